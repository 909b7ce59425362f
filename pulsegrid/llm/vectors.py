"""Near-duplicate embeddings by binary codes of randomly rotated vectors.

Each unit vector is rotated; the signs of the rotated components are its code, and the
share of its length that the code keeps is its correction factor. The product of one
vector's code with the other's rotated components, divided by the factor, is an unbiased
estimate of the cosine, with an error bound that holds at ``SIGMAS`` deviations. A pair
whose estimate plus bound stays below the threshold is dropped; every other pair gets its
exact cosine in double precision, so no link is below the threshold.

Candidates come from the codes too: ``tables`` rotations, of each the first ``bits`` signs
and the label make a bucket. ``bits`` grows with the logarithm of the largest label, so the
rows per bucket stay the same, and ``tables`` is set so that a pair at the threshold meets
in no bucket with probability ``MISS`` at most. Each pair is counted in the first table
where it meets, which its codes tell, so counts need no list of pairs. Buckets beyond
``BLOCK_ROWS`` rows are cut into blocks, and each pair of blocks is one piece of work: no
row is left out, and memory stays bounded.

Equal vectors of one label form a class with a number of its own, whose members count as
links; only the class takes part. Defined cases: rows without label, and vectors that are null, empty, zero or
hold a null or non-finite component, link with nothing; only vectors of equal length link;
rows that repeat an id are vectors of their own, with links and components of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, per_process, stored
from pulsegrid.llm.components import components
from pulsegrid.llm.topk import usable

MISS = 1e-7
ROWS_PER_BUCKET = 32
BLOCK_ROWS = 2_048
SIGMAS = 5.0
CODE_TABLES = 4
#: Numbers of all rotations that a worker keeps (256 MB).
KEPT_NUMBERS = 1 << 25


def rotation(table: int, size: int) -> np.ndarray:
    """A random rotation of the given size, the same in every task; kept in the worker's process."""
    kept = per_process("rotations", dict)
    if (table, size) not in kept:
        rng = np.random.default_rng([table, size])
        q, r = np.linalg.qr(rng.standard_normal((size, size)))
        if sum(x.size for x in kept.values()) + q.size > KEPT_NUMBERS:
            kept.clear()
        kept[table, size] = q * np.sign(np.diag(r))
    return kept[table, size]


def tables_for(threshold: float, bits: int) -> int:
    agree = 1 - math.acos(threshold) / math.pi
    return max(1, math.ceil(math.log(MISS) / math.log(1 - agree**bits)))


def bucket_numbers(units: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Bucket of every row in every table."""
    out = np.zeros((len(units), tables), np.int64)
    size = units.shape[1]
    for t in range(tables):
        # A vector shorter than the code takes more rotations until there are bits enough.
        signs = [units @ rotation(t * 64 + k, size).T >= 0 for k in range(-(-bits // size))]
        out[:, t] = np.hstack(signs)[:, :bits] @ (1 << np.arange(bits))
    return out


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors, their signs, and the correction factor, over CODE_TABLES rotations."""
    size = units.shape[1]
    turned = np.hstack([units @ rotation(10_000 + k, size).T for k in range(CODE_TABLES)])
    turned /= math.sqrt(CODE_TABLES)
    signs = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(turned.shape[1])
    return turned, signs, (turned * signs).sum(axis=1)


def estimates(left: tuple, right: tuple, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of every left row with every right row, and the bound per left row."""
    _, signs, factor = left
    guess = (signs @ right[0].T) / factor[:, None]
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(max(size - 1, 1))
    return guess, SIGMAS * spread


class Vectors:
    """Vectors of one length with what the bounds and the exact cosine need."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        self.codes = codes(rows / self.norms[:, None])

    def linked(self, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple:
        """Pairs of a left and a right position whose exact cosine reaches the threshold."""
        one = tuple(x[left] for x in self.codes)
        guess, bound = estimates(one, (self.codes[0][right],), self.rows.shape[1])
        i, j = np.nonzero(guess + bound[:, None] >= threshold)
        i, j = left[i], right[j]
        if left is right:
            # A pair has an estimate from either side; one of them suffices.
            size = len(self.rows)
            both = np.unique(np.minimum(i, j)[i != j] * size + np.maximum(i, j)[i != j])
            i, j = both // size, both % size
        dots = np.einsum("ij,ij->i", self.rows[i], self.rows[j])
        near = dots / (self.norms[i] * self.norms[j]) >= threshold
        return i[near], j[near]


def _least(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest position that each position reaches by the links given."""
    least = np.arange(n)
    while True:
        now = least.copy()
        np.minimum.at(now, i, least[j])
        np.minimum.at(now, j, least[i])
        now = now[now]
        if (now == least).all():
            return least
        least = now


COUNTED = "id long, links long, other long"


def _compare(threshold: float):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch)
            rows = pd.concat(held) if len(held) > 1 else batch
            # Rows come sorted by piece; the last one may go on in the next batch.
            last = rows["piece"].iloc[-1] if len(rows) else None
            done = rows["piece"] != last
            held = [rows[~done]]
            yield from _pieces(rows[done], threshold)
        if held:
            yield from _pieces(held[0], threshold)

    return compare


def _pieces(rows: pd.DataFrame, threshold: float) -> Iterator[pd.DataFrame]:
    out = []
    sizes = rows["vector"].map(len).to_numpy() if len(rows) else np.zeros(0)
    for size in np.unique(sizes):  # a piece holds vectors of one length
        part = rows[sizes == size]
        known = Vectors(np.stack(part["vector"].to_numpy()).astype(float))
        buckets = np.stack(part["buckets"].to_numpy())
        piece, table, block, ids, copies = (
            part[c].to_numpy() for c in ("piece", "tab", "block", "id", "copies")
        )
        cuts = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1], [True]]))
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            at = np.arange(a, b)
            blocks = np.unique(block[a:b])
            sides = [at[block[a:b] == x] for x in (blocks[0], blocks[-1])] if len(blocks) > 1 else [at, at]
            i, j = known.linked(*sides, threshold)
            t = table[a]
            first = ~(buckets[i, :t] == buckets[j, :t]).any(axis=1)
            i, j = i[first], j[first]
            if not len(i):
                continue
            counts = np.bincount(i - a, copies[j], b - a) + np.bincount(j - a, copies[i], b - a)
            some = np.flatnonzero(counts)
            least = _least(i - a, j - a, b - a)
            out.append((ids[a + some], counts[some].astype(np.int64), ids[a + least[some]]))
    if out:
        yield pd.DataFrame({c: np.concatenate(x) for c, x in zip(("id", "links", "other"), zip(*out))})


def near_vectors(
    df: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of the table."""
    rows = df.select(
        named(id_col).cast("long").alias("id"), named(vector_col).cast("array<double>").alias("vector"),
        named(label_col).cast("string").alias("label"),
    )
    nonzero = F.exists("vector", lambda x: x != 0)
    fits = usable(F.col("vector")) & nonzero & F.col("label").isNotNull() & F.col("id").isNotNull()
    rows = rows.withColumn("fits", F.coalesce(fits, F.lit(False)))
    same = ["label", "vector"]
    classes = rows.filter("fits").groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    # The numbers are fixed by being written; one id may stand for several classes.
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits = min(30, max(4, math.ceil(math.log2(max(most, 1) / ROWS_PER_BUCKET + 1))))
    tables = tables_for(threshold, bits)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch["vector"].map(len).to_numpy()
            for size in np.unique(sizes):
                part = batch[sizes == size].copy()
                vectors = np.stack(part["vector"].to_numpy()).astype(float)
                units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
                part["buckets"] = list(bucket_numbers(units, tables, bits))
                yield part

    shape = "label string, id long, copies long, vector array<double>, buckets array<long>"
    own = classes.select("label", F.col("class").alias("id"), "copies", "vector")
    dealt = own.mapInPandas(coded, shape)
    dealt = dealt.select("*", F.size("vector").alias("size"), F.posexplode("buckets").alias("tab", "bucket"))
    place = ["label", "size", "tab", "bucket"]
    crowd = dealt.groupBy(*place).count().filter(F.col("count") > block_rows)
    crowd = crowd.select(*place, F.ceil(F.col("count") / block_rows).cast("int").alias("blocks"))
    dealt = dealt.join(crowd, place, "left").fillna(1, ["blocks"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pieces = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("mate", pieces)
    piece = F.xxhash64(*place, F.least("block", "mate"), F.greatest("block", "mate"))
    dealt = dealt.withColumn("piece", piece)
    # Alone in its piece, a row has nothing to be compared with.
    alone = F.count("*").over(Window.partitionBy("piece"))
    dealt = dealt.select("piece", "tab", "block", "id", "copies", "vector", "buckets", alone.alias("near"))
    dealt = dealt.filter("near > 1").drop("near").repartition("piece").sortWithinPartitions("piece", "id")
    found = stored(dealt.mapInPandas(_compare(threshold), COUNTED), "counted")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    per_class = classes.join(links.withColumnRenamed("id", "class"), "class", "left")
    per_class = per_class.join(parts.withColumnRenamed("node", "class"), "class", "left")
    least = per_class.filter("component is not null").groupBy("component").agg(F.min("rep").alias("least"))
    per_class = per_class.join(least, "component", "left")
    per_class = per_class.select(
        *same,
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "rep").alias("component_id"),
        F.lit(True).alias("fits"),
    )
    out = rows.join(per_class, [*same, "fits"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
