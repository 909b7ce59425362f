"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct word shingles; two documents link if the sets' Jaccard
similarity reaches the threshold. The work goes in these steps:

1. Documents with equal sets form a class with a number of its own, whatever their ids; the
   steps below work on these numbers, and ids come back at the end, one row per document.
2. Each class gets ``trees * depth`` MinHash values. Tree t orders the classes by their
   values from t * depth on. A region is a run of one order with the first ``depth`` values
   in common. A pair at 0.85 shares no region of 24 trees with probability 1e-10. Regions are
   counted first, on their numbers alone; only rows that share one go on.
3. The depth adapts: where more than ``leaf`` rows share a prefix it grows by two values, and
   by two more, to cells that hold fewer. Rows still together after ``depth + 4`` values are
   dealt to cells by a hash, so that no sorted run exceeds about ``leaf`` rows. Neighbours in
   a cell's order share the longest prefixes. The first round compares direct neighbours of a
   few orders, which joins most copies. In the second the row with most links so far, one
   per region and one per deeper cell, is compared with every row of the region or cell that has
   not joined it, however many: it holds a star of edited copies together.
4. The last round is exact. A region of up to ``REACH + 1`` rows is compared in full by the
   ``REACH`` rows behind each. A larger one that still holds several components goes in
   blocks of bounded rows and bytes, each pair of blocks a task of its own, and rows of
   different components are compared there on their signatures and then on their full sets,
   in the first tree that the two share. Only links leave such a task.
5. Candidates of the other rounds must fit by size and by a sketch of one bit per MinHash
   value, and are then confirmed on the full sets. Pairs whose components are one already
   are left out.

The last round of a crowded region costs the square of the rows that are not yet joined; no
pair of different components that shares a region goes unseen.

Nothing emits all pairs of a group: what is already joined is not paired again. No links
come to the driver. Rows without an id keep it null, link with nothing and are kept; rows
that repeat an id link by their own texts, each with a result row of its own, and are told
apart by ``text_hash``; texts without words have an empty set and link with nothing. Words are split at blank and \\t to \\r and lower-cased for A-Z only.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, stored
from pulsegrid.llm.components import components
from pulsegrid.llm.shingles import ODD, WIDTH, minhash_seeds, mixed, shingle_set, signature

TREES, DEPTH = 24, 3
REACH = 6
SIGMAS = 6.5
BROADCAST_IDS = 250_000
FIRST_TREES = 4
LEAF = 256
BLOCK_ROWS = 2_048
BLOCK_BYTES = 32 << 20
MISS = 1e-9

PROFILE = "id long, h long, n long, d1 long, d2 long, sig binary"


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two numbers."""
    import hashlib

    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _profiles(width: int, count: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = minhash_seeds(count)
        for batch in batches:
            sizes, digests, sigs = [], [], []
            for text in batch.column("t"):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                digests.append(_digest(shingles))
                sigs.append(signature(shingles, seeds).tobytes())
            columns = [batch.column("id"), batch.column("h"), pa.array(sizes, pa.int64()),
                       pa.array([d for d, _ in digests], pa.int64()), pa.array([d for _, d in digests], pa.int64()),
                       pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "h", "n", "d1", "d2", "sig"])

    return profile


FOREST = "region long, tree int, o1 long, o2 long, id long, n long, s1 long, s2 long"


def _turned(sig: np.ndarray, trees: int, depth: int, more: int = 0) -> np.ndarray:
    """Each tree's values in its order, from its own first value on: (rows, trees, depth + more)."""
    places = np.arange(trees)[:, None] * depth + np.arange(depth + more)
    return sig[:, places % (trees * depth)].astype(np.uint64)


def _region(turned: np.ndarray) -> np.ndarray:
    """A number for each row's tree and the values given."""
    number = mixed(np.arange(1, turned.shape[1] + 1, dtype=np.uint64))[None, :]
    for k in range(turned.shape[2]):
        number = mixed(number * ODD + turned[:, :, k])
    return number


def _signatures(batch: pa.RecordBatch, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, count)


def _region_numbers(trees: int, depth: int):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions = _region(_turned(_signatures(batch, trees * depth), trees, depth)).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(regions.view(np.int64))], ["region"])

    return number


def _trees(trees: int, depth: int):
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = trees * depth
        half = (count + 1) // 2
        for batch in batches:
            ids = np.repeat(batch.column("id").to_numpy(), trees)
            sizes = np.repeat(batch.column("n").to_numpy(), trees)
            sig = _signatures(batch, count)
            bits = (sig & 1).astype(np.uint64)
            weights = np.uint64(1) << np.arange(half, dtype=np.uint64)
            s1 = (bits[:, :half] * weights).sum(axis=1, dtype=np.uint64)
            s2 = (bits[:, half:] * weights[: count - half]).sum(axis=1, dtype=np.uint64)
            turned = _turned(sig, trees, depth, 4)
            regions = _region(turned[:, :, :depth]).ravel()
            rest = turned[:, :, depth:].reshape(-1, 4)
            shift = np.uint64(32)
            columns = [
                regions, np.tile(np.arange(trees, dtype=np.int32), len(sig)),
                (rest[:, 0] << shift) | rest[:, 1], (rest[:, 2] << shift) | rest[:, 3],
                ids, sizes, np.repeat(s1, trees), np.repeat(s2, trees),
            ]
            arrays = [pa.array(c if c.dtype == np.int32 else c.astype(np.int64)) for c in columns]
            names = [f.split()[0] for f in FOREST.split(", ")]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return plant


def _deepened(forest: DataFrame, leaf: int) -> DataFrame:
    """Forest rows with the cell whose order they are sorted in, and the cells that have hubs.

    A cell is the shortest prefix of ``depth``, ``depth + 2`` or ``depth + 4`` values that at
    most ``leaf`` rows share, or a share by hash of the rows of the longest.
    """
    small = forest.filter(F.col("crowd") <= leaf)
    small = small.withColumns({"cell": F.col("region"), "cells": F.array("region")})
    large = forest.filter(F.col("crowd") > leaf)
    large = large.withColumns({"second": F.xxhash64("region", "o1"), "third": F.xxhash64("region", "o1", "o2")})
    seconds = large.groupBy("second").agg(F.count("*").alias("seconds"))
    thirds = large.groupBy("third").agg(F.count("*").alias("thirds"))
    large = large.join(seconds, "second").join(thirds, "third")
    shares = F.pmod(F.xxhash64("id"), F.ceil(F.col("thirds") / leaf))
    cell = F.when(F.col("seconds") <= leaf, F.col("second"))
    cell = cell.when(F.col("thirds") <= leaf, F.col("third")).otherwise(F.xxhash64("third", shares))
    deeper = F.array("region", F.when(F.col("seconds") <= leaf, F.col("second")).otherwise(F.col("third")))
    large = large.withColumns({"cell": cell, "cells": deeper})
    return small.unionByName(large.drop("second", "third", "seconds", "thirds"))


def _sets(width: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, found = [], []
            for text in batch.column("t"):
                shingles = shingle_set(text.as_py(), width)
                digests.append(_digest(shingles))
                found.append(shingles.tobytes())
            columns = [batch.column("rep"), pa.array([d for d, _ in digests], pa.int64()),
                       pa.array([d for _, d in digests], pa.int64()), pa.array(found, pa.large_binary())]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "d1", "d2", "set"])

    return sets


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            columns = [batch.column("a"), batch.column("b")]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _likely(x: Column, y: Column, percent: int, count: int) -> Column:
    """Sizes allow the threshold, and the sketches differ in no more bits than chance explains."""
    share = (1 - percent / 100) / 2
    most = int(count * share + SIGMAS * (count * share * (1 - share)) ** 0.5)
    differ = F.bit_count(x["s1"].bitwiseXOR(y["s1"])) + F.bit_count(x["s2"].bitwiseXOR(y["s2"]))
    small, large = F.least(x["n"], y["n"]), F.greatest(x["n"], y["n"])
    return (small * 100 >= large * percent) & (differ <= most) & (x["c"] != y["c"])


def _pairs(paired: DataFrame, percent: int, count: int) -> DataFrame:
    """Pairs of each row with those of its ``others`` that may link."""
    own = F.struct("id", "n", "s1", "s2", "c")
    fitting = F.filter("others", lambda y: _likely(own, y, percent, count))
    found = paired.select("id", F.explode(F.transform(fitting, lambda y: y["id"])).alias("o"))
    return found.select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b")).distinct()


def _neighbours(rows: DataFrame, reach: int, percent: int, count: int) -> DataFrame:
    """Pairs of rows that lie at most ``reach`` places apart in a cell's order."""
    order = Window.partitionBy("cell").orderBy("o1", "o2", "id").rowsBetween(1, reach)
    others = F.collect_list(F.struct("id", "n", "s1", "s2", "c")).over(order)
    return _pairs(rows.withColumn("others", others), percent, count)


def _with_hubs(rows: DataFrame, percent: int, count: int) -> DataFrame:
    """Pairs of the best linked row with all others, in every region and in its deepest cells.

    The best row is a maximum that is merged before the shuffle.
    """
    rows = rows.withColumn("cell", F.explode("cells"))
    best = F.max(F.struct("links", "id", "n", "s1", "s2", "c"))
    hubs = rows.filter("links > 1").groupBy("cell").agg(F.array(best).alias("others"))
    return _pairs(rows.join(hubs, "cell"), percent, count)


def fewest_equal(count: int, percent: int) -> int:
    """The number of equal MinHash values below which a linked pair falls with chance ``MISS``."""
    share, below = percent / 100, 0.0
    for equal in range(count + 1):
        below += comb(count, equal) * share**equal * (1 - share) ** (count - equal)
        if below > MISS:
            return equal
    return count


def _block_links(trees: int, depth: int, percent: int):
    """Links between rows of different components in one pair of blocks."""
    fewest = fewest_equal(trees * depth, percent)

    def find(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, blocks = group.column("id").to_numpy(), group.column("block").to_numpy()
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32)
        sig = sig.reshape(len(ids), -1)
        sizes = group.column("n").to_numpy()
        sets = np.frombuffer(b"".join(group.column("set").to_pylist()), np.uint64)
        known, codes = np.unique(sets, return_inverse=True)
        codes = np.split(codes, np.cumsum(sizes)[:-1])
        parts = np.unique(group.column("c").to_numpy(), return_inverse=True)[1]
        tree = group.column("tree")[0].as_py()
        crossing = group.column("i")[0].as_py() != group.column("j")[0].as_py()
        inside = np.zeros(len(known), bool)
        found = []
        for x in range(len(ids) - 1):
            fits = parts[x + 1 :] != parts[x]
            if crossing:
                fits &= blocks[x + 1 :] != blocks[x]
            low, high = np.minimum(sizes[x + 1 :], sizes[x]), np.maximum(sizes[x + 1 :], sizes[x])
            others = np.flatnonzero(fits & (low * 100 >= high * percent)) + x + 1
            equal = sig[others] == sig[x]
            # A pair belongs to the first tree in which the two share a region.
            shared = equal.reshape(-1, trees, depth).all(axis=2).argmax(axis=1)
            others = others[(equal.sum(axis=1) >= fewest) & (shared == tree)]
            inside[codes[x]] = True
            for y in others:
                both = int(np.count_nonzero(inside[codes[y]]))
                if 100 * both >= percent * int(sizes[x] + sizes[y] - both):
                    found.append((ids[x], ids[y]))
                    parts[parts == parts[y]] = parts[x]
            inside[codes[x]] = False
        ends = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": ends[:, 0], "b": ends[:, 1]})

    return find


def _crowded_links(
    rows: DataFrame, sets: DataFrame, signed: DataFrame, trees: int, depth: int, percent: int
) -> DataFrame:
    """All links between different components inside the crowded regions."""
    crowded = rows.filter(F.col("crowd") > REACH + 1)
    most = F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") * 8 / BLOCK_BYTES)
    regions = crowded.groupBy("region").agg(
        F.ceil(most).cast("int").alias("blocks"), F.min("c").alias("low"), F.max("c").alias("high")
    )
    regions = regions.filter("low <> high").select("region", "blocks")
    own = crowded.join(regions, "region")
    own = own.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    own = own.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.select(
        "region", "tree", F.least("block", "k").alias("i"), F.greatest("block", "k").alias("j"),
        "block", "id", "n", "c",
    )
    ids = own.select("id").distinct()
    full = sets.join(ids, "id", "left_semi")
    full = full.join(signed.select("id", "sig"), "id")
    groups = own.join(full, "id").groupBy("region", "i", "j")
    return groups.applyInArrow(_block_links(trees, depth, percent), "a long, b long").distinct()


def _labelled(forest: DataFrame, parts: DataFrame | None, links: DataFrame | None) -> DataFrame:
    """Forest rows with their component so far and the number of links that the last round found."""
    if parts is None:
        return forest.withColumn("c", F.col("id")).withColumn("links", F.lit(0))
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    degrees = ends.groupBy("node").agg(F.count("*").cast("int").alias("links"))
    known = parts.join(degrees, "node", "left").withColumnRenamed("node", "id")
    rows = forest.join(known, "id", "left")
    return rows.withColumns({
        "c": F.coalesce("component", "id"), "links": F.coalesce("links", F.lit(0))
    }).drop("component")


def near_duplicates(
    df: DataFrame,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    trees: int = TREES,
    depth: int = DEPTH,
    leaf: int = LEAF,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` per row.

    Links need 100 * both >= percent * either; ``text_hash`` is xxhash64 of the text as given.
    """
    count = trees * depth
    text = named(text_col).cast("string")
    texts = df.select(named(id_col).cast("long").alias("id"), text.alias("t"), F.xxhash64(text).alias("h"))
    profiles = stored(texts.mapInArrow(_profiles(width, count), PROFILE), "profiles")
    real = profiles.filter("n > 0 and id is not null")
    # The numbers are fixed by being written; one id may stand for several classes.
    place = ["rep", "d1", "d2"]
    classes = real.groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("class"), *place), "classes")
    numbered = classes.withColumnRenamed("class", "id")
    signed = real.select(F.col("id").alias("rep"), "d1", "d2", "n", "sig").join(numbered, place)
    signed = stored(signed.dropDuplicates(place).select("id", "n", "sig"), "signed")
    regions = signed.select("sig").mapInArrow(_region_numbers(trees, depth), "region long")
    regions = regions.groupBy("region").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    regions = stored(regions, "regions")
    forest = stored(signed.mapInArrow(_trees(trees, depth), FOREST).join(regions, "region"), "forest")
    forest = stored(_deepened(forest, leaf), "orders")

    wanted = stored(numbered.join(forest.select("id").distinct(), "id"), "wanted")
    # Four numbers a class: within this bound they go to every task, and texts need not move.
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    chosen = texts.select(F.col("id").alias("rep"), "t").join(wanted.select("rep").distinct(), "rep", "left_semi")
    # Of the texts of a repeated id, those count that the class was made of.
    sets = chosen.mapInArrow(_sets(width), "rep long, d1 long, d2 long, set binary").join(wanted, place)
    sets = stored(sets.select("id", "set").dropDuplicates(["id"]), "sets")

    links = parts = tested = None
    # The neighbours of the first orders, then the hubs, then all that is still apart.
    for reach in (1, 0, REACH):
        rows = _labelled(forest, parts, links)
        if not reach:
            pairs = _with_hubs(rows, percent, count)
        else:
            first = F.col("tree") < FIRST_TREES if reach == 1 else F.col("crowd") <= REACH + 1
            pairs = _neighbours(rows.filter(first), reach, percent, count)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        used = sets.join(ends, "id", "left_semi")
        both = pairs.join(used.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
        both = both.join(used.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
        good = both.select("a", "b", "x", "y").mapInArrow(_confirmed(percent), "a long, b long")
        if reach == REACH:
            good = good.union(_crowded_links(rows, sets, signed, trees, depth, percent))
        good = stored(good, "links")
        if not good.isEmpty():
            links = good
            # Earlier links count no more than the components they made.
            edges = good if parts is None else good.union(parts.select("node", "component"))
            parts = stored(components(edges), "parts")
        tested = pairs if tested is None else tested.unionByName(pairs)

    if parts is None:
        joined = classes.withColumn("component_id", F.col("rep"))
    else:
        joined = classes.join(parts.withColumnRenamed("node", "class"), "class", "left")
        least = joined.filter("component is not null").groupBy("component")
        least = least.agg(F.min("rep").alias("component_id"))
        joined = joined.join(least, "component", "left")
        joined = joined.withColumn("component_id", F.coalesce("component_id", "rep"))
    result = profiles.select("id", "h", "n", "d1", "d2")
    result = result.join(joined.select("d1", "d2", F.col("component_id").alias("least")), ["d1", "d2"], "left")
    component = F.coalesce(F.when(F.col("id").isNotNull(), F.col("least")), F.col("id"))
    kept = F.coalesce(F.col("id") == component, F.lit(True))
    return result.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        kept.alias("kept"), F.col("h").alias("text_hash"),
    )
