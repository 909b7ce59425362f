"""Exact top-k search by inner product, pruned by statistics of vector segments.

A vector is cut into segments. With the mean m and the deviation norm s of each segment of
n components, ``sum n m m' + s s'`` is never below the inner product; it is the form that
the lower bound on the distance takes for inner products. Coarse segments give a loose,
cheap bound, finer ones a tighter one. A query goes from coarse to fine, and only the rows
whose bound reaches its k-th best score so far get an exact score.

Rows are dealt into blocks of bounded size by a hash of a number of their own. A task keeps one block
and lets the queries pass in batches, so neither side has to fit into memory. The block's
best rows per query are merged by a rank over the query.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no
part, nor do rows without id; rows that repeat an id are each a candidate of all other ids'
queries, and as queries they are ranked together; only vectors of the query's length are
compared; equal scores go by the smaller id. A component or a score beyond the range of a
long raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, stored

LEVELS = (1, 4, 16)
BLOCK_ROWS = 16_384
FIRST_LOOK = 32
TOGETHER = 64
EXACT_DOUBLE = 2.0**53
LONG = 2.0**63


def quantised(vectors: Column, scale: float) -> Column:
    """floor(scale * x) of each component, as long."""
    return F.transform(vectors, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vectors: Column) -> Column:
    """Not null, not empty, every component finite."""
    limit = F.lit(float("inf"))
    finite = F.forall(
        vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < limit)
    )
    return vectors.isNotNull() & (F.size(vectors) > 0) & F.coalesce(finite, F.lit(False))


def segment_statistics(rows: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(n) * mean and the norm of the deviations, side by side."""
    parts = np.array_split(rows, min(segments, rows.shape[1]), axis=1)
    means = [p.mean(axis=1) for p in parts]
    spreads = [np.sqrt(np.maximum(((p - m[:, None]) ** 2).sum(axis=1), 0)) for p, m in zip(parts, means)]
    roots = [np.sqrt(p.shape[1]) for p in parts]
    return np.stack([m * r for m, r in zip(means, roots)] + spreads, axis=1)


def within_long(floats: np.ndarray) -> float:
    """The largest size of a component. One beyond a long's range was cut to its end before."""
    largest = float(np.abs(floats).max(initial=0))
    if largest >= LONG:
        raise OverflowError("a vector's scaled component leaves the range of a long")
    return largest


class Block:
    """The candidates of one block and one vector length."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, levels=LEVELS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.floats = self.rows.astype(float)
        self.levels = levels
        self.statistics = [segment_statistics(self.floats, s) for s in levels]
        self.norms = np.sqrt((self.floats**2).sum(axis=1))
        self.largest = within_long(self.floats)

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact integer scores; doubles are exact as long as no sum can pass 2**53."""
        floats = query.astype(float)
        bound = self.largest * within_long(floats) * len(query)
        if bound < EXACT_DOUBLE:
            return (self.floats[at] @ floats).astype(np.int64)
        if bound < LONG:
            return (self.rows[at] * query).sum(axis=1)
        # numpy refuses whole numbers that a long cannot hold.
        return (self.rows[at].astype(object) @ query.astype(object)).astype(np.int64)

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple]:
        """Of each query its id, and the ids and scores of its k best rows."""
        floats = queries.astype(float)
        lengths = np.sqrt((floats**2).sum(axis=1))
        slack = 1e-9 * (1.0 + lengths * self.norms.max(initial=0))
        floor = np.full(len(queries), -np.inf)
        scores = [np.zeros(0, np.int64)] * len(queries)
        found = [np.zeros(0, np.int64)] * len(queries)
        columns = np.arange(len(self.ids))
        for level, rows in zip(self.levels, self.statistics):
            bounds = segment_statistics(floats, level) @ rows[columns].T
            # Exact scores of the most promising rows raise the floor for the others.
            look = min(max(FIRST_LOOK, k + 1), len(columns))
            first = np.argpartition(bounds, len(columns) - look, axis=1)[:, len(columns) - look :]
            for i in range(len(queries)):
                at = np.setdiff1d(columns[first[i]], found[i], assume_unique=True)
                at = at[self.ids[at] != query_ids[i]]
                found[i] = np.concatenate([found[i], at])
                scores[i] = np.concatenate([scores[i], self.scores(at, queries[i])])
                if len(scores[i]) >= k:
                    floor[i] = np.partition(scores[i], len(scores[i]) - k)[len(scores[i]) - k]
            alive = bounds >= (floor - slack)[:, None]
            some = alive.any(axis=0)
            columns, alive = columns[some], alive[:, some]
        for i in range(len(queries)):
            at = np.setdiff1d(columns[alive[i]], found[i], assume_unique=True)
            at = at[self.ids[at] != query_ids[i]]
            at = np.concatenate([found[i], at])
            exact = np.concatenate([scores[i], self.scores(at[len(found[i]) :], queries[i])])
            top = np.lexsort((self.ids[at], -exact))[:k]
            yield query_ids[i], self.ids[at[top]], exact[top]


def _search(k: int, levels: tuple):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, blocks, current = [], None, None
        for batch in batches:
            for number, part in batch.groupby("block", sort=True):
                if number != current:
                    kept, blocks, current = [], None, number
                rows = part[part["role"] == 0]
                if len(rows):
                    kept.append((rows["id"].to_numpy(np.int64), list(rows["vector"])))
                queries = part[part["role"] == 1]
                if not len(queries):
                    continue
                if blocks is None:
                    blocks = _by_length(kept, levels)
                out = []
                for length, ids, vectors in _lengths(queries["id"].to_numpy(np.int64), list(queries["vector"])):
                    block = blocks.get(length)
                    if block is None:
                        continue
                    for at in range(0, len(ids), TOGETHER):
                        found = block.best(ids[at : at + TOGETHER], vectors[at : at + TOGETHER], k)
                        out += [
                            pd.DataFrame({"query_id": i, "vec_id": got, "score": scores})
                            for i, got, scores in found
                        ]
                if out:
                    yield pd.concat(out)

    return search


def _lengths(ids: np.ndarray, vectors: list):
    """Rows grouped by vector length, each group as a matrix."""
    sizes = np.array([len(v) for v in vectors])
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        yield int(length), ids[at], np.stack([np.asarray(vectors[i], np.int64) for i in at])


def _by_length(kept: list, levels: tuple) -> dict:
    if not kept:
        return {}
    ids = np.concatenate([i for i, _ in kept])
    vectors = [v for _, part in kept for v in part]
    return {n: Block(i, v, levels) for n, i, v in _lengths(ids, vectors)}


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
    levels: tuple = LEVELS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows for every query row."""
    clean = df.select(
        named(id_col).cast("long").alias("id"), named(vector_col).alias("v"), is_query.alias("q")
    )
    clean = clean.filter(usable(F.col("v")) & F.col("id").isNotNull())
    numbered = clean.select("id", quantised(F.col("v"), scale).alias("vector"), "q", F.monotonically_increasing_id().alias("row"))
    rows = stored(numbered, "vectors")
    blocks = max(1, -(-rows.count() // block_rows))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    candidates = rows.select(block.alias("block"), F.lit(0).alias("role"), "id", "vector")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = rows.filter("q").select(every.alias("block"), F.lit(1).alias("role"), "id", "vector")
    dealt = candidates.union(queries).repartition(blocks, "block").sortWithinPartitions("block", "role")
    found = dealt.mapInPandas(_search(k, levels), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
