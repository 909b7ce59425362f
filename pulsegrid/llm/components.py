"""Connected components of a graph that no single machine needs to hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored

MAX_ROUNDS = 60
CHUNK = 1 << 18


def _stars(u: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
    """The same components as stars around their smallest nodes (edges given as u > v)."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = ends[: len(u)], ends[len(u) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[x], least[y])
        # Both ends, and what their labels point to, take the smaller label.
        for place in (x, y, before[x], before[y]):
            np.minimum.at(least, place, low)
        least = least[least]
        if (least == before).all():
            break
    leaf = np.flatnonzero(least != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[leaf]), pa.array(nodes[least[leaf]])], ["u", "v"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars of the edges that lie in one task, a bounded number of edges at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            yield _stars(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v")))
            held, size = [], 0
    if size:
        yield _stars(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v")))


def _print_of(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges; two equal prints mean nothing changed."""
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), checksum).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge; the component is its smallest node.

    Links are first contracted to stars inside the tasks that hold them. Each round hangs the neighbours of a node below the smallest of them, first the larger
    ones, then the smaller ones, which turns any graph into stars in a logarithmic number
    of rounds. The minimum is taken by a sum before the shuffle, so a node with very many
    neighbours costs no more than its rows, and joins of such nodes are split.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    shape = "u long, v long"
    now = stored(pairs.filter("u <> v").distinct().mapInArrow(_contract, shape).distinct(), "edges")
    before = _print_of(now)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        hung = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.distinct()
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        below = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        now = stored(
            hung.join(least, "u").select(below.alias("u"), F.col("m").alias("v")).distinct(), "edges"
        )
        after = _print_of(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.union(roots)
