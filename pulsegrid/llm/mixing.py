"""Mixing sources to target weights by proportionate-fair scheduling of blocks.

A source's documents, in the order of a hash of their id, make blocks of ``block`` documents.
The ideal gives every source, at any time, its share w / W of the weights of all sources that
ideally have blocks left. It has given j blocks of a source with weight w when
T(j / w) = sum over all sources of min(blocks, weight j / w) slots have passed. Block j (from 1)
gets the release time floor(T((j - 1) / w)) and the deadline ceil(T(j / w)). Every slot takes, of
the released blocks, the one with the earliest deadline, ties by source name. All deadlines
are met, so up to any slot each source lags or leads its ideal by less than one block, also
across the ends of other sources. No document is dropped or repeated.

While the ideal shares stay the same the schedule repeats after W slots. Only what does not
repeat is made step by step; the slot of a block follows by division, and the work runs on
Spark. The driver holds one row per source and four numbers per slot that does not repeat; there
are at most as many of those as blocks, whatever the number of sources and their weights.

A document's place in its source comes from two levels: hash ranges of bounded size are
ranked apart, and their counts are added up, so a source of any size is many tasks.

Defined cases: a null source is a source of its own; a source without a weight has weight
1; weights must be whole numbers of 1 or more; rows that repeat an id each count, in an
order of no importance; a source's last block may be short.
"""

from __future__ import annotations

import heapq
import math
from array import array
from bisect import bisect_left
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, stored

BLOCK = 16
RANGE_ROWS = 8_192
#: Longer schedule tables are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
NULL = "\x00null"


def ideal(blocks: Mapping[str, int], unit: Mapping[str, int], weights: Mapping[str, int]) -> list[tuple]:
    """The pieces of T in order: the time at which sources end, and done and W of T(v) = done + W v.

    Times are whole numbers: a block of a source takes ``unit``, the common multiple of all
    weights divided by its own.
    """
    ends: dict[int, list[str]] = {}
    for s, n in blocks.items():
        ends.setdefault(n * unit[s], []).append(s)
    done, total, out = 0, sum(weights[s] for s in blocks), []
    for v in sorted(ends):
        out.append((v, done, total))
        done += sum(blocks[s] for s in ends[v])
        total -= sum(weights[s] for s in ends[v])
    return out


def carried(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[tuple]:
    """The whole schedule as parts ``begin, rounds, slots``; a part's slots repeat ``rounds`` times.

    A slot is four numbers: the source's place in ``blocks``, and ``phase, release, deadline``
    of its block in the first round.
    """
    number = {s: k for k, s in enumerate(blocks)}
    left = {s: n for s, n in blocks.items() if n > 0}
    common = math.lcm(*(weights[s] for s in left))
    unit = {s: common // weights[s] for s in left}
    pieces = ideal(left, unit, weights)
    ends = [v for v, _, _ in pieces]
    at = dict.fromkeys(left, 0)  # the piece in which the source's next block begins
    given = dict.fromkeys(left, 0)

    waiting: list[tuple] = []
    ready: list[tuple] = []

    def offer(s: str) -> None:
        """The source's next block waits for its release."""
        j, w, k = given[s] + 1, weights[s], at[s]
        begin = pieces[k][1] + (j - 1) * pieces[k][2] // w
        last = k if j * unit[s] <= ends[k] else bisect_left(ends, j * unit[s], k)
        due = pieces[last][1] - (-j * pieces[last][2] // w)
        at[s] = last
        heapq.heappush(waiting, (begin, due, s, last))

    def step() -> None:
        while waiting and waiting[0][0] <= t:
            begin, due, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, begin, k))
        due, s, begin, k = heapq.heappop(ready)
        slots.extend((number[s], k, begin, due))
        given[s] += 1
        if given[s] < left[s]:
            offer(s)

    for s in left:
        offer(s)
    t, begun, slots, out, every = 0, 0, array("q"), [], sum(left.values())
    while t < every:
        # The piece in which all blocks offered lie, if there is one, is tried for a repeat.
        active = [s for s in left if given[s] < left[s]]
        k = max(at[s] for s in active)
        total = pieces[k][2]
        start = ends[k - 1] if k else 0
        steady = all(start <= given[s] * unit[s] <= ends[k] - unit[s] for s in active)
        before = dict(given) if steady else {}
        room = min(total, every - t)
        first = len(slots)
        for _ in range(room):
            step()
            t += 1
        if not steady or room < total or any(given[s] - before[s] != weights[s] for s in active):
            continue
        if any(given[s] == left[s] for s in active):
            continue
        # As many more rounds as leave every source's next block in this piece.
        more = min((ends[k] // unit[s] - given[s] - 1) // weights[s] for s in active)
        if more < 1:
            continue
        if first:
            out.append((begun, 1, slots[:first]))
        out.append((t - total, 1 + more, slots[first:]))
        for s in active:
            given[s] += more * weights[s]
        t += more * total
        begun, slots = t, array("q")
        waiting, ready = [], []
        for s in active:
            at[s] = k
            offer(s)
    if slots:
        out.append((begun, 1, slots))
    return out


def carried_schedule(blocks: Mapping[str, int], weights: Mapping[str, int]) -> tuple[pa.Table, pa.Table]:
    """The stretch of blocks that each source gives in each part, and one place per slot that does not repeat."""
    names = list(blocks)
    parts = carried(blocks, weights)
    given = np.zeros(len(names), np.int64)
    stretches, places = [], []
    for part, (begin, rounds, slots) in enumerate(parts):
        rows = np.frombuffer(slots, np.int64).reshape(-1, 4)
        # Slots by source, in order: the place in its group is a slot's step.
        at = np.argsort(rows[:, 0], kind="stable")
        own, first, counts = np.unique(rows[at, 0], return_index=True, return_counts=True)
        step = np.arange(len(at)) - np.repeat(first, counts)
        places.append(np.column_stack([rows[at, 0], np.full(len(at), part), step, at, rows[at, 1:]]))
        end = given[own] + rounds * counts
        same = np.ones(len(own), np.int64)
        stretches.append(
            np.column_stack([own, part * same, given[own], end, counts, len(at) * same, begin * same])
        )
        given[own] = end
    return _arrow(stretches, STRETCH, names), _arrow(places, PLACE, names)


def _arrow(parts: list[np.ndarray], shape: str, names: list[str]) -> pa.Table:
    fields = [f.split() for f in shape.split(", ")]
    rows = np.concatenate(parts) if parts else np.zeros((0, len(fields)), np.int64)
    coded = pa.DictionaryArray.from_arrays(pa.array(rows[:, 0]), pa.array(names, pa.string()))
    columns = [coded.cast(pa.string())]
    columns += [
        pa.array(rows[:, k], pa.int32() if kind == "int" else pa.int64())
        for k, (_, kind) in enumerate(fields) if k
    ]
    return pa.Table.from_arrays(columns, [name for name, _ in fields])


STRETCH = "src string, part int, first long, end long, weight long, total long, begun long"
PLACE = "src string, part int, step long, at long, phase int, release long, deadline long"


def ranked(rows: DataFrame, sizes: Mapping[str, int], block: int) -> DataFrame:
    """Rows of ``_src, id, source`` with each one's place in its source as ``_rank`` from 0."""
    own = rows.withColumn("_draw", F.xxhash64("id", F.lit("mix")))
    known = pa.table([pa.array(sizes.keys(), pa.string()), pa.array(sizes.values(), pa.int64())], ["_src", "_size"])
    known = rows.sparkSession.createDataFrame(known, "_src string, _size long")
    # The ranges of a source hold about RANGE_ROWS rows each.
    ranges = F.ceil(F.col("_size") / RANGE_ROWS)
    own = own.join(F.broadcast(known), "_src").withColumn(
        "_range", F.floor((F.shiftrightunsigned("_draw", 33) / float(1 << 31)) * ranges)
    )
    counts = own.groupBy("_src", "_range").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("_src").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inside = Window.partitionBy("_src", "_range").orderBy("_draw", "id")
    placed = own.withColumn("_in", F.row_number().over(inside) - 1)
    placed = placed.join(counts.select("_src", "_range", "_before"), ["_src", "_range"])
    placed = placed.withColumn("_rank", F.col("_before") + F.col("_in"))
    return placed.withColumn("_block", F.floor(F.col("_rank") / block).cast("long"))


def mix(
    df: DataFrame,
    weights: Mapping[str | None, int] | None = None,
    source_col: str = "source",
    id_col: str = "doc_id",
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, source, block, phase, release, deadline, slot, place`` of every document.

    ``release`` and ``deadline`` count slots from the first one; ``place`` is the document's
    place in its block.
    """
    spark = df.sparkSession
    rows = df.select(
        named(id_col).alias("id"), named(source_col).alias("source"),
        F.coalesce(named(source_col).cast("string"), F.lit(NULL)).alias("_src"),
    )
    # One row per source comes to the driver.
    found = rows.groupBy("_src").count().toArrow()
    sizes = dict(sorted(zip(*(c.to_pylist() for c in found.columns))))
    given = {(NULL if s is None else s): int(w) for s, w in (weights or {}).items()}
    if any(w < 1 for w in given.values()):
        raise ValueError("weights must be whole numbers of 1 or more")
    counts = {s: -(-n // block) for s, n in sizes.items()}
    stretches, places = carried_schedule(counts, {s: given.get(s, 1) for s in counts})
    # Neither table has more rows than there are blocks; what repeats is in them once.
    few = len(places) <= BROADCAST_ROWS
    stretches, places = spark.createDataFrame(stretches, STRETCH), spark.createDataFrame(places, PLACE)
    if few:
        stretches, places = F.broadcast(stretches), F.broadcast(places)
    placed = stored(ranked(rows, sizes, block).select("id", "source", "_src", "_rank", "_block"), "mix")
    inside = (F.col("_block") >= F.col("first")) & (F.col("_block") < F.col("end"))
    timed = placed.join(stretches, (F.col("_src") == F.col("src")) & inside).drop("src")
    timed = timed.withColumn("step", (F.col("_block") - F.col("first")) % F.col("weight"))
    timed = timed.join(places.withColumnRenamed("src", "_src"), ["_src", "part", "step"])
    # Each round of a repeated pattern is ``total`` slots later.
    later = F.floor((F.col("_block") - F.col("first")) / F.col("weight")) * F.col("total")
    return timed.select(
        F.col("id").alias("doc_id"), "source", F.col("_block").alias("block"), "phase",
        (F.col("release") + later).cast("long").alias("release"),
        (F.col("deadline") + later).cast("long").alias("deadline"),
        (F.col("begun") + later + F.col("at")).cast("long").alias("slot"),
        (F.col("_rank") % block).cast("int").alias("place"),
    )


def mixed(
    df: DataFrame, weights: Mapping[str | None, int] | None = None, source_col: str = "source",
    id_col: str = "doc_id", block: int = BLOCK,
) -> DataFrame:
    """All rows and columns of ``df`` in the order of the mix, file by file."""
    columns = df.columns
    temporary = {c: f"_c{k}" for k, c in enumerate(columns)}
    plain = df.select(*[named(c).alias(t) for c, t in temporary.items()])
    order = mix(df, weights, source_col, id_col, block)
    order = order.select(F.col("doc_id").alias("_id"), "slot", "place")
    # Repeated ids would multiply in a join: each copy meets one place.
    number = Window.partitionBy("_id")
    order = order.withColumn("_n", F.row_number().over(number.orderBy("slot", "place")))
    key = temporary[id_col]
    rest = [_hashable(plain, t) for t in temporary.values() if t != key]
    copies = Window.partitionBy(key).orderBy(F.xxhash64(*rest) if rest else F.lit(0))
    plain = plain.withColumn("_n", F.row_number().over(copies))
    joined = plain.join(order, F.col(key).eqNullSafe(F.col("_id")) & (plain["_n"] == order["_n"]))
    joined = joined.repartitionByRange("slot", "place").sortWithinPartitions("slot", "place")
    return joined.select(*[F.col(t).alias(c) for c, t in temporary.items()])


def _hashable(df: DataFrame, name: str) -> Column:
    """The column, or its JSON if it holds maps or variants, which Spark neither sorts nor hashes."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(name)) if "map<" in kind or "variant" in kind else F.col(name)
