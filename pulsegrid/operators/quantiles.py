"""Exact quantiles with linear interpolation, the same way at any table size.

A quantile is one or two order statistics. Each starts with the whole column as its bracket.
A round narrows every bracket that still holds many rows: one scan sketches new ends, a second
one counts what lies below, between and at them, and the counts decide, not the sketch. A round
leaves about one row in 2,500, so few rounds do. A last scan ranks what the brackets hold.
All columns and probabilities share the scans.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEFT_ROWS = 65_536
ACCURACY = 10_000


@dataclass
class Bracket:
    """The values in (low, high] of a column, among them the one of the wanted rank."""

    column: str
    rank: int
    size: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None
    settled: bool = False

    def holds(self, v: Column) -> Column:
        inside = v.isNotNull()
        if self.low is not None:
            inside = inside & (v > self.low)
        return inside if self.high is None else inside & (v <= self.high)

    def narrow(self, low: float, high: float, lower: int, at_low: int, between: int) -> None:
        """``lower`` values of the bracket lie below ``low``, ``between`` in (low, high]."""
        target = self.rank - self.below
        if target < lower:
            # Below the sketched end: what is left has no values from ``low`` on.
            self.high, self.size = math.nextafter(low, -math.inf), lower
        elif target < lower + at_low:
            self.value, self.settled = low, True
        elif target < lower + at_low + between:
            self.low, self.high = low, high
            self.below, self.size = self.below + lower + at_low, between
        else:
            passed = lower + at_low + between
            self.low, self.below, self.size = high, self.below + passed, self.size - passed


def quantile_columns(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    approximate: bool = False,
    left_rows: int = LEFT_ROWS,
) -> dict[str, Column]:
    """Per column an array expression with one quantile per probability.

    The expressions are aggregates over ``df``. With ``approximate`` the values
    are members of the column near the wanted rank, at a bounded rank error.
    """
    wanted = [float(p) for p in probabilities]
    if approximate:
        return {c: F.percentile_approx(c, wanted, ACCURACY).cast("array<double>") for c in columns}
    found = exact_quantiles(df, columns, wanted, left_rows)
    # any_value over a literal keeps the expression an aggregate.
    return {
        c: F.array(*[F.any_value(F.lit(v).cast("double")) for v in values])
        for c, values in found.items()
    }


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], left_rows: int = LEFT_ROWS
) -> dict[str, list[float | None]]:
    """Quantiles per column; only sketched ends, counts and answers reach the driver.

    Nulls do not count, NaN is larger than any number, and a column without values has None.
    """
    names = {c: f"v{k}" for k, c in enumerate(dict.fromkeys(columns))}
    values = df.select(*[F.col(c).cast("double").alias(v) for c, v in names.items()])
    counts = values.agg(*[F.count(v).alias(v) for v in names.values()]).first()
    places = {c: [p * (counts[v] - 1) for p in probabilities] for c, v in names.items() if counts[v]}
    ranks = {(c, r) for c, at in places.items() for p in at for r in (math.floor(p), math.ceil(p))}
    brackets = {(c, r): Bracket(names[c], r, counts[names[c]]) for c, r in sorted(ranks)}
    open_ones = list(brackets.values())
    while open_ones := [b for b in open_ones if not b.settled and b.size > left_rows]:
        _narrow(values, open_ones)
    _rank(values, [b for b in brackets.values() if not b.settled])

    def between(column: str, place: float) -> float:
        low = brackets[column, math.floor(place)].value
        high = brackets[column, math.ceil(place)].value
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {
        c: [between(c, p) for p in places[c]] if c in places else [None] * len(probabilities)
        for c in names
    }


def _narrow(values: DataFrame, brackets: list[Bracket]) -> None:
    margin = 2 / ACCURACY
    sketches, sums = [], []
    for b in brackets:
        place = (b.rank - b.below) / (b.size - 1)
        marks = [max(0.0, place - margin), min(1.0, place + margin)]
        inside = F.when(b.holds(F.col(b.column)), F.col(b.column))
        sketches.append(F.percentile_approx(inside, marks, ACCURACY))
    ends = values.agg(*[s.alias(str(k)) for k, s in enumerate(sketches)]).first()
    for b, (low, high) in zip(brackets, ends):
        v = F.col(b.column)
        for part in (v < low, v == low, (v > low) & (v <= high)):
            sums.append(F.count_if(b.holds(v) & part))
    counts = list(values.agg(*[s.alias(str(k)) for k, s in enumerate(sums)]).first())
    for k, (b, (low, high)) in enumerate(zip(brackets, ends)):
        b.narrow(low, high, *counts[3 * k : 3 * k + 3])


def _rank(values: DataFrame, brackets: list[Bracket]) -> None:
    """Rank what is left, at most ``left_rows`` rows of a bracket; equal values are merged first."""
    if not brackets:
        return
    held = [
        F.when(b.holds(F.col(b.column)), F.struct(F.lit(k).alias("k"), F.col(b.column).alias("v")))
        for k, b in enumerate(brackets)
    ]
    inside = values.select(F.inline(F.array_compact(F.array(*held))))
    upto = F.sum("count").over(Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = inside.groupBy("k", "v").count().withColumn("upto", upto)
    wanted = F.element_at(F.array(*[F.lit(b.rank - b.below) for b in brackets]), F.col("k") + 1)
    for row in ranked.filter(F.col("upto") > wanted).groupBy("k").agg(F.min("v").alias("v")).collect():
        brackets[row.k].value, brackets[row.k].settled = row.v, True
