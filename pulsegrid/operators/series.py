"""Ordered operations over one or many series: fills, rolling windows, differences.

A window over a whole series runs in one task, which a long or hot series would
overload. Series are therefore cut into segments of a fixed number of steps. What
an operation needs from outside its segment is carried over explicitly: fills take
the last known values of earlier segments from a small per-segment table, itself read
in groups of segments, and rolling windows copy the few rows before each segment into it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


FAN = 1_024


@dataclass(frozen=True)
class Axis:
    """How the rows of a table form series.

    ``order`` is a timestamp in units of ``step`` seconds, or an integer. Rolling windows
    and differences count rows. They number the rows first, unless ``dense`` promises that
    every series has each position from its first to its last, as resampled tables do.
    What is carried between segments looks at ``fan`` of them in one task.
    """

    order: str = "timestamp"
    keys: tuple[str, ...] = ()
    step: int = 3600
    segment: int = 65_536
    dense: bool = False
    fan: int = FAN

    def position(self, df: DataFrame) -> Column:
        order = F.col(self.order)
        if isinstance(df.schema[self.order].dataType, T.IntegralType):
            return order.cast("bigint")
        # Calendar fields rather than a cast to epoch time, which would bring in
        # the session's time zone and its daylight-saving jumps.
        days = F.unix_date(order.cast("date")).cast("bigint")
        within = F.hour(order) * 3600 + F.minute(order) * 60 + F.second(order)
        return F.floor((days * 86_400 + within) / F.lit(self.step))

    @property
    def series(self) -> list[str]:
        """Columns that tell series apart, none of them NULL."""
        return [*(f"_key{i}" for i in range(len(self.keys))), "_nulls"] if self.keys else []

    def tag(self, df: DataFrame) -> DataFrame:
        """Add the ``series`` columns, ``_pos`` and ``_seg``.

        Rows with a NULL key form a series too. Such a key is replaced by a default
        and marked in ``_nulls``, so that plain equality joins find it.
        """
        added = {"_pos": self.position(df)}
        for i, key in enumerate(self.keys):
            added[f"_key{i}"] = F.coalesce(F.col(key), _default(df.schema[key].dataType))
        if self.keys:
            flags = [F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(self.keys)]
            added["_nulls"] = sum(flags[1:], flags[0])
        tagged = df.withColumns(added).drop(*self.keys)
        return tagged.withColumn("_seg", F.floor(F.col("_pos") / F.lit(self.segment)))

    def restore(self, columns: Sequence[str]) -> list[Column]:
        """The named columns of a tagged table, keys as they were.

        Tagged tables hold each key once, so all that is derived from one needs the
        same columns of it and can share its shuffle.
        """
        keys = {
            k: F.when(F.col("_nulls").bitwiseAND(1 << i) == 0, F.col(f"_key{i}"))
            for i, k in enumerate(self.keys)
        }
        return [keys[c].alias(c) if c in keys else F.col(c) for c in columns]


def _default(data_type: T.DataType) -> Column:
    calendar = isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return F.lit("1970-01-01" if calendar else "0").cast(data_type)


def segment_groups(ends: DataFrame, series: Sequence[str], segment: str, fan: int = FAN) -> DataFrame:
    """One row per segment, dealt out by groups of ``fan`` neighbouring segments (``_group``).

    What is carried between segments is found in a group first, and between groups then, so
    that no task sees all segments of a long series. Both steps read this one shuffle.
    """
    group = F.floor(F.col(segment) / F.lit(fan))
    return ends.withColumn("_group", group).repartition(*series, "_group")


def _carried(ends: DataFrame, axis: Axis, segment: str, columns: Sequence[str], forward: bool) -> DataFrame:
    """Per segment the nearest known value of each column in the segments before it (behind it)."""
    rows = segment_groups(ends, axis.series, segment, axis.fan)
    nearest = F.max_by if forward else F.min_by

    def before(by: Sequence[str], order: str) -> WindowSpec:
        directed = F.col(order).asc() if forward else F.col(order).desc()
        return Window.partitionBy(*by).orderBy(directed).rowsBetween(Window.unboundedPreceding, -1)

    tops = rows.groupBy(*axis.series, "_group").agg(
        *[nearest(c, F.when(F.col(c).isNotNull(), F.col(segment))).alias(c) for c in columns]
    )
    between = before(axis.series, "_group")
    tops = tops.select(
        *axis.series, "_group", *[F.last(c, ignorenulls=True).over(between).alias(f"_top_{c}") for c in columns]
    )
    within = before([*axis.series, "_group"], segment)
    local = rows.select(
        *axis.series, "_group", segment,
        *[F.last(c, ignorenulls=True).over(within).alias(f"_near_{c}") for c in columns],
    )
    return local.join(tops, [*axis.series, "_group"], "left").select(
        *axis.series, segment,
        *[F.coalesce(f"_near_{c}", f"_top_{c}").alias(f"_carried_{c}") for c in columns],
    )


def _fill_rows(
    rows: DataFrame,
    columns: Sequence[str],
    axis: Axis,
    segment: str,
    forward: bool,
    long: DataFrame | None = None,
) -> DataFrame:
    """Fill tagged rows that lie together by series and segment, without moving them again.

    ``long`` has the same rows, but may lack those of series with one segment only.
    """
    nearest = F.max_by if forward else F.min_by
    known = {c: F.when(F.col(c).isNotNull(), F.col(axis.order)) for c in columns}
    ends = (rows if long is None else long).groupBy(*axis.series, segment)
    ends = ends.agg(*[nearest(c, known[c]).alias(c) for c in columns])
    carried = _carried(ends, axis, segment, columns, forward)
    # Backward fill looks at rows in descending order: a frame up to
    # unboundedFollowing would be evaluated anew for each row.
    directed = F.col(axis.order).asc() if forward else F.col(axis.order).desc()
    so_far = (
        Window.partitionBy(*axis.series, segment)
        .orderBy(directed)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    # Joined after the window, whose sort serves the join too.
    near = {f"_last_{c}": F.last(c, ignorenulls=True).over(so_far) for c in columns}
    joined = rows.withColumns(near).join(carried, [*axis.series, segment], "left")
    return joined.withColumns({c: F.coalesce(f"_last_{c}", f"_carried_{c}") for c in columns})


def _fill(df: DataFrame, columns: Sequence[str] | None, axis: Axis, forward: bool) -> DataFrame:
    columns = list(columns or [c for c in df.columns if c not in (axis.order, *axis.keys)])
    # Shuffled once, up front: the per-segment table and the fill then share the
    # shuffled rows, so whatever computed ``df`` does not run twice.
    rows = axis.tag(df).repartition(*axis.series, "_seg")
    return _fill_rows(rows, columns, axis, "_seg", forward).select(*axis.restore(df.columns))


def ffill(df: DataFrame, columns: Sequence[str] | None = None, axis: Axis = Axis()) -> DataFrame:
    """Replace missing values by the last known one; leading gaps stay missing."""
    return _fill(df, columns, axis, forward=True)


def bfill(df: DataFrame, columns: Sequence[str] | None = None, axis: Axis = Axis()) -> DataFrame:
    """Replace missing values by the next known one; trailing gaps stay missing."""
    return _fill(df, columns, axis, forward=False)


def with_ordinal(df: DataFrame, axis: Axis, name: str = "ordinal") -> DataFrame:
    """Number the rows of each series 0, 1, 2, ... in order, segment by segment."""
    rows = axis.tag(df)
    counts = rows.groupBy(*axis.series, "_seg").agg(F.count("*").alias("_n"))
    counts = segment_groups(counts, axis.series, "_seg", axis.fan)

    def before(total: str, by: Sequence[str], order: str) -> Column:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(earlier), F.lit(0))

    tops = counts.groupBy(*axis.series, "_group").agg(F.sum("_n").alias("_n"))
    tops = tops.select(*axis.series, "_group", before("_n", axis.series, "_group").alias("_base"))
    local = counts.select(
        *axis.series, "_group", "_seg", before("_n", [*axis.series, "_group"], "_seg").alias("_near")
    )
    offsets = local.join(tops, [*axis.series, "_group"])
    offsets = offsets.select(*axis.series, "_seg", (F.col("_base") + F.col("_near")).alias("_offset"))
    here = F.row_number().over(Window.partitionBy(*axis.series, "_seg").orderBy(axis.order))
    numbered = rows.join(offsets, [*axis.series, "_seg"])
    return numbered.withColumn(name, F.col("_offset") + here - 1).select(
        *axis.restore([*df.columns, name])
    )


def _homed(df: DataFrame, axis: Axis, back: int) -> tuple[DataFrame, Axis]:
    """Tagged rows, those that the next segment looks back at twice; also the axis of the tags.

    ``_home`` is the segment a row is for, its own or the next one.
    """
    if back > axis.segment:
        raise ValueError(f"segments of {axis.segment} rows are shorter than {back} rows back")
    if not axis.dense:
        df = with_ordinal(df, axis, "_ordinal")
        axis = replace(axis, order="_ordinal", dense=True)
    rows = axis.tag(df)
    place = F.pmod(F.col("_pos"), F.lit(axis.segment))
    homes = F.when(
        place >= axis.segment - back, F.array(F.col("_seg"), F.col("_seg") + 1)
    ).otherwise(F.array("_seg"))
    return rows.withColumn("_home", F.explode(homes)), axis


def _windowed(
    rows: DataFrame, axis: Axis, build: Callable[[WindowSpec], Mapping[str, Column]]
) -> tuple[DataFrame, list[str]]:
    """Window expressions of homed rows, which then lie together by series and segment; also their names."""
    window = Window.partitionBy(*axis.series, "_home").orderBy(axis.order)
    added = dict(build(window))
    # Filtered after the windows: copies serve as neighbours only.
    return rows.withColumns(added).filter("_seg = _home"), list(added)


def over_rows(
    df: DataFrame,
    axis: Axis,
    back: int,
    build: Callable[[WindowSpec], Mapping[str, Column]],
) -> DataFrame:
    """Add window expressions that look at no more than ``back`` earlier rows."""
    homed, axis = _homed(df, axis, back)
    rows, added = _windowed(homed, axis, build)
    return rows.select(*axis.restore([*df.columns, *[n for n in added if n not in df.columns]]))


def over_rows_filled(
    df: DataFrame,
    axis: Axis,
    back: int,
    build: Callable[[WindowSpec], Mapping[str, Column]],
    extend: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """``over_rows``, more columns of each row alone, and a backward fill, with one shuffle of rows.

    The fill finds the rows of a segment where the windows left them; what it takes from later
    segments is read from that shuffle as well. For that, windows run over series of several
    segments only; where there are none, what the fill carries falls away at run time.
    """
    homed, tagged = _homed(df, axis, back)
    rows, added = _windowed(homed, tagged, build)
    wide, long = extend(rows), None
    if back:
        # Neighbouring segments have copies of rows before them, or a last place that is taken. Plain
        # columns go into the window: an expression would be added to the rows before their shuffle.
        group = Window.partitionBy(*tagged.series, "_home").orderBy(tagged.order)
        group = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        ends = homed.withColumns({"_first": F.min("_seg").over(group), "_last": F.max(tagged.order).over(group)})
        last = F.pmod(replace(tagged, order="_last").position(ends), F.lit(axis.segment))
        several = ends.filter((F.col("_first") < F.col("_home")) | (last == axis.segment - 1))
        several = several.drop("_first", "_last")
        long = extend(_windowed(several, tagged, build)[0])
    columns = [*df.columns, *[n for n in added if n not in df.columns]]
    columns += [c for c in wide.columns if c not in rows.columns]
    filled = [c for c in columns if c not in (axis.order, *axis.keys)]
    rows = _fill_rows(wide, filled, tagged, "_home", forward=False, long=long)
    return rows.select(*tagged.restore(columns))


Names = str | Sequence[str]


def _named(column: Names, out: Names) -> list[tuple[str, str]]:
    one = isinstance(column, str)
    return [(column, out)] if one else list(zip(column, out, strict=True))


def rolling_mean(
    df: DataFrame, column: Names, out: Names, rows: int = 24, axis: Axis = Axis()
) -> DataFrame:
    """Mean of the last ``rows`` rows, this one included; missing values are skipped.

    Several columns share one shuffle.
    """
    return over_rows(
        df,
        axis,
        rows - 1,
        lambda w: {o: F.avg(c).over(w.rowsBetween(1 - rows, 0)) for c, o in _named(column, out)},
    )


def rolling_std(
    df: DataFrame, column: str, out: str, rows: int = 24, axis: Axis = Axis()
) -> DataFrame:
    """Sample standard deviation over the same rows; one value alone gives NULL."""
    return over_rows(
        df,
        axis,
        rows - 1,
        lambda w: {out: F.stddev_samp(column).over(w.rowsBetween(1 - rows, 0))},
    )


def diff(df: DataFrame, column: Names, out: Names, axis: Axis = Axis()) -> DataFrame:
    """Difference from the row before; NULL if either is missing."""
    return over_rows(
        df, axis, 1, lambda w: {o: F.col(c) - F.lag(c, 1).over(w) for c, o in _named(column, out)}
    )
