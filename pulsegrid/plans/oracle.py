"""SQL twins of the catalog queries, written for an engine without this library.

Queries that fit a model on random subsamples or by an iterative solver have none.
"""

from __future__ import annotations

# Fixed values, stated here anew so that a wrong one in the library shows.
METRICS = ("temperature", "voltage", "current", "angular_velocity", "solar_power")
FEATURE_COLS = (
    *METRICS, "temp_rolling_mean", "voltage_rolling_mean", "current_rolling_mean", "power",
)
FAULTS = (
    ("temp_spike", "temperature", 35.0, 45.0),
    ("voltage_drop", "voltage", 20.0, 24.0),
    ("power_loss", "solar_power", 20.0, 60.0),
    ("spin", "angular_velocity", 0.5, 1.0),
)

TEL = """tel as (
  select event_id as seq, user_id, ts as "timestamp", value as temperature,
    cast(nullif(k, 0) as double) as voltage, value / (k + 1) as current,
    (event_id % 100) / 100e0 as angular_velocity, value * 2 + k as solar_power,
    case when event_type = 'error' then 1 else 0 end as is_anomaly
  from (select *, cast(props->>'$.k' as int) as k from events))"""

MINUTE = """minute as (
  select * replace (date_trunc('minute', "timestamp") as "timestamp") from tel)"""

DERIVED = (
    "temp_rolling_mean", "temp_rolling_std", "voltage_rolling_mean", "current_rolling_mean",
    "temp_change", "voltage_change", "power",
)


def r(expression: str, name: str | None = None) -> str:
    """Six places, cut just beside the half as in the catalog."""
    return f"floor(({expression}) * 1e6 + 0.4999e0) / 1e6 as {name or expression}"


def rs(columns) -> str:
    return ", ".join(r(c) for c in columns)


def _deduped(source: str, keys: str) -> str:
    return f"""deduped as (
  select * exclude (rn) from (
    select *, row_number() over (partition by {keys}"timestamp" order by seq) as rn
    from {source}) where rn = 1)"""


def _hourly(source: str, by_user: bool) -> str:
    key = "user_id, " if by_user else ""
    group = "group by user_id" if by_user else ""
    match = "s.user_id = m.user_id and " if by_user else ""
    out_key = "s.user_id, " if by_user else ""
    means = ", ".join(f"avg({c}) as {c}" for c in (*METRICS, "is_anomaly"))
    return f"""means as (
  select {key}date_trunc('hour', "timestamp") as h, {means}
  from {source} group by {key}h),
spine as (
  select {key}unnest(generate_series(min(h), max(h), interval 1 hour)) as h
  from means {group}),
hourly as (
  select {out_key}s.h as "timestamp", {", ".join("m." + c for c in METRICS)},
    case when m.is_anomaly > 0 then 1 else 0 end as is_anomaly
  from spine s left join means m on {match}s.h = m.h)"""


def _filled(name: str, source: str, by_user: bool, columns, forward: bool = True) -> str:
    part = "partition by user_id " if by_user else ""
    frame = "unbounded preceding and current row" if forward else (
        "current row and unbounded following"
    )
    value = "last_value" if forward else "first_value"
    key = "user_id, " if by_user else ""
    cells = ", ".join(f"{value}({c} ignore nulls) over w as {c}" for c in columns)
    return f"""{name} as (
  select {key}"timestamp", {cells} from {source}
  window w as ({part}order by "timestamp" rows between {frame}))"""


def _derived(source: str, by_user: bool) -> str:
    part = "partition by user_id " if by_user else ""
    return f"""derived as (
  select *,
    avg(temperature) over recent as temp_rolling_mean,
    stddev_samp(temperature) over recent as temp_rolling_std,
    avg(voltage) over recent as voltage_rolling_mean,
    avg(current) over recent as current_rolling_mean,
    temperature - lag(temperature) over series as temp_change,
    voltage - lag(voltage) over series as voltage_change,
    voltage * current as power
  from {source}
  window series as ({part}order by "timestamp"),
    recent as ({part}order by "timestamp" rows between 23 preceding and current row))"""


def _clean_steps(by_user: bool) -> list[str]:
    keys = "user_id, " if by_user else ""
    return [
        TEL,
        MINUTE,
        _deduped("minute", keys),
        _hourly("deduped", by_user),
        _filled("cleaned", "hourly", by_user, (*METRICS, "is_anomaly")),
    ]


def _feature_steps(by_user: bool) -> list[str]:
    return [
        *_clean_steps(by_user),
        _derived("cleaned", by_user),
        _filled(
            "features", "derived", by_user, (*METRICS, "is_anomaly", *DERIVED), forward=False
        ),
    ]


def _with(steps, select: str) -> str:
    return "with " + ",\n".join(steps) + "\n" + select


def _hash(seed: str, *parts: str) -> str:
    return f"md5(concat_ws(':', '{seed}', {', '.join(parts)}))"


def _uniform(seed: str, *parts: str) -> str:
    digits = f"substr({_hash(seed, *parts)}, 1, 13)"
    return f"(cast(cast('0x' || {digits} as bigint) as double) / 4503599627370496e0)"


def _faulty() -> str:
    cells = []
    kinds = {column: (i, low, high) for i, (_, column, low, high) in enumerate(FAULTS)}
    for c in METRICS:
        if c in kinds:
            i, low, high = kinds[c]
            cells.append(
                f"case when chosen and kind = {i} then {low}e0 + {high - low}e0 * size"
                f" else {c} end as {c}"
            )
        else:
            cells.append(c)
    return f"""drawn as (
  select *, floor({_uniform("42:kind", "seq")} * {len(FAULTS)}) as kind,
    {_uniform("42:size", "seq")} as size,
    row_number() over (order by {_hash("42:rows", "seq")}, seq)
      <= floor(count(*) over () * 0.05e0) as chosen
  from tel),
faulty as (
  select seq, {", ".join(cells)}, case when chosen then 1 else 0 end as is_anomaly from drawn)"""


def _describe() -> str:
    parts = [
        f"select '{c}' as \"column\", count({c}) as count, {r(f'avg({c})', 'mean')},"
        f" {r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')},"
        f" {r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')},"
        f" {r(f'quantile_cont({c}, 0.75)', 'p75')}, {r(f'max({c})', 'max')} from tel"
        for c in METRICS
    ]
    return "\nunion all ".join(parts)


def _tree_samples(source: str, key: tuple[str, ...], trees: int = 100, psi: int = 256) -> list[str]:
    """Rows of each tree. At or above half of the rows every row takes part in every tree; below,
    a Poisson number of picks per row, its cumulative chances summed here from the series itself."""
    keys = ", ".join(key)
    return [
        f"""hashed as (
  select {keys}, count(*) over () as n, {_hash("42:row", *key)} as row_hash from {source}),
params as (select any_value(n) as n, 4 * {psi + 16} / any_value(n)::double as rate from hashed),
steps as (
  select k, sum(chance) over (order by k) as upto from (
    select k, exp(k * ln(-{trees} * ln(1 - rate)) + {trees} * ln(1 - rate) - lgamma(k + 1)) as chance
    from params, (select unnest(generate_series(0, {4 * trees})) as k) where rate < 0.5)),
times as (
  select {keys}, row_hash, (select count(*) from steps where upto <= u) as times from (
    select *, {_uniform("42:times", "row_hash")} as u from hashed, params where rate < 0.5)),
picks as (
  select distinct {keys}, row_hash,
    cast(floor({_uniform("42:pick", "row_hash", "j")} * {trees}) as int) as tree
  from (select {keys}, row_hash, unnest(generate_series(1, times)) as j from times)
  union all
  select {keys}, row_hash, cast(i as int) from hashed, params, range({trees}) x(i) where rate >= 0.5),
drawn as (select tree, {keys}, {_hash("42:tree", "tree", "row_hash")} as draw from picks),
sampled as (
  select tree, {keys} from (
    select *, row_number() over (partition by tree order by draw, {keys}) as rn from drawn)
  where rn <= {psi})"""
    ]


def _forest(source: str, key: tuple[str, ...], width: int, trees: int = 100, psi: int = 256) -> list[str]:
    """The trees over the list column f of the source, level by level, as the table nodes.

    A place counts from 1 at the root; below place p lie 2p and 2p + 1.
    """
    depth = (psi - 1).bit_length()
    bounds = [f"[{', '.join(f'{end}(f[{i}])' for i in range(1, width + 1))}] as {end}s" for end in ("min", "max")]
    steps = [
        *_tree_samples(source, key, trees, psi),
        f"""at0 as materialized (
  select tree, 1 as place, f from sampled join {source} using ({", ".join(key)}))""",
    ]
    for level in range(depth + 1):
        steps.append(
            f"""parts{level} as (
  select tree, place, count(*) as n, {", ".join(bounds)} from at{level} group by tree, place),
open{level} as (
  select *, list_filter(range(1, {width + 1}), lambda i: maxs[i] > mins[i] and n > 1 and {level} < {depth}) as o
  from parts{level}),
split{level} as materialized (
  select tree, place, n::int as n, {level} as depth,
    case when len(o) > 0 then c end as c, mins[c] + cut * (maxs[c] - mins[c]) as threshold
  from (select *, o[1 + floor({_uniform("42:feature", "tree", "place")} * len(o))::int] as c,
    {_uniform("42:cut", "tree", "place")} as cut from open{level}))"""
        )
        if level < depth:
            steps.append(
                f"""at{level + 1} as materialized (
  select tree, 2 * place + (f[c] > threshold)::int as place, f
  from at{level} join split{level} using (tree, place) where c is not null)"""
            )
    split = " union all ".join(f"select * from split{level}" for level in range(depth + 1))
    return [*steps, f"nodes as materialized ({split})"]


EULER = "0.5772156649015329e0"


def _average_path(n: str) -> str:
    return (
        f"(case when {n} > 2 then 2 * (ln({n} - 1e0) + {EULER}) - 2 * ({n} - 1e0) / {n}"
        f" when {n} = 2 then 1e0 else 0e0 end)"
    )


def _walked(source: str, key: tuple[str, ...], trees: int = 100, psi: int = 256) -> list[str]:
    """Every row down every tree: the table walked with its score."""
    depth = (psi - 1).bit_length()
    keys = ", ".join(key)
    steps = [
        f"""ways as materialized (
  select tree, place, c, threshold, c is null as leaf, depth + {_average_path("n")} as length from nodes),
walk0 as (select {keys}, f, i::int as tree, 1 as place from {source}, range({trees}) t(i))"""
    ]
    for level in range(depth):
        steps.append(
            f"""walk{level + 1} as (
  select {keys}, f, tree, case when leaf then place when f[c] > threshold then 2 * place + 1 else 2 * place end as place
  from walk{level} join ways using (tree, place))"""
        )
    return [
        *steps,
        f"""walked as (
  select {keys}, -pow(2e0, -(sum(length) / {trees}) / {_average_path(f"{psi}e0")}) as anomaly_score
  from walk{depth} join ways using (tree, place) group by all)""",
    ]


def _listed(columns) -> str:
    return "[" + ", ".join(f"floor({c} * 1e6 + 0.4999e0) / 1e6" for c in columns) + "] as f"


NULLABLE = ("timestamp", *METRICS, "is_anomaly")


def _null_counts() -> str:
    parts = [
        f"select '{c}' as \"column\", count(*) - count(\"{c}\") as n_missing from tel"
        for c in NULLABLE
    ]
    total = " + ".join(f'count(*) - count("{c}")' for c in NULLABLE)
    return "\nunion all ".join([*parts, f"select '(total)', {total} from tel"])


def _ranges() -> str:
    return "\nunion all ".join(
        f"select '{c}' as \"column\", {lo}e0 as lo, {hi}e0 as hi, {r(f'min({c})', 'min')},"
        f" {r(f'max({c})', 'max')}, min({c}) >= {lo}e0 and max({c}) <= {hi}e0 as ok,"
        f" count(*) filter ({c} < {lo}e0 or {c} > {hi}e0) as n_outside from tel"
        for c, lo, hi in (("temperature", "0.0", "250.0"), ("voltage", "0.0", "99.0"))
    )


SORTED = """select not exists (
  select 1 from (select "timestamp" as ts, lag("timestamp") over (order by {order}) as before
    from tel) where ts is null or ts < before) as is_sorted"""

SPREAD = """spread as (
  select avg(temperature) as tm, stddev_samp(temperature) as ts,
    avg(voltage) as vm, stddev_samp(voltage) as vs from tel)"""
OUTLYING = """outlying as (
  select tel.*, coalesce(abs(temperature - tm) > 3 * ts, false) as t_out,
    coalesce(abs(voltage - vm) > 3 * vs, false) as v_out, tm, ts, vm, vs
  from tel, spread)"""
REPORT = f"""report as (
  select count(*) as total_samples, {", ".join(f"avg({c}) as avg_{c}" for c in METRICS)},
    count(*) filter (t_out) as temp_anomalies, count(*) filter (v_out) as voltage_anomalies
  from outlying),
rated as (
  select *, temp_anomalies * 100e0 / total_samples as temp_anomaly_pct,
    voltage_anomalies * 100e0 / total_samples as voltage_anomaly_pct,
    (temp_anomalies + voltage_anomalies) * 100e0 / total_samples as anomaly_rate_pct
  from report),
graded as (
  select *, case when anomaly_rate_pct < 1 then 'NOMINAL'
    when anomaly_rate_pct < 5 then 'CAUTION' else 'ALERT' end as status from rated)"""
SIMPLE = [TEL, SPREAD, OUTLYING, REPORT]


def _report_lines() -> str:
    """Every field of the report on a line of its own."""
    fields = [("total_samples", "{:,}"), *((f"avg_{c}", "{:.4f}") for c in METRICS)]
    fields += [("temp_anomalies", "{:,}"), ("voltage_anomalies", "{:,}")]
    fields += [(f"{c}_pct", "{:.2f}") for c in ("temp_anomaly", "voltage_anomaly", "anomaly_rate")]
    lines = [f"'{name.replace('_', ' ')}: ' || format('{form}', {name})" for name, form in fields]
    return " || chr(10) || ".join([*lines, "'status: ' || status"])


def _predicted(source: str) -> str:
    return f"""scored as (select *, -abs(temperature - 50) / 50 as anomaly_score from {source}),
predicted as (
  select *, case when anomaly_score < (select quantile_cont(anomaly_score, 0.05) from scored)
    then 1 else 0 end as is_predicted_anomaly from scored)"""


DETECTION = """count(*) filter (is_anomaly > 0) as actual_anomalies,
    count(*) filter (is_anomaly > 0 and is_predicted_anomaly = 1) as true_positives,
    count(*) filter (not is_anomaly > 0 and is_predicted_anomaly = 1) as false_positives,
    count(*) filter (is_anomaly > 0 and is_predicted_anomaly = 0) as false_negatives"""
QUALITY = """coalesce(true_positives * 1e0 / nullif(true_positives + false_positives, 0), 0e0)
    as precision,
  coalesce(true_positives * 1e0 / nullif(true_positives + false_negatives, 0), 0e0) as recall"""

CLEAN = (
    "regexp_replace(regexp_replace(lower({0}), '<[^\\n]*?>', '', 'g'),"
    " '[^a-zA-Z\\s\\x0b\\x1c-\\x1f\\x85\\p{{Z}}]', '', 'g')"
)
DOCS = f"docs as (select doc_id, {CLEAN.format('text')} as review from documents)"
WORDS = (
    "words as (select doc_id, regexp_extract_all(lower(review), '\\b\\w\\w+\\b') as w from docs)"
)
GRAMS = """grams as (
  select doc_id, w || [w[i] || ' ' || w[i + 1] for i in range(1, len(w))] as g from words)"""
VOCAB = """uses as (select doc_id, unnest(g) as term from grams),
vocab as (
  select term, count(*) as tf, count(distinct doc_id) as df from uses
  group by term order by tf desc, term limit 5000)"""
REVIEWS = """reviews as (
  select d.doc_id, d.text as review,
    case when l.quality = 1 then 'positive' else 'negative' end as sentiment
  from documents d join labels l using (doc_id))"""
TEST_FLAG = f"""flagged as (
  select *, row_number() over (order by {_hash("42", "doc_id")}, doc_id)
    <= ceil(count(*) over () * 0.2e0) as is_test from reviews)"""
CELLS = """cells as (
  select count(*) filter (a = 0 and p = 0) as n00, count(*) filter (a = 0 and p = 1) as n01,
    count(*) filter (a = 1 and p = 0) as n10, count(*) filter (a = 1 and p = 1) as n11
  from (select quality as a, 1 - toxic as p from labels))"""


def _over(a: str, b: str) -> str:
    return f"coalesce(({a}) * 1e0 / nullif({b}, 0), 0e0)"


CLASSES = f"""classes as (
  select 'Negative' as class, {_over("n00", "n00 + n10")} as precision,
    {_over("n00", "n00 + n01")} as recall, {_over("2 * n00", "2 * n00 + n10 + n01")} as f1_score,
    n00 + n01 as support from cells
  union all
  select 'Positive', {_over("n11", "n01 + n11")}, {_over("n11", "n10 + n11")},
    {_over("2 * n11", "2 * n11 + n01 + n10")}, n10 + n11 from cells)"""
SCORES = ("precision", "recall", "f1_score")
ACCURACY = _over("n00 + n11", "n00 + n01 + n10 + n11")

ALL = f'"timestamp", {rs(METRICS)}, is_anomaly'
FEATURES = f"{ALL}, {rs(DERIVED)}"

ORACLE_SQL: dict[str, str] = {
    "ingest_profile": _with(
        [TEL],
        """select count(*) as rows, cast(7 as bigint) as columns,
  min("timestamp") as first_timestamp, max("timestamp") as last_timestamp,
  count(*) * 7 as cells from tel""",
    ),
    "label_breakdown": _with(
        [TEL],
        f"""select count(*) filter (is_anomaly = 0) as normal,
  count(*) filter (is_anomaly = 1) as anomalous,
  {r("count(*) filter (is_anomaly = 1) * 100e0 / count(*)", "anomalous_pct")} from tel""",
    ),
    "describe": _with([TEL], _describe()),
    "preview": _with([TEL], f"select seq, {ALL} from tel order by seq limit 5"),
    "exact_sample": _with(
        [TEL],
        f"""select seq, user_id, {r("temperature")} from (
  select *, row_number() over (order by {_hash("42", "seq")}, seq) as rn,
    floor(count(*) over () * 0.05e0) as k from tel) where rn <= k""",
    ),
    "inject_faults": _with(
        [TEL, _faulty()], f"select seq, {rs(METRICS)}, is_anomaly from faulty"
    ),
    "null_counts": _with([TEL], _null_counts()),
    "range_check": _with([TEL], _ranges()),
    "is_sorted": _with(
        [TEL],
        f"""select 'file' as sequence, is_sorted from ({SORTED.format(order="seq")})
union all
select 'strided', is_sorted from ({SORTED.format(order="seq % 97 * 1000000000 + seq")})""",
    ),
    "validate": _with(
        [
            TEL,
            f"nulls as ({_null_counts()} union all"
            " select 'seq', count(*) - count(seq) from tel)",
            f"ranges as ({_ranges()})",
            f"ordered as ({SORTED.format(order='seq')})",
        ],
        """select 'missing_values' as "check", "column", n_missing = 0 as ok, n_missing as n,
  cast(null as double) as min, cast(null as double) as max from nulls
union all select 'range', "column", ok, n_outside, min, max from ranges
union all select 'sorted', 'timestamp', is_sorted, null, null, null from ordered""",
    ),
    "parse_ts": _with(
        [TEL],
        """select seq, strptime(strftime("timestamp", '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')
  as "timestamp" from tel""",
    ),
    "dedupe_first": _with(
        [TEL, MINUTE, _deduped("minute", "")], f"select seq, user_id, {ALL} from deduped"
    ),
    "dedupe_first_by_user": _with(
        [TEL, MINUTE, _deduped("minute", "user_id, ")], f"select seq, user_id, {ALL} from deduped"
    ),
    "resample_hourly": _with([TEL, _hourly("tel", False)], f"select {ALL} from hourly"),
    "resample_hourly_by_user": _with(
        [TEL, _hourly("tel", True)], f"select user_id, {ALL} from hourly"
    ),
    "resample_summary": _with(
        [TEL, MINUTE, _deduped("minute", ""), _hourly("deduped", False)],
        f"""select (select count(*) from tel) as rows_in,
  (select count(*) from tel) - (select count(*) from deduped) as duplicates_removed,
  count(*) as rows_out,
  {r("(1 - count(*) * 1e0 / (select count(*) from deduped)) * 100", "reduction_pct")},
  min("timestamp") as first_timestamp, max("timestamp") as last_timestamp from hourly""",
    ),
    "ffill": _with(
        [TEL, _hourly("tel", True), _filled("filled", "hourly", True, (*METRICS, "is_anomaly"))],
        f"select user_id, {ALL} from filled",
    ),
    "bfill": _with(
        [
            TEL,
            _hourly("tel", True),
            _filled("filled", "hourly", True, (*METRICS, "is_anomaly"), forward=False),
        ],
        f"select user_id, {ALL} from filled",
    ),
    "clean_telemetry": _with(_clean_steps(False), f"select {ALL} from cleaned"),
    "clean_telemetry_by_user": _with(_clean_steps(True), f"select user_id, {ALL} from cleaned"),
    "rolling_mean": _with(
        [TEL, _hourly("tel", True), _derived("hourly", True)],
        f"""select user_id, "timestamp",
  {rs(("temp_rolling_mean", "voltage_rolling_mean", "current_rolling_mean"))} from derived""",
    ),
    "rolling_readings": _with(
        [TEL],
        f"""select user_id, seq, {r("avg(temperature) over w", "temp_mean")},
  {r("avg(current) over w", "current_mean")},
  {r("temperature - lag(temperature) over (partition by user_id order by seq)", "temp_change")}
from tel window w as (partition by user_id order by seq rows between 4 preceding and current row)""",
    ),
    "rolling_std": _with(
        [TEL, _hourly("tel", True), _derived("hourly", True)],
        f'select user_id, "timestamp", {r("temp_rolling_std")} from derived',
    ),
    "diff": _with(
        [TEL, _hourly("tel", True), _derived("hourly", True)],
        f'select user_id, "timestamp", {rs(("temp_change", "voltage_change"))} from derived',
    ),
    "power": _with([TEL], f"select seq, {r('voltage * current', 'power')} from tel"),
    "engineer_features": _with(_feature_steps(False), f"select {FEATURES} from features"),
    "engineer_features_by_user": _with(
        _feature_steps(True), f"select user_id, {FEATURES} from features"
    ),
    "model_features": _with(
        _feature_steps(False), f'select "timestamp", {rs(FEATURE_COLS)} from features'
    ),
    "system_averages": _with(
        [TEL],
        f"""select count(*) as total_samples,
  {", ".join(r(f"avg({c})", f"avg_{c}") for c in METRICS)} from tel""",
    ),
    "sigma_outliers": _with(
        [TEL, SPREAD, OUTLYING],
        "\nunion all ".join(
            f"""select '{name}' as metric, {r(f"any_value({mean})", "mean")},
  {r(f"any_value({std})", "std")}, count(*) filter ({flag}) as n_outliers,
  {r(f"count(*) filter ({flag}) * 100e0 / count(*)", "outlier_pct")} from outlying"""
            for name, mean, std, flag in (
                ("temperature", "tm", "ts", "t_out"),
                ("voltage", "vm", "vs", "v_out"),
            )
        ),
    ),
    "sigma_filter": _with(
        [TEL, SPREAD, OUTLYING],
        f'select seq, "timestamp", {r("temperature")} from outlying where t_out',
    ),
    "flag_outliers": _with(
        [TEL, SPREAD, OUTLYING],
        f"""select seq, {rs(("temperature", "voltage"))}, t_out as temperature_outlier,
  v_out as voltage_outlier from outlying""",
    ),
    "overall_rate": _with(SIMPLE, f"select {r('anomaly_rate_pct')}, status from graded"),
    "simple_report": _with(
        SIMPLE,
        f"""select total_samples, {rs("avg_" + c for c in METRICS)}, temp_anomalies,
  voltage_anomalies,
  {rs(("temp_anomaly_pct", "voltage_anomaly_pct", "anomaly_rate_pct"))}, status from graded""",
    ),
    "contamination_threshold": _with(
        [TEL, _predicted("tel")],
        f"select {r('quantile_cont(anomaly_score, 0.05)', 'threshold')} from scored",
    ),
    "predict_flags": _with(
        [TEL, _predicted("tel")],
        f"""select seq, {r("anomaly_score")},
  case when is_predicted_anomaly = 1 then -1 else 1 end as anomaly_prediction,
  is_predicted_anomaly from predicted""",
    ),
    "prediction_counts": _with(
        [TEL, _predicted("tel")],
        f"""select count(*) as total_samples,
  count(*) filter (is_predicted_anomaly = 1) as predicted_anomalies,
  count(*) filter (is_predicted_anomaly = 0) as predicted_normal,
  {r("count(*) filter (is_predicted_anomaly = 1) * 100e0 / count(*)", "anomaly_pct")},
  {r("count(*) filter (is_predicted_anomaly = 0) * 100e0 / count(*)", "normal_pct")}
from predicted""",
    ),
    "top_anomalies": _with(
        [TEL, _predicted("tel")],
        f"""select seq, "timestamp", {rs(("temperature", "voltage"))}, {r("score", "anomaly_score")}
from (select *, anomaly_score as score from scored order by anomaly_score, seq limit 5)""",
    ),
    "detection_metrics": _with(
        [TEL, _predicted("tel"), f"counted as (select {DETECTION} from predicted)"],
        f"""select * replace ({rs(("precision", "recall"))})
from (select *, {QUALITY} from counted)""",
    ),
    "ml_report": _with(
        [
            *_feature_steps(True),
            _predicted("features"),
            f"""counted as (
  select count(*) as total_samples, min("timestamp") as first_timestamp,
    max("timestamp") as last_timestamp, {", ".join(f"avg({c}) as avg_{c}" for c in METRICS)},
    sum(is_predicted_anomaly)::bigint as predicted_anomalies,
    sum(1 - is_predicted_anomaly)::bigint as predicted_normal, {DETECTION} from predicted)""",
            f"""graded as (
  select *, predicted_anomalies * 100e0 / total_samples as anomaly_rate_pct, {QUALITY}
  from counted)""",
        ],
        f"""select * replace (
  {rs(("anomaly_rate_pct", "precision", "recall", *("avg_" + c for c in METRICS)))}),
  case when anomaly_rate_pct < 1 then 'NOMINAL' when anomaly_rate_pct < 5 then 'CAUTION'
    else 'ALERT' end as status from graded""",
    ),
    "tree_samples": _with(
        [TEL, *_tree_samples("tel", ("seq",))],
        """select tree, seq from sampled""",
    ),
    "iforest_trees": _with(
        [
            *_feature_steps(True),
            f"""usable as (
  select count(*) as n from features
  where {" and ".join(c + " is not null" for c in FEATURE_COLS)})""",
        ],
        """select cast(i as int) as tree, least(256, n) as rows_drawn,
  least(256, n) as rows_in_leaves, true as depth_ok from usable, range(100) t(i)""",
    ),
    "clean_text": f"select doc_id, {CLEAN.format('text')} as cleaned_review from documents",
    "strip_html": (
        "select page_id, regexp_replace(html, '<[^\\n]*?>', '', 'g') as text from pages"
    ),
    "clean_html": f"select page_id, {CLEAN.format('html')} as text from pages",
    "map_label": """select doc_id, lang,
  case lang when 'en' then 1 when 'de' then 0 end as label from documents""",
    "exact_split": _with(
        [REVIEWS, TEST_FLAG],
        """select doc_id, sentiment, case when is_test then 'test' else 'train' end as part
from flagged""",
    ),
    "tokens": _with(
        [DOCS, WORDS], "select doc_id, array_to_string(w, ' ') as tokens from words"
    ),
    "ngrams": _with(
        [DOCS, WORDS, GRAMS], "select doc_id, array_to_string(g, '|') as terms from grams"
    ),
    "vocabulary": _with([DOCS, WORDS, GRAMS, VOCAB], "select term, tf, df from vocab"),
    "tfidf": _with(
        [
            DOCS,
            WORDS,
            GRAMS,
            VOCAB,
            """weighted as (
  select u.doc_id, u.term, count(*) as tf,
    count(*) * (ln((1e0 + (select count(*) from docs)) / (1 + any_value(v.df))) + 1) as x
  from uses u join vocab v using (term) group by u.doc_id, u.term)""",
        ],
        f"""select doc_id, term, tf,
  {r("x / sqrt(sum(x * x) over (partition by doc_id))", "weight")} from weighted""",
    ),
    "holdout_table": _with(
        [REVIEWS, TEST_FLAG],
        f"""select doc_id, {CLEAN.format("review")} as review,
  case when sentiment = 'positive' then 1 else 0 end as label from flagged where is_test""",
    ),
    "sentiment_stream": "select doc_id, true as same_as_batch from documents",
    "sentiment_columns": f"""select doc_id,
  case when p > 0.5 then 'positive' else 'negative' end as sentiment,
  {r("case when p > 0.5 then p else 1 - p end", "confidence")}
from (select doc_id, (doc_id % 100) / 100e0 as p from labels)""",
    "binary_metrics": _with(
        [CELLS, CLASSES],
        f"""select {r(ACCURACY, "accuracy")},
  {", ".join(f"(select {r(c)} from classes where class = 'Positive') as {c}" for c in SCORES)}
from cells""",
    ),
    "confusion_matrix": _with(
        [CELLS],
        """select 0 as actual, n00 as predicted_0, n01 as predicted_1 from cells
union all select 1, n10, n11 from cells""",
    ),
    "classification_report": _with(
        [CELLS, CLASSES],
        f"""select class, {rs(SCORES)}, support from classes
union all select 'accuracy', null, null, {r(ACCURACY, "f1_score")}, n00 + n01 + n10 + n11
from cells
union all select 'macro avg', {", ".join(r(f"avg({c})", c) for c in SCORES)},
  sum(support)::bigint from classes
union all select 'weighted avg',
  {", ".join(r(f"sum({c} * support) / sum(support)", c) for c in SCORES)},
  sum(support)::bigint from classes""",
    ),
    "csv_round_trip": _with([TEL], f"select {ALL} from tel"),
    "parquet_round_trip": _with([TEL], f"select {ALL} from tel"),
    "report_text": _with(SIMPLE, f"select {_report_lines()} as report from graded"),
}

# Untied scores: the rows strictly below an interpolated 5 % quantile of n are ceil(0.05 (n - 1)).
for _name, _select in {
    "iforest_flags": """select n as rows, true as in_range,
  cast(ceil(0.05e0 * (n - 1)) as bigint) as flagged from usable""",
    "iforest_reload": "select n as rows, cast(0 as bigint) as changed from usable",
}.items():
    _complete = " and ".join(c + " is not null" for c in FEATURE_COLS)
    ORACLE_SQL[_name] = _with(
        [
            *_feature_steps(True),
            f"usable as (select count(*) as n from features where {_complete})",
        ],
        _select,
    )

_KEY = ("user_id", '"timestamp"')
_GROWN = [
    *_feature_steps(True),
    f"""listed as materialized (select user_id, "timestamp", {_listed(FEATURE_COLS)} from features)""",
    *_forest("listed", _KEY, len(FEATURE_COLS)),
]
# Left parts come first: the order of the places read as strings of bits.
ORACLE_SQL["iforest_nodes"] = _with(
    [
        *_GROWN,
        """numbered as (
  select *, row_number() over (partition by tree order by bin(place)) - 1 as node from nodes)""",
    ],
    f"""select a.tree, a.node::int as node, coalesce(a.c - 1, -1)::int as feature,
  {r("case when a.c is null then 0e0 else a.threshold end", "threshold")},
  coalesce(l.node, -1)::int as "left", coalesce(r.node, -1)::int as "right", a.n, a.depth
from numbered a left join numbered l on l.tree = a.tree and l.place = 2 * a.place
  left join numbered r on r.tree = a.tree and r.place = 2 * a.place + 1""",
)
ORACLE_SQL["score_telemetry"] = _with(
    [
        *_GROWN,
        *_walked("listed", _KEY),
        f"""scored as (select user_id, "timestamp", {r("anomaly_score")} from walked),
flagged as (
  select *, (anomaly_score < (select quantile_cont(anomaly_score, 0.05) from scored))::int as is_predicted_anomaly
  from scored)""",
    ],
    """select user_id, "timestamp", 1 - 2 * is_predicted_anomaly as anomaly_prediction, anomaly_score,
  is_predicted_anomaly from flagged""",
)
ORACLE_SQL["forest_walk"] = _with(
    [
        TEL,
        f"""listed as materialized (
  select seq, {_listed(("temperature", "current", "angular_velocity", "solar_power"))} from tel)""",
        *_forest("listed", ("seq",), 4, 10, 64),
        *_walked("listed", ("seq",), 10, 64),
    ],
    f"select seq, {r('anomaly_score')} from walked",
)

def _term_rounds(rounds: int) -> list[str]:
    """Terms of the training reviews, TF-IDF of all reviews, gradient rounds with momentum from zero."""
    steps = [
        REVIEWS,
        TEST_FLAG,
        f"""docs as (
  select doc_id, is_test, (sentiment = 'positive')::int as y, {CLEAN.format("review")} as review from flagged)""",
        WORDS,
        GRAMS,
        "uses as materialized (select doc_id, unnest(g) as term from grams)",
        "trained as materialized (select doc_id, y::double as y from docs where not is_test)",
        "size as (select count(*)::double as n from trained)",
        """vocab as materialized (
  select row_number() over (order by tf desc, term) as i, term, ln((1e0 + n) / (1 + df)) + 1 as idf
  from (select term, count(*) as tf, count(distinct doc_id) as df from uses semi join trained using (doc_id)
    group by term order by tf desc, term limit 5000), size
  union all select 0, '', 1e0)""",
        """cells as materialized (
  select doc_id, i, x / sqrt(sum(x * x) over (partition by doc_id)) as w
  from (select doc_id, i, count(*) * any_value(idf) as x from uses join vocab using (term) group by doc_id, i)
  union all select doc_id, 0, 1e0 from docs)""",
        "beta0 as (select i, 0e0 as b, 0e0 as p from vocab)",
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"""miss{k} as (
  select doc_id, 1 / (1 + exp(-sum(w * p))) - any_value(y) as m
  from cells join beta{k - 1} using (i) join trained using (doc_id) group by doc_id),
slope{k} as (select i, sum(m * w) as total from miss{k} join cells using (doc_id) group by i),
moved{k} as (
  select i, b, p - 2 / (1 + 2 / n)
    * (coalesce(total, 0e0) / n + case when i > 0 then p / n else 0e0 end) as c
  from beta{k - 1} left join slope{k} using (i), size),
beta{k} as materialized (select i, c as b, c + {k - 1} / {k + 2}e0 * (c - b) as p from moved{k})"""
        )
    return [
        *steps,
        f"""judged as materialized (
  select doc_id, 1 / (1 + exp(-sum(w * b))) as p from cells join beta{rounds} using (i) group by doc_id)""",
    ]


ORACLE_SQL["sentiment_coefficients"] = _with(
    _term_rounds(5), f"select term, {r('idf')}, {r('b', 'coefficient')} from vocab join beta5 using (i)"
)
ORACLE_SQL["sentiment_predict"] = _with(
    _term_rounds(5),
    f"""select doc_id, case when p > 0.5 then 'positive' else 'negative' end as sentiment,
  {r("greatest(p, 1 - p)", "confidence")} from judged""",
)
_NAMED = [f"('{c}', {c})" for c in SCORES]
ORACLE_SQL["sentiment_scores"] = _with(
    [
        *_term_rounds(5),
        """cells2 as (
  select count(*) filter (a = 0 and p = 0) as n00, count(*) filter (a = 0 and p = 1) as n01,
    count(*) filter (a = 1 and p = 0) as n10, count(*) filter (a = 1 and p = 1) as n11
  from (select y as a, (p > 0.5)::int as p from judged join docs using (doc_id) where is_test))""",
        CLASSES.replace("from cells", "from cells2"),
        f"overall as (select {ACCURACY} as accuracy, n00 + n01 + n10 + n11 as total from cells2)",
        f"""lines as (
  select class, precision, recall, f1_score, support::double as support from classes
  union all select 'accuracy', null, null, accuracy, total from overall
  union all select 'macro avg', {", ".join(f"avg({c})" for c in SCORES)}, sum(support) from classes
  union all select 'weighted avg', {", ".join(f"sum({c} * support) / sum(support)" for c in SCORES)},
    sum(support) from classes)""",
        f"""measures as (
  select 'metrics.accuracy.' as name, accuracy as x from overall
  union all select 'metrics.' || v.m || '.', v.x from classes,
    (values {", ".join(_NAMED)}) v(m, x) where class = 'Positive'
  union all select 'report.' || v.m || '.' || class, v.x from lines,
    (values {", ".join(_NAMED)}, ('support', support)) v(m, x)
  union all select 'confusion.' || v.m, v.x from cells2, (values ('predicted_0.0', n00),
    ('predicted_1.0', n01), ('predicted_0.1', n10), ('predicted_1.1', n11)) v(m, x))""",
    ],
    f"select name, {r('x')} from measures where x is not null",
)
ORACLE_SQL["sentiment_optimum"] = _with(
    [REVIEWS, TEST_FLAG],
    "select doc_id, true as same_as_pipeline, true as at_optimum from flagged where not is_test",
)

# What the pipelines determine, whatever the fitted model is.
ORACLE_SQL["simple_health"] = f"""select report.*, checks.* from ({ORACLE_SQL["simple_report"]}) report, (
  select count(*) as checks, count(*) filter (not ok) as checks_failed,
    sum(n) filter ("check" = 'missing_values')::bigint as missing,
    sum(n) filter ("check" = 'range')::bigint as outside
  from ({ORACLE_SQL["validate"]})) checks"""
ORACLE_SQL["sentiment_evaluate"] = _with(
    [REVIEWS, TEST_FLAG],
    """select count(*) filter (sentiment = 'negative') as support_negative,
  count(*) filter (sentiment = 'positive') as support_positive, count(*) as held_out,
  true as metrics_agree, true as classes_agree, true as averages_agree, true as better_than_chance
from flagged where is_test""",
)
ORACLE_SQL["sentiment_pipeline"] = _with([REVIEWS], "select doc_id, true as sound from reviews")
ORACLE_SQL["ml_health"] = _with(
    [
        *_feature_steps(True),
        f"""counted as (
  select count(*) as total_samples, min("timestamp") as first_timestamp,
    max("timestamp") as last_timestamp, {", ".join(f"avg({c}) as avg_{c}" for c in METRICS)},
    cast(ceil(0.05e0 * (count(*) - 1)) as bigint) as predicted_anomalies,
    count(*) filter (is_anomaly > 0) as actual_anomalies from features)""",
        """graded as (
  select *, total_samples - predicted_anomalies as predicted_normal,
    predicted_anomalies * 100e0 / total_samples as anomaly_rate_pct from counted)""",
    ],
    f"""select * replace ({rs(("anomaly_rate_pct", *("avg_" + c for c in METRICS)))}),
  case when anomaly_rate_pct < 1 then 'NOMINAL' when anomaly_rate_pct < 5 then 'CAUTION'
    else 'ALERT' end as status,
  true as flags_add_up, true as labels_add_up, true as precision_agrees, true as recall_agrees
from graded""",
)
