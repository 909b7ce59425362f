"""Isolation forest (Liu, Ting, Zhou 2008) fitted and applied by Spark.

The table is read twice: once to count rows, once to draw every tree's own subsample
with one hash per row. Trees grow in parallel, one group of at most ``psi`` rows each. The fitted model has a size bound that does not depend on
the table, so scoring ships it to every executor and needs no shuffle.
"""

from __future__ import annotations

import hashlib
import json
import math
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from pulsegrid.functions.hashing import HEX_DIGITS, hash_hex, hash_uniform, least_digits
from pulsegrid.functions.text import let
from pulsegrid.operators.quantiles import quantile_columns
from pulsegrid.schemas import FEATURE_COLS

# Workers get the functions below by value, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Model parameters and the Euler-Mascheroni constant.
TREES = 100
PSI = 256
CONTAMINATION = 0.05
SEED = 42
EULER_GAMMA = 0.5772156649015329

# Expected draws per tree before ranking, as a multiple of psi + 16: with 4 * 272 expected,
# fewer than 256 is some 25 standard deviations away, and none of 4 * 17 as unlikely.
DRAW_MARGIN = 4
# From this rate on every row takes part in every tree.
FULL_RATE = 0.5
# Levels scored without looking up nodes: their 7 comparisons fit a byte.
TOP_LEVELS = 3

NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("depth", T.IntegerType()),
    ]
)


def average_path(n) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    large = np.maximum(n, 3.0)
    value = 2.0 * (np.log(large - 1.0) + EULER_GAMMA) - 2.0 * (large - 1.0) / large
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def tree_samples(
    df: DataFrame,
    key: str | Sequence[str],
    trees: int = TREES,
    psi: int = PSI,
    seed: object = SEED,
    n_rows: int | None = None,
    margin: float = DRAW_MARGIN,
) -> DataFrame:
    """min(psi, n) rows per tree, without replacement and independent of other trees.

    A tree considers each row with probability ``rate`` and keeps the ``psi`` smallest
    draws. How often a row is considered over all trees is one Poisson number, found from
    one hash; each time, a further hash names the tree. The counts per tree are then
    independent Poisson numbers, so distinct trees are independent picks. A tree is short
    only if keys repeat; a larger ``margin`` widens the rate.
    """
    key = [key] if isinstance(key, str) else list(key)
    n = df.count() if n_rows is None else n_rows
    rows = df.withColumn("_row", hash_hex(f"{seed}:row", *key))
    rate = margin * (psi + 16) / n if n else 1.0
    if rate >= FULL_RATE:
        drawn = rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    else:
        # A row is considered as often as its draw reaches a step. Draws and steps are compared as
        # text, and rows that reach none, nearly all of a large table, leave by their first hash.
        draw = F.substring(hash_hex(f"{seed}:times", "_row"), 1, HEX_DIGITS)
        steps = [least_digits(p) for p in poisson_steps(-trees * math.log1p(-rate))]
        steps = F.array(*[F.lit(p) for p in steps if p is not None])
        times = let(draw, lambda d: F.size(F.filter(steps, lambda p: p <= d)))
        turns = F.filter(F.sequence(F.lit(0), F.col("_times")), lambda j: j > 0)
        picks = F.transform(
            turns,
            lambda j: F.floor(hash_uniform(f"{seed}:pick", "_row", j) * trees).cast("int"),
        )
        drawn = rows.filter(steps[0] <= draw).withColumn("_times", times)
        drawn = drawn.withColumn("tree", F.explode(F.array_distinct(picks))).drop("_times")
    drawn = drawn.withColumn("_draw", hash_hex(f"{seed}:tree", "tree", "_row"))
    order = Window.partitionBy("tree").orderBy("_draw", *key)
    ranked = drawn.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= psi).drop("_rank", "_row", "_draw")


def poisson_steps(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson number, up to where nothing is left."""
    chance = total = math.exp(-mean)
    steps = [total]
    while len(steps) <= mean or chance > 1e-18:
        chance *= mean / len(steps)
        total += chance
        steps.append(total)
    return steps


def tree_draws(seed: object, tree: int) -> Callable[[str, int], float]:
    """Uniform numbers for the places of a tree: md5 of the seed, a purpose, the tree and the place.

    A place counts from 1 at the root; below place p lie 2p and 2p + 1. Any engine can repeat
    these draws, and so the tree.
    """

    def draw(purpose: str, place: int) -> float:
        text = f"{seed}:{purpose}:{tree}:{place}"
        digits = hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()[:HEX_DIGITS]
        return int(digits, 16) / 16**HEX_DIGITS

    return draw


def grow_tree(rows: np.ndarray, max_depth: int, draw: Callable[[str, int], float]) -> list[tuple]:
    """Nodes of one tree as (node, feature, threshold, left, right, n, depth), left parts first."""
    nodes: list[tuple] = []
    open_nodes = [(rows, 0, 1, -1, False)]
    while open_nodes:
        part, depth, place, parent, is_right = open_nodes.pop()
        node = len(nodes)
        if parent >= 0:
            at = 4 if is_right else 3
            nodes[parent] = (*nodes[parent][:at], node, *nodes[parent][at + 1 :])
        low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (0.0, 0.0)
        splittable = np.flatnonzero(np.asarray(high) > np.asarray(low))
        if depth >= max_depth or len(part) <= 1 or len(splittable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(part), depth))
            continue
        feature = int(splittable[int(draw("feature", place) * len(splittable))])
        # The largest value always goes right, so neither side is empty.
        threshold = float(low[feature] + draw("cut", place) * (high[feature] - low[feature]))
        threshold = min(threshold, float(np.nextafter(high[feature], low[feature])))
        goes_left = part[:, feature] <= threshold
        nodes.append((node, feature, threshold, -1, -1, len(part), depth))
        open_nodes.append((part[~goes_left], depth + 1, 2 * place + 1, node, True))
        open_nodes.append((part[goes_left], depth + 1, 2 * place, node, False))
    return nodes


def _grow_forest(samples: DataFrame, features: Sequence[str], key: Sequence[str], psi, seed):
    max_depth = max(1, math.ceil(math.log2(max(psi, 2))))
    features, key = list(features), list(key)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        # Rows arrive in no fixed order; a tree depends on their set alone.
        tree = int(pdf["tree"].iloc[0])
        rows = pdf[features].to_numpy(dtype=float)
        grown = pd.DataFrame(grow_tree(rows, max_depth, tree_draws(seed, tree)), columns=NODES.names[1:])
        grown.insert(0, "tree", tree)
        return grown

    return samples.groupBy("tree").applyInPandas(grow, NODES)


@dataclass
class IForestModel:
    """A fitted forest: at most ``trees * (2 * psi - 1)`` nodes, whatever was fitted on."""

    nodes: pd.DataFrame
    features: list[str]
    psi: int
    offset: float | None = None
    params: dict = field(default_factory=dict)

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and parameters as two parquet tables."""
        nodes = spark.createDataFrame(self.nodes, NODES)
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        settings = {
            "features": self.features, "psi": self.psi, "offset": self.offset, **self.params
        }
        row = [(json.dumps(settings),)]
        spark.createDataFrame(row, "settings string").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/settings"
        )

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IForestModel:
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        params = json.loads(spark.read.parquet(f"{path}/settings").first().settings)
        return cls(
            nodes, params.pop("features"), params.pop("psi"), params.pop("offset"), params
        )

    def packed(self) -> dict[str, np.ndarray]:
        """All trees as complete ones, a row of each array per tree: below place p lie 2p and 2p + 1.

        A leaf goes on as its own child down to the last level, which alone has lengths. As depth is
        limited, a tree has less than 2 * psi places.
        """
        nodes = self.nodes.sort_values(["tree", "node"])
        sizes = nodes.groupby("tree").size()
        roots = np.concatenate([[0], np.cumsum(sizes.to_numpy())[:-1]])
        base = np.repeat(roots, sizes.to_numpy())
        own = np.arange(len(nodes))
        leaf = nodes["feature"].to_numpy() < 0
        depth = nodes["depth"].to_numpy(dtype=float)
        levels = int(depth.max()) if len(depth) else 0
        children = [np.where(leaf, own, base + nodes[side]) for side in ("left", "right")]
        children = np.stack(children, axis=1)
        feature = np.where(leaf, 0, nodes["feature"])
        threshold = nodes["threshold"].to_numpy(dtype=float)
        length = np.where(leaf, depth + average_path(nodes["n"]), 0.0)
        features = np.zeros((len(roots), 1 << levels), dtype=np.intp)
        thresholds = np.zeros(features.shape)
        at = roots[:, None]
        for level in range(levels):
            places = slice(1 << level, 2 << level)
            features[:, places], thresholds[:, places] = feature[at], threshold[at]
            at = children[at].reshape(len(roots), -1)
        return {
            "feature": features, "threshold": thresholds, "length": length[at], "levels": np.array(levels)
        }


def path_lengths(forest: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Mean path length of each row over all trees."""
    levels, n = int(forest["levels"]), len(rows)
    # On the top levels rows are compared with every node, column by column, which is quicker than to
    # look up the node of each row. The results as bits of a number name the place below these levels.
    top = min(levels, TOP_LEVELS)
    numbers = np.arange(1 << ((1 << top) - 1))
    below = np.ones(len(numbers), dtype=np.intp)
    for _ in range(top):
        below = 2 * below + ((numbers >> (below - 1)) & 1)
    columns = np.ascontiguousarray(rows.T, dtype=float)
    values, row = columns.ravel(), np.arange(n)
    total, value, limit = np.zeros(n), np.empty(n), np.empty(n)
    at, cell = np.empty(n, dtype=np.intp), np.empty(n, dtype=np.intp)
    right, number = np.empty(n, dtype=bool), np.empty(n, dtype=np.uint8)
    for feature, threshold, length in zip(forest["feature"], forest["threshold"], forest["length"]):
        number[:] = 0
        for place in range(1, 1 << top):
            np.greater(columns[feature[place]], threshold[place], out=right)
            number |= right.view(np.uint8) << np.uint8(place - 1)
        below.take(number, out=at, mode="clip")
        first = feature * n
        for _ in range(levels - top):
            first.take(at, out=cell, mode="clip")
            cell += row
            values.take(cell, out=value, mode="clip")
            threshold.take(at, out=limit, mode="clip")
            np.greater(value, limit, out=right)
            at += at
            at += right
        at -= 1 << levels
        total += length.take(at, out=limit, mode="clip")
    return total / max(len(forest["length"]), 1)


def fit_iforest(
    df: DataFrame,
    features: Sequence[str] = FEATURE_COLS,
    key: str | Sequence[str] = "timestamp",
    trees: int = TREES,
    psi: int = PSI,
    seed: object = SEED,
    contamination: float | None = CONTAMINATION,
    handle_invalid: str = "error",
    approximate_offset: bool = False,
) -> IForestModel:
    """Fit the forest and, from the scores of ``df`` itself, the anomaly offset.

    ``key`` must identify a row. Missing features raise ("error") or leave the row
    out of the fit ("skip", "keep").
    """
    key = [key] if isinstance(key, str) else list(key)
    rows = _checked(df.select(*key, *[c for c in features if c not in key]), features,
                    "skip" if handle_invalid == "keep" else handle_invalid)
    n = rows.count()
    if n == 0:
        raise ValueError("no rows to fit on")
    size = min(psi, n)
    margin, short = DRAW_MARGIN, True
    while short:
        samples = tree_samples(rows, key, trees, size, seed, n, margin)
        # The result is bounded by trees * (2 * psi - 1) rows; it is the model itself.
        nodes = _grow_forest(samples, features, key, size, seed).toPandas()
        nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
        drawn = nodes[nodes["node"] == 0].set_index("tree")["n"].reindex(range(trees))
        # Repeated keys are drawn together, which can leave a tree short: draw more.
        short = not (drawn == size).all()
        margin *= 8
    params = {"trees": trees, "seed": str(seed), "contamination": contamination}
    model = IForestModel(nodes, list(features), size, None, params)
    if contamination is not None:
        # Scoring is the costly part, so passes over the scores share one run of it.
        scores = score(rows, model).select("anomaly_score").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model.offset = contamination_threshold(
                scores, contamination, approximate=approximate_offset
            ).first()["threshold"]
        finally:
            scores.unpersist()
    return model


def _checked(df: DataFrame, features: Sequence[str], handle_invalid: str) -> DataFrame:
    """Apply the policy for rows with a missing feature."""
    complete = F.lit(True)
    for c in features:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    if handle_invalid == "keep":
        return df
    if handle_invalid == "skip":
        return df.filter(complete)
    if handle_invalid != "error":
        raise ValueError(f"handle_invalid must be error, skip or keep, not {handle_invalid!r}")
    first, message = features[0], F.lit("missing value in a model feature")
    value = F.when(complete, F.col(first)).otherwise(F.raise_error(message))
    return df.withColumn(first, value)


def _score_column(model: IForestModel) -> Column:
    forest = model.packed()
    normal_path = float(average_path(model.psi))

    @F.pandas_udf("double")
    def score_batches(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            # A single feature arrives as a series rather than a tuple of them.
            columns = (batch,) if isinstance(batch, pd.Series) else batch
            rows = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            known = ~np.isnan(rows).any(axis=1)
            result = np.full(len(rows), np.nan)
            mean_path = path_lengths(forest, rows[known])
            result[known] = -(2.0 ** (-mean_path / max(normal_path, 1e-300)))
            yield pd.Series(result)

    return score_batches(*[F.col(c).cast("double") for c in model.features])


def score(
    df: DataFrame, model: IForestModel, handle_invalid: str = "error", out: str = "anomaly_score"
) -> DataFrame:
    """Add the anomaly score in [-1, 0]; lower is more anomalous.

    Only the feature columns go to the Python workers, batch by batch. With "keep",
    rows with a missing feature get a NULL score.
    """
    checked = _checked(df, model.features, handle_invalid)
    return checked.withColumn(out, _score_column(model))


def walk_forest(
    df: DataFrame,
    nodes: DataFrame,
    features: Sequence[str],
    key: Sequence[str],
    psi: int,
    out: str = "anomaly_score",
) -> DataFrame:
    """``key`` and the score of each row, by joins with a forest that lies in a table.

    This is for forests too large to ship to workers: nothing of the forest comes to the
    driver but its depth. Every row takes its place in every tree and moves down one level
    a join; rows at a leaf stay there. Sums over the trees begin before the last shuffle.
    The key must identify a row; rows with a missing feature get no score.
    """
    key, names = list(key), list(features)
    leaf = F.col("feature") < 0
    size = F.greatest(F.col("n"), F.lit(3))
    long = 2.0 * (F.log(size - 1.0) + EULER_GAMMA) - 2.0 * (size - 1.0) / size
    tail = F.when(F.col("n") > 2, long).when(F.col("n") == 2, 1.0).otherwise(0.0)
    steps = nodes.select(
        F.col("tree").alias("_tree"), F.col("node").alias("_node"), "feature", "threshold",
        F.when(leaf, F.col("node")).otherwise(F.col("left")).alias("left"),
        F.when(leaf, F.col("node")).otherwise(F.col("right")).alias("right"),
        F.when(leaf, F.col("depth") + tail).alias("length"),
    )
    depth, trees = nodes.agg(F.max("depth"), F.count_if(F.col("node") == 0)).first()
    values = [F.col(c).cast("double") for c in names]
    known = F.lit(True)
    for v in values:
        known = known & v.isNotNull() & ~F.isnan(v)
    roots = nodes.filter("node = 0").agg(F.collect_list("tree")).scalar()
    at = df.filter(known).select(*key, F.array(*values).alias("_x"), F.explode(roots).alias("_tree"))
    at = at.withColumn("_node", F.lit(0))
    for _ in range(depth or 0):
        step = steps.select("_tree", "_node", "feature", "threshold", "left", "right")
        value = F.get("_x", F.greatest(F.col("feature"), F.lit(0)))
        below = F.when(value <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(step, ["_tree", "_node"]).select(*key, "_x", "_tree", below.alias("_node"))
    ends = at.join(steps.select("_tree", "_node", "length"), ["_tree", "_node"])
    mean = F.sum("length") / trees
    normal_path = max(float(average_path(psi)), 1e-300)
    scored = ends.groupBy(*key).agg((-F.pow(F.lit(2.0), -mean / normal_path)).alias(out))
    return df.select(*key).join(scored, key, "left")


def contamination_threshold(
    scores: DataFrame,
    contamination: float = CONTAMINATION,
    column: str = "anomaly_score",
    approximate: bool = False,
) -> DataFrame:
    """One row: the score below which the wanted share of rows lies."""
    quantile = quantile_columns(scores, [column], [contamination], approximate=approximate)
    return scores.agg(quantile[column][0].alias("threshold"))


def predict_columns(score_column: str, threshold: Column) -> dict[str, Column]:
    """-1 for scores strictly below the threshold, else 1, and the 0/1 flag."""
    prediction = F.when(F.col(score_column) < threshold, -1).otherwise(1)
    return {
        "anomaly_prediction": prediction,
        "is_predicted_anomaly": F.when(prediction == -1, 1).otherwise(0),
    }


def score_telemetry(
    df: DataFrame, model: IForestModel, handle_invalid: str = "error"
) -> DataFrame:
    """Add ``anomaly_prediction``, ``anomaly_score`` and ``is_predicted_anomaly``."""
    if model.offset is None:
        raise ValueError("the model was fitted without a contamination, so it has no offset")
    scored = score(df, model, handle_invalid)
    return scored.withColumns(predict_columns("anomaly_score", F.lit(model.offset)))


def top_anomalies(
    df: DataFrame, n: int = 5, column: str = "anomaly_score", order: str = "timestamp"
) -> DataFrame:
    """The n rows with the smallest scores, ties by file order."""
    return df.orderBy(F.col(column).asc_nulls_last(), order).limit(n)
