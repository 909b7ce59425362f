"""Isolation forest: hand-built trees, sampling, invariants, scoring."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsegrid.functions.hashing import least_digits
from pulsegrid.operators import iforest


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    points = rng.normal(size=(3000, 2))
    points[::100] += 12.0
    rows = [(i, float(a), float(b), int(i % 100 == 0)) for i, (a, b) in enumerate(points)]
    return spark.createDataFrame(rows, "id long, a double, b double, odd int").cache()


@pytest.fixture(scope="module")
def model(table):
    return iforest.fit_iforest(table, ["a", "b"], key="id", trees=40)


def walk(nodes, features, row):
    """Path length in one tree, node by node."""
    by_id = {n.node: n for n in nodes}
    node = by_id[0]
    while node.feature >= 0:
        node = by_id[node.left if row[features[node.feature]] <= node.threshold else node.right]
    return node.depth + float(iforest.average_path(node.n))


def test_average_path():
    assert list(iforest.average_path([0, 1, 2])) == [0.0, 0.0, 1.0]
    expected = 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256
    assert float(iforest.average_path(256)) == pytest.approx(expected)


def test_hand_built_tree():
    nodes = pd.DataFrame(
        [
            (0, 0, 0, 5.0, 1, 2, 4, 0),
            (0, 1, -1, 0.0, -1, -1, 1, 1),
            (0, 2, 1, 1.0, 3, 4, 3, 1),
            (0, 3, -1, 0.0, -1, -1, 2, 2),
            (0, 4, -1, 0.0, -1, -1, 1, 2),
        ],
        columns=iforest.NODES.names,
    )
    forest = iforest.IForestModel(nodes, ["a", "b"], 4).packed()
    rows = np.array([[5.0, 9.0], [6.0, 1.0], [6.0, 2.0]])
    assert list(iforest.path_lengths(forest, rows)) == [1.0, 3.0, 2.0]


def test_tree_samples_have_exact_size(spark):
    for n in (100, 5000, 200_000):
        df = spark.range(n).withColumnRenamed("id", "k")
        drawn = iforest.tree_samples(df, "k", trees=10, psi=min(256, n))
        sizes = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("k").alias("d"))
        assert {tuple(r) for r in sizes.collect()} == {(t, min(256, n), min(256, n)) for t in range(10)}


def test_trees_draw_independently_from_all_rows(spark):
    df = spark.range(200_000).withColumnRenamed("id", "k")
    drawn = iforest.tree_samples(df, "k", trees=1000, psi=256)
    rows, distinct = drawn.agg(F.count("*"), F.count_distinct("k")).first()
    # 200,000 * (1 - (1 - 256 / 200,000) ** 1000)
    assert rows == 256_000 and abs(distinct - 144_400) < 1500


def test_rows_that_no_tree_picks_leave_before_their_draws(spark):
    """By the hash of one draw, compared as text: no step, pick or tree is tried for them."""
    df = spark.range(200_000).withColumnRenamed("id", "k")
    plan = iforest.tree_samples(df, "k", trees=10, psi=16)._jdf.queryExecution().optimizedPlan().toString()
    first = [line for line in plan.splitlines() if "Filter" in line][-1]
    assert "md5" in first and "lambda" not in first and "conv(" not in first and "explode" not in first


@pytest.mark.parametrize("p", [0.0, 1e-17, 0.25, 0.3, 1 - 2**-52, 1 - 2**-53, 1.0])
def test_draws_reach_a_step_as_text(p):
    """Text above and below the first digits of a step, and the numbers they stand for."""
    least = least_digits(p)
    near = [0, 1, 2**52 - 1] + [n + d for n in [int(p * 2**52)] for d in (-1, 0, 1)]
    for n in [n for n in near if 0 <= n < 2**52]:
        assert (least is not None and least <= f"{n:013x}") == (p <= n / 2**52)


def test_repeated_keys_widen_the_draw(spark):
    df = spark.range(20_000).select((F.col("id") % 50).alias("k"), F.col("id").cast("double").alias("a"))
    fitted = iforest.fit_iforest(df, ["a"], "k", trees=5, psi=64, contamination=None)
    assert set(fitted.nodes.query("node == 0")["n"]) == {64}


def test_tree_shapes(model):
    nodes = model.nodes
    assert nodes["tree"].nunique() == 40
    assert nodes["depth"].max() <= 8
    leaves = nodes[nodes["feature"] < 0].groupby("tree")["n"].sum()
    assert (leaves == 256).all()
    assert (nodes["n"] > 0).all()


def test_scores_match_a_walk_through_every_tree(table, model):
    scored = iforest.score(table, model).limit(30).toPandas()
    groups = [list(g.itertuples()) for _, g in model.nodes.groupby("tree")]
    for row in scored.to_dict("records"):
        mean = np.mean([walk(g, model.features, row) for g in groups])
        expected = -(2.0 ** (-mean / float(iforest.average_path(256))))
        assert row["anomaly_score"] == pytest.approx(expected)


def test_outliers_score_lower_and_offset_cuts_five_percent(table, model):
    scored = iforest.score_telemetry(table, model)
    by_kind = {r.odd: r.m for r in scored.groupBy("odd").agg(F.avg("anomaly_score").alias("m")).collect()}
    assert -1 <= by_kind[1] < by_kind[0] <= 0
    flagged = scored.filter("is_predicted_anomaly = 1")
    assert flagged.count() == math.ceil(0.05 * 2999)
    assert flagged.filter("odd = 1").count() == 30
    assert scored.filter("(anomaly_prediction = -1) <> (is_predicted_anomaly = 1)").count() == 0
    worst = iforest.top_anomalies(scored, order="id").collect()
    assert [r.odd for r in worst] == [1] * 5


def test_fit_does_not_depend_on_partitions(table, model):
    again = iforest.fit_iforest(table.repartition(13), ["a", "b"], key="id", trees=40)
    pd.testing.assert_frame_equal(again.nodes, model.nodes)
    assert again.offset == model.offset


def test_save_and_load(spark, table, model, folder):
    model.save(spark, f"{folder}/m")
    loaded = iforest.IForestModel.load(spark, f"{folder}/m")
    assert (loaded.offset, loaded.psi, loaded.features) == (model.offset, 256, ["a", "b"])
    both = iforest.score(iforest.score(table, model), loaded, out="again")
    assert both.filter("again <> anomaly_score").count() == 0


def test_missing_features(spark, table, model):
    holes = table.withColumn("a", F.when(F.col("id") != 7, F.col("a")))
    with pytest.raises(Exception, match="missing value in a model feature"):
        iforest.score(holes, model).agg(F.sum("anomaly_score")).collect()
    with pytest.raises(Exception, match="missing value"):
        iforest.fit_iforest(holes, ["a", "b"], key="id", trees=2)
    kept = iforest.score(holes, model, "keep")
    assert [r.id for r in kept.filter("anomaly_score is null").collect()] == [7]
    assert iforest.score(holes, model, "skip").count() == 2999


def test_top_ties_go_by_file_order(spark):
    df = spark.createDataFrame([(i, -0.5) for i in range(8)] + [(8, None)], "seq long, anomaly_score double")
    top = iforest.top_anomalies(df.repartition(4), order="seq").collect()
    assert [r.seq for r in top] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("psi", [1, 2, 4, 8, 40])
def test_paths_of_shallow_and_deep_trees_equal_a_walk(psi):
    """Fewer levels than are scored column by column, as many, and more."""
    rng = np.random.default_rng(psi)
    depth = math.ceil(math.log2(max(psi, 2)))
    grown = [(t, *node) for t in range(6)
             for node in iforest.grow_tree(rng.integers(0, 9, (psi, 3)), depth, iforest.tree_draws(1, t))]
    nodes = pd.DataFrame(grown, columns=iforest.NODES.names)
    rows = rng.integers(-1, 11, (200, 3)).astype(float)
    forest = iforest.IForestModel(nodes, ["a", "b", "c"], psi).packed()
    trees = [list(part.itertuples()) for _, part in nodes.groupby("tree")]
    want = [sum(walk(tree, [0, 1, 2], row) for tree in trees) / 6 for row in rows]
    assert forest["length"].shape[1] <= 2 * psi
    assert iforest.path_lengths(forest, rows) == pytest.approx(want)


def test_constant_table_has_single_node_trees(spark):
    df = spark.range(50).select("id", F.lit(1.0).alias("a"))
    model = iforest.fit_iforest(df, ["a"], key="id", trees=3)
    assert len(model.nodes) == 3
    assert iforest.score_telemetry(df, model).filter("is_predicted_anomaly = 1").count() == 0


def test_draws_are_md5_of_their_place():
    import hashlib

    digits = hashlib.md5(b"42:cut:3:5").hexdigest()[:13]
    assert iforest.tree_draws(42, 3)("cut", 5) == int(digits, 16) / 16**13


def test_trees_do_not_depend_on_the_order_of_rows():
    rows = np.random.default_rng(1).normal(size=(64, 3))
    grown = iforest.grow_tree(rows, 6, iforest.tree_draws("s", 0))
    assert grown == iforest.grow_tree(rows[::-1], 6, iforest.tree_draws("s", 0))
    assert grown != iforest.grow_tree(rows, 6, iforest.tree_draws("s", 1))


def test_walk_by_joins_equals_shipped_forest(spark, table, model):
    holes = table.withColumn("a", F.when(F.col("id") != 7, F.col("a")))
    nodes = spark.createDataFrame(model.nodes, iforest.NODES)
    walked = iforest.walk_forest(holes, nodes, ["a", "b"], ["id"], model.psi, out="walked")
    both = walked.join(iforest.score(holes, model, "keep"), "id")
    assert both.count() == 3000
    assert [r.id for r in both.filter("walked is null").collect()] == [7]
    assert both.filter("id <> 7 and not abs(walked - anomaly_score) < 1e-12").count() == 0


def test_walk_through_single_node_trees(spark):
    df = spark.range(5).select("id", F.lit(1.0).alias("a"))
    nodes = spark.createDataFrame([(t, 0, -1, 0.0, -1, -1, 5, 0) for t in range(3)], iforest.NODES)
    scores = {r.anomaly_score for r in iforest.walk_forest(df, nodes, ["a"], ["id"], 5).collect()}
    assert scores == {-0.5}
    assert iforest.walk_forest(df.limit(0), nodes, ["a"], ["id"], 5).count() == 0
