"""Each operator against brute force, round trips or held-out rows, and on awkward tables."""

import collections
import dataclasses
import glob
import io
import os
import re
import shutil
import subprocess
import sys
import time
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check import compare
from pulsegrid.llm import components as components_module
from pulsegrid.llm import mixing, neardup, packing, quality, queries, tokenids, warc
from pulsegrid.llm.common import CLEANUP, in_file_order, stored
from pulsegrid.llm.components import components
from pulsegrid.llm.neardup import near_duplicates
from pulsegrid.llm.shingles import minhash_seeds, shingle_set, signature
from pulsegrid.llm.tokencounts import section_tokens
from pulsegrid.llm.tokens import SPACE, PieceEncoder, tokenizer_path
from pulsegrid.llm.topk import segment_statistics, top_k
from pulsegrid.llm.toxicity import fit_toxicity, toxicity
from pulsegrid.llm.vectors import near_vectors

from .conftest import TEXTS, WORDS

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, id string, vector int"


def library(name):
    known = Tokenizer.from_file(tokenizer_path(name))
    known.encode_special_tokens = True
    return known


# --- 1: top-k ------------------------------------------------------------------------


def odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(8).tolist(), k % 2, "x", 1) for k in range(60)]
    rows += [(100, None, 0, "x", 1), (101, [1.0, None], 0, "x", 1), (102, [float("nan")] * 8, 0, "x", 1),
             (103, [0.0] * 8, 0, "x", 1), (104, [], 0, "x", 1), (105, [1.0, 2.0], 0, "x", 1),
             (106, rows[3][1], 1, "x", 1), (107, rows[3][1], 1, "x", 1), (108, rows[3][1], None, "x", 1),
             (None, rows[3][1], 1, "x", 1), (109, [float("inf")] * 8, 1, "x", 1), rows[4]]
    return spark.createDataFrame(rows, VECTORS)


def test_bounds_never_fall_below_the_product():
    rng = np.random.default_rng(0)
    a, b = rng.integers(-300, 300, (50, 13)).astype(float), rng.integers(-300, 300, (40, 13)).astype(float)
    for level in (1, 4, 16):
        bound = segment_statistics(a, level) @ segment_statistics(b, level).T
        assert (bound >= a @ b.T - 1e-6).all()


def test_top_k_equals_brute_force(spark):
    df = odd_vectors(spark)
    ours = top_k(df, F.col("vec_id") % 10 == 0, k=4, block_rows=16).collect()
    assert sorted(tuple(r) for r in ours) == brute_top_k(df, 10, 4)


def brute_top_k(df, every, k):
    """Every row is a candidate of other ids' queries; rows of one id are ranked together."""
    known = [(r.vec_id, np.floor(256 * np.array(r.embedding)).astype(int)) for r in df.collect()
             if r.vec_id is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    want = []
    for q in {i for i, _ in known if i % every == 0}:
        scored = sorted((-int(v @ w), j) for i, v in known if i == q for j, w in known if j != q and len(w) == len(v))
        want += [(q, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(want)


def sql_over(name, **tables):
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register(table, frame.toArrow())
    return con.execute(queries.ORACLE_SQL[name]).fetchall()


def test_top_k_of_repeated_ids(spark):
    """Other vectors, and the same one, below one id; queries and candidates among them."""
    rng = np.random.default_rng(21)
    rows = [(int(k), rng.standard_normal(8).tolist(), 0) for k in rng.integers(0, 120, 200)]
    rows += rows[:7] + [(50, rows[3][1], 0), (50, rows[4][1], 0), (50, rows[4][1], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 50 == 0, k=5, block_rows=30).collect())
    assert found == brute_top_k(df, 50, 5)
    assert found == sorted(sql_over("op1_topk", embeddings=df.filter("vec_id is not null")))


@pytest.mark.parametrize("vectors", [[[1e300], [1.0]], [[3e16], [3e16]]])
def test_top_k_refuses_what_a_long_cannot_hold(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OverflowError"):
        top_k(df, F.lit(True)).collect()


def test_top_k_of_large_scores(spark):
    df = spark.createDataFrame([(0, [1e7, 3e6]), (1, [9999999.5, 1.0])], "vec_id long, embedding array<double>")
    product = 2_560_000_000 * 2_559_999_872 + 768_000_000 * 256
    assert {r.score for r in top_k(df, F.lit(True)).collect()} == {product}


def test_top_k_of_an_empty_table(spark):
    assert top_k(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


# --- 2: near duplicates ----------------------------------------------------------------


def brute_components(sets, percent):
    ids = sorted(sets)
    root = {i: i for i in ids}
    changed = True
    linked = [(a, b) for a in ids for b in ids if a < b and len(sets[a]) and len(sets[b])
              and 100 * len(np.intersect1d(sets[a], sets[b])) >= percent * len(np.union1d(sets[a], sets[b]))]
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_near_duplicates_of_odd_documents(spark, odd_docs):
    found = near_duplicates(odd_docs, percent=85).collect()
    sets = {k: shingle_set(t) for k, t in enumerate(TEXTS)}
    root = brute_components(sets, 85)
    assert len(found) == len(TEXTS) + 2
    for r in found:
        if r.doc_id is None:
            assert r.kept and r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
            assert r.kept == (r.component_id == r.doc_id)


def test_repeated_ids_link_by_their_own_texts(spark):
    w, v = (" ".join(f"{c}{k}" for k in range(60)) for c in "wv")
    rows = [(1, w), (1, v), (2, w), (3, v), (4, v + " z"), (7, "only this row"), (7, "only this row"), (7, None),
            (9, v + " z"), (8, w + " z"), (8, "a b c d e f"), (None, w), (None, v)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_duplicates(df, percent=85).collect())
    want = [(0, 56, 0, True)] * 2 + [(1, 56, 1, True)] * 2 + [
        (2, 56, 1, False), (3, 56, 1, False), (4, 57, 1, False), (7, 0, 7, True), (7, 1, 7, True), (7, 1, 7, True),
        (8, 2, 8, True), (8, 57, 1, False), (9, 57, 1, False)]
    assert found == want


def test_a_stage_drops_repeated_ids_by_their_texts(spark):
    w, v = (" ".join(f"{c}{k}" for k in range(60)) for c in "wv")
    df = spark.createDataFrame([(1, w), (5, w), (5, v), (6, v), (None, w)], "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, df, FOLDER).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(1, w), (5, v), (None, w)}


def test_crowd_of_edited_copies_is_one_component(spark):
    rng = np.random.default_rng(3)
    base = [f"b{k}" for k in range(200)]
    texts = {0: " ".join(base)}
    for k in range(1, 80):
        words = list(base)
        for at in rng.choice(200, int(rng.integers(1, 4)), replace=False):
            words[at] = f"e{k}_{at}"
        texts[k] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_duplicates(df, percent=85).collect()}
    assert found == brute_components({k: shingle_set(t) for k, t in texts.items()}, 85)


@pytest.mark.parametrize("rows, leaf", [(2_048, neardup.LEAF), (32, 8)])
def test_crowd_with_lone_links_is_compared_in_full(spark, monkeypatch, rows, leaf):
    """Copies around the threshold: many link with few others, and with no hub."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", rows)
    rng = np.random.default_rng(11)
    base = [f"b{k}" for k in range(160)]
    texts = {}
    for k in range(150):
        words = list(base)
        for at in rng.choice(160, int(rng.integers(1, 9)), replace=False):
            words[at] = f"e{rng.integers(0, 6)}_{at}"
        texts[k] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.component_id for r in near_duplicates(df, percent=85, leaf=leaf).collect()}
    want = brute_components({k: shingle_set(t) for k, t in texts.items()}, 85)
    assert found == want and 20 < len(set(want.values())) < 149


def test_depth_grows_where_a_prefix_is_crowded(spark):
    """Region 1 fits; region 2 splits at the next values; of region 3 one part stays crowded to the end."""
    rows = [(1, 5, 5, k) for k in range(4)] + [(2, k // 3, 0, 10 + k) for k in range(12)]
    rows += [(3, 7, 7, 100 + k) for k in range(40)] + [(3, 8, k, 200 + k) for k in range(3)]
    forest = spark.createDataFrame(rows, "region long, o1 long, o2 long, id long")
    forest = forest.join(forest.groupBy("region").agg(F.count("*").alias("crowd")), "region")
    found = {r.id: r for r in neardup._deepened(forest, 4).collect()}
    assert len(found) == len(rows)
    assert all(found[k].cell == 1 and found[k].cells == [1] for k in range(4))
    assert len({found[k].cell for k in range(10, 22)}) == 4 and len({found[k].cell for k in range(10, 13)}) == 1
    crowded = collections.Counter(found[k].cell for k in range(100, 140))
    assert len(crowded) > 5 and len({tuple(found[k].cells) for k in range(100, 140)}) == 1
    assert all(len(found[k].cells) == 2 for k in (10, 100, 200)) and found[100].cells[1] != found[200].cells[1]
    assert len({found[k].cell for k in range(200, 203)}) == 1


def test_fewest_equal_values_of_a_linked_pair():
    fewest = neardup.fewest_equal(72, 85)
    equal = np.random.default_rng(0).binomial(72, 0.85, 100_000)
    assert 30 < fewest <= equal.min()


def test_near_duplicates_of_an_empty_table(no_docs):
    assert near_duplicates(no_docs).count() == 0


def test_signature_estimates_similarity():
    a, b = shingle_set(" ".join(f"x{k}" for k in range(1000))), shingle_set(" ".join(f"x{k}" for k in range(100, 1000)))
    seeds = minhash_seeds(512)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((signature(a, seeds) == signature(b, seeds)).mean() - true) < 0.08


def test_written_stages_leave_no_shuffle_files(spark):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(k).getName() for k in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffles()
    keys = spark.range(1000).withColumn("k", F.col("id") % 10)
    rows = stored(keys.groupBy("k").count().join(keys.repartition(3, "k"), "k"), "joined")
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert rows.count() == 1000
    assert spark.conf.get(CLEANUP, None) is None


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 130)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(100, 130), 100)}


def test_components_of_many_tasks(spark, monkeypatch):
    """Chains that run through all tasks, contracted a few edges at a time."""
    order = np.random.default_rng(5).permutation(600)
    edges = [(int(order[k]), int(order[k + 1])) for k in range(599) if k % 150 != 149]
    want = {int(x): int(order[k // 150 * 150 : k // 150 * 150 + 150].min()) for k, x in enumerate(order)}
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    assert {r.node: r.component for r in components(df).collect()} == want
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    ends = np.array([sorted(e, reverse=True) for e in edges])
    batches = pa.table({"u": ends[:, 0], "v": ends[:, 1]}, schema).to_batches(max_chunksize=50)
    monkeypatch.setattr(components_module, "CHUNK", 100)
    stars = pa.Table.from_batches(list(components_module._contract(batches)))
    pairs = zip(stars["u"].to_pylist(), stars["v"].to_pylist())
    again = spark.createDataFrame(list(pairs), "a long, b long")
    assert {r.node: r.component for r in components(again).collect()} == want


# --- 3: WARC -----------------------------------------------------------------------------


@pytest.mark.parametrize("most", [warc.HOT_DIGESTS, 1])
def test_copies_of_hot_payloads(spark, folder, monkeypatch, most):
    """A third of all rows share one payload; with one hot digest the others go by the join."""
    monkeypatch.setattr(warc, "HOT_DIGESTS", most)
    hot, pair = "h" * 100, "p" * 100
    pages = [(k, "u", hot) for k in range(40, 10, -1)] + [(50, "u", pair), (51, "u", pair), (52, "u", pair)]
    pages += [(k, "u", "s" * 99) for k in range(60, 90)] + [(None, "u", hot), (None, "u", None), (11, "v", hot)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    found = warc.read_archives(warc.write_archives(df, folder)).collect()
    assert len(found) == len(pages)
    for r in found:
        want = None
        if r.page_id is not None and 11 < r.page_id <= 40:
            want = 11
        elif r.page_id in (51, 52):
            want = 50
        assert r.refers_to == want and r.record_type == ("response" if want is None else "revisit")


def test_warc_round_trip(spark, folder):
    same = "é" * 80
    pages = [(3, "u", same), (1, None, same), (9, "a\r\nb", None), (4, "u", "short"), (5, "u", "short"),
             (1, None, same), (None, "u", same), (7, "u", "<p>" + "x" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("id", F.lit(1))
    found = warc.read_archives(warc.write_archives(df, folder), payloads=True).collect()
    assert len(found) == len(pages)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in found}
    assert kinds == {(3, "revisit", 1), (1, "response", None), (9, "response", None), (4, "response", None),
                     (5, "response", None), (None, "response", None), (7, "response", None)}
    texts = {r.page_id: bytes(r.payload).decode() for r in found if r.payload is not None}
    assert texts == {None: same, 1: same, 9: "", 4: "short", 5: "short", 7: pages[-1][2]}
    assert warc.round_trip(df.limit(0)).count() == 0


def test_reader_refuses_broken_archives():
    whole = warc.member(warc.record(1, "u", b"payload", None))
    assert [r["payload"] for r in warc.read_records(io.BytesIO(whole * 2))] == [b"payload"] * 2
    wrong = warc.record(1, "u", b"payload", None).replace(b"payload\r\n", b"paYload\r\n")
    for bad in (whole[:-12], warc.member(wrong)):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(bad)))


# --- 4: vectors ----------------------------------------------------------------------------


@pytest.mark.parametrize("block_rows", [2_048, 7])
def test_near_vectors_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(5)
    df = odd_vectors(spark)
    center = rng.standard_normal(16)
    crowd = [(1000 + k, (center + 0.05 * rng.standard_normal(16)).tolist(), 7, "x", 1) for k in range(40)]
    df = df.filter("vec_id is not null").dropDuplicates(["vec_id"]).union(spark.createDataFrame(crowd, VECTORS))
    rows = df.collect()
    fits = [r for r in rows if r.label is not None and r.embedding and None not in r.embedding
            and np.isfinite(r.embedding).all() and any(r.embedding)]
    links = collections.defaultdict(set)
    for a in fits:
        for b in fits:
            if a.vec_id != b.vec_id and a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding), np.array(b.embedding)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    links[a.vec_id].add(b.vec_id)
    found = {r.vec_id: r for r in near_vectors(df, block_rows=block_rows).collect()}
    assert {k: r.n_links for k, r in found.items()} == {r.vec_id: len(links[r.vec_id]) for r in rows}
    for k, near in links.items():
        assert {found[n].component_id for n in near} <= {found[k].component_id}


def test_near_vectors_of_repeated_ids(spark):
    """Different vectors below one id have links of their own; so have null ids none."""
    a, b, c = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]
    near = [[0.01 if x == 0.0 else x for x in v] for v in (a, b)]
    rows = [(1, a, 0), (1, b, 0), (2, near[0], 0), (3, near[1], 0), (4, near[1], 0), (5, c, 0), (5, c, 0), (5, c, 1),
            (None, a, 0), (6, a, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    found = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in near_vectors(df).collect())
    assert found == [(0, 0, 0, True), (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False),
                     (5, 0, 5, True), (5, 1, 5, True), (5, 1, 5, True), (6, 0, 6, True)]


def test_workers_need_not_have_the_package(tmp_path):
    """A session whose workers cannot import the package, as on a cluster without it."""
    code = f"""
import sys
sys.path.insert(0, {os.getcwd()!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate())
from pulsegrid.llm.vectors import near_vectors
from pulsegrid.llm.topk import top_k
df = spark.createDataFrame([(k, [float(k % 3), 1.0], 0) for k in range(9)], "vec_id long, embedding array<double>, label int")
assert near_vectors(df).count() == 9
assert top_k(df, F.lit(True), k=2).count() == 18
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]


def test_near_vectors_of_an_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


# --- 5 and 8: classifiers ----------------------------------------------------------------------


def tables(spark, name):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    right = collections.Counter((r[0] == r[1], r[1]) for r in rows)
    return right[True, 1] / (right[True, 1] + right[False, 1]), right[True, 0] / (right[True, 0] + right[False, 0])


def test_toxicity_on_held_out_documents(spark):
    _, labels = tables(spark, "")
    found, clean = accuracy(queries.op5_toxicity(spark, "/root/testdata/sf0.1"), labels, "toxic")
    assert found > 0.6 and clean > 0.95


def test_quality_on_held_out_documents(spark):
    _, labels = tables(spark, "")
    good, bad = accuracy(queries.op8_quality(spark, "/root/testdata/sf0.1"), labels, "quality")
    assert good > 0.97 and bad > 0.8


def test_the_surest_rows_come_from_the_whole_table(spark):
    """Against one sort of all rows; equal rows count once, and rows taught before are left out."""
    rng = np.random.default_rng(4)
    rows = {k: (rng.standard_normal(3), rng.standard_normal(2)) for k in range(3_000)}
    table = [(k, t.tobytes(), m.tobytes()) for k, (t, m) in rows.items()]
    pool = spark.createDataFrame(table + table[:500], "key long, text binary, meta binary").repartition(7)
    target = np.array([float(t[0] + m[0] > 0) for t, m in rows.values()])
    models = {v: quality.fit_logistic(np.stack([r[k] for r in rows.values()]), target, ridge=1e-3)
              for k, v in enumerate(quality.VIEWS)}
    models = {v: dataclasses.replace(m, weights=m.weights * 4) for v, m in models.items()}
    taught = {"text": set(range(0, 3000, 2)), "meta": set(range(50))}
    got = [(p, label, key) for p, label, key, _ in quality._most_confident(pool, models, taught)]
    want = []
    for pupil, view in (("meta", "text"), ("text", "meta")):
        side = quality.VIEWS.index(view)
        p = models[view].probability(np.stack([r[side] for r in rows.values()]))
        for label, sure in ((1, p), (0, 1 - p)):
            order = sorted((-sure[k], k) for k in rows if sure[k] >= quality.CONFIDENT and k not in taught[pupil])
            want += [(pupil, label, k) for _, k in order[: quality.PER_ROUND]]
    assert got == want and len(got) > 500


def test_unlabelled_rows_outside_any_sample_are_offered(spark, monkeypatch):
    """The one sure page among many unsure ones reaches the other view."""
    monkeypatch.setattr(quality, "PER_ROUND", 1)
    offered = []
    real = quality._most_confident
    monkeypatch.setattr(quality, "_most_confident", lambda pool, *rest: offered.append(pool.count()) or real(pool, *rest))
    words = " ".join(WORDS[:40])
    docs = [(k, words if k % 2 else "### $$$ " * 30, "en", "s", 100) for k in range(12_000)] + [(None, words, "en", "s", 1)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, quality int")
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    quality.fit_quality(df, labels, per_class=50)
    # All rows but the labelled ones of the fit: more than any fixed pool held before.
    assert offered and 12_001 - 200 < min(offered) < 12_001


@pytest.mark.parametrize("part", [1_000_000, 1, 7])
def test_longest_line_at_any_size(monkeypatch, part):
    monkeypatch.setattr(quality, "PART", part)
    lines = ["x" * (k * 7 % 50) for k in range(400)]
    for text in ("", "\n", "a", "a\n", "\nab", "ab\n\nc", "\n".join(lines), "é" * 40 + "\n" + "z" * 9):
        assert quality.longest_line(text) == max(map(len, text.split("\n")))


def test_longest_line_of_a_long_table():
    text = "\n".join("x" * 50 for _ in range(100_001))
    assert quality.metadata_view(text, [], len(text))[2] == pytest.approx(np.log1p(50))


def test_classifiers_on_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(14)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for docs in (odd_docs, no_docs):
        for known in (labels, none):
            tox = fit_toxicity(docs, known)
            good = quality.fit_quality(docs, known)
            rows = docs.select(toxicity(tox, F.col("text")).alias("x"), quality.quality(good, docs)["score"].alias("y"))
            assert all(0 <= r.x <= 1 and 0 <= r.y <= 1 for r in rows.collect())


# --- 6, 7, 9: tokens --------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("spans", [False, True])
def test_piece_encoder_equals_the_library(name, spans):
    odd = ["a  b", " a", "a ", "x\n\ny z", "it's don't  b", "é é \x00 q", "日本 語　x y", "tab\t x", "😀 a😀b c."]
    texts = [t or "" for t in TEXTS] + odd
    rows, ends = PieceEncoder(tokenizer_path(name), spans).encode(texts)
    for k, text in enumerate(texts):
        want = library(name).encode(text, add_special_tokens=False)
        own = rows[ends[k] : ends[k + 1]]
        assert own[:, 0].tolist() == want.ids
        if spans:
            assert list(map(tuple, own[:, 1:].tolist())) == want.offsets


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_encoder_of_letters_that_normalise_to_marks(name):
    words = ["GEZ\u0130", "\u0915\u0958", "\u05d0\ufb2a", "caf\u00e9", "\u017belazny", "\u1e9e", "plain", "\u65e5\u672c"]
    texts = [f"{w}{stop} {w} x {w}{stop}" for w in words for stop in ".,"] + [f"{w}." for w in words]
    rows, ends = PieceEncoder(tokenizer_path(name)).encode(texts)
    for k, text in enumerate(texts):
        want = library(name).encode(text, add_special_tokens=False).ids
        assert rows[ends[k] : ends[k + 1], 0].tolist() == want, text


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_of_latin_letters_skip_the_search_for_units(name, monkeypatch):
    encoder = PieceEncoder(tokenizer_path(name))
    texts = ["Été à la plage.\nVoilà, Straße", "the cat sat.\nThe dog, too", "one two one\ntwo", "x"]
    want = [library(name).encode(t, add_special_tokens=False).ids for t in texts]
    seen = []
    monkeypatch.setattr(encoder, "_whole", seen.append)
    rows, ends = encoder.encode(texts)
    assert [rows[a:b, 0].tolist() for a, b in zip(ends, ends[1:])] == want
    assert seen == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_piece_encoder_of_any_mix_of_letters_stops_and_space(name, monkeypatch):
    monkeypatch.setattr("pulsegrid.llm.tokens.CACHED", 300)
    rng = np.random.default_rng(7)
    parts = [*"aAzéÉßÿµªºÀ×÷ .,\n\n  \t\r'09!?«ñİıſς\x1c\x85\xa0\u0301\u2003\u3000日", "'s", "the", "The ", ".\n", ",\n", "ing"]
    encoder, whole = PieceEncoder(tokenizer_path(name)), library(name)
    for _ in range(3):
        texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(500)]
        rows, ends = encoder.encode(texts)
        for k, text in enumerate(texts):
            assert rows[ends[k] : ends[k + 1], 0].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_arrow_knows_the_same_space_as_python():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = pa.compute.match_substring_regex(pa.array(every), SPACE).to_pylist()
    assert [c for c, hit in zip(every, found) if hit] == [c for c in every if re.match(r"\s", c)]


def expected_ids(name, text):
    return np.array([*library(name).encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_token_files_round_trip(spark, odd_docs, no_docs):
    found = sorted(tokenids.round_trip(odd_docs).collect(), key=lambda r: r.start)
    texts = {**dict(enumerate(TEXTS)), None: "no id at all here"}
    at = 0
    assert [r.doc_id for r in found] == [None, *sorted([*range(len(TEXTS)), 5])]
    for r in found:
        ids = expected_ids("byte_bpe_50k.json", texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert tokenids.round_trip(no_docs).count() == 0


def test_section_counts_equal_brute_force(spark, odd_docs, no_docs):
    path = tokenizer_path("byte_bpe_50k.json")
    found = collections.defaultdict(dict)
    for r in section_tokens(odd_docs.dropDuplicates(["doc_id"]), path).collect():
        found[r.doc_id][r.section] = (r.char_start, r.char_end, r.n_tokens, r.n_crossing)
    for k, text in enumerate(TEXTS):
        text = text or ""
        spans = library("byte_bpe_50k.json").encode(text, add_special_tokens=False).offsets
        for a, b, n, crossing in found[k].values():
            own = [e for s, e in spans if a <= s < b]
            assert (n, crossing) == (len(own), sum(e > b for e in own))
        assert "".join(text[a:b] for a, b, _, _ in (found[k][i] for i in range(len(found[k])))) == text
    assert section_tokens(no_docs, path).count() == 0


@pytest.mark.parametrize("length,open_windows,merged", [(4096, 32, 64), (64, 3, 2)])
def test_packing_places_every_id_once(spark, odd_docs, length, open_windows, merged):
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).repartition(5, "doc_id")
    rows = packing.pack(docs, length=length, open_windows=open_windows, merged=merged).collect()
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    for doc, own in pieces.items():
        ids, at = expected_ids("word_bpe_49k.json", TEXTS[doc]), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert len(pieces) == len(TEXTS)


def test_merges_end_when_groups_are_dealt_to_more_partitions(spark, monkeypatch):
    docs = spark.range(48).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text")).repartition(24)
    kind, calls = type(docs), []
    deal = kind.repartition

    def more(self, number, *keys):
        calls.append(number)
        assert len(calls) <= 2
        return deal(self, max(24, number), *keys)

    monkeypatch.setattr(kind, "repartition", more)
    pieces = packing.pack(docs, merged=6).toPandas()
    assert calls == [4, 1]
    assert sorted(pieces["doc_id"].unique()) == list(range(48))


def test_memory_of_a_packing_task_does_not_follow_its_batches():
    code = """
import re, sys
import numpy as np, pyarrow as pa
from pulsegrid.llm import packing
from pulsegrid.llm.tokens import encoder, tokenizer_path
packing.TaskContext = type("One", (), {"get": classmethod(lambda c: c()), "partitionId": lambda self: 0})
path = tokenizer_path("word_bpe_49k.json")
words = np.array(["word%d" % k for k in range(5_000)])
texts = [" ".join(words[np.random.default_rng(k).integers(0, 5_000, 300)]) for k in range(4_000)]
encoder(path).encode([" ".join(words)])
batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "t": texts})
peak = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
before, pieces = peak(), 0
for made in packing._pack(path, 4096, 32)(iter([batch])):
    pieces += made.num_rows
print(peak() - before, pieces)
"""
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    run = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr
    grown, pieces = map(int, run.stdout.split())
    assert pieces >= 4_000
    assert grown < 90, grown


def test_packing_of_odd_tables(odd_docs, no_docs):
    assert packing.pack(odd_docs).select("doc_id").distinct().count() == len(TEXTS) + 1
    assert packing.pack(no_docs).count() == 0


# --- 10: mixing -----------------------------------------------------------------------------------


def test_schedule_of_endless_sources_is_the_pattern_of_their_weights():
    weights = {"a": 7, "b": 3, "c": 1, "d": 2}
    parts = mixing.carried({s: 1000 * w for s, w in weights.items()}, weights)
    slots = [int(x) for _, rounds, part in parts for _ in range(rounds) for x in part[::4]]
    assert len(slots) == 13_000
    given = collections.Counter()
    for t, k in enumerate(slots, 1):
        given[list(weights)[k]] += 1
        assert all(abs(given[x] - t * w / 13) < 1 for x, w in weights.items())


def ideal_after(slots, blocks, weights):
    """Blocks each source has given, by shares of the weights of those that have some left."""
    given, left = dict.fromkeys(blocks, Fraction(0)), Fraction(slots)
    while left:
        total = sum(weights[s] for s in blocks if given[s] < blocks[s])
        time = min((blocks[s] - given[s]) / weights[s] for s in blocks if given[s] < blocks[s])
        time = min(time, left / total)
        given = {s: min(given[s] + weights[s] * time, Fraction(blocks[s])) for s in blocks}
        left = slots - sum(given.values())
    return given


@pytest.mark.parametrize("short", [[1] * 60, [1 + k % 9 for k in range(40)], list(range(1, 25)), []])
def test_deviation_stays_below_one_block_over_all_ends(spark, short):
    blocks = {"src0": 130, "zzz": 90, **{f"m{k:02}": n for k, n in enumerate(short)}}
    weights = {"src0": 4, "m01": 3, "m05": 2}
    rows = [(k * 100 + n, s) for n, s in enumerate(blocks) for k in range(2 * blocks[s])]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    found = mixing.mix(df, weights, block=2).collect()
    slots = {}
    for r in found:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        assert r.release <= r.slot < r.deadline
    assert len(found) == len(rows) and sorted(slots) == list(range(sum(blocks.values())))
    full = {s: weights.get(s, 1) for s in blocks}
    given = dict.fromkeys(blocks, 0)
    for t in range(len(slots)):
        source, block = slots[t]
        assert block == given[source]
        given[source] += 1
        fair = ideal_after(t + 1, blocks, full)
        assert max(abs(given[s] - fair[s]) for s in blocks) < 1


def test_schedule_tables_grow_with_blocks_not_with_sources_squared():
    # Sources that all end at different times, and single blocks of many sources.
    for blocks in ({f"s{k:04}": k + 1 for k in range(300)}, {f"s{k:05}": 1 for k in range(10_000)}):
        stretches, places = mixing.carried_schedule(blocks, dict.fromkeys(blocks, 1))
        assert len(stretches) <= len(places) <= sum(blocks.values())
    # What repeats is held once.
    stretches, places = mixing.carried_schedule({"a": 4_000_000, "b": 1_000_000}, {"a": 4, "b": 1})
    assert len(places) <= 20


@pytest.mark.parametrize("most", [1_000_000, 10])
def test_many_sources_and_large_weights(spark, monkeypatch, most):
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", most)
    rows = [(k, f"s{k % 3000:04}") for k in range(7000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    found = mixing.mix(df, {"s0001": 70_000, "s0002": 90_001}, block=1).collect()
    assert sorted(r.slot for r in found) == list(range(7000))
    assert all(r.release <= r.slot < r.deadline for r in found)
    # Ideally the three blocks of each have been given after 6.2 slots.
    assert max(r.slot for r in found if r.source in ("s0001", "s0002")) <= 6


def test_the_query_and_the_pipeline_carry_lags(spark, tmp_path):
    rows = [(k, "src0") for k in range(0, 320)] + [(1000 + k, f"m{k}") for k in range(40)]
    rows += [(2000 + k, "zzz") for k in range(320)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    order = sorted(queries.op10_mixing(spark, str(tmp_path)).collect(), key=lambda r: (r.slot, r.place))
    # 45 slots are a round of the ideal: src0 gives 4 blocks and every other source 1.
    first = [r.source for r in order if r.slot < 45]
    assert first.count("zzz") >= 16
    mixed = [r.doc_id for r in mixing.mixed(df, queries.MIX).collect()]
    assert mixed == [r.doc_id for r in order]


def test_mixing_keeps_every_row_and_column(odd_docs, no_docs):
    out = mixing.mixed(odd_docs, {None: 2})
    assert out.columns == odd_docs.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, odd_docs.collect()))
    assert mixing.mixed(no_docs).count() == 0


def test_mixing_keeps_columns_that_cannot_be_sorted(odd_docs):
    extra = F.create_map(F.lit("k"), F.col("n_chars"))
    docs = odd_docs.withColumn("m", extra).withColumn("s", F.array(F.struct(extra.alias("m"))))
    out = mixing.mixed(docs)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, docs.collect()))
    keys = docs.select("doc_id", "source")
    assert mixing.mixed(keys.select("doc_id"), source_col="doc_id").count() == keys.count()


# --- queries and pipeline ----------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_queries_equal_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        db.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    ours = queries.QUERIES[name](spark, FOLDER).toArrow()
    assert compare(ours, db.sql(queries.ORACLE_SQL[name]).to_arrow_table()) == "ok"


def test_pipeline_stages(spark, odd_docs):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.schema == docs.schema, name
        odd = stage(spark, odd_docs, FOLDER)
        assert odd.columns == odd_docs.columns, name
        assert odd.count() <= odd_docs.count()
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_sequences_follow_the_mix_over_files(spark, tmp_path):
    # Later files are larger, so a scan would begin with the end of the mix.
    sizes = [2, 3, 5, 8, 12, 20]
    names = [(sum(sizes[:k]) + i, k) for k, n in enumerate(sizes) for i in range(n)]
    for number, (_, k) in enumerate(names):
        text = " ".join(WORDS[(number + i) % 400] for i in range(4200 + 400 * k))
        names[number] = (1000 - number, text, "en", "src0", len(text), k)
    for k in range(len(sizes)):
        part = spark.createDataFrame([n[:5] for n in names if n[5] == k],
                                     "doc_id long, text string, lang string, source string, n_chars long")
        part.coalesce(1).write.parquet(f"{tmp_path}/{k}")
        (file,) = glob.glob(f"{tmp_path}/{k}/part-*.parquet")
        os.makedirs(f"{tmp_path}/mix", exist_ok=True)
        shutil.copy(file, f"{tmp_path}/mix/part-{99_998 + k:05}-x.c000.snappy.parquet")
    docs = spark.read.parquet(f"{tmp_path}/mix")
    first = collections.defaultdict(lambda: 1 << 62)
    for r in corpus_pipeline.pack_sequences(spark, docs, "").collect():
        first[r.doc_id] = min(first[r.doc_id], r.sequence_id)
    assert sorted(first, key=first.get) == [n[0] for n in names]
    assert corpus_pipeline.pack_sequences(spark, docs.limit(0), "").count() == 0


def test_file_order_survives_the_stage_files(spark, odd_docs, tmp_path):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id as doc_id", "repeat('x', cast(id / 20 as int)) as text")
    rows.write.parquet(f"{tmp_path}/rows")
    assert [r.doc_id for r in in_file_order(spark.read.parquet(f"{tmp_path}/rows")).collect()] == list(range(5000))
    assert in_file_order(odd_docs).count() == odd_docs.count()
