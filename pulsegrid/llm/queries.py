"""The operators as queries over the given tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.text import let
from pulsegrid.llm import linerules, mixing, packing, quality, tokenids, warc
from pulsegrid.llm.common import table
from pulsegrid.llm.fim import fill_in_middle, restored
from pulsegrid.llm.neardup import near_duplicates
from pulsegrid.llm.runs import periodic_runs
from pulsegrid.llm.tokencounts import section_tokens
from pulsegrid.llm.tokens import tokenizer_path
from pulsegrid.llm.topk import top_k
from pulsegrid.llm.toxicity import fit_toxicity, held_out, toxicity
from pulsegrid.llm.vectors import near_vectors

#: Target weights of the mix; sources that are not named have weight 1.
MIX = {"src0": 4, "src1": 2, "src2": 2}


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_neardup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op4_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(table(spark, folder, "embeddings"), threshold=0.98)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit_toxicity(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", toxicity(model, F.col("text")).alias("score"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op6_tokenids(spark: SparkSession, folder: str) -> DataFrame:
    return tokenids.round_trip(table(spark, folder, "documents"))


def op7_tokencounts(spark: SparkSession, folder: str) -> DataFrame:
    return section_tokens(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit_quality(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", quality.quality(model, docs).alias("s"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "s.*",
        F.when(F.col("s.score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), MIX)


def woven(key: Column, text: Column) -> Column:
    """A tenth of the texts, by a hash of the id, repeat a stretch of words from some place on."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words)
        first = F.pmod(g, n)
        period = 1 + F.floor((n - first) / (3 + F.pmod(g, F.lit(8))))
        places = F.sequence(first, n - 1)
        later = F.transform(places, lambda i: F.get(words, (first + F.pmod(i - first, period)).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), first.cast("int")), later), " ")

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    repeated = let(words, lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(text))
    return F.when(h % 10 == 0, repeated).otherwise(text)


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", woven(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    # Runs are sorted by start and period, so the first of equal ones wins.
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.reduce("runs", none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    marked = linerules.mark_lines(docs, linerules.fit_lines(docs, table(spark, folder, "labels")))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~failed & (F.col("content_share") >= linerules.LEAST_CONTENT)
    return marked.select(
        F.col("id").alias("doc_id"), *linerules.COUNTS, failed.alias("base_failed"), kept.alias("kept"),
        "n_lines", "content_share",
    )


def op13_fim(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle(table(spark, folder, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    f.__name__: f
    for f in (op1_topk, op2_neardup, op3_warc, op4_vectors, op5_toxicity, op6_tokenids,
              op7_tokencounts, op8_quality, op9_packing, op10_mixing, op11_runs, op12_rules, op13_fim)
}

REACH = """reach as (
    select {id} as node, {id} as root from nodes
    union
    select p.y, r.root from reach r join links p on p.x = r.node
)"""

ORACLE_SQL = {
    "op1_topk": """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
    where embedding is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as materialized (
    select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
    from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0
), r as (
    select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op2_neardup": r"""
with recursive w as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from documents
), s as materialized (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from w
), nodes as materialized (select doc_id, len(s)::bigint as n from s
), flat as materialized (select doc_id, hash(unnest(s)) as sh from s
), pairs as (
    select a.doc_id as x, b.doc_id as y, count(*) as c from flat a join flat b using (sh)
    where a.doc_id <> b.doc_id group by all
), links as materialized (
    select x, y from pairs join nodes a on a.doc_id = x join nodes b on b.doc_id = y
    where 100 * c >= 85 * (a.n + b.n - c)
), """ + REACH.format(id="doc_id") + """
select doc_id, n as n_shingles, c as component_id, doc_id = c as kept
from nodes join (select node, min(root) as c from reach group by node) on node = doc_id""",
    "op3_warc": """
with p as (
    select page_id, coalesce(html, '') as h from pages
), d as (
    select page_id, strlen(h)::bigint as payload_bytes, sha256(h) as payload_digest,
        min(page_id) over (partition by sha256(h)) as first from p
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 100 and first < page_id then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 100 and first < page_id then first end as refers_to
from d""",
    "op4_vectors": """
with recursive nodes as (
    select vec_id, label, embedding::double[] as e,
        embedding is not null and label is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0 as fits
    from embeddings
), links as materialized (
    select a.vec_id as x, b.vec_id as y from nodes a join nodes b
    on a.label = b.label and a.vec_id <> b.vec_id and a.fits and b.fits and len(a.e) = len(b.e)
    where list_cosine_similarity(a.e, b.e) >= 0.98
), """ + REACH.format(id="vec_id") + """, c as (
    select node, min(root) as component_id from reach group by node
), n as (select x, count(*) as n_links from links group by x)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from nodes join c on node = vec_id left join n on x = vec_id""",
    "op13_fim": """
with d as (
    select doc_id, coalesce(text, '') as text, length(coalesce(text, ''))::bigint as n,
        sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), h as (
    select doc_id, text, n, ('0x' || h[1:8])::bigint % (n + 1) as c1, ('0x' || h[9:16])::bigint % (n + 1) as c2,
        ('0x' || h[17:24])::bigint % 100 as h3, ('0x' || h[25:32])::bigint % 100 as h4 from d
), f as (
    select doc_id, text, n, least(c1, c2) as a, greatest(c1, c2) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 >= 90
            then 'plain' when h4 < 20 then 'spm' else 'psm' end as form from h
), p as (
    select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1) as suffix
    from f
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
    case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(text) as restored_sha256
from p""",
}
