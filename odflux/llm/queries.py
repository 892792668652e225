"""Queries of the corpus operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflux.llm import alignment, bpe, embedding_dedup, jaccard_join, mixing, phrase_dedup, pii, quality, ranked_search, reshard, secrets, toxicity, url_rules
from workload.registry import Query

LLM_QUERIES: dict[str, Query] = {}
LLM_SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def enter(function: Query) -> Query:
        LLM_QUERIES[name] = function
        if sql is not None:
            LLM_SQL[name] = sql
        return function

    return enter


@query("op1_relative_parse")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = phrase_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return parsed.select("doc_id", "n_words", "n_removed", kept, F.size("factors").alias("n_factors"))


@query("op2_anchor_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [f"n_{kind}" for kind in pii.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


OLD_SHARDS, NEW_SHARDS = 12, 16


@query("op3_flow_reshard")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = reshard.reshard(docs, F.pmod(F.xxhash64("doc_id"), F.lit(OLD_SHARDS)), NEW_SHARDS, ["size", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


MIXTURE = mixing.Target(entropy=0.5)


@query("op4_temperature_mix")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, MIXTURE).select(
        "doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_epoch").alias("epoch"), F.col("mix_start").alias("start")
    )


RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

OP5_SQL = """
WITH parts AS (
    SELECT page_id,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
    FROM pages
), split AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
    FROM parts
), rules(h, p, v) AS (
    VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
        ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
    SELECT page_id, host, path, max_by(struct_pack(r := h || p, v := v), length(h || p)) AS b
    FROM split LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    GROUP BY ALL
)
SELECT page_id, host, path, b.r AS rule, coalesce(b.v, 'allow') AS verdict FROM best
"""


@query("op5_range_rules", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


@query("op6_chosen_path")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = """
WITH usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
), pairs AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
    SELECT a, b FROM pairs UNION SELECT reach.a, pairs.b FROM reach JOIN pairs ON reach.b = pairs.a
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
counted AS (SELECT a, count(DISTINCT b) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id,
    vec_id <= coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON vec_id = counted.a LEFT JOIN least ON vec_id = least.a
""".replace("WITH usable", "WITH RECURSIVE usable")


@query("op7_int8_tiles", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_weak_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))


@query("op9_trie_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, path))


@query("op10_line_crf")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.quality(docs, quality.train_field(docs, labels))


OP11_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
    FROM documents
), corpus AS (
    SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d
), i AS (
    SELECT row_number() OVER () AS i, item_id,
        unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), q AS (
    SELECT i, item_id, term, count(*) AS times FROM i GROUP BY ALL
), held AS (
    SELECT k, doc_id, n, term, count(*) AS tf
    FROM (SELECT k, doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL
), weighted AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM held, corpus GROUP BY term, n_docs
), scored AS (
    SELECT i, item_id, k, doc_id,
        CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM q JOIN held USING (term) JOIN weighted USING (term), corpus GROUP BY ALL
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, k) AS rank, doc_id, score
    FROM scored WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op11_mask_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked_search.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op12_char_network")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [f"n_{kind}" for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans", "doubted")


SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@query("op13_span_align")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment.score_links(docs, public_tokenizers.path(SIDE_A), public_tokenizers.path(SIDE_B))
