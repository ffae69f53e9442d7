"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import html, lines, mixing, ngram, ogg, packing, quality, substring, topk, urls
from corvane.llm._spark import table

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of near copies (word 5-grams, Jaccard 0.8) and its number of links."""
    return ngram.join(table(spark, sf_dir, "documents")).drop("text_key")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), ids=False)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), keep=("doc_id",)).select("doc_id", "source", "size", "source_size", "target", "taken")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, net).drop("text")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", (F.col("vec_id") % 100 == 0).alias("query"))
    return topk.top_k(v, "query")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"), texts=False)


def op9_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ogg.media(table(spark, sf_dir, "documents"), stored=False)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the lines that repeat, exactly or nearly, an earlier line."""
    return lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_packing, op3_url_filter, op4_mixing, op5_html, op6_quality, op7_topk, op8_substring, op9_ogg, op10_line_dedup)}

SQL = {
    "op3_url_filter": r"""
WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(rh, rp, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (SELECT page_id, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rh) DESC, length(rp) DESC) AS k
        FROM parts JOIN rules ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp))
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts p LEFT JOIN fit f ON p.page_id = f.page_id AND k = 1
""",
    "op7_topk": r"""
WITH t AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM t q JOIN t c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 10
""",
}
