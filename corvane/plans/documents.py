"""Queries over the text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import numeric, unicode
from corvane.functions import text as t
from corvane.operators import dedup, gates, leakage, metrics, select, workset
from corvane.plans.catalog import query, table

# The same pieces of SQL for several twins.
_KEY = r"regexp_replace(lower(text), '[^\p{L}\p{N}]', '', 'g')"
_WORDS = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"


@query(
    rf"""
    WITH k AS (SELECT doc_id, lang, source, n_chars, md5({_KEY}) AS key FROM documents)
    SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY lang, key ORDER BY n_chars DESC, doc_id) AS r FROM k) WHERE r <= 2
    """
)
def dedup_keep_best_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.md5(t.text_key(F.col("text"))).alias("key"))
    return dedup.best_k(d, ["lang", "key"], [F.desc("n_chars"), F.asc("doc_id")]).select("doc_id", "lang", "source")


@query(rf"SELECT min(doc_id) AS doc_id, count(*) AS n FROM documents GROUP BY md5({_KEY})")
def first_seen_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(t.text_key(F.col("text"))).alias("key"))
    return d.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")).drop("key")


@query(
    r"""
    WITH m AS (SELECT lang, length(text) AS chars,
        len(regexp_extract_all(text, '[A-Za-z]'))::DOUBLE / nullif(len(regexp_extract_all(text, '\p{L}')), 0) AS ratio,
        regexp_matches(text, '(?i)https?://|www\.') AS url,
        regexp_matches(text, '\b\d{1,2}:\d{2}:\d{2}\b') AS stamp FROM documents),
    r AS (SELECT lang, unnest(list_filter([CASE WHEN chars > 2000 THEN 'too_long' END, CASE WHEN chars < 2 THEN 'too_short' END,
        CASE WHEN lang = 'en' AND ratio < 0.8 THEN 'script_ratio_low' END, CASE WHEN url THEN 'url' END, CASE WHEN stamp THEN 'timestamp' END], lambda x: x IS NOT NULL)) AS reason FROM m)
    SELECT lang, reason, count(*) AS n FROM r GROUP BY ALL
    """
)
def quality_gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's rules that both engines write alike, as a census of reasons."""
    text = F.col("text")
    reasons = F.array_compact(
        F.array(
            F.when(F.length(text) > 2000, "too_long"),
            F.when(F.length(text) < 2, "too_short"),
            F.when((F.col("lang") == "en") & (t.count(text, "[A-Za-z]") / F.nullif(t.letters(text), F.lit(0)) < 0.8), "script_ratio_low"),
            F.when(F.regexp_like(text, F.lit(gates.URL)), "url"),
            F.when(F.regexp_like(text, F.lit(gates.TIMESTAMP)), "timestamp"),
        )
    )
    return gates.reason_census(table(spark, sf_dir, "documents").select("lang", reasons.alias("reasons")), "reasons", "lang")


@query()
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gate: verdicts, scores and reasons of every document (checked against plain Python in the tests)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return gates.gated(d, "text", "lang").select("doc_id", "gate.*")


@query(
    rf"""
    WITH w AS (SELECT doc_id, lang, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: regexp_matches(w, '[\p{{L}}\p{{N}}]')) AS u, length(regexp_replace(text, '^\s+|\s+$', '', 'g')) AS chars FROM documents),
    s AS (SELECT doc_id, lang, CASE WHEN len(u) = 0 THEN 0 ELSE round(0.4 * (CASE WHEN len(list_distinct(u)) >= 2 THEN len(list_distinct(u))::DOUBLE / len(u) ELSE 0 END) + 0.4 * least(len(list_distinct(u)) / 24.0::DOUBLE, 1) + 0.2 * least(chars / 24.0::DOUBLE, 1), 4) END AS richness FROM w)
    SELECT doc_id, lang, round(richness, 3) AS richness FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY richness DESC, doc_id) AS r FROM s) WHERE r <= 20
    """
)
def richness_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", t.richness(F.col("text"), F.col("lang")).alias("richness"))
    return dedup.best_k(d, ["lang"], [F.desc("richness"), F.asc("doc_id")], 20).select("doc_id", "lang", F.round("richness", 3).alias("richness"))


@query(r"SELECT lang, count(*) AS n, round(sum(len(regexp_extract_all(text, '[A-Za-z]')))::DOUBLE / sum(len(regexp_extract_all(text, '\p{L}'))), 6) AS latin_share FROM documents GROUP BY lang")
def script_ratio_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", t.count(F.col("text"), "[A-Za-z]").alias("latin"), t.letters(F.col("text")).alias("letters"))
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.sum("latin") / F.sum("letters"), 6).alias("latin_share"))


@query()
def max_char_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by length of their longest run of one character (back-references: no twin in SQL)."""
    d = table(spark, sf_dir, "documents").select("lang", t.longest_run(F.col("text")).alias("run"))
    return d.groupBy("lang", "run").agg(F.count("*").alias("n"))


@query(
    r"""
    SELECT source, count(*) FILTER (regexp_matches(text, '<[^>]+>')) AS tags, count(*) FILTER (regexp_matches(text, '(?i)https?://|www\.')) AS urls,
      count(*) FILTER (regexp_matches(text, '[\w.]+@[\w.]+')) AS mails, count(*) FILTER (regexp_matches(text, '\d{3}[-.]\d{3,4}[-.]\d{4}')) AS phones, count(*) AS n FROM documents GROUP BY source
    """
)
def artifact_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = lambda p: F.regexp_like("text", F.lit(p))
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count_if(has("<[^>]+>")).alias("tags"), F.count_if(has(gates.URL)).alias("urls"), F.count_if(has(r"[\w.]+@[\w.]+")).alias("mails"), F.count_if(has(r"\d{3}[-.]\d{3,4}[-.]\d{4}")).alias("phones"), F.count("*").alias("n"))


@query(
    r"""
    WITH c AS (SELECT doc_id, lang, len(regexp_extract_all(text, '[A-Za-z]')) AS latin, len(regexp_extract_all(text, '\p{L}')) AS letters FROM documents),
    g AS (SELECT doc_id, lang, CASE WHEN latin >= 3 AND latin >= 0.35 * letters THEN 'en' END AS guess FROM c)
    SELECT doc_id, lang, guess FROM g WHERE guess IS NOT NULL AND guess <> lang
    """
)
def language_vote_contradiction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose scripts vote for another language than their label."""
    # A filter moves below a projection and computes the vote again for each mention, but not below a row number.
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", t.script_language(F.col("text")).alias("guess"), F.monotonically_increasing_id().alias("at"))
    return d.where("at >= 0 and guess is not null and guess <> lang").drop("at")


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON d.text = b.text")
def leak_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are a benchmark item, met by digest so that no text is shuffled twice."""
    d, b = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return d.select("doc_id", F.sha2("text", 256).alias("k")).join(b.select("item_id", F.sha2("text", 256).alias("k")), "k").select("doc_id", "item_id")


@query(
    rf"""
    WITH d AS (SELECT doc_id, unnest([{{'kind': 'key', 'value': md5({_KEY})}}, {{'kind': 'head', 'value': md5(substr(text, 1, 40))}}]) AS k FROM documents),
    b AS (SELECT item_id, unnest([{{'kind': 'key', 'value': md5({_KEY})}}, {{'kind': 'head', 'value': md5(substr(text, 1, 40))}}]) AS k FROM benchmark)
    SELECT DISTINCT doc_id AS row, item_id AS other, d.k.kind AS kind FROM d JOIN b ON d.k = b.k
    """
)
def leak_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches between documents and the benchmark by either of two typed identities."""
    ids = leakage.identities(key=F.md5(t.text_key(F.col("text"))), head=F.md5(F.substring("text", 1, 40)))
    d, b = (table(spark, sf_dir, n).withColumnRenamed(i, "id") for n, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    return leakage.typed_leaks(d, b, "id", ids)


@query("WITH l AS (SELECT lang, source, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT md5(line) AS line, count(DISTINCT lang) AS n_groups, count(*) AS n_rows FROM l GROUP BY line HAVING count(DISTINCT lang) > 1")
def cross_group_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand in documents of several languages."""
    d = table(spark, sf_dir, "documents").select("lang", F.explode(F.split("text", "\n", -1)).alias("line")).select("lang", F.md5("line").alias("line"))
    return leakage.conflicts(d, "line", "lang")


@query(
    """
    WITH o AS (SELECT d.doc_id, CASE WHEN length(text) >= 100 THEN md5(text) END AS clip, coalesce(quality, 1) = 1 AS ok FROM documents d LEFT JOIN labels l USING (doc_id)),
    c AS (SELECT clip, arg_max(doc_id, (ok::INT, -doc_id)) AS rep, bool_or(ok) AS usable FROM o WHERE clip IS NOT NULL GROUP BY clip),
    e AS (SELECT DISTINCT md5(text) AS clip FROM documents WHERE doc_id % 20 = 7),
    f AS (SELECT CASE WHEN rep IS NULL THEN 'source_invalid' WHEN e.clip IS NOT NULL THEN 'eval_excluded' WHEN doc_id <> rep THEN 'duplicate' WHEN NOT usable THEN 'blocked' ELSE 'eligible' END AS disposition
          FROM o LEFT JOIN c USING (clip) LEFT JOIN e USING (clip))
    SELECT disposition, count(*) AS n FROM f GROUP BY disposition
    """
)
def disposition_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fates of documents as occurrences of clips (equal texts); bad labels stand for invalid durations, short texts have no key."""
    d = table(spark, sf_dir, "documents")
    rows = d.join(table(spark, sf_dir, "labels"), "doc_id", "left").select("doc_id", F.when(F.length("text") >= 100, F.md5("text")).alias("clip"), F.lit("t").alias("text"), F.lit(1.0).alias("quality"), F.when(F.coalesce("quality", F.lit(1)) == 1, F.lit(1.0)).alias("duration"), F.when(F.col("quality") == 0, F.array(F.lit("invalid_duration"))).alias("errors"))
    clips = workset.representatives(rows, "clip", "doc_id", ["doc_id"])
    fate = workset.dispositions(rows, clips, d.where("doc_id % 20 = 7").select(F.md5("text").alias("clip")), "clip", "doc_id")
    return fate.groupBy("disposition").agg(F.count("*").alias("n"))


@query("SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id)::INTEGER AS turn FROM documents")
def interleave_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.interleave(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", ["doc_id"])


@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS r FROM documents) WHERE r <= 25")
def source_quota_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return select.capped(d, "source", [F.desc("n_chars"), F.asc("doc_id")], 25).select("doc_id", "source")


@query()
def placement_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-first batch placement by language: order-dependent, checked against plain Python in the tests."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5(t.text_key(F.col("text"))).alias("key"), (-F.col("n_chars")).alias("order"))
    return select.place(d, "lang", ["order", "doc_id"], "source", "key", "doc_id", batch_size=50, source_cap=0.2).select("doc_id", "lang", "outcome", "batch")


@query()
def greedy_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation packed in order under a budget of longest times count."""
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return select.greedy_packs(d, "conv_id", "turn", "n", budget=4000, cap=4)


@query(
    """
    SELECT axis, value, n, errors, round(errors::DOUBLE / n, 6) AS rate FROM (
      SELECT 'all' AS axis, 'all' AS value, count(*) AS n, sum((quality = toxic)::INT)::BIGINT AS errors FROM labels JOIN documents USING (doc_id)
      UNION ALL SELECT 'lang', lang, count(*), sum((quality = toxic)::INT)::BIGINT FROM labels JOIN documents USING (doc_id) GROUP BY lang
      UNION ALL SELECT 'source', source, count(*), sum((quality = toxic)::INT)::BIGINT FROM labels JOIN documents USING (doc_id) GROUP BY source)
    """
)
def grouped_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios of sums over all rows, by language and by source, in one pass."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id").withColumn("error", (F.col("quality") == F.col("toxic")).cast("int"))
    return metrics.by_axes(d, ["lang", "source"], [F.count("*").alias("n"), F.sum("error").alias("errors"), F.round(F.sum("error") / F.count("*"), 6).alias("rate")])


@query("SELECT quality AS expected, count(*) FILTER (toxic = 0) AS \"0\", count(*) FILTER (toxic = 1) AS \"1\", count(*) AS support, round(count(*) FILTER (toxic = quality) / count(*)::DOUBLE, 6) AS recall FROM labels GROUP BY quality")
def confusion_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "labels").select(F.col("quality").alias("expected"), "toxic")
    return metrics.confusion(d, "expected", "toxic", [0, 1]).select("expected", "0", "1", F.col("support"), F.round("recall", 6).alias("recall"))


_SCORED = "WITH s AS (SELECT quality AS y, least(greatest(length(text) / 4000.0::DOUBLE, 0), 1) AS c FROM labels JOIN documents USING (doc_id))"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a score derived from length, as a stand-in for a model's confidence."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n")), "doc_id")
    return d.select("doc_id", F.col("quality").alias("y"), F.least(F.col("n") / 4000.0, F.lit(1.0)).alias("c"))


@query(_SCORED + ", b AS (SELECT least(9, floor(c * 10)) AS bin, count(*) AS n, avg(c) AS c, avg(y) AS y FROM s GROUP BY 1) SELECT round(sum(n * abs(c - y)) / sum(n), 6) AS ece, sum(n)::BIGINT AS n FROM b")
def calibration_ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.calibration_error(_scored(spark, sf_dir), "c", F.col("y") == 1).select(F.round("ece", 6).alias("ece"), "n")


@query(
    _SCORED
    + """, n AS (SELECT c, count(*) AS n, sum(1 - y) AS e FROM s GROUP BY c), t AS (SELECT c, sum(n) OVER w AS n, sum(e) OVER w AS e FROM n WINDOW w AS (ORDER BY c DESC)),
    r AS (SELECT c, e / n::DOUBLE AS risk FROM t) SELECT round(coalesce(min(c) FILTER (risk <= 0.1), arg_min(c, risk)), 6) AS threshold, bool_or(risk <= 0.1) AS met FROM r"""
)
def threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = metrics.threshold(_scored(spark, sf_dir), "c", F.col("y") == 1, 0.1)
    return out.select(F.round("threshold", 6).alias("threshold"), "met")


@query(
    """
    WITH g AS (SELECT lang, count(*)::DOUBLE AS n, sum(toxic)::DOUBLE AS e FROM labels JOIN documents USING (doc_id) GROUP BY lang), k AS (SELECT *, e / n AS p, 1.959963984540054 AS z FROM g)
    SELECT lang, n::BIGINT AS n, e::BIGINT AS errors, round(least(1, (p + z * z / (2 * n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)), 6) AS upper FROM k
    """
)
def wilson_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id").groupBy("lang").agg(F.count("*").alias("n"), F.sum("toxic").alias("errors"))
    return d.withColumn("upper", F.round(numeric.wilson_upper(F.col("errors"), F.col("n")), 6))


@query()
def bootstrap_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of toxic labels with a 95% interval by resampling sources whole."""
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id").withColumn("one", F.lit(1))
    return metrics.bootstrap(d, "source", "toxic", "one")


@query(
    r"""
    WITH RECURSIVE t AS (SELECT doc_id, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents), u AS (SELECT doc_id, md5(line) AS k FROM t WHERE length(line) >= 20),
    m AS (SELECT k, min(doc_id) AS b FROM u GROUP BY k HAVING count(*) > 1), e AS (SELECT DISTINCT doc_id AS a, b FROM u JOIN m USING (k)), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    walk(a, r) AS (SELECT DISTINCT a, a FROM s UNION SELECT s.b, walk.r FROM walk JOIN s ON walk.a = s.a)
    SELECT d.doc_id, coalesce(min(r), d.doc_id) AS family FROM documents d LEFT JOIN walk ON walk.a = d.doc_id GROUP BY d.doc_id
    """
)
def components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of documents connected through shared lines of 20 characters or more."""
    d = table(spark, sf_dir, "documents")
    tokens = F.transform(F.filter(F.array_distinct(F.split("text", "\n", -1)), lambda x: F.length(x) >= 20), lambda x: F.md5(x))
    return dedup.families(d.select("doc_id", "text"), "doc_id", tokens)


@query()
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents of one language and source whose matching ratio is 0.92 or more (a ratio of sequences has no SQL twin)."""
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text", ["lang", "source"], 0.92)


@query("SELECT doc_id % 16 AS part, count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM documents GROUP BY 1")
def hash_partition_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy((F.col("doc_id") % 16).alias("part")).agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_ids"))


@query(r"SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n_text, len(regexp_extract_all(html, '<[^>]+>')) AS n_tags FROM pages")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.length(t.strip_html(F.col("html"))).cast("bigint").alias("n_text"), t.count(F.col("html"), "<[^>]+>").alias("n_tags"))


@query(r"SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '[?]([^#]*)', 1) AS query FROM pages")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(u, "^([a-z]+)://", 1).alias("scheme"), F.regexp_extract(u, "://([^/?#]*)", 1).alias("host"), F.regexp_extract(u, r"\?([^#]*)", 1).alias("query"))


@query("SELECT doc_id, nfc_normalize(text) = text AS composed FROM documents")
def unicode_composed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", (unicode.nfc(F.col("text")) == F.col("text")).alias("composed"))


@query(r"SELECT doc_id, length(trim(regexp_replace(regexp_replace(regexp_replace(text, '<[^>]{0,200}>', ' ', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', ' ', 'g'), '\s+', ' ', 'g'))) AS n FROM documents WHERE lang IN ('en', 'de')")
def normalize_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of the normalised text (languages without rules of their own; invisible marks do not occur here)."""
    d = table(spark, sf_dir, "documents").where("lang in ('en', 'de')")
    return d.select("doc_id", F.length(t.normalize(F.col("text"), F.col("lang"))).cast("bigint").alias("n"))


@query(r"SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '\d+'))) AS numbers FROM documents WHERE regexp_matches(text, '\d')")
def numbers_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(r"(\d+)"), F.lit(1))
    return table(spark, sf_dir, "documents").where(F.regexp_like("text", F.lit(r"\d"))).select("doc_id", F.array_sort(F.array_distinct(found)).alias("numbers"))


@query("WITH t AS (SELECT conv_id, count(*) AS turns, count(*) FILTER (role = 'user') AS users, max(turn) AS last FROM conversations GROUP BY conv_id) SELECT turns, count(*) AS conversations, sum(users)::BIGINT AS user_turns, count(*) FILTER (last + 1 = turns) AS gapless FROM t GROUP BY turns")
def conversation_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("role") == "user").alias("users"), F.max("turn").alias("last"))
    return c.groupBy("turns").agg(F.count("*").alias("conversations"), F.sum("users").alias("user_turns"), F.count_if(F.col("last") + 1 == F.col("turns")).alias("gapless"))


@query("SELECT lang, least(9, n_chars // 500) AS bin, count(*) AS n FROM documents GROUP BY ALL")
def length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.histogram(table(spark, sf_dir, "documents"), "n_chars", [500.0 * i for i in range(1, 10)], "lang").select("lang", F.col("bin").cast("bigint").alias("bin"), "n")


@query(rf"SELECT lang, source, sum({_WORDS})::BIGINT AS words, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def word_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("lang", "source", F.size(t.words(F.col("text"))).alias("w"))
    return d.rollup("lang", "source").agg(F.sum("w").alias("words"), F.count("*").alias("n"))


@query()
def word_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit counts of each benchmark item against the next one's text."""
    b = table(spark, sf_dir, "benchmark")
    n = b.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("next"))
    return b.join(n, "item_id").select("item_id", unicode.error_counts(F.col("text"), F.col("next")).alias("e")).select("item_id", "e.*")

