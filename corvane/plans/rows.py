"""One query for one operator each: small rules and text functions over whole tables, with SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import numeric, rules, signal, unicode
from corvane.functions import text as t
from corvane.operators import audit, corrections, evaluate, gates, planning
from corvane.plans.catalog import query, table


def _documents(spark: SparkSession, sf_dir: str, *columns) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


# --- gate rules -------------------------------------------------------------

#: What is put after each text, by id, so that every rule meets some rows.
TAILS = [" [cough] ", " M: hello", " see www.x", " 1:02:03 ", " �", " SPEAKER 2: hi", ""]


def _tailed():
    return F.concat("text", F.element_at(F.array(*map(F.lit, TAILS)), (F.col("doc_id") % len(TAILS) + 1).cast("int")))


TAILED = "(SELECT doc_id, lang, text || ([" + ", ".join(f"'{x}'" for x in TAILS) + f"])[(doc_id % {len(TAILS)} + 1)::INT] AS text FROM documents)"


@query(rf"SELECT doc_id, regexp_matches(text, '\[[^\]\n]{{1,40}}\]') AS hit FROM {TAILED}")
def gate_noise_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.regexp_like(_tailed(), F.lit(gates.NOISE)).alias("hit"))


@query(rf"SELECT doc_id, regexp_matches(text, '(?i)(?:https?://|www\.)\S+') AS hit FROM {TAILED}")
def gate_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.regexp_like(_tailed(), F.lit(gates.URL)).alias("hit"))


@query(rf"SELECT doc_id, regexp_matches(text, '(?i)(?:^|\s)(?:SPEAKER|SPK|MALE|FEMALE|M|F)\s*[:#]?\s*\d*\s*[:|]') AS hit FROM {TAILED}")
def gate_speaker_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.regexp_like(_tailed(), F.lit(gates.SPEAKER)).alias("hit"))


@query(rf"SELECT doc_id, regexp_matches(text, '\b\d{{1,2}}:\d{{2}}:\d{{2}}\b') AS hit FROM {TAILED}")
def gate_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.regexp_like(_tailed(), F.lit(gates.TIMESTAMP)).alias("hit"))


@query(rf"""
    SELECT doc_id, array_to_string(list_filter(list_sort([
      CASE WHEN contains(text, chr(65533)) THEN 'replacement_char' ELSE '' END,
      CASE WHEN regexp_matches(text, '\[[^\]\n]{{1,40}}\]') THEN 'noise_marker' ELSE '' END,
      CASE WHEN regexp_matches(text, '(?i)(?:https?://|www\.)\S+') THEN 'url' ELSE '' END,
      CASE WHEN regexp_matches(text, '(?i)(?:^|\s)(?:SPEAKER|SPK|MALE|FEMALE|M|F)\s*[:#]?\s*\d*\s*[:|]') OR regexp_matches(text, '\b\d{{1,2}}:\d{{2}}:\d{{2}}\b') THEN 'speaker_label_or_timestamp' ELSE '' END,
      CASE WHEN NOT regexp_matches(text, '\p{{L}}') THEN 'no_letters' ELSE '' END]), lambda x: x <> ''), ',') AS reasons FROM {TAILED}
""")
def gate_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reasons of contamination as the whole gate gives them; a blank text, which it calls empty, has no letters."""
    wanted = ["no_letters", "noise_marker", "replacement_char", "speaker_label_or_timestamp", "url"]
    d = gates.gated(table(spark, sf_dir, "documents").select("doc_id", "lang", _tailed().alias("text")), "text", "lang")
    reasons = F.transform("gate.reasons", lambda r: F.when((r == "empty_text") & F.col("text").isNotNull(), "no_letters").otherwise(r))
    return d.select("doc_id", F.array_join(F.array_intersect(F.array(*map(F.lit, wanted)), reasons), ",").alias("reasons"))


@query(r"""
    SELECT doc_id, CASE WHEN lang IN ('ar', 'en', 'hi', 'ml') THEN len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))
      ELSE CASE WHEN len(regexp_extract_all(text, '[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]')) > 0 THEN len(regexp_extract_all(text, '[\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}]')) ELSE length(text) END END AS units
    FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'zh' ELSE lang END AS lang, CASE WHEN doc_id % 6 = 0 THEN text || '語語' ELSE text END AS text FROM documents)
""")
def scoring_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang, text = F.when(F.col("doc_id") % 3 == 0, "zh").otherwise(F.col("lang")), F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("語語"))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", lang.alias("lang"), text.alias("text")).select("doc_id", t.unit_count(F.col("text"), F.col("lang")).alias("units"))


# --- text cleaning, one step each -------------------------------------------


@query("SELECT doc_id, md5(text || 'x') AS out FROM documents")
def control_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.md5(t.strip_control(F.concat(F.lit("\x07"), "text", F.lit("\x9bx\x00")))).alias("out"))


@query("SELECT doc_id, md5(regexp_replace('<b class=\"x\">' || text || '</b>', '<[^>]+>', '', 'g')) AS out FROM documents")
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.md5(t.strip_html(F.concat(F.lit('<b class="x">'), "text", F.lit("</b>")))).alias("out"))


@query("SELECT doc_id, lang || '-' || repeat('a', CASE WHEN doc_id % 9 >= 5 THEN 3 ELSE doc_id % 9 END) || '!' || repeat('7', doc_id % 8) AS out FROM documents")
def run_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, t.collapse_runs(F.concat("lang", F.lit("-"), F.expr("repeat('a', int(doc_id % 9))"), F.lit("!"), F.expr("repeat('7', int(doc_id % 8))"))).alias("out"))


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace('  ' || text || E'\t \n\n\n\n' || lang, '[ \t]+', ' ', 'g'), '\n{3,}', E'\n\n', 'g'), '^\s+|\s+$', '', 'g')) AS out FROM documents")
def space_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.md5(t.collapse_space(F.concat(F.lit("  "), "text", F.lit("\t \n\n\n\n"), "lang"))).alias("out"))


@query("SELECT doc_id, md5(text || lang) AS out FROM documents")
def tatweel_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, F.md5(t.remove_tatweel(F.concat("text", F.lit("ــ"), "lang"))).alias("out"))


@query("SELECT doc_id, CASE WHEN doc_id % 5 + doc_id % 3 = 0 THEN 0 ELSE (doc_id % 5) / (doc_id % 5 + doc_id % 3)::DOUBLE END AS share FROM documents")
def arabic_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, t.arabic_ratio(F.expr("concat(repeat('ب', int(doc_id % 5)), ' 1 ', repeat('a', int(doc_id % 3)))")).alias("share"))


@query("SELECT doc_id, 'ب' || lang AS out FROM documents")
def marks_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, t.strip_marks(F.concat(F.lit("بَّ"), "lang")).alias("out"))


@query("SELECT doc_id, doc_id % 4 AS n FROM documents")
def marks_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, t.mark_count(F.expr("concat('ب', repeat('َ', int(doc_id % 4)), lang)")).cast("bigint").alias("n"))


@query("SELECT doc_id, doc_id % 4 > 0 AS marked FROM documents")
def marks_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, t.has_marks(F.expr("concat('ب', repeat('َ', int(doc_id % 4)), lang)")).alias("marked"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'beta,' || lang ELSE 'alpha,' || lang END AS lost FROM documents")
def lost_latin_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 2 == 0, "ALPHA").otherwise("beta gamma")
    return _documents(spark, sf_dir, F.array_join(t.lost_latin(text, F.concat(F.lit("Alpha Beta "), "lang")), ",").alias("lost"))


# --- numbers ----------------------------------------------------------------


@query("SELECT o_orderkey, o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 AS mixed FROM orders")
def digit_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("n "), F.when(F.col("o_orderkey") % 2 == 0, "12").otherwise(""), F.when(F.col("o_orderkey") % 3 == 0, " ٣").otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", t.mixed_digits(text).alias("mixed"))


@query("SELECT o_orderkey, (o_orderkey::BIGINT * 1000000 > 1000000000)::BIGINT AS n FROM orders")
def large_number_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("about "), (F.col("o_orderkey").cast("bigint") * 1_000_000).cast("string"), F.lit(" of 12"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(t.large_numbers(text)).cast("bigint").alias("n"))


@query("SELECT o_orderkey, coalesce((o_orderkey % 33) BETWEEN 1 AND ([31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[(o_orderkey % 14)::INT], false) AS valid FROM (SELECT o_orderkey FROM orders WHERE o_orderkey % 14 BETWEEN 1 AND 12) UNION ALL SELECT o_orderkey, false FROM orders WHERE o_orderkey % 14 NOT BETWEEN 1 AND 12")
def month_day_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(t.valid_month_day((k % 14).cast("int"), (k % 33).cast("int")), F.lit(False)).alias("valid"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey + 1000000)::VARCHAR ELSE '' END AS dropped FROM orders")
def number_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = (F.col("o_orderkey") + 1_000_000).cast("string")
    text = F.when(F.col("o_orderkey") % 2 == 0, F.lit("a 5 b")).otherwise(F.concat(F.lit("a 5 b "), big))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(t.dropped_numbers(text, F.concat(F.lit("a 5 b "), big)), ",").alias("dropped"))


# --- decision rules, one solver each ----------------------------------------


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'insufficient' WHEN (o_orderkey % 50) * 1000 <= o_orderkey % 9000 THEN 'true' ELSE 'false' END AS answer FROM orders")
def rule_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.compare(F.when(k % 7 != 0, k % 50), F.lit(1000), "<=", k % 9000, F.lit(1)).alias("answer"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'insufficient' WHEN (o_orderkey % 50) * 12 >= o_orderkey % 900 THEN 'covers' ELSE 'short' END AS answer FROM orders")
def rule_instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.instalments(F.when(k % 7 != 0, k % 50), F.lit(12), k % 900).alias("answer"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 OR o_orderstatus = 'F' THEN 'eligible' WHEN o_orderkey % 7 = 0 THEN 'insufficient' ELSE 'ineligible' END AS answer FROM orders")
def rule_policy_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    unstated = F.when(F.col("o_orderkey") % 7 != 0, F.lit(False))
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.policy([F.col("o_totalprice") > 200_000, F.col("o_orderstatus") == "F", unstated], every=False).alias("answer"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 AND o_orderstatus = 'F' THEN 'block' WHEN o_totalprice > 100000 AND o_orderkey % 7 = 0 THEN 'escalate' WHEN o_totalprice > 100000 THEN 'warn' ELSE 'allow' END AS answer FROM orders")
def rule_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    dear, unstated = F.col("o_totalprice") > 100_000, F.when(F.col("o_orderkey") % 7 != 0, F.lit(True))
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.safety([([F.col("o_totalprice") > 200_000, F.col("o_orderstatus") == "F"], "block"), ([dear, unstated], "warn")], "allow").alias("answer"))


@query("""
    WITH w AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS w FROM part),
    n AS (SELECT p_partkey, len(list_intersect(w, ['red', 'blue', 'green'])) AS a, len(list_intersect(w, ['widget', 'steel', 'green'])) AS b FROM w)
    SELECT p_partkey, CASE WHEN a = 0 AND b = 0 THEN 'other' WHEN a >= b THEN 'colour' ELSE 'matter' END AS intent FROM n
""")
def rule_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", rules.route(F.split(F.lower("p_name"), " "), {"colour": ["red", "blue", "green"], "matter": ["widget", "steel", "green"]}).alias("intent"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 2 = 0 ELSE o_orderstatus = 'O' AND NOT o_orderkey % 2 = 0 END AS holds FROM orders")
def rule_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    claimed, actual = F.when(k % 5 != 0, "O"), F.when(k % 2 != 0, F.when(k % 5 == 0, "x").otherwise(F.col("o_orderstatus")))
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.slot(claimed, actual).alias("holds"))


@query("SELECT o_orderkey, CASE WHEN (CASE WHEN o_totalprice > 100000 THEN 3 ELSE 0 END) + (CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END) >= 5 THEN 2 WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS level FROM orders")
def rule_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.triage([(F.col("o_totalprice") > 100_000, 3), (F.col("o_orderstatus") == "F", 2)], [0, 3, 5]).alias("level"))


@query("SELECT o_orderkey, o_orderkey % 3 <> 0 AND o_orderkey % 4 < 2 AS same FROM orders")
def rule_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    said = F.when(k % 4 < 2, k * 1000).otherwise(k * 1000 + 1)
    return table(spark, sf_dir, "orders").select("o_orderkey", rules.readback(k, F.lit(1000), F.when(k % 4 != 1, said).otherwise(k * 1000), F.lit(1), k % 3 != 0).alias("same"))


# --- draws, audits, reports -------------------------------------------------


@query("""
    WITH u AS (SELECT doc_id, ('0x' || substr(sha256('s|' || doc_id), 1, 15))::BIGINT % 10 AS u FROM documents)
    SELECT doc_id, CASE WHEN u < 7 THEN 'train' WHEN u < 9 THEN 'dev' ELSE 'test' END AS side FROM u
""")
def weighted_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, planning.choose(F.col("doc_id"), "s", {"train": 7, "dev": 2, "test": 1}).alias("side"))


@query("SELECT lang, doc_id FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY md5('k|' || doc_id), doc_id) AS r FROM documents) WHERE r <= 10")
def hash_ordered_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A seeded sample of ten documents a language."""
    from corvane.operators import dedup

    d = _documents(spark, sf_dir, "lang").withColumn("h", numeric.hash_rank("k", F.col("doc_id")))
    return dedup.best_k(d, ["lang"], [F.col("h"), F.col("doc_id")], 10).select("lang", "doc_id")


@query("SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def worst_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 worst rows for review."""
    return evaluate.worst(table(spark, sf_dir, "events").select("event_id", "value"), "value", "event_id", 25)


@query("""
    WITH e AS (SELECT event_type, value AS s, value * 2 + 1 AS a, event_id % 9 = 0 AS bad FROM events)
    SELECT event_type, count(*) AS n, count(*) FILTER (bad) AS failed, round(avg(s) FILTER (NOT bad), 6) AS mean, round(sum(s) FILTER (NOT bad) / sum(a) FILTER (NOT bad), 6) AS rtf FROM e GROUP BY ALL
""")
def latency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", F.col("value").alias("s"), (F.col("value") * 2 + 1).alias("a"), F.when(F.col("event_id") % 9 == 0, "error").otherwise("ok").alias("status"))
    return evaluate.latency(e, "s", "a", "event_type").select("event_type", "n", "failed", F.round("mean", 6).alias("mean"), F.round("real_time_factor", 6).alias("rtf"))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 10 = 0 THEN 'unknown' WHEN value < 5 THEN 'too_short' WHEN value > 30 THEN 'too_long' END AS reason FROM events) GROUP BY reason")
def duration_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(F.col("event_id") % 10 == 0, F.when(F.col("event_id") % 20 == 0, F.lit(float("nan")))).otherwise(F.col("value"))
    return table(spark, sf_dir, "events").select(signal.usable_duration(seconds, 5.0, 30.0).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, (o_orderkey % 3 = 0)::INT::DOUBLE AS a, (o_orderkey % 3 = 1)::INT::DOUBLE AS b, (o_orderkey % 3 = 2)::INT::DOUBLE AS c FROM orders")
def one_hot_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    hot = numeric.one_hot(options, F.element_at(options, (F.col("o_orderkey") % 3 + 1).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", *(hot[i].alias(n) for i, n in enumerate("abc")))


@query("SELECT doc_id, doc_id % 4 <> 0 AND length(text) >= 3 AS grounded FROM documents")
def grounded_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans whose text is the document's at its place; every fourth is moved by one mark."""
    span = F.struct(F.lit(1).alias("start"), F.lit(3).alias("end"), F.when(F.col("doc_id") % 4 == 0, "\x00\x00").when(F.length("text") >= 3, F.substring("text", 2, 2)).otherwise("\x00\x00").alias("text"))
    d = table(spark, sf_dir, "documents").select("doc_id", "text", F.array(span).alias("spans"))
    return d.select("doc_id", planning.grounded(d, "text", "spans").alias("grounded"))


@query("""
    SELECT doc_id, s AS source_id, CASE WHEN s = 'lang:fr' THEN 'not_permitted' ELSE 'unknown' END AS fault
    FROM (SELECT doc_id, unnest(['lang:' || lang, 'x' || (doc_id % 3)]) AS s FROM documents) WHERE s NOT IN ('lang:en', 'lang:de', 'lang:es', 'x0', 'x1')
""")
def unregistered_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([("lang:en", True), ("lang:de", True), ("lang:es", True), ("lang:fr", False), ("x0", True), ("x1", True)], "source_id string, permitted boolean")
    rows = _documents(spark, sf_dir, F.array(F.concat(F.lit("lang:"), "lang"), F.concat(F.lit("x"), (F.col("doc_id") % 3).cast("string"))).alias("ids"))
    return audit.registered(rows, "doc_id", "ids", registry).select("doc_id", "source_id", "fault")


@query("""
    SELECT l_orderkey, count(DISTINCT l_linenumber) AS judges, CASE WHEN count(DISTINCT l_linenumber) < 2 THEN 'open' WHEN count(DISTINCT l_returnflag) > 1 THEN 'split' WHEN min(l_returnflag) = 'N' THEN 'confirmed' ELSE 'contradicted' END AS resolution
    FROM lineitem GROUP BY l_orderkey
""")
def vote_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.lit("N").alias("target"))
    return corrections.votes(rows, "l_orderkey", "l_linenumber", "l_returnflag", "target").select("l_orderkey", "judges", "resolution")


@query("SELECT o_orderkey, 5 AS n_wide, o_totalprice AS second, 0.0::DOUBLE AS fifth, 1 AS n_narrow FROM orders")
def padded_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.array(F.col("o_orderkey").cast("double"), F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(signal.pad(v, 5)).alias("n_wide"), signal.pad(v, 5)[1].alias("second"), signal.pad(v, 5)[4].alias("fifth"), F.size(signal.pad(v, 1)).alias("n_narrow"))


@query("""
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'w' || doc_id || ' a b c x' WHEN 1 THEN 'new words only' WHEN 2 THEN 'w' || doc_id || ' A, b c!' ELSE 'abcdefgh' END AS merged FROM documents
""")
def windowed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running transcript and the next window: overlap inside, none, revised overlap, unspaced text."""
    k = F.col("doc_id") % 4
    old = F.when(k == 3, "abcdef").otherwise(F.concat(F.lit("w"), F.col("doc_id").cast("string"), F.lit(" a b c d")))
    new = F.when(k == 0, "a b c x").when(k == 1, "new words only").when(k == 2, "A, b c!").otherwise("cdefgh")
    return _documents(spark, sf_dir, unicode.merge_transcripts(old, new).alias("merged"))
