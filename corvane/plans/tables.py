"""Queries over the relational tables and the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import numeric, rules
from corvane.operators import leakage, metrics, select
from corvane.plans.catalog import query, table


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders still without lines."""
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return leakage.without(table(spark, sf_dir, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_groups, count(*) AS n_rows FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1")
def part_supplier_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.conflicts(table(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey")


@query("SELECT l_partkey, arg_max(l_orderkey, (l_extendedprice, -l_orderkey, -l_linenumber)) AS l_orderkey, round(max(l_extendedprice), 2) AS price, count(*) AS n, round(max(l_discount) - min(l_discount), 4) AS spread FROM lineitem GROUP BY l_partkey")
def representative_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest line of each part, ties by order and line."""
    best = F.max_by("l_orderkey", F.struct("l_extendedprice", -F.col("l_orderkey"), -F.col("l_linenumber")))
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(best.alias("l_orderkey"), F.round(F.max("l_extendedprice"), 2).alias("price"), F.count("*").alias("n"), F.round(F.max("l_discount") - F.min("l_discount"), 4).alias("spread"))


@query(
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_discount > 0.05) AS discounted, round(sum(l_quantity) FILTER (l_tax = 0), 2) AS untaxed,
      round(sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY ALL
    """
)
def conditional_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.round(F.sum(F.when(F.col("l_tax") == 0, F.col("l_quantity"))), 2).alias("untaxed"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT c_custkey, c_mktsegment, rank::INTEGER AS rank, round(least(20, n) / n::DOUBLE, 6) AS inclusion FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('7|' || c_custkey), c_custkey) AS rank, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer) WHERE rank <= 20")
def stratified_hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty customers a segment in seeded digest order."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return select.stratified(c, ["c_mktsegment"], "c_custkey", 20, "7").select("c_custkey", "c_mktsegment", "rank", F.round("inclusion", 6).alias("inclusion"))


@query("SELECT o_orderkey, o_orderpriority, ((r - 1) // 64)::BIGINT AS \"window\", (((r - 1) % 64) // 4) % 4 AS rank FROM (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS r FROM orders)")
def fixed_windows_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 64 orders a priority; in each, chunks of four go to four ranks in turn."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return select.windows(o, "o_orderpriority", ["o_orderkey"], 64, 4, 4).select("o_orderkey", "o_orderpriority", "window", F.col("rank").cast("bigint").alias("rank"))


@query(
    """
    WITH l AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderkey % 3 AS layer FROM orders)
    SELECT o_custkey, o_orderkey, o_totalprice, layer FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY layer DESC, o_orderkey) AS r FROM l) WHERE r = 1
    """
)
def overlay_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order a customer: the latest of three layers, the first within it."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", (F.col("o_orderkey") % 3).alias("layer"))
    return leakage.overlay(o, ["o_custkey"], "layer", ["o_orderkey"])


@query(
    """
    WITH w AS (SELECT c_nationkey, count(*) AS w FROM customer GROUP BY 1), s AS (SELECT *, w * 1000.0::DOUBLE / sum(w) OVER () AS share FROM w),
    f AS (SELECT *, floor(share) AS lo, 1000 - sum(floor(share)) OVER () AS rest, row_number() OVER (ORDER BY share - floor(share) DESC, c_nationkey) AS r FROM s)
    SELECT c_nationkey, w, (lo + (r <= rest)::INT)::BIGINT AS quota FROM f
    """
)
def largest_remainder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand places shared by nations' customers."""
    w = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("w"))
    return select.largest_remainder(w, "c_nationkey", "w", 1000).select("c_nationkey", "w", "quota")


@query("WITH r AS (SELECT l_shipdate::DATE AS d, l_returnflag AS f, l_quantity AS q FROM lineitem), s AS (SELECT f, q, row_number() OVER (PARTITION BY f ORDER BY q) - 1 AS i, count(*) OVER (PARTITION BY f) AS n FROM r) SELECT f AS l_returnflag, max(q) FILTER (i = round_even(0.5 * (n - 1), 0)) AS p50, max(q) FILTER (i = round_even(0.9 * (n - 1), 0)) AS p90, max(q) FILTER (i = round_even(0.99 * (n - 1), 0)) AS p99 FROM s GROUP BY f")
def percentile_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.nearest_rank(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", [0.5, 0.9, 0.99])


@query("SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90 FROM lineitem GROUP BY 1")
def percentile_interpolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.percentile("l_extendedprice", F.array(F.lit(0.5), F.lit(0.9)))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(p.alias("p")).select("l_returnflag", F.round(F.col("p")[0], 4).alias("p50"), F.round(F.col("p")[1], 4).alias("p90"))


@query("SELECT o_orderstatus, least(greatest(floor(o_totalprice / 50000), 0), 9)::BIGINT AS bin, count(*) AS n FROM orders GROUP BY ALL")
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = metrics.histogram(table(spark, sf_dir, "orders"), "o_totalprice", [50000.0 * i for i in range(1, 10)], "o_orderstatus")
    return h.select("o_orderstatus", F.col("bin").cast("bigint").alias("bin"), "n")


@query("SELECT event_type, (props::JSON ->> '$.k')::BIGINT AS k, count(*) AS n FROM events GROUP BY ALL")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field of a JSON column by variant extraction."""
    e = table(spark, sf_dir, "events").select("event_type", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))
    return e.groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query(
    """
    SELECT coalesce(o_orderkey, l_orderkey) AS key, coalesce(e, 0) AS n_expected, coalesce(f, 0) AS n_found, CASE WHEN f IS NULL THEN 'missing' WHEN e IS NULL THEN 'unexpected' ELSE 'repeated' END AS fault
    FROM (SELECT o_orderkey, count(*) AS e FROM orders GROUP BY 1) FULL JOIN (SELECT l_orderkey, count(DISTINCT l_linenumber) AS f FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) ON o_orderkey = l_orderkey
    WHERE e IS DISTINCT FROM f
    """
)
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against first lines, both ways."""
    first = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("key")).distinct()
    return leakage.coverage(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key")), first, ["key"])


@query(
    """
    SELECT o_orderkey, CASE WHEN isodow(o_orderdate) >= 6 THEN 'closed' ELSE 'open' END AS opening, CASE WHEN min(l_shipdate) IS NULL THEN 'insufficient' WHEN epoch(min(l_shipdate)) - epoch(o_orderdate) <= 30 * 86400 THEN 'met' ELSE 'missed' END AS reply
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate
    """
)
def temporal_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday opening and time to the first shipment by the rule functions."""
    first = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("shipped"))
    o = table(spark, sf_dir, "orders").join(first, "o_orderkey", "left")
    return o.select("o_orderkey", rules.within_opening(F.col("o_orderdate"), F.lit(60), 0, 0).alias("opening"), rules.reply_in_time(F.col("o_orderdate"), F.col("shipped"), 30 * 24 * 60).alias("reply"))


@query(
    """
    SELECT c_custkey, CASE WHEN c_acctbal + 500 <= 5000 THEN 'fits' ELSE 'exceeds' END AS budget,
      (CASE WHEN c_acctbal > 0 THEN 2 ELSE 0 END + CASE WHEN c_acctbal > 3000 THEN 3 ELSE 0 END >= 0)::INT + (CASE WHEN c_acctbal > 0 THEN 2 ELSE 0 END + CASE WHEN c_acctbal > 3000 THEN 3 ELSE 0 END >= 2)::INT
      + (CASE WHEN c_acctbal > 0 THEN 2 ELSE 0 END + CASE WHEN c_acctbal > 3000 THEN 3 ELSE 0 END >= 5)::INT - 1 AS level,
      CASE WHEN c_acctbal > 0 AND c_mktsegment = 'BUILDING' THEN 'eligible' ELSE 'ineligible' END AS policy FROM customer
    """
)
def decision_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bal = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select("c_custkey", rules.budget(bal, F.lit(500), F.lit(5000)).alias("budget"), rules.triage([(bal > 0, 2), (bal > 3000, 3)], [0, 2, 5]).alias("level"), rules.policy([bal > 0, F.col("c_mktsegment") == "BUILDING"], every=True).alias("policy"))


@query(
    """
    WITH p AS (SELECT s_suppkey, [s_acctbal / 1000, 1.0, -s_acctbal / 2000] AS x FROM supplier), e AS (SELECT s_suppkey, x, list_transform(x, lambda v: exp(v - list_max(x))) AS e FROM p),
    q AS (SELECT s_suppkey, list_transform(e, lambda v: v / list_sum(e)) AS q FROM e)
    SELECT s_suppkey, round(q[1], 6) AS p0, round(-list_sum(list_transform(q, lambda v: CASE WHEN v > 0 THEN v * ln(v) ELSE 0 END)) / ln(3), 6) AS entropy, round((q[1] - 1) ** 2 + q[2] ** 2 + q[3] ** 2, 6) AS brier,
      round((q[1] - 1) ** 2 / 2 + (q[1] + q[2] - 1) ** 2 / 2, 6) AS rps FROM q
    """
)
def decision_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Softmax, entropy, Brier and ranked-probability scores of three logits a row."""
    p = numeric.softmax(F.array(F.col("s_acctbal") / 1000, F.lit(1.0), -F.col("s_acctbal") / 2000))
    target = F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))
    d = table(spark, sf_dir, "supplier").select("s_suppkey", p.alias("p"))
    return d.select("s_suppkey", F.round(F.col("p")[0], 6).alias("p0"), F.round(numeric.entropy(F.col("p")), 6).alias("entropy"), F.round(numeric.brier(F.col("p"), target), 6).alias("brier"), F.round(numeric.ranked_probability(F.col("p"), target), 6).alias("rps"))


@query("WITH s AS (SELECT user_id, ts, event_type, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM s) SELECT user_id, max(session)::BIGINT AS sessions, count(*) AS events FROM g GROUP BY user_id")
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions a user by pauses over half an hour: the session window of the streaming job, in batch."""
    s = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "30 minutes 1 microsecond")).agg(F.count("*").alias("n"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("events"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
    return w.select(F.col("window.start").alias("hour"), "event_type", "n", "total")


@query("SELECT r_name, n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, x) for x in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.rollup("r_name", "n_name").agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
