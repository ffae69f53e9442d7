"""Every registered query over the driver tables, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.ship import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL twin if it has one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    """
    WITH keyed AS (SELECT doc_id, lang, regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '', 'g') AS key FROM documents),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, key ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY lang, key) AS n FROM keyed)
    SELECT lang, count(*) AS total, count(*) FILTER (rn = 1) AS n_distinct, count(*) FILTER (rn <= 2) AS kept,
           count(*) FILTER (rn > 2) AS dropped, max(n) AS max_repeat FROM ranked GROUP BY lang
    """
)
def diversity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct text keys, rows kept at two a key, rows dropped and the largest repeat, by language.

    Counts per key suffice: one aggregate by (lang, key digest), one by lang, no window over rows.
    """
    key = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}]", "")
    n = table(spark, sf_dir, "documents").groupBy("lang", F.sha2(key, 256).alias("key")).agg(F.count("*").alias("n"))
    return n.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("n_distinct"), F.sum(F.least("n", F.lit(2))).alias("kept"), F.sum(F.greatest(F.col("n") - 2, F.lit(0))).alias("dropped"), F.max("n").alias("max_repeat"))


# The query modules register themselves.
from corvane.plans import documents, more, rows, tables  # noqa: E402, F401
