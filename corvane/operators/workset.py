"""Occurrences to clips: one representative a key, a disposition for every row, an inventory that adds up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import numeric


def representatives(rows: DataFrame, key: str, row: str, order: list[str], quality: str = "quality", duration: str = "duration", text: str = "text", errors: str = "errors") -> DataFrame:
    """One row a key: representative row, its text, duration and quality, the rows behind it, and why the key is blocked.

    The representative is the row of highest quality, then lowest ``order``, among those with a text and
    neither an invalid duration nor a language mismatch; without such rows, among all. A key is blocked by, in
    turn: any row's language mismatch, durations further apart than a tenth of a second and a
    hundredth of the shortest, no text, an invalid duration, no duration anywhere. A missing duration
    is borrowed from the shortest of the key. Everything is one aggregate whose parts combine.
    """
    has = lambda e: F.array_contains(F.coalesce(F.col(errors), F.array().cast("array<string>")), e)
    said = F.coalesce(F.col(text), F.lit("")) != ""
    good = said & ~has("invalid_duration") & ~has("language_mismatch")
    rank = F.struct(good.cast("int"), F.coalesce(F.col(quality), F.lit(0.0)), *(-F.col(c) for c in order))
    chosen = F.struct(F.col(row).alias("row"), F.col(text).alias("text"), F.col(duration).alias("duration"), F.col(quality).alias("quality"), said.alias("said"), has("invalid_duration").alias("invalid"))
    g = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(chosen, rank).alias("c"), F.count("*").alias("n_rows"), F.bool_or(has("language_mismatch")).alias("mismatch"), F.min(duration).alias("shortest"), F.max(duration).alias("longest"))
    spread = F.col("longest") - F.col("shortest") > F.greatest(F.lit(0.1), 0.01 * F.col("shortest")) + 1e-12
    blocked = F.when(F.col("mismatch"), "language_mismatch").when(spread, "duration_conflict").when(~F.col("c.said"), "missing_or_invalid_text").when(F.col("c.invalid"), "invalid_duration").when(F.col("shortest").isNull(), "missing_duration")
    return g.select(key, F.col("c.row").alias("representative"), F.col("c.text").alias("text"), F.coalesce("c.duration", "shortest").alias("duration"), F.col("c.quality").alias("quality"), "n_rows", blocked.alias("blocked"))


def dispositions(rows: DataFrame, clips: DataFrame, held_out: DataFrame, key: str, row: str) -> DataFrame:
    """Every row with its fate: source_invalid (no key), eval_excluded, duplicate, blocked or eligible."""
    out = rows.join(clips.select(key, "representative", "blocked"), key, "left").join(held_out.select(key).distinct().withColumn("__eval", F.lit(True)), key, "left")
    fate = F.when(F.col("representative").isNull(), "source_invalid").when(F.col("__eval"), "eval_excluded").when(F.col(row) != F.col("representative"), "duplicate").when(F.col("blocked").isNotNull(), "blocked").otherwise("eligible")
    return out.withColumn("disposition", fate).drop("__eval", "representative", "blocked")


def cross_language(clips: DataFrame, key: str, lang: str) -> DataFrame:
    """clips whose key stands in several languages blocked as such, unless blocked already."""
    n = clips.groupBy(key).agg((F.count_distinct(lang) > 1).alias("__several"))
    return clips.join(n, key).withColumn("blocked", F.coalesce("blocked", F.when(F.col("__several"), "cross_language_conflict"))).drop("__several")


def inventory(rows: DataFrame, *by: str) -> DataFrame:
    """Rows per disposition, in all and for each of ``by``, in one pass over grouping sets."""
    axes = F.array(F.struct(F.lit("all").alias("axis"), F.lit("all").alias("value")), *(F.struct(F.lit(b).alias("axis"), F.col(b).cast("string").alias("value")) for b in by))
    return rows.select("disposition", F.explode(axes).alias("a")).groupBy("a.axis", "a.value", "disposition").agg(F.count("*").alias("n"))


def partitions(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows with a stable part number of their key."""
    return rows.withColumn("part", numeric.part_of(F.col(key), parts))


def accounting(planned: DataFrame, done: DataFrame, by: str) -> DataFrame:
    """Per group: rows planned and finished by status, and whether they are equal."""
    a = planned.groupBy(by).agg(F.count("*").alias("planned"))
    b = done.groupBy(by).agg(F.count("*").alias("finished"), *(F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "quarantined", "rejected")))
    return a.join(b, by, "full_outer").withColumn("exact", F.col("planned").eqNullSafe(F.col("finished")))
