"""Scoring predictions against references: exact coverage first, then ratios of sums and paired intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import unicode
from corvane.operators import leakage, metrics
from corvane.ship import ship


def coverage_faults(expected: DataFrame, found: DataFrame, row: str, same: list[str] | None = None) -> DataFrame:
    """(row, fault): ids missing, unexpected or repeated, and ids whose identity fields differ."""
    ids = leakage.coverage(expected, found, [row]).select(row, "fault")
    if not same:
        return ids
    both = expected.select(row, *(F.col(c).alias(f"__{c}") for c in same)).join(found, row)
    wrong = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in same)))
    return ids.unionByName(both.where(F.size(wrong) > 0).select(row, F.concat(F.lit("differs:"), F.array_join(wrong, ",")).alias("fault")))


def scored(references: DataFrame, predictions: DataFrame, row: str, reference: str = "reference", hypothesis: str = "hypothesis") -> DataFrame:
    """references joined to predictions with edit counts; a missing hypothesis counts as empty."""
    ship(references.sparkSession)
    j = references.join(predictions.select(row, hypothesis), row, "left")
    return j.withColumn("e", unicode.error_counts(F.coalesce(F.col(reference), F.lit("")), F.coalesce(F.col(hypothesis), F.lit("")))).select(*j.columns, "e.*")


def error_rates(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Word and character error rates, over all rows and by each axis: sums first, one ratio at the end."""
    words = F.col("word_substitutions") + F.col("word_deletions") + F.col("word_insertions")
    rows = rows.withColumn("word_errors", words).withColumn("exact", ((words == 0) & (F.col("char_errors") == 0)).cast("int"))
    return metrics.by_axes(rows, axes, [F.count("*").alias("n"), metrics.rate("word_errors", "words").alias("wer"), metrics.rate("char_errors", "chars").alias("cer"), F.avg("exact").alias("exact"), F.sum("word_substitutions").alias("substitutions"), F.sum("word_deletions").alias("deletions"), F.sum("word_insertions").alias("insertions")])


def silence(rows: DataFrame, is_speech: Column, hypothesis: str, minutes: Column) -> DataFrame:
    """How often text is written where there is no speech, per row and per minute."""
    said = F.trim(F.coalesce(F.col(hypothesis), F.lit(""))) != ""
    quiet = rows.where(~is_speech)
    return quiet.agg(F.count("*").alias("n"), F.avg(said.cast("int")).alias("rate"), (F.sum(said.cast("int")) / F.nullif(F.sum(minutes), F.lit(0.0))).alias("per_minute"))


def paired(a: DataFrame, b: DataFrame, row: str, family: str, errors: str, units: str, replicates: int = 500, seed: str = "0") -> DataFrame:
    """Difference of two systems' ratios of sums on the same rows, with a 95% interval over resampled families."""
    j = a.select(row, family, F.col(errors).alias("ea"), F.col(units).alias("u")).join(b.select(row, F.col(errors).alias("eb")), row)
    return metrics.bootstrap(j.withColumn("d", F.col("eb") - F.col("ea")), family, "d", "u", replicates, seed)


def worst(rows: DataFrame, score: str, row: str, n: int) -> DataFrame:
    """The n worst rows for review, ties by id: a top-k, not a sort of all."""
    return rows.orderBy(F.desc(score), row).limit(n)


def latency(rows: DataFrame, seconds: str, audio: str, *by: str) -> DataFrame:
    """Requests, mean and percentiles of latency, real-time factor and failures."""
    p = F.percentile_approx(seconds, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)), 10_000)
    ok = F.col("status") == "ok"
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(~ok).alias("failed"), F.avg(F.when(ok, F.col(seconds))).alias("mean"), p.alias("p50_p90_p99"), (F.sum(F.when(ok, F.col(seconds))) / F.nullif(F.sum(F.when(ok, F.col(audio))), F.lit(0.0))).alias("real_time_factor"))
