"""Corpus metrics: ratios of sums, grouping sets, calibration, thresholds, bootstrap, percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions import numeric


def by_axes(df: DataFrame, axes: list[str], aggregates: list[Column]) -> DataFrame:
    """Aggregates over all rows and for each value of each axis: (axis, value, ...)."""
    own = F.array(F.struct(F.lit("all").alias("axis"), F.lit("all").alias("value")), *(F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes))
    return df.withColumn("__axis", F.explode(own)).groupBy(F.col("__axis.axis").alias("axis"), F.col("__axis.value").alias("value")).agg(*aggregates)


def rate(errors: str, units: str) -> Column:
    """A ratio of sums; null without units."""
    return F.sum(errors) / F.nullif(F.sum(units), F.lit(0))


def macro(df: DataFrame, group: str, value: Column) -> DataFrame:
    """The unweighted mean over groups of a group's value."""
    return df.groupBy(group).agg(value.alias("__v")).agg(F.avg("__v").alias("macro"), F.count("*").alias("groups"))


def confusion(df: DataFrame, expected: str, predicted: str, labels: list) -> DataFrame:
    """Counts by expected label, one column for each predicted one, with precision, recall and support of the label."""
    n = df.groupBy(expected).pivot(predicted, labels).agg(F.count(F.lit(1))).na.fill(0)
    row = sum((F.col(f"`{x}`") for x in labels), F.lit(0))
    hits = F.coalesce(*(F.when(F.col(expected) == x, F.col(f"`{x}`")) for x in labels), F.lit(0))
    said = F.coalesce(*(F.when(F.col(expected) == x, F.sum(f"`{x}`").over(W.partitionBy())) for x in labels), F.lit(0))  # one row a label
    return n.withColumn("support", row).withColumn("recall", hits / F.nullif(row, F.lit(0))).withColumn("precision", hits / F.nullif(said, F.lit(0)))


def calibration(df: DataFrame, confidence: str, correct: Column, bins: int = 10) -> DataFrame:
    """n, mean confidence, accuracy and gap of each equal-width bin."""
    b = df.select(numeric.bin_of(F.col(confidence), bins).alias("bin"), F.col(confidence).alias("c"), correct.cast("double").alias("y"))
    return b.groupBy("bin").agg(F.count("*").alias("n"), F.avg("c").alias("confidence"), F.avg("y").alias("accuracy")).withColumn("gap", F.abs(F.col("confidence") - F.col("accuracy")))


def calibration_error(df: DataFrame, confidence: str, correct: Column, bins: int = 10) -> DataFrame:
    """The expected calibration error: bins' gaps weighted by their rows."""
    return calibration(df, confidence, correct, bins).agg((F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("ece"), F.sum("n").alias("n"))


def risk_curve(df: DataFrame, confidence: str, correct: Column) -> DataFrame:
    """Coverage and risk of answering from each confidence upward.

    Rows reduce to one a distinct confidence first; running sums run over those alone.
    """
    n = df.groupBy(F.col(confidence).alias("threshold")).agg(F.count("*").alias("n"), F.sum((~correct).cast("int")).alias("wrong"))
    down = W.orderBy(F.desc("threshold")).rowsBetween(W.unboundedPreceding, 0)
    total = n.withColumn("answered", F.sum("n").over(down)).withColumn("errors", F.sum("wrong").over(down))
    return total.select("threshold", "answered", "errors", (F.col("errors") / F.col("answered")).alias("risk"), (F.col("answered") / F.sum("n").over(W.partitionBy())).alias("coverage"))


def threshold(df: DataFrame, confidence: str, correct: Column, target: float) -> DataFrame:
    """The smallest threshold whose risk meets the target; without one, that of least risk."""
    c = risk_curve(df, confidence, correct)
    ok = F.col("risk") <= target
    return c.agg(F.coalesce(F.min(F.when(ok, F.col("threshold"))), F.min_by("threshold", "risk")).alias("threshold"), F.max(ok).alias("met"))


def temperature(df: DataFrame, logits: str, target: str, low: float = 0.05, high: float = 20.0, steps: int = 40) -> float:
    """The temperature of least mean cross-entropy by golden section over its logarithm: one aggregate a step."""
    import math

    ratio = (math.sqrt(5) - 1) / 2

    def loss(x: float) -> float:
        return df.agg(F.avg(numeric.cross_entropy(numeric.softmax(F.col(logits), math.exp(x)), F.col(target)))).first()[0]

    a, b = math.log(low), math.log(high)
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    fc, fd = loss(c), loss(d)
    for _ in range(steps):
        if fc < fd:
            b, d, fd = d, c, fc
            c = b - ratio * (b - a)
            fc = loss(c)
        else:
            a, c, fc = c, d, fd
            d = a + ratio * (b - a)
            fd = loss(d)
    return math.exp((a + b) / 2)


def bootstrap(df: DataFrame, family: str, numerator: str, denominator: str, replicates: int = 200, seed: str = "0") -> DataFrame:
    """Ratio of sums with a 95% interval by resampling whole families.

    A family's weight in a replicate is a Poisson(1) draw from the digest of (seed, family, replicate):
    families reduce to their sums first, draws combine before the shuffle, and reruns agree.
    """
    f = df.groupBy(family).agg(F.sum(numerator).cast("double").alias("a"), F.sum(denominator).cast("double").alias("b"))
    # Poisson(1) by inversion of a uniform draw: cumulative probabilities of 0, 1, 2, ... draws.
    import math

    ends, total = [], 0.0
    for k in range(10):
        total += math.exp(-1) / math.factorial(k)
        ends.append(total)

    u = F.pmod(F.xxhash64(F.lit(seed), F.col(family), F.col("i")), F.lit(2**53)) / float(2**53)
    weight = sum(((u >= e).cast("int") for e in ends), F.lit(0))
    drawn = f.withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(replicates)))).withColumn("w", weight)
    each = drawn.groupBy("i").agg((F.sum(F.col("a") * F.col("w")) / F.nullif(F.sum(F.col("b") * F.col("w")), F.lit(0.0))).alias("r"))
    r = each.agg(F.array_sort(F.array_compact(F.collect_list("r"))).alias("r"))  # one row of ``replicates`` numbers
    sums = f.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).join(F.broadcast(r), F.lit(True))
    return sums.select((F.col("a") / F.col("b")).alias("ratio"), numeric.nearest_rank(F.col("r"), 0.025).alias("low"), numeric.nearest_rank(F.col("r"), 0.975).alias("high"))


def nearest_rank(df: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """Percentiles by rank round-half-even(share * (n - 1)), over value counts, so no group's rows are gathered."""
    n = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))
    up = W.partitionBy(*by).orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    c = n.withColumn("last", F.sum("n").over(up)).withColumn("total", F.sum("n").over(W.partitionBy(*by)))
    return c.groupBy(*by).agg(*(F.min(F.when(F.col("last") > F.bround(F.lit(s) * (F.col("total") - 1)), F.col(value))).alias(f"p{round(s * 100)}") for s in shares))


def histogram(df: DataFrame, value: str, edges: list[float], *by: str) -> DataFrame:
    """Rows per bin [edge, next edge), below the first and from the last upward."""
    b = sum((F.when(F.col(value) >= e, 1).otherwise(0) for e in edges), F.lit(0))
    return df.where(F.col(value).isNotNull()).groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"))
