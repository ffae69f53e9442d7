"""Split planning, quotas, review sampling and acquisition over example tables with families."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions import numeric


def choose(identity: Column, seed: str, weights: dict[str, int]) -> Column:
    """A value drawn by weight from the digest of (seed, identity): 60 bits of SHA-256 modulo the total."""
    u = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), identity.cast("string")), 256), 1, 15), 16, 10).cast("bigint")
    at = F.pmod(u, F.lit(sum(weights.values())))
    out, end = F.lit(None).cast("string"), sum(weights.values())
    for name, w in reversed(weights.items()):
        end -= w
        out = F.when(at >= end, F.coalesce(F.when(at < end + w, F.lit(name)), out)).otherwise(out)
    return out


def splits(df: DataFrame, family: str, seed: str, weights: dict[str, int], reserved: dict[str, list] | None = None) -> DataFrame:
    """df with ``split``, the same for all rows of a family; reserved families keep the split they are promised."""
    split = choose(F.col(family), seed, weights)
    for name, own in (reserved or {}).items():
        split = F.when(F.col(family).isin(own), name).otherwise(split)
    return df.withColumn("split", split)


def option_bin(n: Column) -> Column:
    """Bins of option counts: 2, 3-5, 6-16, 17-64, 65-255."""
    return F.when(n == 2, "2").when(n.between(3, 5), "3-5").when(n.between(6, 16), "6-16").when(n.between(17, 64), "17-64").when(n.between(65, 255), "65-255")


def shortfall(df: DataFrame, cell: str, wanted: dict[str, int]) -> DataFrame:
    """Rows there and missing for each wanted cell, cells without rows too."""
    spark = df.sparkSession
    plan = spark.createDataFrame(list(wanted.items()), f"{cell} string, wanted bigint")
    have = df.groupBy(cell).agg(F.count("*").alias("have"))
    return plan.join(have, cell, "left").na.fill(0, ["have"]).withColumn("missing", F.greatest(F.col("wanted") - F.col("have"), F.lit(0).cast("bigint")))


def audit_sample(df: DataFrame, cells: list[str], family: str, n: int, seed: str) -> DataFrame:
    """n families a cell by seeded digest, with their chance of being taken; one row a family and cell."""
    f = df.select(*cells, family).distinct()
    d = numeric.hash_rank(seed, F.col(family))
    r = f.withColumn("__d", d).withColumn("rank", F.row_number().over(W.partitionBy(*cells).orderBy("__d", family)))
    size = f.groupBy(*cells).agg(F.count("*").alias("__n"))
    return r.where(F.col("rank") <= n).join(size, cells).withColumn("inclusion", F.least(F.lit(n), F.col("__n")) / F.col("__n")).drop("__d", "__n")


def audit_bounds(reviews: DataFrame, cells: list[str], family: str, wrong: Column, limit: float) -> DataFrame:
    """Per cell: families reviewed, families with an error, the Wilson upper bound and whether it is under the limit."""
    f = reviews.groupBy(*cells, family).agg(F.bool_or(wrong).alias("bad"))
    c = f.groupBy(*cells).agg(F.count("*").alias("families"), F.count_if("bad").alias("errors"))
    return c.withColumn("upper", numeric.wilson_upper(F.col("errors"), F.col("families"))).withColumn("passed", F.col("upper") <= limit)


def acquire(pool: DataFrame, row: str, family: str, cell: str, probabilities: Column, count: int, seed: str, random_share: float = 0.2) -> DataFrame:
    """The rows to label next: a random part in turn over cells, the rest by uncertainty and rarity; one row a family.

    Both parts take the best row of each family first (an aggregate), then rank families: ranks are
    over at most one row a family, and only ``count`` of them go on.
    """
    n = pool.groupBy(cell).agg(F.count("*").alias("__cell"))
    scored = pool.join(n, cell).withColumn("score", numeric.entropy(probabilities) + 1 / F.sqrt("__cell")).withColumn("__d", numeric.hash_rank(seed, F.col(row)))
    best = scored.groupBy(family).agg(F.max_by(F.struct(row, cell, "score", "__d"), F.struct("score", "__d")).alias("x")).select(family, "x.*")
    k = int(count * random_share)
    turn = best.withColumn("__turn", F.row_number().over(W.partitionBy(cell).orderBy("__d")))
    first = turn.orderBy("__turn", "__d").limit(k).select(row, family, cell, "score", F.lit("random").alias("reason"))
    rest = best.join(first.select(family), family, "left_anti").orderBy(F.desc("score"), "__d").limit(count - k)
    return first.unionByName(rest.select(row, family, cell, "score", F.lit("uncertain").alias("reason")))


def budget_worlds(df: DataFrame, row: str, seed: str) -> DataFrame:
    """A drawn budget question for each row: total, spent, requested (each null once in ten), its text and its answer."""
    from corvane.functions import rules

    draw = lambda salt, top: F.pmod(F.xxhash64(F.lit(seed), F.col(row), F.lit(salt)), F.lit(top)).cast("int")
    hide = lambda salt, c: F.when(draw(salt + 10, 10) > 0, c)
    w = df.select(row, hide(1, draw(1, 900) + 100).alias("total"), hide(2, draw(2, 600)).alias("spent"), hide(3, draw(3, 500) + 1).alias("requested"))
    said = F.concat_ws(" ", F.when(F.col("total").isNotNull(), F.format_string("The budget is %d.", "total")), F.when(F.col("spent").isNotNull(), F.format_string("So far %d is spent.", "spent")), F.when(F.col("requested").isNotNull(), F.format_string("The request is for %d.", "requested")))
    return w.withColumn("text", said).withColumn("answer", rules.budget(F.col("spent"), F.col("requested"), F.col("total")))


def grounded(df: DataFrame, document: str, spans: str) -> Column:
    """Whether every span (start, end, text) of a row is the document's text at its place."""
    return F.forall(F.col(spans), lambda s: F.substring(F.col(document), s["start"] + 1, s["end"] - s["start"]) == s["text"])
