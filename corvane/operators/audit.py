"""Audits: one-pass counters of files and corpora, batch contracts, run reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import text as t

# Patterns of markup and mojibake left in texts.
ARTIFACTS = {"html": "<[^>]+>", "url": r"(?i)https?://|www\.", "bracketed": r"\[[^\]]{1,40}\]", "replacement": "�", "zero_width": "[​‎‏﻿]", "mojibake": "Ã.|â€", "fence": "```", "control": r"[\x00-\x08\x0b\x0c\x0e-\x1f]"}
EDGES = (1, 2, 3, 5, 8, 12, 16, 20, 30)


def census(df: DataFrame, text: str, duration: str | None, path: str, *by: str) -> DataFrame:
    """Rows, empties, artifacts, missing and odd durations, a ten-bin duration histogram, distinct paths and texts, in one aggregate."""
    x = F.col(text)
    aggs: list[Column] = [F.count("*").alias("n"), F.count_if(F.coalesce(F.trim(x), F.lit("")) == "").alias("empty"), F.sum(F.length(x)).alias("chars"), F.max(F.length(x)).alias("longest")]
    aggs += [F.count_if(F.regexp_like(x, F.lit(p))).alias(name) for name, p in ARTIFACTS.items()]
    if duration:
        d = F.col(duration)
        b = sum(((d >= e).cast("int") for e in EDGES), F.lit(0))
        aggs += [F.count_if(d.isNull()).alias("no_duration"), F.count_if(d <= 0).alias("nonpositive"), (F.sum(d) / 3600).alias("hours")]
        aggs += [F.count_if(b == i).alias(f"bin{i}") for i in range(len(EDGES) + 1)]
    base = df.groupBy(*by).agg(*aggs)
    # Distinct counts by two plain aggregates each, so that no key's rows expand.
    for name, key in (("paths", F.col(path)), ("texts", F.xxhash64(t.text_key(x)))):
        n = df.select(*by, key.alias("__k")).distinct().groupBy(*by).agg(F.count("*").alias(f"distinct_{name}"))
        base = base.join(n, list(by)) if by else base.join(F.broadcast(n))  # one row each without groups
    return base


def batch_faults(manifest: DataFrame, sidecar: DataFrame, held_out: DataFrame, path: str, size: int, *by: str) -> DataFrame:
    """Per batch: rows, what breaks its contract: wrong size, repeated paths, paths in the held-out set, sidecar out of step."""
    m = manifest.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(path).alias("distinct"))
    leaks = manifest.join(held_out.select(path).distinct(), path, "left_semi").groupBy(*by).agg(F.count("*").alias("leaks"))
    keys = [*by, path]
    both = manifest.select(*keys, F.lit(1).alias("a")).unionByName(sidecar.select(*keys, F.lit(-1).alias("a"))).groupBy(*keys).agg(F.sum("a").alias("a")).where("a <> 0").groupBy(*by).agg(F.count("*").alias("unpaired"))
    out = m.join(leaks, list(by), "left").join(both, list(by), "left").na.fill(0)
    faults = F.array_compact(F.array(F.when(F.col("n") != size, "wrong_size"), F.when(F.col("distinct") < F.col("n"), "repeated_path"), F.when(F.col("leaks") > 0, "leaks_held_out"), F.when(F.col("unpaired") > 0, "sidecar_out_of_step")))
    return out.withColumn("faults", faults)


def bundle(batches: DataFrame, lang: str, label: str) -> DataFrame:
    """The batches of each language that make a balanced bundle: as many from each as the poorest has, lowest labels first."""
    from pyspark.sql import Window as W

    n = batches.groupBy(lang).agg(F.count("*").alias("n")).agg(F.min("n").alias("__least"))
    ranked = batches.withColumn("__r", F.row_number().over(W.partitionBy(lang).orderBy(label)))  # one row a batch
    return ranked.join(F.broadcast(n), F.col("__r") <= F.col("__least")).drop("__r", "__least")


def reconcile(planned: DataFrame, outputs: DataFrame, by: list[str], status: str) -> DataFrame:
    """Per group: rows planned, rows by status, and whether every row is accounted for."""
    p = planned.groupBy(*by).agg(F.count("*").alias("planned"))
    o = outputs.groupBy(*by, status).agg(F.count("*").alias("c")).groupBy(*by).agg(F.sum("c").alias("written"), F.map_from_entries(F.collect_list(F.struct(status, "c"))).alias("by_status"))
    return p.join(o, by, "full_outer").withColumn("complete", F.col("planned").eqNullSafe(F.col("written")))


def axes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and share by each of several columns, in one pass."""
    own = F.array(*(F.struct(F.lit(c).alias("axis"), F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("value")) for c in columns))
    n = df.select(F.explode(own).alias("a")).groupBy("a.axis", "a.value").agg(F.count("*").alias("n"))
    from pyspark.sql import Window as W

    return n.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("axis")))  # one row a value


def merged_counters(df: DataFrame, counters: str, *by: str) -> DataFrame:
    """Sums of counter maps over chunks."""
    return df.select(*by, F.explode(counters).alias("key", "n")).groupBy(*by, "key").agg(F.sum("n").alias("n"))


def registered(rows: DataFrame, row: str, source_ids: str, registry: DataFrame) -> DataFrame:
    """Rows of which a source is unknown to the registry or not permitted: (row, source_id, fault)."""
    s = rows.select(row, F.explode(source_ids).alias("source_id"))
    j = s.join(registry.select("source_id", "permitted"), "source_id", "left")
    return j.withColumn("fault", F.when(F.col("permitted").isNull(), "unknown").when(~F.col("permitted"), "not_permitted")).where("fault is not null").drop("permitted")
