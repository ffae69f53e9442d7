"""Joins that look for rows on the wrong side: leaks, overlaps, conflicts, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leaked(train: DataFrame, held_out: DataFrame, key: str) -> DataFrame:
    """Training rows whose key is in the held-out set."""
    return train.join(held_out.select(key).distinct(), key, "left_semi")


def without(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not among seen rows."""
    return rows.join(seen.select(*keys).distinct(), keys, "left_anti")


def typed_leaks(train: DataFrame, held_out: DataFrame, row: str, identities: Column) -> DataFrame:
    """(row, other, kind): matches by any of several typed identities.

    identities gives an array of struct(kind, value); both sides explode it and meet on the pair.
    """
    a, b = (d.select(F.col(row).alias(n), F.explode(identities).alias("k")).select(n, "k.kind", "k.value").where("value is not null").distinct() for d, n in ((train, "row"), (held_out, "other")))
    return a.join(b, ["kind", "value"]).select("row", "other", "kind").distinct()


def identities(**keys: Column) -> Column:
    """Typed identities of a row; null values are left out."""
    return F.array_compact(F.array(*(F.when(v.isNotNull(), F.struct(F.lit(k).alias("kind"), v.cast("string").alias("value"))) for k, v in keys.items())))


def conflicts(df: DataFrame, key: str, group: str) -> DataFrame:
    """Keys that stand in several groups, with the number of groups and rows."""
    return df.groupBy(key).agg(F.count_distinct(group).alias("n_groups"), F.count("*").alias("n_rows")).where("n_groups > 1")


def disjoint(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """(field, value) present on both sides, over several columns."""
    sides = [d.select(F.explode(identities(**{c: F.col(c) for c in columns})).alias("k")).select("k.kind", "k.value").distinct() for d in (a, b)]
    return sides[0].intersect(sides[1]).select(F.col("kind").alias("field"), "value")


def coverage(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with their row counts on both sides where they differ: missing, unexpected or repeated."""
    both = expected.select(*keys, F.lit(1).alias("e"), F.lit(0).alias("f")).unionByName(found.select(*keys, F.lit(0).alias("e"), F.lit(1).alias("f")))
    n = both.groupBy(*keys).agg(F.sum("e").alias("n_expected"), F.sum("f").alias("n_found"))
    fault = F.when(F.col("n_found") == 0, "missing").when(F.col("n_expected") == 0, "unexpected").when(F.col("n_found") != F.col("n_expected"), "repeated")
    return n.withColumn("fault", fault).where("fault is not null")


def overlap_share(rows: DataFrame, other: DataFrame, key: Column, file: str) -> DataFrame:
    """Per file: rows, rows whose key is on the other side, and their share."""
    hits = other.select(key.alias("__key")).distinct().withColumn("__hit", F.lit(1))
    n = rows.withColumn("__key", key).join(hits, "__key", "left").groupBy(file).agg(F.count("*").alias("n_rows"), F.count("__hit").alias("n_hits"))
    return n.withColumn("share", F.col("n_hits") / F.col("n_rows"))


def overlay(layers: DataFrame, keys: list[str], layer: str, order: list[str]) -> DataFrame:
    """Layered upsert: within a layer the first row of a key counts, across layers the latest layer wins.

    One maximum by key: (layer, reversed order) as a struct, combined before the shuffle.
    """
    rest = [c for c in layers.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(layer), *(-F.col(c) for c in order)))
    return layers.groupBy(*keys).agg(best.alias("__row")).select(*(F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in layers.columns))


def promised(promise: DataFrame, observed: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Full outer comparison of registered and observed counts."""
    a, b = promise.select(*keys, F.col(count).alias("registered")), observed.select(*keys, F.col(count).alias("observed"))
    state = F.when(F.col("registered").isNull(), "unregistered").when(F.col("observed").isNull(), "absent").when(F.col("registered") != F.col("observed"), "differs").otherwise("ok")
    return a.join(b, keys, "full_outer").withColumn("state", state)
