"""Publication: sorted shards, sealed directories with checksums, idempotent overwrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_pool(df: DataFrame, path: str, by: list[str], best: Column, files: int = 8) -> None:
    """Parquet under by=.../ with each file sorted best first; a hot group is spread over ``files`` files."""
    df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(files))).repartition(*by, "__salt").sortWithinPartitions(*by, best).drop("__salt").write.partitionBy(*by).mode("overwrite").parquet(path)


def replace_parts(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces exactly the partitions that df has rows for; running it again changes nothing."""
    df.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def seal(spark: SparkSession, path: str) -> DataFrame:
    """path, length and sha256 of each data file."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def broken(spark: SparkSession, path: str, sealed: DataFrame) -> DataFrame:
    """Files that are missing, new or changed since they were sealed."""
    now = seal(spark, path).select("path", F.col("sha256").alias("now"))
    return sealed.select("path", "sha256").join(now, "path", "full_outer").where(~F.col("sha256").eqNullSafe(F.col("now")))


def to_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object a line, null fields left out, gzip."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").option("compression", "gzip").json(path)
