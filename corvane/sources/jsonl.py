"""JSON-lines readers: tolerant ones that turn faults into data, strict ones that fail."""

from __future__ import annotations

import gzip
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions import text as t

PATHS = ("$.audio_filepath", "$.wav_path", "$.audio.path", "$.audio.audio_file_name", "$.audio")
TEXTS = ("$.text", "$.transcript", "$.sentence")


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """file, raw: one row a line; a line that is not UTF-8 has its bad bytes replaced."""
    raw = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))
    return raw.withColumn("raw", F.make_valid_utf8("raw"))


def _first(v: Column, names: tuple[str, ...], kind: str = "string") -> Column:
    return F.coalesce(*(F.try_variant_get(v, n, kind) for n in names))


def tolerant(df: DataFrame, raw: str = "raw") -> DataFrame:
    """df with path, text, duration, lang and reject_reason of its JSON lines; no row is dropped.

    Aliases are tried in order. A number given as text is read, true and false are no durations,
    an object in ``audio`` gives its path. The first reason that applies is kept: blank_line,
    malformed_json, not_an_object, missing_path, missing_text.
    """
    v = F.try_parse_json(raw)
    shape = F.schema_of_variant(v)
    out = df.withColumn("__v", v).withColumn("__shape", shape)
    path, text_ = _first(F.col("__v"), PATHS), _first(F.col("__v"), TEXTS)
    d = F.try_variant_get("__v", "$.duration", "variant")
    kind = F.schema_of_variant(d)
    number = F.when(kind != "BOOLEAN", F.try_variant_get(F.col("__v"), "$.duration", "string").try_cast("double"))
    good = F.when((number > 0) & (number < float("inf")) & ~F.isnan(number), number)
    reason = (
        F.when(F.trim(F.col(raw)) == "", "blank_line")
        .when(F.col("__v").isNull(), "malformed_json")
        .when(~F.startswith(F.col("__shape"), F.lit("OBJECT")), "not_an_object")
        .when(path.isNull() | (path == ""), "missing_path")
        .when(text_.isNull() | (F.trim(text_) == ""), "missing_text")
    )
    fault = F.when(d.isNull() | (kind == "VOID"), "missing_duration").when(kind == "BOOLEAN", "boolean_duration").when(number.isNull(), "unreadable_duration").when(good.isNull(), "nonpositive_duration")
    made = out.withColumns({"reject_reason": reason, "path": path, "text": text_, "duration": good, "duration_fault": fault, "lang": _first(F.col("__v"), ("$.lang", "$.language"))})
    return made.drop("__v", "__shape")


def read_tolerant(spark: SparkSession, *paths: str) -> DataFrame:
    return tolerant(lines(spark, *paths))


def read_strict(spark: SparkSession, *paths: str) -> DataFrame:
    """audio_filepath, duration, text, lang; evaluation fails at a line that lacks one or is no JSON."""
    v = F.try_parse_json("raw")
    raw = lines(spark, *paths).where(F.trim("raw") != "")
    cols = {"audio_filepath": "string", "duration": "double", "text": "string", "lang": "string"}
    values = {c: F.try_variant_get(v, f"$.{c}", kind) for c, kind in cols.items()}
    return raw.select(*(F.coalesce(x, F.raise_error(F.concat(F.lit(f"no {c} in "), F.col("file"), F.lit(": "), F.substring("raw", 1, 120))).cast(cols[c])).alias(c) for c, x in values.items()))


def read_array(spark: SparkSession, *paths: str) -> DataFrame:
    """file, raw of the elements of files that hold one JSON array each."""
    whole = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", "array<variant>").alias("v"))
    return whole.select("file", F.explode("v").alias("v")).select("file", F.to_json("v").alias("raw"))


def numbered(spark: SparkSession, *paths: str) -> DataFrame:
    """file, line (from 1), raw. A line's number needs all lines before it, so a file is one task's work."""
    from corvane.ship import ship

    ship(spark)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for file, content in zip(b["path"].to_pylist(), b["content"].to_pylist(), strict=True):
                data = gzip.decompress(content) if file.endswith(".gz") else content
                own = data.decode("utf-8", "replace").split("\n")
                own = own[:-1] if own and own[-1] == "" else own
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(own)), pa.array(range(1, len(own) + 1), pa.int64()), pa.array(own, pa.string())], ["file", "line", "raw"])

    return spark.read.format("binaryFile").load(list(paths)).select("path", "content").mapInArrow(run, "file string, line bigint, raw string")


@dataclass(frozen=True)
class Spec:
    """A declared source: where it lies, which fields it maps, and what it may give."""

    name: str
    lang: str
    paths: tuple[str, ...]
    kind: str = "jsonl"
    prefix: str = ""
    exclude: tuple[str, ...] = ()
    max_rows: int | None = None
    gated: bool = False
    license: str = ""
    fields: dict[str, str] = field(default_factory=dict)


class Registry:
    """Declared sources in order; ``select`` filters them, ``frame`` reads them as one table."""

    def __init__(self, *specs: Spec):
        names = [(s.lang, s.name) for s in specs]
        if len(set(names)) < len(names):
            raise ValueError("a source is declared twice")
        self.specs = specs

    def select(self, lang: str | None = None, gated: bool = True, names: tuple[str, ...] = ()) -> list[Spec]:
        return [s for s in self.specs if (lang is None or s.lang == lang) and (gated or not s.gated) and (not names or s.name in names)]

    def frame(self, spark: SparkSession, specs: list[Spec] | None = None) -> DataFrame:
        """path, text, duration, lang, reject_reason and source of all rows; ``turn`` orders sources in turn."""
        from functools import reduce

        from pyspark.sql import Window as W

        frames = []
        for s in specs if specs is not None else list(self.specs):
            if s.kind == "parquet":
                df = spark.read.parquet(*s.paths).select(F.col("_metadata.file_path").alias("file"), *(F.col(s.fields.get(k, k)).cast(kind).alias(k) for k, kind in (("path", "string"), ("text", "string"), ("duration", "double"))))
                df = df.withColumn("reject_reason", F.when(F.col("path").isNull(), "missing_path").when(F.col("text").isNull(), "missing_text"))
            else:
                df = read_tolerant(spark, *s.paths)
            for part in s.exclude:
                df = df.where(~F.contains("file", F.lit(part)))
            df = df.select("file", t.under(F.col("path"), s.prefix).alias("path") if s.prefix else F.col("path"), "text", "duration", "reject_reason", F.lit(s.lang).alias("lang"), F.lit(s.name).alias("source"))
            df = df.withColumn("turn", F.row_number().over(W.partitionBy("source").orderBy("file", "path")))
            frames.append(df if s.max_rows is None else df.where(F.col("turn") <= s.max_rows))
        return reduce(DataFrame.unionByName, frames)


def duration_coverage(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows with and without a duration."""
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count("duration").alias("n_present"), (F.count("duration") / F.count("*")).alias("share"))


def inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Name, size and time of every file, without reading content."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")
