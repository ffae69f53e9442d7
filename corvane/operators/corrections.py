"""Text correction through a pluggable batch service, with guards, bisection of failing batches, and retries.

A service takes a list of texts and returns as many texts (or raises). None is at hand offline, so
the default is the identity; a deployment passes its own client. Rows are never lost: what cannot be
corrected comes back with its reason.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions import compare, unicode
from corvane.ship import ship

Service = Callable[[list[str]], list[str]]


def identity(texts: list[str]) -> list[str]:
    return texts


def answered(service: Service, texts: list[str]) -> list[str | None]:
    """The service's answers; a batch that fails is halved until the failing texts stand alone, and those give None."""
    try:
        out = service(texts)
        if len(out) == len(texts):
            return list(out)
    except Exception:  # noqa: BLE001  a service may fail in any way; its rows are quarantined, not lost
        pass
    if len(texts) == 1:
        return [None]
    half = len(texts) // 2
    return answered(service, texts[:half]) + answered(service, texts[half:])


def corrected(df: DataFrame, text: str, service: Service = identity, batch: int = 64, most: float = 0.5) -> DataFrame:
    """df with ``corrected`` and ``verdict``: accepted, or why the source stands (unanswered, empty, diverges, too_long)."""
    ship(df.sparkSession)

    def run(texts: pd.Series) -> pd.Series:
        own = texts.fillna("").tolist()
        return pd.Series([x for i in range(0, len(own), batch) for x in answered(service, own[i : i + batch])], dtype=object)

    answer = F.pandas_udf(lambda s: run(s), "string", F.PandasUDFType.SCALAR)
    out = df.withColumn("__answer", answer(F.col(text)))
    a, b = unicode.compare_form(F.col("__answer")), unicode.compare_form(F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("__a", a).withColumn("__b", b)
    verdict = F.coalesce(F.when(F.col("__answer").isNull(), "unanswered"), compare.guard(F.col("__a"), [F.col("__b")], most), F.lit("accepted"))
    out = out.withColumn("verdict", F.when(F.coalesce(F.trim(F.col(text)), F.lit("")) == "", "accepted").otherwise(verdict))
    return out.withColumn("corrected", F.when((F.col("verdict") == "accepted") & F.col(text).isNotNull(), F.coalesce("__answer", F.col(text))).otherwise(F.col(text))).drop("__answer", "__a", "__b")


def with_retries(df: DataFrame, row: str, text: str, services: list[Service]) -> DataFrame:
    """Each service gets what the ones before it left unaccepted; ``attempt`` tells which one settled a row."""
    left, done = df, None
    for i, service in enumerate(services):
        tried = corrected(left, text, service).withColumn("attempt", F.lit(i))
        final = i == len(services) - 1
        out = tried if final else tried.where("verdict = 'accepted'")
        done = out if done is None else done.unionByName(out)
        if not final:
            left = tried.where("verdict <> 'accepted'").select(*df.columns)
    return done


def parsed_answers(df: DataFrame, answer: str, size: str) -> DataFrame:
    """df with ``items``: index and text of a model's JSON array answer, or null where indices repeat, are missing or out of range."""
    ship(df.sparkSession)
    items = F.from_json(unicode.salvage_json(F.col(answer)), "array<struct<i:int,t:string>>")
    out = df.withColumn("__items", items)
    seen = F.array_sort(F.transform("__items", lambda x: x["i"]))
    good = seen == F.when(F.col(size) > 0, F.sequence(F.lit(0), F.col(size) - 1)).otherwise(F.array().cast("array<int>"))
    return out.withColumn("items", F.when(good, F.array_sort("__items"))).drop("__items")


def votes(answers: DataFrame, row: str, judge: str, label: str, target: str, least: int = 2) -> DataFrame:
    """Per row: distinct judges, whether all agree, and the resolution: confirmed, contradicted, split or open."""
    g = answers.groupBy(row).agg(F.count_distinct(judge).alias("judges"), F.count_distinct(label).alias("labels"), F.min(label).alias("label"), F.first(target).alias("target"))
    state = F.when(F.col("judges") < least, "open").when(F.col("labels") > 1, "split").when(F.col("label") == F.col("target"), "confirmed").otherwise("contradicted")
    return g.withColumn("resolution", state)
