"""Structured Streaming jobs: watermark dedup, stateful transcript merge, idempotent publication, windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corvane.functions.unicode import _merge
from corvane.ship import ship


def dedup(stream: DataFrame, keys: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """First row of each key; state of a key goes once the watermark has passed it."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def tumbling(stream: DataFrame, time: str, width: str, by: list[str], aggregates: list, delay: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Aggregates by event-time window; rows later than ``delay`` are left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width, slide or width), *by).agg(*aggregates)


def sessions(stream: DataFrame, time: str, gap: str, by: list[str], aggregates: list, delay: str = "10 minutes") -> DataFrame:
    """Aggregates by runs of events with no pause of ``gap`` or more."""
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap), *by).agg(*aggregates)


def merge_transcripts(stream: DataFrame, session: str, seq: str, text: str) -> DataFrame:
    """session, seq, transcript: the running transcript of each session after each batch of window hypotheses.

    State is the transcript and the last number seen; a hypothesis that comes again is passed over.
    """
    ship(stream.sparkSession)

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        said, last = state.get if state.exists else ("", -1)
        rows = pd.concat(list(frames)).sort_values(seq)
        for n, own in zip(rows[seq], rows[text], strict=True):
            if n > last:
                said, last = _merge(said, own or ""), int(n)
        state.update((said, last))
        yield pd.DataFrame({session: [key[0]], seq: [last], "transcript": [said]})

    kind = dict(stream.dtypes)[session]
    return stream.groupBy(session).applyInPandasWithState(fold, f"{session} {kind}, {seq} bigint, transcript string", "said string, last bigint", "update", GroupStateTimeout.NoTimeout)


def publish(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Exactly-once Parquet: each micro-batch owns the partition of its number, and writes it whole again after a failure."""

    def write(df: DataFrame, number: int) -> None:
        df.withColumn("micro_batch", F.lit(number)).write.partitionBy("micro_batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def upsert(results: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Terminal results by key: an accepted or published row stays, others give way to a later generation."""
    both = results.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    fixed = (F.col("status") == "accepted").cast("int")
    rest = [c for c in results.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(fixed * (1 - F.col("__new")), "generation", "__new"))
    return both.groupBy(key).agg(best.alias("r")).select(key, *(F.col(f"r.{c}").alias(c) for c in rest)).select(*results.columns)


def pending(items: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Items with neither an accepted result nor one of their own or a later generation."""
    done = results.groupBy(key).agg(F.bool_or(F.col("status") == "accepted").alias("__ok"), F.max("generation").alias("__g"))
    return items.join(done, key, "left").where(~F.coalesce("__ok", F.lit(False)) & (F.coalesce("__g", F.lit(-1)) < F.col("generation"))).drop("__ok", "__g")


def retry(items: DataFrame, results: DataFrame, key: str, reasons: list[str] | None = None) -> DataFrame:
    """Items of quarantined or rejected results as a new generation."""
    again = results.where(F.col("status").isin("quarantined", "rejected"))
    again = again.where(F.col("reason").isin(reasons)) if reasons else again
    top = results.agg(F.max("generation").alias("__top"))  # one row
    return items.join(again.select(key).distinct(), key, "left_semi").join(F.broadcast(top)).withColumn("generation", F.col("__top") + 1).drop("__top")
