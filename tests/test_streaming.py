"""Streams over small files, run to completion."""

from pyspark.sql import functions as F

from corvane.streaming import jobs


def test_publish_merges_and_is_idempotent(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    rows = [("s", 0, "a b c"), ("s", 1, "b c d"), ("r", 0, "x"), ("s", 1, "b c d")]
    spark.createDataFrame(rows, "session string, seq bigint, text string").write.parquet(str(src))
    stream = spark.readStream.schema("session string, seq bigint, text string").parquet(str(src))
    for _ in range(2):
        jobs.publish(stream, out, str(tmp_path / "cp")).awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
    q = jobs.merge_transcripts(stream, "session", "seq", "text").writeStream.outputMode("update").format("memory").queryName("said").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(r.session, r.transcript) for r in spark.sql("select * from said").collect()} == {("s", "a b c d"), ("r", "x")}


def test_dedup_and_windows(spark, tmp_path):
    src = tmp_path / "ev"
    d = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:30"), (2, "2024-01-01 00:07:00")], "k int, ts string").withColumn("ts", F.to_timestamp("ts"))
    d.write.parquet(str(src))
    stream = spark.readStream.schema(d.schema).parquet(str(src))
    for name, frame, mode, want in (
        ("once", jobs.dedup(stream, ["k"], "ts"), "append", 2),
        ("tiles", jobs.tumbling(stream, "ts", "5 minutes", ["k"], [F.count("*").alias("n")]), "update", 2),
        ("runs", jobs.sessions(stream, "ts", "1 minute", ["k"], [F.count("*").alias("n")]), "complete", 2),
    ):
        q = frame.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert spark.sql(f"select * from {name}").count() == want


def test_results(spark):
    items = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "k string, generation int")
    done = spark.createDataFrame([("a", "accepted", 0, None), ("b", "rejected", 0, "bad"), ("c", "rejected", 0, "bad")], "k string, status string, generation int, reason string")
    assert [r.k for r in jobs.pending(items, done, "k").collect()] == ["c"]
    assert sorted((r.k, r.generation) for r in jobs.retry(items, done, "k").collect()) == [("b", 1), ("c", 1)]
    new = spark.createDataFrame([("a", "rejected", 1, "late"), ("b", "accepted", 1, None)], done.schema)
    assert {r.k: r.status for r in jobs.upsert(done, new, "k").collect()} == {"a": "accepted", "b": "accepted", "c": "rejected"}
