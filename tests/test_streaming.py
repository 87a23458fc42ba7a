from docketlake.streaming import incremental


def test_upsert_stream(spark, tmp_path):
    landing, target, mark = str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").coalesce(1).write.parquet(landing)
    stream = incremental.landing(spark, landing, "k int, v string")
    incremental.upsert_sink(stream, target, ["k"], mark).awaitTermination()
    spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string").coalesce(1).write.mode("append").parquet(landing)
    incremental.upsert_sink(incremental.landing(spark, landing, "k int, v string"), target, ["k"], mark).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{target}/v=1").collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_windowed_counts(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.sql("select timestamp'2024-01-01 00:00:01' ts, 'a' k union all select timestamp'2024-01-01 00:05:00', 'a' union all select timestamp'2024-01-01 00:00:02', 'a'").write.parquet(landing)
    counts = incremental.windowed_counts(incremental.landing(spark, landing, "ts timestamp, k string"), "ts", "1 minute", "10 minutes", "k")
    q = counts.writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["n"] for r in spark.table("counted").collect()) == [1, 2]


def test_pending(spark):
    batch, proofs = spark.createDataFrame([(1,), (2,)], "d int"), spark.createDataFrame([(2,), (2,)], "d int")
    assert [r[0] for r in incremental.pending_documents(batch, proofs, "d").collect()] == [1]


def test_upsert_goes_on_after_a_restart(spark, tmp_path):
    """A query that stops and starts again takes up new files only, and a batch run twice changes nothing."""
    from docketlake.streaming.incremental import landing, upsert_sink

    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "k string, v int"
    latest = lambda: sorted(tuple(r) for r in spark.read.parquet(max((str(p) for p in (tmp_path / "out").glob("v=*")), key=lambda p: int(p.rsplit("=", 1)[1]))).collect())

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        upsert_sink(landing(spark, source, schema), target, ["k"], checkpoint).awaitTermination()

    land([("a", 1), ("b", 1)])
    assert latest() == [("a", 1), ("b", 1)]
    land([("b", 2), ("c", 2)])
    assert latest() == [("a", 1), ("b", 2), ("c", 2)]
    # nothing new landed
    upsert_sink(landing(spark, source, schema), target, ["k"], checkpoint).awaitTermination()
    assert latest() == [("a", 1), ("b", 2), ("c", 2)]
