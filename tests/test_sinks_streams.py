"""Sinks are idempotent; batch and stream roll-ups agree; late and repeated rows."""

import datetime as dt

from pyspark.sql import functions as F

from finlake.operators.bars import bars_from_ticks, ohlcv_bars
from finlake.sources import sinks
from finlake.streaming import jobs
from tests.conftest import rows


def bars(spark, closes, loaded):
    data = [("A", dt.date(2023 + i, 1, 2), c, loaded) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, "ticker string, day date, close double, ingested_at int")


def test_upsert_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    load = lambda d: sinks.upsert(spark, d, path, "day", ["ticker", "day"], ["ingested_at"])
    load(bars(spark, [1.0, 2.0], 1))
    load(bars(spark, [1.5], 2))
    load(bars(spark, [1.5], 2))
    assert rows(spark.read.parquet(path), "close", "year") == [(1.5, 2023), (2.0, 2024)]
    load(bars(spark, [9.0], 0))
    assert rows(spark.read.parquet(path), "close") == [(1.5,), (2.0,)]


def test_copy_by_month_reconciles(spark, tmp_path):
    d = spark.range(100).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    out = sinks.copy_by_month(d, str(tmp_path / "m"), "day", ["id"]).collect()
    assert len(out) == 4 and all(r.matches for r in out)
    assert sinks.reconcile(d.withColumn("ym", F.lit(1)), d.limit(3).withColumn("ym", F.lit(2)), "ym").filter("matches").count() == 0


def ticks(spark, n=400):
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("ticker"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 37).alias("timestamp"),
                                 (F.col("id") % 11 + 1).cast("double").alias("price"), (F.col("id") % 5 + 1).alias("size"), F.col("id").alias("seq"))


def test_stream_bars_equal_batch_bars(spark, tmp_path):
    d = ticks(spark)
    d.filter("seq < 200").coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    d.filter("seq >= 200").coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    src = spark.readStream.schema(d.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.start_sink(jobs.stream_bars(src, "5m", seq="seq"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    last = d.agg(F.max("timestamp")).first()[0] - dt.timedelta(minutes=15)
    want = bars_from_ticks(d, "ticker", "timestamp", "price", "size", "5m", "seq").filter(F.col("bucket") <= F.lit(last))
    assert rows(got, *want.columns) == rows(want)


def test_late_row_is_ignored(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 10, m)
    schema = "ticker string, timestamp timestamp, price double, size long, seq long"
    batches = [[("A", t(1), 1.0, 1, 1)], [("A", t(30), 2.0, 1, 2)], [("A", t(2), 9.0, 1, 3), ("A", t(50), 3.0, 1, 4)]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        jobs.start_sink(jobs.stream_bars(src, "5m", seq="seq"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")), "bucket", "high") == [(t(0), 1.0), (t(30), 2.0)]


def test_redelivered_rows_are_dropped(spark, tmp_path):
    d = ticks(spark, 50)
    for i in range(2):
        d.coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    src = spark.readStream.schema(d.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    jobs.start_sink(jobs.dedup_stream(src, ["seq"], watermark="1 day"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 50


def test_rollup_invariants(spark):
    d = ticks(spark, 3000)
    minute = bars_from_ticks(d, "ticker", "timestamp", "price", "size", "1m", "seq", "timestamp")
    five = ohlcv_bars(minute, "ticker", "timestamp", "5m", out="timestamp")
    direct, via = ohlcv_bars(minute, "ticker", "timestamp", "1d"), ohlcv_bars(five, "ticker", "timestamp", "1d")
    cols = ["ticker", "bucket", "open", "high", "low", "close", "volume", "transactions"]
    assert rows(direct, *cols) == rows(via, *cols)
    assert direct.agg(F.sum("volume")).first()[0] == d.agg(F.sum("size")).first()[0]
    assert direct.filter("high < low OR high < open OR low > close").count() == 0


def landed(spark, tmp_path, batches, schema, rows_of, **sink):
    """Run a stream over a few batches of rows, one micro-batch each; the last progress of every run, and the sink's path."""
    progress = []
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        q = jobs.start_sink(rows_of(src), str(tmp_path / "out"), str(tmp_path / "state"), **sink)
        q.awaitTermination()
        progress.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]])
    return progress, str(tmp_path / "out")


TICK = "ticker string, timestamp timestamp, price double, size long, seq long"


def test_bar_chain_is_the_batch_roll_up(spark, tmp_path):
    """All grains from one query over three batches, two of them with late ticks: one for an open bar, one for a closed one."""
    t = lambda h, m, s=0: dt.datetime(2024, 1, 1, h, m, s)
    batches = [[("A", t(10, 1), 1.0, 1, 1), ("A", t(10, 1), 7.0, 2, 2), ("B", t(10, 4), 5.0, 1, 3), (None, t(10, 1), 1.0, 1, 4), ("A", None, 1.0, 1, 5)],
               [("A", t(10, 2), 0.5, 4, 6), ("A", t(11, 30), 2.0, 1, 7)],
               [("A", t(10, 3), 99.0, 1, 8), ("A", t(11, 31), 3.0, 1, 9), ("B", dt.datetime(2024, 1, 2, 0, 30), 6.0, 2, 10)]]
    _, out = landed(spark, tmp_path, batches, TICK, lambda d: jobs.stream_bar_chain(d, seq="seq"), by="grain")
    got = spark.read.parquet(out)
    on_time = spark.createDataFrame([r for b in batches for r in b if r[0] and r[1] and r[4] != 8], TICK)
    for grain, closed in (("5m", 5), ("15m", 15), ("1h", 60), ("1d", 1440)):
        want = bars_from_ticks(on_time, "ticker", "timestamp", "price", "size", grain, "seq").withColumn("bucket", F.col("bucket").cast("timestamp"))
        want = want.filter(F.col("bucket") <= F.lit(dt.datetime(2024, 1, 2, 0, 20) - dt.timedelta(minutes=closed)))
        assert want.count() and rows(got.filter(F.col("grain") == grain), *want.columns) == rows(want), grain


def test_chain_grains_have_to_nest(spark):
    import pytest
    with pytest.raises(ValueError, match="multiple"):
        jobs.stream_bar_chain(ticks(spark), ("15m", "5m"))


def test_idle_keys_leave_the_state(spark, tmp_path):
    """The state grows with open minutes and is empty but for the newest ones after an idle day."""
    start = dt.datetime(2024, 1, 1, 10)
    many = [(f"k{i % 20}", start + dt.timedelta(seconds=30 * i), 1.0, 1 + 50 * (i == 390), i) for i in range(400)]
    batches = [many, [("late", start + dt.timedelta(days=1), 1.0, 1, 1000)], [("late", start + dt.timedelta(days=2), 1.0, 1, 1001)]]
    progress, out = landed(spark, tmp_path, batches, TICK, lambda d: jobs.volume_spikes(d, volume="size"))
    assert max(progress[0]) > 100 and progress[2][-1] < 10
    assert rows(spark.read.parquet(out), "ticker", "volume") == [("k10", 51.0)]


def test_recent_rows_leave_with_the_watermark(spark, tmp_path):
    t = lambda m: dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=m)
    told = []
    src_schema = "ticker string, timestamp timestamp, close double"
    batches = [[("A", t(0), 1.0), ("A", t(0), 2.0), ("A", t(30), 3.0), ("B", t(5), 4.0), ("A", t(31), None)], [("B", t(75), 5.0)], [("C", t(500), 6.0)]]
    for i, b in enumerate(batches):
        spark.createDataFrame(b, src_schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
        src = spark.readStream.schema(src_schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        q = jobs.recent_rows(src).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        q.foreachBatch(lambda d, n: told.append([tuple(r) for r in d.collect()])).start().awaitTermination()
    last = {}
    for batch in told[:-1]:
        last |= {r[0]: r[1:] for r in batch}
    flat = [r for batch in told for r in batch]
    assert ("A", t(30), 3.0, 3) in flat and ("A", t(30), 3.0, 1) in flat  # 65 minutes on, only the row of minute 30 is left
    assert ("A", None, None, 0) in flat and ("B", None, None, 0) in flat and flat[-1][0] in "ABC" and ("C", t(500), 6.0, 1) in flat


def test_recent_rows_are_held_by_panes(spark, tmp_path):
    """The state grows with the panes that rows fall into, not with rows; what is told is that of a table of all rows."""
    start, schema = dt.datetime(2024, 1, 1), "ticker string, timestamp timestamp, close double"
    batches = [[("A", start + dt.timedelta(milliseconds=4321 * i), float(i % 97)) for i in range(3000)], [("A", start + dt.timedelta(hours=4), 5.0), ("A", start + dt.timedelta(hours=3, minutes=30), 1.0), ("A", start + dt.timedelta(hours=4), 7.0)],
               [("A", start + dt.timedelta(hours=4, minutes=40), 2.0)]]
    told, held = [], []
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{i}"))
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        q = jobs.recent_rows(src).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        q = q.foreachBatch(lambda d, n: told.append([tuple(r) for r in d.collect()])).start()
        q.awaitTermination()
        held += [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
        every = [r for x in batches[:i + 1] for r in x]
        last = max(r[1] for r in every)
        mark = last - dt.timedelta(minutes=10)
        mark = mark.replace(microsecond=mark.microsecond // 1000 * 1000)
        live = [r for r in every if r[1] + dt.timedelta(hours=1) >= mark]
        assert [x for x in told if x][-1] == [("A", last, max(r[2] for r in every if r[1] == last), len(live))]
    assert told[0] == [("A", batches[0][-1][1], batches[0][-1][2], 3000)] and max(held) < 1000


def test_sliding_windows_add_up_panes(spark, tmp_path):
    d = ticks(spark)
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))
    jobs.start_sink(jobs.stream_vwap(src, "1 hour", "1 minute"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    last = d.agg(F.max("timestamp")).first()[0] - dt.timedelta(minutes=70)
    want = d.groupBy(F.window("timestamp", "1 hour", "1 minute").start.alias("bucket"), "ticker").agg(F.sum(F.col("price") * F.col("size")).alias("notional"), F.sum("size").alias("volume"))
    want = want.filter(F.col("bucket") <= F.lit(last - dt.timedelta(minutes=1)))
    assert want.count() > 100 and set(rows(want, "ticker", "bucket", "notional", "volume")) <= set(rows(got, "ticker", "bucket", "notional", "volume"))
