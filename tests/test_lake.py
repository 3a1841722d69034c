"""Stored tables: newest rows, partition pruning, named queries end to end."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from finlake.lake import Lake
from finlake.plans import functions
from tests.conftest import rows


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lk = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    days = spark.range(800).select(F.date_add(F.lit("2022-01-03").cast("date"), F.col("id").cast("int")).alias("day"), F.col("id").alias("i"))
    names = F.array(*[F.struct(F.lit(t).alias("ticker"), F.lit(k).alias("k")) for t, k in (("SPY", 1.0), ("AAA", 2.0), ("BBB", 3.0))])
    b = days.select("day", "i", F.inline(names)).select(
        "ticker", "day", *[(100 + F.col("k") * (F.col("i") % 17) + F.col("i") * 0.1).alias(c) for c in ("open", "close")],
        (F.lit(200.0) + F.col("i")).alias("high"), F.lit(1.0).alias("low"), (F.col("i") + 1).alias("volume"), F.lit(None).cast("double").alias("vwap"),
        F.lit(1).cast("long").alias("transactions"), F.lit("t").alias("source"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at"))
    lk.load("ohlcv_daily", b)
    fix = b.filter((F.col("ticker") == "AAA") & (F.col("day") == "2022-01-03")).withColumn("close", F.lit(1.5)).withColumn("ingested_at", F.lit("2024-02-01").cast("timestamp"))
    lk.load("ohlcv_daily", fix)
    u = spark.createDataFrame([(t, f"{t} Inc", "2834", "NYSE", 1e12) for t in ("AAA", "BBB", "SPY")], "ticker string, name string, sic_code string, exchange string, market_cap double")
    lk.load("universe", u.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp")))
    lk.load("universe", u.filter("ticker = 'AAA'").withColumns({"name": F.lit("New Inc"), "updated_at": F.lit("2024-02-01").cast("timestamp")}))
    chain = spark.range(6).select(
        F.when(F.col("id") < 3, "SPY").otherwise("OLD").alias("underlying"), F.lit("2024-12-20").cast("date").alias("expiration"), F.lit(100.0).alias("strike"), F.lit("call").alias("put_call"),
        F.expr("CASE WHEN id < 3 THEN date_add(DATE'2024-03-01', CAST(id AS INT)) ELSE date_add(DATE'2023-05-01', CAST(id AS INT)) END").alias("snapshot_date"), F.col("id").alias("volume"),
        F.lit(0.2).alias("implied_vol"), F.lit(90.0).alias("underlying_price"), F.lit("2024-01-01").cast("timestamp").alias("ingested_at"))
    lk.load("option_chains", chain)
    trades = chain.select("underlying", F.col("snapshot_date").alias("trade_date"), "expiration", "strike", "put_call", F.col("snapshot_date").cast("timestamp").alias("trade_timestamp"), F.col("volume").alias("sequence"),
                          F.lit(50_000.0).alias("notional"), F.lit("buy").alias("aggressor_side"), "ingested_at")
    lk.load("option_trades", trades, "month")
    return lk


def _filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x.split("], ")[0] for x in plan.split("PartitionFilters: [")[1:]]


def test_tables_without_a_date_load_and_take_new_versions(lake):
    assert sorted(rows(lake.table("universe"), "ticker", "name")) == [("AAA", "New Inc"), ("BBB", "BBB Inc"), ("SPY", "SPY Inc")]


def test_snapshots_are_an_underlyings_own_newest_and_read_one_partition(lake):
    for name, day in (("SPY", dt.date(2024, 3, 3)), ("OLD", dt.date(2023, 5, 6))):
        snap = lake._snap(name)
        assert [r.snapshot_date for r in snap.collect()] == [day]
        assert all(str(day.year) in f for f in _filters(snap)) and _filters(snap)
        assert [r.latest_date for r in lake.latest_trade_date(name).collect()] == [day]
        surface = lake.flow_surface(name)
        assert {r.trade_date for r in surface.collect()} == {day}
        assert all(f"{day:%Y%m}" in f for f in _filters(surface)) and _filters(surface)
        assert lake._lately(name).count() == 3


def test_stored_breadth_is_served(lake):
    lake.store_breadth()
    assert lake.breadth_status(5).count() == 5
    assert lake.table("zbt_breadth").count() == lake.breadth_thrust().count()


def test_newest_version_is_served(lake):
    d = lake.daily("2022-01-03", "2022-01-03")
    assert rows(d.filter("ticker = 'AAA'"), "close") == [(1.5,)]
    assert lake.daily().count() == 2400


def test_dates_prune_partitions(lake):
    plan = lake.daily("2024-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "2024" in plan


def test_named_queries(lake):
    last = dt.date(2022, 1, 3) + dt.timedelta(799)
    assert lake.top_movers().count() == 3
    assert [r.day for r in lake.latest_prices(["AAA"]).collect()] == [last]
    assert lake.beta().count() == 2
    assert lake.hilo_counts().first().total == 3
    assert lake.correlation_matrix(["AAA", "BBB", "SPY"]).count() == 3
    assert lake.indicator("rsi", ["AAA"], n=14).count() == 800 - 14
    assert lake.sector_performance().first().sector == "Pharma"
    assert lake.breadth_thrust().count() > 700
    assert lake.sql("SELECT count(*) AS n FROM ohlcv_daily").first().n == 2400
    assert ("close", "double") in lake.columns("ohlcv_daily")


def test_table_functions_take_arguments(lake):
    d = lake.sql("SELECT * FROM daily_returns('AAA', DATE '2022-01-04', DATE '2022-01-05')")
    assert sorted(rows(d, "day", "prev_close")) == [(dt.date(2022, 1, 4), 1.5), (dt.date(2022, 1, 5), pytest.approx(102.1))]
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(ticker,AAA)" in plan
    assert lake.sql("SELECT * FROM daily_returns(NULL, NULL, NULL)").count() == 2400
    top = lake.sql("SELECT m.ticker, u.name FROM daily_movers(DATE '2022-02-01', 1) m JOIN universe u USING (ticker)").collect()
    assert len(top) == 1
    assert {r.underlying for r in lake.sql("SELECT * FROM snapshot_of('SPY', NULL)").collect()} == {"SPY"}


def test_own_table_function(lake, monkeypatch):
    monkeypatch.setattr(functions, "FUNCTIONS", dict(functions.FUNCTIONS))

    @functions.table_function("volume_between", ("ohlcv_daily",), "first_day DATE, last_day DATE", functions.between("day"))
    def volume(lk):
        return lk.daily().select("ticker", "day", "volume")

    assert rows(lake.sql("SELECT max(volume) FROM volume_between(NULL, DATE '2022-01-12')")) == [(10,)]
    with pytest.raises(ValueError):
        functions.table_function("no name", (), "", "true")


def test_functions_without_their_tables_are_unknown(lake):
    with pytest.raises(Exception, match="statements_of"):
        lake.sql("SELECT * FROM statements_of(NULL, 'annual')")
