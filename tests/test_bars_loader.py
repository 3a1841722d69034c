"""Minute-bar and candle payloads: shape, types, empty input, bad rows, duplicates."""

import json

from pyspark.sql import functions as F

from finlake import schemas as S
from finlake.operators.quality import bar_report, validate_bars
from finlake.sources import common
from finlake.sources.bars import bars_from_aggs, bars_from_candles, daily_from_grouped

COLUMNS = ["ticker", "timestamp", "open", "high", "low", "close", "volume", "vwap", "transactions", "source", "ingested_at"]
MINUTES = [
    {"t": 1743494400000, "o": 170.0, "h": 171.0, "l": 169.5, "c": 170.5, "v": 1000, "vw": 170.2, "n": 50},
    {"t": 1743494460000, "o": 170.5, "h": 172.0, "l": 170.0, "c": 171.5, "v": 1500, "vw": 171.0, "n": 75},
    {"t": 1743494520000, "o": 171.5, "h": 171.5, "l": 170.5, "c": 171.0, "v": 800},
]
CANDLES = [{"datetime": 1704067200000 + i * 86400000, "open": 10.0 + i, "high": 12.0 + i, "low": 9.0 + i, "close": 11.0 + i, "volume": 100 * i} for i in range(3)]


def load(spark, payload, schema):
    d = spark.createDataFrame([("X", json.dumps(r)) for r in payload], "ticker string, payload string")
    return common.parse_text(d, "payload", schema, ("ticker",))


def test_minute_shape_and_types(spark):
    d = bars_from_aggs(load(spark, MINUTES, S.MINUTE_BARS))
    assert d.columns == COLUMNS
    assert d.count() == 3
    types = dict(d.dtypes)
    assert types["timestamp"] == "timestamp" and types["volume"] == "bigint" and types["vwap"] == "double" and types["transactions"] == "bigint"
    first = d.orderBy("timestamp").first()
    assert str(first.timestamp) == "2025-04-01 08:00:00" and first.source == "polygon_backfill"
    assert d.filter("vwap IS NULL AND transactions IS NULL").count() == 1


def test_candles_have_no_vwap(spark):
    d = bars_from_candles(load(spark, CANDLES, S.DAILY_CANDLES))
    assert d.columns == COLUMNS and d.count() == 3
    assert d.filter("vwap IS NULL AND transactions IS NULL AND source = 'schwab'").count() == 3


def test_empty_input_keeps_schema(spark):
    d = bars_from_aggs(load(spark, MINUTES, S.MINUTE_BARS).limit(0))
    assert d.columns == COLUMNS and d.count() == 0


def test_bad_row_is_dropped(spark):
    bad = {"o": 200.0, "c": 200.0, "h": 195.0, "l": 205.0, "t": 1743494580000, "v": 1}
    d = bars_from_aggs(load(spark, MINUTES + [bad], S.MINUTE_BARS))
    assert d.count() == 4 and validate_bars(d).count() == 3
    report = bar_report(d).first()
    assert (report.input_rows, report.disordered_rows, report.output_rows) == (4, 1, 3)


def test_duplicate_keeps_last_loaded(spark):
    d = bars_from_aggs(load(spark, MINUTES, S.MINUTE_BARS), ingested_at=F.lit("2024-01-01").cast("timestamp"))
    again = bars_from_aggs(load(spark, [{**MINUTES[0], "c": 170.9}], S.MINUTE_BARS), ingested_at=F.lit("2024-01-02").cast("timestamp"))
    out = validate_bars(d.unionByName(again))
    assert out.count() == 3
    assert out.orderBy("timestamp").first().close == 170.9


def test_grouped_daily_filters(spark):
    base = {"o": 1.0, "h": 2.0, "l": 1.0, "c": 1.5, "v": 10, "vw": 1.2, "n": 3}
    days = [{"T": "A", **base}, {"T": "B", **base, "h": 0.5}, {"T": "C", **base, "v": 0}, {"T": "D", **base, "c": 0.0}, {"T": "E", **base}]
    d = load(spark, days, S.GROUPED_DAILY).withColumn("day", F.lit("2024-01-02"))
    keep = spark.createDataFrame([("A",), ("B",)], "ticker string")
    assert sorted(r.ticker for r in daily_from_grouped(d).collect()) == ["A", "E"]
    assert [r.ticker for r in daily_from_grouped(d, tickers=keep).collect()] == ["A"]


def test_universe_file(spark, tmp_path):
    (tmp_path / "u.txt").write_text(" aapl \n\nMSFT\nmsft\n")
    assert sorted(r.ticker for r in common.read_universe(spark, str(tmp_path / "u.txt")).collect()) == ["AAPL", "MSFT"]


def test_join_on_parsed_fields_parses_each_text_once(spark):
    """A join's filters on its keys do not parse again; texts that are missing or broken give rows without values."""
    from finlake.sources import options

    text = lambda strike, **more: json.dumps({"symbol": "SPY", "expiration": "2024-03-15", "strike": strike, "right": "CALL", **more})
    d = spark.createDataFrame([(text(1.0, bid=0.5),), (text(2.0, bid=0.7),), ("{bad",), (None,)], "payload string")
    oi = spark.createDataFrame([(text(1.0, open_interest="7"),), (text(1.0, open_interest="-"),), (None,)], "payload string")
    chain = options.chain_from_greeks(common.parse_text(d, "payload", S.OPTION_GREEKS), F.lit("2024-01-01")).select("underlying", "expiration", "strike", "put_call", "bid")
    oi = options.oi_from_ndjson(common.parse_text(oi, "payload", S.OPEN_INTEREST)).groupBy("underlying", "expiration", "strike", "put_call").agg(F.max("open_interest").alias("open_interest"))
    out = options.merge_chain_oi(chain, oi)
    assert sorted((str(r.strike), str(r.bid), r.open_interest) for r in out.collect()) == [("1.0", "0.5", 7), ("2.0", "0.7", 0), ("None", "None", 0), ("None", "None", 0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
