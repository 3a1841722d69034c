"""Structured Streaming jobs.  Sources are any streaming DataFrame (files or a broker)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from finlake.functions.exprs import order_key, safe_div
from finlake.operators.bars import GRAINS
from finlake.operators.quality import with_reasons
from finlake.schemas import BAR_MESSAGE, QUOTE_MESSAGE
from finlake.streaming import stateful


# ---- messages ---------------------------------------------------------------------

def parse_envelope(messages: DataFrame, schema: str, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON messages -> typed rows; the original text is kept next to them for rejects."""
    d = messages.select(*keep, F.col(value).cast("string").alias("original"))
    d = d.withColumn("_m", F.from_json("original", schema))
    return d.select(*keep, "original", "_m.*")


def quotes(messages: DataFrame, value: str = "value") -> DataFrame:
    d = parse_envelope(messages, QUOTE_MESSAGE, value)
    return d.select("original", "ticker", F.timestamp_millis("timestamp").alias("timestamp"), "source", "quote.*")


def stream_bar_rows(messages: DataFrame, value: str = "value") -> DataFrame:
    """Bar messages -> ``ohlcv`` rows stamped with the bar's own minute."""
    d = parse_envelope(messages, BAR_MESSAGE, value)
    return d.select("ticker", F.timestamp_millis("ohlcv.chart_time").alias("timestamp"), "ohlcv.open", "ohlcv.high", "ohlcv.low",
                    "ohlcv.close", "ohlcv.volume", "source")


# ---- windowed aggregates ----------------------------------------------------------

def stream_bars(ticks: DataFrame, grain: str, watermark: str = "10 minutes", key: str = "ticker", ts: str = "timestamp",
                price: str = "price", size: str = "size", seq: str | None = None) -> DataFrame:
    """Tumbling price bars from trades, with the same columns as the batch roll-up."""
    p, q = F.col(price), F.col(size)
    order = order_key(ts, seq) if seq else F.col(ts)
    g = ticks.withWatermark(ts, watermark).groupBy(F.window(ts, GRAINS[grain]), key).agg(
        F.min_by(p, order).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"), F.max_by(p, order).alias("close"),
        F.sum(q).alias("volume"), safe_div(F.sum(p * q), F.sum(q)).alias("vwap"), F.count(F.lit(1)).alias("transactions"))
    return g.select(key, F.col("window.start").alias("bucket"), "open", "high", "low", "close", "volume", "vwap", "transactions")


def stream_bar_chain(ticks: DataFrame, grains: tuple[str, ...] = ("5m", "15m", "1h", "1d"), watermark: str = "10 minutes", key: str = "ticker",
                     ts: str = "timestamp", price: str = "price", size: str = "size", seq: str | None = None) -> DataFrame:
    """Bars of all grains from one reading of the ticks: each grain rolls up the closed bars of the one before it.

    One query, whose rows say their grain; ``start_sink(..., by="grain")`` lands every grain in a folder of its own.  Each grain has to be a
    multiple of the one before it.  A late tick counts as long as its finest bar is open; ticks without a key, time, price or size are left out.
    """
    seconds = [pd.Timedelta(GRAINS[g]).total_seconds() for g in grains]
    if any(b % a for a, b in zip(seconds, seconds[1:])):
        raise ValueError("each grain has to be a multiple of the one before it")
    parts = stateful.partial_bars(ticks, int(seconds[0]), key, ts, price, size, seq).withWatermark("last", watermark)
    kind = ticks.schema[key].dataType.simpleString()
    out = stateful.keyed(parts, stateful.Chain([int(s) for s in seconds]), f"grain int, key {kind}, bucket long, open double, high double, low double, close double, volume long, notional double, n long")
    return out.select(F.element_at(F.array(*map(F.lit, grains)), F.col("grain") + 1).alias("grain"), F.col("key").alias(key), F.timestamp_seconds("bucket").alias("bucket"),
                      "open", "high", "low", "close", "volume", safe_div("notional", "volume").alias("vwap"), F.col("n").alias("transactions"))


def stream_latest(rows: DataFrame, key: str = "ticker", ts: str = "timestamp", value: str = "close") -> DataFrame:
    """Latest value per key, kept continuously (update or complete mode); of rows with one time the largest value."""
    return rows.groupBy(key).agg(F.max(ts).alias(ts), F.max_by(value, F.struct(ts, value)).alias(value))


def stream_vwap(ticks: DataFrame, window: str = "1 minute", slide: str | None = None, watermark: str = "10 minutes",
                key: str = "ticker", ts: str = "timestamp", price: str = "price", size: str = "size") -> DataFrame:
    """Volume-weighted price and its parts per window; the parts of minutes add up to hours.

    A sliding window adds up tumbling panes of one slide, so a tick is counted once and only a pane, of which there is one
    for each key and slide, goes into several windows.
    """
    g = ticks.withWatermark(ts, watermark).groupBy(F.window(ts, slide or window), key).agg(
        F.sum(F.col(price) * F.col(size)).alias("notional"), F.sum(size).alias("volume"))
    if slide:
        g = g.groupBy(F.window(F.window_time("window"), window, slide), key).agg(F.sum("notional").alias("notional"), F.sum("volume").alias("volume"))
    return g.select(key, F.col("window.start").alias("bucket"), "notional", "volume", safe_div("notional", "volume").alias("vwap"))


def recent_rows(rows: DataFrame, horizon: str = "1 hour", watermark: str = "10 minutes", key: str = "ticker", ts: str = "timestamp",
                value: str = "close") -> DataFrame:
    """(key, newest time, its value, rows): what each key's last ``horizon`` up to the watermark holds, told whenever it changes (update mode).

    The state is the table's times, packed by panes of a 64th of the horizon; rows leave it when the watermark has passed them by the horizon.  A
    key whose rows have all left is told once more, without a value and with 0 rows.  Of rows with one time the largest value counts.
    """
    flat = rows.select(F.col(key).alias("key"), F.col(ts).alias("at"), F.unix_micros(ts).alias("us"), F.col(value).cast("double").alias("value")).filter("key IS NOT NULL AND at IS NOT NULL AND value IS NOT NULL")
    out = stateful.keyed(flat.withWatermark("at", watermark), stateful.Recent(int(pd.Timedelta(horizon).total_seconds() * 1000)),
                         f"key {rows.schema[key].dataType.simpleString()}, newest long, value double, rows long", "Update")
    return out.select(F.col("key").alias(key), F.timestamp_micros("newest").alias(ts), F.col("value").alias(value), "rows")


def recent(rows: DataFrame, horizon: str = "1 hour", watermark: str = "10 minutes", key: str = "ticker", ts: str = "timestamp",
           value: str = "close") -> DataFrame:
    """Rolling last-``horizon`` summary per key; the watermark expires older windows from state.  Of rows with one time the largest value counts."""
    g = rows.withWatermark(ts, watermark).groupBy(F.window(ts, horizon, "1 minute" if horizon == "1 hour" else horizon), key).agg(
        F.max_by(value, F.struct(ts, value)).alias(value), F.count(F.lit(1)).alias("rows"))
    return g.select(key, F.col("window.start").alias("since"), F.col("window.end").alias("until"), value, "rows")


def dedup_stream(rows: DataFrame, keys: list[str], ts: str = "timestamp", watermark: str = "10 minutes") -> DataFrame:
    """Drop redelivered rows; keys are remembered for the watermark delay."""
    return rows.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


# ---- stateful alert ---------------------------------------------------------------

def volume_spikes(rows: DataFrame, factor: float = 3.0, horizon_seconds: int = 3600, watermark: str = "10 minutes",
                  key: str = "ticker", ts: str = "timestamp", volume: str = "volume") -> DataFrame:
    """Minutes whose volume exceeds ``factor`` times the mean minute of the hour up to them.

    Ticks are first summed per key and minute inside each task, so a hot key reaches its
    stateful task as a few rows per partition and minute.  The state of a key holds a row for each of its
    open minutes and of the last hour of closed ones; a minute is judged once the watermark
    has passed it.  A key that stays idle for the horizon loses its state.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["minute"] = b["minute"].dt.floor("min")
            yield b.groupby(["key", "minute"], as_index=False)["volume"].sum()

    minutes = rows.select(F.col(key).alias("key"), F.col(ts).alias("minute"), F.col(volume).cast("double").alias("volume"))
    minutes = minutes.mapInPandas(partial, "key string, minute timestamp, volume double").withWatermark("minute", watermark).withColumn("start", F.unix_seconds("minute"))

    out = stateful.keyed(minutes, stateful.Spikes(factor, horizon_seconds), "key string, minute long, volume double, mean_volume double")
    return out.select(F.col("key").alias(key), F.timestamp_seconds("minute").alias(ts), "volume", "mean_volume")


def volume_spikes_batch(bars: DataFrame, factor: float = 3.0, horizon_seconds: int = 3600, key: str = "ticker", ts: str = "timestamp",
                        volume: str = "volume") -> DataFrame:
    """The same alert over stored rows."""
    from finlake.operators.series import mean_over_range

    m = bars.groupBy(F.window(ts, "1 minute").start.alias("minute"), key).agg(F.sum(volume).cast("double").alias("volume"))
    m = mean_over_range(m, key, "minute", horizon_seconds, "volume", "mean_volume")
    return m.filter(F.col("volume") > factor * F.col("mean_volume")).select(key, F.col("minute").alias(ts), "volume", "mean_volume")


# ---- sinks ------------------------------------------------------------------------

def route_dead_letters(rules: dict[str, Column], good_path: str, bad_path: str, topic: str = "") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer: valid rows to one sink, rejects with reasons to another.

    Each batch writes to its own folder in overwrite mode, so a replayed batch after a
    failure replaces its earlier attempt instead of adding duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        d = with_reasons(batch, rules).persist()
        try:
            good = d.filter(F.size("reasons") == 0).drop("reasons")
            good.write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            bad = d.filter(F.size("reasons") > 0).select(
                F.lit(topic).alias("original_topic"), F.col("ticker").alias("original_key"), F.col("original").alias("original_value"),
                F.concat_ws(", ", "reasons").alias("error_message"), F.lit("ValidationError").alias("error_type"),
                F.current_timestamp().alias("failed_at"))
            bad.write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            d.unpersist()
    return write


def start_sink(rows: DataFrame, path: str, checkpoint: str, trigger: str | None = None, by: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet, in folders by a column if one is named; offsets are committed after each written batch.

    ``trigger`` is a processing-time interval; without one all available data is loaded and
    the query stops.
    """
    w = rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    w = w.partitionBy(by) if by else w
    w = w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)
    return w.start()


def read_landed(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000, fmt: str = "json") -> DataFrame:
    """File stream with a bounded number of files per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)

