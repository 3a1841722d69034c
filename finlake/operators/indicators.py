"""Technical indicators for all keys at once.

Frames use window functions; recurrences (EMA, RSI, MACD) are written as
``y = a*y_prev + b`` and solved by :meth:`OrderedSeries.scan`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import names, pct_change, pct_of, safe_div
from finlake.operators.series import OrderedSeries, Recurrence, Split, over_rows


def _present(df: DataFrame, price: str) -> DataFrame:
    """Rows that have a price: a recurrence passes over the others, whether a series is split or not."""
    d = df.filter(F.col(price).isNotNull())
    return d.filter(~F.isnan(price)) if dict(df.dtypes)[price] in ("double", "float") else d


def _full(w, n: int):
    f = w.rowsBetween(-(n - 1), 0)
    return f, F.count(F.lit(1)).over(f) == n


def sma(df: DataFrame, key, time: str, price: str, n: int, seq=None, split: Split | None = None,
        out: str = "sma") -> DataFrame:
    """Mean of the last ``n`` rows, only where ``n`` rows exist."""
    def build(w):
        f, full = _full(w, n)
        return {out: F.when(full, F.avg(price).over(f))}
    return over_rows(df, key, time, build, n - 1, seq, split).filter(F.col(out).isNotNull())


def bollinger(df: DataFrame, key, time: str, price: str, n: int = 20, k: float = 2.0, seq=None,
              split: Split | None = None) -> DataFrame:
    def build(w):
        f, full = _full(w, n)
        return {"middle": F.when(full, F.avg(price).over(f)), "_sd": F.stddev_pop(price).over(f)}
    d = over_rows(df, key, time, build, n - 1, seq, split).filter(F.col("middle").isNotNull())
    return (d.withColumn("upper", F.col("middle") + k * F.col("_sd"))
            .withColumn("lower", F.col("middle") - k * F.col("_sd")).drop("_sd"))


def _ema(x: Column, w, n: int, seed: str, start: int = 0) -> tuple[Column, float, int]:
    """(input term, decay, seed position) of an EMA whose input begins at position ``start``."""
    k = 2.0 / (n + 1)
    first = start if seed == "first" else start + n - 1
    init = x if seed == "first" else F.avg(x).over(w.rowsBetween(-(n - 1), 0))
    pos = F.col("_pos")
    return F.when(pos > first, x * k).when(pos == first, init), 1.0 - k, first


def ema(df: DataFrame, key, time: str, price: str, n: int, seed: str = "sma", seq=None,
        split: Split | None = None, out: str = "ema") -> DataFrame:
    """Exponential mean with factor 2/(n+1), seeded by the mean of the first ``n`` values
    (``seed='sma'``, output starts there) or by the first value (``seed='first'``).  Rows
    without a price are left out and change nothing for the others."""
    s = OrderedSeries(_present(df, price), key, time, seq, split)
    b, decay, first = _ema(F.col(price).cast("double"), s.window, n, seed)
    s.with_columns(lambda w: {"_b": b}).scan([Recurrence("_b", out, decay, first)])
    return s.done("_b").filter(F.col(out).isNotNull())


def rsi(df: DataFrame, key, time: str, price: str, n: int = 14, seq=None, split: Split | None = None,
        out: str = "rsi") -> DataFrame:
    """Relative strength with Wilder smoothing; with no losses the ratio counts as 100.
    Rows without a price are left out."""
    def changes(w):
        d = F.col(price) - F.lag(price).over(w)
        return {"_g": F.when(d > 0, d).otherwise(0.0), "_l": F.when(d < 0, -d).otherwise(0.0)}

    def terms(w):
        pos = F.col("_pos")
        return {f"{c}b": F.when(pos > n, F.col(c) / n).when(pos == n, F.avg(c).over(w.rowsBetween(-(n - 1), 0))) for c in ("_g", "_l")}

    s = OrderedSeries(_present(df, price), key, time, seq, split, before=1).with_columns(changes).only_home()
    decay = (n - 1) / n
    s.with_columns(terms).scan([Recurrence("_gb", "_gain", decay, n), Recurrence("_lb", "_loss", decay, n)])
    d = s.done("_g", "_l", "_gb", "_lb").filter(F.col("_gain").isNotNull())
    rs = F.when(F.col("_loss") == 0, F.lit(100.0)).otherwise(safe_div("_gain", "_loss"))
    return d.withColumn(out, 100 - 100 / (1 + rs)).drop("_gain", "_loss")


def macd(df: DataFrame, key, time: str, price: str, fast: int = 12, slow: int = 26, signal: int = 9,
         seq=None, split: Split | None = None) -> DataFrame:
    """Fast minus slow EMA, its signal EMA and the histogram, from the first full signal.
    Rows without a price are left out."""
    x = F.col(price).cast("double")
    s = OrderedSeries(_present(df, price), key, time, seq, split)
    fb, fd, ff = _ema(x, s.window, fast, "sma")
    sb, sd, sf = _ema(x, s.window, slow, "sma")
    s.with_columns(lambda w: {"_fb": fb, "_sb": sb}).scan([Recurrence("_fb", "_fast", fd, ff), Recurrence("_sb", "_slow", sd, sf)])
    s.with_columns(lambda w: {"macd": F.col("_fast") - F.col("_slow")})
    gb, gd, gf = _ema(F.col("macd"), s.window, signal, "sma", slow - 1)
    s.with_columns(lambda w: {"_gb": gb}).scan([Recurrence("_gb", "signal", gd, gf)])
    d = s.done("_fb", "_sb", "_fast", "_slow", "_gb").filter(F.col("signal").isNotNull())
    return d.withColumn("histogram", F.col("macd") - F.col("signal"))


def _first_value(df: DataFrame, key, time: str, price: str) -> DataFrame:
    """Every row next to its key's first price; the base is one pre-aggregated row per key."""
    ks = names(key)
    base = df.groupBy(*ks).agg(F.min_by(price, time).alias("_base"))
    return df.join(base, ks).filter(F.col("_base").isNotNull() & (F.col("_base") != 0))


def normalise(df: DataFrame, key, time: str, price: str = "close",
              cols: Sequence[str] = ("open", "high", "low", "close")) -> DataFrame:
    """Scale prices so that the first close of the key is 100."""
    d = _first_value(df, key, time, price)
    return d.withColumns({c: F.col(c) * safe_div(F.lit(100.0), "_base") for c in cols}).drop("_base")


def cumulative_return(df: DataFrame, key, time: str, price: str = "close", out: str = "return_pct") -> DataFrame:
    return _first_value(df, key, time, price).withColumn(out, pct_change(price, "_base")).drop("_base")


def yoy(df: DataFrame, metric: str, key: str = "ticker", year: str = "fiscal_year",
        period: str = "fiscal_period") -> DataFrame:
    """Growth against the same period one year earlier, over its absolute value.

    A join on the year, not a lag: years may be missing.
    """
    prior = df.select(key, period, (F.col(year) + 1).alias(year), F.col(metric).alias("prior_value"))
    d = df.join(prior, [key, period, year], "left")
    return d.withColumn("growth_pct", safe_div(F.col(metric) - F.col("prior_value"), F.abs("prior_value")) * 100)


def margins(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "gross_margin": pct_of("gross_profit", "revenue"),
        "operating_margin": pct_of("operating_income", "revenue"),
        "net_margin": pct_of("net_income", "revenue"),
    })
