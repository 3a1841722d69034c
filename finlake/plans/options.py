"""Option-chain marts.

Chain rows are contract x snapshot.  Every mart is grouped by underlying; pass
``underlying`` to restrict it.  All of them are hash aggregates, so an underlying holding
most of the rows is combined map-side before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import avg_if, count_if, days_between, max_if, safe_div, sum_if
from finlake.operators.dedup import at_group_max
from finlake.operators.returns import log_return, percentile_rank, rolling_vol

CONTRACT = ["underlying", "expiration", "strike", "put_call"]
CALL, PUT = "call", "put"


def is_call() -> Column:
    return F.col("put_call") == CALL


def is_put() -> Column:
    return F.col("put_call") == PUT


def dte() -> Column:
    return days_between("expiration", "snapshot_date")


def near_spot(share: float = 0.02) -> Column:
    return safe_div(F.abs(F.col("strike") - F.col("underlying_price")), "underlying_price") < share


def of(chain: DataFrame, underlying: str | None) -> DataFrame:
    return chain if underlying is None else chain.filter(F.col("underlying") == underlying)


def snapshot(chain: DataFrame, underlying: str | None = None, date: Column | None = None) -> DataFrame:
    """Rows of one snapshot, by default the latest of each underlying."""
    d = of(chain, underlying)
    if date is not None:
        return d.filter(F.col("snapshot_date") == date)
    if underlying is not None:
        return d.filter(F.col("snapshot_date") == d.select(F.max("snapshot_date")).scalar())
    return at_group_max(d, "underlying", "snapshot_date")


# ---- single-snapshot projections --------------------------------------------------

def expirations(snap: DataFrame) -> DataFrame:
    return snap.select("underlying", "expiration").distinct()


def surface(snap: DataFrame, expiration: Column | None = None) -> DataFrame:
    """Implied volatility by expiration and strike; one expiration gives its skew."""
    d = snap.filter(F.col("implied_vol") > 0)
    if expiration is not None:
        d = d.filter(F.col("expiration") == expiration)
    return d.select("underlying", "expiration", "strike", "put_call", "implied_vol", "delta", "volume", "open_interest")


def greeks(snap: DataFrame, columns: Sequence[str] = ("delta", "gamma", "theta", "vega", "rho")) -> DataFrame:
    return snap.select(*CONTRACT, *columns)


def split_chain(snap: DataFrame, expiration: Column) -> tuple[DataFrame, DataFrame]:
    """(calls, puts) of one expiration."""
    d = snap.filter(F.col("expiration") == expiration)
    return d.filter(is_call()), d.filter(is_put())


def iv_history(chain: DataFrame, underlying: str, strike: float, expiration: Column, put_call: str) -> DataFrame:
    d = chain.filter((F.col("underlying") == underlying) & (F.col("strike") == strike)
                     & (F.col("expiration") == expiration) & (F.col("put_call") == put_call))
    return d.select("snapshot_date", "implied_vol")


def latest_trade_date(trades: DataFrame, underlying: str | None = None) -> DataFrame:
    d = trades if underlying is None else trades.filter(F.col("underlying") == underlying)
    return d.groupBy("underlying").agg(F.max("trade_date").alias("latest_date"))


# ---- volume and open interest -----------------------------------------------------

def put_call_ratio(chain: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    d = chain.filter((F.col("snapshot_date") >= F.date_sub(as_of, days)) & (F.col("snapshot_date") <= as_of))
    g = d.groupBy("underlying", "snapshot_date").agg(
        sum_if("volume", is_put()).alias("put_volume"), sum_if("volume", is_call()).alias("call_volume"))
    ratio = F.round(safe_div("put_volume", F.greatest("call_volume", F.lit(1))), 3)
    return g.withColumn("ratio", ratio)


def volume_ratio(chain: DataFrame) -> DataFrame:
    """Put volume over call volume per day; NULL when no call traded."""
    g = chain.filter(F.col("volume") > 0).groupBy("underlying", "snapshot_date").agg(
        sum_if("volume", is_put()).alias("_p"), sum_if("volume", is_call()).alias("_c"))
    return g.select("underlying", "snapshot_date", safe_div("_p", "_c").alias("put_call_ratio"))


def zero_day_flow(chain: DataFrame) -> DataFrame:
    """Volume on contracts that expire on the snapshot day; days without any are absent."""
    d = chain.filter((F.col("expiration") == F.col("snapshot_date")) & (F.col("volume") > 0))
    g = d.groupBy("underlying", "snapshot_date").agg(
        sum_if("volume", is_put()).alias("zero_dte_put_volume"), sum_if("volume", is_call()).alias("zero_dte_call_volume"))
    return g.withColumn("zero_dte_pc_ratio", safe_div("zero_dte_put_volume", "zero_dte_call_volume"))


def oi_by_strike(snap: DataFrame, max_dte: int = 45, min_total: int = 100) -> DataFrame:
    g = snap.filter((dte() <= max_dte) & (F.col("open_interest") > 0)).groupBy("underlying", "strike").agg(
        sum_if("open_interest", is_call()).alias("call_oi"), sum_if("open_interest", is_put()).alias("put_oi"),
        F.sum("open_interest").alias("total_oi"))
    return g.filter(F.col("total_oi") > min_total)


def profile(snap: DataFrame, measure: str) -> DataFrame:
    """Calls and puts of a measure by expiration and strike."""
    return snap.groupBy("underlying", "expiration", "strike").agg(
        sum_if(measure, is_call()).alias(f"call_{measure}"), sum_if(measure, is_put()).alias(f"put_{measure}"))


# ---- gamma exposure ---------------------------------------------------------------

SCALES = {
    "contract": lambda: F.col("gamma") * F.col("open_interest") * 100,
    "spot": lambda: F.col("open_interest") * F.col("gamma") * 100 * F.col("underlying_price"),
    "spot_squared": lambda: F.col("open_interest") * F.col("gamma") * F.col("underlying_price") * F.col("underlying_price") * 0.01,
}


def gex_by_strike(snap: DataFrame, max_dte: int = 45) -> DataFrame:
    d = snap.filter((dte() <= max_dte) & (F.col("open_interest") > 0)).withColumn("_g", SCALES["contract"]())
    g = d.groupBy("underlying", "strike").agg(
        sum_if("_g", is_call()).alias("_c"), sum_if("_g", is_put()).alias("_p"))
    g = g.select("underlying", "strike", F.round("_c", 2).alias("call_gamma"), F.round("_p", 2).alias("put_gamma"),
                 F.round(F.col("_c") - F.col("_p"), 2).alias("net_gamma"))
    return g.filter(F.abs("net_gamma") > 0)


def net_gex(chain: DataFrame, max_dte: int = 60, scale: str = "spot_squared") -> DataFrame:
    """Call minus put exposure per day and its sign."""
    d = chain.filter((F.col("gamma") > 0) & (F.col("open_interest") > 0) & dte().between(0, max_dte))
    signed = F.when(is_call(), SCALES[scale]()).otherwise(-SCALES[scale]())
    g = d.groupBy("underlying", "snapshot_date").agg(F.sum(signed).alias("gex_net"))
    return g.withColumn("gex_sign", F.signum("gex_net").cast("int"))


def _same_day(chain: DataFrame) -> DataFrame:
    d = chain.filter((F.col("expiration") == F.col("snapshot_date")) & F.col("underlying_price").isNotNull())
    return d.withColumn("_g", SCALES["spot"]())


def max_gex_strike(chain: DataFrame, min_oi: int = 100) -> DataFrame:
    """Per day the strike with the largest absolute exposure, and its distance from spot."""
    g = _same_day(chain).filter(F.col("open_interest") > 0).groupBy("underlying", "snapshot_date", "strike").agg(
        F.max("underlying_price").alias("spot"), (sum_if("_g", is_call()) - sum_if("_g", is_put())).alias("gex"),
        F.sum("open_interest").alias("oi"))
    g = g.filter(F.col("oi") > min_oi).groupBy("underlying", "snapshot_date").agg(
        F.max("spot").alias("spot"), F.max(F.struct(F.round(F.abs("gex"), 6).alias("g"), F.col("strike"))).alias("_m"))
    pct = F.round(safe_div(F.abs(F.col("spot") - F.col("_m.strike")), "spot") * 100, 3)
    return g.select("underlying", "snapshot_date", "spot", F.col("_m.strike").alias("max_gex_strike"), pct.alias("pct_from_max_gex"))


def gex_stress(chain: DataFrame, start: Column, end: Column) -> DataFrame:
    d = _same_day(chain).filter(F.col("snapshot_date").between(start, end))
    g = d.groupBy("underlying", "snapshot_date").agg(
        F.max("underlying_price").alias("spot"), sum_if("_g", is_call()).alias("call_gex"),
        sum_if("_g", is_put()).alias("put_gex"), F.sum("open_interest").alias("total_oi"))
    return g.withColumn("net_gex", F.col("call_gex") - F.col("put_gex"))


# ---- implied volatility -----------------------------------------------------------

def term_structure(snap: DataFrame) -> DataFrame:
    d = snap.filter(is_call() & F.abs("delta").between(0.35, 0.65) & (F.col("implied_vol") > 0) & dte().between(1, 365))
    return d.groupBy("underlying", "expiration", dte().alias("dte")).agg(F.round(F.avg("implied_vol"), 4).alias("iv"))


def atm_iv(chain: DataFrame, rule: str = "delta") -> DataFrame:
    """At-the-money call volatility 20 to 40 days out, per day; by delta band or by strike."""
    near = F.abs("delta").between(0.40, 0.60) if rule == "delta" else near_spot()
    d = chain.filter(is_call() & near & dte().between(20, 40) & (F.col("implied_vol") > 0))
    return d.groupBy("underlying", "snapshot_date").agg(F.avg("implied_vol").alias("iv"))


def iv_gauge(chain: DataFrame, as_of: Column) -> DataFrame:
    """Current at-the-money volatility within its past year (share at or below, percent)."""
    iv = atm_iv(chain.filter(F.col("snapshot_date") <= as_of)).withColumn("iv", F.round("iv", 4))
    d = iv.filter(F.col("snapshot_date") >= F.date_sub(as_of, 365))
    now = d.groupBy("underlying").agg(F.max_by("iv", "snapshot_date").alias("current_iv"))
    d = d.join(now, "underlying").groupBy("underlying", "current_iv").agg(
        count_if(F.col("iv") <= F.col("current_iv")).alias("_b"), F.count(F.lit(1)).alias("_n"),
        F.min("iv").alias("min_1y"), F.max("iv").alias("max_1y"), F.round(F.avg("iv"), 4).alias("avg_1y"))
    rank = F.round(safe_div("_b", F.greatest("_n", F.lit(1))) * 100, 1)
    return d.select("underlying", "current_iv", rank.alias("percentile_rank"), "min_1y", "max_1y", "avg_1y")


def iv_rank(chain: DataFrame, days: int = 365, min_days: int = 20) -> DataFrame:
    """Daily at-the-money volatility (by strike, ten digits) and the share of the past year below it."""
    iv = atm_iv(chain, "strike").select("underlying", "snapshot_date", F.round("iv", 10).alias("iv_current"))
    return percentile_rank(iv, "underlying", "snapshot_date", "iv_current", days, True, min_days, "iv_rank")


def skew_25d(chain: DataFrame) -> DataFrame:
    """25-delta put minus 25-delta call volatility per day, where both exist."""
    d = chain.filter((F.col("implied_vol") > 0) & dte().between(20, 40))
    g = d.groupBy("underlying", "snapshot_date").agg(
        avg_if("implied_vol", is_put() & F.col("delta").between(-0.30, -0.20)).alias("put_iv_25d"),
        avg_if("implied_vol", is_call() & F.col("delta").between(0.20, 0.30)).alias("call_iv_25d"))
    g = g.filter((F.col("put_iv_25d") > 0) & (F.col("call_iv_25d") > 0))
    return g.withColumn("skew", F.col("put_iv_25d") - F.col("call_iv_25d"))


def term_slope(chain: DataFrame) -> DataFrame:
    """Volatility at the nearest minus at the farthest expiry, 7 to 90 days out, per day."""
    d = chain.filter(is_call() & (F.col("implied_vol") > 0) & near_spot() & dte().between(7, 90))
    g = d.groupBy("underlying", "snapshot_date", dte().alias("dte")).agg(F.avg("implied_vol").alias("iv"))
    return g.groupBy("underlying", "snapshot_date").agg(
        (F.min_by("iv", "dte") - F.max_by("iv", "dte")).alias("term_structure_slope"))


def daily_summary(chain: DataFrame) -> DataFrame:
    """All per-day option features of each underlying in one pass over the chain.

    The chain is reduced to one row per (underlying, day, days to expiry) of sums and
    counts, and those rows to one per day.  Same definitions as the single marts above:
    ``iv_current`` (at the money by strike), ``term_structure_slope``, ``skew_25d``,
    ``gex_net`` and sign, ``put_call_ratio`` and the zero-day volumes.
    """
    vol, iv = F.col("volume") > 0, F.col("implied_vol") > 0
    atm, far = is_call() & iv & near_spot(), iv & dte().between(20, 40)
    put25 = far & is_put() & F.col("delta").between(-0.30, -0.20)
    call25 = far & is_call() & F.col("delta").between(0.20, 0.30)
    gex = (F.col("gamma") > 0) & (F.col("open_interest") > 0) & dte().between(0, 60)
    signed = F.when(is_call(), SCALES["spot_squared"]()).otherwise(-SCALES["spot_squared"]())
    total = lambda cond, value: F.sum(F.when(cond, value))
    ivs = F.col("implied_vol")
    by_dte = chain.groupBy("underlying", "snapshot_date", dte().alias("dte")).agg(
        total(atm, ivs).alias("atm"), count_if(atm).alias("atm_n"), total(put25, ivs).alias("p25"), count_if(put25).alias("p25_n"),
        total(call25, ivs).alias("c25"), count_if(call25).alias("c25_n"), total(gex, signed).alias("gex"),
        total(vol & is_put(), F.col("volume")).alias("put_v"), total(vol & is_call(), F.col("volume")).alias("call_v"), count_if(vol).alias("v_n"))
    d = F.col("dte")
    month, curve, zero = d.between(20, 40), d.between(7, 90) & (F.col("atm_n") > 0), d == 0
    level = safe_div("atm", "atm_n")
    g = by_dte.groupBy("underlying", "snapshot_date").agg(
        safe_div(total(month, F.col("atm")), total(month, F.col("atm_n"))).alias("iv_current"),
        (F.min_by(level, F.when(curve, d)) - F.max_by(level, F.when(curve, d))).alias("term_structure_slope"),
        safe_div(F.sum("p25"), F.sum("p25_n")).alias("_p25"), safe_div(F.sum("c25"), F.sum("c25_n")).alias("_c25"), F.sum("gex").alias("gex_net"),
        safe_div(F.coalesce(F.sum("put_v"), F.lit(0)), F.sum("call_v")).alias("put_call_ratio"),
        F.coalesce(total(zero, F.col("put_v")), F.lit(0)).alias("_zp"), F.coalesce(total(zero, F.col("call_v")), F.lit(0)).alias("_zc"))
    return g.select(
        "underlying", "snapshot_date", "iv_current", "term_structure_slope", F.when((F.col("_p25") > 0) & (F.col("_c25") > 0), F.col("_p25") - F.col("_c25")).alias("skew_25d"),
        "gex_net", F.coalesce(F.signum("gex_net").cast("int"), F.lit(0)).alias("gex_sign"), "put_call_ratio", F.col("_zp").alias("zero_dte_put_volume"),
        F.col("_zc").alias("zero_dte_call_volume"), safe_div("_zp", "_zc").alias("zero_dte_pc_ratio"))


def hv_vs_iv(daily: DataFrame, chain: DataFrame, as_of: Column, days: int = 365) -> DataFrame:
    """30-row realised volatility next to implied volatility, by ticker and day, in percent."""
    since = F.date_sub(as_of, days)
    d = daily.filter((F.col("day") >= F.date_sub(as_of, days + 40)) & (F.col("day") <= as_of)).select("ticker", "day", "close")
    r = log_return(d, "ticker", "day").filter(F.col("ret").isNotNull())
    hv = rolling_vol(r, "ticker", "day", "ret", 30, out="_v").select("ticker", "day", F.round(F.col("_v") * 100, 2).alias("hv30"))
    iv = atm_iv(chain.filter((F.col("snapshot_date") >= since) & (F.col("snapshot_date") <= as_of)))
    iv = iv.select(F.col("underlying").alias("ticker"), F.col("snapshot_date").alias("day"), F.round(F.col("iv") * 100, 2).alias("iv30"))
    return hv.filter((F.col("day") >= since) & (F.col("hv30") > 0)).join(iv, ["ticker", "day"])


# ---- activity ---------------------------------------------------------------------

def volume_history(chain: DataFrame, days: int = 25) -> DataFrame:
    """Mean volume per contract over the ``days`` before the latest snapshot."""
    newest = chain.groupBy("underlying").agg(F.max("snapshot_date").alias("_last"))
    low = newest.select(F.date_sub(F.min("_last"), days)).scalar()
    d = chain.filter(F.col("snapshot_date") >= low).join(newest, "underlying")
    d = d.filter(F.col("snapshot_date").between(F.date_sub("_last", days), F.date_sub("_last", 1)))
    return d.groupBy(*CONTRACT).agg(F.avg("volume").alias("avg_vol"))


_ACTIVITY = [*CONTRACT, "volume", "open_interest", "avg_volume", "vol_ratio", "implied_vol", "delta", "bid", "ask",
             "underlying_price", "dte"]


def _activity(d: DataFrame) -> DataFrame:
    return d.withColumns({
        "avg_volume": F.round(F.coalesce("avg_vol", F.lit(0.0)), 0),
        "vol_ratio": F.round(safe_div("volume", F.greatest(F.coalesce("avg_vol", F.lit(1.0)), F.lit(1.0))), 1),
        "implied_vol": F.round("implied_vol", 4), "delta": F.round("delta", 3), "dte": dte()}).select(*_ACTIVITY)


def unusual_activity(chain: DataFrame, min_ratio: float = 3, min_volume: int = 500, limit: int | None = 30) -> DataFrame:
    """Contracts trading far above their own recent mean on the latest snapshot."""
    hist = volume_history(chain).filter(F.col("avg_vol") > 0)
    d = snapshot(chain).filter(F.col("volume") >= min_volume).join(hist, CONTRACT)
    d = d.filter(safe_div("volume", F.greatest("avg_vol", F.lit(1.0))) >= min_ratio)
    d = _activity(d)
    return d.orderBy(F.desc("vol_ratio"), *CONTRACT).limit(limit) if limit else d


def volume_over_oi(chain: DataFrame, min_volume: int = 500, limit: int | None = 20) -> DataFrame:
    """Contracts whose volume exceeds their open interest: new positions."""
    hist = volume_history(chain).filter(F.col("avg_vol") > 0)
    d = snapshot(chain).filter((F.col("volume") > F.col("open_interest")) & (F.col("volume") >= min_volume))
    d = _activity(d.join(hist, CONTRACT, "left"))
    return d.orderBy(F.desc("volume"), *CONTRACT).limit(limit) if limit else d


def chain_table(chain: DataFrame) -> DataFrame:
    """Latest snapshot with calls and puts side by side per strike, and recent mean volume."""
    d = snapshot(chain).join(volume_history(chain), CONTRACT, "left")
    cols = []
    for side, cond in (("call", is_call()), ("put", is_put())):
        for src, name, digits in (("bid", "bid", None), ("ask", "ask", None), ("close", "last", None), ("volume", "volume", None),
                                  ("open_interest", "oi", None), ("implied_vol", "iv", 4), ("delta", "delta", 3), ("avg_vol", "avg_vol", 0)):
            c = max_if(src, cond)
            cols.append((c if digits is None else F.round(c, digits)).alias(f"{side}_{name}"))
    return d.groupBy("underlying", "expiration", "strike").agg(*cols)


def flow_surface(trades: DataFrame, trade_date: Column | None = None, floor: float = 10_000) -> DataFrame:
    """Directional notional by expiration and strike for a day (default: each latest day).

    Mid-market trades count a quarter on each side.
    """
    if trade_date is None:
        d = at_group_max(trades, "underlying", "trade_date")
    else:
        d = trades.filter(F.col("trade_date") == trade_date)
    d = d.filter(F.col("expiration") >= F.col("trade_date"))
    side, n = F.col("aggressor_side"), F.col("notional")
    mid = n * 0.25
    up = F.when((is_call() & (side == "buy")) | (is_put() & (side == "sell")), n).when(side == "mid", mid).otherwise(0.0)
    down = F.when((is_call() & (side == "sell")) | (is_put() & (side == "buy")), n).when(side == "mid", mid).otherwise(0.0)
    g = d.groupBy("underlying", "trade_date", "expiration", "strike").agg(
        F.sum(up).alias("bullish_notional"), F.sum(down).alias("bearish_notional"))
    b, s = F.col("bullish_notional"), F.col("bearish_notional")
    g = g.filter(b + s >= floor)
    return g.withColumns({"dte": days_between("expiration", "trade_date"), "net_flow": b - s,
                          "bias_ratio": F.coalesce(safe_div(b - s, b + s), F.lit(0.0))})


def otm_flow(chain: DataFrame, min_volume: int = 10_000) -> DataFrame:
    """Out-of-the-money (3 to 10 percent) against at-the-money call volume per day."""
    strike, spot = F.col("strike"), F.col("underlying_price")
    d = chain.filter(spot.isNotNull() & (spot > 0))
    g = d.groupBy("underlying", "snapshot_date").agg(
        F.max("underlying_price").alias("spot"), sum_if("volume", is_call() & near_spot()).alias("atm_call_vol"),
        sum_if("volume", is_call() & (strike > spot * 1.03) & (strike < spot * 1.10)).alias("otm_call_vol"),
        F.sum("volume").alias("total_volume"))
    return g.filter(F.col("total_volume") > min_volume)
