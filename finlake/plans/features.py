"""Daily feature matrix: every feature for all dates in one plan.

A feature group is a function ``(inputs, calendar) -> DataFrame`` with one row per date,
its feature columns, and a ``stale`` array naming the features that had to be taken from
old data.  Groups register themselves; the matrix left-joins all of them to the calendar.
Calendars and daily series have one row per date, so the joins and windows here are small
whatever the size of the tick and chain tables the inputs were aggregated from.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import safe_corr, safe_div
from finlake.operators.asof import asof_timeline
from finlake.operators.pivots import full_merge
from finlake.operators.returns import percentile_rank, rolling_mean
from finlake.plans import options as opt
from finlake.session import materialise

ANNUAL = math.sqrt(252)


@dataclass
class Inputs:
    """Source frames of the feature groups and the names they look for."""

    daily: DataFrame
    chain: DataFrame
    rates: DataFrame
    macro_daily: DataFrame
    macro_weekly: DataFrame
    macro_monthly: DataFrame
    benchmark: str = "SPY"
    assets: tuple[str, ...] = ("SPY", "GLD", "TLT", "HYG", "DBC", "UUP")
    pairs: tuple[tuple[str, str], ...] = (("SPY", "TLT"), ("SPY", "GLD"), ("SPY", "HYG"))
    labels: dict[str, str] = field(default_factory=dict)

    def label(self, ticker: str) -> str:
        return self.labels.get(ticker, ticker.lower())


Group = Callable[[Inputs, DataFrame], DataFrame]
GROUPS: dict[str, Group] = {}


def feature_group(name: str) -> Callable[[Group], Group]:
    """Register a feature group under a name; the matrix picks up every registered group."""
    def register(fn: Group) -> Group:
        GROUPS[name] = fn
        return fn
    return register


def trading_calendar(daily: DataFrame, benchmark: str, start=None, end=None) -> DataFrame:
    """Dates on which the benchmark traded."""
    d = daily.filter(F.col("ticker") == benchmark)
    if start is not None:
        d = d.filter(F.col("day") >= start)
    if end is not None:
        d = d.filter(F.col("day") <= end)
    return d.select(F.col("day").alias("date")).distinct()


def stale_if(cond: Column, names: list[str]) -> Column:
    return F.when(cond, F.array(*[F.lit(n) for n in names])).otherwise(F.array().cast("array<string>"))


# ---- price action -----------------------------------------------------------------

EQUITY = ["overnight_gap", "premarket_range", "intraday_momentum", "realized_vol_5d", "realized_vol_20d"]


@feature_group("equity")
def equity_features(x: Inputs, calendar: DataFrame) -> DataFrame:
    """Gap, range, momentum and realised volatility of the benchmark.

    History older than 45 days before the date does not count.
    """
    w = W.orderBy("day")
    b = x.daily.filter(F.col("ticker") == x.benchmark).select("day", "open", "high", "low", "close")
    b = b.withColumns({"_p": F.lag("close").over(w), "_pd": F.lag("day").over(w)})
    known = F.col("_pd").isNotNull() & (F.col("_pd") >= F.date_sub("day", 45)) & (F.col("_p") > 0)
    b = b.withColumn("_ret", F.when(known, safe_div(F.col("close") - F.col("_p"), "_p")))
    cols = {
        "overnight_gap": F.when(known, safe_div(F.col("open") - F.col("_p"), "_p")),
        "premarket_range": F.when(known, safe_div(F.col("high") - F.col("low"), "_p")),
        "intraday_momentum": F.col("_ret"),
    }
    for n in (5, 20):
        f = w.rowsBetween(-(n - 1), 0)
        enough = (F.count("_ret").over(f) >= n) & (F.lag("day", n).over(w) >= F.date_sub("day", 45))
        cols[f"realized_vol_{n}d"] = F.when(enough, F.stddev_pop("_ret").over(f) * ANNUAL)
    b = b.withColumns(cols).withColumn("stale", stale_if(~F.coalesce(known, F.lit(False)), EQUITY))
    return calendar.join(b.select(F.col("day").alias("date"), *EQUITY, "stale"), "date", "left")


@feature_group("cross_asset")
def cross_asset_features(x: Inputs, calendar: DataFrame, window: int = 20) -> DataFrame:
    """Latest daily return of each asset and 20-day return correlations with the benchmark.

    Only bars of the 35 days up to the date count, for the return's previous bar too.
    """
    reach = window + 15
    w = W.partitionBy("ticker").orderBy("day")
    b = x.daily.filter(F.col("ticker").isin(*x.assets) & (F.coalesce("close", F.lit(0.0)) != 0)).select("ticker", "day", "close")
    b = b.withColumns({"_p": F.lag("close").over(w), "_pd": F.lag("day").over(w)})
    one = F.struct("day", F.when(F.col("_p") > 0, safe_div(F.col("close") - F.col("_p"), "_p")).alias("v"), F.col("_pd").alias("start"))
    wide = b.groupBy("day").agg(*[F.max(F.when(F.col("ticker") == t, one)).alias(x.label(t)) for t in x.assets])
    sides = {f"ret_{x.label(t)}": (wide.filter(F.col(x.label(t)).isNotNull()).select(f"{x.label(t)}.*"), "day", reach) for t in x.assets}
    rows = W.orderBy("day").rowsBetween(-(window - 1), 0)
    for a, c in x.pairs:
        a, c = x.label(a), x.label(c)
        both = wide.filter(F.col(f"{a}.v").isNotNull() & F.col(f"{c}.v").isNotNull())
        enough = F.count(F.lit(1)).over(rows) >= window
        corr = safe_corr(F.col(f"{a}.v"), F.col(f"{c}.v"), rows)
        start = F.min(F.least(f"{a}.start", f"{c}.start")).over(rows)
        sides[f"corr_{a}_{c}_{window}d"] = (both.select("day", F.when(enough, corr).alias("v"), start.alias("start")), "day", reach)
    d = asof_timeline(calendar, sides)
    d = d.withColumns({n: F.when(F.col(f"{n}.start") >= F.date_sub("date", reach), F.col(f"{n}.v")) for n in sides})
    stale = [F.when(F.col(n).isNull(), F.lit(n)) for n in sides if n.startswith("ret_")]
    return d.withColumn("stale", F.filter(F.array(*stale), lambda s: s.isNotNull()))


# ---- options ----------------------------------------------------------------------

OPTIONS = ["iv_rank", "iv_current", "term_structure_slope", "skew_25d", "gex_net", "gex_sign", "put_call_ratio",
           "vol_risk_premium", "zero_dte_put_volume", "zero_dte_call_volume", "zero_dte_pc_ratio"]


def trailing_vol(daily: DataFrame, dates: DataFrame, reach: int = 35) -> DataFrame:
    """(date, rv): annualised deviation of the daily returns inside the ``reach`` days up to
    each date; a return counts when its previous bar is inside too.

    Dates and bars are merged into one ordered series, so a date need not be a trading day.
    """
    w = W.orderBy("day")
    b = daily.select("day", "close").withColumns({"_p": F.lag("close").over(w), "_pd": F.lag("day").over(w)})
    b = b.select("day", F.struct("_pd", safe_div(F.col("close") - F.col("_p"), "_p").alias("r")).alias("_x"), F.lit(0).alias("_ask"))
    b = b.filter(F.col("_x.r").isNotNull())
    asked = dates.select(F.col("date").alias("day")).withColumn("_ask", F.lit(1))
    d = b.unionByName(asked, allowMissingColumns=True)
    f = W.orderBy(F.unix_date("day")).rangeBetween(-reach, 0)
    d = d.withColumn("_seen", F.collect_list("_x").over(f)).filter(F.col("_ask") == 1)
    kept = F.transform(F.filter("_seen", lambda s: s["_pd"] >= F.date_sub("day", reach)), lambda s: s["r"])
    d = d.select(F.col("day").alias("date"), kept.alias("_r"))
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v)
    d = d.withColumn("_m", safe_div(total(F.col("_r")), F.size("_r")))
    var = safe_div(total(F.transform("_r", lambda v: (v - F.col("_m")) * (v - F.col("_m")))), F.size("_r"))
    return d.select("date", (F.sqrt(var) * ANNUAL).alias("rv"))


def vol_risk_premium(iv: DataFrame, daily: DataFrame, reach: int = 35) -> DataFrame:
    """Implied minus trailing realised volatility; ``iv`` is (snapshot_date, iv_current)."""
    rv = trailing_vol(daily, iv.select(F.col("snapshot_date").alias("date")), reach)
    d = iv.join(rv.withColumnRenamed("date", "snapshot_date"), "snapshot_date", "left")
    return d.select("snapshot_date", F.when(F.col("rv") > 0, F.col("iv_current") - F.col("rv")).alias("vol_risk_premium"))


def option_snapshots(x: Inputs) -> DataFrame:
    """Chain features of the benchmark, one row per snapshot date.

    The chain is read once; its daily summary (one row per day) is written and reused.
    """
    c = x.chain.filter(F.col("underlying") == x.benchmark)
    day = materialise(opt.daily_summary(c).drop("underlying"))
    iv = day.filter(F.col("iv_current").isNotNull()).select("snapshot_date", "iv_current")
    # Means are compared at ten digits: the last bits depend on the order of summation.
    rank = percentile_rank(iv.withColumn("iv_current", F.round("iv_current", 10)), None, "snapshot_date", "iv_current", 365, True, 20, "iv_rank").drop("iv_current")
    premium = vol_risk_premium(iv, x.daily.filter(F.col("ticker") == x.benchmark))
    return full_merge([day, rank, premium], "snapshot_date").select("snapshot_date", *OPTIONS)


@feature_group("options")
def option_features(x: Inputs, calendar: DataFrame) -> DataFrame:
    d = asof_timeline(calendar, {"_o": (option_snapshots(x), "snapshot_date", 5)})
    old = F.col("_o").isNull() | (F.datediff("date", F.col("_o.snapshot_date")) > 1)
    return d.select("date", *[F.col(f"_o.{c}").alias(c) for c in OPTIONS], stale_if(old, OPTIONS).alias("stale"))


# ---- macro ------------------------------------------------------------------------

MACRO = ["real_yield_10y", "real_yield_momentum_5d", "yield_curve_10y2y", "yield_curve_10y3m", "cp_stress_spread", "hy_oas",
         "vix", "financial_stress", "financial_conditions", "sahm_rule", "jobless_claims_4wk_avg", "jobless_claims_momentum"]


def momentum_5d(series: DataFrame, calendar: DataFrame, column: str, out: str) -> DataFrame:
    """Latest value minus the last one at least five days old, within ten days.

    If all values are younger than five days the oldest is used; one value gives NULL.
    """
    v = series.filter(F.col(column).isNotNull()).select("date", F.struct(F.col("date").alias("d"), F.col(column).alias("v")).alias("_x"))
    d = v.withColumn("_ask", F.lit(0)).unionByName(calendar.select("date").withColumn("_ask", F.lit(1)), allowMissingColumns=True)
    f = W.orderBy(F.unix_date("date")).rangeBetween(-10, 0)
    d = d.withColumn("_s", F.array_sort(F.collect_list("_x").over(f))).filter(F.col("_ask") == 1)
    old = F.filter("_s", lambda s: s["d"] <= F.date_sub("date", 5))
    older = F.coalesce(F.get(old, F.size(old) - 1), F.get("_s", F.lit(0)))
    newest = F.get("_s", F.size("_s") - 1)
    return d.select("date", F.when(F.size("_s") >= 2, newest["v"] - older["v"]).alias(out))


@feature_group("macro")
def macro_features(x: Inputs, calendar: DataFrame) -> DataFrame:
    """As-of macro values: daily tables up to 5 days old, weekly 10, monthly 45.

    The claims momentum uses the whole series: 13 observations back needs 17 of them.
    """
    w = W.orderBy("date")
    claims = x.macro_weekly.filter(F.col("initial_claims").isNotNull()).select("date", "initial_claims")
    claims = rolling_mean(claims, None, "date", "initial_claims", 4, True, "avg").withColumns({
        "start": F.lag("date", 3).over(w), "ago": F.when(F.lag("date", 16).over(w).isNotNull(), F.lag("avg", 13).over(w))})
    d = asof_timeline(calendar, {
        "_r": (x.rates.select("date", "tips_10y", "hy_oas", "commercial_paper_3m", "tbill_3m"), "date", 5),
        "_d": (x.macro_daily.select("date", "yield_curve_10y2y", "yield_curve_10y3m", "vix"), "date", 5),
        "_w": (x.macro_weekly.select("date", "financial_stress", "financial_conditions"), "date", 10),
        "_c": (claims, "date", 112),
        "_s": (x.macro_monthly.filter(F.col("sahm_rule").isNotNull()).select("date", "sahm_rule"), "date", 45)})
    ok = F.col("_c.start") >= F.date_sub("date", 112)
    d = d.withColumns({
        "real_yield_10y": F.col("_r.tips_10y"), "hy_oas": F.col("_r.hy_oas"), "cp_stress_spread": F.col("_r.commercial_paper_3m") - F.col("_r.tbill_3m"),
        "yield_curve_10y2y": F.col("_d.yield_curve_10y2y"), "yield_curve_10y3m": F.col("_d.yield_curve_10y3m"), "vix": F.col("_d.vix"),
        "financial_stress": F.col("_w.financial_stress"), "financial_conditions": F.col("_w.financial_conditions"), "sahm_rule": F.col("_s.sahm_rule"),
        "jobless_claims_4wk_avg": F.when(ok, F.col("_c.avg")), "jobless_claims_momentum": F.when(ok, F.col("_c.avg") - F.col("_c.ago"))})
    d = d.join(momentum_5d(x.rates, calendar, "tips_10y", "real_yield_momentum_5d"), "date", "left")
    stale = F.concat(
        stale_if(F.col("_r").isNull(), ["real_yield_10y", "cp_stress_spread", "hy_oas"]),
        stale_if(F.col("_d").isNull(), ["yield_curve_10y2y", "yield_curve_10y3m", "vix"]),
        stale_if(F.col("_w").isNull(), ["financial_stress", "financial_conditions"]))
    return d.withColumn("stale", stale).select("date", *MACRO, "stale")


# ---- matrix -----------------------------------------------------------------------

META = ("date", "feature_count", "stale_features")


def feature_matrix(x: Inputs, calendar: DataFrame, groups: tuple[str, ...] | None = None) -> DataFrame:
    """One wide row per calendar date with all groups, a non-missing count and the stale names."""
    out, stale, features = calendar, [], []
    for name in groups or tuple(GROUPS):
        g = GROUPS[name](x, calendar)
        features += [c for c in g.columns if c not in ("date", "stale")]
        out = out.join(g.withColumnRenamed("stale", f"_stale_{name}"), "date", "left")
        stale.append(F.coalesce(f"_stale_{name}", F.array().cast("array<string>")))
    present = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in features), F.lit(0))
    return out.select("date", *features, present.alias("feature_count"), F.array_distinct(F.concat(*stale)).alias("stale_features"))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in META and not c.startswith("pc_")]


def pca(df: DataFrame, cols: list[str] | None = None, k: int = 10, written: bool = False) -> DataFrame:
    """Add ``pc_1..pc_k``: mean-impute, standardise by population deviation, project.

    The matrix is materialised first, unless it is ``written`` already: the moments, the covariance inside MLlib and the
    projection each read it once.  Only a few numbers per column come to the driver.  Each component's sign is fixed so that its
    largest loading is positive.  Components beyond the data's rank limit are NULL.
    """
    cols = cols or feature_columns(df)
    df = df if written else materialise(df)
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(c).cast("double")).alias(f"{t}_{c}")
                   for c in cols for t, f in (("m", F.avg), ("s", F.stddev_pop), ("n", F.count))]).first()
    n = stats["n"]
    scaled = []
    for c in cols:
        mean = stats[f"m_{c}"] or 0.0
        sd = (stats[f"s_{c}"] or 0.0) * math.sqrt(stats[f"n_{c}"] / n) if n else 0.0
        scaled.append(((F.coalesce(F.col(c).cast("double"), F.lit(mean)) - mean) / (sd or 1.0)).alias(f"_z_{c}"))
    used = min(k, len(cols), n)
    null = F.lit(None).cast("double")
    if not used:
        return df.withColumns({f"pc_{i + 1}": null for i in range(k)})
    z = df.select("*", *scaled)
    vec = VectorAssembler(inputCols=[f"_z_{c}" for c in cols], outputCol="_v")
    model = PCA(k=used, inputCol="_v", outputCol="_p").fit(vec.transform(z))
    load = model.pc.toArray()
    comps = {}
    for i in range(used):
        v = load[:, i]
        sign = 1.0 if v[abs(v).argmax()] >= 0 else -1.0
        comps[f"pc_{i + 1}"] = sum((F.col(f"_z_{c}") * float(sign * v[j]) for j, c in enumerate(cols)), F.lit(0.0))
    for i in range(used, k):
        comps[f"pc_{i + 1}"] = null
    return z.withColumns(comps).drop(*[f"_z_{c}" for c in cols])


def score_day(matrix: DataFrame, day, lookback: int = 252, k: int = 10, min_rows: int = 30) -> DataFrame:
    """Components of one day, fitted on the days before it (NULL with too little history)."""
    cols = feature_columns(matrix)
    matrix = materialise(matrix)
    d = F.lit(day).cast("date")
    hist = matrix.filter((F.col("date") >= F.date_sub(d, lookback + 30)) & (F.col("date") < d))
    today = matrix.filter(F.col("date") == d)
    if hist.select("date").limit(min_rows).count() < min_rows:
        return today.withColumns({f"pc_{i + 1}": F.lit(None).cast("double") for i in range(k)})
    return pca(hist.unionByName(today, allowMissingColumns=True), cols, k, written=True).filter(F.col("date") == d)


def storable(matrix: DataFrame) -> DataFrame:
    """Missing values as stored: NaN for numbers, 0 for the integer columns."""
    whole = ("gex_sign", "zero_dte_put_volume", "zero_dte_call_volume")
    cols = {}
    for c in matrix.columns:
        if c in whole:
            cols[c] = F.coalesce(F.col(c).cast("long"), F.lit(0))
        elif c not in META:
            cols[c] = F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))
    return matrix.withColumns(cols)
