"""Recurrences and frames: hand-made values, plain loops, and split against unsplit."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from finlake.operators import asof, events, indicators as ind, pairs, quantiles, ranks, returns
from finlake.operators.pairs import pair_stats
from finlake.operators.series import Split
from tests.conftest import rows


def series(spark, keys, seed=1):
    """Keyed prices; the first key holds far more rows than the others."""
    rnd = random.Random(seed)
    data = []
    for k, n in keys.items():
        t = 1_700_000_000
        for i in range(n):
            t += rnd.choice([0, 1, 30, 4000])
            data.append((k, t, i, round(rnd.uniform(1, 100), 2)))
    return spark.createDataFrame(data, "k string, s long, seq long, price double").select("k", F.timestamp_seconds("s").alias("ts"), "seq", "price")


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1, abs(a), abs(b)))


@pytest.mark.parametrize("build", [
    lambda d, s: ind.ema(d, "k", "ts", "price", 5, seq="seq", split=s),
    lambda d, s: ind.ema(d, "k", "ts", "price", 5, "first", seq="seq", split=s),
    lambda d, s: ind.rsi(d, "k", "ts", "price", 6, seq="seq", split=s),
    lambda d, s: ind.macd(d, "k", "ts", "price", 3, 6, 4, seq="seq", split=s),
    lambda d, s: ind.sma(d, "k", "ts", "price", 7, seq="seq", split=s),
    lambda d, s: returns.simple_return(d, "k", "ts", "price", seq="seq", split=s),
    lambda d, s: returns.rolling_mean(d, "k", "ts", "price", 5, seq="seq", split=s),
])
def test_split_equals_unsplit(spark, build):
    d = series(spark, {"hot": 900, "b": 40, "c": 3})
    a, b = rows(build(d, None)), rows(build(d, Split("10 minutes", 25)))
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert all(close(p, q) if isinstance(p, float) else p == q for p, q in zip(x, y)), (x, y)


@pytest.mark.parametrize("build", [
    lambda d, s: ind.ema(d, "k", "ts", "price", 5, seq="seq", split=s),
    lambda d, s: ind.ema(d, "k", "ts", "price", 5, "first", seq="seq", split=s),
    lambda d, s: ind.rsi(d, "k", "ts", "price", 6, seq="seq", split=s),
    lambda d, s: ind.macd(d, "k", "ts", "price", 3, 6, 4, seq="seq", split=s),
])
@pytest.mark.parametrize("holes", [(2,), (24, 25, 26), (30, 49, 50, 74, 75), tuple(range(0, 400, 3))])
def test_missing_prices_are_passed_over_split_or_not(spark, build, holes):
    full = series(spark, {"hot": 400, "b": 40})
    d = full.withColumn("price", F.when(~F.col("seq").isin(*holes), F.col("price")))
    a, b = rows(build(d, None)), rows(build(d, Split("10 minutes", 25)))
    want = rows(build(full.filter(~F.col("seq").isin(*holes)), None))
    assert len(a) == len(b) == len(want) > 0
    for x, y, z in zip(a, b, want):
        assert all(close(p, q) and close(p, r) if isinstance(p, float) else p == q == r for p, q, r in zip(x, y, z)), (x, y, z)


def test_one_missing_price_costs_one_row(spark):
    d = spark.createDataFrame([("a", i, None if i == 25 else float(i)) for i in range(100)], "k string, t int, p double")
    assert ind.ema(d, "k", "t", "p", 5).count() == 95


def test_pair_plan_makes_no_rows_for_pairs(spark):
    """The same plan for any number of series, without a join."""
    d = spark.createDataFrame([(f"s{k}", t, float((k * t) % 7)) for k in range(60) for t in range(20)], "k string, t int, v double")
    plans = [pair_stats(d, "k", "t", "v", [f"s{k}" for k in range(n)])._jdf.queryExecution().executedPlan().toString() for n in (3, 60)]
    assert plans[0].count("\n") == plans[1].count("\n") and not any("Join" in p for p in plans)
    assert pair_stats(d, "k", "t", "v").count() == 60 * 59 // 2


def test_pairs_of_many_blocks_are_as_one_by_one(spark, monkeypatch):
    """Missing values, repeated times, values far from 0, pairs that never meet, a constant; several blocks of series and spans of times."""
    rng = random.Random(3)
    rows = [(f"s{k}", dt.date(2024, 1, 1) + dt.timedelta(t), 1e8 * k + rng.gauss(0, 1) + t * (k % 3)) for k in range(14) for t in range(120) if rng.random() < 0.7 and (k != 5 or t < 40) and (k != 6 or t >= 40)]
    rows += [("flat", dt.date(2024, 1, 1) + dt.timedelta(t), 3.0) for t in range(50)] + [("s1", rows[0][1], None), ("s1", None, 1.0), (None, rows[0][1], 1.0), ("s2", rows[0][1], float("nan")), ("s3", rows[0][1], -1e18)]
    d = spark.createDataFrame(rows, "k string, t date, v double")
    wide = pd.DataFrame([r for r in rows if None not in r], columns=["k", "t", "v"]).dropna().groupby(["t", "k"]).v.max().unstack()
    want = {}
    for a in wide:
        for b in wide:
            both = wide[[a, b]].dropna().to_numpy() if a < b else []
            if len(both):
                x, y = (both - both.mean(axis=0)).T
                want[a, b] = (len(both), (x * y).mean(), None if not x.any() or not y.any() else (x * y).mean() / np.sqrt((x * x).mean() * (y * y).mean()))
    for sizes in ((512, 2048, 4), (4, 16, 2)):
        for name, size in zip(("SERIES", "TIMES", "SPAN"), sizes):
            monkeypatch.setattr(pairs, name, size)
        got = {(r.a, r.b): (r.n, r.covariance, r.correlation) for r in pair_stats(d, "k", "t", "v").collect()}
        assert got.keys() == want.keys() and ("s5", "s6") not in got
        for k, (n, cov, corr) in want.items():
            assert got[k][0] == n and got[k][1] == pytest.approx(cov, rel=1e-7, abs=1e-7) and got[k][2] == (None if corr is None or n < 2 else pytest.approx(corr, abs=1e-7)), k
    assert pair_stats(d.filter("false"), "k", "t", "v").collect() == []


@pytest.mark.parametrize("strict", [True, False])
def test_trailing_rank_against_brute_force(spark, strict):
    """Ties, rows at one time, missing values, times and keys, NaN; split and not."""
    rng = random.Random(7)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.randrange(4000) if i % 40 else None, rng.choice([None, float("nan"), *map(float, range(6))])) for i in range(600)]
    d = spark.createDataFrame(data, "k string, i int, s long, x double").withColumn("ts", F.timestamp_seconds("s"))

    def below(a, b):
        return b == a and not strict or (a != a and b != b and not strict) or (b == b and (a != a or b < a))

    want = {}
    for k, i, t, x in data:
        seen = [y for k2, _, t2, y in data if k2 == k and t is not None and t2 is not None and t - 300 <= t2 <= t and y is not None]
        want[i] = sum(below(x, y) for y in seen) / len(seen) if x is not None and len(seen) >= 3 else None
    for split in (True, False):
        got = returns.tick_rank(d, "k", "ts", "x", 300, strict, 3, split=split)
        assert got.columns == [*d.columns, "rank"] and {r.i: r["rank"] for r in got.collect()} == want
    days = d.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s") / 10).cast("int")))
    whole = {r.i: r["rank"] for r in returns.percentile_rank(days, ["k"], "day", "x", 30, strict, 3).collect()}
    assert whole == {r.i: r["rank"] for r in returns.percentile_rank(days, ["k"], "day", "x", 30, strict, 3, split=True).collect()}
    assert returns.percentile_rank(days.filter("false"), None, "day", "x").collect() == []


def test_ranks_of_long_ranges_take_little_time():
    """200,000 values whose ranges hold half of them."""
    x = np.random.default_rng(1).integers(0, 50_000, 200_000)
    at = np.arange(len(x))
    got = ranks.count_below(x, np.maximum(at - 100_000, 0), at + 1, x)
    for i in (5, 1000, 150_000, 199_999):
        assert got[i] == (x[max(i - 100_000, 0):i + 1] < x[i]).sum()


def test_ema_seeds(spark):
    d = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate([1, 2, 3, 4, 8])], "k string, t int, p double")
    sma = {r.t: r.ema for r in ind.ema(d, "k", "t", "p", 3).collect()}
    assert sma == {2: 2.0, 3: 3.0, 4: 5.5}
    first = [r.ema for r in ind.ema(d, "k", "t", "p", 3, "first").orderBy("t").collect()]
    assert first == [1.0, 1.5, 2.25, 3.125, 5.5625]


def test_rsi_without_losses(spark):
    d = spark.createDataFrame([("a", i, float(i)) for i in range(16)], "k string, t int, p double")
    out = ind.rsi(d, "k", "t", "p", 14).collect()
    assert len(out) == 2 and all(abs(r.rsi - 99.00990099009901) < 1e-9 for r in out)


def test_macd_starts_at_first_signal(spark):
    d = spark.createDataFrame([("a", i, float(i * i % 17)) for i in range(40)], "k string, t int, p double")
    out = ind.macd(d, "k", "t", "p").orderBy("t").collect()
    assert out[0].t == 33 and len(out) == 7
    assert all(abs(r.histogram - (r.macd - r.signal)) < 1e-12 for r in out)


def test_short_series_give_nothing(spark):
    d = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "k string, t int, p double")
    assert ind.ema(d, "k", "t", "p", 3).count() == ind.sma(d, "k", "t", "p", 3).count() == ind.rsi(d, "k", "t", "p", 14).count() == 0


def test_asof_tolerance_edges(spark):
    left = spark.createDataFrame([("2024-01-10",), ("2024-01-15",), ("2024-01-16",), ("2024-01-01",)], "d string").select(F.to_date("d").alias("d"))
    right = spark.createDataFrame([("2024-01-10", 1.0, 7.0), ("2024-01-09", 2.0, 9.0), ("2024-01-15", None, 3.0)], "t string, v double, u double").select(F.to_date("t").alias("t"), "v", "u")
    got = {str(r.d): (r.v, r.u) for r in asof.asof_join(left, right, "d", "t", 5).collect()}
    assert got == {"2024-01-10": (1.0, 7.0), "2024-01-15": (None, 3.0), "2024-01-16": (None, 3.0), "2024-01-01": (None, None)}
    need = {str(r.d): r.v for r in asof.asof_join(left, right, "d", "t", 5, require="v").collect()}
    assert need == {"2024-01-10": 1.0, "2024-01-15": 1.0, "2024-01-16": None, "2024-01-01": None}


def test_asof_and_timeline_agree(spark):
    rnd = random.Random(3)
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n)
    cal = spark.range(120).select(day(F.col("id").cast("int")).alias("date"))
    obs = spark.createDataFrame([(i, float(i)) for i in range(150) if rnd.random() < 0.2], "n int, v double").select(day(F.col("n")).alias("t"), "v")
    a = {r.date: r.v for r in asof.asof_join(cal, obs, "date", "t", 4).collect()}
    b = {r.date: r.x.v if r.x else None for r in asof.asof_timeline(cal, {"x": (obs, "t", 4)}).collect()}
    assert a == b


def test_ffill_slots_and_age(spark):
    d = series(spark, {"hot": 300, "b": 20}).withColumn("price", F.when(F.col("seq") % 7 == 0, F.col("price")))
    assert rows(asof.ffill(d, "k", "ts", ["price"], seq="seq")) == rows(asof.ffill(d, "k", "ts", ["price"], seq="seq", slot="30 minutes"))


def test_constant_series_has_no_correlation(spark):
    d = spark.createDataFrame([("a", i, 1.0) for i in range(5)] + [("b", i, float(i)) for i in range(5)] + [("c", i, 2.0 * i) for i in range(5)], "k string, t int, v double")
    got = {(r.a, r.b): r.correlation for r in pair_stats(d, "k", "t", "v", ["a", "b", "c"]).collect()}
    assert got[("a", "b")] is None and got[("a", "c")] is None and abs(got[("b", "c")] - 1) < 1e-12


def test_first_row_has_no_return(spark):
    d = series(spark, {"a": 5, "b": 2})
    out = returns.simple_return(d, "k", "ts", "price", seq="seq").filter("prev_close IS NULL")
    assert rows(out, "k", "return_pct") == [("a", None), ("b", None)]


@pytest.mark.parametrize("n", [1, 2, 501, 1000])
def test_group_median_is_exact(spark, n):
    rnd = random.Random(n)
    vals = [("hot", round(rnd.expovariate(0.1), 3)) for _ in range(n)] + [("hot", 5.0)] * (n // 2) + [("b", 2.0), ("b", 4.0), ("c", None)]
    got = {r.g: r.median for r in events.group_median(spark.createDataFrame(vals, "g string, v double"), "g", "v", rows=5).collect()}
    hot = sorted(v for g, v in vals if g == "hot")
    mid = (hot[(len(hot) - 1) // 2] + hot[len(hot) // 2]) / 2
    assert got == {"hot": mid, "b": 3.0}


@pytest.mark.parametrize("few", [True, False])
def test_group_quantiles_are_exact(spark, monkeypatch, few):
    """Ties that fill most of a group, infinities, missing values and groups, one value; ranges of five values at most; cuts that miss."""
    rng = random.Random(2)
    vals = [("hot", rng.gauss(0, 1)) for _ in range(400)] + [("tie", 5.0)] * 300 + [("tie", rng.random() * 10) for _ in range(90)] + [("inf", x) for x in (float("inf"), float("-inf"), 1.0)]
    vals += [("one", 7.0), ("none", None), ("none", float("nan")), (None, 1.0), (None, 2.0), ("zero", -0.0), ("zero", 0.0)]
    if not few:
        monkeypatch.setattr(quantiles, "BROADCAST_GROUPS", 0)
        monkeypatch.setattr(quantiles, "MARGIN", -0.002)  # the upper cut lies below the lower one: every sketch misses
    probs = {"least": 0.0, "q1": 0.25, "mid": 0.5, "most": 1.0}
    got = {r.g: r for r in quantiles.group_quantiles(spark.createDataFrame(vals, "g string, v double"), "g", "v", probs, rows=5).collect()}
    assert set(got) == {"hot", "tie", "inf", "one", "zero", None}
    for g in set(got) - {"inf"}:
        x = np.array([v for k, v in vals if k == g])
        assert [got[g][n] for n in probs] == pytest.approx([np.quantile(x, p) for p in probs.values()], abs=1e-12), g
    assert (got["inf"].least, got["inf"].mid, got["inf"].most) == (float("-inf"), 1.0, float("inf"))
    whole = quantiles.group_quantiles(spark.createDataFrame(vals, "g string, v double").filter("g = 'hot'"), None, "v", {"mid": 0.5}, rows=5).collect()
    assert [r.mid for r in whole] == [got["hot"].mid] and quantiles.group_quantiles(spark.createDataFrame([], "g string, v double"), "g", "v", probs).collect() == []


def test_no_task_orders_more_than_the_bound(spark, monkeypatch):
    """Ten million values of one group, at most 20,000 ordered; the ranges that are ordered are counted."""
    ordered = []
    keep = quantiles.stored

    def watch(df):
        out = keep(df)
        if "_state" in out.columns:
            ordered.extend(r._n for r in out.filter("_state = 'order'").collect())
        return out

    monkeypatch.setattr(quantiles, "stored", watch)
    d = spark.range(10_000_000).select(F.lit("a").alias("g"), ((F.col("id") * 7_368_787) % 10_000_019).cast("double").alias("v"))
    got = quantiles.group_quantiles(d, "g", "v", {"mid": 0.5}, rows=20_000).first().mid
    assert ordered and max(ordered) <= 22_000
    assert got == d.selectExpr("percentile(v, 0.5)").first()[0]


def test_walk_forward_folds(spark):
    d = spark.range(130).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    f = events.walk_forward(d, "day", 60, 20, 20).groupBy("fold", "part").count()
    assert rows(f) == [(0, "test", 20), (0, "train", 60), (1, "test", 20), (1, "train", 60), (2, "test", 20), (2, "train", 60)]


def test_forward_labels_edges(spark):
    d = spark.createDataFrame([("a", i, float(100 + (i % 3))) for i in range(30)], "k string, day int, close double")
    out = events.forward_labels(d, "k", "day").orderBy("day").collect()
    assert out[10].vol_expansion_3d is None and out[22].vol_expansion_3d in (0, 1) and out[-1].fwd_sign_5d is None


def test_pairs_travel_as_tiles(spark, monkeypatch):
    """Where all times fit into a span, a matrix goes to each tile, not to each block, and no sums of pairs are shuffled; the results are those of spans."""
    rng = random.Random(8)
    d = spark.createDataFrame([(f"s{k}", t, rng.gauss(k, 1)) for k in range(40) for t in range(30) if rng.random() < 0.6 or k == 7], "k string, t int, v double")
    found = {}
    for sizes in ((4, 64, 4, 4 * 4 * 40, 2), (4, 64, 4, 1, 8), (4, 4, 2, 1, 8)):
        for name, size in zip(("SERIES", "TIMES", "SPAN", "CELLS", "TILES"), sizes):
            monkeypatch.setattr(pairs, name, size)
        out = pair_stats(d, "k", "t", "v")
        plan = out._jdf.queryExecution().executedPlan().toString()
        found[sizes] = ({(r.a, r.b): (r.n, r.covariance, r.correlation) for r in out.collect()}, "sums" in plan)
    (tiles, summed), (blocks, blocks_summed), (spans, spans_summed) = found.values()
    assert (summed, blocks_summed, spans_summed) == (False, False, True)
    assert len(tiles) == 40 * 39 // 2 and tiles.keys() == blocks.keys() == spans.keys()
    for k, v in spans.items():
        assert v == pytest.approx(tiles[k], abs=1e-9) and v == pytest.approx(blocks[k], abs=1e-9)


def test_tiles_are_as_large_as_their_values(spark, monkeypatch):
    """Values are dealt once and empty places make no tiles, so few matrices are shuffled; blocks with other times, and instants that several local times share."""
    rng = random.Random(11)
    data = [(f"s{k}", dt.datetime(2024, 3, 1) + dt.timedelta(days=t), rng.gauss(k, 1)) for k in range(40) for t in range(3 * k % 50, 3 * k % 50 + 30) if rng.random() < 0.7]
    wide = pd.DataFrame(data, columns=["k", "t", "v"]).set_index(["t", "k"]).v.unstack()
    want = {(a, b): wide[[a, b]].dropna().cov(ddof=0).loc[a, b] for a in wide for b in wide if a < b and len(wide[[a, b]].dropna())}
    gap = dt.datetime(2024, 3, 31, 2, 30)  # not on the clock in Berlin: half past three
    data += [(k, gap + dt.timedelta(hours=h), v) for k, h, v in (("gap", 0, 2.0), ("gap", 1, 1.0), ("noon", 1, 4.0), ("gap", 24, 5.0), ("noon", 24, 5.0))] + [(k, gap, v) for k, v in (("gap", 1.0), ("noon", 3.0))]
    zone = spark.conf.get("spark.sql.session.timeZone")
    for name, size in (("SERIES", 4), ("CELLS", 600), ("TILES", 2)):
        monkeypatch.setattr(pairs, name, size)

    def written(p):
        """Records that the exchanges of a plan have written, each exchange once."""
        name = p.getClass().getSimpleName()
        own = p.metrics().apply("shuffleRecordsWritten").value() if name == "ShuffleExchangeExec" else 0
        below = [p.executedPlan()] if name == "AdaptiveSparkPlanExec" else [p.plan()] if name.endswith("QueryStageExec") else [p.children().apply(k) for k in range(p.children().size())]
        return own + sum(map(written, below))

    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        out = pair_stats(spark.createDataFrame(data, "k string, t timestamp_ntz, v double"), "k", "t", "v")
        got = {(r.a, r.b): (r.n, r.covariance) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got.pop(("gap", "noon")) == (2, 0.75) and got.keys() == want.keys() and all(got[k][1] == pytest.approx(v, abs=1e-9) for k, v in want.items())
    assert written(out._jdf.queryExecution().executedPlan()) <= len(data) + 40


def test_range_mean_adds_up_no_frame_twice(spark):
    """Dense rows, ties, gaps, missing values, and values that must leave no trace; frames that only grow, so the work does not follow the density."""
    rng = random.Random(5)
    data = [(k, rng.randrange(-9000, 9000), i, rng.choice([None, 1.5, 2.25, 7.0, 1e18 if i % 40 == 0 else 3.0])) for i in range(700) for k in ("a", None) if k or i % 7 == 0]
    data += [("a", 9500, 800, float("inf")), ("a", 9501, 801, float("nan")), ("b", 0, 802, None), ("b", None, 803, 1.0), ("a", 30000, 804, 4.0), ("a", 30060, 805, 6.0), ("a", 30061, 806, 8.0)]
    d = spark.createDataFrame(data, "k string, s long, seq long, v double").select("k", F.timestamp_seconds("s").alias("ts"), "seq", "v")
    out = returns.range_mean(d, "k", "ts", "v", 60)
    got = {r.seq if r.k else (r.seq,): r.range_mean for r in out.collect()}
    want = {}
    for k, s, seq, _ in data:
        if s is not None:
            seen = [v for q, t, _, v in data if q == k and t is not None and s - 60 <= t <= s and v is not None]
            want[seq if k else (seq,)] = sum(seen) / len(seen) if seen else None
    assert got.keys() == want.keys() and (got[804], got[805], got[806]) == (4.0, 5.0, 7.0)
    assert all(close(got[q], w) or (got[q] != got[q] and w != w) for q, w in want.items())
    frames = out._jdf.queryExecution().executedPlan().toString().split("specifiedwindowframe(")[1:]
    assert frames and all("unboundedpreceding" in f.split(")")[0] for f in frames)
