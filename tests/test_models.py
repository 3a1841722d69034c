"""PCA against numpy, short history, feature group registration, missing values as stored."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.plans import features as fe
from finlake.plans.scoring import score_all_days


def matrix(spark, n=60, seed=5):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 2)
        data.append((dt.date(2024, 1, 1) + dt.timedelta(i), a, a + 0.3 * b, None if i % 9 == 0 else b, 1.0))
    return spark.createDataFrame(data, "date date, x double, y double, z double, w double")


def expected(rows):
    m = np.array([[np.nan if v is None else v for v in r] for r in rows], dtype=float)
    mean = np.nanmean(m, axis=0)
    m = np.where(np.isnan(m), mean, m)
    sd = m.std(axis=0)
    z = (m - m.mean(axis=0)) / np.where(sd == 0, 1, sd)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    vt *= np.sign(vt[np.arange(len(vt)), np.abs(vt).argmax(axis=1)])[:, None]
    return z @ vt.T


def test_pca_matches_numpy(spark):
    d = matrix(spark)
    got = fe.pca(d, ["x", "y", "z", "w"], 3).orderBy("date").collect()
    want = expected([(r.x, r.y, r.z, r.w) for r in got])
    for i in range(2):
        assert np.allclose([r[f"pc_{i + 1}"] for r in got], want[:, i], atol=1e-8)
    var = [np.var([r[f"pc_{i}"] for r in got]) for i in (1, 2, 3)]
    assert var == sorted(var, reverse=True)


def test_more_components_than_columns_are_null(spark):
    got = fe.pca(matrix(spark, 10), ["x", "y"], 4).first()
    assert got.pc_2 is not None and got.pc_3 is None and got.pc_4 is None


def test_score_day_needs_history(spark):
    d = matrix(spark, 40)
    assert fe.score_day(d, "2024-01-20", k=2).first().pc_1 is None
    assert fe.score_day(d, "2024-02-08", k=2).first().pc_1 is not None


def test_all_days_are_as_each_day_alone(spark):
    """Gaps in the dates, missing values, a column that is constant for some windows only, and dates near a chunk's edge."""
    d = matrix(spark, 420).withColumn("w", F.when(F.dayofyear("date") > 200, 2.0).otherwise(1.0) + F.when(F.dayofyear("date") == 150, None).otherwise(0.0))
    d = d.filter(F.dayofmonth("date") % 7 != 3).withColumn("feature_count", F.lit(1))
    cols = ["x", "y", "z", "w"]
    got = {r.date: r for r in score_all_days(d, lookback=60, k=5, days=100).collect()}
    assert len(got) == d.count() and set(r.x for r in got.values()) == set(r.x for r in d.collect())
    rows = sorted(d.collect(), key=lambda r: r.date)
    for r in rows:
        seen = [x for x in rows if r.date - dt.timedelta(90) <= x.date <= r.date]
        g = got[r.date]
        if sum(x.date < r.date for x in seen) < 30:
            assert g.pc_1 is None and g.explained is None
            continue
        want = expected([[x[c] for c in cols] for x in seen])[-1]
        assert np.allclose(np.abs([g.pc_1, g.pc_2, g.pc_3]), np.abs(want[:3]), atol=1e-7), r.date
        assert g.pc_5 is None and abs(g.explained - 1) < 1e-9
    for day in ("2024-02-20", "2024-07-20", "2025-01-12"):
        one, all_days = fe.score_day(d, day, lookback=60, k=2).first(), got[dt.date.fromisoformat(day)]
        assert np.allclose([one.pc_1, one.pc_2], [all_days.pc_1, all_days.pc_2], atol=1e-7)


def test_all_days_do_not_lose_digits(spark):
    """Values far from 0 that hardly move."""
    d = matrix(spark, 80).select("date", (1e9 + F.col("x")).alias("x"), (F.col("y") * 1e-6).alias("y"))
    got = score_all_days(d, k=2).orderBy("date").collect()[-1]
    want = fe.score_day(d, got.date, k=2).first()
    assert np.allclose(np.abs([got.pc_1, got.pc_2]), np.abs([want.pc_1, want.pc_2]), atol=1e-5)  # two loadings of one size: any sign
    assert score_all_days(d.filter("false"), k=2).collect() == []


def test_unknown_group_is_refused(spark):
    with pytest.raises(KeyError):
        fe.feature_matrix(None, spark.range(1).select(F.lit(None).alias("date")), ("nope",))


def test_stored_missing_values(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 1), None, None, None, 0, ["x"])],
                              "date date, iv_rank double, gex_sign int, zero_dte_put_volume long, feature_count int, stale_features array<string>")
    r = fe.storable(d).first()
    assert np.isnan(r.iv_rank) and r.gex_sign == 0 and r.zero_dte_put_volume == 0 and r.stale_features == ["x"]
