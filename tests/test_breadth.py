"""Breadth thrust against a literal loop over the rule."""

import datetime as dt
import random

import pytest

from finlake.plans.breadth import EMA_DAYS, OVERSOLD, THRUST, WINDOW_DAYS, thrust_signal, thrust_status


def literal(ratios):
    k, ema, start, fired, out = 2 / (EMA_DAYS + 1), None, None, False, []
    for i, r in enumerate(ratios):
        ema = r if ema is None else r * k + ema * (1 - k)
        low, high = ema < OVERSOLD, ema > THRUST
        if low:
            start, fired = i, False
        active, left, now = False, None, False
        if start is not None and not fired and i - start <= WINDOW_DAYS:
            active, left = True, i - start
            if high:
                fired = now = True
        out.append((low, high, active, left, now))
    return out


def frame(spark, ratios):
    return spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(i), r) for i, r in enumerate(ratios)], "day date, breadth_ratio double")


def swing(seed):
    rnd, level, out = random.Random(seed), 0.5, []
    for _ in range(200):
        if rnd.random() < 0.12:
            level = rnd.choice([0.1, 0.3, 0.5, 0.8, 0.95])
        out.append(float(min(1.0, max(0.0, level + rnd.uniform(-0.1, 0.1)))))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_same_as_loop(spark, seed):
    ratios = swing(seed)
    got = [(r.oversold, r.thrust, r.signal_active, r.days_in_window, r.signal_fired) for r in thrust_signal(frame(spark, ratios)).orderBy("day").collect()]
    assert got == literal(ratios)


def test_fires_expires_and_rearms(spark):
    ratios = [0.5] + [0.0] * 4 + [1.0] * 12 + [0.0] * 8 + [0.5] * 14 + [1.0] * 8
    want = literal(ratios)
    assert sum(w[4] for w in want) == 1
    got = thrust_signal(frame(spark, ratios)).orderBy("day").collect()
    assert [r.signal_fired for r in got] == [w[4] for w in want]


def test_day_without_movers_counts_and_keeps_the_average(spark):
    got = thrust_signal(frame(spark, [0.3, None, 0.7])).orderBy("day").collect()
    assert [(r.day.day, r.breadth_ratio, r.days_in_window) for r in got] == [(1, 0.3, 0), (2, None, 0), (3, 0.7, 0)]
    assert got[0].ema_10 == got[1].ema_10 < got[2].ema_10
    assert thrust_status(thrust_signal(frame(spark, [0.5] * 30))).count() == 15
