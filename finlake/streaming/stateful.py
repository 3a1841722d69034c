"""Stateful processors: keyed maps with timers on the RocksDB state store.

A processor holds one row of state for each open pane of a key instead of one text for the key, so a batch writes only what it
changed.  Each key has at most one timer, for the first watermark at which its state has something to do; timers fire between
batches, so a key is visited at most once for it however much has come due.  (A timer fires when the watermark reaches it and
is deleted after that, so what is still undone must never ask for the same moment again.)  A key with empty maps has no timer and no state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def keyed(rows: DataFrame, processor: StatefulProcessor, schema: str, mode: str = "Append", key: str = "key") -> DataFrame:
    """Run a processor on event time; the session's state store becomes RocksDB, which keyed maps need."""
    rows.sparkSession.conf.set(PROVIDER, ROCKSDB)
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, mode, "EventTime")


class Panes(StatefulProcessor):
    """Common ground: maps that are read whole, changed in memory, and written back where they changed."""

    #: name -> (key schema, value schema)
    maps: dict[str, tuple[str, str]] = {}
    columns: list[str] = []

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = {name: handle.getMapState(name, *kinds) for name, kinds in self.maps.items()}
        self.due = handle.getValueState("due", "at LONG")

    def load(self, name: str) -> dict[tuple, tuple]:
        return {tuple(k): tuple(v) for k, v in self.state[name].iterator()}

    def save(self, name: str, before: dict[tuple, tuple], after: dict[tuple, tuple]) -> None:
        kept = self.state[name]
        if before and not after:
            kept.clear()
            return
        for k in before:
            if k not in after:
                kept.removeKey(k)
        for k, v in after.items():
            if before.get(k) != v:
                kept.updateValue(k, v)

    def wake(self, at: Iterable[int]) -> None:
        """Have the one timer of this key at the earliest of some times in milliseconds."""
        want, have = min(at, default=None), self.due.get()[0] if self.due.exists() else None
        if want == have:
            return
        if have is not None:
            self.handle.deleteTimer(have)
        if want is None:
            self.due.clear()
        else:
            self.handle.registerTimer(want)
            self.due.update((want,))

    def table(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.columns)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()  # the timer has fired and is gone
        yield from self.advance(key, timerValues.getCurrentWatermarkInMs())

    def advance(self, key: tuple, mark: int) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def close(self) -> None:
        pass


class Spikes(Panes):
    """Minutes whose volume exceeds ``factor`` times the mean minute of the ``horizon`` seconds up to them.

    ``open`` has minutes that may still grow, ``kept`` the closed ones that later minutes are judged against.
    """

    maps = {"open": ("minute LONG", "volume DOUBLE"), "kept": ("minute LONG", "volume DOUBLE")}
    columns = ["key", "minute", "volume", "mean_volume"]

    def __init__(self, factor: float, horizon: int):
        self.factor, self.horizon = factor, horizon

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before = self.load("open")
        after = dict(before)
        for b in rows:
            for minute, volume in zip(b["start"].tolist(), b["volume"].tolist()):
                after[minute,] = (after.get((minute,), (0.0,))[0] + volume,)
        self.save("open", before, after)
        self._sleep(after, self.load("kept"))
        return iter([])

    def _sleep(self, opened: dict, kept: dict) -> None:
        self.wake([(m + 60) * 1000 for m, in opened] + [(m + self.horizon) * 1000 + 1 for m, in kept])

    def advance(self, key: tuple, mark: int) -> Iterator[pd.DataFrame]:
        opened, held = self.load("open"), self.load("kept")
        left, kept, hits = dict(opened), dict(held), []
        for minute in sorted(m for m, in opened if (m + 60) * 1000 <= mark):
            (volume,) = left.pop((minute,))
            kept = {k: v for k, v in kept.items() if k[0] >= minute - self.horizon} | {(minute,): (volume,)}
            mean = sum(v for v, in kept.values()) / len(kept)
            if volume > self.factor * mean:
                hits.append((key[0], minute, volume, mean))
        kept = {k: v for k, v in kept.items() if (k[0] + self.horizon) * 1000 >= mark}  # older ones matter to no later minute
        self.save("open", opened, left)
        self.save("kept", held, kept)
        self._sleep(left, kept)
        yield self.table(hits)


class Recent(Panes):
    """A table of the rows of the last ``horizon`` milliseconds of each key, told as newest value and number of rows whenever it changes.

    The table is cut into panes of a 64th of the horizon.  ``panes`` has the first time and the number of rows of each, ``times`` the
    milliseconds of its rows, each once with its count, as one packed value.  So a batch asks the state store for the panes that it
    touches, not for rows, and what the watermark passes goes by panes: only the pane at the horizon is opened.  Values
    need no table, since the newest row leaves last: ``newest`` has its time in microseconds and its value.
    """

    maps = {"panes": ("pane LONG", "oldest LONG, n LONG"), "times": ("pane LONG", "times BINARY")}
    columns = ["key", "newest", "value", "rows"]
    #: Rows of a key that are held before they go into the state.
    HELD = 1 << 22

    def __init__(self, horizon: int):
        self.horizon, self.width = horizon, max(1, horizon // 64)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.newest = handle.getValueState("newest", "at LONG, value DOUBLE")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before = self.load("panes")
        after, held, newest = dict(before), [], self.newest.get() if self.newest.exists() else None
        for b in rows:
            us, value = b["us"].to_numpy(), b["value"].to_numpy()
            last = us.max()
            top = (int(last), float(value[us == last].max()))
            if newest is None or newest[0] < top[0]:
                newest = top
            elif newest[0] == top[0]:
                newest = (top[0], float(np.maximum(newest[1], top[1])))
            held.append(us // 1000)
            if sum(map(len, held)) >= self.HELD:
                self._put(after, np.concatenate(held))
                held = []
        if held:
            self._put(after, np.concatenate(held))
        if newest:
            self.newest.update(tuple(newest))
        yield self._tell(key, before, after, timerValues.getCurrentWatermarkInMs())

    def advance(self, key: tuple, mark: int) -> Iterator[pd.DataFrame]:
        before = self.load("panes")
        yield self._tell(key, before, dict(before), mark)

    def _times(self, pane: int) -> np.ndarray:
        """Milliseconds of a pane in order, and the rows of each."""
        return np.frombuffer(self.state["times"].getValue((pane,))[0], np.int64).reshape(2, -1)

    def _keep(self, panes: dict, pane: int, at: np.ndarray, n: np.ndarray) -> None:
        self.state["times"].updateValue((pane,), (np.stack([at, n]).tobytes(),))
        panes[pane,] = (int(at[0]), int(n.sum()))

    def _put(self, panes: dict, ms: np.ndarray) -> None:
        """Count more rows in their panes."""
        at, n = np.unique(ms, return_counts=True)
        pane, start = np.unique(at // self.width, return_index=True)
        for p, a, m in zip(pane.tolist(), np.split(at, start[1:]), np.split(n, start[1:])):
            if (p,) in panes:
                had = self._times(p)
                a, place = np.unique(np.concatenate([had[0], a]), return_inverse=True)
                m = np.bincount(place, np.concatenate([had[1], m])).astype(np.int64)
            self._keep(panes, p, a, m)

    def _tell(self, key: tuple, before: dict, panes: dict, mark: int) -> pd.DataFrame:
        first = mark - self.horizon  # the first millisecond that is still in the table
        for (p,), (oldest, _) in list(panes.items()):
            if oldest >= first:
                continue
            at, n = self._times(p) if p == first // self.width else (np.empty(0, np.int64), np.empty(0, np.int64))
            live = at >= first
            if live.any():
                self._keep(panes, p, at[live], n[live])
            else:
                del panes[p,]
                self.state["times"].removeKey((p,))
        self.save("panes", before, panes)
        self.wake([min(o for o, _ in panes.values()) + self.horizon + 1] if panes else [])
        newest = self.newest.get() if panes else (None, None)
        if not panes:
            self.newest.clear()
        return self.table([(key[0], *newest, sum(n for _, n in panes.values()))])


class Chain(Panes):
    """Bars of several grains, each from the closed bars of the one before it."""

    maps = {"panes": ("grain INT, start LONG", "o_at LONG, o_seq LONG, open DOUBLE, high DOUBLE, low DOUBLE, c_at LONG, c_seq LONG, close DOUBLE, volume LONG, notional DOUBLE, n LONG")}
    columns = ["grain", "key", "bucket", "open", "high", "low", "close", "volume", "notional", "n"]

    def __init__(self, seconds: list[int]):
        self.seconds = seconds

    @staticmethod
    def merged(a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        first, last = (a if a[:2] <= b[:2] else b), (a if a[5:7] >= b[5:7] else b)
        return (*first[:3], max(a[3], b[3]), min(a[4], b[4]), *last[5:8], a[8] + b[8], a[9] + b[9], a[10] + b[10])

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        before = self.load("panes")
        after = dict(before)
        for b in rows:
            for start, *bar in b[["bucket", *PARTIAL]].itertuples(index=False):
                after[0, start] = self.merged(after.get((0, start)), tuple(bar))
        self.save("panes", before, after)
        self._sleep(after)
        return iter([])

    def _sleep(self, panes: dict) -> None:
        self.wake([(start + self.seconds[g]) * 1000 for g, start in panes])

    def advance(self, key: tuple, mark: int) -> Iterator[pd.DataFrame]:
        before = self.load("panes")
        after, out = dict(before), []
        for g, width in enumerate(self.seconds):
            for start in sorted(s for level, s in after if level == g and (s + width) * 1000 <= mark):
                bar = after.pop((g, start))
                out.append((g, key[0], start, bar[2], bar[3], bar[4], bar[7], bar[8], bar[9], bar[10]))
                if g + 1 < len(self.seconds):
                    up = (g + 1, start - start % self.seconds[g + 1])
                    after[up] = self.merged(after.get(up), bar)
        self.save("panes", before, after)
        self._sleep(after)
        yield self.table(out)


#: A partial bar in the order of the state's values.
PARTIAL = ["o_at", "o_seq", "open", "high", "low", "c_at", "c_seq", "close", "volume", "notional", "n"]


def partial_bars(ticks: DataFrame, seconds: int, key: str, ts: str, price: str, size: str, seq: str | None) -> DataFrame:
    """Ticks of one task and pane as one row: a hot key reaches its stateful task as a few rows a pane and partition.

    ``last`` is the newest time in it, so the watermark is that of the ticks.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.sort_values(["at", "seq"], kind="stable")
            g = b.assign(bucket=b["at"] // 1_000_000 // seconds * seconds, notional=b["price"] * b["size"]).groupby(["key", "bucket"], as_index=False, sort=False)
            yield g.agg(o_at=("at", "first"), o_seq=("seq", "first"), open=("price", "first"), high=("price", "max"), low=("price", "min"), c_at=("at", "last"), c_seq=("seq", "last"),
                        close=("price", "last"), volume=("size", "sum"), notional=("notional", "sum"), n=("at", "size"), last=("last", "max"))

    flat = ticks.select(F.col(key).alias("key"), F.unix_micros(ts).alias("at"), (F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")).alias("seq"),
                        F.col(price).cast("double").alias("price"), F.col(size).cast("bigint").alias("size"), F.col(ts).alias("last"))
    flat = flat.filter("key IS NOT NULL AND at IS NOT NULL AND price IS NOT NULL AND size IS NOT NULL AND seq IS NOT NULL")
    return flat.mapInPandas(partial, f"key {ticks.schema[key].dataType.simpleString()}, bucket long, o_at long, o_seq long, open double, high double, low double, c_at long, c_seq long, close double, "
                                     "volume long, notional double, n long, last timestamp")
