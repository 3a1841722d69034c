"""Table functions for ad-hoc SQL: marts and stored features called with arguments.

``Lake.sql`` offers each function whose tables are stored, for example
``SELECT * FROM daily_returns('SPY', DATE '2024-01-01', NULL)``.  A NULL argument sets no limit.  The rows are a DataFrame
of the lake, the arguments become ordinary filters of its plan, so those on a window's own keys reach the scan.
Further functions are added with the decorator::

    @table_function("volume_between", ("ohlcv_daily",), "first_day DATE, last_day DATE", between("day"))
    def volume(lake):
        return lake.daily().select("ticker", "day", "volume")
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.operators.returns import simple_return
from finlake.plans import breadth, fundamentals as fun

Source = Callable[["Lake"], DataFrame]  # noqa: F821


@dataclass(frozen=True)
class TableFunction:
    """Rows of a lake, the arguments in SQL, and the condition that uses them; argument and column names differ."""

    needs: tuple[str, ...]
    arguments: str
    where: str
    rows: Source


FUNCTIONS: dict[str, TableFunction] = {}


def table_function(name: str, needs: tuple[str, ...], arguments: str, where: str) -> Callable[[Source], Source]:
    """Register a function of the lake under a name of SQL; the same name again replaces it."""
    if not re.fullmatch(r"[a-z][a-z0-9_]*", name):
        raise ValueError(f"not a name for a table function: {name!r}")

    def register(rows: Source) -> Source:
        FUNCTIONS[name] = TableFunction(needs, arguments, where, rows)
        return rows
    return register


def equal(column: str, argument: str) -> str:
    return f"({argument} IS NULL OR {column} = {argument})"


def between(column: str) -> str:
    return f"(first_day IS NULL OR {column} >= first_day) AND (last_day IS NULL OR {column} <= last_day)"


def asked(text: str) -> list[str]:
    """Registered functions that a statement may call; only these are planned."""
    return [name for name in FUNCTIONS if re.search(rf"\b{name}\s*\(", text, re.IGNORECASE)]


def create(lake, name: str) -> None:
    """Make a function known to the lake's session, over a view of its rows."""
    f, spark = FUNCTIONS[name], lake.spark
    rows = f.rows(lake)
    rows.createOrReplaceTempView(f"{name}_rows")
    columns = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({f.arguments}) RETURNS TABLE ({columns}) RETURN SELECT * FROM {name}_rows WHERE {f.where}")


_SPAN = "first_day DATE, last_day DATE"
_TICKER = "one_ticker STRING"


@table_function("daily_returns", ("ohlcv_daily",), f"{_TICKER}, {_SPAN}", f"{equal('ticker', 'one_ticker')} AND {between('day')}")
def daily_returns(lake) -> DataFrame:
    """Close, previous close and percent change; the first day asked for still has its predecessor."""
    return simple_return(lake.daily().select("ticker", "day", "close"), "ticker", "day")


@table_function("daily_movers", ("ohlcv_daily",), "on_day DATE, most INT", f"{equal('day', 'on_day')} AND (most IS NULL OR place <= most)")
def daily_movers(lake) -> DataFrame:
    """Largest percent changes of each day, ties by ticker."""
    moved = daily_returns(lake).filter(F.col("return_pct").isNotNull())
    return moved.withColumn("place", F.row_number().over(W.partitionBy("day").orderBy(F.desc("return_pct"), "ticker")))


@table_function("breadth_between", ("ohlcv_daily", "universe"), _SPAN, between("day"))
def breadth_between(lake) -> DataFrame:
    return breadth.breadth_thrust(lake.daily(), lake.universe())


@table_function("statements_of", ("financials",), f"{_TICKER}, frame STRING", f"{equal('ticker', 'one_ticker')} AND {equal('timeframe', 'frame')}")
def statements_of(lake) -> DataFrame:
    """Statements with their timeframe, ``annual`` or ``quarterly``."""
    d = lake.table("financials")
    return fun.periods(d, "annual").withColumn("timeframe", F.lit("annual")).unionByName(fun.periods(d, "quarterly").withColumn("timeframe", F.lit("quarterly")))


@table_function("snapshot_of", ("option_chains",), "one_underlying STRING, on_day DATE", f"{equal('underlying', 'one_underlying')} AND {equal('snapshot_date', 'on_day')}")
def snapshot_of(lake) -> DataFrame:
    return lake.table("option_chains")


@table_function("curve_between", ("treasury_yields",), _SPAN, between("date"))
def curve_between(lake) -> DataFrame:
    return lake.table("treasury_yields")


@table_function("features_between", ("algo_feature_matrix",), _SPAN, between("date"))
def features_between(lake) -> DataFrame:
    """The stored feature matrix."""
    return lake.features()
