"""Registered queries: name -> (DataFrame builder over the given tables, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.checks.roles import Tables, oracle

Builder = Callable[[Tables], DataFrame]
CHECKS: dict[str, tuple[Builder, str | None]] = {}


def add(name: str, build: Builder, sql: str | None = None) -> None:
    if name in CHECKS:
        raise ValueError(f"registered twice: {name}")
    CHECKS[name] = (build, oracle(sql) if sql else None)


def rnd(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round result columns, so that two engines' last bits do not matter."""
    return df.withColumns({c: F.round(c, digits) for c in cols})
