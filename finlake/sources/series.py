"""Economic and energy observations -> wide tables; futures matrices -> long bars."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finlake.functions.lookups import ECONOMIC_TABLES, ENERGY_TABLES, FUTURES
from finlake.operators.pivots import matrix_to_long, parse_observations, series_to_wide

REGISTRY = {**ECONOMIC_TABLES, **ENERGY_TABLES}


def register_series(table: str, columns: dict[str, str]) -> None:
    """Add or extend a wide table: series id -> column name."""
    REGISTRY.setdefault(table, {}).update(columns)


def wide_table(raw: DataFrame, table: str, seq: str | None = None) -> DataFrame:
    """Raw observations (series_id, date, value as text) -> the registered wide table."""
    return series_to_wide(parse_observations(raw), REGISTRY[table], seq=seq)


def futures_bars(matrix: DataFrame, time: str = "date") -> DataFrame:
    return matrix_to_long(matrix, time, FUTURES)
