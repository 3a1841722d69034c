"""Column expressions shared by every operator.

All arithmetic that could divide by zero goes through :func:`safe_div`: ANSI mode
raises on ``x / 0`` and on the built-in ``corr`` of a constant series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def names(cols: str | Sequence[str] | None) -> list[str]:
    """One name or many -> list of names."""
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


# ---- arithmetic ---------------------------------------------------------------

def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def pct_change(new: ColumnOrName, old: ColumnOrName) -> Column:
    return safe_div(col(new) - col(old), old) * 100


def pct_of(part: ColumnOrName, whole: ColumnOrName) -> Column:
    return safe_div(part, whole) * 100


def positive_log(c: ColumnOrName) -> Column:
    """``ln`` of a positive number, NULL otherwise."""
    return F.when(col(c) > 0, F.ln(col(c)))


# ---- conditional aggregates ---------------------------------------------------

def sum_if(value: ColumnOrName, cond: Column) -> Column:
    """Sum over matching rows; 0 when nothing matches."""
    return F.coalesce(F.sum(F.when(cond, col(value))), F.lit(0))


def avg_if(value: ColumnOrName, cond: Column) -> Column:
    """Mean over matching rows; NULL when nothing matches."""
    return F.avg(F.when(cond, col(value)))


def max_if(value: ColumnOrName, cond: Column) -> Column:
    return F.max(F.when(cond, col(value)))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def latest(value: ColumnOrName, by: ColumnOrName) -> Column:
    """Value at the largest ``by`` among rows where the value is not NULL."""
    return F.max_by(col(value), F.when(col(value).isNotNull(), col(by)))


def earliest(value: ColumnOrName, by: ColumnOrName) -> Column:
    """Value at the smallest ``by`` among rows where the value is not NULL."""
    return F.min_by(col(value), F.when(col(value).isNotNull(), col(by)))


# ---- statistics ---------------------------------------------------------------

def _both(x: ColumnOrName, y: ColumnOrName) -> tuple[Column, Column]:
    ok = col(x).isNotNull() & col(y).isNotNull()
    return F.when(ok, col(x)), F.when(ok, col(y))


def safe_corr(x: ColumnOrName, y: ColumnOrName, over=None) -> Column:
    """Pearson correlation; NULL (not an error) when one side is constant."""
    a, b = _both(x, y)
    parts = [F.covar_pop(a, b), F.stddev_pop(a), F.stddev_pop(b)]
    if over is not None:
        parts = [p.over(over) for p in parts]
    return F.try_divide(parts[0], parts[1] * parts[2])


def beta(y: ColumnOrName, x: ColumnOrName) -> Column:
    a, b = _both(y, x)
    return F.try_divide(F.covar_pop(a, b), F.var_pop(b))


# ---- time ---------------------------------------------------------------------

def bucket(ts: ColumnOrName, every: str) -> Column:
    """Start of the epoch-aligned bucket, e.g. ``every='15 minutes'``."""
    return F.window(col(ts), every).start


def period_start(day: ColumnOrName, unit: str) -> Column:
    """First day of the week (Monday), month, quarter or year."""
    return F.trunc(col(day), unit)


def seconds(t: ColumnOrName) -> Column:
    """Epoch seconds of a DATE or TIMESTAMP column."""
    return F.unix_timestamp(col(t).cast("timestamp"))


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    return F.datediff(col(end), col(start))


def order_key(ts: ColumnOrName, seq: ColumnOrName) -> Column:
    """One sortable number for (timestamp, sequence).

    ``min_by`` / ``max_by`` on a struct forces a sort-based aggregate, because a
    struct cannot live in a hash-aggregate buffer; a decimal can.
    """
    micros = F.unix_micros(col(ts).cast("timestamp")).cast("decimal(19,0)")
    return (micros * F.expr("10000000000000000000BD") + col(seq).cast("decimal(19,0)")).cast("decimal(38,0)")


# ---- classification -----------------------------------------------------------

def sector_from_code(code: ColumnOrName) -> Column:
    """Sector from the first two digits of an industry code."""
    from finlake.functions.lookups import SECTOR_PREFIXES

    prefix = F.substring(col(code), 1, 2)
    out = None
    for sector, prefixes in SECTOR_PREFIXES.items():
        test = prefix.isin(*prefixes)
        out = F.when(test, sector) if out is None else out.when(test, sector)
    return out.otherwise("Other")


def lookup(code: ColumnOrName, table: dict[str, str]) -> Column:
    """Value from a small fixed table; NULL for an unknown code."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col(code))


def bands(value: ColumnOrName, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first limit the value is below; NULL values get NULL."""
    out = F.when(col(value).isNull(), F.lit(None).cast("string"))
    for limit, label in limits:
        out = out.when(col(value) < limit, label)
    return out.otherwise(otherwise)
