"""Load template: read -> shape -> validate -> store, each step replaceable."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.operators.dedup import latest_version
from finlake.sources.bars import daily_from_grouped

Step = Callable[[DataFrame], DataFrame]


@dataclass
class Load:
    """A chain of DataFrame steps; ``run`` returns the rows ready to store."""

    shape: Step
    validate: Step = field(default=lambda df: df)
    store: Callable[[DataFrame], None] | None = None

    def run(self, raw: DataFrame) -> DataFrame:
        out = raw.transform(self.shape).transform(self.validate)
        if self.store:
            self.store(out)
        return out


def daily_load(raw: DataFrame, store: Callable[[DataFrame], None] | None = None) -> DataFrame:
    """Grouped daily payload rows -> one validated bar per ticker and day."""
    load = Load(
        shape=lambda df: daily_from_grouped(df, ingested_at=F.current_timestamp()),
        validate=lambda df: latest_version(df, ["ticker", "day"], ["ingested_at", "transactions", "close", "volume"]), store=store)
    return load.run(raw)
