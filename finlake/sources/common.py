"""Reading landed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON-lines files with a fixed schema; lines that do not parse give NULL columns."""
    return spark.read.schema(schema).json(path)


def parse_text(df: DataFrame, column: str, schema: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload text column -> its fields (the same plan for files and message streams).

    A generator, not a projection: Spark repeats a projection's expressions in the filters that it pushes below it (a join adds
    one for each of its keys), so each text would be parsed again for each of them.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(F.col(column), schema))))


def whole(column: str) -> Column:
    """Integer column of a lenient feed: bad or missing values become 0."""
    return F.coalesce(F.col(column).try_cast("double").try_cast("long"), F.lit(0).cast("long"))


def lenient_date(column: str) -> Column:
    return F.col(column).try_cast("date")


def stamp(df: DataFrame, source: str, ingested_at: Column | None = None) -> DataFrame:
    return df.withColumn("source", F.lit(source)).withColumn(
        "ingested_at", ingested_at if ingested_at is not None else F.current_timestamp())


def universe_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """One ticker per line -> distinct upper-case ``ticker`` rows, blanks dropped."""
    t = lines.select(F.upper(F.trim(F.col(column))).alias("ticker"))
    return t.filter(F.col("ticker") != "").distinct()


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    return universe_from_lines(spark.read.text(path))


def only_tickers(df: DataFrame, universe: DataFrame, ticker: str = "ticker") -> DataFrame:
    return df.join(universe.select(F.col("ticker").alias(ticker)), ticker, "left_semi")
