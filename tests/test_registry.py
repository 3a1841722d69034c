"""Every registered query builds; a sample of them is compared with the oracle.

FINLAKE_ALL=1 compares all of them (``tools/compare.py`` does the same at any scale).
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, canon, key

SF = "/root/testdata/sf0.001"
SAMPLE = ["dq01_latest_version", "join06_asof_ticks", "agg01_bars_1h", "agg33_study_past_return", "win07_rolling_corr", "ind05_macd_split", "mrt01_market_breadth",
          "mrt16_corr_returns", "agg20_flow_surface_latest", "agg26_ratios", "src14_financials_from_facts", "mrt32_breadth_thrust", "fea06_macro", "str01_stream_bars_1h"]
QUERIES, SQL = entry.queries(), entry.oracle_sql()
CHOSEN = sorted(set(SQL) - set(entry.LLM)) if os.environ.get("FINLAKE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_oracles_belong_to_queries():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(entry.LLM) - set(SQL) == set()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHOSEN)
def test_against_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=key)
    rel = con.sql(SQL[name])
    at = {c: i for i, c in enumerate(rel.columns)}
    assert sorted(at) == cols
    assert got == sorted((tuple(canon(r[at[c]]) for c in cols) for r in rel.fetchall()), key=key)
