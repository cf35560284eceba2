import duckdb
import pytest

import __spark_entry__ as contract
from catalog import ORACLES, QUERIES
from compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"

# One or two of each kind; compare.py checks all of them.
CHOSEN = [
    "tpt_scan", "union_parts", "param_matrix_rows", "curve_long", "fx_asof", "sym_adj_lookup",
    "cast_rejects", "excel_serial_date", "tpt_calc_type", "tpt_validation_report", "tpt_critical_report",
    "lookthrough_join", "position_value", "value_reconciliation", "validation_report",
    "group_dominant", "curve_interpolate", "equity_risk", "interest_rate_risk", "spread_risk",
    "currency_risk", "concentration_risk", "concentration_by_country", "property_risk", "ul_currency_risk",
]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, oracle, name):
    df = contract.queries()[name](spark, SF)
    want = oracle.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "portfolio_group" and df.count() > 0
