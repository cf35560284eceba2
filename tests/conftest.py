import datetime
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

D = datetime.date

POSITION_SCHEMA = (
    "portfolio_group string, portfolio_id string, analysis_date date, security_name string, "
    "country string, rating string, cic_of_instrument string, asset_allocation string, "
    "currency string, exp_maturity_date date, balance_nominal double, modified_duration double, "
    "dirty_value_pc double, position_ord bigint"
)
HOLDING_SCHEMA = (
    "portfolio_id string, valuation_date date, portfolio_mod_dur double, scr_delivery string, "
    "cic_of_underlying string, economic_zone int, id_of_underlying string, "
    "name_of_underlying string, qc_of_underlying string, valuation_weight double, "
    "maturity_date date, cqs string, mod_dur_of_underlying double, "
    "underlying_asset_category string, holding_ord bigint"
)
CALC_SCHEMA = (
    "portfolio_group string, portfolio_id string, position_ord bigint, analysis_date date, "
    "security_name string, country string, currency string, cic_of_instrument string, "
    "asset_allocation string, balance_nominal double, id_of_underlying string, "
    "qc_of_underlying string, maturity_date date, cqs string, mod_dur_of_underlying double, "
    "calculation_type string, is_direct boolean, value double"
)
POSITION = dict(
    portfolio_group="G1", portfolio_id="S1", analysis_date=D(2001, 12, 31), security_name="SEC",
    country="HU", rating="AA", cic_of_instrument="HU11", asset_allocation="100 General",
    currency="HUF", exp_maturity_date=D(2005, 12, 31), balance_nominal=10.0,
    modified_duration=3.0, dirty_value_pc=100.0,
)
HOLDING = dict(
    portfolio_id="S1", valuation_date=D(2001, 12, 31), portfolio_mod_dur=3.0, scr_delivery="Y",
    cic_of_underlying="DE21", economic_zone=1, id_of_underlying="U1", name_of_underlying="UND",
    qc_of_underlying="EUR", valuation_weight=1.0, maturity_date=D(2005, 12, 31), cqs="2",
    mod_dur_of_underlying=3.0, underlying_asset_category="2",
)
CALC = dict(
    portfolio_group="G1", portfolio_id="S1", analysis_date=D(2001, 12, 31), security_name="SEC",
    country="DE", currency="EUR", cic_of_instrument="DE21", asset_allocation="100 General",
    balance_nominal=10.0, id_of_underlying="U1", qc_of_underlying="EUR",
    maturity_date=D(2005, 12, 31), cqs="2", mod_dur_of_underlying=3.0, calculation_type="2",
    is_direct=False, value=100.0,
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _maker(schema, defaults, order):
    names = [f.split()[0] for f in schema.split(", ")]

    def make(spark, *rows):
        data = [{**defaults, order: i, **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(d[n] for n in names) for d in data], schema)

    return make


positions = _maker(POSITION_SCHEMA, POSITION, "position_ord")
holdings = _maker(HOLDING_SCHEMA, HOLDING, "holding_ord")
calc = _maker(CALC_SCHEMA, CALC, "position_ord")


def rows(df, *columns, order=None):
    """Rows as tuples, sorted unless ``order`` is a column."""
    picked = df.select(*(columns or df.columns))
    out = [tuple(r) for r in picked.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
