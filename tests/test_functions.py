import datetime
import math

import pytest
from pyspark.sql import functions as F

from shockwell import CalculationMatrix, Parameters, ReportingPeriod
from shockwell.functions import aggregates, cleaning
from shockwell.functions.dates import quarter_end, years_between
from shockwell.functions.lookups import pick, pick2, translate
from shockwell.operators.interest import clamped_term
from shockwell.operators.spread import duration_bucket, duration_in_bucket, spread_shock, step_label, step_number

D = datetime.date


def column(spark, values, type_, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {type_}")
    return [r[1] for r in df.select("i", expression(F.col("c"))).orderBy("i").collect()]


def test_numbers_with_comma(spark):
    got = column(spark, ["1,5", "1.5", "x", None, "NaN", "1,2,3", " 2 "], "string", cleaning.to_number)
    assert got == [1.5, 1.5, None, None, None, None, 2.0]


def test_whole_numbers(spark):
    got = column(spark, ["1", "2.0", "1.5", "EU", None, "1,0"], "string", cleaning.to_whole_number)
    assert got == [1, 2, None, None, None, None]


def test_dates(spark):
    assert column(spark, ["31.12.2001", "1.2.2001", "31.02.2001", "2001.12.31", None], "string",
                  cleaning.day_first_date) == [D(2001, 12, 31), D(2001, 2, 1), None, None, None]
    assert column(spark, ["2001.12.31", "2001.2.1", "31.12.2001"], "string",
                  cleaning.year_first_date) == [D(2001, 12, 31), D(2001, 2, 1), None]
    assert column(spark, ["37256", "37256.7", "2001.12.31", "soon", None], "string",
                  cleaning.serial_or_date) == [D(2001, 12, 31)] * 3 + [None, None]


def test_plain_dates_are_cast_and_equal_the_parser(spark):
    day_first = ["31.12.2001", "29.02.2000", "29.02.2001", "00.01.2001", "31.04.1999", "01.01.0000", "01.01.0999", "1.02.2001", "01.2.2001",
                 " 01.02.2001", "01.02.2001 ", "01.02.2001\n", "01.02.20011", "01-02-2001", "01.02.2001.", "", "x", None, "28.02.1582", "10.10.1582"]
    year_first = [None if c is None else ".".join(c.split(".")[::-1]) for c in day_first]
    for cells, parse, pattern in ((day_first, cleaning.day_first_date, "d.M.yyyy"), (year_first, cleaning.year_first_date, "yyyy.M.d")):
        want = column(spark, cells, "string", lambda c, p=pattern: F.try_to_date(c, p).cast("string"))
        assert column(spark, cells, "string", lambda c, f=parse: f(c).cast("string")) == want
    table = spark.createDataFrame([("31.12.2001",)], "c string").select(cleaning.day_first_date(F.col("c")))
    assert "cast(" in table._jdf.queryExecution().optimizedPlan().toString()


def test_missing_tokens_and_control_characters(spark):
    assert column(spark, ["", "NA", "nan", "NR", "None", "x"], "string", cleaning.missing_to_null) == [
        None, None, None, "NR", None, "x"]
    assert column(spark, ["a\x01b\x7f", "\t"], "string", cleaning.strip_control) == ["ab", ""]


YEARS = [
    # start, end, whole years, days over
    (D(2001, 12, 31), D(2002, 12, 31), 1, 0),
    (D(2001, 12, 31), D(2002, 6, 30), 0, 181),
    (D(2001, 12, 31), D(2003, 12, 30), 1, 364),
    (D(2001, 1, 1), D(2004, 3, 1), 3, 60),
    (D(2000, 2, 29), D(2001, 2, 28), 1, 0),
    (D(2000, 2, 29), D(2001, 2, 27), 0, 364),
    (D(2000, 2, 29), D(2004, 2, 28), 3, 365),
    (D(2000, 2, 29), D(2004, 2, 29), 4, 0),
    (D(2003, 2, 28), D(2004, 2, 29), 1, 1),
    (D(2001, 1, 1), D(1999, 1, 1), -2, 0),
    (D(2001, 12, 31), D(1999, 1, 1), -3, 1),
]


def test_years_between(spark):
    df = spark.createDataFrame(YEARS, "s date, e date, years int, days int")
    for r in df.select("*", years_between(F.col("s"), F.col("e")).alias("y")).collect():
        assert math.isclose(r.y, r.years + r.days / 365.2425, abs_tol=1e-12), r


def test_years_between_edges(spark):
    df = spark.createDataFrame(
        [(D(2001, 12, 31), D(2001, 12, 31)), (D(2001, 6, 2), D(2003, 6, 1)), (D(2001, 6, 2), None)],
        "s date, e date",
    )
    got = [r[0] for r in df.select(years_between(F.col("s"), F.col("e"))).collect()]
    assert got[0] == 0 and math.isclose(got[1], 1 + 364 / 365.2425) and got[2] is None


def test_quarter_end(spark):
    df = spark.createDataFrame([(2001, 3), (2001, 6), (2001, 5), (2001, 12)], "y int, m int")
    got = [r[0] for r in df.select(quarter_end(F.col("y"), F.col("m"))).collect()]
    assert got == [D(2001, 3, 31), D(2001, 6, 30), None, D(2001, 12, 31)]
    with pytest.raises(ValueError):
        ReportingPeriod(2001, 5)


def test_term_clamp(spark):
    assert column(spark, [0.5, -2.0, 150.5, 10.0, 149.5, None], "double", lambda _: clamped_term("c")) == [
        1.0, 1.0, 150.0, 10.0, 149.5, None]


def test_duration_buckets(spark):
    durations = [0.5, 1.0, 4.999, 5.0, 10.0, 15.0, 20.0, 35.0, None]
    assert column(spark, durations, "double", lambda _: duration_bucket("c")) == [0, 0, 0, 1, 2, 3, 4, 4, 4]
    inside = column(spark, durations, "double", lambda _: duration_in_bucket("c"))
    assert inside[:2] == [1.0, 1.0] and inside[3:] == [0.0, 0.0, 0.0, 0.0, 15.0, None]


def test_step_number(spark):
    got = column(spark, ["0", "6", "7", "NR", "1.5", "-1", None, "A", "3.0"], "string", step_number)
    assert got == [0, 6, 7, 7, None, None, None, None, 3]
    assert column(spark, [0, 6, 7, None], "int", step_label) == ["0", "6", "NR", None]


def test_spread_shock_reads_the_matrices(spark):
    p = Parameters()
    cases = [(2, 3.0, 0.014 * 3), (6, 7.0, 0.225 + 0.025 * 2), (7, 12.0, 0.235 + 0.012 * 2),
             (5, 19.0, 0.610 + 0.005 * 4), (0, 25.0, 0.120 + 0.005 * 5), (5, 300.0, 1.0), (1, None, None)]
    df = spark.createDataFrame([(s, d) for s, d, _ in cases], "s int, d double")
    got = [r[0] for r in df.select(spread_shock(F.col("s"), "d", p)).collect()]
    for have, (_, _, want) in zip(got, cases):
        assert have == want if want is None else math.isclose(have, want)


def test_lookups(spark):
    values = [1.0, 2.0, 3.0]
    assert column(spark, [0, 2, 9, -1, -3, -4, None], "bigint", lambda c: pick(values, c)) == [
        1.0, 3.0, 3.0, 3.0, 1.0, None, None]
    assert column(spark, [0, 1, None], "int", lambda c: pick2([[1.0], [2.0]], c, F.lit(0))) == [1.0, 2.0, None]
    assert column(spark, ["UK", "GB", None], "string",
                  lambda c: translate(c, Parameters().country_currency)) == ["GBP", None, None]


def test_uniform_dominant(spark):
    df = spark.createDataFrame(
        [("a", 2, "x", 5.0), ("a", 1, None, 1.0), ("b", 1, "y", 2.0), ("b", 2, "y", 2.0)],
        "k string, o int, c string, v double",
    )
    got = {r.k: r for r in df.groupBy("k").agg(
        aggregates.uniform("c").alias("uniform"),
        aggregates.total("if(k = 'b', v, NULL)").alias("total"),
    ).collect()}
    assert got["a"].uniform is None and got["a"].total == 0.0
    assert got["b"].uniform == "y" and got["b"].total == 4.0
    sums = spark.createDataFrame(
        [("tie", "b", 3.0), ("tie", "a", 3.0), ("neg", "a", -5.0), ("neg", "b", -1.0), ("nil", None, 9.0), ("nil", "a", 9.0)],
        "k string, c string, v double",
    )
    assert {r.k: r.d for r in sums.groupBy("k").agg(aggregates.dominant("c", "v").alias("d")).collect()} == {
        "tie": "a", "neg": "b", "nil": "a"}


def test_weighted_step(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.1, 2.0), (3.0, 0.0), (4.00001, 2.0)], "x double, w double")
    got = [r[0] for r in df.select(aggregates.weighted_step(F.col("x"), F.col("w"), 1e-5)).collect()]
    assert got == [2, 3, 0, 2]


def test_parameters_and_matrix(spark, tmp_path):
    p = Parameters()
    doc = {
        "equity_risk": {"strategic_shock": 0.1, "T1_base_shock": 0.2, "T2_base_shock": 0.3},
        "currency_risk": {"currency_up_shock": 0.4, "currency_down_shock": 0.5},
        "property_risk": {"property_shock": 0.6},
        "spread_risk_matrices": {k: [[1.0]] for k in (
            "bond_rated_a_i_matrix", "bond_rated_b_i_matrix", "bond_unrated_a_i_matrix", "bond_unrated_b_i_matrix")},
        "concentration_risk": {"excess_exposure_thresholds": [1], "risk_factors": [2],
                               "other_gov_bonds_risk_factors": [3], "tolerance": 0.1},
        "calculation_type_mapping": {"1": 0, "2": 1}, "EEA_COUNTRIES": ["AT"],
        "OECD_NON_EEA_COUNTRIES": ["AU"], "COUNTRY_CURRENCY_MAPPING": {"AT": "EUR", "HU": "HUF"},
    }
    import json

    (tmp_path / "p.json").write_text(json.dumps(doc))
    read = Parameters.read(spark, str(tmp_path / "p.json"))
    assert read.strategic_shock == 0.1 and read.oecd_countries == ["AT", "AU"] and read.thresholds == [1]
    (tmp_path / "m.csv").write_text(
        "Equity Risk,Interest rate risk,Spread Risk,Concentration Risk,Property Risk\nx,,,x,\n,x,,,x\n")
    matrix = CalculationMatrix.read(spark, str(tmp_path / "m.csv"), read)
    assert matrix.types_for("equity") == ["1", "3S"]
    assert matrix.types_for("interest") == ["1X", "2"]
    assert matrix.types_for("currency") == ["1", "1X", "3S", "FX"]
    assert matrix.types_for("property") == ["2"]
    other = CalculationMatrix.read(spark, str(tmp_path / "m.csv"), read, currency_flag_column="Property Risk")
    assert other.types_for("currency") == ["1X", "2", "3S", "FX"]
    prefixes = dict(p.curve_prefixes())
    assert prefixes["EUR"] == "EUR" and prefixes["CHF"] == "LI" and prefixes["GBP"] == "UK"
    assert {(r.module, r.calculation_type) for r in matrix.table(spark).collect()} >= {("equity", "3S")}
