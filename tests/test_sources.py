import csv

import pytest
from pyspark.sql import functions as F

from shockwell import Parameters, ReportingPeriod
from shockwell import fixed_values as fv
from shockwell.functions import cleaning
from shockwell.plans.storage import settled
from shockwell.sources import market, tables
from tests.conftest import D, rows

TPT = list(fv.TPT_HEADERS)


def write_csv(path, header, lines, encoding="ISO-8859-1"):
    path.write_bytes("\n".join([",".join(f'"{h}"' for h in header), *lines]).encode(encoding))
    return str(path)


def tpt_line(**cells):
    row = {"portfolio_id": "F1", "valuation_date": "31.12.2001", "portfolio_mod_dur": '"3,5"', "scr_delivery": "Y",
           "cic_of_underlying": "DE21", "economic_zone": "1", "id_of_underlying": "U1", "name_of_underlying": "Jó név",
           "qc_of_underlying": "EUR", "valuation_weight": '"0,25"', "maturity_date": "1.2.2005", "cqs": "NR",
           "mod_dur_of_underlying": "4.5", "underlying_asset_category": "2", **cells}
    return ",".join(row[fv.TPT_HEADERS[h]] for h in TPT) + ",unused"


def test_tpt_parts_from_csv(spark, tmp_path):
    header = [*TPT, "99_Other"]
    one = write_csv(tmp_path / "a.csv", header, [tpt_line(), tpt_line(portfolio_id="nan"), tpt_line(portfolio_id="F2", cqs="3")])
    short = [h for h in header if h != "39_Maturity_date"]
    broken = tpt_line(portfolio_id="007", portfolio_mod_dur="bad", economic_zone="1.5")
    values = dict(zip(header, next(csv.reader([broken]))))
    two = write_csv(tmp_path / "b.csv", short, [",".join(f'"{values[h]}"' for h in short)])
    raw = tables.read_tpt(spark, [one, two])
    assert raw.count() == 3
    typed, rejects = tables.type_holdings(tables.project_tpt(raw))
    assert typed.columns == [*fv.TPT_HEADERS.values(), "holding_ord"]
    got = [tuple(r) for r in typed.orderBy("holding_ord").select(
        "portfolio_id", "valuation_date", "portfolio_mod_dur", "economic_zone", "name_of_underlying",
        "valuation_weight", "maturity_date", "cqs").collect()]
    assert got == [
        ("F1", D(2001, 12, 31), 3.5, 1, "Jó név", 0.25, D(2005, 2, 1), "NR"),
        ("F2", D(2001, 12, 31), 3.5, 1, "Jó név", 0.25, D(2005, 2, 1), "3"),
        ("007", D(2001, 12, 31), None, None, "Jó név", 0.25, None, "NR"),
    ]
    assert rows(rejects, "reason", "portfolio_id", "raw_value") == [
        ("cannot convert economic_zone", "007", "1.5"), ("cannot convert portfolio_mod_dur", "007", "bad")]


def test_parquet_parts_and_file_order(spark, tmp_path):
    df = spark.range(500).select(*[F.col("id").cast("string").alias(h) for h in TPT])
    df.coalesce(1).write.parquet(str(tmp_path / "p"))
    raw = tables.read_tpt(spark, [str(tmp_path / "p")], format="parquet")
    ids = [r[0] for r in raw.orderBy("holding_ord").select(F.col(f"`{tables.TPT_ID}`")).collect()]
    assert ids == [str(i) for i in range(500)]


def test_position_lists(spark, tmp_path):
    cells = {"portfolio_group": "G", "portfolio_id": "007", "analysis_date": "2001.12.31", "security_name": "x\x01y",
             "country": "DE", "rating": "AA", "cic_of_instrument": "DE11", "asset_allocation": "100", "currency": "EUR",
             "exp_maturity_date": "37256", "balance_nominal": "1e3", "modified_duration": "2,5", "dirty_value_pc": "100.5"}
    for headers, project in ((fv.ASSET_HEADERS, tables.project_asset_list), (fv.UL_HEADERS, tables.project_ul_list)):
        order = list(reversed(headers))
        path = write_csv(tmp_path / f"{project.__name__}.csv", order, [",".join(f'"{cells[headers[h]]}"' for h in order)])
        projected = project(tables.read_raw(spark, path, order="position_ord"))
        assert projected.columns == [*fv.ASSET_HEADERS.values(), "position_ord"]
        typed, rejects = tables.type_positions(projected)
        r = typed.first()
        assert (r.portfolio_id, r.analysis_date, r.exp_maturity_date, r.balance_nominal, r.modified_duration) == (
            "007", D(2001, 12, 31), D(2001, 12, 31), 1000.0, None)
        assert r.security_name == "x\x01y"
        assert tables.type_positions(projected, clean=True)[0].first().security_name == "xy"
        assert rows(rejects, "reason", "raw_value") == [("cannot convert modified_duration", "2,5")]
    with pytest.raises(ValueError):
        tables.project_asset_list(projected)


def test_broken_csv_records_are_set_aside(spark, tmp_path):
    lines = ['F1,"two\nlines",0.5', "F2,one line,0.25", "F3,short", 'F4,"a ""quoted"" word",1']
    path = write_csv(tmp_path / "broken.csv", ["id", "name", "weight"], lines)
    raw = tables.read_raw(spark, path)
    good = tables.good_records(raw)
    assert rows(good, "id", "name", "weight") == [("F2", "one line", "0.25"), ("F4", 'a "quoted" word', "1")]
    assert [r[0] for r in good.orderBy("row_ord").select("id").collect()] == ["F2", "F4"]
    assert rows(tables.corrupt_records(raw, "holdings"), "module", "raw_value") == [
        ("holdings", 'F1,"two'), ("holdings", "F3,short"), ("holdings", 'lines",0.5')]
    whole = tables.read_raw(spark, path, multiline=True)
    assert ("F1", "two\nlines", "0.5") in rows(tables.good_records(whole), "id", "name", "weight")


def test_numbers_have_no_type_suffix(spark):
    cells = ["12d", "1f", "3D", "1F", "0x1", "1e3", " -2.5 ", ".5", "4.", "nan", "inf", "", "1e", None]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    got = [r[0] for r in df.select(cleaning.parse_number(F.col("c"))).collect()]
    assert got == [None] * 5 + [1000.0, -2.5, 0.5, 4.0] + [None] * 5
    assert [r[0] for r in df.select(F.expr(cleaning.number_sql("c"))).collect()] == got
    assert df.select(cleaning.serial_or_date(F.col("c")).alias("d")).filter("c IN ('1f', '12d') AND d IS NOT NULL").count() == 0


def test_fx_sheet_with_units_row(spark):
    sheet = spark.createDataFrame(
        [(None, 1.0, 100.0, None), (D(2001, 12, 31), 2.0, 3.0, 4.0)], "day date, USD double, JPY double, CNY double")
    rates, units = market.fx_sheet(sheet, "day")
    assert rows(units) == [("JPY", 100.0), ("USD", 1.0)]
    asof = market.fx_asof(market.fx_month(rates, ReportingPeriod(2001, 12)), units)
    assert rows(asof) == [("CNY", None), ("JPY", 300.0), ("USD", 2.0)]


def test_clean_text_keeps_ids_that_become_empty(spark):
    df = spark.createDataFrame([("a\x02", "x"), ("", "y"), (None, "z"), ("\x03", "w")], "id string, t string")
    assert rows(tables.clean_text(df)) == [("", "w"), ("a", "x")]


def test_curves_from_sheets(spark):
    wide = spark.createDataFrame([(1, 0.1, 0.2), (2, 0.3, None)], "term int, `EUR_x` double, `HU_x` double")
    long = market.curves_from_sheets(wide, wide, wide, "term")
    assert rows(long.filter("shock = 'up'"), "pos", "curve_code", "term", "rate") == [
        (0, "EUR_x", 1, 0.1), (0, "EUR_x", 2, 0.3), (1, "HU_x", 1, 0.2)]


def curves(spark, data):
    return spark.createDataFrame(
        [(s, pos, code, term, rate) for s in ("base", "up", "down") for pos, code, term, rate in data],
        "shock string, pos int, curve_code string, term int, rate double")


def test_first_curve_of_a_prefix_wins(spark):
    df = curves(spark, [(3, "LI_b", 1, 0.3), (2, "LI_a", 1, 0.2), (2, "LI_a", 2, 0.25), (0, "EUR", 1, 0.1), (1, "CH", 1, 9.0)])
    chosen = market.curve_for_currency(df, Parameters()).filter("shock = 'base'")
    assert rows(chosen, "curve_currency", "curve_code") == [("CHF", "LI_a"), ("EUR", "EUR")]
    table = market.curve_table(df, Parameters()).filter("curve_currency = 'CHF'")
    assert rows(table, "term", "base", "base_next", "up_next") == [(1, 0.2, 0.25, 0.25), (2, 0.25, None, None)]


def test_curve_gap_is_not_bridged(spark):
    df = curves(spark, [(0, "EUR", 1, 0.1), (0, "EUR", 3, 0.3), (0, "EUR", 151, 1.0)])
    assert rows(market.curve_table(df, Parameters()), "term", "base_next") == [(1, None), (3, None)]


def test_fx_month_and_asof(spark):
    wide = spark.createDataFrame(
        [(D(2001, 11, 30), 1.0, 2.0, 3.0), (D(2001, 12, 3), 1.1, 2.1, 3.1), (D(2001, 12, 31), None, 2.2, 1.0)],
        "day date, USD double, JPY double, HUF double")
    long = market.fx_long(wide, "day")
    units = spark.createDataFrame([("USD", 1.0), ("JPY", 100.0), ("HUF", 1.0)], "currency string, unit double")
    month = market.fx_month(long, ReportingPeriod(2001, 12))
    assert sorted({r.rate_day for r in month.collect()}) == ["2001.12.03", "2001.12.31"]
    assert rows(market.fx_asof(month, units)) == [("JPY", 220.00000000000003)]
    empty = market.fx_month(long, ReportingPeriod(2002, 3))
    with pytest.raises(Exception, match="no exchange rates"):
        market.fx_asof(empty, units).collect()


def test_symmetric_adjustment(spark):
    table = spark.createDataFrame([(D(2001, 9, 30), -0.02), (D(2001, 12, 31), 0.0146)], "period_end date, value double")
    for day, want in ((D(2001, 12, 31), 0.0146), (D(2001, 12, 30), -0.02), (D(2001, 1, 1), None)):
        assert market.symmetric_adjustment(table, F.lit(day)).first()[0] == want


def test_text_without_control_characters_is_not_rewritten(spark):
    stored = settled(spark.createDataFrame([("a", "b\x01", 1), ("c", None, 2), ("d", "e", 3), ("", "x", 4), (None, "x", 5)], "p string, q string, n int"))
    cleaned = tables.clean_text(stored)
    assert [tuple(r) for r in cleaned.orderBy("n").collect()] == [("a", "b", 1), ("c", None, 2), ("d", "e", 3)]
    assert "CASE WHEN _control" in cleaned._jdf.queryExecution().optimizedPlan().toString()
