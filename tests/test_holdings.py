import pytest
from pyspark.sql import functions as F

from shockwell.operators import holdings as hold
from shockwell.operators.holdings import HoldingRules
from shockwell.operators.skew import SkewPolicy
from tests.conftest import holdings, rows

TINY = SkewPolicy(rows_per_split=2, key_share=1000, null_splits=3)


def types(spark, *given, rules=HoldingRules()):
    df = holdings(spark, *given)
    typed = hold.with_calculation_type(df, rules=rules)
    return [r[1] for r in rows(typed, "holding_ord", "calculation_type")]


def own(spark, *given):
    """Types of holdings that live in funds of their own, two rows per fund to
    keep fund rules quiet."""
    return types(spark, *[{"portfolio_id": f"F{i}", **g} for i, g in enumerate(given)])


def test_type_by_category_cic_and_name(spark):
    got = own(
        spark,
        {"underlying_asset_category": "1", "cic_of_underlying": "DE1"},                 # short, foreign
        {"underlying_asset_category": "1", "cic_of_underlying": "HU11"},
        {"underlying_asset_category": "1", "cic_of_underlying": "DE11", "name_of_underlying": "the hgb 5"},
        {"underlying_asset_category": "1", "cic_of_underlying": None, "name_of_underlying": None},
        {"underlying_asset_category": "0", "cic_of_underlying": "X"},
        {"underlying_asset_category": "L", "cic_of_underlying": "X"},
        {"underlying_asset_category": "3"},
        {"underlying_asset_category": None},
        {"underlying_asset_category": "5", "cic_of_underlying": "DE5"},
        {"underlying_asset_category": "5", "cic_of_underlying": "DE21"},                # mismatch keeps the type
    )
    assert got == ["1X", "1", "1", "1X", "3X", "7", "3", "3X", "3X", "5"]


def test_row_rules(spark):
    got = own(
        spark,
        {"cqs": None},
        {"underlying_asset_category": "5", "cqs": None},
        {"underlying_asset_category": "3L", "economic_zone": None},
        {"underlying_asset_category": "3L"},
        {"maturity_date": None},
        {"underlying_asset_category": "3L", "maturity_date": None},
        {"qc_of_underlying": "XXX"},
        {"qc_of_underlying": None},
        {"underlying_asset_category": "9", "qc_of_underlying": "XXX"},
        {"valuation_date": None},
        {"portfolio_mod_dur": None},
        {"valuation_weight": None},
    )
    assert got == ["3X", "5", "3X", "3L", "3X", "3L", "3X", "3X", "9", "3X", "3X", "3X"]


def test_structured_weight_limit_is_strict(spark):
    a = {"portfolio_id": "A", "underlying_asset_category": "A"}
    at_limit = [{**a, "valuation_weight": 0.12}, {"portfolio_id": "A", "valuation_weight": 0.88}]
    assert types(spark, *at_limit) == ["A", "2"]
    above = [{**a, "valuation_weight": 0.07}, {**a, "valuation_weight": 0.06}, {"portfolio_id": "A"}]
    assert types(spark, *above) == ["3X"] * 3
    assert types(spark, *above, rules=HoldingRules(disabled=frozenset({"structured_weight"}))) == ["A", "A", "2"]


def test_one_undelivered_row_converts_the_fund(spark):
    given = [
        {"scr_delivery": "N", "portfolio_mod_dur": None},
        {"underlying_asset_category": "9"},
        {"portfolio_id": "S2", "scr_delivery": "N", "portfolio_mod_dur": None, "underlying_asset_category": "9"},
    ]
    rules = HoldingRules(disabled=frozenset({"mandatory"}))
    assert types(spark, *given, rules=rules) == ["3X", "3X", "9"]


def test_missing_weight_becomes_zero(spark):
    typed = hold.with_calculation_type(holdings(spark, {"valuation_weight": None}, {}))
    assert rows(typed, "valuation_weight") == [(0.0,), (1.0,)]
    kept = hold.with_calculation_type(
        holdings(spark, {"valuation_weight": None}), rules=HoldingRules(disabled=frozenset({"mandatory"})))
    assert rows(kept, "valuation_weight", "calculation_type") == [(None, "2")]


def report(spark, *given, checks=None, rules=HoldingRules(), policy=SkewPolicy()):
    df = holdings(spark, *given)
    found = hold.holding_findings(df, rules=rules, checks=checks, policy=policy)
    return rows(found, "severity", "error_code", "portfolio_id", "id_of_underlying", "type_from_cic_code")


def test_weight_sum_bounds(spark):
    given = [
        {"portfolio_id": "low", "valuation_weight": 0.999}, {"portfolio_id": "high", "valuation_weight": 1.001},
        {"portfolio_id": "under", "valuation_weight": 0.99}, {"portfolio_id": "none", "valuation_weight": None},
        {"portfolio_id": "pair", "valuation_weight": 0.6}, {"portfolio_id": "pair", "valuation_weight": 0.6, "id_of_underlying": "U2"},
    ]
    got = report(spark, *given, checks=["weight_sum"])
    assert [g[2:4] for g in got] == [("none", "U1"), ("pair", "U1"), ("pair", "U2"), ("under", "U1")]
    assert {g[0] for g in got} == {"critical"}


def test_cic_findings(spark):
    got = report(
        spark,
        {"portfolio_id": "a", "cic_of_underlying": "DE31", "underlying_asset_category": "3X", "economic_zone": None},
        {"portfolio_id": "b", "cic_of_underlying": "DE31", "underlying_asset_category": "3X", "economic_zone": 2},
        {"portfolio_id": "c", "cic_of_underlying": "DE"},
        {"portfolio_id": "d", "underlying_asset_category": None},
        checks=["cic"],
    )
    assert [(g[1], g[2], g[4]) for g in got] == [
        ("CIC_LENGTH", "c", None), ("CIC_MISMATCH", "b", "3L"), ("CIC_MISMATCH", "c", None), ("CIC_MISMATCH", "d", "2")]


def test_missing_values_and_types(spark):
    got = report(
        spark, {"valuation_date": None, "portfolio_mod_dur": None, "valuation_weight": None, "economic_zone": None},
        {"id_of_underlying": "U2", "scr_delivery": None}, checks=["mandatory", "data_types"],
    )
    assert [(g[0], g[1]) for g in got] == [
        ("critical", "MISSING_MANDATORY"), ("validation", "DATA_TYPE"),
        ("validation", "MISSING_MANDATORY"), ("validation", "MISSING_MANDATORY")]


def test_duplicates(spark, monkeypatch):
    given = (
        [{"portfolio_id": "a"}] * 5
        + [{"portfolio_id": "b", "portfolio_mod_dur": None}] * 2
        + [{"portfolio_id": "c", "valuation_weight": None}] * 2
        + [{"portfolio_id": "d"}, {"portfolio_id": "d", "valuation_weight": 0.5}]
        + [{"portfolio_id": "e", "scr_delivery": None}] * 2
    )
    want = [("a", "U1")] * 5 + [("c", "U1")] * 2 + [("e", "U1")] * 2
    assert [g[2:4] for g in report(spark, *given, checks=["duplicates"])] == want
    monkeypatch.setattr(hold, "DUPLICATE_CHUNK", 2)
    assert [g[2:4] for g in report(spark, *given, checks=["duplicates"])] == want


def test_portfolio_duration(spark):
    given = [
        {"portfolio_id": "ok", "valuation_weight": 0.5, "mod_dur_of_underlying": 2.0},
        {"portfolio_id": "ok", "valuation_weight": 0.5, "mod_dur_of_underlying": 4.0},
        {"portfolio_id": "off", "portfolio_mod_dur": None, "id_of_underlying": "U0"},
        {"portfolio_id": "off", "portfolio_mod_dur": 9.0},
        {"portfolio_id": "unstated", "portfolio_mod_dur": None},
        {"portfolio_id": "zero", "portfolio_mod_dur": 0.0, "mod_dur_of_underlying": None},
    ]
    got = report(spark, *given, checks=["portfolio_duration"])
    assert [g[2:4] for g in got] == [("off", "U0"), ("off", "U1")]


def test_reports_split_and_switches(spark):
    df = holdings(spark, {"valuation_weight": None, "cic_of_underlying": "X"})
    validation, critical = hold.split_report(hold.holding_findings(df))
    assert critical.columns == hold.CRITICAL_COLUMNS and validation.columns == hold.REPORT_COLUMNS
    assert {r.error_code for r in critical.collect()} == {"WEIGHT_SUM", "MISSING_MANDATORY"}
    off = HoldingRules(disabled=frozenset({"cic", "mandatory"}))
    found = hold.holding_findings(df, rules=off)
    assert {r.error_code for r in found.collect()} == {"WEIGHT_SUM", "PORTFOLIO_DURATION"}
    with pytest.raises(ValueError):
        HoldingRules(disabled=frozenset({"nonsense"}))


def test_guards(spark):
    df = holdings(spark, {})
    with pytest.raises(ValueError):
        hold.with_row_type(df.drop("scr_delivery"))
    with pytest.raises(ValueError):
        hold.require_rows(df.filter(F.lit(False)), "holdings")


def test_splitting_hot_funds_changes_nothing(spark):
    given = [
        {"portfolio_id": p, "id_of_underlying": f"U{i}", "valuation_weight": 0.3, "cqs": None if i % 3 else "1"}
        for p, n in (("hot", 23), ("warm", 5), ("cold", 1)) for i in range(n)
    ]
    df = holdings(spark, *given)
    plain, split = hold.with_calculation_type(df), hold.with_calculation_type(df, policy=TINY)
    assert rows(plain) == rows(split.select(*plain.columns))
    assert report(spark, *given) == report(spark, *given, policy=TINY)
    hot = hold.hot_funds(hold.fund_facts(df), TINY)
    assert dict(rows(hot)) == {"hot": 12, "warm": 3}
