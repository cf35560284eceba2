"""Queries on holding checks, look-through, classification and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (
    ORDER_SQL, calc_frame, direct_rows, flagged, fund_facts, order_columns, r, rs,
)
from fixtures import sql, views
from shockwell import fixed_values as fv
from shockwell.operators import holdings as hold
from shockwell.operators import positions as pos


def tpt_calc_type(spark, sf_dir):
    typed = hold.with_calculation_type(views.holdings(spark, sf_dir), fund_facts(spark, sf_dir))
    return typed.select(
        *order_columns(), "portfolio_id", "underlying_asset_category", "calculation_type",
        r("valuation_weight", 8),
    )


def _all_findings(spark, sf_dir, facts=None):
    return hold.holding_findings(views.holdings(spark, sf_dir), facts or fund_facts(spark, sf_dir))


def _findings(checks, code=None, by_fund=False):
    """Report rows of some checks."""

    def query(spark, sf_dir):
        facts = fund_facts(spark, sf_dir) if by_fund else None
        found = hold.holding_findings(views.holdings(spark, sf_dir), facts, checks=checks)
        if code is not None:
            found = found.filter(F.col("error_code") == code)
        return found.select(
            "severity", "error_code", "Error", "portfolio_id", "id_of_underlying",
            "cic_code", "type_from_cic_code", "original_type",
        )

    return query


def tpt_validation_report(spark, sf_dir):
    validation, _ = hold.split_report(_all_findings(spark, sf_dir))
    return validation


def tpt_critical_report(spark, sf_dir):
    _, critical = hold.split_report(_all_findings(spark, sf_dir))
    return critical


def lookthrough_join(spark, sf_dir):
    return calc_frame(spark, sf_dir, "asset").select(
        "position_ord", "portfolio_id", *order_columns(), "id_of_underlying", "calculation_type", "is_direct"
    )


def unmatched_positions(spark, sf_dir):
    return pos.unmatched_positions(flagged(spark, sf_dir)).select(
        "position_ord", "portfolio_id", "security_name"
    )


def direct_fill(spark, sf_dir):
    return direct_rows(spark, sf_dir, "asset").select(
        "position_ord", "portfolio_id", "qc_of_underlying", "maturity_date", "valuation_date",
        "mod_dur_of_underlying", "cqs",
    )


def rating_to_cqs(spark, sf_dir):
    return views.positions(spark, sf_dir).select(
        "position_ord", "rating", pos.rating_to_step(F.col("rating")).alias("cqs")
    )


def _classify(kind):
    def query(spark, sf_dir):
        return views.positions(spark, sf_dir).select(
            "position_ord", "cic_of_instrument", "asset_allocation",
            pos.classify(kind).alias("calculation_type"),
        )

    return query


def position_value(spark, sf_dir):
    return calc_frame(spark, sf_dir, "asset").select(
        "position_ord", *order_columns(), r("valuation_weight", 8), r("value")
    )


def _reconciliation(kind):
    def query(spark, sf_dir):
        totals = pos.value_totals(flagged(spark, sf_dir, kind))
        return totals.select(
            r("total_dirty_value_pc", 1), r("total_value", 1), pos.totals_differ().alias("differs")
        )

    return query


def direct_irr_missing(spark, sf_dir):
    return direct_rows(spark, sf_dir, "asset").filter("missing_irr").select(
        "position_ord", "portfolio_id", "classified_type", "calculation_type"
    )


def position_mandatory_missing(spark, sf_dir):
    return _position_findings(spark, sf_dir, "asset").filter("error_code = 'MISSING_MANDATORY'").select(
        "error_code", "Error", "portfolio_id"
    )


def _position_findings(spark, sf_dir, kind, rules=pos.PositionRules(), facts=None):
    facts = facts or fund_facts(spark, sf_dir)
    return pos.position_findings(
        flagged(spark, sf_dir, kind, facts),
        direct_rows(spark, sf_dir, kind, rules, facts),
        rules,
    )


def _position_report(kind):
    def query(spark, sf_dir):
        return _position_findings(spark, sf_dir, kind).select(
            "severity", "error_code", "Error", "portfolio_id",
            r("total_dirty_value_pc", 1), r("total_value", 1),
        )

    return query


def strict_missing_rating(spark, sf_dir):
    rules = pos.PositionRules(strict_missing_rating=True)
    return direct_rows(spark, sf_dir, "asset", rules).select(
        "position_ord", "classified_type", "calculation_type", "missing_rating", "missing_irr"
    )


def validation_report(spark, sf_dir):
    """All findings of holdings and both lists, counted by kind."""
    facts = fund_facts(spark, sf_dir)
    shown = ["severity", "error_code"]
    counted = _all_findings(spark, sf_dir, facts).select(F.lit("holdings").alias("list"), *shown)
    for kind in ("asset", "ul"):
        found = _position_findings(spark, sf_dir, kind, facts=facts)
        counted = counted.unionByName(found.select(F.lit(kind).alias("list"), *shown))
    return counted.groupBy("list", *shown).agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    "tpt_calc_type": tpt_calc_type,
    "tpt_cic_length_errors": _findings(["cic"], "CIC_LENGTH"),
    "tpt_cic_mismatch": _findings(["cic"], "CIC_MISMATCH"),
    "tpt_weight_sum_critical": _findings(["weight_sum"], by_fund=True),
    "tpt_mandatory_missing": _findings(["mandatory"]),
    "tpt_duplicates": _findings(["duplicates"]),
    "tpt_type_report": _findings(["data_types"]),
    "tpt_mod_dur_mismatch": _findings(["portfolio_duration"], by_fund=True),
    "tpt_validation_report": tpt_validation_report,
    "tpt_critical_report": tpt_critical_report,
    "lookthrough_join": lookthrough_join,
    "unmatched_positions": unmatched_positions,
    "direct_fill": direct_fill,
    "rating_to_cqs": rating_to_cqs,
    "position_mandatory_missing": position_mandatory_missing,
    "classify_asset": _classify("asset"),
    "classify_ul": _classify("ul"),
    "position_value": position_value,
    "value_reconciliation": _reconciliation("asset"),
    "ul_value_reconciliation": _reconciliation("ul"),
    "direct_irr_missing": direct_irr_missing,
    "strict_missing_rating": strict_missing_rating,
    "position_validation_report": _position_report("asset"),
    "ul_validation_report": _position_report("ul"),
    "validation_report": validation_report,
}

_HELD = (sql.HOLDINGS, sql.TYPED)
_NOTHING = "NULL::VARCHAR AS cic_code, NULL::VARCHAR AS type_from_cic_code, NULL::VARCHAR AS original_type"
_THIRD = """CASE substr(cic_of_underlying, 3, 1) WHEN '' THEN NULL
    WHEN '3' THEN CASE WHEN economic_zone IN (1, 2) THEN '3L' ELSE '3X' END
    ELSE substr(cic_of_underlying, 3, 1) END"""


def _row(severity, code, text, extra=_NOTHING):
    return (f"SELECT '{severity}' AS severity, '{code}' AS error_code, '{text}' AS \"Error\", "
            f"portfolio_id, id_of_underlying, {extra} ")


_FOUND = {
    "cic_length": _row("validation", "CIC_LENGTH", "CIC code length is not 4",
        "cic_of_underlying AS cic_code, NULL::VARCHAR AS type_from_cic_code, underlying_asset_category AS original_type")
        + "FROM holdings WHERE length(cic_of_underlying) <> 4",
    "cic_mismatch": _row("validation", "CIC_MISMATCH", "CIC code and underlying asset type mismatch",
        f"cic_of_underlying AS cic_code, {_THIRD} AS type_from_cic_code, underlying_asset_category AS original_type")
        + f"FROM holdings WHERE ({_THIRD}) IS DISTINCT FROM underlying_asset_category",
    "weight_sum": _row("critical", "WEIGHT_SUM", "Valuation weight sum of the fund is not between 0.999 and 1.001")
        + "FROM typed WHERE weight_sum < 0.999 OR weight_sum > 1.001",
    "mandatory": " UNION ALL ".join(
        _row("critical" if c == "valuation_weight" else "validation", "MISSING_MANDATORY",
             f"Missing value in mandatory column: {c}") + f"FROM holdings WHERE {c} IS NULL"
        for c in ("valuation_date", "valuation_weight", "portfolio_mod_dur")),
    "data_types": _row("validation", "DATA_TYPE", "Column economic_zone is not of type int")
        + "FROM holdings WHERE economic_zone IS NULL",
    "duration": _row("validation", "PORTFOLIO_DURATION",
        "Weighted duration of the holdings differs from the fund''s duration")
        + """FROM (SELECT *, bool_or(abs(portfolio_mod_dur - weighted_duration) > 1e-9)
             OVER (PARTITION BY portfolio_id) AS off FROM typed) WHERE off""",
    "duplicates": _row("validation", "DUPLICATE", "Duplicate rows found") + """FROM (
        SELECT *, count(*) OVER (PARTITION BY portfolio_id, valuation_date, scr_delivery, cic_of_underlying,
          id_of_underlying, qc_of_underlying, valuation_weight, portfolio_mod_dur, underlying_asset_category) AS n
        FROM typed WHERE portfolio_mod_dur IS NOT NULL AND valuation_date IS NOT NULL) WHERE n > 1""",
}
_ALL_FOUND = " UNION ALL ".join(_FOUND.values())


def _report(name):
    return sql.with_(*_HELD) + _FOUND[name]


def _position_report_sql(kind):
    return sql.with_(sql.POSITIONS, *_HELD, sql.calc(kind)) + f""", totals AS (
      SELECT (SELECT sum(dirty_value_pc) FROM all_positions WHERE kind = '{kind}') AS total_dirty_value_pc,
        (SELECT sum(value) FROM calc) AS total_value)
    {" UNION ALL ".join(f"""SELECT 'critical' AS severity, 'MISSING_MANDATORY' AS error_code,
      'Missing value in mandatory column: {c}' AS "Error", portfolio_id,
      NULL::DOUBLE AS total_dirty_value_pc, NULL::DOUBLE AS total_value
    FROM all_positions WHERE kind = '{kind}' AND {c} IS NULL""" for c in fv.POSITION_MANDATORY)}
    UNION ALL SELECT 'validation', 'MISSING_IRR_INPUT',
      'Missing duration, maturity or analysis date for a rate-sensitive type', portfolio_id, NULL, NULL
    FROM direct WHERE missing_irr
    UNION ALL SELECT 'critical', 'CONTROL_TOTAL', 'Total value is not within 1000000 of the control total', NULL,
      {rs('total_dirty_value_pc', 'a', 1)}, {rs('total_value', 'b', 1)}
    FROM totals WHERE abs(total_value - total_dirty_value_pc) > 1000000"""


def _reconcile(kind):
    return sql.with_(sql.POSITIONS, *_HELD, sql.calc(kind)) + f"""
    SELECT {rs('d', 'total_dirty_value_pc', 1)}, {rs('v', 'total_value', 1)}, abs(v - d) > 1000000 AS differs FROM
      (SELECT (SELECT sum(dirty_value_pc) FROM all_positions WHERE kind = '{kind}') AS d, sum(value) AS v FROM calc)"""


_ASSET = (sql.POSITIONS, *_HELD, sql.calc("asset"))

ORACLES = {
    "tpt_calc_type": sql.with_(*_HELD) + f"""SELECT {ORDER_SQL}, portfolio_id, underlying_asset_category,
        calculation_type, {rs('valuation_weight', digits=8)} FROM typed""",
    "tpt_cic_length_errors": _report("cic_length"),
    "tpt_cic_mismatch": _report("cic_mismatch"),
    "tpt_weight_sum_critical": _report("weight_sum"),
    "tpt_mandatory_missing": _report("mandatory"),
    "tpt_duplicates": _report("duplicates"),
    "tpt_type_report": _report("data_types"),
    "tpt_mod_dur_mismatch": _report("duration"),
    "tpt_validation_report": sql.with_(*_HELD) + f"""SELECT error_code, "Error", portfolio_id, id_of_underlying,
        cic_code, type_from_cic_code, original_type FROM ({_ALL_FOUND}) WHERE severity = 'validation'""",
    "tpt_critical_report": sql.with_(*_HELD) + f"""SELECT error_code, "Error", portfolio_id, id_of_underlying
        FROM ({_ALL_FOUND}) WHERE severity = 'critical'""",
    "lookthrough_join": sql.with_(*_ASSET) + f"""SELECT position_ord, portfolio_id, {ORDER_SQL},
        id_of_underlying, calculation_type, is_direct FROM calc""",
    "unmatched_positions": sql.with_(sql.POSITIONS, sql.HOLDINGS) + """SELECT position_ord, portfolio_id, security_name
        FROM all_positions WHERE portfolio_id NOT IN (SELECT portfolio_id FROM holdings)""",
    "direct_fill": sql.with_(*_ASSET) + """SELECT position_ord, portfolio_id, qc_of_underlying, maturity_date,
        valuation_date, mod_dur_of_underlying, cqs FROM calc WHERE is_direct""",
    "rating_to_cqs": sql.with_(sql.POSITIONS) + f"SELECT position_ord, rating, {sql.STEP} AS cqs FROM all_positions",
    "position_mandatory_missing": sql.with_(sql.POSITIONS) + " UNION ALL ".join(
        f"""SELECT 'MISSING_MANDATORY' AS error_code, 'Missing value in mandatory column: {c}' AS "Error", portfolio_id
        FROM all_positions WHERE kind = 'asset' AND {c} IS NULL""" for c in fv.POSITION_MANDATORY),
    **{f"classify_{k}": sql.with_(sql.POSITIONS) + f"""SELECT position_ord, cic_of_instrument, asset_allocation,
        {sql.classify(k)} AS calculation_type FROM all_positions""" for k in ("asset", "ul")},
    "position_value": sql.with_(*_ASSET) + f"""SELECT position_ord, {ORDER_SQL},
        {rs('valuation_weight', digits=8)}, {rs('value')} FROM calc""",
    "value_reconciliation": _reconcile("asset"),
    "ul_value_reconciliation": _reconcile("ul"),
    "direct_irr_missing": sql.with_(*_ASSET) + """SELECT position_ord, portfolio_id, classified_type,
        '3X' AS calculation_type FROM direct WHERE missing_irr""",
    "strict_missing_rating": sql.with_(sql.POSITIONS, *_HELD, sql.direct("asset")) + """
        SELECT position_ord, classified_type, missing_rating, missing_irr AND NOT missing_rating AS missing_irr,
          CASE WHEN missing_rating OR missing_irr THEN '3X' ELSE classified_type END AS calculation_type
        FROM (SELECT *, classified_type IN ('1','2','8') AND rating IS NULL AS missing_rating FROM direct)""",
    "position_validation_report": _position_report_sql("asset"),
    "ul_validation_report": _position_report_sql("ul"),
    "validation_report": f"""SELECT list, severity, error_code, count(*) AS n_rows FROM (
        SELECT 'holdings' AS list, severity, error_code FROM ({sql.with_(*_HELD)} {_ALL_FOUND})
        UNION ALL SELECT 'asset', severity, error_code FROM ({_position_report_sql('asset')})
        UNION ALL SELECT 'ul', severity, error_code FROM ({_position_report_sql('ul')})) GROUP BY ALL""",
}
