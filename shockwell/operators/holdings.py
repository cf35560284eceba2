"""Fund look-through holdings: checks, calculation type, report.

Rules fall in two groups.  Row rules need one holding only and are plain
expressions.  Fund rules need sums over a fund; they come from one aggregation
(`fund_facts`) with a single row per fund, which is joined back to the
holdings.  No window is used: a window would bring a whole fund into one task.

Functions that take ``facts`` read it more than once; pass a stored table
(`shockwell.plans.storage.settled`) to have the holdings aggregated only once.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shockwell import fixed_values as fv
from shockwell.functions.aggregates import exact_total
from shockwell.functions.cleaning import is_in, matches, starts_with
from shockwell.functions.lookups import sql_text
from shockwell.operators.skew import SkewPolicy, hot_keys, split_join

VALIDATION = "validation"
CRITICAL = "critical"

REPORT_COLUMNS = [
    "error_code", "Error", "portfolio_id", "id_of_underlying",
    "cic_code", "type_from_cic_code", "original_type",
]
CRITICAL_COLUMNS = ["error_code", "Error", "portfolio_id", "id_of_underlying"]

# Funds with findings that are broadcast; more are joined by shuffle.
MOST_BROADCAST_FUNDS = 200_000

# Rows that one task emits for a single group of duplicates.
DUPLICATE_CHUNK = 100_000


@dataclass(frozen=True)
class HoldingRules:
    """Switches and lists of the holding checks; ``mandatory`` columns must be
    there and filled, ``specific`` ones must be there.

    A check named in ``disabled`` neither reports nor changes a type; only the
    type a holding has by category, CIC and name is always assigned.
    """

    rate_types: tuple = tuple(fv.RATE_SENSITIVE_TYPES)
    mandatory: tuple = tuple(fv.HOLDING_MANDATORY)
    specific: tuple = tuple(fv.HOLDING_SPECIFIC)
    duration_tolerance: float = 1e-9
    disabled: frozenset = field(default_factory=frozenset)

    CHECKS = (
        "cic", "weight_sum", "structured_weight", "cqs", "economic_zone", "scr_delivery",
        "mandatory", "duplicates", "data_types", "portfolio_duration", "maturity", "currency",
    )

    def __post_init__(self):
        unknown = set(self.disabled) - set(self.CHECKS)
        if unknown:
            raise ValueError(f"unknown checks: {sorted(unknown)}")

    def on(self, check: str) -> bool:
        return check not in self.disabled


def require_columns(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    return df


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


# ---------------------------------------------------------------- row rules

WRONG_CIC_LENGTH = "coalesce(length(cic_of_underlying) <> 4, true)"

# Category the third CIC character stands for; equity splits by zone.
CATEGORY_FROM_CIC = """CASE substring(cic_of_underlying, 3, 1) WHEN '' THEN NULL
    WHEN '3' THEN if(coalesce(economic_zone IN (1, 2), false), '3L', '3X')
    ELSE substring(cic_of_underlying, 3, 1) END"""

CIC_MISMATCH = f"coalesce(({CATEGORY_FROM_CIC}) <> underlying_asset_category, true)"


def sovereign_like(cic: str, name: str) -> str:
    """Condition: a government bond by its CIC country or a word in its name."""
    by_cic = starts_with(cic, fv.SOVEREIGN_CIC_PREFIX)
    return f"({by_cic} OR {matches(name, fv.SOVEREIGN_NAME_PATTERN)})"


def category_in(values) -> str:
    return is_in("underlying_asset_category", values)


def missing_mandatory(df: DataFrame, rules: HoldingRules) -> list[str]:
    """Mandatory columns that can be missing: the dates and numbers.  Text is
    never counted as missing; a holding without text fails other rules."""
    types = dict(df.dtypes)
    return [c for c in rules.mandatory if types[c] != "string"]


def own_type() -> Column:
    """Calculation type by category, CIC and name alone."""
    return F.expr(f"""CASE
        WHEN underlying_asset_category = '1'
          AND NOT {sovereign_like('cic_of_underlying', 'name_of_underlying')} THEN '1X'
        WHEN underlying_asset_category = '0' THEN '3X'
        WHEN underlying_asset_category = 'L' THEN '7'
        WHEN NOT {category_in(fv.VALID_CATEGORIES)} OR {WRONG_CIC_LENGTH} THEN '3X'
        ELSE underlying_asset_category END""")


def row_overrides(df: DataFrame, rules: HoldingRules) -> Column:
    """True when a rule on the holding itself turns it into other equity."""
    rate = category_in(rules.rate_types)
    conditions = {
        "cqs": f"{category_in(fv.RATED_CATEGORIES)} AND cqs IS NULL",
        "economic_zone": f"{category_in(fv.EQUITY_CATEGORIES)} AND economic_zone IS NULL",
        "maturity": f"{rate} AND maturity_date IS NULL",
        "currency": f"{rate} AND NOT {is_in('qc_of_underlying', fv.CURVE_CURRENCIES)}",
        "mandatory": " OR ".join(f"{c} IS NULL" for c in missing_mandatory(df, rules)) or "false",
    }
    active = [f"({condition})" for check, condition in conditions.items() if rules.on(check)]
    return F.expr(" OR ".join(active) or "false")


def weight_after_fill(rules: HoldingRules) -> str:
    return "coalesce(valuation_weight, 0.0D)" if rules.on("mandatory") else "valuation_weight"


def with_row_type(holdings: DataFrame, rules: HoldingRules = HoldingRules()) -> DataFrame:
    """Add ``row_type`` (every rule but the fund rules) and fill the weight."""
    require_columns(holdings, (*rules.mandatory, *rules.specific))
    typed = F.when(row_overrides(holdings, rules), "3X").otherwise(own_type())
    return holdings.withColumn("row_type", typed).withColumn(
        "valuation_weight", F.expr(weight_after_fill(rules))
    )


# --------------------------------------------------------------- fund rules

def fund_facts(holdings: DataFrame, rules: HoldingRules = HoldingRules()) -> DataFrame:
    """One row per fund: size, sums, and the verdict of each fund rule.

    ``applied_weight`` is the sum of the weights that positions are valued with.
    All buffers are numbers, so this is a hash aggregation with map-side
    partial results: a fund of any size shuffles one row per task.  Sums are
    exact, so a verdict at a limit does not depend on how the rows are dealt.
    """
    undelivered = f"""coalesce(scr_delivery = 'N' AND portfolio_mod_dur IS NULL
        AND {category_in(rules.rate_types)}, false)"""
    structured = category_in(fv.STRUCTURED_CATEGORIES)
    sums = holdings.groupBy("portfolio_id").agg(
        F.expr("count(1) AS n_rows"),
        F.expr(f"{exact_total('valuation_weight')} AS weight_sum"),
        F.expr(f"{exact_total(f'coalesce({weight_after_fill(rules)}, 1.0D)')} AS applied_weight"),
        F.expr(f"{exact_total(f'if({structured}, valuation_weight, NULL)')} AS structured_sum"),
        F.expr(f"max({undelivered}) AS undelivered"),
        F.expr(f"{exact_total(f'{weight_after_fill(rules)} * mod_dur_of_underlying')} AS weighted_duration"),
        F.expr("min(portfolio_mod_dur) AS stated_low"),
        F.expr("max(portfolio_mod_dur) AS stated_high"),
    )
    too_structured = f"structured_sum > {fv.STRUCTURED_WEIGHT_LIMIT}D" if rules.on("structured_weight") else "false"
    undelivered = "undelivered" if rules.on("scr_delivery") else "false"
    return sums.selectExpr(
        "portfolio_id",
        "n_rows",
        "weight_sum",
        "applied_weight",
        "weighted_duration",
        f"({too_structured} OR {undelivered}) AS fund_is_other_equity",
        f"(weight_sum < {fv.WEIGHT_SUM_LOW}D OR weight_sum > {fv.WEIGHT_SUM_HIGH}D) AS weight_sum_outside",
        f"""coalesce(greatest(abs(stated_low - weighted_duration), abs(stated_high - weighted_duration))
            > {rules.duration_tolerance!r}D, false) AS duration_differs""",
    )


def hot_funds(facts: DataFrame, policy: SkewPolicy) -> DataFrame:
    return hot_keys(facts, "portfolio_id", policy)


def with_fund_facts(
    holdings: DataFrame, facts: DataFrame, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Put the facts of its fund on every holding."""
    return split_join(
        holdings, facts.drop("n_rows"), "portfolio_id", "inner",
        "holding_ord", hot_funds(facts, policy), policy,
    )


def final_type() -> Column:
    return F.expr("if(fund_is_other_equity, '3X', row_type)")


def with_calculation_type(
    holdings: DataFrame,
    facts: DataFrame | None = None,
    rules: HoldingRules = HoldingRules(),
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Holdings with weight filled and ``calculation_type`` set by all rules."""
    facts = fund_facts(holdings, rules) if facts is None else facts
    rows = with_fund_facts(
        with_row_type(holdings, rules), facts.select("portfolio_id", "n_rows", "fund_is_other_equity"), policy
    )
    return rows.withColumn("calculation_type", final_type()).drop("row_type", "fund_is_other_equity")


# ------------------------------------------------------------------ reports

class Finding(NamedTuple):
    """One possible report row: condition and struct as SQL."""

    when: str
    severity: str
    row: str


def _finding(when: str, severity: str, code: str, text: str) -> Finding:
    with_cic = code.startswith("CIC")
    nothing = "cast(NULL AS STRING)"
    return Finding(when, severity, f"""named_struct('found', {when}, 'severity', {sql_text(severity)},
        'error_code', {sql_text(code)}, 'Error', {sql_text(text)},
        'cic_code', {"cic_of_underlying" if with_cic else nothing},
        'type_from_cic_code', {CATEGORY_FROM_CIC if code == "CIC_MISMATCH" else nothing},
        'original_type', {"underlying_asset_category" if with_cic else nothing})""")


def row_findings(df: DataFrame, rules: HoldingRules) -> dict[str, list[Finding]]:
    """Possible report rows of each check that looks at one holding."""
    found = {
        "cic": [
            _finding(WRONG_CIC_LENGTH, VALIDATION, "CIC_LENGTH", "CIC code length is not 4"),
            _finding(CIC_MISMATCH, VALIDATION, "CIC_MISMATCH",
                     "CIC code and underlying asset type mismatch"),
        ],
        "mandatory": [
            _finding(
                f"{c} IS NULL",
                CRITICAL if c == "valuation_weight" else VALIDATION,
                "MISSING_MANDATORY",
                f"Missing value in mandatory column: {c}",
            )
            for c in missing_mandatory(df, rules)
        ],
        "data_types": [
            _finding("economic_zone IS NULL", VALIDATION, "DATA_TYPE",
                     "Column economic_zone is not of type int"),
        ],
    }
    return {check: rows for check, rows in found.items() if rules.on(check)}


def fund_findings(rules: HoldingRules) -> dict[str, list[Finding]]:
    """Possible report rows of each check that looks at a fund."""
    found = {
        "weight_sum": [
            _finding("weight_sum_outside", CRITICAL, "WEIGHT_SUM",
                     "Valuation weight sum of the fund is not between 0.999 and 1.001"),
        ],
        "portfolio_duration": [
            _finding("duration_differs", VALIDATION, "PORTFOLIO_DURATION",
                     "Weighted duration of the holdings differs from the fund's duration"),
        ],
    }
    return {check: rows for check, rows in found.items() if rules.on(check)}


def duplicate_findings(holdings: DataFrame, rules: HoldingRules = HoldingRules()) -> DataFrame:
    """One report row per holding that equals another one in every mandatory
    column, all of them filled.

    The key holds everything a report row shows, so the rows are written from
    the group counts; group members never meet in one task.  A large group is
    cut into chunks that are dealt out to tasks before they are unrolled.
    """
    filled = [f"{c} IS NOT NULL" for c in missing_mandatory(holdings, rules)]
    keyed = holdings.withColumn("valuation_weight", F.expr(weight_after_fill(rules))).filter(
        " AND ".join(filled) or "true"
    )
    groups = keyed.groupBy(*rules.mandatory).agg(F.expr("count(1) AS n")).filter("n > 1")
    chunks = groups.selectExpr(
        "portfolio_id", "id_of_underlying", "n",
        f"explode(sequence(0L, (n - 1) div {DUPLICATE_CHUNK})) AS chunk",
    ).repartition(F.expr("xxhash64(portfolio_id, id_of_underlying, chunk)"))
    size = f"least({DUPLICATE_CHUNK}L, n - chunk * {DUPLICATE_CHUNK})"
    return chunks.selectExpr("*", f"explode(sequence(1L, {size})) AS copy").selectExpr(
        f"'{VALIDATION}' AS severity",
        "'DUPLICATE' AS error_code",
        "'Duplicate rows found' AS Error",
        "portfolio_id",
        "id_of_underlying",
        "cast(NULL AS STRING) AS cic_code",
        "cast(NULL AS STRING) AS type_from_cic_code",
        "cast(NULL AS STRING) AS original_type",
    )


def with_flagged_facts(holdings: DataFrame, facts: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Holdings of funds whose weights or duration have a finding, with the fund's verdicts."""
    flagged = facts.filter("weight_sum_outside OR duration_differs")
    verdicts = flagged.select("portfolio_id", "weight_sum_outside", "duration_differs")
    if verdicts.limit(MOST_BROADCAST_FUNDS + 1).count() <= MOST_BROADCAST_FUNDS:
        return holdings.join(F.broadcast(verdicts), "portfolio_id")
    return split_join(holdings, verdicts, "portfolio_id", "inner", "holding_ord", hot_funds(flagged, policy), policy)


def _unrolled(rows: DataFrame, findings: list[Finding]) -> DataFrame:
    found = f"inline(filter(array({', '.join(f.row for f in findings)}), x -> x.found))"
    # Rows are laid out only if they have a finding.
    return rows.filter(" OR ".join(f"({f.when})" for f in findings)).selectExpr("portfolio_id", "id_of_underlying", found).select(
        "severity", "error_code", "Error", "portfolio_id", "id_of_underlying", "cic_code", "type_from_cic_code", "original_type")


def holding_findings(
    holdings: DataFrame,
    facts: DataFrame | None = None,
    rules: HoldingRules = HoldingRules(),
    policy: SkewPolicy = SkewPolicy(),
    checks: list[str] | None = None,
    severity: str | None = None,
) -> DataFrame:
    """Report rows of the chosen checks (default all), with their severity, or those of one ``severity``.

    Checks that look at a holding need no join: each holding carries its
    possible findings and unrolls those that apply.  Checks that look at a fund
    join the funds that have a finding only; if they are few, which is checked,
    they are broadcast and the holdings stay where they are.
    """
    chosen = HoldingRules.CHECKS if checks is None else checks
    by_row, by_fund = ([f for c, fs in found.items() if c in chosen for f in fs if severity in (None, f.severity)]
                       for found in (row_findings(holdings, rules), fund_findings(rules)))
    parts = []
    if by_row:
        parts.append(_unrolled(holdings, by_row))
    if by_fund:
        facts = fund_facts(holdings, rules) if facts is None else facts
        parts.append(_unrolled(with_flagged_facts(holdings, facts, policy), by_fund))
    if "duplicates" in chosen and rules.on("duplicates") and severity in (None, VALIDATION):
        parts.append(duplicate_findings(holdings, rules))
    if not parts and severity is not None:  # no check of that severity is on
        return holding_findings(holdings, facts, rules, policy, checks).filter(F.col("severity") == severity)
    if not parts:
        raise ValueError(f"no check in {chosen} writes report rows, or all are disabled")
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def split_report(findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(validation report, critical report)`` in their column order."""
    return (
        findings.filter(F.col("severity") == VALIDATION).select(*REPORT_COLUMNS),
        findings.filter(F.col("severity") == CRITICAL).select(*CRITICAL_COLUMNS),
    )
