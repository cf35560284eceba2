"""The insurer's own positions: classification, look-through, value, report.

A position whose security is a fund with holdings is replaced by them
(look-through); any other position is direct and classified by itself.

The calc frame has one row per position and holding.  For the stress modules
the positions of one security are folded before the join: a holding's stress
is proportional to the position's value, and all positions of a security meet
the same holdings, so their values may be added first.  The join then yields
holdings x portfolio groups instead of holdings x positions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shockwell import fixed_values as fv
from shockwell.functions.cleaning import is_in, starts_with
from shockwell.functions.lookups import sql_text, translate
from shockwell.operators.holdings import (
    CRITICAL, VALIDATION, HoldingRules, final_type, fund_facts, hot_funds, require_columns, sovereign_like, with_row_type,
)
from shockwell.operators.skew import (
    SALT, SkewPolicy, hot_keys, hot_products, per_salt, product_join, row_counts, split_join, with_salt,
)

ASSET = "asset"
UL = "ul"

POSITION_COLUMNS = list(fv.ASSET_HEADERS.values()) + ["position_ord"]
HOLDING_COLUMNS = [
    "valuation_date", "portfolio_mod_dur", "scr_delivery", "cic_of_underlying", "economic_zone",
    "id_of_underlying", "name_of_underlying", "qc_of_underlying", "valuation_weight",
    "maturity_date", "cqs", "mod_dur_of_underlying", "underlying_asset_category", "holding_ord",
]
CALC_COLUMNS = POSITION_COLUMNS + HOLDING_COLUMNS + ["calculation_type", "is_direct", "value"]

# What the stress modules read.
MODULE_COLUMNS = [
    "portfolio_group", "portfolio_id", "position_ord", "analysis_date", "security_name",
    "country", "currency", "cic_of_instrument", "asset_allocation", "balance_nominal",
    "id_of_underlying", "qc_of_underlying", "maturity_date", "cqs", "mod_dur_of_underlying",
    "calculation_type", "is_direct", "value",
]


@dataclass(frozen=True)
class PositionRules:
    """Switches and lists of the position checks; ``mandatory``: columns that
    must be filled."""

    mandatory: tuple = tuple(fv.POSITION_MANDATORY)
    rate_types: tuple = tuple(fv.RATE_SENSITIVE_TYPES)
    oecd_countries: tuple = tuple(fv.EEA_COUNTRIES + fv.OECD_NON_EEA_COUNTRIES)
    strict_missing_rating: bool = False
    disabled: frozenset = field(default_factory=frozenset)

    CHECKS = ("mandatory", "irr")

    def __post_init__(self):
        unknown = set(self.disabled) - set(self.CHECKS)
        if unknown:
            raise ValueError(f"unknown checks: {sorted(unknown)}")

    def on(self, check: str) -> bool:
        return check not in self.disabled


# ----------------------------------------------------------- classification

def rating_to_step(rating: Column) -> Column:
    """Credit quality step of a rating; signs and blanks do not count, and an
    unknown or missing rating is the worst step."""
    bare = F.regexp_replace(rating, r"[+\-\s]", "")
    return F.coalesce(translate(bare, fv.RATING_STEPS), F.lit(fv.WORST_STEP))


def classify(kind: str, oecd_countries=PositionRules.oecd_countries) -> Column:
    """Calculation type of a direct position, first rule that applies.

    The allocation rules hold for the asset list only.
    """
    fx, deposit, strategic = (
        starts_with("asset_allocation", prefix) if kind == ASSET else "false"
        for prefix in (fv.ALLOCATION_FX, fv.ALLOCATION_DEPOSIT, fv.ALLOCATION_STRATEGIC)
    )
    sovereign = sovereign_like("cic_of_instrument", "security_name")
    return F.expr(f"""CASE
        WHEN coalesce(length(cic_of_instrument) <> 4, true) THEN '3X'
        WHEN {fx} THEN 'FX'
        WHEN {deposit} THEN '2'
        WHEN substring(cic_of_instrument, 3, 1) = '3' THEN CASE
          WHEN {strategic} THEN '3S'
          WHEN {is_in("substring(cic_of_instrument, 1, 2)", oecd_countries)} THEN '3L'
          ELSE '3X' END
        WHEN substring(cic_of_instrument, 3, 1) = '1' AND NOT {sovereign} THEN '1X'
        ELSE substring(cic_of_instrument, 3, 1) END""")


# ------------------------------------------------------------- direct rows

def flagged_positions(positions: DataFrame, facts: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Positions with what the look-through asks about their security:
    ``has_holdings``, ``fund_is_other_equity`` and ``applied_weight``.

    Missing ids have no holdings.  Everything below reads the positions through
    this table, so it should be stored when more than one step does.
    """
    flags = facts.select("portfolio_id", "fund_is_other_equity", "applied_weight", F.lit(True).alias("has_holdings"))
    crowded = hot_keys(row_counts(positions, "portfolio_id"), "portfolio_id", policy)
    return split_join(positions, flags, "portfolio_id", "left", "position_ord", crowded, policy).withColumn(
        "has_holdings", F.expr("coalesce(has_holdings, false)"))


FLAGS = ("has_holdings", "fund_is_other_equity", "applied_weight")


def unmatched_positions(flagged: DataFrame) -> DataFrame:
    """Positions whose security has no holdings, missing ids included."""
    return flagged.filter("NOT has_holdings").drop(*FLAGS)


def direct_rows(
    unmatched: DataFrame, kind: str, rules: PositionRules = PositionRules()
) -> DataFrame:
    """Unmatched positions as calc rows, before types are corrected.

    Holding columns are taken over from the position where it has them;
    ``missing_rating`` and ``missing_irr`` say which correction applies.
    """
    missing_rating = f"{is_in('classified_type', fv.RATED_CATEGORIES)} AND rating IS NULL"
    missing_irr = f"""{is_in('classified_type', rules.rate_types)} AND NOT missing_rating AND (
        modified_duration IS NULL OR exp_maturity_date IS NULL OR analysis_date IS NULL)"""
    typed = unmatched.withColumn("classified_type", classify(kind, rules.oecd_countries))
    typed = typed.selectExpr("*", f"({missing_rating if rules.strict_missing_rating else 'false'}) AS missing_rating")
    typed = typed.selectExpr("*", f"({missing_irr if rules.on('irr') else 'false'}) AS missing_irr")
    return typed.select(
        "*",
        rating_to_step(F.col("rating")).alias("cqs"),
        *[F.expr(e) for e in (
            "currency AS qc_of_underlying",
            "exp_maturity_date AS maturity_date",
            "analysis_date AS valuation_date",
            "modified_duration AS mod_dur_of_underlying",
            "1.0D AS valuation_weight",
            "dirty_value_pc AS value",
            "true AS is_direct",
            "cast(NULL AS STRING) AS id_of_underlying",
            "if(missing_rating OR missing_irr, '3X', classified_type) AS calculation_type",
        )],
    )


# -------------------------------------------------------------- look-through

#: Words of 64 bits in the filter of held funds: 16 MB of words and places.
HELD_WORDS = 1 << 20

TEXTS = ["security_name", "country", "currency", "cic_of_instrument", "asset_allocation"]

#: What folding reads.
FOLDED = ["portfolio_id", "portfolio_group", "analysis_date", *TEXTS, "fund_is_other_equity", "dirty_value_pc", "position_ord"]


def fold_positions(flagged: DataFrame) -> DataFrame:
    """Add up positions that the stress modules cannot tell apart.

    Same list (if there is a column for it), security, portfolio group, analysis
    date and texts; of the order key the first one stays.  The texts are grouping
    keys and the sums are numbers, so this is one hash aggregation with map-side
    partial sums and no sort.
    """
    keys = ["portfolio_id", "portfolio_group", "analysis_date", *TEXTS, "fund_is_other_equity"]
    keys += [c for c in flagged.columns if c == "list"]
    folded = flagged.filter("has_holdings").groupBy(*keys).agg(
        F.sum("dirty_value_pc").alias("dirty_value_pc"), F.min("position_ord").alias("position_ord"))
    return folded.withColumn("balance_nominal", F.lit(None).cast("double"))


def held_only(holdings: DataFrame, held: DataFrame) -> DataFrame:
    """The holdings of funds in ``held(portfolio_id)``, and a few others.

    Funds nobody holds are most of the data and would be shuffled for nothing.
    The held funds' hashes set bits in words that are broadcast: at most
    ``HELD_WORDS`` rows, whatever the number of funds.  Funds that share a bit
    with a held one stay in, so the join behind still decides.
    """
    place = f"pmod(xxhash64(portfolio_id), {64 * HELD_WORDS}L)"
    words = held.selectExpr(f"{place} AS place").groupBy(F.expr("place div 64 AS _word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place % 64 AS INT))) AS _mask"))
    known = holdings.withColumn("_word", F.expr(f"{place} div 64")).join(F.broadcast(words), "_word")
    return known.filter(f"getbit(_mask, cast({place} % 64 AS INT)) = 1").drop("_word", "_mask")


def look_through(
    flagged: DataFrame,
    typed_holdings: DataFrame,
    facts: DataFrame,
    policy: SkewPolicy = SkewPolicy(),
    folded: bool = False,
) -> DataFrame:
    """Positions joined to the holdings of their fund (matched positions only).

    ``typed_holdings`` carries ``row_type``; the fund's verdict travels with the
    position, so the holdings are shuffled once.  Folded positions are few per
    security: the holdings of a very large fund are salted and the position
    repeated per salt.  Other positions may crowd a security, too, so the
    positions times holdings of a security are dealt out, each side salted and
    repeated for the other's salts.
    """
    if folded:
        hot = hot_funds(facts, policy)
        left = per_salt(flagged, "portfolio_id", hot)
        right = with_salt(typed_holdings, "portfolio_id", "holding_ord", hot, policy)
        joined = left.join(right, ["portfolio_id", SALT]).drop(SALT)
    else:
        matched = flagged.filter("has_holdings")
        typed_holdings = held_only(typed_holdings, matched.select("portfolio_id"))
        hot = hot_products(
            row_counts(matched, "portfolio_id"), facts.select("portfolio_id", "n_rows"), "portfolio_id", policy)
        joined = product_join(matched, typed_holdings, "portfolio_id", "position_ord", "holding_ord", hot)
    return looked_through(joined)


def looked_through(joined: DataFrame) -> DataFrame:
    """Type and value of positions joined to the holdings of their fund."""
    return (
        joined.withColumns({
            "calculation_type": final_type(),
            "valuation_weight": F.expr("coalesce(valuation_weight, 1.0D)"),
            "value": F.expr("coalesce(valuation_weight, 1.0D) * dirty_value_pc"),
            "is_direct": F.expr("false"),
        })
        .drop("row_type", *FLAGS)
    )


def calc_frame(
    positions: DataFrame,
    holdings: DataFrame,
    kind: str,
    facts: DataFrame | None = None,
    holding_rules: HoldingRules = HoldingRules(),
    position_rules: PositionRules = PositionRules(),
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Left look-through join: one row per position and holding, one per direct
    position, with type and value.  ``positions`` may be flagged already."""
    facts = fund_facts(holdings, holding_rules) if facts is None else facts
    flagged = positions if "has_holdings" in positions.columns else flagged_positions(positions, facts, policy)
    matched = look_through(flagged, with_row_type(holdings, holding_rules), facts, policy)
    direct = direct_rows(unmatched_positions(flagged), kind, position_rules)
    return matched.select(*CALC_COLUMNS).unionByName(
        direct.drop("classified_type", "missing_rating", "missing_irr"), allowMissingColumns=True
    )


def module_frames(
    lists: Mapping[str, DataFrame],
    holdings: DataFrame,
    facts: DataFrame | None = None,
    holding_rules: HoldingRules = HoldingRules(),
    position_rules: PositionRules = PositionRules(),
    policy: SkewPolicy = SkewPolicy(),
    only_types: Sequence[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """The calc frames of several position lists as the stress modules need
    them: positions folded before the join, only the columns that modules read,
    and ``list`` naming the list.  The lists share one pass over the holdings.

    The positions may be flagged already (`flagged_positions`).

    With ``only_types``, holdings that cannot get one of these types stay out
    of the join; other rows of the result may still have any type.  With 3X
    among them every holding goes in: a fund's verdict makes any type 3X, and
    asking for it beforehand would shuffle the same holdings once more.

    With ``buckets`` the rows of a security leave together, dealt out by
    ``portfolio_id``: positions and holdings are exchanged once each, for the
    folding, the join and a bucketed table.  Very large keys are not split then;
    `split_crowded` takes them apart first.
    """
    facts = fund_facts(holdings, holding_rules) if facts is None else facts
    typed = with_row_type(holdings, holding_rules)
    if only_types is not None and "3X" not in only_types:
        # A fund's verdict can only turn a type into 3X, so the rest keep theirs.
        typed = typed.filter(is_in("row_type", only_types))
    matched, direct = [], []
    for kind, positions in lists.items():
        flagged = positions if "has_holdings" in positions.columns else flagged_positions(positions, facts, policy)
        matched.append(flagged.filter("has_holdings").withColumn("list", F.lit(kind)))
        direct.append(direct_rows(unmatched_positions(flagged), kind, position_rules).withColumn("list", F.lit(kind)))
    matched, direct = reduce(DataFrame.unionByName, matched), reduce(DataFrame.unionByName, direct)
    typed = held_only(typed, matched.select("portfolio_id"))
    direct = direct.select("list", *MODULE_COLUMNS)
    if buckets:
        matched, typed, direct = (rows.repartition(buckets, "portfolio_id") for rows in (
            matched.select("list", "has_holdings", *FOLDED), typed, direct))
        matched = looked_through(fold_positions(matched).join(typed, "portfolio_id"))
    else:
        matched = look_through(fold_positions(matched), typed, facts, policy, folded=True)
    return matched.select("list", *MODULE_COLUMNS).unionByName(direct)


def crowded_securities(lists: Sequence[DataFrame], facts: DataFrame, policy: SkewPolicy) -> DataFrame:
    """``(portfolio_id)`` of very large funds and of securities with very many positions: few, see `skew`."""
    hot = [hot_funds(facts, policy), *(hot_keys(row_counts(flagged, "portfolio_id"), "portfolio_id", policy) for flagged in lists)]
    return reduce(DataFrame.unionByName, [keys.select("portfolio_id") for keys in hot]).distinct()


def split_crowded(flagged: DataFrame, crowded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(positions whose security fits one task, the others)``: the others are those of ``crowded`` securities and of none."""
    listed = flagged.join(F.broadcast(crowded.withColumn("_crowded", F.lit(True))), "portfolio_id", "left").withColumn(
        "_crowded", F.expr("portfolio_id IS NULL OR _crowded IS NOT NULL"))
    return tuple(listed.filter(side).drop("_crowded").select(*flagged.columns) for side in ("NOT _crowded", "_crowded"))


def module_frame(positions: DataFrame, holdings: DataFrame, kind: str, *args, **options) -> DataFrame:
    """`module_frames` of a single list."""
    return module_frames({kind: positions}, holdings, *args, **options).drop("list")


# ------------------------------------------------------------------ reports

def value_totals(flagged: DataFrame) -> DataFrame:
    """One row: value before (``total_dirty_value_pc``) and after (``total_value``)
    the look-through, and the part of the latter that counts in the portfolio
    total (``portfolio_total``).

    A fund's holdings share out the position's value by weight, so the sum over
    the look-through is the position's value times the fund's weight sum.  The
    holdings themselves are not read.
    """
    outside = starts_with("asset_allocation", *fv.ALLOCATIONS_OUTSIDE_TOTAL)
    after = "dirty_value_pc * coalesce(applied_weight, 1.0D)"
    return flagged.agg(
        F.expr("coalesce(sum(dirty_value_pc), 0.0D) AS total_dirty_value_pc"),
        F.expr(f"coalesce(sum({after}), 0.0D) AS total_value"),
        F.expr(f"coalesce(sum(if({outside}, NULL, {after})), 0.0D) AS portfolio_total"),
    )


def totals_differ() -> Column:
    gap = F.abs(F.col("total_value") - F.col("total_dirty_value_pc"))
    return gap > fv.CONTROL_TOTAL_TOLERANCE


def position_findings(flagged: DataFrame, direct: DataFrame, rules: PositionRules = PositionRules()) -> DataFrame:
    """Report rows of one position list: ``flagged`` from `flagged_positions`,
    ``direct`` from `direct_rows`."""
    shown = ["severity", "error_code", "Error", "portfolio_id", "total_dirty_value_pc", "total_value"]

    def finding(rows, severity, code, text, *columns):
        """``text`` is an SQL expression."""
        empty = {"portfolio_id": "cast(NULL AS STRING)", "total_dirty_value_pc": "cast(NULL AS DOUBLE)",
                 "total_value": "cast(NULL AS DOUBLE)"}
        values = {"severity": sql_text(severity), "error_code": sql_text(code), "Error": text,
                  **empty, **{c: c for c in columns}}
        return rows.selectExpr(*[f"{values[c]} AS {c}" for c in shown])

    parts = []
    if rules.on("mandatory"):
        require_columns(flagged, rules.mandatory)
        cells = [f"struct({c} IS NULL AS missing, {sql_text(c)} AS name)" for c in rules.mandatory]
        missing = flagged.selectExpr("portfolio_id", f"inline(filter(array({', '.join(cells)}), x -> x.missing))")
        text = "Missing value in mandatory column: "
        parts.append(finding(missing, CRITICAL, "MISSING_MANDATORY", f"concat({sql_text(text)}, name)", "portfolio_id"))
    if rules.strict_missing_rating:
        parts.append(finding(
            direct.filter("missing_rating"), VALIDATION,
            "MISSING_RATING", sql_text("Missing rating for calculation type 1, 2 or 8"), "portfolio_id",
        ))
    if rules.on("irr"):
        parts.append(finding(
            direct.filter("missing_irr"), VALIDATION, "MISSING_IRR_INPUT",
            sql_text("Missing duration, maturity or analysis date for a rate-sensitive type"), "portfolio_id",
        ))
    parts.append(finding(
        value_totals(flagged).filter(totals_differ()), CRITICAL, "CONTROL_TOTAL",
        sql_text("Total value is not within 1000000 of the control total"), "total_dirty_value_pc", "total_value",
    ))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def split_position_report(findings: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        findings.filter(F.col("severity") == VALIDATION).select("error_code", "Error", "portfolio_id"),
        findings.filter(F.col("severity") == CRITICAL).select(
            "error_code", "Error", "portfolio_id", "total_dirty_value_pc", "total_value"
        ),
    )
