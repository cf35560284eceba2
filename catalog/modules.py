"""Queries on shared aggregates and the stress modules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.common import calc_frame, flagged, fund_facts, module_frame, r, rs
from catalog.scans import read_holdings, read_positions
from fixtures import sql, views
from shockwell.functions import aggregates
from shockwell.functions.dates import years_between
from shockwell.operators import concentration, currency, equity, interest, positions as pos
from shockwell.operators import property as prop
from shockwell.operators import spread
from shockwell.operators.securities import SECURITY, roll_up
from shockwell.plans import market_risk as plan
from shockwell.plans.publication import published
from shockwell.plans.storage import work_folder
from shockwell.sources import market

P, M = views.PARAMS, views.MATRIX
# Digits that results are compared with, where not four.
DIGITS = {"currency": 3, "concentration": 2}


def _rates(spark, sf_dir):
    rates, units = market.fx_sheet(views.fx_sheet(spark, sf_dir), "rate_date")
    return market.fx_asof(market.fx_month(rates, views.FX_PERIOD), units)


def _shown(df, digits=4):
    """Numbers rounded, texts as they are."""
    return df.select(*[r(c, digits) if t == "double" else F.col(c) for c, t in df.dtypes])


def _frame(spark, sf_dir, kind, module, full=False):
    """The full look-through frame, or what one module needs of it."""
    if full:
        return calc_frame(spark, sf_dir, kind)
    return module_frame(spark, sf_dir, kind, only_types=M.types_for(module))


def _equity(kind):
    def query(spark, sf_dir):
        frame = _frame(spark, sf_dir, kind, "equity")
        return _shown(equity.equity_risk(frame, P, M, views.SYMMETRIC_ADJUSTMENT))

    return query


def _interest(kind, rejects=False):
    def query(spark, sf_dir):
        frame = _frame(spark, sf_dir, kind, "interest", full=rejects)
        return _shown(interest.interest_rate_risk(frame, P, M, views.curves(spark))[rejects])

    return query


def _spread(kind, rejects=False):
    def query(spark, sf_dir):
        frame = _frame(spark, sf_dir, kind, "spread", full=rejects)
        return _shown(spread.spread_risk(frame, P, M)[rejects])

    return query


def _currency(kind):
    def query(spark, sf_dir):
        frame = _frame(spark, sf_dir, kind, "currency")
        return _shown(currency.currency_risk(frame, P, M, _rates(spark, sf_dir)), 3)

    return query


def _property(kind):
    def query(spark, sf_dir):
        return _shown(prop.property_risk(_frame(spark, sf_dir, kind, "property"), P, M))

    return query


def concentration_risk(spark, sf_dir):
    facts = fund_facts(spark, sf_dir)
    frame = module_frame(spark, sf_dir, "asset", facts, M.types_for("concentration"))
    totals = pos.value_totals(flagged(spark, sf_dir, "asset", facts))
    return _shown(concentration.concentration_risk(frame, P, M, totals)[0], 2)


def _whole_run(spark, sf_dir):
    """Everything from stored inputs to sinks; the path that the result tables are in."""
    market_data = plan.MarketData(views.curves(spark), _rates(spark, sf_dir), views.SYMMETRIC_ADJUSTMENT)
    path = f"{work_folder(spark)}/out"
    plan.run(
        views.holdings(spark, sf_dir), views.positions(spark, sf_dir, "asset"), views.positions(spark, sf_dir, "ul"),
        plan.Settings(P, M), market_data, path)
    return published(spark, path)


def _stored_totals(spark, path):
    """Rows and total value of every result table that a run has stored."""
    parts = []
    for kind, modules in (("asset", plan.ASSET_MODULES), ("ul", plan.UL_MODULES)):
        for module in modules:
            table = spark.read.parquet(f"{path}/results/list={kind}/module={module}")
            parts.append(_shown(table, DIGITS.get(module, 4)).agg(
                F.lit(kind).alias("list"), F.lit(module).alias("module"), F.count(F.lit(1)).alias("n_rows"),
                F.expr("cast(sum(cast(value AS DECIMAL(30, 4))) AS STRING) AS value")))
    return reduce(DataFrame.unionByName, parts)


def market_risk_pipeline(spark, sf_dir):
    """The whole calculation from typed tables."""
    return _stored_totals(spark, _whole_run(spark, sf_dir))


_text_runs: dict[tuple[str, str], str] = {}


def _text_run(spark, sf_dir):
    """The whole calculation from the text files: scan, number, look through,
    stress, publish; once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _text_runs:
        _text_runs[key] = _run_from_text(spark, sf_dir)
    return _text_runs[key]


def _run_from_text(spark, sf_dir):
    market_data = plan.MarketData(views.curves(spark), _rates(spark, sf_dir), views.SYMMETRIC_ADJUSTMENT)
    tables = [read_holdings(spark, sf_dir), *(read_positions(spark, sf_dir, kind) for kind in ("asset", "ul"))]
    path = f"{work_folder(spark)}/out"
    plan.run(*(typed for typed, _ in tables), plan.Settings(P, M), market_data, path, cast_rejects=[rejects for _, rejects in tables])
    return published(spark, path)


def text_pipeline(spark, sf_dir):
    return _stored_totals(spark, _text_run(spark, sf_dir))


def text_pipeline_equity(spark, sf_dir):
    """A table with first texts, which depend on the order of the text's rows."""
    return _shown(spark.read.parquet(f"{_text_run(spark, sf_dir)}/results/list=asset/module=equity"))


def ul_pipeline_equity(spark, sf_dir):
    return _shown(spark.read.parquet(f"{_whole_run(spark, sf_dir)}/results/list=ul/module=equity"))


def _by_country(spark, sf_dir):
    """Positions as direct rows of 25 large securities (one per country), so
    that exposures pass the thresholds."""
    n = F.array_position(F.array(*[F.lit(c) for c in views.COUNTRIES]), F.col("country")) - 1
    rows = views.positions(spark, sf_dir).withColumn("n", n)
    kind = F.when((F.col("n") < 6) & (F.col("n") != 4), "1X").otherwise(pos.classify("asset"))
    return rows.select(
        "*",
        F.concat(F.lit("N"), F.col("n").cast("string")).alias("pid"),
        (F.col("n") % 7).cast("string").alias("cqs"),
        kind.alias("calculation_type"),
        F.lit(None).cast("string").alias("id_of_underlying"),
        F.lit(True).alias("is_direct"),
        F.col("dirty_value_pc").alias("value"),
    ).drop("portfolio_id").withColumnRenamed("pid", "portfolio_id")


def concentration_by_country(spark, sf_dir):
    return _shown(concentration.concentration_risk(_by_country(spark, sf_dir), P, M)[0], 2)


# ------------------------------------------------------- aggregates, scalars

def group_first(spark, sf_dir):
    rows = views.positions(spark, sf_dir)
    return roll_up(rows, ["portfolio_group", "country"], ["rating", "security_name"], ["dirty_value_pc"]).drop("dirty_value_pc")


def group_uniform(spark, sf_dir):
    return views.positions(spark, sf_dir).groupBy("portfolio_id").agg(
        aggregates.uniform("rating").alias("rating"),
        aggregates.uniform("modified_duration").alias("modified_duration"),
        aggregates.uniform("analysis_date").alias("analysis_date"),
    )


def group_dominant(spark, sf_dir):
    """Currency with the largest value per security, through the roll-up."""
    rows = module_frame(spark, sf_dir, "asset")
    return _shown(roll_up(
        rows, SECURITY, ["security_name"], ["value"], ["mod_dur_of_underlying"], "qc_of_underlying"
    ))


def weighted_cqs(spark, sf_dir):
    rows = views.holdings(spark, sf_dir)
    step, w = F.expr(concentration.STEP_OR_WORST), F.col("mod_dur_of_underlying")
    return rows.groupBy("portfolio_id", "id_of_underlying").agg(
        aggregates.weighted_step(F.sum(step * w), F.sum(w), P.tolerance).alias("weighted_cqs")
    )


def years_to_maturity(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    start = F.date_sub(day, (F.col("l_partkey") % 9000 - 500).cast("int"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        years_between(start, day).alias("years"),
    ).withColumn("years", r("years", 8))


def curve_interpolate(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.col("l_quantity") * 4 - 10 + (F.col("l_partkey") % 8) / 8).alias("years"),
        F.expr(views.code_at(views.HOLDING_CURRENCIES, "l_suppkey % 8")).alias("currency"),
    )
    rated = interest.with_rates(lines, views.curves(spark), P, "currency", "years")
    return rated.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "currency", "years",
        r("base_rate", 8), r("up_rate", 8), r("down_rate", 8),
    )


def curve_for_currency(spark, sf_dir):
    """Holdings per currency, with the curve that currency reads."""
    chosen = market.curve_for_currency(views.curves(spark), P).filter("shock = 'base'")
    used = views.holdings(spark, sf_dir).groupBy("qc_of_underlying").agg(F.count(F.lit(1)).alias("n_holdings"))
    return used.join(chosen, used.qc_of_underlying == chosen.curve_currency, "left").select(
        "qc_of_underlying", "curve_code", "n_holdings"
    )


def spread_buckets(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(l_partkey % 8 AS INT) AS step",
        "if(l_partkey % 29 = 0, NULL, l_quantity / 2 - 0.25D * (l_suppkey % 3)) AS duration",
    )
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        spread.duration_bucket("duration").cast("bigint").alias("bucket"),
        spread.duration_in_bucket("duration").alias("years_in_bucket"),
        spread.spread_shock(F.col("step"), "duration", P).alias("shock"),
    ).withColumns({"years_in_bucket": r("years_in_bucket", 6), "shock": r("shock", 6)})


def cqs_normalise(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    p = F.col("l_partkey") % 11
    cell = F.when(p == 8, "NR").when(p == 9, F.when(F.col("l_suppkey") % 2 == 0, "3D").otherwise("1.5")).when(p == 10, "-1").when(
        (p == 7) & (F.col("l_suppkey") % 2 == 0), "A"
    ).otherwise(p.cast("string"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        spread.step_label(spread.step_number(cell)).alias("cqs"),
    )


def risk_type_filter(spark, sf_dir):
    """Value per module and calculation type that the module stresses."""
    per_type = module_frame(spark, sf_dir, "asset").groupBy("calculation_type").agg(
        aggregates.total("value").alias("value")
    )
    return M.table(spark).join(per_type, "calculation_type").select("module", "calculation_type", r("value", 1))


QUERIES = {
    "risk_type_filter": risk_type_filter,
    "group_first": group_first,
    "group_uniform": group_uniform,
    "group_dominant": group_dominant,
    "weighted_cqs": weighted_cqs,
    "years_to_maturity": years_to_maturity,
    "curve_interpolate": curve_interpolate,
    "curve_for_currency": curve_for_currency,
    "spread_buckets": spread_buckets,
    "cqs_normalise": cqs_normalise,
    "equity_risk": _equity("asset"),
    "interest_rate_risk": _interest("asset"),
    "interest_rate_rejects": _interest("asset", rejects=True),
    "spread_risk": _spread("asset"),
    "spread_rejects": _spread("asset", rejects=True),
    "currency_risk": _currency("asset"),
    "concentration_risk": concentration_risk,
    "concentration_by_country": concentration_by_country,
    "property_risk": _property("asset"),
    "ul_equity_risk": _equity("ul"),
    "ul_interest_rate_risk": _interest("ul"),
    "ul_spread_risk": _spread("ul"),
    "ul_currency_risk": _currency("ul"),
    "ul_property_risk": _property("ul"),
    "market_risk_pipeline": market_risk_pipeline,
    "ul_pipeline_equity": ul_pipeline_equity,
    "text_pipeline": text_pipeline,
    "text_pipeline_equity": text_pipeline_equity,
}


def _calc(kind):
    return (sql.POSITIONS, sql.HOLDINGS, sql.TYPED, sql.calc(kind))


def _first(column):
    return f"first({column} ORDER BY position_ord)"


def _uniform(column):
    return f"CASE WHEN count({column}) = count(*) AND min({column}) = max({column}) THEN min({column}) END"


def _dominant(rows, keys, category):
    """Category with the largest value per key, as a scalar from ranked sums."""
    ks = ", ".join(keys)
    return f"""(SELECT {ks}, first({category} ORDER BY v DESC, coalesce({category}, 'nan')) AS {category}
      FROM (SELECT {ks}, {category}, coalesce(sum(value), 0) AS v FROM {rows} GROUP BY ALL) GROUP BY {ks})"""


def _sum(column, digits=4):
    return rs(f"coalesce(sum({column}), 0)", column, digits)


_SEC = ["portfolio_id", "portfolio_group"]


def _equity_sql(kind):
    sa = views.SYMMETRIC_ADJUSTMENT
    return sql.with_(*_calc(kind)) + f""", e AS (
      SELECT *, value * (1 - CASE calculation_type WHEN '3S' THEN 0.22::DOUBLE
          WHEN '3L' THEN 0.39::DOUBLE + {sa}::DOUBLE ELSE 0.49::DOUBLE + {sa}::DOUBLE END) AS shocked_value,
        CASE calculation_type WHEN '3S' THEN 'strat_part' WHEN '3L' THEN 't1_equity' ELSE 't2_equity' END AS equity_type
      FROM calc WHERE calculation_type IN {sql.types('equity')}),
    x AS (SELECT *, value - shocked_value AS calc_equity_shock FROM e)
    SELECT * FROM (SELECT portfolio_group, portfolio_id, {_first('security_name')} AS security_name,
      {_first('cic_of_instrument')} AS cic_of_instrument, {_sum('value')}, {_sum('shocked_value')},
      {_sum('calc_equity_shock')} FROM x GROUP BY portfolio_group, portfolio_id)
    JOIN {_dominant('x', _SEC, 'equity_type')} USING (portfolio_id, portfolio_group)"""


_YEARS = sql.years("analysis_date", "maturity_date")


def _rate(shock):
    def point(term):
        return f"""(SELECT rate FROM points p WHERE p.shock = '{shock}'
          AND p.curve_currency = y.qc_of_underlying AND p.term = {term})"""

    at = "greatest(1, least(150, y.years_to_maturity))"
    return (f"{point(f'floor({at})::INT')} + ({point(f'ceil({at})::INT')} - {point(f'floor({at})::INT')})"
            f" * ({at} - floor({at}))")


def _interest_rows(kind):
    return sql.with_(*_calc(kind), sql.CURVES) + f""", y AS (
      SELECT *, {_YEARS} AS years_to_maturity FROM calc WHERE calculation_type IN {sql.types('interest')}),
    z AS (SELECT *, {_rate('base')} AS base_rate, {_rate('up')} AS up_rate, {_rate('down')} AS down_rate FROM y)"""


def _interest_sql(kind):
    return _interest_rows(kind) + f""", w AS (
      SELECT *, -value * (up_rate - base_rate) * mod_dur_of_underlying AS up_shock_value,
        -value * (down_rate - base_rate) * mod_dur_of_underlying AS down_shock_value FROM z
      WHERE maturity_date IS NOT NULL AND base_rate IS NOT NULL),
    x AS (SELECT *, value + up_shock_value AS up_shock_market_value,
        value + down_shock_value AS down_shock_market_value FROM w)
    SELECT * FROM (SELECT portfolio_group, portfolio_id, {_first('security_name')} AS security_name,
      {rs(_uniform('years_to_maturity'), 'years_to_maturity')},
      {rs(_uniform('mod_dur_of_underlying'), 'mod_dur_of_underlying')}, {_sum('value')},
      {_sum('down_shock_market_value')}, {_sum('down_shock_value')},
      {_sum('up_shock_market_value')}, {_sum('up_shock_value')} FROM x GROUP BY portfolio_group, portfolio_id)
    JOIN {_dominant('x', _SEC, 'qc_of_underlying')} USING (portfolio_id, portfolio_group)"""


def _matrix_sql(rows):
    return "[" + ",".join("[" + ",".join(f"{v}::DOUBLE" for v in line) + "]" for line in rows) + "]"


def _shock_sql(step, duration):
    bucket = (f"(CASE WHEN {duration} < 5 THEN 1 WHEN {duration} < 10 THEN 2 WHEN {duration} < 15 THEN 3 "
              f"WHEN {duration} < 20 THEN 4 ELSE 5 END)")
    inside = (f"(CASE WHEN {duration} < 1 THEN 1.0::DOUBLE WHEN {duration} < 5 THEN {duration} "
              f"WHEN {duration} < 10 THEN {duration} - 5 WHEN {duration} < 15 THEN {duration} - 10 "
              f"WHEN {duration} < 20 THEN {duration} - 15 ELSE {duration} - 20 END)")
    rated = f"(CASE {step} WHEN 6 THEN 4 ELSE {step} END)::INT + 1"

    def cell(r_, u):
        return (f"CASE WHEN {step} = 7 THEN {_matrix_sql(u)}[{bucket}][1] "
                f"ELSE {_matrix_sql(r_)}[{bucket}][{rated}] END")

    raw = f"({cell(P.rated_a, P.unrated_a)} + ({cell(P.rated_b, P.unrated_b)}) * {inside})"
    return bucket, inside, f"CASE WHEN {duration} IS NOT NULL THEN least({raw}, 1) END"


_STEP_OF_CALC = "CASE WHEN cqs = 'NR' THEN 7 ELSE least(cqs::INT, 7) END"


def _spread_sql(kind):
    shock = _shock_sql("step", "mod_dur_of_underlying")[2]
    return sql.with_(*_calc(kind)) + f""", s AS (
      SELECT *, {_STEP_OF_CALC} AS step FROM calc
      WHERE calculation_type IN {sql.types('spread')} AND cqs IS NOT NULL),
    t AS (SELECT *, value * (1 - ({shock})) AS spread_shocked_mv_value FROM s),
    x AS (SELECT *, value - spread_shocked_mv_value AS spread_shock_value FROM t)
    SELECT portfolio_group, portfolio_id, {_first('security_name')} AS security_name,
      CASE WHEN min(step) = max(step) THEN CASE min(step) WHEN 7 THEN 'NR' ELSE min(step)::VARCHAR END END AS cqs,
      {rs(_uniform('mod_dur_of_underlying'), 'mod_dur_of_underlying')}, {_sum('value')},
      {_sum('spread_shocked_mv_value')}, {_sum('spread_shock_value')} FROM x GROUP BY portfolio_group, portfolio_id"""


def _currency_sql(kind):
    return sql.with_(*_calc(kind), sql.FX) + f""", g AS (
      SELECT {_first('portfolio_group')} AS portfolio_group, portfolio_id, {_first('security_name')} AS security_name,
        qc_of_underlying, coalesce(sum(value), 0) AS value,
        CASE WHEN qc_of_underlying = 'HUF' THEN 1.0::DOUBLE ELSE 0.75::DOUBLE END AS down,
        CASE WHEN qc_of_underlying = 'HUF' THEN 1.0::DOUBLE ELSE 1.25::DOUBLE END AS up
      FROM calc WHERE calculation_type IN {sql.types('currency')} AND calculation_type <> 'FX'
      GROUP BY portfolio_id, qc_of_underlying)
    SELECT portfolio_group, portfolio_id, security_name, qc_of_underlying, {rs('value', digits=3)},
      {rs('value * down', 'down_shock_mv_value', 3)}, {rs('value - value * down', 'down_shock_value', 3)},
      {rs('value * up', 'up_shock_mv_value', 3)}, {rs('value - value * up', 'up_shock_value', 3)} FROM g
    UNION ALL
    SELECT portfolio_group, portfolio_id, security_name, qc_of_underlying, {rs('value', digits=3)},
      {rs('balance_nominal * CASE WHEN c IS NULL THEN value ELSE rate END', 'down_shock_mv_value', 3)},
      {rs('value - balance_nominal * CASE WHEN c IS NULL THEN value ELSE rate END', 'down_shock_value', 3)},
      0.0::DOUBLE, {rs('value', 'up_shock_value', 3)}
    FROM calc LEFT JOIN (SELECT currency AS c, rate FROM fx_asof) ON c = qc_of_underlying
    WHERE calculation_type = 'FX'"""


def _property_sql(kind):
    return sql.with_(*_calc(kind)) + f""", x AS (
      SELECT *, value * 0.25::DOUBLE AS property_shock_value, value - value * 0.25::DOUBLE AS property_shocked_mv_value
      FROM calc WHERE calculation_type IN {sql.types('property')})
    SELECT portfolio_group, portfolio_id, {_first('security_name')} AS security_name, {_sum('value')},
      {_sum('property_shocked_mv_value')}, {_sum('property_shock_value')} FROM x GROUP BY portfolio_group, portfolio_id"""


def _vector_sql(values):
    return "[" + ",".join(f"{v}::DOUBLE" for v in values) + "]"


_COUNTRY_MAP = ("MAP {" + ",".join(f"'{k}':'{v}'" for k, v in P.country_currency.items()) + "}")


def _concentration_sql(head):
    """``head`` ends with a CTE ``calc``."""
    return head + f""", f AS (
      SELECT *, coalesce(value, 0) AS v, coalesce(id_of_underlying, CASE WHEN is_direct THEN 'dummy_id' ELSE 'nan' END) AS uid,
        CASE WHEN cqs IS NULL OR cqs = 'NR' THEN 6 ELSE cqs::DOUBLE END AS step
      FROM calc WHERE calculation_type IN {sql.types('concentration')}),
    g AS (
      SELECT portfolio_id, uid, {_first('portfolio_group')} AS portfolio_group, {_first('security_name')} AS security_name,
        {_first('currency')} AS currency, {_first('country')} AS country, bool_and(calculation_type = '1X') AS sovereign,
        sum(v) AS value,
        CASE WHEN sum(v) <> 0 THEN ceil(sum(step * v) / sum(v) - 1e-5::DOUBLE)::BIGINT ELSE 0 END AS weighted_cqs
      FROM f GROUP BY portfolio_id, uid),
    h AS (
      SELECT *, {_vector_sql(P.thresholds)}[least(weighted_cqs, 6) + 1] AS threshold,
        CASE WHEN sovereign AND coalesce({_COUNTRY_MAP}[country] = currency, false)
          THEN {_vector_sql(P.gov_risk_factors)}[least(weighted_cqs, 6) + 1]
          ELSE {_vector_sql(P.risk_factors)}[least(weighted_cqs, 6) + 1] END AS risk_factor,
        (SELECT sum(value) FROM calc WHERE asset_allocation NOT LIKE '995%' AND asset_allocation NOT LIKE '645%') AS total
      FROM g),
    i AS (SELECT *, threshold * total AS threshold_value, greatest(0, value - threshold * total) AS excess_exposure FROM h),
    j AS (SELECT *, excess_exposure * risk_factor AS concentration_risk FROM i)
    SELECT portfolio_id, first(portfolio_group ORDER BY uid) AS portfolio_group,
      first(security_name ORDER BY uid) AS security_name, first(currency ORDER BY uid) AS currency,
      first(country ORDER BY uid) AS country, {_uniform('weighted_cqs')} AS weighted_cqs,
      {rs(_uniform('threshold'), 'threshold', 2)}, {rs(_uniform('threshold_value'), 'threshold_value', 2)},
      {_sum('excess_exposure', 2)}, {rs(_uniform('risk_factor'), 'risk_factor', 2)}, {_sum('value', 2)},
      {_sum('concentration_risk', 2)} FROM j GROUP BY portfolio_id"""


_NUMBER = f"list_position({sql.CC}, country) - 1"
_BY_COUNTRY = sql.with_(sql.POSITIONS) + f""", calc AS (
      SELECT * REPLACE ('N' || {_NUMBER} AS portfolio_id), (({_NUMBER}) % 7)::VARCHAR AS cqs,
        CASE WHEN {_NUMBER} < 6 AND {_NUMBER} <> 4 THEN '1X' ELSE {sql.classify('asset')} END AS calculation_type,
        NULL::VARCHAR AS id_of_underlying, true AS is_direct, dirty_value_pc AS value FROM all_positions)"""

_bucket, _inside, _shock = _shock_sql("step", "d")
_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

ORACLES = {
    "risk_type_filter": sql.with_(*_calc("asset")) + f"""SELECT module, calculation_type, {rs('coalesce(sum(value), 0)', 'value', 1)}
      FROM calc JOIN (VALUES {",".join(f"('{m}','{t}')" for m in M.flags for t in M.types_for(m))}) x(module, t)
      ON t = calculation_type GROUP BY ALL""",
    "group_first": sql.with_(sql.POSITIONS) + f"""SELECT portfolio_group, country, {_first('rating')} AS rating,
      {_first('security_name')} AS security_name FROM all_positions GROUP BY 1, 2""",
    "group_uniform": sql.with_(sql.POSITIONS) + f"""SELECT portfolio_id, {_uniform('rating')} AS rating,
      {_uniform('modified_duration')} AS modified_duration, {_uniform('analysis_date')} AS analysis_date
      FROM all_positions GROUP BY 1""",
    "group_dominant": sql.with_(*_calc("asset")) + f"""SELECT * FROM (SELECT portfolio_id, portfolio_group,
      {_first('security_name')} AS security_name, {_sum('value')},
      {rs(_uniform('mod_dur_of_underlying'), 'mod_dur_of_underlying')} FROM calc GROUP BY 1, 2)
      JOIN {_dominant('calc', _SEC, 'qc_of_underlying')} USING (portfolio_id, portfolio_group)""",
    "weighted_cqs": sql.with_(sql.HOLDINGS) + """SELECT portfolio_id, id_of_underlying,
      CASE WHEN sum(mod_dur_of_underlying) <> 0 THEN ceil(sum(coalesce(cqs::DOUBLE, 6) * mod_dur_of_underlying)
        / sum(mod_dur_of_underlying) - 1e-5::DOUBLE)::BIGINT ELSE 0 END AS weighted_cqs
      FROM holdings GROUP BY 1, 2""",
    "years_to_maturity": f"""WITH l AS (SELECT *, l_shipdate::DATE AS e,
        l_shipdate::DATE - (l_partkey % 9000 - 500)::INT AS s FROM lineitem)
      SELECT {_LINE}, {rs(sql.years('s', 'e'), 'years', 8)} FROM l""",
    "curve_interpolate": sql.with_(sql.CURVES) + f""", y AS (
      SELECT {_LINE}, l_quantity * 4 - 10 + (l_partkey % 8)::DOUBLE / 8 AS years_to_maturity,
        {sql._list(views.HOLDING_CURRENCIES)}[(l_suppkey % 8)::INT + 1] AS qc_of_underlying FROM lineitem)
      SELECT {_LINE}, qc_of_underlying AS currency, years_to_maturity AS years,
        {rs(_rate('base'), 'base_rate', 8)}, {rs(_rate('up'), 'up_rate', 8)}, {rs(_rate('down'), 'down_rate', 8)} FROM y""",
    "curve_for_currency": sql.with_(sql.HOLDINGS, sql.CURVES) + f"""SELECT qc_of_underlying,
        {sql._list(views.CURVE_NAMES)}[pos + 1] || '_31_12_2001_SWP' AS curve_code, count(*) AS n_holdings
      FROM holdings LEFT JOIN pick ON curve_currency = qc_of_underlying GROUP BY ALL""",
    "spread_buckets": f"""WITH l AS (SELECT {_LINE}, (l_partkey % 8)::INT AS step,
        CASE WHEN l_partkey % 29 <> 0 THEN l_quantity / 2 - 0.25::DOUBLE * (l_suppkey % 3) END AS d FROM lineitem)
      SELECT {_LINE}, ({_bucket} - 1)::BIGINT AS bucket, {rs(_inside, 'years_in_bucket', 6)}, {rs(_shock, 'shock', 6)} FROM l""",
    "cqs_normalise": f"""SELECT {_LINE}, CASE WHEN l_partkey % 11 = 8 THEN 'NR'
        WHEN l_partkey % 11 = 7 AND l_suppkey % 2 <> 0 THEN 'NR'
        WHEN l_partkey % 11 < 7 THEN (l_partkey % 11)::VARCHAR END AS cqs FROM lineitem""",
    "equity_risk": _equity_sql("asset"),
    "interest_rate_risk": _interest_sql("asset"),
    "interest_rate_rejects": _interest_rows("asset") + """SELECT 'interest' AS module,
      CASE WHEN maturity_date IS NULL THEN 'missing maturity or analysis date' ELSE 'no curve for the currency' END AS reason,
      portfolio_id, id_of_underlying, qc_of_underlying AS raw_value FROM z
      WHERE maturity_date IS NULL OR base_rate IS NULL""",
    "spread_risk": _spread_sql("asset"),
    "spread_rejects": sql.with_(*_calc("asset")) + f"""SELECT 'spread' AS module, 'invalid credit quality step' AS reason,
      portfolio_id, id_of_underlying, cqs AS raw_value FROM calc
      WHERE calculation_type IN {sql.types('spread')} AND cqs IS NULL""",
    "currency_risk": _currency_sql("asset"),
    "concentration_risk": _concentration_sql(sql.with_(*_calc("asset"))),
    "concentration_by_country": _concentration_sql(_BY_COUNTRY),
    "property_risk": _property_sql("asset"),
    "ul_equity_risk": _equity_sql("ul"),
    "ul_interest_rate_risk": _interest_sql("ul"),
    "ul_spread_risk": _spread_sql("ul"),
    "ul_currency_risk": _currency_sql("ul"),
    "ul_property_risk": _property_sql("ul"),
}

_STORED = {"equity": "equity_risk", "interest": "interest_rate_risk", "spread": "spread_risk", "currency": "currency_risk",
           "concentration": "concentration_risk", "property": "property_risk"}
ORACLES["market_risk_pipeline"] = " UNION ALL ".join(
    f"""SELECT '{kind}' AS list, '{module}' AS module, count(*) AS n_rows,
      sum(value::DECIMAL(30, 4))::VARCHAR AS value FROM ({ORACLES[prefix + _STORED[module]]})"""
    for kind, prefix, modules in (("asset", "", plan.ASSET_MODULES), ("ul", "ul_", plan.UL_MODULES)) for module in modules)
ORACLES["ul_pipeline_equity"] = ORACLES["ul_equity_risk"]


def _from_text(oracle):
    """The same SQL over what the text files hold."""
    return ORACLES[oracle].replace(sql.POSITIONS, sql.POSITIONS_TEXT).replace(sql.HOLDINGS, sql.HOLDINGS_TEXT)


ORACLES["text_pipeline"] = _from_text("market_risk_pipeline")
ORACLES["text_pipeline_equity"] = _from_text("equity_risk")
