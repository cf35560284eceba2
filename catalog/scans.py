"""Queries on sources, cleaning and typing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import ORDER_SQL, order_columns, r, rs
from fixtures import sql, views
from shockwell import fixed_values as fv
from shockwell.functions import cleaning
from shockwell.operators.spread import duration_bucket, matrix_rows, step_number
from shockwell.sources import market, tables


def _raw(df, headers, order):
    """Typed domain table under its raw headers; some rows lack the id."""
    return df.select(*[F.col(c).alias(h) for h, c in headers.items()], order)


def _raw_tpt(spark, sf_dir):
    typed = views.holdings(spark, sf_dir)
    no_id = typed.withColumn("portfolio_id", F.when(F.col("cqs").isNotNull(), F.col("portfolio_id")))
    return _raw(no_id, fv.TPT_HEADERS, "holding_ord").withColumn("2_Unused", F.lit("x"))


def read_holdings(spark, sf_dir):
    """``(typed holdings, rejects)`` of the fund file's two text parts, broken records among the rejects."""
    paths = [views.text_file(spark, sf_dir, f"tpt_{p}.csv", lambda s, d, p=p: views.tpt_text(s, d, p)) for p in (0, 1)]
    raw = tables.read_tpt(spark, paths)
    typed, rejects = tables.type_holdings(tables.project_tpt(raw))
    return typed, rejects.unionByName(tables.corrupt_records(raw, "holdings"))


def read_positions(spark, sf_dir, kind):
    """``(typed positions, rejects)`` of a list's text, broken records among the rejects."""
    path = views.text_file(spark, sf_dir, f"{kind}.csv", lambda s, d: views.position_text(s, d, kind))
    raw = tables.read_raw(spark, path, order="position_ord")
    project = tables.project_asset_list if kind == "asset" else tables.project_ul_list
    typed, rejects = tables.type_positions(project(raw))
    return typed, rejects.unionByName(tables.corrupt_records(raw, "positions"))


def tpt_scan(spark, sf_dir):
    """The fund file from text: scan, number, stack, project, clean, type."""
    typed = read_holdings(spark, sf_dir)[0]
    return typed.select(*[c for c in fv.TPT_HEADERS.values() if c != "valuation_weight"], r("valuation_weight", 8), "holding_ord")


def _list_scan(kind):
    def query(spark, sf_dir):
        return read_positions(spark, sf_dir, kind)[0].select(*fv.ASSET_HEADERS.values(), "position_ord")

    return query


def position_cast_rejects(spark, sf_dir):
    """Cells and records that typing sets aside; of broken records the whole text."""
    both = [read_positions(spark, sf_dir, k)[1].withColumn("list", F.lit(k)) for k in ("asset", "ul")]
    return both[0].unionByName(both[1])


def union_parts(spark, sf_dir):
    first = _raw_tpt(spark, sf_dir)
    both = tables.union_parts([first, first.drop("39_Maturity_date")], tables.TPT_ID)
    return both.groupBy(F.col(tables.TPT_ID).alias("portfolio_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("`39_Maturity_date`").alias("n_maturities")
    )


def tpt_project(spark, sf_dir):
    typed = tables.project_tpt(_raw_tpt(spark, sf_dir))
    names = [c for c in fv.TPT_HEADERS.values() if c != "valuation_weight"]
    return typed.select(*order_columns(), *names, r("valuation_weight", 8))


def _position_project(headers, project, kind):
    def query(spark, sf_dir):
        raw = _raw(views.positions(spark, sf_dir, kind), headers, "position_ord")
        return project(raw.withColumn("Unused", F.lit(1)))

    return query


def param_matrix_rows(spark, sf_dir):
    """Every matrix cell with the number of holdings that read it."""
    step = step_number(F.col("cqs"))
    used = (
        views.holdings(spark, sf_dir)
        .select(step.alias("step"), duration_bucket("mod_dur_of_underlying").alias("duration_row"))
        .filter("step IS NOT NULL")
        .groupBy("step", "duration_row")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.when(F.col("step") == 7, "unrated").otherwise("rated").alias("family"),
            F.when(F.col("step") == 7, 0).when(F.col("step") == 6, 4).otherwise(F.col("step")).alias("step_column"),
            "duration_row", "n",
        )
        .groupBy("family", "step_column", "duration_row").agg(F.sum("n").alias("n"))
    )
    cells = matrix_rows(spark, views.PARAMS).withColumn("family", F.split("matrix", "_")[0])
    return cells.join(used, ["family", "step_column", "duration_row"], "left").select(
        "matrix",
        F.col("duration_row").cast("bigint").alias("duration_row"),
        F.col("step_column").cast("bigint").alias("step_column"),
        "value",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_holdings"),
    )


def _matrix_values():
    p = views.PARAMS
    rows = [
        f"('{name}','{name.split('_')[0]}',{i},{j},{v}::DOUBLE)"
        for name, m in (("rated_a", p.rated_a), ("rated_b", p.rated_b),
                        ("unrated_a", p.unrated_a), ("unrated_b", p.unrated_b))
        for i, line in enumerate(m) for j, v in enumerate(line)
    ]
    return ",".join(rows)


def curve_long(spark, sf_dir):
    """Wide sheets of top prices by term and curve, turned to long rows."""
    lines = views.table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 150 + 1).cast("int").alias("term"),
        F.expr(views.code_at(views.CURVE_NAMES, "l_suppkey % 15")).alias("code"),
        "l_extendedprice",
    )
    base = lines.groupBy("term").pivot("code", views.CURVE_NAMES).agg(
        F.max("l_extendedprice") / 1000
    )
    up = base.select("term", *[(F.col(c) + 1).alias(c) for c in views.CURVE_NAMES])
    down = base.select("term", *[(F.col(c) - 1).alias(c) for c in views.CURVE_NAMES])
    return market.curves_from_sheets(base, up, down, "term").select(
        "shock", F.col("pos").cast("bigint").alias("pos"), "curve_code",
        F.col("term").cast("bigint").alias("term"), r("rate"),
    )


def fx_month_filter(spark, sf_dir):
    rates, _ = market.fx_sheet(views.fx_sheet(spark, sf_dir), "rate_date")
    return market.fx_month(rates, views.FX_PERIOD)


def fx_asof(spark, sf_dir):
    rates, units = market.fx_sheet(views.fx_sheet(spark, sf_dir), "rate_date")
    return market.fx_asof(market.fx_month(rates, views.FX_PERIOD), units)


def _adjustments(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    quarter = F.last_day(F.add_months(F.trunc(day, "quarter"), 2))
    return views.table(spark, sf_dir, "orders").groupBy(quarter.alias("period_end")).agg(
        F.round(F.avg("o_totalprice") / 1e6, 4).alias("value")
    )


def sym_adj_lookup(spark, sf_dir):
    day = F.to_date(F.lit("2001-06-15"))
    return market.symmetric_adjustment(_adjustments(spark, sf_dir), day)


def quarter_end(spark, sf_dir):
    months = views.table(spark, sf_dir, "orders").groupBy(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.count(F.lit(1)).alias("n_orders"))
    accepted, rejected = market.reporting_dates(months)
    both = accepted.unionByName(rejected, allowMissingColumns=True)
    return both.select(
        F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"),
        "period_end", "n_orders",
    )


# ----------------------------------------------------------------- cleaning

def clean_text(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    bell, delete, tab = (F.char(F.lit(n)) for n in (7, 127, 9))
    raw = orders.select(
        F.when(k % 50 == 0, "").when(k % 51 != 0, F.concat(F.lit("S"), bell, k.cast("string"))).alias("portfolio_id"),
        F.concat(tab, F.col("o_orderpriority"), delete).alias("name"),
        k.alias("o_orderkey"),
    )
    return tables.clean_text(raw)


def _price_text(comma=True):
    text = F.col("l_extendedprice").cast("string")
    return F.when(F.col("l_partkey") % 10 == 3, "n.a.").when(F.col("l_partkey") % 10 == 4, "1,2,3").when(
        F.col("l_partkey") % 10 == 5, "12d"
    ).otherwise(
        F.replace(text, F.lit("."), F.lit(",")) if comma else text
    )


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_SQL = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def decimal_comma_cast(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    return lines.select(*LINE_KEY, cleaning.to_number(_price_text()).alias("value"))


def date_parse(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    dotted = F.when(F.col("l_partkey") % 10 < 6, F.date_format(day, "dd.MM.yyyy")).otherwise(
        F.when(F.col("l_partkey") % 10 < 8, F.date_format(day, "d.M.yyyy")).otherwise("31.02.2001")
    )
    other = F.when(F.col("l_partkey") % 10 < 6, F.date_format(day, "yyyy.MM.dd")).otherwise(
        F.when(F.col("l_partkey") % 10 < 8, F.date_format(day, "yyyy.M.d")).otherwise("2001-01-02")
    )
    return lines.select(
        *LINE_KEY,
        cleaning.day_first_date(dotted).alias("day_first"),
        cleaning.year_first_date(other).alias("year_first"),
    )


def excel_serial_date(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    cell = (
        F.when(F.col("l_partkey") % 4 == 0, serial)
        .when(F.col("l_partkey") % 4 == 1, F.concat(serial, F.lit(".75")))
        .when(F.col("l_partkey") % 4 == 2, F.date_format(day, "yyyy.MM.dd"))
        .when(F.col("l_suppkey") % 2 == 0, F.concat(serial, F.lit("f")))
        .otherwise("soon")
    )
    return lines.select(*LINE_KEY, cleaning.serial_or_date(cell).alias("maturity_date"))


def int_coerce(spark, sf_dir):
    lines = views.table(spark, sf_dir, "lineitem")
    p, q = F.col("l_partkey") % 4, F.col("l_quantity").cast("int").cast("string")
    cell = (
        F.when(p == 0, q).when(p == 1, F.concat(q, F.lit(".0"))).when(p == 2, F.concat(q, F.lit(".5"))).when(
            F.col("l_suppkey") % 2 == 0, F.concat(q, F.lit("D"))
        ).otherwise("EU")
    )
    return lines.select(*LINE_KEY, cleaning.to_whole_number(cell).cast("bigint").alias("zone"))


def cast_rejects(spark, sf_dir):
    """Fund file text with broken cells: what the typing step sets aside."""
    raw = views.holdings(spark, sf_dir).select(
        "*", F.col("holding_ord.l_partkey").alias("p"), F.col("holding_ord.l_linenumber").alias("line")
    )
    comma = {c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(",")) for c in tables.HOLDING_NUMBERS}
    comma["valuation_weight"] = F.when(F.col("p") % 7 == 0, "ten percent").otherwise(comma["valuation_weight"])
    comma["mod_dur_of_underlying"] = F.when(F.col("p") % 11 == 0, "4,5 years").when(
        F.col("p") % 11 == 1, F.concat(F.col("line").cast("string"), F.lit("d"))
    ).otherwise(comma["mod_dur_of_underlying"])
    zone = (
        F.when(F.col("p") % 5 == 0, F.concat(F.col("line").cast("string"), F.lit(".5")))
        .when(F.col("p") % 5 == 1, "EEA")
        .otherwise(F.col("economic_zone").cast("string"))
    )
    text = raw.withColumns({
        **comma, "economic_zone": zone,
        **{c: F.date_format(c, "dd.MM.yyyy") for c in tables.HOLDING_DATES},
    }).select(*fv.TPT_HEADERS.values(), "holding_ord")
    return tables.type_holdings(text)[1]


QUERIES = {
    "tpt_scan": tpt_scan,
    "asset_scan": _list_scan("asset"),
    "ul_scan": _list_scan("ul"),
    "position_cast_rejects": position_cast_rejects,
    "union_parts": union_parts,
    "tpt_project": tpt_project,
    "asset_project": _position_project(fv.ASSET_HEADERS, tables.project_asset_list, "asset"),
    "ul_project": _position_project(fv.UL_HEADERS, tables.project_ul_list, "ul"),
    "param_matrix_rows": param_matrix_rows,
    "curve_long": curve_long,
    "fx_month_filter": fx_month_filter,
    "fx_asof": fx_asof,
    "sym_adj_lookup": sym_adj_lookup,
    "quarter_end": quarter_end,
    "clean_text": clean_text,
    "decimal_comma_cast": decimal_comma_cast,
    "date_parse": date_parse,
    "excel_serial_date": excel_serial_date,
    "int_coerce": int_coerce,
    "cast_rejects": cast_rejects,
}

_no_id = "CASE WHEN cqs IS NOT NULL THEN portfolio_id END"


def _tpt(names, where=""):
    cells = []
    for header, c in fv.TPT_HEADERS.items():
        name = header if names == "raw" else c
        value = _no_id if c == "portfolio_id" else c
        cells.append(rs(value, f'"{name}"', 8) if c == "valuation_weight" else f'{value} AS "{name}"')
    return sql.with_(sql.HOLDINGS) + f"SELECT {ORDER_SQL}, {', '.join(cells)} FROM holdings {where}"


def _position_columns(kind):
    names = ", ".join([*fv.ASSET_HEADERS.values(), "position_ord"])
    return sql.with_(sql.POSITIONS) + f"SELECT {names} FROM all_positions WHERE kind = '{kind}'"


_price_sql = ("CASE l_partkey % 10 WHEN 3 THEN 'n.a.' WHEN 4 THEN '1,2,3' WHEN 5 THEN '12d' "
              "ELSE replace(l_extendedprice::VARCHAR, '.', ',') END")

ORACLES = {
    "tpt_scan": sql.with_(sql.HOLDINGS_TEXT) + f"""SELECT {', '.join(
        rs(c, c, 8) if c == 'valuation_weight' else c for c in fv.TPT_HEADERS.values())}, holding_ord FROM holdings""",
    **{f"{kind}_scan": sql.with_(sql.POSITIONS_TEXT) + f"""SELECT {', '.join(fv.ASSET_HEADERS.values())}, position_ord
      FROM all_positions WHERE kind = '{kind}'""" for kind in ("asset", "ul")},
    "position_cast_rejects": sql.with_(sql.POSITIONS) + """, text AS (SELECT *,
        CASE WHEN position_ord % 37 = 0 THEN '2,5' WHEN position_ord % 41 = 0 THEN '3d' END AS bad FROM all_positions),
      cut AS (SELECT * FROM text WHERE position_ord % 101 = 0)
      SELECT 'positions' AS module, 'cannot convert modified_duration' AS reason, portfolio_id,
        NULL::VARCHAR AS id_of_underlying, bad AS raw_value, kind AS list
      FROM text WHERE bad IS NOT NULL AND position_ord % 101 <> 0
      UNION ALL SELECT 'positions', 'record does not have the columns of the header', NULL, NULL,
        portfolio_group || ',' || portfolio_id || ',2001.12.31,"' || security_name, kind FROM cut
      UNION ALL SELECT 'positions', 'record does not have the columns of the header', NULL, NULL, 'second line",' || concat_ws(',',
        country, coalesce(rating, ''), cic_of_instrument, asset_allocation, currency,
        coalesce(CASE WHEN position_ord % 2 = 0 THEN (exp_maturity_date - DATE '1899-12-30')::VARCHAR
          ELSE strftime(exp_maturity_date, '%Y.%m.%d') END, ''),
        coalesce(balance_nominal::VARCHAR, ''),
        CASE bad WHEN '2,5' THEN '"2,5"' ELSE coalesce(bad, modified_duration::VARCHAR, '') END, ''), kind FROM cut""",
    "union_parts": sql.with_(sql.HOLDINGS) + """SELECT portfolio_id, 2 * count(*) AS n_rows,
        count(maturity_date) AS n_maturities FROM holdings WHERE cqs IS NOT NULL GROUP BY 1""",
    "tpt_project": _tpt("new"),
    "asset_project": _position_columns("asset"),
    "ul_project": _position_columns("ul"),
    "param_matrix_rows": sql.with_(sql.HOLDINGS) + f"""SELECT m.matrix, m.i::BIGINT AS duration_row,
        m.j::BIGINT AS step_column, m.v AS value, count(h.step) AS n_holdings
      FROM (VALUES {_matrix_values()}) m(matrix, family, i, j, v)
      LEFT JOIN (SELECT cqs::INT AS step, CASE WHEN mod_dur_of_underlying < 5 THEN 0
          WHEN mod_dur_of_underlying < 10 THEN 1 WHEN mod_dur_of_underlying < 15 THEN 2
          WHEN mod_dur_of_underlying < 20 THEN 3 ELSE 4 END AS bucket
        FROM holdings WHERE cqs IS NOT NULL) h
      ON h.bucket = m.i AND CASE WHEN step > 6 THEN m.family = 'unrated'
        ELSE m.family = 'rated' AND m.j = CASE step WHEN 6 THEN 4 ELSE step END END
      GROUP BY ALL""",
    "curve_long": f"""WITH b AS (
        SELECT l_suppkey % 15 AS pos, l_partkey % 150 + 1 AS term, max(l_extendedprice) / 1000 AS rate
        FROM lineitem GROUP BY ALL)
      SELECT shock, pos::BIGINT AS pos, {sql._list(views.CURVE_NAMES)}[pos::INT + 1] AS curve_code,
        term::BIGINT AS term,
        {rs("CASE shock WHEN 'base' THEN rate WHEN 'up' THEN rate + 1 ELSE rate - 1 END", "rate")}
      FROM b, (VALUES ('base'), ('up'), ('down')) x(shock)""",
    "fx_month_filter": sql.with_(sql.FX) + "SELECT rate_day, rate_date, currency, rate FROM fx_month",
    "fx_asof": sql.with_(sql.FX) + "SELECT currency, rate FROM fx_asof",
    "sym_adj_lookup": """SELECT round(avg(o_totalprice) / 1e6::DOUBLE, 4) AS symmetric_adjustment FROM orders
      WHERE date_trunc('quarter', o_orderdate) = (
        SELECT max(date_trunc('quarter', o_orderdate)) FROM orders
        WHERE date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY <= DATE '2001-06-15')""",
    "quarter_end": """SELECT year(o_orderdate) AS year, month(o_orderdate) AS month,
        CASE WHEN month(o_orderdate) IN (3, 6, 9, 12) THEN any_value(last_day(o_orderdate))::DATE END AS period_end,
        count(*) AS n_orders FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",
    "clean_text": r"""SELECT 'S' || o_orderkey AS portfolio_id, o_orderpriority AS name, o_orderkey
      FROM orders WHERE o_orderkey % 50 <> 0 AND o_orderkey % 51 <> 0""",
    "decimal_comma_cast": f"""SELECT {LINE_SQL},
        TRY_CAST(replace({_price_sql}, ',', '.') AS DOUBLE) AS value FROM lineitem""",
    "date_parse": f"""SELECT {LINE_SQL}, CASE WHEN l_partkey % 10 < 8 THEN l_shipdate::DATE END AS day_first,
        CASE WHEN l_partkey % 10 < 8 THEN l_shipdate::DATE END AS year_first FROM lineitem""",
    "excel_serial_date": f"""SELECT {LINE_SQL},
        CASE WHEN l_partkey % 4 < 3 THEN l_shipdate::DATE END AS maturity_date FROM lineitem""",
    "int_coerce": f"""SELECT {LINE_SQL}, CASE WHEN l_partkey % 4 < 2 THEN l_quantity::BIGINT END AS zone
      FROM lineitem""",
    "cast_rejects": sql.with_(sql.HOLDINGS) + """SELECT 'holdings' AS module,
        'cannot convert ' || c AS reason, portfolio_id, id_of_underlying, raw_value FROM (
          SELECT 'valuation_weight' AS c, 'ten percent' AS raw_value, * FROM holdings WHERE l_partkey % 7 = 0
          UNION ALL SELECT 'mod_dur_of_underlying', '4,5 years', * FROM holdings WHERE l_partkey % 11 = 0
          UNION ALL SELECT 'mod_dur_of_underlying', l_linenumber || 'd', * FROM holdings WHERE l_partkey % 11 = 1
          UNION ALL SELECT 'economic_zone', l_linenumber || '.5', * FROM holdings WHERE l_partkey % 5 = 0)""",
}
