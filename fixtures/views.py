"""Domain tables derived from the driver tables (see FIXTURES.md).

Positions and holdings are input files in real use, so they are derived once
per session and folder, over the whole driver tables, and stored; queries read
the stored table.  `sql.py` next to this file states the same derivations for
DuckDB.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shockwell import CalculationMatrix, Parameters, ReportingPeriod
from shockwell import fixed_values as fv
from shockwell.plans.storage import settled, work_folder
from shockwell.sources import tables

ANALYSIS_DATE = datetime.date(2001, 12, 31)
FX_PERIOD = ReportingPeriod(2001, 6)
SYMMETRIC_ADJUSTMENT = 0.0146

COUNTRIES = "AT BE BG HR CY CZ DK EE FI FR DE GR HU IS IE IT BR CN NO PL PT RO US JP GB".split()
CURRENCIES = (
    "EUR EUR BGN HRK EUR CZK DKK EUR EUR EUR EUR EUR HUF ISK EUR EUR BRL CNY NOK PLN EUR RON "
    "USD JPY GBP"
).split()
HOLDING_CURRENCIES = "EUR HUF USD GBP CHF EUR EUR XXX".split()
CURVE_NAMES = "EUR BG HR CZ DK HU IS LI NO PL RO SE UK US JP".split()

# Our own calculation matrix; the real one is the user's.
FLAGGED = {
    "equity": ["3L", "3X", "4", "A", "B", "C", "D", "E", "F"],
    "interest": ["1", "2", "5", "6", "8"],
    "spread": ["2", "5", "6", "8"],
    "currency": ["1", "2", "3L", "3X", "4", "5", "6", "8"],
    "concentration": ["1", "2", "3L", "3X", "4", "5", "6", "8"],
    "property": ["9"],
}
PARAMS = Parameters()
MATRIX = CalculationMatrix({m: frozenset(t) for m, t in FLAGGED.items()})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_at(codes: list, index: str) -> str:
    """SQL text: the code at a position counted from zero."""
    return f"element_at(array({', '.join(map(repr, codes))}), cast({index} AS INT) + 1)"


def letter_at(text: str, index: str) -> str:
    return f"substring('{text}', cast({index} AS INT) + 1, 1)"


_stored: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The derived table from the work folder, written on first use.

    The driver files may hold all rows in one block; the derivations' joins deal
    their narrow rows out, so the wide ones are written where they are made.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = settled(build(spark, sf_dir), name)
    return _stored[key]


def positions(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """All positions, or those of the ``asset`` or ``ul`` list."""
    rows = stored(spark, sf_dir, "positions", derive_positions)
    return (rows if kind is None else rows.filter(F.col("list") == kind)).drop("list")


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "holdings", derive_holdings)


def derive_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per order; the UL list is the orders with status P."""
    rows = table(spark, sf_dir, "orders").hint("merge").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).withColumnsRenamed({"o_orderkey": "k", "c_nationkey": "n"})
    return rows.selectExpr(
        "c_mktsegment AS portfolio_group",
        "concat('S', k div 2) AS portfolio_id",
        f"DATE '{ANALYSIS_DATE}' AS analysis_date",
        "concat(if(k % 7 = 0, 'HGB ', 'SEC '), k) AS security_name",
        f"{code_at(COUNTRIES, 'n')} AS country",
        """CASE left(o_orderpriority, 1) WHEN '1' THEN 'AAA' WHEN '2' THEN 'AA-' WHEN '3' THEN 'BBB +'
           WHEN '4' THEN 'NR' ELSE if(k % 2 = 0, 'CCC', NULL) END AS rating""",
        f"""if(k % 97 = 0, 'X1', concat({code_at(COUNTRIES, 'n')},
            {letter_at('1234567833ABCDEF09', 'k % 18')}, '1')) AS cic_of_instrument""",
        """CASE k % 11 WHEN 0 THEN '645 FX' WHEN 1 THEN '996 Deposit' WHEN 2 THEN '950 Strategic'
           WHEN 3 THEN '995 Other' ELSE '100 General' END AS asset_allocation""",
        f"{code_at(CURRENCIES, 'n')} AS currency",
        "if(k % 13 = 0, NULL, date_add(cast(o_orderdate AS DATE), cast(k % 40 * 365 AS INT))) AS exp_maturity_date",
        "o_totalprice / 100 AS balance_nominal",
        "if(k % 19 = 0, NULL, (k % 250) / 10.0D) AS modified_duration",
        "if(k % 101 = 0, NULL, o_totalprice) AS dirty_value_pc",
        "k AS position_ord",
        "if(o_orderstatus = 'P', 'ul', 'asset') AS list",
    )


def derive_holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One holding per lineitem, some of them twice.

    Fourteen orders in a row make seven securities and share five funds, so
    that two securities in seven have no holdings.  The join leaves a fund's
    holdings together, so sums per fund are nearly whole before they are shuffled.
    """
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "*", f"7 * (l_orderkey div 14) + {code_at([0, 1, 3, 4, 6], 'l_orderkey % 5')} AS f"
    )
    sums = lines.groupBy("f").agg(F.sum("l_extendedprice").alias("fund_sum"))
    coded = lines.hint("merge").join(sums, "f").withColumnsRenamed({"l_partkey": "p", "l_suppkey": "s"}).selectExpr(
        "*",
        f"""CASE WHEN p % 60 = 7 THEN {letter_at('ABCDEF', 's % 6')}
            WHEN p % 61 = 5 THEN 'L' WHEN p % 67 = 5 THEN '0'
            ELSE {letter_at('122456783333331278', 'p % 18')} END AS c1""",
        "if(p % 23 = 0, NULL, cast(l_linenumber % 5 AS INT)) AS economic_zone",
    )
    rows = coded.selectExpr(
        "concat('S', f) AS portfolio_id",
        f"DATE '{ANALYSIS_DATE}' AS valuation_date",
        "if(f % 19 = 0, NULL, cast(f % 10 AS DOUBLE)) AS portfolio_mod_dur",
        "if(f % 5 = 0, 'N', 'Y') AS scr_delivery",
        f"if(p % 71 = 0, 'HU1', concat({code_at(COUNTRIES, 's % 25')}, c1, '1')) AS cic_of_underlying",
        "economic_zone",
        "concat('U', p % 40) AS id_of_underlying",
        "concat(if(p % 9 = 0, 'EIB ', 'UND '), p) AS name_of_underlying",
        f"{code_at(HOLDING_CURRENCIES, 's % 8')} AS qc_of_underlying",
        "if(p % 211 = 0, NULL, l_extendedprice / fund_sum * if(f % 29 = 0, 0.9D, 1.0D)) AS valuation_weight",
        "if(p % 37 = 0, NULL, date_add(cast(l_shipdate AS DATE), cast(p % 40 * 365 AS INT))) AS maturity_date",
        "if(p % 41 = 0, NULL, cast(cast(l_quantity % 8 AS INT) AS STRING)) AS cqs",
        "l_quantity / 2 AS mod_dur_of_underlying",
        """CASE WHEN p % 83 = 0 THEN '9'
           WHEN c1 = '3' THEN if(coalesce(economic_zone IN (1, 2), false), '3L', '3X')
           ELSE c1 END AS underlying_asset_category""",
        "explode(if(f % 31 = 0 AND p % 2 = 0, array(0, 1), array(0))) AS copy",
        "l_orderkey", "l_linenumber", "p AS l_partkey", "s AS l_suppkey", "l_quantity", "l_extendedprice",
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "copy"]
    return rows.withColumn("holding_ord", F.struct(*order)).drop(*order)


_texts: dict[tuple[str, str, str], str] = {}


def text_file(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Path of a derived table written as CSV text, once per session and folder.

    The ordering shuffle bounds the files' sizes, so none needs to be split when it is read.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _texts:
        path = f"{work_folder(spark)}/{name}"
        build(spark, sf_dir).write.options(header=True, encoding="ISO-8859-1", quote='"', escape='"', compression="gzip").csv(path)
        _texts[key] = path
    return _texts[key]


def tpt_text(spark: SparkSession, sf_dir: str, part: int):
    """Fund file text: decimal commas, dotted dates, unused columns.  Rows
    without a credit step lack the fund id.  Every third part key is in the
    second part, which has no maturity column.  Rows stand in key order."""
    rows = holdings(spark, sf_dir).filter(f"(holding_ord.l_partkey % 3 = 0) = {part == 1}").orderBy("holding_ord")
    cells = {
        **{c: F.replace(F.col(c).cast("string"), F.lit("."), F.lit(",")) for c in tables.HOLDING_NUMBERS},
        **{c: F.date_format(c, "dd.MM.yyyy") for c in tables.HOLDING_DATES},
        "portfolio_id": F.when(F.col("cqs").isNotNull(), F.col("portfolio_id")),
    }
    text = rows.select(
        F.lit("\u00e9").alias("0_Unused"),
        *[cells.get(c, F.col(c)).cast("string").alias(h) for h, c in fv.TPT_HEADERS.items()])
    return text.drop("39_Maturity_date") if part == 1 else text


def position_text(spark: SparkSession, sf_dir: str, kind: str):
    """Position list text: dates as text or day number, some cells that do not
    parse, and names with a line break, which cut their record in two."""
    k = F.col("position_ord")
    serial = F.datediff("exp_maturity_date", F.lit("1899-12-30").cast("date")).cast("string")
    cells = {
        "analysis_date": F.date_format("analysis_date", "yyyy.MM.dd"),
        "exp_maturity_date": F.when(k % 2 == 0, serial).otherwise(F.date_format("exp_maturity_date", "yyyy.MM.dd")),
        "modified_duration": F.when(k % 37 == 0, "2,5").when(k % 41 == 0, "3d").otherwise(F.col("modified_duration").cast("string")),
        "security_name": F.when(k % 101 == 0, F.concat(F.col("security_name"), F.lit("\nsecond line"))).otherwise(F.col("security_name")),
    }
    headers = fv.ASSET_HEADERS if kind == "asset" else fv.UL_HEADERS
    return positions(spark, sf_dir, kind).orderBy("position_ord").select(
        *[cells.get(c, F.col(c)).cast("string").alias(h) for h, c in headers.items()])


def curves(spark: SparkSession) -> DataFrame:
    """Closed-form curves of the three sheets, 15 codes, terms 1..150."""
    names = ", ".join(map(repr, CURVE_NAMES))
    points = spark.range(1, 151).selectExpr("cast(id AS INT) AS term", f"posexplode(array({names})) AS (pos, name)")
    rates = points.selectExpr("*", "0.02D + 0.0001D * term + 0.001D * pos AS b").selectExpr(
        "pos", "term", "concat(name, '_31_12_2001_SWP') AS curve_code",
        "explode(map('base', b, 'up', 1.5D * b + 0.01D, 'down', 0.6D * b)) AS (shock, rate)",
    )
    return rates.select("shock", "pos", "curve_code", "term", "rate")


def fx_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rates in long form: largest order per day and customer currency,
    missing where that is small."""
    rows = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).selectExpr(
        "cast(o_orderdate AS DATE) AS rate_date",
        f"{code_at(CURRENCIES, 'c_nationkey')} AS currency",
        "o_totalprice / 1000 AS m",
    )
    top = rows.groupBy("rate_date", "currency").agg(F.max("m").alias("m"))
    return top.selectExpr("rate_date", "currency", "if(m > 60, m, NULL) AS rate")


FX_UNITS = {c: 100.0 if c == "JPY" else 1.0 for c in sorted(set(CURRENCIES)) if c != "CNY"}


def fx_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rates as a sheet: units in a row without date (one currency lacks
    its unit), then a row per day, a column per currency."""
    codes = sorted(set(CURRENCIES))
    days = fx_table(spark, sf_dir).groupBy("rate_date").pivot("currency", codes).agg(F.max("rate"))
    units = spark.range(1).select(
        F.lit(None).cast("date").alias("rate_date"), *[F.lit(FX_UNITS.get(c)).cast("double").alias(c) for c in codes])
    return units.unionByName(days)
