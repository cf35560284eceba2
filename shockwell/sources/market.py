"""Market data: risk-free curves, exchange rates, symmetric adjustment."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shockwell import fixed_values as fv
from shockwell.functions.dates import quarter_end
from shockwell.parameters import Parameters, ReportingPeriod

SHOCKS = ("base", "up", "down")


# ------------------------------------------------------------------- curves

def curve_long(wide: DataFrame, term: str, shock: str) -> DataFrame:
    """One sheet (a row per term, a column per curve) as long rows
    ``(shock, pos, curve_code, term, rate)``; ``pos`` is the column's place."""
    codes = [c for c in wide.columns if c != term]
    long = wide.unpivot([term], [F.col(f"`{c}`") for c in codes], "curve_code", "rate")
    place = F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("curve_code")) - 1
    return long.filter(F.col("rate").isNotNull()).select(
        F.lit(shock).alias("shock"),
        place.cast("int").alias("pos"),
        "curve_code",
        F.col(term).cast("int").alias("term"),
        "rate",
    )


def curves_from_sheets(base: DataFrame, up: DataFrame, down: DataFrame, term: str) -> DataFrame:
    sheets = [curve_long(s, term, shock) for s, shock in zip((base, up, down), SHOCKS)]
    return sheets[0].unionByName(sheets[1]).unionByName(sheets[2])


def curve_prefix_rows(curves: DataFrame, params: Parameters) -> DataFrame:
    """Curve codes with the currencies whose prefix they start with.

    Prefixes have few lengths, so the test is an exact lookup of each cut of
    the code in a literal map, not a comparison of every pair.
    """
    currencies: dict[str, list[str]] = {}
    for currency, prefix in params.curve_prefixes():
        currencies.setdefault(prefix, []).append(currency)
    lengths = sorted({len(p) for p in currencies})
    cuts = F.explode(F.array(*[F.substring("curve_code", 1, n) for n in lengths]))
    entries = [x for p, cs in currencies.items() for x in (F.lit(p), F.array(*map(F.lit, cs)))]
    owners = F.try_element_at(F.create_map(*entries), F.col("_cut"))
    return (
        curves.select("shock", "pos", "curve_code", "term", "rate", cuts.alias("_cut"))
        .withColumn("curve_currency", F.explode(owners))
        .drop("_cut")
    )


def curve_for_currency(curves: DataFrame, params: Parameters) -> DataFrame:
    """``(shock, curve_currency, curve_code, pos)``: the first matching curve of
    each currency in each sheet."""
    return (
        curve_prefix_rows(curves, params)
        .groupBy("shock", "curve_currency")
        .agg(F.min(F.struct("pos", "curve_code")).alias("_first"))
        .select("shock", "curve_currency", "_first.curve_code", "_first.pos")
    )


def curve_table(curves: DataFrame, params: Parameters) -> DataFrame:
    """``(curve_currency, term, base, base_next, up, up_next, down, down_next)``.

    Unique per listed currency and term 1..150: its size is bounded by the
    parameters.  ``x_next`` is the rate one term later.
    """
    candidates = curve_prefix_rows(curves, params).filter(
        F.col("term").between(fv.FIRST_TERM, fv.LAST_TERM)
    )
    chosen = curve_for_currency(curves, params).select("shock", "curve_currency", "pos")
    rates = candidates.join(chosen, ["shock", "curve_currency", "pos"], "left_semi")
    points = rates.groupBy("curve_currency", "term").agg(
        *[F.max(F.when(F.col("shock") == s, F.col("rate"))).alias(s) for s in SHOCKS]
    )
    along = Window.partitionBy("curve_currency").orderBy("term")
    adjacent = F.lead("term").over(along) == F.col("term") + 1
    return points.select(
        "*", *[F.when(adjacent, F.lead(s).over(along)).alias(f"{s}_next") for s in SHOCKS]
    )


# ----------------------------------------------------------------------- fx

def fx_long(wide: DataFrame, date: str) -> DataFrame:
    """Rate sheet (a row per day, a column per currency) as long rows."""
    codes = [c for c in wide.columns if c != date]
    return wide.unpivot([date], [F.col(f"`{c}`") for c in codes], "currency", "rate").select(
        F.col(date).alias("rate_date"), "currency", "rate"
    )


def fx_sheet(sheet: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """``(rates (rate_date, currency, rate), units (currency, unit))`` of a sheet
    with a column per currency.  The row without a date holds the units in
    which a currency is quoted; a currency may lack one."""
    units = fx_long(sheet.filter(F.col(date).isNull()), date).select("currency", F.col("rate").alias("unit"))
    return fx_long(sheet.filter(F.col(date).isNotNull()), date), units.filter("unit IS NOT NULL")


def fx_month(rates: DataFrame, period: ReportingPeriod) -> DataFrame:
    """Rates of the reporting month with the date as ``yyyy.MM.dd`` text.

    The range test on the plain column reaches the file scan.
    """
    start = datetime.date(period.year, period.month, 1)
    end = F.last_day(F.lit(start))
    return rates.filter((F.col("rate_date") >= F.lit(start)) & (F.col("rate_date") <= end)).select(
        F.date_format("rate_date", "yyyy.MM.dd").alias("rate_day"), "rate_date", "currency", "rate"
    )


def fx_asof(month: DataFrame, units: DataFrame, base: str = fv.BASE_CURRENCY) -> DataFrame:
    """``(currency, rate)`` of the month's last day, times the currency's unit.

    Currencies without a rate on that day and the base currency have no row; a
    currency with a rate but no unit has one without rate.  Raises when the
    month has no rates.
    """
    last = month.agg(F.max("rate_date").alias("d")).select(
        F.when(F.col("d").isNull(), F.raise_error(F.lit("no exchange rates in the reporting month")))
        .otherwise(F.col("d"))
        .alias("d")
    )
    return (
        month.filter(F.col("rate_date") == last.scalar())
        .filter(F.col("rate").isNotNull() & (F.col("currency") != base))
        .join(units, "currency", "left")
        .select("currency", (F.col("rate") * F.col("unit")).alias("rate"))
    )


# --------------------------------------------------- symmetric adjustment etc.

def symmetric_adjustment(table: DataFrame, day: Column) -> DataFrame:
    """One row, ``symmetric_adjustment``: the value of the last period that
    ended on or before ``day``."""
    return table.filter(F.col("period_end") <= day).agg(
        F.max_by("value", "period_end").alias("symmetric_adjustment")
    )


def reporting_dates(periods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(periods with period_end, rejected periods)`` of ``(year, month)`` rows."""
    dated = periods.withColumn("period_end", quarter_end(F.col("year"), F.col("month")))
    return (
        dated.filter(F.col("period_end").isNotNull()),
        dated.filter(F.col("period_end").isNull()).drop("period_end"),
    )
