"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shockwell.operators import holdings as hold
from shockwell.operators import positions as pos

from fixtures import views


def r(column: str, digits: int = 4) -> Column:
    """Rounded so that two engines agree although they add in another order.

    A nudge far below the last digit moves exact halves off the rounding
    boundary; adding zero turns a negative zero into zero.
    """
    return F.expr(f"round(cast(`{column}` AS DOUBLE) + 1e-{digits + 3}D, {digits}) + 0.0D AS `{column}`")


def rs(expression: str, name: str | None = None, digits: int = 4) -> str:
    """The same in DuckDB SQL."""
    nudged = f"({expression})::DOUBLE + 1e-{digits + 3}::DOUBLE"
    return f"round({nudged}, {digits}) + 0.0::DOUBLE AS {name or expression}"


def order_columns() -> list[Column]:
    """The holding's identity, spelled out."""
    return [F.col(f"holding_ord.{c}").cast("bigint").alias(c)
            for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy")]


ORDER_SQL = ("l_orderkey::BIGINT AS l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
             "l_partkey::BIGINT AS l_partkey, l_suppkey::BIGINT AS l_suppkey, copy::BIGINT AS copy")


def fund_facts(spark, sf_dir):
    """Facts per fund, stored once per session and folder: every query reads them."""
    return views.stored(spark, sf_dir, "fund_facts", lambda *_: hold.fund_facts(views.holdings(spark, sf_dir)))


def flagged(spark, sf_dir, kind=None, facts=None):
    """Positions with the look-through flags of their security, stored once as a run does."""

    def build(*_):
        return pos.flagged_positions(views.positions(spark, sf_dir, kind), facts or fund_facts(spark, sf_dir))

    return views.stored(spark, sf_dir, f"flagged_{kind}", build)


def module_frame(spark, sf_dir, kind, facts=None, only_types=None):
    """The frame the stress modules run on."""
    return pos.module_frame(
        flagged(spark, sf_dir, kind, facts), views.holdings(spark, sf_dir), kind,
        facts or fund_facts(spark, sf_dir), only_types=only_types,
    )


def calc_frame(spark, sf_dir, kind, facts=None):
    """The full look-through frame."""
    return pos.calc_frame(
        flagged(spark, sf_dir, kind, facts), views.holdings(spark, sf_dir), kind,
        facts or fund_facts(spark, sf_dir),
    )


def direct_rows(spark, sf_dir, kind, rules=pos.PositionRules(), facts=None):
    return pos.direct_rows(pos.unmatched_positions(flagged(spark, sf_dir, kind, facts)), kind, rules)
