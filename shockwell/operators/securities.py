"""Roll-up of stressed rows to one row per security.

The roll-up has two levels.  The first adds numbers per security, text and
category, all of them grouping keys, so it is a hash aggregation with map-side
partial sums, and a fund of any size leaves every task as a few rows.  The
second brings what is left of a security together once, and picks texts and
categories there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.functions.aggregates import dominant

SECURITY = ["portfolio_id", "portfolio_group"]


def roll_up(
    rows: DataFrame,
    keys: Sequence[str],
    texts: Sequence[str],
    sums: Sequence[str],
    uniform: Sequence[str] = (),
    category: str | None = None,
    category_by: str = "value",
    gathered: bool = False,
) -> DataFrame:
    """One row per ``keys``.

    ``texts``: from the first position in list order.  ``sums``: added, missing
    values skipped.  ``uniform``: the common value of all rows, NULL when they
    differ; must be numbers.  ``category``: the one with the largest sum of
    ``category_by``.  ``gathered``: the input is stored with the rows of a
    security together (`storage.bucketed`), and nothing is exchanged.
    """
    first = f"min(struct(position_ord, {', '.join(texts)})) AS _first"
    added = [F.expr(f"sum({c}) AS {c}") for c in sums]
    bounds = [
        F.expr(f"{f}({c}_{bound}) AS {c}_{bound}")
        for c in uniform for f, bound in (("min", "low"), ("max", "high"), ("max", "gap"))
    ]
    common = [
        F.expr(f"if(min({c}_low) = max({c}_high) AND NOT max({c}_gap), min({c}_low), NULL) AS {c}")
        for c in uniform
    ]
    categories = [category] if category else []
    level = rows.groupBy(*keys, *texts, *categories).agg(
        F.expr("min(position_ord) AS position_ord"),
        *[F.expr(f"coalesce(sum({c}), 0.0D) AS {c}") for c in sums],
        *[F.expr(f"min({c}) AS {c}_low") for c in uniform],
        *[F.expr(f"max({c}) AS {c}_high") for c in uniform],
        *[F.expr(f"max({c} IS NULL) AS {c}_gap") for c in uniform],
    )
    if not gathered:
        level = level.repartition(*keys)  # serves both aggregations below
    if category is None:
        result = level.groupBy(*keys).agg(F.expr(first), *added, *common)
    else:
        # Categories add up over positions before they compete.
        per_category = level.groupBy(*keys, category).agg(F.expr(first), *added, *bounds)
        result = per_category.groupBy(*keys).agg(
            F.expr("min(_first) AS _first"), *added, *common,
            dominant(category, category_by).alias("_category"),
        ).withColumnRenamed("_category", category)
    return result.select(*keys, *[f"_first.{t}" for t in texts], *sums, *uniform, *categories)
