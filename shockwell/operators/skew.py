"""Joins on keys of which one may hold a large part of all rows.

A key with very many rows is split: its rows get a salt, and the matching rows
of the other side are repeated once per salt, so that several tasks share the
key.  Where both sides of a key are large, both are salted and the work, rows
times rows, is dealt out.

The list of split keys is broadcast, and arithmetic bounds it: a split key has
more than one in ``key_share`` of all rows (or joined rows), so there are fewer
than ``key_share`` such keys, some ten megabytes, whatever the data size.  A
key below that share is left whole; it is a small part of the whole work.
Results do not depend on which keys are split.

Salts are hashes of the row's own order key, never random numbers, so a task
that is run again after an executor loss sends every row to the same place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
SPLITS = "_splits"
LEFT_SALT, RIGHT_SALT = "_left_salt", "_right_salt"
LEFT_SPLITS, RIGHT_SPLITS = "_left_splits", "_right_splits"


@dataclass(frozen=True)
class SkewPolicy:
    """``rows_per_split``: rows of one key that a task should get, of an inner
    join of two large sides the joined rows.  ``key_share``: a key with a
    smaller share of all rows is never split.  ``null_splits`` spreads rows
    without a key, which have no partners to repeat."""

    rows_per_split: int = 2_000_000
    key_share: int = 200_000
    null_splits: int = 1_000_000


def above_share(counts: DataFrame, key: str, size: str, policy: SkewPolicy) -> DataFrame:
    """The keys with more than ``rows_per_split`` and more than one in ``key_share`` of all."""
    total = counts.agg(F.expr(f"coalesce(sum({size}), 0) AS total")).select("total").scalar()
    large = counts.filter(f"{size} > {policy.rows_per_split} AND {key} IS NOT NULL")
    return large.filter(F.col(size) > total / policy.key_share)


def hot_keys(counts: DataFrame, key: str, policy: SkewPolicy) -> DataFrame:
    """``(key, _splits)`` for the large keys of ``counts(key, n_rows)``."""
    splits = f"cast(ceil(n_rows / {policy.rows_per_split}) AS INT)"
    return above_share(counts, key, "n_rows", policy).selectExpr(key, f"{splits} AS {SPLITS}")


def row_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key; partial sums leave one row per key and task to shuffle."""
    return rows.groupBy(key).agg(F.expr("count(1) AS n_rows"))


def with_salt(rows: DataFrame, key: str, order: str, hot: DataFrame, policy: SkewPolicy) -> DataFrame:
    """Give each row of a split key one of its salts, any other row salt 0.

    Rows without a key match nothing, so they are spread freely.
    """
    salts = f"if({key} IS NULL, {policy.null_splits}, {SPLITS})"
    salt = f"cast(coalesce(pmod(xxhash64({order}), {salts}), 0) AS INT)"
    return rows.join(F.broadcast(hot), key, "left").withColumn(SALT, F.expr(salt)).drop(SPLITS)


def per_salt(rows: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat each row once per salt of its key."""
    salts = f"explode(sequence(0, coalesce({SPLITS}, 1) - 1))"
    return rows.join(F.broadcast(hot), key, "left").withColumn(SALT, F.expr(salts)).drop(SPLITS)


def split_join(
    many: DataFrame,
    few: DataFrame,
    key: str,
    how: str,
    order: str,
    hot: DataFrame,
    policy: SkewPolicy,
) -> DataFrame:
    """Join ``many`` (the side with hot keys) to ``few`` on ``key``.

    ``how`` may be inner, left, left_semi or left_anti, seen from ``many``:
    each of its rows meets every partner under exactly one salt.
    """
    left = with_salt(many, key, order, hot, policy)
    return left.join(per_salt(few, key, hot), [key, SALT], how).drop(SALT)


def hot_products(left_counts: DataFrame, right_counts: DataFrame, key: str, policy: SkewPolicy) -> DataFrame:
    """``(key, _left_splits, _right_splits)`` of the keys with many joined rows.

    A key's rows times rows are cut into cells of half of ``rows_per_split`` on
    average, which leaves room for uneven hashes.  The cells are about as wide
    as high in rows, so that repeating both sides costs least.
    """
    both = left_counts.selectExpr(key, "cast(n_rows AS DOUBLE) AS l").join(
        right_counts.selectExpr(key, "cast(n_rows AS DOUBLE) AS r"), key).selectExpr("*", "l * r AS joined")
    cells = f"2 * joined / {policy.rows_per_split}"
    wide = f"least(l, greatest(1D, ceil(sqrt({cells} * l / r))))"
    cut = above_share(both, key, "joined", policy).selectExpr("*", f"{wide} AS w")
    return cut.selectExpr(
        key, f"cast(w AS INT) AS {LEFT_SPLITS}", f"cast(least(r, greatest(1D, ceil({cells} / w))) AS INT) AS {RIGHT_SPLITS}")


def salted(rows: DataFrame, key: str, order: str, hot: DataFrame, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
    """One salt of the row's own side, and the row repeated for each salt of the other."""
    return (
        rows.join(F.broadcast(hot), key, "left")
        .withColumn(own[0], F.expr(f"cast(coalesce(pmod(xxhash64({order}), {own[1]}), 0) AS INT)"))
        .withColumn(other[0], F.expr(f"explode(sequence(0, coalesce({other[1]}, 1) - 1))"))
        .drop(LEFT_SPLITS, RIGHT_SPLITS)
    )


def product_join(
    left: DataFrame, right: DataFrame, key: str, left_order: str, right_order: str, hot: DataFrame, keep_salts: bool = False
) -> DataFrame:
    """Inner join of two sides that may both have many rows of a key; each pair
    meets under exactly one pair of salts."""
    left_names, right_names = (LEFT_SALT, LEFT_SPLITS), (RIGHT_SALT, RIGHT_SPLITS)
    joined = salted(left, key, left_order, hot, left_names, right_names).join(
        salted(right, key, right_order, hot, right_names, left_names), [key, LEFT_SALT, RIGHT_SALT])
    return joined if keep_salts else joined.drop(LEFT_SALT, RIGHT_SALT)
