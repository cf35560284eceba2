"""Text cleaning and typed parsing of raw cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shockwell import fixed_values as fv
from shockwell.functions.lookups import sql_text, text_list

CONTROL_CHARACTERS = r"[\x00-\x1F\x7F]"
# Sign, digits with at most one point, exponent.  A cast alone would also take
# the type suffixes of programming languages, as in 12d or 3F.
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def missing_to_null(c: Column) -> Column:
    """The cell, or NULL when its text is one of the missing-value tokens."""
    return F.when(~c.isin(fv.MISSING_TOKENS), c)


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_CHARACTERS, "")


def has_control(columns: list[Column]) -> Column:
    """Whether a text has a control character: one search over all of them, where most rows have none."""
    return F.concat_ws("", *columns).rlike(CONTROL_CHARACTERS)


def parse_number(c: Column) -> Column:
    """Number written with a decimal point; NULL for any other text."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def number_sql(c: str) -> str:
    """`parse_number` as SQL text."""
    return f"if({c} RLIKE {sql_text(NUMBER)}, try_cast({c} AS DOUBLE), NULL)"


def to_number(c: Column) -> Column:
    """Number written with a decimal comma or point; NULL when it is neither."""
    return parse_number(F.replace(c, F.lit(","), F.lit(".")))


def to_whole_number(c: Column) -> Column:
    """Integer text such as ``2`` or ``2.0``; NULL for fractions and words."""
    parsed = parse_number(c)
    return F.when(parsed == F.floor(parsed), parsed).try_cast("int")


def day_first_date(c: Column) -> Column:
    """``dd.MM.yyyy`` with one- or two-digit day and month; NULL otherwise.

    Two digits each are the rule, and their cast costs a fraction of the pattern's parser.
    """
    plain = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2)).try_cast("date")
    return F.when(c.rlike(r"\A[0-9]{2}\.[0-9]{2}\.[1-9][0-9]{3}\z"), plain).otherwise(F.try_to_date(c, "d.M.yyyy"))


def year_first_date(c: Column) -> Column:
    """``yyyy.MM.dd`` with one- or two-digit day and month; NULL otherwise."""
    plain = F.replace(c, F.lit("."), F.lit("-")).try_cast("date")
    return F.when(c.rlike(r"\A[1-9][0-9]{3}\.[0-9]{2}\.[0-9]{2}\z"), plain).otherwise(F.try_to_date(c, "yyyy.M.d"))


def serial_or_date(c: Column) -> Column:
    """Spreadsheet day number (day 0 is 1899-12-30) or ``yyyy.MM.dd`` text."""
    days = F.floor(parse_number(c)).try_cast("int")
    return F.coalesce(F.date_add(F.lit("1899-12-30").cast("date"), days), year_first_date(c))


# Conditions as SQL text, for use in larger expressions.  A missing value makes
# them false, never NULL.


def starts_with(column: str, *prefixes: str) -> str:
    tests = " OR ".join(f"startswith({column}, {sql_text(p)})" for p in prefixes)
    return f"coalesce({tests}, false)"


def is_in(column: str, values) -> str:
    return f"coalesce({column} IN ({text_list(list(values))}), false)"


def matches(column: str, pattern: str) -> str:
    return f"coalesce({column} RLIKE {sql_text(pattern)}, false)"
