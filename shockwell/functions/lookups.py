"""Literal lookups: matrices and vectors that live inside the expression.

Literals are written as SQL text, which crosses to the JVM in one call however
many values there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_text(value: str) -> str:
    """A string as an SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def text_list(values: Sequence[str]) -> str:
    return ", ".join(sql_text(v) for v in values)


def _vector_text(values: Sequence[float]) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


def vector(values: Sequence[float]) -> Column:
    return F.expr(_vector_text(values))


def matrix(rows: Sequence[Sequence[float]]) -> Column:
    return F.expr(f"array({', '.join(_vector_text(r) for r in rows)})")


def pick(values: Sequence[float], index: Column) -> Column:
    """Element at ``index``: positions past the end give the last element,
    -1 counts from the end, anything further back (or no index) gives NULL."""
    n = len(values)
    position = F.when(index >= n, n).when(index >= 0, index + 1).when(index >= -n, index)
    return F.when(position.isNotNull(), F.try_element_at(vector(values), position.cast("int")))


def pick2(rows: Sequence[Sequence[float]], i: Column, j: Column) -> Column:
    """Matrix cell; NULL when either index is NULL."""
    return F.when(i.isNotNull() & j.isNotNull(), F.get(F.get(matrix(rows), i), j))


def translate(c: Column, mapping: Mapping[str, str]) -> Column:
    """Map a code to another; NULL for codes that are not listed."""
    pairs = text_list([x for kv in mapping.items() for x in kv])
    return F.when(c.isNotNull(), F.try_element_at(F.expr(f"map({pairs})"), c))
