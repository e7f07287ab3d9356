"""Exploding computed arrays without computing them twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_once(df: DataFrame, keep: list, array: Column, name: str, pos: str | None = None) -> DataFrame:
    """One row per element of a computed array.

    For a plain ``explode`` the optimizer infers ``size(array) > 0`` and pushes it down, which repeats the
    whole array expression; the outer form plus a filter on its output evaluates it once.
    """
    if pos is None:
        return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())
    return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).filter(F.col(pos).isNotNull())


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt to all tasks by ``keys``, ahead of expressions that cost far more than moving the row: a table of few bytes is
    read by few tasks, and they would do all that work."""
    return df.repartition(*keys)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once per row: a column that an expression names several times is otherwise computed at
    each of them, and nested ones multiply."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
