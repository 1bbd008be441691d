"""Small column-expression helpers; everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def orderable(dtype: T.DataType) -> bool:
    """Whether Spark can compare values of the type (maps and variants it cannot)."""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def name(column: str) -> str:
    """Column name as SQL text."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """String literal as SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def latest(order: str, value: str, dtypes: Iterable[T.DataType], where: str) -> str:
    """SQL aggregate: ``struct(o, v)`` of the last row, by ``order``, where ``where`` holds.

    Nulls in ``value`` count. Merges partial results, so a hot group is reduced
    on the map side before anything is shuffled. ``dtypes`` are the types in ``value``.
    """
    entry = f"struct({order} AS o, {value} AS v)"
    if all(orderable(t) for t in dtypes):
        return f"max(CASE WHEN {where} THEN {entry} END)"
    return f"max_by({entry}, CASE WHEN {where} THEN {order} END)"


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def join_same(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join by equal key columns, where null equals null; the key columns appear once.

    Null-safe equality is an equi-join for Spark, so nothing else changes in the plan.
    """
    keys = list(keys)
    other = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    joined = left.join(other, all_of(F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    if how == "full":
        joined = joined.withColumns({k: F.coalesce(k, f"_same_{k}") for k in keys})
    return joined.drop(*[f"_same_{k}" for k in keys])


def is_true(predicate: Column) -> Column:
    """SQL predicates act on rows where they are TRUE; NULL counts as not."""
    return F.coalesce(predicate, F.lit(False))
