"""Typed table operations, one row or a whole frame of rows at a time."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions.columns import all_of
from deltaloom.model import DELETE, INSERT, TableSpec, as_changes, declared_type


def create_table(spark: SparkSession, name: str, columns: Mapping[str, str]) -> tuple[TableSpec, DataFrame]:
    """Ordered ``{column: declared type}`` -> spec and empty table."""
    schema = T.StructType([T.StructField(c, declared_type(t)) for c, t in columns.items()])
    keys = tuple(c for c, t in columns.items() if "PRIMARY KEY" in t.upper())
    return TableSpec(name, schema, keys), spark.createDataFrame([], schema)


def save_table(df: DataFrame, name: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert_rows(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows; columns the table has not seen yet are added."""
    return table.unionByName(rows, allowMissingColumns=True)


def _matches(condition: Mapping[str, Any]) -> Column:
    return all_of(F.col(c).eqNullSafe(F.lit(v)) for c, v in condition.items())


def update_where(table: DataFrame, values: Mapping[str, Any], condition: Mapping[str, Any]) -> DataFrame:
    """Set columns where all conditions are equal; unseen columns are added."""
    hit = _matches(condition)
    changed = {}
    for name, value in values.items():
        if name in table.columns:
            changed[name] = F.when(hit, F.lit(value).cast(table.schema[name].dataType)).otherwise(F.col(name))
        else:
            changed[name] = F.when(hit, F.lit(value))
    return table.withColumns(changed)


def delete_where(table: DataFrame, condition: Mapping[str, Any]) -> DataFrame:
    """One condition."""
    return table.where(~_matches(condition))


def update_each(table: DataFrame, params: DataFrame, where: list[str], order: Column) -> DataFrame:
    """T03 / Q13 for many parameter rows: equi-join, the last matching row wins.

    ``params`` holds the condition columns under their own names and the new
    values as ``set_<column>``. SET and condition columns must be disjoint:
    then one pass gives the same result as applying the rows in turn.
    """
    targets = [c[4:] for c in params.columns if c.startswith("set_")]
    overlap = sorted(set(targets) & set(where))
    if overlap:
        raise ValueError(f"columns {overlap} are both assigned and matched")
    last = params.groupBy(*where).agg(F.max_by(F.struct(*[f"set_{c}" for c in targets]), order).alias("_new"))
    last = last.withColumnsRenamed({c: f"_w_{c}" for c in where})
    same = all_of(F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in where)
    joined = table.join(last, same, "left")
    changed = {}
    for name in targets:
        new = F.col("_new")[f"set_{name}"]
        old = F.col(name) if name in table.columns else F.lit(None).cast(params.schema[f"set_{name}"].dataType)
        changed[name] = F.when(F.col("_new").isNotNull(), new).otherwise(old)
    return joined.withColumns(changed).drop("_new", *[f"_w_{c}" for c in where])


def delete_each(table: DataFrame, params: DataFrame, where: list[str]) -> DataFrame:
    """T04 / Q13 for many parameter rows."""
    keys = params.select(*[F.col(c).alias(f"_w_{c}") for c in where])
    same = all_of(F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in where)
    return table.join(keys, same, "left_anti")


def split_appends(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An append-only table accepts inserts and refuses everything else."""
    is_append = F.col("_op") == INSERT
    return changes.where(is_append), changes.where(~is_append)


def purge_older(table: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    """Rows that survive a retention purge; unknown times are kept."""
    return table.where(F.col(ts).isNull() | (F.col(ts) >= cutoff))


def purge_changes(
    table: DataFrame, spec: TableSpec, ts: str, cutoff: Column, *, device_id, device_name, segment, commit_id
) -> DataFrame:
    """T07 as DELETE changes, so that the purge reaches every destination."""
    return as_changes(
        table.where(F.col(ts) < cutoff),
        spec,
        device_id=device_id,
        device_name=device_name,
        op=DELETE,
        segment=segment,
        seq=F.xxhash64(*spec.keys),
        commit_id=commit_id,
    )
