"""Batch destinations behind one description."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from deltaloom.model import TableSpec
from deltaloom.sources.jdbc import JdbcTable, write_table

LAKEHOUSE = ("iceberg", "delta", "hudi")


@dataclass(frozen=True)
class Destination:
    """A writer format with its options; ``target`` is a path, table or url."""

    format: str
    target: str
    options: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    table: str | None = None


def write(df: DataFrame, to: Destination, mode: str = "append") -> None:
    """Parquet, CSV, relational, lakehouse and any other Spark writer.

    Lakehouse and document formats need their connector on the class path.
    """
    if to.format == "jdbc":
        write_table(df, JdbcTable(to.target, to.table, to.options), mode)
        return
    if to.format in LAKEHOUSE and to.table is not None:
        _write_catalog_table(df, to, mode)
        return
    writer = df.write.format(to.format).options(**to.options).mode(mode)
    if to.format == "csv":
        writer = writer.option("header", True)
    if to.partition_by:
        writer = writer.partitionBy(*to.partition_by)
    writer.save(to.target)


def _write_catalog_table(df: DataFrame, to: Destination, mode: str) -> None:
    writer = df.writeTo(to.table).using(to.format).options(**to.options)
    if to.partition_by:
        first, *rest = [df[c] for c in to.partition_by]
        writer = writer.partitionedBy(first, *rest)
    if mode == "overwrite":
        writer.createOrReplace()
    elif df.sparkSession.catalog.tableExists(to.table):
        writer.append()
    else:
        writer.create()


def per_device(path: str, format: str = "parquet") -> Destination:
    """One directory per device, so that a device's table can be read alone."""
    return Destination(format, path, partition_by=("_device_id",))


def device_namespace(policy: str, device_id: str, device_name: str) -> str:
    """Name of a device's schema from its id, its name, or both."""
    parts = {"ID": [device_id], "NAME": [device_name], "NAME_AND_ID": [device_name, device_id]}[policy]
    return "_".join("".join(c if c.isalnum() else "_" for c in p) for p in parts)


def merge_statement(spec: TableSpec, target: str, source: str) -> str:
    """MERGE for tables that support it. ``source`` holds one row per key with ``_op``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in spec.keys)
    assign = ", ".join(f"t.{c} = s.{c}" for c in spec.values)
    names = ", ".join(spec.columns)
    values = ", ".join(f"s.{c}" for c in spec.columns)
    update = f" WHEN MATCHED THEN UPDATE SET {assign}" if spec.values else ""
    return (
        f"MERGE INTO {target} t USING {source} s ON {on}"
        f" WHEN MATCHED AND s._op = 'DELETE' THEN DELETE{update}"
        f" WHEN NOT MATCHED AND s._op <> 'DELETE' THEN INSERT ({names}) VALUES ({values})"
    )
