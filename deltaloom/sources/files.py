"""File tables, incremental reads and upstream change feeds."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.model import CHANGE_COLS, UPSERT, TableSpec, as_changes
from deltaloom.operators.normalize import only_columns


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    """S05. ``merge_schema`` for append tables whose columns grew over time."""
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """S04. Without a schema the types are inferred, which reads the data twice."""
    reader = spark.read.option("header", True).option("sep", sep)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_after(df: DataFrame, watermark: str, last: Any = None) -> DataFrame:
    """Rows beyond the last mark. The comparison is pushed to the scan.

    Deleted rows cannot be seen this way, nor rows that arrive later with a
    watermark equal to the mark already taken.
    """
    return df if last is None else df.where(F.col(watermark) > F.lit(last))


def new_mark(df: DataFrame, watermark: str) -> Any:
    """High mark of the rows just read (null when there were none)."""
    return df.agg(F.max(watermark)).first()[0]


def incremental_changes(
    df: DataFrame,
    spec: TableSpec,
    watermark: str,
    last: Any,
    *,
    device_id,
    device_name,
    segment,
    commit_id: Column | int,
) -> DataFrame:
    """S02 as change rows: every row found is an UPSERT."""
    return as_changes(
        read_after(df, watermark, last),
        spec,
        device_id=device_id,
        device_name=device_name,
        op=UPSERT,
        segment=segment,
        seq=F.xxhash64(*spec.keys),
        commit_id=commit_id,
    )


def read_feed(df: DataFrame, columns: dict[str, str | Column], spec: TableSpec) -> DataFrame:
    """Rows already captured upstream, in batch or as a stream.

    ``columns`` names where each canonical column comes from; missing ones get
    a neutral value. Works on any reader, including ``readStream``.
    """
    defaults = {
        "_device_id": F.lit("source"),
        "_device_name": F.lit("source"),
        "_segment": F.lit(0),
        "_txn_seq": F.lit(0),
        "_set_cols": F.lit(None),
    }
    types = dict(zip(CHANGE_COLS, ("string", "string", "bigint", "bigint", "bigint", "bigint", "string", "array<string>")))
    picked = []
    for name in CHANGE_COLS:
        source = columns.get(name, defaults.get(name))
        if source is None:
            raise ValueError(f"the feed must say where {name} comes from")
        picked.append((F.col(source) if isinstance(source, str) else source).cast(types[name]).alias(name))
    return df.select(*picked, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields])


FULL, INCREMENTAL, FEED = "FULL", "INCREMENTAL", "FEED"


@dataclass(frozen=True)
class ReadJob:
    """One table of one source, and how to read it."""

    source: str
    table: str
    mode: str = FULL
    watermark: str | None = None
    last: Any = None
    include: tuple[str, ...] = field(default=())
    exclude: tuple[str, ...] = field(default=())


def read_jobs(jobs: Iterable[ReadJob], read: Callable[[ReadJob], DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """Many sources and tables through the same plan, tagged by origin.

    ``read`` opens one job's table with any Spark reader; filters and column
    lists given here still reach its scan.
    """
    frames = {}
    for job in jobs:
        df = only_columns(read(job), job.include, job.exclude)
        if job.mode == INCREMENTAL:
            df = read_after(df, job.watermark, job.last)
        frames[job.source, job.table] = df.withColumns({"_source": F.lit(job.source), "_table": F.lit(job.table)})
    return frames
