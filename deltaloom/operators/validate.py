"""Source against destination: rows, values, schemas, transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions.columns import all_of, join_same, orderable
from deltaloom.model import ORDER_COLS
from deltaloom.storage import cut_lineage


def _equal(df: DataFrame, column: str) -> Column:
    s, d = F.col(f"_s_{column}"), F.col(f"_d_{column}")
    if not orderable(df.schema[column].dataType):
        s, d = F.to_json(s), F.to_json(d)
    return s.eqNullSafe(d)


def _paired(source: DataFrame, dest: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Full outer join by key, each side prefixed. Unique keys: no skew to fear."""
    values = [c for c in source.columns if c not in keys and c in dest.columns]
    left = source.select(*keys, F.lit(True).alias("_in_s"), *[F.col(c).alias(f"_s_{c}") for c in values])
    right = dest.select(*keys, F.lit(True).alias("_in_d"), *[F.col(c).alias(f"_d_{c}") for c in values])
    return join_same(left, right, keys, "full"), values


def compare_rows(source: DataFrame, dest: DataFrame, keys: list[str]) -> DataFrame:
    """Differing keys only, with ``kind`` missing / extra / mismatched."""
    paired, values = _paired(source, dest, keys)
    kind = (
        F.when(F.col("_in_d").isNull(), "missing")
        .when(F.col("_in_s").isNull(), "extra")
        .when(~all_of(_equal(source, c) for c in values), "mismatched")
    )
    return paired.select(*keys, kind.alias("kind")).where(F.col("kind").isNotNull())


#: Buckets of keys whose checksums are compared.
BUCKETS = 4096


def bucket_sums(df: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """X05 per bucket of keys: rows, and two sums over the hashes of whole rows, columns by name. At most ``buckets`` rows leave a task."""
    columns = [F.col(c) if orderable(df.schema[c].dataType) else F.to_json(c) for c in sorted(df.columns)]
    row = F.struct(F.xxhash64(*columns).alias("h"), F.hash(*columns).cast("bigint").alias("g"))
    rows = df.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket"), row.alias("r"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(F.col("r.h").cast("decimal(38,0)")).alias("h"), F.sum("r.g").alias("g"))


def compare_by_buckets(source: DataFrame, dest: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """X01 for tables that are nearly equal: checksums per bucket of keys first, then only the rows of buckets that differ are joined.

    Both sides need the same columns and types. Rows of equal buckets are read, but neither shuffled nor joined.
    """
    if sorted(source.dtypes) != sorted(dest.dtypes):
        return compare_rows(source, dest, keys)
    left, right = bucket_sums(source, keys, buckets), bucket_sums(dest, keys, buckets).withColumnsRenamed({"n": "m", "h": "i", "g": "j"})
    both = left.join(right, "bucket", "full")
    same = F.col("n").eqNullSafe(F.col("m")) & F.col("h").eqNullSafe(F.col("i")) & F.col("g").eqNullSafe(F.col("j"))
    differ = cut_lineage(both.where(~same).select(F.col("bucket").alias("_bucket")), "differing-buckets")

    def doubtful(df: DataFrame) -> DataFrame:
        mine = F.pmod(F.xxhash64(*keys), F.lit(buckets)) == F.col("_bucket")
        return df.join(F.broadcast(differ), mine, "left_semi")  # ``buckets`` numbers at most

    return compare_rows(doubtful(source), doubtful(dest), keys)


def compare_bags(source: DataFrame, dest: DataFrame) -> DataFrame:
    """X01 for key-less tables: rows whose number of copies differs.

    Copies are counted on the map side, so a row repeated a billion times is
    one shuffled record per task.
    """
    columns = source.columns
    sides = source.select(*columns, F.lit(1).alias("_s"), F.lit(0).alias("_d")).unionAll(
        dest.select(*columns, F.lit(0).alias("_s"), F.lit(1).alias("_d"))
    )
    return (
        sides.groupBy(*columns)
        .agg(F.sum("_s").alias("n_source"), F.sum("_d").alias("n_dest"))
        .where(F.col("n_source") != F.col("n_dest"))
    )


def difference_report(source: DataFrame, dest: DataFrame, keys: list[str]) -> DataFrame:
    """One row per differing cell with both values, one per missing / extra row."""
    paired, values = _paired(source, dest, keys)

    def text(name: str) -> Column:
        return F.col(name).cast("string") if orderable(paired.schema[name].dataType) else F.to_json(name)

    def entry(kind: str, column, s, d) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("kind"),
            (none if column is None else F.lit(column)).alias("column_name"),
            (none if s is None else s).alias("source_value"),
            (none if d is None else d).alias("dest_value"),
        )

    cells = [F.when(~_equal(source, c), entry("mismatched", c, text(f"_s_{c}"), text(f"_d_{c}"))) for c in values]
    found = (
        F.when(F.col("_in_d").isNull(), F.array(entry("missing", None, None, None)))
        .when(F.col("_in_s").isNull(), F.array(entry("extra", None, None, None)))
        .otherwise(F.array_compact(F.array(*cells)))
    )
    return paired.select(*keys, F.inline(found))


def compare_schemas(source: DataFrame, dest: DataFrame) -> DataFrame:
    """Columns present on one side only or with different types.

    Both inputs are catalog frames: ``table_name, column_name, data_type``.
    """
    left = source.select("table_name", "column_name", F.col("data_type").alias("source_type"))
    right = dest.select("table_name", "column_name", F.col("data_type").alias("dest_type"))
    kind = (
        F.when(F.col("dest_type").isNull(), "missing")
        .when(F.col("source_type").isNull(), "extra")
        .when(F.col("source_type") != F.col("dest_type"), "type")
    )
    return (
        left.join(right, ["table_name", "column_name"], "full").withColumn("kind", kind).where(F.col("kind").isNotNull())
    )


def transaction_integrity(captured: DataFrame, applied: DataFrame, txn: DataFrame) -> DataFrame:
    """Committed changes that did not arrive, rolled-back changes that did.

    Compares log positions, not counts: a re-delivered row is no second change,
    and a lost one is not hidden by it. Flags are combined on the map side, first
    per position, then per commit.
    """
    key = ["_device_id", "_commit_id"]

    def side(df: DataFrame, name: str, positions: bool = True) -> DataFrame:
        place = [F.col(c) if positions else F.lit(None).cast("bigint").alias(c) for c in ORDER_COLS]
        return df.select(*key, *place, *[F.lit(name == n).alias(n) for n in ("captured", "applied", "committed")])

    flags = [F.bool_or(n).alias(n) for n in ("captured", "applied", "committed")]
    rows = side(captured, "captured").unionAll(side(applied, "applied")).unionAll(side(txn, "committed", False))
    commits = rows.groupBy(*key, *ORDER_COLS).agg(*flags).groupBy(*key).agg(
        F.bool_or("committed").alias("committed"),
        F.bool_or("applied").alias("applied"),
        F.bool_or(F.col("captured") & ~F.col("applied")).alias("lost"),
    )
    kind = F.when(F.col("committed") & F.col("lost"), "missing_change").when(
        ~F.col("committed") & F.col("applied"), "rolled_back_change_applied"
    )
    return commits.withColumn("kind", kind).where(F.col("kind").isNotNull())


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and an order-independent checksum.

    The checksum adds up 52 bits of the MD5 of every row, written as text with
    columns by name: another engine can compute it too. Numbers count to four
    decimal places, times in microseconds; null and text differ.
    """

    def written(field: T.StructField) -> Column:
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.FractionalType, T.DecimalType)):
            plain = F.round(value * 10000).cast("decimal(38,0)").cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            plain = F.unix_micros(value.cast("timestamp")).cast("string")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            plain = F.to_json(value)
        else:
            plain = value.cast("string")
        return F.coalesce(F.concat(F.lit("="), plain), F.lit("~"))

    row = F.md5(F.concat_ws("|", *[written(f) for f in sorted(df.schema.fields, key=lambda f: f.name)]))
    part = F.conv(F.substring(row, 1, 13), 16, 10).cast("decimal(38,0)")
    return df.select(part.alias("_h")).agg(F.count("*").alias("row_count"), F.sum("_h").alias("checksum"))


def inspect_log(log: DataFrame, last: int = 5, first: int = 20) -> dict[str, DataFrame]:
    """Row counts, last rows and first statements of a command log."""
    return {
        "counts": log.groupBy("_device_id", "_segment").agg(F.count("*").alias("n_rows")),
        "last_rows": log.orderBy(F.desc("_segment"), F.desc("_seq"), "_device_id").limit(last),
        "first_statements": log.where(F.length("sql") > 0)
        .orderBy("_segment", "_seq", "_device_id")
        .select("_device_id", "_segment", "_seq", "sql")
        .limit(first),
    }

