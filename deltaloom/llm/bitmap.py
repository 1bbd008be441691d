"""A fixed-size bitmap over ids: drops most rows that cannot join before their texts are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltaloom.llm.text import free_name

#: Bits of a bitmap. The table of its words has at most a 64th as many rows, however many ids there are.
BITS = 1 << 24


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS)).cast("long")


def keep_likely(rows: DataFrame, key: str, ids: DataFrame, id_column: str) -> DataFrame:
    """Rows whose key may be among ``ids``: all that are, and few others while the ids are fewer than the bits.

    With far more ids than bits nearly all rows stay, which costs time but no row: the join that follows decides.
    """
    return split_likely(rows, key, ids, id_column)[0]


def split_likely(rows: DataFrame, key: str, ids: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among ``ids``, and rows whose key is surely not (null keys among them)."""
    place = _place(F.col(id_column))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    at, word, bits = (free_name(rows.columns, c) for c in ("_place", "_word", "_bits"))
    words = ids.select(F.floor(place / 64).alias(word), one.alias("_bit")).groupBy(word).agg(F.bit_or("_bit").alias(bits))
    joined = rows.withColumn(at, _place(F.col(key))).join(F.broadcast(words), F.floor(F.col(at) / 64) == F.col(word), "left")
    bit = F.call_function("shiftrightunsigned", F.col(bits), F.pmod(F.col(at), F.lit(64)).cast("int")).bitwiseAND(F.lit(1))
    likely = F.coalesce(bit == 1, F.lit(False)) & F.col(key).isNotNull()
    return joined.where(likely).select(*rows.columns), joined.where(~likely).select(*rows.columns)
