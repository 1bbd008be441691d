"""Key-value mutation logs folded to typed tables.

Input: ``ord, ts, call, key, value, fields, members, scores, ttl`` with the
columns a call does not use left null. State is kept as rows (key, field, ...)
rather than as one map or list per key: a key of any size stays distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.functions.columns import join_same
from deltaloom.operators.carry import carry_forward, sum_forward
from deltaloom.operators.ranking import number_rows
from deltaloom.storage import cut_lineage

#: A position beyond all others.
NEVER = 2**63 - 1
SET, HSET, RPUSH, SADD, ZADD, EXPIRE, DEL = "set", "hset", "rpush", "sadd", "zadd", "expire", "del"

LOG_SCHEMA = T.StructType(
    [
        T.StructField("ord", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("call", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
        T.StructField("members", T.ArrayType(T.StringType())),
        T.StructField("scores", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("ttl", T.LongType()),
    ]
)


def kv_log(df: DataFrame, **columns: Column) -> DataFrame:
    """Fill the log schema from named expressions; the rest is null."""
    return df.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LOG_SCHEMA.fields]
    )


def at(log: DataFrame, as_of: Column | None) -> DataFrame:
    """The calls before an instant, all of them without one."""
    return log if as_of is None else log.where(F.col("ts") < as_of)


def key_states(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Per key that was ever deleted or given a deadline: ``since``, the position from which on its rows count.

    A key lives from its first write, dies by ``del`` or when its deadline passes, and lives again from the next write on, without a deadline. ``set``
    takes a deadline away, ``expire`` replaces it and does nothing to a dead key. A deadline has passed for a call, or for ``as_of``, whose time is not before
    it. A key that is dead in the end counts from beyond all positions.
    """
    calls = at(log, as_of).select(
        "key", "ord", "ts", "call", F.when(F.col("call") == EXPIRE, F.timestamp_add("SECOND", F.col("ttl"), F.col("ts"))).alias("deadline")
    )
    limited = calls.where(F.col("call") == EXPIRE).select("key").distinct()
    lives = _lives(join_same(calls, limited, ["key"], "left_semi"), limited, as_of)
    deleted = calls.where(F.col("call") == DEL).groupBy("key").agg((F.max("ord") + 1).alias("since"))
    return lives.unionByName(join_same(deleted, limited, ["key"], "left_anti"))


def _lives(calls: DataFrame, keys: DataFrame, as_of: Column | None) -> DataFrame:
    """Frame (key, since) of keys with deadlines; ``calls`` holds all their calls.

    ``set``, ``del`` and ``expire`` are marks. Whether a key is alive before a mark follows from whether it was alive before the mark ahead of it, and from the
    writes between them: each mark stands for a function of one truth value. Such a function is constant, keeps the value or turns it round, so the
    value is that of the last constant one, turned round as often as the marks since then do. Both are carried in two levels; no key's calls meet in one task.
    """
    when = F.lit(None).cast("timestamp_ntz") if as_of is None else as_of
    end = keys.select("key", F.lit(NEVER).alias("ord"), when.cast("timestamp_ntz").alias("ts"), F.lit("end").alias("call"), F.lit(None).cast("timestamp_ntz").alias("deadline"))
    ordered = calls.unionByName(end).withColumns({"_segment": F.lit(0).cast("bigint"), "_seq": F.col("ord"), "_txn_seq": F.lit(0).cast("bigint")})
    mark = F.col("call").isin(SET, DEL, EXPIRE)
    told = carry_forward(ordered, ["key"], F.when(mark, F.struct("ord", "call", "deadline")), "prev", inclusive=False)
    writes = told.where(~mark & (F.col("call") != "end")).groupBy("key", F.col("prev.ord").alias("after"))
    writes = writes.agg(F.min("ord").alias("first"), F.min(F.when(F.col("ts") >= F.col("prev.deadline"), F.col("ord"))).alias("late"))

    marks = told.where(mark | (F.col("call") == "end")).withColumn("after", F.col("prev.ord"))
    marks = join_same(marks, writes, ["key", "after"], "left")
    wrote = F.col("first").isNotNull()
    kept = F.col("late").isNotNull() | F.coalesce(F.col("ts") < F.col("prev.deadline"), F.lit(True))
    before = F.col("prev.call")
    limited = F.coalesce(before == EXPIRE, F.lit(False))
    if_alive = F.when(limited, kept).when(before == SET, True).otherwise(wrote)
    if_dead = F.when(before == SET, True).otherwise(wrote)
    marks = marks.withColumns({"if_alive": if_alive, "if_dead": if_dead}).drop("first", "late", "after", "prev")
    turned = (F.col("if_dead") & ~F.col("if_alive")).cast("bigint")
    marks = sum_forward(marks, ["key"], turned, "turns")
    known = F.when(F.col("if_alive") == F.col("if_dead"), F.struct("if_alive", "turns"))
    marks = carry_forward(marks, ["key"], known, "known", inclusive=True)
    alive = F.col("known.if_alive") != ((F.col("turns") - F.col("known.turns")) % 2 == 1)

    # births: a set of a dead key, and the first write after a death
    marks = join_same(marks.withColumn("alive", alive).withColumn("after", F.col("ord")), writes, ["key", "after"], "left")
    birth = (
        F.when(F.col("call") == SET, F.when(~F.col("alive"), F.col("ord")))
        .when(F.col("call") == DEL, F.col("first"))
        .when(F.col("call") == EXPIRE, F.when(F.col("alive"), F.col("late")).otherwise(F.col("first")))
    )
    births = marks.select("key", birth.alias("birth"), F.when(F.col("call") == "end", F.col("alive")).alias("alive"))
    births = births.unionByName(writes.where("after is null").select("key", F.col("first").alias("birth"), F.lit(None).cast("boolean").alias("alive")))
    last = births.groupBy("key").agg(F.max("birth").alias("birth"), F.max("alive").alias("alive"))
    return last.select("key", F.when(F.col("alive"), F.col("birth")).otherwise(F.lit(NEVER)).alias("since"))


def _alive(rows: DataFrame, log: DataFrame, as_of: Column | None, states: DataFrame | None = None) -> DataFrame:
    """Rows written in their key's last life; ``ord`` is the last write of the row. ``states`` are the log's :func:`key_states`, if they are at hand."""
    told = join_same(rows, key_states(log, as_of) if states is None else states, ["key"], "left")
    return told.where(F.col("since").isNull() | (F.col("ord") >= F.col("since"))).drop("since")


def strings(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """Last value per key."""
    last = at(log, as_of).where(F.col("call") == SET).groupBy("key").agg(
        F.max("ord").alias("ord"), F.max_by("value", "ord").alias("value")
    )
    return _alive(last, log, as_of, states).select("key", "value")


def get(log: DataFrame, keys: DataFrame, as_of: Column | None = None) -> DataFrame:
    """V01 read: look keys up; absent ones give null."""
    return join_same(keys.select("key"), strings(log, as_of), ["key"], "left")


def hashes(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """Last value per (key, field)."""
    written = at(log, as_of).where(F.col("call") == HSET).select("ord", "key", F.explode("fields").alias("field", "value"))
    last = written.groupBy("key", "field").agg(F.max("ord").alias("ord"), F.max_by("value", "ord").alias("value"))
    return _alive(last, log, as_of, states).select("key", "field", "value")


def list_items(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """V03 without numbering: every pushed value and where it stands."""
    pushed = at(log, as_of).where(F.col("call") == RPUSH).select("ord", "key", F.posexplode("members").alias("pos", "value"))
    return _alive(pushed, log, as_of, states)


def lists(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """``key, position, value`` in push order, from 1."""
    return number_rows(list_items(log, as_of, states), ["key"], ["ord", "pos"], "position").select("key", "position", "value")


def sets(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """Distinct members."""
    added = at(log, as_of).where(F.col("call") == SADD).select("ord", "key", F.explode("members").alias("member"))
    last = added.groupBy("key", "member").agg(F.max("ord").alias("ord"))
    return _alive(last, log, as_of, states).select("key", "member")


def scores(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """V05 without ranks: last score per member."""
    added = at(log, as_of).where(F.col("call") == ZADD).select("ord", "key", F.explode("scores").alias("member", "score"))
    last = added.groupBy("key", "member").agg(F.max("ord").alias("ord"), F.max_by("score", "ord").alias("score"))
    return _alive(last, log, as_of, states).select("key", "member", "score")


def sorted_sets(log: DataFrame, as_of: Column | None = None, states: DataFrame | None = None) -> DataFrame:
    """Members ranked from 1 by (score, member)."""
    return number_rows(scores(log, as_of, states), ["key"], ["score", "member"], "rank").select(
        "key", "rank", "member", "score"
    )


def full_state(log: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``kind, key, item, value`` of everything alive, rebuilt from the log."""

    def rows(kind: str, df: DataFrame, item: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"), "key", item.cast("string").alias("item"), value.cast("string").alias("value")
        )

    none = F.lit(None)
    states = cut_lineage(key_states(log, as_of), "lives")  # found once for all kinds
    return (
        rows("string", strings(log, as_of, states), none, F.col("value"))
        .unionByName(rows("hash", hashes(log, as_of, states), F.col("field"), F.col("value")))
        .unionByName(rows("list", lists(log, as_of, states), F.col("position"), F.col("value")))
        .unionByName(rows("set", sets(log, as_of, states), F.col("member"), none))
        .unionByName(rows("zset", scores(log, as_of, states), F.col("member"), F.col("score")))
    )
