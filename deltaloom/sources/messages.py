"""Messages and topics as sources (S10-S13, R09). All of it also runs on streams."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deltaloom.storage import broadcast_checked, cut_lineage


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    """Needs Spark's Kafka package on the class path."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    return decode_records(reader.options(**options).load())


def decode_records(records: DataFrame) -> DataFrame:
    """``(topic, key, value, timestamp)`` with text keys and values."""
    return records.select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def parse_payload(messages: DataFrame, schema: str, sep: str = ",", column: str = "payload") -> DataFrame:
    """Add the parsed struct ``_row``; null where the payload does not fit the schema."""
    parsed_type = T._parse_datatype_string(f"struct<{schema}>") if ":" in schema else T._parse_datatype_string(schema)
    with_bad = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed_type.fields) + ", _bad string"
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    whole = F.from_csv(F.col(column), with_bad, options)
    row = F.struct(*[F.col("_parsed")[f.name].alias(f.name) for f in parsed_type.fields])
    fits = F.col("_parsed").isNotNull() & F.col("_parsed")["_bad"].isNull()
    return messages.withColumn("_parsed", whole).withColumn("_row", F.when(fits, row)).drop("_parsed")


def accepted(parsed: DataFrame, *keep: str) -> DataFrame:
    return parsed.where(F.col("_row").isNotNull()).select(*keep, "_row.*")


def rejected(parsed: DataFrame) -> DataFrame:
    """The side output of payloads that could not be parsed."""
    return parsed.where(F.col("_row").isNull()).drop("_row")


@dataclass(frozen=True)
class TopicRule:
    """Topics of one shape go to one table, fields to columns."""

    pattern: str
    table: str
    columns: dict[str, str] | None = None

    def regex(self) -> str:
        """``+`` stands for one level of the path, ``#`` for the rest of it and for no level at all. Neither meets a first level that begins with ``$``."""
        levels = self.pattern.split("/")
        rest = levels[-1] == "#"
        parts = ["[^/]*" if level == "+" else re.escape(level) for level in levels[: len(levels) - rest]]
        open_ = r"(?!\$)" if levels[0] in ("+", "#") else ""
        return "^" + open_ + "/".join(parts) + (("(?:/.*)?" if parts else ".*") if rest else "") + "$"


def map_topics(messages: DataFrame, rules: Iterable[TopicRule], topic: str = "topic") -> DataFrame:
    """Add the target table and the number of the rule; the first matching rule wins, null = no rule.

    For a short list that is configuration: the rules become one CASE expression, no join, also on streams. See
    :func:`route_topics` for rules that are a table.
    """
    found = F.lit(None).cast("struct<_table:string,_rule:bigint>")
    for number, rule in reversed(list(enumerate(rules))):
        hit = F.struct(F.lit(rule.table).alias("_table"), F.lit(number).cast("bigint").alias("_rule"))
        found = F.when(F.col(topic).rlike(rule.regex()), hit).otherwise(found)
    return messages.withColumn("_found", found).withColumns({"_table": F.col("_found._table"), "_rule": F.col("_found._rule")}).drop("_found")


def route_topics(messages: DataFrame, rules: DataFrame, topic: str = "topic") -> DataFrame:
    """S12 with any number of rules, a frame ``rule bigint, pattern string, target string``: adds ``_table`` and ``_rule``, the smallest matching one.

    Rules are a tree of levels. Distinct topics walk down it together, one join a level: to the child with the level's own name, and to ``+``. The joins
    look paths up by equality, so their cost follows the topics and how many rules a topic meets, not topics times rules. A ``#`` is a mark on the
    node above it. Streams call this on each micro-batch.
    """
    parts = F.split("pattern", "/")
    rules = rules.where(F.col("pattern").isNotNull()).select("rule", "target", parts.alias("levels"))
    rest = F.element_at("levels", -1) == "#"
    nodes = rules.select("rule", rest.alias("rest"), F.when(rest, F.slice("levels", 1, F.size("levels") - 1)).otherwise(F.col("levels")).alias("levels"))
    nodes = nodes.select("rule", "rest", "levels", F.explode(F.sequence(F.lit(0), F.size("levels"))).alias("depth"))
    own = F.col("depth") == F.size("levels")
    nodes = nodes.groupBy("depth", F.array_join(F.slice("levels", 1, F.col("depth")), "/").alias("node")).agg(
        F.min(F.when(own & F.col("rest"), F.col("rule"))).alias("below"), F.min(F.when(own & ~F.col("rest"), F.col("rule"))).alias("here")
    )
    nodes = cut_lineage(nodes, "topic-rules")
    deepest = nodes.agg(F.max("depth")).first()[0]
    topics = messages.where(F.col(topic).isNotNull()).select(F.col(topic).alias("topic")).distinct()
    walk = cut_lineage(topics.select("topic", F.split("topic", "/").alias("levels"), F.lit("").alias("path")), "topics")
    hits = None
    for depth in range(0, (deepest if deepest is not None else -1) + 1):
        if depth:
            name = F.get("levels", F.lit(depth - 1))
            ways = F.array_distinct(F.array(name, F.lit("+")))
            if depth == 1:
                ways = F.when(F.startswith("topic", F.lit("$")), F.array(name)).otherwise(ways)
            walk = walk.where(F.size("levels") >= depth).withColumn("way", F.explode(ways))
            walk = walk.withColumn("path", F.concat("path", F.lit("/" if depth > 1 else ""), "way")).drop("way")
        there = broadcast_checked(nodes.where(F.col("depth") == depth).select("node", "below", "here"))
        met = walk.join(there, F.col("path") == F.col("node")).drop("node")
        closed = F.startswith("topic", F.lit("$")) if depth == 0 else F.lit(False)  # '#' alone does not meet them
        whole = F.when((F.size("levels") == depth) & (depth > 0), F.col("here"))
        found = met.select("topic", F.least(F.when(~closed, F.col("below")), whole).alias("rule")).where("rule is not null")
        hits = found if hits is None else hits.unionByName(found)
        walk = met.drop("below", "here")
        if depth % 4 == 3:
            walk = cut_lineage(walk, "topics")
    if hits is None:
        return messages.withColumns({"_table": F.lit(None).cast("string"), "_rule": F.lit(None).cast("bigint")})
    first = hits.groupBy(F.col("topic").alias("_topic")).agg(F.min("rule").alias("_rule"))
    named = first.join(rules.select(F.col("rule").alias("_number"), F.col("target").alias("_table")), F.col("_rule") == F.col("_number")).drop("_number")
    return messages.join(named, F.col(topic) == F.col("_topic"), "left").select(*messages.columns, "_table", "_rule")


def rows_for(mapped: DataFrame, rule: TopicRule, number: int | None = None) -> DataFrame:
    """Rows of one target table under its column names; ``number`` picks one of several rules for the table."""
    rows = mapped.where((F.col("_table") == rule.table) if number is None else (F.col("_rule") == number))
    if not rule.columns:
        return rows.drop("_table", "_rule")
    return rows.select(*[F.col(source).alias(target) for source, target in rule.columns.items()])


def append_records(records: DataFrame, path: str) -> None:
    """topic/key/value records, one directory per topic."""
    records.write.mode("append").partitionBy("topic").parquet(path)


def json_values(records: DataFrame, schema: str) -> DataFrame:
    """JSON values as columns next to topic and key."""
    return records.select("topic", "key", F.from_json("value", schema).alias("_v")).select("topic", "key", "_v.*")
