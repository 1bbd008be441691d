"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

1. Every source gets a budget of words: its share of the total by weight, at most ``most`` times its own size; what a capped source
   cannot use is shared again by weight. The end state of that resharing has a closed form: capped sources are those with the smallest size per
   weight, found with one running sum over the per-source totals.
2. Within a source every document gets an exponential key, ``-ln(u) / quality weight`` with ``u`` from a hash of id and text. Sorted by key,
   the documents are a weighted sample without replacement.
3. The budget pays complete epochs of the whole source first. The rest is taken from the sorted documents until their running sum of
   sizes reaches it; the document on the border is taken if that comes nearer to the budget.

The running sum is taken in two steps, so that a source with a third of all rows is no single task: documents are dealt into slices of the key
range (some thousand documents each), slice totals are summed up per source, and only the slice with the border is sorted.

Defined results: a null text has size 0; a null source is a source of its own, after all others; documents of size 0 take 0 words. Equal
keys are ordered by id, then by text hash. Rows that repeat id, text and source are one entry with a count until the end: as many of its copies are
taken as come nearest to the budget. A null, non-positive or non-finite quality weight counts as 1. Each document row gives one row; empty tables give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from deltaloom.llm.text import SPACED_WORD
from deltaloom.llm.vectors import partitions_of
from deltaloom.storage import cut_lineage

#: Weights of the sources by code point, repeating (fixed values).
WEIGHTS = (5, 2, 1)
#: Budget of the whole mix and cap of a source, in times of the sizes.
SHARE, MOST = 1.5, 2.0
#: Documents in a slice of the key range, on average, and rows that one task writes of a repeated document at a time.
SLICE = 4096


def label_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """Quality weights from frame (doc_id, quality): good documents, bad ones; a null quality gives none."""
    weight = F.when(F.col("quality") == 1, good).when(F.col("quality") == 0, bad)
    return labels.select(F.col("doc_id").alias("quality_id"), weight.alias("weight"))


def size_of(text: Column) -> Column:
    """Number of words. Each becomes one letter and the space between them goes: no array of words is built."""
    letters = F.translate(F.regexp_replace(text.cast("string"), SPACED_WORD, "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Budget of each source from frame (source, source_size): adds ``target``.

    With sources in ascending order of cap per weight, the first k are capped for the smallest k at which the next one's even share of
    what is left stays within its cap. The windows run over one row per source, not over documents.
    """
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    rows = sources.withColumn("weight", F.element_at(kinds, ((rank - 1) % len(weights) + 1).cast("int")))
    whole = W.partitionBy()
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rows = (
        rows.withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("total", F.sum("source_size").over(whole) * F.lit(share))
        .withColumn("all_weight", F.sum("weight").over(whole))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("weight_left"))
        .withColumn("open", F.col("level") * F.col("weight") <= F.col("cap"))
        .withColumn("first_level", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    )
    target = F.when(F.col("first_level").isNull(), F.col("cap")).otherwise(F.col("first_level") * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
) -> DataFrame:
    """Frame (doc_id, size, source_size, source, target, taken): words that the mix takes of each document, repeats counted.

    ``quality``: frame (quality_id, weight) of document quality weights; of several rows for one id the largest weight counts, documents
    without one weigh 1.
    """
    digest = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
    code = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), digest).cast("binary"))
    uniform = (F.conv(F.substring(code, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size"), code.alias("code"), uniform.alias("u")
    )
    if quality is None:
        rows = rows.withColumn("weight", F.lit(1.0))
    else:
        given = F.col("weight").cast("double")
        best = quality.where((given > 0) & (given < float("inf"))).groupBy("quality_id").agg(F.max(given).alias("weight"))
        rows = rows.join(best, F.col("doc_id") == F.col("quality_id"), "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    rows = rows.select("doc_id", "source", "size", "code", (-F.log("u") / F.col("weight")).alias("key"))
    rows = rows.groupBy("doc_id", "source", "size", "code", "key").agg(F.count("*").alias("copies"))
    rows = cut_lineage(rows, "mix")  # ids, sizes and keys: the texts are read once

    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_docs"))
    plan = targets(totals, weights, share, most).join(totals.select(F.col("source").alias("s"), "n_docs"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("epochs", F.least(F.col("epochs"), F.lit(int(most)))).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    plan = cut_lineage(plan.withColumn("slices", F.ceil(F.col("n_docs") / SLICE).cast("long")), "mix-plan")  # one row per source

    told = plan.select(F.col("source").alias("s"), "source_size", "target", "epochs", "rest", "slices")
    dealt = rows.join(told, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = dealt.withColumn("slice", F.floor((1 - F.exp(-F.col("key"))) * F.col("slices")).cast("long"))

    slices = dealt.groupBy("source", "slice", "rest").agg(F.sum(F.col("size") * F.col("copies")).alias("slice_size"))
    running = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    border = (
        slices.withColumn("upto", F.sum("slice_size").over(running))
        .where(F.col("upto") >= F.col("rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct("slice", (F.col("upto") - F.col("slice_size")).alias("before")), "slice").alias("b"))
        .select(F.col("source").alias("s"), F.col("b.slice").alias("border"), "b.before")
    )
    placed = dealt.join(border, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    on_border = F.col("slice") == F.col("border")
    inside = placed.where(on_border)
    in_order = W.partitionBy("source").orderBy("key", "doc_id", "code").rowsBetween(W.unboundedPreceding, -1)
    ahead = F.col("rest") - F.col("before") - F.coalesce(F.sum(F.col("size") * F.col("copies")).over(in_order), F.lit(0))
    nearest = F.when(F.col("size") > 0, F.floor(F.col("ahead") / F.col("size") + 0.5)).otherwise(F.lit(0))
    inside = inside.withColumn("ahead", ahead).withColumn("extra", F.greatest(F.lit(0), F.least("copies", nearest)))
    all_of_it = F.coalesce(F.col("slice") < F.col("border"), F.lit(True))
    outside = placed.where(~on_border | F.col("border").isNull()).withColumn("extra", F.when(all_of_it, F.col("copies")).otherwise(F.lit(0)))
    columns = ["doc_id", "size", "source_size", "source", "target", "epochs", "copies", "extra"]
    taken = (F.col("epochs") + (F.col("copy") < F.col("extra")).cast("long")) * F.col("size")
    rows = _each_copy(inside.select(*columns).unionByName(outside.select(*columns)))
    return rows.select("doc_id", "size", "source_size", "source", "target", taken.cast("long").alias("taken"))


def _each_copy(rows: DataFrame) -> DataFrame:
    """A row per copy, ``copy`` from 0. Those of a document repeated without end are dealt out before they are written."""
    few = rows.where(F.col("copies") <= SLICE).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    many = rows.where(F.col("copies") > SLICE).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SLICE))))
    many = many.repartition(partitions_of(rows))
    many = many.withColumn("copy", F.explode(F.sequence(F.col("part") * SLICE, F.least(F.col("copies"), (F.col("part") + 1) * SLICE) - 1)))
    return few.unionByName(many.drop("part"))
