"""Mixing sources to target weights: hash-random keys, a range sort within each source, distributed prefix sums of token counts, and a cut at each source's exact budget.

Everything is a DataFrame operation. The text is read once for the sizes; what is sorted is (source, key, size). A source is dealt over ranges of its hash keys, as many as its rows ask for, so one that holds a third of all rows fills as many tasks as any other third.

Defined results: a null text has size 0; a null source is a source of its own, last in order; an empty table gives an empty result; rows repeated in full have equal keys and are taken one after the other; a source without words takes nothing; extra columns, whatever their names, are ignored by mix() and kept by mix_documents().
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, n_words, unused

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Rows that one range of keys of one source holds on average.
RANGE_ROWS = 4096


def mix_key(seed: str, doc_id: str, text: str):
    """The hash-random key of a row: 32 hexadecimal digits."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(seed + ":"), part(doc_id), F.lit(":"), F.md5(part(text))))


def targets(sources: DataFrame, weights=WEIGHTS, cap: float = MAX_EPOCHS) -> DataFrame:
    """Adds target to (source, source_size): all sizes shared by weight, none above cap times its own size.

    The limits of cap * size are met in order of cap * size / weight; from the first source that stays below, all stay below. One row a source goes to one task."""
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_limit = W.orderBy("ratio", "rank")
    before = by_limit.rowsBetween(W.unboundedPreceding, -1)
    return (
        sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", weight)
        .withColumn("limit", cap * F.col("source_size").cast("double"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("share", F.col("left") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
        .withColumn("level", F.min(F.when(F.col("share") <= F.col("ratio"), F.struct("ratio", "rank", "share"))).over(everything)["share"])
        .select("source", "source_size", "source_rows", F.least("limit", F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")).alias("target"))
    )


def _ordered(docs: DataFrame, scratch: Scratch, weights, cap, seed, doc_id, text, source) -> DataFrame:
    """(doc_id, source, size, key) with the source's figures and before, the words of the rows of its source with smaller keys."""
    sized = scratch.table(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"), mix_key(seed, doc_id, text).alias("key")), "sized")
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), weights, cap)
    per_source = per_source.withColumn("budget", F.round("target").cast("long")).withColumn("digits", F.greatest(F.lit(0), F.ceil(F.log(F.col("source_rows") / RANGE_ROWS) / math.log(16))).cast("int"))
    per_source = scratch.table(per_source.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0).cast("long")), "sources")
    # the figures of a few sources are joined by value; Spark broadcasts them while their files are below its threshold
    keyed = sized.alias("d").join(per_source.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.doc_id", "d.source", "d.size", "d.key", "source_size", "target", "budget", "epochs", F.expr("substring(d.key, 1, digits)").alias("range"))
    sums = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    start = F.coalesce(F.sum("range_size").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = scratch.table(sums.select("source", "range", start.alias("start")), "ranges")
    joined = keyed.alias("d").join(starts.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.range") == F.col("r.range"))).select("d.*", "r.start")
    inside = W.partitionBy("source", "range").orderBy("key", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    return joined.withColumn("before", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))


def mix(docs: DataFrame, weights=WEIGHTS, cap: float = MAX_EPOCHS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken for every row.

    taken: the words that the mix takes of the row: all of them in each whole epoch of its source, and in the last one as far as the source's budget goes, so that the words taken of a source add up to its target, rounded."""
    scratch = Scratch(docs.sparkSession, "mix")
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return _ordered(docs, scratch, weights, cap, seed, doc_id, text, source).select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, weights=WEIGHTS, cap: float = MAX_EPOCHS, seed: str = SEED, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents of the mix, whole, each as often as its source's budget asks.

    The last epoch takes a document if half of it or more lies before the cut. Only one key a source is needed for that, so the texts pass by without a shuffle."""
    scratch = Scratch(docs.sparkSession, "mixdocs")
    own, epochs, cut, copies = unused(docs.columns, "own", "epochs", "cut", "copies")
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    taken = F.when(F.col("before") + F.col("size") / 2 <= rest, F.col("key"))
    cuts = _ordered(docs, scratch, weights, cap, seed, doc_id, text, source).groupBy("source").agg(F.first("epochs").alias(epochs), F.max(F.when(rest > 0, taken)).alias(cut))
    cuts = scratch.table(cuts.withColumnRenamed("source", own), "cuts")
    times = F.col(epochs) + F.when(mix_key(seed, doc_id, text) <= F.col(cut), 1).otherwise(0)
    joined = docs.join(cuts, F.col(source).eqNullSafe(F.col(own))).withColumn(copies, times.cast("int")).where(F.col(copies) > 0)
    return joined.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(own, epochs, cut, copies)
