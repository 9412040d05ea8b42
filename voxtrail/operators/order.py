"""Places and quantiles: numbers of rows over a range sort, exact percentiles from places within a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import let
from .graph import checkpointed


def numbered(df: DataFrame, order, name: str, start: int = 1) -> DataFrame:
    """df with the place of each row in order, which must leave no ties for the numbers to be the same each time.

    Rows are range-sorted; the counts of the ranges, one row for each, are summed in one task and added to the places inside."""
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(F.count("*").alias("__n")).select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(W.partitionBy("__range").orderBy(*order))
    return ranged.join(F.broadcast(starts), "__range").withColumn(name, (F.col("__start") + inside + (start - 1)).cast("long")).drop("__range", "__start")


def with_quantiles(df: DataFrame, keys, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """df with exact interpolated percentiles over keys: wanted is name -> (column, share). Nulls don't count.

    A sort by key for each column, all on one partitioning by key: sorts spill, so a key's values needn't fit in memory."""
    key = W.partitionBy(*keys)
    columns = sorted({c for c, _ in wanted.values()})
    rank = {c: f"__rank{i}" for i, c in enumerate(columns)}
    ranked = df.withColumns({rank[c]: F.when(F.col(c).isNotNull(), F.row_number().over(key.orderBy(F.col(c).asc_nulls_last()))) for c in columns})
    counted = ranked.withColumns({f"{rank[c]}n": F.count(c).over(key) for c in columns})
    place = {name: F.floor(q * (F.col(f"{rank[c]}n") - 1)) for name, (c, q) in wanted.items()}
    ends = {f"__{k}_{name}": F.max(F.when(F.col(rank[c]) == place[name] + i, F.col(c))).over(key).cast("double") for name, (c, _) in wanted.items() for i, k in ((1, "low"), (2, "high"))}
    parts = {name: q * (F.col(f"{rank[c]}n") - 1) - place[name] for name, (c, q) in wanted.items()}
    found = {name: _between(F.col(f"__low_{name}"), F.col(f"__high_{name}"), part) for name, part in parts.items()}
    return counted.withColumns(ends).withColumns(found).drop(*ends, *rank.values(), *[f"{r}n" for r in rank.values()])


def _between(low: Column, high: Column, part: Column) -> Column:
    """The percentile between two neighbouring values. Where they are nearly equal the first product is left unrounded, as in DuckDB's fused multiply-add: there the last bit decides which values lie above."""
    near = high - low <= F.abs(high) * 1e-12
    return F.when(high.isNull() | (low == high), low).when(near, _fused(low, 1 - part, high * part)).otherwise(low * (1 - part) + high * part)


def _fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c without rounding the product: its error, from halves of 26 bits, and the sum's error are added at the end. Where that overflows, the plain sum."""
    top = lambda v: v * 134217729.0 - (v * 134217729.0 - v)

    def total(h):
        a, b, p, c, x, y = (h[n] for n in ("a", "b", "p", "c", "x", "y"))
        s = p + c
        lost = (a - x) * (b - y) - (((p - x * y) - (a - x) * y) - x * (b - y))
        exact = s + (lost + ((p - (s - (s - p))) + (c - (s - p))))
        return F.when(F.isnan(exact) | (F.abs(exact) == float("inf")), s).otherwise(exact)

    return let(F.struct(a.alias("a"), b.alias("b"), (a * b).alias("p"), c.alias("c"), top(a).alias("x"), top(b).alias("y")), total)


def quantiles(df: DataFrame, keys, wanted: dict[str, tuple[str, float]], *more: Column) -> DataFrame:
    """One row for each key with its percentiles, and further aggregates."""
    return with_quantiles(df, keys, wanted).groupBy(*keys).agg(*[F.first(name).alias(name) for name in wanted], *more)
