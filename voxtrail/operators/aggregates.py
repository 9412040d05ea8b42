"""Aggregates of points, masks, pairs and votes. Percentiles are exact and interpolated, from sorts that spill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULTS
from .order import quantiles, with_quantiles


def shape_tokens(points: DataFrame, keys=("obj",), low: float = DEFAULTS.obb_percentile) -> DataFrame:
    """Count, and mean, population deviation and bounds of each axis: percentiles from 20 points on, else the extremes."""
    ends = {f"{c}_{end}": (c, q) for c in "xyz" for end, q in (("min", low), ("max", 1 - low))}
    moments = [f(c).alias(f"{c}_{name}") for c in "xyz" for f, name in ((F.avg, "mu"), (F.stddev_pop, "sigma"), (F.min, "least"), (F.max, "most"))]
    found = quantiles(points, keys, ends, F.count("*").alias("n"), *moments)
    bound = lambda c, end, other: F.when(F.col("n") >= 20, F.col(f"{c}_{end}")).otherwise(F.col(f"{c}_{other}")).alias(f"{c}_{end}")
    return found.select(*keys, "n", *[x for c in "xyz" for x in (F.col(f"{c}_mu"), F.col(f"{c}_sigma"), bound(c, "min", "least"), bound(c, "max", "most"))])


def oriented_boxes(points: DataFrame, keys=("obj",), low: float = DEFAULTS.obb_percentile, least: int = 12) -> DataFrame:
    """Boxes turned about the vertical axis: outliers beyond median + 2.5 * 1.4826 * MAD go where 30 points or more allow it, the yaw is that of the main axis in closed form (modulo pi), and bounds are percentiles in the turned frame. Keys of fewer than least points have no box.

    All medians, counts and moments are windows over one partitioning by key, so the points are shuffled once."""
    key = W.partitionBy(*keys)
    rows = points.select(*keys, "x", "y", "z").withColumn("__n", F.count("*").over(key)).where(F.col("__n") >= least)
    rows = with_quantiles(rows, keys, {f"__m{c}": (c, 0.5) for c in "xyz"})
    rows = rows.withColumn("__d", F.sqrt(sum(((F.col(c) - F.col(f"__m{c}")) ** 2 for c in "xyz"), F.lit(0.0))))
    rows = with_quantiles(rows, keys, {"__md": ("__d", 0.5)}).withColumn("__off", F.abs(F.col("__d") - F.col("__md")))
    rows = with_quantiles(rows, keys, {"__mad": ("__off", 0.5)})
    rows = rows.withColumn("__in", F.col("__d") <= F.col("__md") + 2.5 * 1.4826 * (F.col("__mad") + 1e-6))
    rows = rows.withColumn("__k", F.sum(F.col("__in").cast("int")).over(key)).where((F.col("__n") < 30) | (F.col("__k") < least) | F.col("__in"))
    moments = {"n_points": F.count("*"), "__xz": F.covar_samp("x", "z"), "__xx": F.var_samp("x"), "__zz": F.var_samp("z")}
    rows = rows.select(*keys, "x", "y", "z", *[f.over(key).alias(name) for name, f in moments.items()])
    rows = rows.withColumn("yaw", -0.5 * F.atan2(2 * F.col("__xz"), F.col("__xx") - F.col("__zz")))
    c, s = F.cos("yaw"), F.sin("yaw")
    turned = rows.withColumns({"u": c * F.col("x") - s * F.col("z"), "v": F.col("y"), "w": s * F.col("x") + c * F.col("z")})
    ends = {f"{a}{i}": (a, q) for a in "uvw" for i, q in ((0, low), (1, 1 - low))}
    extremes = [f(a).alias(f"{a}{name}") for a in "uvw" for f, name in ((F.min, "least"), (F.max, "most"))]
    box = quantiles(turned, keys, ends, F.first("yaw").alias("yaw"), F.first("n_points").alias("n_points"), *extremes)
    full = F.col("n_points") >= 20
    box = box.withColumns({f"{a}{i}": F.when(full, F.col(f"{a}{i}")).otherwise(F.col(f"{a}{other}")) for a in "uvw" for i, other in ((0, "least"), (1, "most"))})
    mid_u, mid_w = (F.col("u0") + F.col("u1")) / 2, (F.col("w0") + F.col("w1")) / 2
    size = lambda n: F.greatest(F.col(f"{n}1") - F.col(f"{n}0"), F.lit(1e-4))
    place = [(c * mid_u + s * mid_w).alias("cx"), ((F.col("v0") + F.col("v1")) / 2).alias("cy"), (-s * mid_u + c * mid_w).alias("cz")]
    return box.select(*keys, "n_points", "yaw", *place, size("u").alias("length"), size("v").alias("height"), size("w").alias("width"))


def voxels(points: DataFrame, size: float, keys=("obj",)) -> DataFrame:
    """The mean point of each voxel."""
    cell = [F.floor(F.col(c) / size).alias(f"v{c}") for c in "xyz"]
    return points.groupBy(*keys, *cell).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in "xyz"])


def fused(points: DataFrame, pixel, least_views: int) -> DataFrame:
    """The mean of the views of each pixel that least_views or more agree on."""
    return points.groupBy(*pixel).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in "xyz"]).where(F.col("n") >= least_views)


def majority(votes: DataFrame, keys=("track_id",), name: str = "name", rank: str = "frame_idx", default: str = "object") -> DataFrame:
    """The most frequent name but the default; of equally frequent ones that which came first."""
    n = votes.groupBy(*keys, name).agg(F.count("*").alias("n"), F.min(rank).alias("first"))
    order = F.struct((F.col(name) != default).alias("named"), "n", (-F.col("first")).alias("first"))
    return n.groupBy(*keys).agg(F.max_by(name, order).alias("name"), F.max_by("n", order).alias("votes"))


def best_crop(obs: DataFrame, keys=("track_id",)) -> DataFrame:
    """The row of the highest (score, brightness), the first of equal ones."""
    order = F.struct("score", "ext_x", (-F.col("frame_idx")).alias("o"))
    return obs.groupBy(*keys).agg(F.max_by("frame_idx", order).alias("frame_idx"), F.max("score").alias("score"))


def least_squares_scale(a: Column, b: Column, eps: float = 1e-12) -> Column:
    return F.sum(a * b) / F.greatest(F.sum(b * b), F.lit(eps))


def weighted_quantile(df: DataFrame, value: str, weight: str, q: float, keys=("obj",)) -> DataFrame:
    """The least value at which the weights so far reach a share q of all."""
    o = W.partitionBy(*keys).orderBy(value, "pid")
    w = df.withColumns({"__cum": F.sum(weight).over(o.rowsBetween(W.unboundedPreceding, 0)), "__all": F.sum(weight).over(W.partitionBy(*keys))})
    return w.where(F.col("__cum") >= q * F.col("__all") - 1e-12).groupBy(*keys).agg(F.min(value).alias("quantile"))


def confidence_threshold(df: DataFrame, conf: str, floor: float, low: float = 0.1, high: float = 0.9, keys=("obj",)) -> DataFrame:
    ends = quantiles(df, keys, {"__low": (conf, low), "__high": (conf, high)})
    return ends.select(*keys, F.least(F.greatest(F.lit(floor), F.col("__low")), F.col("__high")).alias("threshold"))


def scene_scale(points: DataFrame, keys=("obj",)) -> DataFrame:
    """The diagonal of the box of the 5th to 95th percentiles."""
    ends = quantiles(points, keys, {f"__{c}{q}": (c, q / 100) for c in "xyz" for q in (5, 95)})
    return ends.select(*keys, F.sqrt(sum(((F.col(f"__{c}95") - F.col(f"__{c}5")) ** 2 for c in "xyz"), F.lit(0.0))).alias("scale"))


def min_max_reference(df: DataFrame, columns, key: str, keys=("label",)) -> DataFrame:
    """The row whose columns, each scaled to its group's range, lie nearest to the middle of all."""
    g = W.partitionBy(*keys)
    off = sum((F.abs(F.coalesce((F.col(c) - F.min(c).over(g)) / F.nullif(F.max(c).over(g) - F.min(c).over(g), F.lit(0.0)), F.lit(0.0)) - 0.5) for c in columns), F.lit(0.0))
    return df.withColumn("__off", F.round(off, 9)).groupBy(*keys).agg(F.min_by(key, F.struct("__off", key)).alias(key))


def patch_grid(pixels: DataFrame, height: int, width: int, keys=("grp", "id"), grid: int = 16, coverage: float = 0.5) -> DataFrame:
    """Cells of a grid of which more than coverage is masked, in row order: the last row and column take what the division leaves."""
    ch, cw = height // grid, width // grid
    row, col = F.least(F.floor(F.col("v") / ch), F.lit(grid - 1)), F.least(F.floor(F.col("u") / cw), F.lit(grid - 1))
    tall, wide = height - (grid - 1) * ch, width - (grid - 1) * cw
    area = F.when(F.col("row") == grid - 1, tall).otherwise(ch) * F.when(F.col("col") == grid - 1, wide).otherwise(cw)
    return pixels.groupBy(*keys, row.alias("row"), col.alias("col")).agg(F.count("*").alias("n")).withColumn("cover", F.col("n") / area).where(F.col("cover") > coverage)


def colour_histogram(df: DataFrame, columns: dict, keys=("obj",)) -> DataFrame:
    """Shares of the values in equal bins, the columns' bins one after the other; columns: name -> (low, high, bins)."""
    total = sum(n for _, _, n in columns.values())
    parts, offset = [], 0
    for c, (lo, hi, n) in columns.items():
        at = F.least(F.greatest(F.floor((F.col(c) - lo) / (hi - lo) * n), F.lit(0)), F.lit(n - 1))
        parts += [F.sum((at == i).cast("int")) / (F.count("*") * len(columns)) for i in range(n)]
        offset += n
    assert offset == total
    return df.groupBy(*keys).agg(F.array(*parts).alias("hist"))


def step_tokens(df: DataFrame, keys, time: str = "ts_s") -> DataFrame:
    """First and last time of each step."""
    return df.groupBy(*keys).agg(F.min(time).alias("t_start"), F.max(time).alias("t_end"))
