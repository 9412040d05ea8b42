"""Predicates over detections, points, queries and objects. Nulls follow the rule each one states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULTS


def valid_depth(depth: Column, conf: Column, least: float = DEFAULTS.min_confidence) -> Column:
    """Finite, above 0, and trusted; a null confidence is trusted."""
    return ~F.isnan(depth) & (F.abs(depth) < float("inf")) & (depth > 0) & (F.coalesce(conf, F.lit(1.0)) >= least)


def plausible_candidates(shapes: DataFrame, least: int = DEFAULTS.min_points, most: float = DEFAULTS.max_extent_m, metric: bool = True) -> DataFrame:
    """Objects of least points or more and, in metric scale, no axis longer than most."""
    kept = shapes.where(F.col("n") >= least)
    return kept.where(F.greatest(*[F.col(f"{c}_max") - F.col(f"{c}_min") for c in "xyz"]) <= most) if metric else kept


def moving_tracks(speeds: DataFrame, least: float = DEFAULTS.background_speed) -> DataFrame:
    """(track_id) of a mean speed of least or more."""
    v = F.sqrt(sum((F.col(c) ** 2 for c in ("vx", "vy", "vz")), F.lit(0.0)))
    return speeds.groupBy("track_id").agg(F.avg(v).alias("mean_speed")).where(F.col("mean_speed") >= least)


def not_background(tracks: DataFrame, area: float = DEFAULTS.background_area, thin: float = DEFAULTS.background_size) -> DataFrame:
    """Without what fills the image and has no depth: a median share of the image above area, and a smallest size below thin."""
    return tracks.where(~((F.col("area_frac") > area) & (F.least("size_x", "size_y", "size_z") < thin)))


def low_texture(std: Column, edges: Column) -> Column:
    return (std < DEFAULTS.texture_std) & (edges < DEFAULTS.texture_edges)


def uniform_crop(std: Column) -> Column:
    """A crop whose pixels hardly differ."""
    return std < DEFAULTS.crop_std


def keep_n_queries(queries: DataFrame, n: int, keys=("image_id",), negative: str = "is_negative", seed: int = 0) -> DataFrame:
    """Up to n rows of each key, positives first, then in an order hashed from the seed."""
    order = W.partitionBy(*keys).orderBy(F.col(negative).cast("int"), F.md5(F.concat(F.lit(f"{seed}:"), F.col("query_id").cast("string"))), "query_id")
    return queries.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")


def without_texts(queries: DataFrame, texts, column: str = "text") -> DataFrame:
    """Queries whose text isn't listed; null texts stay."""
    return queries.where(F.coalesce(~F.col(column).isin(*texts), F.lit(True)))


def without_zero_boxes(queries: DataFrame, refs: DataFrame, objects: DataFrame) -> DataFrame:
    """Queries none of whose objects (refs: query_id, object_id) has a box without width or height."""
    flat = objects.where("(x1 - x0) <= 0 or (y1 - y0) <= 0").select("object_id")
    return queries.join(refs.join(flat, "object_id", "left_semi").select("query_id").distinct(), "query_id", "left_anti")


def too_many_outputs(queries: DataFrame, refs: DataFrame, most: int) -> DataFrame:
    """Queries of most objects or fewer."""
    return queries.join(refs.groupBy("query_id").count().where(F.col("count") > most).select("query_id"), "query_id", "left_anti")


def drop_objects(objects: DataFrame, least_area: float = 1e-6, crowd: str | None = "is_crowd") -> DataFrame:
    kept = objects.where((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) >= least_area)
    return kept.where(~F.coalesce(F.col(crowd).cast("boolean"), F.lit(False))) if crowd else kept


def exhaustive(queries: DataFrame, flag: str) -> DataFrame:
    """A false flag drops the row; null keeps it."""
    return queries.where(F.coalesce(F.col(flag), F.lit(True)))


def compacted(queries: DataFrame, refs: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries, references and objects after a filter: unreferenced objects go, and ids are dense from 0 within an image."""
    refs = refs.join(queries.select("query_id"), "query_id", "left_semi").join(objects.select("object_id"), "object_id", "left_semi")
    objects = objects.join(refs.select("object_id").distinct(), "object_id", "left_semi")
    dense = lambda df, c: df.withColumn(f"new_{c}", F.dense_rank().over(W.partitionBy("image_id").orderBy(c)) - 1)
    q, o = dense(queries, "query_id"), dense(objects, "object_id")
    r = refs.join(q.select("query_id", "new_query_id"), "query_id").join(o.select("object_id", "new_object_id"), "object_id").select(F.col("new_query_id").alias("query_id"), F.col("new_object_id").alias("object_id"))
    rename = lambda df, c: df.drop(c).withColumnRenamed(f"new_{c}", c)
    return rename(q, "query_id"), r, rename(o, "object_id")


def low_score_objects(df: DataFrame, least: float, keys=("track_id",)) -> DataFrame:
    """Rows of objects whose best score is least or more."""
    return df.join(df.groupBy(*keys).agg(F.max("score").alias("__best")).where(F.col("__best") < least).select(*keys), list(keys), "left_anti")


def assert_unique(df: DataFrame, keys) -> DataFrame:
    """df; an error at run time if a key occurs twice."""
    n = F.count("*").over(W.partitionBy(*keys))
    return df.withColumn("__n", n).where(F.when(F.col("__n") > 1, F.raise_error(F.lit(f"ids are not unique: {keys}")).cast("boolean")).otherwise(True)).drop("__n")


def exactly_one(df: DataFrame, condition: Column):
    """The one row that fits; an error for none or several."""
    found = df.where(condition).limit(2).collect()
    if len(found) != 1:
        raise LookupError(f"{len(found) or 'no'} rows where one is asked for")
    return found[0]


def discoveries(det: DataFrame, known: DataFrame, every: int = 5, least_area: float = 0.02, iou: float = 0.3, per_frame: int = 2) -> DataFrame:
    """Detections of every fifth frame, large enough and apart from all known boxes of the frame: per_frame of them, the largest first."""
    from ..functions import boxes as B

    d = det.where((F.col("frame_idx") % every == 0) & (B.area(B.box()) >= least_area))
    k = known.select(F.col("frame_idx").alias("__f"), *[F.col(c).alias(f"k_{c}") for c in ("x0", "y0", "x1", "y1")])
    apart = d.join(k, (F.col("frame_idx") == F.col("__f")) & (B.iou(B.box(), B.box(prefix="k_")) >= iou), "left_anti")
    n = F.row_number().over(W.partitionBy("frame_idx").orderBy(F.desc(B.area(B.box())), "id"))
    return apart.withColumn("__n", n).where(F.col("__n") <= per_frame).drop("__n")


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42, keys=()) -> DataFrame:
    """n rows, of each key if given, in an order hashed from the seed; the same rows each time."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    if not keys:
        return df.orderBy(h, key).limit(n)
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(h, key))).where(F.col("__n") <= n).drop("__n")


def round_robin(df: DataFrame, n: int, order, keys=()) -> DataFrame:
    """part: place modulo n."""
    return df.withColumn("part", F.pmod(F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1, F.lit(n)))


def closest_frames(df: DataFrame, at: int, most: int, keep_first: bool = True, keys=("track_id",), frame: str = "frame_idx") -> DataFrame:
    """Up to most frames: the first if asked, the nearest before and after, then by distance."""
    o = W.partitionBy(*keys)
    f = F.col(frame)
    before, after = F.max(F.when(f < at, f)).over(o), F.min(F.when(f >= at, f)).over(o)
    rank = F.when(F.lit(keep_first) & (f == F.min(f).over(o)), 0).when(f == before, 1).when(f == after, 2).otherwise(3)
    return df.withColumn("__r", rank).withColumn("__n", F.row_number().over(o.orderBy("__r", F.abs(f - at), f))).where(F.col("__n") <= most).drop("__r", "__n")
