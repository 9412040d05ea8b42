"""Nested documents: objects by frame, tracks with trajectories, prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULTS
from .windows import moving_average, velocity


def survivors(obs: DataFrame, min_obs: int = DEFAULTS.survivor_min_obs, max_extent: float = DEFAULTS.survivor_max_extent_m) -> DataFrame:
    """Tracks of min_obs observations or more whose largest median extent is max_extent at most, with their median size."""
    sizes = obs.groupBy("track_id").agg(F.count("*").alias("n_obs"), *[F.percentile(c, F.lit(0.5)).alias(f"size_{c[-1]}") for c in ("ext_x", "ext_y", "ext_z")])
    return sizes.where((F.col("n_obs") >= min_obs) & (F.greatest("size_x", "size_y", "size_z") <= max_extent))


def visible_objects(obs: DataFrame) -> DataFrame:
    """A row for each object of each frame: smoothed place, velocity and size, rounded to 4 places.

    One shuffle by track serves the windows, the sizes and the join; the sizes come from the same partitions."""
    smooth = velocity(moving_average(obs, ("x", "y", "z")), ("x_s", "y_s", "z_s"))
    r = lambda c: F.round(c, 4)
    out = smooth.join(survivors(obs), "track_id")
    return out.select("frame_idx", "track_id", "name", "ts_s", *[r(f"{a}_s").alias(a) for a in "xyz"], *[r(f"v{a}_s").alias(f"v{a}") for a in "xyz"], *[r(f"size_{a}").alias(f"size_{a}") for a in "xyz"])


def all_frames(frames: DataFrame, objects: DataFrame) -> DataFrame:
    """(frame_key, timestamp, visible_objects, json): one row for each processed frame, also without objects; keys are dense in frame order.

    frames: frame_idx, ts_s. The numbering needs all frames of a video in order, so it goes by counts of frame ranges: a range's offset is added to the place within the range."""
    item = F.struct(F.col("track_id").alias("id"), "name", F.array("x", "y", "z").alias("position"), F.array("vx", "vy", "vz").alias("velocity"), F.array("size_x", "size_y", "size_z").alias("size"))
    grouped = objects.groupBy("frame_idx").agg(F.array_sort(F.collect_list(item)).alias("visible_objects"))
    ranged = frames.withColumn("__range", F.floor(F.col("frame_idx") / 4096))
    starts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    starts = starts.withColumn("__start", F.coalesce(F.sum("__n").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    numbered = ranged.join(starts, "__range").withColumn("number", F.col("__start") + F.row_number().over(W.partitionBy("__range").orderBy("frame_idx")) - 1)
    joined = numbered.join(grouped, "frame_idx", "left").withColumn("visible_objects", F.coalesce("visible_objects", F.array().cast(grouped.schema["visible_objects"].dataType)))
    body = F.struct(F.col("ts_s").alias("timestamp"), "visible_objects")
    return joined.select("frame_idx", F.concat(F.lit("frame_"), F.col("number").cast("string")).alias("frame_key"), F.col("ts_s").alias("timestamp"), "visible_objects", F.to_json(body).alias("json"))


def scene_graph(obs: DataFrame, last: int | None = None, max_extent: float = DEFAULTS.survivor_max_extent_m) -> DataFrame:
    """A row for each track: median size rounded to 2 places, then compared with max_extent, first image place and its trajectory, of the last rows if asked."""
    point = F.struct("frame_idx", *[F.round(c, 2).alias(c) for c in ("x", "y", "z")])
    size = lambda c: F.round(F.percentile(c, F.lit(0.5)), 2)
    tracks = obs.groupBy("track_id").agg(F.count("*").alias("n_obs"), size("ext_x").alias("size_x"), size("ext_y").alias("size_y"), size("ext_z").alias("size_z"), F.min_by("cx", "frame_idx").alias("cx"), F.min_by("cy", "frame_idx").alias("cy"), F.array_sort(F.collect_list(point)).alias("trajectory"))
    tracks = tracks.where((F.col("n_obs") >= DEFAULTS.survivor_min_obs) & (F.greatest("size_x", "size_y", "size_z") <= max_extent))
    return tracks.withColumn("trajectory", F.slice("trajectory", F.greatest(F.size("trajectory") - last + 1, F.lit(1)), last)) if last else tracks


def prompt_text(graph: DataFrame) -> DataFrame:
    """A line of text for each track and one for each of its points."""
    line = F.transform("trajectory", lambda p: F.format_string("  F%d pos=[%.3f,%.3f,%.3f]", p["frame_idx"], p["x"], p["y"], p["z"]))
    head = F.format_string("object %d size=[%.2f,%.2f,%.2f]", "track_id", "size_x", "size_y", "size_z")
    return graph.select("track_id", F.array_join(F.concat(F.array(head), line), "\n").alias("text"))
