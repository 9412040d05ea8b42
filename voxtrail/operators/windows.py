"""Windows over tracks: smoothing, slopes, phases, fills, chunks and sampling. All keep one shuffle by the track's key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import DEFAULTS


def by(keys, order) -> W:
    return W.partitionBy(*keys).orderBy(*order)


def moving_average(df: DataFrame, columns, keys=("track_id",), order=("frame_idx",), window: int = DEFAULTS.smooth_window, suffix: str = "_s") -> DataFrame:
    """Centred averages that shrink at the ends; tracks of fewer than 3 rows, and windows of 1 or less, stay as they are."""
    w = by(keys, order).rowsBetween(-(window // 2), window // 2)
    n = F.count("*").over(W.partitionBy(*keys))
    smooth = lambda c: F.when(n >= 3, F.avg(c).over(w)).otherwise(F.col(c)) if window > 1 else F.col(c)
    return df.withColumns({c + suffix: smooth(c) for c in columns})


def circular_yaw(df: DataFrame, yaw: str = "yaw", keys=("track_id",), order=("frame_idx",), window: int = DEFAULTS.smooth_window) -> DataFrame:
    """Mean of an angle modulo pi: on the circle of twice the angle. Nulls in the window are passed over; a null centre gives 0."""
    w = by(keys, order).rowsBetween(-(window // 2), window // 2)
    mean = F.atan2(F.sum(F.sin(2 * F.col(yaw))).over(w), F.sum(F.cos(2 * F.col(yaw))).over(w)) / 2
    return df.withColumn(yaw + "_s", F.when(F.col(yaw).isNull(), 0.0).otherwise(mean))


def velocity(df: DataFrame, columns, time: str = "ts_s", keys=("track_id",), order=("frame_idx",), half: int = DEFAULTS.velocity_half_window, least_span: float = DEFAULTS.velocity_min_span_s) -> DataFrame:
    """Slopes by least squares over 2*half+1 rows, where there are 3 and time passes; else by the neighbours; else 0."""
    o = by(keys, order)
    w = o.rowsBetween(-half, half)
    t = F.col(time)
    enough = (F.count("*").over(w) >= 3) & (F.max(t).over(w) - F.min(t).over(w) > least_span)
    before, after = F.lag(t).over(o), F.lead(t).over(o)

    def slope(c: str) -> Column:
        v, back, ahead = F.col(c), F.lag(c).over(o), F.lead(c).over(o)
        return (
            F.when(enough, F.regr_slope(v, t).over(w))
            .when(after - before > least_span, (ahead - back) / (after - before))
            .when(after - t > least_span, (ahead - v) / (after - t))
            .when(t - before > least_span, (v - back) / (t - before))
            .otherwise(0.0)
        )

    return df.withColumns({"v" + c: slope(c) for c in columns})


def path_statistics(df: DataFrame, x: str = "x", y: str = "y", z: str = "z", keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """Per track: rows, length of its path, distance of its ends, and range of each axis."""
    o = by(keys, order)
    step = F.sqrt(sum(((F.col(c) - F.lag(c).over(o)) ** 2 for c in (x, y, z)), F.lit(0.0)))
    ends = F.sqrt(sum(((F.max_by(c, order[0]) - F.min_by(c, order[0])) ** 2 for c in (x, y, z)), F.lit(0.0)))
    return df.withColumn("__step", step).groupBy(*keys).agg(F.count("*").alias("n_obs"), F.coalesce(F.sum("__step"), F.lit(0.0)).alias("path_length"), ends.alias("displacement"), *[(F.max(c) - F.min(c)).alias(f"range_{c}") for c in (x, y, z)])


def motion_phases(df: DataFrame, column: str, still: float, keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """Runs of rows that move one way: (keys, phase, sign, first, last, n)."""
    o = by(keys, order)
    step = F.col(column) - F.lag(column).over(o)
    signed = df.withColumn("__sign", F.when(step > still, 1).when(step < -still, -1).otherwise(0)).withColumn("__first", F.row_number().over(o))
    moved = signed.where("__first > 1").withColumn("__new", F.coalesce((F.col("__sign") != F.lag("__sign").over(o)).cast("int"), F.lit(1)))
    return moved.withColumn("phase", F.sum("__new").over(o)).groupBy(*keys, "phase").agg(F.first("__sign").alias("sign"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("n"))


def reversals(phases: DataFrame, keys=("track_id",), oscillates_at: int = 3) -> DataFrame:
    """Per track the changes between the two ways of moving, still phases left out."""
    o = W.partitionBy(*keys).orderBy("phase")
    turned = phases.where("sign <> 0").withColumn("__turn", (F.col("sign") != F.lag("sign").over(o)).cast("int"))
    return turned.groupBy(*keys).agg(F.coalesce(F.sum("__turn"), F.lit(0)).alias("n_reversals")).withColumn("oscillates", F.col("n_reversals") >= oscillates_at)


def box_filter(df: DataFrame, column: str, keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """Mean of three rows; what lies beyond the ends counts as 0."""
    o = by(keys, order)
    return df.withColumn(column + "_f", (F.coalesce(F.lag(column).over(o), F.lit(0.0)) + F.col(column) + F.coalesce(F.lead(column).over(o), F.lit(0.0))) / 3)


# Halves of the kernels of 1, 3, 5 and 7 rows, from the middle on.
SMALL_KERNELS = ((1.0,), (0.5, 0.25), (0.375, 0.25, 0.0625), (0.28125, 0.21875, 0.109375, 0.03125))


def gaussian_path(df: DataFrame, column: str, size: int = 45, keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """A path smoothed with a Gaussian kernel of an odd size, no longer than the path (3 at least where it has 3 rows), and of deviation 0.3 * ((size - 1) / 2 - 1) + 0.8 from 9 rows on (SMALL_KERNELS below); beyond its ends the path is reflected about the first and last row. Paths of one row stay as they are.

    The kernel's size depends on the path, so its weights are expressions; a window of each side holds what the kernel can reach, reflection included."""
    size = max(1, size) | 1
    half = size // 2
    w = W.partitionBy(*keys).orderBy(*order)
    n, place = F.count("*").over(W.partitionBy(*keys)), F.row_number().over(w)
    odd = F.when(F.col("__n") % 2 == 1, F.col("__n")).otherwise(F.col("__n") - 1)
    k = F.least(F.lit(size), F.greatest(odd, F.lit(1)))
    k = F.when((F.col("__n") >= 3) & (k < 3), 3).otherwise(k)
    near = F.collect_list(F.col(column).cast("double")).over(w.rowsBetween(-half, half))
    # the window starts at row max(1, place - half), and a reflected row is no farther than half
    rows = df.withColumns({"__n": n, "__place": place}).withColumns({"__near": near, "__half": F.floor(k / 2).cast("int")})
    sigma = 0.3 * (F.col("__half") - 1) + 0.8
    start = F.greatest(F.lit(1), F.col("__place") - half)

    def reflected(i: Column) -> Column:
        at = F.col("__place") + i
        at = F.when(at < 1, 2 - at).otherwise(F.when(at > F.col("__n"), 2 * F.col("__n") - at).otherwise(at))
        return F.element_at("__near", (at - start + 1).cast("int"))

    steps = F.sequence(-F.col("__half"), F.col("__half"))
    small = F.element_at(F.array(*[F.array(*map(F.lit, k)) for k in SMALL_KERNELS]), F.least(F.col("__half") + 1, F.lit(len(SMALL_KERNELS))))
    weight = lambda i: F.when(F.col("__half") < len(SMALL_KERNELS), F.element_at(small, F.least(F.abs(i), F.size(small) - 1) + 1)).otherwise(F.exp(-(i * i) / (2 * sigma * sigma)))
    total = lambda f: F.aggregate(F.transform(steps, f), F.lit(0.0), lambda s, x: s + x)
    smooth = total(lambda i: weight(i) * reflected(i)) / total(weight)
    return rows.withColumn(column + "_g", F.when(F.col("__n") <= 1, F.col(column).cast("double")).otherwise(smooth)).drop("__n", "__place", "__near", "__half")


def camera_motion(df: DataFrame, keys=("track_id",), order: str = "frame_idx") -> DataFrame:
    """How far the last pose is from the first, in words."""
    d = F.sqrt(sum(((F.max_by(c, order) - F.min_by(c, order)) ** 2 for c in ("x", "y", "z")), F.lit(0.0)))
    return df.groupBy(*keys).agg(d.alias("moved")).withColumn("motion", F.when(F.col("moved") < 0.01, "static").when(F.col("moved") < 0.3, "slight").when(F.col("moved") < 1.0, "moderate").otherwise("large"))


def estimated_fps(df: DataFrame, time: str = "ts_s", keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """1 by the median of the positive time steps."""
    step = df.withColumn("__dt", F.col(time) - F.lag(time).over(by(keys, order)))
    return step.where("__dt > 0").groupBy(*keys).agg((1 / F.percentile("__dt", F.lit(0.5))).alias("fps"))


def fill_from_keyframes(df: DataFrame, column: str, is_key: Column, keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """The value of the nearest keyframe at or before each row; null before the first."""
    w = by(keys, order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(column + "_key", F.last(F.when(is_key, F.col(column)), ignorenulls=True).over(w))


def nearest_keyframe(frame: Column, stride: int, last: Column) -> Column:
    """Number of the keyframe nearest to a frame: halves go to the even one."""
    return F.least(F.bround(frame / stride).cast("int"), last)


def sample_by_time(df: DataFrame, fps: float = DEFAULTS.target_fps, time: str = "ts_s", keys=("track_id",), order=("ts_s", "frame_idx"), most: int | None = None) -> DataFrame:
    """The first frame of each time slot of 1/fps, up to most frames a key."""
    slot = F.floor((F.col(time) + 1e-9) * fps)
    kept = df.withColumn("__slot", slot).withColumn("__n", F.row_number().over(W.partitionBy(*keys, "__slot").orderBy(*order))).where("__n = 1").drop("__n", "__slot")
    if most is None:
        return kept
    return kept.withColumn("__n", F.row_number().over(by(keys, order))).where(F.col("__n") <= most).drop("__n")


def every_kth(df: DataFrame, k: int, frame: str = "frame_idx") -> DataFrame:
    return df.where(F.col(frame) % k == 0)


def chunks(lengths: DataFrame, size: int, overlap: int, n: str = "n", merge_last: bool = True) -> DataFrame:
    """(keys, chunk, start, stop): windows of size with overlap; a last one that holds overlap only, or less, is merged into the one before."""
    step = size - overlap
    least = F.when(F.col(n) <= size, 1).otherwise(F.ceil((F.col(n) - (overlap if merge_last else 0)) / step)).cast("int")
    cut = lengths.where(F.col(n) > 0).withColumn("__chunks", F.greatest(least, F.lit(1))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
    stop = F.when(F.col("chunk") == F.col("__chunks") - 1, F.col(n)).otherwise(F.least(F.col("chunk") * step + size, F.col(n)))
    return cut.withColumn("start", F.col("chunk") * step).withColumn("stop", stop.cast("int")).drop("__chunks")


def sample_stages(df: DataFrame, stages: int, stride: int, stage: str = "frame_idx", keys=("track_id",), start: int = 0) -> DataFrame:
    """stages rows from start on, stride apart; the stride gets smaller where there are too few rows, and keys with fewer rows than stages go."""
    n = F.count("*").over(W.partitionBy(*keys))
    fits = F.least(F.lit(stride), F.greatest(F.lit(1), F.floor((n - 1 - start) / max(1, stages - 1)))).cast("int")
    place = F.dense_rank().over(W.partitionBy(*keys).orderBy(stage)) - 1 - start
    rows = df.withColumns({"__n": n, "__stride": fits, "__place": place})
    return rows.where((F.col("__n") - start >= stages) & (F.col("__place") >= 0) & (F.col("__place") % F.col("__stride") == 0) & (F.col("__place") / F.col("__stride") < stages)).drop("__n", "__stride", "__place")


def track_states(df: DataFrame, end_frame: int, keys=("track_id",), frame: str = "frame_idx", lost: int = DEFAULTS.lost_after, archived: int = DEFAULTS.archived_after) -> DataFrame:
    """Status of each track at end_frame by its misses: a gap of archived or more misses ends it for good."""
    gap = F.lead(frame, 1, end_frame + 1).over(W.partitionBy(*keys).orderBy(frame)) - F.col(frame) - 1
    spans = df.where(F.col(frame) <= end_frame).withColumn("__gap", gap)
    first_end = F.min(F.when(F.col("__gap") >= archived, F.col(frame)))
    out = spans.groupBy(*keys).agg(F.max(frame).alias("__last"), first_end.alias("__ended"))
    seen = F.coalesce("__ended", "__last")
    streak = F.least(F.lit(end_frame) - seen, F.when(F.col("__ended").isNotNull(), archived).otherwise(F.lit(end_frame) - seen))
    return out.withColumn("last_seen", seen).withColumn("missing_streak", streak.cast("int")).withColumn("status", F.when(F.col("__ended").isNotNull(), "archived").when(F.col("missing_streak") >= lost, "lost").otherwise("active")).drop("__last", "__ended")


def confirmed(df: DataFrame, detected: Column, after: int = DEFAULTS.confirm_after, keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """Run lengths of detections, and whether a track has had a run of after rows by each row."""
    o = by(keys, order)
    run = df.withColumn("__hit", detected.cast("int")).withColumn("__miss", F.sum(1 - F.col("__hit")).over(o.rowsBetween(W.unboundedPreceding, 0)))
    run = run.withColumn("run_length", F.sum("__hit").over(W.partitionBy(*keys, "__miss").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))
    return run.withColumn("is_confirmed", F.max("run_length").over(o.rowsBetween(W.unboundedPreceding, 0)) >= after).drop("__hit", "__miss")


def hot_start(df: DataFrame, detected: Column, low: int = -4, high: int = 8, keys=("track_id",), order=("frame_idx",)) -> DataFrame:
    """A counter per track that rises by 1 with a detection and falls by 1 without, held within low and high; suppressed at 0 or less.

    The clipped walk is a running fold of (shift, floor, ceiling) maps; here it is a fold over the track's ordered rows."""
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, detected.alias("hit")))).alias("__rows"))
    step = lambda s, r: F.concat(s, F.array(F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0)) + F.when(r["hit"], 1).otherwise(-1)))))
    kept = rows.withColumn("__alive", F.aggregate("__rows", F.array().cast("array<int>"), step))
    flat = kept.select(*keys, F.explode(F.arrays_zip("__rows", "__alive")).alias("__x"))
    return flat.select(*keys, *[F.col(f"__x.__rows.{c}").alias(c) for c in order], F.col("__x.__alive").alias("keep_alive")).withColumn("suppressed", F.col("keep_alive") <= 0)
