"""Greedy suppression, each variant with its own order, ties and boundary.

A group's boxes become one array, ordered by the variant's rule, and a fold keeps those that no kept box suppresses; all in the JVM. A group is a frame, an image or a track list, so its array is bounded by what one frame shows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULTS
from ..functions import boxes as B

BOX = ("x0", "y0", "x1", "y1")


def of(s: Column) -> B.Box:
    return tuple(s[c] for c in BOX)


def greedy(df: DataFrame, keys, order: list[Column], suppressed_by: Callable[[Column, Column], Column], columns) -> DataFrame:
    """The rows that stay: taken in order, each unless suppressed_by(row, kept row) holds for a row kept before."""
    rows = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order)], *columns))).alias("__rows"))
    kind = rows.schema["__rows"].dataType
    keep = F.aggregate("__rows", F.array().cast(kind), lambda kept, r: F.when(F.exists(kept, lambda k: suppressed_by(r, k)), kept).otherwise(F.concat(kept, F.array(r))))
    return rows.select(*keys, F.explode(keep).alias("__r")).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in columns])


def _boxes(df: DataFrame, keys, order, rule, extra=("id", "score")) -> DataFrame:
    return greedy(df, keys, order, rule, (*extra, *BOX))


def mask_dedup(df: DataFrame, keys=("grp",), threshold: float = DEFAULTS.mask_dedup_iou) -> DataFrame:
    """Highest score first; IoU of threshold or more suppresses."""
    return _boxes(df, keys, [-F.col("score"), F.col("id")], lambda r, k: B.iou(of(r), of(k)) >= threshold)


def nms(df: DataFrame, keys=("grp",), min_score: float = 0.0, threshold: float = 0.5, overlap: str = "iou") -> DataFrame:
    """Scores above min_score only; boxes overlapping by more than threshold are suppressed. Of equal scores the later one goes first."""
    measure = B.iom if overlap == "iom" else B.iou
    return _boxes(df.where(F.col("score") > min_score), keys, [-F.col("score"), -F.col("id")], lambda r, k: measure(of(r), of(k)) > threshold)


def overlap_removal(df: DataFrame, keys=("grp",), threshold: float = DEFAULTS.overlap_iom) -> DataFrame:
    """Every row with kept: highest score first, an IoM above threshold removes."""
    left = _boxes(df, keys, [-F.col("score"), F.col("id")], lambda r, k: B.iom(of(r), of(k)) > threshold)
    marked = left.select(*keys, "id", F.lit(True).alias("__kept"))
    return df.join(marked, [*keys, "id"], "left").withColumn("kept", F.coalesce("__kept", F.lit(False))).drop("__kept")


def frame_nms(df: DataFrame, keys=("grp",), threshold: float = 0.5) -> DataFrame:
    """Every row; the box of a suppressed one (IoU of threshold or more) is null."""
    left = mask_dedup(df, keys, threshold).select(*keys, "id", F.lit(True).alias("__kept"))
    return df.join(left, [*keys, "id"], "left").withColumns({c: F.when(F.col("__kept"), F.col(c)) for c in BOX}).drop("__kept")


def track_pairs(df: DataFrame, video: str = "video", track: str = "id", frame: str = "grp") -> DataFrame:
    """(video, a, b, shared, inter, whole, least): sums over shared frames of the overlaps of two tracks' boxes."""
    a, b = df.alias("a"), df.alias("b")
    on = (F.col(f"a.{video}") == F.col(f"b.{video}")) & (F.col(f"a.{frame}") == F.col(f"b.{frame}")) & (F.col(f"a.{track}") < F.col(f"b.{track}"))
    left, right = B.box(prefix="a."), B.box(prefix="b.")
    return a.join(b, on).groupBy(F.col(f"a.{video}").alias("video"), F.col(f"a.{track}").alias("a"), F.col(f"b.{track}").alias("b")).agg(
        F.count("*").alias("shared"), F.sum(B.intersection(left, right)).alias("inter"), F.sum(B.union(left, right)).alias("whole"), F.sum(F.least(B.area(left), B.area(right))).alias("least")
    )


def track_nms(df: DataFrame, scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(video, id, kept): tracks by score, suppressed by a kept track of a pooled IoU of threshold or more over shared frames."""
    pairs = track_pairs(df).where(F.col("inter") / F.col("whole") >= threshold)
    both = pairs.select("video", F.col("a").alias("id"), F.col("b").alias("other")).union(pairs.select("video", "b", "a")).groupBy("video", "id").agg(F.collect_set("other").alias("others"))
    rows = scores.join(both, ["video", "id"], "left").withColumn("others", F.coalesce("others", F.array().cast("array<bigint>")))
    left = greedy(rows, ["video"], [-F.col("score"), F.col("id")], lambda r, k: F.array_contains(r["others"], k["id"]), ("id", "others"))
    return scores.join(left.select("video", "id", F.lit(True).alias("__kept")), ["video", "id"], "left").select("video", "id", "score", F.coalesce("__kept", F.lit(False)).alias("kept"))


def loop_nms(edges: DataFrame, width: int = DEFAULTS.loop_nms, keys=()) -> DataFrame:
    """Edges (i < j, sim): the most similar first; others whose ends are both within width of a kept one's go."""
    near = lambda r, k: (F.abs(r["i"] - k["i"]) <= width) & (F.abs(r["j"] - k["j"]) <= width)
    keys = list(keys) or ["__all"]
    return greedy(edges.withColumn("__all", F.lit(0)) if keys == ["__all"] else edges, keys, [-F.col("sim"), F.col("i"), F.col("j")], near, ("i", "j", "sim")).drop("__all")


def edge_reduction(edges: DataFrame, most: int, gap: int = 30, width: int = 2, keys=("grp",)) -> DataFrame:
    """Edges by rising magnitude, j - i of gap or more, none with an i within width of a kept one's, most of them at most."""
    left = greedy(edges.where(F.col("j") - F.col("i") >= gap), keys, [F.col("mag"), F.col("i"), F.col("j")], lambda r, k: F.abs(r["i"] - k["i"]) <= width, ("i", "j", "mag"))
    rows = left.groupBy(*keys).agg(F.slice(F.array_sort(F.collect_list(F.struct("mag", "i", "j"))), 1, most).alias("e"))
    return rows.select(*keys, F.explode("e").alias("e")).select(*keys, "e.i", "e.j", "e.mag")


def radius_thinning(points: DataFrame, radius: float, keys=("obj",)) -> DataFrame:
    """Points in a hashed order, each unless a kept one lies within radius."""
    near = lambda r, k: (r["x"] - k["x"]) * (r["x"] - k["x"]) + (r["y"] - k["y"]) * (r["y"] - k["y"]) + (r["z"] - k["z"]) * (r["z"] - k["z"]) < radius * radius
    return greedy(points, keys, [F.md5(F.col("pid").cast("string"))], near, ("pid", "x", "y", "z"))


def anchor_dedup(df: DataFrame, keys=("video",), min_area: float = 100, iou: float = 0.4, distance: float = 0.05, iom: float = 0.7, width: float = 64, height: float = 64) -> DataFrame:
    """Anchors in order of time: one that matches a kept object, by IoU, else by near centres of like areas, else by containment, renews its last box; others are new objects. (keys, object, n, first_id, box)."""
    rows = df.where(B.area(B.box()) >= min_area).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("grp", "id", *BOX))).alias("__rows"))
    state = "array<struct<first_grp:bigint,first_id:bigint,n:int,x0:double,y0:double,x1:double,y1:double>>"

    def matches(o: Column, r: Column) -> Column:
        a, b = of(o), of(r)
        (ax, ay, _, _), (bx, by, _, _) = B.xyxy_to_cxcywh(a), B.xyxy_to_cxcywh(b)
        near = F.sqrt(((ax - bx) / width) ** 2 + ((ay - by) / height) ** 2) < distance
        ratio = B.area(a) / B.area(b)
        return (B.iou(a, b) >= iou) | (near & (ratio >= 0.5) & (ratio <= 2)) | (B.iom(a, b) >= iom)

    def renewed(o: Column, r: Column) -> Column:
        contained = ~(B.iou(of(o), of(r)) >= iou) & (B.area(of(o)) > B.area(of(r))) & (B.iom(of(o), of(r)) >= iom)  # a larger box is not replaced by what it holds
        pick = lambda c: F.when(contained, o[c]).otherwise(r[c]).alias(c)
        return F.struct(o["first_grp"].alias("first_grp"), o["first_id"].alias("first_id"), (o["n"] + 1).alias("n"), *[pick(c) for c in BOX])

    def step(objects: Column, r: Column) -> Column:
        hit = F.array_min(F.filter(F.transform(objects, lambda o, i: F.when(matches(o, r), i)), lambda i: i.isNotNull()))
        fresh = F.array(F.struct(r["grp"].alias("first_grp"), r["id"].alias("first_id"), F.lit(1).alias("n"), *[r[c].alias(c) for c in BOX]))
        return F.when(hit.isNull(), F.concat(objects, fresh)).otherwise(F.transform(objects, lambda o, i: F.when(i == hit, renewed(o, r)).otherwise(o)))

    kept = rows.withColumn("__objects", F.aggregate("__rows", F.array().cast(state), step))
    return kept.select(*keys, F.posexplode("__objects").alias("object", "__o")).select(*keys, "object", "__o.*")
