"""Files from tables. A task writes what it has; only formats of one file gather rows, and say so."""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .readers import CAMERA_MODELS


def ply_bytes(rows) -> bytes:
    head = f"ply\nformat binary_little_endian 1.0\nelement vertex {len(rows)}\n" + "".join(f"property float {c}\n" for c in "xyz") + "".join(f"property uchar {c}\n" for c in ("red", "green", "blue")) + "end_header\n"
    return head.encode() + b"".join(struct.pack("<fffBBB", *r) for r in rows)


def confident_points(points: DataFrame, threshold: float, most: int | None = None, conf: str = "conf", key: str = "pid", seed: int = 42) -> DataFrame:
    """Points of a confidence of threshold or more, and above 1e-5; a hashed sample of most of them."""
    kept = points.where((F.col(conf) >= threshold) & (F.col(conf) > 1e-5))
    return kept if most is None else kept.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(most)


def cameras_bytes(rows) -> bytes:
    number = {name: i for i, (name, _) in CAMERA_MODELS.items()}
    return struct.pack("<Q", len(rows)) + b"".join(struct.pack(f"<iiQQ{len(r['params'])}d", r["camera_id"], number[r["model"]], r["width"], r["height"], *r["params"]) for r in rows)


def images_bytes(rows) -> bytes:
    out = struct.pack("<Q", len(rows))
    for r in rows:
        out += struct.pack("<i7di", r["image_id"], *r["qvec"], *r["tvec"], r["camera_id"]) + r["name"].encode() + b"\0" + struct.pack("<Q", len(r["xys"]))
        out += b"".join(struct.pack("<ddq", *xy, p) for xy, p in zip(r["xys"], r["point3d_ids"]))
    return out


def points_bytes(rows) -> bytes:
    out = struct.pack("<Q", len(rows))
    for r in rows:
        out += struct.pack("<QdddBBBdQ", r["point3d_id"], *r["xyz"], *r["rgb"], r["error"], len(r["image_ids"]))
        out += b"".join(struct.pack("<ii", a, b) for a, b in zip(r["image_ids"], r["point2d_idxs"]))
    return out


def text_lines(df: DataFrame, *columns) -> DataFrame:
    """One line a row: values apart by spaces, arrays spelled out."""
    kinds = dict(df.dtypes)
    part = lambda c: F.array_join(F.col(c).cast("array<string>"), " ") if kinds[c].startswith("array") else F.col(c).cast("string")
    return df.select(F.concat_ws(" ", *map(part, columns)).alias("value"))


def detection_rows(predictions: DataFrame) -> DataFrame:
    """image_id, category_id, bbox (x, y, w, h), score: a row for each of an image's boxes."""
    flat = predictions.select("image_id", F.explode(F.arrays_zip("boxes", "scores", "labels")).alias("p"))
    b = F.col("p.boxes")
    return flat.select("image_id", F.col("p.labels").alias("category_id"), F.array(b[0], b[1], b[2] - b[0], b[3] - b[1]).alias("bbox"), F.col("p.scores").alias("score"))


def merged_shards(df: DataFrame, most: int, keys=("image_id", "category_id"), shard: str = "shard") -> DataFrame:
    """Of each image and category the first shard's rows; of each image the most best."""
    kept = df.withColumn("__f", F.min(shard).over(W.partitionBy(*keys))).where(F.col(shard) == F.col("__f"))
    n = F.row_number().over(W.partitionBy(keys[0]).orderBy(F.desc("score"), *keys, "pos"))
    return kept.withColumn("__n", n).where(F.col("__n") <= most).drop("__f", "__n")


def video_to_frames(annotations: DataFrame, images: DataFrame, drop_zero: bool = False) -> DataFrame:
    """Annotations of tracks with an array of boxes, as a row for each frame with a box; images: (image_id, video_id, frame_index). A frame without an image is an error at run time."""
    flat = annotations.select("id", "video_id", "category_id", F.posexplode("bboxes").alias("frame_index", "bbox")).where("bbox is not null")
    if drop_zero:
        flat = flat.where(F.exists("bbox", lambda v: v != 0))
    joined = flat.join(images, ["video_id", "frame_index"], "left")
    image = F.when(F.col("image_id").isNull(), F.raise_error(F.lit("a frame has no image")).cast("bigint")).otherwise(F.col("image_id"))
    return joined.select(F.col("id").alias("track_id"), "video_id", "category_id", image.alias("image_id"), "bbox")
