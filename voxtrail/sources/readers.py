"""Tables from the file formats of scenes: camera models, annotations, tracks, poses, point clouds.

Text and JSON are read by Spark's own readers; binary files come as whole files, one task for each, and are parsed in Arrow batches."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Numbers and parameters of the camera models.
CAMERA_MODELS = {0: ("SIMPLE_PINHOLE", 3), 1: ("PINHOLE", 4), 2: ("SIMPLE_RADIAL", 4), 3: ("RADIAL", 5), 4: ("OPENCV", 8), 5: ("OPENCV_FISHEYE", 8), 6: ("FULL_OPENCV", 12), 7: ("FOV", 5), 8: ("SIMPLE_RADIAL_FISHEYE", 4), 9: ("RADIAL_FISHEYE", 5), 10: ("THIN_PRISM_FISHEYE", 12)}
# Extensions by kind of input.
VIDEO, IMAGE = (".mp4", ".mov", ".avi", ".mkv", ".webm"), (".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tif", ".tiff")
CAMERAS = "camera_id int, model string, width long, height long, params array<double>"
IMAGES = "image_id int, qvec array<double>, tvec array<double>, camera_id int, name string, xys array<array<double>>, point3d_ids array<long>"
POINTS = "point3d_id long, xyz array<double>, rgb array<int>, error double, image_ids array<int>, point2d_idxs array<int>"


def kind_of(path: str, names: list[str] | None = None) -> str:
    """image, video, images, colmap or unknown, from a path and, for a folder, the names in it."""
    low = path.lower()
    if low.endswith(VIDEO):
        return "video"
    if low.endswith(IMAGE):
        return "image"
    names = [n.lower() for n in names or ()]
    if any(n.endswith(("cameras.bin", "cameras.txt")) or n == "sparse" for n in names):
        return "colmap"
    return "images" if any(n.endswith(IMAGE) for n in names) else "unknown"


def files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) in order of path."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).orderBy("path")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(F.split(F.trim("value"), r"\s+").alias("w"))


def _tail(from_: int, kind: str = "double"):
    return F.slice("w", from_, F.greatest(F.size("w") - from_ + 1, F.lit(0))).cast(f"array<{kind}>")


def cameras_text(spark: SparkSession, path: str) -> DataFrame:
    w = F.col("w")
    return _lines(spark, path).select(w[0].cast("int").alias("camera_id"), w[1].alias("model"), w[2].cast("long").alias("width"), w[3].cast("long").alias("height"), _tail(5).alias("params"))


def points_text(spark: SparkSession, path: str) -> DataFrame:
    w = F.col("w")
    track = _tail(9, "int")
    pick = lambda odd: F.filter(track, lambda x, i: i % 2 == odd)
    return _lines(spark, path).select(w[0].cast("long").alias("point3d_id"), F.slice(w, 2, 3).cast("array<double>").alias("xyz"), F.slice(w, 5, 3).cast("array<int>").alias("rgb"), w[7].cast("double").alias("error"), pick(0).alias("image_ids"), pick(1).alias("point2d_idxs"))


def images_text(spark: SparkSession, path: str) -> DataFrame:
    """Two lines an image, the second may be empty: files are read whole, one task for each."""

    def run(batches):
        for b in batches:
            rows = []
            for text in b.column("value").to_pylist():
                lines = [x for x in text.split("\n") if not x.startswith("#")]
                while lines and not lines[0].strip():
                    lines.pop(0)
                for head, pts in zip(lines[::2], lines[1::2] + [""]):
                    w, p = head.split(), pts.split()
                    if len(w) >= 10:
                        rows.append((int(w[0]), [float(x) for x in w[1:5]], [float(x) for x in w[5:8]], int(w[8]), " ".join(w[9:]), [[float(x), float(y)] for x, y in zip(p[::3], p[1::3])], [int(x) for x in p[2::3]]))
            yield _batch(rows, [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.string(), pa.list_(pa.list_(pa.float64())), pa.list_(pa.int64())], ("image_id", "qvec", "tvec", "camera_id", "name", "xys", "point3d_ids"))

    return spark.read.text(path, wholetext=True).mapInArrow(run, IMAGES)


def _batch(rows: list, kinds: list, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))


def _binary(spark: SparkSession, path: str, parse, kinds, names, schema: str) -> DataFrame:
    def run(batches):
        for b in batches:
            yield _batch([r for data in b.column("content").to_pylist() for r in parse(data)], kinds, names)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


class Cursor:
    """Little-endian values, one after the other."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, form: str) -> tuple:
        got = struct.unpack_from("<" + form, self.data, self.at)
        self.at += struct.calcsize("<" + form)
        return got

    def text(self) -> str:
        end = self.data.index(b"\0", self.at)
        got, self.at = self.data[self.at : end].decode(), end + 1
        return got


def parse_cameras(data: bytes):
    c = Cursor(data)
    for _ in range(c.take("Q")[0]):
        i, model, w, h = c.take("iiQQ")
        name, n = CAMERA_MODELS[model]
        yield i, name, w, h, list(c.take(f"{n}d"))


def parse_images(data: bytes):
    c = Cursor(data)
    for _ in range(c.take("Q")[0]):
        i, *pose = c.take("i7d")
        camera, name, n = c.take("i")[0], c.text(), c.take("Q")[0]
        flat = c.take("ddq" * n)
        yield i, pose[:4], pose[4:], camera, name, [list(p) for p in zip(flat[::3], flat[1::3])], list(flat[2::3])


def parse_points(data: bytes):
    c = Cursor(data)
    for _ in range(c.take("Q")[0]):
        i, x, y, z, r, g, b, error, n = c.take("QdddBBBdQ")
        track = c.take("ii" * n)
        yield i, [x, y, z], [r, g, b], error, list(track[::2]), list(track[1::2])


def cameras_binary(spark: SparkSession, path: str) -> DataFrame:
    return _binary(spark, path, parse_cameras, [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.float64())], ("camera_id", "model", "width", "height", "params"), CAMERAS)


def images_binary(spark: SparkSession, path: str) -> DataFrame:
    kinds = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.string(), pa.list_(pa.list_(pa.float64())), pa.list_(pa.int64())]
    return _binary(spark, path, parse_images, kinds, ("image_id", "qvec", "tvec", "camera_id", "name", "xys", "point3d_ids"), IMAGES)


def points_binary(spark: SparkSession, path: str) -> DataFrame:
    kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
    return _binary(spark, path, parse_points, kinds, ("point3d_id", "xyz", "rgb", "error", "image_ids", "point2d_idxs"), POINTS)


def scene_model(spark: SparkSession, path: str, binary: bool) -> dict[str, DataFrame]:
    """cameras, images and points of a model folder, and views: images with their cameras."""
    if binary:
        got = {"cameras": cameras_binary(spark, f"{path}/cameras.bin"), "images": images_binary(spark, f"{path}/images.bin"), "points": points_binary(spark, f"{path}/points3D.bin")}
    else:
        got = {"cameras": cameras_text(spark, f"{path}/cameras.txt"), "images": images_text(spark, f"{path}/images.txt"), "points": points_text(spark, f"{path}/points3D.txt")}
    return got | {"views": got["images"].join(got["cameras"], "camera_id")}


def coco(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """images, annotations and categories of an annotation file."""
    doc = spark.read.json(path, multiLine=True)
    return {k: doc.select(F.explode(k).alias("x")).select("x.*") for k in ("images", "annotations", "categories", "videos", "video_np_pairs") if k in doc.columns}


def annotations_by_image(images: DataFrame, annotations: DataFrame) -> DataFrame:
    """Every image, with its annotations in order of id; an empty array without any."""
    packed = annotations.groupBy("image_id").agg(F.array_sort(F.collect_list(F.struct("id", "category_id", "bbox"))).alias("annotations"))
    joined = images.join(packed, images["id"] == packed["image_id"], "left").drop("image_id")
    return joined.withColumn("annotations", F.coalesce("annotations", F.array().cast(packed.schema["annotations"].dataType)))


#: Categories whose names are broadcast to the images.
MOST_CATEGORIES = 100_000


def queries_by_category(images: DataFrame, annotations: DataFrame, categories: DataFrame, chunk: int = 20, negatives: bool = True) -> DataFrame:
    """(image_id, chunk, category_id, name, boxes): a query for each category of an image; with negatives also for those without boxes. The number of categories is a fixed list's."""
    cats = categories.select(F.col("id").alias("category_id"), "name").withColumn("chunk", F.floor((F.row_number().over(W.orderBy("category_id")) - 1) / chunk))
    boxes = annotations.groupBy("image_id", "category_id").agg(F.collect_list("bbox").alias("boxes"))
    if not negatives:
        return boxes.join(images.select(F.col("id").alias("image_id")), "image_id", "left_semi").join(cats, "category_id").select("image_id", "category_id", "name", "chunk", "boxes")
    few = F.broadcast(cats) if cats.count() <= MOST_CATEGORIES else cats
    rows = images.select(F.col("id").alias("image_id")).crossJoin(few).join(boxes, ["image_id", "category_id"], "left")
    return rows.withColumn("boxes", F.coalesce("boxes", F.array().cast(boxes.schema["boxes"].dataType)))


def camera_poses(spark: SparkSession, path: str) -> DataFrame:
    """(frame_idx, pose): 16 numbers a line, in order of the lines."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "")).alias("frame_idx", "line"))
    return lines.select("frame_idx", F.split(F.trim("line"), r"\s+").cast("array<double>").alias("pose"))


def tracking_text(spark: SparkSession, path: str, valid: dict | None = None, negative_ids: bool = False) -> DataFrame:
    """frame, id, x, y, w, h, conf, class, visibility of a tracking file; valid: column -> values that stay."""
    df = spark.read.csv(path, schema="frame int, id long, x double, y double, w double, h double, conf double, class int, visibility double")
    for c, vs in (valid or {}).items():
        df = df.where(F.col(c).isin(*vs))
    return df if negative_ids else df.where("id >= 0")


def last_row(spark: SparkSession, path: str, keys) -> DataFrame:
    """The chosen keys of the last line of a file of JSON lines."""
    lines = spark.read.text(path, wholetext=True).select(F.filter(F.split("value", "\n"), lambda x: F.trim(x) != "").alias("l"))
    return lines.select(*[F.get_json_object(F.element_at("l", -1), f"$.{k}").alias(k) for k in keys])


def depth_camera(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Extrinsics (4x4) and intrinsics (3x3) of a stereo camera file: a heading line before each matrix."""
    words = [x.split() for x in text.splitlines() if x.strip()]
    at = {w[0].lower(): i for i, w in enumerate(words) if len(w) == 1 and w[0].isalpha()}
    grab = lambda name, n: np.array([[float(v) for v in words[at[name] + 1 + r]] for r in range(n)])
    return grab("extrinsic", 4), grab("intrinsic", 3)


def ply(spark: SparkSession, path: str) -> DataFrame:
    """(x, y, z, red, green, blue) of binary or text point clouds with these properties."""

    def run(batches):
        for b in batches:
            for data in b.column("content").to_pylist():
                head, _, body = data.partition(b"end_header\n")
                n = int(next(x.split()[2] for x in head.decode().splitlines() if x.startswith("element vertex")))
                if b"format ascii" in head:
                    got = np.array(body.split()[: n * 6], float).reshape(n, 6)
                    cols = [got[:, i] for i in range(6)]
                else:
                    got = np.frombuffer(body, np.dtype([("x", "<f4"), ("y", "<f4"), ("z", "<f4"), ("r", "u1"), ("g", "u1"), ("b", "u1")]), n)
                    cols = [got[c] for c in got.dtype.names]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(float)) for c in cols[:3]] + [pa.array(c.astype(np.int32)) for c in cols[3:]], names=["x", "y", "z", "red", "green", "blue"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "x double, y double, z double, red int, green int, blue int")
