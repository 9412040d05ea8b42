"""Queries that prepare annotation tables."""

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..adapters import CTES, boxes, observations, points, predictions, table, truth
from ..functions import boxes as B
from ..functions import geometry as G
from ..functions import text as T
from ..functions import vectors as V
from ..operators import aggregates, alignment, filters, joins, metrics, nms, tables
from ..operators.graph import shared_dir
from ..sources import readers, writers
from .fusion import greedy

BOX = lambda f: lambda spark, sf_dir: f(boxes(spark, sf_dir))
OBS = lambda f: lambda spark, sf_dir: f(observations(spark, sf_dir))
PTS = lambda f: lambda spark, sf_dir: f(points(spark, sf_dir))
TWO = lambda f: lambda spark, sf_dir: f(truth(spark, sf_dir), predictions(spark, sf_dir))
XY = ("x0", "y0", "x1", "y1")
R = lambda *cs, n=4: [F.round(c, n).alias(c) for c in cs]


def _filled(b):
    child = b.select("grp", "id", F.when(F.col("id") % 3 != 0, F.col("video")).alias("video"))
    parent = b.select("grp", "video").distinct().withColumn("height", F.col("grp") % 7)
    return tables.filled_from_parent(child, parent, "grp", "grp", ("video", "height"))


def _negatives(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 12).cast("int").alias("video"), (F.col("s_suppkey") % 5).cast("int").alias("cat"), F.col("s_suppkey").alias("pos"))


def _split(g):
    merged = g.sparkSession.createDataFrame([(2, 0)], "old int, new int")
    split = g.sparkSession.createDataFrame([(0,)], "cat int")
    return tables.of_split(tables.merged_categories(g, merged), split).select("grp", "id", "cat")


def _open_world(g, p):
    matched = p.where("id % 2 = 0")
    negative = p.where("grp % 3 = 0").select("grp", "cat")
    partial = p.where("grp % 5 = 0 and cat = 1").select("grp", "cat")
    return tables.removable_predictions(p, matched, g.where("id % 3 <> 1"), negative, partial).select("grp", "id")


def _queries(b):
    return b.select(F.col("grp").alias("video"), (F.col("grp") * 10 + F.col("id")).alias("query_id"), (F.col("id") * 2).alias("stage"), F.when(F.col("id") % 4 == 0, "geometric").when(F.col("id") % 4 == 1, F.concat(F.lit(" Chair"), F.col("id").cast("string"))).otherwise(F.lit("Red Sofa ")).alias("text"))


def _stages(b):
    q = _queries(b)
    kept = q.where("stage % 3 <> 0").select("video", "stage")
    return tables.restricted_stages(q, kept, reverse=True).select("video", "query_id", "stage")


def _tiled(b):
    return tables.tiled_stages(_queries(b).where("stage = 2"), 3).select("video", "query_id", "stage")


def _visual(b):
    q = _queries(b)
    refs = b.select((F.col("grp") * 10 + F.col("id") % 4).alias("query_id"), F.col("id").alias("object_id"), F.col("x0").alias("box"))
    return tables.text_to_visual(q, refs, 0.5).select("query_id", "text", "input_box")


def _inputs(b):
    q = _queries(b).withColumns({"input_box": F.when(F.col("stage") % 4 == 0, F.col("query_id")), "input_points": F.lit(1)})
    return tables.text_only(q).select("query_id").union(tables.without_inputs(q).where("input_box is null and input_points is null and stage = 4").select("query_id"))


def _trimmed(o):
    from ..operators import windows

    n = o.groupBy(F.col("track_id").alias("seq")).agg(F.count("*").cast("int").alias("n"))
    chunks = windows.chunks(n, 12, 4)
    frames = chunks.select("seq", "chunk", F.posexplode(F.sequence("start", F.col("stop") - 1)).alias("local", "frame"))
    return tables.trimmed_overlap(frames, 0, 4).select("seq", "chunk", "frame")


def _exact_mean(column):
    """The mean of values of up to eight decimals, summed without rounding, so a mean that lies on a threshold is there in any order of the rows."""
    return F.avg(F.col(column).cast("decimal(20,8)")).cast("double")


def _suffixes(spark, sf_dir):
    images = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 5).alias("scene"), F.concat(F.lit("img_"), F.col("c_custkey").cast("string"), F.lit(".png")).alias("name"))
    listed = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 5).alias("scene"), F.concat((F.col("s_suppkey") * 7).cast("string"), F.lit(".png")).alias("suffix"))
    return tables.without_suffixes(images, listed)


def _tagged(b):
    scores = b.groupBy("video").agg(F.avg("score").alias("score"))
    tags = b.select("video", F.concat(F.lit("t"), (F.col("video") % 3).cast("string")).alias("tag")).union(b.select("video", F.lit("all")))
    return tables.tagged_means(scores, tags, ("score",)).select("tag", "n", *R("score", n=6))


def _metric_rows(b):
    key = F.concat(F.element_at(F.array(F.lit("eth"), F.lit("dtu"), F.lit("tum")), (F.col("video") % 3 + 1).cast("int")), F.lit("_pose_"), F.col("id").cast("string"))
    return b.groupBy(key.alias("key"), F.concat(F.lit("m"), (F.col("grp") % 4).cast("string")).alias("name")).agg(F.avg("score").alias("value"))


def _report(b):
    wide = metrics.report(_metric_rows(b))
    return wide.select("name", *R("dtu", "eth", "tum", n=6))


def _compared(b):
    runs = b.groupBy(F.concat(F.lit("run"), (F.col("video") % 2).cast("string")).alias("run"), F.concat(F.lit("m"), (F.col("grp") % 4).cast("string")).alias("name")).agg(F.avg("score").alias("value"))
    return tables.compared(runs, ("run0", "run1")).select("name", *R("run0", "run1", "change", n=6))


def _loop_nms(o):
    e = o.select(F.col("track_id").alias("v"), (F.col("frame_idx") % 40).cast("long").alias("i"), (F.col("frame_idx") * 7 % 90).cast("long").alias("j"), "score")
    e = e.groupBy("v", "i", "j").agg(F.max("score").alias("sim")).where("i < j")
    return nms.loop_nms(e, 5, ("v",)).select("v", "i", "j")


def _edge_reduction(o):
    e = o.select(F.col("track_id").alias("v"), (F.col("frame_idx") % 40).cast("long").alias("i"), (F.col("frame_idx") * 7 % 90).cast("long").alias("j"), "score")
    e = e.groupBy("v", "i", "j").agg(F.max("score").alias("mag"))
    return nms.edge_reduction(e, 3, 20, 2, ("v",)).select("v", "i", "j")


def _thinned(p):
    return nms.radius_thinning(p, 3.0).select("obj", "pid")


def _cross_faded(o):
    a = o.select(F.col("track_id").alias("seq_id"), "frame_idx", F.col("x").alias("depth"), F.col("score").alias("conf")).where("frame_idx < 20")
    b = o.select(F.col("track_id").alias("seq_id"), "frame_idx", F.col("z").alias("depth"), F.col("cx").alias("conf")).where("frame_idx >= 12")
    return alignment.cross_fade(a, b, start=12).select("seq_id", "frame_idx", *R("depth", n=6), "conf")


def _rotations(p):
    m = G.yaw_matrix(F.col("conf"))
    there = F.struct(m.alias("m"), F.array("x", "y", "z").alias("t"), F.array("z", "x", "y").alias("p"))

    def again(v):
        r, t = G.rigid_inverse(v["m"], v["t"])
        return G.rigid(r, t, G.rigid(v["m"], v["t"], v["p"]))

    rows = p.select("obj", "pid", G.let(G.let(m, G.matrix_to_quaternion), lambda q: F.struct(q.alias("q"), G.quaternion_to_matrix(q).alias("m"))).alias("r"), G.let(there, again).alias("back"), G.field_of_view(F.col("x") + 100, F.lit(300.0)).alias("fov"))
    parts = {"q1": F.col("r.q")[1], "q3": F.col("r.q")[3], "m0": F.col("r.m")[0], "m2": F.col("r.m")[2], **{f"b{i}": F.col("back")[i] for i in range(3)}, "fov": F.col("fov")}
    return rows.select("obj", "pid", *[F.round(c, 5).alias(n) for n, c in parts.items()])


def _relative(p):
    eye = G.yaw_matrix(F.lit(0.0))
    a = (F.lit(2.0), eye, F.array("x", "y", "z"))
    b = (F.lit(4.0), eye, F.array("z", "x", "y"))
    s, _, t = G.sim3_relative(a, b)
    return p.select("obj", "pid", s.alias("s"), *[F.round(G.at(t, i), 5).alias(f"t{i}") for i in range(3)])


def _accumulated(o):
    rows = o.where("frame_idx < 6").select(F.col("track_id").alias("seq_id"), F.col("frame_idx").cast("long").alias("chunk"), F.lit(0.5).alias("s"), G.yaw_matrix(F.lit(0.0)).alias("r"), F.array("x", "y", "z").alias("t"))
    return alignment.accumulate(rows, with_identity=False).select("seq_id", "chunk", F.round("s", 6).alias("s"), F.round(F.element_at("t", 1), 8).alias("t0"))


def _settings(b):
    text = F.format_string("a=%d,b = x%d ,c=true", "grp", "id")
    kv = F.transform_values(F.str_to_map(F.regexp_replace(text, r"\s*([=,])\s*", "$1"), F.lit(","), F.lit("=")), lambda k, v: F.trim(v))
    return b.select("grp", "id", kv["a"].alias("a"), kv["b"].alias("b"), kv["c"].alias("c"))


def _padded(b):
    rows = b.groupBy("grp").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return rows.select("grp", F.array_join(V.padded(F.col("ids"), F.lit(8), -1).cast("array<string>"), ",").alias("ids"))


def _kinds(spark, sf_dir):
    ext = F.element_at(F.array(*map(F.lit, (".MP4", ".jpg", ".mov", "", ".txt", ".tiff", "/cameras.bin", "/sparse"))), (F.col("c_custkey") % 8 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.input_kind(F.concat(F.lit("/data/x"), F.col("c_custkey").cast("string"), ext)).alias("kind"))


def _scene_text(spark, sf_dir):
    """Cameras and points written as text and read again."""
    path = f"{shared_dir(spark)}/scene-{uuid.uuid4().hex}"
    s = table(spark, sf_dir, "supplier")
    cams = s.select(F.col("s_suppkey").alias("id"), F.lit("PINHOLE").alias("model"), F.lit(640).alias("w"), F.lit(480).alias("h"), F.array(F.col("s_acctbal").cast("double"), F.lit(1.5), F.lit(320.0), F.lit(240.0)).alias("params"))
    writers.text_lines(cams, "id", "model", "w", "h", "params").write.text(f"{path}/cameras.txt")
    return readers.cameras_text(spark, f"{path}/cameras.txt").select("camera_id", "model", "width", "height", F.col("params")[0].alias("fx"), F.size("params").alias("n"))


def _points_text(spark, sf_dir):
    path = f"{shared_dir(spark)}/points-{uuid.uuid4().hex}"
    p = points(spark, sf_dir).select("pid", "x", "y", "z", F.lit(1).alias("r"), F.lit(2).alias("g"), F.lit(3).alias("b"), F.lit(0.5).alias("e"), F.array((F.col("pid") % 9).cast("int"), F.lit(4), F.lit(7), (F.col("pid") % 5).cast("int")).alias("track"))
    writers.text_lines(p, "pid", "x", "y", "z", "r", "g", "b", "e", "track").write.text(path)
    got = readers.points_text(spark, path)
    return got.select("point3d_id", *[F.round(F.col("xyz")[i], 6).alias(c) for i, c in enumerate("xyz")], F.col("rgb")[2].alias("blue"), "error", F.array_join(F.col("image_ids").cast("array<string>"), ",").alias("images"), F.array_join(F.col("point2d_idxs").cast("array<string>"), ",").alias("places"))


def _tracking_scan(spark, sf_dir):
    path = f"{shared_dir(spark)}/tracking-{uuid.uuid4().hex}"
    b = boxes(spark, sf_dir).select("grp", F.when(F.col("id") == 4, -1).otherwise(F.col("id")).alias("id"), "x0", "y0", (F.col("x1") - F.col("x0")).alias("w"), (F.col("y1") - F.col("y0")).alias("h"), "score", (F.col("id") % 3).alias("class"), F.lit(1.0).alias("v"))
    b.write.csv(path)
    return readers.tracking_text(spark, path, {"class": (0, 1)}).select("frame", "id", "x", "y", "w", "h", "conf", "class")


def _last_rows(spark, sf_dir):
    path = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "nation").select(F.to_json(F.struct(F.col("n_nationkey").alias("step"), F.col("n_name").alias("name"))).alias("v"), "n_nationkey")
    rows.coalesce(1).sortWithinPartitions("n_nationkey").select("v").write.text(path)
    return readers.last_row(spark, path, ("step", "name"))


def _annotations(b):
    images = b.select(F.col("grp").alias("id")).distinct()
    notes = b.where("id % 3 <> 1").select(F.col("grp").alias("image_id"), "id", (F.col("id") % 2).alias("category_id"), F.array(*XY).alias("bbox"))
    return images, notes


def _by_image(b):
    got = readers.annotations_by_image(*_annotations(b))
    return got.select("id", F.size("annotations").alias("n"), F.array_join(F.transform("annotations", lambda a: a["id"].cast("string")), ",").alias("ids"))


def _by_category(b):
    images, notes = _annotations(b)
    cats = b.sparkSession.createDataFrame([(0, "even"), (1, "odd"), (2, "none")], "id int, name string")
    return readers.queries_by_category(images, notes, cats, chunk=2).select("image_id", F.col("chunk").cast("int").alias("chunk"), "category_id", "name", F.size("boxes").alias("n"))


def _polygons(b):
    xs, ys = [F.col(c) for c in ("x0", "x1", "x1", "x0")], [F.col(c) for c in ("y0", "y0", "y1", "y1")]
    return b.select("grp", "id", G.polygon_area(xs[:2] + [xs[2] + 3, xs[3]], ys).alias("area"))


def _rotated(b):
    return b.select("grp", "id", B.wrap_degrees(F.col("x0") * 37).alias("angle"), *[F.round(c, 6).alias(f"c{i}") for i, c in enumerate(B.rotated_hull((F.col("x0"), F.col("y0"), F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), F.col("x0") * 37))])


def _rois(b):
    box = B.zoom_window(B.box(), 64, 64, 2.0)
    return b.select("grp", "id", *[F.round(c, 6).alias(f"z{i}") for i, c in enumerate(box)])


QUERIES = {
    "filled_references": BOX(_filled),
    "image_timesteps": BOX(lambda b: tables.timesteps(b.select("video", F.col("grp").alias("frame_idx")).distinct()).select("video", "frame_idx", "timestep")),
    "tracks_of_videos": BOX(lambda b: tables.tracks_of_videos(b).select("video", "id", "n", "first", "last", F.size("frames").alias("frames"))),
    "pair_ids": lambda spark, sf_dir: tables.pair_ids(truth(spark, sf_dir).where("video <> 3"), predictions(spark, sf_dir).where("video <> 5"), negatives=_negatives(spark, sf_dir)),
    "class_agnostic": TWO(lambda g, p: tables.class_agnostic(g).select("grp", "video", "id", "cat")),
    "merged_categories": TWO(lambda g, p: _split(g)),
    "open_world_predictions": TWO(_open_world),
    "pose_pairs": OBS(lambda o: tables.index_pairs(o.where("frame_idx < 30").select(F.col("track_id").alias("scene"), F.col("frame_idx").alias("i")))),
    "reference_first": OBS(lambda o: tables.reference_first(o.select(F.col("track_id").alias("scene"), F.col("frame_idx").alias("i")), F.col("i") == 7)),
    "gathered_first": OBS(lambda o: tables.first_of(o.select("track_id", (F.col("frame_idx") % 10).alias("image"), "event_id"), ("track_id", "image"), ("event_id",))),
    "distinct_chunk_pairs": OBS(lambda o: tables.distinct_chunk_pairs(o.select((F.col("track_id") % 9).alias("chunk1"), (F.col("frame_idx") % 9).alias("chunk2"), F.col("event_id").alias("pos")))),
    "restricted_stages": BOX(_stages),
    "tiled_stages": BOX(_tiled),
    "slot_buckets": BOX(lambda b: tables.slots(b, 3).select("grp", "id", "bucket", "slot")),
    "least_loaded": BOX(lambda b: tables.least_loaded(b.select("grp", "id"), b.sparkSession.createDataFrame([(0, 2), (1, 0), (2, 1)], "worker int, load int"))),
    "without_suffixes": _suffixes,
    "counts_above": BOX(lambda b: tables.counts_above(b, 0.6)),
    "mean_or_zero": BOX(lambda b: tables.mean_or_zero(b.withColumn("v", F.when(F.col("video") != 2, F.col("score"))), "v", ("video",)).select("video", *R("mean", n=6))),
    "tagged_means": BOX(_tagged),
    "metric_report": BOX(_report),
    "metric_comparison": BOX(_compared),
    "rewritten_texts": BOX(lambda b: tables.lowered(tables.with_text(_queries(b), "a "), ("a red sofa",)).select("query_id", "text")),
    "text_to_visual": BOX(_visual),
    "text_only": BOX(_inputs),
    "listed_texts": BOX(lambda b: filters.without_texts(_queries(b), ("geometric", " Chair1")).select("query_id")),
    "trimmed_overlap": OBS(_trimmed),
    "kept_objects": BOX(lambda b: filters.drop_objects(b.withColumns({"is_crowd": F.when(F.col("id") > 1, F.col("id") == 5), "x1": F.when(F.col("id") == 3, F.col("x0")).otherwise(F.col("x1"))})).select("grp", "id")),
    "exhaustive_queries": BOX(lambda b: filters.exhaustive(b.withColumn("flag", F.when(F.col("id") > 2, F.col("id") % 2 == 0)), "flag").select("grp", "id")),
    "low_texture": PTS(lambda p: p.groupBy("obj").agg(F.stddev_pop("x").alias("s"), (_exact_mean("conf") / 32).alias("e")).where(filters.low_texture(F.col("s"), F.col("e"))).select("obj")),
    "uniform_crops": PTS(lambda p: p.groupBy("obj").agg(F.stddev_pop("x").alias("s")).where(filters.uniform_crop(F.col("s") * 0.82)).select("obj")),
    "not_background": BOX(lambda b: filters.not_background(b.select("grp", "id", (B.area(B.box()) / 625).alias("area_frac"), (F.col("x1") - F.col("x0")).alias("size_x"), (F.col("y1") - F.col("y0")).alias("size_y"), ((F.col("id") % 4) / 50).alias("size_z"))).select("grp", "id")),
    "split_tags": BOX(lambda b: b.select("grp", "id", F.array_join(T.split_tags(F.concat(F.lit(" a |"), F.col("grp").cast("string"), F.lit("| |c d"))), ";").alias("tags"))),
    "dense_ids": lambda spark, sf_dir: joins.dense_ids(points(spark, sf_dir), "obj", "new"),
    "unique_ids": BOX(lambda b: filters.assert_unique(b, ("grp", "id")).groupBy("video").agg(F.count("*").alias("n"))),
    "loop_nms": OBS(_loop_nms),
    "edge_reduction": OBS(_edge_reduction),
    "radius_thinning": PTS(_thinned),
    "loop_windows": OBS(lambda o: o.select("event_id", *[c.alias(n) for n, c in zip(("lo", "hi"), joins.loop_window(F.col("frame_idx"), F.lit(5), F.lit(60), 6))])),
    "cross_fade": OBS(_cross_faded),
    "confident_points": PTS(lambda p: writers.confident_points(p, 0.4, 500).select("obj", "pid")),
    "rotations": PTS(_rotations),
    "relative_similarity": PTS(_relative),
    "accumulated_transforms": OBS(_accumulated),
    "parsed_settings": BOX(_settings),
    "padded_arrays": BOX(_padded),
    "input_kinds": _kinds,
    "camera_text_scan": _scene_text,
    "point_text_scan": _points_text,
    "tracking_scan": _tracking_scan,
    "last_json_row": _last_rows,
    "annotations_by_image": BOX(_by_image),
    "queries_by_category": BOX(_by_category),
    "polygon_areas": BOX(_polygons),
    "rotated_boxes": BOX(_rotated),
    "zoom_windows": BOX(_rois),
    "step_tokens": OBS(lambda o: aggregates.step_tokens(o.withColumn("step", F.floor(F.col("frame_idx") / 10)), ("track_id", "step"), "ts_s").select("track_id", "step", *R("t_start", "t_end"))),
    "frame_inputs": OBS(lambda o: joins.frame_inputs(o.select("frame_idx", "track_id", "score"), o.where("track_id = 1").select("frame_idx", F.col("z").alias("depth")), o.where("track_id = 2").select("frame_idx", F.col("x").alias("pose"))).select("frame_idx", "n", "depth", "pose")),
}

_Q = f"WITH RECURSIVE {CTES}"
_QS = "qs AS (SELECT grp AS video, grp * 10 + id AS query_id, id * 2 AS stage, CASE WHEN id % 4 = 0 THEN 'geometric' WHEN id % 4 = 1 THEN ' Chair' || id ELSE 'Red Sofa ' END AS text FROM box)"
_NEAR = "abs(r.i - k.i) <= {w} AND abs(r.j - k.j) <= {w}"
_EDGE = "e AS (SELECT track_id AS v, frame_idx % 40 AS i, frame_idx * 7 % 90 AS j, max(score) AS s FROM obs GROUP BY ALL)"
ORACLE = {
    "filled_references": f"{_Q} SELECT grp, id, video, grp % 7 AS height FROM box",
    "image_timesteps": f"{_Q}, f AS (SELECT DISTINCT video, grp AS frame_idx FROM box) SELECT video, frame_idx, CAST(row_number() OVER (PARTITION BY video ORDER BY frame_idx) - 1 AS INT) AS timestep FROM f",
    "tracks_of_videos": f"{_Q} SELECT video, id, count(*) AS n, min(grp) AS first, max(grp) AS last, CAST(count(DISTINCT grp) AS INT) AS frames FROM box GROUP BY ALL",
    "pair_ids": f"""{_Q}, k AS (SELECT video, cat FROM gt WHERE video <> 3 UNION SELECT video, cat FROM pred WHERE video <> 5), n AS (SELECT video, cat, row_number() OVER (ORDER BY video, cat) AS new_id FROM k),
m AS (SELECT CAST(s_suppkey % 12 AS INT) AS video, CAST(s_suppkey % 5 AS INT) AS cat, min(s_suppkey) AS pos FROM supplier GROUP BY ALL), x AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.video = m.video AND n.cat = m.cat))
SELECT * FROM n UNION ALL SELECT video, cat, (SELECT count(*) FROM n) + row_number() OVER (ORDER BY pos, video, cat) FROM x""",
    "class_agnostic": f"{_Q}, d AS (SELECT DISTINCT video, id FROM gt), n AS (SELECT *, row_number() OVER (ORDER BY video, id) AS k FROM d) SELECT gt.grp, gt.video, n.k AS id, 1 AS cat FROM gt JOIN n USING (video, id)",
    "merged_categories": f"{_Q} SELECT grp, id, 0 AS cat FROM gt WHERE cat IN (0, 2)",
    "open_world_predictions": f"""{_Q} SELECT grp, id FROM pred p WHERE id % 2 = 0 OR (grp % 3 = 0 OR EXISTS (SELECT 1 FROM gt g WHERE g.grp = p.grp AND g.cat = p.cat AND g.id % 3 <> 1)) AND NOT (cat = 1 AND grp % 5 = 0)""",
    "pose_pairs": f"{_Q} SELECT a.track_id AS scene, a.frame_idx AS i, b.frame_idx AS j FROM obs a JOIN obs b ON a.track_id = b.track_id AND a.frame_idx < b.frame_idx WHERE b.frame_idx < 30",
    "reference_first": f"{_Q} SELECT track_id AS scene, frame_idx AS i, CAST(CASE WHEN frame_idx = 7 THEN 0 WHEN frame_idx < 7 AND max(frame_idx) OVER (PARTITION BY track_id) >= 7 THEN frame_idx + 1 ELSE frame_idx END AS INT) AS place FROM obs",
    "gathered_first": f"{_Q} SELECT track_id, frame_idx % 10 AS image, min(event_id) AS event_id FROM obs GROUP BY ALL",
    "distinct_chunk_pairs": f"{_Q} SELECT track_id % 9 AS chunk1, frame_idx % 9 AS chunk2, min(event_id) AS pos FROM obs WHERE track_id % 9 <> frame_idx % 9 GROUP BY ALL",
    "restricted_stages": f"{_Q}, {_QS} SELECT video, query_id, CAST(dense_rank() OVER (PARTITION BY video ORDER BY stage DESC) - 1 AS INT) AS stage FROM qs WHERE stage % 3 <> 0",
    "tiled_stages": f"{_Q}, {_QS} SELECT video, query_id, s AS stage FROM qs, (VALUES (0), (1), (2)) v(s) WHERE stage = 2",
    "slot_buckets": f"{_Q} SELECT grp, id, CAST((id - 1) // 3 AS BIGINT) AS bucket, CAST((id - 1) % 3 AS INT) AS slot FROM box",
    "least_loaded": f"{_Q}, t AS (SELECT w, l, k, row_number() OVER (ORDER BY l + k, w) AS n FROM (VALUES (0, 2), (1, 0), (2, 1)) v(w, l), range(0, 20) r(k)) SELECT grp, id, w AS worker FROM box JOIN t ON n = id",
    "without_suffixes": "SELECT c_custkey % 5 AS scene, 'img_' || c_custkey || '.png' AS name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s_suppkey % 5 = c_custkey % 5 AND ends_with('img_' || c_custkey || '.png', s_suppkey * 7 || '.png'))",
    "counts_above": f"{_Q} SELECT grp, count(*) FILTER (WHERE score > 0.6) AS n FROM box GROUP BY grp",
    "mean_or_zero": f"{_Q} SELECT video, round(CASE WHEN video = 2 THEN 0 ELSE avg(score) END, 6) AS mean FROM box GROUP BY video",
    "tagged_means": f"{_Q}, s AS (SELECT video, avg(score) AS s FROM box GROUP BY video), t AS (SELECT video, 't' || video % 3 AS tag FROM s UNION ALL SELECT video, 'all' FROM s) SELECT tag, count(*) AS n, round(avg(s), 6) AS score FROM s JOIN t USING (video) GROUP BY tag",
    "metric_report": f"{_Q}, m AS (SELECT video % 3 AS d, id, 'm' || grp % 4 AS name, avg(score) AS v FROM box GROUP BY ALL) SELECT name, round(avg(v) FILTER (WHERE d = 1), 6) AS dtu, round(avg(v) FILTER (WHERE d = 0), 6) AS eth, round(avg(v) FILTER (WHERE d = 2), 6) AS tum FROM m GROUP BY name",
    "metric_comparison": f"{_Q}, m AS (SELECT 'm' || grp % 4 AS name, avg(score) FILTER (WHERE video % 2 = 0) AS a, avg(score) FILTER (WHERE video % 2 = 1) AS b FROM box GROUP BY ALL) SELECT name, round(a, 6) AS run0, round(b, 6) AS run1, round(b - a, 6) AS change FROM m",
    "rewritten_texts": f"{_Q}, {_QS} SELECT query_id, CASE WHEN text = 'geometric' THEN text WHEN text = 'Red Sofa ' THEN 'a red sofa' ELSE 'a ' || text END AS text FROM qs",
    "text_to_visual": f"""{_Q}, {_QS}, r AS (SELECT grp * 10 + id % 4 AS query_id, arg_min(x0, (md5('0:' || (grp * 10 + id % 4) || ':' || id), id)) AS box FROM box GROUP BY ALL), m AS (SELECT qs.query_id, text, r.box, r.box IS NOT NULL AND substr(md5('0:' || qs.query_id), 1, 4) < '8000' AS v FROM qs LEFT JOIN r USING (query_id))
SELECT query_id, CASE WHEN v THEN 'visual' ELSE text END AS text, CASE WHEN v THEN box END AS input_box FROM m""",
    "text_only": f"{_Q}, {_QS} SELECT query_id FROM qs WHERE stage % 4 <> 0 UNION ALL SELECT query_id FROM qs WHERE stage = 4",
    "listed_texts": f"{_Q}, {_QS} SELECT query_id FROM qs WHERE text NOT IN ('geometric', ' Chair1')",
    "trimmed_overlap": f"{_Q}, n AS (SELECT track_id AS seq, count(*) AS n FROM obs GROUP BY ALL), c AS (SELECT seq, n, greatest(1, CAST(ceil((n - 4) / 8) AS INT)) AS chunks FROM n) SELECT seq, CAST(least(f // 8, chunks - 1) AS INT) AS chunk, CAST(f AS INT) AS frame FROM (SELECT *, unnest(range(0, n)) AS f FROM c)",
    "kept_objects": f"{_Q} SELECT grp, id FROM box WHERE id NOT IN (3, 5)",
    "exhaustive_queries": f"{_Q} SELECT grp, id FROM box WHERE id <= 2 OR id % 2 = 0",
    "low_texture": f"{_Q} SELECT obj FROM pts GROUP BY obj HAVING stddev_pop(x) < 20 AND avg(conf) / 32 < 0.015e0",
    "uniform_crops": f"{_Q} SELECT obj FROM pts GROUP BY obj HAVING stddev_pop(x) * 0.82e0 < 12",
    "not_background": f"{_Q} SELECT grp, id FROM box WHERE NOT ((x1 - x0) * (y1 - y0) / 625 > 0.7e0 AND least(x1 - x0, y1 - y0, (id % 4) / 50) < 0.03e0)",
    "split_tags": f"{_Q} SELECT grp, id, 'a;' || grp || ';c d' AS tags FROM box",
    "dense_ids": f"{_Q}, d AS (SELECT DISTINCT obj FROM pts) SELECT obj, row_number() OVER (ORDER BY obj) AS new FROM d",
    "unique_ids": f"{_Q} SELECT video, count(*) AS n FROM box GROUP BY video",
    "loop_nms": f"{_Q}, {_EDGE}, l AS (SELECT * FROM e WHERE i < j), {greedy('l', 'v', 's DESC, i, j', _NEAR.format(w=5))} SELECT v, i, j FROM stay",
    "edge_reduction": f"{_Q}, {_EDGE}, l AS (SELECT * FROM e WHERE j - i >= 20), {greedy('l', 'v', 's, i, j', 'abs(r.i - k.i) <= 2')}, n AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY s, i, j) AS n FROM stay) SELECT v, i, j FROM n WHERE n <= 3",
    "radius_thinning": f"{_Q}, h AS (SELECT *, md5(CAST(pid AS VARCHAR)) AS h FROM pts), {greedy('h', 'obj', 'h, pid', '(r.x - k.x) ** 2 + (r.y - k.y) ** 2 + (r.z - k.z) ** 2 < 9')} SELECT obj, pid FROM stay",
    "loop_windows": f"{_Q} SELECT event_id, CAST(greatest(5, least(frame_idx - 6, 48)) AS INT) AS lo, CAST(least(greatest(5, least(frame_idx - 6, 48)) + 12, 60) AS INT) AS hi FROM obs",
    "cross_fade": f"{_Q} SELECT track_id AS seq_id, frame_idx, round((1 - (frame_idx - 11) / 9) * x + (frame_idx - 11) / 9 * z, 6) AS depth, least(score, cx) AS conf FROM obs WHERE frame_idx BETWEEN 12 AND 19",
    "confident_points": f"{_Q} SELECT obj, pid FROM pts WHERE conf >= 0.4 ORDER BY md5('42:' || pid), pid LIMIT 500",
    "rotations": f"{_Q} SELECT obj, pid, round(sin(conf / 2), 5) AS q1, round(cos(conf / 2), 5) AS q3, round(cos(conf), 5) AS m0, round(sin(conf), 5) AS m2, round(z, 5) AS b0, round(x, 5) AS b1, round(y, 5) AS b2, round(degrees(2 * atan((x + 100) / 600)), 5) AS fov FROM pts",
    "relative_similarity": f"{_Q} SELECT obj, pid, CAST(0.5 AS DOUBLE) AS s, round(x - z / 2, 5) AS t0, round(y - x / 2, 5) AS t1, round(z - y / 2, 5) AS t2 FROM pts",
    "accumulated_transforms": f"{_Q} SELECT track_id AS seq_id, CAST(frame_idx AS BIGINT) AS chunk, round(0.5e0 ** (frame_idx + 1), 6) AS s, round(sum(x * 0.5e0 ** frame_idx) OVER (PARTITION BY track_id ORDER BY frame_idx), 8) AS t0 FROM obs WHERE frame_idx < 6",
    "parsed_settings": f"{_Q} SELECT grp, id, CAST(grp AS VARCHAR) AS a, 'x' || id AS b, 'true' AS c FROM box",
    "padded_arrays": f"{_Q}, n AS (SELECT grp, list(id ORDER BY id) AS l FROM box GROUP BY grp) SELECT grp, array_to_string(list_concat(l, list_transform(range(0, greatest(8 - len(l), 0)), lambda i: -1)), ',') AS ids FROM n",
    "input_kinds": "SELECT c_custkey, ['video', 'image', 'video', 'unknown', 'unknown', 'image', 'colmap', 'colmap'][c_custkey % 8 + 1] AS kind FROM customer",
    "camera_text_scan": "SELECT CAST(s_suppkey AS INT) AS camera_id, 'PINHOLE' AS model, 640 AS width, 480 AS height, CAST(s_acctbal AS DOUBLE) AS fx, 4 AS n FROM supplier",
    "point_text_scan": f"{_Q} SELECT pid AS point3d_id, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z, 3 AS blue, CAST(0.5 AS DOUBLE) AS error, pid % 9 || ',7' AS images, '4,' || pid % 5 AS places FROM pts",
    "tracking_scan": f"{_Q} SELECT grp AS frame, id, x0 AS x, y0 AS y, x1 - x0 AS w, y1 - y0 AS h, score AS conf, CAST(id % 3 AS INT) AS class FROM box WHERE id <> 4 AND id % 3 < 2",
    "last_json_row": "SELECT CAST(n_nationkey AS VARCHAR) AS step, n_name AS name FROM nation ORDER BY n_nationkey DESC LIMIT 1",
    "annotations_by_image": f"{_Q} SELECT grp AS id, CAST(count(*) FILTER (WHERE id % 3 <> 1) AS INT) AS n, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (WHERE id % 3 <> 1), '') AS ids FROM box GROUP BY grp",
    "queries_by_category": f"{_Q}, i AS (SELECT DISTINCT grp FROM box), c AS (SELECT * FROM (VALUES (0, 'even', 0), (1, 'odd', 0), (2, 'none', 1)) v(category_id, name, chunk)) SELECT i.grp AS image_id, c.chunk, c.category_id, c.name, CAST(count(b.id) AS INT) AS n FROM i CROSS JOIN c LEFT JOIN box b ON b.grp = i.grp AND b.id % 3 <> 1 AND b.id % 2 = c.category_id GROUP BY ALL",
    "polygon_areas": f"{_Q} SELECT grp, id, (x1 - x0 + 1.5) * (y1 - y0) AS area FROM box",
    "rotated_boxes": f"""{_Q}, t AS (SELECT grp, id, x0, y0, x1 - x0 AS w, y1 - y0 AS h, x0 * 37 AS d FROM box), s AS (SELECT *, abs(cos(radians(d))) AS c, abs(sin(radians(d))) AS s FROM t)
SELECT grp, id, d + 180 - floor((d + 180) / 360) * 360 - 180 AS angle, round(x0 - (c * w + s * h) / 2, 6) AS c0, round(y0 - (s * w + c * h) / 2, 6) AS c1, round(x0 + (c * w + s * h) / 2, 6) AS c2, round(y0 + (s * w + c * h) / 2, 6) AS c3 FROM s""",
    "zoom_windows": f"{_Q} SELECT grp, id, greatest(x0 - (x1 - x0) / 2, 0) AS z0, greatest(y0 - (y1 - y0) / 2, 0) AS z1, least(x1 + (x1 - x0) / 2, 64) AS z2, least(y1 + (y1 - y0) / 2, 64) AS z3 FROM box",
    "step_tokens": f"{_Q} SELECT track_id, CAST(floor(frame_idx / 10) AS BIGINT) AS step, round(min(ts_s), 4) AS t_start, round(max(ts_s), 4) AS t_end FROM obs GROUP BY ALL",
    "frame_inputs": f"{_Q}, n AS (SELECT frame_idx, CAST(count(*) AS INT) AS n FROM obs GROUP BY ALL) SELECT d.frame_idx, n.n, d.z AS depth, p.x AS pose FROM obs d JOIN n USING (frame_idx) LEFT JOIN obs p ON p.frame_idx = d.frame_idx AND p.track_id = 2 WHERE d.track_id = 1",
}
