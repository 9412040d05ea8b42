"""Queries of aggregates, metrics and alignments."""

from pyspark.sql import functions as F

from ..adapters import CTES, observations, points, predictions, table, truth
from ..functions import geometry as G
from ..functions import masks as M
from ..functions import text as T
from ..functions import vectors as V
from ..operators import aggregates, alignment, metrics, pose_graph, teta

OBS = lambda f: lambda spark, sf_dir: f(observations(spark, sf_dir))
PTS = lambda f: lambda spark, sf_dir: f(points(spark, sf_dir))
TWO = lambda f: lambda spark, sf_dir: f(truth(spark, sf_dir), predictions(spark, sf_dir))


def rounded(df, keys, n=4):
    kinds = dict(df.dtypes)
    return df.select(*[c if c in keys or kinds[c] != "double" else F.round(c, n).alias(c) for c in df.columns])


def _matched(p):
    """Points and a turned, scaled and moved copy with a little noise."""
    c, s = 0.8, 0.6
    e = lambda k: (F.col("pid") % k - k // 2) / 1000
    return p.select("obj", "conf", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az"), (2 * (c * F.col("x") + s * F.col("z")) + 1 + e(7)).alias("bx"), (2 * F.col("y") - 3 + e(5)).alias("by"), (2 * (c * F.col("z") - s * F.col("x")) + 0.5 + e(11)).alias("bz"))


def _scales(p):
    return p.groupBy("obj").agg(aggregates.least_squares_scale(F.col("x"), F.col("z")).alias("scale"))


def _chunks(p):
    """Depths of two overlapping chunks of scale 1.5 with a little noise; one pair in nine is far off."""
    off = F.when(F.col("pid") % 9 == 0, 20.0).otherwise((F.col("pid") % 7 - 3) / 100)
    return p.select("obj", "pid", (F.col("z") * 1.5 + off).alias("a"), F.col("z").alias("b"), F.col("conf").alias("conf_a"), F.col("conf").alias("conf_b"))


def _poses(p):
    """Rotation and translation errors between two poses of each point."""
    a, b = G.yaw_matrix(F.col("y") / 7), G.yaw_matrix(F.col("conf"))
    return p.select("obj", "pid", F.greatest(G.rotation_angle(a, b), G.direction_angle(F.array("x", "y", "z"), F.array("z", "y", "x"))).alias("error"))


def _backproject(p):
    c = G.backproject(F.col("x") * 10, F.col("y") * 10, F.col("z"), 300.0, 310.0, 160.0, 120.0)
    u, v = G.project(c, 300.0, 310.0, 160.0, 120.0)
    return p.select("obj", "pid", *[F.round(G.at(c, i), 4).alias(n) for i, n in enumerate("abc")], F.round(u, 4).alias("u"), F.round(v, 4).alias("v"), F.round(G.metric_depth(F.col("z"), F.lit(450.0)), 4).alias("metric"))


def _corners(p):
    k = F.explode(G.box_corners(F.array("x", "y", "z"), F.array(F.lit(2.0), F.lit(1.0), F.col("conf")), F.col("conf"))).alias("k")
    return p.select("obj", "pid", k).groupBy("obj").agg(*[F.round(f(G.at(F.col("k"), i)), 3).alias(f"{n}{a}") for n, f in (("lo_", F.min), ("hi_", F.max)) for i, a in enumerate("xyz")])


def _names(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.clean_name(F.col("text")).alias("name")).withColumn("bad", T.is_bad_name(F.col("name")))


def _directions(p):
    return p.select("obj", "pid", T.direction_words(F.col("x") - 25, F.col("y") - 7, F.col("z") - 7, 1.0).alias("words"))


def _patches(p):
    px = p.select("obj", (F.col("x") * 1).cast("int").alias("u"), (F.col("z") * 5 - 10).cast("int").alias("v")).distinct()
    return aggregates.patch_grid(px, 53, 51, keys=("obj",), grid=8, coverage=0.1).select("obj", "row", "col", F.round("cover", 4).alias("cover"))


_AREAS = {"all": (0.0, 1e10), "small": (0.0, 150.0), "large": (150.0, 1e10)}


def _graph(o):
    """Steps of each track's first rows, and a loop that agrees with them: the poses must stay."""
    rows = o.where("frame_idx < 6")
    eye = G.yaw_matrix(F.lit(0.0))
    steps = rows.select(F.col("track_id").alias("seq_id"), F.col("frame_idx").cast("long").alias("chunk"), F.lit(1.0).alias("s"), eye.alias("r"), F.array("x", "y", "z").alias("t"))
    ends = rows.groupBy(F.col("track_id").alias("seq_id")).agg(F.count("*").alias("i"), F.array(*map(F.sum, "xyz")).alias("t"))
    loops = ends.select("seq_id", "i", F.lit(0).cast("long").alias("j"), F.lit(1.0).alias("s"), eye.alias("r"), "t")
    got = pose_graph.optimised_poses(steps, loops)
    return got.select("seq_id", "node", F.round("s", 4).alias("s"), *[F.round(F.col("t")[i], 4).alias(c) for i, c in enumerate("xyz")])


def _masks(g, p):
    """Boxes on an image of 64 x 64 as masks."""
    box = [F.least(F.col(c), F.lit(64)).cast("int") for c in ("x0", "y0", "x1", "y1")]
    rle = F.struct(F.array(F.lit(64), F.lit(64)).alias("size"), M.box_counts(*box, 64).alias("counts"))
    return metrics.mask_scores(g.select("grp", "id", rle.alias("rle")), p.select("grp", "id", rle.alias("rle"), "score"))


def _best_scoring(g, p):
    one = metrics.cgf1_images(g, p.where("grp % 2 = 0")).withColumn("annotator", F.lit(0))
    two = metrics.cgf1_images(g, p.where("grp % 3 = 0")).withColumn("annotator", F.lit(1))
    return metrics.best_scoring(one.union(two))


QUERIES = {
    "shape_tokens": PTS(lambda p: rounded(aggregates.shape_tokens(p), ("obj", "n"))),
    "oriented_boxes": PTS(lambda p: rounded(aggregates.oriented_boxes(p), ("obj",))),
    "voxel_downsample": PTS(lambda p: rounded(aggregates.voxels(p, 4.0), ("obj",))),
    "consistent_fusion": PTS(lambda p: rounded(aggregates.fused(p.withColumns({"u": F.floor("x"), "v": F.floor("y")}), ("u", "v"), 3), ("u", "v"))),
    "majority_vote": OBS(lambda o: aggregates.majority(o)),
    "best_crop": OBS(lambda o: aggregates.best_crop(o)),
    "least_squares_scale": PTS(lambda p: rounded(_scales(p), ("obj",), 6)),
    "weighted_quantile": PTS(lambda p: rounded(aggregates.weighted_quantile(p, "z", "conf", 0.9), ("obj",))),
    "confidence_threshold": PTS(lambda p: rounded(aggregates.confidence_threshold(p, "conf", 0.5), ("obj",))),
    "scene_scale": PTS(lambda p: rounded(aggregates.scene_scale(p), ("obj",))),
    "min_max_reference": lambda spark, sf_dir: aggregates.min_max_reference(table(spark, sf_dir, "embeddings").withColumns({"n": F.round(V.norm(F.col("embedding")), 6), "first": F.round(F.col("embedding")[0].cast("double"), 6)}), ("n", "first"), "vec_id"),
    "patch_grid": PTS(_patches),
    "histogram_bins": PTS(lambda p: aggregates.colour_histogram(p, {"x": (0, 50, 8), "y": (0, 14, 8), "conf": (0, 1, 4)}).select("obj", F.posexplode("hist").alias("bin", "share")).withColumn("share", F.round("share", 6))),
    "hota": TWO(lambda g, p: rounded(metrics.hota_combine(metrics.hota_partial(g, p)), ("alpha",))),
    "hota_by_class": TWO(lambda g, p: rounded(metrics.hota_by_class(metrics.hota_combine(metrics.hota_partial(g, p, ("video", "cat")), ("cat",))), ("alpha",))),
    "track_counts": TWO(lambda g, p: metrics.counts(p)),
    "cgf1": TWO(lambda g, p: rounded(metrics.cgf1_accumulate(metrics.cgf1_images(g, p)), ("iou",))),
    "best_annotator": TWO(_best_scoring),
    "average_precision": TWO(lambda g, p: rounded(metrics.average_precision(g, p), ("cat", "iou"))),
    "coco_evaluation": TWO(lambda g, p: rounded(metrics.coco_evaluation(g, p, thresholds=(0.5, 0.75), areas=_AREAS, max_dets=(1, 3)), ("cat", "area", "iou"))),
    "coco_summary": TWO(lambda g, p: rounded(metrics.coco_summary(metrics.coco_evaluation(g, p, thresholds=(0.5, 0.75), areas=_AREAS, max_dets=(1, 3)), (1, 3)), ("area",))),
    "pose_graph": OBS(_graph),
    "mask_scores": TWO(lambda g, p: rounded(_masks(g, p), ("grp",))),
    "tracklet_iou": TWO(lambda g, p: rounded(metrics.tracklet_iou(g, p), ("video",))),
    "pose_auc": PTS(lambda p: rounded(metrics.pose_auc(p.withColumn("error", F.col("z") * 2.5), most=30, keys=("obj",)), ("obj",))),
    "pose_errors": PTS(lambda p: _poses(p).select("obj", "pid", F.round("error", 2).alias("error"))),
    "reconstruction": PTS(lambda p: rounded(metrics.reconstruction(p.where("pid % 3 <> 0"), p.where("pid % 3 = 0"), 1.0, 3.0, keys=("obj",)), ("obj",))),
    "similarity_fit": PTS(lambda p: alignment.guarded(alignment.similarity(_matched(p), weight="conf")).select("obj", "n", F.round("s", 4).alias("s"), *[F.round(F.element_at("t", i), 2).alias(f"t{i}") for i in (1, 2, 3)])),
    "robust_similarity": PTS(lambda p: rounded(alignment.alignment_error(_matched(p), alignment.robust_similarity(_matched(p))), ("obj",))),
    "consensus_scale": PTS(lambda p: rounded(alignment.consensus_scale(_chunks(p)), ("obj",), 6)),
    "teta": TWO(lambda g, p: rounded(teta.teta_combine(teta.teta_partial(g, p)), ("cat", "alpha"))),
    "teta_by_class": TWO(lambda g, p: rounded(teta.teta_by_class(teta.teta_combine(teta.teta_partial(g, p, exhaustive=True))), ("alpha",))),
    "kalman_smooth": OBS(lambda o: rounded(alignment.kalman_smooth(o), ("track_id", "frame_idx"))),
    "back_projection": PTS(_backproject),
    "box_corners": PTS(_corners),
    "clean_names": _names,
    "direction_words": PTS(_directions),
}

_Q = f"WITH RECURSIVE {CTES}"


def _bound(c):
    return f"round(CASE WHEN count(*) >= 20 THEN quantile_cont({c}, 0.02) ELSE min({c}) END, 4) AS {c}_min, round(CASE WHEN count(*) >= 20 THEN quantile_cont({c}, 0.98) ELSE max({c}) END, 4) AS {c}_max"


def _axes(form: str) -> str:
    return ", ".join(form.replace("#", c) for c in "xyz")


#: Filter and backward pass as recursions over a track's rows: gains written out for the two-by-two covariance.
_KALMAN = f"""o AS MATERIALIZED (SELECT track_id, frame_idx AS i, ts_s AS t, x, y, z, (0.03e0 * greatest(z, 1) ** 2) ** 2 AS r0 FROM obs),
f AS (SELECT track_id, i, t, x, y, z, 0::DOUBLE AS vx, 0::DOUBLE AS vy, 0::DOUBLE AS vz, 0.0009e0 - 0.0009e0 * 0.0009e0 / (0.0009e0 + r0) AS a, 0::DOUBLE AS b, 1::DOUBLE AS d, x AS qx, y AS qy, z AS qz, 0.0009e0 AS qa, 0::DOUBLE AS qb, 1::DOUBLE AS qd, 0::DOUBLE AS h FROM o WHERE i = 0
 UNION ALL SELECT track_id, i, t, {_axes("q# + qa / tot * o#")}, {_axes("v# + qb / tot * o#")}, qa - qa / tot * qa, qb - qa / tot * qb, qd - qb / tot * qb, {_axes("q#")}, qa, qb, qd, h
  FROM (SELECT *, qa + r0 * CASE WHEN far > 1 THEN 1 + 50 * far * far ELSE 1 END AS tot FROM (SELECT *, (ox * ox + oy * oy + oz * oz) / (qa + r0) / 27 AS far
  FROM (SELECT *, {_axes("z# - q# AS o#")} FROM (SELECT f.track_id, o.i, o.t, o.r0, o.t - f.t AS h, {_axes("f.v#")}, {_axes("o.# AS z#")}, {_axes("f.# + (o.t - f.t) * f.v# AS q#")},
   f.a + 2 * (o.t - f.t) * f.b + (o.t - f.t) ** 2 * f.d + 0.25e0 * (o.t - f.t) ** 4 / 4 AS qa, f.b + (o.t - f.t) * f.d + 0.25e0 * (o.t - f.t) ** 3 / 2 AS qb, f.d + 0.25e0 * (o.t - f.t) ** 2 AS qd
   FROM f JOIN o ON o.track_id = f.track_id AND o.i = f.i + 1))))),
g AS MATERIALIZED (SELECT * FROM f),
s AS (SELECT track_id, i, {_axes("#")}, {_axes("v#")} FROM g WHERE i = (SELECT max(i) FROM o WHERE o.track_id = g.track_id)
 UNION ALL SELECT c.track_id, c.i, {_axes("c.# + ((c.a + n.h * c.b) * n.qd - c.b * n.qb) / (n.qa * n.qd - n.qb ** 2) * (s.# - n.q#) + (c.b * n.qa - (c.a + n.h * c.b) * n.qb) / (n.qa * n.qd - n.qb ** 2) * (s.v# - c.v#)")},
  {_axes("c.v# + ((c.b + n.h * c.d) * n.qd - c.d * n.qb) / (n.qa * n.qd - n.qb ** 2) * (s.# - n.q#) + (c.d * n.qa - (c.b + n.h * c.d) * n.qb) / (n.qa * n.qd - n.qb ** 2) * (s.v# - c.v#)")}
  FROM s JOIN g n ON n.track_id = s.track_id AND n.i = s.i JOIN g c ON c.track_id = s.track_id AND c.i = s.i - 1)"""
_INTER = "greatest(least(g.x1, p.x1) - greatest(g.x0, p.x0), 0) * greatest(least(g.y1, p.y1) - greatest(g.y0, p.y0), 0)"


def _evaluation(areas: dict, dets: tuple) -> str:
    """ev: the evaluation of boxes, its matching as a recursion over the places of an image's predictions."""
    listed = ", ".join(f"('{k}', {lo}::DOUBLE, {hi}::DOUBLE)" for k, (lo, hi) in areas.items())
    return f"""ar(area, lo, hi) AS (VALUES {listed}), th(iou) AS (VALUES (0.5::DOUBLE), (0.75::DOUBLE)),
dt AS MATERIALIZED (SELECT * FROM (SELECT grp, cat, id, score, x0, y0, x1, y1, (x1 - x0) * (y1 - y0) AS size, row_number() OVER (PARTITION BY grp, cat ORDER BY score DESC, id) AS place FROM pred) WHERE place <= {max(dets)}),
cn AS MATERIALIZED (SELECT p.grp, p.cat, p.place, r.area, list({{'ig': ga < r.lo OR ga > r.hi, 'less': -ov, 'later': -gid}} ORDER BY ga < r.lo OR ga > r.hi, -ov, -gid) AS l
 FROM (SELECT p.grp, p.cat, p.place, g.id AS gid, (g.x1 - g.x0) * (g.y1 - g.y0) AS ga, {_INTER} / ((g.x1 - g.x0) * (g.y1 - g.y0) + p.size - {_INTER}) AS ov FROM dt p JOIN gt g ON g.grp = p.grp AND g.cat = p.cat) p, ar r WHERE ov >= 0.5 GROUP BY ALL),
fl AS MATERIALIZED (SELECT d.grp, d.cat, d.place, r.area, t.iou, d.id, d.score, d.size < r.lo OR d.size > r.hi AS far, coalesce(cn.l, []) AS l FROM dt d CROSS JOIN ar r CROSS JOIN th t LEFT JOIN cn ON cn.grp = d.grp AND cn.cat = d.cat AND cn.place = d.place AND cn.area = r.area),
mt AS (SELECT grp, cat, area, iou, 0::BIGINT AS place, []::BIGINT[] AS taken, NULL::BOOLEAN AS hit, NULL::BOOLEAN AS ig FROM (SELECT DISTINCT grp, cat, area, iou FROM fl)
 UNION ALL SELECT grp, cat, area, iou, place, CASE WHEN m IS NULL THEN taken ELSE list_append(taken, m.later) END, m IS NOT NULL, CASE WHEN m IS NULL THEN far ELSE m.ig END
  FROM (SELECT f.grp, f.cat, f.area, f.iou, f.place, w.taken, f.far, list_filter(f.l, lambda x: x.less <= -f.iou AND NOT list_contains(w.taken, x.later))[1] AS m FROM mt w JOIN fl f ON f.grp = w.grp AND f.cat = w.cat AND f.area = w.area AND f.iou = w.iou AND f.place = w.place + 1)),
ok AS MATERIALIZED (SELECT mt.*, d.id, d.score FROM mt JOIN dt d ON d.grp = mt.grp AND d.cat = mt.cat AND d.place = mt.place WHERE NOT ig),
ng AS (SELECT cat, area, count(*) AS n_gt FROM gt g, ar r WHERE (x1 - x0) * (y1 - y0) BETWEEN lo AND hi GROUP BY ALL),
cu AS (SELECT *, sum(CAST(hit AS INT)) OVER o AS tp, count(*) OVER o AS seen FROM ok WINDOW o AS (PARTITION BY cat, area, iou ORDER BY score DESC, grp, id)),
sp AS (SELECT cu.cat, cu.area, cu.iou, CAST(floor(100 * tp / n_gt) AS INT) AS s, max(tp / seen) AS p FROM cu JOIN ng ON ng.cat = cu.cat AND ng.area = cu.area WHERE hit GROUP BY ALL),
pk AS (SELECT cat, area, iou, k, max(p) AS p FROM sp, range(0, 101) r(k) WHERE k <= s GROUP BY ALL), pa AS (SELECT cat, area, iou, sum(p) / 101 AS ap FROM pk GROUP BY ALL),
rc AS (SELECT cat, area, iou, {', '.join(f'count(*) FILTER (WHERE hit AND place <= {m}) AS tp_{m}' for m in dets)} FROM ok GROUP BY ALL),
ev AS MATERIALIZED (SELECT ng.cat, ng.area, th.iou, n_gt, coalesce(ap, 0) AS ap, {', '.join(f'coalesce(tp_{m}, 0) / n_gt AS ar_{m}' for m in dets)} FROM ng CROSS JOIN th LEFT JOIN pa ON pa.cat = ng.cat AND pa.area = ng.area AND pa.iou = th.iou LEFT JOIN rc ON rc.cat = ng.cat AND rc.area = ng.area AND rc.iou = th.iou)"""


ORACLE = {
    "shape_tokens": f"{_Q} SELECT obj, count(*) AS n, {', '.join(f'round(avg({c}), 4) AS {c}_mu, round(stddev_pop({c}), 4) AS {c}_sigma, {_bound(c)}' for c in 'xyz')} FROM pts GROUP BY obj",
    "oriented_boxes": f"""{_Q}, md AS (SELECT obj, count(*) AS n, median(x) AS mx, median(y) AS my, median(z) AS mz FROM pts GROUP BY obj),
f AS (SELECT p.*, n, sqrt((x - mx) ** 2 + (y - my) ** 2 + (z - mz) ** 2) AS d FROM pts p JOIN md USING (obj) WHERE n >= 12), m2 AS (SELECT obj, median(d) AS m FROM f GROUP BY obj), m3 AS (SELECT obj, any_value(m) AS m, median(abs(d - m)) AS mad FROM f JOIN m2 USING (obj) GROUP BY obj),
k AS (SELECT f.*, d <= m + 2.5e0 * 1.4826e0 * (mad + 1e-6) AS ok FROM f JOIN m3 USING (obj)), c AS (SELECT *, sum(CAST(ok AS INT)) OVER (PARTITION BY obj) AS nk FROM k), s AS (SELECT * FROM c WHERE n < 30 OR nk < 12 OR ok),
yw AS (SELECT obj, count(*) AS n_points, -0.5e0 * atan2(2 * covar_samp(x, z), var_samp(x) - var_samp(z)) AS yaw FROM s GROUP BY obj), tu AS (SELECT s.obj, n_points, yaw, cos(yaw) * x - sin(yaw) * z AS u, y AS v, sin(yaw) * x + cos(yaw) * z AS w FROM s JOIN yw USING (obj)),
b AS (SELECT obj, n_points, yaw, {', '.join(f'CASE WHEN count(*) >= 20 THEN quantile_cont({c}, 0.02) ELSE min({c}) END AS {c}0, CASE WHEN count(*) >= 20 THEN quantile_cont({c}, 0.98) ELSE max({c}) END AS {c}1' for c in 'uvw')} FROM tu GROUP BY ALL)
SELECT obj, n_points, round(yaw, 4) AS yaw, round(cos(yaw) * (u0 + u1) / 2 + sin(yaw) * (w0 + w1) / 2, 4) AS cx, round((v0 + v1) / 2, 4) AS cy, round(-sin(yaw) * (u0 + u1) / 2 + cos(yaw) * (w0 + w1) / 2, 4) AS cz, round(greatest(u1 - u0, 1e-4), 4) AS length, round(greatest(v1 - v0, 1e-4), 4) AS height, round(greatest(w1 - w0, 1e-4), 4) AS width FROM b""",
    "voxel_downsample": f"{_Q} SELECT obj, CAST(floor(x / 4) AS BIGINT) AS vx, CAST(floor(y / 4) AS BIGINT) AS vy, CAST(floor(z / 4) AS BIGINT) AS vz, count(*) AS n, round(avg(x), 4) AS x, round(avg(y), 4) AS y, round(avg(z), 4) AS z FROM pts GROUP BY ALL",
    "consistent_fusion": f"{_Q} SELECT CAST(floor(x) AS BIGINT) AS u, CAST(floor(y) AS BIGINT) AS v, count(*) AS n, round(avg(x), 4) AS x, round(avg(y), 4) AS y, round(avg(z), 4) AS z FROM pts GROUP BY ALL HAVING count(*) >= 3",
    "majority_vote": f"{_Q}, n AS (SELECT track_id, name, count(*) AS n, min(frame_idx) AS f FROM obs GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY CAST(name <> 'object' AS INT) DESC, n DESC, f) AS k FROM n) SELECT track_id, name, n AS votes FROM r WHERE k = 1",
    "best_crop": f"{_Q}, r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY score DESC, ext_x DESC, frame_idx) AS k FROM obs) SELECT track_id, frame_idx, score FROM r WHERE k = 1",
    "least_squares_scale": f"{_Q} SELECT obj, round(sum(x * z) / greatest(sum(z * z), 1e-12), 6) AS scale FROM pts GROUP BY obj",
    "weighted_quantile": f"{_Q}, c AS (SELECT obj, z, sum(conf) OVER (PARTITION BY obj ORDER BY z, pid ROWS UNBOUNDED PRECEDING) AS c, sum(conf) OVER (PARTITION BY obj) AS a FROM pts) SELECT obj, round(min(z), 4) AS quantile FROM c WHERE c >= 0.9e0 * a - 1e-12 GROUP BY obj",
    "confidence_threshold": f"{_Q} SELECT obj, round(least(greatest(0.5, quantile_cont(conf, 0.1)), quantile_cont(conf, 0.9)), 4) AS threshold FROM pts GROUP BY obj",
    "scene_scale": f"{_Q} SELECT obj, round(sqrt({' + '.join(f'(quantile_cont({c}, 0.95) - quantile_cont({c}, 0.05)) ** 2' for c in 'xyz')}), 4) AS scale FROM pts GROUP BY obj",
    "min_max_reference": "WITH e AS (SELECT vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))), 6) AS n, round(embedding[1]::DOUBLE, 6) AS f FROM embeddings), o AS (SELECT vec_id, label, round(abs(coalesce((n - min(n) OVER g) / nullif(max(n) OVER g - min(n) OVER g, 0), 0) - 0.5) + abs(coalesce((f - min(f) OVER g) / nullif(max(f) OVER g - min(f) OVER g, 0), 0) - 0.5), 9) AS o FROM e WINDOW g AS (PARTITION BY label)) SELECT label, arg_min(vec_id, (o, vec_id)) AS vec_id FROM o GROUP BY label",
    "patch_grid": f"{_Q}, px AS (SELECT DISTINCT obj, CAST(trunc(x) AS INT) AS u, CAST(trunc(z * 5 - 10) AS INT) AS v FROM pts), c AS (SELECT obj, CAST(least(floor(v / 6), 7) AS BIGINT) AS row, CAST(least(floor(u / 6), 7) AS BIGINT) AS col, count(*) AS n FROM px GROUP BY ALL), a AS (SELECT *, n / ((CASE WHEN row = 7 THEN 11 ELSE 6 END) * (CASE WHEN col = 7 THEN 9 ELSE 6 END)) AS cover FROM c) SELECT obj, row, col, round(cover, 4) AS cover FROM a WHERE cover > 0.1",
    "histogram_bins": f"""{_Q}, b AS (SELECT obj, least(greatest(floor(x / 50 * 8), 0), 7) AS k FROM pts UNION ALL SELECT obj, 8 + least(greatest(floor(y / 14 * 8), 0), 7) FROM pts UNION ALL SELECT obj, 16 + least(greatest(floor(conf * 4), 0), 3) FROM pts),
n AS (SELECT obj, count(*) AS n FROM b GROUP BY obj), g AS (SELECT obj, n, CAST(unnest(range(0, 20)) AS INT) AS bin FROM n) SELECT g.obj, g.bin, round(count(b.k) / any_value(g.n), 6) AS share FROM g LEFT JOIN b ON b.obj = g.obj AND b.k = g.bin GROUP BY g.obj, g.bin""",
    "track_counts": f"{_Q} SELECT video, count(*) AS dets, count(DISTINCT id) AS ids, count(DISTINCT grp) AS frames FROM pred GROUP BY video",
    "average_precision": f"{_Q}, {_evaluation({'all': (0.0, 1e10)}, (100,))} SELECT cat, iou, round(ap, 4) AS ap FROM ev",
    "coco_evaluation": f"{_Q}, {_evaluation(_AREAS, (1, 3))} SELECT cat, area, iou, n_gt, round(ap, 4) AS ap, round(ar_1, 4) AS ar_1, round(ar_3, 4) AS ar_3 FROM ev",
    "coco_summary": f"{_Q}, {_evaluation(_AREAS, (1, 3))} SELECT area, round(avg(ap), 4) AS ap, round(avg(ap) FILTER (WHERE iou = 0.5), 4) AS ap_50, round(avg(ap) FILTER (WHERE iou = 0.75), 4) AS ap_75, round(avg(ar_1), 4) AS ar_1, round(avg(ar_3), 4) AS ar_3 FROM ev GROUP BY area",
    "pose_graph": f"{_Q} SELECT track_id AS seq_id, CAST(frame_idx + 1 AS BIGINT) AS node, CAST(1 AS DOUBLE) AS s, {', '.join(f'round(sum({c}) OVER w, 4) AS {c}' for c in 'xyz')} FROM obs WHERE frame_idx < 6 WINDOW w AS (PARTITION BY track_id ORDER BY frame_idx) UNION ALL SELECT DISTINCT track_id, 0::BIGINT, 1::DOUBLE, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM obs",
    "tracklet_iou": f"""{_Q}, i AS (SELECT g.video, g.id AS gt_id, p.id AS pred_id, sum({_INTER}) AS i FROM gt g JOIN pred p ON g.video = p.video AND g.grp = p.grp GROUP BY ALL), ga AS (SELECT video, id, sum((x1 - x0) * (y1 - y0)) AS a FROM gt GROUP BY ALL), pa AS (SELECT video, id, sum((x1 - x0) * (y1 - y0)) AS a FROM pred GROUP BY ALL)
SELECT i.video, gt_id, pred_id, round(i / (ga.a + pa.a - i), 4) AS iou FROM i JOIN ga ON ga.video = i.video AND ga.id = gt_id JOIN pa ON pa.video = i.video AND pa.id = pred_id""",
    "pose_auc": f"{_Q} SELECT obj, round(avg(CASE WHEN z * 2.5e0 <= 30 THEN (30 - least(floor(z * 2.5e0), 29)) / 30 ELSE 0 END), 4) AS auc FROM pts GROUP BY obj",
    "pose_errors": f"{_Q}, e AS (SELECT obj, pid, degrees(acos(least(1, greatest(-1, cos(y / 7 - conf))))) AS r, degrees(acos(least(1, greatest(-1, (2 * x * z + y * y) / (x * x + y * y + z * z))))) AS t FROM pts) SELECT obj, pid, round(greatest(r, least(t, 180 - t)), 2) AS error FROM e",
    "reconstruction": f"""{_Q}, a AS (SELECT DISTINCT obj, pid FROM pts), d AS (SELECT q.obj, q.pid, q.pid % 3 <> 0 AS is_pred, coalesce(min(sqrt((q.x - t.x) ** 2 + (q.y - t.y) ** 2 + (q.z - t.z) ** 2)), 3) AS d FROM pts q LEFT JOIN pts t ON t.obj = q.obj AND (t.pid % 3 <> 0) <> (q.pid % 3 <> 0) GROUP BY ALL),
m AS (SELECT obj, avg(least(d, 3)) FILTER (WHERE is_pred) AS acc, avg(CAST(d < 1 AS DOUBLE)) FILTER (WHERE is_pred) AS pr, avg(least(d, 3)) FILTER (WHERE NOT is_pred) AS comp, avg(CAST(d < 1 AS DOUBLE)) FILTER (WHERE NOT is_pred) AS re FROM d GROUP BY obj)
SELECT obj, round(acc, 4) AS acc, round(pr, 4) AS precision, round(comp, 4) AS comp, round(re, 4) AS recall, round((acc + comp) / 2, 4) AS overall, round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 4) AS fscore FROM m""",
    "similarity_fit": f"{_Q} SELECT obj, count(*) AS n, CAST(2 AS DOUBLE) AS s, CAST(1 AS DOUBLE) AS t1, CAST(-3 AS DOUBLE) AS t2, CAST(0.5 AS DOUBLE) AS t3 FROM pts GROUP BY obj",
    "consensus_scale": f"""{_Q}, q AS (SELECT obj, pid, z * 1.5e0 + CASE WHEN pid % 9 = 0 THEN 20 ELSE (pid % 7 - 3) / 100 END AS a, z AS b, conf FROM pts), f AS (SELECT obj, greatest(median(conf) * 0.1e0, 1e-6) AS f FROM q GROUP BY obj),
g AS (SELECT q.*, count(*) OVER (PARTITION BY obj) AS n FROM q JOIN f USING (obj) WHERE conf > f AND a > 1e-3 AND a < 100 AND b > 1e-3 AND b < 100), t AS (SELECT obj, pid % least(100, n // 10) AS k, sum(a * b) / sum(b * b) AS s FROM g WHERE n >= 100 GROUP BY ALL),
v AS (SELECT obj, k, s, count(*) FILTER (WHERE abs(a - s * b) <= 0.1e0) AS v FROM g JOIN t USING (obj) GROUP BY ALL), w AS (SELECT obj, arg_max(s, (v, -k)) AS s FROM v GROUP BY obj),
l AS (SELECT obj, sum(a * b) / sum(b * b) AS s, count(*) AS v FROM g JOIN w USING (obj) WHERE abs(a - s * b) <= 0.1e0 GROUP BY obj), m AS (SELECT obj, count(*) AS n FROM g GROUP BY obj)
SELECT o.obj, coalesce(n, 0) AS n, round(CASE WHEN s > 0.1e0 AND s < 10 THEN s ELSE 1 END, 6) AS scale, round(coalesce(v / n, 0), 6) AS inliers FROM (SELECT DISTINCT obj FROM pts) o LEFT JOIN m USING (obj) LEFT JOIN l USING (obj)""",
    "box_corners": f"""{_Q}, k AS (SELECT p.obj, p.x + cos(conf) * i + sin(conf) * conf / 2 * k AS a, p.y + 0.5e0 * j AS b, p.z - sin(conf) * i + cos(conf) * conf / 2 * k AS c
 FROM pts p, (VALUES (-1), (1)) vi(i), (VALUES (-1), (1)) vj(j), (VALUES (-1), (1)) vk(k)) SELECT obj, {', '.join(f'round({f}({c}), 3) AS {n}{a}' for n, f in (('lo_', 'min'), ('hi_', 'max')) for a, c in zip('xyz', 'abc'))} FROM k GROUP BY obj""",
    "clean_names": """WITH l AS (SELECT doc_id, trim(regexp_replace(string_split(lower(trim(text)), chr(10))[1], '["''`]', '', 'g')) AS l FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(regexp_replace(regexp_replace(l, '^(a|an|the)\\s+', ''), '[^a-z0-9 \\-]', ' ', 'g')), '\\s+'), lambda x: x <> '') AS w FROM l),
n AS (SELECT doc_id, array_to_string(w[1:3], ' ') AS name FROM w) SELECT doc_id, name, name = '' OR regexp_matches(name, 'background|wall|floor|ceiling|sky|ground|scene|room|image|unknown|nothing|none') AS bad FROM n""",
    "kalman_smooth": f"{_Q}, {_KALMAN} SELECT track_id, CAST(i AS BIGINT) AS frame_idx, {_axes('round(#, 4) AS #')}, {_axes('round(v#, 4) AS v#')} FROM s",
    "back_projection": f"{_Q} SELECT obj, pid, round((x * 10 - 160) / 300 * z, 4) AS a, round((y * 10 - 120) / 310 * z, 4) AS b, round(z, 4) AS c, round(x * 10, 4) AS u, round(y * 10, 4) AS v, round(z * 450 / 300, 4) AS metric FROM pts",
    "direction_words": f"""{_Q}, d AS (SELECT obj, pid, x - 25 AS dx, y - 7 AS dy, z - 7 AS dz FROM pts), n AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS n FROM d),
w AS (SELECT *, list_sort([{{'s': -abs(dz / n), 'o': 0, 'w': CASE WHEN dz > 0 THEN 'away' ELSE 'toward' END}}, {{'s': -abs(dx / n), 'o': 1, 'w': CASE WHEN dx > 0 THEN 'right' ELSE 'left' END}}, {{'s': -abs(dy / n), 'o': 2, 'w': CASE WHEN dy > 0 THEN 'down' ELSE 'up' END}}]) AS l FROM n)
SELECT obj, pid, CASE WHEN n < 1 THEN 'stationary' ELSE array_to_string(list_transform(list_filter(l, lambda t: t.s <= -0.25)[1:2], lambda t: t.w), ' and ') END AS words FROM w""",
}
