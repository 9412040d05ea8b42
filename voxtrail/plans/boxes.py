"""Queries over boxes: overlaps, suppression, matching, top-k."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..adapters import CTES, boxes, predictions, truth
from ..functions import boxes as B
from ..operators import matching, nms

BOX = lambda f: lambda spark, sf_dir: f(boxes(spark, sf_dir))
TWO = lambda f: lambda spark, sf_dir: f(truth(spark, sf_dir), predictions(spark, sf_dir))
R = lambda c: F.round(c, 6)
IDS = ("grp", "id")


def _pairs(b):
    return b.alias("a").join(b.alias("b"), (F.col("a.grp") == F.col("b.grp")) & (F.col("a.id") < F.col("b.id")))


def _overlaps(b):
    x, y = B.box(prefix="a."), B.box(prefix="b.")
    return _pairs(b).select(F.col("a.grp").alias("grp"), F.col("a.id").alias("a"), F.col("b.id").alias("b"), R(B.iou(x, y)).alias("iou"), R(B.iom(x, y)).alias("iom"), R(B.ioa(x, y)).alias("ioa"), R(B.giou(x, y) + 1e-9).alias("giou"), R(B.metric_iou(x, y)).alias("metric_iou"), R(B.euclidean_similarity(x, y, 40.0)).alias("similarity"))


def _conversions(b):
    named = lambda parts, name: [R(p).alias(f"{name}{i}") for i, p in enumerate(parts)]
    x = B.box()
    c = B.xyxy_to_cxcywh(x)
    return b.select(*IDS, *named(c, "c"), *named(B.cxcywh_to_xyxy(c), "r"), *named(B.xyxy_to_xywh(x), "w"), *named(B.cxcywh_to_xywh(c), "v"), *named(B.xywh_to_xyxy(B.xyxy_to_xywh(x)), "q"), *named(B.xywh_to_cxcywh(B.xyxy_to_xywh(x)), "s"))


def _box_sets(b):
    x = B.box()
    named = lambda parts, name: [R(p).alias(f"{name}{i}") for i, p in enumerate(parts)]
    return b.select(*IDS, B.area(x).alias("area"), *named(B.clip(x, 50, 50), "clip"), B.nonempty(B.clip(x, 50, 50), 4).alias("nonempty"), B.inside(x, 50, 50).alias("inside"), *named(B.hflip(x, 64), "flip"), *named(B.rescale_about_centre(x, 1.5), "wide"), *named(B.padded_crop(x, 64, 64), "crop"), *named(B.point_distances(x, F.lit(20.0), F.lit(20.0)), "side"), B.near_border(B.scale(x, 1 / 64, 1 / 64), 0.1).alias("near_border"), B.wrap_degrees(F.col("x0") * 37).alias("degrees"))


def _top_k(b):
    n = F.row_number().over(W.partitionBy("grp").orderBy(F.desc("score"), "id"))
    return b.withColumn("n", n).where("n <= 3").select(*IDS, "score")


def _detector(b):
    rows = b.withColumn("frac", B.area(B.box()) / 1600).where("frac > 0 and frac <= 0.35")
    return rows.withColumn("rank", F.row_number().over(W.partitionBy("grp").orderBy(F.desc("frac"), "id"))).where("rank <= 2").select(*IDS, R("frac").alias("frac"), "rank")


def _best_per_key(b):
    return b.groupBy("grp").agg(F.max_by("id", F.struct("score", -F.col("id"))).alias("id"), F.max("score").alias("score"))


def _track_nms(b):
    scores = b.groupBy("video", "id").agg(F.round(F.avg("score"), 9).alias("score"))
    return nms.track_nms(b, scores, 0.05)


def _matches(g, p):
    return matching.optimal_matches(g, p).select("grp", "gt_id", "pred_id", R("iou").alias("iou"))


def _associate(g, p):
    return matching.associate(p, g)


def _greedy_pairs(g, p):
    pairs = g.alias("g").join(p.alias("p"), F.col("g.grp") == F.col("p.grp")).select(F.col("g.grp").alias("grp"), F.col("g.id").alias("a"), F.col("p.id").alias("b"), B.iou(B.box(prefix="g."), B.box(prefix="p.")).alias("overlap"))
    return matching.greedy_one_to_one(pairs.where("overlap >= 0.3")).select("grp", "a", "b")


def _antijoin(g, p):
    """Ground truth without any prediction that holds 70 % of the smaller box."""
    hits = g.alias("g").join(p.alias("p"), (F.col("g.grp") == F.col("p.grp")) & (B.iom(B.box(prefix="g."), B.box(prefix="p.")) >= 0.7), "left_anti")
    return hits.select("grp", "id")


QUERIES = {
    "box_conversions": BOX(_conversions),
    "box_overlaps": BOX(_overlaps),
    "box_sets": BOX(_box_sets),
    "mask_dedup": BOX(lambda b: nms.mask_dedup(b, threshold=0.3).select(*IDS)),
    "nms_iou": BOX(lambda b: nms.nms(b, min_score=0.1, threshold=0.25).select(*IDS)),
    "nms_iom": BOX(lambda b: nms.nms(b, min_score=0.1, threshold=0.5, overlap="iom").select(*IDS)),
    "overlap_removal": BOX(lambda b: nms.overlap_removal(b).select(*IDS, "kept")),
    "frame_nms": BOX(lambda b: nms.frame_nms(b, threshold=0.3).select(*IDS, "x0", "y0", "x1", "y1")),
    "pooled_track_iou": BOX(lambda b: nms.track_pairs(b).select("video", "a", "b", "shared", R(F.col("inter") / F.col("whole")).alias("iou"), R(F.col("inter") / F.col("least")).alias("iom"))),
    "track_nms": BOX(_track_nms),
    "anchor_dedup": BOX(lambda b: nms.anchor_dedup(b, keys=("grp",)).select("grp", "object", "first_id", "n", "x0", "y0", "x1", "y1")),
    "top_k_per_image": BOX(_top_k),
    "detector_filter": BOX(_detector),
    "best_per_key": BOX(_best_per_key),
    "optimal_matches": TWO(_matches),
    "association": TWO(_associate),
    "association_by_threshold": TWO(lambda g, p: matching.associate_by_threshold(p, g).select("grp", "det_id", "trk_id", R("overlap").alias("overlap"))),
    "greedy_pairs": TWO(_greedy_pairs),
    "late_dedup_antijoin": TWO(_antijoin),
}

_Q = f"WITH RECURSIVE {CTES}"


def _inter(a="a", b="b"):
    return f"greatest(least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0), 0) * greatest(least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0), 0)"


def _area(a):
    return f"(({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0))"


def _iou(a="a", b="b"):
    return f"({_inter(a, b)} / ({_area(a)} + {_area(b)} - {_inter(a, b)}))"


def _iom(a="a", b="b"):
    return f"({_inter(a, b)} / least({_area(a)}, {_area(b)}))"


def _greedy(order: str, rule: str, where: str = "true") -> str:
    """Greedy suppression as a recursion over ranks; kept ranks are a list."""
    return f"""rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY {order}) AS rk FROM box WHERE {where}),
bad AS MATERIALIZED (SELECT r.grp, r.rk, list(k.rk) AS ks FROM rk r JOIN rk k ON r.grp = k.grp AND k.rk < r.rk AND {rule} GROUP BY ALL),
full_ AS MATERIALIZED (SELECT rk.grp, rk.rk, rk.id, coalesce(bad.ks, []) AS ks FROM rk LEFT JOIN bad ON rk.grp = bad.grp AND rk.rk = bad.rk),
walk AS (SELECT grp, rk, [rk] AS kept FROM full_ WHERE rk = 1
  UNION ALL SELECT w.grp, f.rk, CASE WHEN list_has_any(f.ks, w.kept) THEN w.kept ELSE list_append(w.kept, f.rk) END FROM walk w JOIN full_ f ON f.grp = w.grp AND f.rk = w.rk + 1),
last_ AS (SELECT grp, arg_max(kept, rk) AS kept FROM walk GROUP BY grp),
stay AS (SELECT f.grp, f.id FROM full_ f JOIN last_ l ON f.grp = l.grp WHERE list_contains(l.kept, f.rk))"""


def _anchors() -> str:
    """ob: the objects of each group, a list that the group's boxes go through in order."""
    iou, iom, near = f"coalesce({_iou('o', 'q')}, 0)", _iom("o", "q"), "sqrt((((o.x0 + o.x1) / 2 - (q.x0 + q.x1) / 2) / 64) ** 2 + (((o.y0 + o.y1) / 2 - (q.y0 + q.y1) / 2) / 64) ** 2) < 0.05"
    fits = f"({iou} >= 0.4 OR {near} AND {_area('o')} / {_area('q')} BETWEEN 0.5 AND 2 OR {iom} >= 0.7)"
    held = f"(NOT {iou} >= 0.4 AND {_area('o')} > {_area('q')} AND {iom} >= 0.7)"
    kept = ", ".join(f"'{c}': CASE WHEN {held} THEN o.{c} ELSE q.{c} END" for c in ("x0", "y0", "x1", "y1"))
    fresh = ", ".join(f"'{c}': q.{c}" for c in ("x0", "y0", "x1", "y1"))
    return f"""rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY id) AS rk FROM box WHERE (x1 - x0) * (y1 - y0) >= 100),
walk AS (SELECT grp, rk, [{{'first_id': id, 'n': 1, {fresh}}}] AS objs FROM rk q WHERE rk = 1
 UNION ALL SELECT grp, rk, CASE WHEN hit = 0 OR hit IS NULL THEN list_append(objs, {{'first_id': q.id, 'n': 1, {fresh}}}) ELSE list_transform(objs, lambda o, i: CASE WHEN i = hit THEN {{'first_id': o.first_id, 'n': o.n + 1, {kept}}} ELSE o END) END
  FROM (SELECT q.grp, q.rk, q, w.objs, list_position(list_transform(w.objs, lambda o: {fits}), true) AS hit FROM walk w JOIN rk q ON q.grp = w.grp AND q.rk = w.rk + 1)),
ob AS (SELECT grp, arg_max(objs, rk) AS objs FROM walk GROUP BY grp)"""


_D = f"{_Q}, {_greedy('score DESC, id', _iou('r', 'k') + ' >= 0.3')}"
ORACLE = {
    "box_conversions": f"{_Q} SELECT grp, id, round((x0 + x1) / 2, 6) AS c0, round((y0 + y1) / 2, 6) AS c1, x1 - x0 AS c2, y1 - y0 AS c3, x0 AS r0, y0 AS r1, x1 AS r2, y1 AS r3, x0 AS w0, y0 AS w1, x1 - x0 AS w2, y1 - y0 AS w3, x0 AS v0, y0 AS v1, x1 - x0 AS v2, y1 - y0 AS v3, x0 AS q0, y0 AS q1, x1 AS q2, y1 AS q3, round((x0 + x1) / 2, 6) AS s0, round((y0 + y1) / 2, 6) AS s1, x1 - x0 AS s2, y1 - y0 AS s3 FROM box",
    "box_overlaps": f"""{_Q} SELECT a.grp, a.id AS a, b.id AS b, round({_iou()}, 6) AS iou, round({_iom()}, 6) AS iom, round({_inter()} / {_area('a')}, 6) AS ioa,
 round({_iou()} - ((greatest(a.x1, b.x1) - least(a.x0, b.x0)) * (greatest(a.y1, b.y1) - least(a.y0, b.y0)) - ({_area('a')} + {_area('b')} - {_inter()})) / ((greatest(a.x1, b.x1) - least(a.x0, b.x0)) * (greatest(a.y1, b.y1) - least(a.y0, b.y0))) + 1e-9, 6) AS giou,
 round({_iou()}, 6) AS metric_iou, round(greatest(0, 1 - sqrt(((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2) ** 2 + ((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2) ** 2) / 40), 6) AS similarity FROM box a JOIN box b ON a.grp = b.grp AND a.id < b.id""",
    "box_sets": f"""{_Q}, c AS (SELECT *, greatest(least(x0, 50), 0) AS a0, greatest(least(y0, 50), 0) AS a1, greatest(least(x1, 50), 0) AS a2, greatest(least(y1, 50), 0) AS a3, x1 - x0 AS w, y1 - y0 AS h FROM box)
SELECT grp, id, w * h AS area, a0 AS clip0, a1 AS clip1, a2 AS clip2, a3 AS clip3, a2 - a0 > 4 AND a3 - a1 > 4 AS nonempty, x0 >= 0 AND y0 >= 0 AND x1 < 50 AND y1 < 50 AS inside, 64 - x1 AS flip0, y0 AS flip1, 64 - x0 AS flip2, y1 AS flip3,
 round((x0 + x1) / 2 - w * 0.75, 6) AS wide0, round((y0 + y1) / 2 - h * 0.75, 6) AS wide1, round((x0 + x1) / 2 + w * 0.75, 6) AS wide2, round((y0 + y1) / 2 + h * 0.75, 6) AS wide3,
 least(greatest(x0 - floor(w * 0.2e0), 0), 64) AS crop0, least(greatest(y0 - floor(h * 0.2e0), 0), 64) AS crop1, least(greatest(x1 + floor(w * 0.2e0), 0), 64) AS crop2, least(greatest(y1 + floor(h * 0.2e0), 0), 64) AS crop3,
 20 - x0 AS side0, 20 - y0 AS side1, x1 - 20 AS side2, y1 - 20 AS side3, (x0 + x1) / 128 < 0.1 OR (x0 + x1) / 128 > 0.9 OR (y0 + y1) / 128 < 0.1 OR (y0 + y1) / 128 > 0.9 AS near_border, x0 * 37 + 180 - floor((x0 * 37 + 180) / 360) * 360 - 180 AS degrees FROM c""",
    "mask_dedup": f"{_D} SELECT * FROM stay",
    "nms_iou": f"{_Q}, {_greedy('score DESC, id DESC', _iou('r', 'k') + ' > 0.25', 'score > 0.1')} SELECT * FROM stay",
    "nms_iom": f"{_Q}, {_greedy('score DESC, id DESC', _iom('r', 'k') + ' > 0.5', 'score > 0.1')} SELECT * FROM stay",
    "overlap_removal": f"{_Q}, {_greedy('score DESC, id', _iom('r', 'k') + ' > 0.3')} SELECT b.grp, b.id, s.id IS NOT NULL AS kept FROM box b LEFT JOIN stay s ON b.grp = s.grp AND b.id = s.id",
    "frame_nms": f"{_D} SELECT b.grp, b.id, {', '.join(f'CASE WHEN s.id IS NOT NULL THEN {c} END AS {c}' for c in ('x0', 'y0', 'x1', 'y1'))} FROM box b LEFT JOIN stay s ON b.grp = s.grp AND b.id = s.id",
    "pooled_track_iou": f"{_Q} SELECT a.video, a.id AS a, b.id AS b, count(*) AS shared, round(sum({_inter()}) / sum({_area('a')} + {_area('b')} - {_inter()}), 6) AS iou, round(sum({_inter()}) / sum(least({_area('a')}, {_area('b')})), 6) AS iom FROM box a JOIN box b ON a.video = b.video AND a.grp = b.grp AND a.id < b.id GROUP BY ALL",
    "track_nms": f"""{_Q}, b8 AS (SELECT * FROM box), sc AS (SELECT video, id, round(avg(score), 9) AS score FROM b8 GROUP BY ALL),
pr AS (SELECT a.video, a.id AS a, b.id AS b FROM b8 a JOIN b8 b ON a.video = b.video AND a.grp = b.grp AND a.id < b.id GROUP BY ALL HAVING sum({_inter()}) / sum({_area('a')} + {_area('b')} - {_inter()}) >= 0.05),
both_ AS (SELECT video, a, b FROM pr UNION ALL SELECT video, b, a FROM pr), rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY video ORDER BY score DESC, id) AS rk FROM sc),
full_ AS MATERIALIZED (SELECT r.video, r.rk, r.id, coalesce((SELECT list(b.b) FROM both_ b WHERE b.video = r.video AND b.a = r.id), []) AS ks FROM rk r),
walk AS (SELECT video, rk, [id] AS kept FROM full_ WHERE rk = 1 UNION ALL SELECT w.video, f.rk, CASE WHEN list_has_any(f.ks, w.kept) THEN w.kept ELSE list_append(w.kept, f.id) END FROM walk w JOIN full_ f ON f.video = w.video AND f.rk = w.rk + 1),
last_ AS (SELECT video, arg_max(kept, rk) AS kept FROM walk GROUP BY video)
SELECT sc.video, sc.id, sc.score, list_contains(l.kept, sc.id) AS kept FROM sc JOIN last_ l ON sc.video = l.video""",
    "top_k_per_image": f"{_Q}, n AS (SELECT grp, id, score, row_number() OVER (PARTITION BY grp ORDER BY score DESC, id) AS n FROM box) SELECT grp, id, score FROM n WHERE n <= 3",
    "detector_filter": f"{_Q}, f AS (SELECT grp, id, (x1 - x0) * (y1 - y0) / 1600 AS frac FROM box), n AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY frac DESC, id) AS rank FROM f WHERE frac > 0 AND frac <= 0.35) SELECT grp, id, round(frac, 6) AS frac, CAST(rank AS INT) AS rank FROM n WHERE rank <= 2",
    "best_per_key": f"{_Q} SELECT grp, arg_max(id, (score, -id)) AS id, max(score) AS score FROM box GROUP BY grp",
    "association_by_threshold": f"""{_Q}, p AS (SELECT d.grp, d.id AS det_id, t.id AS trk_id, {_iou('d', 't')} AS overlap FROM pred d JOIN gt t ON d.grp = t.grp WHERE {_iou('d', 't')} >= 0.5),
s AS (SELECT *, count(*) OVER (PARTITION BY grp, det_id) > 1 AND count(*) OVER (PARTITION BY grp, trk_id) > 1 AS many FROM p), n AS (SELECT *, row_number() OVER (PARTITION BY grp, det_id ORDER BY overlap DESC, trk_id) AS n FROM s WHERE NOT many)
SELECT grp, det_id, trk_id, round(overlap, 6) AS overlap FROM n WHERE n = 1""",
    "anchor_dedup": f"{_Q}, {_anchors()} SELECT grp, CAST(i AS INT) AS object, objs[i + 1].first_id AS first_id, objs[i + 1].n AS n, objs[i + 1].x0 AS x0, objs[i + 1].y0 AS y0, objs[i + 1].x1 AS x1, objs[i + 1].y1 AS y1 FROM (SELECT grp, objs, unnest(range(len(objs))) AS i FROM ob)",
    "greedy_pairs": f"""{_Q}, pr AS MATERIALIZED (SELECT g.grp, g.id AS a, p.id AS b, {_iou('g', 'p')} AS overlap FROM gt g JOIN pred p ON g.grp = p.grp WHERE {_iou('g', 'p')} >= 0.3),
rk AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY overlap DESC, a, b) AS rk FROM pr), bad AS MATERIALIZED (SELECT r.grp, r.rk, list(k.rk) AS ks FROM rk r JOIN rk k ON r.grp = k.grp AND k.rk < r.rk AND (r.a = k.a OR r.b = k.b) GROUP BY ALL),
full_ AS MATERIALIZED (SELECT rk.grp, rk.rk, coalesce(bad.ks, []) AS ks FROM rk LEFT JOIN bad ON rk.grp = bad.grp AND rk.rk = bad.rk),
walk AS (SELECT grp, rk, [rk] AS kept FROM full_ WHERE rk = 1 UNION ALL SELECT w.grp, f.rk, CASE WHEN list_has_any(f.ks, w.kept) THEN w.kept ELSE list_append(w.kept, f.rk) END FROM walk w JOIN full_ f ON f.grp = w.grp AND f.rk = w.rk + 1),
last_ AS (SELECT grp, arg_max(kept, rk) AS kept FROM walk GROUP BY grp) SELECT rk.grp, rk.a, rk.b FROM rk JOIN last_ l ON rk.grp = l.grp WHERE list_contains(l.kept, rk.rk)""",
    "late_dedup_antijoin": f"{_Q} SELECT g.grp, g.id FROM gt g WHERE NOT EXISTS (SELECT 1 FROM pred p WHERE p.grp = g.grp AND {_iom('g', 'p')} >= 0.7)",
}
