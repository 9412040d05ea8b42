"""Queries of filters, samples, masks, exports and streams."""

import uuid

from pyspark.sql import functions as F

from ..adapters import CTES, boxes, observations, points, predictions, table, truth
from ..functions import masks as M
from ..operators import aggregates, filters, windows
from ..operators.graph import shared_dir
from ..sources import writers
from ..streaming import tracks as streams
from .tracks import _WO, _slope

OBS = lambda f: lambda spark, sf_dir: f(observations(spark, sf_dir))
BOX = lambda f: lambda spark, sf_dir: f(boxes(spark, sf_dir))
PTS = lambda f: lambda spark, sf_dir: f(points(spark, sf_dir))


def _queries(b):
    """Queries over images: one for each box, negative where its score is low."""
    return b.select(F.col("grp").alias("image_id"), (F.col("grp") * 10 + F.col("id")).alias("query_id"), (F.col("score") < 0.5).alias("is_negative"))


def _zero(b):
    flat = b.withColumns({"query_id": F.col("grp") * 10 + F.col("id") % 2, "object_id": F.col("grp") * 10 + F.col("id")}).withColumn("x1", F.when(F.col("id") == 3, F.col("x0")).otherwise(F.col("x1")))
    q, refs = flat.select("query_id").distinct(), flat.select("query_id", "object_id")
    return filters.too_many_outputs(filters.without_zero_boxes(q, refs, flat), refs, 2)


def _compacted(b):
    objects = b.select(F.col("grp").alias("image_id"), (F.col("grp") * 10 + F.col("id")).alias("object_id"))
    queries = b.where("id % 2 = 0").select(F.col("grp").alias("image_id"), (F.col("grp") * 10 + F.col("id")).alias("query_id"))
    refs = b.select((F.col("grp") * 10 + F.col("id")).alias("query_id"), (F.col("grp") * 10 + F.col("id")).alias("object_id"))
    return filters.compacted(queries, refs, objects)[2]


def _discoveries(spark, sf_dir):
    scaled = lambda df: df.select(F.col("grp").alias("frame_idx"), "id", *[(F.col(c) / 64).alias(c) for c in ("x0", "y0", "x1", "y1")])
    return filters.discoveries(scaled(truth(spark, sf_dir)), scaled(predictions(spark, sf_dir).where("id % 2 = 0"))).select("frame_idx", "id")


def _moving(o):
    v = windows.velocity(o, ("x", "y", "z"))
    return filters.moving_tracks(v, 0.0005).select("track_id", F.round("mean_speed", 4).alias("mean_speed"))


def _rle(b):
    """Masks of boxes on an image of 64 x 64, as run lengths; the area comes from the runs."""
    x0, y0, x1, y1 = (F.least(F.col(c), F.lit(64)).cast("int") for c in ("x0", "y0", "x1", "y1"))
    h, w = y1 - y0, x1 - x0
    runs = F.flatten(F.transform(F.sequence(F.lit(1), w), lambda i: F.array(h, 64 - h)))
    counts = F.concat(F.array(x0 * 64 + y0), F.slice(runs, 1, 2 * w - 1), F.array(64 * (64 - x1) + 64 - y1))
    return b.where((h > 0) & (w > 0)).select("grp", "id", M.area(counts).alias("area"))


def _mask_iou(b):
    x0, y0, x1, y1 = (F.least(F.col(c), F.lit(64)).cast("int") for c in ("x0", "y0", "x1", "y1"))
    h, w = y1 - y0, x1 - x0
    runs = F.flatten(F.transform(F.sequence(F.lit(1), w), lambda i: F.array(h, 64 - h)))
    counts = F.concat(F.array(x0 * 64 + y0), F.slice(runs, 1, 2 * w - 1), F.array(64 * (64 - x1) + 64 - y1))
    rows = b.where((h > 0) & (w > 0)).select("grp", "id", F.struct(F.array(F.lit(64), F.lit(64)).alias("size"), counts.alias("counts")).alias("rle"))
    p = rows.alias("a").join(rows.alias("b"), (F.col("a.grp") == F.col("b.grp")) & (F.col("a.id") < F.col("b.id")))
    return p.select(F.col("a.grp").alias("grp"), F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(M.mask_iou(F.col("a.rle"), F.col("b.rle")), 6).alias("iou"))


def _detections(b):
    packed = b.groupBy(F.col("grp").alias("image_id")).agg(F.collect_list(F.array("x0", "y0", "x1", "y1")).alias("boxes"), F.collect_list("score").alias("scores"), F.collect_list("id").alias("labels"))
    d = writers.detection_rows(packed)
    return d.select("image_id", "category_id", *[F.col("bbox")[i].alias(n) for i, n in enumerate("xywh")], "score")


def _merged(b):
    rows = b.select(F.col("grp").alias("image_id"), (F.col("id") % 2).alias("category_id"), (F.col("id") % 3).alias("shard"), "score", F.col("id").alias("pos"))
    return writers.merged_shards(rows, 2).select("image_id", "category_id", "pos")


def _video_frames(o):
    tracks = o.groupBy(F.col("track_id").alias("id")).agg(F.lit(1).alias("video_id"), F.lit(1).alias("category_id"), F.transform(F.array_sort(F.collect_list(F.struct("frame_idx", "x", "yaw"))), lambda s: F.when(s["yaw"].isNotNull(), F.array(s["x"], s["x"], F.lit(1.0), F.lit(1.0)))).alias("bboxes"))
    images = o.select("frame_idx").distinct().select((F.col("frame_idx") + 1000).alias("image_id"), F.lit(1).alias("video_id"), F.col("frame_idx").alias("frame_index"))
    return writers.video_to_frames(tracks, images).select("track_id", "image_id", F.col("bbox")[0].alias("x"))


def _stream_states(spark, sf_dir):
    obs = observations(spark, sf_dir).where("event_id % 4 <> 0").select("track_id", "frame_idx")
    path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    obs.write.parquet(path)
    return streams.run_once(streams.track_states(spark.readStream.schema(obs.schema).parquet(path)), "stream_states")


def _stream_rates(spark, sf_dir):
    q = spark.readStream.schema(table(spark, sf_dir, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    rates = streams.event_rates(q.withColumn("ts", F.col("ts").cast("timestamp")), "1 day")
    return streams.run_once(rates, "stream_rates", "complete").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


QUERIES = {
    "valid_depth": PTS(lambda p: p.where(filters.valid_depth(F.col("z"), F.when(F.col("pid") % 5 != 0, F.col("conf")), 0.3)).select("obj", "pid")),
    "plausible_candidates": PTS(lambda p: filters.plausible_candidates(aggregates.shape_tokens(p), 50, 47.5).select("obj", "n")),
    "moving_tracks": OBS(_moving),
    "low_score_objects": OBS(lambda o: filters.low_score_objects(o, 0.985).select("track_id", "frame_idx")),
    "keep_n_queries": BOX(lambda b: filters.keep_n_queries(_queries(b), 2).select("image_id", "query_id")),
    "zero_box_queries": BOX(_zero),
    "compacted_ids": BOX(_compacted),
    "discoveries": _discoveries,
    "sampled_rows": OBS(lambda o: filters.sample_rows(o, 5, "event_id", keys=("track_id",)).select("track_id", "event_id")),
    "round_robin": BOX(lambda b: filters.round_robin(b, 4, ("id",), ("grp",)).select("grp", "id", F.col("part").cast("int").alias("part"))),
    "closest_frames": OBS(lambda o: filters.closest_frames(o, 20, 6).select("track_id", "frame_idx")),
    "mask_area": BOX(_rle),
    "mask_iou": BOX(_mask_iou),
    "detection_rows": BOX(_detections),
    "merged_shards": BOX(_merged),
    "video_to_frames": OBS(_video_frames),
    "stream_track_states": _stream_states,
    "stream_event_rates": _stream_rates,
}

_Q = f"WITH RECURSIVE {CTES}"
_I = "greatest(least(a.x1, b.x1) - greatest(a.x0, b.x0), 0) * greatest(least(a.y1, b.y1) - greatest(a.y0, b.y0), 0)"
_CLIP = "cl AS (SELECT grp, id, least(x0, 64) AS x0, least(y0, 64) AS y0, least(x1, 64) AS x1, least(y1, 64) AS y1 FROM box)"
ORACLE = {
    "valid_depth": f"{_Q} SELECT obj, pid FROM pts WHERE z > 0 AND (pid % 5 = 0 OR conf >= 0.3)",
    "plausible_candidates": f"{_Q} SELECT obj, count(*) AS n FROM pts GROUP BY obj HAVING count(*) >= 50 AND greatest({', '.join(f'quantile_cont({c}, 0.98) - quantile_cont({c}, 0.02)' for c in 'xyz')}) <= 47.5",
    "moving_tracks": f"{_Q}, v AS (SELECT track_id, {', '.join(f'{_slope(a)} AS v{a}' for a in 'xyz')} FROM obs WINDOW {_WO}), m AS (SELECT track_id, avg(sqrt(vx ** 2 + vy ** 2 + vz ** 2)) AS s FROM v GROUP BY track_id) SELECT track_id, round(s, 4) AS mean_speed FROM m WHERE s >= 0.0005e0",
    "low_score_objects": f"{_Q} SELECT track_id, frame_idx FROM obs WHERE track_id IN (SELECT track_id FROM obs GROUP BY track_id HAVING max(score) >= 0.985)",
    "keep_n_queries": f"{_Q}, q AS (SELECT grp AS image_id, grp * 10 + id AS query_id, score < 0.5 AS neg FROM box), n AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY CAST(neg AS INT), md5('0:' || query_id), query_id) AS n FROM q) SELECT image_id, query_id FROM n WHERE n <= 2",
    "zero_box_queries": f"{_Q} SELECT grp * 10 + id % 2 AS query_id FROM box GROUP BY grp, id % 2 HAVING count(*) <= 2 AND count(*) FILTER (WHERE id = 3) = 0",
    "compacted_ids": f"{_Q} SELECT grp AS image_id, CAST(dense_rank() OVER (PARTITION BY grp ORDER BY id) - 1 AS INT) AS object_id FROM box WHERE id % 2 = 0",
    "discoveries": f"""{_Q}, n AS (SELECT a.grp, a.id, row_number() OVER (PARTITION BY a.grp ORDER BY (a.x1 - a.x0) * (a.y1 - a.y0) DESC, a.id) AS n FROM gt a WHERE a.grp % 5 = 0 AND (a.x1 - a.x0) * (a.y1 - a.y0) / 4096 >= 0.02
 AND NOT EXISTS (SELECT 1 FROM pred b WHERE b.id % 2 = 0 AND b.grp = a.grp AND {_I} / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_I}) >= 0.3)) SELECT grp AS frame_idx, id FROM n WHERE n <= 2""",
    "sampled_rows": f"{_Q}, n AS (SELECT track_id, event_id, row_number() OVER (PARTITION BY track_id ORDER BY md5('42:' || event_id), event_id) AS n FROM obs) SELECT track_id, event_id FROM n WHERE n <= 5",
    "round_robin": f"{_Q} SELECT grp, id, CAST((row_number() OVER (PARTITION BY grp ORDER BY id) - 1) % 4 AS INT) AS part FROM box",
    "closest_frames": f"""{_Q}, r AS (SELECT track_id, frame_idx, CASE WHEN frame_idx = min(frame_idx) OVER p THEN 0 WHEN frame_idx = max(frame_idx) FILTER (WHERE frame_idx < 20) OVER p THEN 1 WHEN frame_idx = min(frame_idx) FILTER (WHERE frame_idx >= 20) OVER p THEN 2 ELSE 3 END AS r FROM obs WINDOW p AS (PARTITION BY track_id)),
n AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY r, abs(frame_idx - 20), frame_idx) AS n FROM r) SELECT track_id, frame_idx FROM n WHERE n <= 6""",
    "mask_area": f"{_Q}, {_CLIP} SELECT grp, id, CAST((x1 - x0) * (y1 - y0) AS INT) AS area FROM cl",
    "mask_iou": f"{_Q}, {_CLIP} SELECT a.grp, a.id AS a, b.id AS b, round({_I} / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_I}), 6) AS iou FROM cl a JOIN cl b ON a.grp = b.grp AND a.id < b.id",
    "detection_rows": f"{_Q} SELECT grp AS image_id, id AS category_id, x0 AS x, y0 AS y, x1 - x0 AS w, y1 - y0 AS h, score FROM box",
    "merged_shards": f"{_Q}, s AS (SELECT grp, id % 2 AS cat, id % 3 AS sh, score, id, min(id % 3) OVER (PARTITION BY grp, id % 2) AS f FROM box), n AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, cat, id) AS n FROM s WHERE sh = f) SELECT grp AS image_id, cat AS category_id, id AS pos FROM n WHERE n <= 2",
    "video_to_frames": f"{_Q} SELECT track_id, CAST(frame_idx + 1000 AS INT) AS image_id, x FROM obs WHERE yaw IS NOT NULL",
    "stream_track_states": f"""{_Q}, g AS (SELECT track_id, frame_idx, frame_idx - lag(frame_idx) OVER o - 1 AS gap FROM obs WHERE event_id % 4 <> 0 WINDOW o AS (PARTITION BY track_id ORDER BY frame_idx)),
r AS (SELECT *, sum(CAST(coalesce(gap, 1) > 0 AS INT)) OVER (PARTITION BY track_id ORDER BY frame_idx) AS grp FROM g), l AS (SELECT *, row_number() OVER (PARTITION BY track_id, grp ORDER BY frame_idx) AS run FROM r)
SELECT track_id, frame_idx, CASE WHEN coalesce(gap, 0) >= 5 THEN 'lost' ELSE 'active' END AS status, CAST(coalesce(gap, 0) AS INT) AS missing_streak, CAST(run AS INT) AS run_length, max(run) OVER (PARTITION BY track_id ORDER BY frame_idx) >= 3 AS is_confirmed FROM l""",
    "stream_event_rates": "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
}
