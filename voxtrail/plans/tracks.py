"""Queries over tracks of observations."""

from pyspark.sql import functions as F

from ..adapters import CTES, observations
from ..functions import text as T
from ..operators import exports, windows

OBS = lambda f: lambda spark, sf_dir: f(observations(spark, sf_dir))
R = lambda *cs: [F.round(c, 4).alias(c) for c in cs]


def _frames(obs):
    return obs.groupBy("frame_idx").agg(F.min("ts_s").alias("ts_s"))


def _all_frames(obs):
    every = exports.all_frames(_frames(obs), exports.visible_objects(obs).where("track_id % 3 = 0"))
    return every.select("frame_idx", "frame_key", F.round("timestamp", 4).alias("timestamp"), F.size("visible_objects").alias("n_objects"), F.array_join(F.transform("visible_objects", lambda o: o["id"].cast("string")), ",").alias("ids"))


def _scene_graph(obs):
    g = exports.scene_graph(obs, last=5)
    return g.select("track_id", "n_obs", "size_x", "size_y", "size_z", "cx", "cy", F.size("trajectory").alias("n_points"), F.array_join(F.transform("trajectory", lambda p: p["frame_idx"].cast("string")), ",").alias("frames"))


QUERIES = {
    "visible_objects": OBS(exports.visible_objects),
    "all_frames": OBS(_all_frames),
    "scene_graph": OBS(_scene_graph),
    "prompt_text": OBS(lambda o: exports.prompt_text(exports.scene_graph(o, last=3))),
    "survivor_tracks": OBS(lambda o: exports.survivors(o).select("track_id", "n_obs", *R("size_x", "size_y", "size_z"))),
    "moving_average": OBS(lambda o: windows.moving_average(o, ("x", "y", "z")).select("track_id", "frame_idx", *R("x_s", "y_s", "z_s"))),
    "circular_yaw": OBS(lambda o: windows.circular_yaw(o).select("track_id", "frame_idx", *R("yaw_s"))),
    "velocity_lsq": OBS(lambda o: windows.velocity(o, ("x", "y", "z")).select("track_id", "frame_idx", *R("vx", "vy", "vz"))),
    "path_statistics": OBS(lambda o: windows.path_statistics(o).select("track_id", "n_obs", *R("path_length", "displacement", "range_x", "range_y", "range_z"))),
    "motion_phases": OBS(lambda o: windows.motion_phases(o, "y", 0.5)),
    "motion_reversals": OBS(lambda o: windows.reversals(windows.motion_phases(o, "y", 0.5))),
    "box_filter": OBS(lambda o: windows.box_filter(o, "x").select("track_id", "frame_idx", *R("x_f"))),
    "gaussian_path": OBS(lambda o: windows.gaussian_path(o, "x", 5).select("track_id", "frame_idx", F.round("x_g", 6).alias("x_g"))),
    "camera_motion": OBS(lambda o: windows.camera_motion(o).select("track_id", "motion", *R("moved"))),
    "estimated_fps": OBS(lambda o: windows.estimated_fps(o).select("track_id", F.round("fps", 9).alias("fps"))),
    "keyframe_fill": OBS(lambda o: windows.fill_from_keyframes(o, "x", F.col("frame_idx") % 5 == 0).select("track_id", "frame_idx", *R("x_key"))),
    "nearest_keyframe": OBS(lambda o: o.select("track_id", "frame_idx", windows.nearest_keyframe(F.col("frame_idx"), 4, F.lit(12)).alias("keyframe"))),
    "sample_by_time": OBS(lambda o: windows.sample_by_time(o, fps=1 / 43200.0, most=20).select("track_id", "frame_idx")),
    "every_kth": OBS(lambda o: windows.every_kth(o, 3).select("track_id", "frame_idx")),
    "chunk_windows": OBS(lambda o: windows.chunks(o.groupBy("track_id").agg(F.count("*").cast("int").alias("n")), 12, 4)),
    "sample_stages": OBS(lambda o: windows.sample_stages(o, 8, 5).select("track_id", "frame_idx")),
    "track_states": OBS(lambda o: windows.track_states(o.where("event_id % 4 <> 0"), 80)),
    "confirmed_tracks": OBS(lambda o: windows.confirmed(o, F.col("score") >= 0.4).select("track_id", "frame_idx", F.col("run_length").cast("long").alias("run_length"), "is_confirmed")),
    "hot_start": OBS(lambda o: windows.hot_start(o, F.col("score") >= 0.5)),
    "image_position": OBS(lambda o: o.select("event_id", T.position_9(F.col("cx"), F.col("cy")).alias("position"))),
}

_SMOOTH = "w AS (PARTITION BY track_id ORDER BY frame_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)"


def _slope(c: str, src: str = "s") -> str:
    return f"""CASE WHEN count(*) OVER w >= 3 AND max(ts_s) OVER w - min(ts_s) OVER w > 1e-6 THEN regr_slope({c}, ts_s) OVER w
  WHEN lead(ts_s) OVER o - lag(ts_s) OVER o > 1e-6 THEN (lead({c}) OVER o - lag({c}) OVER o) / (lead(ts_s) OVER o - lag(ts_s) OVER o)
  WHEN lead(ts_s) OVER o - ts_s > 1e-6 THEN (lead({c}) OVER o - {c}) / (lead(ts_s) OVER o - ts_s)
  WHEN ts_s - lag(ts_s) OVER o > 1e-6 THEN ({c} - lag({c}) OVER o) / (ts_s - lag(ts_s) OVER o) ELSE 0 END"""


_WO = _SMOOTH + ", o AS (PARTITION BY track_id ORDER BY frame_idx)"
_SIZES = "sizes AS (SELECT track_id, count(*) AS n_obs, quantile_cont(ext_x, 0.5) AS size_x, quantile_cont(ext_y, 0.5) AS size_y, quantile_cont(ext_z, 0.5) AS size_z FROM obs GROUP BY track_id)"
_VISIBLE = f"""s AS (SELECT *, {", ".join(f"CASE WHEN count(*) OVER (PARTITION BY track_id) >= 3 THEN avg({a}) OVER w ELSE {a} END AS {a}s" for a in "xyz")} FROM obs WINDOW {_SMOOTH}),
vel AS (SELECT *, {", ".join(f"{_slope(a + 's')} AS v{a}" for a in "xyz")} FROM s WINDOW {_WO}), {_SIZES},
vis AS (SELECT frame_idx, track_id, name, ts_s, {", ".join(f"round({a}s, 4) AS {a}" for a in "xyz")}, {", ".join(f"round(v{a}, 4) AS v{a}" for a in "xyz")}, {", ".join(f"round(size_{a}, 4) AS size_{a}" for a in "xyz")}
  FROM vel JOIN sizes USING (track_id) WHERE n_obs >= 3 AND greatest(size_x, size_y, size_z) <= 15)"""
_PHASES = """sg AS (SELECT track_id, frame_idx, CASE WHEN y - lag(y) OVER o > 0.5 THEN 1 WHEN y - lag(y) OVER o < -0.5 THEN -1 ELSE 0 END AS sg, row_number() OVER o AS rn FROM obs WINDOW o AS (PARTITION BY track_id ORDER BY frame_idx)),
nw AS (SELECT *, coalesce(CAST(sg <> lag(sg) OVER (PARTITION BY track_id ORDER BY frame_idx) AS INT), 1) AS nw FROM sg WHERE rn > 1),
ph AS (SELECT *, sum(nw) OVER (PARTITION BY track_id ORDER BY frame_idx) AS phase FROM nw),
phases AS (SELECT track_id, CAST(phase AS BIGINT) AS phase, min(sg) AS sign, min(frame_idx) AS first, max(frame_idx) AS last, count(*) AS n FROM ph GROUP BY ALL)"""
_Q = f"WITH RECURSIVE {CTES}"
_G = [2.718281828459045 ** (-0.5 * (k / (5 / 6)) ** 2) for k in (-2, -1, 0, 1, 2)]

ORACLE = {
    "visible_objects": f"{_Q}, {_VISIBLE} SELECT * FROM vis",
    "all_frames": f"""{_Q}, {_VISIBLE}, fr AS (SELECT frame_idx, round(min(ts_s), 4) AS timestamp FROM obs GROUP BY frame_idx),
ob AS (SELECT frame_idx, count(*) AS n, string_agg(track_id, ',' ORDER BY track_id) AS ids FROM vis WHERE track_id % 3 = 0 GROUP BY frame_idx)
SELECT frame_idx, 'frame_' || (row_number() OVER (ORDER BY frame_idx) - 1) AS frame_key, timestamp, CAST(coalesce(n, 0) AS INT) AS n_objects, coalesce(ids, '') AS ids FROM fr LEFT JOIN ob USING (frame_idx)""",
    "scene_graph": f"""{_Q}, g AS (SELECT track_id, count(*) AS n_obs, round(quantile_cont(ext_x, 0.5), 2) AS size_x, round(quantile_cont(ext_y, 0.5), 2) AS size_y, round(quantile_cont(ext_z, 0.5), 2) AS size_z, arg_min(cx, frame_idx) AS cx, arg_min(cy, frame_idx) AS cy, list(frame_idx ORDER BY frame_idx) AS fs FROM obs GROUP BY track_id)
SELECT track_id, n_obs, size_x, size_y, size_z, cx, cy, CAST(least(len(fs), 5) AS INT) AS n_points, array_to_string(fs[greatest(len(fs) - 4, 1):], ',') AS frames FROM g WHERE n_obs >= 3 AND greatest(size_x, size_y, size_z) <= 15""",
    "prompt_text": f"""{_Q}, r AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame_idx DESC) AS back FROM obs), {_SIZES}
SELECT track_id, 'object ' || track_id || ' size=[' || printf('%.2f,%.2f,%.2f', round(any_value(size_x), 2), round(any_value(size_y), 2), round(any_value(size_z), 2)) || ']' || chr(10) || string_agg('  F' || frame_idx || printf(' pos=[%.3f,%.3f,%.3f]', round(x, 2), round(y, 2), round(z, 2)), chr(10) ORDER BY frame_idx) AS text
FROM r JOIN sizes USING (track_id) WHERE back <= 3 AND n_obs >= 3 GROUP BY track_id""",
    "survivor_tracks": f"{_Q}, {_SIZES} SELECT track_id, n_obs, round(size_x, 4) AS size_x, round(size_y, 4) AS size_y, round(size_z, 4) AS size_z FROM sizes WHERE n_obs >= 3 AND greatest(size_x, size_y, size_z) <= 15",
    "moving_average": f"{_Q} SELECT track_id, frame_idx, {', '.join(f'round(CASE WHEN count(*) OVER (PARTITION BY track_id) >= 3 THEN avg({a}) OVER w ELSE {a} END, 4) AS {a}_s' for a in 'xyz')} FROM obs WINDOW {_SMOOTH}",
    "circular_yaw": f"{_Q} SELECT track_id, frame_idx, round(CASE WHEN yaw IS NULL THEN 0 ELSE atan2(sum(sin(2 * yaw)) OVER w, sum(cos(2 * yaw)) OVER w) / 2 END, 4) AS yaw_s FROM obs WINDOW {_SMOOTH}",
    "velocity_lsq": f"{_Q} SELECT track_id, frame_idx, {', '.join(f'round({_slope(a)}, 4) AS v{a}' for a in 'xyz')} FROM obs WINDOW {_WO}",
    "path_statistics": f"""{_Q}, st AS (SELECT *, sqrt((x - lag(x) OVER o) ** 2 + (y - lag(y) OVER o) ** 2 + (z - lag(z) OVER o) ** 2) AS st FROM obs WINDOW o AS (PARTITION BY track_id ORDER BY frame_idx))
SELECT track_id, count(*) AS n_obs, round(coalesce(sum(st), 0), 4) AS path_length, round(sqrt((arg_max(x, frame_idx) - arg_min(x, frame_idx)) ** 2 + (arg_max(y, frame_idx) - arg_min(y, frame_idx)) ** 2 + (arg_max(z, frame_idx) - arg_min(z, frame_idx)) ** 2), 4) AS displacement, round(max(x) - min(x), 4) AS range_x, round(max(y) - min(y), 4) AS range_y, round(max(z) - min(z), 4) AS range_z FROM st GROUP BY track_id""",
    "motion_phases": f"{_Q}, {_PHASES} SELECT * FROM phases",
    "motion_reversals": f"{_Q}, {_PHASES}, t AS (SELECT track_id, CAST(sign <> lag(sign) OVER (PARTITION BY track_id ORDER BY phase) AS INT) AS t FROM phases WHERE sign <> 0) SELECT track_id, CAST(coalesce(sum(t), 0) AS BIGINT) AS n_reversals, coalesce(sum(t), 0) >= 3 AS oscillates FROM t GROUP BY track_id",
    "box_filter": f"{_Q} SELECT track_id, frame_idx, round((coalesce(lag(x) OVER o, 0) + x + coalesce(lead(x) OVER o, 0)) / 3, 4) AS x_f FROM obs WINDOW o AS (PARTITION BY track_id ORDER BY frame_idx)",
    "gaussian_path": f"""{_Q}, n AS (SELECT *, count(*) OVER (PARTITION BY track_id) AS n FROM obs), k(half, d, w) AS (VALUES (0, 0, 1.0), (1, -1, 0.25), (1, 0, 0.5), (1, 1, 0.25), (2, -2, 0.0625), (2, -1, 0.25), (2, 0, 0.375), (2, 1, 0.25), (2, 2, 0.0625)),
s AS (SELECT n.*, k.w, abs(CASE WHEN frame_idx + d >= n THEN 2 * n - 2 - frame_idx - d ELSE frame_idx + d END) AS at FROM n JOIN k ON k.half = CASE WHEN n >= 5 THEN 2 WHEN n >= 3 THEN 1 ELSE 0 END)
SELECT s.track_id, s.frame_idx, round(sum(s.w::DOUBLE * p.x), 6) AS x_g FROM s JOIN obs p ON p.track_id = s.track_id AND p.frame_idx = s.at GROUP BY ALL""",
    "camera_motion": f"{_Q}, d AS (SELECT track_id, sqrt((arg_max(x, frame_idx) - arg_min(x, frame_idx)) ** 2 + (arg_max(y, frame_idx) - arg_min(y, frame_idx)) ** 2 + (arg_max(z, frame_idx) - arg_min(z, frame_idx)) ** 2) AS m FROM obs GROUP BY track_id) SELECT track_id, CASE WHEN m < 0.01 THEN 'static' WHEN m < 0.3 THEN 'slight' WHEN m < 1 THEN 'moderate' ELSE 'large' END AS motion, round(m, 4) AS moved FROM d",
    "estimated_fps": f"{_Q}, d AS (SELECT track_id, ts_s - lag(ts_s) OVER (PARTITION BY track_id ORDER BY frame_idx) AS d FROM obs) SELECT track_id, round(1 / quantile_cont(d, 0.5), 9) AS fps FROM d WHERE d > 0 GROUP BY track_id",
    "keyframe_fill": f"{_Q} SELECT track_id, frame_idx, round(last_value(CASE WHEN frame_idx % 5 = 0 THEN x END IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS x_key FROM obs",
    "nearest_keyframe": f"{_Q} SELECT track_id, frame_idx, CAST(least(CASE WHEN frame_idx % 4 = 2 THEN 2 * ((frame_idx // 4 + 1) // 2) ELSE round(frame_idx / 4) END, 12) AS INT) AS keyframe FROM obs",
    "sample_by_time": f"{_Q}, k AS (SELECT track_id, frame_idx, ts_s, row_number() OVER (PARTITION BY track_id, floor((ts_s + 1e-9) * (1 / 43200.0e0)) ORDER BY ts_s, frame_idx) AS n FROM obs), c AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY ts_s, frame_idx) AS r FROM k WHERE n = 1) SELECT track_id, frame_idx FROM c WHERE r <= 20",
    "every_kth": f"{_Q} SELECT track_id, frame_idx FROM obs WHERE frame_idx % 3 = 0",
    "chunk_windows": f"{_Q}, n AS (SELECT track_id, CAST(count(*) AS INT) AS n FROM obs GROUP BY track_id), c AS (SELECT *, CAST(CASE WHEN n <= 12 THEN 1 ELSE ceil((n - 4) / 8) END AS INT) AS k FROM n), x AS (SELECT *, CAST(unnest(range(0, k)) AS INT) AS chunk FROM c) SELECT track_id, n, chunk, CAST(chunk * 8 AS INT) AS start, CAST(CASE WHEN chunk = k - 1 THEN n ELSE least(chunk * 8 + 12, n) END AS INT) AS stop FROM x",
    "sample_stages": f"{_Q}, n AS (SELECT track_id, frame_idx, count(*) OVER (PARTITION BY track_id) AS n FROM obs), s AS (SELECT *, least(5, greatest(1, (n - 1) // 7)) AS st FROM n WHERE n >= 8) SELECT track_id, frame_idx FROM s WHERE frame_idx % st = 0 AND frame_idx // st < 8",
    "track_states": f"""{_Q}, k AS (SELECT track_id, frame_idx, lead(frame_idx, 1, 81) OVER (PARTITION BY track_id ORDER BY frame_idx) - frame_idx - 1 AS gap FROM obs WHERE event_id % 4 <> 0),
a AS (SELECT track_id, max(frame_idx) AS l, min(frame_idx) FILTER (WHERE gap >= 35) AS e FROM k WHERE frame_idx <= 80 GROUP BY track_id)
SELECT track_id, coalesce(e, l) AS last_seen, CAST(CASE WHEN e IS NOT NULL THEN least(80 - e, 35) ELSE 80 - l END AS INT) AS missing_streak, CASE WHEN e IS NOT NULL THEN 'archived' WHEN 80 - l >= 5 THEN 'lost' ELSE 'active' END AS status FROM a""",
    "confirmed_tracks": f"""{_Q}, h AS (SELECT track_id, frame_idx, CAST(score >= 0.4 AS INT) AS h FROM obs), m AS (SELECT *, sum(1 - h) OVER (PARTITION BY track_id ORDER BY frame_idx) AS m FROM h), r AS (SELECT *, sum(h) OVER (PARTITION BY track_id, m ORDER BY frame_idx) AS r FROM m)
SELECT track_id, frame_idx, CAST(r AS BIGINT) AS run_length, max(r) OVER (PARTITION BY track_id ORDER BY frame_idx) >= 3 AS is_confirmed FROM r""",
    "hot_start": f"""{_Q}, walk AS (SELECT track_id, frame_idx, CASE WHEN score >= 0.5 THEN 1 ELSE -1 END AS a FROM obs WHERE frame_idx = 0
UNION ALL SELECT o.track_id, o.frame_idx, least(8, greatest(-4, w.a + CASE WHEN o.score >= 0.5 THEN 1 ELSE -1 END)) FROM walk w JOIN obs o ON o.track_id = w.track_id AND o.frame_idx = w.frame_idx + 1)
SELECT track_id, frame_idx, CAST(a AS INT) AS keep_alive, a <= 0 AS suppressed FROM walk""",
    "image_position": f"{_Q}, p AS (SELECT event_id, CASE WHEN cx < 1.0e0 / 3 THEN 'left' WHEN cx > 2.0e0 / 3 THEN 'right' ELSE 'center' END AS h, CASE WHEN cy < 1.0e0 / 3 THEN 'top' WHEN cy > 2.0e0 / 3 THEN 'bottom' ELSE 'middle' END AS v FROM obs) SELECT event_id, CASE WHEN h = 'center' AND v = 'middle' THEN 'center' ELSE v || '-' || h END AS position FROM p",
}
