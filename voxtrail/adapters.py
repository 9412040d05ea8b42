"""The engine's semantic tables over the driver's tables, each with the SQL that makes the same rows.

A table of observations is made of events, of boxes and points of lineitem, of gt and pred boxes of two disturbed copies; all values come from keys by modular arithmetic, so both sides agree to the bit."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Expressions that mean the same in both dialects; {us} is the time in microseconds.
_OBS = """SELECT user_id AS track_id, event_id, event_type AS name,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS INT) AS frame_idx,
  (us - min(us) OVER (PARTITION BY user_id)) / 1000000.0e0 AS ts_s,
  CAST(value AS DOUBLE) AS x, (event_id * 37 % 101) / 10.0e0 AS y, 5.0e0 + (event_id * 53 % 97) / 10.0e0 AS z,
  (event_id % 7 + 1) / 10.0e0 AS ext_x, (event_id % 11 + 1) / 10.0e0 AS ext_y, (event_id % 5 + 1) / 10.0e0 AS ext_z,
  (event_id * 29 % 100) / 100.0e0 AS score, (event_id * 13 % 100) / 100.0e0 AS cx, (event_id * 7 % 100) / 100.0e0 AS cy,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE ((event_id * 17 % 314) - 157) / 100.0e0 END AS yaw
FROM (SELECT *, {us} AS us FROM {events}) e"""

_BOX = """SELECT l_orderkey AS grp, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS id,
  CAST(l_partkey % 40 AS DOUBLE) AS x0, CAST(l_suppkey % 40 AS DOUBLE) AS y0,
  CAST(l_partkey % 40 + 5 + (l_orderkey + l_linenumber * 3) % 20 AS DOUBLE) AS x1,
  CAST(l_suppkey % 40 + 5 + (l_orderkey * 3 + l_linenumber) % 20 AS DOUBLE) AS y1,
  ((l_orderkey * 31 + l_linenumber * 17) % 100) / 100.0e0 AS score, CAST(l_orderkey % 8 AS INT) AS video
FROM {lineitem}"""

#: Ground truth: every line; prediction: a shifted copy of most lines.
_GT = "SELECT grp, id, x0, y0, x1, y1, video, CAST(id % 3 AS INT) AS cat FROM ({box}) b"
_PRED = "SELECT grp, id + 100 AS id, x0 + (grp + id) % 5 AS x0, y0 + (grp * 3 + id) % 4 AS y0, x1 + (grp + id) % 5 AS x1, y1 + (grp * 3 + id) % 4 AS y1, score, video, CAST(id % 3 AS INT) AS cat FROM ({box}) b WHERE (grp + id) % 7 <> 0"

_POINTS = """SELECT l_suppkey AS obj, l_orderkey * 10 + l_linenumber AS pid,
  CAST(l_quantity AS DOUBLE) AS x, (l_partkey % 97) / 7.0e0 AS y, 2.0e0 + (l_orderkey % 53) / 5.0e0 AS z, (l_orderkey * 7 % 100) / 100.0e0 AS conf
FROM {lineitem}"""



def _made(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = {n: table(spark, sf_dir, n) for n in ("events", "lineitem") if "{%s}" % n in text}
    return spark.sql(text, **names)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window runs over the column under its later name, else Spark doesn't see that its rows are partitioned by track and shuffles them again."""
    text = _OBS.replace("user_id AS track_id", "track_id").replace("user_id", "track_id")
    return spark.sql(text.format(us="unix_micros(CAST(ts AS TIMESTAMP))", events="{events}"), events=table(spark, sf_dir, "events").withColumnRenamed("user_id", "track_id"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _BOX)


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _GT.replace("{box}", _BOX))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _PRED.replace("{box}", _BOX))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _made(spark, sf_dir, _POINTS)


OBS_SQL = _OBS.format(us="epoch_us(ts)", events="events")
BOX_SQL = _BOX.format(lineitem="lineitem")
GT_SQL = _GT.format(box=BOX_SQL)
PRED_SQL = _PRED.format(box=BOX_SQL)
POINTS_SQL = _POINTS.format(lineitem="lineitem")
CTES = f"obs AS ({OBS_SQL}), box AS ({BOX_SQL}), gt AS ({GT_SQL}), pred AS ({PRED_SQL}), pts AS ({POINTS_SQL})"
