"""Connected components of edges, with lineage cut in the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, which cuts its lineage and survives lost executors; removed when the driver's Python ends. A checkpoint would compute the last stage twice."""
    path = f"{shared_dir(df.sparkSession)}/voxtrail/engine-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM has gone; nothing is left to ask
        pass


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset a folder of the warehouse, or, if driver and executors are one process, a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return "file://" + tempfile.mkdtemp(prefix="voxtrail-")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_voxtrail"


def components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(id, label): the least id reachable over edges (a, b); ids of nodes without edges keep their own."""
    both = checkpointed(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("label"))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        new = checkpointed(labels.join(near, labels["id"] == near["a"]).select("id", F.least("label", "near").alias("label"), F.col("label").alias("old")))
        jump = new.select(F.col("id").alias("at"), F.col("label").alias("next"))
        labels = checkpointed(new.join(jump, new["label"] == jump["at"], "left").select("id", F.least("label", F.coalesce("next", "label")).alias("label"), "old"))
        if labels.where("label <> old").isEmpty():
            break
        labels = labels.drop("old")
    labels = labels.select("id", "label")
    if nodes is None:
        return labels
    return nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))
