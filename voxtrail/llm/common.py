"""Helpers shared by the operators: the shared scratch folder, words, unused names, joins with hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words, as a Java and RE2 character class.
SPACE = "[ \\t-\\r]"
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


#: Bytes of text that a Python worker takes up at once.
SLICE_BYTES = 1 << 20


def slices(batches: Iterable[pa.RecordBatch], column: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in order, in slices of up to size bytes of the text in column, or of one row. A worker then holds Python copies and results of a slice, not of a batch, and Spark reads results of that length."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0).to_numpy(zero_copy_only=False)
        ends, lo = np.cumsum(lengths, dtype=np.int64), 0
        while lo < batch.num_rows:
            most = (ends[lo - 1] if lo else 0) + size
            hi = max(lo + 1, int(np.searchsorted(ends, most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where it is unset, a folder of the warehouse, or, if driver and executors are one process, a temporary one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.sparkContext.master.startswith("local"):
            path = "file://" + tempfile.mkdtemp(prefix="voxtrail-")
        else:
            path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_voxtrail"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


class Scratch:
    """Tables written in the shared folder, which cut lineage and survive lost executors.

    They are removed when drop() is called or the driver's Python ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/voxtrail/{name}-{uuid.uuid4().hex}"
        atexit.register(self._close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        remove(self.spark, self.path(name))

    def _close(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                remove(self.spark, self.root)
        except Exception:  # the JVM has gone; nothing is left to ask
            pass


def n_words(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for null."""
    ends = lambda at: F.coalesce(F.substring(text, at, 1).isin(*SPACES), F.lit(False)).cast("int")
    n = F.size(F.split(text, SPACE + "+", -1)) - ends(1) - ends(-1)
    return F.when(text.isNull() | (text == ""), 0).otherwise(n).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind it as make it differ from all columns, regardless of case."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


#: Rows of one key beyond which the key counts as hot, at least; and hot keys there can be at most.
HOT_ROWS = 50_000
MOST_HOT = 10_000


def hot_join(rows: DataFrame, names: DataFrame, keys: list[str], total: int, sizes: DataFrame | None = None) -> DataFrame:
    """rows joined with names (one row for each of the keys), where single keys may hold a large part of all rows. sizes: keys and n, the number of their rows, if names is dear to compute.

    A key is hot if it has more than HOT_ROWS rows and more than one in MOST_HOT of all: there can't be more than MOST_HOT such keys, so their names are broadcast, and rows of hot keys aren't shuffled. What is left has at most that many rows in a key."""
    limit = max(HOT_ROWS, total // MOST_HOT)
    sizes = names if sizes is None else sizes
    hot = sizes.where(F.col("n") > limit).select(*keys)
    if hot.isEmpty():
        return rows.join(names, keys)
    hot = F.broadcast(hot)
    few = F.broadcast(names.join(hot, keys, "left_semi"))
    return rows.join(few, keys).unionByName(rows.join(hot, keys, "left_anti").join(names, keys))
