"""Ordered frames as a stream: sampling, track states and confirmation with state per track.

A track's frames must come in order of their number; a frame that is older than the last one seen is dropped, as is any after a track is archived."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from ..config import DEFAULTS
from ..operators.graph import shared_dir

STATES = "track_id long, frame_idx int, status string, missing_streak int, run_length int, is_confirmed boolean"


def track_states(frames: DataFrame, lost: int = DEFAULTS.lost_after, archived: int = DEFAULTS.archived_after, confirm: int = DEFAULTS.confirm_after) -> DataFrame:
    """A row for each observed frame: the status before it came in again, its misses, and the run of hits."""

    def update(key, batches, state):
        last, run, sure, dead = state.get if state.exists else (-1, 0, False, False)
        out = []
        for pdf in batches:
            for f in sorted(pdf["frame_idx"].tolist()):
                if dead or f <= last:
                    continue
                gap = f - last - 1 if last >= 0 else 0
                if gap >= archived:
                    dead = True
                    out.append((key[0], f, "archived", gap, 0, sure))
                    continue
                run = run + 1 if gap == 0 else 1
                sure = sure or run >= confirm
                out.append((key[0], f, "lost" if gap >= lost else "active", gap, run, sure))
                last = f
        state.update((last, run, sure, dead))
        yield pd.DataFrame(out, columns=["track_id", "frame_idx", "status", "missing_streak", "run_length", "is_confirmed"])

    return frames.select("track_id", F.col("frame_idx").cast("int").alias("frame_idx")).groupBy("track_id").applyInPandasWithState(update, STATES, "last int, run int, sure boolean, dead boolean", "append", GroupStateTimeout.NoTimeout)


def sampled(frames: DataFrame, fps: float = DEFAULTS.target_fps) -> DataFrame:
    """The first frame of each time slot of a track, by dropping repeats of (track, slot) within the watermark."""
    slot = F.floor((F.col("ts_s") + 1e-9) * fps)
    return frames.withColumn("slot", slot).dropDuplicates(["track_id", "slot"])


def event_rates(events: DataFrame, every: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", every), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def run_once(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """All that is there now, as a table in the shared folder: each batch is written under its number, so one that is run again replaces itself; in complete mode the last one replaces all."""
    root = f"{shared_dir(df.sparkSession)}/voxtrail/{name}-{uuid.uuid4().hex}"

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/{number if mode == 'append' else 'all'}")

    df.sparkSession.createDataFrame([], df.schema).write.parquet(f"{root}/out/none")
    q = df.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/progress").foreachBatch(put).trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()
    return df.sparkSession.read.schema(df.schema).option("recursiveFileLookup", "true").parquet(f"{root}/out")
