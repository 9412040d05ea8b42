"""Sharding by size-tiered compaction: arrivals become small immutable shards, shards of similar size are merged into files of a target size, and each change is one new manifest version that appears whole or not at all.

A tier holds shards whose sizes are within a factor of FAN_IN. When a tier below the target has FAN_IN shards or more, one Spark job reads up to MOST_MERGED of them, the smallest first, and writes them as fewer files: the read's partitions are coalesced to the number of files that the target asks for, so rows stream from file to file with neither a shuffle nor a sort. In a full merge there's a version for each job.

A version's manifest names its schema and its segments, immutable lists of up to SEGMENT shards that versions share: a change writes the segments it touches and a short manifest, whatever the size of the store. It is written beside its name and moved there; a move onto an existing version fails, so of two writers one sees ManifestConflict, reads the manifest anew and tries again: an append as it is, a merge if its shards are all still there, else from the start. A commit first looks whether the files it adds exist.

Versions: the newest RETAIN stay readable. vacuum() removes what no retained version names, and only what is older than MIN_AGE, so that the finished files of a writer that hasn't committed yet stay. Files of lost jobs go by the same rule. The driver holds a line for each shard, not for each document.

Defined results: every row goes to exactly one shard, with all its columns as they are (null, empty and very long texts, repeated rows); ties in size are merged in order of path; an empty arrival adds no shard but keeps the schema; an arrival of another schema is an error; a column named like the shard's gets the shard's name with underscores behind it, and columns of any other name are safe.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, hadoop_path, unused

TARGET_BYTES = 64 << 20
BASE_BYTES = 1 << 20
FAN_IN = 4
#: Rows of an arriving shard at most.
ARRIVAL_ROWS = 4096
#: Shards that one job merges, and shards in one segment of a manifest.
MOST_MERGED = 4096
SEGMENT = 4096
#: Versions that stay readable, and seconds for which a file without a version stays.
RETAIN = 10
MIN_AGE = 24 * 3600
#: Shards whose names (about 100 bytes each) are broadcast.
MOST_BROADCAST = 100_000


class ManifestConflict(RuntimeError):
    """Another writer has committed this version."""


@dataclass(frozen=True)
class Shard:
    path: str  # below the store's root
    bytes: int
    rows: int

    def tier(self) -> int:
        return max(0, math.floor(math.log(max(1, self.bytes) / BASE_BYTES, FAN_IN)) + 1) if self.bytes >= BASE_BYTES else 0


@dataclass
class State:
    """What a version's manifest says; segments: shards by the name of the segment they are listed in."""

    version: int = 0
    schema: str | None = None
    segments: dict[str, list[Shard]] = field(default_factory=dict)
    runs: dict[str, int] = field(default_factory=dict)  # files of each run, dead ones too

    def shards(self) -> list[Shard]:
        return sorted((s for part in self.segments.values() for s in part), key=lambda s: s.path)


class ShardStore:
    """A folder of shards (data/run-.../part-...) and manifests (manifests/v....json, manifests/s-....json)."""

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, retain: int = RETAIN, min_age: float = MIN_AGE):
        self.spark, self.root, self.target, self.retain, self.min_age = spark, root.rstrip("/"), target_bytes, retain, min_age

    # manifests

    def _load(self, name: str):
        fs, p = hadoop_path(self.spark, f"{self.root}/manifests/{name}")
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _save(self, name: str, value) -> None:
        fs, p = hadoop_path(self.spark, f"{self.root}/manifests/{name}")
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(json.dumps(value).encode()))
        finally:
            stream.close()

    def versions(self) -> list[int]:
        fs, p = hadoop_path(self.spark, f"{self.root}/manifests")
        return sorted(int(x.getPath().getName()[1:-5]) for x in fs.listStatus(p) if x.getPath().getName().startswith("v")) if fs.exists(p) else []

    def state(self, version: int | None = None) -> State:
        """The newest version's state, or that of an older one; version 0 if there is none."""
        version = version or (self.versions() or [0])[-1]
        if not version:
            return State()
        found = self._load(f"v{version:08d}.json")
        return State(version, found["schema"], {name: [Shard(**x) for x in self._load(name)] for name in found["segments"]}, found["runs"])

    def manifest(self, version: int | None = None) -> tuple[int, str | None, list[Shard]]:
        """The version (0: none yet), the schema, and the shards in order of path."""
        state = self.state(version)
        return state.version, state.schema, state.shards()

    def commit(self, state: State, schema: str, new: list[Shard], gone: set[str] = frozenset()) -> State:
        """The version after state: with new shards, and without those of the paths in gone. ManifestConflict: there is one already."""
        jvm = self.spark._jvm
        runs = {s.path.rpartition("/")[0] for s in new}
        for run in runs:  # files may have been lost since they were written
            fs, p = hadoop_path(self.spark, f"{self.root}/{run}")
            there = {x.getPath().getName() for x in fs.listStatus(p)} if fs.exists(p) else set()
            if lost := {s.path for s in new if s.path.startswith(run + "/")} - {f"{run}/{x}" for x in there}:
                raise FileNotFoundError(f"{len(lost)} new shards are gone, such as {min(lost)}")
        segments, loose = {}, list(new)
        for name, part in state.segments.items():
            kept = [s for s in part if s.path not in gone]
            if len(kept) == len(part):
                segments[name] = part
            else:
                loose += kept
        for at in range(0, len(loose), SEGMENT):
            name = f"s-{uuid.uuid4().hex}.json"
            segments[name] = loose[at : at + SEGMENT]
            self._save(name, [asdict(s) for s in segments[name]])
        live = {s.path.rpartition("/")[0] for part in segments.values() for s in part}
        files = state.runs | {run: sum(s.path.startswith(run + "/") for s in new) for run in runs}
        after = State(state.version + 1, schema, segments, {run: n for run, n in files.items() if run in live})
        draft, name = f".{uuid.uuid4().hex}", f"v{after.version:08d}.json"
        self._save(draft, {"version": after.version, "schema": schema, "segments": list(segments), "runs": after.runs})
        fs, p = hadoop_path(self.spark, f"{self.root}/manifests/{draft}")
        target = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifests/{name}")
        contexts = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            contexts.rename(p, target, self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        except Exception as e:
            fs.delete(p, False)
            if fs.exists(target):
                raise ManifestConflict(name) from e
            raise
        return after

    # changes

    def _write(self, df: DataFrame, run: str, **options) -> list[Shard]:
        path = f"{self.root}/data/{run}"
        df.write.options(**options).parquet(path)
        fs, p = hadoop_path(self.spark, path)
        size = {x.getPath().getName(): x.getLen() for x in fs.listStatus(p) if x.getPath().getName().startswith("part-")}
        back = self.spark.read.schema(df.schema).parquet(path)
        counts = back.groupBy(back.metadataColumn("_metadata").getField("file_name").alias("file")).count().collect()  # a row for each file
        return [Shard(f"data/{run}/{r['file']}", size[r["file"]], r["count"]) for r in counts]

    def append(self, df: DataFrame, arrival_rows: int = ARRIVAL_ROWS) -> int:
        """Adds the rows of df as small shards; each task writes its own. The files are written once, however often the commit has to be tried."""
        new, schema = self._write(df, f"run-{uuid.uuid4().hex}", maxRecordsPerFile=arrival_rows), df.schema.json()
        kind = lambda text: T.StructType.fromJson(json.loads(text)).simpleString()
        while True:
            state = self.state()
            if state.schema and kind(state.schema) != kind(schema):
                raise ValueError("the rows' schema isn't that of the store")
            try:
                return self.commit(state, schema, new).version
            except ManifestConflict:
                continue

    def _due(self, shards: list[Shard]) -> list[Shard]:
        """The smallest shards of the lowest tier that is due, or none. Shards of half the target or more are final."""
        tiers: dict[int, list[Shard]] = {}
        for s in shards:
            if s.bytes < self.target / 2:
                tiers.setdefault(s.tier(), []).append(s)
        due = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= FAN_IN), [])
        return sorted(due, key=lambda s: (s.bytes, s.path))[:MOST_MERGED]

    def compact(self) -> int:
        """Merges tiers until none is due; each merge is a version of its own."""
        state = self.state()
        while due := self._due(state.shards()):
            n = math.ceil(sum(s.bytes for s in due) / self.target)
            new = self._write(self._read(state, due).coalesce(n), f"run-{uuid.uuid4().hex}")
            gone = {s.path for s in due}
            while gone <= {s.path for s in state.shards()}:
                try:
                    state = self.commit(state, state.schema, new, gone)
                    break
                except ManifestConflict:
                    state = self.state()
            self.vacuum()  # of a merge that came too late, the files go when they are old enough
        return state.version

    def vacuum(self) -> None:
        """Removes old versions beyond the newest retain ones, and what no retained version names and is older than min_age seconds."""
        versions = self.versions()
        before = time.time() - self.min_age
        states = [self.state(v) for v in versions[-self.retain :]]
        named = {s.path for x in states for s in x.shards()}
        kept = {f"v{x.version:08d}.json" for x in states} | {name for x in states for name in x.segments}
        fs, p = hadoop_path(self.spark, f"{self.root}/manifests")
        old = lambda x: x.getModificationTime() / 1000 <= before
        for file in fs.listStatus(p) if fs.exists(p) else []:
            name = file.getPath().getName()
            version = name.startswith("v") and int(name[1:-5]) <= versions[-1]
            if name not in kept and (version or old(file)):
                fs.delete(file.getPath(), False)
        fs, p = hadoop_path(self.spark, f"{self.root}/data")
        live = {x.rpartition("/")[0] for x in named}
        for run in fs.listStatus(p) if fs.exists(p) else []:
            name = f"data/{run.getPath().getName()}"
            files = list(fs.listStatus(run.getPath()))
            if name not in live:
                if old(run) and all(map(old, files)):
                    fs.delete(run.getPath(), True)
                continue
            for file in files:
                if f"{name}/{file.getPath().getName()}" not in named and old(file):
                    fs.delete(file.getPath(), False)

    # reading

    def _read(self, state: State, shards: list[Shard]) -> DataFrame:
        """The shards' rows: runs that are whole by their folder, others by file."""
        kind = T.StructType.fromJson(json.loads(state.schema))
        by_run: dict[str, list[str]] = {}
        for s in shards:
            by_run.setdefault(s.path.rpartition("/")[0], []).append(s.path)
        paths = [p for run, files in sorted(by_run.items()) for p in ([run] if len(files) == state.runs.get(run) else sorted(files))]
        return self.spark.read.schema(kind).parquet(*[f"{self.root}/{p}" for p in paths]) if paths else self.spark.createDataFrame([], kind)

    def read(self, version: int | None = None, shard: str = "shard") -> DataFrame:
        """The rows of a version, each with the number of its shard in the manifest's order."""
        state = self.state(version)
        if state.schema is None:
            raise FileNotFoundError(f"{self.root} has no manifest")
        shards = state.shards()
        df = self._read(state, shards)
        shard, name = unused(df.columns, shard, "name")
        if not shards:
            return df.withColumn(shard, F.lit(None).cast("int"))
        # one short row for each shard of the manifest that the driver has just read; past MOST_BROADCAST of them Spark joins as it sees fit
        numbers = self.spark.createDataFrame([(s.path.rpartition("/")[2], i) for i, s in enumerate(shards)], f"{name} string, {shard} int")
        numbers = F.broadcast(numbers) if len(shards) <= MOST_BROADCAST else numbers
        return df.withColumn(name, df.metadataColumn("_metadata").getField("file_name")).join(numbers, name).drop(name)


def shard_documents(docs: DataFrame, target_bytes: int = TARGET_BYTES, arrival_rows: int = ARRIVAL_ROWS) -> tuple[ShardStore, DataFrame]:
    """A new store in the shared folder with docs in it, compacted, and its rows. No one else writes there, so only its newest version is kept."""
    store = ShardStore(docs.sparkSession, Scratch(docs.sparkSession, "shards").path("store"), target_bytes, retain=1, min_age=0)
    store.append(docs, arrival_rows)
    store.compact()
    return store, store.read()
