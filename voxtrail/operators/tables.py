"""Preparation of annotation tables: references, ids, queries, stages, slots and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .order import numbered


def filled_from_parent(child: DataFrame, parent: DataFrame, foreign: str, key: str, columns) -> DataFrame:
    """child with its nulls in columns filled from the parent's row; a missing parent fills nothing."""
    p = parent.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    have = [c for c in columns if c in child.columns]
    joined = child.join(p, child[foreign] == p["__key"], "left").withColumns({c: F.coalesce(c, f"__{c}") if c in have else F.col(f"__{c}") for c in columns})
    return joined.drop("__key", *[f"__{c}" for c in columns])


def timesteps(images: DataFrame, video: str = "video", frame: str = "frame_idx") -> DataFrame:
    """images with timestep, the place of the frame in its video from 0."""
    return images.withColumn("timestep", F.row_number().over(W.partitionBy(video).orderBy(frame)) - 1)


def tracks_of_videos(annotations: DataFrame, video: str = "video", track: str = "id", frame: str = "grp") -> DataFrame:
    """(video, track, n, first, last, frames): a row for each track with its timeline."""
    return annotations.groupBy(video, track).agg(F.count("*").alias("n"), F.min(frame).alias("first"), F.max(frame).alias("last"), F.array_sort(F.collect_set(frame)).alias("frames"))


def pair_ids(gt: DataFrame, pred: DataFrame, keys=("video", "cat"), negatives: DataFrame | None = None) -> DataFrame:
    """(keys, new_id): ids from 1 for the pairs that occur on either side, in order; pairs of negatives (keys, pos) that are new get the following ids in order of pos."""
    keys = list(keys)
    known = numbered(gt.select(*keys).union(pred.select(*keys)).distinct(), keys, "new_id")
    if negatives is None:
        return known
    fresh = negatives.groupBy(*keys).agg(F.min("pos").alias("pos")).join(known, keys, "left_anti")
    most = known.agg(F.coalesce(F.max("new_id"), F.lit(0)).alias("__most"))  # one row
    more = numbered(fresh, ["pos", *keys], "__n").crossJoin(F.broadcast(most)).select(*keys, (F.col("__most") + F.col("__n")).alias("new_id"))
    return known.unionByName(more)


def class_agnostic(annotations: DataFrame, video: str = "video", track: str = "id", category: str = "cat") -> DataFrame:
    """annotations of one category, with track ids from 1 that no two videos share, in order of video and track."""
    ids = numbered(annotations.select(video, track).distinct(), [video, track], "__new")
    return annotations.join(ids, [video, track]).withColumn(track, F.col("__new")).withColumn(category, F.lit(1)).drop("__new")


def merged_categories(annotations: DataFrame, merged: DataFrame, category: str = "cat") -> DataFrame:
    """annotations with categories replaced by what merged (old, new) says; others stay."""
    m = merged.select(F.col("old").alias("__old"), F.col("new").alias("__new"))
    return annotations.join(m, annotations[category] == m["__old"], "left").withColumn(category, F.coalesce("__new", category)).drop("__old", "__new")


def of_split(annotations: DataFrame, split: DataFrame, category: str = "cat") -> DataFrame:
    """annotations of the categories that a split (cat) lists: the known, or the unknown ones."""
    return annotations.join(split.select(category).distinct(), category, "left_semi")


def removable_predictions(pred: DataFrame, matched: DataFrame, gt: DataFrame, negative: DataFrame, not_exhaustive: DataFrame, frame=("grp",), category: str = "cat") -> DataFrame:
    """Predictions of an open-world evaluation that count: matched ones, and of the others those whose class has ground truth in the frame or is known to be absent there (negative: frame, cat), unless the class isn't labelled exhaustively there (not_exhaustive: frame, cat). matched: frame, id."""
    at = [*frame, category]
    unmatched = pred.join(matched.select(*frame, "id"), [*frame, "id"], "left_anti")
    known = gt.select(*at).union(negative.select(*at)).distinct()
    kept = unmatched.join(known, at, "left_semi").join(not_exhaustive.select(*at).distinct(), at, "left_anti")
    return pred.join(matched.select(*frame, "id"), [*frame, "id"], "left_semi").unionByName(kept)


def index_pairs(df: DataFrame, keys=("scene",), index: str = "i") -> DataFrame:
    """(keys, i, j), i < j, of the rows of each key: for the poses of a scene."""
    b = df.select(*keys, F.col(index).alias("j"))
    return df.select(*keys, F.col(index).alias("i")).join(b, list(keys)).where("i < j")


def reference_first(df: DataFrame, reference: Column, keys=("scene",), index: str = "i") -> DataFrame:
    """df with place: the reference row of each key comes first, the others keep their order. place and index undo each other: ordering by index restores."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(F.when(reference, 0).otherwise(1), index)) - 1)


def first_of(df: DataFrame, keys, order) -> DataFrame:
    """Of the rows of each key the first in order: parts gathered from several workers, or loops between one pair of chunks."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def distinct_chunk_pairs(pairs: DataFrame, order: str = "pos") -> DataFrame:
    """Loops between two chunks: none within a chunk, the first of each pair of chunks."""
    return first_of(pairs.where("chunk1 <> chunk2"), ("chunk1", "chunk2"), (order,))


def restricted_stages(queries: DataFrame, kept: DataFrame, keys=("video",), stage: str = "stage", reverse: bool = False) -> DataFrame:
    """Queries of the kept stages (keys, stage), renumbered from 0 in order, or in reverse."""
    order = F.col(stage).desc() if reverse else F.col(stage).asc()
    rows = queries.join(kept.select(*keys, stage).distinct(), [*keys, stage], "left_semi")
    return rows.withColumn(stage, F.dense_rank().over(W.partitionBy(*keys).orderBy(order)) - 1)


def tiled_stages(queries: DataFrame, stages: int, stage: str = "stage") -> DataFrame:
    """The queries of a single image as those of stages frames that all show it."""
    return queries.withColumn(stage, F.explode(F.sequence(F.lit(0), F.lit(stages - 1))))


def slots(df: DataFrame, capacity: int, keys=("grp",), order=("id",)) -> DataFrame:
    """df with bucket and slot: rows in order fill buckets of a fixed capacity."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("bucket", F.floor(place / capacity)).withColumn("slot", F.pmod(place, F.lit(capacity)))


def least_loaded(jobs: DataFrame, loads: DataFrame, keys=("grp",), order=("id",)) -> DataFrame:
    """jobs with worker: each in order goes to the worker of the least load so far, of equal ones the first; a job adds 1 to its worker's load. loads: worker, load, a row for each worker.

    The loads that workers pass through, sorted, are the order in which they are chosen, so no fold is needed."""
    numbered_jobs = jobs.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    n = jobs.groupBy(*keys).agg(F.count("*").cast("int").alias("__n"))
    turns = n.crossJoin(F.broadcast(loads)).withColumn("__t", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    turn = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("load") + F.col("__t"), "worker"))
    chosen = turns.withColumn("__k", turn).select(*keys, "__k", "worker")
    return numbered_jobs.join(chosen, [*keys, "__k"]).drop("__k")


def without_suffixes(images: DataFrame, listed: DataFrame, scene: str = "scene", name: str = "name") -> DataFrame:
    """Images of which no listed ending (scene, suffix) of their scene is the end of the name.

    An equi-join on the ends of the names, of the lengths that listed endings have: one row tells the lengths."""
    ends = listed.select(scene, "suffix").where(F.col("suffix").isNotNull()).distinct()
    lengths = ends.agg(F.collect_set(F.char_length("suffix")).alias("__lengths"))  # one row
    tails = images.select(scene, name).where(F.col(name).isNotNull()).crossJoin(F.broadcast(lengths)).withColumn("__n", F.explode("__lengths")).where(F.col("__n") <= F.char_length(name))
    tails = tails.select(scene, name, F.when(F.col("__n") > 0, F.right(F.col(name), F.col("__n"))).otherwise("").alias("suffix"))
    hit = tails.join(ends, [scene, "suffix"], "left_semi").select(scene, name).distinct()
    return images.join(hit, [scene, name], "left_anti").select(*images.columns)


def counts_above(df: DataFrame, threshold: float, keys=("grp",), score: str = "score") -> DataFrame:
    """(keys, n): rows of a score above threshold; 0 for keys without any."""
    return df.groupBy(*keys).agg(F.count(F.when(F.col(score) > threshold, 1)).alias("n"))


def mean_or_zero(df: DataFrame, value: str, keys=("cat",)) -> DataFrame:
    """(keys, mean); 0 where all values are null."""
    return df.groupBy(*keys).agg(F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"))


def tagged_means(scores: DataFrame, tags: DataFrame, columns, sequence: str = "video", tag: str = "tag") -> DataFrame:
    """(tag, n, means of columns) over the sequences that carry each tag."""
    return scores.join(tags.select(sequence, tag).distinct(), sequence).groupBy(tag).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns])


def compared(metrics: DataFrame, runs, run: str = "run", name: str = "name", value: str = "value") -> DataFrame:
    """A row for each metric, a column for each run, and the last run's difference to the first."""
    wide = metrics.groupBy(name).pivot(run, list(runs)).agg(F.first(value))
    return wide.withColumn("change", F.col(runs[-1]) - F.col(runs[0]))


def with_text(queries: DataFrame, prefix: str = "", suffix: str = "", text: str = "text") -> DataFrame:
    """Queries with a prefix and suffix about their text; the text geometric, and null, stay."""
    from ..functions.text import prefixed

    return queries.withColumn(text, prefixed(F.col(text), prefix, suffix))


def lowered(queries: DataFrame, listed, text: str = "text") -> DataFrame:
    """Texts that are listed, apart from case and outer space, in their listed form."""
    tidy = F.lower(F.trim(text))
    return queries.withColumn(text, F.when(tidy.isin(*[x.lower() for x in listed]), tidy).otherwise(F.col(text)))


def text_to_visual(queries: DataFrame, refs: DataFrame, share: float, seed: int = 0, text: str = "text") -> DataFrame:
    """Queries of which a share, chosen by a hash of seed and id, give up their text for the box of one of their objects (refs: query_id, object_id, box), the least hashed one. Queries without objects stay."""
    h = lambda *cs: F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cs]))
    one = refs.groupBy("query_id").agg(F.min_by("box", F.struct(h("query_id", "object_id").alias("h"), F.col("object_id"))).alias("__box"))
    chosen = (F.substring(h("query_id"), 1, 4) < f"{int(share * 65536):04x}") & F.col("__box").isNotNull()
    joined = queries.join(one, "query_id", "left").withColumn("input_box", F.when(chosen, F.col("__box")))
    return joined.withColumn(text, F.when(chosen, "visual").otherwise(F.col(text))).drop("__box")


def without_inputs(queries: DataFrame, columns=("input_box", "input_points")) -> DataFrame:
    """Queries whose geometric inputs are null."""
    return queries.withColumns({c: F.lit(None).cast(queries.schema[c].dataType) for c in columns if c in queries.columns})


def text_only(queries: DataFrame, box: str = "input_box") -> DataFrame:
    """Queries without a box as input."""
    return queries.where(F.col(box).isNull())


def trimmed_overlap(frames: DataFrame, head: int, tail: int, keys=("seq",), chunk: str = "chunk", local: str = "local") -> DataFrame:
    """Frames of overlapping chunks, each frame once: every chunk but the first gives up its first head frames, every one but the last its last tail frames."""
    k = W.partitionBy(*keys)
    rows = frames.withColumns({"__first": F.min(chunk).over(k), "__last": F.max(chunk).over(k), "__size": F.max(local).over(W.partitionBy(*keys, chunk)) + 1})
    start = F.when(F.col(chunk) == F.col("__first"), 0).otherwise(head)
    stop = F.when(F.col(chunk) == F.col("__last"), F.col("__size")).otherwise(F.col("__size") - tail)
    return rows.where((F.col(local) >= start) & (F.col(local) < stop)).drop("__last", "__size", "__first")
