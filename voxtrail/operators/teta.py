"""Tracking accuracy in three parts: localisation, association and classification, class by class.

A prediction counts for a class by its overlap with the class' ground truth, whatever class it carries itself; its own class is judged by the third part alone."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import checkpointed
from .metrics import EPS, aligned_matches, association_sums, pair_sums, track_pairs, track_sizes
from .packed import Alignment, Beyond, Groups, Tracks, packed, passed

# Thresholds of the metric, the least one of classification and the overlap that makes a candidate.
ALPHAS = tuple(round(0.05 * i, 2) for i in range(20))
CLASS_FROM = 0.5
OVERLAP = 0.5
COUNTS = ("loc_tp", "loc_fn", "loc_fp", "cls_tp", "cls_fn", "cls_fp")
SHARES = ("assoc_a", "assoc_re", "assoc_pr")


def candidates(pairs: DataFrame, gt: DataFrame, n_gt: DataFrame, n_pred: DataFrame, keys=("video",), frame: str = "grp") -> DataFrame:
    """(keys, frame, gt_cat, pred_id): predictions that overlap ground truth of a class in the frame, but for those that the assignment over all classes gives to another class there."""
    at = [*keys, frame]
    close = pairs.where(F.col("s") >= OVERLAP)
    near = close.select(*keys, "pred_id").distinct()
    all_classes = aligned_matches(pairs.drop("gt_cat").join(near, [*keys, "pred_id"], "left_semi"), n_gt, n_pred, keys, frame).where(F.col("s") >= OVERLAP - EPS)
    owner = all_classes.join(gt.select(*at, F.col("id").alias("gt_id"), F.col("gt_cat").alias("owner")), [*at, "gt_id"]).select(*at, "pred_id", "owner")
    found = close.select(*at, "gt_cat", "pred_id").distinct().join(owner, [*at, "pred_id"], "left")
    return found.where("owner is null or owner = gt_cat").select(*at, "gt_cat", "pred_id")


def by_joins(gt: DataFrame, pred: DataFrame, keys, frame: str, cat: str, exhaustive: bool) -> tuple:
    """(shares, truths, candidates, judged, lone): association sums, and the numbers of boxes of ground truth, of candidates, of matches by both classes and of predictions that don't overlap the class they carry. Pairs of boxes are rows; any number of tracks."""
    at, by = [*keys, frame], [*keys, "gt_cat"]
    gt = gt.select(*at, "id", "x0", "y0", "x1", "y1", F.col(cat).alias("gt_cat"))
    pairs = track_pairs(gt.where("id is not null"), pred.where("id is not null"), keys, frame, kept=("gt_cat",))
    n_pred = track_sizes(pred, keys, "pred")
    # several sums read the candidates and the matches, so both are cut from their plans once
    over = checkpointed(candidates(pairs, gt, track_sizes(gt, keys, "gt"), n_pred, keys, frame))
    tracks = over.select(*by, "pred_id").distinct()
    sizes = track_sizes(gt, by, "gt"), tracks.join(n_pred, [*keys, "pred_id"])
    found = checkpointed(aligned_matches(pairs.join(tracks, [*by, "pred_id"], "left_semi"), *sizes, by, frame))
    shares = association_sums(found, *sizes, ALPHAS, by)
    judged = found.join(pred.select(*at, F.col("id").alias("pred_id"), F.col(cat).alias("pred_cat")), [*at, "pred_id"]).join(over.withColumn("over", F.lit(1)), [*by, frame, "pred_id"], "left")
    reached = F.filter(F.array(*map(F.lit, ALPHAS)), lambda a: F.col("s") >= a - EPS)
    judged = judged.withColumn("alpha", F.explode(reached)).groupBy(*by, "pred_cat", "alpha").agg(F.count("*").alias("n"), F.count("over").alias("over"))
    own = pred.select(*at, F.col("id").alias("pred_id"), F.col(cat).alias("gt_cat"))
    counted = lambda df: df.groupBy(*by).agg(F.count("*").alias("n"))
    return shares, counted(gt), counted(over), judged, counted(own.join(over, [*at, "gt_cat", "pred_id"], "left_anti")) if exhaustive else None


def by_frames(gt: DataFrame, pred: DataFrame, keys, frame: str, cat: str, exhaustive: bool) -> tuple:
    """The same as by_joins() in five passes over packed frames: sizes and close tracks, alignment, candidates, alignment by class, matches. Raises Beyond where the tracks are too many to be held by tasks, or an id comes twice in a frame."""
    by = [*keys, "gt_cat"]
    rows = checkpointed(packed(gt, pred, keys, frame, cat))
    frames, lone = rows.where("lone = 0").drop("lone"), rows.where("lone > 0")
    kind = rows.schema["gt"].dataType.elementType["cat"].dataType.simpleString()
    of = lambda side, places: {"seq": places.seq[side.frame]}

    def sizes(fr):
        g, near = Groups(fr, False), np.zeros(len(fr.pred.id))
        near[g.pred] = g.overlaps(OVERLAP)
        twice = fr.gt.twice() or fr.pred.twice()
        for i, (side, cats) in enumerate(((fr.gt, fr.gt.cat), (fr.pred, np.full(len(fr.pred.id), -1)))):
            close = (lambda first, place: np.bincount(place, near) > 0) if i else (lambda first, place: np.zeros(len(first), bool))
            out = fr.counted({**of(side, fr), "gt_cat": cats, "id": side.id}, near=close)
            n = len(out["n"])
            yield out | {"side": pa.array(np.full(n, i, np.int32)), "twice": pa.array(np.full(n, twice))}

    unpaired = lambda i, name: lone.select(*keys, F.explode(name).alias("b")).select(*keys, (F.col("b.cat") if i == 0 else F.lit(None).cast(kind)).alias("gt_cat"), F.col("b.id").alias("id"), F.lit(1).cast("long").alias("n"), F.lit(False).alias("near"), F.lit(i).alias("side"), F.lit(False).alias("twice"))
    each = passed(frames, keys, sizes, f"gt_cat {kind}, id long, n long, near boolean, side int, twice boolean").unionByName(unpaired(0, "gt")).unionByName(unpaired(1, "pred"))
    sized = checkpointed(each.groupBy(*by, "id", "side").agg(F.sum("n").alias("n"), F.max("near").alias("near"), F.max("twice").alias("twice")))
    if not sized.where("twice").isEmpty():
        raise Beyond
    size = lambda i, name, ends: sized.where(F.col("side") == i).groupBy(*ends, F.col("id").alias(f"{name}_id")).agg(F.sum("n").cast("double").alias(f"n_{name}"))
    n_pred = size(1, "pred", keys)
    near = Tracks(sized.where("near").select(*keys, F.col("id").alias("pred_id")), keys, False)

    def alignment(kept, by_class, n_gt, n_pred):
        ends = by if by_class else keys

        def run(fr):
            g = Groups(fr, by_class, kept)
            for gpos, ppos, share in g.shares():
                a, b = g.gt[gpos], g.pred[ppos]
                yield fr.counted({"seq": fr.seq[fr.gt.frame[a]], **({"gt_cat": fr.gt.cat[a]} if by_class else {}), "gt_id": fr.gt.id[a], "pred_id": fr.pred.id[b]}, share)

        sums = passed(frames, keys, run, (f"gt_cat {kind}, " if by_class else "") + "gt_id long, pred_id long, n double").groupBy(*ends, "gt_id", "pred_id").agg(F.sum("n").alias("p"))
        both = sums.join(n_gt, [*ends, "gt_id"]).join(n_pred, [*ends, "pred_id"])
        return Alignment(both.select(*ends, "gt_id", "pred_id", (F.col("p") / (F.col("n_gt") + F.col("n_pred") - F.col("p"))).alias("a")), keys, by_class)

    whole = alignment(near, False, size(0, "gt", keys), n_pred)

    def over(fr):
        """(frame, class, place of prediction) of the candidates."""
        g, owner = Groups(fr, False, near), np.full(len(fr.pred.id), -1)
        gpos, ppos, s = g.assigned(whole)
        hit = s >= OVERLAP - EPS
        owner[g.pred[ppos[hit]]] = fr.gt.cat[g.gt[gpos[hit]]]
        g = Groups(fr, True, near, lambda fr, frames, cats, preds: (owner[preds] < 0) | (owner[preds] == cats))
        is_over = g.overlaps(OVERLAP)
        return g.frame[g.of[is_over]], g.cat[g.of[is_over]], g.pred[is_over]

    def counts(fr):
        f, c, p = over(fr)
        out = fr.counted({"seq": fr.seq[f], "gt_cat": c, "pred_id": fr.pred.id[p]})
        yield out | {"lone": pa.array(np.zeros(len(out["n"]), bool))}
        if exhaustive:
            rest = np.ones(len(fr.pred.id), bool)
            rest[p[fr.pred.cat[p] == c]] = False
            out = fr.counted({"seq": fr.seq[fr.pred.frame[rest]], "gt_cat": fr.pred.cat[rest], "pred_id": np.zeros(rest.sum(), np.int64)})
            yield out | {"lone": pa.array(np.ones(len(out["n"]), bool))}

    told = checkpointed(passed(frames, keys, counts, f"gt_cat {kind}, pred_id long, n long, lone boolean").groupBy(*by, "pred_id", "lone").agg(F.sum("n").alias("n")))
    found = told.where("not lone").drop("lone")
    tracks = Tracks(found.select(*by, "pred_id"), keys, True)
    n_both = size(0, "gt", by), found.select(*by, "pred_id").join(n_pred, [*keys, "pred_id"])
    classed = alignment(tracks, True, *n_both)
    reached = np.array([a - EPS for a in ALPHAS])

    def matches(fr):
        _, c, p = over(fr)
        g, n = Groups(fr, True, tracks), len(fr.cats) + 1
        gpos, ppos, s = g.assigned(classed)
        a, b = g.gt[gpos], g.pred[ppos]
        cats = fr.gt.cat[a]
        yield fr.counted({"seq": fr.seq[fr.gt.frame[a]], "gt_cat": cats, "gt_id": fr.gt.id[a], "pred_id": fr.pred.id[b], "pred_cat": fr.pred.cat[b], "level": np.searchsorted(reached, s, "right"), "over": np.isin(b * n + cats, p * n + c).astype(np.int64)})

    hits = passed(frames, keys, matches, f"gt_cat {kind}, gt_id long, pred_id long, pred_cat {kind}, level long, over long, n long")
    hits = checkpointed(hits.groupBy(*by, "gt_id", "pred_id", "pred_cat", "level", "over").agg(F.sum("n").alias("n")))
    hits = hits.withColumn("alpha", F.explode(F.slice(F.array(*map(F.lit, ALPHAS)), F.lit(1), F.col("level").cast("int"))))
    pairs = hits.groupBy(*by, "alpha", "gt_id", "pred_id").agg(F.sum("n").cast("double").alias("m"), F.lit(0.0).alias("loc"))
    judged = hits.groupBy(*by, "pred_cat", "alpha").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("over")).alias("over"))
    counted = lambda df: df.groupBy(*by).agg(F.sum("n").alias("n"))
    own = lone.select(*keys, F.explode("pred").alias("b")).select(*keys, F.col("b.cat").alias("gt_cat"), F.lit(1).cast("long").alias("n"))
    rest = counted(told.where("lone").select(*by, "n").unionByName(own)) if exhaustive else None
    return pair_sums(pairs, *n_both, by), counted(sized.where("side = 0")), counted(found), judged, rest


def teta_partial(gt: DataFrame, pred: DataFrame, keys=("video",), frame: str = "grp", cat: str = "cat", exhaustive: bool = False) -> DataFrame:
    """(keys, cat, alpha, counts, association sums) of the classes that have ground truth. With exhaustive, every prediction that carries a class without overlapping it is a false class too.

    Rows whose key, frame, id or class is null match nothing. An empty side has no true positives. Frames are packed and taken many at a time; where tracks are too many for that, or an id comes twice in a frame, pairs of boxes become rows."""
    try:
        shares, truths, over, judged, lone = by_frames(gt, pred, keys, frame, cat, exhaustive)
    except Beyond:
        shares, truths, over, judged, lone = by_joins(gt, pred, keys, frame, cat, exhaustive)

    def part(df, c="gt_cat", **made):
        zero = F.lit(0.0)
        return df.select(*keys, F.col(c).alias(cat), "alpha", *[made.get(n, zero).cast("double").alias(n) for n in (*COUNTS, *SHARES)])

    every = lambda df: df.withColumn("alpha", F.explode(F.array(*map(F.lit, ALPHAS))))
    right, said = F.col("gt_cat") == F.col("pred_cat"), F.col("alpha") >= CLASS_FROM
    parts = [
        part(shares, loc_tp=F.col("tp"), loc_fn=-F.col("tp"), assoc_a=F.col("ass_a"), assoc_re=F.col("ass_re"), assoc_pr=F.col("ass_pr")),
        part(every(truths), loc_fn=F.col("n")),
        part(every(over), loc_fp=F.col("n")),
        part(judged, loc_fp=-F.col("over"), cls_tp=F.when(right & said, F.col("n")).otherwise(0), cls_fn=F.when(~right & said, F.col("n")).otherwise(0)),
        part(judged.where(~right & said), "pred_cat", cls_fp=F.col("n")),
    ]
    if exhaustive:
        parts.append(part(every(lone).where(said), cls_fp=F.col("n")))
    out = reduce(DataFrame.unionByName, parts).groupBy(*keys, cat, "alpha").agg(*[F.sum(c).alias(c) for c in (*COUNTS, *SHARES)])
    return out.join(truths.select(F.col("gt_cat").alias(cat)).distinct(), cat, "left_semi")


def teta_combine(partial: DataFrame, keys=("cat",)) -> DataFrame:
    """Sums over sequences, association weighted by true positives; scores of classification are means over their thresholds. Without keys all detections count alike."""
    out = partial.groupBy(*keys, "alpha").agg(*[F.sum(c).alias(c) for c in COUNTS], *[(F.sum(c) / F.greatest(F.lit(1.0), F.sum("loc_tp"))).alias(c) for c in SHARES])
    share = lambda k, *more: F.col(f"{k}_tp") / F.greatest(F.lit(1.0), sum((F.col(f"{k}_{m}") for m in more), F.col(f"{k}_tp")))
    mean = lambda c: F.avg(F.when(F.col("alpha") >= CLASS_FROM, c)).over(W.partitionBy(*keys))
    scores = {f"loc_{n}": share("loc", *m) for n, m in (("re", ["fn"]), ("pr", ["fp"]), ("a", ["fn", "fp"]))} | {f"cls_{n}": mean(share("cls", *m)) for n, m in (("re", ["fn"]), ("pr", ["fp"]), ("a", ["fn", "fp"]))}
    return out.withColumns(scores).withColumn("teta", (F.col("loc_a") + F.col("assoc_a") + F.col("cls_a")) / 3)


def teta_by_class(per_class: DataFrame, ignore_empty: bool = False) -> DataFrame:
    """Means of the scores over classes; ignore_empty leaves out classes without a detection at any threshold."""
    if ignore_empty:
        per_class = per_class.join(per_class.where("loc_tp + loc_fn + loc_fp > 0").select("cat").distinct(), "cat", "left_semi")
    return per_class.groupBy("alpha").agg(*[F.avg(c).alias(c) for c in ("teta", "loc_a", "assoc_a", "cls_a")])
