"""Quality metrics of detection and tracking: partial rows per sequence and threshold, merged by sums and weighted means.

Matching takes one frame or image at a time; what a sequence adds, the alignment of its tracks and its counts, are sums and joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import boxes as B
from ..functions import masks
from ..functions.geometry import let
from .graph import checkpointed
from .matching import assign, box_array, iou_matrix, paired, per_group

# Thresholds of the metrics.
ALPHAS = tuple(round(0.05 * i, 2) for i in range(1, 20))
IOUS = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))
EPS = 2.220446049250313e-16


def track_pairs(gt: DataFrame, pred: DataFrame, keys=("video",), frame: str = "grp", kept=()) -> DataFrame:
    """(keys, frame, gt_id, pred_id, s, kept): the boxes of a frame with their IoU; kept names further columns of gt."""
    at = [*keys, frame]
    side = lambda df, k, more=(): df.select(*at, F.col("id").alias(f"{k}_id"), *[F.col(c).alias(f"{k}_{c}") for c in ("x0", "y0", "x1", "y1")], *more)
    both = side(gt, "gt", kept).join(side(pred, "pred"), at)
    return both.select(*at, "gt_id", "pred_id", *kept, B.iou(B.box(prefix="gt_"), B.box(prefix="pred_")).alias("s"))


def track_sizes(df: DataFrame, keys, name: str) -> DataFrame:
    return df.groupBy(*keys, F.col("id").alias(f"{name}_id")).agg(F.count("*").cast("double").alias(f"n_{name}"))


def aligned_matches(pairs: DataFrame, n_gt: DataFrame, n_pred: DataFrame, keys=("video",), frame: str = "grp") -> DataFrame:
    """(keys, frame, gt_id, pred_id, s): in each frame the assignment of the largest total of IoU times the alignment of the two tracks over their sequence.

    Sums by pair of tracks give the alignment, and Python sees one frame at a time, so neither a sequence nor a track has to fit in a task."""
    at, ends = [*keys, frame], [*keys, "gt_id", "pred_id"]
    whole = F.sum("s").over(W.partitionBy(*at, "gt_id")) + F.sum("s").over(W.partitionBy(*at, "pred_id")) - F.col("s")
    parts = pairs.withColumn("__w", whole).withColumn("__w", F.when(F.col("__w") > EPS, F.col("s") / F.col("__w")).otherwise(0.0))
    tracks = parts.groupBy(*ends).agg(F.sum("__w").alias("__p")).join(n_gt, [*keys, "gt_id"]).join(n_pred, [*keys, "pred_id"])
    tracks = tracks.select(*ends, (F.col("__p") / (F.col("n_gt") + F.col("n_pred") - F.col("__p"))).alias("__a"))
    frames = pairs.join(tracks, ends).groupBy(*at).agg(F.array_sort(F.collect_list(F.struct("gt_id", "pred_id", "s", "__a"))).alias("pairs"))

    def run(r):
        g, p = ({x: i for i, x in enumerate(sorted({x[k] for x in r["pairs"]}))} for k in ("gt_id", "pred_id"))
        s, cost = np.full((len(g), len(p)), -1.0), np.zeros((len(g), len(p)))
        for x in r["pairs"]:
            i, j = g[x["gt_id"]], p[x["pred_id"]]
            s[i, j], cost[i, j] = x["s"], -x["s"] * x["__a"]
        g, p = list(g), list(p)
        return [(g[i], p[j], float(s[i, j])) for i, j in zip(*assign(cost)) if s[i, j] >= 0]

    return per_group(frames, at, run, pa.schema([("gt_id", pa.int64()), ("pred_id", pa.int64()), ("s", pa.float64())]))


def association_sums(found: DataFrame, n_gt: DataFrame, n_pred: DataFrame, alphas, keys=("video",)) -> DataFrame:
    """(keys, alpha, tp, loc, ass_a, ass_re, ass_pr), all sums over the matches whose IoU reaches alpha; a match weighs by its pair's share of the two tracks."""
    reached = F.filter(F.array(*map(F.lit, alphas)), lambda a: F.col("s") >= a - EPS)
    return pair_sums(found.withColumn("alpha", F.explode(reached)).groupBy(*keys, "alpha", "gt_id", "pred_id").agg(F.count("*").cast("double").alias("m"), F.sum("s").alias("loc")), n_gt, n_pred, keys)


def pair_sums(pairs: DataFrame, n_gt: DataFrame, n_pred: DataFrame, keys=("video",)) -> DataFrame:
    """association_sums() of pairs (keys, alpha, gt_id, pred_id) with the number m of their matches and the sum loc of IoU."""
    m, g, p = F.col("m"), F.col("n_gt"), F.col("n_pred")
    sized = pairs.join(n_gt, [*keys, "gt_id"]).join(n_pred, [*keys, "pred_id"])
    return sized.groupBy(*keys, "alpha").agg(F.sum("m").alias("tp"), F.sum("loc").alias("loc"), F.sum(m * m / (g + p - m)).alias("ass_a"), F.sum(m * m / g).alias("ass_re"), F.sum(m * m / p).alias("ass_pr"))


def hota_partial(gt: DataFrame, pred: DataFrame, keys=("video",), frame: str = "grp") -> DataFrame:
    """(keys, alpha, tp, fn, fp, ass_a, ass_re, ass_pr, loc_a): association scores are weighted means over true positives, loc_a the mean similarity of matches (1 without any). A sequence that one side lacks has no true positives."""
    n_gt, n_pred = track_sizes(gt, keys, "gt"), track_sizes(pred, keys, "pred")
    found = aligned_matches(track_pairs(gt, pred, keys, frame).where("s > 0"), n_gt, n_pred, keys, frame)
    total = lambda n, c: n.groupBy(*keys).agg(F.sum(c).alias(c))
    base = total(n_gt, "n_gt").join(total(n_pred, "n_pred"), list(keys), "full").na.fill(0.0, ["n_gt", "n_pred"]).withColumn("alpha", F.explode(F.array(*map(F.lit, ALPHAS))))
    out = base.join(association_sums(found, n_gt, n_pred, ALPHAS, keys), [*keys, "alpha"], "left").na.fill(0.0, ["tp", "loc", "ass_a", "ass_re", "ass_pr"])
    tp, least = F.col("tp"), lambda c: F.greatest(F.lit(1e-10), c)
    share = lambda c: (F.col(c) / F.greatest(F.lit(1.0), tp)).alias(c)
    return out.select(*keys, "alpha", "tp", (F.col("n_gt") - tp).alias("fn"), (F.col("n_pred") - tp).alias("fp"), share("ass_a"), share("ass_re"), share("ass_pr"), (least(F.col("loc")) / least(tp)).alias("loc_a"))


def hota_combine(partial: DataFrame, keys=()) -> DataFrame:
    """Counts are added, association scores weighted by true positives, localisation likewise; then the derived scores."""
    weighted = lambda c: (F.sum(F.col(c) * F.col("tp")) / F.greatest(F.lit(1.0), F.sum("tp"))).alias(c)
    merged = partial.groupBy(*keys, "alpha").agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn"), F.sum("fp").alias("fp"), *[weighted(c) for c in ("ass_a", "ass_re", "ass_pr", "loc_a")])
    return hota_final(merged)


def hota_final(df: DataFrame) -> DataFrame:
    one = lambda c: F.greatest(F.lit(1.0), c)
    out = df.withColumns({"det_re": F.col("tp") / one(F.col("tp") + F.col("fn")), "det_pr": F.col("tp") / one(F.col("tp") + F.col("fp")), "det_a": F.col("tp") / one(F.col("tp") + F.col("fn") + F.col("fp"))})
    return out.withColumns({"hota": F.sqrt(F.col("det_a") * F.col("ass_a")), "owta": F.sqrt(F.col("det_re") * F.col("ass_a"))})


def hota_by_class(per_class: DataFrame, ignore_empty: bool = False) -> DataFrame:
    """Means over classes; ignore_empty leaves out classes without any box."""
    rows = per_class.where("tp + fn + fp > 0") if ignore_empty else per_class
    return rows.groupBy("alpha").agg(*[F.avg(c).alias(c) for c in ("hota", "det_a", "ass_a", "loc_a")])


def counts(df: DataFrame, keys=("video",), frame: str = "grp") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("dets"), F.countDistinct("id").alias("ids"), F.countDistinct(frame).alias("frames"))


def cgf1_images(gt: DataFrame, pred: DataFrame, keys=("grp",), least_score: float = 0.5) -> DataFrame:
    """(keys, iou, tp, fp, fn, local_f1, n_gt, n_pred): the assignment of the largest total IoU among predictions of least_score or more, counted at each threshold. local_f1 is null where both sides are empty."""

    def run(r):
        g, p = r["gt"] or [], [x for x in r["pred"] or [] if x["score"] >= least_score]
        s = iou_matrix(box_array(g), box_array(p))
        rows, cols = assign(-s)
        got = s[rows, cols] if len(rows) else np.empty(0)
        out = []
        for t in IOUS:
            tp = int((got >= t).sum())
            fp, fn = len(p) - tp, len(g) - tp
            pr, re = tp / (tp + fp + 1e-4), tp / (tp + fn + 1e-4)
            out.append((t, tp, fp, fn, 2 * pr * re / (pr + re + 1e-4) if g or p else None, len(g), len(p)))
        return out

    kinds = [("iou", pa.float64()), ("tp", pa.int64()), ("fp", pa.int64()), ("fn", pa.int64()), ("local_f1", pa.float64()), ("n_gt", pa.int64()), ("n_pred", pa.int64())]
    return per_group(paired(gt, pred, keys), list(keys), run, pa.schema(kinds))


def mask_scores(gt: DataFrame, pred: DataFrame, keys=("grp",), least_score: float = 0.5, radius: int = 1) -> DataFrame:
    """(keys, j, f, jf, n): of the masks (id, rle, and score of predictions) of each image the assignment of the largest total IoU among predictions of least_score or more: mean IoU of its pairs, mean F of their boundaries, and the mean of both. An image without pairs has nulls and n 0."""

    decode, boundary_f = masks.decode, masks.boundary_f  # the functions alone go to the executors

    def run(r):
        g, p = r["gt"] or [], [x for x in r["pred"] or [] if x["score"] >= least_score]
        a, b = ([decode(x["rle"]) for x in side] for side in (g, p))
        iou = np.array([[(m & n).sum() / max((m | n).sum(), 1) for n in b] for m in a]).reshape(len(a), len(b))
        rows, cols = assign(-iou)
        if not len(rows):
            return [(None, None, None, 0)]
        j = float(iou[rows, cols].mean())
        f = float(np.mean([boundary_f(a[x], b[y], radius) for x, y in zip(rows, cols)]))
        return [(j, f, (j + f) / 2, len(rows))]

    kinds = [("j", pa.float64()), ("f", pa.float64()), ("jf", pa.float64()), ("n", pa.int64())]
    return per_group(paired(gt, pred, keys, ("id", "rle")), list(keys), run, pa.schema(kinds))


def mask_summary(scores: DataFrame, keys=()) -> DataFrame:
    """Means of j, f and jf over the images that have pairs."""
    return scores.where("n > 0").groupBy(*keys).agg(F.avg("j").alias("j"), F.avg("f").alias("f"), F.avg("jf").alias("jf"), F.count("*").alias("images"))


def cgf1_accumulate(images: DataFrame, keys=()) -> DataFrame:
    """Micro precision, recall and F1 over all images, macro F1 over images with ground truth and predictions, the image-level correlation (MCC), and cgF1 = positive micro F1 * MCC."""
    e, i = 1e-4, 1e-6
    pos, said = F.col("n_gt") > 0, F.col("n_pred") > 0
    n = lambda c: F.sum(c.cast("double"))
    agg = images.groupBy(*keys, "iou").agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.sum(F.when(pos, F.col("fp")).otherwise(0)).alias("pos_fp"),
        n(pos & said).alias("il_tp"), n(~pos & said).alias("il_fp"), n(pos & ~said).alias("il_fn"), n(~pos & ~said).alias("il_tn"), F.avg(F.when(pos & said, F.col("local_f1"))).alias("macro_f1"),
    )
    f1 = lambda p, r: 2 * p * r / (p + r + e)
    out = agg.withColumns({"precision": F.col("tp") / (F.col("tp") + F.col("fp") + e), "recall": F.col("tp") / (F.col("tp") + F.col("fn") + e), "pos_precision": F.col("tp") / (F.col("tp") + F.col("pos_fp") + e)})
    a, b, c, d = (F.col(f"il_{x}") for x in ("tp", "tn", "fp", "fn"))
    mcc = (a * b - c * d) / F.sqrt((a + c + i) * (a + d + i) * (b + c + i) * (b + d + i))
    out = out.withColumns({"micro_f1": f1(F.col("precision"), F.col("recall")), "pm_f1": f1(F.col("pos_precision"), F.col("recall")), "il_mcc": mcc, "il_fpr": c / (b + c + i)})
    return out.withColumn("cgf1", F.col("pm_f1") * F.col("il_mcc"))


def best_scoring(scorings: DataFrame, keys=("grp",), which: str = "annotator") -> DataFrame:
    """Of several annotations of an image that of the largest mean local F1; one without any counts as perfect; of equal ones the first."""
    mean = scorings.groupBy(*keys, which).agg(F.coalesce(F.avg("local_f1"), F.lit(float("inf"))).alias("mean"))
    return mean.groupBy(*keys).agg(F.max_by(which, F.struct("mean", (-F.col(which)).alias("o"))).alias(which))


# Ranges of areas, both ends included, and largest numbers of detections of an image and class.
AREAS = {"all": (0.0, 1e10), "small": (0.0, 1024.0), "medium": (1024.0, 9216.0), "large": (9216.0, 1e10)}
MAX_DETS = (1, 10, 100)


def matched_detections(gt: DataFrame, pred: DataFrame, keys=("grp",), cat: str = "cat", thresholds=IOUS, areas=AREAS, most: int = MAX_DETS[-1]) -> DataFrame:
    """(keys, cat, area, iou, id, score, place, hit, ignored): the most best predictions of an image and class, each with the free box it takes at every threshold and range of areas.

    In order of falling score, then id, a prediction takes the free box of the largest overlap that reaches the threshold (of equal ones that of the largest id); boxes whose area is outside of the range are ignored and only taken where no other fits. A prediction is ignored with the box it takes, or, without one, if its own area is outside. The choice is a fold over the ordered predictions of an image and class, in the JVM."""
    at = [*keys, cat]
    size = lambda p="": B.area(B.box(prefix=p))
    side = lambda df, p: [F.col(c).alias(f"{p}{c}") for c in ("x0", "y0", "x1", "y1")]
    place = F.row_number().over(W.partitionBy(*at).orderBy(F.desc("score"), "id"))
    top = pred.select(*at, "id", "score", place.alias("place"), size().alias("size"), *side(pred, "p_")).where(F.col("place") <= most)
    boxes = gt.select(*at, F.col("id").alias("gt_id"), size().alias("gt_size"), *side(gt, "g_"))
    overlap = B.iou(B.box(prefix="p_"), B.box(prefix="g_"))
    pairs = top.join(boxes, at).select(*at, "place", F.struct((-overlap).alias("less"), (-F.col("gt_id")).alias("later"), F.col("gt_size").alias("size")).alias("box")).where(F.col("box.less") <= -min(thresholds))
    found = pairs.groupBy(*at, "place").agg(F.array_sort(F.collect_list("box")).alias("found"))
    none = F.array().cast(found.schema["found"].dataType)
    dets = top.join(found, [*at, "place"], "left").groupBy(*at).agg(F.array_sort(F.collect_list(F.struct("place", "id", "score", "size", F.coalesce("found", none).alias("found")))).alias("dets"))
    ranges = F.array(*[F.struct(F.lit(name).alias("area"), F.lit(float(lo)).alias("low"), F.lit(float(hi)).alias("high")) for name, (lo, hi) in areas.items()])
    outside = lambda v: ((v < F.col("range.low")) | (v > F.col("range.high"))).cast("int")
    ordered = lambda d: F.array_sort(F.transform(d["found"], lambda g: F.struct(outside(g["size"]).alias("out"), g["less"].alias("less"), g["later"].alias("later"))))
    runs = dets.withColumn("range", F.explode(ranges))
    runs = runs.withColumn("fits", F.transform("dets", lambda d: F.struct(outside(d["size"]).alias("out"), ordered(d).alias("found")))).withColumn("iou", F.explode(F.array(*map(F.lit, thresholds))))
    start = F.struct(F.array().cast("array<bigint>").alias("taken"), F.array().cast("array<int>").alias("said"))

    def step(s, d):
        free = F.filter(d["found"], lambda g: (g["less"] <= -F.col("iou")) & ~F.array_contains(s["taken"], g["later"]))
        took = lambda g: F.struct(F.concat(s["taken"], F.array(g["later"])).alias("taken"), F.concat(s["said"], F.array(1 + 2 * g["out"])).alias("said"))
        none = F.struct(s["taken"].alias("taken"), F.concat(s["said"], F.array(2 * d["out"])).alias("said"))
        return let(F.try_element_at(free, F.lit(1)), lambda g: F.when(g.isNull(), none).otherwise(took(g)))

    told = runs.withColumn("said", F.aggregate("fits", start, step)["said"]).withColumn("d", F.explode(F.arrays_zip("dets", "said")))
    said = F.col("d.said")
    return told.select(*at, F.col("range.area").alias("area"), "iou", F.col("d.dets.id").alias("id"), F.col("d.dets.score").alias("score"), F.col("d.dets.place").alias("place"), (said % 2).alias("hit"), (said >= 2).alias("ignored"))


def coco_evaluation(gt: DataFrame, pred: DataFrame, keys=("grp",), cat: str = "cat", thresholds=IOUS, areas=AREAS, max_dets=MAX_DETS) -> DataFrame:
    """(cat, area, iou, n_gt, ap, ar_1, ar_10, ...): average precision at 101 recalls, and the recall of the best max_dets predictions of each image; classes without ground truth in a range have no row.

    The ranking is a range sort by class, range, threshold and falling score, cut by a checkpoint. A partition's counts are summed and added to the places inside it, so no class and no score shared by many predictions meets in one task."""
    group = [cat, "area", "iou"]
    each = checkpointed(matched_detections(gt, pred, keys, cat, thresholds, areas, max(max_dets)).where("not ignored"))
    size = B.area(B.box())
    inside = [F.when((size >= lo) & (size <= hi), F.lit(name)) for name, (lo, hi) in areas.items()]
    n = gt.select(cat, F.explode(F.array_compact(F.array(*inside))).alias("area")).groupBy(cat, "area").agg(F.count("*").alias("n_gt"))
    order = [F.desc("score"), *keys, "id"]
    ranged = checkpointed(each.repartitionByRange(*group, *order).withColumn("__r", F.spark_partition_id()))
    sums = ranged.groupBy(*group, "__r").agg(F.sum("hit").alias("__h"), F.count("*").alias("__n"))
    before = W.partitionBy(*group).orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(*group, "__r", F.coalesce(F.sum("__h").over(before), F.lit(0)).alias("__h0"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n0"))
    so_far = W.partitionBy(*group, "__r").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    curve = ranged.join(starts, [*group, "__r"]).withColumn("tp", F.col("__h0") + F.sum("hit").over(so_far)).withColumn("seen", F.col("__n0") + F.count("*").over(so_far)).where("hit = 1")
    # the best precision at or beyond each of 101 recalls: one row for each step is enough
    curve = curve.join(n, [cat, "area"]).withColumn("__s", F.floor(100 * F.col("tp") / F.col("n_gt")))
    best = curve.groupBy(*group, "__s").agg(F.max(F.col("tp") / F.col("seen")).alias("__p"))
    at = best.withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__s")))).groupBy(*group, "__k").agg(F.max("__p").alias("__p"))
    ap = at.groupBy(*group).agg((F.sum("__p") / 101).alias("ap"))
    hits = each.groupBy(*group).agg(*[F.sum(F.when(F.col("place") <= m, F.col("hit")).otherwise(0)).alias(f"tp_{m}") for m in max_dets])
    every = n.withColumn("iou", F.explode(F.array(*map(F.lit, thresholds))))
    out = every.join(hits, group, "left").join(ap, group, "left")
    recall = [(F.coalesce(f"tp_{m}", F.lit(0)) / F.col("n_gt")).alias(f"ar_{m}") for m in max_dets]
    return out.select(*group, "n_gt", F.coalesce("ap", F.lit(0.0)).alias("ap"), *recall)


def coco_summary(evaluation: DataFrame, max_dets=MAX_DETS) -> DataFrame:
    """(area, ap, ap_50, ap_75, ar_...): means over classes and thresholds, a row for each range of areas."""
    at = lambda t: F.avg(F.when(F.abs(F.col("iou") - t) < 1e-9, F.col("ap")))
    return evaluation.groupBy("area").agg(F.avg("ap").alias("ap"), at(0.5).alias("ap_50"), at(0.75).alias("ap_75"), *[F.avg(f"ar_{m}").alias(f"ar_{m}") for m in max_dets])


def average_precision(gt: DataFrame, pred: DataFrame, keys=("grp",), cat: str = "cat", thresholds=(0.5, 0.75)) -> DataFrame:
    """(cat, iou, ap) over boxes of all sizes; see coco_evaluation()."""
    return coco_evaluation(gt, pred, keys, cat, thresholds, {"all": AREAS["all"]}, (MAX_DETS[-1],)).select(cat, "iou", "ap")


def tracklet_iou(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """(video, gt_id, pred_id, iou): sums over all frames of either of intersections and unions; a frame with one side adds its area to the union."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    totals = lambda df, k: df.groupBy("video", F.col("id").alias(k)).agg(F.sum(area).alias(f"{k}_area"))
    g, p = gt.alias("g"), pred.alias("p")
    inter = g.join(p, (F.col("g.video") == F.col("p.video")) & (F.col("g.grp") == F.col("p.grp"))).groupBy(F.col("g.video").alias("video"), F.col("g.id").alias("gt_id"), F.col("p.id").alias("pred_id")).agg(F.sum(B.intersection(B.box(prefix="g."), B.box(prefix="p."))).alias("inter"))
    both = inter.join(totals(gt, "gt_id"), ["video", "gt_id"]).join(totals(pred, "pred_id"), ["video", "pred_id"])
    whole = F.col("gt_id_area") + F.col("pred_id_area") - F.col("inter")
    return both.select("video", "gt_id", "pred_id", F.when(whole > 0, F.col("inter") / whole).otherwise(1.0).alias("iou"))


def pose_auc(errors: DataFrame, error: str = "error", most: int = 30, keys=()) -> DataFrame:
    """Mean of the cumulative shares of errors in bins of 1 degree; errors beyond most count in the whole only, most itself in the last bin."""
    # an error in bin k counts at the thresholds k + 1 to most
    gain = F.when(F.col(error) <= most, (most - F.least(F.floor(error), F.lit(most - 1))) / most).otherwise(0.0)
    return errors.groupBy(*keys).agg(F.avg(gain).alias("auc"))


def reconstruction(pred: DataFrame, truth: DataFrame, threshold: float, reach: float, keys=()) -> DataFrame:
    """Accuracy, completeness, their mean, precision, recall and F of two point sets; points farther than reach count as reach."""
    from .joins import nearest_sides

    side = lambda df, i: df.select(*keys, "pid", F.lit(i).alias("side"), *"xyz")
    d, one = F.coalesce("distance", F.lit(reach)), lambda i, v: F.avg(F.when(F.col("side") == i, v))
    found = nearest_sides(side(pred, 0).unionByName(side(truth, 1)), reach, keys, named=False)
    names = (("acc", "precision"), ("comp", "recall"))
    both = found.groupBy(*keys).agg(*[f for i, (a, b) in enumerate(names) for f in (one(i, d).alias(a), one(i, (d < threshold).cast("double")).alias(b))])
    both = both.where("acc is not null and comp is not null").select(*keys, "acc", "precision", "comp", "recall")
    p, r = F.col("precision"), F.col("recall")
    return both.withColumn("overall", (F.col("acc") + F.col("comp")) / 2).withColumn("fscore", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))


def report(metrics: DataFrame, name: str = "name", key: str = "key", value: str = "value") -> DataFrame:
    """Rows of metrics by columns of datasets; a key is dataset_mode."""
    return metrics.withColumn("dataset", F.split(key, "_", 2)[0]).groupBy(name).pivot("dataset").agg(F.avg(value))
