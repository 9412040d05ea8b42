"""Matches of tracks over packed frames: a row holds the boxes of a frame, and Python compares and assigns many frames at once.

No row for a pair and a frame is made or shuffled. What a pass needs of whole sequences (tracks, alignments of pairs of tracks) are counts and sums that Spark makes of the pass before; tasks hold them as arrays, up to HELD rows. Beyond that, or where an id comes twice in a frame, Beyond is raised and the callers go by joins."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matching import assign_all

#: Rows of tracks, or of pairs of tracks, that a task holds as arrays.
HELD = 1 << 20
#: Boxes taken up and pairs of boxes compared at once (a single crowded frame may have more).
BOXES, PAIRS = 1 << 17, 1 << 18
#: Rows that match nothing, since a key, frame or id is null, are dealt to so many groups.
LONE = 1024
EPS = 2.220446049250313e-16


class Beyond(Exception):
    """The tables need the way by joins."""


def packed(gt: DataFrame, pred: DataFrame, keys, frame: str, cat: str) -> DataFrame:
    """(keys, frame, lone, gt, pred): the boxes of each side in the order of their ids. lone is 0, and another number for rows that match nothing."""
    at, values = [*keys, frame], ("x0", "y0", "x1", "y1")
    side = lambda df, n: df.select(*at, F.lit(n).alias("__side"), F.col("id").cast("long").alias("id"), *[F.col(c).cast("double").alias(c) for c in values], F.col(cat).alias("cat"))
    lacks = F.expr(" or ".join(f"`{c}` is null" for c in (*at, "id")))
    rows = side(gt, 0).unionByName(side(pred, 1)).withColumn("lone", F.when(lacks, 1 + F.pmod(F.xxhash64("id", *values), F.lit(LONE))).otherwise(0).cast("int"))
    pack = lambda n, name: F.array_sort(F.collect_list(F.when(F.col("__side") == n, F.struct("id", *values, "cat")))).alias(name)
    return rows.groupBy(*at, "lone").agg(pack(0, "gt"), pack(1, "pred"))


class Index:
    """Places of rows of whole numbers; -1 for rows that are not held."""

    def __init__(self, *columns):
        self.values, self.steps = [np.unique(c) for c in columns], []
        code = np.searchsorted(self.values[0], columns[0])
        for v, c in zip(self.values[1:], columns[1:]):
            both = code * len(v) + np.searchsorted(v, c)
            self.steps.append(np.unique(both))
            code = np.searchsorted(self.steps[-1], both)
        self.code = code  # of the rows it was made of

    def __call__(self, *columns):
        code = _place(self.values[0], columns[0])
        for v, step, c in zip(self.values[1:], self.steps, columns[1:]):
            c = _place(v, c)
            code = np.where((code >= 0) & (c >= 0), _place(step, code * len(v) + c), -1)
        return code


def _place(values, x):
    if not len(values):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return np.where(values[at] == x, at, -1)


class Held:
    """A small table on the driver: sequences and classes as numbers, the columns as arrays."""

    def __init__(self, df: DataFrame, keys, columns):
        t = df.select(*keys, *columns).limit(HELD + 1).toArrow()
        n = t.num_rows
        if n > HELD:
            raise Beyond
        self.seqs = {}
        rows = zip(*[t.column(k).to_pylist() for k in keys]) if keys else [()] * n
        self.seq = np.array([self.seqs.setdefault(r, len(self.seqs)) for r in rows], np.int64)
        self.cats = {}
        if "gt_cat" in columns:
            self.cat = np.array([self.cats.setdefault(c, len(self.cats)) for c in t.column("gt_cat").to_pylist()], np.int64)
        self.columns = {c: t.column(c).to_numpy() for c in columns if c != "gt_cat"}

    def seq_of(self, fr: Frames) -> np.ndarray:
        """Its numbers of the batch's sequences, -1 for others."""
        return np.array([self.seqs.get(k, -1) for k in fr.names], np.int64)

    def cat_of(self, fr: Frames) -> np.ndarray:
        """Its numbers of the batch's classes, the last for null."""
        return np.array([*(self.cats.get(c, -1) for c in fr.cats.to_pylist()), -1], np.int64)


class Tracks(Held):
    """Predicted tracks, of a sequence or of a sequence and class."""

    def __init__(self, df: DataFrame, keys, by_class: bool):
        super().__init__(df, keys, [*(["gt_cat"] if by_class else []), "pred_id"])
        self.by_class = by_class
        self.index = Index(self.seq, *([self.cat] if by_class else []), self.columns["pred_id"])

    def __call__(self, fr: Frames, frames, cats, preds) -> np.ndarray:
        seq = self.seq_of(fr)[fr.seq[frames]]
        return self.index(seq, *([self.cat_of(fr)[cats]] if self.by_class else []), fr.pred.id[preds]) >= 0


class Alignment(Held):
    """The alignments of pairs of tracks."""

    def __init__(self, df: DataFrame, keys, by_class: bool):
        super().__init__(df, keys, [*(["gt_cat"] if by_class else []), "gt_id", "pred_id", "a"])
        self.by_class = by_class
        self.gt = Index(self.seq, *([self.cat] if by_class else []), self.columns["gt_id"])
        self.pred = Index(self.seq, self.columns["pred_id"])
        self.pair = Index(self.gt.code, self.pred.code)
        self.a = np.zeros(len(self.seq) + 1)  # the last for pairs that are not held
        self.a[self.pair.code] = self.columns["a"]

    def __call__(self, fr: Frames, g: Groups, gpos, ppos) -> np.ndarray:
        seq = self.seq_of(fr)[fr.seq]
        of_gt = self.gt(seq[fr.gt.frame[g.gt]], *([self.cat_of(fr)[fr.gt.cat[g.gt]]] if self.by_class else []), fr.gt.id[g.gt])
        of_pred = self.pred(seq[fr.pred.frame[g.pred]], fr.pred.id[g.pred])
        return self.a[self.pair(of_gt[gpos], of_pred[ppos])]


class Side:
    def __init__(self, lists: pa.ListArray):
        n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        rows = lists.flatten()
        self.id, *self.box = (rows.field(c).to_numpy(zero_copy_only=False) for c in ("id", "x0", "y0", "x1", "y1"))
        self.box = [b.astype(float) for b in self.box]
        self.frame = np.repeat(np.arange(len(n)), n)
        self.starts, self.n, self.cats = np.cumsum(n) - n, n, rows.field("cat")
        self.area = (self.box[2] - self.box[0]) * (self.box[3] - self.box[1])

    def twice(self) -> bool:
        return bool(((self.frame[1:] == self.frame[:-1]) & (self.id[1:] == self.id[:-1])).any())


class Frames:
    """Many packed frames. seq: each one's sequence, names: those of the sequences; cats: names of classes, of which a row with none has the number -1."""

    def __init__(self, batch: pa.RecordBatch, keys):
        self.gt, self.pred = Side(batch.column("gt")), Side(batch.column("pred"))
        code = np.zeros(batch.num_rows, np.int64)
        for k in keys:
            d = batch.column(k).dictionary_encode()
            code = np.unique(code * len(d.dictionary) + d.indices.to_numpy(), return_inverse=True)[1]
        _, first, self.seq = np.unique(code, return_index=True, return_inverse=True)
        self.keys = {k: batch.column(k).take(pa.array(first)) for k in keys}
        self.names = list(zip(*[v.to_pylist() for v in self.keys.values()])) if keys else [()] * len(first)
        d = pa.concat_arrays([self.gt.cats, self.pred.cats]).dictionary_encode()
        self.cats, at = d.dictionary, d.indices.fill_null(-1).to_numpy().astype(np.int64)
        self.gt.cat, self.pred.cat = at[: len(self.gt.id)], at[len(self.gt.id) :]

    def counted(self, columns: dict, weights=None, **more) -> dict:
        """Sums of weights (or counts, as n) by sequence and the further columns of whole numbers; cat columns are given by number."""
        at = columns.pop("seq")
        index = Index(at, *columns.values())
        _, first, place = np.unique(index.code, return_index=True, return_inverse=True)
        sums = np.bincount(place, weights, len(first))
        out = {k: v.take(pa.array(at[first])) for k, v in self.keys.items()}
        for k, v in columns.items():
            v = v[first]
            out[k] = self.cats.take(pa.array(v, mask=v < 0)) if k.endswith("cat") else pa.array(v)
        return out | {"n": pa.array(sums if weights is not None else sums.astype(np.int64))} | {k: pa.array(f(first, place)) for k, f in more.items()}


class Groups:
    """What is assigned as one: rows of ground truth (places gt) and predictions (places pred) of a frame, or of a frame and class, with the kept predictions."""

    def __init__(self, fr: Frames, by_class: bool, *kept):
        gt, pred = fr.gt, fr.pred
        if by_class:
            self.gt = np.lexsort((np.arange(len(gt.id)), gt.cat, gt.frame))
            self.gt = self.gt[gt.cat[self.gt] >= 0]
        else:
            self.gt = np.arange(len(gt.id))
        f, c = gt.frame[self.gt], gt.cat[self.gt]
        new = np.ones(len(f), bool)
        new[1:] = (f[1:] != f[:-1]) | ((c[1:] != c[:-1]) & by_class)
        first = np.nonzero(new)[0]
        self.frame, self.cat, self.gstart, self.n = f[first], c[first], first, np.diff([*first, len(f)])
        m = pred.n[self.frame]
        group = np.repeat(np.arange(len(first)), m)
        self.pred = pred.starts[self.frame][group] + np.arange(len(group)) - np.repeat(np.cumsum(m) - m, m)
        for k in kept:
            keep = k(fr, self.frame[group], self.cat[group], self.pred)
            group, self.pred = group[keep], self.pred[keep]
        self.of = group  # of the places in pred
        self.m = np.bincount(group, minlength=len(first))
        self.pstart = np.cumsum(self.m) - self.m
        self.fr = fr

    def compared(self):
        """(starts of groups' pairs, n, m, places of pairs in gt and in pred, IoU) for some groups at a time; the pairs of a group are a matrix, row by row."""
        size = self.n * self.m
        total, lo = np.cumsum(size), 0
        while lo < len(size):
            hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS, "right")))
            n, m, k = self.n[lo:hi], self.m[lo:hi], size[lo:hi]
            starts = np.cumsum(k) - k
            of = np.repeat(np.arange(hi - lo), k)
            i, j = np.divmod(np.arange(len(of)) - starts[of], m[of])
            gpos, ppos = self.gstart[lo:hi][of] + i, self.pstart[lo:hi][of] + j
            yield starts, n, m, gpos, ppos, self.iou(self.gt[gpos], self.pred[ppos])
            lo = hi

    def iou(self, g, p):
        """As functions.boxes has it; 0 where a value is missing."""
        a, b = ([v[at] for v in side.box] for side, at in ((self.fr.gt, g), (self.fr.pred, p)))
        inter = np.maximum(np.minimum(a[2], b[2]) - np.maximum(a[0], b[0]), 0.0) * np.maximum(np.minimum(a[3], b[3]) - np.maximum(a[1], b[1]), 0.0)
        whole = self.fr.gt.area[g] + self.fr.pred.area[p] - inter
        s = np.divide(inter, whole, out=np.zeros(len(inter)), where=whole > 0)
        return np.where(np.isfinite(s), s, 0.0)

    def overlaps(self, least: float) -> np.ndarray:
        """Of each place in pred, whether a pair reaches least."""
        out = np.zeros(len(self.pred), bool)
        for *_, ppos, s in self.compared():
            out[ppos[s >= least]] = True
        return out

    def shares(self):
        """(places in gt, in pred, share) of the pairs: IoU over the sums of IoU of either end."""
        for *_, gpos, ppos, s in self.compared():
            g, p = gpos - (gpos[0] if len(gpos) else 0), ppos - (ppos[0] if len(ppos) else 0)
            whole = np.bincount(g, s)[g] + np.bincount(p, s)[p] - s if len(s) else s
            yield gpos, ppos, np.divide(s, whole, out=np.zeros(len(s)), where=whole > EPS)

    def assigned(self, alignment: Alignment):
        """(places in gt, in pred, IoU) of the pairs that are assigned to each other."""
        out = [(np.empty(0, int), np.empty(0, int), np.empty(0))]
        for starts, n, m, gpos, ppos, s in self.compared():
            cost = -s * alignment(self.fr, self, gpos, ppos)
            shape = n * (int(m.max(initial=0)) + 1) + m
            order = np.argsort(shape, kind="stable")
            for at in np.split(order, np.nonzero(np.diff(shape[order]))[0] + 1):
                r, c = int(n[at[0]]), int(m[at[0]])
                if r and c:
                    rows, cols = assign_all(cost[starts[at][:, None] + np.arange(r * c)].reshape(-1, r, c))
                    hit = (starts[at][:, None] + rows * c + cols).ravel()
                    out.append((gpos[hit], ppos[hit], s[hit]))
        return [np.concatenate(x) for x in zip(*out)]


def passed(frames: DataFrame, keys, run, schema: str) -> DataFrame:
    """What run(Frames) yields as dicts of arrays, keys among them; frames are taken up in parts of about BOXES boxes."""
    kinds = dict(frames.dtypes)
    schema = "".join(f"`{k}` {kinds[k]}, " for k in keys) + schema

    def go(batches):
        for b in regrouped(batches):
            for out in run(Frames(b, keys)):
                if len(next(iter(out.values()))):
                    yield pa.RecordBatch.from_pydict(out)

    return frames.select(*keys, "gt", "pred").mapInArrow(go, schema)


def regrouped(batches):
    held, n = [], 0
    for b in batches:
        count = np.cumsum(sum(pc.list_value_length(b.column(k)).to_numpy(zero_copy_only=False) for k in ("gt", "pred")))
        lo = 0
        while lo < b.num_rows:
            before = int(count[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(count, before + BOXES - n, "right")))
            held, n, lo = [*held, b.slice(lo, hi - lo)], n + int(count[hi - 1]) - before, hi
            if n >= BOXES or lo < b.num_rows:
                yield joined(held)
                held, n = [], 0
    if held:
        yield joined(held)


def joined(batches) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.concat_arrays([b.column(i) for b in batches]) for i in range(batches[0].num_columns)], names=batches[0].schema.names)
