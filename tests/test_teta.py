"""The three-part tracking accuracy against loops over frames with all assignments tried."""

import itertools

import numpy as np
import pytest

from voxtrail.operators import teta
from voxtrail.operators.matching import box_array, iou_matrix

SCHEMA = "grp int, id long, x0 double, y0 double, x1 double, y1 double, video int, cat int"


def boxes(rng, n_frames=6):
    gt, pred = [], []
    for v in range(2):
        for f in range(n_frames):
            for i in range(1, 4):
                x, y = 6.0 * i + rng.random(), 3.0 * i + rng.random()
                gt.append((f, i, x, y, x + 8, y + 8, v, i % 2))
                if rng.random() < 0.8:
                    dx, dy = (rng.random(2) * 3).tolist()
                    pred.append((f, 10 + i, x + dx, y + dy, x + dx + 8, y + dy + 8, v, int(rng.random() < 0.5)))
            pred.append((f, 20, 90.0, 90.0, 95.0, 95.0, v, 1))
    return gt, pred


def best(cost):
    n, m = cost.shape
    if n > m:
        return [(i, j) for j, i in best(cost.T)]
    return list(enumerate(max(itertools.permutations(range(m), n), key=lambda p: sum(cost[i, j] for i, j in enumerate(p))))) if n else []


def aligned(frames):
    """Frames of (gt rows, pred rows) -> for each frame (gt, pred, s) of the assignment, and the sizes of tracks."""
    pot, cg, cp = {}, {}, {}
    for g, p in frames:
        s = iou_matrix(arr(g), arr(p))
        whole = s.sum(0)[None] + s.sum(1)[:, None] - s
        for i, a in enumerate(g):
            cg[a[1]] = cg.get(a[1], 0) + 1
            for j, b in enumerate(p):
                pot[a[1], b[1]] = pot.get((a[1], b[1]), 0) + (s[i, j] / whole[i, j] if whole[i, j] else 0)
        for b in p:
            cp[b[1]] = cp.get(b[1], 0) + 1
    out = []
    for g, p in frames:
        s = iou_matrix(arr(g), arr(p))
        c = np.array([[s[i, j] * pot[a[1], b[1]] / (cg[a[1]] + cp[b[1]] - pot[a[1], b[1]]) for j, b in enumerate(p)] for i, a in enumerate(g)]).reshape(len(g), len(p))
        out.append([(g[i], p[j], s[i, j]) for i, j in best(c)])
    return out, cg, cp


def arr(rows):
    return box_array([dict(zip(("x0", "y0", "x1", "y1"), r[2:6])) for r in rows])


def brute(gt, pred, n_frames, exhaustive):
    got = {}
    for c, a in itertools.product((0, 1), teta.ALPHAS):
        got[c, a] = dict.fromkeys((*teta.COUNTS, *teta.SHARES), 0.0)
    for v in range(2):
        frames = [([r for r in gt if r[6] == v and r[0] == f], [r for r in pred if r[6] == v and r[0] == f]) for f in range(n_frames)]
        hits = lambda g, p: {p[j][1] for j in np.nonzero((iou_matrix(arr(g), arr(p)) >= 0.5).any(0))[0]}
        near = set().union(*[hits(g, p) for g, p in frames])
        whole = aligned([(g, [x for x in p if x[1] in near]) for g, p in frames])[0]
        for c in (0, 1):
            mine = [[x for x in g if x[7] == c] for g, _ in frames]
            over = [hits(m, p) - {b[1] for a, b, s in w if s >= 0.5 and a[7] != c} for m, (_, p), w in zip(mine, frames, whole)]
            tracks = set().union(*over)
            found, cg, cp = aligned([(m, [x for x in p if x[1] in tracks]) for m, (_, p) in zip(mine, frames)])
            for a in teta.ALPHAS:
                r, pairs = got[c, a], {}
                for m, o, f, (_, p) in zip(mine, over, found, frames):
                    ok = [(x, y) for x, y, s in f if s >= a - 1e-12]
                    r["loc_tp"] += len(ok)
                    r["loc_fn"] += len(m) - len(ok)
                    r["loc_fp"] += len(o - {y[1] for _, y in ok})
                    for x, y in ok:
                        pairs[x[1], y[1]] = pairs.get((x[1], y[1]), 0) + 1
                        if a >= 0.5:
                            r["cls_tp" if y[7] == c else "cls_fn"] += 1
                            if y[7] != c:
                                got[y[7], a]["cls_fp"] += 1
                    if exhaustive and a >= 0.5:
                        r["cls_fp"] += sum(x[7] == c and x[1] not in o for x in p)
                for (x, y), n in pairs.items():
                    r["assoc_a"] += n * n / (cg[x] + cp[y] - n)
                    r["assoc_re"] += n * n / cg[x]
                    r["assoc_pr"] += n * n / cp[y]
    return got


@pytest.mark.parametrize("exhaustive", [False, True])
def test_against_loops(spark, exhaustive):
    gt, pred = boxes(np.random.default_rng(3))
    want = brute(gt, pred, 6, exhaustive)
    part = teta.teta_partial(spark.createDataFrame(gt, SCHEMA), spark.createDataFrame(pred, SCHEMA), exhaustive=exhaustive)
    got = {(r.cat, r.alpha): r for r in part.groupBy("cat", "alpha").sum(*teta.COUNTS, *teta.SHARES).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        # pairs without any overlap are matched at 0 in an order that the metric leaves open
        for c in teta.COUNTS[:2] if k[1] == 0 else w:
            assert got[k][f"sum({c})"] == pytest.approx(w[c]), (k, c)


def test_perfect_and_empty(spark):
    gt, _ = boxes(np.random.default_rng(4), 3)
    g = spark.createDataFrame(gt, SCHEMA)
    same = teta.teta_combine(teta.teta_partial(g, g)).collect()
    assert len(same) == 40 and all(r.teta == pytest.approx(1) for r in same if r.alpha > 0)
    none = teta.teta_by_class(teta.teta_combine(teta.teta_partial(g, g.limit(0)))).collect()
    assert len(none) == 20 and all(r.teta == 0 for r in none)
    assert teta.teta_partial(g.limit(0), g).count() == 0
