"""Pose graphs, mask scores, quantiles, numbering and detection metrics against brute force on small fixtures."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxtrail.functions import masks as M
from voxtrail.operators import joins, metrics, order, pose_graph, windows


def ring(n, noise, seed=0):
    """Transforms about a circle, with turned and scaled noise."""
    rng = np.random.default_rng(seed)
    angle = 2 * np.pi / n
    out = []
    for _ in range(n):
        r = pose_graph._rotation(rng.normal(0, noise, (1, 3)))[0] @ pose_graph._rotation(np.array([[0, 0, angle]]))[0]
        out.append((float(np.exp(rng.normal(0, noise))), r.ravel().tolist(), [float(3 * np.sin(angle)), float(3 * (1 - np.cos(angle))), 0.0]))
    return out


def test_rotations_and_their_vectors():
    w = np.random.default_rng(1).normal(0, 1, (50, 3)) * 0.9
    w = np.concatenate([w, np.zeros((1, 3))])
    r = pose_graph._rotation(w)
    assert np.allclose(r @ r.transpose(0, 2, 1), np.eye(3)) and np.allclose(pose_graph._rotation(pose_graph._vector(r)), r)


def test_loops_close_the_ring(spark):
    schema = "seq_id long, chunk long, s double, r array<double>, t array<double>"
    rows = [(0, k, *x) for k, x in enumerate(ring(20, 0.0))] + [(1, k, *x) for k, x in enumerate(ring(20, 0.03))] + [(2, 0, 2.0, np.eye(3).ravel().tolist(), [1.0, 0.0, 0.0])]
    eye = np.eye(3).ravel().tolist()
    loops = spark.createDataFrame([(0, 20, 0, 1.0, eye, [0.0] * 3), (1, 20, 0, 1.0, eye, [0.0] * 3)], "seq_id long, i long, j long, s double, r array<double>, t array<double>")
    steps = spark.createDataFrame(rows, schema)
    got = {(r.seq_id, r.node): r for r in pose_graph.optimised_poses(steps, loops).collect()}
    plain = {(r.seq_id, r.node): r for r in pose_graph.optimised_poses(steps, loops.limit(0)).collect()}
    assert len(got) == len(plain) == 44 and got[(2, 1)].t == [1.0, 0.0, 0.0]
    assert all(np.allclose(got[k].t, plain[k].t, atol=1e-6) for k in got if k[0] == 0)  # a ring that closes stays
    gap = lambda x: np.linalg.norm(np.array(x[(1, 20)].t) - x[(1, 0)].t)
    assert gap(plain) > 0.2 and gap(got) < 0.25 * gap(plain)
    i, j = np.array([*range(20), 0]), np.array([*range(1, 21), 20])
    stack = lambda xs: (np.array([x[-3] for x in xs]), np.array([x[-2] for x in xs]).reshape(-1, 3, 3), np.array([x[-1] for x in xs]))
    measured = stack([x for x in rows if x[0] == 1] + [(1.0, eye, [0.0] * 3)])
    cost = lambda x: (pose_graph._residuals(stack([(x[(1, k)].s, x[(1, k)].r, x[(1, k)].t) for k in range(21)]), i, j, measured) ** 2).sum()
    best = cost(got)
    assert best < 0.2 * cost(plain)
    rng = np.random.default_rng(3)
    for _ in range(20):  # no small step is better
        poses = stack([(got[(1, k)].s, got[(1, k)].r, got[(1, k)].t) for k in range(21)])
        step = rng.normal(0, 1e-3, (21, 7))
        step[0] = 0
        assert (pose_graph._residuals(pose_graph._moved(poses, step), i, j, measured) ** 2).sum() >= best - 1e-9


def test_mask_scores_against_permutations(spark):
    rng = np.random.default_rng(5)
    gt, pred, want = [], [], {}
    for image in range(6):
        a, b = ([rng.random((8, 9)) < 0.5 for _ in range(rng.integers(0, 4))] for _ in range(2))
        gt += [(image, i, M.encode(m)) for i, m in enumerate(a)]
        pred += [(image, i, M.encode(m), 0.9) for i, m in enumerate(b)] + [(image, 99, M.encode(a[0]), 0.1)] * bool(a)
        if a and b:
            small, big = (a, b) if len(a) <= len(b) else (b, a)
            best = max((sum((x & big[k]).sum() / max((x | big[k]).sum(), 1) for x, k in zip(small, p)), p) for p in itertools.permutations(range(len(big)), len(small)))
            f = np.mean([M.boundary_f(*((x, big[k]) if small is a else (big[k], x))) for x, k in zip(small, best[1])])
            want[image] = (best[0] / len(small), f)
    kind = "struct<size:array<int>,counts:array<int>>"
    scores = metrics.mask_scores(spark.createDataFrame(gt, f"grp long, id long, rle {kind}"), spark.createDataFrame(pred, f"grp long, id long, rle {kind}, score double"))
    got = {r.grp: r for r in scores.collect()}
    for image, (j, f) in want.items():
        assert got[image].j == pytest.approx(j) and got[image].f == pytest.approx(f) and got[image].jf == pytest.approx((j + f) / 2)
    assert all(r.n == 0 and r.j is None for k, r in got.items() if k not in want)
    assert metrics.mask_summary(scores).first().j == pytest.approx(np.mean([x[0] for x in want.values()]))


def test_quantiles_numbers_and_nulls(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k), None if v < 0.1 else float(v)) for k, v in zip(rng.integers(0, 5, 300), rng.random(300).round(2))] + [(9, None)]
    df = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r for r in order.quantiles(df, ("k",), {"a": ("v", 0.1), "b": ("v", 0.5)}).collect()}
    for k in range(5):
        v = [x for q, x in rows if q == k and x is not None]
        assert got[k].a == pytest.approx(np.quantile(v, 0.1)) and got[k].b == pytest.approx(np.quantile(v, 0.5))
    assert got[9].a is None
    numbers = order.numbered(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")), ["x"], "n").collect()
    assert all(r.n == r.x + 1 for r in numbers) and len(numbers) == 1000


def test_repeated_rows_keep_their_chunks(spark):
    chunks = spark.createDataFrame([(0, 0, 100), (1, 80, 200), (2, 200, 200)], "chunk int, start int, stop int")
    points = spark.createDataFrame([(5, "a"), (5, "a"), (90, "b"), (250, "c"), (None, "d")], "idx int, x string")
    assert sorted((r.idx, r.x, r.chunk) for r in joins.chunk_of(points, chunks).collect()) == [(5, "a", 0), (5, "a", 0), (90, "b", 1)]


def test_paths_are_reflected(spark):
    for n, size in ((1, 45), (2, 45), (4, 45), (9, 5), (30, 11), (30, 45)):
        x = np.random.default_rng(n).normal(0, 1, n)
        df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(x)], "track_id long, frame_idx int, x double")
        got = [r.x_g for r in windows.gaussian_path(df, "x", size).orderBy("frame_idx").collect()]
        k = min(size, n if n % 2 else max(1, n - 1))
        k = 3 if n >= 3 and k < 3 else k
        if k <= 7:
            w = np.array([*windows.SMALL_KERNELS[k // 2][:0:-1], *windows.SMALL_KERNELS[k // 2]])
        else:
            w = np.exp(-((np.arange(k) - k // 2) ** 2) / (2 * (0.3 * ((k - 1) / 2 - 1) + 0.8) ** 2))
        want = np.convolve(np.pad(x, k // 2, mode="reflect"), w / w.sum(), "valid") if n > 1 else x
        assert np.allclose(got, want)


def test_masks_overlap_by_their_runs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, M.encode(rng.random((7, 5)) < p), M.encode(rng.random((7, 5)) < q)) for i, (p, q) in enumerate(itertools.product((0, 0.2, 0.6, 1), repeat=2))]
    kind = "struct<size:array<int>,counts:array<int>>"
    df = spark.createDataFrame(rows, f"i int, a {kind}, b {kind}")
    for r in df.select("i", M.mask_iou("a", "b").alias("iou"), M.mask_iom("a", "b").alias("iom")).collect():
        a, b = (M.decode(x) for x in rows[r.i][1:])
        both, least = (a & b).sum(), min(a.sum(), b.sum())
        assert r.iou == pytest.approx(both / max((a | b).sum(), 1)) and r.iom == pytest.approx(both / max(least, 1))
