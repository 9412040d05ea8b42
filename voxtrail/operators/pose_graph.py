"""Similarity pose graphs: poses of chunks that agree with the transforms between neighbours and with loops, by Levenberg-Marquardt. A sequence is one row; its graph has a node for each chunk."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matching import per_group

#: Step of the numerical derivatives.
DELTA = 1e-6


def _rotation(w: np.ndarray) -> np.ndarray:
    """Rotations (n, 3, 3) of rotation vectors (n, 3)."""
    angle = np.linalg.norm(w, axis=1)[:, None, None]
    k = np.zeros((len(w), 3, 3))
    k[:, 0, 1], k[:, 0, 2], k[:, 1, 2] = -w[:, 2], w[:, 1], -w[:, 0]
    k -= k.transpose(0, 2, 1)
    return np.eye(3) + np.sinc(angle / np.pi) * k + 0.5 * np.sinc(angle / (2 * np.pi)) ** 2 * (k @ k)


def _vector(r: np.ndarray) -> np.ndarray:
    """Rotation vectors of rotations, for angles below pi."""
    axis = np.stack([r[:, 2, 1] - r[:, 1, 2], r[:, 0, 2] - r[:, 2, 0], r[:, 1, 0] - r[:, 0, 1]], 1) / 2
    angle = np.arctan2(np.linalg.norm(axis, axis=1), (np.trace(r, axis1=1, axis2=2) - 1) / 2)
    return axis / np.sinc(angle / np.pi)[:, None]


def _compose(a: tuple, b: tuple) -> tuple:
    """First b, then a; transforms are (s, r, t) with n of each."""
    return a[0] * b[0], a[1] @ b[1], a[0][:, None] * (a[1] @ b[2][..., None])[..., 0] + a[2]


def _inverse(a: tuple) -> tuple:
    back = a[1].transpose(0, 2, 1)
    return 1 / a[0], back, -(back @ a[2][..., None])[..., 0] / a[0][:, None]


def _moved(poses: tuple, step: np.ndarray) -> tuple:
    """Poses after small transforms (n, 7) of their own frames: rotation vector, translation, logarithm of scale."""
    return _compose(poses, (np.exp(step[:, 6]), _rotation(step[:, :3]), step[:, 3:6]))


def _residuals(poses: tuple, i: np.ndarray, j: np.ndarray, measured: tuple) -> np.ndarray:
    """(edges, 7): by how much the pose of j seen from i differs from what was measured."""
    at = lambda k: tuple(x[k] for x in poses)
    s, r, t = _compose(_inverse(measured), _compose(_inverse(at(i)), at(j)))
    return np.concatenate([_vector(r), t, np.log(s)[:, None]], 1)


def solve(poses: tuple, i: np.ndarray, j: np.ndarray, measured: tuple, iterations: int = 30, damping: float = 1e-6) -> tuple:
    """The poses that agree best with the edges (i, j, measured); the first one stays."""
    n = len(poses[0])
    error = _residuals(poses, i, j, measured)
    for _ in range(iterations):
        normal, right = np.zeros((n, 7, n, 7)), np.zeros((n, 7))
        parts = []
        for ends in (i, j):
            own = np.empty((len(i), 7, 7))
            for k in range(7):
                shift = np.zeros((len(i), 7))
                shift[:, k] = DELTA
                # each edge with a pose of its own that moves: its two ends as 2 * edges poses
                both = tuple(np.concatenate([x[i], x[j]]) for x in poses)
                full = np.zeros((2 * len(i), 7))
                full[: len(i)] += shift * (ends is i)
                full[len(i) :] += shift * (ends is j)
                places = np.arange(len(i))
                own[:, :, k] = (_residuals(_moved(both, full), places, places + len(i), measured) - error) / DELTA
            parts.append((ends, own))
        for a, ja in parts:
            np.add.at(right, a, -np.einsum("erk,er->ek", ja, error))
            for b, jb in parts:
                np.add.at(normal.transpose(0, 2, 1, 3), (a, b), np.einsum("erk,erl->ekl", ja, jb))
        free = normal.reshape(7 * n, 7 * n)[7:, 7:]
        before = (error**2).sum()
        for _ in range(10):
            step = np.linalg.solve(free + damping * (np.diag(np.diag(free)) + 1e-9 * np.eye(len(free))), right.ravel()[7:])
            tried = _moved(poses, np.concatenate([np.zeros(7), step]).reshape(n, 7))
            after = _residuals(tried, i, j, measured)
            if (after**2).sum() < before:
                poses, error, damping = tried, after, max(damping / 10, 1e-12)
                break
            damping *= 10
        else:
            break
        if before - (error**2).sum() < 1e-12 * max(before, 1e-12):
            break
    return poses


def optimised_poses(sequential: DataFrame, loops: DataFrame, keys=("seq_id",), iterations: int = 30) -> DataFrame:
    """(keys, node, s, r, t): absolute poses of the nodes of each sequence, the first one the identity.

    sequential: keys, chunk, s, r, t, where node chunk + 1 is node chunk followed by the transform; loops: keys, i, j, s, r, t, the pose of node i seen from node j. Sequences without loops are the running products."""
    pack = lambda df, cols, name: df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    rows = pack(sequential, ("chunk", "s", "r", "t"), "steps").join(pack(loops, ("i", "j", "s", "r", "t"), "loops"), list(keys), "left")
    stack = lambda xs: (np.array([x["s"] for x in xs], float), np.array([x["r"] for x in xs], float).reshape(-1, 3, 3), np.array([x["t"] for x in xs], float).reshape(-1, 3))

    def run(row):
        steps, found = stack(row["steps"]), row["loops"] or []
        n = len(steps[0]) + 1
        poses = [(np.ones(1), np.eye(3)[None], np.zeros((1, 3)))]
        for k in range(n - 1):
            poses.append(_compose(poses[-1], tuple(x[k : k + 1] for x in steps)))
        poses = tuple(np.concatenate(x) for x in zip(*poses))
        if found:
            i = np.concatenate([np.arange(n - 1), [x["j"] for x in found]]).astype(int)
            j = np.concatenate([np.arange(1, n), [x["i"] for x in found]]).astype(int)
            poses = solve(poses, i, j, tuple(np.concatenate(x) for x in zip(steps, stack(found))), iterations)
        return [(k, float(s), r.ravel().tolist(), t.tolist()) for k, (s, r, t) in enumerate(zip(*poses))]

    return per_group(rows, list(keys), run, pa.schema([("node", pa.int64()), ("s", pa.float64()), ("r", pa.list_(pa.float64())), ("t", pa.list_(pa.float64()))]))
