"""Camera and pose geometry as expressions; a matrix is an array of its rows, one after the other."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(a: Column, i: int) -> Column:
    return F.element_at(a, i + 1)


def vec(*xs) -> Column:
    return F.array(*[F.lit(x).cast("double") if not isinstance(x, Column) else x for x in xs])


def dot(a: Column, b: Column, n: int = 3) -> Column:
    found = at(a, 0) * at(b, 0)
    for i in range(1, n):
        found = found + at(a, i) * at(b, i)
    return found


def norm(a: Column, n: int = 3) -> Column:
    return F.sqrt(dot(a, a, n))


def let(value: Column, body) -> Column:
    """body(value) with the value bound once: nested products would otherwise repeat their factors' whole expressions."""
    return F.element_at(F.transform(F.array(value), body), 1)


def apply3(m: Column, v: Column) -> Column:
    """3x3 matrix times vector."""
    return let(F.struct(m.alias("m"), v.alias("v")), lambda x: F.array(*[at(x["m"], 3 * r) * at(x["v"], 0) + at(x["m"], 3 * r + 1) * at(x["v"], 1) + at(x["m"], 3 * r + 2) * at(x["v"], 2) for r in range(3)]))


def matmul3(a: Column, b: Column) -> Column:
    return let(F.struct(a.alias("a"), b.alias("b")), lambda x: F.array(*[at(x["a"], 3 * r) * at(x["b"], c) + at(x["a"], 3 * r + 1) * at(x["b"], 3 + c) + at(x["a"], 3 * r + 2) * at(x["b"], 6 + c) for r in range(3) for c in range(3)]))


def transpose3(m: Column) -> Column:
    return let(m, lambda x: F.array(*[at(x, 3 * c + r) for r in range(3) for c in range(3)]))


def backproject(u: Column, v: Column, depth: Column, fx, fy, cx, cy) -> Column:
    """A pixel with depth, in camera coordinates."""
    return F.array((u - cx) / fx * depth, (v - cy) / fy * depth, depth)


def project(p: Column, fx, fy, cx, cy) -> tuple[Column, Column]:
    """Camera coordinates to a pixel; null behind the camera."""
    z = at(p, 2)
    return F.when(z > 0, at(p, 0) / z * fx + cx), F.when(z > 0, at(p, 1) / z * fy + cy)


def rigid(r: Column, t: Column, p: Column) -> Column:
    return F.zip_with(apply3(r, p), t, lambda a, b: a + b)


def rigid_inverse(r: Column, t: Column) -> tuple[Column, Column]:
    back = transpose3(r)
    return back, F.transform(apply3(back, t), lambda a: -a)


def sim3_apply(s: Column, r: Column, t: Column, p: Column) -> Column:
    return F.zip_with(apply3(r, p), t, lambda a, b: s * a + b)


def sim3_compose(a: tuple, b: tuple) -> tuple:
    """First b, then a."""
    s, r, t = a
    return s * b[0], matmul3(r, b[1]), sim3_apply(s, r, t, b[2])


def sim3_relative(a: tuple, b: tuple) -> tuple:
    """What takes b's frame to a's: a after the inverse of b."""
    s, r, t = b
    back = transpose3(r)
    inverse = (1 / s, back, F.transform(apply3(back, t), lambda v: -v / s))
    return sim3_compose(a, inverse)


def quaternion_to_matrix(q: Column) -> Column:
    """(x, y, z, w), of any length but 0."""
    x, y, z, w = (at(q, i) for i in range(4))
    k = 2 / (x * x + y * y + z * z + w * w)
    return F.array(1 - k * (y * y + z * z), k * (x * y - z * w), k * (x * z + y * w), k * (x * y + z * w), 1 - k * (x * x + z * z), k * (y * z - x * w), k * (x * z - y * w), k * (y * z + x * w), 1 - k * (x * x + y * y))


def matrix_to_quaternion(m: Column) -> Column:
    """(x, y, z, w) with w >= 0, by the largest of the four."""
    a = [at(m, i) for i in range(9)]
    w, x, y, z = (F.sqrt(F.greatest(F.lit(0.0), 1 + i * a[0] + j * a[4] + k * a[8])) / 2 for i, j, k in ((1, 1, 1), (1, -1, -1), (-1, 1, -1), (-1, -1, 1)))
    most = F.greatest(w, x, y, z)
    q = (
        F.when(w == most, F.array((a[7] - a[5]) / (4 * w), (a[2] - a[6]) / (4 * w), (a[3] - a[1]) / (4 * w), w))
        .when(x == most, F.array(x, (a[1] + a[3]) / (4 * x), (a[2] + a[6]) / (4 * x), (a[7] - a[5]) / (4 * x)))
        .when(y == most, F.array((a[1] + a[3]) / (4 * y), y, (a[5] + a[7]) / (4 * y), (a[2] - a[6]) / (4 * y)))
        .otherwise(F.array((a[2] + a[6]) / (4 * z), (a[5] + a[7]) / (4 * z), z, (a[3] - a[1]) / (4 * z)))
    )
    return F.transform(q, lambda v: F.when(at(q, 3) < 0, -v).otherwise(v))


def rotation_angle(a: Column, b: Column) -> Column:
    """Degrees between two rotations."""
    trace = at(a, 0) * at(b, 0)
    for i in range(1, 9):
        trace = trace + at(a, i) * at(b, i)
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1) / 2))))


def direction_angle(a: Column, b: Column, ambiguous: bool = True) -> Column:
    """Degrees between two directions; ambiguous: up to sign. Null if either has no length."""
    c = dot(a, b) / (norm(a) * norm(b))
    angle = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))))
    return F.when(norm(a) * norm(b) > 0, F.least(angle, 180 - angle) if ambiguous else angle)


def field_of_view(size, focal) -> Column:
    return F.degrees(2 * F.atan(size / (2 * focal)))


# Signs of a box's corners along its length, height and width.
CORNERS = ((1, 1, 1), (1, 1, -1), (-1, 1, -1), (-1, 1, 1), (1, -1, 1), (1, -1, -1), (-1, -1, -1), (-1, -1, 1))


def yaw_matrix(yaw: Column) -> Column:
    c, s = F.cos(yaw), F.sin(yaw)
    return vec(c, 0, s, 0, 1, 0, -s, 0, c)


def box_corners(centre: Column, size: Column, yaw: Column) -> Column:
    """The eight corners of a box turned about the vertical axis."""
    c, s = F.cos(yaw), F.sin(yaw)
    corners = []
    for i, j, k in CORNERS:
        dx, dy, dz = at(size, 0) / 2 * i, at(size, 1) / 2 * j, at(size, 2) / 2 * k
        corners.append(F.array(at(centre, 0) + c * dx + s * dz, at(centre, 1) + dy, at(centre, 2) - s * dx + c * dz))
    return F.array(*corners)


def metric_depth(depth: Column, focal: Column, reference: float = 300.0) -> Column:
    return depth * focal / reference


def polygon_area(xs: list, ys: list) -> Column:
    """Of the corners in order: half of the sum of the cross products of neighbours, without sign."""
    n = len(xs)
    return F.abs(sum((xs[i] * ys[(i + 1) % n] - xs[(i + 1) % n] * ys[i] for i in range(n)), F.lit(0.0))) / 2
