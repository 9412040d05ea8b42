"""Boxes as four columns: conversions, areas, overlaps. All are expressions, evaluated inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple  # four Columns


def box(*names: str, prefix: str = "") -> Box:
    return tuple(F.col(prefix + n) for n in (names or ("x0", "y0", "x1", "y1")))


def cxcywh_to_xyxy(b: Box) -> Box:
    cx, cy, w, h = b
    return cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2


def cxcywh_to_xywh(b: Box) -> Box:
    cx, cy, w, h = b
    return cx - w / 2, cy - h / 2, w, h


def xywh_to_xyxy(b: Box) -> Box:
    x, y, w, h = b
    return x, y, x + w, y + h


def xywh_to_cxcywh(b: Box) -> Box:
    x, y, w, h = b
    return x + w / 2, y + h / 2, w, h


def xyxy_to_xywh(b: Box) -> Box:
    x0, y0, x1, y1 = b
    return x0, y0, x1 - x0, y1 - y0


def xyxy_to_cxcywh(b: Box) -> Box:
    x0, y0, x1, y1 = b
    return (x0 + x1) / 2, (y0 + y1) / 2, x1 - x0, y1 - y0


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def intersection(a: Box, b: Box) -> Column:
    zero = F.lit(0.0)
    return F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), zero) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), zero)


def union(a: Box, b: Box) -> Column:
    return area(a) + area(b) - intersection(a, b)


def iou(a: Box, b: Box) -> Column:
    """0 where the union is empty."""
    return F.when(union(a, b) > 0, intersection(a, b) / union(a, b)).otherwise(0.0)


def iom(a: Box, b: Box) -> Column:
    """Intersection over the smaller area."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, intersection(a, b) / least).otherwise(0.0)


def ioa(a: Box, b: Box) -> Column:
    """Intersection over the first area."""
    return F.when(area(a) > 0, intersection(a, b) / area(a)).otherwise(0.0)


def metric_iou(a: Box, b: Box, eps: float = 2.220446049250313e-16) -> Column:
    """The metrics' flavour: boxes without area have no intersection, and an empty union counts as 1."""
    inter = F.when((area(a) <= eps) | (area(b) <= eps), 0.0).otherwise(intersection(a, b))
    whole = area(a) + area(b) - inter
    return F.when(whole <= eps, 1.0).otherwise(inter / whole)


def giou(a: Box, b: Box) -> Column:
    hull = (F.greatest(a[2], b[2]) - F.least(a[0], b[0])) * (F.greatest(a[3], b[3]) - F.least(a[1], b[1]))
    return iou(a, b) - F.when(hull > 0, (hull - union(a, b)) / hull).otherwise(0.0)


def clip(b: Box, width: float, height: float) -> Box:
    to = lambda c, most: F.least(F.greatest(c, F.lit(0.0)), F.lit(float(most)))
    return to(b[0], width), to(b[1], height), to(b[2], width), to(b[3], height)


def nonempty(b: Box, threshold: float = 0.0) -> Column:
    return (b[2] - b[0] > threshold) & (b[3] - b[1] > threshold)


def inside(b: Box, width: float, height: float, margin: float = 0.0) -> Column:
    return (b[0] >= -margin) & (b[1] >= -margin) & (b[2] < width + margin) & (b[3] < height + margin)


def scale(b: Box, sx: float, sy: float) -> Box:
    return b[0] * sx, b[1] * sy, b[2] * sx, b[3] * sy


def rescale_about_centre(b: Box, factor: float) -> Box:
    cx, cy, w, h = xyxy_to_cxcywh(b)
    return cxcywh_to_xyxy((cx, cy, w * factor, h * factor))


def hflip(b: Box, width: float) -> Box:
    return width - b[2], b[1], width - b[0], b[3]


def near_border(b: Box, margin: float) -> Column:
    """The centre of a normalised box lies within margin of the border."""
    cx, cy, _, _ = xyxy_to_cxcywh(b)
    return (cx < margin) | (cx > 1 - margin) | (cy < margin) | (cy > 1 - margin)


def centre_distance(a: Box, b: Box) -> Column:
    ax, ay, _, _ = xyxy_to_cxcywh(a)
    bx, by, _, _ = xyxy_to_cxcywh(b)
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def euclidean_similarity(a: Box, b: Box, zero_distance: float = 2.0) -> Column:
    """1 at distance 0, falling to 0 at zero_distance."""
    return F.greatest(F.lit(0.0), 1 - centre_distance(a, b) / zero_distance)


def point_distances(b: Box, x: Column, y: Column) -> tuple:
    """Distances of a point to the left, upper, right and lower side; negative outside."""
    return x - b[0], y - b[1], b[2] - x, b[3] - y


def wrap_degrees(angle: Column) -> Column:
    """An angle in [-180, 180)."""
    return angle + 180 - F.floor((angle + 180) / 360) * 360 - 180


def padded_crop(b: Box, width: float, height: float, padding: float = 0.2) -> Box:
    """The box widened by a share of its sides, cut to whole pixels, inside the image."""
    px, py = F.floor((b[2] - b[0]) * padding), F.floor((b[3] - b[1]) * padding)
    return clip((b[0] - px, b[1] - py, b[2] + px, b[3] + py), width, height)


def rotated_hull(b: tuple, degrees: Column) -> Box:
    """The upright box about a turned one (centre, width, height) of an angle against the clock."""
    cx, cy, w, h = b
    c, s = F.abs(F.cos(F.radians(degrees))), F.abs(F.sin(F.radians(degrees)))
    half_w, half_h = (c * w + s * h) / 2, (s * w + c * h) / 2
    return cx - half_w, cy - half_h, cx + half_w, cy + half_h


def zoom_window(b: Box, width: float, height: float, factor: float = 2.0) -> Box:
    """A window factor times as large as the box about its centre, inside the image."""
    return clip(rescale_about_centre(b, factor), width, height)
