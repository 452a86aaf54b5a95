"""Box geometry as Column expressions; everything stays in generated code."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    """Corner columns of an axis-parallel box."""

    x1: Column
    y1: Column
    x2: Column
    y2: Column


def corners(prefix: str = "", names: tuple[str, str, str, str] = ("x1", "y1", "x2", "y2")) -> Box:
    return Box(*(F.col(prefix + n) for n in names))


def from_xywh(x: Column, y: Column, w: Column, h: Column) -> Box:
    return Box(x, y, x + w, y + h)


def xywh(prefix: str = "") -> Box:
    return from_xywh(*(F.col(prefix + n) for n in "xywh"))


def from_centre(xc: Column, yc: Column, w: Column, h: Column) -> Box:
    return Box(xc - w / 2, yc - h / 2, xc + w / 2, yc + h / 2)


def to_xywh(b: Box) -> tuple[Column, Column, Column, Column]:
    return b.x1, b.y1, b.x2 - b.x1, b.y2 - b.y1


def to_centre(b: Box) -> tuple[Column, Column, Column, Column]:
    return (b.x1 + b.x2) / 2, (b.y1 + b.y2) / 2, b.x2 - b.x1, b.y2 - b.y1


def to_yolo(b: Box, width: Column, height: Column) -> tuple[Column, Column, Column, Column]:
    """Centre form as shares of the image."""
    xc, yc, w, h = to_centre(b)
    return xc / width, yc / height, w / width, h / height


def from_yolo(xc: Column, yc: Column, w: Column, h: Column, width: Column, height: Column) -> Box:
    return from_centre(xc * width, yc * height, w * width, h * height)


def area(b: Box) -> Column:
    return (b.x2 - b.x1) * (b.y2 - b.y1)


def intersection(a: Box, b: Box) -> Column:
    w = F.least(a.x2, b.x2) - F.greatest(a.x1, b.x1)
    h = F.least(a.y2, b.y2) - F.greatest(a.y1, b.y1)
    return F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def union_area(a: Box, b: Box) -> Column:
    return area(a) + area(b) - intersection(a, b)


def iou(a: Box, b: Box) -> Column:
    return _share(intersection(a, b), union_area(a, b))


def ioa(a: Box, b: Box) -> Column:
    """Intersection over the area of the second box."""
    return _share(intersection(a, b), area(b))


def iom(a: Box, b: Box) -> Column:
    """Intersection over the smaller area."""
    return _share(intersection(a, b), F.least(area(a), area(b)))


def giou(a: Box, b: Box) -> Column:
    hull = (F.greatest(a.x2, b.x2) - F.least(a.x1, b.x1)) * (F.greatest(a.y2, b.y2) - F.least(a.y1, b.y1))
    return iou(a, b) - _share(hull - union_area(a, b), hull)


def clip(b: Box, width: Column, height: Column) -> Box:
    to = lambda v, top: F.greatest(F.least(v, top), F.lit(0.0))
    return Box(to(b.x1, width), to(b.y1, height), to(b.x2, width), to(b.y2, height))


def scaled(b: Box, sx: Column, sy: Column) -> Box:
    return Box(b.x1 * sx, b.y1 * sy, b.x2 * sx, b.y2 * sy)


def non_empty(b: Box, threshold: float = 0.0) -> Column:
    return (b.x2 - b.x1 > threshold) & (b.y2 - b.y1 > threshold)


def inside(b: Box, width: Column, height: Column, border: float = 0.0) -> Column:
    return (b.x1 >= -border) & (b.y1 >= -border) & (b.x2 < width + border) & (b.y2 < height + border)


def near_edge(b: Box, margin: float = 0.025) -> Column:
    """Whether the centre of a normalised box lies within `margin` of the image's edge."""
    xc, yc, _, _ = to_centre(b)
    return (xc <= margin) | (yc <= margin) | (xc >= 1 - margin) | (yc >= 1 - margin)


def point_distances(px: Column, py: Column, b: Box) -> tuple[Column, Column, Column, Column]:
    """Left, top, right and bottom distance of a point from the box's sides."""
    return px - b.x1, py - b.y1, b.x2 - px, b.y2 - py


def point_similarity(ax: Column, ay: Column, bx: Column, by: Column, zero: float) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by)) / zero)


def unit(v: Column, size: Column) -> Column:
    """A coordinate as a share of the size, clamped to 0..1."""
    return F.least(F.greatest(v / size, F.lit(0.0)), F.lit(1.0))


# -- rotated boxes (centre, size, angle in degrees) -----------------------------------------------------------------------


def rotated_bounds(xc: Column, yc: Column, w: Column, h: Column, angle: Column) -> Box:
    c, s = F.abs(F.cos(F.radians(angle))), F.abs(F.sin(F.radians(angle)))
    return from_centre(xc, yc, c * w + s * h, c * h + s * w)


def normal_angle(angle: Column) -> Column:
    """The same angle in [-180, 180)."""
    return F.pmod(angle + 180.0, F.lit(360.0)) - 180.0


def rotated_inside(xc: Column, yc: Column, width: Column, height: Column, border: float = 0.0) -> Column:
    """Whether the centre lies within the image, by at most `border` outside."""
    return (xc >= -border) & (yc >= -border) & (xc < width + border) & (yc < height + border)


def rotated_clip(xc: Column, yc: Column, w: Column, h: Column, angle: Column, width: Column, height: Column, level: float = 1.0) -> tuple[Column, ...]:
    """(xc, yc, w, h, angle): a box that is level to within `level` degrees is cut to the image, another one stays as it is."""
    turn = normal_angle(angle)
    flat = F.abs(turn) <= level
    cut = clip(from_centre(xc, yc, w, h), width, height)
    cx, cy, cw, ch = to_centre(cut)
    # the size never grows by rounding
    return F.when(flat, cx).otherwise(xc), F.when(flat, cy).otherwise(yc), F.when(flat, F.least(w, cw)).otherwise(w), F.when(flat, F.least(h, ch)).otherwise(h), turn


def converted(v: tuple[Column, ...], source: str, target: str) -> tuple[Column, ...]:
    """Columns of a box from one form to another: xyxy, xywh, cxcywh (4 columns each), rotated (xc, yc, w, h, angle).

    A rotated box becomes its upright bounds; only an upright one becomes rotated, with angle 0.
    """
    if source == target:
        return v
    b = Box(*v) if source == "xyxy" else from_xywh(*v) if source == "xywh" else from_centre(*v) if source == "cxcywh" else rotated_bounds(*v)
    if target == "rotated":
        return (*to_centre(b), F.lit(0.0))
    return tuple(b) if target == "xyxy" else to_xywh(b) if target == "xywh" else to_centre(b)


def polygon_area(points: Column) -> Column:
    """Shoelace area of x0, y0, x1, y1, ... (array of doubles)."""
    n = F.size(points) / 2
    x = lambda i: F.element_at(points, (2 * F.pmod(i, n) + 1).cast("int"))
    y = lambda i: F.element_at(points, (2 * F.pmod(i, n) + 2).cast("int"))
    turn = F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: x(i) * y(i + 1) - y(i) * x(i + 1))
    return F.abs(F.aggregate(turn, F.lit(0.0), lambda a, v: a + v)) / 2


def sigmoid(v: Column) -> Column:
    return 1 / (1 + F.exp(-v))


def presence_score(logit: Column, presence: Column | None = None) -> Column:
    return sigmoid(logit) if presence is None else sigmoid(logit) * sigmoid(presence)
