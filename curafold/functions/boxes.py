"""Box columns. A box is four columns (x1, y1, x2, y2)."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def corners(x: Column, y: Column, w: Column, h: Column) -> Box:
    return x - w / 2, y - h / 2, x + w / 2, y + h / 2


def centred(b: Box) -> Box:
    return (b[0] + b[2]) / 2, (b[1] + b[3]) / 2, b[2] - b[0], b[3] - b[1]


def clipped(b: Box, width: float, height: float) -> Box:
    within = lambda x, most: F.least(F.greatest(x, F.lit(0.0)), F.lit(float(most)))
    return within(b[0], width), within(b[1], height), within(b[2], width), within(b[3], height)


def area(b: Box) -> Column:
    return (b[2] - b[0]) * (b[3] - b[1])


def intersection(a: Box, b: Box) -> Column:
    side = lambda k: F.greatest(F.least(a[k + 2], b[k + 2]) - F.greatest(a[k], b[k]), F.lit(0.0))
    return side(0) * side(1)


def iou(a: Box, b: Box) -> Column:
    both = intersection(a, b)
    return both / (area(a) + area(b) - both)


def _hull(a: Box, b: Box) -> tuple[Column, Column]:
    return tuple(F.greatest(a[k + 2], b[k + 2]) - F.least(a[k], b[k]) for k in (0, 1))


def giou(a: Box, b: Box) -> Column:
    w, h = _hull(a, b)
    union = area(a) + area(b) - intersection(a, b)
    return iou(a, b) - (w * h - union) / (w * h)


def diou(a: Box, b: Box) -> Column:
    w, h = _hull(a, b)
    apart = ((a[0] + a[2] - b[0] - b[2]) / 2) ** 2 + ((a[1] + a[3] - b[1] - b[3]) / 2) ** 2
    return iou(a, b) - apart / (w * w + h * h)


def ciou(a: Box, b: Box, eps: float = 1e-7) -> Column:
    shape = lambda x: F.atan((x[2] - x[0]) / (x[3] - x[1]))
    v = F.lit(4 / pi**2) * (shape(b) - shape(a)) ** 2
    return diou(a, b) - v * v / (v - iou(a, b) + F.lit(1 + eps))


def over_second(a: Box, b: Box) -> Column:
    return intersection(a, b) / area(b)


def alpha_iou(a: Box, b: Box, alpha: float = 3.0) -> Column:
    return F.pow(iou(a, b), F.lit(alpha))


def union_box(boxes: Column) -> Column:
    """(x1, y1, x2, y2) around an array of boxes, each an array of four; null for none."""
    side = lambda k, f: f(F.transform(boxes, lambda b: b[k]))
    around = F.struct(side(0, F.array_min).alias("x1"), side(1, F.array_min).alias("y1"), side(2, F.array_max).alias("x2"), side(3, F.array_max).alias("y2"))
    return F.when(F.size(boxes) > 0, around)


def survives(before: Box, after: Box, side: float = 2.0, share: float = 0.1, aspect: float = 20.0) -> Column:
    """Whether a box is still worth keeping after a transform: both sides above `side`, area above a share, not too thin."""
    w, h = after[2] - after[0], after[3] - after[1]
    thin = F.greatest(w / (h + 1e-16), h / (w + 1e-16))
    return (w > side) & (h > side) & (w * h / (area(before) + 1e-16) > share) & (thin < aspect)


def letterbox(width: Column, height: Column, size: int = 640, stride: int = 32, enlarge: bool = True) -> dict[str, Column]:
    """Scale, new sides and padding of each side that fit an image into a square, padded to a multiple of the stride."""
    scale = F.least(F.lit(float(size)) / height, F.lit(float(size)) / width)
    scale = scale if enlarge else F.least(scale, F.lit(1.0))
    w, h = F.bround(width * scale).cast("int"), F.bround(height * scale).cast("int")
    return {"scale": scale, "w": w, "h": h, "pad_x": F.pmod(size - w, F.lit(stride)) / 2, "pad_y": F.pmod(size - h, F.lit(stride)) / 2}


def anchor_fit(w: Column, h: Column, anchors: list[tuple[float, float]]) -> Column:
    """How well the best anchor fits a box: the worse of both sides' ratios (the smaller of a ratio and its inverse)."""
    fits = []
    for a, b in anchors:
        x, y = w / a, h / b
        fits.append(F.least(x, 1 / x, y, 1 / y))
    return F.greatest(*fits) if len(fits) > 1 else fits[0]
