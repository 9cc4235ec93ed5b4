"""Regions, points and grids: crops, patches, orders of persons, hands, heat maps, thinning of dense points."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.boxes import Box, centred, clipped, corners
from .vectors import doubles, moments


def padded_crop(box: Box, width: float, height: float, scale: float = 1.2, pixels: float = 3.0) -> Box:
    """A box enlarged around its middle by a factor and some pixels, within the image."""
    x, y, w, h = centred(box)
    return clipped(corners(x, y, w * scale + pixels, h * scale + pixels), width, height)


def starts(side: Column, size: int, overlap: int) -> Column:
    """Where overlapping patches begin along a side; the last one ends at the border."""
    last = side - size
    regular = F.when(last > 0, F.sequence(F.lit(0), last - 1, F.lit(size - overlap))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.concat(regular, F.array(F.greatest(last, F.lit(0)))))


def patches(images: DataFrame, size: int = 512, overlap: int = 96, least: int = 800) -> DataFrame:
    """images (w, h and keys) with x, y, pw, ph of each patch; an image with a side of at most `least` is one patch."""
    large = (F.col("w") > least) & (F.col("h") > least)
    whole = F.array(F.lit(0))
    xs, ys = (F.when(large, starts(F.col(c), size, overlap)).otherwise(whole) for c in ("w", "h"))
    rows = images.withColumn("x", F.explode(xs)).withColumn("y", F.explode(ys))
    return rows.withColumns({"pw": F.when(large, size).otherwise(F.col("w")), "ph": F.when(large, size).otherwise(F.col("h"))})


def best_crop(images: DataFrame, keys: list[str], width: float, height: float, scales: list[float], step: int, score: Callable[..., Column]) -> DataFrame:
    """keys, scale, x, y and score of the first best window of each image (w, h and keys), of those of the given sides, at each scale and step, that lie inside.

    score is a function of a window's x, y, cw, ch and scale. A row's windows are compared in the row: what is dealt and
    sorted is one window a row, not the grid. The first comes from the largest scale, then from the least y, then x."""

    def best(scale: float) -> Column:
        cw, ch = scale * width, scale * height
        along = lambda side, own: F.sequence(F.lit(0), F.greatest(F.floor(F.col(side) - own).cast("int"), F.lit(0)), F.lit(step))
        window = lambda x, y: F.struct((-score(x, y, F.lit(cw), F.lit(ch), F.lit(scale))).alias("s"), F.lit(-scale).alias("scale"), y.alias("y"), x.alias("x"))
        found = F.array_min(F.transform(along("h", ch), lambda y: F.array_min(F.transform(along("w", cw), lambda x: window(x, y)))))
        return F.when((F.col("w") >= cw) & (F.col("h") >= ch), found)

    dealt = images.repartition(*keys, "w", "h")  # a small file's rows make many windows
    own = dealt.select(*keys, F.array_min(F.array(*[best(float(k)) for k in scales])).alias("_b"))
    first = own.groupBy(*keys).agg(F.min("_b").alias("b")).filter("b IS NOT NULL")
    return first.select(*keys, (-F.col("b.scale")).alias("scale"), "b.x", "b.y", (-F.col("b.s")).alias("score"))


def left_to_right(boxes: Column) -> Column:
    """An array of boxes (arrays of four) in the order of their middles, by x, then y."""
    keyed = F.transform(boxes, lambda b: F.struct(((b[0] + b[2]) / 2).alias("x"), ((b[1] + b[3]) / 2).alias("y"), b.alias("b")))
    return F.transform(F.array_sort(keyed), lambda k: k["b"])


def hand_patch(xs: Column, ys: Column, invalid: Column, first: int, last: int) -> Column:
    """(x1, y1, x2, y2) around a hand's points first..last, or null: more than three valid points, and not tiny.

    The square's half side is the longer side of the points' box, around their mean."""
    valid = F.filter(F.sequence(F.lit(first), F.lit(last)), lambda k: ~F.array_contains(invalid, k))

    def around(ks: Column) -> Column:
        x, y = (F.transform(ks, _reader(c)) for c in (xs, ys))
        span = lambda v: F.array_max(v) - F.array_min(v)
        mean = lambda v: F.aggregate(v, F.lit(0.0), lambda a, e: a + e) / F.size(v)
        half = F.greatest(span(x), span(y))
        box = F.struct((mean(x) - half).alias("x1"), (mean(y) - half).alias("y1"), (mean(x) + half).alias("x2"), (mean(y) + half).alias("y2"))
        return F.when((F.size(ks) > 3) & (span(x) * span(y) > 1e-5), box)

    return F.get(F.transform(F.array(valid), around), F.lit(0))


def _reader(values: Column):
    return lambda k: F.get(values, k)


def peak(heat: Column, width: int) -> Column:
    """(x, y, score) of the first highest place of a heat map in rows of `width`."""
    best = F.array_max(heat)
    at = F.array_position(heat, best) - 1
    return F.struct((at % width).cast("int").alias("x"), F.floor(at / width).cast("int").alias("y"), best.alias("score"))


def thinned(points: DataFrame, x: str, y: str, cell: float, *order: str) -> DataFrame:
    """The first point of each cell of a grid, so that drawn points don't lie on one another."""
    first = F.row_number().over(W.partitionBy(F.floor(F.col(x) / cell), F.floor(F.col(y) / cell)).orderBy(*order))
    return points.withColumn("_n", first).filter("_n = 1").drop("_n")


def variation(values: Column, width: int) -> Column:
    """Sum of absolute differences between neighbours of an image in rows of `width`."""
    gaps = F.transform(values, lambda v, i: F.when((i + 1) % width != 0, F.abs(F.coalesce(F.get(values, i + 1), v) - v)).otherwise(0.0) + F.abs(F.coalesce(F.get(values, i + width), v) - v))
    return F.aggregate(gaps, F.lit(0.0), lambda a, v: a + v)


def cubic(x: Column) -> Column:
    """The cubic kernel of resampling (a = -1/2), 0 beyond 2."""
    d = F.abs(x)
    near, far = 1.5 * d * d * d - 2.5 * d * d + 1, -0.5 * d * d * d + 2.5 * d * d - 4 * d + 2
    return F.when(d <= 1, near).when(d <= 2, far).otherwise(0.0)


def moved(box: Box, matrix: list[list[float]]) -> Box:
    """The box around a box's corners after a perspective transform."""
    xs, ys = [], []
    for px, py in ((box[0], box[1]), (box[2], box[1]), (box[2], box[3]), (box[0], box[3])):
        x, y, z = (row[0] * px + row[1] * py + row[2] for row in matrix)
        xs.append(x / z)
        ys.append(y / z)
    return F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys)


def flipped(box: Box, width: float) -> Box:
    return width - box[2], box[1], width - box[0], box[3]


def distances(df: DataFrame, key: str, vector: str) -> DataFrame:
    """key, distance: each row's Mahalanobis distance from the mean of all; what reaches the driver is the covariance, by the vector's length only."""
    rows = moments(df, vector).collect()
    n = max((r.j for r in rows), default=-1) + 1
    mean, cov = np.zeros(n), np.zeros((n, n))
    for r in rows:
        mean[r.i], mean[r.j] = r.mean_i, r.mean_j
        cov[r.i, r.j] = cov[r.j, r.i] = r.covariance or 0.0
    inverse = np.linalg.pinv(cov)

    def run(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), dtype=float).reshape(len(batch), n) - mean
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.sqrt(np.einsum("ij,jk,ik->i", x, inverse, x)))], [key, "distance"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, doubles(F.col(vector)).alias("v")).mapInArrow(run, f"{key} {kind}, distance double")


def mapped(df: DataFrame, key: str, vector: str, seed_dims: int = 2) -> DataFrame:
    """key and the first principal components of a vector column, for maps of clusters."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    ready = df.select(key, array_to_vector(doubles(F.col(vector))).alias("_v"))
    model = PCA(k=seed_dims, inputCol="_v", outputCol="_p").fit(ready)
    return model.transform(ready).select(key, *[vector_to_array("_p")[k].alias(f"p{k}") for k in range(seed_dims)])
