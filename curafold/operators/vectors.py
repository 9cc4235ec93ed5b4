"""Embeddings, scores and clusters over array columns."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fold(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def doubles(x: Column) -> Column:
    return F.transform(x, lambda v: v.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return _fold(F.zip_with(a, b, lambda x, y: x * y))


def l2_normalized(x: Column) -> Column:
    """Unit length; a zero vector stays."""
    length = F.sqrt(dot(x, x))
    return F.get(F.transform(F.array(F.when(length == 0, 1.0).otherwise(length)), lambda n: F.transform(x, lambda v: v / n)), F.lit(0))


def softmax(x: Column, scale: float = 1.0) -> Column:
    powers = F.transform(x, lambda v: F.exp((v - F.array_max(x)) * scale))
    return F.get(F.transform(F.array(powers), lambda p: F.transform(p, lambda v: v / _fold(p))), F.lit(0))


def mcut(scores: Column) -> Column:
    """The middle of the first widest gap between falling scores; null for fewer than two."""
    falling = F.sort_array(scores, asc=False)
    gaps = F.zip_with(F.slice(falling, 1, F.size(falling) - 1), F.slice(falling, 2, F.size(falling)), lambda a, b: F.struct((a - b).alias("gap"), ((a + b) / 2).alias("middle")))
    best = lambda g: F.aggregate(g, F.get(g, F.lit(0)), lambda a, x: F.when(x["gap"] > a["gap"], x).otherwise(a))
    return F.when(F.size(scores) > 1, F.get(F.transform(F.array(gaps), best), F.lit(0))["middle"])


def expectation(p: Column) -> Column:
    return _fold(F.transform(p, lambda v, i: v * (i + 1))) / _fold(p)


def running(x: Column) -> Column:
    step = lambda acc, v: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0.0)) + v))
    return F.aggregate(x, F.array().cast("array<double>"), step)


def emd_squares(p: Column, t: Column) -> Column:
    """Mean square of the difference of two distributions' running sums."""
    d = F.zip_with(running(p), running(t), lambda a, b: (a - b) * (a - b))
    return _fold(d) / F.size(p)


def moments(df: DataFrame, vector: str) -> DataFrame:
    """i, j, mean_i, mean_j, covariance of the vector's places, j >= i, over the rows that have both.

    Each task sums outer products of its rows around its own means and gives one row a pair of places; these
    are merged around the means of all, so no row is exploded and large means cost no digits."""

    def merge(a, b):
        n = np.where(a[0] + b[0], a[0] + b[0], 1)
        dx, dy = b[1] - a[1], b[2] - a[2]
        return [a[0] + b[0], a[1] + dx * b[0] / n, a[2] + dy * b[0] / n, a[3] + b[3] + dx * dy * a[0] * b[0] / n]

    def run(batches):
        held = None  # counts, means of i, means of j and co-moments, each a matrix over i, j
        for batch in batches:
            rows = [r or [] for r in batch.column(0).to_pylist()]
            width = max(map(len, rows), default=0)
            have = np.array([[v is not None for v in r] + [False] * (width - len(r)) for r in rows], dtype=float).reshape(len(rows), width)
            x = np.array([[v or 0.0 for v in r] + [0.0] * (width - len(r)) for r in rows]).reshape(len(rows), width)
            n = have.T @ have
            some = np.where(n, n, 1)
            middle = x.sum(axis=0) / np.maximum(have.sum(axis=0), 1)
            x = (x - middle) * have
            mx, my = x.T @ have / some, have.T @ x / some
            part = [n, mx + middle[:, None], my + middle, x.T @ x - n * mx * my]
            if held is not None:
                size = max(len(held[0]), width)
                held, part = ([np.pad(m, (0, size - len(m))) for m in ms] for ms in (held, part))
                part = merge(held, part)
            held = part
        if held is not None:
            i, j = np.triu_indices(len(held[0]))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype("i4")), pa.array(j.astype("i4")), *[pa.array(m[i, j]) for m in held]], ["i", "j", "n", "mx", "my", "c"])

    parts = df.select(doubles(F.col(vector)).alias("v")).mapInArrow(run, "i int, j int, n double, mx double, my double, c double").filter("n > 0")
    held = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("mean_i"), (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("mean_j"), F.collect_list(F.struct("n", "mx", "my", "c")).alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, q: a + q["c"] + q["n"] * (q["mx"] - F.col("mean_i")) * (q["my"] - F.col("mean_j")))
    return held.select("i", "j", "mean_i", "mean_j", F.when(F.col("n") > 1, total / (F.col("n") - 1)).alias("covariance"))


def body_embedding(persons: Column) -> Column:
    """34 numbers of the largest person of an array of (BBOX, INVLD_KPTS_IDX, KPTS_X, KPTS_Y), or null.

    Points are scaled by the square root of the box's area, centred on nose and shoulders (else hips, else
    the middle), and zero where invalid; more than 14 of the 17 body points invalid gives null."""
    size = lambda p: (p["BBOX"][2] - p["BBOX"][0]) * (p["BBOX"][3] - p["BBOX"][1])
    largest = F.array_max(F.transform(persons, lambda p, i: F.struct(size(p).alias("area"), i.alias("i"))))["i"]

    def embed(p: Column) -> Column:
        bad = lambda k: F.array_contains(p["INVLD_KPTS_IDX"], F.lit(k) if isinstance(k, int) else k)
        scale = F.sqrt(1 / size(p))

        def axis(points: Column, low: Column) -> Column:
            def place(v: Column) -> Column:
                mean = lambda *ks: sum((F.get(v, F.lit(k)) for k in ks[1:]), F.get(v, F.lit(ks[0]))) / len(ks)
                centre = F.when(~bad(0) & ~bad(5) & ~bad(6), mean(0, 5, 6)).when(~bad(11) & ~bad(12), mean(11, 12)).otherwise(0.5)
                return F.transform(v, lambda x, i: F.when(bad(i), 0.0).otherwise(x - centre))

            scaled = F.transform(F.slice(points, 1, 17), lambda x: (x - low) * scale)
            return F.get(F.transform(F.array(scaled), place), F.lit(0))

        usable = (F.size(F.filter(p["INVLD_KPTS_IDX"], lambda k: k < 17)) <= 14) & (size(p) > 0)
        return F.when(usable, F.concat(axis(p["KPTS_X"], p["BBOX"][0]), axis(p["KPTS_Y"], p["BBOX"][1])))

    return F.when(F.size(persons) > 0, F.get(F.transform(F.array(F.get(persons, largest)), embed), F.lit(0)))


def layout_embedding(boxes: Column) -> Column:
    """20 numbers of up to five large boxes (arrays x1, y1, x2, y2), left to right, or null if they span little."""
    size = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    most = F.array_max(F.transform(boxes, size))
    large = F.transform(F.filter(boxes, lambda b: size(b) > most * 0.3), lambda b: F.struct(size(b).alias("a"), b.alias("b")))
    five = F.transform(F.slice(F.sort_array(large, asc=False), 1, 5), lambda x: F.struct(((x["b"][0] + x["b"][2]) / 2).alias("cx"), ((x["b"][1] + x["b"][3]) / 2).alias("cy"), x["b"].alias("b")))

    def embed(row: Column) -> Column:
        side = lambda k: F.flatten(F.transform(row, lambda x: F.array(x["b"][k], x["b"][k + 2])))
        width, height = (F.array_max(side(k)) - F.array_min(side(k)) for k in (0, 1))
        scale = F.sqrt(1 / (width * height))

        def axis(k: int) -> Column:
            scaled = F.transform(side(k), lambda v: (v - F.array_min(side(k))) * scale)
            centred = F.get(F.transform(F.array(scaled), lambda s: F.transform(s, lambda v: v - _fold(s) / F.size(s))), F.lit(0))
            return F.slice(F.concat(centred, F.array_repeat(F.lit(0.0), 10)), 1, 10)

        return F.when(width * height >= 0.01, F.concat(axis(0), axis(1)))

    return F.get(F.transform(F.array(F.sort_array(five)), embed), F.lit(0))


def clustered(df: DataFrame, vector: str, k: int, method: str = "kmeans", seed: int = 42) -> tuple[DataFrame, float]:
    """df with lbl, and the fit's cost (kmeans) or minus its log likelihood (gmm)."""
    ready = df.withColumn("_features", array_to_vector(doubles(F.col(vector))))
    if method == "gmm":
        model = GaussianMixture(k=k, seed=seed, featuresCol="_features", predictionCol="lbl").fit(ready)
        cost = -model.summary.logLikelihood
    else:
        model = KMeans(k=k, seed=seed, maxIter=10_000, tol=1e-6, featuresCol="_features", predictionCol="lbl").fit(ready)
        cost = model.summary.trainingCost
    return model.transform(ready).drop("_features", "probability"), float(cost)


def cluster_costs(df: DataFrame, vector: str, ks: list[int]) -> DataFrame:
    """k, cost. A fit is hundreds of short passes, one after another; the fits are independent and run side by side."""
    fit = inheritable_thread_target(lambda k: (k, clustered(df, vector, k)[1]))
    with ThreadPoolExecutor(max(len(ks), 1)) as pool:
        rows = list(pool.map(fit, ks))
    return df.sparkSession.createDataFrame(rows, "k int, cost double")


__all__ = ["body_embedding", "cluster_costs", "clustered", "dot", "doubles", "emd_squares", "expectation", "l2_normalized", "layout_embedding", "mcut", "moments", "running", "softmax", "vector_to_array"]
