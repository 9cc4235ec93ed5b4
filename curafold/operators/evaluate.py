"""Histograms, detection metrics, distances between distributions and images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.boxes import iou


def bucket(x: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin from 1, the last one closed; null outside."""
    place = F.least(F.floor((x - low) / (high - low) * bins) + 1, F.lit(bins))
    return F.when((x >= low) & (x <= high), place).cast("int")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    return df.groupBy(bucket(F.col(column), low, high, bins).alias("bin")).agg(F.count("*").alias("n")).filter("bin IS NOT NULL")


def cumulative(hist: DataFrame) -> DataFrame:
    """A histogram's running share; it has a row a bin, so one window serves."""
    run, total = F.sum("n").over(W.orderBy("bin")), F.sum("n").over(W.partitionBy())
    return hist.select("bin", "n", (run / total).alias("share"))


def histogram_2d(df: DataFrame, x: str, y: str, ranges: tuple, bins: tuple[int, int]) -> DataFrame:
    bx, by = bucket(F.col(x), *ranges[0], bins[0]), bucket(F.col(y), *ranges[1], bins[1])
    return df.groupBy(bx.alias("bx"), by.alias("by")).agg(F.count("*").alias("n")).filter("bx IS NOT NULL AND by IS NOT NULL")


def matched(detections: DataFrame, labels: DataFrame, confidence: float = 0.25, overlap: float = 0.45) -> DataFrame:
    """One-to-one pairs in each image: by falling overlap first one label a detection, then one detection a label.

    detections: image, det, cls, conf, x1..y2; labels: image, lab, cls, x1..y2. An equi-join on the image."""
    d = detections.filter(F.col("conf") > confidence).select("image", "det", F.col("cls").alias("pred"), *[F.col(c).alias(f"d{c}") for c in ("x1", "y1", "x2", "y2")])
    t = labels.select("image", "lab", F.col("cls").alias("truth"), *[F.col(c).alias(f"l{c}") for c in ("x1", "y1", "x2", "y2")])
    box = lambda p: tuple(F.col(f"{p}{c}") for c in ("x1", "y1", "x2", "y2"))
    pairs = d.join(t, "image").withColumn("iou", iou(box("l"), box("d"))).filter(F.col("iou") > overlap)
    first = lambda df, by, ties: df.withColumn("_n", F.row_number().over(W.partitionBy("image", by).orderBy(F.desc("iou"), *ties))).filter("_n = 1").drop("_n")
    return first(first(pairs, "det", ["lab"]), "lab", ["det"]).select("image", "det", "lab", "pred", "truth", "iou")


def confusion(detections: DataFrame, labels: DataFrame, classes: int, confidence: float = 0.25, overlap: float = 0.45) -> DataFrame:
    """pred, truth, n; the class number `classes` is the background. Unmatched detections count only in images with a match."""
    pairs = matched(detections, labels, confidence, overlap)
    hit = pairs.select("pred", "truth")
    lost = labels.join(pairs.select("image", "lab"), ["image", "lab"], "left_anti").select(F.lit(classes).cast("long").alias("pred"), F.col("cls").alias("truth"))
    seen = detections.filter(F.col("conf") > confidence).join(pairs.select("image").distinct(), "image", "left_semi")
    false = seen.join(pairs.select("image", "det"), ["image", "det"], "left_anti").select(F.col("cls").alias("pred"), F.lit(classes).cast("long").alias("truth"))
    return hit.union(lost).union(false).groupBy("pred", "truth").agg(F.count("*").alias("n"))


def precision_recall(results: DataFrame, truths: DataFrame, ranges: int = 64) -> DataFrame:
    """cls, n, recall, precision along falling confidence. results: cls, conf, tp, id; truths: cls, n_labels.

    Confidences are cut at approximate quantiles; a task orders one range of one class, and ranges before it count as a sum."""
    found = results.agg(F.percentile_approx("conf", [k / ranges for k in range(1, ranges)], 10_000)).first()[0] or []
    cuts = F.array(*map(F.lit, sorted(set(found)))).cast("array<double>")
    cut = results.withColumn("_range", F.size(F.filter(cuts, lambda c: c > F.col("conf"))))
    earlier = W.partitionBy("cls").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    sums = cut.groupBy("cls", "_range").agg(F.count("*").alias("_n"), F.sum("tp").alias("_t"))  # at most `ranges` rows a class
    bases = sums.select("cls", "_range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in ("_n", "_t")])
    order = W.partitionBy("cls", "_range").orderBy(F.desc("conf"), "id")
    own = cut.withColumns({"_i": F.row_number().over(order), "_hits": F.sum("tp").over(order.rowsBetween(W.unboundedPreceding, 0))})
    run = own.join(bases, ["cls", "_range"]).withColumns({"n": F.col("_i") + F.col("_n0"), "tps": F.col("_hits") + F.col("_t0")})
    return run.join(truths, "cls").select("cls", "conf", "id", "n", (F.col("tps") / (F.col("n_labels") + 1e-16)).alias("recall"), (F.col("tps") / F.col("n")).alias("precision"))


#: Places of recall at which the curve is read.
GRID = 101


def ap_per_class(results: DataFrame, truths: DataFrame) -> DataFrame:
    """cls, ap: the area under the best precision reached at each recall or beyond, read at GRID places with straight lines between points.

    A curve has at most as many recalls as labels. Each gives the best precision from it on (what a line to it ends at) and
    from its last row on (what a line from it starts at), by a running maximum from the right. Before the first
    recall above 0 the curve starts at precision 1; a hundredth after the last recall it has fallen to 0."""
    points = precision_recall(results, truths).groupBy("cls", "recall").agg(F.max("precision").alias("high"), F.min("precision").alias("low"))
    ends = points.groupBy("cls").agg(F.max("recall").alias("last"), F.min("recall").alias("first"))
    start = ends.filter("first > 0").select("cls", F.lit(0.0), F.lit(1.0), F.lit(1.0))
    curve = points.union(start).union(ends.select("cls", F.col("last") + 0.01, F.lit(0.0), F.lit(0.0)))
    beyond = F.coalesce(F.max("high").over(W.partitionBy("cls").orderBy(F.desc("recall")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    best = curve.withColumn("_b", beyond).select("cls", "recall", F.greatest("high", "_b").alias("to"), F.greatest("low", "_b").alias("from"))
    after = lambda c: F.lead(c).over(W.partitionBy("cls").orderBy("recall"))
    lines = best.select("cls", F.col("recall").alias("r0"), F.col("from").alias("p0"), after("recall").alias("r1"), after("to").alias("p1")).filter("r1 IS NOT NULL")
    place = lambda r: F.ceil(r * (GRID - 1) - 1e-9)
    read = lines.withColumns({"_a": place(F.col("r0")), "_z": F.least(place(F.col("r1")) - 1, F.lit(GRID - 1))}).filter("_z >= _a")
    at = read.select("cls", "r0", "p0", "r1", "p1", F.explode(F.sequence("_a", "_z")).alias("g"))
    height = F.col("p0") + (F.col("p1") - F.col("p0")) * (F.col("g") / (GRID - 1) - F.col("r0")) / (F.col("r1") - F.col("r0"))
    areas = at.groupBy("cls").agg((F.sum(height * F.when(F.col("g").isin(0, GRID - 1), 0.5).otherwise(1.0)) / (GRID - 1)).alias("ap"))
    return truths.select("cls").join(areas, "cls", "left").fillna(0.0, ["ap"])


def normalised(counts: DataFrame) -> DataFrame:
    """A confusion table's counts as shares of their true class."""
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("truth")))


def fitness(*metrics: Column) -> Column:
    """Precision, recall, AP at 0.5 and AP weighed 0, 0, 0.1 and 0.9."""
    return metrics[2] * 0.1 + metrics[3] * 0.9


def greedy(starts: np.ndarray, rows: int, goes, most: int | None = None) -> np.ndarray:
    """Which of a number of rows are kept, group by group: the first row is, and those that go because of it are out, and so on, `most` times.

    starts: the place of each group's first row; goes(k, i): whether the rows at places k go because of those at i. A round
    takes one row of every group that has any left, so its cost is shared by all groups."""
    kept, left = np.zeros(rows, dtype=bool), np.arange(rows)
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=rows))
    rounds = 0
    while len(left) and rounds != most:
        first = np.diff(group[left], prepend=-1) != 0
        best = left[first]
        kept[best] = True
        i, left = best[np.cumsum(first) - 1][~first], left[~first]
        left = left[~goes(left, i)]
        rounds += 1
    return kept


def _sides(boxes: np.ndarray):
    return [np.ascontiguousarray(boxes[:, k], dtype=float) for k in range(4)]


def _covers(boxes: np.ndarray, overlap: float):
    """goes() on whole pixels: the first box is covered by more than `overlap` of its area."""
    x1, y1, x2, y2 = _sides(boxes)
    sizes = (x2 - x1 + 1) * (y2 - y1 + 1)
    side = lambda low, high, k, i: np.clip(np.minimum(high[k], high[i]) - np.maximum(low[k], low[i]) + 1, 0, None)

    def goes(k, i):
        with np.errstate(all="ignore"):
            return ~(side(x1, x2, k, i) * side(y1, y2, k, i) / sizes[k] <= overlap)

    return goes


def _overlaps(boxes: np.ndarray, overlap: float):
    """goes() by intersection over union."""
    x1, y1, x2, y2 = _sides(boxes)
    sizes = (x2 - x1) * (y2 - y1)
    side = lambda low, high, k, i: np.clip(np.minimum(high[k], high[i]) - np.maximum(low[k], low[i]), 0, None)

    def goes(k, i):
        with np.errstate(all="ignore"):
            both = side(x1, x2, k, i) * side(y1, y2, k, i)
            return both / (sizes[k] + sizes[i] - both) > overlap

    return goes


def _boxes(g: dict) -> np.ndarray:
    return np.column_stack([g[c] for c in ("x1", "y1", "x2", "y2")]).astype(float)


def plain_nms(boxes: np.ndarray, scores: np.ndarray, overlap: float = 0.3) -> list[int]:
    """Places kept, best first, on whole pixels: a box goes if a kept one covers more than `overlap` of it. Later rows win ties."""
    order = np.lexsort((np.arange(len(scores)), scores))[::-1]
    return order[greedy(np.array([0]), len(order), _covers(boxes[order], overlap))].tolist()


def suppress_plain(detections: DataFrame, overlap: float = 0.3) -> DataFrame:
    """Detections that survive plain_nms in each image, whatever their class."""

    def run(g: dict, starts: np.ndarray) -> dict:
        kept = greedy(starts, len(g["conf"]), _covers(_boxes(g), overlap))
        return {c: x[kept] for c, x in g.items()}

    best = F.desc(F.coalesce(F.col("conf").cast("double"), F.lit(float("nan"))))
    return by_group(detections, ["image"], [best, F.desc("det")], run, detections.schema.simpleString()[7:-1].replace(":", " "))


def blocking(image: np.ndarray, block: int = 8) -> float:
    """Blocking-effect factor of a grey image: how much more neighbours differ across the lines of a block grid than elsewhere, in mean squares."""
    height, width = image.shape
    across, down = np.diff(image, axis=1) ** 2, np.diff(image, axis=0) ** 2
    lines = [np.arange(n - 1) % block == block - 1 for n in (width, height)]
    on = across[:, lines[0]].sum() + down[lines[1]].sum()
    off = across[:, ~lines[0]].sum() + down[~lines[1]].sum()
    counts = height * (width / block - 1) + width * (height / block - 1)
    every = height * (width - 1) + width * (height - 1)
    on, off = on / counts, off / (every - counts)
    return float(np.log2(block) / np.log2(min(height, width)) * (on - off)) if on > off else 0.0


def psnr_b(a: np.ndarray, b: np.ndarray, peak: float = 255.0) -> float:
    """Peak signal-to-noise ratio of b against a, with b's blocking effect as further noise."""
    noise = float(((a - b) ** 2).mean()) + blocking(b)
    return float("inf") if noise == 0 else float(10 * np.log10(peak**2 / noise))


def ssim(a: np.ndarray, b: np.ndarray, peak: float = 255.0, size: int = 11, sigma: float = 1.5) -> float:
    """Structural similarity of two grey images: local means and variances under a Gaussian window, where it fits whole."""
    from numpy.lib.stride_tricks import sliding_window_view

    g = np.exp(-((np.arange(size) - size // 2) ** 2) / (2 * sigma**2))
    window = np.outer(g, g) / g.sum() ** 2
    local = lambda x: np.einsum("ijkl,kl->ij", sliding_window_view(x, (size, size)), window)
    ma, mb = local(a), local(b)
    va, vb, both = local(a * a) - ma**2, local(b * b) - mb**2, local(a * b) - ma * mb
    c1, c2 = (0.01 * peak) ** 2, (0.03 * peak) ** 2
    return float((((2 * ma * mb + c1) * (2 * both + c2)) / ((ma**2 + mb**2 + c1) * (va + vb + c2))).mean())


def frechet(mean_a: np.ndarray, cov_a: np.ndarray, mean_b: np.ndarray, cov_b: np.ndarray) -> float:
    """Distance between two Gaussians; the trace of the root of the product comes from the eigenvalues of a symmetric form."""
    values, vectors = np.linalg.eigh(cov_a)
    root = (vectors * np.sqrt(np.clip(values, 0, None))) @ vectors.T
    middle = np.sqrt(np.clip(np.linalg.eigvalsh(root @ cov_b @ root), 0, None)).sum()
    return float(((mean_a - mean_b) ** 2).sum() + np.trace(cov_a) + np.trace(cov_b) - 2 * middle)


METRICS = {"psnr_b": psnr_b, "ssim": ssim}


def nms(boxes: np.ndarray, scores: np.ndarray, overlap: float, most: int = 300) -> list[int]:
    """Places kept, best first: a box goes if it overlaps a kept one by more than `overlap`."""
    order = np.argsort(-scores, kind="stable")
    return order[greedy(np.array([0]), len(order), _overlaps(boxes[order], overlap), most)].tolist()


#: Rows that by_group gives to one call, at least.
CALL_ROWS = 200_000


def by_group(df: DataFrame, keys: list[str], order: list, run, schema: str) -> DataFrame:
    """run(columns of some whole groups as arrays, in order, and the places of the groups' first rows) gives a dict of result
    arrays, or None. Groups are streamed from sorted partitions, many a call; a group that goes over a call's end waits for the rest."""

    def stream(batches):
        def called(pdf, last):
            starts = np.flatnonzero(pdf[keys].ne(pdf[keys].shift()).any(axis=1).to_numpy())
            stop = len(pdf) if last else int(starts[-1])
            out = run({c: pdf[c].to_numpy()[:stop] for c in pdf.columns}, starts[starts < stop]) if stop else None
            return None if out is None else pd.DataFrame(out), pdf.iloc[stop:]

        held, rows, enough = [], 0, CALL_ROWS
        for pdf in batches:
            held.append(pdf)
            rows += len(pdf)
            if rows >= enough:
                out, rest = called(pd.concat(held, ignore_index=True), False)
                held, rows, enough = [rest], len(rest), max(CALL_ROWS, 2 * len(rest))
                if out is not None:
                    yield out
        if rows:
            out, _ = called(pd.concat(held, ignore_index=True), True)
            if out is not None:
                yield out

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(stream, schema)


def suppress(detections: DataFrame, overlap: float = 0.45, confidence: float = 0.25, most: int = 300) -> DataFrame:
    """Detections that survive greedy suppression in each image and class, at most `most` of an image."""

    def run(g: dict, starts: np.ndarray) -> dict:
        n, cls = len(g["conf"]), pd.Series(g["cls"])
        new = cls.ne(cls.shift()).to_numpy()
        new[starts] = True
        kept = np.flatnonzero(greedy(np.flatnonzero(new), n, _overlaps(_boxes(g), overlap), most))
        image = np.searchsorted(starts, kept, side="right")
        many = np.bincount(image, minlength=len(starts) + 1) > most
        if many.any():
            rank = pd.DataFrame({"i": image, "conf": g["conf"][kept], "det": g["det"][kept]})[many[image]]
            rank = rank.sort_values(["conf", "det"], ascending=[False, True], na_position="first", kind="stable").groupby("i").cumcount()
            kept = np.delete(kept, rank.index[rank >= most].to_numpy())
        return {c: x[kept] for c, x in g.items()}

    sure = detections.filter(F.col("conf") > confidence)
    best = F.desc(F.when(~F.isnan("conf"), F.col("conf")))  # in its class, what is no number comes last
    return by_group(sure, ["image"], ["cls", best, "det"], run, sure.schema.simpleString()[7:-1].replace(":", " "))


def assignments(cost: np.ndarray) -> np.ndarray:
    """The column of each row, or -1, in the one-to-one pairs of the least total cost, for each of many problems of one shape
    (shortest augmenting paths with potentials). cost: problems, rows, columns. The problems take their steps together."""
    many, rows, cols = cost.shape
    if rows > cols:
        flipped, out = assignments(cost.transpose(0, 2, 1)), np.full((many, rows), -1)
        out[np.arange(many)[:, None], flipped] = np.arange(cols)
        return out
    u, v = np.zeros((many, rows)), np.zeros((many, cols))
    owner, mate = np.full((many, cols), -1), np.full((many, rows), -1)
    for start in range(rows):
        shortest, via, done = np.full((many, cols), np.inf), np.full((many, cols), -1), np.zeros((many, cols), dtype=bool)
        low, sink = np.zeros(many), np.full(many, -1)
        live, i = np.arange(many), np.full(many, start)
        while len(live):
            gap = low[live, None] + cost[live, i] - u[live, i][:, None] - v[live]
            near, closed = shortest[live], done[live]
            better = ~closed & (gap < near)
            near = np.where(better, gap, near)
            shortest[live], via[live] = near, np.where(better, i[:, None], via[live])
            j = np.where(closed, np.inf, near).argmin(axis=1)
            low[live], done[live, j] = near[np.arange(len(live)), j], True
            taken = owner[live, j]
            sink[live] = j
            live, i = live[taken >= 0], taken[taken >= 0]
        u[:, start] += low
        p, j = np.nonzero(done & (owner >= 0))
        u[p, owner[p, j]] += low[p] - shortest[p, j]
        p, j = np.nonzero(done)
        v[p, j] -= low[p] - shortest[p, j]
        p, j = np.arange(many), sink
        while len(p):
            i = via[p, j]
            before = mate[p, i]
            owner[p, j], mate[p, i] = i, j
            p, j = p[i != start], before[i != start]
    return mate


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of rows and columns of the least total cost."""
    return [(i, int(j)) for i, j in enumerate(assignments(cost[None])[0]) if j >= 0]


#: Costs that attach holds at once, unless one image has more.
COSTS = 2_000_000


def attach(parts: DataFrame, instances: DataFrame) -> DataFrame:
    """image, part, instance, distance: the one-to-one assignment of the least total distance in each image.

    A point without both coordinates has no distance to any other and is not attached."""

    def run(g: dict, starts: np.ndarray) -> dict | None:
        x, y = g["x"].astype(float), g["y"].astype(float)
        n = np.add.reduceat((g["side"] == 0).astype(int), starts)
        shape = np.column_stack([n, np.diff(starts, append=len(x)) - n])
        found = []
        for a, b in np.unique(shape[shape.min(axis=1) > 0], axis=0).tolist():
            same = starts[(shape == (a, b)).all(axis=1)]
            step = max(1, COSTS // (a * b))
            for own in (same[k : k + step] for k in range(0, len(same), step)):
                p, q = own[:, None] + np.arange(a), own[:, None] + a + np.arange(b)
                cost = np.hypot(x[p][:, :, None] - x[q][:, None, :], y[p][:, :, None] - y[q][:, None, :])
                column = assignments(cost)
                k, i = np.nonzero(column >= 0)
                j = column[k, i]
                found.append((p[k, i], q[k, j], cost[k, i, j]))
        if not found:
            return None
        p, q, distance = map(np.concatenate, zip(*found, strict=True))
        return {"image": g["image"][p], "part": g["id"][p], "instance": g["id"][q], "distance": distance}

    columns = ["image", "id", "x", "y"]
    both = parts.select(*columns, F.lit(0).alias("side")).union(instances.select(*columns, F.lit(1)))
    placed = both.filter(~F.isnan(F.coalesce(F.col("x").cast("double") + F.col("y").cast("double"), F.lit(float("nan")))))
    return by_group(placed, ["image"], ["side", "id"], run, "image long, part long, instance long, distance double")


def mean(x: Column) -> Column:
    """An average that the order of the rows does not change: the sum of multiples of 2^-20 is exact while it stays under
    2^33, and what the multiples leave is so small that its own sum's errors don't reach the result. Nulls don't count."""
    small = F.abs(x) < float(2**32)
    coarse = F.when(small, F.rint(x * float(2**20)) / float(2**20)).otherwise(x)
    return (F.sum(coarse) + F.sum(F.when(small, x - coarse).otherwise(0.0))) / F.count(x)


def psnr(mse: Column, peak: float = 255.0) -> Column:
    return F.when(mse == 0, F.lit(float("inf"))).otherwise(10 * F.log10(F.lit(peak**2) / mse))


def charbonnier(a: Column, b: Column, eps: float = 1e-12) -> Column:
    return F.sqrt((a - b) ** 2 + eps)


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks. Ranks come from counts of different values, not from a window over rows."""

    def average_rank(c: str) -> DataFrame:
        n = df.groupBy(c).agg(F.count("*").alias("_n"))
        from .relational import ranked

        ordered = ranked(n, F.col(c), c, name="_r").withColumn("_b", F.floor(F.col("_r") / 4096))
        base = F.coalesce(F.sum("t").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        bases = ordered.groupBy("_b").agg(F.sum("_n").alias("t")).select("_b", base.alias("_base"))
        run = F.sum("_n").over(W.partitionBy("_b").orderBy("_r"))
        return ordered.withColumn("_c", run).join(bases, "_b").select(c, (F.col("_c") + F.col("_base") - (F.col("_n") - 1) / 2).alias(f"_rank_{c}"))

    return df.join(average_rank(x), x).join(average_rank(y), y).agg(F.corr(f"_rank_{x}", f"_rank_{y}").alias("spearman"))
