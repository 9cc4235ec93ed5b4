"""Image metrics, suppression and average precision against direct calculations."""

import numpy as np
from pyspark.sql import functions as F

from curafold.operators import evaluate as E
from curafold.operators import relational as R


def test_ssim_and_blocking():
    rng = np.random.default_rng(0)
    a = rng.uniform(0, 255, (40, 48))
    assert abs(E.ssim(a, a) - 1) < 1e-12 and E.ssim(a, 255 - a) < 0.1
    flat = np.full((32, 32), 100.0)
    assert E.blocking(flat) == 0 and E.psnr_b(flat, flat) == float("inf")
    steps = np.kron(rng.uniform(0, 255, (4, 4)), np.ones((8, 8)))  # changes on the grid only
    on = (np.diff(steps, axis=1)[:, 7::8] ** 2).sum() + (np.diff(steps, axis=0)[7::8] ** 2).sum()
    assert abs(E.blocking(steps) - 3 / 5 * on / (2 * 32 * 3)) < 1e-9


def test_frechet():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(5, 5)), rng.normal(size=(5, 5))
    x, y, m = a @ a.T, b @ b.T, rng.normal(size=5)
    assert abs(E.frechet(m, x, m, x)) < 1e-9
    values, vectors = np.linalg.eig(x @ y)
    root = np.trace((vectors * np.sqrt(values)) @ np.linalg.inv(vectors)).real
    assert abs(E.frechet(m, x, np.zeros(5), y) - ((m**2).sum() + np.trace(x) + np.trace(y) - 2 * root)) < 1e-6


def test_plain_suppression():
    boxes = np.array([[0, 0, 9, 9], [1, 1, 10, 10], [0, 0, 3, 3], [40, 40, 49, 49]], float)
    # the second covers the first and the third by more than 0.3 of their own areas; 6.25 % would not do
    assert E.plain_nms(boxes, np.array([0.5, 0.9, 0.4, 0.1])) == [1, 3]
    assert E.plain_nms(boxes[[0, 3]], np.array([0.5, 0.9])) == [1, 0]


def test_average_precision_by_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(int(c), float(s), int(t), i) for i, (c, s, t) in enumerate(zip(rng.integers(0, 3, 400), rng.integers(0, 50, 400) / 50, rng.random(400) < 0.6))]
    labels = {0: 100, 1: 300, 2: 90, 3: 5}
    got = {r.cls: r.ap for r in E.ap_per_class(spark.createDataFrame(rows, "cls long, conf double, tp int, id long"), spark.createDataFrame(list(labels.items()), "cls long, n_labels long")).collect()}
    for c, n in labels.items():
        own = sorted([(-s, i, t) for k, s, t, i in rows if k == c])
        hits = np.cumsum([t for *_, t in own])
        if not len(hits):
            assert got[c] == 0
            continue
        recall, precision = hits / n, hits / np.arange(1, len(hits) + 1)
        best = [max([p for r, p in zip(recall[k:], precision[k:], strict=True)]) for k in range(len(recall))]
        xs, ys = np.r_[0, recall, recall[-1] + 0.01], np.r_[1.0, best, 0.0]
        want = np.trapezoid(np.interp(np.linspace(0, 1, 101), xs, ys), np.linspace(0, 1, 101))
        assert abs(got[c] - want) < 1e-9, c


def test_draws_with_replacement_follow_weights(spark):
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(40)], "k long, w double")
    out = R.weighted_sample_wr(df, 20_000, "k", "w").groupBy("k").count().collect()
    share = {r.k: r["count"] / 20_000 for r in out}
    assert sum(r["count"] for r in out) == 20_000 and not any(k % 4 == 0 for k in share)
    assert all(abs(share.get(k, 0) - (k % 4) / 60) < 0.01 for k in range(40))


def test_epoch_shares_cover_all(spark):
    out = R.epoch_shares(spark.range(10), "id", 4, epoch=3).collect()
    assert len(out) == 12 and {r.id for r in out} == set(range(10))
    assert sorted((r["rank"], r.place) for r in out) == [(r, p) for r in range(4) for p in range(3)]
    assert [r.id for r in out] != [r.id for r in R.epoch_shares(spark.range(10), "id", 4, epoch=4).collect()]


def test_precision_recall_orders_ties_of_a_constant(spark):
    rows = [(0, 0.5, i % 2, i) for i in range(50)]
    out = E.precision_recall(spark.createDataFrame(rows, "cls long, conf double, tp int, id long"), spark.createDataFrame([(0, 25)], "cls long, n_labels long")).orderBy("n").collect()
    assert [r.n for r in out] == list(range(1, 51)) and abs(out[-1].recall - 1) < 1e-12


def test_mahalanobis_and_map(spark):
    from curafold.operators import regions as G

    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, v array<double>").repartition(3)
    got = {r.k: r.distance for r in G.distances(df, "k", "v").collect()}
    gap = x - x.mean(axis=0)
    want = np.sqrt(np.einsum("ij,jk,ik->i", gap, np.linalg.inv(np.cov(x.T)), gap))
    assert np.allclose([got[i] for i in range(60)], want)
    drawn = np.array([[r.p0, r.p1] for r in G.mapped(df, "k", "v").orderBy("k").collect()])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(np.abs(np.corrcoef(drawn[:, 0], x @ vectors[:, -1])[0, 1]), 1)


def test_hand_patch(spark):
    from curafold.operators import regions as G

    row = spark.createDataFrame([([0.0] * 5 + [0.1, 0.3, 0.2, 0.2], [0.0] * 5 + [0.1, 0.1, 0.2, 0.2], [0], [5, 6, 7])], "x array<double>, y array<double>, good array<int>, bad array<int>")
    found = row.select(G.hand_patch(F.col("x"), F.col("y"), F.col("good"), 5, 8).alias("p"), G.hand_patch(F.col("x"), F.col("y"), F.col("bad"), 5, 8).alias("q")).first()
    assert np.allclose(list(found.p), [0.0, -0.05, 0.4, 0.35]) and found.q is None


def test_smoothing_in_blocks(spark):
    from curafold.operators import sequences as S

    rng = np.random.default_rng(3)
    values = rng.normal(size=500).tolist()
    df = spark.createDataFrame([(i % 3, i, v if i % 50 else None) for i, v in enumerate(values)], "k int, t int, v double").repartition(4)
    got = {r.k: (r.n, r.last) for r in S.smoothed(df, "k", ["t"], "v", 0.9, block=7).collect()}
    for k in range(3):
        own = [v for i, v in enumerate(values) if i % 3 == k and i % 50]
        s = own[0]
        for v in own[1:]:
            s = s * 0.9 + v * (1 - 0.9)
        assert got[k][0] == len(own) and abs(got[k][1] - s) < 1e-12
