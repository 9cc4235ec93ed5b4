"""Queries on more rows of a key, larger groups and odd rows than the small tables have."""

import itertools
import math
import sys
import threading
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import numpy as np
from compare import differences

from curafold.catalogue import QUERIES, SQL
from curafold.operators import evaluate as E
from curafold.operators import vectors as V


def test_psnr_rows_of_large_groups(spark, tmp_path):
    # the mean of 60 times d + 5e-13 / d and 60 times 1e-6 lies a few units of the last place above the middle of two rounded values
    rows = [(d, 1, 7.0 + x) for d in range(10, 43) for x in [d] * 60 + [0] * 60]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {r.l_orderkey: r for r in QUERIES["psnr_rows"](spark, str(tmp_path)).collect()}
    for d in range(10, 43):
        exact = math.fsum(math.sqrt(x * x + 1e-12) for x in (0, d) for _ in range(60)) / 120
        assert (got[d].charbonnier, got[d].l1, got[d].mse) == (round(exact, 6), d / 2, d * d / 2), d


def test_crop_candidates_are_compared_in_their_rows(spark, tmp_path):
    # sizes too small for one or both scales, no size, no key, and a key with several sizes
    rows = [(k, n) for k, n in enumerate(range(-30, 60))] + [(5, 49), (5, 20), (5, None), (None, 7), (None, 9), (200, None)]
    spark.createDataFrame(rows, "p_partkey long, p_size int").write.parquet(str(tmp_path / "part.parquet"))
    assert not differences(spark, str(tmp_path), "crop_candidates", QUERIES["crop_candidates"], SQL["crop_candidates"])
    plan = QUERIES["crop_candidates"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # no row for each window, so none is sorted


def _detections(rng, n, images):
    low = rng.integers(0, 30, (n, 2))
    boxes = np.column_stack([low, low + rng.integers(1, 25, (n, 2))]).astype(float).tolist()
    return [(int(i), k, int(c), float(s), *b) for k, (i, c, s, b) in enumerate(zip(rng.integers(0, images, n), rng.integers(0, 3, n), rng.integers(1, 20, n) / 20, boxes, strict=True))]


_DETECTIONS = "image long, det long, cls long, conf double, x1 double, y1 double, x2 double, y2 double"


def test_images_take_their_suppression_together(spark):
    rows = _detections(np.random.default_rng(6), 2000, 300)
    rounds = []
    goes = lambda k, i: rounds.append(len(k)) or np.zeros(len(k), dtype=bool)
    starts = np.arange(0, 9000, 3)
    assert E.greedy(starts, 9000, goes).all() and rounds == [6000, 3000, 0]  # a round for all groups, not one for each
    first = E.greedy(starts, 9000, goes, 2)
    assert np.flatnonzero(~first).tolist() == list(range(2, 9000, 3))
    want = set()
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r[0], r[2], -r[3], r[1])), key=lambda r: (r[0], r[2])):
        kept = []
        for r in own:
            area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
            both = lambda a, b: max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0)
            if r[3] > 0.25 and all(both(r[4:], k[4:]) / (area(r[4:]) + area(k[4:]) - both(r[4:], k[4:])) <= 0.45 for k in kept):
                kept.append(r)
        want |= set(kept)
    assert sorted(map(tuple, E.suppress(spark.createDataFrame(rows, _DETECTIONS)).collect())) == sorted(want)


def test_at_most_so_many_boxes_of_an_image(spark):
    rows = [(i, k, k % 3, (k % 50 + 20) / 80, 20.0 * k, 0.0, 20.0 * k + 9, 9.0) for i in (1, 2) for k in range(400 if i == 1 else 30)]
    want = [r for i in (1, 2) for r in sorted((r for r in rows if r[0] == i and r[3] > 0.25), key=lambda r: (-r[3], r[1]))[:25]]
    assert sorted(map(tuple, E.suppress(spark.createDataFrame(rows, _DETECTIONS), most=25).collect())) == sorted(want)


def test_groups_longer_than_a_call(spark):
    run = lambda g, starts: {"k": g["k"][starts], "n": np.add.reduceat(g["id"] * 0 + 1, starts)}
    sizes = {0: 3, 1: E.CALL_ROWS * 2 + 7, 2: 1, 3: E.CALL_ROWS - 1}
    df = spark.range(E.CALL_ROWS * 4).selectExpr("id", f"CASE WHEN id < 3 THEN 0 WHEN id < {3 + sizes[1]} THEN 1 WHEN id < {4 + sizes[1]} THEN 2 ELSE 3 END AS k").filter(f"id < {sum(sizes.values())}")
    assert {r.k: r.n for r in E.by_group(df, ["k"], ["id"], run, "k int, n long").collect()} == sizes


def test_fits_run_side_by_side(spark, monkeypatch):
    together = threading.Barrier(3, timeout=20)
    monkeypatch.setattr(V, "clustered", lambda df, vector, k: (together.wait(), float(k)))
    assert [tuple(r) for r in V.cluster_costs(spark.range(3), "v", [2, 4, 8]).collect()] == [(2, 2.0), (4, 4.0), (8, 8.0)]


def test_images_of_one_shape_are_assigned_together(spark):
    rng = np.random.default_rng(7)
    for rows, cols in itertools.product(range(1, 5), repeat=2):
        cost = rng.integers(0, 6, (40, rows, cols)).astype(float)  # many ties
        for c, own in zip(cost, E.assignments(cost), strict=True):
            pairs = [(i, int(j)) for i, j in enumerate(own) if j >= 0]
            flat = c if rows <= cols else c.T
            best = min(sum(flat[i, p[i]] for i in range(len(flat))) for p in itertools.permutations(range(flat.shape[1]), len(flat)))
            assert len({j for _, j in pairs}) == len(pairs) == min(rows, cols) and sum(c[p] for p in pairs) == best


def test_points_without_a_place_are_not_attached(spark):
    parts = [(1, 10, 0.0, 0.0), (1, 11, None, 1.0), (1, 12, 5.0, 0.0), (2, 13, 1.0, None), (3, 14, 0.0, 0.0), (4, 15, 0.0, float("nan"))]
    instances = [(1, 20, 5.0, 1.0), (1, 21, 0.0, 2.0), (1, 22, None, None), (2, 23, 0.0, 0.0), (4, 24, 0.0, 0.0), (5, 25, 0.0, 0.0)]
    points = lambda rows: spark.createDataFrame(rows, "image long, id long, x double, y double")
    assert sorted(map(tuple, E.attach(points(parts), points(instances)).collect())) == [(1, 10, 21, 2.0), (1, 12, 20, 1.0)]


def test_images_take_their_plain_suppression_together(spark):
    rows = _detections(np.random.default_rng(8), 1500, 200)
    calls = []
    covers = E._covers(np.array([r[4:] for r in rows]), 0.3)
    E.greedy(np.arange(0, 1500, 5), 1500, lambda k, i: calls.append(len(k)) or covers(k, i))
    assert calls[0] == 1200 and len(calls) <= 5  # a call a round, for all groups
    want = []
    for _, own in itertools.groupby(sorted(rows, key=lambda r: (r[0], -r[3], -r[1])), key=lambda r: r[0]):
        kept = []
        for r in own:
            side = lambda k, c: max(min(r[k + 2], c[k + 2]) - max(r[k], c[k]) + 1, 0)  # noqa: B023, E731
            if all(side(4, c) * side(5, c) / ((r[6] - r[4] + 1) * (r[7] - r[5] + 1)) <= 0.3 for c in kept):
                kept.append(r)
        want += kept
    assert sorted(map(tuple, E.suppress_plain(spark.createDataFrame(rows, _DETECTIONS)).collect())) == sorted(want)
