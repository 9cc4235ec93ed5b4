"""Queries work on their whole tables."""

import collections

from curafold.catalogue import QUERIES
from curafold.operators import vectors
from curafold.operators.vectors import moments

FOLDER = "/root/testdata/sf0.001"


def test_all_boxes_are_attached(spark):
    rows = QUERIES["hungarian_attach"](spark, FOLDER).collect()
    det = "l_linenumber * 1000000000000 + l_partkey * 1000000 + l_suppkey"
    want = collections.Counter(map(tuple, spark.read.parquet(f"{FOLDER}/lineitem.parquet").selectExpr("l_orderkey", det).collect()))  # a few lines are repeated
    assert collections.Counter((r.image, r.part) for r in rows) == collections.Counter((r.image, r.instance) for r in rows) == want
    own = collections.Counter()  # the cost of each box with its own label: x + 1, y + det % 3
    for r in rows:
        own[r.image] += (1 + (r.part % 3) ** 2) ** 0.5 - r.distance
    assert min(own.values()) > -1e-9


def test_all_places_of_vectors(spark):
    n = spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    assert QUERIES["explode_detections"](spark, FOLDER).count() == 64 * n
    stats = QUERIES["mvg_stats"](spark, FOLDER).collect()
    assert len(stats) == 2080 and all(r.mean_i is not None and r.mean_j is not None for r in stats)


def test_moments_of_ragged_vectors(spark):
    rows = [([1e8 + 1, 2.0, None],), ([1e8 + 3, 5.0],), ([1e8 + 8, None, 4.0],), (None,), ([],)]
    got = {(r.i, r.j): (r.mean_i, r.mean_j, r.covariance) for r in moments(spark.createDataFrame(rows, "v array<double>").repartition(3), "v").collect()}
    assert got == {(0, 0): (1e8 + 4, 1e8 + 4, 13.0), (0, 1): (1e8 + 2, 3.5, 3.0), (0, 2): (1e8 + 8, 4.0, None), (1, 1): (3.5, 3.5, 4.5), (2, 2): (4.0, 4.0, None)}


def test_kmeans_runs_to_its_tolerance(spark, monkeypatch):
    seen = {}
    make = vectors.KMeans
    monkeypatch.setattr(vectors, "KMeans", lambda **options: seen.update(options) or make(**options))
    assert QUERIES["kmeans_inertia"](spark, FOLDER).count() == 3
    assert (seen["maxIter"], seen["tol"]) == (10_000, 1e-6)
