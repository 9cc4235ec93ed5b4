"""Closed-form and brute-force checks of the sequential kernels and of stages."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from curafold.operators.evaluate import assignment, nms
from curafold.operators.relational import ranked
from curafold.operators.sequences import frame_window
from curafold.plans.enrichment import REGISTRY, Stage, enrich, from_config, register


def test_assignment_is_the_cheapest():
    rng = np.random.default_rng(3)
    for rows, cols in itertools.product(range(1, 6), repeat=2):
        cost = rng.random((rows, cols))
        pairs = assignment(cost)
        assert len(pairs) == min(rows, cols) == len({i for i, _ in pairs}) == len({j for _, j in pairs})
        c = cost if rows <= cols else cost.T
        best = min(sum(c[i, p[i]] for i in range(len(c))) for p in itertools.permutations(range(c.shape[1]), len(c)))
        assert abs(sum(cost[p] for p in pairs) - best) < 1e-9


def test_suppression_keeps_no_overlap():
    boxes = np.array([[0, 0, 10, 10], [1, 1, 11, 11], [20, 20, 30, 30], [0, 0, 10, 10]], float)
    assert nms(boxes, np.array([0.9, 0.8, 0.7, 0.9]), 0.45) == [0, 2]


def test_frame_padding(spark):
    want = {"replicate": [0, 0, 0, 1, 2], "reflection": [2, 1, 0, 1, 2], "reflection_circle": [4, 3, 0, 1, 2], "circle": [3, 4, 0, 1, 2]}
    row = spark.range(1).select(*[frame_window(F.lit(0), F.lit(100), 5, m).alias(m) for m in want]).first()
    assert {m: row[m] for m in want} == want


def test_ranks_are_gapless(spark):
    df = ranked(spark.range(1000).select("id", (F.col("id") % 7).alias("k")), F.col("k"), "id", ranges=16)
    rows = [r.id for r in df.orderBy("rank").collect()]
    assert rows == sorted(range(1000), key=lambda i: (i % 7, i))


def test_ranks_of_no_rows(spark):
    assert ranked(spark.range(0), F.col("id"), "id").count() == 0


def test_enrichment_fills_only_what_is_missing(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "dataset string, q int")
    assert sorted(enrich(df, [Stage("q", {"q": F.lit(9)})]).collect()) == [("a", 1), ("b", 9)]


def test_pipeline_configuration():
    register("Half")(lambda k=2: Stage("half", {"h": F.lit(k)}) if False else Stage("half", {}))
    try:
        stages = from_config("Tools:\n- toolClass: Half\n  forceUpdate: true\n")
        assert [s.name for s in stages] == ["half"] and stages[0].force
        assert from_config("Tools:\n") == []
    finally:
        REGISTRY.pop("Half")
