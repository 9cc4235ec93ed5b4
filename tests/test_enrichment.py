"""Enrichment: new typed fields, resumption, and row-wise criteria."""

import pandas as pd
from pyspark.sql import functions as F

from curafold.plans.enrichment import Stage, enrich, run


def test_new_fields_keep_their_types(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, old int")
    stages = [Stage("n", {"n": F.col("id") * 2}), Stage("d", {"d": F.col("id") / 2, "a": F.array("id")}, {"n"}), Stage("o", {"old": F.lit(9)})]
    out = enrich(df, stages)
    assert [f.dataType.simpleString() for f in out.schema] == ["int", "int", "int", "double", "array<int>"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 9, 2, 0.5, [1]), (2, 5, 4, 1.0, [2])]


def test_only_rows_in_need_reach_a_function(spark):
    @F.pandas_udf("int")
    def double(x: pd.Series) -> pd.Series:
        return (x * 2).astype("Int32")

    df = spark.createDataFrame([(1, None), (2, 7)], "id int, n int")
    assert [tuple(r) for r in enrich(df, [Stage("n", {"n": double("id")})]).orderBy("id").collect()] == [(1, 2), (2, 7)]
    forced = enrich(df, [Stage("n", {"n": double("id")}, force=True)])
    assert [r.n for r in forced.orderBy("id").collect()] == [2, 4]


def test_run_goes_on_after_the_last_whole_stage(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "id int")
    one, two = Stage("one", {"a": F.col("id") + 1}), Stage("two", {"b": F.col("a") + 1}, {"a"})
    run(df, [one], str(tmp_path / "w"))
    other = Stage("one", {"a": F.lit(100)})  # would give other values if it ran again
    out = run(df, [other, two], str(tmp_path / "w"))
    assert sorted((r.a, r.b) for r in out.collect()) == [(2, 3), (3, 4)]
    (tmp_path / "w/001-two/_SUCCESS").unlink()  # a stage that was cut off is written anew
    assert sorted(r.b for r in run(df, [other, two], str(tmp_path / "w")).collect()) == [3, 4]
