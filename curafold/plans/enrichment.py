"""Enrichment pipelines: stages that fill columns, only where their predicate holds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import inside
from ..operators.relational import needs_update

REGISTRY: dict[str, Callable[..., "Stage"]] = {}
DEFAULTS = {"forceUpdate": False, "multiGPUs": None, "excludeDirs": None, "includeDirs": None, "args": {}, "batchsize": 1, "num_workers": 4}


@dataclass
class Stage:
    """outputs: name to column (built-in or pandas UDF); criterion replaces the missing-field test."""

    name: str
    outputs: dict[str, Column]
    inputs: set[str] = field(default_factory=set)
    criterion: Column | None = None
    force: bool = False
    include: list[str] | None = None
    exclude: list[str] | None = None

    def applies(self) -> Column:
        wanted = F.lit(True) if self.force else (self.criterion if self.criterion is not None else needs_update(list(self.outputs)))
        for folders, sign in ((self.include, True), (self.exclude, False)):
            if folders:
                hit = F.lit(False)
                for x in folders:
                    hit = hit | inside(F.col("dataset"), x)
                wanted = wanted & (hit if sign else ~hit)
        return F.coalesce(wanted, F.lit(False))


def register(name: str):
    def keep(make):
        REGISTRY[name] = make
        return make

    return keep


def from_config(text: str) -> list[Stage]:
    """Stages of a YAML pipeline, in its order. Unknown names fail before anything runs."""
    import yaml

    stages = []
    for entry in (yaml.safe_load(text) or {}).get("Tools") or []:
        options = DEFAULTS | entry
        if options["toolClass"] not in REGISTRY:
            raise ValueError(f"unknown stage {options['toolClass']}; known: {sorted(REGISTRY)}")
        stage = REGISTRY[options["toolClass"]](**options["args"])
        stage.force, stage.include, stage.exclude = options["forceUpdate"], options["includeDirs"], options["excludeDirs"]
        stages.append(stage)
    return stages


def ordered(stages: list[Stage]) -> list[Stage]:
    """Stages after those that make their inputs; otherwise in the given order."""
    made_by = {f: s.name for s in stages for f in s.outputs}
    done, out, left = set(), [], list(stages)
    while left:
        ready = next((s for s in left if all(made_by.get(i, s.name) in done | {s.name} for i in s.inputs)), None)
        if ready is None:
            raise ValueError("stages depend on each other in a circle")
        left.remove(ready)
        done.add(ready.name)
        out.append(ready)
    return out


def with_fields(df: DataFrame, stage: Stage) -> DataFrame:
    """df with the stage's fields; new ones are null and have the type of the stage's output."""
    missing = [f for f in stage.outputs if f not in df.columns]
    types = df.select(*[stage.outputs[f].alias(f) for f in missing]).schema if missing else []
    return df.withColumns({f: F.lit(None).cast(types[f].dataType) for f in missing}) if missing else df


def enrich(df: DataFrame, stages: list[Stage]) -> DataFrame:
    """Rows for which a stage doesn't apply never reach its function: it gets null and its old value stays."""
    for s in ordered(stages):
        flag = with_fields(df, s).withColumn("_applies", s.applies())
        df = flag.withColumns({f: F.when(F.col("_applies"), F.coalesce(c, F.col(f))).otherwise(F.col(f)) for f, c in s.outputs.items()}).drop("_applies")
    return df


def run(df: DataFrame, stages: list[Stage], folder: str) -> DataFrame:
    """enrich(), with the table written under folder after each stage. A run that was cut off goes on after the last stage
    that was written whole; Spark's commit marks it, and a stage's place and name make its folder."""
    spark = df.sparkSession
    for n, s in enumerate(ordered(stages)):
        place = f"{folder}/{n:03d}-{s.name}"
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            enrich(df, [s]).write.mode("overwrite").parquet(place)
        df = spark.read.parquet(place)
    return df
