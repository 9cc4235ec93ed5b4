"""Frames and events in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def padded_index(i: Column, at: Column, frames: Column, width: int, mode: str) -> Column:
    """Index i of a window around frame `at`, mapped back where it leaves 0..frames-1."""
    last, k = frames - 1, width // 2
    below, above = {
        "replicate": (F.lit(0), last),
        "reflection": (-i, 2 * last - i),
        "reflection_circle": (at + k - i, (at - k) - (i - last)),
        "circle": (width + i, i - width),
    }[mode]
    return F.when(i < 0, below).when(i > last, above).otherwise(i)


def frame_window(at: Column, frames: Column, width: int, mode: str) -> Column:
    offsets = F.sequence(F.lit(-(width // 2)), F.lit(width - width // 2 - 1))
    return F.transform(offsets, lambda o: padded_index((at + o).cast("long"), at, frames, width, mode).cast("long"))


def clip_frames(lines: DataFrame) -> DataFrame:
    """clip, idx, key of each frame, from lines `clip frames (h,w,c)`."""
    parts = F.split("value", " ")
    return lines.select(F.get(parts, F.lit(0)).alias("clip"), F.explode(F.sequence(F.lit(0), F.get(parts, F.lit(1)).cast("int") - 1)).alias("idx")).withColumn("key", F.concat_ws("/", "clip", F.lpad(F.col("idx").cast("string"), 8, "0")))


def smoothed(df: DataFrame, key: str, order: list[str], value: str, weight: float, block: int = 4096) -> DataFrame:
    """key, n, last: the recursive mean s = w*s + (1-w)*v of each key's values in order, seeded by the first.

    A block of values takes s to a*s + b, so blocks are folded apart and a key's row holds one pair for each block."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1
    rows = df.filter(F.col(value).isNotNull()).select(key, rank.alias("_i"), F.col(value).cast("double").alias("_v"))
    parts = rows.groupBy(key, F.floor(F.col("_i") / block).alias("_b")).agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_all"))
    start = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    step = lambda s, x: F.struct((s["a"] * weight).alias("a"), (s["b"] * weight + x["_v"] * (1 - weight)).alias("b"))
    folded = parts.select(key, "_b", F.size("_all").alias("_n"), F.get(F.col("_all._v"), F.lit(0)).alias("_first"), F.aggregate("_all", start, step).alias("_f"))
    keys = folded.groupBy(key).agg(F.sum("_n").alias("n"), F.min_by("_first", "_b").alias("_seed"), F.sort_array(F.collect_list(F.struct("_b", "_f"))).alias("_fs"))
    return keys.select(key, "n", F.aggregate("_fs", F.col("_seed"), lambda s, x: s * x["_f"]["a"] + x["_f"]["b"]).alias("last"))


def best_so_far(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    return df.withColumn("best", F.max(value).over(W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)))


def latest(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    best = F.max(F.struct(*order, *columns))
    return df.groupBy(key).agg(best.alias("_m")).select(key, *[F.col(f"_m.{c}").alias(c) for c in dict.fromkeys([*order, *columns])])


def every_nth(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """Of each key's rows in order the first and then every n-th."""
    return df.withColumn("_i", F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1).filter(F.col("_i") % n == 0).drop("_i")


def filled_grid(df: DataFrame, key: str, ts: str, value: str, step: str) -> DataFrame:
    """key, slot, value: the last value of each step, repeated over empty ones between a key's first and last."""
    slots = df.groupBy(key, F.date_trunc(step, ts).alias("slot")).agg(F.max_by(value, F.struct(ts, value)).alias("_v"))
    ends = slots.groupBy(key).agg(F.min("slot").alias("a"), F.max("slot").alias("b"))
    grid = ends.select(key, F.explode(F.sequence("a", "b", F.expr(f"interval 1 {step}"))).alias("slot"))
    run = F.last("_v", ignorenulls=True).over(W.partitionBy(key).orderBy("slot"))
    return grid.join(slots, [key, "slot"], "left").select(key, "slot", run.alias(value))


def sessions(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    w = F.session_window(ts, gap)
    return df.groupBy(key, w.alias("_w")).agg(F.count("*").alias("n")).select(key, F.col("_w.start").alias("start"), "n")


def tumbling(df: DataFrame, ts: str, size: str, slide: str | None = None) -> DataFrame:
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return df.groupBy(w.alias("_w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("_w.start").alias("start"), "event_type", "n", "total")


def border_flags(df: DataFrame, key: str, order: list[str], width: int) -> DataFrame:
    """df with `border`: whether a row is among the first or last `width` of its key."""
    up, down = W.partitionBy(key).orderBy(*order), W.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("border", (F.row_number().over(up) <= width) | (F.row_number().over(down) <= width))


def neighbours(df: DataFrame, key: str, order: list[str], value: str, reach: int, step: int = 1, backwards: bool = False) -> DataFrame:
    """df with `near`: the values of the rows `step` apart on both sides, null beyond the ends."""
    w = W.partitionBy(key).orderBy(*order)
    shifts = [k * step for k in range(-reach, reach + 1)]
    found = [F.col(value) if k == 0 else F.lag(value, -k).over(w) if k < 0 else F.lead(value, k).over(w) for k in shifts]
    return df.withColumn("near", F.array(*(reversed(found) if backwards else found)))


def running_mean(df: DataFrame, key: str, order: list[str], value: str, reset: int | None = None) -> DataFrame:
    """df with `mean` of the key's values so far; with `reset` it starts anew after so many rows."""
    w = W.partitionBy(key).orderBy(*order)
    if reset is None:
        return df.withColumn("mean", F.avg(value).over(w.rowsBetween(W.unboundedPreceding, 0)))
    block = df.withColumn("_b", F.floor((F.row_number().over(w) - 1) / reset))
    return block.withColumn("mean", F.avg(value).over(W.partitionBy(key, "_b").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))).drop("_b")


def count_windows(df: DataFrame, key: str, order: list[str], size: int) -> DataFrame:
    """df with `window`: the number of its batch of `size` rows in the key's order; the last batch may be shorter."""
    return df.withColumn("window", F.floor((F.row_number().over(W.partitionBy(key).orderBy(*order)) - 1) / size))


def scheduled(step: Column, periods: list[int], values: list[float]) -> Column:
    """The value of the period a step falls in: the first whose end, in the sum of periods, is at or after it; null beyond."""
    end, out = 0, None
    for period, value in zip(periods, values, strict=True):
        end += period
        out = F.when(step <= end, F.lit(value)) if out is None else out.when(step <= end, F.lit(value))
    return out
