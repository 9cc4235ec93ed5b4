"""Joins, set operations, selection, sampling, balancing and ordering of the asset table.

Global order is never one task's work: `ranked` cuts the key's range at approximate quantiles, ranks inside
each range and adds the counts of the ranges before, a table of as many rows as ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.paths import uniform

RANGES = 64


def ranked(df: DataFrame, key: Column, *ties: str, name: str = "rank", ranges: int = RANGES) -> DataFrame:
    """df with a global row number from 0 in the order of a numeric key, then ties."""
    keyed = df.withColumn("_key", key.cast("double"))
    found = keyed.agg(F.percentile_approx("_key", [k / ranges for k in range(1, ranges)], 10_000)).first()[0] or []
    cuts = F.array(*map(F.lit, sorted(set(found)))).cast("array<double>")
    in_range = keyed.withColumn("_range", F.size(F.filter(cuts, lambda c: c < F.col("_key"))))
    before = F.coalesce(F.sum("count").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bases = in_range.groupBy("_range").count().select("_range", before.alias("_base"))
    local = F.row_number().over(W.partitionBy("_range").orderBy("_key", *ties)) - 1
    return in_range.withColumn("_local", local).join(F.broadcast(bases), "_range").withColumn(name, F.col("_local") + F.col("_base")).drop("_key", "_range", "_local", "_base")


def reconcile(known: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """key, status: NEW (only listed), DELETED (only known) or KEPT; equal keys count once."""
    a = known.select(F.col(key).alias("_a")).distinct()
    b = listed.select(F.col(key).alias("_b")).distinct()
    status = F.when(F.col("_a").isNull(), "NEW").when(F.col("_b").isNull(), "DELETED").otherwise("KEPT")
    return a.join(b, F.col("_a") == F.col("_b"), "full").select(F.coalesce("_a", "_b").alias(key), status.alias("status"))


def needs_update(fields: list[str], force: bool = False) -> Column:
    """A row qualifies if forced or any field is missing."""
    return reduce(lambda a, b: a | b, [F.col(f).isNull() for f in fields], F.lit(force))


def missing_or_empty(column: Column) -> Column:
    return column.isNull() | (F.length(column) == 0)


def enriched(df: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Right side wins where it has a value; `changed` tells whether a field differs."""
    right = new.select(F.col(key).alias("_key"), *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = df.join(right, df[key] == F.col("_key"), "left")
    changed = reduce(lambda a, b: a | b, [~F.col(f).eqNullSafe(F.coalesce(F.col(f"_new_{f}"), F.col(f))) for f in fields])
    merged = joined.withColumn("changed", changed)
    return merged.withColumns({f: F.coalesce(F.col(f"_new_{f}"), F.col(f)) for f in fields}).drop("_key", *[f"_new_{f}" for f in fields])


def balance_weights(df: DataFrame, label: str = "lbl", ratio: int = 10) -> DataFrame:
    """label, freq, weight, lbl_new. Labels with at least 1/ratio of the largest frequency are equalised by
    inverse frequency; rarer ones and -1 share one weight and the label -1. One row a label."""
    freq = df.groupBy(label).agg(F.count("*").alias("freq"))
    real = F.col(label) != -1
    top = freq.crossJoin(freq.agg(F.max(F.when(real, F.col("freq"))).alias("_max"), F.sum("freq").alias("_all")))  # one row
    marked = top.withColumn("_valid", F.coalesce(real & (F.col("freq") >= F.col("_max") / ratio), F.lit(False)))
    sums = marked.agg(F.min(F.when(F.col("_valid"), F.col("freq"))).alias("_least"), F.sum(F.when(F.col("_valid"), F.col("freq"))).alias("_good"), F.sum(F.when(~F.col("_valid"), F.col("freq"))).alias("_rest"))
    weight = F.when(F.col("_valid"), F.col("_least") / F.col("freq") * F.coalesce("_good", F.lit(0)) / F.col("_all")).otherwise(F.coalesce("_rest", F.lit(0)) / F.col("_all"))
    return marked.crossJoin(sums).select(label, "freq", weight.alias("weight"), F.when(F.col("_valid"), F.col(label)).otherwise(-1).alias("lbl_new"))


def balanced(df: DataFrame, label: str = "lbl") -> DataFrame:
    """df with weight and lbl_new; the weights have a row a label, so Spark broadcasts them while that is small."""
    return df.join(balance_weights(df, label).drop("freq"), label, "left")


def normalized_weights(df: DataFrame, weight: str = "weight") -> DataFrame:
    total = df.agg(F.sum(weight).alias("_total"))
    return df.crossJoin(total).withColumn(weight, F.col(weight) / F.col("_total")).drop("_total")


def sample_exact(df: DataFrame, n: int, key: str, by: str | None = None) -> DataFrame:
    """Exactly n rows (all if fewer) of df or of each group, uniform by the order of the key's md5."""
    order = [F.md5(F.col(key).cast("string")), F.col(key)]
    if by is None:
        return df.orderBy(*order).limit(n)
    rank = F.row_number().over(W.partitionBy(by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def sample_weighted(df: DataFrame, n: int, key: str, weight: str) -> DataFrame:
    """n rows without replacement, by exponential keys of the weights."""
    return df.withColumn("_order", -F.log(uniform(F.col(key)) + F.lit(2.0**-33)) / F.col(weight)).orderBy("_order", key).limit(n).drop("_order")


def split(df: DataFrame, key: str, shares: dict[str, float]) -> DataFrame:
    """A split for each row from its key's hash: stable when rows are added."""
    u, high, out = uniform(F.col(key)), 0.0, F.lit(list(shares)[-1])
    for name, share in reversed(list(shares.items())[:-1]):
        high = sum(list(shares.values())[: list(shares).index(name) + 1])
        out = F.when(u < high, name).otherwise(out)
    return df.withColumn("split", out)


def chunked(df: DataFrame, key: str, size: int) -> DataFrame:
    """df with the number of its chunk of so many rows in the key's order."""
    return ranked(df, F.col(key), key).withColumn("chunk", F.floor(F.col("rank") / size)).drop("rank")


def class_weights(df: DataFrame, label: str, classes: int) -> DataFrame:
    """label, weight: inverse counts (0 counts as 1), to sum 1."""
    domain = df.sparkSession.range(classes).select(F.col("id").cast(df.schema[label].dataType).alias(label))
    counts = domain.join(df.groupBy(label).count(), label, "left").select(label, (1 / F.greatest(F.coalesce("count", F.lit(0)), F.lit(1))).alias("weight"))
    return normalized_weights(counts)


def unresolved_duplicates(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The path to drop of each pair (p1, p2): the smaller file, p1 on a tie; pairs with a missing file don't count."""
    one = sizes.select(F.col("path").alias("p1"), F.col("length").alias("_s1"))
    two = sizes.select(F.col("path").alias("p2"), F.col("length").alias("_s2"))
    both = pairs.join(one, "p1").join(two, "p2")
    return both.select(F.when(F.col("_s1") > F.col("_s2"), F.col("p2")).otherwise(F.col("p1")).alias("path")).distinct()


def coverage(df: DataFrame, item: str, order: list[str], step: int = 1000) -> DataFrame:
    """draws, share: different items seen after every `step` draws, as a share of all; the first sight of an
    item is found by a group minimum, and only sums of steps are put in order."""
    at = ranked(df, F.col(order[0]), *order, name="draw")
    firsts = at.groupBy(item).agg(F.min("draw").alias("draw")).groupBy(F.floor(F.col("draw") / step).alias("b")).count()
    steps = at.agg(F.max("draw").alias("m")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("m") / step))).alias("b"))
    seen = steps.join(firsts, "b", "left").fillna(0, ["count"])
    total, run = F.sum("count").over(W.partitionBy()), F.sum("count").over(W.orderBy("b"))
    return seen.select(((F.col("b") + 1) * step).alias("draws"), run.alias("seen"), total.alias("total")).select("draws", (F.col("seen") / F.col("total")).alias("share"))


def weighted_sample_wr(df: DataFrame, n: int, key: str, weight: str, seed: str = "") -> DataFrame:
    """draw, key: n draws with replacement, each row with a chance in proportion to its weight.

    Weights are summed up range by range of keys; a draw first finds its range among the ranges' sums and then, in the
    sorted rows of that range, the last row that begins at or before it. No draw is paired with more than one row."""
    rows = ranked(df.select(key, F.col(weight).cast("double").alias("_w")).filter("_w > 0"), F.col(key), key, name="_at")
    part = rows.withColumn("_part", F.floor(F.col("_at") / 100_000))
    before = F.coalesce(F.sum("_s").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    sums = part.groupBy("_part").agg(F.sum("_w").alias("_s")).select("_part", before.alias("_low"), "_s")
    edges = sums.agg(F.sort_array(F.collect_list(F.struct("_low", "_part"))).alias("_edges"), F.sum("_s").alias("_total"))  # a row for 100,000
    draws = df.sparkSession.range(n).crossJoin(F.broadcast(edges)).filter("_total > 0")
    target = draws.withColumn("_x", uniform(F.concat(F.lit(seed), F.col("id").cast("string"))) * F.col("_total"))
    own = F.element_at(F.filter("_edges", lambda e: e["_low"] <= F.col("_x")), -1)
    asked = target.select(own["_part"].alias("_part"), F.col("_x").alias("_start"), F.col("id").alias("draw"), F.lit(None).cast(df.schema[key].dataType).alias(key), F.lit(1).alias("_order"))
    within = W.partitionBy("_part").orderBy("_at")
    starts = part.withColumn("_own", F.sum("_w").over(within) - F.col("_w")).join(sums, "_part")
    offered = starts.select("_part", (F.col("_own") + F.col("_low")).alias("_start"), F.lit(None).cast("long").alias("draw"), key, F.lit(0).alias("_order"))
    run = W.partitionBy("_part").orderBy("_start", "_order").rowsBetween(W.unboundedPreceding, 0)
    return offered.union(asked).withColumn("_found", F.last(key, ignorenulls=True).over(run)).filter("draw IS NOT NULL").select("draw", F.col("_found").alias(key))


def epoch_shares(df: DataFrame, key: str, world: int, epoch: int = 0, ratio: int = 1) -> DataFrame:
    """key, rank, place: each epoch's order of `ratio` times the rows, dealt to `world` readers in turn.

    The order is that of a hash of epoch and number; rows repeat where the total isn't a multiple of the readers."""
    n = df.count()
    each = -(-n * ratio // world)
    numbered = ranked(df.select(key), F.col(key), key, name="_i")
    numbers = df.sparkSession.range(each * world).withColumn("_u", uniform(F.concat_ws(":", F.lit(epoch), F.col("id"))))
    placed = ranked(numbers, F.col("_u"), "id", name="_p").select((F.col("id") % max(n, 1)).alias("_i"), (F.col("_p") % world).alias("rank"), F.floor(F.col("_p") / world).alias("place"))
    return placed.join(numbered, "_i").select(key, "rank", "place")


def image_weights(labels: DataFrame, weights: DataFrame, image: str, label: str) -> DataFrame:
    """image, weight: the sum of its labels' class weights. weights: label, weight (a row a class)."""
    counts = labels.groupBy(image, label).agg(F.count("*").alias("_n"))
    return counts.join(weights.select(label, F.col("weight").alias("_w")), label).groupBy(image).agg(F.sum(F.col("_n") * F.col("_w")).alias("weight"))


def remapped(column: Column, table: dict) -> Column:
    """Values by a fixed table; null for what it lacks."""
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(pairs, column)


def group_lists(df: DataFrame, label: str, key: str) -> DataFrame:
    """label, keys (ascending), n, place (from 0 by ascending size, then label). One row holds a label's keys, as asked for."""
    lists = df.groupBy(label).agg(F.sort_array(F.collect_list(key)).alias("keys"), F.count("*").alias("n"))
    return ranked(lists, F.col("n"), label, name="place")


def one_chunk(df: DataFrame, key: str, chunks: int, number: int) -> DataFrame:
    """The rows of one of so many chunks of equal length (the last may be shorter), in the key's order."""
    size = max(-(-df.count() // chunks), 1)
    return chunked(df, key, size).filter(F.col("chunk") == number).drop("chunk")


def smallest_half(df: DataFrame, size: Column, *ties: str) -> DataFrame:
    """The half of the rows with the smallest sizes, rounded to the nearest even number of rows."""
    return ranked(df, size, *ties, name="_r").filter(F.col("_r") < round(df.count() * 0.5)).drop("_r")


def exclusive_union(generated: DataFrame, custom: DataFrame) -> DataFrame:
    """Both, with a flag that tells the custom ones."""
    return generated.withColumn("custom", F.lit(False)).unionByName(custom.withColumn("custom", F.lit(True)))


def present(df: DataFrame, listing: DataFrame, key: str, other: str = "path") -> DataFrame:
    """df with `present`: whether its key is among the listed paths, however often it is listed."""
    held = listing.select(F.col(other).alias(key), F.lit(True).alias("present")).distinct()
    return df.join(held, key, "left").fillna(False, ["present"])


def repeated(df: DataFrame, times: int) -> DataFrame:
    """df once for each of so many rounds."""
    return df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def agreed(first: DataFrame, second: DataFrame, key: str, label: str) -> DataFrame:
    """Rows of first to which second gives the same label."""
    return first.join(second.select(key, F.col(label).alias("_l")), key).filter(F.col(label) == F.col("_l")).drop("_l")


def named(df: DataFrame, code: str, names: DataFrame) -> DataFrame:
    """df with the name of its code; names: code, name (unique codes)."""
    return df.join(names.select(F.col("code").alias(code), "name"), code, "left")


def logged(known: DataFrame, new: DataFrame, score: str) -> DataFrame:
    """A log with further rows: different rows only, with their place by falling score."""
    rows = known.unionByName(new).distinct()
    return ranked(rows, -F.col(score), *rows.columns, name="place")


def scraped(lines: DataFrame, pattern: str, line: str = "line") -> DataFrame:
    """step, value: the two groups of a pattern in lines that have it."""
    part = lambda k: F.regexp_extract(line, pattern, k)
    return lines.filter(F.col(line).rlike(pattern)).select(part(1).cast("long").alias("step"), part(2).cast("double").alias("value"))
