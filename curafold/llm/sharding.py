"""Operator 8, sharding by the minimax contiguous partition.

Equal texts are one atomic group; groups are ordered by their smallest doc_id, then by their text's hash, and numbered
in that order. The smallest capacity for which a greedy run over the ordered groups needs no more than the
given number of shards is found by binary search, and the shards are cut where that run cuts. A group above the
capacity can't be divided; it stands alone in the run, in its place, so that shards are always contiguous and the
others stay even. The law is `bytes`.

At any size the driver holds sums over at most about BUCKETS intervals of group numbers: intervals are first even, and
those in which a cut can fall under any capacity between the bounds known so far are divided again until they
are single groups (each round one aggregation). No more groups than shards can be above the capacity; they are told apart from the start.

Defined cases: null and empty texts are one group, each of 16 bytes; a group without any doc_id comes before the
others; rows that repeat are counted each; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import documents, staged, text_of

SHARDS, OVERHEAD, BUCKETS, ROWS_A_TASK = 40, 16, 1 << 16, 1_000_000


def cuts_of(sizes: np.ndarray, capacity: int, limit: int) -> list[int] | None:
    """Places before which a greedy run of this capacity starts a new shard; None if it needs more than limit shards.

    What is above the capacity has a shard of its own."""
    ends, large = np.cumsum(sizes), np.flatnonzero(sizes > capacity)
    cuts, at = [], 0
    while True:
        if int(sizes[at]) > capacity:
            after = at + 1
        else:
            after = int(np.searchsorted(ends, (int(ends[at - 1]) if at else 0) + capacity, side="right"))
            wall = int(np.searchsorted(large, at))
            after = min(after, int(large[wall])) if wall < len(large) else after
        if after >= len(sizes):
            return cuts
        if len(cuts) == limit - 1:
            return None
        cuts.append(after)
        at = after


def smallest_capacity(sizes: np.ndarray, shards: int, low: int = 1) -> int:
    high = int(sizes.sum())
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if cuts_of(sizes, middle, shards) is not None else (middle + 1, high)
    return low


def least_thinkable(largest: list[int], total: int, shards: int) -> int:
    """A bound that no feasible capacity is below. largest: the sizes of the largest groups, one more than shards at least."""
    low, high = 1, max(total, 1)
    while low < high:
        middle = (low + high) // 2
        above = [x for x in largest if x > middle]
        fits = len(above) <= shards and len(above) - (-(total - sum(above)) // middle) <= shards
        low, high = (low, middle) if fits else (middle + 1, high)
    return low


def minimax_cuts(groups: DataFrame, shards: int, buckets: int = BUCKETS) -> list[int]:
    """Numbers of the groups at which shards 1, 2, ... start. groups: key (one row each), size.

    Keys are counted in aligned intervals of a power of two, which end at groups above the least thinkable capacity. Only
    intervals that a cut can reach are halved on, widest first, about `buckets` at a time, until they hold one key."""
    first, last, total = groups.agg(F.min("key"), F.max("key"), F.sum("size")).first()
    if last is None:
        return []
    top = groups.orderBy(F.desc("size"), "key").limit(shards + 1).select("key", "size").collect()
    floor = least_thinkable([int(r["size"]) for r in top], int(total), shards)
    above = {int(r["key"]): int(r["size"]) for r in top if r["size"] > floor}
    most = max((int(r["size"]) for r in top if r["size"] <= floor), default=0)
    walls = sorted(above)
    part = F.lit(0)
    for w in walls:
        part = part + (F.col("key") > w).cast("int")
    normal = groups.filter(~F.col("key").isin(walls)) if walls else groups
    bits = max(1, buckets.bit_length() - 1)
    shift, inside = max(0, (last - first + 1).bit_length() - bits), F.lit(True)
    known: dict[int, tuple[int, int, int]] = {w: (0, above[w], w) for w in walls}  # start: (shift, bytes, first key of the aligned interval)
    while True:
        for k, j, size in normal.filter(inside).groupBy(F.shiftright("key", shift).alias("k"), part.alias("j")).agg(F.sum("size").alias("s")).collect():
            first = int(k) << shift
            known[max(first, walls[j - 1] + 1) if j else first] = (shift, int(size), first)
        order = sorted(known)
        sizes = np.array([known[x][1] for x in order], dtype=np.int64)
        many = np.array([known[x][0] > 0 for x in order])
        roof = smallest_capacity(sizes, shards, max(floor, int(sizes[many].max(initial=1))))
        wide = [order[k] for k in _reached(sizes, np.array([x in above for x in order]), floor, roof, most, shards) if many[k]]
        if not wide:
            return [order[k] for k in cuts_of(sizes, roof, shards) or []]
        widest = max(known[x][0] for x in wide)
        firsts = {known[x][2] for x in wide if known[x][0] == widest}
        for x in [x for x in order if known[x][0] == widest and known[x][2] in firsts]:  # all parts of an aligned interval
            del known[x]
        shift, inside = max(0, widest - max(1, bits - (len(firsts) - 1).bit_length())), F.lit(False)
        for first, end in _merged([(x, x + (1 << widest)) for x in firsts]):
            inside = inside | F.col("key").between(first, end - 1)


def _reached(sizes: np.ndarray, above: np.ndarray, floor: int, roof: int, most: int, shards: int) -> list[int]:
    """Places of the intervals that may hold a cut of a run of any capacity from floor to roof."""
    ends = np.cumsum(sizes)
    starts, last = ends - sizes, len(sizes) - 1
    tops = np.flatnonzero(above)
    found: set[int] = set()
    low = high = 0  # bytes before the k-th cut, at least and at most
    for _ in range(1, shards):
        at = min(int(np.searchsorted(ends, low, side="right")), last)
        if above[at] and low == int(starts[at]):
            low = int(ends[at])
        else:
            whole = int(np.searchsorted(ends, low + floor, side="right"))
            wall = int(np.searchsorted(tops, at))
            limit = int(starts[tops[wall]]) if wall < len(tops) else int(ends[-1])
            low = min(max(low + floor - most, int(ends[whole - 1]) if whole else 0, low), limit)
        passed = [int(ends[t]) for t in tops if int(starts[t]) <= high]
        high = min(max([high + roof, *passed]), int(ends[-1]))
        first, final = int(np.searchsorted(ends, low, side="left")), int(np.searchsorted(ends, high, side="left"))
        found.update(range(first, min(final + 2, last + 1)))
    return sorted(found)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and out[-1][1] == a:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def numbered(groups: DataFrame) -> DataFrame:
    """groups with key, their number from 0 in the order of first (nulls first) and _text: no task orders more than its range."""
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col("first").asc_nulls_first(), F.col("_text")]
    ranged = groups.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    local = staged(ranged.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "ordered_groups")
    base, before = [], 0
    for r in sorted(local.groupBy("_part").count().collect()):  # a row for each partition
        base.append(F.struct(F.lit(r[0]).alias("_part"), F.lit(before).cast("long").alias("_base")))
        before += r[1]
    if not base:
        return local.withColumn("key", F.col("_at"))
    bases = groups.sparkSession.range(1).select(F.explode(F.array(*base)).alias("b")).select("b.*")
    return local.join(F.broadcast(bases), "_part").withColumn("key", F.col("_at") + F.col("_base")).drop("_part", "_at", "_base")


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row."""
    body = text_of(text)
    rows = staged(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + overhead).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.sha2(body, 256).alias("_text"), F.monotonically_increasing_id().alias("_row")),
        "sizes",
    )
    groups = numbered(staged(rows.groupBy("_text").agg(F.min("doc_id").alias("first"), F.sum("size").alias("size")), "text_groups"))
    number = F.lit(0)
    for start in minimax_cuts(groups.select("key", "size"), shards, buckets):
        number = number + (F.col("key") >= start).cast("int")
    placed = rows.join(groups.select("_text", number.alias("shard")), "_text")

    n = rows.count()
    salts = max(16, -(-n // ROWS_A_TASK))
    salted = staged(placed.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "_text", "_row"), F.lit(salts)).cast("int")), "placed")
    before = F.sum("count").over(W.partitionBy("shard").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1))
    bases = salted.groupBy("shard", "_salt").count().select("shard", "_salt", F.coalesce(before, F.lit(0)).alias("_base"))
    rank = F.row_number().over(W.partitionBy("shard", "_salt").orderBy("doc_id", "text_crc32", "_row")) - 1
    slots = salted.withColumn("_rank", rank).join(bases, ["shard", "_salt"])
    return slots.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_rank") + F.col("_base")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir))
