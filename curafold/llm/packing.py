"""Operator 4, best-fit packing by a configuration linear program.

Documents become pieces of at most `capacity` tokens; only longer documents are cut. Everything the solver
sees is the histogram of piece lengths, at most `capacity` numbers however many documents there are:
minimise the number of sequences over configurations (multisets of lengths that fit), so that each length
is covered. The covering LP is solved by multiplicative weights: a length's weight falls as it is covered,
a knapsack dynamic program prices the best configuration under the weights, and the configuration is used
as often as its scarcest length allows. The fractional solution is scaled to the mass of the pieces and
rounded down; what is left is packed by the best fit on the remaining histogram, longest first.

Pieces then find their places without a global order: pieces of a length are ranked inside salted groups
(their number follows the row count, so that a length with a third of all rows is spread), and the rank
selects configuration, copy and offset in a table that is bounded by lengths and configurations.

Defined cases: a null or empty text has the separator only and is packed as one token; null doc_ids and
repeated rows are packed like others; an empty table gives an empty table; other columns aren't read.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import documents, staged
from .tokens import columns, crc32, default_path, encoder, spread

CAPACITY, SEPARATOR = 2048, 0
PRICINGS, STEP, ROWS_A_TASK = 600, 0.5, 1_000_000


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR, ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids: the pieces of each whole document."""

    def run(batches):
        for batch in batches:
            for at, column in columns(batch):
                found, bounds = encoder(tokenizer).encode_column(column)
                whole = np.insert(found, bounds[1:], separator).astype("<u4")  # each document's ids end with the separator
                sizes = np.diff(bounds) + 1
                firsts, pieces = np.cumsum(sizes) - sizes, -(-sizes // capacity)
                of = np.repeat(np.arange(len(sizes)), pieces)
                piece = spread(np.zeros(len(sizes), np.int64), pieces)
                start = piece * capacity
                length = np.minimum(capacity, sizes[of] - start)
                begin = firsts[of] + start
                raw, cuts = whole.tobytes(), list(zip((4 * begin).tolist(), (4 * (begin + length)).tolist(), strict=True))
                sums = [crc32(raw[a:b]) for a, b in cuts]
                arrays = [batch.column(0).slice(at, len(column)).take(pa.array(of)), pa.array(piece.astype("i4")), pa.array(start), pa.array(length), pa.array(sums, pa.int64())]
                if ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(whole)).astype("i4")), pa.array(whole.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + ids])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids)


def price(values: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths of the largest value that fits: values[l] is that of length l, 0 if it is absent."""
    lengths = np.nonzero(values)[0]
    worth = values[lengths]
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=int)
    for room in range(1, capacity + 1):
        n = bisect_right(lengths, room)
        if n:
            with_it = best[room - lengths[:n]] + worth[:n]
            k = int(with_it.argmax())
            if with_it[k] > best[room - 1]:
                best[room], choice[room] = with_it[k], lengths[k]
                continue
        best[room] = best[room - 1]
    config: dict[int, int] = {}
    room = capacity
    while room > 0:
        if x := int(choice[room]):
            config[x] = config.get(x, 0) + 1
            room -= x
        else:
            room -= 1
    return config


def solve(counts: dict[int, int], capacity: int = CAPACITY, pricings: int = PRICINGS) -> list[tuple[dict[int, int], int]]:
    """Configurations and how often each is used; together they hold each length exactly counts times."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        left[length] = n
    plan: list[tuple[dict[int, int], int]] = []

    def use(config: dict[int, int], times: int) -> None:
        if times > 0:
            plan.append((config, times))
            for length, n in config.items():
                left[length] -= n * times

    use({capacity: 1}, int(left[capacity]))  # full pieces can only stand alone
    need = left.astype(float)
    have = need > 0
    covered, fractional = np.zeros(capacity + 1), []
    for _ in range(min(pricings, 4 * int(have.sum()))):
        weight = np.where(have, np.exp(-STEP * (covered - covered[have].min())), 0.0)
        # an instance of a length counts by its share of that length's need, and by the room it takes
        config = price(np.where(have, weight * (np.arange(capacity + 1) + 1.0), 0.0), capacity)
        config = {x: min(n, int(left[x])) for x, n in config.items()}
        times = min(need[x] / n for x, n in config.items())
        fractional.append((config, times))
        for x, n in config.items():
            covered[x] += n * times / need[x]
    packed = sum(times * sum(x * n for x, n in config.items()) for config, times in fractional)
    scale = float((need * np.arange(capacity + 1)).sum()) / packed if packed else 0.0
    for config, times in sorted(fractional, key=lambda c: (-sum(x * n for x, n in c[0].items()), -c[1])):
        use(config, min(int(times * scale), *(int(left[x]) // n for x, n in config.items())))
    # the rest, on the histogram: open a sequence with the longest piece, then always the longest that fits
    lengths = np.nonzero(left)[0].tolist()
    while lengths:
        config, room = {}, capacity
        while (k := bisect_right(lengths, room)) > 0:
            while k > 0 and config.get(lengths[k - 1], 0) >= left[lengths[k - 1]]:
                k -= 1
            if not k:
                break
            x = lengths[k - 1]
            n = min(room // x, int(left[x]) - config.get(x, 0))
            config[x] = config.get(x, 0) + n
            room -= n * x
        use(config, min(int(left[x]) // n for x, n in config.items()))
        lengths = [x for x in lengths if left[x] > 0]
    return plan


def place(pieces: DataFrame, capacity: int = CAPACITY, pricings: int = PRICINGS) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    table, sequence, taken = [], 0, dict.fromkeys(counts, 0)
    for config, times in solve(counts, capacity, pricings):
        offset = 0
        for x in sorted(config, reverse=True):
            table.append((x, taken[x], taken[x] + config[x] * times, config[x], sequence, offset))
            taken[x] += config[x] * times
            offset += x * config[x]
        sequence += times
    slots = spark.createDataFrame(table, "length long, _from long, _to long, _each long, _sequence long, _at long")

    salts = max(16, -(-sum(counts.values()) // ROWS_A_TASK))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    groups = salted.groupBy("length", "_salt").count()
    before = F.sum("count").over(W.partitionBy("length").orderBy("_salt").rowsBetween(W.unboundedPreceding, -1))
    bases = groups.select("length", "_salt", F.coalesce(before, F.lit(0)).alias("_base"))
    rank = F.row_number().over(W.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("_rank", rank).join(bases, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_base"))
    # intervals of a length as one sorted array: a join on equal lengths that makes a row for each piece
    held = slots.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("_from", "_to", "_each", "_sequence", "_at"))).alias("_slots"))
    found = ranked.join(F.broadcast(held), "length").withColumn("_slot", F.get(F.filter("_slots", lambda s: (s["_from"] <= F.col("_rank")) & (F.col("_rank") < s["_to"])), F.lit(0)))
    n = F.col("_rank") - F.col("_slot._from")
    each = F.col("_slot._each")
    found = found.withColumns({"sequence_id": F.col("_slot._sequence") + F.floor(n / each), "offset": F.col("_slot._at") + (n % each) * F.col("length")})
    return found.select(*pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return place(staged(cut(docs, tokenizer, capacity, ids=ids, doc_id=doc_id, text=text), "pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), default_path("word_bpe_49k.json")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
