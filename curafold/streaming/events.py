"""Structured Streaming forms of the ordered operators; each also accepts a batch table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(events: DataFrame, late: str = "10 minutes", size: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums by event time and type; rows later than the watermark are dropped by Spark."""
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return events.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def user_sessions(events: DataFrame, late: str = "10 minutes", gap: str = "30 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def new_files(spark, folder: str, schema: str, files_a_trigger: int = 1000) -> DataFrame:
    """Each file of a growing folder once, by the stream's own checkpoint."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def latest_values(events: DataFrame) -> DataFrame:
    """The newest event of each user so far (a larger event_id on equal times); state is one event a user."""

    def newest(key, pdfs, state: GroupState):
        best = state.get if state.exists else None
        for pdf in pdfs:
            row = pdf.sort_values(["ts", "event_id"]).iloc[-1]
            mine = (int(row.ts.value), int(row.event_id), float(row.value))
            best = mine if best is None or mine[:2] > tuple(best)[:2] else tuple(best)
        state.update(best)
        yield pd.DataFrame({"user_id": [key[0]], "event_id": [best[1]], "value": [best[2]]})

    rows = events.select("user_id", "ts", "event_id", "value").filter("ts IS NOT NULL AND user_id IS NOT NULL")
    return rows.groupBy("user_id").applyInPandasWithState(newest, "user_id long, event_id long, value double", "ns long, event_id long, value double", "update", GroupStateTimeout.NoTimeout)


def shuffle_pool(events: DataFrame, pools: int = 64, size: int = 180) -> DataFrame:
    """A bounded pool for each hash bucket: full pools emit rows in the order of their hashes and keep the rest."""

    def mix(key, pdfs, state: GroupState):
        held = list(state.get[0]) if state.exists else []
        held += [int(x) for pdf in pdfs for x in pdf.event_id]
        held.sort(key=lambda x: hash((x, key[0])))
        out, held = held[: max(0, len(held) - size)], held[max(0, len(held) - size) :]
        state.update((held,))
        yield pd.DataFrame({"pool": [key[0]] * len(out), "event_id": out})

    rows = events.select(F.pmod(F.xxhash64("event_id"), F.lit(pools)).alias("pool"), "event_id")
    return rows.groupBy("pool").applyInPandasWithState(mix, "pool long, event_id long", "held array<long>", "append", GroupStateTimeout.NoTimeout)
