"""Operator 9, exact deduplication, in DataFrame functions only.

Rows are grouped by the 128-bit hash (md5) of the normalised text together with the text, so that Spark
finds a group by its hash and compares bytes inside it: two texts that share a hash stay apart. The grouping
combines inside each task first, so a group of a third of all rows shuffles one text a task. Rows then find
their group by both hashes (md5 and sha256), without their texts; Spark can split that join on a hot key.

Defined cases: a null text counts as empty. A null doc_id never wins over another id; a group of null
ids only has keep_id null. Rows that repeat the smallest doc_id with the same text are the same document
and all stay in this report; `deduplicate` leaves exactly one row of each different text, whatever its ids. An empty table gives an empty table. Other
columns aren't read here and are carried unchanged by `deduplicate`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACES, documents, having_keys, staged, text_of, with_row_keys


def normalised(text: str = "text") -> Column:
    return F.regexp_replace(text_of(text), f"[{SPACES}]+", " ")


def _found(docs: DataFrame, doc_id: str, text: str, content_hash: Callable[[Column], Column], keep: list[str]) -> DataFrame:
    """doc_id, the columns to keep, both hashes, keep_id, group_size and kept of each row."""
    whole = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(k).alias(f"_{n}") for n, k in enumerate(keep)], normalised(text).alias("norm")).withColumn("h", content_hash(F.col("norm")))
    sha = F.sha2("norm", 256).alias("text_sha256")
    groups = whole.groupBy("h", "norm").agg(F.count("*").alias("group_size"), F.min("doc_id").alias("keep_id")).select("h", sha, "group_size", "keep_id")
    rows = whole.select("doc_id", *[f"_{n}" for n in range(len(keep))], "h", sha)
    found = staged(rows, "hashes").join(staged(groups, "hash_groups"), ["h", "text_sha256"])
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row. content_hash: another hash, for tests."""
    return _found(docs, doc_id, text, content_hash, []).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: of those with the smallest doc_id any one."""
    keyed, keys = with_row_keys(docs)
    kept = _found(keyed, doc_id, text, F.md5, keys).filter("kept")
    stay = kept.groupBy("h", "text_sha256").agg(F.min(F.struct(F.col("_0").alias("_a"), F.col("_1").alias("_b"))).alias("r")).select("r.*")
    return having_keys(keyed, keys, staged(stay, "stay"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""
