"""What the operators share: the shared working folder, written intermediate tables, loading of documents."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of all word contracts; a word is a run of anything else.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"
ROWS_A_BATCH = 2000
WORDS = re.compile(WORD)
WORDS_BYTES = re.compile(WORD.encode())


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors reach: spark.checkpoint.dir. Only in local mode, where it may be
    unset, a temporary folder takes its place (the setting is then made); on any other master that is an error."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/") + "/" + spark.sparkContext.applicationId


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def staged(df: DataFrame, label: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: lineage ends there, so a lost
    executor costs a reread and no recomputation, and the planner knows the true size."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    """A table of the folder. Rows go to Python workers in batches of at most ROWS_A_BATCH, as whole texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_A_BATCH))
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """name, with as many underscores before it as make it differ from all columns of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_row_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with two columns that together name each row, and their names: the same however often docs is read.

    Rows of Parquet files are named by file and place in it; any other rows are written once with their numbers."""
    one, two = unused(docs, "_file"), unused(docs, "_place")
    if "_metadata" not in docs.columns:
        try:
            return docs.select("*", F.xxhash64("_metadata.file_path").alias(one), F.col("_metadata.row_index").alias(two)), [one, two]
        except AnalysisException:  # not rows of files
            pass
    return staged(docs.withColumns({one: F.lit(0).cast("long"), two: F.monotonically_increasing_id()}), "keyed"), [one, two]


def having_keys(keyed: DataFrame, keys: list[str], stay: DataFrame) -> DataFrame:
    """The rows whose keys are rows of stay (columns _a, _b), without the keys. Keys differ, so no task gets many of one; the same join at every size."""
    held = stay.select("_a", "_b").hint("shuffle_hash")
    return keyed.join(held, (keyed[keys[0]] == held["_a"]) & (keyed[keys[1]] == held["_b"]), "left_semi").drop(*keys)
