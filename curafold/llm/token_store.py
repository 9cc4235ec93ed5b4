"""Operator 2, token-id output: documents compressed one by one with a shared zstandard dictionary.

File format. A store is a folder of Parquet files (so that any store Spark writes to will do, and Spark's
commit protocol makes retried tasks safe). A row is a block of neighbouring documents in ascending doc_id
order: part, seq (order of blocks), dict_sha256 and width (bytes of an id), start (ids before the block in
its part), first/last doc_id, the offset index (doc_ids, offsets, n_tokens) and payload, the frames one
after another. A frame holds one document's ids, little-endian, compressed with the dictionary, so a short
document is read by one slice of one block. The dictionary is a one-row table beside the blocks.

The dictionary is trained on at most SAMPLE documents, those with the smallest hash of doc_id (a documented,
bounded sample; any dictionary gives the same ids back). Every document is encoded whole and stored.

Defined cases: a null or empty text has the end id only; null doc_ids come first; rows that repeat a doc_id
are stored one after another in the order of their texts' hashes; an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, new_path, text_of
from .tokens import columns, crc32, default_path, encoder, slices

SAMPLE, SAMPLE_BYTES, DICTIONARY_BYTES = 2048, 64 << 10, 64 << 10
BLOCK_BYTES, BLOCK_DOCS, LEVEL = 1 << 20, 4096, 3
END = 1
BLOCKS = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("dict_sha256", pa.string()), ("width", pa.int32()), ("start", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int32())), ("n_tokens", pa.list_(pa.int32())), ("payload", pa.binary()),
])
BLOCKS_DDL = "part int, seq int, dict_sha256 string, width int, start long, first_id long, last_id long, doc_ids array<long>, offsets array<int>, n_tokens array<int>, payload binary"


def _narrow(ids: bytes, width: int) -> bytes:
    return np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def _dictionary(content: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(content) if content else None


def train_dictionary(docs: DataFrame, tokenizer: str, width: int, end: int = END) -> bytes:
    """docs: doc_id, text. Empty if there is nothing to learn from."""
    import zstandard

    rank = F.xxhash64("doc_id")
    last = docs.select(rank.alias("r")).orderBy("r").limit(SAMPLE).agg(F.max("r")).first()[0]
    if last is None:
        return b""

    def encode(batches):
        for batch in batches:
            for _, texts in slices(batch):
                ids = [_narrow(x + end.to_bytes(4, "little"), width) for x in encoder(tokenizer).encode(texts)]
                ids = [x for x in ids if len(x) <= SAMPLE_BYTES]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    rows = docs.filter(rank <= last).limit(SAMPLE).mapInArrow(encode, "ids binary").collect()
    samples = sorted(bytes(r.ids) for r in rows)
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples: their own bytes then serve as the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _block_writer(tokenizer: str, width: int, end: int, content: bytes):
    sha = hashlib.sha256(content).hexdigest()

    def write(batches):
        import zstandard

        shared = _dictionary(content)
        if shared is not None:
            shared.precompute_compress(level=LEVEL)  # digested once, not for each document
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        ids, offsets, counts, payload, held = [], [0], [], [], 0

        def block():
            nonlocal seq, start, ids, offsets, counts, payload, held
            row = [[part], [seq], [sha], [width], [start], [ids[0]], [ids[-1]], [ids], [offsets], [counts], [b"".join(payload)]]
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, BLOCKS, strict=True)], schema=BLOCKS)
            seq, start = seq + 1, start + sum(counts)
            ids, offsets, counts, payload, held = [], [0], [], [], 0
            return out

        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, column in columns(batch):
                found, bounds = encoder(tokenizer).encode_column(column)
                whole = np.insert(found, bounds[1:], end).astype(f"<u{width}").tobytes()
                cuts = (width * (bounds + np.arange(len(bounds)))).tolist()
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    raw = whole[a:b]
                    frame = packer.compress(raw)
                    ids.append(keys[at + k])
                    counts.append(len(raw) // width)
                    payload.append(frame)
                    held += len(frame)
                    offsets.append(held)
                    if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                        yield block()
        if ids:
            yield block()

    return write


def write_token_store(docs: DataFrame, path: str, tokenizer: str, end: int = END, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of docs under path, in ascending doc_id order."""
    vocabulary = encoder(tokenizer).tokenizer.get_vocab_size(True)
    width = 2 if max(vocabulary, end + 1) <= 1 << 16 else 4
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    content = train_dictionary(slim, tokenizer, width, end)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = slim.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    ordered.mapInArrow(_block_writer(tokenizer, width, end, content), BLOCKS_DDL).write.option("compression", "none").parquet(f"{path}/blocks")
    table = pa.table({"sha256": [hashlib.sha256(content).hexdigest()], "content": [content]})
    docs.sparkSession.createDataFrame(table).coalesce(1).write.parquet(f"{path}/dictionary")


def _load(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    content = bytes(row.content)
    if hashlib.sha256(content).hexdigest() != row.sha256:
        raise ValueError(f"the dictionary of {path} is damaged")
    return content


def _frames(batch: pa.RecordBatch, content: bytes, only: set | None = None):
    """(row of the block, place in it, doc_id, ids as bytes, width, ids before it in the block)"""
    import zstandard

    opener, sha = zstandard.ZstdDecompressor(dict_data=_dictionary(content)), hashlib.sha256(content).hexdigest()
    for b, row in enumerate(batch.to_pylist()):
        if row["dict_sha256"] != sha:
            raise ValueError("a block was written with another dictionary")
        before = 0
        for k, (key, n) in enumerate(zip(row["doc_ids"], row["n_tokens"], strict=True)):
            if only is None or key in only:
                raw = opener.decompress(row["payload"][row["offsets"][k] : row["offsets"][k + 1]], max_output_size=n * row["width"])
                yield b, k, key, raw, row["width"], before
            before += n


def read_token_store(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids."""
    content = _load(spark, path)
    blocks = spark.read.parquet(f"{path}/blocks")
    totals = blocks.select("part", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n")).groupBy("part").sum("n").collect()
    base, before = {}, 0
    for part, n in sorted(totals):  # one entry for each written partition, not for each document
        base[part], before = before, before + n

    def decode(batches):
        for batch in batches:
            for one in (batch.slice(k, 1) for k in range(len(batch))):
                part, start = one.column("part")[0].as_py(), one.column("start")[0].as_py()
                rows = []
                for _, _, key, raw, width, within in _frames(one, content):
                    whole = np.frombuffer(raw, f"<u{width}").astype("<u4")
                    rows.append((key, base[part] + start + within, len(whole), crc32(whole.tobytes()), whole if ids else None))
                keys, starts, counts, sums, arrays = zip(*rows, strict=True)
                columns = [pa.array(x, pa.int64()) for x in (keys, starts, counts, sums)]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(arrays, pa.list_(pa.int64()))] if ids else []), names + ["ids"] * ids)

    return blocks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids)


def fetch(spark: SparkSession, path: str, wanted: list[int]) -> dict[int, list[int]]:
    """Ids of a few documents: the block index selects blocks, the offset index their frames."""
    content, only = _load(spark, path), set(wanted)
    near = F.lit(False)
    for x in only:
        near = near | ((F.col("first_id").isNull() | (F.col("first_id") <= x)) & (F.col("last_id") >= x))  # null ids come first
    blocks = spark.read.parquet(f"{path}/blocks").filter(near & F.arrays_overlap("doc_ids", F.array(*map(F.lit, only)).cast("array<bigint>"))) if only else None
    if blocks is None:
        return {}
    return {key: np.frombuffer(raw, f"<u{width}").tolist() for batch in blocks.toArrow().to_batches() for _, _, key, raw, width, _ in _frames(batch, content, only)}


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token_store")
    write_token_store(documents(spark, sf_dir), path, default_path("word_bpe_49k.json"))
    return read_token_store(spark, path)
