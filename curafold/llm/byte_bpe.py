"""Operator 3, byte-level BPE as a monoid tree reduction.

A long piece is halved until its parts are short, parts are encoded, and neighbours are joined: the bytes
of a window of tokens around the seam are encoded again, and the window doubles until the tokens outside it
provably keep. The proof: a sequence of tokens is the BPE encoding of its bytes if and only if each two
neighbours are the encoding of their own bytes. Inside the left rest, the window and the right rest that
holds already, so only the two pairs at the window's edges are looked at. Decoding joins bytes up a tree.

Whole pieces that are a token are that token, as in the rank-file library. Texts are first cut before the
white space that follows a non-space: no match of the split pattern crosses such a cut, so each different
chunk of a text is split and encoded once.

Defined cases: a null or empty text has no ids, ids_sha256 and decoded_sha256 of the empty string. Null and
repeated doc_ids are carried. An empty table gives an empty table. Other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .tokens import CACHE, CACHE_BYTES, ENTRY, default_path, slices

LEAF, WINDOW, FLAT = 64, 4, 96
#: Unicode white space; Python's own class also has 1C to 1F, which the split pattern doesn't count as space.
CHUNKS = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
_codecs: dict[tuple, "ByteBPE"] = {}


class ByteBPE:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pieces = ranks, regex.compile(pattern)
        self.bytes_of = {v: k for k, v in ranks.items()}
        self.chunks: dict[str, list[int]] = {}
        self.held = 0
        self.pairs: dict[tuple[int, int], bool] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> "ByteBPE":
        if (path, pattern) not in _codecs:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
            _codecs[path, pattern] = cls(ranks, pattern)
        return _codecs[path, pattern]

    def _short(self, data: bytes) -> list[int]:
        """Merges of the lowest rank first, the leftmost of equal ones; ranks of pairs are kept beside the parts."""
        rank, none = self.ranks.get, 1 << 60
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (low := min(pairs)) != none:
            at = pairs.index(low)
            merged = parts[at] + parts[at + 1]
            parts[at : at + 2] = [merged]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + merged, none)
            if at < len(pairs):
                pairs[at] = rank(merged + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def _heaped(self, data: bytes) -> list[int]:
        """The same with a heap of pairs, O(n log n), for windows that had to grow."""
        ranks, n = self.ranks, len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := ranks.get(parts[x] + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [ranks[p] for p in parts if p is not None]

    def flat(self, data: bytes) -> list[int]:
        return self._short(data) if len(data) <= FLAT else self._heaped(data)

    def keeps(self, a: int, b: int) -> bool:
        """Whether two neighbouring tokens are the encoding of their bytes."""
        if (kept := self.pairs.get((a, b))) is None:
            if len(self.pairs) > CACHE:
                self.pairs.clear()
            kept = self.pairs[a, b] = self.flat(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return kept

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's product: the encoding of the two sides' bytes together."""
        if not left or not right:
            return left or right
        size = WINDOW
        while True:
            i, j = max(0, len(left) - size), min(len(right), size)
            middle = self.flat(b"".join([self.bytes_of[t] for t in chain(left[i:], right[:j])]))
            if (i == 0 or self.keeps(left[i - 1], middle[0])) and (j == len(right) or self.keeps(middle[-1], right[j])):
                return left[:i] + middle + right[j:]
            size *= 2

    def tree(self, data: bytes) -> list[int]:
        if len(data) <= LEAF:
            return self._short(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, data: bytes) -> list[int]:
        return [token] if (token := self.ranks.get(data)) is not None else self.tree(data)

    def _learn(self, chunk: str) -> list[int]:
        """Pieces are looked up as chunks of their own, which they are: most new chunks are known words with other marks."""
        parts = self.pieces.findall(chunk)
        if len(parts) == 1:
            ids = self.piece(chunk.encode())
        else:
            ids = [i for p in parts for i in (self.chunks.get(p) or self._learn(p))]
        self.chunks[chunk] = ids
        self.held += len(chunk) + 8 * len(ids) + ENTRY
        return ids

    def encode(self, text: str) -> list[int]:
        if self.held > CACHE_BYTES:
            self.chunks.clear()
            self.held = 0
        known, learn = self.chunks.get, self._learn
        return list(chain.from_iterable([known(c) or learn(c) for c in CHUNKS.findall(text)]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join([self.bytes_of[i] for i in ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encode_documents(docs: DataFrame, ranks: str, pattern: str, ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids of each whole text."""
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches):
        codec = ByteBPE.load(ranks, pattern)
        names = [str(i) for i in range(max(codec.bytes_of, default=0) + 1)]
        for batch in batches:
            for at, texts in slices(batch):
                rows = []
                for t in texts:
                    own = codec.encode(t)
                    rows.append((len(own), sha(" ".join([names[i] for i in own]).encode()), sha(codec.decode(own)), own if ids else None))
                n, a, b, own = zip(*rows, strict=True)
                columns = [batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(own, pa.list_(pa.int64()))] if ids else []), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids)

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * ids)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, text of rows (doc_id, ids)."""

    def run(batches):
        codec = ByteBPE.load(ranks, pattern)
        for batch in batches:
            texts = [codec.decode(x or []).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_documents(documents(spark, sf_dir), default_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
