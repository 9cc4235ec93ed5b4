"""Token ids of whole texts by the tokenizers library, and the Arrow plumbing of the operators that use them."""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a worker's cache of words may take; it is emptied when full, so its memory is bounded.
CACHE_BYTES = 96 << 20
#: What an entry of such a cache takes besides its own bytes, about.
ENTRY = 140
#: Entries of other caches of small values in a worker.
CACHE = 600_000
_encoders: dict[str, "WordEncoder"] = {}


def lowered(texts: pa.Array) -> pa.Array:
    """A-Z in lower case and null as the empty text; texts that may hold a special token's string stay as they are."""
    texts = pc.fill_null(texts, "")
    special, lower = pc.match_substring(texts, "<|"), pc.ascii_lower(texts)
    return pc.if_else(special, texts, lower) if pc.any(special).as_py() else lower


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another (some may be empty), and where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... (lengths[i] of them), one i after another."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class WordEncoder:
    """Ids of texts as unsigned 32-bit numbers.

    The tokenizer's normaliser and splitter never join characters across white space, so a text's ids are
    those of its words one after another, and each different word of a batch needs a look-up once. A new word
    of ASCII and Latin letters is cut into the splitter's pieces here and each new piece goes to the library's
    model; any other word (special tokens, control characters, other scripts) goes through the whole library.
    """

    #: The splitter's pattern over the characters that are cut here, which are all in normal form.
    LETTERS = "a-zà-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįıĳĵķĸĺļľŀłńņňŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżž"
    PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+")
    PLAIN = re.compile(rf"[!-~{LETTERS}]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # byte-level alphabet: other bytes follow from 256 on
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used, self.held = np.zeros(4096, np.uint32), 0, 0

    def _piece(self, piece: str) -> tuple[int, ...]:
        text = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = self.pieces[piece] = tuple([t.id for t in self.model.tokenize(text)])
        self.held += len(text) + ENTRY
        return ids

    def word(self, word: str) -> tuple[int, ...] | list[int]:
        low = word.lower()
        if "<|" in word or not self.PLAIN.fullmatch(low) or "İ" in word:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        known = self.pieces.get
        return [i for p in self.PIECES.findall(low) for i in known(p) or self._piece(p)]

    def _learn(self, words: list[str]) -> None:
        flat: list[int] = []
        first, ends, known = len(self.places), [], self.pieces.get
        for w in words:
            # a word of ASCII letters is one piece
            flat += (known(w) or self._piece(w.lower())) if w.isascii() and w.isalpha() else self.word(w)
            ends.append(len(flat))
        self.held += sum(map(len, words)) + ENTRY * len(words)
        self.places.update(zip(words, range(first, first + len(words)), strict=True))
        total, more = len(self.places), self.used + len(flat)
        for name, size in (("starts", total), ("lengths", total), ("pool", more)):
            old = getattr(self, name)
            if size > len(old):
                new = np.zeros(2 * size, old.dtype)
                new[: len(old)] = old
                setattr(self, name, new)
        stops = np.array(ends, np.int64)
        begins = np.concatenate([[0], stops[:-1]])
        self.starts[first:total], self.lengths[first:total] = begins + self.used, stops - begins
        self.pool[self.used : more] = flat
        self.used, self.held = more, self.held + 4 * len(flat)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids begin and end (one entry more than texts)."""
        words, bounds = words_of(lowered(texts))
        coded = words.dictionary_encode()
        kinds = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if self.held > CACHE_BYTES:
            self._forget()
        places = self.places
        new = [w for w in kinds if w not in places]
        if new:
            self._learn(new)
        at = np.fromiter(map(places.__getitem__, kinds), np.int64, len(kinds))[coded.indices.to_numpy(zero_copy_only=False)] if kinds else np.zeros(0, np.int64)
        lengths = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.pool[spread(self.starts[at], lengths)], ends[bounds]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Of each text its ids as little-endian unsigned 32-bit bytes."""
        ids, bounds = self.encode_column(pa.array(texts, pa.string()))
        raw = ids.astype("<u4").tobytes()
        cuts = (4 * bounds).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def encoder(path: str) -> WordEncoder:
    """One for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def columns(batch: pa.RecordBatch, text: int = 1, size: int = 3_000_000):
    """Parts of a batch with about so many bytes of text, each as (start, column of texts)."""
    column = batch.column(text)
    if not len(column):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < len(column):
        stop = min(max(int(np.searchsorted(ends, before + size, side="left")) + 1, start + 1), len(column))
        yield start, column.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds little


def slices(batch: pa.RecordBatch, text: int = 1, size: int = 4_000_000):
    """Parts of a batch with about so many bytes of text, each as (start, texts); null is the empty text."""
    for start, column in columns(batch, text, size):
        yield start, [t or "" for t in column.to_pylist()]


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def default_path(name: str) -> str:
    """Where the installed public tokenizers keep a file; every operator takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)
