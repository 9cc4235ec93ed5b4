"""Operator 6, quality classifier by co-training.

Two views of a document: its text content (words, and shares that its characters and
lines show) and its page metadata (language, source, length as the page states it, host). For each of the labels
quality and toxic, a linear classifier of each view is fitted on labelled rows. In each round both views judge every
document of the table, whole; the rows that one is sure of are pseudo-labels for the other, whose features Spark counts
over them, and the other is fitted again on labelled rows and these counts. The views are calibrated on labelled rows held
back from fitting, and combined by a small logistic model. A document is kept if quality is at least, and
toxicity below, one half.

Only labelled rows are sampled: at most LABELLED of them, those with the smallest hash of doc_id, reach the
driver, as features. Pseudo-labels come from all other rows, as counts of each feature. A feature takes
part if its likelihood ratio (G squared) would hardly occur by chance among all features; at most SELECTED do.
Copies of one text hardly count: labelled ones as one row, and a pseudo-labelled feature must stand in DIFFERENT texts.

Defined cases: a null or empty text has no content features and is scored by its metadata; null or absent lang,
source, url or n_chars are values of their own; labels that are null are not used, and of contradicting labels of one
document the worse counts; of rows that repeat a labelled doc_id the one with the smallest text hash is fitted on; with
no labels of both kinds the label's classifier abstains (probability 1/2, quality rounds up to kept); null and
repeated doc_ids keep their rows; an empty table gives an empty table; columns other than these aren't read.
"""

from __future__ import annotations

import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged
from .tokens import CACHE_BYTES, ENTRY, columns, words_of

LABELLED, ROUNDS, SURE = 6000, 3, 0.97
SELECTED, HELD_BACK, PULL, FEW, SEED = 4096, 5, 1e-2, 24, 17
#: Rows a feature must stand on for its G squared to be able to tell, so that it counts as one that is tried.
OFTEN = 4
#: Texts, copies not counted, that a feature must stand in to be taken from pseudo-labels.
DIFFERENT = 8
LABELS = ("quality", "toxic")
VIEWS = ("content", "metadata")
METADATA = ("lang", "source", "url", "n_chars")
#: Kinds of characters by byte: 1 capital, 2 letter (one for each letter beyond ASCII), 4 space, 8 mark, 16 shout, 32 begins a character.
_KIND = np.zeros(256, np.uint8)
_KIND[:0x80] |= 32
_KIND[0xC0:] |= 32 | 2
for _chars, _bit in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1 | 2), ("abcdefghijklmnopqrstuvwxyz", 2), (" \n", 4), ("#*$%&|<>", 8), ("!?", 16)):
    for _c in _chars:
        _KIND[ord(_c)] |= _bit
#: What is no part of a word's feature at its ends.
_ENDS = ".,;:!?\"'()|#$%&*"
#: Bytes of longer words are not worked on column-wise.
_LONG = 40
#: Bytes of characters that Arrow's lower case may leave otherwise than Python's; beside them only the letters of _CASED.
_ODD = np.isin(np.arange(256), [0xE1, 0xEA, *range(0xF0, 0x100)])
_CASED = ("\u0130", "\u03a3")
_SECOND = 0x5BD1E995
#: The checksum's step by byte, and what the second checksum of a word of each length adds to the first.
_STEP = np.array([zlib.crc32(bytes([k]), 0xFFFFFFFF) ^ 0xFFFFFFFF for k in range(256)], np.uint32)
_SHIFT = np.array([zlib.crc32(b"word\0" + bytes(k), _SECOND) ^ zlib.crc32(b"word\0" + bytes(k)) for k in range(_LONG + 1)], np.uint64)
_words: dict[str, int] = {}
_held = [0]


def _slot(kind: str, value: str, view: int = 0) -> int:
    """A 62-bit name of a feature; its last bit is its view."""
    raw = f"{kind}\0{value}".encode("utf-8", "surrogatepass")
    return ((zlib.crc32(raw) << 30 | zlib.crc32(raw, _SECOND) >> 2) << 1) | view


def _one_by_one(words: list[str]) -> np.ndarray:
    if _held[0] > CACHE_BYTES // 5:
        _words.clear()
        _held[0] = 0
    for w in words:
        if w not in _words:
            _words[w] = _slot("word", w.lower().strip(_ENDS))
            _held[0] += len(w) + ENTRY
    return np.fromiter(map(_words.__getitem__, words), np.int64, len(words))


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts one after another, and where each text's bytes begin and end."""
    ends = np.frombuffer(texts.buffers()[1], "<i4", len(texts) + 1, 4 * texts.offset).astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    size = int(ends[-1] - ends[0])
    return np.frombuffer(texts.buffers()[2], np.uint8, size, int(ends[0])) if size else np.zeros(0, np.uint8), ends - ends[0]


def word_features(words: pa.Array) -> np.ndarray:
    """The feature of each word: itself in lower case, without marks at its ends. The checksums that name
    them take a step for one byte of all words at once; long words and those with odd characters go one by one."""
    raw, ends = _raw(words)
    odd = np.zeros(len(words), bool)
    odd[np.searchsorted(ends, np.flatnonzero(_ODD[raw]), side="right") - 1] = True
    for letter in _CASED:
        odd |= pc.match_substring(words, letter).to_numpy(zero_copy_only=False)
    raw, ends = _raw(pc.ascii_trim(pc.utf8_lower(words), _ENDS))
    lengths = np.diff(ends)
    odd |= lengths > _LONG
    lengths[odd] = 0
    order = np.argsort(-lengths.astype(np.int8), kind="stable")  # the longest first
    starts = ends[:-1][order]
    state = np.full(len(words), zlib.crc32(b"word\0") ^ 0xFFFFFFFF, np.uint32)
    longer = len(words) - np.cumsum(np.bincount(lengths, minlength=1))
    for place, n in enumerate(longer[:-1].tolist()):
        state[:n] = _STEP[(state[:n] ^ raw[starts[:n] + place]) & 0xFF] ^ (state[:n] >> 8)
    first = np.empty(len(words), np.uint64)
    first[order] = ~state
    slots = ((first << 30 | (first ^ _SHIFT[lengths]) >> 2) << 1).astype(np.int64)
    if odd.any():
        slots[odd] = _one_by_one(words.filter(pa.array(odd)).to_pylist())
    return slots


def _steps(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.ceil(20 * part / np.maximum(whole, 1)).astype(np.int64)


def _layout(texts: pa.Array, n_words: np.ndarray, n_different: np.ndarray) -> np.ndarray:
    """Features of each text from shares in steps of a twentieth: capitals, other characters, marks, shouts, different words, lines."""
    raw, ends = _raw(texts)
    kinds, cuts = _KIND[raw], list(itertools.pairwise(ends.tolist()))

    def count(bit: int) -> np.ndarray:
        marks = (kinds & bit) > 0
        return np.array([np.count_nonzero(marks[a:b]) for a, b in cuts], np.int64)

    n, lines = count(32), pc.split_pattern(texts, "\n")
    offsets = lines.offsets.to_numpy().astype(np.int64)
    n_lines = np.diff(offsets)
    codes = lines.flatten().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), n_lines)
    different = np.bincount(np.unique(of * (len(codes) + 1) + codes) // (len(codes) + 1), minlength=len(texts)) if len(codes) else np.zeros(len(texts), np.int64)
    shares = {
        "upper": _steps(count(1), n),
        "other": _steps(np.maximum(n - count(2) - count(4), 0), n),
        "marks": _steps(count(8), n),
        "shouts": _steps(count(16), n),
        "different": _steps(n_different, n_words),
        "repeated lines": _steps(n_lines - different, n_lines),
        "words": _steps(n_words, n),
    }
    found = []
    for name, steps in shares.items():
        table = np.array([_slot(name, str(k)) for k in range(int(steps.max(initial=0)) + 1)], np.int64)
        found.append(table[steps])
    return np.stack(found, axis=1)


def _pairs(docs: np.ndarray, codes: np.ndarray, n_docs: int, n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of a text and a code once, in order; numbers of 32 bits are sorted faster."""
    kind = np.uint32 if n_docs * n_codes < 1 << 32 else np.int64
    keys = np.sort(docs.astype(kind) * kind(n_codes) + codes.astype(kind))
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    keys = keys[first]
    found = keys // kind(n_codes)
    return found.astype(np.int64), (keys - found * kind(n_codes)).astype(np.int64)


def content_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and feature, each pair once, by text."""
    texts = pc.fill_null(texts, "")
    words, bounds = words_of(texts)
    coded = words.dictionary_encode()
    kinds, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(bounds))
    empty = pc.index(kinds, "").as_py()
    if empty >= 0:
        of, codes = of[codes != empty], codes[codes != empty]
    doc, word = _pairs(of, codes, len(texts), max(len(kinds), 1))
    layout = _layout(texts, np.bincount(of, minlength=len(texts)), np.bincount(doc, minlength=len(texts)))
    slots, at = np.unique(np.concatenate([word_features(kinds), layout.ravel()]), return_inverse=True)  # words may share a feature
    docs = np.concatenate([doc, np.repeat(np.arange(len(texts)), layout.shape[1])])
    docs, places = _pairs(docs, np.concatenate([at[word], at[len(kinds) :]]), len(texts), max(len(slots), 1))
    return docs, slots[places]


def metadata_features(values: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """The same for the columns METADATA: values as they are, the host of a url, the length's number of binary digits, and two together."""
    lang, source, url, chars = (v.to_pylist() for v in values)
    docs, slots = [], []
    for i, (a, b, u, n) in enumerate(zip(lang, source, url, chars, strict=True)):
        host = "" if u is None else u.split("//")[-1].split("/")[0]
        size = "none" if n is None else str(int(n).bit_length())
        found = {_slot("lang", str(a), 1), _slot("source", str(b), 1), _slot("host", host, 1), _slot("length", size, 1), _slot("lang and length", f"{a} {size}", 1), _slot("source and length", f"{b} {size}", 1)}
        docs += [i] * len(found)
        slots += found
    return _once(np.array(docs, np.int64), np.array(slots, np.int64))


def _once(docs: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((slots, docs))
    docs, slots = docs[order], slots[order]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (slots[1:] != slots[:-1])
    return docs[first], slots[first]


def sketches(docs: np.ndarray, slots: np.ndarray, texts: pa.Array) -> np.ndarray:
    """A number for each text, from the least of its features' hashes under two orders: copies and most near copies agree,
    others hardly ever. A text of few features is told by its whole text."""
    n = len(texts)
    out = np.zeros(n, np.uint64)
    bounds = np.searchsorted(docs, np.arange(n + 1))
    some = bounds[1:] > bounds[:-1]
    for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        mixed = slots.astype(np.uint64) * np.uint64(factor)
        mixed ^= mixed >> np.uint64(29)
        least = np.zeros(n, np.uint64)
        least[some] = np.minimum.reduceat(mixed, bounds[:-1][some]) if some.any() else 0
        out = (out ^ least) * np.uint64(0xFF51AFD7ED558CCD)
    for i in np.flatnonzero(np.diff(bounds) < FEW).tolist():
        out[i] = (zlib.crc32((texts[i].as_py() or "").encode("utf-8", "surrogatepass")) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(design: np.ndarray, y: np.ndarray, start: list[float]) -> np.ndarray:
    """Weights of a logistic model by Newton's method, drawn towards the start, which matters only for few rows."""
    start = np.array(start)
    w = start.copy()
    loss = lambda w: np.logaddexp(0, design @ w).sum() - y @ (design @ w) + ((w - start) ** 2).sum() / 2
    for _ in range(50):
        p = _sigmoid(design @ w)
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + np.eye(len(w))
        step = np.linalg.solve(hessian, design.T @ (p - y) + (w - start))
        while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:  # where p is near 0 or 1 a whole step goes too far
            step /= 2
        w = w - step
    return w


class Linear:
    """Logistic regression of one view over the features that tell.

    Fitted on the labelled rows; features counted over pseudo-labelled rows draw their weights towards what these counts
    say (the logarithm of the odds ratio), so that they take part even if no labelled row has them."""

    def __init__(self, docs: np.ndarray, slots: np.ndarray, y: np.ndarray, weight: np.ndarray, chosen: np.ndarray, drawn: dict[int, float]):
        self.slots = np.union1d(chosen, np.fromiter(drawn, np.int64, len(drawn))).astype(np.int64)
        start = np.array([drawn.get(int(s), 0.0) for s in self.slots])
        pull = np.array([PULL if int(s) in drawn else 1e-4 for s in self.slots])
        rows, cols = self._found(docs, slots)
        n, total = len(y), weight.sum()
        w, b = start.copy(), math.log((weight @ y + 1) / (total - weight @ y + 1))
        squares, square = np.full(len(w), 1e-6), 1e-6
        for _ in range(150):
            gap = (_sigmoid(np.bincount(rows, weights=w[cols], minlength=n) + b) - y) * weight
            grad, mean = np.bincount(cols, weights=gap[rows], minlength=len(w)) / total + pull * (w - start), gap.sum() / total
            squares += grad**2
            square += mean**2
            w -= 0.5 * grad / np.sqrt(squares)
            b -= 0.1 * mean / math.sqrt(square)
        self.weights, self.bias = w, b

    def _found(self, docs: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.slots):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.slots, slots), len(self.slots) - 1)
        hit = self.slots[at] == slots
        return docs[hit], at[hit]

    def margins(self, docs: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        rows, cols = self._found(docs, slots)
        return np.bincount(rows, weights=self.weights[cols], minlength=n) + self.bias


def g_squared(rare, every, n_rare, n):
    """Likelihood ratio of a feature seen on so many rows of the rarer class and of all; written for numbers and for columns."""
    cells = [(rare, every * n_rare / n), (every - rare, every - every * n_rare / n), (n_rare - rare, n_rare - every * n_rare / n), (n - n_rare - every + rare, n - n_rare - every + every * n_rare / n)]
    if isinstance(every, Column):
        terms = [F.when((a > 0) & (b > 0), a * F.log(a / b)).otherwise(0.0) for a, b in cells]
        return 2 * (terms[0] + terms[1] + terms[2] + terms[3])
    return 2 * sum(np.where((a > 0) & (b > 0), a * np.log(np.maximum(a, 1e-300) / np.maximum(b, 1e-300)), 0.0) for a, b in cells)


def chance(features: float) -> float:
    """What G squared exceeds by chance on about one of so many features."""
    return 2 * math.log(max(features, 2))


class CoTrained:
    """Two views of one label, their calibration, and their combination; y is 1 for the label's rarer class."""

    def __init__(self, sample: "Sample", rare_is: int, y: np.ndarray, drawn: list[dict[int, float]]):
        self.rare_is = rare_is
        self.views = [sample.fitted(v, y, drawn[v]) for v in (0, 1)]
        back = sample.back
        x = np.stack([view.margins(*sample.features[k], len(y)) for k, view in enumerate(self.views)], axis=1)[back].clip(-8, 8)
        one = np.ones((len(x), 1))
        self.alone = [logistic(np.hstack([x[:, [k]], one]), y[back], [1.0, 0.0]) for k in (0, 1)]
        self.mix = logistic(np.hstack([x, one]), y[back], [1.0, 0.5, 0.0])

    def _margins(self, features: list, n: int) -> list[np.ndarray]:
        return [v.margins(*f, n).clip(-8, 8) for v, f in zip(self.views, features, strict=True)]

    def probability(self, features: list, n: int) -> np.ndarray:
        """Of the rarer class, by both views."""
        x = self._margins(features, n)
        return _sigmoid(self.mix[0] * x[0] + self.mix[1] * x[1] + self.mix[2])

    def pseudo_labels(self, features: list, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each view what the other one tells it: rows surely of the rarer class, and rows surely of either."""
        p = [_sigmoid(a[0] * m + a[1]) for a, m in zip(self.alone, self._margins(features, n), strict=True)]
        told = [(x > SURE, (x > SURE) | (x < 1 - SURE)) for x in p]
        return [told[1], told[0]]


class Sample:
    """Features of the labelled rows; every HELD_BACK-th is held back, and copies share one row's weight."""

    def __init__(self, content: list[np.ndarray], metadata: list[np.ndarray], sketch: np.ndarray):
        self.size = len(content)
        flat = lambda sets: (np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int64))
        self.features = [flat(content), flat(metadata)]
        _, copy, copies = np.unique(sketch, return_inverse=True, return_counts=True)
        self.weight = 1.0 / copies[copy]
        self.back = np.arange(self.size) % HELD_BACK == 0

    def fitted(self, view: int, y: np.ndarray, drawn: dict[int, float]) -> "Linear":
        docs, slots = self.features[view]
        used = ~self.back[docs]
        docs, slots = docs[used], slots[used]
        kinds, at = np.unique(slots, return_inverse=True)
        w = np.where(self.back, 0.0, self.weight)
        every, rare = np.bincount(at, weights=w[docs], minlength=len(kinds)), np.bincount(at, weights=(w * y)[docs], minlength=len(kinds))
        g = g_squared(rare, every, (w * y).sum(), w.sum())
        most = np.argsort(-g, kind="stable")[:SELECTED]
        return Linear(docs, slots, y, w, kinds[most[g[most] > chance((every >= OFTEN).sum())]], drawn)


def _columns(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    kinds = {"n_chars": "long"}
    return [F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *[(F.col(c) if c in docs.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in METADATA]]


def _both(batch: pa.RecordBatch, at: int, texts: pa.Array) -> list:
    return [content_features(texts), metadata_features([batch.column(2 + k).slice(at, len(texts)) for k in range(len(METADATA))])]


def _sampled(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[list, list[list], Sample]:
    """ids, labels and features of at most LABELLED rows."""
    rank = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("int").alias(c) for c in LABELS]).filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    some = known.orderBy(rank, "doc_id").limit(LABELLED)  # rows of three numbers
    chosen = docs.select(*_columns(docs, doc_id, text)).join(F.broadcast(some), "doc_id").select("doc_id", "text", *METADATA, *LABELS, F.xxhash64("text").alias("h"))

    def run(batches):
        for batch in batches:
            for at, texts in columns(batch):
                lists, both = [], _both(batch, at, texts)
                sketch = pa.array(sketches(*both[0], texts).view(np.int64))
                for of, slots in both:
                    lists.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(texts) + 1)).astype("i4")), pa.array(slots)))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(at, len(texts)) for c in (0, 6, 7, 8)], sketch, *lists], ["doc_id", *LABELS, "h", "sketch", *VIEWS])

    rows = chosen.mapInArrow(run, "doc_id long, quality int, toxic int, h long, sketch long, content array<long>, metadata array<long>")
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct(*LABELS, "sketch", *VIEWS), F.struct("h", "quality", "toxic")).alias("r")).select("doc_id", "r.*")
    found = one.toArrow().sort_by("doc_id").combine_chunks()
    lists = [[np.asarray(x.values) for x in found.column(v).combine_chunks()] if len(found) else [] for v in VIEWS]
    return found.column("doc_id").to_pylist(), [found.column(c).to_pylist() for c in LABELS], Sample(*lists, found.column("sketch").to_numpy())


def _counted(docs: DataFrame, models: dict[str, CoTrained], sampled: list, doc_id: str, text: str) -> DataFrame:
    """For each feature, over all rows outside the sample: how many rows the other view is sure of (n), how many of these
    it puts in the label's rarer class (rare), and a mask of 64 bits (one set for each such text's sketch, so that copies
    set one), for each label. Slots -2 and -1 count the rows themselves for content and metadata."""
    outside = pa.array(sampled, pa.int64())
    names = [f"{c}_{x}" for c in LABELS for x in ("rare", "n", "mask")]

    def merged(parts: list) -> list:
        slots = np.concatenate([p[0] for p in parts])
        order = np.argsort(slots, kind="stable")
        slots = slots[order]
        first = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        values = np.concatenate([p[1] for p in parts])[order]
        reduce = (np.bitwise_or if k % 3 == 2 else np.add for k in range(len(names)))
        return [slots[first], np.stack([r.reduceat(values[:, k], first) for k, r in enumerate(reduce)], axis=1)]

    def out(part: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(part[0]), *[pa.array(part[1][:, k]) for k in range(len(names))]], ["slot", *names])

    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            for at, texts in columns(batch):
                features, n = _both(batch, at, texts), len(texts)
                free = ~pc.fill_null(pc.is_in(batch.column(0).slice(at, n), value_set=outside), False).to_numpy(zero_copy_only=False)
                bit = np.left_shift(np.int64(1), (sketches(*features[0], texts) >> np.uint64(58)).astype(np.int64))
                marks = [np.zeros((n, len(names)), np.int64) for _ in VIEWS]
                for k, label in enumerate(LABELS):
                    if label in models:
                        for v, (rare, known) in enumerate(models[label].pseudo_labels(features, n)):
                            marks[v][:, 3 * k] = rare & free
                            marks[v][:, 3 * k + 1] = known & free
                            marks[v][:, 3 * k + 2] = bit * (rare & free)
                for v, (of, slots) in enumerate(features):
                    some = (marks[v][:, 1] + marks[v][:, 4] > 0)[of]
                    waiting.append(merged([[np.append(slots[some], np.full(n, v - 2)), np.concatenate([marks[v][of[some]], marks[v]])]]))
                    size += len(waiting[-1][0])
                if size > 2_000_000:
                    waiting = [merged(waiting)]
                    size = len(waiting[0][0])
                    if size > 1_000_000:  # memory stays bounded: Spark adds up what is sent in parts
                        yield out(waiting[0])
                        waiting, size = [], 0
        if waiting:
            yield out(merged(waiting))

    rows = docs.select(*_columns(docs, doc_id, text)).mapInArrow(run, "slot long, " + ", ".join(f"{c} long" for c in names))
    return rows.groupBy("slot").agg(*[(F.bit_or if c.endswith("mask") else F.sum)(c).alias(c) for c in names])


def _drawn(counts: DataFrame, label: str, view: int) -> dict[int, float]:
    """Features that tell by the pseudo-labels a view was given, with the logarithm of their odds ratio."""
    rare, n, mask = (f"{label}_{x}" for x in ("rare", "n", "mask"))
    rows = counts.filter(F.col("slot") == view - 2).first()
    if rows is None or not 0 < rows[rare] < rows[n]:
        return {}
    own = counts.filter((F.col("slot") >= 0) & (F.pmod("slot", F.lit(2)) == view) & (F.col(n) > 0))
    kinds = own.filter(F.col(n) >= OFTEN).count()
    g = g_squared(F.col(rare).cast("double"), F.col(n).cast("double"), float(rows[rare]), float(rows[n]))
    telling = own.filter(F.bit_count(mask) >= DIFFERENT).select("slot", F.col(rare).alias("rare"), F.col(n).alias("n"), g.alias("g")).filter(F.col("g") > chance(kinds))
    logit = lambda a, b: math.log((a + 0.5) / (b - a + 0.5))
    return {r.slot: min(max(logit(r.rare, rows[rare]) - logit(r.n - r.rare, rows[n] - rows[rare]), -4.0), 4.0) for r in telling.orderBy(F.desc("g"), "slot").limit(SELECTED).collect()}


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> dict[str, CoTrained]:
    """A classifier for each label that has rows of both kinds."""
    ids, marks, sample = _sampled(docs, labels, doc_id, text)
    targets = {}
    for name, values in zip(LABELS, marks, strict=True):
        y = np.array([float(v > 0) for v in values])
        rare_is = int(2 * y.sum() <= len(y))
        if len(y) >= 2 * HELD_BACK and 0 < y[~sample.back].sum() < (~sample.back).sum():
            targets[name] = (rare_is, y if rare_is else 1 - y)
    models = {name: CoTrained(sample, *target, [{}, {}]) for name, target in targets.items()}
    for _ in range(rounds - 1 if models else 0):
        counts = staged(_counted(docs, models, ids, doc_id, text), "pseudo_labels")
        models = {name: CoTrained(sample, *target, [_drawn(counts, name, v) for v in (0, 1)]) for name, target in targets.items()}
    return models


def _judged(models: dict[str, CoTrained], features: list, n: int) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Quality, toxicity (None without a classifier) and verdict of each text."""

    def chance_of(name: str):
        if name not in models:
            return None
        p = models[name].probability(features, n)
        return p if models[name].rare_is else 1 - p

    good, bad = chance_of("quality"), chance_of("toxic")
    good = np.full(n, 0.5) if good is None else good
    return good, bad, (good >= 0.5) & (True if bad is None else bad < 0.5)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, quality, toxicity (probabilities), kept of each row."""
    models = train(docs, labels, doc_id, text)

    def run(batches):
        for batch in batches:
            for at, texts in columns(batch):
                good, bad, kept = _judged(models, _both(batch, at, texts), len(texts))
                arrays = [batch.column(0).slice(at, len(texts)), pa.array(good), pa.nulls(len(texts), pa.float64()) if bad is None else pa.array(bad), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "quality", "toxicity", "kept"])

    return docs.select(*_columns(docs, doc_id, text)).mapInArrow(run, "doc_id long, quality double, toxicity double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns; each row is judged where it is read, without a shuffle."""
    models = train(docs, labels, doc_id, text)

    @F.arrow_udf("boolean")
    def kept(ids: pa.Array, texts: pa.Array, lang: pa.Array, source: pa.Array, url: pa.Array, chars: pa.Array) -> pa.Array:
        batch, verdicts = pa.RecordBatch.from_arrays([ids, texts, lang, source, url, chars], ["doc_id", "text", *METADATA]), []
        for at, part in columns(batch):
            verdicts.append(_judged(models, _both(batch, at, part), len(part))[2])
        return pa.array(np.concatenate([*verdicts, np.zeros(0, bool)]), pa.bool_())

    return docs.filter(kept(*_columns(docs, doc_id, text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))
