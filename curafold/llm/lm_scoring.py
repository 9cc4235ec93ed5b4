"""Operator 7, language-model scoring by the subword lattice.

The vocabulary, with its scores, is an existing subword model's. Each word is a lattice of all its
segmentations into pieces (with byte pieces for characters that are no piece); a piece's probability weights
them, and a forward recursion in log space returns the word's marginal probability. Pieces never cross words,
so a text's probability is the product over its words and the end, the same as one recursion over the text.
The file's scores give the first probabilities; one round of expectation-maximisation over all different
words of the training documents, weighted by their counts, gives the final ones.

The base score is a smoothed word unigram. Counts of all words are one distributed aggregation. The HEAD most
frequent words (a fixed number) are broadcast with their counts and probabilities; other words go with their
document through a shuffle, so no frequent word ever makes a large partition.

Defined cases: a null or empty text is the end only; a null doc_id counts as not held out (its remainder is
null) and keeps its row; repeated rows count each; with no training rows N and V are 0 and
the formula gives base_score 0; other columns aren't read.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter, deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged
from .tokens import columns, default_path, words_of

HEAD, SLICE, LONG, SMOOTHING = 100_000, 8_000_000, 4096, 0.1
#: The end of a text as a word: no word can contain a space.
END = " "
#: Factor a character on probabilities in the sums over segmentations, near their inverse.
SCALE = 100.0
MARK = "▁"
_lattices: dict = {}


class Lattice:
    """Natural-log probabilities of pieces in a trie, and the recursions over a word."""

    def __init__(self, logs: dict[str, float], byte_logs: list[float]):
        self.logs, self.byte_logs = logs, byte_logs
        self.longest = max(map(len, logs), default=1)
        self.root: dict = {}  # a node: next character to node; "" to (piece, log probability, scaled probability)
        for piece, x in logs.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = (piece, x, math.exp(x) * SCALE ** len(piece))

    @classmethod
    def load(cls, path: str) -> "Lattice":
        """Pieces of a sentencepiece file. Its scores are minus a rank, so a piece of rank r starts with weight 1/(r+10)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        weights, bytes_ = {}, [0.0] * 256
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                bytes_[int(model.id_to_piece(i)[3:5], 16)] = 1e-5
            elif not (model.is_control(i) or model.is_unknown(i)):
                weights[model.id_to_piece(i)] = 1.0 / (10.0 - model.get_score(i))
        weights[END] = 1e-3
        return cls.of_weights(weights, [x or 1e-5 for x in bytes_])

    @classmethod
    def of_weights(cls, weights: dict[str, float], bytes_: list[float]) -> "Lattice":
        total = math.log(math.fsum(weights.values()) + math.fsum(bytes_))
        return cls({p: math.log(w) - total for p, w in weights.items()}, [math.log(w) - total for w in bytes_])

    def arcs(self, text: str, i: int) -> list:
        """(end, piece or bytes, log probability, scaled probability) of what may start at i."""
        found, node, n = [], self.root, len(text)
        for j in range(i, n):
            node = node.get(text[j])
            if node is None:
                break
            if (leaf := node.get("")) is not None:
                found.append((j + 1, *leaf))
        if not found or found[0][0] > i + 1:
            raw = text[i].encode("utf-8", "surrogatepass")
            x = sum([self.byte_logs[b] for b in raw])
            found.append((i + 1, raw, x, math.exp(x) * SCALE))
        return found

    @staticmethod
    def _sum(logs: list[float]) -> float:
        if len(logs) == 1:
            return logs[0]
        most = max(logs)
        return most + math.log(sum([math.exp(x - most) for x in logs]))

    def _ahead(self, text: str, i: int, here: float, pending: deque) -> None:
        """Adds what may start at i to the terms of the places it reaches; pending[k] belongs to place i + k."""
        for j, _, x, _ in self.arcs(text, i):
            pending[j - i].append(here + x)

    def _forward(self, text: str):
        """Logarithms of the sums over segmentations up to place 0, 1, ...; as many terms are held as a piece is long."""
        pending = deque([[] for _ in range(self.longest + 1)])
        pending[0].append(0.0)
        for i in range(len(text) + 1):
            here = self._sum(pending[0])
            yield here
            if i < len(text):
                self._ahead(text, i, here, pending)
                pending.popleft()
                pending.append([])

    def log10(self, word: str) -> float:
        """Forward recursion in log space: the marginal over all segmentations."""
        if word == END:
            return self.logs[END] / math.log(10)
        text, last = MARK + word, 0.0
        if len(text) > LONG:
            for last in self._forward(text):
                pass
            return last / math.log(10)
        terms: list[list[float]] = [[0.0], *[[] for _ in text]]
        for i in range(len(text)):
            here = self._sum(terms[i])
            for j, _, x, _ in self.arcs(text, i):
                terms[j].append(here + x)
        return self._sum(terms[-1]) / math.log(10)

    def expect(self, word: str, count: float, uses: Counter) -> None:
        """Adds the expected number of uses of each piece in so many copies of the word. Probabilities are scaled by
        their lengths, which cancels; where that leaves the range of numbers the recursion is done with logarithms."""
        if word == END:
            uses[END] += count
            return
        text = MARK + word
        n = len(text)
        if n > LONG:
            return self._expect_long(text, count, uses)
        arcs = [self.arcs(text, i) for i in range(n)]
        alpha, beta = [1.0, *[0.0] * n], [*[0.0] * n, 1.0]
        for i in range(n):
            here = alpha[i]
            for j, _, _, p in arcs[i]:
                alpha[j] += here * p
        if not 1e-290 < alpha[n] < 1e290 or not all([1e-290 < x < 1e290 for x in alpha]):
            return self._expect_long(text, count, uses)
        whole = count / alpha[n]
        for i in range(n - 1, -1, -1):
            here, total = alpha[i] * whole, 0.0
            for j, piece, _, p in arcs[i]:
                rest = p * beta[j]
                total += rest
                self._use(uses, piece, here * rest)
            beta[i] = total

    def _expect_long(self, text: str, count: float, uses: Counter) -> None:
        """The same with logarithms; a word of any length takes eight bytes a character, and arcs are found twice instead of kept."""
        n = len(text)
        alpha = array("d", self._forward(text))
        beta = deque([0.0] + [0.0] * self.longest)  # beta[k] belongs to place i + 1 + k
        for i in range(n - 1, -1, -1):
            arcs = self.arcs(text, i)
            for j, piece, x, _ in arcs:
                self._use(uses, piece, count * math.exp(alpha[i] + x + beta[j - i - 1] - alpha[n]))
            beta.appendleft(self._sum([x + beta[j - i - 1] for j, _, x, _ in arcs]))
            beta.pop()

    @staticmethod
    def _use(uses: Counter, piece, share: float) -> None:
        if piece.__class__ is bytes:
            for byte in piece:
                uses[f"<0x{byte:02X}>"] += share
        else:
            uses[piece] += share


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different words of the texts, in lower case, and for each word in turn its number and its text's; the end is not among them."""
    words, bounds = words_of(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of = np.repeat(np.arange(len(texts)), np.diff(bounds))
    empty = pc.index(coded.dictionary, "").as_py()
    return (coded.dictionary, codes, of) if empty < 0 else (coded.dictionary, codes[codes != empty], of[codes != empty])


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


def word_counts(rows: DataFrame) -> DataFrame:
    """word, c: how often each word occurs in the training rows (doc_id, text, held_out); 0 if only elsewhere."""

    def run(batches):
        for batch in batches:
            training = ~batch.column(2).to_numpy(zero_copy_only=False)
            for at, texts in columns(batch, size=SLICE):
                words, codes, of = _coded(texts)
                own = training[at : at + len(texts)]
                counts = np.bincount(codes, weights=own[of], minlength=len(words)).astype(np.int64)
                some = np.bincount(codes, minlength=len(words)) > 0
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words.filter(pa.array(some)), pa.array([END])]), pa.array(np.append(counts[some], own.sum()))], ["word", "c"])

    return rows.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def train(counts: DataFrame, path: str) -> Lattice:
    """One EM round over all different training words; what reaches the driver is one number a piece."""

    def run(batches):
        lattice, expected = _lattices.setdefault(path, None) or Lattice.load(path), Counter()
        _lattices[path] = lattice
        for batch in batches:
            for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lattice.expect(w, c, expected)
        yield pa.RecordBatch.from_arrays([pa.array(list(expected), pa.string()), pa.array(list(expected.values()), pa.float64())], ["piece", "n"])

    found = {r[0]: r[1] for r in counts.filter("c > 0").mapInArrow(run, "piece string, n double").groupBy("piece").sum("n").collect()}
    first = Lattice.load(path)
    weights = {p: found.get(p, 0.0) + SMOOTHING for p in first.logs}
    return Lattice.of_weights(weights, [found.get(f"<0x{b:02X}>", 0.0) + SMOOTHING for b in range(256)])


def _least_frequent(counts: DataFrame, head: int) -> int:
    """The least count such that at most `head` words have it or more, from a histogram in steps of a sixteenth of a doubling.

    Words below go through the shuffle, so nothing is lost wherever it falls."""
    step = F.floor(F.log2("c") * 16)
    total, least = 0, 1 << 62
    for k, n in sorted(((int(r[0]), int(r[1])) for r in counts.filter("c > 0").groupBy(step.alias("k")).count().collect()), reverse=True):  # at most 16 x 63 rows
        total += n
        if total > head:
            break
        least = math.ceil(2 ** (k / 16) - 1e-9)
    return least


def score_documents(docs: DataFrame, vocabulary: str, head: int = HEAD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("held_out", _held_out())
    counts = staged(word_counts(rows), "word_counts")
    totals = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    tokens, kinds = int(totals[0] or 0), int(totals[1] or 0)
    sent = spark.sparkContext.broadcast(train(counts, vocabulary))

    def weigh(batches):
        lattice = sent.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([lattice.log10(w) for w in batch.column(0).to_pylist()], pa.float64())], ["word", "c", "lp"])

    weighed = staged(counts.mapInArrow(weigh, "word string, c long, lp double"), "word_scores")
    divisor = tokens + SMOOTHING * (kinds + 1)
    found = weighed.filter(F.col("c") >= _least_frequent(counts, head)).toArrow()  # at most `head` rows
    frequent, c = found.column("word").to_pylist(), found.column("c").to_numpy().astype(float)
    # the last entry stands for all words that aren't among them
    table = [np.append(np.log10((c + SMOOTHING) / divisor), 0.0), np.append(found.column("lp").to_numpy(), 0.0), np.append(c > 0, False).astype(float)]
    top = spark.sparkContext.broadcast(({w: k for k, w in enumerate(frequent)}, table))

    def run(batches):
        places, (base, lp, known) = top.value
        absent, end = len(base) - 1, places.get(END, len(base) - 1)
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "words", "counts"]
        for batch in batches:
            for at, texts in columns(batch, size=SLICE):
                n = len(texts)
                words, codes, of = _coded(texts)
                kinds = [places.get(w, absent) for w in words.to_numpy(zero_copy_only=False).tolist()]
                place = np.append(np.array(kinds, np.int64)[codes], np.full(n, end))
                doc = np.append(of, np.arange(n))
                sums = [np.bincount(doc, weights=x[place], minlength=n) for x in (known, base, lp)]
                rare = np.append(codes, np.full(n, len(words)))[place == absent]
                pairs, times = np.unique(doc[place == absent] * (len(words) + 1) + rare, return_counts=True)
                ends = pa.array(np.searchsorted(pairs, np.arange(n + 1) * (len(words) + 1)).astype("i4"))
                spelled = pa.concat_arrays([words, pa.array([END])]).take(pa.array(pairs % (len(words) + 1)))
                lists = [pa.ListArray.from_arrays(ends, x) for x in (spelled, pa.array(times.astype("i4")))]
                own = [batch.column(k).slice(at, n) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.bincount(doc, minlength=n)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), *lists], names)

    struct = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, words array<string>, counts array<int>"
    parts = staged(rows.mapInArrow(run, struct).withColumn("_row", F.monotonically_increasing_id()), "document_scores")
    rare = parts.select("_row", F.explode(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("n"))).alias("r")).select("_row", "r.word", "r.n").join(weighed, "word")
    c = F.col("c")
    sums = rare.groupBy("_row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("k"),
        F.sum(F.col("n") * F.log10((c + SMOOTHING) / F.lit(divisor))).alias("b"),
        F.sum(F.col("n") * F.col("lp")).alias("s"),
    )
    whole = parts.drop("words", "counts").join(sums, "_row", "left")
    add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
    return whole.select("doc_id", "held_out", "n_tokens", add("n_known", "k").cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), add("base_score", "b").alias("base_score"), add("score", "s").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), default_path("piece_bpe_32k.model"))
