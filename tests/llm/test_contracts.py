"""What the queries return, by brute force over a small folder of documents: digests, counts, places and fits."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curafold.llm import packing, pii, quality_classifier, quality_rules, queries
from curafold.llm.tokens import encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 9))) for _ in range(400)]
    out = {i: " ".join(rng.choices(words, k=rng.randint(1, 300))) for i in range(50)}
    out |= {60: None, 61: "", 62: " \n\t ", 63: "a b c d e " * 9, 64: "one line\none line\n\none line", 65: "#*$%&|<> symbols", 66: "x" * 20_000, 67: "word " * 5000}
    return out | {68: out[1], 69: out[1] + " more"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, texts):
    path = str(tmp_path_factory.mktemp("contracts"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_quality_rules(spark, folder, texts):
    out = {r.doc_id: r for r in queries.QUERIES["op1_quality_rules"](spark, folder).collect()}
    assert len(out) == len(texts)
    for i, t in texts.items():
        words = WORD.findall(t or "")
        windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words)) and not (r.base_failed and r.kept)


def test_expectation_maximisation(spark):
    """The fit and the posterior against the same model on plain arrays, and on votes whose truth is known."""
    rng = np.random.default_rng(3)
    names = ["a", "b", "c"]
    truth = rng.random(3000) < 0.8
    votes = np.stack([np.where(rng.random(3000) < np.where(truth, 0.85, 0.2), 1, np.where(rng.random(3000) < np.where(truth, 0.1, 0.8), -1, 0)) for _ in names], axis=1)
    df = spark.createDataFrame([tuple(map(int, v)) for v in votes], ", ".join(f"{n} int" for n in names))
    prior, chance = quality_rules.fit(df, names)
    p, c = quality_rules.PRIOR, {n: {v: list(x) for v, x in quality_rules.START.items()} for n in names}
    for _ in range(12):
        good, bad = np.full(3000, p), np.full(3000, 1 - p)
        for k, n in enumerate(names):
            good, bad = good * np.array([c[n][v][0] for v in votes[:, k]]), bad * np.array([c[n][v][1] for v in votes[:, k]])
        q = good / (good + bad)
        p = min(max(q.mean(), 0.05), 0.95)
        for k, n in enumerate(names):
            for v, (g, b) in quality_rules.START.items():
                own = votes[:, k] == v
                c[n][v] = [(q[own].sum() + quality_rules.PSEUDO * g) / (q.sum() + quality_rules.PSEUDO), ((1 - q)[own].sum() + quality_rules.PSEUDO * b) / ((1 - q).sum() + quality_rules.PSEUDO)]
            c[n][-1][0], c[n][1][1] = min(c[n][-1][0], c[n][-1][1] / 2), min(c[n][1][1], c[n][1][0])
    assert abs(prior - p) < 1e-9 and all(abs(chance[n][v][s] - c[n][v][s]) < 1e-9 for n in names for v in (1, 0, -1) for s in (0, 1))
    found = np.array([r[0] for r in df.select(quality_rules.posterior(names, prior, chance)).collect()])
    assert ((found > 0.5) == truth).mean() > 0.9


def test_packing_digests_and_places(spark, folder, texts):
    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in texts.items():
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, 2048 * k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(ids[x : x + 2048] for x in range(0, len(ids), 2048))]
    out = queries.QUERIES["op4_packing"](spark, folder).toPandas().sort_values(["sequence_id", "offset"])
    assert sorted(zip(out.doc_id, out.piece, out.start, out.length, out.ids_crc32)) == sorted(want)
    assert (out.offset == out.groupby("sequence_id").length.cumsum() - out.length).all() and out.groupby("sequence_id").length.sum().max() <= 2048


def fewest_bins(sizes, room):
    """The exact optimum by dynamic programming over subsets."""
    best = {0: (0, 0)}
    for mask in range(1, 1 << len(sizes)):
        options = []
        for k, n in enumerate(sizes):
            if mask >> k & 1:
                bins, used = best[mask ^ (1 << k)]
                options.append((bins, used + n) if bins and used + n <= room else (bins + 1, n))
        best[mask] = min(options)
    return best[(1 << len(sizes)) - 1][0]


def test_packing_against_the_optimum():
    rng = random.Random(6)
    for _ in range(40):
        sizes = [rng.randint(1, 20) for _ in range(rng.randint(1, 10))]
        counts = collections.Counter(sizes)
        plan = packing.solve(dict(counts), 20)
        used = collections.Counter()
        for config, times in plan:
            assert sum(x * n for x, n in config.items()) <= 20
            for x, n in config.items():
                used[x] += n * times
        assert used == counts and sum(times for _, times in plan) <= fewest_bins(sizes, 20) + (len(sizes) > 6)


def test_encoder_on_odd_characters():
    own = encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(9)
    parts = [*"aBz1.,' \n\t\x0b\x1c\x00\x7f\x85\xa0éÉİıŉſΣςß×÷ª½あ한中", "é", "'re", "'LL", "!!", "$$$", "<|startoftext|>", "<|", "|>", "", "Ĳ", "ŷ", "😀", "​"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for text, got in zip(texts, own.encode(texts), strict=True):
        assert got == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    def luhn(d):
        return sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(map(int, reversed(d)))) % 10 == 0

    found = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text, re.A):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                found.append((m.start(), k, m.end()))
    return sorted(found)


def test_personal_data(spark):
    rng = random.Random(2)
    parts = ["a", "é", "😀", "@", "x.y", "mail@a.b", "1", "23", "192.168.1.1", "300.1.1.1", " ", "-", ".", "+1 (234) 567-8901", "4111 1111 1111 1111", "4111-1111-1111-1112", "+", "(", ")", "\n", "%", "a@b.c.d", "+44 20"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["1" * 5000, "a@" * 3000, "1.2.3.4" * 700, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = pii.personal_data(docs).collect()
    spans = {r.doc_id: [(s.start, s.kind, s.end) for s in r.all_spans] for r in rows}
    assert len(rows) == len(texts) and all([(s.start, s.kind, s.end) for s in r.base] == base_spans(texts[r.doc_id]) for r in rows)
    for r in pii.redact(docs).collect():
        at, clean = 0, ""
        for start, kind, end in spans[r.doc_id]:
            if start >= at:
                clean += texts[r.doc_id][at:start] + f"<{pii.KINDS[kind].upper()}>"
            at = max(at, end)
        assert r.text == clean + texts[r.doc_id][at:]


def test_personal_data_in_a_long_row(spark):
    text = " ".join(f"user{i}@mail{i % 97}.example at 10.{i % 256}.3.{i % 199}" for i in range(15_000))
    (row,) = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.text == " ".join(["<EMAIL> at <IP>"] * 15_000)


def test_bootstrapping_finds_unlabelled_identifiers(spark):
    rng = random.Random(1)
    filler = lambda: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega"], k=12))
    rows = [f"{filler()} contact: person{i}@mail.example thanks {filler()}" for i in range(60)] + [f"{filler()} contact: ID-{i:06d}-X thanks {filler()}" for i in range(5)] + [f"{filler()} build {i:06d}abc of {filler()}" for i in range(60)]
    out = pii.personal_data(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()
    found = {r.doc_id: [(s.start, s.end) for s in r.all_spans if s.kind == 4] for r in out}
    assert all((len(found[i]) == 1 and rows[i][slice(*found[i][0])] == f"ID-{i - 60:06d}-X") == (60 <= i < 65) for i in found) and not any(found[i] for i in range(65, 125))


def test_linear_view_against_plain_descent():
    """The classifier's weights reach the least loss that a long gradient descent on the dense problem finds."""
    rng = np.random.default_rng(5)
    x = rng.random((300, 6)) < 0.3
    y = (x @ np.array([2.0, -2, 1, 0, 0, 0]) + rng.normal(size=300) > 0).astype(float)
    docs, slots = np.nonzero(x)
    view = quality_classifier.Linear(docs, slots.astype(np.int64), y, np.ones(300), np.arange(6), {})
    loss = lambda w, b: np.logaddexp(0, x @ w + b).mean() - (y * (x @ w + b)).mean() + 0.5e-4 * (w**2).sum()
    w, b = np.zeros(6), 0.0
    for _ in range(20_000):
        gap = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - 0.5 * (x.T @ gap / 300 + 1e-4 * w), b - 0.5 * gap.mean()
    assert loss(view.weights, view.bias) < loss(w, b) + 0.01
    assert np.allclose(view.margins(docs, slots, 300), x @ view.weights + view.bias)


def test_pseudo_labels_cross_views(spark):
    """Metadata that the sample shows to tell lets content words be learnt that no labelled row has."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    row = lambda i, bad: (i, " ".join(rng.choices(words, k=60)) + (f" fresh{i // 4 % 2}" if bad and i >= 400 else ""), "en", "dark" if bad else "light", 10)
    docs = spark.createDataFrame([row(i, i % 4 == 0) for i in range(2000)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    model = quality_classifier.train(docs, labels)["toxic"]
    weights = dict(zip(model.views[0].slots.tolist(), model.views[0].weights.tolist(), strict=True))
    assert all(weights.get(quality_classifier._slot("word", f"fresh{k}"), 0) > 1 for k in (0, 1))
    assert all(r.kept == (r.doc_id % 4 != 0) for r in quality_classifier.classify(docs, labels).collect())


def test_labels_with_odd_rows(spark):
    rng = random.Random(7)
    docs = spark.createDataFrame([(i % 300, " ".join(rng.choices("abcdefgh", k=30)) + (" vileword" if i % 3 == 0 else "")) for i in range(600)], "doc_id long, text string")
    odd = [(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, None, None), (4, 1, 1), (999, 1, 0)]
    out = quality_classifier.classify(docs, spark.createDataFrame(odd, "doc_id long, quality int, toxic int"))  # no metadata columns, repeated ids, contradicting labels
    assert out.count() == 600 and all(r.quality == 0.5 for r in out.collect())
    assert quality_classifier.classify(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).filter("kept").count() == 600
