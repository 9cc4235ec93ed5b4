"""The near stage: SimHash candidates at a similarity of 0.8, and the work for one large group."""

import random

import numpy as np
import pytest

import corpus_pipeline
from curafold.llm import near_texts


def sets(t):
    words = t.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def texts_of_a_group(rng, copies):
    """A text and copies that are mostly near it, few near one another."""
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    base = [word() for _ in range(150)]
    texts = [" ".join(base)]
    for k in range(copies):
        copy = list(base)
        for at in rng.sample(range(5, 145, 6), rng.choice([2, 3, 3, 4])):
            copy[at] = word()
        texts.append(" ".join(copy) + f" {k}")
    return texts


def components(texts):
    found, group = [sets(t) for t in texts], list(range(len(texts)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(found)):
        for b in range(a):
            if len(found[a] & found[b]) >= 0.8 * len(found[a] | found[b]):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {top(a) for a in range(len(texts))}


def test_fingerprints_and_bands_catch_the_similarity():
    rng, salts = np.random.default_rng(5), near_texts._salts()
    apart = []
    for _ in range(200):  # 80 of 100 different shingles are common
        drawn = rng.integers(0, 1 << 64, 100, dtype=np.uint64)
        a, b = (np.frombuffer(near_texts.fingerprint(x, salts), np.uint8) for x in (drawn[:90], drawn[10:]))
        apart.append(int(np.bitwise_count(a ^ b).sum()) / (8 * len(a)))
    expected = np.arccos(2 * 0.8 / 1.8) / np.pi
    assert abs(np.mean(apart) - expected) < 0.003
    for rows in (10, 40_000, 15_000_000):
        bits, number = near_texts.bands(rows)
        assert (1 - (1 - expected) ** bits) ** number <= 2e-4
        assert near_texts.band_keys(np.zeros((3, 144), np.uint8), bits, number).shape == (3, number)


def test_clusters_of_trees_and_flat_values():
    rng = random.Random(6)
    centres = [rng.getrandbits(128) for _ in range(6)]
    values = list({c ^ sum(1 << b for b in rng.sample(range(128), rng.randint(0, 22))) for c in centres for _ in range(12)} | {rng.getrandbits(128) for _ in range(40)})
    want = list(range(len(values)))
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 36:
                low, high = sorted((want[a], want[b]))
                want = [low if w == high else w for w in want]
    groups = {frozenset(k for k, w in enumerate(want) if w == g) for g in want}
    for large in (10_000, 10):
        assert {frozenset(c) for c in near_texts.clusters(values, 36, large)} == groups


def test_near_finds_pairs_just_above_the_similarity(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts = []
    for _ in range(300):
        base = [word() for _ in range(104)]
        copy = list(base)
        for at in (20, 60):
            copy[at] = word()
        texts += [" ".join(base), " ".join(copy)]
    assert all(0.8 <= len(sets(a) & sets(b)) / len(sets(a) | sets(b)) < 0.83 for a, b in zip(texts[::2], texts[1::2], strict=True))
    found = corpus_pipeline.near(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), "").collect()
    assert sorted(r.doc_id for r in found) == list(range(0, 600, 2))


def test_near_finds_four_of_five_shingles(spark):
    rng = random.Random(10)
    texts = []
    for _ in range(2000):
        words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(9)]
        texts += [" ".join(words), " ".join(words[:8] if rng.random() < 0.5 else words[1:])]
    found = corpus_pipeline.near(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), "").collect()
    assert sorted(r.doc_id for r in found) == list(range(0, 4000, 2))


@pytest.mark.parametrize("index", [4 << 20, 5000])
def test_work_for_a_large_group_is_linear(spark, monkeypatch, index):
    texts = texts_of_a_group(random.Random(9), 500)
    compared, verified, links = [], near_texts._verified, near_texts._links

    def counted(pairs, of):
        compared.append(pairs.count())
        return verified(pairs, of)

    monkeypatch.setattr(near_texts, "_verified", counted)
    if index < 1 << 20:
        monkeypatch.setattr(near_texts, "_links", lambda rows: links(rows, index))
    found = corpus_pipeline.near(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), "").collect()
    assert sorted(r.doc_id for r in found) == sorted(components(texts))
    assert sum(compared) <= len(texts)
