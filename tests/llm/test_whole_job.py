"""Each operator does its whole job: cases that a smaller one gets wrong."""

import random

import corpus_pipeline
from curafold.llm import exact_dedup


def test_exact_decides_on_id_and_text(spark):
    rows = [(None, "a"), (None, "b"), (None, "b"), (5, "c"), (5, "d"), (0, "e"), (1, "e"), (1, "f"), (2, "g  h"), (2, "g h")]
    out = exact_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = sorted(((r.doc_id, " ".join(r.text.split())) for r in out), key=repr)
    assert got == sorted([(None, "a"), (None, "b"), (5, "c"), (5, "d"), (0, "e"), (1, "f"), (2, "g h")], key=repr)


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := t.lower().split()) else set() for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_near_finds_similar_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    texts = ["", "   ", "one", "one two three four", "ONE two three  four"]
    for n, edits in [(50, 1), (200, 2), (200, 6), (1000, 20), (300, 25), (100, 0)] * 12:
        words = [word() for _ in range(n)]
        copy = list(words)
        for at in rng.sample(range(5, n - 5, 6), min(edits, (n - 10) // 6)):
            copy[at] = word()
        texts += [" ".join(words), " ".join(copy) + (" tail" if not edits else "")]
    base = [word() for _ in range(120)]
    for k in range(60):  # one large group: each near the first, few near one another
        copy = list(base)
        for at in rng.sample(range(5, 115, 6), 2):
            copy[at] = word()
        texts.append(" ".join(copy) + f" {k}")
    texts.append(" ".join(base))
    rows = [(None if i % 9 == 7 else i // 2 if i % 11 == 3 else i, t) for i, t in enumerate(texts)]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if jaccard(rows[a][1], rows[b][1]) >= 0.8:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    found = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    of = {(i, t): g for (i, t), g in zip(rows, group, strict=True)}
    assert sorted(of[r.doc_id, r.text] for r in found) == sorted(set(group))
    least = {g: min(((i is None, i or 0) for (i, _), h in zip(rows, group, strict=True) if h == g)) for g in set(group)}
    assert all((r.doc_id is None, r.doc_id or 0) == least[of[r.doc_id, r.text]] for r in found)
