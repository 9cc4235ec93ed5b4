"""Content features of the quality classifier: worked on column-wise, and the same as word by word."""

import random
import sys

import pyarrow as pa

from curafold.llm import quality_classifier


def one_by_one(words):
    return [quality_classifier._slot("word", w.lower().strip(".,;:!?\"'()|#$%&*")) for w in words]


def test_new_words_are_named_column_wise(monkeypatch):
    """A name by itself for each of many different words took most of the operator's time; none of these words needs one."""
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abcdefgéñłш", k=9)) + rng.choice(["", ".", "!)"]) for _ in range(20_000)})
    calls, slot = [], quality_classifier._slot
    monkeypatch.setattr(quality_classifier, "_slot", lambda *a: calls.append(a) or slot(*a))
    docs, slots = quality_classifier.content_features(pa.array([" ".join(words[:9000]), None, " ".join(words[9000:])]))
    assert len(calls) < 1000
    assert set(one_by_one(words)) <= set(slots.tolist()) and set(docs.tolist()) == {0, 1, 2}


def test_names_of_words_are_those_of_one_by_one():
    chars = [chr(c) for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    cases = [*chars, *[f"A{c}" for c in chars], *[f"{c}b" for c in chars]]
    cases += ["", "...", "THE", "(The).", "ΑΣ", "ΑΣΑ", "İstanbul", "x" * 40, "x" * 41, "é" * 20, "É" * 21, "#" * 300 + "a", "x" * 30_000, "“Quoted”", "日本語"]
    assert quality_classifier.word_features(pa.array(cases)).tolist() == one_by_one(cases)
    assert quality_classifier.word_features(pa.array(cases).slice(60, 40)).tolist() == one_by_one(cases[60:100])
    assert quality_classifier.word_features(pa.array([], pa.string())).tolist() == []


def test_features_of_texts_are_each_once_in_order():
    rng = random.Random(4)
    texts = [None, "", "  ", "The the THE, the.", "x\ny\ny", *["".join(rng.choices("abAB ΣİéШ.!#\n\t", k=rng.randint(0, 200))) for _ in range(200)]]
    docs, slots = quality_classifier.content_features(pa.array(texts))
    found = list(zip(docs.tolist(), slots.tolist(), strict=True))
    assert found == sorted(set(found))
    words = {(i, s) for i, t in enumerate(texts) for s in one_by_one((t or "").split())}
    shares = {quality_classifier._slot(name, str(k)) for name in ("upper", "other", "marks", "shouts", "different", "repeated lines", "words") for k in range(21)}
    assert {p for p in found if p[1] not in shares} == words
    assert {i: sum(d == i and s in shares for d, s in found) for i in range(len(texts))} == dict.fromkeys(range(len(texts)), 7)
