"""The pipeline against a brute-force chain over a small folder of documents, and each stage over no rows."""

import collections
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from curafold.llm import quality_classifier
from curafold.llm.common import documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, norm string, _row long, _stay long, _hash string, _spans string, all_spans string, _gone long"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 9))) for _ in range(2000)]
    texts = {}
    for i in range(240):
        text = " ".join(rng.choices(words, k=300))
        texts[i] = text + " vileword" * 3 if i % 4 == 0 else text + " mail some.one@mail.example now" if i % 10 == 1 else text
    texts |= {300: texts[1], 301: texts[2].replace(" ", "  ", 9), 302: texts[3] + " more", 303: None, 304: "", 305: " ".join(words * 3)}
    rows = [(i, t, "en", None if i == 5 else "s", len(t or ""), "x", "y", 0, 1, "", "", "", 2) for i, t in [*texts.items(), (7, texts[7]), (7, "another text of document seven"), (None, "a text without an id"), (None, "a second text without an id"), (None, texts[6]), (None, None)]]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)] + [(None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def shingles(t):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split(" ")
    words = [w for w in words if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, redacted text) of what exact, near and private leave of rows (doc_id, text)."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((i is None, i or 0, t))
    rows = [(None if m[0] else m[1], m[2]) for m in map(lambda g: min(g, key=lambda m: m[:2]), groups.values())]
    group = list(range(len(rows)))
    sets = [shingles(t or "") for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    first = {}
    for g, (i, t) in zip(group, rows, strict=True):
        first[g] = min(first.get(g, (i, t)), (i, t), key=lambda r: (r[0] is None, r[0] or 0))
    return [(i, t and EMAIL.sub("<EMAIL>", t)) for i, t in first.values()]


def test_pipeline(spark, folder):
    docs = documents(spark, folder)
    verdicts = quality_classifier.classify(docs, documents(spark, folder, "labels")).select("doc_id", "kept").collect()
    assert all(r.kept == (r.doc_id % 4 != 0) for r in verdicts if r.doc_id is not None and 160 <= r.doc_id < 240)
    good = corpus_pipeline.quality(spark, docs, folder)
    assert good.columns == docs.columns
    judged = [(r.doc_id, r.text) for r in good.collect()]
    assert collections.Counter(i for i, _ in judged) == collections.Counter(r.doc_id for r in verdicts if r.kept)

    tokenizer, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), []
    for i, t in brute(judged):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(i, k, 2048 * k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(ids[x : x + 2048] for x in range(0, len(ids), 2048))]
    out = corpus_pipeline.run(spark, folder).toPandas()
    got = [(None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    out = out.sort_values(["sequence_id", "offset"])
    assert (out.offset == out.groupby("sequence_id").length.cumsum() - out.length).all() and out.groupby("sequence_id").length.sum().max() <= 2048
    bins = []  # first fit, longest first
    for n in sorted((w[3] for w in want), reverse=True):
        k = next((k for k, room in enumerate(bins) if room >= n), None)
        if k is None:
            bins.append(2048 - n)
        else:
            bins[k] -= n
    assert out.sequence_id.nunique() <= len(bins)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_of_no_rows(spark, folder, name, stage):
    none = spark.createDataFrame([], SCHEMA)
    out = stage(spark, none, folder)
    assert out.count() == 0 and (name == "packed" or out.columns == none.columns)
