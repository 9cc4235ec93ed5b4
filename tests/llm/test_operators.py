"""Operators against brute force on a small fixture with nulls, empty texts, ties, repeated rows and clashing names."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curafold.llm import byte_bpe, exact_dedup, lm_scoring, packing, pii, quality_classifier, quality_rules, sharding, simhash, token_store
from curafold.llm.common import new_path

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, norm string, _row long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", "   ", "one", "a b c d e f a b c d e f", "Equal  text\tHERE\n", "Equal text here", "line one\nline one\n\nline", "mail a.b@c.d.e now", "ip 1.2.3.400 and 10.0.0.1.2", "card 4111 1111 1111 1111 +1 (555) 010-9999", "x" * 30_000, "é日本 ΑΣ. <|endoftext|> İ,", "7" * 3000]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghé", k=rng.randint(1, 9))) for _ in range(300)]
    long = [" ".join(rng.choices(words, k=rng.randint(1, 900))) for _ in range(60)]
    out = [*enumerate(TEXTS), *[(100 + i, t) for i, t in enumerate(long)], (200, long[0]), (201, long[0] + " more"), (202, long[1])]
    return [*out, (3, "one"), (None, "no id"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, None if i == 3 else "en", "s", 1, "x", "y", 0) for i, t in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_quality_rules(docs, rows, none):
    def brute(t):
        w = WORD.findall(t or "")
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = collections.Counter(windows)
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len({p for i, x in enumerate(windows) if n[x] > 1 for p in range(i, i + 5)})

    out = quality_rules.quality_rules(docs)
    assert collected(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") == sorted([(i, *brute(t)) for i, t in rows], key=repr)
    assert not out.filter("base_failed AND kept").count() and quality_rules.quality_rules(none).count() == 0


def test_token_store(spark, docs, rows, none):
    path = new_path(spark, "t")
    token_store.write_token_store(docs, path, WORD_BPE)
    t = Tokenizer.from_file(WORD_BPE)
    got = sorted(map(tuple, token_store.read_token_store(spark, path, ids=True).collect()), key=lambda r: r[1])
    assert [r[0] is not None for r in got] == sorted(r[0] is not None for r in got)
    want = collections.Counter((i, tuple([*t.encode(x or "", add_special_tokens=False).ids, 1])) for i, x in rows)
    assert collections.Counter((r[0], tuple(r[4])) for r in got) == want
    start = 0
    for _, at, n, crc, ids in got:
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    assert token_store.fetch(spark, path, [4, 999]) == {4: [*t.encode(TEXTS[4], add_special_tokens=False).ids, 1]}
    path = new_path(spark, "t")
    token_store.write_token_store(none, path, WORD_BPE)
    assert token_store.read_token_store(spark, path).count() == 0


def test_byte_bpe(docs, rows, none):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda x: hashlib.sha256(x).hexdigest()
    out = byte_bpe.encode_documents(docs, BYTE_BPE, public_tokenizers.PATTERN, ids=True)
    want = [(i, len(ids := e.encode_ordinary(t or "")), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())) for i, t in rows]
    assert collected(out, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert collected(byte_bpe.decode_documents(out, BYTE_BPE, public_tokenizers.PATTERN), "doc_id", "text") == sorted([(i, t or "") for i, t in rows], key=repr)
    assert byte_bpe.encode_documents(none, BYTE_BPE, public_tokenizers.PATTERN).count() == 0
    codec = byte_bpe.ByteBPE.load(BYTE_BPE, public_tokenizers.PATTERN)
    rng = random.Random(1)
    for _ in range(60):
        data = "".join(rng.choices(rng.choice(["ab", "a", "abcdefgh ", "é日x1"]), k=rng.randint(65, 900))).encode()
        assert codec.tree(data) == codec.flat(data)


def test_packing(docs, rows, none):
    out = packing.pack(docs, WORD_BPE, capacity=256).toPandas().sort_values(["sequence_id", "offset"])
    assert (out.offset == out.groupby("sequence_id").length.cumsum() - out.length).all() and out.groupby("sequence_id").length.sum().max() <= 256
    assert out.length.sum() == sum(len(Tokenizer.from_file(WORD_BPE).encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert out.sequence_id.nunique() <= -(-out.length.sum() // 256) + 1
    assert packing.pack(none, WORD_BPE).count() == 0


def test_simhash(docs, rows, none):
    def brute(t):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = [brute(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in ((a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3):
        group = [min(group[a], group[b]) if g in (group[a], group[b]) else g for g in group]
    least = {g: min((i for (i, _), x in zip(rows, group, strict=True) if x == g and i is not None), default=None) for g in set(group)}
    want = sorted([(i, f"{p:016x}", least[g]) for (i, _), p, g in zip(rows, prints, group, strict=True)], key=repr)
    for shard in (20_000, 1):
        assert collected(simhash.near_duplicates(docs, shard=shard), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(none).count() == 0


def test_quality_classifier(spark, none):
    rng = random.Random(2)
    say = lambda bad: " ".join(rng.choices(["alpha", "beta", "gamma", "delta"], k=40)) + (" vileword" if bad else "")
    rows = [(i, say(i % 4 == 0), "en", "s", 1, "", "", 0) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, None, None, None, None, None, None, None), (1, rows[1][1], "en", "s", 1, "", "", 0)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(docs, labels)
    held = out.filter("doc_id >= 200").select("doc_id", "kept").collect()
    assert len(held) == 200 and all(r.kept == (r.doc_id % 4 != 0) for r in held) and out.count() == 402
    assert quality_classifier.classify(none, labels).count() == 0


def test_lm_scoring(docs, rows, none):
    out = {r.doc_id: r for r in lm_scoring.score_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), head=5).filter("doc_id IS NOT NULL").collect()}
    tokens = lambda t: [*WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or "")), " "]
    c = collections.Counter(w for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10 for w in tokens(t))
    n = sum(c.values())
    for i, t in rows:
        if i is not None:
            w, r = tokens(t), out[i]
            base = sum(np.log10((c[x] + 0.1) / (n + 0.1 * (len(c) + 1))) for x in w)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n) and abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    lattice = lm_scoring.Lattice.of_weights({"▁": 1.0, "a": 2.0, "b": 1.0, "ab": 3.0, "▁a": 1.0, " ": 1.0}, [0.01] * 256)
    p = {k: np.exp(v) for k, v in lattice.logs.items()}
    assert abs(lattice.log10("ab") - np.log10(p["▁"] * p["a"] * p["b"] + p["▁"] * p["ab"] + p["▁a"] * p["b"])) < 1e-12
    assert lm_scoring.score_documents(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0


def least_capacity(sizes, shards):
    """The least capacity for which some contiguous partition into so many shards exists whose shards fit it or are one larger group."""

    def fewest(capacity):
        best = [0]
        for end in range(1, len(sizes) + 1):
            starts = [k for k in range(end) if sum(sizes[k:end]) <= capacity or (k == end - 1 and sizes[k] > capacity)]
            best.append(1 + min(best[k] for k in starts))
        return best[-1]

    return next(c for c in range(1, sum(sizes) + 1) if fewest(c) <= shards)


@pytest.mark.parametrize("buckets, wide", [(16, 1 << 12), (1 << 16, 1 << 62)])
def test_cuts_are_the_best(spark, buckets, wide):
    rng = random.Random(buckets)
    for spread, shards in ((10, 3), (wide, 7)):
        groups = {rng.randint(-spread, spread): rng.choice([1, 5, 40, 40, 300]) for _ in range(40)}
        keys = sorted(groups)
        sizes = np.array([groups[k] for k in keys])
        cuts = sharding.minimax_cuts(spark.createDataFrame(list(groups.items()), "key long, size long").coalesce(1), shards, buckets)
        shard = np.searchsorted(cuts, keys, side="right")
        load, best = np.bincount(shard, sizes), least_capacity(sizes.tolist(), shards)
        alone = {int(shard[k]) for k in range(len(keys)) if sizes[k] > best}
        assert len(cuts) < shards and max(x for k, x in enumerate(load) if k not in alone) <= best
        assert all((shard == k).sum() == 1 for k in alone) and sharding.smallest_capacity(sizes, shards) == best


def test_sharding(docs, rows, none):
    out = sharding.shard(docs, shards=7, buckets=16).toPandas()
    assert len(out) == len(rows) and all(sorted(g.slot) == list(range(len(g))) for _, g in out.groupby("shard"))
    assert out["size"].sum() == sum(len((t or "").encode()) + 16 for _, t in rows)
    assert out.groupby("text_crc32")["shard"].nunique().max() == 1
    sizes = np.random.default_rng(1).integers(1, 50, 40)
    best = sharding.smallest_capacity(sizes, 6)
    assert sharding.cuts_of(sizes, best, 6) is not None and (best == sizes.max() or sharding.cuts_of(sizes, best - 1, 6) is None)
    assert sharding.shard(none).count() == 0


@pytest.mark.parametrize("collide", [False, True])
def test_exact_dedup(docs, rows, none, collide):
    hashed = (lambda c: F.lit("same")) if collide else F.md5
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = []
    for t, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    assert collected(exact_dedup.exact_dedup(docs, content_hash=hashed), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)
    assert exact_dedup.exact_dedup(none).count() == 0 and exact_dedup.deduplicate(docs).count() == len(groups)


def test_personal_data(docs, none):
    out = {r.doc_id: r for r in pii.personal_data(docs).filter("doc_id < 20").collect()}
    spans = lambda i: [(pii.KINDS[s.kind], s.start, s.end) for s in out[i].base]
    assert spans(8) == [("email", 5, 14)] and spans(9) == [("ip", 17, 25)] and spans(13) == [] and spans(0) == []
    assert spans(10) == [("card", 5, 24), ("phone", 25, 42)]
    clean = {r.doc_id: r.text for r in pii.redact(docs).filter("doc_id < 20").collect()}
    assert clean[8] == "mail <EMAIL> now" and clean[10] == "card <CARD> <PHONE>" and clean[3] == "one"
    assert pii.personal_data(none).count() == 0 and pii.redact(docs).columns == docs.columns
