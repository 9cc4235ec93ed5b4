"""Operator 5 where a similarity is asked for: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The candidates come from SimHash, shards and BK-trees as in simhash.py, with radius and bands wide enough for 0.8.
At that similarity two fingerprints differ in at most 15.1% of their bits on average (the angle between the sets), so
64 bits and radius 3 would find one pair in a hundred. Here a fingerprint has PRINT + POOL words of 64 bits. A band
is a draw of bits from the pool; their number a band grows with the table, so that a shard of unlike texts has some
SHARD rows, and the number of bands is what leaves out a pair of similarity 0.8 with probability MISSED. A shard's
BK-tree holds the PRINT words, where such a pair differs in 19.4 of 128 bits, unlike texts in 64; RADIUS is 36. Only for
four of five shingles the average is higher, 24 bits, as four can tie; such pairs also meet by what four they share.
Equal sets are one node, named by 64 bits of their hash.

No pairs are listed. What steps within the radius connect in a shard is a cluster, and each member is a candidate for
one centre, the member nearest to the bits most of them have. Each node is first compared, exactly, with the
nearest of its centres. Then what candidates connect is a family; a family whose sets are not all linked by then is compared whole:
each set outside its largest component against all others, by counting common shingles in an index of a few MB.
That decides every pair within a family, so no link between candidates is lost. This last step's work is the number
of sets outside the largest component times the family's size; its rows are the family's once for each index.

Defined cases: words are those of simhash; a text of fewer than five words is one shingle, one without words has
none, and all of these are equal. Of a component one row with the smallest doc_id stays, null ids last, whatever ids
repeat. An empty table gives an empty table; other columns are only carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORDS_BYTES, having_keys, staged, with_row_keys
from .simhash import BKTree, components
from .tokens import slices

SHINGLE, SIMILAR, SEED = 5, 0.8, 42
PRINT, POOL, RADIUS, SHARD, MISSED = 2, 16, 36, 32, 2e-4
LARGE, INDEX = 20_000, 4 << 20


def shingles(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted different 64-bit hashes of a text's word shingles."""
    import xxhash

    words = WORDS_BYTES.findall(text.encode().lower())
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, SEED)], dtype=np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, stops = [0, *ends.tolist()], (ends - 1).tolist()
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1], stops[size - 1 :], strict=True)], dtype=np.uint64))


def _salts() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, PRINT + POOL, dtype=np.uint64)


def fingerprint(found: np.ndarray, salts: np.ndarray) -> bytes:
    """SimHash of PRINT + POOL words over a set's shingle hashes, mixed anew for each word: a bit is 1 if set in over half."""
    ones = np.zeros(64 * len(salts), dtype=np.int64)
    for k in range(0, len(found), 255):
        mixed = found[k : k + 255, None] ^ salts
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(32)
        ones += np.add.reduce(np.unpackbits(mixed.view(np.uint8), axis=1), axis=0, dtype=np.uint8)  # 255 at most
    return np.packbits(2 * ones > len(found)).tobytes()


def bands(rows: int) -> tuple[int, int]:
    """Bits of a band and number of bands for a table of so many different sets."""
    agree = 1 - math.acos(2 * SIMILAR / (1 + SIMILAR)) / math.pi
    bits = min(max(8, math.ceil(math.log2(max(rows, 1) / SHARD))), 32)
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree**bits))


def band_keys(prints: np.ndarray, bits: int, number: int) -> np.ndarray:
    """One signed key for each fingerprint (row of bytes) and band."""
    draw = np.random.default_rng(SEED)
    chosen = np.concatenate([draw.permutation(64 * POOL) for _ in range(-(-bits * number // (64 * POOL)))])[: bits * number]
    places = np.full((number, 32), 64 * POOL)  # a place after the pool, where all bits are 0
    places[:, :bits] = chosen.reshape(number, bits)
    keys = np.empty((len(prints), number), dtype=np.int64)
    for k in range(0, len(prints), 256):
        pool = np.pad(np.unpackbits(prints[k : k + 256, 8 * PRINT :], axis=1), ((0, 0), (0, 1)))
        keys[k : k + 256] = np.packbits(pool[:, places], axis=2).view("<u4")[:, :, 0]
    return keys + (np.arange(number, dtype=np.int64) << 32)


def similar(a: bytes, b: bytes, least: float = SIMILAR) -> bool:
    """Whether two sorted sets of shingles reach a Jaccard similarity."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    x, y = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both)


def marked(docs: DataFrame, keys: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keys (_a, _b), node, fingerprint and shingles of each row."""

    def run(batches):
        import xxhash

        salts = _salts()
        for batch in batches:
            for at, texts in slices(batch):
                sets = [shingles(t) for t in texts]
                node = np.array([xxhash.xxh3_64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
                prints = pa.array([fingerprint(s, salts) for s in sets], pa.binary())
                # sets are compared by 32 bits of their shingles' hashes, which halves what is sent
                short = pa.array([np.unique((s >> np.uint64(32)).astype("<u4")).tobytes() for s in sets], pa.binary())
                own = [batch.column(k).slice(at, len(texts)) for k in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(node), prints, short], ["doc_id", "_a", "_b", "node", "print", "shingles"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(keys[0]).alias("_a"), F.col(keys[1]).alias("_b"))
    return rows.mapInArrow(run, "doc_id long, _a long, _b long, node long, print binary, shingles binary")


def small_keys(own: bytes) -> list[int]:
    """Negative keys of a set of four or five shingles: one for each four of them. Sets of 4 and 5 that reach 0.8 share one."""
    import xxhash

    four = [own] if len(own) == 16 else [own[:k] + own[k + 4 :] for k in range(0, 20, 4)]
    return [-1 - (xxhash.xxh64_intdigest(x, SEED) >> 1) for x in four]


def _sharded(bits: int, number: int):
    """Rows (node, print, small) to rows (key, high, low, node), one for each band, with the words that the trees hold.

    Sets of four and five shingles (small) also share shards where all words are 0, so that they are candidates whatever their bits."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            prints = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            words = prints[:, : 8 * PRINT].copy().view(np.int64)
            columns = [band_keys(prints, bits, number).ravel(), *(np.repeat(x, number) for x in (words[:, 0], words[:, 1], batch.column(0).to_numpy()))]
            few = [(key, 0, 0, node) for node, own in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True) if own for key in small_keys(own)]
            more = np.array(few, dtype=np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x, y])) for x, y in zip(columns, more, strict=True)], ["key", "high", "low", "node"])

    return run


class Flat:
    """What BKTree does, for shards so large that a tree's memory would tell: all living values are looked at."""

    def __init__(self, items):
        raw = b"".join(x.to_bytes(16, "little") for x in items)
        self.words, self.alive = np.frombuffer(raw, np.uint64).reshape(-1, 2), np.ones(len(items), dtype=bool)
        self.left = np.arange(len(items))

    def remove(self, at: int) -> None:
        self.alive[at] = False

    def take(self, x: int, radius: int) -> list[int]:
        one = np.frombuffer(x.to_bytes(16, "little"), np.uint64)
        if 2 * np.count_nonzero(self.alive[self.left]) < len(self.left):
            self.left = self.left[self.alive[self.left]]
        near = np.bitwise_count(self.words[self.left] ^ one).sum(axis=1, dtype=np.int64) <= radius
        found = self.left[near & self.alive[self.left]]
        self.alive[found] = False
        return found.tolist()


def clusters(values: list[int], radius: int = RADIUS, large: int = LARGE) -> list[list[int]]:
    """Places of different values, as lists of those that steps within the radius connect."""
    tree, found = (Flat if len(values) > large else BKTree)(values), []
    for first in range(len(values)):
        if tree.alive[first]:
            tree.remove(first)
            group = [first]
            for at in group:  # grows meanwhile
                group += tree.take(values[at], radius)
            found.append(group)
    return found


def _candidates(words: np.ndarray, node: np.ndarray, radius: int = RADIUS):
    """node, centre and their distance for each member of a shard's clusters but the centre; rows are sorted by words."""
    change = np.flatnonzero((words[1:] != words[:-1]).any(axis=1)) + 1
    starts = np.concatenate([[0], change, [len(words)]])
    high, low = (words[starts[:-1], k].tolist() for k in range(2))
    for group in clusters([h << 64 | x for h, x in zip(high, low, strict=True)], radius):
        if len(group) == 1 and starts[group[0] + 1] - starts[group[0]] == 1:
            continue
        rows = np.concatenate([np.arange(starts[g], starts[g + 1]) for g in group])
        own = words[rows]
        ones = sum(np.unpackbits(own[k : k + 4096].view(np.uint8), axis=1).sum(axis=0, dtype=np.int64) for k in range(0, len(own), 4096))
        most = np.packbits(2 * ones > len(own)).view(np.uint64)
        apart = lambda x: np.bitwise_count(own ^ x).sum(axis=1, dtype=np.int64)
        centre = int(np.argmin(apart(most)))
        others = np.arange(len(rows)) != centre
        yield node[rows][others], np.full(len(rows) - 1, node[rows[centre]]), apart(own[centre])[others]


def _search(batches):
    """Streams rows (key, high, low, node) sorted by them and gives candidates (node, centre, distance) of each shard."""
    held: list[list[np.ndarray]] = []
    found: list[tuple[np.ndarray, ...]] = []

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["node", "centre", "distance"])
        found.clear()
        return batch

    def searched(rows, cuts):
        words = np.stack([rows[1].view(np.uint64), rows[2].view(np.uint64)], axis=1)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                found.extend(_candidates(words[a:b], rows[3][a:b]))

    joined = lambda: [np.concatenate(x) for x in zip(*held, strict=True)]
    for batch in batches:
        rows = [batch.column(k).to_numpy() for k in range(4)]
        if not len(rows[0]):
            continue
        held.append(rows)
        if held[0][0][0] == rows[0][-1]:  # the shard goes on
            continue
        rows = joined()
        cuts = [0, *(np.flatnonzero(np.diff(rows[0])) + 1).tolist()]
        searched(rows, cuts)
        held = [[x[cuts[-1] :] for x in rows]]
        if len(found) > 5000:
            yield out()
    if held:
        rows = joined()
        searched(rows, [0, len(rows[0])])
    if found:
        yield out()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs a, b whose sets are similar."""

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(k) for k in range(4))
            good = pa.array([similar(p, q) for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(good), b.filter(good)], ["a", "b"])

    of = lambda side, name: sets.select(F.col("node").alias(side), F.col("shingles").alias(name)).hint("shuffle_hash")
    return pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


class Index:
    """Sets of shingles by shingle: which of them are similar to a set, by counting what is common."""

    def __init__(self, sets: list[bytes]):
        parts = [np.frombuffer(s, "<u4") for s in sets]
        self.sizes = np.array([len(p) for p in parts])
        every, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), self.sizes)
        order = np.argsort(every, kind="stable")
        self.every, self.owner = every[order], owner[order]

    def similar(self, one: bytes, least: float = SIMILAR) -> list[int]:
        y = np.frombuffer(one, "<u4")
        low, high = (np.searchsorted(self.every, y, side) for side in ("left", "right"))
        many = high - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        both = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(both >= least * (self.sizes + len(y) - both)).tolist()


def _across(batches):
    """Streams rows (family, part, asked, node, root, shingles), the asked ones first, and gives links between different roots."""
    at, asked, index, up = None, [], None, {}

    def top(x):
        while x in up:
            x = up[x]
        return x

    for batch in batches:
        links = []
        for family, part, ask, node, root, own in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if (family, part) != at:
                at, asked, index, up = (family, part), [], None, {}
            if ask:
                asked.append((node, root, own))
                continue
            index = index or Index([s for _, _, s in asked])
            for k in index.similar(own):
                a, b = top(asked[k][1]), top(root)
                if a != b:
                    up[max(a, b)] = min(a, b)
                    links.append((node, asked[k][0]))
        if links:
            a, b = zip(*links, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _candidate_links(rows: DataFrame) -> DataFrame:
    """node, centre, distance: links that connect all candidates among the rows of marked()."""
    small = F.when(F.length("shingles").isin(16, 20), F.col("shingles")).alias("small")
    prints = staged(rows.filter("length(shingles) > 0").select("node", "print", small).dropDuplicates(["node"]), "prints")
    shards = prints.mapInArrow(_sharded(*bands(prints.count())), "key long, high long, low long, node long")
    return shards.repartition("key").sortWithinPartitions("key", "high", "low", "node").mapInArrow(_search, "node long, centre long, distance long")


def _links(rows: DataFrame, index: int = INDEX) -> DataFrame:
    """node, root of the components of all similar candidates among the rows of marked()."""
    near = staged(_candidate_links(rows), "candidates")
    families = components(near.select(F.col("node").alias("a"), F.col("centre").alias("b")))
    families = families.union(families.select("root", "root").distinct())  # a root is no node of its own
    own = rows.select("node", "shingles").join(families.select("node").hint("shuffle_hash"), "node", "left_semi")
    sets = staged(own.dropDuplicates(["node"]), "shingle_sets")
    nearest = near.groupBy("node").agg(F.min(F.struct("distance", "centre")).alias("c")).select(F.col("node").alias("a"), F.col("c.centre").alias("b"))
    links = staged(_verified(nearest, sets), "similar")
    roots = components(links)

    sizes = sets.select("node", F.length("shingles").cast("long").alias("size")).hint("shuffle_hash")
    rooted = families.select("node", F.col("root").alias("family")).join(roots.hint("shuffle_hash"), "node", "left").select("family", "node", F.coalesce("root", "node").alias("root"))
    placed = staged(rooted.join(sizes, "node").select("family", "node", "root", "size"), "families")
    parts = placed.groupBy("family", "root").agg(F.count("*").alias("n")).groupBy("family").agg(F.count("*").alias("roots"), F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most"))
    apart = staged(parts.filter("roots > 1 and n > 2").select("family", F.col("most.root").alias("largest")), "apart")  # two were compared
    if apart.isEmpty():
        return roots

    asked = F.col("root") != F.col("largest")
    before = F.sum(F.when(asked, F.col("size")).otherwise(0)).over(Window.partitionBy("family").orderBy("node").rowsBetween(Window.unboundedPreceding, -1))
    dealt = placed.join(apart.hint("shuffle_hash"), "family").withColumn("part", F.floor(F.coalesce(before, F.lit(0)) / index)).withColumn("asked", asked)
    dealt = staged(dealt.join(sets.select("node", "shingles").hint("shuffle_hash"), "node").select("family", "part", "asked", "node", "root", "shingles"), "open")
    indexes = dealt.filter("asked").select("family", "part").distinct().hint("shuffle_hash")
    every = dealt.drop("part", "asked").join(indexes, "family").select("family", "part", F.lit(False).alias("asked"), "node", "root", "shingles")
    order = ["family", "part", F.col("asked").desc(), "node"]
    more = dealt.filter("asked").union(every).repartition("family", "part").sortWithinPartitions(*order).mapInArrow(_across, "a long, b long")
    return components(links.union(more))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each component of similar texts."""
    keyed, keys = with_row_keys(docs)
    rows = staged(marked(keyed, keys, doc_id, text), "shingles")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_a", "_b")
    least = rows.groupBy("node").agg(F.min(order).alias("least"))
    rooted = least.join(_links(rows).hint("shuffle_hash"), "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("least").alias("least"))
    return having_keys(keyed, keys, staged(rooted.select("least._a", "least._b"), "stay"))
