"""Operator 5, near duplicates by SimHash and BK-trees.

A fingerprint is 64 bits over a text's three-word shingles. Equal fingerprints are first made one. Two
fingerprints at distance 3 or less agree on at least one of four 16-bit bands (with more bands, on several),
so each goes to the shards of its bands. A shard holds one BK-tree: children are keyed by their Hamming
distance to the parent, and a search follows only edges within the radius of its own distance. A shard's
tree is searched component by component: what a search reaches leaves the tree, whose subtrees count the
living, so that a dense cluster costs about one visit a member and no pairs are listed; each member gets one
link to the first. Shards beyond SHARD rows are divided again, as often as needed, by bands of the bits that are left,
which loses no link for the same reason; with LEAST_BITS bits left a shard can't be that large. Links of all shards are joined by large-star/small-star rounds.

The trees aren't broadcast whole to all tasks: they hold every fingerprint and would grow with the corpus.
Each shard's tree stands in the one task that has all its searchers.

Defined cases: null and empty texts have fingerprint zero and link like others; component_id is the smallest
doc_id reachable, null ids counting as absent; repeated rows each give a row; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import deque
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORDS_BYTES, documents, staged
from .tokens import slices

SHINGLE, SEED, RADIUS, BANDS, SHARD, LEAST_BITS = 3, 42, 3, 4, 20_000, 14


def fingerprint(text: str, size: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    import xxhash

    words = WORDS_BYTES.findall(text.encode().lower())  # bytes.lower changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, seed)]
    else:
        starts, stops = [0, *ends.tolist()], (ends - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - size + 1], stops[size - 1 :], strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[k : k + (1 << 16)], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp: the fingerprint as a signed long."""

    def run(batches):
        for batch in batches:
            for at, texts in slices(batch):
                found = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(found)], ["doc_id", "fp"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Nodes in arrays: children keyed by distance to the parent, and the number of living nodes below."""

    def __init__(self, items):
        self.value, self.children, self.parent, self.living, self.alive = [], [], [], [], []
        for x in items:
            self._add(x)

    def _add(self, x: int) -> None:
        new = len(self.value)
        at, up = (0, -1) if new else (-1, -1)
        while at >= 0:
            self.living[at] += 1
            up = at
            d = (x ^ self.value[at]).bit_count()
            if (at := self.children[up].get(d, -1)) < 0:
                self.children[up][d] = new
        self.value.append(x)
        self.children.append({})
        self.parent.append(up)
        self.living.append(1)
        self.alive.append(True)

    def remove(self, at: int) -> None:
        self.alive[at] = False
        while at >= 0:
            self.living[at] -= 1
            at = self.parent[at]

    def take(self, x: int, radius: int) -> list[int]:
        """Places of the living within the radius of x, which leave the tree."""
        found, stack = [], [0] if self.living[0] else []
        while stack:
            at = stack.pop()
            d = (x ^ self.value[at]).bit_count()
            if d <= radius and self.alive[at]:
                found.append(at)
            for edge, child in self.children[at].items():
                if d - radius <= edge <= d + radius and self.living[child]:
                    stack.append(child)
        for at in found:
            self.remove(at)
        return found


def star_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """For each component of different values one link from each further member to the first."""
    if len(values) < 2:
        return []
    if len(values) == 2:
        return [(values[1], values[0])] if (values[0] ^ values[1]).bit_count() <= radius else []
    tree, links = BKTree(values), []
    for at, first in enumerate(tree.value):
        if tree.alive[at]:
            tree.remove(at)
            waiting = deque([first])
            while waiting:
                for near in tree.take(waiting.popleft(), radius):
                    links.append((tree.value[near], first))
                    waiting.append(tree.value[near])
    return links


def _bands(low: int, high: int, n: int) -> list[tuple[int, int]]:
    cuts = [low + (high - low) * k // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:], strict=False))


def _band_keys(fp, bits: list[int], bands: int, radius: int):
    """Array of (combination, value): one entry for each choice of bands - radius of the bands over these bit places."""
    cuts = [bits[a:b] for a, b in _bands(0, len(bits), bands)]
    keys = []
    for k, chosen in enumerate(combinations(range(bands), bands - radius)):
        mask = sum(1 << i for c in chosen for i in cuts[c])
        mask -= (1 << 64) * (mask >> 63)
        keys.append(F.struct(F.lit(k).alias("k"), fp.bitwiseAND(F.lit(mask)).alias("v")))
    return F.array(*keys)


def _search(radius: int):
    """Streams sorted rows (key, fp) and gives the star links of each shard."""

    def run(batches):
        key, values = None, []

        def out(links):
            a, b = zip(*links, strict=True)
            signed = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([signed(a), signed(b)], ["a", "b"])

        links: list[tuple[int, int]] = []
        for batch in batches:
            for k, fp in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy().view(np.uint64).tolist(), strict=True):
                if k != key:
                    links += star_links(values, radius)
                    key, values = k, []
                    if len(links) > 50_000:
                        yield out(links)
                        links = []
                values.append(fp)
        links += star_links(values, radius)
        if links:
            yield out(links)

    return run


def _divide(radius: int):
    """Rows (key, free, fp) of large shards to rows of smaller ones: the bits that are still free are cut into radius + 1 bands."""

    def run(batches):
        for batch in batches:
            key, free, fp = (batch.column(k).to_numpy().view(np.uint64) for k in range(3))
            for mask in np.unique(free).tolist():
                own = free == mask
                bits = [i for i in range(64) if mask >> i & 1]
                for k, (low, high) in enumerate(_bands(0, len(bits), radius + 1)):
                    band = np.uint64(sum(1 << i for i in bits[low:high]))
                    mixed = (key[own] ^ ((fp[own] & band) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(k)
                    mixed ^= mixed >> np.uint64(31)
                    rest = np.full(int(own.sum()), mask & ~int(band), np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (mixed, rest, fp[own])], ["key", "free", "fp"])

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, bands: int = BANDS, shard: int = SHARD) -> DataFrame:
    """Links a, b between different fingerprints (column fp) that make the components of all links.

    Two shards that get the same key are searched as one, which adds nothing but work."""
    fixed = [sum(1 << i for c in chosen for i in range(*_bands(0, 64, bands)[c])) for chosen in combinations(range(bands), bands - radius)]
    signed = lambda x: x - (1 << 64) * (x >> 63)
    free = F.get(F.array(*[F.lit(signed((1 << 64) - 1 & ~m)) for m in fixed]), F.col("s.k"))
    level = distinct.select("fp", F.explode(_band_keys(F.col("fp"), list(range(64)), bands, radius)).alias("s")).select(F.xxhash64("s.k", "s.v").alias("key"), free.alias("free"), "fp")
    shards = None
    while True:  # each round fixes a quarter of the bits that are left, and shards with few free bits are never large
        sizes = level.groupBy("key").agg(F.count("*").alias("n"), F.max(F.bit_count("free")).alias("bits"))
        large = staged(sizes.filter((F.col("n") > shard) & (F.col("bits") > LEAST_BITS)).select("key"), "large_shards")
        some = not large.isEmpty()
        small = (level.join(large, "key", "left_anti") if some else level).select("key", "fp")
        shards = small if shards is None else shards.union(small)
        if not some:
            return shards.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_search(radius), "a long, b long").distinct()
        level = staged(level.join(large, "key", "left_semi").select("key", "free", "fp").mapInArrow(_divide(radius), "key long, free long, fp long"), "divided")


def components(links: DataFrame) -> DataFrame:
    """node, root of the components of links (a, b): root is the smallest node reachable.

    Large-star and small-star rounds (Kiveris and others, 2014): the rows of a round never outnumber the
    links, each is a group minimum (combined before the shuffle) and a join Spark can split on a hot node."""
    edges = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.filter("a <> b").distinct(), "large_star")
        floor = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(floor, F.col("a") == F.col("n")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = staged(small.select("e.a", "e.b").filter("a <> b").distinct(), "small_star")
        same = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if same(after) == same(edges):
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        edges = after


def near_duplicates(docs: DataFrame, radius: int = RADIUS, bands: int = BANDS, shard: int = SHARD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row."""
    marked = staged(fingerprints(docs, doc_id, text), "fingerprints")
    classes = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
    roots = components(near_links(classes.select("fp"), radius, bands, shard))
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(named, "root").select("fp", "component_id")
    return marked.join(of_print, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
