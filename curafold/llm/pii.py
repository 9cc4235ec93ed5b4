"""Operator 10, personal data by bootstrapped contextual extraction, in DataFrame functions only.

Four kinds are found by their own patterns (email, ip, card, phone). These seeds induce lexical patterns: the word
before them, the two words before, the word after, and the words on both sides. Other identifier-like tokens (six
characters or more, three digits or more) are instances without a label. Patterns and instance values form a
bipartite graph; in rounds of two aggregations a pattern is scored by the share of its different values that are
personal (smoothed), and an unlabelled value by its best pattern. A pattern takes part once SUPPORT of its values are
seeds or were found in an earlier round, so that what is found induces further patterns. Values scored at least CONFIDENT
are unseen identifiers; their spans have kind `id`. Seeds always stay.

Positions are code points, end exclusive. They come from running sums over the lengths of the parts between
matches; running sums and maxima take a few passes over an array (see _running), and texts are read through blocks of
BLOCK code points, so that the work in a row grows with its length even for a log of many addresses. All repeated
groups are possessive and runs are only entered at their start (or where the last match ended), which keeps matching linear on very long runs.

Defined cases: null and empty texts have no spans (base_sha256 of the empty string, spans empty); null and
repeated doc_ids each give a row; an empty table gives an empty table; other columns are only carried when
asked for. A token with the character U+E000 is no instance: it stands for seeds where tokens are looked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, staged, text_of, unused

KINDS = ["email", "ip", "card", "phone", "id"]
#: The contract's patterns, with starts and repeats that can't backtrack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MASK = "\ue000"
TOKEN = rf"(?<![A-Za-z0-9._@:/+{MASK}-])(?=[A-Za-z._@:/+{MASK}-]*+[0-9])[A-Za-z0-9._@:/+{MASK}-]++"
ROUNDS, SMOOTHING, SUPPORT, CONFIDENT, SIDE, BLOCK = 3, 2.0, 5, 0.8, 52, 1024
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _bound(value: Column, use) -> Column:
    """use(value), with value evaluated once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(x: Column, combine) -> Column:
    """The array's running sums or maxima: each pass combines an element with the 15 at once, twice, ... a distance before
    it, and the distance grows sixteenfold while it is less than the array's length (up to 2^28)."""
    zero = F.lit(0)

    def passes(whole: Column) -> Column:
        def further(a: Column, distance: Column) -> Column:
            def one(v: Column, i: Column) -> Column:
                return F.aggregate(F.sequence(F.lit(1), F.lit(15)), v, lambda acc, k: combine(acc, F.coalesce(F.get(a, i - k * distance), zero)))

            return F.transform(a, one)

        return F.aggregate(F.filter(F.array(*[F.lit(16**k) for k in range(7)]), lambda d: d < F.size(whole)), whole, further)

    return _bound(x, passes)


def _sums(x: Column) -> Column:
    return _running(x, lambda a, b: a + b)


def _before(ends: Column, use) -> Column:
    """use(reach), where reach(i) is the furthest of the first i ends, 0 for none."""
    return _bound(_running(ends, F.greatest), lambda most: use(lambda i: F.coalesce(F.get(most, i - 1), F.lit(0))))


def _matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(v: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, 1, F.size(v)), v, lambda gap, x: gap + F.length(x))
        at = lambda sums: F.transform(v, lambda x, i: F.struct((F.get(sums, i) - F.length(x)).alias("start"), F.get(sums, i).alias("end"), x.alias("value")))
        return F.when(F.size(v) == 0, F.array().cast("array<struct<start:int,end:int,value:string>>")).otherwise(_bound(_sums(steps), at))

    return _bound(values, placed)


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _part(blocks: Column, start: Column, end: Column) -> Column:
    """The text from start to end, read from the blocks it touches."""
    first = F.floor(start / BLOCK).cast("int")
    near = F.array_join(F.slice(blocks, first + 1, F.floor((end - 1) / BLOCK).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(near, start - first * BLOCK + 1, end - start)).otherwise("")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("decimal(38,0)") <= 255, F.regexp_replace(p, "^0+", "") == ""))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _worth_a_scan(kind: str, text: Column) -> Column:
    """A cheap test that every text with a match passes."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9][\x20-]?[0-9]")


def base_spans(text: Column) -> Column:
    """Spans of the four kinds by start, then kind."""
    def of_kind(k: int, kind: str) -> Column:
        good = F.filter(_matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"]))
        spans = F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end")))
        return F.when(_worth_a_scan(kind, text), spans).otherwise(F.array().cast(SPAN))

    return F.sort_array(F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS[:4])]))


def _masked(blocks: Column, spans: Column, n: Column) -> Column:
    """The text with each character of a span replaced by MASK."""

    def pieces(reach) -> Column:
        def one(s: Column, i: Column) -> Column:
            return F.concat(_part(blocks, reach(i), s["start"]), F.repeat(F.lit(MASK), F.greatest(s["end"] - F.greatest(s["start"], reach(i)), F.lit(0))))

        return F.concat(F.array_join(F.transform(spans, one), ""), _part(blocks, reach(F.size(spans)), n))

    return _before(F.transform(spans, lambda s: s["end"]), pieces)


def _instances(text: Column, spans: Column) -> Column:
    """(start, end, kind or null, value, patterns): the seeds, and identifier-like tokens that touch no seed."""
    n = F.length(text)

    def patterns(blocks: Column, start: Column, end: Column) -> Column:
        before, after = _part(blocks, F.greatest(start - SIDE, F.lit(0)), start), _part(blocks, end, end + SIDE)

        def named(words: Column) -> Column:
            one, two, right = (F.get(words, F.lit(k)) for k in range(3))
            some = lambda kind, x, there: F.when(there, F.concat(F.lit(kind), x))
            both = some("b:", F.concat(one, F.lit(" _ "), right), (one != "") & (right != ""))
            return F.array_compact(F.array(some("1:", one, one != ""), some("2:", two, two != ""), some("r:", right, right != ""), both))

        found = [(before, r"(\S{1,24})\s*$"), (before, r"(\S{1,24}\s+\S{1,24})\s*$"), (after, r"^\s*(\S{1,24})")]
        return _bound(F.array(*[F.lower(F.regexp_extract(x, p, 1)) for x, p in found]), named)

    def every(blocks: Column) -> Column:
        def one(x: Column, kind: Column, value: Column) -> Column:
            return F.struct(x["start"].alias("start"), x["end"].alias("end"), kind.cast("int").alias("kind"), value.alias("value"), patterns(blocks, x["start"], x["end"]).alias("patterns"))

        free = _matches(F.when(F.size(spans) > 0, _masked(blocks, spans, n)).otherwise(text), TOKEN)
        shaped = F.filter(free, lambda t: (F.length(t["value"]) >= 6) & (F.length(F.regexp_replace(t["value"], "[^0-9]", "")) >= 3) & ~F.contains(t["value"], F.lit(MASK)))
        seeds = F.transform(spans, lambda s: one(s, s["kind"], _part(blocks, s["start"], s["end"])))
        return F.concat(seeds, F.transform(shaped, lambda t: one(t, F.lit(None), t["value"])))

    empty = F.array().cast("array<struct<start:int,end:int,kind:int,value:string,patterns:array<string>>>")
    return F.when(text.rlike("[0-9]") | (F.size(spans) > 0), _bound(_blocks(text), every)).otherwise(empty)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One written row for each document: a row key, base spans, instances and the columns to keep."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("_text"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    spans = rows.withColumn("base", base_spans(F.col("_text")))
    return staged(spans.withColumn("instances", _instances(F.col("_text"), F.col("base"))).drop("_text"), "pii_scan")


def discover(scanned: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """_row, found: spans of unseen identifiers."""
    instances = scanned.select("_row", F.explode("instances").alias("i")).select("_row", "i.*")
    own = instances.select(F.explode("patterns").alias("pattern"), "value", F.col("kind").isNotNull().cast("int").alias("seed"))
    edges = staged(own.groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pii_edges")
    values = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"))
    for _ in range(rounds):
        sure = F.count_if(F.col("score") >= CONFIDENT)
        shares = edges.select("pattern", "value").join(values, "value").groupBy("pattern").agg((F.sum("score") / (F.count("*") + SMOOTHING)).alias("share"), sure.alias("personal"))
        patterns = shares.filter(F.col("personal") >= SUPPORT).select("pattern", "share")
        scored = edges.join(patterns, "pattern", "left").groupBy("value").agg(F.max("seed").alias("seed"), F.max(F.coalesce("share", F.lit(0.0))).alias("best"))
        values = staged(scored.select("value", F.when(F.col("seed") == 1, 1.0).otherwise(F.col("best")).alias("score")), "pii_scores")
    sure = values.filter(F.col("score") >= CONFIDENT).select("value")
    new = instances.filter("kind IS NULL").join(sure, "value", "left_semi")
    span = F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end")
    return new.groupBy("_row").agg(F.collect_list(span).alias("found"))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, base and all spans (start, kind, end) of each row, and the columns to keep."""
    scanned = scan(docs, doc_id, text, keep)
    both = scanned.drop("instances").join(discover(scanned), "_row", "left")
    spans = F.sort_array(F.concat("base", F.coalesce("found", F.array().cast(SPAN))))
    return both.withColumn("all_spans", spans).select("doc_id", "base", "all_spans", *[F.col(f"_keep_{c}").alias(c) for c in keep])


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in angle brackets."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def pieces(blocks: Column, reach) -> Column:
        def one(s: Column, i: Column) -> Column:
            return F.when(s["start"] >= reach(i), F.concat(_part(blocks, reach(i), s["start"]), F.get(names, s["kind"]))).otherwise("")

        return F.concat(F.array_join(F.transform(spans, one), ""), _part(blocks, reach(F.size(spans)), F.length(text)))

    return _bound(_blocks(text), lambda blocks: _before(F.transform(spans, lambda s: s["end"]), lambda reach: pieces(blocks, reach)))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with personal data in text replaced; n_chars follows if there is such a column.

    Spans depend on a text alone, so rows find them by their text's hash; only texts with spans have a row there."""
    h, spans = unused(docs, "_hash"), unused(docs, "_spans")
    hashed = docs.withColumn(h, F.sha2(text_of(text), 256))
    found = personal_data(hashed, doc_id, text, keep=(h,)).filter(F.size("all_spans") > 0).select(h, F.col("all_spans").alias(spans)).dropDuplicates([h])
    out = hashed.join(staged(found, "texts_with_spans").hint("shuffle_hash"), h, "left")
    out = out.withColumn(text, F.when(F.col(spans).isNotNull(), redacted(F.col(text), F.col(spans))).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNotNull(), F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = personal_data(documents(spark, sf_dir))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return df.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("all_spans")).alias("spans"))
