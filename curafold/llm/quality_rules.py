"""Operator 1, quality rules by weak supervision, in DataFrame functions only.

Nine rules vote for a text (+1), against it (-1) or abstain (0). Votes are counted by pattern; there
are at most 3^9 patterns however many documents, and expectation-maximisation (Dawid and Skene's model,
where abstaining is an outcome too) runs on these counts as Spark aggregations. The posterior is then a plain
expression over the votes, so that no join or second reading of the texts is needed.

Defined cases: a null or empty text has no words, all counts zero and base_failed true. A null doc_id
stays null. Repeated rows each give a row. An empty table gives an empty table. Other columns of the
input aren't read, so their names can't clash. Long texts are handled inside their row by sorted
arrays of window hashes, O(n log n) in the number of words. Windows count as equal if their 64-bit hashes are: among
the windows of a text of a million words two different ones agree with a chance of 3e-8.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, staged, text_of

WINDOW = 5
SYMBOLS = r"[^#*$%&|<>]+"
#: Where EM starts: the share of good texts, and the chance of each vote on a good and on a bad text.
PRIOR, START, PSEUDO = 0.85, {1: (0.8, 0.3), 0: (0.18, 0.35), -1: (0.02, 0.35)}, 10


def _bound(value: Column, use) -> Column:
    """use(value), with value evaluated once a row: inside a lambda a plain expression would be evaluated for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Number of word positions inside a WINDOW-word window that is found twice or more."""
    n = F.size(words)
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    none = F.lit(0).cast("long")

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def repeats(ranked: Column) -> Column:
            marks = F.zip_with(
                ranked,
                F.zip_with(F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), ranked), F.slice(ranked, 2, F.size(ranked)), lambda x, y: F.struct(x["h"].alias("x"), y["h"].alias("y"))),
                lambda own, near: F.when((own["h"] == near["x"]) | (own["h"] == near["y"]), own["i"]),
            )
            return F.sort_array(F.filter(marks, lambda i: i.isNotNull()))

        first = F.struct(none.alias("sum"), F.lit(-WINDOW).alias("last"))
        step = lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("sum"), i.alias("last"))
        return F.aggregate(_bound(ranked, repeats), first, step, lambda acc: acc["sum"])

    found = _bound(windows, lambda hashes: F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), none).otherwise(covered(hashes)))
    return F.when(n < WINDOW + 1, none).otherwise(found)


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts for each document, all from its own row."""
    body = text_of(text)
    df = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        body.alias("_t"),
        F.regexp_extract_all(body, F.lit(WORD), F.lit(0)).alias("_w"),
    )
    lines = F.filter(F.split(F.col("_t"), "\n", -1), lambda x: x.rlike(WORD))
    joined = F.array_join("_w", "")
    return df.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_t", SYMBOLS, "")).cast("long").alias("n_symbols"),
        _bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        _repeat_words(F.col("_w")).alias("n_repeat_words"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"),
        F.length(F.regexp_replace("_t", r"[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace(joined, r"[\p{L}\p{M}]+", "")).cast("long").alias("n_other"),
        F.length(F.regexp_replace("_t", r"[^!?]+", "")).cast("long").alias("n_shouts"),
        F.size(lines).cast("long").alias("n_lines"),
    )


def rules() -> dict[str, Column]:
    """Name to vote: +1 good, -1 bad, 0 abstains. Most rules know one kind of junk and abstain otherwise."""

    def vote(bad: Column, good: Column | None = None) -> Column:
        cast = F.when(bad, -1)
        return F.coalesce(cast if good is None else cast.when(good, 1), F.lit(0)).cast("int")

    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "length": vote(F.col("n_words") < 10),
        "repeats": vote(F.col("n_repeat_words") * 100 > words * 20),
        "symbols": vote(F.col("n_symbols") * 100 > chars * 8, F.col("n_symbols") * 100 <= chars * 3),
        "lines": vote(F.col("n_dup_lines") * 100 > F.col("n_lines") * 30),
        "capitals": vote(F.col("n_upper") * 100 > chars * 30),
        "letters": vote(F.col("n_other") * 100 > chars * 20, F.col("n_other") * 100 <= chars * 8),
        "shouts": vote(F.col("n_shouts") * 100 > words * 15),
        "word_length": vote(~F.col("word_chars").between(words * 2, words * 16)),
        "variety": vote(F.col("n_distinct_words") * 100 < F.least(words, F.lit(200)) * 15),
    }


def posterior(names: list[str], prior: float, chance: dict[str, dict[int, tuple[float, float]]]) -> Column:
    """Probability that a text is good, given its votes. chance: for each rule and vote (1, 0, -1) its
    probability on a good and on a bad text."""
    total = F.lit(log(prior / (1 - prior)))
    for name in names:
        weight = {vote: log(good / bad) for vote, (good, bad) in chance[name].items()}
        total = total + F.when(F.col(name) == 1, weight[1]).when(F.col(name) == -1, weight[-1]).otherwise(weight[0])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(votes: DataFrame, names: list[str], rounds: int = 12) -> tuple[float, dict[str, dict[int, tuple[float, float]]]]:
    """EM on the counts of vote patterns: the driver holds six numbers a rule.

    A vote against stays at least twice as likely on bad texts, and a vote for at least as likely on good
    ones, which fixes the sign that the likelihood alone leaves open."""
    patterns = staged(votes.groupBy(*names).agg(F.count("*").alias("n")), "vote_patterns").coalesce(1)
    prior, chance = PRIOR, dict.fromkeys(names, START)
    for _ in range(rounds):
        q, n = F.col("q"), F.col("n")
        sums = [F.sum(n).alias("all"), F.sum(n * q).alias("good")]
        for k in names:
            for vote in START:
                cast = n * (F.col(k) == vote).cast("int")
                sums += [F.sum(cast * q).alias(f"good_{vote}_{k}"), F.sum(cast * (1 - q)).alias(f"bad_{vote}_{k}")]
        row = patterns.withColumn("q", posterior(names, prior, chance)).agg(*sums).first()
        if not row["all"]:
            break
        good, bad = row["good"], row["all"] - row["good"]
        prior = min(max(good / row["all"], 0.05), 0.95)
        for k in names:
            # PSEUDO pseudo-texts of either kind vote as at the start: rules that hardly vote stay near it
            new = {v: ((row[f"good_{v}_{k}"] + PSEUDO * g) / (good + PSEUDO), (row[f"bad_{v}_{k}"] + PSEUDO * b) / (bad + PSEUDO)) for v, (g, b) in START.items()}
            new[-1] = (min(new[-1][0], new[-1][1] / 2), new[-1][1])
            new[1] = (new[1][0], min(new[1]))
            chance[k] = new
    return prior, chance


def quality_rules(docs: DataFrame, threshold: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: counts, the votes, quality (posterior probability), base_failed and kept."""
    table, names = rules(), list(rules())
    counted = staged(features(docs, doc_id, text), "quality_features")
    votes = counted.select("*", *[c.alias(k) for k, c in table.items()])
    prior, chance = fit(votes, names)
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    scored = votes.withColumn("quality", posterior(names, prior, chance)).withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"]
    return quality_rules(documents(spark, sf_dir)).select(*names)


__all__ = ["SPACES", "features", "fit", "posterior", "quality_rules", "query", "rules"]
