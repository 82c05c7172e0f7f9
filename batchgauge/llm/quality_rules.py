"""Quality rules, and a likelihood ratio between trusted and raw text. DataFrame functions only.

A document's hashed word unigrams and bigrams are scored by log p(trusted) - log p(raw), the
two multinomials being counted over the trusted documents and over all documents (without
the n-gram in question), and the mean over the document's n-grams is its ratio: the same for a long and a short text. A
document is kept if it passes the base rules and its ratio reaches a fixed threshold; nothing
is drawn at random.

Counting: each n-gram becomes a bucket number and the buckets are summed before the shuffle,
so that a hot source or a frequent word is a few rows per task. The table of the `buckets`
log ratios is a constant of the plan, of fixed size.

Defined results: null text has no words and no lines and fails the base rules; its ratio is 0.
Without trusted documents every ratio is 0 and only the base rules decide.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from batchgauge.llm.common import small

BUCKETS = 1 << 14
PRIOR = 64
THRESHOLD = -0.05
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def words(text: str = "text") -> Column:
    return F.filter(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), lambda w: w != "")


def window_hashes(w: Column, window: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(w) - (window - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, F.lit(window))))
    return F.when(F.size(w) >= window, hashes).otherwise(F.array().cast("array<bigint>"))


def sorted_hashes(h: Column) -> Column:
    return F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))


def repeated_spots(s: Column) -> Column:
    """From sorted (hash, place) pairs: the places whose hash has another place, in order."""
    same = lambda e, i: F.coalesce(F.get(s, i)["h"] == e["h"], F.lit(False))
    return F.array_sort(F.transform(F.filter(s, lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["i"]))


def base_rules(docs: DataFrame, window: int = 8) -> DataFrame:
    """doc_id, the mark `_t`, the words (`_w`), the counts of the base rules and base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    out = docs.select(
        "doc_id", "_t", words().alias("_w"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_l"),
    )
    out = out.withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long")).drop("_l")
    out = out.withColumn("_h", window_hashes(F.col("_w"), window))
    # most texts repeat no window: only the others are sorted
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("_s", F.when(twice, sorted_hashes(F.col("_h"))).otherwise(empty)).drop("_h")
    out = out.withColumn("_p", repeated_spots(F.col("_s"))).drop("_s")
    gaps = F.transform(F.col("_p"), lambda p, i: F.least(F.lit(window), F.coalesce(F.get(F.col("_p"), i + 1) - p, F.lit(window))))
    out = out.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_p")
    out = out.withColumn("n_words", F.size("_w").cast("long"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def grams(buckets: int, w: str = "_w") -> Column:
    """The bucket of every unigram and bigram of a text."""
    col, n = F.col(w), F.size(w)
    one = F.transform(col, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
    two = F.transform(
        F.slice(col, 2, F.greatest(n - 1, F.lit(0))),
        lambda x, i: F.pmod(F.xxhash64(F.get(col, i), x), F.lit(buckets)).cast("int"),
    )
    return F.concat(one, two)


def log_ratios(docs: DataFrame, buckets: int = BUCKETS) -> tuple[list[float], list[float]]:
    """Per bucket log p(trusted) - log p(raw), for a document outside and for one inside the trusted set.

    docs: the words `_w` and `_t`, 1 for trusted documents. An n-gram is judged by the others of
    its bucket: its own count is left out on both sides, and PRIOR pseudo n-grams with the
    corpus' share of trusted text are put in. So an n-gram that no other text has says nothing,
    and a trusted document is not judged by itself.
    """
    counted = (
        docs.select("_t", F.explode(grams(buckets)).alias("bucket"))
        .groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("_t").alias("good")).collect()
    )
    share = sum(r["good"] for r in counted) / max(1, sum(r["raw"] for r in counted))
    outside, inside = [0.0] * buckets, [0.0] * buckets
    for r in counted if share else ():
        prior, others = PRIOR * share, share * (r["raw"] - 1 + PRIOR)
        outside[r["bucket"]] = math.log((r["good"] + prior) / others)
        inside[r["bucket"]] = math.log((max(r["good"] - 1, 0) + prior) / others)
    return outside, inside


def _looked_up(table: Column) -> Column:
    return F.aggregate("_g", F.lit(0.0), lambda a, g: a + F.get(table, g))


def judged(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs the base counts, the ratio and whether it is kept. trusted: a table of doc_id."""
    marks = trusted.filter("doc_id is not null").select("doc_id").distinct().withColumn("_t", F.lit(1))
    known = docs.select("doc_id", "text").join(small(marks, 24), "doc_id", "left").withColumn("_t", F.coalesce("_t", F.lit(0)))
    tables = [
        F.split(F.lit(",".join(map(repr, t))), ",").cast("array<double>")
        for t in log_ratios(known.select("_t", words().alias("_w")), buckets)
    ]
    rows = base_rules(known).withColumn("_g", grams(buckets))
    outside, inside = (_looked_up(t) for t in tables)
    total = F.when(F.col("_t") == 1, inside).otherwise(outside)
    ratio = F.when(F.size("_g") > 0, total / F.size("_g")).otherwise(0.0)
    return rows.withColumn("ratio", ratio).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("ratio") >= threshold)).alias("kept"), "ratio",
    )
