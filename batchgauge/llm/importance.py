"""Importance resampling towards a target: Gumbel top-k over hashed n-gram gains, on Arrow kernels.

Words are found by Arrow's ascii_lower and split_pattern_regex, flattened and dictionary encoded, a
block of texts at a time. The n-grams of k words are pairs of a (k-1)-gram's index and the index of the word
that follows, so only distinct pairs are hashed: a CRC is carried on from the CRC of the shorter
n-gram. A bucket (CRC modulo `buckets`) has the gain floor(1000 ln(q/p)), q and p being its
smoothed shares in the target and in the corpus. A document's weight is the floored mean gain
of its n-grams (taken from the distinct ones and reduced over each document's segment), its
score adds a Gumbel number from a hash of its id: the highest scores are a draw without
replacement in proportion to exp(weight / 1000).

Two reads of the texts: one counts, one scores. `buckets` numbers of each side go to the driver and back
to the tasks, whatever the input; the draw is ranked by ranges of the score (`ranks.positioned`) and only rows above
the score where the draw ends are ranked at all.

Defined results: null or empty text has no word, weight 0, and is never drawn. A null doc_id
hashes as empty text and comes last among equal scores; rows that repeat a doc_id are documents of their own, which
equal scores order by n_features and weight. Empty tables give no rows, an empty target leaves the smoothed
shares. Other columns of the input are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from batchgauge.llm.common import stored, text_batches
from batchgauge.llm.ranks import positioned
from batchgauge.llm.spans import blocks

#: What separates words: all of ASCII but digits and a-z (A-Z are lower-cased before).
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NGRAMS = 2
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
BLOCK_BYTES = 8_000_000


def text_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of about BLOCK_BYTES of text."""
    texts = batch.column(batch.schema.get_field_index("text"))
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in blocks(batch.num_rows, sizes, BLOCK_BYTES):
        yield batch.slice(a, b - a)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For every word its document and its place in the list of distinct words; and that list."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=SEPARATORS)
    flat = pc.list_flatten(parts)
    doc = np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    word = pc.not_equal(flat, "")  # before a first and after a last separator
    coded = flat.filter(word).dictionary_encode()
    return (
        doc[word.to_numpy(zero_copy_only=False)], coded.indices.to_numpy().astype(np.int64),
        coded.dictionary.cast(pa.binary()).to_pylist(),
    )


def ngram_codes(doc: np.ndarray, codes: np.ndarray, words: list[bytes], ngrams: int) -> Iterator[tuple]:
    """For k = 1..ngrams: the document and distinct index of every run of k words, and the CRC of each distinct one."""
    crcs = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words))
    at, index = np.arange(len(codes)), codes
    yield doc, index, crcs
    for k in range(2, ngrams + 1):
        inside = at + k - 1 < len(codes)
        at, index = at[inside], index[inside]
        inside = doc[at] == doc[at + k - 1]
        at, index = at[inside], index[inside]
        pairs, index = np.unique(index * len(words) + codes[at + k - 1], return_inverse=True)
        head, tail = np.divmod(pairs, max(1, len(words)))
        before = crcs
        crcs = np.fromiter(
            (zlib.crc32(b" " + words[t], int(before[h])) for h, t in zip(head, tail)), np.int64, len(pairs)
        )
        yield doc[at], index, crcs


def _counting(ngrams: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch):
                for _, index, crcs in ngram_codes(*word_codes(part.column("text")), ngrams):
                    total += np.bincount((crcs % buckets)[index], minlength=buckets)
        found = np.flatnonzero(total)
        yield pa.record_batch({"bucket": found.astype(np.int64), "n": total[found]})

    return run


def bucket_counts(texts: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> list[int]:
    """How many n-grams of all texts fall into each bucket: a row per bucket and task is shuffled."""
    counted = texts.select("text").mapInArrow(_counting(ngrams, buckets), "bucket long, n long")
    with text_batches(texts.sparkSession):
        rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most `buckets` rows
    counts = [0] * buckets
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    many, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + many) / ((s + 1) * (t_all + many)))) for s, t in zip(corpus, target)
    ], np.int64)


def _weighing(ngrams: int, gains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for batch in batches:
            for part in text_slices(batch):
                doc, codes, words = word_codes(part.column("text"))
                rows = part.num_rows
                n, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                for of, index, crcs in ngram_codes(doc, codes, words, ngrams):
                    each = pa.array(gain[crcs % len(gain)]).take(pa.array(index)).to_numpy()
                    # documents are segments: sums are differences of a running one
                    ends = np.searchsorted(of, np.arange(rows + 1))
                    sums = np.concatenate(([0], np.cumsum(each)))
                    n += np.diff(ends)
                    total += np.diff(sums[ends])
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_words": np.bincount(doc, minlength=rows).astype(np.int64),
                    "n_features": n, "weight": np.floor_divide(total, np.maximum(n, 1)),
                })

    return run


def gumbel(key: str = "doc_id", seed: int = SEED) -> Column:
    """floor(1000 g) of a standard Gumbel number g from the SHA-256 of seed and id, the same everywhere."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, ngrams: int = NGRAMS, buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), one per row of docs; rank is null where it is not drawn.

    `percent` of the documents with at least `least_words` words are drawn. `target` has a column `text`.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gains = bucket_gains(bucket_counts(base, ngrams, buckets), bucket_counts(target, ngrams, buckets))
    weighed = base.mapInArrow(
        _weighing(ngrams, spark.sparkContext.broadcast(gains)), "doc_id long, n_words long, n_features long, weight long"
    )
    rows = stored(weighed.withColumn("score", F.col("weight") + gumbel(seed=seed)), "importance", texts=True)
    may = F.col("n_words") >= least_words
    # scores are whole numbers of a bounded range: a count of each says where the draw ends
    by_score = rows.filter(may).groupBy("score").count().orderBy(F.desc("score")).collect()
    wanted = percent * sum(r["count"] for r in by_score) // 100
    cut, above = None, 0
    for r in by_score:
        if above >= wanted:
            break
        cut, above = r["score"], above + r["count"]
    columns = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return rows.select(*columns, undrawn)
    top = may & (F.col("score") >= cut)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = positioned(rows.filter(top).select(*columns), order, label="importance-ranks")
    return ranked.select(*columns, F.when(F.col("pos") < wanted, F.col("pos") + 1).alias("rank")).unionByName(
        rows.filter(~top).select(*columns, undrawn)
    )
