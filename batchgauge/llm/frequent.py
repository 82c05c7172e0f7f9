"""Word n-grams that very many documents share, found from counts over all documents.

They only decide the order in which other operators prefer n-grams (rare ones first), so
that no frequent phrase becomes a hot key. No result depends on the list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from batchgauge.llm.common import text_batches
from batchgauge.llm.spans import Spans, text_blocks

LOCAL_COUNT = 4
TOTAL_COUNT = 64
MAX_GRAMS = 200_000
HIGH = np.uint64(1 << 63)


def gram_hashes(spans: Spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every n-gram of a block; the top bit of a hash is free."""
    n = int(spans.first[-1])
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = spans.doc_of_word()
    at = np.arange(n - size + 1)
    at = at[doc[at] == doc[at + size - 1]]
    return spans.hashes(at, at + size - 1) >> np.uint64(1), doc[at]


def frequent_grams(docs: DataFrame, size: int, lower: bool = False, local_count: int = LOCAL_COUNT) -> np.ndarray:
    """Sorted hashes of the most frequent n-grams, at most MAX_GRAMS of them.

    Each block of documents reports the n-grams that it holds at least `local_count` times;
    the reports of all blocks are added up. A phrase in a fixed share of all documents is
    reported by nearly every block, whatever the table's size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_blocks(batch):
                spans = Spans([t.lower() for t in texts] if lower else texts)
                grams, n = np.unique(gram_hashes(spans, size)[0], return_counts=True)
                keep = n >= local_count
                yield pa.record_batch({"gram": grams[keep].astype(np.int64), "n": n[keep].astype(np.int64)})

    counted = docs.select("text").filter("text is not null").mapInArrow(count, "gram long, n long")
    top = (
        counted.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= TOTAL_COUNT)
        .orderBy(F.desc("n"), "gram").limit(MAX_GRAMS)
    )
    with text_batches(docs.sparkSession):
        top = top.toPandas()
    return np.sort(top["gram"].to_numpy(np.int64).astype(np.uint64))


def demoted(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The hashes as order keys: those of frequent n-grams come after all others."""
    if not len(frequent):
        return grams
    spot = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    return np.where(frequent[spot] == grams, grams | HIGH, grams)
