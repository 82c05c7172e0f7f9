"""Benchmark passages in documents, found up to a bounded number of edits.

Texts are compared lower-cased, with each run of white space as one space. An item of m
characters may differ in k = floor(rate * m) of them. It is cut into k + 1 pieces: with at
most k edits at least one piece is untouched, so every match holds a piece exactly. All
pieces of all items are searched at once in each whole text; around each hit the edit
distance of the whole item is computed with Myers' bit-parallel columns.

The benchmark is sent to the tasks in blocks of about `block_chars` characters, one pass
over the documents each; what a pass found is written before the next block is read, so that a task and the driver hold one block.

Defined results: null or empty texts and items match nothing. Items with fewer than
`min_chars` characters must occur without any edit. Items that repeat a text are all reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from batchgauge.llm.common import apart, stored

RATE = 0.05
MIN_CHARS = 40
BLOCK_CHARS = 8_000_000

HIT = StructType([
    StructField("item_id", LongType()), StructField("distance", IntegerType()),
    StructField("start", IntegerType()), StructField("until", IntegerType()),
])


def plain(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(length: int, rate: float, min_chars: int) -> int:
    return int(rate * length) if length >= min_chars else 0


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item in edits + 1 parts of nearly equal length, with their places."""
    n = min(edits + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_end(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to a substring of the text, and where the first such one ends."""
    m = len(pattern)
    ones, high = (1 << m) - 1, 1 << (m - 1)
    at: dict[str, int] = {}
    for i, c in enumerate(pattern):
        at[c] = at.get(c, 0) | 1 << i
    plus, minus, score = ones, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = at.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(diagonal | plus) & ones
        down = plus & diagonal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up = up << 1 & ones  # row 0 is free: a match may begin anywhere
        down = down << 1 & ones
        plus = down | ~(diagonal | up) & ones
        minus = up & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float, min_chars: int):
        import ahocorasick

        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            if not text:
                continue
            edits = budget(len(text), rate, min_chars)
            for offset, piece in pieces(text, edits):
                places.setdefault(piece, []).append((len(self.items), offset))
            self.items.append((item_id, text, edits))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[dict]:
        """The best match of each item that occurs within its budget, by item."""
        if not self.items or not text:
            return []
        regions: dict[int, list[list[int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for item, offset in where:
                _, pattern, edits = self.items[item]
                begin = end + 1 - size - offset
                a, b = max(0, begin - edits), min(len(text), begin + len(pattern) + edits)
                found = regions.setdefault(item, [])
                if found and a <= found[-1][1]:
                    found[-1][0] = min(found[-1][0], a)
                    found[-1][1] = max(found[-1][1], b)
                else:
                    found.append([a, b])
        out = []
        for item in sorted(regions):
            item_id, pattern, edits = self.items[item]
            best = None
            for a, b in regions[item]:
                distance, end = best_end(pattern, text[a:b])
                if distance <= edits and (best is None or distance < best[0]):
                    length = best_end(pattern[::-1], text[a : a + end][::-1])[1]
                    best = (distance, a + end - length, a + end)
            if best:
                out.append({"item_id": item_id, "distance": best[0], "start": best[1], "until": best[2]})
        return out


def marked(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS, columns: list[str] | None = None,
) -> DataFrame:
    """`columns` (default: all) of every document plus `hits`: item, distance and place (in the plain text).

    No row is dropped; a clean document has an empty array. An input column `hits` is replaced.
    """
    spark = docs.sparkSession
    wanted = docs.columns if columns is None else columns
    docs, back = apart(docs, ("__hits",))
    own = {name: other for other, name in back.items()}
    names = [own.get(c, c) for c in wanted if c != "hits"]
    fields = {f.name: f for f in docs.schema.fields}
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    size = items.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    passes = max(1, -(-size // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    out = docs.select(*dict.fromkeys([*names, "text"])).withColumn("__hits", F.array().cast(ArrayType(HIT)))
    for k in range(passes):
        if k:  # one automaton a task at a time: what the last pass found is written before the next is made
            out = stored(out, "decontaminate", texts=True)
        block = [(r["item_id"], plain(r["text"])) for r in items.filter(part == k).collect()]
        out = _search(out, spark.sparkContext.broadcast(sorted(block, key=str)), rate, min_chars)
    return out.select(*[F.col(f"`{n}`") for n in fields if n in names], F.col("__hits").alias("hits")).withColumnsRenamed(back)


def _search(docs: DataFrame, block, rate: float, min_chars: int) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value, rate, min_chars)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("until", pa.int32())]))
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))
            hits = [
                (old or []) + matcher.hits(plain(text))
                for text, old in zip(get("text").to_pylist(), get("__hits").to_pylist())
            ]
            yield pa.record_batch({n: pa.array(hits, kind) if n == "__hits" else get(n) for n in names})

    return docs.mapInArrow(run, docs.schema)


def found(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """A row (doc_id, item_id, distance, start, until) for each document and item in it."""
    hits = marked(docs, benchmark, columns=["doc_id"], **settings)
    return hits.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")
