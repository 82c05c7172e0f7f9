"""Removal of word passages that also occur earlier, by super-k-mer partitioning.

A window is `window` consecutive words of one document. Its minimiser is the smallest of
its word n-grams in an order by hash that puts very frequent n-grams last. Consecutive
windows with the same minimiser form a super-k-mer, which travels as one packed string to
the bucket of its minimiser. Equal windows have equal minimisers, so each bucket is judged
on its own: its windows are sorted, and every one but the earliest of equals is a repeat.

The work goes in two steps, so that only text that can repeat is sent. First the bare
buckets are counted, without their text; then the documents with a bucket that occurs
twice send their super-k-mers of those buckets. Copies within a block of documents are
found before the shuffle in either step: only the first of equal super-k-mers travels, and
the others are already known to be repeats. A passage that a third of all documents share
thus sends one string per block, not one per document. A long super-k-mer, such as one word
said again and again, travels in pieces. A task judges a bounded number of windows at once;
of a bucket that holds more, the first of equal windows of each part go on for Spark to sort.

Defined results: null or empty text has no words. Rows are told apart by (doc_id, text);
rows equal in both count as one document and get the same result. Rows with one doc_id and
different texts come in the order of a hash of the text. A null doc_id comes last.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from batchgauge.llm.common import BROADCAST_BYTES, apart, stored
from batchgauge.llm.frequent import demoted, frequent_grams, gram_hashes
from batchgauge.llm.spans import Spans, blocks, text_blocks

WINDOW = 20
GRAM = 5
#: What a task holds of a bucket, and takes of a batch at a time (twice this is judged at once, at most): the bytes of
#: packed strings, and WINDOW_BYTES for each of their windows.
GROUP_BYTES = 24_000_000
WINDOW_BYTES = 16
#: Windows of a packed string: a longer super-k-mer is cut into pieces.
PIECE = 512
#: Windows that are compared or sent in one go, and bytes of packed strings that are hashed in one go.
STEP = 20_000
STEP_BYTES = 500_000
LAST_ID = (1 << 63) - 1
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ADDED = ("n_words", "n_removed", "kept_sha256")


def row_key() -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"),
    ]


class SuperKmers:
    """The super-k-mers of a block: minimiser, document, first word and number of windows."""

    def __init__(self, spans: Spans, window: int, gram: int, frequent: np.ndarray):
        grams, doc = gram_hashes(spans, gram)
        keys = demoted(grams, frequent)
        span = window - gram + 1
        empty = np.zeros(0, np.int64)
        self.key, self.doc, self.word, self.windows = keys[:0].astype(np.int64), empty, empty, empty
        ordered = np.sort(keys)
        #: minimisers that the block holds twice: only their super-k-mers can repeat a window inside
        self.twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]]).astype(np.int64)
        if len(keys) < span:
            return
        least, width = keys, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = span - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        inside = doc[: len(least)] == doc[span - 1 : span - 1 + len(least)]
        least, doc = least[inside], doc[: len(inside)][inside]
        if not len(least):
            return
        # the n-grams of a document start at its words 0, 1, ...: windows number its words too
        per_doc = np.bincount(doc, minlength=len(spans.counts))
        word = np.arange(len(least)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
        new = np.concatenate(([True], (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])))
        at = np.flatnonzero(new)
        self.key, self.doc, self.word = least[at].astype(np.int64), doc[at], word[at]
        self.windows = np.diff(np.concatenate((at, [len(least)])))


def _sorted_rows(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes], list[int]]:
    doc = batch.column(0).to_numpy(zero_copy_only=False)
    tie = batch.column(1).to_numpy(zero_copy_only=False)
    order = np.lexsort((tie, doc))
    doc, tie = doc[order], tie[order]
    return doc, tie, [texts[i] for i in order], order


def _same_as_before(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """For sorted rows: true where a row equals the one before (it counts as the same document)."""
    return np.concatenate(([False], (doc[1:] == doc[:-1]) & (tie[1:] == tie[:-1]))) if len(doc) else np.zeros(0, bool)


def _unique_rows(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    doc, tie, texts, _ = _sorted_rows(batch, texts)
    fresh = ~_same_as_before(doc, tie)
    return doc[fresh], tie[fresh], [t for t, f in zip(texts, fresh) if f]


BUCKETS = "bucket long, doc long, tie long, word int, known boolean"


def _buckets(window: int, gram: int, frequent):
    """Per super-k-mer its bucket and place. Of a bucket's places in one block only the first is open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch):
                doc, tie, texts = _unique_rows(part, texts)
                sk = SuperKmers(Spans(texts), window, gram, frequent.value)
                _, first, back, n = np.unique(sk.key, return_index=True, return_inverse=True, return_counts=True)
                known = (n[back] > 1) | np.isin(sk.key, sk.twice)
                travels = np.zeros(len(sk.key), bool)
                travels[first] = True
                # the others need no bucket: they are spread by their document
                bucket = np.where(travels, sk.key, doc[sk.doc] * 31 + sk.word if len(sk.key) else sk.key)
                yield pa.record_batch({
                    "bucket": bucket, "doc": doc[sk.doc], "tie": tie[sk.doc], "word": sk.word.astype(np.int32),
                    "known": known,
                    "travels": travels,
                })

    return run


def _repeated_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by bucket: the places whose bucket has another place. Holds one row at a time."""
    held = None
    for batch in batches:
        table = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
        if held is not None:
            table = {n: np.concatenate((held[n], table[n])) for n in table}
        b, travels = table["bucket"], table["travels"].astype(bool)
        same = (b[1:] == b[:-1]) & travels[1:] & travels[:-1]
        again = np.concatenate((same, [False])) | np.concatenate(([False], same)) | table["known"].astype(bool)
        if held is not None:
            again[0] |= held["again"]
        out = again.copy()
        out[-1] = False  # the last row waits for its successor
        held = {n: table[n][-1:] for n in table}
        held["again"] = bool(again[-1])
        yield pa.record_batch({n: table[n][out] for n in ("doc", "tie", "word")})
        held = {k: v for k, v in held.items()}
    if held is not None:
        keep = slice(0, 1) if held["again"] else slice(0, 0)
        yield pa.record_batch({n: held[n][keep] for n in ("doc", "tie", "word")})


def _pieces(pick: np.ndarray, word: np.ndarray, windows: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers cut into pieces of at most `most` windows, in order: number, first word and windows of each."""
    n = -(-windows // most)
    at = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * most
    return np.repeat(pick, n), np.repeat(word, n) + at, np.minimum(np.repeat(windows, n) - at, most)


PACKED = "bucket long, doc long, tie long, word int, until int, packed binary"


def _packed(window: int, gram: int, frequent):
    """The super-k-mers named in `words`, packed. Copies of one in the same block are marks (packed: null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_blocks(batch):
                wanted = part.column(part.schema.get_field_index("words")).to_pylist()
                doc, tie, texts, order = _sorted_rows(part, texts)
                wanted = [wanted[i] for i in order]
                fresh = np.flatnonzero(~_same_as_before(doc, tie))
                doc, tie = doc[fresh], tie[fresh]
                spans = Spans([texts[i] for i in fresh])
                sk = SuperKmers(spans, window, gram, frequent.value)
                stride = int(spans.counts.max(initial=0)) + 1
                asked = np.concatenate([np.array(wanted[i], dtype=np.int64) + d * stride for d, i in enumerate(fresh)]) if len(fresh) else np.zeros(0, np.int64)
                pick = np.flatnonzero(np.isin(sk.doc * stride + sk.word, asked))
                pick, word, windows = _pieces(pick, sk.word[pick], sk.windows[pick], max(PIECE, window))
                first = spans.first[sk.doc[pick]] + word
                last = first + windows + window - 2
                starts, ends = spans.start[first].tolist(), spans.end[last].tolist()
                data, seen, strings, travels = spans.data, set(), [], np.ones(len(pick), bool)
                for i, (s, e) in enumerate(zip(starts, ends)):
                    string = data[s:e]
                    if string in seen:
                        travels[i] = False
                        strings.append(None)
                    else:
                        seen.add(string)
                        strings.append(string)
                d = doc[sk.doc[pick]]
                yield pa.record_batch({
                    "bucket": np.where(travels, sk.key[pick], d * 31 + word),
                    "doc": d, "tie": tie[sk.doc[pick]], "word": word.astype(np.int32),
                    "until": (word + windows + window - 1).astype(np.int32),
                    "packed": pa.array(strings, pa.binary()),
                })

    return run


MARKS = "doc long, tie long, word int, until int, window binary"


def _windows(packed: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Of every window of packed strings: its hash, string, place in words, and first and last byte in its string."""
    parts = []
    for a, b in blocks(len(packed), np.array([len(x) for x in packed]), STEP_BYTES):
        spans = Spans(packed[a:b])
        n = np.maximum(spans.counts - window + 1, 0)
        row = np.repeat(np.arange(b - a), n)
        shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        first = spans.first[row] + shift
        base = spans.start[spans.first[row]]
        ints = (a + row, shift, spans.start[first] - base, spans.end[first + window - 1] - base)
        parts.append((spans.hashes(first, first + window - 1), *(x.astype(np.int32) for x in ints)))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _judge(rows: pa.Table, window: int, large: int | None) -> Iterator[pa.RecordBatch]:
    """Repeats among whole buckets: sort all windows of all buckets, compare neighbours, check the words.

    Of the bucket `large` these rows are a part: windows that repeat none of them go on one by one.
    """
    bucket, doc, tie, word = (rows.column(i).to_numpy() for i in range(4))
    order = np.lexsort((word, tie, doc, bucket))
    # a row that is repeated in other blocks sends its super-k-mers again: they are one document's
    again = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (bucket, doc, tie, word)])
    order = order[np.concatenate(([True], ~again))]
    packed = rows.column("packed").to_pylist()
    packed = [packed[i] for i in order]
    bucket, doc, tie, word = bucket[order], doc[order], tie[order], word[order]
    value, row, shift, lo, hi = _windows(packed, window)
    group = np.cumsum(np.concatenate(([True], bucket[1:] != bucket[:-1])), dtype=np.int32)[row]
    by = np.lexsort((value, group))  # stable: the earliest of equal windows stays first
    same = (group[by][1:] == group[by][:-1]) & (value[by][1:] == value[by][:-1])
    del group, value
    said = lambda i: packed[row[i]][lo[i] : hi[i]]
    repeat = np.zeros(len(row), bool)
    spots = np.flatnonzero(same)  # equal hashes are checked by their words, each against the one before
    unlike = []
    for at in range(0, len(spots), STEP):
        some = spots[at : at + STEP]
        before, after = ([x[i].tolist() for x in (row, lo, hi)] for i in (by[some], by[some + 1]))
        pairs = zip(*before, *after)
        equal = np.array([packed[r][a:b] == packed[q][c:d] for r, a, b, q, c, d in pairs], dtype=bool)
        repeat[by[some[equal] + 1]] = True
        unlike.extend(some[~equal].tolist())
    for spot in unlike:  # other words of the same hash: look further back among its equals
        lead, here = spot, by[spot + 1]
        while lead > 0 and same[lead - 1] and not repeat[here]:
            lead -= 1
            repeat[here] = said(by[lead]) == said(here)
    hit = np.flatnonzero(repeat)
    start = word[row[hit]] + shift[hit]
    # runs of neighbouring windows of one string are one interval
    new = np.concatenate(([True], (row[hit][1:] != row[hit][:-1]) | (start[1:] != start[:-1] + 1))) if len(hit) else np.zeros(0, bool)
    a = np.flatnonzero(new)
    b = np.concatenate((a[1:], [len(hit)])) - 1 if len(a) else a
    yield pa.record_batch({
        "doc": doc[row[hit[a]]], "tie": tie[row[hit[a]]], "word": start[a].astype(np.int32),
        "until": (start[b] + window).astype(np.int32), "window": pa.nulls(len(a), pa.binary()),
    })
    if large is None:
        return
    loose = np.flatnonzero(~repeat & (bucket == large)[row])
    for at in range(0, len(loose), STEP):
        some = loose[at : at + STEP]
        start = (word[row[some]] + shift[some]).astype(np.int32)
        yield pa.record_batch({
            "doc": doc[row[some]], "tie": tie[row[some]], "word": start, "until": start + np.int32(window),
            "window": pa.array([said(i) for i in some.tolist()], pa.binary()),
        })


def _bucket_marks(window: int, group_bytes: int):
    """From rows sorted by bucket: intervals of repeated words.

    Whole buckets are judged together. A bucket beyond `group_bytes` is not held: it is judged
    in parts, and the windows that are new to their part go on one by one, for Spark to sort.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_cost, large = None, 0, None  # the last bucket so far; the one of which a part was judged
        for batch in batches:
            table = pa.Table.from_batches([batch])
            marks = table.filter(table.column("packed").is_null())
            if marks.num_rows:
                yield from marks.select(["doc", "tie", "word", "until"]).append_column(
                    "window", pa.nulls(marks.num_rows, pa.binary())).to_batches()
            table = table.filter(table.column("packed").is_valid())
            windows = table.column("until").to_numpy().astype(np.int64) - table.column("word").to_numpy() - window + 1
            cost = pc.binary_length(table.column("packed")).to_numpy() + WINDOW_BYTES * windows
            for a, b in blocks(table.num_rows, cost, group_bytes):
                part = table.slice(a, b - a)
                known = 0 if held is None else held.num_rows
                rows = part if held is None else pa.concat_tables([held, part])
                bucket = rows.column("bucket").to_numpy()
                other = np.flatnonzero(bucket != bucket[-1])
                cut = int(other[-1]) + 1 if len(other) else 0
                if cut:  # what is held is of one bucket: the last one begins in this part
                    yield from _judge(rows.slice(0, cut), window, large)
                    large, held_cost = None, 0
                held, held_cost = rows.slice(cut), held_cost + int(cost[a + max(0, cut - known) : b].sum())
                if held_cost > group_bytes:
                    large = bucket[-1]
                    yield from _judge(held, window, large)
                    held, held_cost = None, 0
        if held is not None:
            yield from _judge(held, window, large)

    return run


def repeated_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Rows (doc, tie, intervals): the word intervals [word, until) of each document that occur earlier."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_grams(docs, gram))
    rows = docs.select(*row_key(), "text")
    open_rows = rows.filter("text is not null").mapInArrow(_buckets(window, gram, frequent), BUCKETS + ", travels boolean")
    suspects = (
        open_rows.repartition("bucket").sortWithinPartitions("bucket", F.desc("travels"))
        .mapInArrow(_repeated_buckets, "doc long, tie long, word int")
        .groupBy("doc", "tie").agg(F.collect_list("word").alias("words"))
    )
    packed = rows.join(suspects, ["doc", "tie"]).select("doc", "tie", "text", "words").mapInArrow(
        _packed(window, gram, frequent), PACKED
    )
    marks = (
        packed.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_bucket_marks(window, group_bytes), MARKS)
    )
    marks = stored(marks, "repeats", texts=True)
    loose = marks.filter("window is not null")
    place = F.struct("doc", "tie", "word")
    late = loose.withColumn("first", F.min(place).over(Window.partitionBy("window"))).filter(place != F.col("first"))
    both = marks.filter("window is null").select("doc", "tie", "word", "until").unionByName(
        late.select("doc", "tie", "word", "until")
    )
    spans = F.array_sort(F.collect_set(F.struct("word", "until")))
    return both.groupBy("doc", "tie").agg(spans.alias("spans")).mapInArrow(_merged, MERGED)


MERGED = "doc long, tie long, words array<int>, untils array<int>"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching intervals of a document become one."""
    for batch in batches:
        words, untils = [], []
        for spans in batch.column(2).to_pylist():
            a, b = [], []
            for x in spans:
                if b and x["word"] <= b[-1]:
                    b[-1] = max(b[-1], x["until"])
                else:
                    a.append(x["word"])
                    b.append(x["until"])
            words.append(a)
            untils.append(b)
        yield pa.record_batch({
            "doc": batch.column(0), "tie": batch.column(1),
            "words": pa.array(words, pa.list_(pa.int32())), "untils": pa.array(untils, pa.list_(pa.int32())),
        })


def _cut(names: list[str]):
    """Remove the marked words of every row; the white space before a removed word goes with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in (block for whole in batches for block in text_blocks(whole)):
            get = lambda n: batch.column(batch.schema.get_field_index(n))
            n_words, n_removed, digest, kept_text = [], [], [], []
            for raw, text, starts, ends in zip(texts, *(get(n).to_pylist() for n in ("text", "__words", "__untils"))):
                words = raw.split()
                total = len(words)
                if starts:
                    keep = np.ones(total, bool)
                    for a, b in zip(starts, ends):
                        keep[a:b] = False
                    out, at = [], 0
                    for i, w in enumerate(WORD.finditer(raw)):
                        if keep[i]:
                            out.append(raw[at : w.end()])
                        at = w.end()
                    text = b"".join(out).strip().decode("utf-8", "surrogatepass")
                    words = [words[i] for i in np.flatnonzero(keep)]
                n_words.append(total)
                n_removed.append(total - len(words))
                digest.append(hashlib.sha256(b" ".join(words)).hexdigest())
                kept_text.append(text)
            made = {
                "text": pa.array(kept_text, pa.string()), "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string()),
            }
            yield pa.record_batch({n: made[n] if n in made else get(n) for n in [*names, *ADDED]})

    return run


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group_bytes: int = GROUP_BYTES,
    columns: list[str] | None = None,
) -> DataFrame:
    """The documents without words that a window which also starts earlier covers.

    Returns `columns` (default: all), with the text that is left if text is one of them, plus
    n_words (before), n_removed and kept_sha256 (of the kept words joined by one space).
    Columns of the input with those three names are replaced. A text without removed words
    is unchanged, a null text stays null. No row is dropped.
    """
    wanted = docs.columns if columns is None else columns
    docs, back = apart(docs, ("__doc", "__tie", "__words", "__untils"))
    own = {name: other for other, name in back.items()}
    names = [own.get(c, c) for c in wanted if c not in ADDED]
    fields = {f.name: f for f in docs.schema.fields}
    schema = StructType(
        [fields[n] for n in names]
        + [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_sha256", StringType())]
    )
    marks = stored(repeated_intervals(docs, window, gram, group_bytes).toDF("__doc", "__tie", "__words", "__untils"), "cuts")
    doc, tie = row_key()
    keyed = docs.select(*dict.fromkeys([*names, "text"]), doc.alias("__doc"), tie.alias("__tie"))
    size = marks.agg(F.sum(F.size("__words") * 8 + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        marks = F.broadcast(marks)
    return keyed.join(marks, ["__doc", "__tie"], "left").drop("__doc", "__tie").mapInArrow(_cut(names), schema).withColumnsRenamed(back)
