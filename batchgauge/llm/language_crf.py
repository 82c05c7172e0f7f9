"""Language identification by a linear-chain conditional random field over words.

Every word (a run of letters, lower-cased) is labelled with a language. Its score for a
language is a sum of learned weights: character n-grams, prefixes and suffixes (hashed), and
membership in the languages' learned lexicons. Learned transitions tie neighbouring words
together, so text that switches between languages is labelled passage by passage.
Forward-backward gives each word's probabilities; a document's language is the one with the
largest share of words, and the score is that share.

Learned on the driver from at most `per_language` documents of each language (a documented
bound; the sample is the same on every run), every lang value being a language; the model and
its time grow with the number of languages. Applied to every word of every whole text.

Defined results: `und` with score 0 for null text, text without a letter, or nothing learned.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from batchgauge.llm.common import bounded_sample, held_out
from batchgauge.llm.spans import blocks

PER_LANGUAGE = 120
STEPS = 30
HASHED = 1 << 16
LEXICON_COUNT = 3
LEXICON_WORDS = 20_000
BLOCK_CHARS = 1_000_000
WORD = re.compile(r"[^\W\d_]+")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_SEED = 0x27D4EB2F165667C5


def words_of(text: str | None) -> list[str]:
    """The runs of letters. Fractions, raised digits and Roman numerals count as word characters but are none."""
    found = WORD.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return [x for w in found for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def _word_features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of distinct words, and the word each belongs to; grouped by word for each kind."""
    lens = np.array([len(w) + 2 for w in words], dtype=np.int64)
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lens)
    first = np.cumsum(lens) - lens
    features, owners = [], []

    def add(at: np.ndarray, n: int, kind: int) -> None:
        value = np.full(len(at), np.uint64((kind + 1) * _SEED % (1 << 64)))
        for k in range(n):
            value = (value ^ chars[at + k]) * _ODD[k % 3]
            value ^= value >> np.uint64(29)
        features.append((value >> np.uint64(40)).astype(np.int64) % HASHED)
        owners.append(owner[at])

    for n in (1, 2, 3):
        at = np.arange(max(0, len(chars) - n + 1))
        add(at[owner[at] == owner[at + n - 1]], n, n)
    for n in (4, 5):  # with the mark of the word's edge: prefixes and suffixes of 3 and 4 letters
        fit = lens >= n
        add(first[fit], n, 10 + n)
        add(first[fit] + lens[fit] - n, n, 20 + n)
    known = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    bits = [(i, b) for i, mask in known for b in range(mask.bit_length()) if mask >> b & 1]
    features.append(np.array([HASHED + b for _, b in bits], dtype=np.int64))
    owners.append(np.array([i for i, _ in bits], dtype=np.int64))
    return np.concatenate(features), np.concatenate(owners)


def _columns(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pack sequences into columns of about equal length: (token numbers [T, C], padded by the last+1; first flags)."""
    total, longest = int(lengths.sum()), int(lengths.max())
    depth = max(longest, -(-total // 256))
    heap = [(0, c) for c in range(max(1, -(-total // depth)))]
    offset = np.cumsum(lengths) - lengths
    spot = np.zeros((len(lengths), 2), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        load, c = heapq.heappop(heap)
        spot[i] = load, c
        heapq.heappush(heap, (load + int(lengths[i]), c))
    t = max(load for load, _ in heap)
    index = np.full((t, len(heap)), total, dtype=np.int64)
    start = np.zeros((t, len(heap)), dtype=bool)
    row = np.repeat(spot[:, 0], lengths) + np.arange(total) - np.repeat(offset, lengths)
    index[row, np.repeat(spot[:, 1], lengths)] = np.arange(total)
    start[spot[lengths > 0, 0], spot[lengths > 0, 1]] = True
    return index, start


def forward_backward(emission: np.ndarray, lengths: np.ndarray, transition: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Label probabilities of every word of every sequence; with `pairs` also the expected
    transitions and the probabilities of the first words."""
    lengths = np.asarray(lengths, dtype=np.int64)
    n, labels = emission.shape
    index, first = _columns(lengths)
    first |= index == n  # nothing passes from the filling of a column to a sequence
    top = emission.max(axis=1, keepdims=True)
    likely = np.ones((n + 1, labels))
    likely[:n] = np.exp(np.maximum(emission - top, -60.0))
    step = likely[index]  # [T, C, L]
    a = np.exp(transition)
    begin = np.exp(start)
    T = len(index)
    alpha, beta = np.empty_like(step), np.empty_like(step)
    any_first = first.any(axis=1)
    now = np.full(step.shape[1:], 1.0 / labels)
    for t in range(T):
        now = now @ a
        if any_first[t]:
            now[first[t]] = begin
        now *= step[t]
        now /= now.sum(axis=1)[:, None]
        alpha[t] = now
    ones = np.ones(labels)
    now = np.ones(step.shape[1:])
    at = a.T.copy()
    for t in range(T - 1, -1, -1):
        beta[t] = now
        now = (now * step[t]) @ at
        now /= now.sum(axis=1)[:, None]
        if any_first[t]:
            now[first[t]] = ones
    both = alpha * beta
    both /= both.sum(axis=2, keepdims=True)
    out = np.empty((n + 1, labels))
    out[index] = both
    if not pairs:
        return out[:n]
    live = index < n
    inner = live[1:] & ~first[1:]
    x, y = alpha[:-1][inner], (beta * step)[1:][inner]
    z = np.einsum("ni,ij,nj->n", x, a, y)
    expected = a * np.einsum("ni,nj->ij", x / z[:, None], y)
    return out[:n], expected, out[:n][np.cumsum(lengths) - lengths]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    lexicon: dict[str, int]

    def emission(self, words: list[str]) -> np.ndarray:
        features, owner = _word_features(words, self.lexicon)
        out = np.zeros((len(words), len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(owner, self.weights[features, k], minlength=len(words))
        return out

    def shares(self, texts: list[list[str]]) -> np.ndarray:
        """Mean label probabilities of each list of words (0 for an empty one)."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        out = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(lengths)
        if not len(full):
            return out
        flat = np.empty(int(lengths.sum()), dtype=object)
        flat[:] = [w for t in texts for w in t]
        code, distinct = pd.factorize(flat)
        post = forward_backward(self.emission(list(distinct))[code], lengths[full], self.transition, self.start)
        at = np.cumsum(lengths[full]) - lengths[full]
        out[full] = np.add.reduceat(post, at, axis=0) / lengths[full][:, None]
        return out


def fit(sample: list[tuple[str, str]], steps: int = STEPS, joined: int = 4) -> Model | None:
    """Maximum likelihood with a small ridge, by adaptive gradient steps. `joined` documents in a row are one
    sequence, so that switches between languages are seen and get a weight of their own."""
    sample = [(w, lang) for w, lang in ((words_of(t), lang) for t, lang in sample) if w]
    if not sample:
        return None
    languages = sorted({lang for _, lang in sample})
    number = {lang: i for i, lang in enumerate(languages)}
    seen = [Counter() for _ in languages]
    for words, lang in sample:
        seen[number[lang]].update(words)
    lexicon: dict[str, int] = {}
    for i, counts in enumerate(seen):
        for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            if n >= LEXICON_COUNT:
                lexicon[w] = lexicon.get(w, 0) | 1 << i
    lengths = np.array([sum(len(w) for w, _ in sample[i : i + joined]) for i in range(0, len(sample), joined)])
    truth = np.concatenate([np.full(len(w), number[lang]) for w, lang in sample])
    flat = np.empty(len(truth), dtype=object)
    flat[:] = [x for w, _ in sample for x in w]
    code, distinct = pd.factorize(flat)
    features, owner = _word_features(list(distinct), lexicon)
    size, labels = HASHED + len(languages), len(languages)
    weights, transition, start = np.zeros((size, labels)), np.zeros((labels, labels)), np.zeros(labels)
    first = np.cumsum(lengths) - lengths
    inner = np.ones(len(truth), bool)
    inner[first] = False
    spots = np.flatnonzero(inner)
    seen_pairs = np.zeros((labels, labels))
    np.add.at(seen_pairs, (truth[spots - 1], truth[spots]), 1.0)
    seen_first = np.bincount(truth[first], minlength=labels)
    seen_word = np.zeros((len(distinct), labels))
    np.add.at(seen_word, (code, truth), 1.0)
    memory = [np.full_like(x, 1e-8) for x in (weights, transition, start)]
    for _ in range(steps):
        emission = np.stack([np.bincount(owner, weights[features, k], minlength=len(distinct)) for k in range(labels)], axis=1)
        post, pairs, heads = forward_backward(emission[code], lengths, transition, start, pairs=True)
        miss = seen_word - np.stack([np.bincount(code, post[:, k], minlength=len(distinct)) for k in range(labels)], axis=1)
        push = np.stack([np.bincount(features, miss[owner, k], minlength=size) for k in range(labels)], axis=1)
        grads = (push - 0.05 * weights, seen_pairs - pairs - 0.05 * transition, seen_first - heads.sum(axis=0) - 0.05 * start)
        for value, grad, mem in zip((weights, transition, start), grads, memory):
            mem += grad * grad
            value += 0.3 * grad / np.sqrt(mem)
    return Model(languages, weights.astype(np.float32), transition, start, lexicon)


def trained(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from the documents whose key is not held out."""
    known = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()
    )
    rows = bounded_sample(known, "doc_id", "lang", per_language, max_strata=None).select("doc_id", "text", "lang").collect()
    rows.sort(key=lambda r: (hash_of(r["doc_id"]), r["text"], r["lang"]))
    return fit([(r["text"], r["lang"]) for r in rows])


def hash_of(key) -> int:
    return zlib.crc32(f"order {key}".encode())


def identified(docs: DataFrame, per_language: int = PER_LANGUAGE, columns: list[str] | None = None) -> DataFrame:
    """`columns` (default: all) of every document plus lang_pred and lang_score. No row is dropped.

    Input columns called lang_pred or lang_score are replaced.
    """
    names = [c for c in (docs.columns if columns is None else columns) if c not in ("lang_pred", "lang_score")]
    fields = {f.name: f for f in docs.schema.fields}
    schema = StructType([fields[n] for n in names] + [StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(trained(docs, per_language))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            for a, b in blocks(len(texts), np.array([len(t or "") for t in texts], dtype=np.int64), BLOCK_CHARS):
                words = [words_of(t) for t in texts[a:b]]
                lang, score = ["und"] * (b - a), np.zeros(b - a)
                if model is not None:
                    shares = model.shares(words)
                    best = shares.argmax(axis=1)
                    lang = [model.languages[k] if w else "und" for k, w in zip(best, words)]
                    score = np.clip(shares[np.arange(b - a), best], 0.0, 1.0)
                part = batch.slice(a, b - a)
                yield pa.record_batch({
                    **{n: part.column(part.schema.get_field_index(n)) for n in names},
                    "lang_pred": pa.array(lang, pa.string()), "lang_score": pa.array(score, pa.float64()),
                })

    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, schema)
