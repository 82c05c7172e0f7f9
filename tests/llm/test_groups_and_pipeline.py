"""Near-duplicate groups at small bounds, and every stage of the pipeline, against brute force; nulls, empty tables, repeats, extra columns."""

import glob
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from batchgauge.llm import chat_format, importance, jaccard_join, language_crf
from batchgauge.llm.common import dropped, stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_groups(rows):
    """From (doc_id, text): (doc_id, shingles, component) per row; a set is a vertex, a null id none."""
    own = [shingles(t) if i is not None else frozenset() for i, t in rows]
    sets = sorted({s for s in own if s}, key=sorted)
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for k, a in enumerate(sets):
        for b in sets[:k]:
            if 100 * len(a & b) >= 75 * len(a | b):
                root[find(a)] = find(b)
    names = {}
    for (i, _), s in zip(rows, own):
        if s:
            names[find(s)] = min(names.get(find(s), i), i)
    return sorted(((i, len(shingles(t)), names[find(s)] if s else i) for (i, t), s in zip(rows, own)), key=str)


def family(rng, words, size, members, edits):
    base = rng.choices(words, k=size)
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(size)] = rng.choice(words) + "x"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("dense, block", [(2, 300), (5, 10**6), (10**6, 10**6)])
def test_groups_at_any_bound(spark, monkeypatch, dense, block):
    monkeypatch.setattr(jaccard_join, "DENSE", dense)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", block)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(300)]
    texts = family(rng, words, 80, 60, 9) + family(rng, words, 40, 30, 4) + family(rng, words, 9, 10, 1)
    passage = " ".join(rng.choices(words, k=40))
    texts += [passage + " " + " ".join(f"own{i}-{k}" for k in range(12)) for i in range(30)]
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (None, texts[0])]
    rows += [(i, t.upper()) for i, t in rows[:5]] + rows[7:9]
    # one id with several texts
    rows += [(10, texts[50]), (11, texts[51]), (11, texts[52]), (2, texts[60] + " tail"), (3, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rep": F.lit(1), "component_id": F.lit("c"), "token": F.lit(2)})
    got = sorted(map(tuple, jaccard_join.near_duplicates(docs.repartition(4)).collect()), key=str)
    assert got == brute_groups(rows)


def test_an_id_with_two_texts_loses_no_link(spark):
    rng = random.Random(2)
    a, b = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(40)) for x in "ab")
    rows = [(1, b), (2, b), (2, a), (3, b), (4, b + " more"), (-5, a), (0, a + " end")]
    got = sorted(map(tuple, jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_groups(rows)
    high = [(i + (1 << 62) if i > 0 else i, t) for i, t in rows]
    got = sorted(map(tuple, jaccard_join.near_duplicates(spark.createDataFrame(high, "doc_id long, text string")).collect()), key=str)
    assert got == brute_groups(high)


# --- stages ---


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    rng = random.Random(21)
    items = [(k, " ".join(f"q{rng.randrange(900)}" for _ in range(30))) for k in range(3)] + [(8, None), (9, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path), dict(items)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]])
def test_stages_on_empty_tables_and_odd_rows(spark, folder, stage):
    path, _ = folder
    empty = table(spark, [])
    assert stage(spark, empty, path).columns == empty.columns and stage(spark, empty, path).count() == 0
    words = " ".join(f"word{i}" for i in range(60))
    odd = [(1, words, "en", "a"), (1, words, "en", "a"), (None, None, None, None), (2, None, "en", None), (3, "", None, "a"), (None, "plain words", "en", "a"),
           (4, "x" * 300_000 + " y", "en", "a"), (5, "letters here", "en", "a")]
    docs = table(spark, odd).withColumns({"__doc": F.lit(1), "__HITS": F.lit(4), "__words": F.lit("w"), "hits": F.lit("h"), "component_id": F.lit(2), "lang_pred": F.lit("?"), "n_words": F.lit(3)})
    got = stage(spark, docs, path)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    rows = got.collect()
    assert {5, 4} <= {r["doc_id"] for r in rows} and all(r["hits"] == "h" and r["n_words"] == 3 and r["__HITS"] == 4 and r["__words"] == "w" for r in rows)


def test_mix_stage(spark, folder):
    assert corpus_pipeline.mix(spark, table(spark, []), "").count() == 0
    rows = [(i, "w " * (i % 5), "en", "ab"[i % 2]) for i in range(50)] + [(None, None, None, None), (7, "w w", "en", None)]
    got = corpus_pipeline.mix(spark, table(spark, rows).withColumn("size", F.lit(9)), "").collect()
    assert len(got) == 52 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark):
    rng = random.Random(4)
    a, b, c = (" ".join(rng.choices([f"{x}{i}" for i in range(200)], k=50)) for x in "abc")
    rows = [(1, a, "en", "s"), (2, a + " z", "en", "s"), (2, b, "en", "s"), (2, b, "en", "t"), (3, b, "en", "s"), (4, c, "en", "s"), (4, c, "en", "s"),
            (5, None, "en", "s"), (5, None, "en", "s"), (6, "", "en", "s"), (None, a, "en", "s")]
    got = sorted(((r["doc_id"], r["text"], r["source"]) for r in corpus_pipeline.near_duplicates(spark, table(spark, rows), "").collect()), key=str)
    # the text of doc 2 that is no copy of doc 1 stays, once
    want = [(1, a, "s"), (2, b, "t"), (4, c, "s"), (5, None, "s"), (5, None, "s"), (6, "", "s"), (None, a, "s")]
    assert got == sorted(want, key=str)


def test_repeats_stage_cuts_and_counts(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(1, "one " + passage + " end", "en", "s"), (2, "two\n" + passage + "\nlast", "en", "s"), (3, passage, "en", "s"), (4, "short", "en", "s")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeats(spark, table(spark, rows), "").collect()}
    assert got[1] == (rows[0][1], len(rows[0][1])) and got[4] == ("short", 5) and 3 not in got
    assert got[2][0].split() == ["two", "last"] and got[2][1] == len(got[2][0])
    assert "n_chars" not in corpus_pipeline.repeats(spark, table(spark, rows).drop("n_chars"), "").columns


def test_pipeline_against_brute_force(spark, folder, tmp_path):
    path, items = folder
    rng = random.Random(33)
    words = [f"ka{i}ro" for i in range(400)]

    def prose(n):
        return " ".join(rng.choices(words, k=n))

    passage = prose(60)
    rows = [(i, prose(rng.randint(30, 80)), "xx", "abc"[i % 3]) for i in range(60)]
    rows += [(100 + i, rows[i][1], "xx", "a") for i in range(6)]                           # copies
    rows += [(110 + i, rows[10 + i][1] + " tail", "xx", "b") for i in range(4)]            # near copies
    rows += [(120 + i, prose(20) + " " + passage + " " + prose(20), "xx", "c") for i in range(4)]
    rows += [(130 + k, prose(15) + " " + items[k] + " " + prose(15), "xx", "a") for k in range(3)]
    rows += [(140, "12 ## 3", "xx", "a"), (141, None, "xx", "a"), (142, "", None, "a")]
    table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{path}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    names = {i: c for i, _, c in brute_groups([(i, t) for i, t, _, _ in rows])}
    kept = [(i, t, s) for i, t, _, s in rows if i < 140 and names[i] == i]
    seen, sizes = set(), {}
    for i, t, s in sorted(kept):
        w = t.split()
        keep = [True] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                keep[k : k + 20] = [False] * 20
            seen.add(window)
        if any(keep) and not any(items[k] in t for k in range(3)):
            sizes[i] = sum(keep)
    assert {i: r["size"] for i, r in got.items()} == sizes
    per = {}
    for i, _, s in kept:
        if i in sizes:
            per[s] = per.get(s, 0) + sizes[i]
    # weights 1, 2, 3 for a, b, c; no source beyond three times its size
    total, limit = sum(per.values()), {s: 3 * n for s, n in per.items()}
    level = total / 6
    assert all(level * w <= limit[s] for s, w in zip("abc", (1, 2, 3)))
    source = {i: s for i, _, s in kept}
    for s, w in zip("abc", (1, 2, 3)):
        taken = sum(r["taken"] for i, r in got.items() if source[i] == s)
        assert abs(taken - level * w) <= max(sizes.values())
        assert all(r["target"] == pytest.approx(level * w) for i, r in got.items() if source[i] == s)


# --- contracts of single operators ---


def test_very_long_blanks_are_encoded():
    from pathlib import Path

    coder = chat_format.Coder(Path(chat_format.VOCABULARY).read_bytes())
    for blank in (" ", "\n", "\t ", " "):
        text = "a" + blank * (2_000_000 // len(blank)) + "b <|im_end|>"
        ids, first, last = coder.turn("user", text)
        assert chat_format.unescaped(coder.decode(ids[first:last])) == text
    plain = "two  spaces\n\n and more " * 50
    assert coder.encode(plain) == coder.coder.encode_ordinary(plain)


def test_numbers_are_no_letters(spark):
    assert language_crf.words_of("½ ² Ⅷ ٣ 7 _ ab½c Ça Ⅷx") == ["ab", "c", "ça", "x"]
    train = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "plain words here", "en", "a") for i in train] + [(100, "½ ² Ⅷ", None, "a"), (101, "١٢٣", None, "a")]
    got = {r["doc_id"]: r["lang_pred"] for r in language_crf.identified(table(spark, rows)).collect()}
    assert got[100] == got[101] == "und" and got[train[0]] == "en"


def test_every_operator_takes_an_empty_table(spark):
    from batchgauge.llm import decontaminate, html_wrappers, license_scan, quality_knn, quality_rules, source_mix

    none = table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    files = spark.createDataFrame([], "file long, path string, text string")
    assert chat_format.read_back(chat_format.formatted(turns)).count() == 0
    assert license_scan.licensed(files).count() == 0
    assert html_wrappers.main_texts(pages).count() == 0
    assert quality_knn.scored(none, labels).count() == 0
    assert language_crf.identified(none).count() == 0
    assert decontaminate.found(none, bench).count() == 0
    assert quality_rules.judged(none, labels.select("doc_id")).count() == 0
    assert source_mix.mixed(none).count() == 0
    assert importance.resampled(none, bench).count() == 0


def test_arrow_words_are_the_pattern_of_the_contract():
    import pyarrow as pa

    doc, codes, found = importance.word_codes(pa.array(["A-b_c9ß K", "\x00\x7f"]))
    assert [found[c].decode() for c in codes] == ["a", "b", "c9ß", "K"] and np.all(doc == 0)


def test_quality_ratio_against_plain_counts(spark):
    import math

    import xxhash

    from batchgauge.llm import quality_rules

    rng = random.Random(12)
    good, bad = [f"g{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(good if i % 2 else bad, k=rng.randint(15, 50))), "en", "a") for i in range(60)]
    rows += [(70, "ß 中文 " * 15 + "\n\tend", None, None), (71, None, None, None), (72, "", None, None), (73, "one", None, None), (70, rows[1][1], None, None)]
    trusted = {i for i in range(60) if i % 2 and i % 3}
    buckets, share_prior = 1 << 9, quality_rules.PRIOR

    def grams(text):
        w = [x.encode() for x in (text or "").split()]
        one = [xxhash.xxh64(x, seed=42).intdigest() for x in w]
        two = [xxhash.xxh64(b, seed=h).intdigest() for h, b in zip(one, w[1:])]
        return [(v - (1 << 64) if v >> 63 else v) % buckets for v in one + two]

    raw, of_good = [0] * buckets, [0] * buckets
    for i, t, _, _ in rows:
        for g in grams(t):
            raw[g] += 1
            of_good[g] += i in trusted
    share = sum(of_good) / sum(raw)
    want = []
    for i, t, _, _ in rows:
        terms = [
            math.log((max(of_good[g] - (i in trusted), 0) + share_prior * share) / (share * (raw[g] - 1 + share_prior))) for g in grams(t)
        ]
        want.append((i, round(sum(terms) / len(terms), 9) if terms else 0.0))
    marks = spark.createDataFrame([(i,) for i in trusted] + [(None,), (1,), (1,)], "doc_id long")
    got = quality_rules.judged(table(spark, rows).repartition(3), marks, buckets=buckets, threshold=0.1).collect()
    assert sorted((r["doc_id"], round(r["ratio"], 9)) for r in got) == [(i, pytest.approx(x, abs=2e-9)) for i, x in sorted(want)]
    assert all(r["kept"] == (not r["base_failed"] and r["ratio"] >= 0.1) for r in got)
    assert any(r["kept"] for r in got) and any(not r["kept"] and not r["base_failed"] for r in got)


def test_licences_by_name_and_denied_ones(spark):
    from batchgauge.llm import license_scan

    said = {
        "a": "// Distributed under the terms of the GPLv3", "b": "Released under the GPLv3, see COPYING", "c": "# Not licensed under the Apache License, Version 2.0.",
        "d": "# Licensed under the Apache License, Version 2.0.", "e": "this file is not distributed under the MIT License", "f": "go there mit ihm",
        "g": "Distributed under the terms of the LGPLv3.", "h": "You may not use this file except in compliance with the License",
    }
    files = spark.createDataFrame([(i, f"src/{k}.txt", t) for i, (k, t) in enumerate(said.items())], "file long, path string, text string")
    got = {r["path"][4]: r["licence"] for r in license_scan.licensed(files).collect()}
    assert [got[k] for k in "abcdefg"] == ["GPL-3.0", "GPL-3.0", None, "Apache-2.0", None, None, "LGPL-3.0"]


def test_licence_cosines_against_plain_vectors(spark):
    import math
    import re
    from collections import Counter

    from batchgauge.llm import license_scan

    templates = {"ONE": ("alpha licence of beta beta", "gamma licence"), "TWO": "delta licence of the house"}
    texts = ["alpha licence beta", "beta licence of delta house", "a licence without more", "gamma gamma licence", "licence of the house delta", "nothing said"]
    files = spark.createDataFrame([(i, f"d/{i}.txt", t) for i, t in enumerate(texts)], "file long, path string, text string")
    got = {r["file"]: (r["licence"], r["cosine"]) for r in license_scan.own_licences(files, templates, 0.1).collect()}
    units = {i: Counter(t.split()) for i, t in enumerate(texts) if re.search(license_scan.CUES, t)}
    seen = Counter(w for c in units.values() for w in c)

    def vector(counts):
        raw = {w: n * (math.log((1 + len(units)) / (1 + seen[w])) + 1) for w, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()}

    want = {}
    for i, counts in units.items():
        v = vector(counts)
        cosines = {
            name: max(sum(v.get(w, 0) * x for w, x in vector(Counter(t.split())).items()) for t in ([said] if isinstance(said, str) else said))
            for name, said in templates.items()
        }
        best = min(cosines, key=lambda k: (-round(cosines[k], 6), k))
        if round(cosines[best], 6) >= 0.1:
            want[i] = (best, pytest.approx(cosines[best], abs=2e-6))
    assert got == want and len(got) > 3


def test_columns_called_like_an_operators_own(spark):
    from batchgauge.llm import decontaminate, html_wrappers, substring_dedup

    docs = table(spark, [(1, "some words", "en", "a")]).withColumns({c: F.lit(c) for c in ("__doc", "__TIE", "__untils", "__hits", "__doc_")})
    row = substring_dedup.remove_repeats(docs).first()
    assert [row[c] for c in ("__doc", "__TIE", "__untils", "__doc_")] == ["__doc", "__TIE", "__untils", "__doc_"] and row["n_words"] == 2
    bench = spark.createDataFrame([(3, "some words")], "item_id long, text string")
    row = decontaminate.marked(docs, bench).first()
    assert row["__hits"] == "__hits" and row["hits"][0]["item_id"] == 3
    pages = spark.createDataFrame([(1, "http://a/b", "<p>x")], "page_id long, url string, html string").withColumns({"__host": F.lit(1), "__constants": F.lit("c")})
    row = html_wrappers.main_texts(pages).first()
    assert (row["__host"], row["__constants"], row["text"]) == (1, "c", "x")


# --- scratch space ---


def shuffle_files(spark):
    jvm = spark._jvm
    held = [str(p) for p in jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for top in held for f in glob.glob(f"{top}/*/shuffle_*.data")}


def test_a_scratch_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = stored(spark.range(5000).withColumn("k", F.col("id") % 7).repartition(3, "id").groupBy("k").count(), "released")
    for _ in range(100):  # they are removed in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert sorted(map(tuple, rows.collect())) == [(k, 5000 // 7 + (k < 5000 % 7)) for k in range(7)]
    dropped(rows)
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/batchgauge-released-*")


def test_groups_in_passes_keep_no_large_scratch(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choices(words, k=60))
    rows = list(enumerate(
        family(rng, words, 70, 50, 9)
        + [passage + " " + " ".join(f"own{i}-{k}" for k in range(rng.randint(3, 40))) for i in range(40)]
        + [" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(30)]
    ))
    for dense in (3, 10**6):  # by blocks, and as rows
        monkeypatch.setattr(jaccard_join, "DENSE", dense)
        monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 2000)
        monkeypatch.setattr(jaccard_join, "PASS_PAIRS", 4)
        monkeypatch.setattr(jaccard_join, "PASS_SHARE", 0.4)
        passes, sized = {}, jaccard_join._in_passes
        monkeypatch.setattr(jaccard_join, "_in_passes", lambda n, key, label, made: passes.update({label: n}) or sized(n, key, label, made))
        seen = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*"))
        got = sorted(map(tuple, jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=str)
        monkeypatch.undo()
        assert got == brute_groups(rows)
        assert passes["dense-pairs" if dense == 3 else "pairs"] > 1
        left = " ".join(set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/*")) - seen)
        assert not [n for n in ("sets", "postings", "links-texts", "last-links-texts", "rest", "whole-sets", "block-sides") if f"batchgauge-{n}-" in left]
