"""The training-data operators against brute force on small rows: nulls, empty and long texts, ties, clashes."""

import hashlib
import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from batchgauge.llm import (
    chat_format, decontaminate, html_wrappers, jaccard_join, language_crf, license_scan, quality_knn, quality_rules,
    source_mix, substring_dedup,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(25, 90))) for _ in range(12)]
    rows = [(i, t, "en", "a") for i, t in enumerate(base)]
    for i, t in enumerate(base[:6]):
        w = t.split()
        w[rng.randrange(len(w))] = "CHANGED"
        rows.append((100 + i, " \n".join(w), "en", "b"))
        rows.append((200 + i, t, "en", None))
        rows.append((300 + i, "head " + base[i + 3] + "\ttail " + t, None, "b"))
    rows += [(400, None, None, "a"), (401, "", "en", "a"), (402, "one two", "en", "a"), (403, "x " * 300, "en", "a"),
             (404, "Only Three words", "en", "a"), (405, "only three WORDS", "en", "a"), (406, " ".join(rng.choices(words, k=9000)), "en", "a")]
    return rows


def test_substring_dedup(spark, corpus):
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(table(spark, corpus).withColumn("intervals", F.lit(1))).collect()}
    small = {r["doc_id"]: r["kept_sha256"] for r in substring_dedup.remove_repeats(table(spark, corpus), group_bytes=1, columns=["doc_id"]).collect()}
    seen = set()
    for i, text, _, _ in sorted(corpus, key=lambda r: r[0]):
        w = (text or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                keep[k : k + 20] = [False] * 20
            seen.add(window)
        left = b" ".join(x for x, y in zip(w, keep) if y)
        digest = hashlib.sha256(left).hexdigest()
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(w), keep.count(False), digest)
        assert small[i] == digest
        assert (got[i]["text"] or "").encode().split() == left.split()
        if all(keep):
            assert got[i]["text"] == text


def test_substring_dedup_of_repeated_rows_and_empty_table(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (None, text, "en", "a")]
    got = [(r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(table(spark, rows)).collect()]
    assert sorted(got, key=str) == [(1, 0), (1, 0), (None, 30)]
    assert substring_dedup.remove_repeats(table(spark, [])).count() == 0


def test_substring_dedup_of_rows_repeated_in_other_blocks(spark):
    text, long = " ".join(f"t{i}" for i in range(30)), " ".join(f"long{i}" for i in range(120_000))
    assert len(long) > 1 << 20
    one = table(spark, [(1, text, "en", "a"), (3, long, "en", "a"), (3, long, "en", "a")])
    other = table(spark, [(2, text, "en", "a"), (1, text, "en", "a"), (3, long, "en", "a")])
    docs = one.coalesce(1).union(other.coalesce(1))  # no join moves them: suspects are few and broadcast
    for size in (substring_dedup.GROUP_BYTES, 1):
        got = sorted((r["doc_id"], r["n_removed"]) for r in substring_dedup.remove_repeats(docs, group_bytes=size).collect())
        assert got == [(1, 0), (1, 0), (2, 30), (3, 0), (3, 0), (3, 0)]
    many = table(spark, [(5, text, "en", "a")] * 4_500).coalesce(1)
    assert substring_dedup.remove_repeats(many).filter("n_removed > 0").count() == 0


def removed_words(texts):
    """By brute force: the words of each text that a window which starts earlier covers."""
    seen, removed = set(), []
    for text in texts:
        w = text.split()
        gone = set()
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone.update(range(k, k + 20))
            seen.add(window)
        removed.append(len(gone))
    return removed


def test_substring_dedup_of_one_word_and_of_buckets_in_parts(spark):
    rng = random.Random(8)
    texts = ["said " * rng.randint(900, 1500) + f"end{i}" for i in range(40)]
    two = [" ".join(rng.choices(["ab", "cd"], k=200)) for _ in range(40)]
    texts += two + [f"{a} {b[:300]}" for a, b in zip(two, two[7:])]
    docs = table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(3)
    for size in (substring_dedup.GROUP_BYTES, 20_000):
        got = substring_dedup.remove_repeats(docs, group_bytes=size, columns=["doc_id"]).orderBy("doc_id").collect()
        assert [r["n_removed"] for r in got] == removed_words(texts)


def test_substring_dedup_judges_in_bounded_memory():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]

    def one_bucket(texts):
        for at in range(0, len(texts), 2000):
            some = texts[at : at + 2000]
            yield pa.record_batch({
                "bucket": pa.array([7] * len(some), pa.int64()), "doc": pa.array(range(at, at + len(some)), pa.int64()),
                "tie": pa.array([0] * len(some), pa.int64()), "word": pa.array([0] * len(some), pa.int32()),
                "until": pa.array([len(t.split()) for t in some], pa.int32()),
                "packed": pa.array([t.encode() for t in some], pa.binary()),
            })

    def one_word():
        texts = ["said " * n for n in range(4000, 4060)]
        batch = pa.record_batch({
            "doc": pa.array(range(60), pa.int64()), "tie": pa.array([0] * 60, pa.int64()),
            "text": texts, "words": pa.array([[0]] * 60, pa.list_(pa.int64())),
        })
        return substring_dedup._packed(20, 5, SimpleNamespace(value=np.zeros(0, np.uint64)))(iter([batch]))

    hot = [" ".join(rng.choices(words, k=35)) for _ in range(25_000)]
    for rows, megabytes in ((list(one_word()), 20), (list(one_bucket(hot)), 80)):
        judge = substring_dedup._bucket_marks(20, substring_dedup.GROUP_BYTES)
        tracemalloc.start()
        for _ in judge(iter(rows)):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < megabytes * 1_000_000


def test_near_duplicates(spark, corpus):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(table(spark, corpus)).collect()}
    sets = {}
    for i, text, _, _ in corpus:
        w = (text or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert got == {i: (len(sets[i]), root[i]) for i in sets}
    assert jaccard_join.near_duplicates(table(spark, [])).count() == 0


def distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, c in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (p != c)))
    return min(row)


def test_groups_are_joined_up_by_new_links(spark):
    groups = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "rep long, root long")
    links = spark.createDataFrame([(6, 2), (9, 30), (30, 31), (40, 41)], "a long, b long")
    got = {r["rep"]: r["root"] for r in jaccard_join._merged(groups, links, "t").collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 8: 8, 9: 8, 30: 8, 31: 8, 40: 40, 41: 40}
    assert jaccard_join._merged(groups, links.limit(0), "t").count() == 6


def test_edit_distance_columns():
    rng = random.Random(3)
    for _ in range(300):
        p = "".join(rng.choices("ab c", k=rng.randint(1, 12)))
        t = "".join(rng.choices("ab c", k=rng.randint(0, 30)))
        best, end = decontaminate.best_end(p, t)
        assert best == distance(p, t)
        assert best == len(p) or distance(p, t[:end]) == best


def test_decontamination(spark):
    rng = random.Random(9)
    items = ["".join(rng.choices("abcdefgh ", k=120)).strip() for _ in range(6)] + ["short one"]
    rows = []
    for i, item in enumerate(items):
        text = list(item.upper())
        for _ in range(i):
            text[rng.randrange(len(text))] = "#"
        rows.append((i, "before\n" + "".join(text) + "  after", "en", "a"))
    rows += [(50, None, None, None), (51, "", None, None), (52, "nothing here " * 500, None, None)]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "")], "item_id long, text string")
    docs = table(spark, rows).withColumn("hits", F.lit(1))
    for block in (decontaminate.BLOCK_CHARS, 200):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.found(docs, bench, block_chars=block).collect()}
        want = set()
        for i, text, _, _ in rows:
            for k, item in enumerate(items):
                p = decontaminate.plain(item)
                if distance(p, decontaminate.plain(text)) <= decontaminate.budget(len(p), 0.05, 40):
                    want.add((i, k))
        assert got == want and (0, 0) in want


def test_language(spark):
    rng = random.Random(1)
    parts = {"xx": ["ka", "ro", "mi"], "yy": ["sch", "ung", "ei"]}
    rows = []
    for i in range(120):
        lang = "xx" if i % 2 else "yy"
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(30)), lang, "a"))
    rows += [(900, None, "xx", "a"), (901, "12 ## 3", "yy", "a"), (902, "", None, "a"), (903, " ".join(["karomi"] * 30 + ["schungei"] * 10), None, "a")]
    got = {r["doc_id"]: r for r in language_crf.identified(table(spark, rows).withColumn("lang_pred", F.lit("?"))).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in rows[:120])
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert got[903]["lang_pred"] == "xx" and 0.6 < got[903]["lang_score"] < 0.9
    empty = language_crf.identified(table(spark, rows[-4:-2])).collect()
    assert {r["lang_pred"] for r in empty} == {"und"}


def test_pipeline_keeps_documents_when_no_language_was_learned(spark):
    import corpus_pipeline

    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 0)
    rows = [(200, "plain words", None, "a"), (201, "12 ## 3", None, "a"), (202, None, None, "a"), (203, "", None, "a"), (204, "1 été", None, "a")]
    for more in ([], [(held, "held out", "en", "a")]):
        got = {r["doc_id"] for r in corpus_pipeline.language(spark, table(spark, rows + more), "").collect()}
        assert got == {200, 204, *(i for i, *_ in more)}


def test_every_language_is_learned(spark, monkeypatch):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:230]
    docs = table(spark, [(i, "some words", f"l{k}", "a") for k, i in enumerate(ids)])
    monkeypatch.setattr(language_crf, "fit", lambda sample: {lang for _, lang in sample})
    assert language_crf.trained(docs) == {f"l{k}" for k in range(230)}


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(2)
    emission, trans, start = rng.normal(size=(5, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    got = language_crf.forward_backward(emission, np.array([3, 2]), trans, start)
    want = np.zeros((5, 2))
    for a, n in ((0, 3), (3, 2)):
        total = 0.0
        for path in np.ndindex(*[2] * n):
            w = np.exp(start[path[0]] + sum(emission[a + t, y] for t, y in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:])))
            total += w
            for t, y in enumerate(path):
                want[a + t, y] += w
        want[a : a + n] /= total
    assert np.allclose(got, want)


def test_quality(spark):
    rng = random.Random(4)
    vocabulary = ["the", "plain", "prose", "reads", "well", "and", "flows", "along"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=60)) if i % 3 else "### &&& " * 20, "en", "a") for i in range(150)]
    rows += [(900, None, None, None), (901, "", None, None)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["quality_score"] for r in quality_knn.scored(table(spark, rows), labels).collect()}
    assert all((got[i] > 0.5) == (i % 3 > 0) for i in range(150)) and all(0 <= x <= 1 for x in got.values())
    none = quality_knn.scored(table(spark, rows[:3]), labels.limit(0)).collect()
    assert [r["quality_score"] for r in none] == [0.5] * 3


def test_quality_rules(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices("abcdefghij", k=rng.randint(1, 60))) + "\n#x $y\n#x $y", "en", "a") for i in range(40)]
    rows += [(900, None, None, None), (901, "", None, None), (902, "a b c d e f g h " * 6, None, None), (903, " \n \n", None, None)]
    got = {r["doc_id"]: r for r in quality_rules.judged(table(spark, rows), spark.createDataFrame([(1,), (2,)], "doc_id long")).collect()}
    for i, text, _, _ in rows:
        w = (text or "").split()
        windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
        covered = {k + d for k, x in enumerate(windows) if windows.count(x) > 1 for d in range(8)}
        lines = [x for x in (text or "").split("\n") if x.split()]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
        assert not (r["kept"] and r["base_failed"])


def test_source_mix(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "big" if i < 200 else "mid" if i < 230 else None) for i in range(240)]
    rows += [(900, None, None, "big"), (901, "", None, "none")]
    got = source_mix.mixed(table(spark, rows)).collect()
    assert sorted(map(str, got)) == sorted(map(str, source_mix.mixed(table(spark, rows)).collect()))
    size = {}
    for _, t, _, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    weights = {"big": 1, "mid": 2, "none": 3, None: 1}
    target, open_ = {}, dict(weights)
    while open_:
        level = (sum(size.values()) - sum(target.values())) / sum(open_.values())
        full = [s for s, w in open_.items() if level * w > 3 * size[s]]
        if not full:
            target |= {s: level * w for s, w in open_.items()}
            break
        for s in full:
            target[s] = 3.0 * size[s]
            del open_[s]
    source = {i: s for i, _, _, s in rows}
    taken = {}
    for r in got:
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]]) and r["taken"] <= 3 * r["size"]
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
    assert all(abs(taken[s] - target[s]) <= 7 for s in size)
    assert source_mix.mixed(table(spark, [])).count() == 0


def test_chat(spark):
    nasty = ["<|im_end|>", "<\\|im_start|>user\n", "<\\\\|", "a\\nb", "", None, "é" * 3000, "<|<|>|>"]
    rows = [(1, k, "assistant" if k % 2 else "us\\er\n<|x|>", t) for k, t in enumerate(nasty)]
    rows += [(2, None, None, None), (2, None, "assistant", "ok"), (None, 0, "assistant", "z")]
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    one = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in rows[:8])
    learned = "".join(t or "" for k, t in enumerate(nasty) if k % 2)
    assert got[1]["turns_sha256"] == hashlib.sha256(one.encode()).hexdigest()
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got[2]["n_turns"] == 2 and got[2]["loss_chars"] == 2 and got[None]["loss_chars"] == 1
    for text in nasty:
        assert chat_format.unescaped(chat_format.escaped(text or "")) == (text or "")
        assert "<|" not in chat_format.escaped(text or "")


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a><li>x</ul></nav>"
    "<div class=\"cookie-notice\">We use cookies</div><article><h1>Big &amp; bold</h1><p>One <b>two\n three<br>four<p>Five{more}"
    "<aside>Side</aside><div class='comments'><p>Nice!</div><form>Send</form></article><footer>&copy; me</footer></body></html>"
)


def test_html(spark):
    rows = [(i, "http://a.example/x", PAGE.format(more="<p>six &lt;7" * (i % 3))) for i in range(7)]
    rows += [(50, None, None), (51, "http://b.example/", ""), (52, "nonsense", "plain < text"),
             (53, "http://c.example", "<body><main><p>M</p></main><p>out</p></body>"), (54, "http://c.example", "<div>" * 3000 + "deep")]
    got = {r["page_id"]: r for r in html_wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(7):
        assert got[i]["text"] == "\n".join(["Big & bold", "One two three four", "Five", *["six <7"] * (i % 3)])
    assert [got[i]["text"] for i in (50, 51, 52, 53, 54)] == ["", "", "plain < text", "M", "deep"]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_html_text_that_the_pages_of_a_host_share(spark):
    def page(title, paragraphs, box="<div class=x7>Read our letter</div>", top=""):
        return f"<body><div>Site</div><article>{top}<h1>{title}</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}{box}</article></body>"

    many = [(100 + i, f"http://two.example/{i}", page(f"More {i}", [f"m{i}"])) for i in range(8)]
    rows = many + [
        (1, "http://two.example/1", page("One", ["a", "b"])), (2, "http://two.example/2", page("One", ["c"])),
        (3, "http://two.example/3", page("Three", ["d", "e"], "")),
        (10, "http://one.example/1", page("Alone", ["a"])), (11, "http://one.example/1", page("Alone", ["a"])),
        (20, "http://same.example/1", "<article><p>x</article>"), (21, "http://same.example/2", "<article><p>x</article><p>y"),
    ]
    rows += [(200 + i, f"http://main.example/{i}", f"<body><div>Top</div><p>a{i}<p>b<div>Links</div>") for i in range(9)]
    rows += [(300, "http://main.example/x", "<body><div>Top</div>")]
    rows += [(400 + i, f"http://few.example/{i}", page(f"Few {i}", [f"f{i}"])) for i in range(7)]
    rows += [(500 + i, f"http://cook.example/{i}", f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><p>{i} eggs</p><h2>Method</h2><p>Boil {i}</p></article>") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_wrappers.main_texts(pages.repartition(3, "page_id")).collect()}
    want = {100 + i: f"More {i}\nm{i}" for i in range(8)} | {
        1: "One\na\nb", 2: "One\nc", 3: "Three\nd\ne", 10: "Alone\na\nRead our letter", 11: "Alone\na\nRead our letter", 20: "x", 21: "x", 300: "Top",
    }
    want |= {200 + i: f"a{i}\nb" for i in range(9)}
    want |= {400 + i: f"Few {i}\nf{i}\nRead our letter" for i in range(7)}  # too few pages agree
    want |= {500 + i: f"Dish {i}\nIngredients\n{i} eggs\nMethod\nBoil {i}" for i in range(20)}  # headings inside the article
    assert got == want


def test_html_of_long_pages_with_many_kinds_of_elements(spark):
    import time

    kinds = ["p", "h2", "blockquote", "pre", "dl"]
    cycle = "".join(f"<{k}>text of {k}</{k}>" for k in kinds)
    rng = random.Random(2)
    mixed = "".join(f"<{k}>w{i}</{k}>" for i, k in enumerate(rng.choices(kinds, k=15_000)))
    began = time.perf_counter()
    own = html_wrappers.structure(f"<article>{cycle * 7_000}</article>")
    assert html_wrappers.expression(own) == f"<article>({''.join(f'<{k}>#</>' for k in kinds)})+</>"
    one, other = html_wrappers.structure(f"<article>{mixed}</article>"), html_wrappers.structure(f"<article>{mixed[400:]}{cycle}</article>")
    both = html_wrappers.aligned(one, other)
    assert time.perf_counter() - began < 60
    for side in (one, other):  # every text of either side has a place
        found = html_wrappers.located(html_wrappers.read(f"<article>{mixed}</article>")[0], html_wrappers.numbered(both))
        assert len(found) == 15_000


def test_html_common_places_rise_on_both_sides():
    rng = random.Random(8)
    for n, m, letters in ((0, 5, "ab"), (30, 30, "abc"), (400, 300, "abcdefgh"), (500, 500, [str(i) for i in range(300)]), (900, 700, "ab")):
        a, b = rng.choices(letters, k=n), rng.choices(letters, k=m)
        found = html_wrappers._common(a, b)
        assert all(a[x] == b[y] for x, y in found)
        assert all(x < u and y < v for (x, y), (u, v) in zip(found, found[1:]))
        assert html_wrappers._common(a, a) == [(i, i) for i in range(n)]


def test_html_nested_deeper_than_the_wrapper():
    inner = "<nav>Menu</nav><p>a</p><p>b</p>"
    page = "<div><article>" + "<div>" * 150 + inner + "</div>" * 150 + "<p>rest</p></article></div><p>after</p>"
    assert html_wrappers.extract(page, {}) == "a\nb\nrest"
    assert html_wrappers.expression(html_wrappers.structure(page)).endswith("<p>#</></></><p>#</>")
    assert html_wrappers.extract("<ul><li>" + "<div>" * 120 + "<li>x" + "</div>" * 120 + "<li>y</ul>z", {}) == "x\ny\nz"


def test_wrapper_grows_by_optional_and_repeated_parts():
    a = html_wrappers.structure("<ul><li>x</li></ul><p>t</p>")
    b = html_wrappers.structure("<ul><li>x</li><li>y</li></ul><hr><p>t</p>")
    assert html_wrappers.expression(html_wrappers.aligned(a, b)) == "<ul><li>#</>+</><hr></>?<p>#</>"
    groups = html_wrappers.structure("<dl><dt>a<dd>b<dt>c<dd>d</dl>")
    assert html_wrappers.expression(groups) == "<dl>(<dt>#</><dd>#</>)+</>"


def test_licences(spark):
    files = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "code"), (3, "a/b/COPYING", "Licensed under CC BY-NC 4.0."),
        (4, "a/y.py", "code\nLicensed under the Apache License, Version 2.0.\ncode"), (5, "z/q.py", None), (6, None, ""), (7, "a/b/w.py", "x"),
    ]
    got = {r["file"]: (r["licence"], r["origin"]) for r in license_scan.licensed(spark.createDataFrame(files, "file long, path string, text string")).collect()}
    assert got == {
        1: ("MIT", "own"), 2: ("CC-BY-NC-4.0", "inherited"), 3: ("CC-BY-NC-4.0", "own"), 4: ("Apache-2.0", "own"),
        5: (None, "none"), 6: (None, "none"), 7: ("CC-BY-NC-4.0", "inherited"),
    }


def test_licences_by_version_variant_and_wrapped_header(spark):
    mpl = (
        "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
        " * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\nint main() { return 0; }\nint other(int x);"
    )
    wrap = lambda text: "\n".join("# " + " ".join(text.split()[i : i + 9]) for i in range(0, len(text.split()), 9))
    full = license_scan.TEMPLATES
    texts = {
        "Licensed under CC BY 4.0.": "CC-BY-4.0", "Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Licensed under CC BY-NC-ND 4.0.": None,
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0", "GNU Lesser General Public License, version 3": "LGPL-3.0",
        "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Preamble\n\nThe licenses for most software": "GPL-3.0",
        "Mozilla Public License Version 2.0": "MPL-2.0", mpl: "MPL-2.0", "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0",
        "x = 1\n" + wrap("Copyright (c) 2020 A. Body " + full["BSD-2-Clause"][0]) + "\ny = 2": "BSD-2-Clause",
        wrap("Copyright (c) 2020 A. Body " + full["BSD-3-Clause"][0]): "BSD-3-Clause",
        "MIT License\n\nCopyright (c) 2020 A. Body\n\n" + full["MIT"][0]: "MIT", wrap(full["ISC"][0]): "ISC",
        "Licensed under Creative Commons CC0 1.0 Universal.": "CC0-1.0", "Copyright 2020 A. Body. All rights reserved.": None,
    }
    files = [(i, f"d{i}/f.c", t) for i, t in enumerate(texts)]
    got = {r["file"]: r["licence"] for r in license_scan.licensed(spark.createDataFrame(files, "file long, path string, text string")).collect()}
    assert got == dict(enumerate(texts.values()))


def test_held_out_is_the_crc_of_the_key(spark):
    from batchgauge.llm.common import held_out

    got = {r[0]: r[1] for r in spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", held_out()).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}
