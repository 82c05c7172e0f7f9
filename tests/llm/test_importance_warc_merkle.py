"""Importance resampling, WARC archives and Merkle proofs against plain Python: nulls, empty and long texts, ties, clashes."""

import base64
import gzip
import hashlib
import io
import itertools
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from batchgauge.llm import importance, merkle, warc
from batchgauge.llm.ranks import positioned

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def expected_draw(rows, target, ngrams, buckets, least, percent, seed):
    def features(text):
        words = WORD.findall(lower(text))
        return len(words), [" ".join(words[i : i + k]) for k in range(1, ngrams + 1) for i in range(len(words) - k + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % buckets

    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t)[1]:
                out[bucket(f)] += 1
        return out

    s, t = counts([r[1] for r in rows]), counts(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        n_words, found = features(text)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, n_words])
    may = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(may[: percent * len(may) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["Ähre", "zwei2", "x", "ß", "the", "THE", "a1b2", "中文", "naïve"] + [f"w{i}" for i in range(60)]
    gaps = [" ", ", ", "\n", "--", "\x00", "\x7f", "`"]
    rows = [(i, "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, " ,.\n"), (None, "the null id " * 9), (None, "the null id " * 9), (7, rows[3][1]),
             (203, " ".join(rng.choices(words, k=200_000))), (3, rows[3][1])]
    return rows


@pytest.mark.parametrize("ngrams, buckets, percent", [(1, 10_000, 10), (3, 97, 50), (2, 1, 100)])
def test_importance_is_the_plain_one(spark, texts, ngrams, buckets, percent):
    target = ["the zwei2 Ähre", "x ß x ß", None, ""]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"score": F.lit(1), "rank": F.lit("x"), "_at": F.lit(2)})
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resampled(docs.repartition(5), bench, ngrams=ngrams, buckets=buckets, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_draw(texts, target, ngrams, buckets, 20, percent, 2024)


def test_importance_of_empty_tables(spark, texts):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resampled(none, none).collect() == []
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = importance.resampled(docs, none, ngrams=1)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected_draw(texts, [], 1, 10_000, 20, 10, 2024)


def test_places_in_a_hot_group(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 3000).alias("v"))
    got = positioned(rows, [F.asc_nulls_first("g"), F.asc("v")], within="g").collect()
    for g in (None, 0, 1):
        mine = sorted((r["v"], r["pos"]) for r in got if r["g"] == g)
        assert [p for _, p in mine] == list(range(1000))


# --- archives ---


def page_rows():
    big = "<p>" + "é" * 900 + "</p>"
    return [
        (1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9\r\nEvil: 1", big), (3, None, "short"), (4, "http://a/4", "short"),
        (5, "http://a/5", None), (6, "http://a/6", ""), (7, "http://a/7", "x" * 999), (8, "http://a/8", "x" * 999),
        (10, "http://b", "y" * 1000), (11, "http://b", "y" * 1000), (12, "http://b", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 40),
        (13, "http://b", "z" * 3_000_000), (None, "http://n", big), (10, "http://b2", "y" * 1000), (11, "http://b", "y" * 1000),
        (14, "http://c", "\r\n\r\n\x1f\x8b\x08 tail" * 100),
    ]


def expected_records(rows):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        same = [k for k, _, h in rows if h == html and k is not None]
        keeper = max(same) if len(data) >= 1000 and same else key
        again = keeper != key
        out.append((key, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"max_bytes": 2000}])
def test_archives_give_back_every_page(spark, tmp_path, options):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"_same": F.lit(1), "payload": F.lit("x"), "record_type": F.lit(0)})
    folder = f"file://{tmp_path}/a"
    warc.write(warc.page_records(pages.repartition(3), "page_id", "url", "html", "2024-01-01T00:00:00Z"), folder, **options)
    got = warc.read(spark, folder).filter("record_type <> 'warcinfo'").withColumns({"key": warc.page_key("record_id"), "to": warc.page_key("refers_to")}).collect()
    seen = []
    for r in got:
        body = bytes(r["payload"]) if r["payload"] is not None else None
        if r["record_type"] == "response":
            assert (len(body), hashlib.sha1(body).hexdigest()) == (r["payload_length"], r["payload_digest"])
        else:
            assert body is None
        as_key = lambda v: None if not v else int(v)
        seen.append((as_key(r["key"]), r["payload_length"], r["payload_digest"], r["record_type"], as_key(r["to"])))
        assert r["headers"]["WARC-Type"] == r["record_type"] and "Evil" not in r["headers"]
    assert sorted(seen, key=str) == expected_records(rows)
    files = list((tmp_path / "a").glob("part-*"))
    if "max_bytes" in options:
        assert len(files) > 3
    if not options:  # plain gzip readers see the same bytes
        assert sum(gzip.decompress(f.read_bytes()).count(b"WARC-Type: revisit\r\n") for f in files) == 5


def test_a_hot_group_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "HOT_COPIES", 3)
    monkeypatch.setattr(warc, "BROADCAST_LIMIT", 0)
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    made = warc.page_records(pages, "page_id", "url", "html", "2024-01-01T00:00:00Z").select(
        warc.page_key("record_id").alias("k"), "payload_length", "payload_digest", "record_type", warc.page_key("refers_to").alias("to")).collect()
    as_key = lambda v: None if not v else int(v)
    assert sorted(((as_key(r[0]), r[1], r[2], r[3], as_key(r[4])) for r in made), key=str) == expected_records(rows)


def test_predicates_reach_the_headers(spark, tmp_path):
    folder = f"file://{tmp_path}/p"
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    warc.write(warc.page_records(pages, "page_id", "url", "html", "2024-01-01T00:00:00Z"), folder)
    every = warc.read(spark, folder).drop("payload", "headers").toPandas()
    df = warc.read(spark, folder, ["record_type", "record_id", "target_uri", "payload_length", "refers_to", "payload"])
    assert df.filter("record_type = 'revisit'").count() == (every.record_type == "revisit").sum() == 5
    assert df.filter("target_uri LIKE 'http://b%' AND payload_length > 1000").count() == 2
    assert df.filter("refers_to IS NULL AND record_type IN ('response', 'x')").count() == (every.record_type == "response").sum()
    assert df.filter("NOT (target_uri = 'http://b')").count() == (every.target_uri.notna() & (every.target_uri != "http://b")).sum()
    assert df.filter("target_uri IS NULL").count() == every.target_uri.isna().sum()
    plan = df.filter("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # the source has it


def test_unwanted_payloads_are_not_inflated():
    row = {"record_type": "response", "record_id": "<a>", "payload": bytes(random.Random(1).randbytes(400_000))}
    blob = b"".join(warc.member(warc.encoded(row | {"record_id": f"<{i}>"}), 6) for i in range(3))

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.taken += len(out)
            return out

    kept = list(warc.records(Counted(blob), True, [warc.EqualTo(("record_id",), "<1>")], ["record_id", "payload"]))
    assert [(r["record_id"], r["payload"]) for r in kept] == [("<1>", row["payload"])]
    assert Counted.taken < 400_000 + 3 * 3 * warc.PIECE < len(blob)


def test_archives_of_others(spark, tmp_path):
    """Members without a length note, folded headers, base-16 digests, chunked bodies, records that are no pages."""
    def rec(kind, block, extra=""):
        return f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <{kind}>\r\n{extra}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"

    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n4;x=1\r\ndefg\r\n0\r\n\r\n"
    digest = hashlib.sha1(b"abcdefg").hexdigest()
    all_records = [
        rec("warcinfo", b"a: b\r\n"), rec("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http\r\n"),
        rec("response", chunked, f"Content-Type: application/http;\r\n msgtype=response\r\nWARC-Payload-Digest: SHA1:{digest.upper()}\r\n"),
        rec("resource", b"plain body", "Content-Type: text/plain\r\n"),
    ]
    (tmp_path / "x.warc").write_bytes(b"".join(all_records))
    (tmp_path / "y.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in all_records))
    (tmp_path / "notes.txt").write_text("no archive")
    for name in ("x.warc", "y.warc.gz"):
        got = {r["record_type"]: r for r in warc.read(spark, f"{tmp_path}/{name}").collect()}
        assert list(got) == ["warcinfo", "request", "response", "resource"]
        assert bytes(got["response"]["payload"]) == b"abcdefg" and got["response"]["payload_digest"] == digest
        assert got["response"]["content_type"] == "application/http; msgtype=response"
        assert bytes(got["resource"]["payload"]) == b"plain body" and got["resource"]["payload_length"] == 10
    assert warc.read(spark, str(tmp_path), ["record_id"]).count() == 8
    (tmp_path / "x.warc").write_bytes(b"".join(all_records)[:-20])
    with pytest.raises(Exception, match="x.warc at byte"):
        warc.read(spark, f"{tmp_path}/x.warc").collect()


def test_only_named_files_count_and_overwrite_clears(spark, tmp_path):
    pages = spark.createDataFrame(page_rows()[:4], "page_id long, url string, html string")
    folder = tmp_path / "m"
    made = warc.page_records(pages, "page_id", "url", "html", "2024-01-01T00:00:00Z")
    warc.write(made, str(folder))
    lost = next(folder.glob("part-*")).read_bytes()
    (folder / "part-lost.warc.gz").write_bytes(lost)
    assert warc.read(spark, str(folder), ["record_type"]).filter("record_type <> 'warcinfo'").count() == 4
    warc.write(made, str(folder))
    assert warc.read(spark, str(folder), ["record_type"]).filter("record_type <> 'warcinfo'").count() == 8
    warc.write(made, str(folder), mode="overwrite")
    assert warc.read(spark, str(folder), ["record_type"]).filter("record_type <> 'warcinfo'").count() == 4
    empty = tmp_path / "empty"
    warc.write(made.limit(0), str(empty))
    assert warc.read(spark, str(empty)).collect() == []


def test_digest_forms():
    digits = hashlib.sha1(b"x")
    assert warc.bare_digest("sha1:" + base64.b32encode(digits.digest()).decode()) == digits.hexdigest()
    assert warc.bare_digest("sha1:" + digits.hexdigest()) == digits.hexdigest()
    assert warc.bare_digest("md5:ABC") == "md5:ABC" and warc.bare_digest(None) is None


# --- Merkle trees ---


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_way(levels, i):
    out = []
    for level in levels[:-1]:
        out.append((level[i ^ 1] if i ^ 1 < len(level) else None, i % 2))
        i //= 2
    return out


def expected_proofs(rows):
    """From (tree, key, leaf, claimed), in any order."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2], r[3] or "")):
        trees.setdefault(r[0], []).append(r)
    built = {t: plain_tree([r[2] for r in rs]) for t, rs in trees.items()}
    top = plain_tree([b[-1][0] for b in built.values()])
    out = []
    for n, (t, rs) in enumerate(trees.items()):
        for i, (_, key, leaf, claimed) in enumerate(rs):
            way = plain_way(built[t], i) + plain_way(top, n)
            end = claimed or leaf
            for other, left in way:
                end = h(other, end) if left else h(end, other or "")
            proof = h("".join(x for x, _ in way if x))
            out.append((t, key, leaf, built[t][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("tier", [1, 2, 10])
def test_proofs_are_the_plain_ones(spark, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    rng = random.Random(tier)
    rows = []
    for tree, n in ((None, 5), ("", 1), ("a", 33), ("Z", 2), ("é", 17), ("hot", 70), ("b", 16)):
        for i in rng.sample(range(1000), n):
            leaf = h(str(tree), str(i))
            rows.append((tree, None if i < 10 else i, leaf, h("other", leaf) if i % 7 == 0 else None))
    rows += rows[:4] + [("a", 2000, h("tie 2"), None), ("a", 2000, h("tie 1"), None)]
    df = spark.createDataFrame(rows, "tree string, key long, leaf string, claimed string").withColumns({"pos": F.lit(1), "n": F.lit(2), "unit": F.lit(3)})
    got = sorted((tuple(r) for r in merkle.proofs(df.repartition(6)).collect()), key=str)
    assert got == expected_proofs(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(i, "t" * i, None, "s", None) for i in range(n)], DOCS)
    changed = {"n_chars": F.expr("n_chars + 1")}
    got = merkle.tampered_proofs(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", changed, F.lit(True)).collect()
    assert len(got) == n and all(r["verified"] for r in got)  # a null stays, so nothing was changed
    if n == 1:
        leaf = h("1:0", "1:s", "-", "-", "0:")
        assert [tuple(got[0])[1:7]] == [(0, leaf, leaf, leaf, h(), leaf)]


def test_a_changed_row_is_found(spark):
    docs = spark.createDataFrame([(i, "é" * i, "en" if i % 2 else "de", None, i) for i in range(40)], DOCS)
    got = merkle.tampered_proofs(docs, ["doc_id", "text", "n_chars"], "lang", "doc_id", {"n_chars": F.expr("n_chars + 1")}, F.col("doc_id") == 11).collect()
    assert [r["key"] for r in got if not r["verified"]] == [11]
    assert {r["leaf"] for r in got if r["key"] == 3} == {h("1:3", "6:ééé", "1:3")}


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13])
def test_missing_nodes_are_least_and_enough(n):
    levels = plain_tree([h(str(i)) for i in range(n)])
    for size in (1, 2, 3, n):
        for known in itertools.islice(itertools.combinations(range(n), min(size, n)), 60):
            missing = merkle.missing_nodes(known, n)
            nodes = {(0, i): levels[0][i] for i in known} | {c: levels[c[0]][c[1]] for c in missing}
            merkle.derived(nodes, known, n)
            assert nodes[merkle.height(n), 0] == levels[-1][0]
            below = set()  # none of the missing ones follows from known leaves or lies over one
            for up in range(len(levels)):
                below |= {(up, i >> up) for i in known}
            assert not below & set(missing) and len(set(missing)) == len(missing)
            for i in known:
                assert merkle.siblings(nodes, i, 0, merkle.height(n)) == [(s, bool(left)) for s, left in plain_way(levels, i)]


def test_word_codes_of_arrow_arrays():
    doc, codes, words = importance.word_codes(pa.array(["Ab ab", None, "", "!x!"]))
    assert [words[c].decode() for c in codes] == ["ab", "ab", "x"] and doc.tolist() == [0, 0, 3]
