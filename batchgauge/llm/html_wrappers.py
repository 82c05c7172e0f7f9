"""Main text of web pages, by wrappers inferred from the pages of each host.

A page is read as a stream of tags and texts, with missing end tags put in. Its own structure
comes first: neighbouring equal elements, and neighbouring equal groups, become
repeated groups, and every text becomes a slot. The structures of a host's pages are then
aligned one after another: what only one side has becomes optional, what one side has more
often becomes repeated. The result is one union-free regular expression over tags per host,
the wrapper. Every page is then read along its host's wrapper, so that each of its texts has
a place there. A place that says the same on every page that has it is a constant of the
template (a notice, an advert, a box of links); one that says different things, on two pages or
within one, as repeated parts do, is a slot. The slots in article places are a page's text.

Constants need eight texts on pages that differ in their article, and stand before the article's first slot or
after its last: a heading or caption that a host's pages share inside the article stays. The title (`h1`) of
an article stays, and a page that would be left without any text keeps its constants. Shared
text in a repeated part, like a paragraph among paragraphs, is not told from the article.

Pages of one host mostly share a few structures, so structures are counted and made distinct
before the shuffle; a host with a third of all pages sends a few rows per task. A host's
structures are folded in parts, one structure in memory at a time, then the parts; there are about as many parts
as structures in a part.
Of the texts only the smallest and largest hash per place are shuffled, combined per batch.
Wrappers are broadcast to the pages when their counted size allows, else joined by host.

The article: the `article` elements of a page; without any, `main`; without, elements whose
class or id says content; without, the body. Menus, page headers, footers, sidebars, notices,
adverts, forms and reader comments are left out anywhere, by element, role, or class and id
words. Inline elements do not end a block, a line break is white space.

Defined results: null or empty html gives an empty text. A page without a host in its url is
wrapped with the other such pages. Elements of any depth are read; those nested deeper than
100 are no part of the wrapper's expression, and their texts are slots.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from batchgauge.llm.common import BROADCAST_BYTES, apart, stored

DEPTH = 100
#: Cells of an alignment that is searched whole, and ends that are tried for a repeated group.
TABLE = 40_000
TRIES = 32
#: Pages that must agree on a text before it counts as template.
AGREEING = 8

# Elements and class words by their meaning in public web practice.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template xmp noembed noframes svg math".split())
DROPPED = frozenset(
    "head nav aside footer form button select option dialog menu object audio video canvas map fieldset".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr "
    "notice notices alert popup modal sidebar side menu nav navbar navigation breadcrumb breadcrumbs footer comments "
    "comment comment-list disqus replies reply respond share sharing social related newsletter subscribe toolbar "
    "pagination pager masthead".split()
)
CONTENT_WORDS = frozenset("content article post entry story body-text main-text article-body post-body entry-content".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S
)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+))?", re.I)


def host_of(url: str = "url") -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _key(tag: str, attributes: str) -> str:
    """An element's name in a wrapper: its tag and those words of its role, class and id that mean something."""
    if not attributes:
        return tag
    words = set()
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            words.add("~hidden")
        elif name == "role":
            words.update(f"@{w}" for w in value.split() if w in DROPPED_ROLES or w == "main")
        else:
            for whole in value.split():
                words.update(w for w in (whole, *re.split(r"[-_]+", whole)) if w in DROPPED_WORDS or w in CONTENT_WORDS)
    return ".".join([tag, *sorted(words)])


def _implied_ends(tag: str, stack: list[str], opened: Counter) -> int:
    """How many open elements end because this one begins: an item before the next item, a paragraph before a block."""
    ends, limits = CLOSES.get(tag, (frozenset(), frozenset()))
    outermost, left = 0, sum(opened[name] for name in ends)
    for depth, name in enumerate(reversed(stack), 1):
        if not left or name in limits:
            break
        if name in ends:
            outermost, left = depth, left - 1
    return outermost or int(bool(stack) and stack[-1] == "p")


def events(page: str) -> Iterator[tuple[str, str]]:
    """("open", key), ("close", ""), ("text", characters) of the block elements, properly nested."""
    stack: list[str] = []
    opened: Counter = Counter()  # how often each tag is in the stack
    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            yield "text", page[at:]
            break
        if m.start() > at:
            yield "text", page[at : m.start()]
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "br":
                yield "text", " "
            elif opened[tag]:
                while True:
                    top = stack.pop()
                    opened[top] -= 1
                    yield "close", ""
                    if top == tag:
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, at)
            if not m[3].rstrip().endswith("/"):
                at = end.end() if end else size
            continue
        if tag == "br":
            yield "text", " "
        if tag in INLINE:
            continue
        if tag == "hr":
            yield "open", "hr"
            yield "close", ""
        if tag in VOID:
            continue
        for _ in range(_implied_ends(tag, stack, opened)):
            opened[stack.pop()] -= 1
            yield "close", ""
        stack.append(tag)
        opened[tag] += 1
        yield "open", _key(tag, m[3])
    for _ in stack:
        yield "close", ""


# A wrapper is a list of nodes [key, least, many, children]: least 0 is optional, many 1 is repeated.
# Key "#" is a text, a key in brackets a repeated group. The children of a text are numbers: none in a
# wrapper as it is stored, the numbers of its blocks in the structure of a page that is read.


def read(page: str, shaped: bool = True) -> tuple[list, list[str], list[int], set[int]]:
    """The page's own expression, its blocks, the numbers of those of the article and of those that are titles."""
    root: list = []
    stack, marks = [root], [("", False, 0)]
    blocks: list[str] = []
    regions: dict[int, list[int]] = {0: []}
    titles: set[int] = set()
    words: list[str] = []

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(words)).split())
        words.clear()
        if not text:
            return
        key, dropped, rank = marks[-1]
        if shaped and len(marks) <= DEPTH + 1:
            stack[-1].append(["#", 1, 0, [len(blocks)]])
        if not dropped:
            regions.setdefault(rank, []).append(len(blocks))
        if key.split(".")[0] == "h1":
            titles.add(len(blocks))
        blocks.append(text)

    for kind, value in events(page):
        if kind == "text":
            words.append(value)
            continue
        if words:
            flush()
        if kind == "open":
            _, dropped, rank = marks[-1]
            dropped, rank = placed(value, dropped, rank)
            marks.append((value, dropped, rank))
            if not dropped:
                regions.setdefault(rank, [])
            if shaped and len(marks) <= DEPTH + 1:
                node = [value, 1, 0, []]
                stack[-1].append(node)
                stack.append(node[3])
        else:
            if shaped and len(marks) <= DEPTH + 1:
                children = stack.pop()
                children[:] = folded(children)
            marks.pop()
    flush()
    return folded(root) if shaped else [], blocks, regions[max(regions)], titles


def structure(page: str) -> list:
    """The page's own expression, its texts left out."""
    return _bare(read(page)[0])


def _bare(nodes: list) -> list:
    return [[key, least, many, [] if key == "#" else _bare(children)] for key, least, many, children in nodes]


def folded(nodes: list) -> list:
    """Neighbouring repeats as one: first of single nodes, then of groups of any width, the narrowest first."""
    nodes = runs(nodes)
    keys = [n[0] for n in nodes]
    later: dict[str, list[int]] = {}
    for i, key in enumerate(keys):
        later.setdefault(key, []).append(i)
    out: list = []
    i, size = 0, len(nodes)
    while i < size:
        found = later[keys[i]]
        # a group that begins here ends where its first key comes again
        for j in found[bisect_right(found, i) : bisect_right(found, i) + TRIES]:
            width = j - i
            if keys[i:j] == keys[j : j + width]:
                group = aligned(nodes[i:j], nodes[j : j + width])
                end = j + width
                while keys[end : end + width] == keys[i:j]:
                    group = aligned(group, nodes[end : end + width])
                    end += width
                out.append([f"({' '.join(keys[i:j])})", 1, 1, group])
                i = end
                break
        else:
            out.append(nodes[i])
            i += 1
    return runs(out)


def _common(a: list, b: list) -> list[tuple[int, int]]:
    """Places (in a, in b) of equal keys, rising in both: a longest such list where the rest is small.

    What begins and ends alike is taken first, then keys that each side has once (as many of these as rise
    together), then the same between those. A stretch without such keys is searched whole if it has at most TABLE
    cells, else its equal keys are taken as they come: time and memory stay near the length of the lists.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, low, high = todo.pop()
        while lo < hi and low < high and a[lo] == b[low]:
            out.append((lo, low))
            lo, low = lo + 1, low + 1
        while lo < hi and low < high and a[hi - 1] == b[high - 1]:
            hi, high = hi - 1, high - 1
            out.append((hi, high))
        if lo == hi or low == high:
            continue
        if (hi - lo) * (high - low) <= TABLE:
            out += [(lo + x, low + y) for x, y in _longest(a[lo:hi], b[low:high])]
            continue
        once_a, once_b = (Counter(x) for x in (a[lo:hi], b[low:high]))
        spot = {k: y for y, k in enumerate(b[low:high], low) if once_b[k] == 1}
        anchors = _rising([(x, spot[k]) for x, k in enumerate(a[lo:hi], lo) if once_a[k] == 1 and k in spot])
        if not anchors:
            out += _as_they_come(a, b, lo, hi, low, high)
            continue
        ends = [*anchors, (hi, high)]
        for (x, y), (u, v) in zip([(lo - 1, low - 1), *anchors], ends):
            todo.append((x + 1, u, y + 1, v))
        out += anchors
    return sorted(out)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The most pairs, of those with rising first places, whose second places rise too."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int | None] = []
    for i, (_, y) in enumerate(pairs):
        at = bisect_left(tops, y)
        before.append(last[at - 1] if at else None)
        if at == len(tops):
            tops.append(y)
            last.append(i)
        else:
            tops[at], last[at] = y, i
    out, i = [], last[-1] if last else None
    while i is not None:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def _as_they_come(a: list, b: list, lo: int, hi: int, low: int, high: int) -> list[tuple[int, int]]:
    places: dict[str, list[int]] = {}
    for y in range(low, high):
        places.setdefault(b[y], []).append(y)
    out, y = [], low - 1
    for x in range(lo, hi):
        found = places.get(a[x])
        at = bisect_right(found, y) if found else 0
        # a key that comes much later would leave most of the other side alone
        if found and at < len(found) and (found[at] - y) * (hi - lo) <= 8 * (high - low) * max(1, x - lo + 1):
            y = found[at]
            out.append((x, y))
    return out


def _longest(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence."""
    n, m = len(a), len(b)
    length = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            length[i][j] = length[i + 1][j + 1] + 1 if a[i] == b[j] else max(length[i + 1][j], length[i][j + 1])
    i, j, out = 0, 0, []
    while i < n and j < m:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif length[i + 1][j] >= length[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _steps(a: list, b: list) -> Iterator[tuple[list | None, list | None]]:
    """The nodes of both lists in order, common ones together."""
    i, j = 0, 0
    for x, y in [*_common([n[0] for n in a], [n[0] for n in b]), (len(a), len(b))]:
        yield from ((n, None) for n in a[i:x])
        yield from ((None, n) for n in b[j:y])
        if x < len(a):
            yield a[x], b[y]
        i, j = x + 1, y + 1


def _inside(x: list, y: list) -> list:
    """What two nodes of one key hold, as one."""
    return x[3] + y[3] if x[0] == "#" else aligned(x[3], y[3])


def aligned(a: list, b: list) -> list:
    """One expression for both lists: common nodes by longest common subsequence, the others optional."""
    if a == b:
        return a
    out = []
    for x, y in _steps(a, b):
        if x and y:
            out.append([x[0], min(x[1], y[1]), max(x[2], y[2]), _inside(x, y)])
        else:
            one = x or y
            out.append([one[0], 0, one[2], one[3]])
    return runs(out)


def runs(nodes: list) -> list:
    """Neighbours of one key as one repeated node."""
    out: list = []
    for node in nodes:
        if out and out[-1][0] == node[0]:
            last = out[-1]
            out[-1] = [node[0], max(last[1], node[1]), 1, _inside(last, node)]
        else:
            out.append(node)
    return out


def expression(wrapper: list) -> str:
    """The wrapper as a readable regular expression."""
    parts = []
    for key, least, many, children in wrapper:
        mark = ("+" if least else "*") if many else ("" if least else "?")
        inner = expression(children)
        parts.append((f"({inner})" if key[0] == "(" else "#" if key == "#" else f"<{key}>{inner}</>") + mark)
    return "".join(parts)


def placed(key: str, dropped: bool, rank: int) -> tuple[bool, int]:
    """Whether an element is left out, and the rank of the article region it lies in."""
    tag, *words = key.split(".")
    if tag in DROPPED or "~hidden" in words or any(w[0] == "@" and w != "@main" for w in words):
        dropped = True
    elif tag == "header" and rank < 2:
        dropped = True
    elif any(w in DROPPED_WORDS for w in words) and tag not in ("body", "html", "main"):
        dropped = True
    if tag == "article":
        rank = 3
    elif tag == "main" or "@main" in words:
        rank = max(rank, 2)
    elif any(w in CONTENT_WORDS for w in words):
        rank = max(rank, 1)
    return dropped, rank


def numbered(wrapper: list) -> list:
    """The wrapper with a number in every text: its place."""
    count = 0

    def walk(nodes: list) -> list:
        nonlocal count
        out = []
        for key, least, many, children in nodes:
            if key == "#":
                out.append([key, least, many, [count]])
                count += 1
            else:
                out.append([key, least, many, walk(children)])
        return out

    return walk(wrapper)


def located(own: list, wrapper: list, found: dict[int, int] | None = None) -> dict[int, int]:
    """Read a page along a numbered wrapper: the number of a block -> its place."""
    found = {} if found is None else found
    same = len(own) == len(wrapper) and all(x[0] == y[0] for x, y in zip(own, wrapper))
    for x, y in zip(own, wrapper) if same else _steps(own, wrapper):
        if not x or not y:
            continue
        if x[0] == "#":
            found.update(dict.fromkeys(x[3], y[3][0]))
        else:
            located(x[3], y[3], found)
    return found


def extract(page: str | None, wrapper: list, constants: frozenset[int] = frozenset()) -> str:
    """The article's blocks in slots of the numbered wrapper: those whose places are not `constants`."""
    if not page:
        return ""
    own, blocks, article, titles = read(page, bool(constants))
    if constants:
        place = located(own, wrapper)
        slots = [i for i in article if i in titles or place.get(i) not in constants]
        article = slots or article
    return "\n".join(blocks[i] for i in article)


def _hash(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


STRUCTURES = "host string, structure string"


def wrappers(pages: DataFrame) -> DataFrame:
    """Rows (host, wrapper): one expression per host, as JSON."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [json.dumps(structure(h), separators=(",", ":")) for h in batch.column(1).to_pylist()]
            yield pa.record_batch({"host": batch.column(0), "structure": pa.array(made, pa.string())})

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, wrapper = None, None
        for batch in batches:
            hosts, made = [], []
            for h, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if wrapper is not None and h == host:
                    wrapper = aligned(wrapper, json.loads(s))
                    continue
                if wrapper is not None:
                    hosts.append(host), made.append(json.dumps(wrapper, separators=(",", ":")))
                host, wrapper = h, json.loads(s)
            yield pa.record_batch({"host": pa.array(hosts, pa.string()), "structure": pa.array(made, pa.string())})
        if wrapper is not None:
            yield pa.record_batch({"host": pa.array([host], pa.string()), "structure": pa.array([json.dumps(wrapper, separators=(",", ":"))], pa.string())})

    own = pages.select(host_of().alias("host"), "html").filter("html is not null").mapInArrow(read, STRUCTURES)
    distinct = stored(own.distinct(), "structures")
    # as many parts as there are structures in each, at least for a host with most of them
    salts = max(16, math.isqrt(distinct.count()))
    distinct = distinct.withColumn("salt", F.pmod(F.xxhash64("structure"), F.lit(salts)))
    parts = (
        distinct.repartition("host", "salt").sortWithinPartitions("host", "salt", "structure")
        .select(F.concat_ws("\x00", "host", F.col("salt").cast("string")).alias("host"), "structure").mapInArrow(fold, STRUCTURES)
    )
    whole = parts.select(F.substring_index("host", "\x00", 1).alias("host"), "structure")
    return (
        whole.repartition("host").sortWithinPartitions("host", "structure").mapInArrow(fold, STRUCTURES)
        .withColumnRenamed("structure", "wrapper")
    )


PLACES = "host string, place int, low long, high long, first long, last long, n long"


def _readings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pages with their wrappers: per place the range of the hashes of its texts, and of its pages' articles."""
    for batch in batches:
        ranges: dict[tuple[str, int], list[int]] = {}
        known: dict[str, list] = {}
        for host, wrapper, page in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if wrapper not in known:
                known[wrapper] = numbered(json.loads(wrapper))
            own, blocks, article, _ = read(page)
            place = located(own, known[wrapper])
            whole = _hash("\n".join(blocks[i] for i in article))
            for i in article:
                if i not in place:
                    continue
                value = _hash(blocks[i])
                r = ranges.setdefault((host, place[i]), [value, value, whole, whole, 0])
                r[:] = min(r[0], value), max(r[1], value), min(r[2], whole), max(r[3], whole), r[4] + 1
        rows = [(*k, *v) for k, v in ranges.items()]
        names = [x.split()[0] for x in PLACES.split(", ")]
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 5]
        yield pa.record_batch({n: pa.array([r[i] for r in rows], kind) for i, (n, kind) in enumerate(zip(names, kinds))})


def templates(pages: DataFrame) -> DataFrame:
    """Rows (host, wrapper, constants) of the hosts that have template text: their expression and its places of that kind."""
    made = stored(wrappers(pages), "wrappers")
    read_along = pages.select(host_of().alias("host"), "html").filter("html is not null").join(_bounded(made), "host")
    ranges = read_along.select("host", "wrapper", "html").mapInArrow(_readings, PLACES).groupBy("host", "place").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n")
    )
    # the places of a host are those of one expression: what lies between two slots is part of the article
    same = (F.col("low") == F.col("high")) & (F.col("first") < F.col("last")) & (F.col("n") >= AGREEING)
    places = F.sort_array(F.collect_list(F.struct("place", same.alias("same"))))
    slots = F.transform(F.filter("places", lambda p: ~p["same"]), lambda p: p["place"])
    outside = F.filter("places", lambda p: p["same"] & ((p["place"] < F.array_min("slots")) | (p["place"] > F.array_max("slots"))))
    constants = stored(
        ranges.groupBy("host").agg(places.alias("places")).withColumn("slots", slots)
        .withColumn("constants", F.transform(outside, lambda p: p["place"])).filter(F.size("constants") > 0).select("host", "constants"),
        "constants",
    )
    return made.join(constants, "host")


def _bounded(made: DataFrame) -> DataFrame:
    """Rows by host, for a broadcast when their counted size allows."""
    size = made.agg(F.sum(F.length("wrapper") + 64)).first()[0] or 0
    return F.broadcast(made) if size <= BROADCAST_BYTES // 4 else made


def main_texts(pages: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """`columns` (default: all but html) of every page plus text and n_chars. Columns of those names are replaced."""
    wanted = [c for c in pages.columns if c != "html"] if columns is None else columns
    pages, back = apart(pages, ("__host", "__wrapper", "__constants"))
    own = {name: other for other, name in back.items()}
    names = [own.get(c, c) for c in wanted if c not in ("text", "n_chars")]
    fields = {f.name: f for f in pages.schema.fields}
    schema = StructType([fields[n] for n in names] + [StructField("text", StringType()), StructField("n_chars", LongType())])
    made = _bounded(stored(templates(pages), "templates")).toDF("__host", "__wrapper", "__constants")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            get = lambda n: batch.column(batch.schema.get_field_index(n))  # noqa: B023, E731
            texts: list[str] = []
            for page, wrapper, constants in zip(get("html").to_pylist(), get("__wrapper").to_pylist(), get("__constants").to_pylist()):
                if wrapper not in known:
                    if len(known) > 256:
                        known.clear()
                    known[wrapper] = numbered(json.loads(wrapper)) if wrapper else []
                texts.append(extract(page, known[wrapper], frozenset(constants or ())))
            yield pa.record_batch({
                **{n: get(n) for n in names}, "text": pa.array(texts, pa.string()),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
            })

    keyed = pages.select(*dict.fromkeys([*names, "html"]), host_of().alias("__host"))
    return keyed.join(made, "__host", "left").drop("__host").mapInArrow(run, schema).withColumnsRenamed(back)
