"""A Merkle manifest of a dataset, with a proof for every row by octopus multiproofs.

Each row is a leaf; the leaves of a tree (a language, say) ascend by their key, every two neighbours become
the hash of both, a last one without a neighbour the hash of itself, until one node, the subroot,
remains. The subroots, ordered by tree, are the leaves of the top tree, whose last node is the root.
H is the lowercase hex SHA-256 of its inputs put together, digests as hex text.

Leaves get their places by ranges of (tree, key) (`ranks.positioned`) and are packed in leaf partitions: runs of
2^TIER places of one tree, so that a tree with a third of all rows is spread over many. Nodes are built
TIER levels at a time, each step from the tops of the last: n leaves need log(n) / TIER shuffles,
and only nodes above the leaf partitions are stored, two per 2^TIER leaves. A leaf partition
works out which node coordinates its leaves need that they don't give themselves (`missing_nodes`:
a sibling that another leaf of it gives, or that two of its leaves share, counts once or not at all),
fetches these by one join, derives the nodes above its leaves once, and then reads every
leaf's proof off them. A coordinate near a root is asked for by very many partitions: those (two in 2^TIER of
the nodes, and the top tree) are broadcast after a check of their size; any other is asked for by 2^TIER at most.

Defined results: null keys come first; rows of equal key are ordered by leaf, and equal rows have
neighbouring places and proofs of their own. The null tree comes first, then trees by UTF-8 bytes. A null field is `-`; an
empty one has length 0. One row: leaf, subroot and root are the same and its proof is H of nothing. An empty table
gives no rows. Columns that are not named as fields are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from batchgauge.llm.common import small, stored, text_batches
from batchgauge.llm.ranks import positioned

TIER = 10
#: The number of the top tree; the others count from 0.
TOP = -1
#: Packed leaf partitions handed to Python at a time: about 100 kB each.
PACKED_ROWS = 64


def field(value: Column) -> Column:
    """`-` for null, else the length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def joined(left: str, right: str = "") -> str:
    return sha256((left + right).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves."""
    return max(0, n - 1).bit_length()


def width(n: int, level: int) -> int:
    """Nodes at a level of a tree of n leaves."""
    return -(-n >> level)


def missing_nodes(known: Sequence[int], n: int, level: int = 0) -> list[tuple[int, int]]:
    """The least set of nodes (level, index) from which, and from the known nodes of one level, the root follows."""
    out, at = [], set(known)
    for up in range(level, height(n)):
        out += [(up, i ^ 1) for i in sorted(at) if i ^ 1 not in at and i ^ 1 < width(n, up)]
        at = {i >> 1 for i in at}
    return out


def derived(nodes: dict[tuple[int, int], str], known: Sequence[int], n: int, level: int = 0) -> None:
    """Add to `nodes`, which has the known nodes of a level and the missing ones, all nodes above the known ones."""
    at = set(known)
    for up in range(level, height(n)):
        at = {i >> 1 for i in at}
        for i in at:
            nodes[up + 1, i] = joined(nodes[up, 2 * i], nodes.get((up, 2 * i + 1), ""))


def siblings(nodes: dict[tuple[int, int], str], index: int, level: int, end: int) -> list[tuple[str | None, bool]]:
    """Per level below `end` the sibling of a node on the way up (None: it has none), and whether it stands to the left."""
    out = []
    for up in range(level, end):
        out.append((nodes.get((up, index ^ 1)), bool(index & 1)))
        index >>= 1
    return out


def folded(leaf: str, way: Sequence[tuple[str | None, bool]]) -> str:
    """The root that a leaf and the siblings on its way give."""
    for other, left in way:
        leaf = joined(other, leaf) if left else joined(leaf, other or "")
    return leaf


def _levels(hashes: list[str], up: int) -> list[list[str]]:
    """`up` levels above neighbouring nodes of which the first has an even index at every level but the last."""
    out = []
    for _ in range(up):
        hashes = [joined(hashes[i], hashes[i + 1] if i + 1 < len(hashes) else "") for i in range(0, len(hashes), 2)]
        out.append(hashes)
    return out


NODES = "tree_no long, level int, idx long, hash string, n long"


def _raised(tier: int):
    """From (tree_no, level, block, n, hashes): the nodes of the next `tier` levels, or as many as the tree has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                up = min(tier, height(r["n"]) - r["level"])
                for k, hashes in enumerate(_levels(r["hashes"], up), 1):
                    out += [(r["tree_no"], r["level"] + k, (r["block"] << tier >> k) + i, h, r["n"]) for i, h in enumerate(hashes)]
            yield _batch(out, ("tree_no", "level", "idx", "hash", "n"), (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64()))

    return run


def _batch(rows: list[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=list(names))


def _above(nodes: DataFrame, largest: int, label: str, level: int = 0) -> DataFrame:
    """All nodes above those of one level (NODES, level included), of trees of at most `largest` leaves."""
    spark, parts = nodes.sparkSession, [nodes]
    while level < height(largest):
        blocks = (
            nodes.filter((F.col("level") == level) & (F.col("n") > F.lit(1 << level)))
            .groupBy("tree_no", "level", F.shiftright("idx", TIER).alias("block"), "n")
            .agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("hashes"))
            .withColumn("hashes", F.col("hashes.hash"))
        )
        with text_batches(spark, PACKED_ROWS):
            nodes = stored(blocks.mapInArrow(_raised(TIER), NODES), f"{label}-nodes")
        parts.append(nodes)
        level += TIER
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tops(tier: int):
    """The top node of each leaf partition: at level `tier`, or the subroot of a tree that is one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                up = min(tier, height(r["n"]))
                hashes = [x.hex() for x in r["leaves"]]
                out.append((r["tree_no"], up, r["unit"], (_levels(hashes, up) or [hashes])[-1][0], r["n"]))
            yield _batch(out, ("tree_no", "level", "idx", "hash", "n"), (pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64()))

    return run


NEEDS = "tree_no long, unit long, of long, level int, idx long"


def _needs(n_trees: int, tier: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first = r["unit"] << tier
                own = range(first, min(first + (1 << tier), r["n"]))
                out += [(r["tree_no"], r["unit"], r["tree_no"], *c) for c in missing_nodes(own, r["n"])]
                out += [(r["tree_no"], r["unit"], TOP, *c) for c in missing_nodes([r["tree_no"]], n_trees)]
            yield _batch(out, ("tree_no", "unit", "of", "level", "idx"), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))

    return run


PROOFS = (
    "tree_no long, key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def _proven(n_trees: int, root: str, tier: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                tree, n, first = r["tree_no"], r["n"], r["unit"] << tier
                leaves = [x.hex() for x in r["leaves"]]
                own = range(first, first + len(leaves))
                nodes = {(0, p): h for p, h in zip(own, leaves)}
                top = {}
                for x in r["fetched"] or ():
                    (top if x["of"] == TOP else nodes)[x["level"], x["idx"]] = x["hash"]
                derived(nodes, own, n)
                up = height(n)
                own_up = min(tier, up)
                top[0, tree] = nodes[up, 0]
                derived(top, [tree], n_trees)
                got = top[height(n_trees), 0]
                # what lies above the partition is the same way for all of its leaves
                shared = siblings(nodes, first >> own_up, own_up, up) + siblings(top, tree, 0, height(n_trees))
                tail = "".join(h for h, _ in shared if h)
                out = []
                for place, (key, leaf, claimed) in enumerate(zip(r["keys"], leaves, r["claimed"])):
                    way = siblings(nodes, first + place, 0, own_up)
                    proof = sha256(("".join(h for h, _ in way if h) + tail).encode()).hexdigest()
                    end = got if claimed is None else folded(claimed.hex(), way + shared)
                    out.append((tree, key, leaf, nodes[up, 0], root, proof, end, end == root))
                yield _batch(out, [c.split()[0] for c in PROOFS.split(", ")], [pa.int64()] * 2 + [pa.string()] * 5 + [pa.bool_()])

    return run


def proofs(rows: DataFrame) -> DataFrame:
    """Rows (tree, key, leaf, subroot, root, proof_sha256, folded_root, verified) of a table (tree, key, leaf, claimed).

    leaf is a hex digest; claimed is the digest that is held against the proof, null where it is the leaf.
    """
    spark = rows.sparkSession
    rows = stored(rows.select("tree", F.col("key").cast("long").alias("key"), F.unhex("leaf").alias("leaf"), F.unhex("claimed").alias("claimed")), "leaves")
    order = [F.asc_nulls_first("tree"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("claimed")]
    placed = positioned(rows, order, within="tree", label="leaf-places")
    sizes = stored(rows.groupBy("tree").agg(F.count("*").alias("n")), "trees")
    trees = stored(positioned(sizes, [F.asc_nulls_first("tree")], label="tree-places").withColumnRenamed("pos", "tree_no"), "trees")
    n_trees, largest = trees.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    out_columns = ["tree", "key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    if not n_trees:
        return spark.createDataFrame([], f"tree string, {PROOFS}").select(out_columns)
    numbered = small(trees, 96)
    packed = (
        placed.groupBy("tree", F.shiftright("pos", TIER).alias("unit"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "key", "leaf", "claimed"))).alias("l"))
    )
    units = stored(
        packed.join(numbered.withColumnRenamed("tree", "_tree"), F.col("tree").eqNullSafe(F.col("_tree"))).select(
            "tree_no", "unit", "n", F.col("l.key").alias("keys"), F.col("l.leaf").alias("leaves"), F.col("l.claimed").alias("claimed")
        ), "units",
    )
    with text_batches(spark, PACKED_ROWS):
        tops = stored(units.select("tree_no", "unit", "n", "leaves").mapInArrow(_tops(TIER), NODES), "tops")
    nodes = _above(tops, largest, "tree", TIER)
    # the node above all others of its tree: level = height
    roots = nodes.filter((F.col("idx") == 0) & (F.expr("shiftleft(1L, level)") >= F.col("n")))
    subroots = stored(
        roots.select(F.lit(TOP).cast("long").alias("tree_no"), F.lit(0).alias("level"), F.col("tree_no").alias("idx"), "hash", F.lit(n_trees).cast("long").alias("n")),
        "subroots",
    )
    top = stored(_above(subroots, n_trees, "top"), "top-nodes")
    root = top.filter((F.col("level") == height(n_trees)) & (F.col("idx") == 0)).first()["hash"]

    needs = stored(units.select("tree_no", "unit", "n").mapInArrow(_needs(n_trees, TIER), NEEDS), "needs")
    have = nodes.unionByName(top).select(F.col("tree_no").alias("of"), "level", "idx", "hash")
    wide = (F.col("of") == TOP) | (F.col("level") >= 2 * TIER)
    found = [
        needs.filter(wide).join(small(stored(have.filter(wide), "wide"), 160), ["of", "level", "idx"]),
        needs.filter(~wide).join(have.filter(~wide), ["of", "level", "idx"]),
    ]
    fetched = stored(
        found[0].unionByName(found[1]).groupBy("tree_no", "unit")
        .agg(F.collect_list(F.struct("of", "level", "idx", "hash")).alias("fetched")), "fetched",
    )
    with text_batches(spark, PACKED_ROWS):
        proven = stored(
            units.join(small(fetched, 160 * 64), ["tree_no", "unit"], "left").mapInArrow(_proven(n_trees, root, TIER), PROOFS), "proofs"
        )
    return proven.join(numbered.select("tree_no", "tree"), "tree_no").select(out_columns)


def tampered_proofs(docs: DataFrame, fields: Sequence[str], tree: str, key: str, tampered: dict[str, Column], where: Column) -> DataFrame:
    """Proofs for the rows of `docs`; where `where` is true, the proof is held against the row with the columns `tampered` put in."""
    claimed = leaf_hash([tampered.get(f, F.col(f)) for f in fields])
    return proofs(docs.select(
        F.col(tree).cast("string").alias("tree"), F.col(key).alias("key"), leaf_hash([F.col(f) for f in fields]).alias("leaf"),
        F.when(where, claimed).alias("claimed"),
    ))
