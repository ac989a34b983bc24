"""Merkle manifest of a dataset: a tree per group of rows, a tree over the groups, a witness per row.

Nodes are lowercase hex SHA-256. While a tree has several nodes, every ``ARITY``
consecutive ones (the last run may be shorter, even one) become the hash of their
concatenation. The witness of a node holds, level by level, the siblings to its left
and to its right.

Witnesses grow by streaming aligned append. A tree is cut into blocks of
``ARITY ** levels`` consecutive nodes, so a block's subtree does not depend
on others. A task takes the blocks' nodes in order. Each node enters the open run of
level 0 with an empty witness; when a run is complete its siblings are attached to the
witnesses of every node beneath it and its hash is appended one level up. At the end of
a block the open runs are closed, the last level first. The block roots are then further
appends, in blocks of their own, until each tree has one root, and the trees' roots are
appended to the tree over the groups in the same way. Going back down, each block
continues from the finished witness of its root. A task holds one block at a time, and
the driver learns one number a tier: the nodes of the largest tree.

Rows of a group ascend by key, null first; rows of equal keys ascend by leaf, so ties
and repeated rows give one defined tree (a repeated row is a leaf of its own). Groups
ascend bytewise, null first. Numbers are given in range partitions of (group, key, leaf),
so a group with a third of all rows is spread evenly. An empty table has no rows and no
root. Extra columns take no part; ``row`` carries the key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from itemsync.llm.common import fold, prepared, written
from itemsync.operators.numbering import with_position

ARITY = 16
#: Levels of a block's subtree; it has ``ARITY ** LEVELS`` nodes.
LEVELS = 3
#: Rows of one batch a task gives back.
OUT_ROWS = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fields of a document's leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WITNESS = "array<struct<left:string,right:string>>"


def hashed(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


class OpenTree:
    """The open right edge of a tree: one run of at most ``ARITY`` nodes a level, with the leaves beneath each node."""

    def __init__(self) -> None:
        self.runs: list[list[str]] = [[]]
        self.beneath: list[list[list[int]]] = [[]]
        self.witnesses: list[list[dict[str, str]]] = []

    def append(self, node: str) -> None:
        self.witnesses.append([])
        self._put(0, node, [len(self.witnesses) - 1])

    def _put(self, level: int, node: str, leaves: list[int]) -> None:
        if level == len(self.runs):
            self.runs.append([])
            self.beneath.append([])
        self.runs[level].append(node)
        self.beneath[level].append(leaves)
        if len(self.runs[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Close the run of a level: extend the witnesses beneath it, append its hash one level up."""
        run, beneath = self.runs[level], self.beneath[level]
        self.runs[level], self.beneath[level] = [], []
        for at, leaves in enumerate(beneath):
            step = {"left": "".join(run[:at]), "right": "".join(run[at + 1 :])}
            for leaf in leaves:
                self.witnesses[leaf].append(step)
        self._put(level + 1, hashed(run), [leaf for leaves in beneath for leaf in leaves])

    def close(self, levels: int) -> str:
        """Complete what is open below ``levels`` and give the one node there."""
        for level in range(levels):
            if level < len(self.runs) and self.runs[level]:
                self._complete(level)
        (root,) = self.runs[levels]
        return root


def levels_of(nodes: int, most: int) -> int:
    """Levels a block takes: all ``most`` in a tree of further blocks, else those up to its one root."""
    taken = 0
    while nodes > 1 and taken < most:
        nodes, taken = -(-nodes // ARITY), taken + 1
    return taken


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """Nodes (group, pos, n, digest, row), n the nodes of the group's tree, with their block and the place in it."""
    return nodes.withColumn("block", F.expr(f"pos div {ARITY**levels}")).withColumn(
        "place", (F.col("pos") % ARITY**levels).cast("int")
    )


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("group", "block").sortWithinPartitions("group", "block", "place")


def _roots(nodes: DataFrame, levels: int) -> DataFrame:
    """One node a block: (group, pos, n, digest, row), the next tier of every tree."""
    rows = _ordered(_blocks(nodes, levels).select("group", "block", "place", "n", "digest"))
    kind = StructType().add("group", "string").add("block", "long").add("n", "long").add("digest", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(kind)
        key, n, tree, done = None, 0, OpenTree(), []

        def given() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*done, strict=True)] or [[], [], [], []]
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
            )

        for batch in batches:
            for group, block, size, digest in zip(
                *(batch.column(c).to_pylist() for c in ("group", "block", "n", "digest")), strict=True
            ):
                if (group, block) != key:
                    if key is not None:
                        done.append((*key, n, tree.close(levels_of(n, levels))))
                    key, n, tree = (group, block), size, OpenTree()
                tree.append(digest)
            if len(done) >= OUT_ROWS:
                yield given()
        if key is not None:
            done.append((*key, n, tree.close(levels_of(n, levels))))
        yield given()

    found = rows.mapInArrow(run, kind)
    more = F.when(F.col("n") > ARITY**levels, F.ceil(F.col("n") / ARITY**levels)).otherwise(F.lit(1)).cast("long")
    return found.select("group", F.col("block").alias("pos"), more.alias("n"), "digest", F.col("block").alias("row"))


def _climbed(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The tiers of all trees, the leaves first, and every tree's root."""
    tiers = [nodes]
    while (tiers[-1].agg(F.max("n")).first()[0] or 0) > ARITY**levels:
        tiers.append(written(_roots(tiers[-1], levels), "tier"))
    return tiers, written(_roots(tiers[-1], levels), "roots")


def _proven(nodes: DataFrame, above: DataFrame, levels: int) -> DataFrame:
    """Every node of a tier with its whole witness.

    ``above`` has a row a block: (group, block, subroot, root, witness), the roots the block hangs
    under and the witness of the block's own root. It goes ahead of the block's nodes.
    """
    carried = nodes.schema["row"].dataType
    own = _blocks(nodes, levels).select(
        *("group", "block", "place", "n", "digest", "row"),
        *(F.lit(None).cast(t).alias(c) for c, t in (("subroot", "string"), ("root", "string"), ("witness", WITNESS))),
    )
    ahead = above.select(
        *("group", "block", F.lit(-1).alias("place"), F.lit(0).cast("long").alias("n")),
        *(F.lit("").alias("digest"), F.lit(None).cast(carried).alias("row"), "subroot", "root", "witness"),
    )
    kind = StructType().add("group", "string").add("pos", "long").add("digest", "string").add("row", carried)
    for name in ("subroot", "root"):
        kind = kind.add(name, "string")
    kind = kind.add("witness", above.schema["witness"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(kind)
        lead: dict | None = None
        tree, nodes, n = OpenTree(), [], 0

        def finished() -> Iterator[pa.RecordBatch]:
            if not nodes:
                return
            tree.close(levels_of(n, levels))
            first = lead["block"] * ARITY**levels
            for start in range(0, len(nodes), OUT_ROWS):
                part = nodes[start : start + OUT_ROWS]
                witnesses = [w + lead["witness"] for w in tree.witnesses[start : start + OUT_ROWS]]
                columns = [
                    [lead["group"]] * len(part),
                    [first + place for place, _, _ in part],
                    [digest for _, digest, _ in part],
                    [row for _, _, row in part],
                    [lead["subroot"]] * len(part),
                    [lead["root"]] * len(part),
                    witnesses,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
                )

        for batch in batches:
            leads = batch.column("place").to_pylist()
            sizes, digests = batch.column("n").to_pylist(), batch.column("digest").to_pylist()
            rows = batch.column("row").to_pylist()
            for i, place in enumerate(leads):
                if place < 0:
                    yield from finished()
                    lead, tree, nodes = batch.slice(i, 1).to_pylist()[0], OpenTree(), []
                else:
                    n = sizes[i]
                    nodes.append((place, digests[i], rows[i]))
                    tree.append(digests[i])
        yield from finished()

    return _ordered(own.unionByName(ahead)).mapInArrow(run, kind)


def _descended(tiers: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """The first tier's nodes with their witnesses, from those of the trees' roots."""
    for depth, tier in enumerate(reversed(tiers)):
        found = _proven(tier, above, levels)
        if depth < len(tiers) - 1:
            above = written(found.select("group", F.col("row").alias("block"), "subroot", "root", "witness"), "above")
    return found


def _numbered(rows: DataFrame, order: list[str], within: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their number in the order ``order`` within ``within``, counted in range partitions."""
    ranged = rows.repartitionByRange(*within, *order).withColumn("range", F.spark_partition_id())
    return with_position(written(ranged, "ranged"), order, within, F.col("range"), "pos").drop("range")


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Leaves (group string, key, leaf, row) -> (group, pos, digest, row, subroot, root, witness).

    ``key`` orders the leaves of a group; ``row`` (any type) is carried along.
    """
    prepared(leaves.sparkSession)
    # the number of the row in its file keeps equal rows apart
    stored = written(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    counts = stored.groupBy(F.struct("group").alias("of")).agg(F.count("*").alias("n"))
    numbered = _numbered(stored, ["key", "leaf", "tie"], ["group"])
    nodes = numbered.withColumn("of", F.struct("group")).join(written(counts, "sizes"), "of")
    tiers, roots = _climbed(
        written(nodes.select("group", "pos", "n", F.col("leaf").alias("digest"), "row"), "nodes"), levels
    )
    subroots = roots.select(F.col("group").alias("key"), "digest")
    total = subroots.count()
    tops = _numbered(subroots, ["key"], []).select(
        F.lit("").alias("group"), "pos", F.lit(total).cast("long").alias("n"), "digest", F.col("key").alias("row")
    )
    top_tiers, top = _climbed(written(tops, "tops"), levels)
    summit = top.select(
        "group", F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), F.col("digest").alias("root"),
        F.array().cast(WITNESS).alias("witness"),
    )
    groups = written(_descended(top_tiers, summit, levels), "groups")
    above = groups.select(
        F.col("row").alias("group"), F.lit(0).cast("long").alias("block"), F.col("digest").alias("subroot"), "root", "witness"
    )
    return _descended(tiers, above, levels)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness give."""
    return F.aggregate(witness, leaf, lambda node, step: F.sha2(F.concat(step.left, node, step.right).cast("binary"), 256))


def siblings(witness: Column) -> Column:
    """All siblings of a witness behind one another, from the leaf up, left to right."""
    return F.array_join(F.transform(witness, lambda step: F.concat(step.left, step.right)), "")


def leaf_of(fields: list[Column]) -> Column:
    """Hash of fields, each ``-`` if null, else its UTF-8 length, a colon and its value."""
    parts = [
        F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
        for f in fields
    ]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def verified(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents by source, and the root each gives after tampering.

    Where 5 divides the crc32 of the decimal doc_id (a null id counts as empty text, so it is
    among them) the tampered text has A-Z lower-cased; others stay as they are.
    """
    columns = {name: F.col(name) for name in FIELDS}
    lowered = leaf_of([*(columns[name] for name in FIELDS[:-1]), F.translate("text", UPPER, LOWER)])
    leaves = docs.select(
        F.col("source").cast("string").alias("group"),
        F.col("doc_id").alias("key"),
        leaf_of(list(columns.values())).alias("leaf"),
        F.struct("doc_id", F.when(fold(F.col("doc_id"), 5) == 0, lowered).alias("tampered")).alias("row"),
    )
    found = manifest(leaves, levels)
    again = folded(F.coalesce("row.tampered", "digest"), F.col("witness"))
    return found.select(
        "row.doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.sha2(siblings(F.col("witness")).cast("binary"), 256).alias("proof_sha256"),
        again.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
