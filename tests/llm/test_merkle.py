"""Merkle manifest against trees built whole in memory."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from itemsync.llm import merkle


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and per leaf the siblings left and right of its ancestors."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = p // 16 * 16
            paths[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1 : run + 16])))
            at[i] = p // 16
        nodes = [H("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
    return nodes[0], paths


def leaf(row: dict, text: str | None) -> str:
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def expected(rows: list[dict]) -> list[tuple]:
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((row, leaf(row, row["text"])))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        by_source[source].sort(key=lambda r: (r[0]["doc_id"] is not None, r[0]["doc_id"] or 0, r[1]))
        trees[source] = plain_tree([d for _, d in by_source[source]])
    root, tops = plain_tree([trees[s][0] for s in sources])
    found = []
    for source, top in zip(sources, tops, strict=True):
        subroot, paths = trees[source]
        for (row, digest), path in zip(by_source[source], paths, strict=True):
            path = path + top
            tampered, text = digest, row["text"]
            if zlib.crc32(str("" if row["doc_id"] is None else row["doc_id"]).encode()) % 5 == 0 and text is not None:
                tampered = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in path:
                tampered = H(left + tampered + right)
            proof = H("".join(left + right for left, right in path))
            found.append((row["doc_id"], digest, subroot, root, proof, tampered, tampered == root))
    return found


def ordered(rows) -> list[tuple]:
    return sorted(map(tuple, rows), key=str)


def compared(df, levels: int = merkle.LEVELS) -> list[tuple]:
    found = merkle.verified(df, levels)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [r.asDict() for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    result = ordered(found.collect())
    assert result == ordered(expected(rows))
    return result


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string").repartition(3)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096, 4097])
def test_open_tree_at_every_edge(n):
    """A block's root and witnesses are those of the whole tree, up to the block's levels."""
    leaves = [H(str(i)) for i in range(n)]
    tree = merkle.OpenTree()
    for node in leaves[: merkle.ARITY**merkle.LEVELS]:
        tree.append(node)
    root = tree.close(merkle.levels_of(n, merkle.LEVELS))
    whole, paths = plain_tree(leaves)
    if n <= merkle.ARITY**merkle.LEVELS:
        assert root == whole
    for i, witness in enumerate(tree.witnesses):
        assert [(w["left"], w["right"]) for w in witness] == paths[i][: merkle.LEVELS]


def test_nasty_rows(nasty):
    compared(nasty)


def test_sources_of_all_sizes(spark):
    rng = random.Random(4)
    rows = [(i, f"s{int(rng.expovariate(0.3))}", "en", i, rng.choice(["a", "B c", None, "É"])) for i in range(900)]
    found = compared(made(spark, rows))
    assert {r[-1] for r in found} == {True, False}


def test_several_tiers(spark):
    """Blocks of one level, so that a hot source takes three tiers and the sources two."""
    rows = [(i, "hot" if i % 2 else f"s{i % 50}", "en", i, f"Text {i}") for i in range(700)]
    compared(made(spark, rows), 1)


def test_one_row_and_one_source(spark):
    (row,) = compared(made(spark, [(7, None, None, None, None)]))
    assert row[1] == row[2] == row[3] and row[4] == H("")
    compared(made(spark, [(i, "a", "en", 1, "x") for i in range(40)] + [(3, "a", "en", 1, "x")] * 30))


def test_empty_table(empty):
    assert merkle.verified(empty).count() == 0


def test_a_changed_witness_is_refused(spark):
    rows = made(spark, [(i, "a", "en", 1, f"text {i}") for i in range(300)])
    leaves = rows.select(
        F.col("source").alias("group"), F.col("doc_id").alias("key"), F.sha2("text", 256).alias("leaf"), F.lit(1).alias("row")
    )
    found = merkle.manifest(leaves)
    turned = F.transform("witness", lambda w: F.struct(w.right.alias("left"), w.left.alias("right")))
    assert found.where(merkle.folded(F.col("digest"), F.col("witness")) != F.col("root")).count() == 0
    assert found.where(merkle.folded(F.col("digest"), turned) == F.col("root")).count() == 0
