"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

A fingerprint bit is 1 if set in over half of the 64-bit hashes of a text's word
shingles, repeats included. Fingerprints that differ in ``distance`` bits at most
agree in all but ``distance`` of their ``blocks`` parts, so they share at least one
combination of ``blocks - distance`` parts; fingerprints are joined on these
combinations and the Hamming distance of each pair is verified.

Equal fingerprints are one node, so exact copies never multiply. A combination
shared by more than ``crowd`` fingerprints is not paired off: each fingerprint is
joined to all values at half the distance from it within the bits left open.
Two fingerprints are within the distance exactly if they meet at such a value, and
all that meet at one are linked to its least, so every link's component is kept at
a cost in proportion to the fingerprints.

Null and empty texts have fingerprint zero and are linked like others. Rows are
told apart by ``doc_id`` alone; repeated ids give repeated rows with equal results
if their texts are equal, and a null id has no number to stand for a component: it
takes that of its component, null if there is none. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import lower_blank_words, map_rows, prepared, written
from itemsync.llm.components import smallest

SEED = 42
SHINGLE = 3
DISTANCE = 2
BLOCKS = 4
CROWD = 64
BITS = 64


def shingles(text: str | None, size: int) -> list[bytes]:
    """Space-joined runs of ``size`` words, repeats included; all words if they are fewer."""
    words = lower_blank_words(text)
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(run) for run in zip(*(words[i:] for i in range(size)))]


def hashes(text: str | None, size: int) -> np.ndarray:
    found = shingles(text, size)
    return np.fromiter(map(_hash, found), dtype=np.uint64, count=len(found))


def _hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, SEED)


def fingerprint(values: np.ndarray) -> int:
    """Bits set in over half of the values, as an unsigned number."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):
        part = values[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(values)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint as a signed number."""
    prepared(docs.sparkSession)

    def run(batches):
        for batch in batches:
            marks = [fingerprint(hashes(text, size)) for text in batch["text"]]
            yield {"doc_id": batch["doc_id"], "mark": [m - (1 << BITS) if m >> (BITS - 1) else m for m in marks]}

    return map_rows(docs.select("doc_id", "text"), run, "doc_id bigint, mark bigint")


def _masks(blocks: int, distance: int) -> list[int]:
    """For each combination of parts that must agree, the mask of its bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [sum(1 << bit for bit in range(a, b)) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - distance)]


def _signed(n: int) -> int:
    return n - (1 << BITS) if n >> (BITS - 1) else n


def _near(mask: int) -> Column:
    """0 and each single bit outside the mask: the values at distance 0 and 1 within the open bits."""
    return F.array(F.lit(0).cast("bigint"), *(F.lit(_signed(1 << b)).cast("bigint") for b in range(BITS) if not mask >> b & 1))


def links(marks: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """Stored distinct fingerprints ``mark`` -> (a, b), links that connect all within ``distance`` bits.

    Every pair of a combination shared by ``crowd`` fingerprints at most is compared.
    """
    if distance != 2:
        raise ValueError("crowded blocks are resolved for a distance of 2 bits")
    masks = _masks(blocks, distance)
    parts = F.array(*(F.col("mark").bitwiseAND(F.lit(_signed(m)).cast("bigint")) for m in masks))
    keyed = marks.select("mark", F.posexplode(parts).alias("part", "key"))
    # stored, so that the joins have plain scans on both sides and can split a crowded key
    sizes = written(keyed.groupBy("part", "key").count().where("count > 1"), "sizes")
    small = keyed.join(sizes.where(F.col("count") <= crowd).drop("count"), ["part", "key"])
    left, right = small.withColumnRenamed("mark", "a"), small.withColumnRenamed("mark", "b")
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    paired = left.join(right, ["part", "key"]).where((F.col("b") < F.col("a")) & (differ <= distance)).select("a", "b")

    large = keyed.join(sizes.where(F.col("count") > crowd).drop("count"), ["part", "key"])
    flips = F.element_at(F.array(*(_near(m) for m in masks)), F.col("part") + 1)
    meeting = large.select(
        "mark", "part", F.explode(F.transform(flips, lambda bit: F.col("mark").bitwiseXOR(bit))).alias("at")
    )
    met = meeting.groupBy("part", "at").agg(F.min("mark").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    star = meeting.join(written(met, "met"), ["part", "at"]).where("mark <> b").select(F.col("mark").alias("a"), "b")
    return paired.unionAll(star).distinct()


def components(
    docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    marked = written(fingerprints(docs, size), "fingerprints")
    nodes = written(marked.groupBy("mark").agg(F.min("doc_id").alias("least_id")), "marks")
    joined = smallest(links(nodes.select("mark"), distance, blocks, crowd)).withColumnRenamed("id", "mark")
    roots = nodes.join(joined, "mark", "left").select("mark", "least_id", F.coalesce("least", "mark").alias("root"))
    roots = written(roots, "roots")
    named = written(roots.groupBy("root").agg(F.min("least_id").alias("component_id")), "named")
    found = roots.join(named, "root").select("mark", "component_id")
    shown = F.lower(F.lpad(F.hex("mark"), 16, "0"))
    return marked.join(found, "mark").select("doc_id", shown.alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, text_key, kept: whether a row is the one that stays of its component of fingerprints.

    ``text_key`` is xxhash64 of the text. The smallest doc_id of a component stays, a null
    one only if there is no other; rows that repeat it whole are all marked kept. Null, empty
    and blank texts have fingerprint zero, so one of them stays.
    """
    prepared(docs.sparkSession)

    def run(batches):
        for batch in batches:
            marks = [_signed(fingerprint(hashes(text, size))) for text in batch["text"]]
            yield {"doc_id": batch["doc_id"], "text_key": batch["text_key"], "mark": marks}

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    marked = written(map_rows(rows, run, "doc_id bigint, text_key bigint, mark bigint"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    nodes = written(marked.groupBy("mark").agg(first), "marks")
    joined = smallest(links(nodes.select("mark"), distance)).withColumnRenamed("id", "mark")
    roots = nodes.join(joined, "mark", "left").select("mark", "first", F.coalesce("least", "mark").alias("root"))
    roots = written(roots, "roots")
    least = written(roots.groupBy("root").agg(F.min("first").alias("stays")), "least")
    # stored, so that the join can split a fingerprint that very many rows have
    named = written(roots.join(least, "root").select("mark", "stays"), "named")
    stays = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("text_key") == F.col("stays.text_key"))
    return marked.join(named, "mark").select("doc_id", "text_key", stays.alias("kept"))


def _same_row(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def deduplicated(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component of fingerprints that link at ``distance`` bits or fewer."""
    found = written(near_duplicates(docs, size, distance), "near")
    keys = found.groupBy("doc_id", "text_key").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    # rows that go, and rows that stay but are there several times
    keys = written(keys.where("not kept or n > 1").select("doc_id", "text_key", "kept"), "keys")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_key"))
    met = rows.join(keys, _same_row(rows, keys), "left").select("row", rows["doc_id"], rows["text_key"], "kept")
    once = met.where("kept is null").select("row.*")
    several = met.where("kept").dropDuplicates(["doc_id", "text_key"]).select("row.*")
    return once.unionAll(several)
