"""Substring dedup: words in a passage that an earlier document also holds are removed.

A window is ``window`` consecutive words. Its key is the least hash of the runs of
``gram`` words inside it, so equal windows have equal keys, and one key covers a
whole run of windows.

First pass: every partition counts its documents' keys in a count-min sketch; the
sketches are summed. A key's estimate is never below the number of documents that
hold it, so a window in two documents always has an estimate of two or more.
Second pass: only runs of windows with such keys are grouped, exactly, by a 128-bit
hash of their words. Runs equal as a whole are one class; all its documents but the
least lose the run. Where a key has several classes, the windows of each class's
least document are listed and grouped one by one, as another class may hold them.

The sketch is ``depth`` rows of ``width`` one-byte counters that stop at two. The
width follows the input up to ``MOST_WIDTH``; beyond it more windows than needed
reach the second pass, with the same result. Texts meet what was found in them by
joins; a bitmap of bounded size lets most texts without finds pass by.

Rows of equal doc_id do not remove each other's words. A row with a null doc_id
keeps its text and removes nothing. Null and empty texts have no words. Repeated
rows each get their row. Other columns are kept by ``cleaned`` and ignored by
``removals``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import blank_words, map_rows, prepared, utf8, written

WINDOW = 50
GRAM = 8
DEPTH = 2
LEAST_WIDTH, MOST_WIDTH = 1 << 16, 1 << 26
#: Characters of text for each counter of a row, below the widest.
CHARS_PER_COUNTER = 32
#: Words whose hashes a task keeps at hand; beyond it starts anew.
CACHE_WORDS = 300_000
#: Keys that are counted at a time.
COUNTED = 500_000
#: Bits of the bitmap that tells which texts may have finds, as a power of two.
BITMAP_BITS = 23

_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MULTIPLIERS[3])
    return x ^ (x >> np.uint64(29))


def _grams(values: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` (a power of two) consecutive words."""
    step, level = 1, 0
    while step < gram:
        values = _mixed(values[:-step] * np.uint64(_MULTIPLIERS[level % 3]) + values[step:])
        step, level = 2 * step, level + 1
    return values


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive values."""
    step = 1
    while 2 * step <= size:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = size - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def window_keys(words: list[bytes], known: _Words, window: int, gram: int) -> np.ndarray:
    """The key of every window, in order."""
    if len(words) < window:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    return _least(_grams(values, gram), window - gram + 1)


def window_marks(words: list[bytes], known: _Words, window: int) -> np.ndarray:
    """A 64-bit hash of every window, in order; windows are only compared under equal keys."""
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    out, at, size = np.zeros(len(words) - window + 1, np.uint64), 0, 1
    for bit in range(window.bit_length()):  # the window in runs of powers of two
        if window >> bit & 1:
            out = _mixed(out * np.uint64(_MULTIPLIERS[0]) + values[at : at + len(out)] + np.uint64(bit))
            at += size
        step = values[:-size] * np.uint64(_MULTIPLIERS[bit % 3]) if len(values) > size else values[:0]
        values = _mixed(step + values[size:])
        size *= 2
    return out


def _cells(keys: np.ndarray, width: int, row: int) -> np.ndarray:
    return (_mixed(keys * np.uint64(_MULTIPLIERS[row] | 1)) & np.uint64(width - 1)).astype(np.int64)


class Sketch:
    """Count-min sketch whose counters stop at two."""

    def __init__(self, width: int, depth: int, packed: bytes | None = None):
        self.width, self.depth = width, depth
        if packed is None:
            self.counts = np.zeros((depth, width), np.uint8)
        else:
            raw = zstandard.ZstdDecompressor().decompress(packed)
            self.counts = np.frombuffer(bytearray(raw), np.uint8).reshape(depth, width)

    def add(self, keys: np.ndarray) -> None:
        """Count keys, each as often as it is given."""
        for row in range(self.depth):
            cells, n = np.unique(_cells(keys, self.width, row), return_counts=True)
            self.counts[row, cells] = np.minimum(self.counts[row, cells] + np.minimum(n, 2), 2)

    def merge(self, other: Sketch) -> Sketch:
        np.minimum(self.counts + other.counts, 2, out=self.counts)
        return self

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for row in range(self.depth):
            out &= self.counts[row, _cells(keys, self.width, row)] > 1
        return out

    def packed(self) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(self.counts.tobytes())


def width_for(chars: int) -> int:
    wanted = max(LEAST_WIDTH, chars // CHARS_PER_COUNTER)
    return min(MOST_WIDTH, 1 << (wanted - 1).bit_length())


def sketched(docs: DataFrame, window: int, gram: int, width: int, depth: int) -> bytes:
    """The merged sketch of all documents' keys, packed; merged on executors, pair by pair."""
    texts = docs.where("doc_id is not null and text is not null").select("text")

    def count(batches):
        sketch, known, held, n = Sketch(width, depth), _Words(), [], 0
        for batch in batches:
            for text in batch["text"]:
                keys = window_keys(blank_words(text), known, window, gram)
                if len(keys):
                    held.append(np.unique(keys[[a for a, _ in _runs(keys)]]))
                    n += len(held[-1])
                if n > COUNTED:
                    sketch.add(np.concatenate(held))
                    held, n = [], 0
        if held:
            sketch.add(np.concatenate(held))
        yield {"sketch": [sketch.packed()]}

    def merge(a: bytes, b: bytes) -> bytes:
        return Sketch(width, depth, a).merge(Sketch(width, depth, b)).packed()

    blocks = map_rows(texts, count, "sketch binary").rdd.map(lambda row: bytes(row[0]))
    return blocks.treeAggregate(Sketch(width, depth).packed(), merge, merge, depth=3)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """First and last window of each run of equal keys."""
    edges = np.flatnonzero(keys[1:] != keys[:-1])
    return [*zip(np.r_[0, edges + 1].tolist(), np.r_[edges, len(keys) - 1].tolist())]


def _signed(n: int) -> int:
    return n - (1 << 64) if n >> 63 else n


RUNS = "doc_id bigint, text_key bigint, key bigint, first int, n int, same binary"


def suspects(docs: DataFrame, sketch, window: int, gram: int, width: int, depth: int) -> DataFrame:
    """Runs of windows whose estimate is two or more, with the hash of their words."""

    def run(batches):
        merged, known = Sketch(width, depth, sketch.value), _Words()
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "text_key": [], "key": [], "first": [], "n": [], "same": []}
            for doc_id, text_key, text in zip(batch["doc_id"], batch["text_key"], batch["text"]):
                words = blank_words(text)
                keys = window_keys(words, known, window, gram)
                if not len(keys):
                    continue
                runs = _runs(keys)
                found = merged.repeated(keys[[a for a, _ in runs]])
                for (a, b), repeated in zip(runs, found.tolist()):
                    if repeated:
                        same = xxhash.xxh3_128_digest(b" ".join(words[a : b + window]))
                        row = (doc_id, text_key, _signed(int(keys[a])), a, b - a + 1, same)
                        for column, value in zip(out.values(), row):
                            column.append(value)
            if out["doc_id"]:
                yield out

    rows = docs.where("doc_id is not null").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return map_rows(rows, run, RUNS)


LISTED = "key bigint, mark bigint, doc_id bigint, text_key bigint, place int"


def _listed(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """The windows of the runs ``wanted`` (doc_id, text_key, runs of key, first, n), one by one."""

    def run(batches):
        known = _Words()
        for batch in batches:
            for doc_id, text_key, runs, text in zip(*(batch[c] for c in ("doc_id", "text_key", "runs", "text"))):
                marks = window_marks(blank_words(text), known, window).view(np.int64)
                places = np.concatenate([np.arange(r["first"], r["first"] + r["n"]) for r in runs])
                keys = np.repeat([r["key"] for r in runs], [r["n"] for r in runs])
                yield {
                    "key": keys,
                    "mark": marks[places],
                    "doc_id": np.full(len(places), doc_id),
                    "text_key": np.full(len(places), text_key),
                    "place": places.astype(np.int32),
                }

    return map_rows(_met(docs, ["text"], wanted, found_only=True).select("doc_id", "text_key", "runs", "text"), run, LISTED)


def _met(docs: DataFrame, columns: list, finds: DataFrame, found_only: bool = False) -> DataFrame:
    """``columns`` of every row, its doc_id and text_key, and what ``finds`` has for it (null: nothing).

    Rows that the bitmap of finds rules out are not joined.
    """
    slots = F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(1 << BITMAP_BITS))
    bits = finds.select(slots.alias("slot")).groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
    bits = written(bits.agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")), "bits")
    rows = docs.select(*columns, "doc_id", F.xxhash64("text").alias("text_key")).withColumn("slot", slots)
    rows = rows.withColumn("bucket", F.expr("bitmap_bucket_number(slot)"))
    # 4 KB for each of 1 << (BITMAP_BITS - 15) buckets at most, whatever the input
    marked = rows.join(F.broadcast(bits), "bucket", "left")
    spot = "CAST(bitmap_bit_position(slot) AS INT)"
    byte = f"CAST(conv(hex(substring(bits, {spot} DIV 8 + 1, 1)), 16, 10) AS INT)"
    may = F.coalesce(F.expr(f"shiftright({byte}, {spot} % 8) & 1") == 1, F.lit(False)) & F.col("doc_id").isNotNull()
    marked = marked.withColumn("may", may).drop("bucket", "slot", "bits")
    joined = marked.where("may").drop("may").join(finds, ["doc_id", "text_key"], "inner" if found_only else "left")
    if found_only:
        return joined
    rest = [c for c in finds.columns if c not in ("doc_id", "text_key")]
    none = {c: F.lit(None).cast(finds.schema[c].dataType) for c in rest}
    return joined.unionByName(marked.where("not may").drop("may").withColumns(none))


def _shared(runs: DataFrame) -> DataFrame:
    """Stored classes of equal runs that some other run may share a window with: key, same, least, crowded."""
    classes = runs.groupBy("key", "same").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    classes = written(classes, "classes")
    sizes = written(classes.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").drop("c"), "crowded")
    met = classes.join(sizes.withColumn("crowded", F.lit(True)), "key", "left")
    crowded = F.coalesce("crowded", F.lit(False))
    # a run that one document alone holds, under a key of its own, was overestimated
    return written(met.where(crowded | (F.col("least") < F.col("most"))).select("key", "same", "least", crowded.alias("crowded")), "shared")


def removals(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, depth: int = DEPTH, width: int | None = None
) -> DataFrame:
    """Stored doc_id, text_key, cuts: the runs of words (first, last) to remove, for documents that have any."""
    spark = prepared(docs.sparkSession)
    if not width:
        width = width_for(docs.agg(F.sum(F.length("text"))).first()[0] or 0)
    sketch = spark.sparkContext.broadcast(sketched(docs, window, gram, width, depth))
    runs = written(suspects(docs, sketch, window, gram, width, depth), "runs")
    met = written(runs.join(_shared(runs), ["key", "same"]).drop("same"), "met")
    whole = met.where("doc_id > least").select(
        "doc_id", "text_key", "first", (F.col("first") + F.col("n") + (window - 2)).alias("last")
    )
    own = met.where("crowded and doc_id = least").groupBy("doc_id", "text_key")
    wanted = written(own.agg(F.collect_list(F.struct("key", "first", "n")).alias("runs")), "wanted")
    listed = written(_listed(docs, wanted, window), "windows")
    holders = listed.groupBy("key", "mark").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("most"))
    holders = written(holders.where("holder < most").drop("most"), "holders")
    later = listed.join(holders, ["key", "mark"]).where("holder < doc_id").select(
        "doc_id", "text_key", F.col("place").alias("first"), (F.col("place") + (window - 1)).alias("last")
    )
    cuts = whole.unionAll(later).groupBy("doc_id", "text_key")
    return written(cuts.agg(F.collect_list(F.struct("first", "last")).alias("cuts")), "cuts")


def removed_words(n_words: int, cuts: list[dict] | None) -> list[bool]:
    """For each word whether a run of ``cuts`` covers it."""
    edges = [0] * (n_words + 1)
    for cut in cuts or []:
        edges[cut["first"]] += 1
        edges[cut["last"] + 1] -= 1
    out, depth = [], 0
    for edge in edges[:n_words]:
        depth += edge
        out.append(depth > 0)
    return out


_WORD = re.compile(rb"([^\x20\x09-\x0D]+)([\x20\x09-\x0D]*)")


def without(text: str | None, cuts: list[dict] | None) -> str | None:
    """The text without removed words and the white space behind each."""
    if not cuts:
        return text
    data = utf8(text)
    gone = removed_words(len(data.split()), cuts)
    head = data[: len(data) - len(data.lstrip(b"\t\n\x0b\x0c\r "))]
    kept = [m.group(0) for m, g in zip(_WORD.finditer(data), gone) if not g]
    return (head + b"".join(kept)).decode("utf-8", "surrogatepass")


def deduplicated(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 of the words that stay."""

    def run(batches):
        for batch in batches:
            n_words, n_removed, digests = [], [], []
            for text, cuts in zip(batch["text"], batch["cuts"]):
                words = blank_words(text)
                total = len(words)
                if cuts:
                    words = [w for w, gone in zip(words, removed_words(total, cuts)) if not gone]
                n_words.append(total)
                n_removed.append(total - len(words))
                digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield {"doc_id": batch["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept_sha256": digests}

    kind = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return map_rows(_met(docs, ["text"], removals(docs, **parameters)).select("doc_id", "text", "cuts"), run, kind)


def cleaned(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with later copies of passages removed from ``text``; an ``n_chars`` column follows."""
    columns = [F.struct("*").alias("row"), F.col("text").alias("_text")]
    met = _met(docs, columns, removals(docs, **parameters)).select("row", "_text", "cuts")

    def run(batches):
        for batch in batches:
            yield {"row": batch["row"], "new": [without(t, c) for t, c in zip(batch["_text"], batch["cuts"])]}

    kind = met.select("row", F.col("_text").alias("new")).schema
    touched = map_rows(met.where("cuts is not null"), run, kind).unionByName(
        met.where("cuts is null").select("row", F.col("_text").alias("new"))
    )
    changed = {"text": F.col("new"), "n_chars": F.length("new").cast("bigint")}
    return touched.select(*(changed[c].alias(c) if c in changed else F.col(f"row.{c}") for c in docs.columns))
