"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, each text scanned once.

Words are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII.
A window is ``window`` consecutive words of an item, or the whole of a shorter
item that has a word. A text's normalised form puts one space around each word,
so that a window occurs exactly where its words stand consecutively.

Nulls and empty texts have no words and no hits. Items without words match
nothing. A null ``item_id`` counts as the empty string among the ids. Repeated
items count once per id, repeated documents each get their row. Other columns of
the tables are neither read nor kept.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import alnum_blanked, alnum_words, map_rows, prepared, utf8, written

WINDOW = 10
#: Bytes of item text that one automaton takes; more items are scanned for in further blocks of items.
BLOCK_BYTES = 8_000_000

HITS = "array<struct<first:bigint,last:bigint,begin:bigint,end:bigint,items:array<string>>>"


def windows_of(items: list[tuple[str, str | None]], window: int) -> dict[bytes, list[str]]:
    """Each window's normalised text with the sorted ids of the items that hold it."""
    found: dict[bytes, set[str]] = {}
    for item_id, text in items:
        words = alnum_words(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            found.setdefault(b" ".join(words[i : i + window]), set()).add(item_id)
    return {key: sorted(ids) for key, ids in found.items()}


class Scanner:
    """The automaton over all windows. Bytes are read as Latin-1, one character a byte."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.automaton = ahocorasick.Automaton()
        for key, ids in windows_of(items, window).items():
            self.automaton.add_word(f" {key.decode('latin-1')} ", (key.count(b" ") + 1, len(key) + 2, ids))
        if len(self.automaton):
            self.automaton.make_automaton()

    def find(self, text: str | None) -> tuple[int, list[tuple[int, int, tuple[str, ...]]]]:
        """Number of words, and (first word, number of words, item ids) of each occurrence."""
        words = alnum_words(text)
        if not words or not len(self.automaton):
            return len(words), []
        joined = f" {b' '.join(words).decode('latin-1')} "
        matches = list(self.automaton.iter(joined))
        if not matches:
            return len(words), []
        starts, at = [], 0
        for word in words:
            starts.append(at)
            at += len(word) + 1
        return len(words), [(bisect.bisect_left(starts, end + 1 - size), n, ids) for end, (n, size, ids) in matches]


def merged(hits: list[tuple[int, int, list[str]]]) -> list[tuple[int, int, list[str]]]:
    """Maximal runs of hit words as (first, last, item ids)."""
    out: list[tuple[int, int, set[str]]] = []
    for first, n, ids in sorted(hits, key=lambda h: h[0]):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], first + n - 1), out[-1][2] | set(ids))
        else:
            out.append((first, first + n - 1, set(ids)))
    return [(first, last, sorted(ids)) for first, last, ids in out]


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of runs of words given as (first, last)."""
    blanked = alnum_blanked(utf8(text))
    wanted = sorted({w for span in spans for w in span})
    edges, word, at, end = {}, -1, 0, 0
    for w in wanted:
        while word < w:
            while blanked[end : end + 1] == b" ":
                end += 1
            at, word = end, word + 1
            end = blanked.find(b" ", at)
            end = len(blanked) if end < 0 else end
        edges[w] = (at, end)
    data = utf8(text)
    chars = lambda n: len(data[:n].decode("utf-8", "surrogatepass"))
    return [(chars(edges[a][0]), chars(edges[b][1])) for a, b in spans]


@lru_cache(maxsize=2)
def _scanner(items: tuple, window: int) -> Scanner:
    return Scanner(list(items), window)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The items in blocks of about ``block_bytes``: the driver and a task hold one block at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").where(
        F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield sorted({(r.item_id, r.text) for r in part.toLocalIterator()})


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words and ``hits``, the runs of hit words with their place in the original text.

    ``first`` and ``last`` count words from 0, ``begin`` and ``end`` are character
    offsets. Further blocks of items add their hits to the rows of the scan before.
    """
    spark = prepared(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("n_words", "hits")]
    texts = docs.select(*kept).withColumns({"n_words": F.lit(0).cast("bigint"), "hits": F.array().cast(HITS)})
    for n, block in enumerate(_blocks(benchmark, block_bytes)):
        shared = spark.sparkContext.broadcast(tuple(block))

        def find(batches, shared=shared):
            scanner = _scanner(shared.value, window)
            for batch in batches:
                n_words, hits = [], []
                for text, before in zip(batch["text"], batch["hits"]):
                    count, found = scanner.find(text)
                    if found:
                        runs = merged(found + [(h["first"], h["last"] - h["first"] + 1, h["items"]) for h in before])
                        places = original_offsets(text, [(a, b) for a, b, _ in runs])
                        before = [
                            {"first": a, "last": b, "begin": begin, "end": end, "items": ids}
                            for (a, b, ids), (begin, end) in zip(runs, places)
                        ]
                    n_words.append(count)
                    hits.append(before)
                yield batch | {"n_words": n_words, "hits": hits}

        texts = map_rows(written(texts, "scan") if n else texts, find, texts.schema)
    return texts


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark, window, block_bytes)
    runs = F.col("hits")
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform(runs, lambda r: r["items"]))))
    n_hit = F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"] + 1)
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
