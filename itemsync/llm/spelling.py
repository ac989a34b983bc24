"""Spelling variants: words one edit apart, found by search schemes over bidirectional FM-indexes.

An edit is one inserted, deleted or replaced code point. Of two words one edit apart, at
least one half of either is untouched, so every word is searched twice: its left half
exactly and on to the right with at most one error, and its right half exactly and on to
the left. An index holds a vocabulary as one circular text, each word behind a delimiter,
and the suffix ranks (Burrows-Wheeler transforms) of the text and of its reverse, each in
a wavelet matrix. An interval of suffix ranks stands for all places of a string; extending
the string at one end moves the interval of that direction and, by the count of smaller
symbols in it, that of the other. The half is matched from the middle out to its
delimiter in one direction, then the search turns and spends its error in the other.
Steps are taken for all words of a batch at once.

The vocabulary is dealt to indexes by what must be equal: a word stands in those of the
left halves (and right halves) that a word one edit from it can have, two of each, and
searches only that of its own. Many halves share an index of about ``index_words`` words.
A half with more words than that is dealt to several indexes by a hash of the word, and
each of its words visits all of them; so memory is bounded however many words share a
half, and no pair is lost. A task builds one index at a time and streams its searches.

Words are counted by the tasks first (at most ``MOST_COUNTED`` distinct ones held), then
shuffled by word. Null and empty texts have no words, a text may be one very long word,
repeated rows count repeatedly, and a null doc_id counts as empty text in the damage rule.
An empty table, or one without near words, gives no rows or rows without forms. Of equally
frequent near words the smallest in code-point order is the form. Other columns take no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from itemsync.llm.common import map_rows, prepared, utf8, written

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One run in so many loses a code point.
DAMAGED = 97
#: Distinct words a task counts before it hands them on.
MOST_COUNTED = 1 << 18
INDEX_WORDS = 1 << 15
#: Words searched at once.
SEARCHED = 2048
#: Smaller than every letter.
DELIMITER = "$"

_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")


def damaged(doc_id: int | None, run: str) -> str:
    """The run, or the run without one code point where ``DAMAGED`` divides its hash."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame) -> DataFrame:
    """Distinct words of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` places -> (word, n)."""
    prepared(docs.sparkSession)

    def given(counts: Counter) -> dict:
        return {"word": list(counts), "n": list(counts.values())}

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                # bytes lower-case ASCII letters only
                runs = _RUN.findall(utf8(text).lower().decode("utf-8", "surrogatepass"))
                for run, n in Counter(runs).items():
                    word = damaged(doc_id, run)
                    if len(word) >= LEAST_LENGTH:
                        counts[word] += n
            if len(counts) >= MOST_COUNTED:
                yield given(counts)
                counts.clear()
        yield given(counts)

    found = map_rows(docs.select("doc_id", "text"), count, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Wavelet:
    """Symbols of a sequence, bit by bit: at each level the zeros go ahead, in order, then the ones."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        self.bits = max(1, int(symbols - 1).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=symbols))])[:symbols]
        self.zeros: list[np.ndarray] = []
        now, which = sequence, np.arange(symbols)
        for bit in reversed(range(self.bits)):
            low = (now >> bit) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(low)]).astype(np.int32))
            now = np.concatenate([now[low], now[~low]])
            high = (which >> bit) & 1 == 1
            which = np.concatenate([which[~high], which[high]])
        counts = np.bincount(sequence, minlength=symbols)
        self.first = np.zeros(symbols, np.int64)
        self.first[which] = np.cumsum(counts[which]) - counts[which]

    def extend(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Intervals after one more symbol, and how many smaller symbols stood in each."""
        smaller = np.zeros(len(lo), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros, strict=True):
            one = (symbol >> bit) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            smaller += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        shift = self.before[symbol] - self.first[symbol]
        return lo + shift, hi + shift, smaller

    def each(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Every symbol within each interval: which interval, the symbol, and the interval after it."""
        of, symbol = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for zeros in self.zeros:
            a, b = zeros[lo], zeros[hi]
            low, high = b > a, hi - lo > b - a
            lo, hi = (
                np.concatenate([a[low], (zeros[-1] + lo - a)[high]]),
                np.concatenate([b[low], (zeros[-1] + hi - b)[high]]),
            )
            of = np.concatenate([of[low], of[high]])
            symbol = np.concatenate([2 * symbol[low], 2 * symbol[high] + 1])
        shift = self.before[symbol] - self.first[symbol]
        return of, symbol, lo + shift, hi + shift


def suffix_ranks(codes: np.ndarray) -> np.ndarray:
    """Starts of the rotations of a circular text in order, by doubling; no two rotations may be equal."""
    n, width, rank = len(codes), 1, codes.astype(np.int64)
    while True:
        top = int(rank.max()) + 1
        key = rank * top + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        places = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if places[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = places
        width *= 2


class Index:
    """A bidirectional FM-index over distinct words."""

    def __init__(self, words: list[str], counts: list[int]) -> None:
        self.words, self.counts = words, np.array(counts, np.int64)
        text = np.frombuffer("".join(DELIMITER + w for w in words).encode("utf-32-le"), np.uint32)
        self.alphabet, codes = np.unique(text, return_inverse=True)
        symbols, self.n = len(self.alphabet), len(text)
        order = suffix_ranks(codes)
        self.left = Wavelet(codes[order - 1], symbols)  # extends to the left
        back = codes[::-1]
        self.back_order = suffix_ranks(back)
        self.right = Wavelet(back[self.back_order - 1], symbols)  # extends to the right
        self.starts = np.flatnonzero(codes == 0)

    def coded(self, words: list[str]) -> np.ndarray:
        """Words of one length as rows of symbols, -1 for code points that the index does not hold."""
        raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)
        at = np.minimum(np.searchsorted(self.alphabet, raw), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == raw, at, -1)

    def near(self, words: list[str], half: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (searched, held) one edit apart that share the first ``half`` code points; words of one length."""
        codes = self.coded(words)
        length = codes.shape[1]
        which = np.flatnonzero((codes[:, :half] >= 0).all(axis=1))
        # the half from the middle out: leftwards to its delimiter, the interval to the right in step
        lo, hi = np.zeros(len(which), np.int64), np.full(len(which), self.n)
        other = np.zeros(len(which), np.int64)
        for at in [*reversed(range(half)), -1]:
            symbol = codes[which, at] if at >= 0 else np.zeros(len(which), np.int64)
            lo, hi, smaller = self.left.extend(lo, hi, symbol)
            other = other + smaller
            live = hi > lo
            which, lo, hi, other = which[live], lo[live], hi[live], other[live]
        # turned: rightwards, without an error so far, and with one
        exact = (which, other, other + hi - lo)
        spent = tuple(np.zeros(0, np.int64) for _ in range(3))
        for at in range(half, length + 1):
            of, symbol, lo, hi = self.right.each(exact[1], exact[2])
            word = exact[0][of]
            inside = symbol > 0
            put_in = (word[inside], lo[inside], hi[inside])
            spent = tuple(np.concatenate(pair) for pair in zip(spent, put_in, strict=True))
            if at == length:
                break
            expected = codes[word, at]
            same, replaced = symbol == expected, inside & (symbol != expected)
            left_out, changed = exact, (word[replaced], lo[replaced], hi[replaced])
            exact = (word[same], lo[same], hi[same])
            going = codes[spent[0], at] >= 0
            word, lo, hi = (part[going] for part in spent)
            lo, hi, _ = self.right.extend(lo, hi, codes[word, at])
            live = hi > lo
            spent = tuple(
                np.concatenate(parts)
                for parts in zip((word[live], lo[live], hi[live]), left_out, changed, strict=True)
            )
        word, lo, hi = spent
        lo, hi, _ = self.right.extend(lo, hi, np.zeros(len(word), np.int64))
        live = hi > lo
        # a rank of the reverse text is where the closing delimiter stands, so the word begins one delimiter before
        closing = self.n - 1 - self.back_order[lo[live]]
        held = (np.searchsorted(self.starts, closing) - 1) % len(self.starts)
        pairs = np.unique(word[live] * len(self.words) + held)
        return pairs // len(self.words), pairs % len(self.words)


def _searched(index: Index, words: list[str], right: bool) -> Iterator[tuple[str, int, int, str]]:
    """Near words that a search finds: (word, how many, n of the most frequent, that word).

    For a search by the right half both sides are reversed, and what the left half finds is left out.
    """
    by_length: dict[int, list[str]] = {}
    for word in words:
        by_length.setdefault(len(word), []).append(word)
    for length, group in by_length.items():
        half = length - length // 2 if right else length // 2
        searched, held = index.near([w[::-1] for w in group] if right else group, half)
        found: dict[int, list[int]] = {}
        for s, h in zip(searched.tolist(), held.tolist(), strict=True):
            found.setdefault(s, []).append(h)
        for s, all_held in found.items():
            word = group[s]
            named = [(index.words[h][::-1] if right else index.words[h], int(index.counts[h])) for h in all_held]
            if right:
                named = [pair for pair in named if not pair[0].startswith(word[: length // 2])]
            if named:
                best, n = min(named, key=lambda pair: (-pair[1], pair[0]))
                yield word, len(named), n, best


def near_words(words: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """(word, n) -> (word, n_near, best_n, best) for every word with near words; best is the most frequent, then smallest."""
    spark = prepared(words.sparkSession)
    # a half as long as that of a word one code point shorter, equally long, or one longer
    sized = words.select("word", "n", F.length("word").alias("size"))
    left = sized.select(
        "*", F.lit(False).alias("right"), F.expr("size div 2").alias("own"),
        F.explode(F.expr("array_distinct(array((size - 1) div 2, size div 2, (size + 1) div 2))")).alias("k"),
    )
    right = sized.select(
        "*", F.lit(True).alias("right"), F.expr("size - size div 2").alias("own"),
        F.explode(F.expr("array_distinct(array(size div 2, size - size div 2, size + 1 - (size + 1) div 2))")).alias("k"),
    )
    part = F.expr("CASE WHEN `right` THEN right(word, CAST(k AS INT)) ELSE left(word, CAST(k AS INT)) END")
    entries = left.unionAll(right).select(
        "word", "n", F.struct("right", "k", part.alias("half")).alias("key"), F.expr("k = own").alias("asks")
    )
    crowded = written(
        entries.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > index_words), "crowded"
    )
    pieces = F.coalesce(F.ceil(F.col("held") / index_words), F.lit(1)).cast("int")
    dealt = entries.join(crowded, "key", "left").withColumn("pieces", pieces)
    total = words.count()
    shards = max(1, -(-4 * total // index_words))
    shard = F.pmod(F.xxhash64("key", "piece"), F.lit(shards))
    columns = ("shard", F.col("key.right").alias("right"), "asks", "word", "n")
    holding = (
        dealt.withColumn("piece", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
        .withColumn("asks", F.lit(False)).withColumn("shard", shard).select(*columns)
    )
    asking = (
        dealt.where("asks").withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)")))
        .withColumn("shard", shard).select(*columns)
    )
    tasks = min(max(2 * shards, spark.sparkContext.defaultParallelism), 4096)
    rows = holding.unionAll(asking).repartition(tasks, "shard", "right").sortWithinPartitions("shard", "right", "asks")
    kind = _parse_datatype_string("word string, n_near bigint, best_n bigint, best string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = to_arrow_schema(kind)
        key, held, index = None, {}, None
        asked: list[str] = []

        def answered() -> Iterator[pa.RecordBatch]:
            if asked and index is not None:
                found = list(_searched(index, asked, key[1]))
                columns = list(zip(*found, strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields
                )
            asked.clear()

        for batch in batches:
            for shard, right, asks, word, n in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (shard, right) != key:
                    yield from answered()
                    key, held, index = (shard, right), {}, None
                if not asks:
                    held[word[::-1] if right else word] = n
                    continue
                if index is None and held:
                    index = Index(list(held), list(held.values()))
                    held = {}
                asked.append(word)
                if len(asked) >= SEARCHED:
                    yield from answered()
        yield from answered()

    found = rows.mapInArrow(run, kind)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return (
        found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, by doubling. n rises along them, so they end."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        now = written(step, "roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")


def variants(docs: DataFrame, index_words: int = INDEX_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = written(vocabulary(docs), "words")
    near = near_words(words, index_words)
    known = written(words.join(near, "word", "left"), "near")
    has_form = F.col("best_n") >= 2 * F.col("n")
    formed = known.select(
        "word", F.when(has_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
