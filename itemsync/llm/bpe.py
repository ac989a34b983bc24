"""Byte-level BPE: a minimal perfect hash for pre-tokens in the vocabulary, a heap over linked bytes for others.

A text is split by the vocabulary's pattern. Each pre-token is looked up whole in a
minimal perfect hash of the vocabulary: every token has a slot of its own, with no
slot left over, and the token that stands in a slot tells whether the pre-token is it.
A pre-token that is not starts as a linked list of its bytes, with a heap of the
adjacent pairs that are tokens. The pair of the lowest rank, the leftmost on ties, is
merged and its two new neighbours enter the heap, so a pre-token of n bytes costs
n log n, however long it is.

The vocabulary (a file of at most ``MOST_BYTES``) is read by the driver and sent to
the tasks; texts are worked on row by row, without a shuffle. Each batch looks up its
distinct pre-tokens only; results of the heap are kept for at most ``MOST_KEPT`` short
pre-tokens a task.

Null and empty texts have no ids and decode to no bytes. Repeated rows give repeated
results. Text that is no valid Unicode is read as U+FFFD where it breaks. Special
tokens are ordinary text. Other columns are ignored or returned, as ``encoded`` states.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StructType

from itemsync.llm.common import prepared

#: The largest vocabulary file that is sent to the tasks.
MOST_BYTES = 64 << 20
#: Keys of a bucket of the hash, on average.
BUCKET_KEYS = 4
#: Merged pre-tokens a task remembers, and their greatest length in bytes.
MOST_KEPT = 1 << 19
LONGEST_KEPT = 64

#: Places in a pre-token, beside the rank in one number of the heap.
_PLACE = (1 << 40) - 1
#: Code points that ``regex`` takes as letters or numbers and the Unicode tables of tiktoken do not.
NEWER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2"
    r"\uA7F1\uAB6C-\uAB6D\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7"
    r"\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1\U0001246F"
    r"\U00012475-\U0001247F\U00012550-\U00012686\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3"
    r"\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA\U00018D09-\U00018D20"
    r"\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168"
    r"\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF"
    r"\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED"
    r"\U0001E6F0-\U0001E6F4\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    r"\U000323B0-\U00033479\U0003D000-\U0003FC3F"
)

_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def _slots(hashes: np.ndarray, shifts: np.ndarray | int, n: int) -> np.ndarray:
    """Slot of each hash under a shift of its bucket."""
    mixed = (hashes ^ (np.asarray(shifts, np.uint64) * _STEP)) * _MIX
    return ((mixed >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _hashed(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class PerfectHash:
    """Distinct keys, each in a slot of its own below their number, by hash and displace.

    Buckets, the fullest first, take the least shift that puts their keys into free
    slots. Buckets of one key take a free slot outright (stored below zero).
    """

    def __init__(self, keys: list[bytes]) -> None:
        self.n = len(keys)
        hashes = _hashed(keys)
        if len(np.unique(hashes)) < self.n:
            raise ValueError("two keys have one hash")
        self.buckets = self.n // BUCKET_KEYS + 1
        self.shifts = np.zeros(self.buckets, np.int64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        starts = np.cumsum(sizes) - sizes
        self.slot_of = np.zeros(self.n, np.int64)
        taken = np.zeros(self.n, bool)
        tries = np.arange(4096, dtype=np.uint64)
        for b in np.argsort(-sizes, kind="stable"):
            size = sizes[b]
            if size < 2:
                break
            members = order[starts[b] : starts[b] + size]
            first = 0
            while True:
                found = _slots(hashes[members][:, None], tries[None, :] + np.uint64(first), self.n)
                good = ~taken[found].any(axis=0)
                for i in range(size):
                    for j in range(i):
                        good &= found[i] != found[j]
                if good.any():
                    at = int(good.argmax())
                    break
                first += len(tries)
            self.shifts[b] = first + at
            self.slot_of[members] = found[:, at]
            taken[found[:, at]] = True
        single = order[starts[sizes == 1]]
        free = np.flatnonzero(~taken)[: len(single)]
        self.shifts[bucket[single]] = -1 - free
        self.slot_of[single] = free

    def slots(self, keys: list[bytes]) -> np.ndarray:
        """A slot for every key; for keys outside the set it is that of another key."""
        hashes = _hashed(keys)
        shift = self.shifts[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(shift < 0, -1 - shift, _slots(hashes, np.maximum(shift, 0).astype(np.uint64), self.n))


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of the lowest rank is merged, the leftmost first, until none is a token."""
    n, get = len(piece), ranks.get
    ends = list(range(1, n + 1))  # the part that starts at i is piece[i:ends[i]]
    before = list(range(-1, n - 1))
    live = [get(piece[i : i + 2], -1) for i in range(n - 1)]  # rank of the pair of the part at i, -1 if none
    live.append(-1)
    pairs = [rank << 40 | i for i, rank in enumerate(live) if rank >= 0]
    heapify(pairs)
    while pairs:
        top = heappop(pairs)
        i = top & _PLACE
        if live[i] != top >> 40:
            continue  # the pair has changed since
        gone = ends[i]
        end = ends[i] = ends[gone]
        live[gone] = -1
        if end < n:
            before[end] = i
            rank = live[i] = get(piece[i : ends[end]], -1)
            if rank >= 0:
                heappush(pairs, rank << 40 | i)
        else:
            live[i] = -1
        left = before[i]
        if left >= 0:
            rank = live[left] = get(piece[left:end], -1)
            if rank >= 0:
                heappush(pairs, rank << 40 | left)
    found, i = [], 0
    while i < n:
        end = ends[i]
        found.append(ranks[piece[i:end]])
        i = end
    return found


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from lines of a base64 token and its rank; ranks run from 0 without a gap."""
    with open(path, "rb") as file:
        data = file.read(MOST_BYTES + 1)
    if len(data) > MOST_BYTES:
        raise ValueError(f"a vocabulary file holds at most {MOST_BYTES} bytes")
    ranked = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in data.splitlines() if line)}
    if sorted(ranked) != list(range(len(ranked))):
        raise ValueError("ranks must run from 0 without a gap")
    return [ranked[rank] for rank in range(len(ranked))]


class Vocabulary:
    """Tokens by rank and the pattern that splits texts; built once by the driver."""

    def __init__(self, tokens: list[bytes], pattern: str) -> None:
        self.tokens, self.pattern = tokens, pattern
        self.hash = PerfectHash(tokens)
        self.id_at = np.zeros(len(tokens), np.int64)
        self.id_at[self.hash.slot_of] = np.arange(len(tokens))

    def whole(self, pieces: list[bytes]) -> list[int]:
        """Id of each piece that is a token, else -1."""
        ids = self.id_at[self.hash.slots(pieces)].tolist()
        tokens = self.tokens
        return [i if tokens[i] == piece else -1 for i, piece in zip(ids, pieces, strict=True)]


class Encoder:
    """Encodes batches of texts in a task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        older = vocabulary.pattern
        for kind in (r"\p{L}", r"\p{N}"):
            older = older.replace(kind, f"[{kind}--[{NEWER}]]")
        self.find_newer = regex.compile(older, regex.V1).findall
        self.newer = regex.compile(f"[{NEWER}]").search
        self.ranks: dict[bytes, int] | None = None
        self.kept: dict[bytes, list[int]] = {}

    def _missed(self, piece: bytes) -> list[int]:
        found = self.kept.get(piece)
        if found is None:
            if self.ranks is None:
                self.ranks = {token: rank for rank, token in enumerate(self.vocabulary.tokens)}
            found = merged(piece, self.ranks)
            if len(piece) <= LONGEST_KEPT:
                if len(self.kept) >= MOST_KEPT:
                    self.kept.clear()
                self.kept[piece] = found
        return found

    def split(self, text: str) -> list[str]:
        return self.find(text) if text.isascii() or not self.newer(text) else self.find_newer(text)

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and where each text's ids end."""
        split = [self.split(_valid(text)) for text in texts]
        pieces = list(chain.from_iterable(split))
        at = dict(zip(dict.fromkeys(pieces), count(), strict=False))
        raw = [piece.encode() for piece in at]
        found = [
            (i,) if i >= 0 else self._missed(piece) for i, piece in zip(self.vocabulary.whole(raw), raw, strict=True)
        ]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        which = np.fromiter(map(at.__getitem__, pieces), np.int64, len(pieces))
        counts = sizes[which]
        ends = np.cumsum(counts)
        # the k-th id of a piece lies k behind the piece's first
        spots = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - counts), counts) + np.arange(int(counts.sum()))
        pieces_end = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        return flat[spots], np.concatenate([[0], ends])[pieces_end]


def _valid(text: str | None) -> str:
    if text is None:
        return ""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def vocabulary(spark: SparkSession, path: str, pattern: str):
    """The vocabulary of a rank file, shared with the tasks."""
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))


def encoded(docs: DataFrame, shared, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) as struct ``row``, and ``ids`` array<int> of the text."""
    prepared(docs.sparkSession)
    columns = [F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]
    rows = docs.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = StructType().add(rows.schema["row"]).add("ids", ArrayType(IntegerType(), False), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        fields = to_arrow_schema(kind)
        for batch in batches:
            ids, ends = encoder.batch(batch.column("text").to_pylist())
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()), type=fields.field("ids").type)
            yield pa.RecordBatch.from_arrays([batch.column("row"), lists], schema=fields)

    return rows.mapInArrow(run, kind)


def decoded(rows: DataFrame, shared) -> DataFrame:
    """``rows`` with ``ids`` -> ``row``, ``n_tokens``, ``decoded`` binary, and the ids as little-endian 32-bit integers."""
    kind = (
        StructType()
        .add(rows.schema["row"])
        .add("n_tokens", "long", False)
        .add("packed_sha256", "string", False)
        .add("decoded", "binary", False)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        fields = to_arrow_schema(kind)
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            ends = lists.offsets.to_numpy()
            cut = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([len(ids) for ids in cut], pa.int64()),
                    pa.array([hashlib.sha256(ids.tobytes()).hexdigest() for ids in cut], pa.string()),
                    pa.array([b"".join(map(tokens.__getitem__, ids.tolist())) for ids in cut], pa.binary()),
                ],
                schema=fields,
            )

    return rows.select("row", "ids").mapInArrow(run, kind)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, digest of the ids and of the bytes they decode to."""
    shared = vocabulary(docs.sparkSession, path, pattern)
    found = decoded(encoded(docs, shared, keep=["doc_id"]), shared)
    return found.select(
        "row.doc_id",
        "n_tokens",
        F.col("packed_sha256").alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
