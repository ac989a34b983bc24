"""LM scoring with a causal self-attention model, trained in numpy on subword ids.

Tokens of the base score are lower-cased words and one end; their counts cover all
learned-from documents. The model reads the same words as subword ids of a given
vocabulary, and one end. It has one attention layer over ``WINDOW`` ids. Its output
layer chooses among all ``N_INPUTS`` rows of ids in two steps: the most frequent are a
class each, and the others lie by frequency in ``BANDS``, of which each is a class and
has an output layer of its own. The first step's bias by the id before starts from
corpus counts and is learned on; that of a band stays the corpus counts, so attention
learns what pairs of ids don't tell. Ids beyond the rows, the rarest of the corpus,
share the last row by their counts.

Training is data-parallel: in each round every partition starts from the same
weights, takes Adam steps over all windows of its documents of the round, and the
weights are averaged by the number of windows. Every learned-from document is of one
round, so each of its ids and its end is a target once.

Each text is encoded once; its ids are stored, and the rounds and the scores read them.

Scoring cuts a text into windows that overlap by ``OVERLAP`` ids; an id is scored in
the one window in which it has the longest context before it. Windows of many texts
are scored together, with a causal mask.

Counts of the ``HEAD_WORDS`` most frequent words are sent to the tasks, as many at
most whatever the corpus; those of all others are joined.

A null text is empty and has the end alone. A null doc_id counts as empty text in
the fold. Repeated rows each get their row and count each. Other columns are
neither read nor kept.
"""

from __future__ import annotations

import base64
import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sized
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import fold, lower_blank_words, map_rows, prepared, written

FOLDS, HELD_OUT = 7, 2
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
HEAD_WORDS = 200_000
CACHE_WORDS = 300_000

WIDTH = 16
WINDOW, OVERLAP = 32, 8
N_INPUTS = 2048
#: Where the bands of rarer rows begin.
BANDS = 127, 256, 512, 1024
EDGES = [*zip(BANDS, (*BANDS[1:], N_INPUTS))]
#: Rows that are a class of their own, and the bands.
N_CLASSES = BANDS[0] + len(BANDS)
CLASS_OF = np.repeat(np.arange(N_CLASSES), [1] * BANDS[0] + [upto - at for at, upto in EDGES])
#: Pairs of the ids' own shares that are added to those seen behind an id.
LEAN = 20.0
#: Rounds over which the documents are dealt.
ROUNDS = 3
#: Windows of a training step, and windows scored at once: few, so that they stay in the processor's cache.
BATCH, SCORED = 64, 64
#: Ids of texts that are cut into windows together, and words of texts that are encoded together.
HELD_IDS, HELD_WORDS = 1 << 18, 1 << 16
RATE = 0.02


@dataclass
class Vocabulary:
    """What the model makes of subword ids: corpus counts of ids and of pairs inside words."""

    ranks: bytes  # the tokenizer's file
    inputs: np.ndarray  # id -> row of the tables; the rarest share the last
    alone: np.ndarray  # id -> log10 of its share within its row
    follows: np.ndarray  # row before, class -> log of the class's share behind it
    others: list[np.ndarray]  # of each band: row before, row of the band -> log of the row's share in the band behind it

    @property
    def end(self) -> int:
        return len(self.inputs) - 1


@lru_cache(maxsize=2)
def _encoding(ranks: bytes) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    # a space and the word behind it are one piece
    return tiktoken.Encoding("words", pat_str=" [^ ]*", mergeable_ranks=table, special_tokens={})


@lru_cache(maxsize=2)
def _begins_word(ranks: bytes) -> np.ndarray:
    """For each id whether it begins with a space."""
    encoding = _encoding(ranks)
    return np.array([encoding.decode_single_token_bytes(i)[:1] == b" " for i in range(encoding.max_token_value + 1)])


def encoded(words: list[bytes], ranks: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The ids of words, each with the space before it, and where each word begins among them."""
    text = b"".join([b" " + w for w in words]).decode("utf-8", "replace")
    ids = _encoding(ranks).encode_to_numpy(text).astype(np.int32)
    return ids, np.flatnonzero(_begins_word(ranks)[ids])


def entries(words: list[bytes], values: np.ndarray, ranks: bytes) -> dict[bytes, bytes]:
    """For each of different words its value and its ids, as the bytes of a float and of int32 numbers."""
    ids, begins = encoded(words, ranks)
    data, edges = ids.tobytes(), [*(ids.itemsize * begins).tolist(), ids.nbytes]
    values = values.astype(np.float64).tobytes()
    heads = (values[at : at + 8] for at in range(0, len(values), 8))
    return dict(zip(words, (h + data[a:b] for h, a, b in zip(heads, edges, edges[1:]))))


class Encoder:
    """Ids and values of texts' words. Entries of known words are at hand; new ones of some texts are encoded together and have no value."""

    def __init__(self, ranks: bytes, head: dict[bytes, bytes] | None = None):
        self.ranks, self.head = ranks, head or {}
        self.known = dict(self.head)

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of the words, how many each has, and each word's value, NaN if it has none."""
        distinct = [*{*words}]
        found = [*map(self.known.get, distinct)]
        missing = [nth for nth, entry in enumerate(found) if entry is None]
        if missing:
            new = entries([distinct[nth] for nth in missing], np.full(len(missing), np.nan), self.ranks)
            if len(self.known) + len(new) > len(self.head) + CACHE_WORDS:
                self.known = dict(self.head)
            self.known.update(new)
            for nth, entry in zip(missing, new.values()):
                found[nth] = entry
        data = np.frombuffer(b"".join(found), np.int32)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // data.itemsize
        heads = np.cumsum(sizes) - sizes
        values = data[heads[:, None] + np.arange(2)].view(np.float64).ravel()
        place = dict(zip(distinct, range(len(distinct))))
        places = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        lengths = sizes[places] - 2
        # an id's place among the data is its place among the ids, and what its word is moved by
        moved = heads[places] + 2 - (np.cumsum(lengths) - lengths)
        ids = data[np.repeat(moved, lengths) + np.arange(lengths.sum())]
        return ids, lengths, values[places]

    def ids(self, words: list[bytes]) -> np.ndarray:
        return self.read(words)[0]

    def texts(self, batch: dict[str, list]) -> Iterator[np.ndarray]:
        """The ids of each text of a batch."""
        return (self.ids(lower_blank_words(text)) for text in batch["text"])


class Stored:
    """Ids that were stored as bytes, in the least numbers that hold every id of a vocabulary."""

    def __init__(self, n_ids: int):
        self.kind = np.dtype(np.uint16 if n_ids <= 1 << 16 else np.int32)

    def bytes(self, ids: np.ndarray) -> bytes:
        return ids.astype(self.kind).tobytes()

    def texts(self, batch: dict[str, list]) -> Iterator[np.ndarray]:
        return (np.frombuffer(ids, self.kind) for ids in batch["ids"])


def _groups(items: Iterable[Sized], most: int) -> Iterator[list]:
    """Items whose lengths add up to ``most`` or less, or one longer."""
    group, n = [], 0
    for item in items:
        if group and n + len(item) > most:
            yield group
            group, n = [], 0
        group.append(item)
        n += len(item) + 1
    if group:
        yield group


def _joined(texts: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ids in front of those to predict, the ids to predict, and where each text begins and ends among them."""
    lengths = np.array([len(t) + 1 for t in texts])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    after = np.empty(int(ends[-1]), np.int32)
    before = np.empty_like(after)
    for text, at, upto in zip(texts, begins.tolist(), ends.tolist()):
        after[at : upto - 1], after[upto - 1] = text, end
        before[at], before[at + 1 : upto] = end, text
    return before, after, begins, ends


# ---- the model

Weights = dict[str, np.ndarray]


def started(voc: Vocabulary, seed: int = 7) -> Weights:
    """Weights that predict each class by its share of the corpus behind the id before it."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 1 / math.sqrt(WIDTH), shape).astype(np.float32)
    return {
        "E": draw(N_INPUTS, WIDTH),
        "P": 0.1 * draw(WINDOW, WIDTH),
        "Q": draw(WIDTH, WIDTH),
        "K": draw(WIDTH, WIDTH),
        "V": 0.1 * draw(WIDTH, WIDTH),
        "U": 0.1 * draw(WIDTH, N_CLASSES),
        "T": 0.1 * draw(N_INPUTS - BANDS[0], WIDTH),  # the bands' output layers, a row for each of their rows
        "B": voc.follows.astype(np.float32),
    }


@lru_cache(maxsize=64)
def _mask(size: int) -> np.ndarray:
    return np.where(np.tri(size, dtype=bool), np.float32(0), np.float32(-1e9))


def _exps(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(x - shift), its sums over the last axis, and the shift: each row's largest value, or 0 if no row needs one."""
    ones = np.ones(x.shape[-1], x.dtype)
    if x.max(initial=0) <= 60:
        e = np.exp(x)
        sums = e @ ones
        if sums.min(initial=1) >= 1e-20:
            return e, sums, 0.0
    shift = x.max(axis=-1, keepdims=True)
    e = np.exp(x - shift)
    return e, e @ ones, shift[..., 0]


def _rows(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return table.take(ids, axis=0, mode="clip")  # ids are rows of the table; the mode spares a copy


def _in_bands(
    w: Weights, others: list[np.ndarray], h: np.ndarray, before: np.ndarray, targets: np.ndarray, classes: np.ndarray
) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each band with targets: its rows of "T", the places of its targets, their h, and of its output layer the
    places of the targets' values, negative log likelihoods, exponentials and their sums.

    ``classes`` are those of the targets; places of any other number are left out.
    """
    for nth, (at, upto) in enumerate(EDGES):
        some = np.flatnonzero(classes == BANDS[0] + nth)
        if len(some):
            part, own = slice(at - BANDS[0], upto - BANDS[0]), _rows(h, some)
            z = own @ w["T"][part].T
            z += _rows(others[nth], before[some])
            chosen = np.arange(0, z.size, upto - at) + (targets[some] - at)
            e, sums, shift = _exps(z)
            yield part, some, own, chosen, np.log(sums) + shift - z.ravel()[chosen], e, sums


def row_gradients(
    w: Weights, ids: np.ndarray, targets: np.ndarray, valid: np.ndarray, others: list[np.ndarray] | None = None
) -> tuple[float, Weights, np.ndarray]:
    """Mean negative log likelihood of the valid targets, its gradient, and the rows of "E" and "B" that it has.

    Targets are rows; ``others`` are the vocabulary's, for targets in bands.

    No other row of the two has a gradient but zero. Queries and keys, and values, meet the
    inputs as one matrix each: (xQ)(xK)' is (xQK')x', and a(xV) is (ax)V.
    """
    n, size = ids.shape
    flat = ids.ravel()
    kind = w["E"].dtype
    root = np.float32(1 / math.sqrt(WIDTH))
    x = _rows(w["E"], flat).reshape(n, size, WIDTH)
    x += w["P"][:size]
    across = np.empty((n, WIDTH + 1, size), kind)  # x', and a row of ones
    across[:, :WIDTH], across[:, WIDTH] = x.transpose(0, 2, 1), 1
    both = w["Q"] @ w["K"].T * root
    y = x @ both
    near = y @ across[:, :WIDTH]
    near += _mask(size)
    a, sums, _ = _exps(near)
    share = (1 / sums)[..., None]  # a * share is the attention
    seen = a @ x
    seen *= share
    mixed = seen @ w["V"]
    # the output layer takes the places in the order of their ids; small whole numbers sort by their digits
    order = np.argsort(flat.astype(np.uint16) if N_INPUTS <= 1 << 16 else flat, kind="stable")
    places = flat[order]
    begins = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    h = _rows((x + mixed).reshape(-1, WIDTH), order).reshape(n, size, WIDTH)
    z = (h @ w["U"]).reshape(n * size, -1)
    z += _rows(w["B"], places)
    p, sums, shift = _exps(z)
    goals, counts = targets.ravel()[order], valid.ravel()[order]
    classes = CLASS_OF[goals]
    chosen = np.arange(0, z.size, z.shape[1]) + classes
    weight = counts / np.float32(max(1, int(valid.sum())))
    loss = float(((np.log(sums) + shift - z.ravel()[chosen]) * weight).sum())
    p *= (weight / sums)[:, None]
    p.reshape(-1)[chosen] -= weight
    p3 = p.reshape(n, size, -1)
    dh = (p3 @ np.ascontiguousarray(w["U"].T)).reshape(-1, WIDTH)
    dt = np.zeros_like(w["T"])
    banded = _in_bands(w, others, h.reshape(-1, WIDTH), places, goals, np.where(counts, classes, -1))
    for part, some, heads, at, losses, q, sums in banded:
        share_of = weight[some]
        loss += float((losses * share_of).sum())
        q *= (share_of / sums)[:, None]
        q.reshape(-1)[at] -= share_of
        dt[part] = q.T @ heads
        dh[some] += q @ w["T"][part]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    dh = _rows(dh, back)
    own = (dh.reshape(n, size, WIDTH) * share).reshape(-1, WIDTH)
    dseen = np.empty((n * size, WIDTH + 1), kind)
    np.matmul(own, w["V"].T, out=dseen[:, :WIDTH])
    # what the shares' sum takes off
    dseen[:, WIDTH] = (own * mixed.reshape(-1, WIDTH)) @ np.full(WIDTH, -1, kind)
    dseen = dseen.reshape(n, size, -1)
    ds = dseen @ across
    ds *= a
    dy = (ds @ x).reshape(-1, WIDTH)
    dboth = x.reshape(-1, WIDTH).T @ dy * root
    dv = seen.reshape(-1, WIDTH).T @ dh
    dx = dh
    dx += dy @ both.T
    dx = dx.reshape(n, size, WIDTH)
    dx += a.transpose(0, 2, 1) @ dseen[..., :WIDTH]
    dx += ds.transpose(0, 2, 1) @ y
    dp = np.zeros_like(w["P"])
    dp[:size] = dx.sum(axis=0)
    return loss, {
        "E": np.add.reduceat(_rows(dx.reshape(-1, WIDTH), order), begins), "P": dp, "Q": dboth @ w["K"],
        "K": dboth.T @ w["Q"], "V": dv, "U": (h.transpose(0, 2, 1) @ p3).sum(axis=0), "T": dt,
        "B": np.add.reduceat(p, begins),
    }, places[begins]


#: Tables with a row for each input row; by name they come before all others.
BY_ROW = ("B", "E")


def gradients(
    w: Weights, ids: np.ndarray, targets: np.ndarray, valid: np.ndarray, others: list[np.ndarray] | None = None
) -> tuple[float, Weights]:
    """Mean negative log likelihood of the valid targets, and its gradient."""
    loss, found, rows = row_gradients(w, ids, targets, valid, others)
    for name in BY_ROW:
        table = np.zeros_like(w[name])
        table[rows] = found[name]
        found[name] = table
    return loss, found


class Adam:
    """Adam's steps over weights that lie behind one another as ``packed`` puts them, the tables ``BY_ROW`` first.

    Means fade by a factor that all share, so a step writes only those that have a
    gradient: they are ``m * FADES[0]**age`` and ``s * FADES[1]**age``; ``root`` is the root of ``s``.
    """

    FADES = 0.9, 0.99
    #: Steps after which the factors are multiplied in, while both are far from the ends of floats.
    AGED = 128
    #: Weights changed at once, few enough for the processor's cache.
    BLOCK = 1 << 15

    def __init__(self, weights: Weights, rate: float):
        self.rate, self.n, self.age = rate, 0, 0
        self.flat = packed(weights)
        self.w = _views(self.flat, weights)
        self.m, self.s, self.root = (np.zeros_like(self.flat) for _ in range(3))
        self.rest = sum(weights[k].size for k in BY_ROW)
        means = [_views(x, weights) for x in (self.m, self.s, self.root)]
        self.by_row = {k: [x[k] for x in means] for k in BY_ROW}
        self.held = np.empty(self.BLOCK, self.flat.dtype)

    def step(self, gradient: Weights, rows: np.ndarray | slice = slice(None)) -> None:
        """One step; of the tables ``BY_ROW`` the gradient has these rows alone."""
        if self.age == self.AGED:
            self._settle()
        self.n += 1
        self.age += 1
        fade_m, fade_s = (fade**self.age for fade in self.FADES)
        others = np.concatenate([gradient[k].ravel() for k in sorted(gradient) if k not in BY_ROW])
        rest = slice(self.rest, None)
        parts = [(gradient[k], rows, *self.by_row[k]) for k in BY_ROW] + [(others, rest, self.m, self.s, self.root)]
        for g, at, m, s, root in parts:
            m[at] += np.float32(0.1 / fade_m) * g
            new = s[at] + np.float32(0.01 / fade_s) * (g * g)
            s[at] = new
            root[at] = np.sqrt(new)
        rate = self.rate * math.sqrt(1 - self.FADES[1] ** self.n) / (1 - self.FADES[0] ** self.n)
        least, rate = np.float32(1e-8 / math.sqrt(fade_s)), np.float32(rate * fade_m / math.sqrt(fade_s))
        for at in range(0, len(self.flat), self.BLOCK):
            part = slice(at, at + self.BLOCK)
            w = self.flat[part]
            change = np.add(self.root[part], least, out=self.held[: len(w)])
            np.divide(self.m[part], change, out=change)
            change *= rate
            w -= change

    def _settle(self) -> None:
        self.m *= np.float32(self.FADES[0] ** self.age)
        self.m[np.abs(self.m) < 1e-30] = 0  # moves no weight, and numbers near the end of floats are slow
        self.s *= np.float32(self.FADES[1] ** self.age)
        np.sqrt(self.s, out=self.root)
        self.age = 0


def packed(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)])


def _views(flat: np.ndarray, like: Weights) -> Weights:
    """The parts of ``packed`` weights, not copied."""
    out, at = {}, 0
    for k in sorted(like):
        size = like[k].size
        out[k] = flat[at : at + size].reshape(like[k].shape)
        at += size
    return out


def unpacked(flat: np.ndarray, like: Weights) -> Weights:
    return {k: v.astype(np.float32) for k, v in _views(flat, like).items()}


class Model:
    """Scores flat id sequences. As in ``row_gradients``, queries and keys meet the inputs as one matrix."""

    def __init__(self, weights: Weights, vocabulary: Vocabulary):
        self.w, self.vocabulary = weights, vocabulary
        self.both = weights["Q"] @ weights["K"].T * np.float32(1 / math.sqrt(WIDTH))

    def scores(self, texts: list[np.ndarray]) -> list[float]:
        """log10 probability of each text's ids and its end."""
        return [score for group in _groups(texts, HELD_IDS) for score in self._scores(group)]

    def _scores(self, texts: list[np.ndarray]) -> list[float]:
        voc = self.vocabulary
        before, after, begins, ends = _joined(texts, voc.end)
        inputs, targets = voc.inputs[before], voc.inputs[after]
        step = WINDOW - OVERLAP
        n_windows = np.maximum(1, -(-(ends - begins - OVERLAP) // step))
        of_text = np.repeat(np.arange(len(texts)), n_windows)
        nth = np.arange(len(of_text)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        starts = begins[of_text] + nth * step
        out = np.zeros(len(texts))
        # a text's first window is scored whole, the others behind their overlap
        for some, behind in ((nth == 0, 0), (nth > 0, OVERLAP)):
            some = np.flatnonzero(some)
            for at in range(0, len(some), SCORED):
                part = some[at : at + SCORED]
                found = self._window_scores(inputs, targets, starts[part], ends[of_text[part]], behind)
                out += np.bincount(of_text[part], found, len(out))
        shares = np.add.reduceat(voc.alone[after], begins)
        return (out / math.log(10) + shares).tolist()

    def _window_scores(self, inputs, targets, starts, ends, behind: int) -> np.ndarray:
        """log probability of the target rows of each window from place ``behind`` to its text's end."""
        places = starts[:, None] + np.arange(WINDOW)
        ids = inputs.take(places, mode="clip")
        x = _rows(self.w["E"], ids)
        x += self.w["P"]
        own = x[:, behind:]
        near = (own @ self.both) @ np.ascontiguousarray(x.transpose(0, 2, 1))
        near += _mask(WINDOW)[behind:]
        a, sums, _ = _exps(near)
        seen = a @ x
        seen /= sums[..., None]
        h = seen @ self.w["V"]
        h += own
        logits = (h @ self.w["U"]).reshape(-1, N_CLASSES)
        rows = ids[:, behind:].ravel()
        logits += _rows(self.w["B"], rows)
        places = places[:, behind:]
        goals, inside = targets.take(places, mode="clip").ravel(), places < ends[:, None]
        classes = CLASS_OF[goals]
        chosen = logits.ravel()[np.arange(0, logits.size, N_CLASSES) + classes]
        _, sums, shift = _exps(logits)
        found = chosen - shift - np.log(sums)
        classes = np.where(inside.ravel(), classes, -1)
        for _, some, _, _, losses, _, _ in _in_bands(
            self.w, self.vocabulary.others, h.reshape(-1, WIDTH), rows, goals, classes
        ):
            found[some] -= losses
        return np.where(inside, found.reshape(places.shape), 0).sum(axis=1, dtype=np.float64)


# ---- what is gathered from the corpus


def word_counts(learned: DataFrame) -> DataFrame:
    """Stored word, n over all documents; partitions add up before they send."""

    def run(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(lower_blank_words(text))
            if len(seen) > CACHE_WORDS:
                yield {"word": [*seen], "n": [*seen.values()]}
                seen = Counter()
        if seen:
            yield {"word": [*seen], "n": [*seen.values()]}

    found = map_rows(learned.select("text"), run, "word binary, n bigint")
    return written(found.groupBy("word").agg(F.sum("n").alias("n")), "words")


def _head(counts: DataFrame, most: int) -> DataFrame:
    """The frequent words: all of a least count, chosen so that they are ``most`` at most."""
    level = F.floor(F.log2("n") * 16)
    sizes = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in sizes:  # a row per sixteenth of an octave
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def _summed(found: DataFrame, *keys: str) -> list[np.ndarray]:
    table = found.groupBy(*keys).agg(F.sum("n").alias("n")).toArrow()
    return [table[name].to_numpy() for name in (*keys, "n")]


#: Codes of pairs of rows, with one row more for the edge of a word; and pairs summed at a time.
WIDE = N_INPUTS + 1
HELD_PAIRS = 1_000_000


def _pair_sums(held: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
    times = np.bincount(np.concatenate([c for c, _ in held]), np.concatenate([t for _, t in held]))
    codes = np.flatnonzero(times)
    return {"a": (codes // WIDE).astype(np.int32), "b": (codes % WIDE).astype(np.int32), "n": times[codes].astype(np.int64)}


def _word_groups(batches) -> Iterator[tuple[list[bytes], list[int]]]:
    """Words and their counts, those of many batches together."""
    words, times = [], []
    for batch in batches:
        words += batch["word"]
        times += batch["n"]
        if len(words) > HELD_WORDS:
            yield words, times
            words, times = [], []
    if words:
        yield words, times


def vocabulary(counts: DataFrame, n_docs: int, ranks: bytes) -> Vocabulary:
    """The vocabulary, from the ids of all counted words and the pairs of ids inside them and at their ends.

    What follows a word's last id is counted as the end or any word's first id.
    """
    context = counts.sparkSession.sparkContext
    shared = context.broadcast(ranks)

    def single(batches):
        seen = np.zeros(size)
        for words, times in _word_groups(batches):
            ids, begins = encoded(words, shared.value)
            seen += np.bincount(ids, np.repeat(times, np.diff(begins, append=len(ids))), size)
        yield {"id": np.flatnonzero(seen).astype(np.int32), "n": seen[seen > 0].astype(np.int64)}

    size = max(_encoding(ranks).max_token_value + 1, 1)
    n = np.ones(size + 1)  # each id once more than seen
    # at most a row per id
    ids, seen = _summed(map_rows(counts, single, "id int, n bigint"), "id")
    n[ids] += seen
    n[size] += n_docs
    inputs = np.full(size + 1, N_INPUTS - 1, np.int32)
    order = np.argsort(-n, kind="stable")[: N_INPUTS - 1]
    inputs[order] = np.arange(N_INPUTS - 1)
    rows = np.bincount(inputs, n, N_INPUTS)
    shared_inputs = context.broadcast(inputs)

    def pairs(batches):
        row_of, held, n = shared_inputs.value, [], 0
        for words, times in _word_groups(batches):
            ids, begins = encoded(words, shared.value)
            rows = row_of[ids].astype(np.int64)
            after = np.append(rows[1:], N_INPUTS)
            after[begins[1:] - 1] = N_INPUTS  # a word's last id
            times = np.array(times, np.float64)
            codes = np.concatenate([rows * WIDE + after, N_INPUTS * WIDE + rows[begins]])
            held.append((codes, np.append(np.repeat(times, np.diff(begins, append=len(ids))), times)))
            n += len(codes)
            if n > HELD_PAIRS:
                yield _pair_sums(held)
                held, n = [], 0
        if held:
            yield _pair_sums(held)

    # at most a row per pair of table rows
    first, second, times = _summed(map_rows(counts, pairs, "a int, b int, n bigint"), "a", "b")
    behind = np.zeros((WIDE, WIDE))
    behind[first, second] = times
    opening = behind[-1, :-1] + 1e-3
    end = inputs[size]
    opening[end] += n_docs
    opening /= opening.sum()
    table = behind[:-1, :-1] + behind[:-1, -1:] * opening
    table[end] += opening * max(n_docs, 1)
    # each row leans on the ids' own shares
    table += LEAN * np.maximum(rows, 1) / rows.sum()  # a small vocabulary has rows without ids
    bands = [table[:, at:upto] for at, upto in EDGES]
    totals = np.concatenate([table[:, : BANDS[0]], *(band.sum(axis=1, keepdims=True) for band in bands)], axis=1)
    follows = np.log(totals / totals.sum(axis=1, keepdims=True)).astype(np.float32)
    others = [np.log(band / band.sum(axis=1, keepdims=True)).astype(np.float32) for band in bands]
    return Vocabulary(ranks, inputs, np.log10(n / rows[inputs]).astype(np.float32), follows, others)


def _windows(batches, encoder: Encoder | Stored, voc: Vocabulary):
    """(inputs, targets, which of them are of the text) of windows: each id and each end is a target once."""
    for batch in batches:
        for texts in _groups(encoder.texts(batch), HELD_IDS):
            before, after, begins, ends = _joined(texts, voc.end)
            rows, targets = voc.inputs[before], voc.inputs[after]
            n_windows = -(-(ends - begins) // WINDOW)
            nth = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
            places = (np.repeat(begins, n_windows) + nth * WINDOW)[:, None] + np.arange(WINDOW)
            valid = places < np.repeat(ends, n_windows)[:, None]
            yield rows.take(places, mode="clip"), targets.take(places, mode="clip"), valid


def _batches(windows, size: int):
    """The windows, ``size`` at a time, and how many they are."""
    rest = None
    for found in windows:
        found = found if rest is None else tuple(np.concatenate(pair) for pair in zip(rest, found))
        whole = len(found[0]) // size * size
        for at in range(0, whole, size):
            yield *(x[at : at + size] for x in found), size
        rest = tuple(x[whole:] for x in found)
    if rest is not None and len(rest[0]):
        yield *rest, len(rest[0])


def trained(learned: DataFrame, voc: Vocabulary, weights: Weights, rounds: int) -> Weights:
    """The weights after rounds of local steps and averaging; each document's stored ids are learned whole, in one round."""
    context = learned.sparkSession.sparkContext
    shared_voc = context.broadcast(voc)
    for turn in range(rounds):
        shared = context.broadcast(weights)

        def run(batches, shared=shared, turn=turn):
            own = shared_voc.value
            adam, seen = Adam(shared.value, RATE / (1 + turn)), 0
            for ids, targets, valid, n in _batches(_windows(batches, Stored(len(own.inputs)), own), BATCH):
                _, found, rows = row_gradients(adam.w, ids, targets, valid, own.others)
                adam.step(found, rows)
                seen += n
            if seen:
                yield {"sum": [(adam.flat * np.float32(seen)).tobytes()], "n": [seen]}

        def add(a, b):
            return (a[0] + b[0], a[1] + b[1])

        rows = learned.where(fold(F.col("doc_id"), rounds) == turn).select("ids")
        found = map_rows(rows, run, "sum binary, n bigint").rdd.map(
            lambda r: (np.frombuffer(bytes(r[0]), np.float32).astype(np.float64), r[1])
        )
        total, n = found.treeAggregate((np.zeros(1), 0), add, add, depth=3)
        if n:
            weights = unpacked(total / n, weights)
    return weights


SCORES = "uid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double"
ENCODED = f"{SCORES}, words array<binary>, times array<bigint>, ids binary"


def scored(
    docs: DataFrame,
    ranks_path: str = VOCABULARY,
    head_words: int = HEAD_WORDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = prepared(docs.sparkSession)
    with open(ranks_path, "rb") as file:
        ranks = file.read()
    held_out = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    learned = docs.where(~held_out).select("doc_id", "text")
    n_docs = learned.count()
    counts = word_counts(learned)
    n_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_tokens, n_distinct = n_words + n_docs, distinct + (n_docs > 0)
    voc = vocabulary(counts, n_docs, ranks)
    n_ids = len(voc.inputs)
    head = _head(counts, head_words).toArrow()
    context = spark.sparkContext
    shared_head = context.broadcast(
        (ranks, entries(head["word"].to_pylist(), np.log10(head["n"].to_numpy() + 1.0), ranks))
    )
    end_known, unseen = int(n_docs > 0), math.log10(n_tokens + n_distinct + 1)

    def encode(batches):
        encoder, stored = Encoder(*shared_head.value), Stored(n_ids)
        for batch in batches:
            out: dict[str, list] = {"n_tokens": [], "n_known": [], "base": [], "words": [], "times": [], "ids": []}
            for texts in _groups(map(lower_blank_words, batch["text"]), HELD_WORDS):
                words = [*chain.from_iterable(texts)]
                sizes = np.array([*map(len, texts)])
                of_text = np.repeat(np.arange(len(texts)), sizes)
                ids, lengths, values = encoder.read(words)
                rare = np.isnan(values)
                rest: list[Counter] = [Counter() for _ in texts]
                for text, at in zip(of_text[rare].tolist(), np.flatnonzero(rare).tolist()):
                    rest[text][words[at]] += 1
                edges = np.cumsum(np.concatenate([[0], lengths]))[np.cumsum(np.concatenate([[0], sizes]))].tolist()
                found = (
                    sizes + 1,
                    np.bincount(of_text[~rare], minlength=len(texts)) + end_known,
                    np.bincount(of_text[~rare], values[~rare], len(texts)) + math.log10(n_docs + 1),
                    [[*counted] for counted in rest],
                    [[*counted.values()] for counted in rest],
                    [stored.bytes(ids[a:b]) for a, b in zip(edges, edges[1:])],
                )
                for column, some in zip(out.values(), found):
                    column.extend(some)
            yield {k: batch[k] for k in ("uid", "doc_id", "held_out")} | out

    # every text is read as ids once, for all rounds and the scores
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", held_out.alias("held_out"), "text")
    found = written(map_rows(rows, encode, ENCODED), "encoded")
    weights = trained(found.where(~F.col("held_out")), voc, started(voc), rounds)
    shared = context.broadcast((voc, weights))

    def score(batches):
        voc, weights = shared.value
        model, stored = Model(weights, voc), Stored(len(voc.inputs))
        for batch in batches:
            scores = model.scores([*stored.texts(batch)])
            yield {k: v for k, v in batch.items() if k != "ids"} | {"score": scores}

    scores = written(map_rows(found.drop("words", "times"), score, f"{SCORES}, score double"), "scores")
    rare = found.select("uid", F.explode(F.arrays_zip("words", "times")).alias("t")).select(
        "uid", F.col("t.words").alias("word"), "t.times"
    )
    met = rare.join(counts, "word").groupBy("uid")
    rest = met.agg(F.sum("times").alias("_n"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("_base"))
    joined = scores.join(rest, "uid", "left")
    none = F.lit(0)
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_n", none)).alias("n_known"),
        F.lit(n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", none) - F.col("n_tokens") * unseen).alias("base_score"),
        "score",
    )
