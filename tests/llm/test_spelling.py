"""Spelling variants against every pair of words compared."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from itemsync.llm import spelling
from tests.llm.conftest import nasty_texts, prose


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_vocabulary(rows) -> dict[str, int]:
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= 3}


def expected(rows) -> list[tuple]:
    n = plain_vocabulary(rows)
    near = {word: [other for other in n if one_edit(word, other)] for word in n}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    found = []
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        found.append((word, form[word], root, n[word], len(near[word]), n[form[word]] if form[word] else None))
    return sorted(found)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def compared(spark, rows, **options) -> list[tuple]:
    found = spelling.variants(made(spark, rows), **options)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    result = sorted(map(tuple, found.collect()))
    assert result == expected(rows)
    return result


def misspelt(seed: int, n: int) -> list[tuple[int, str]]:
    """Texts of few words, many of them with up to three edits, in a small alphabet so that edits collide."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abÀéz") for _ in range(rng.randrange(4, 12))) for _ in range(40)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(30):
            word = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(word))
                word[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "Z", "é"])
                word = word or ["a"]
            words.append("".join(word))
        rows.append((i, " ".join(words)))
    return rows


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abÀ", min_size=1, max_size=7), min_size=1, max_size=40, unique=True))
def test_index_finds_all_pairs(words):
    """Every pair with an equal left half, of all words held, whatever their length."""
    index = spelling.Index(words, [1] * len(words))
    for length in {len(w) for w in words if len(w) > 1}:
        group = [w for w in words if len(w) == length]
        half = length // 2
        searched, held = index.near(group, half)
        found = {(group[s], words[h]) for s, h in zip(searched.tolist(), held.tolist(), strict=True)}
        assert found == {(a, b) for a in group for b in words if one_edit(a, b) and a[:half] == b[:half]}


def test_both_intervals_stay_in_step():
    words = ["banana", "bandana", "ananas", "nan"]
    index = spelling.Index(words, [1] * 4)
    text = "".join("$" + w for w in words)
    lo, hi, other = np.array([0]), np.array([index.n]), np.array([0])
    back = text[::-1]
    for k, symbol in enumerate(reversed("$ban")):
        lo, hi, smaller = index.left.extend(lo, hi, np.searchsorted(index.alphabet, [ord(symbol)]))
        other = other + smaller
        part = "$ban"[3 - k :]
        places = [i for i in range(len(text)) if (text + text)[i : i + len(part)] == part]
        assert (hi - lo).tolist() == [len(places)]
        rank = other[0]
        start = index.back_order[rank]
        assert (back + back)[start : start + len(part)] == part[::-1]


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_match_all_pairs(spark, seed):
    found = compared(spark, misspelt(seed, 120))
    assert any(form for _, form, *_ in found)


def test_crowded_halves_in_many_small_indexes(spark):
    compared(spark, misspelt(3, 100), index_words=4)


def test_nasty_rows(spark, nasty):
    rows = [(i, t) for i, t in nasty_texts()]
    result = sorted(map(tuple, spelling.variants(nasty).collect()))
    assert result == expected(rows)
    long = "xy" * 40_000
    compared(spark, [(None, long), (1, long + " abcde"), (1, long), (2, long + "z abcde"), (3, None), (4, "abcde abcdé")] * 3)


def test_ties_take_the_smallest_word(spark):
    rows = [(1, " ".join(["abcdef"] * 3 + ["abcdeg"] * 9 + ["abcdeh"] * 9 + ["zbcdeg"] * 30))]
    found = {row[0]: row for row in compared(spark, rows)}
    assert found["abcdef"][1:3] == ("abcdeg", "zbcdeg")


def test_some_runs_are_damaged():
    rows = [(i, prose(i, 200)) for i in range(40)]
    whole = set(re.findall("[a-z]+", " ".join(t for _, t in rows)))
    hurt = [spelling.damaged(i, w) for i in range(200) for w in whole]
    assert 0 < sum(w not in whole for w in hurt) < len(hurt) / 50


def test_empty_table(empty):
    assert spelling.variants(empty).count() == 0
