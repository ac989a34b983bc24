import hashlib

import numpy as np
import pytest

from itemsync.llm import substring
from tests.llm.conftest import nasty_texts, prose


def brute(rows, window=50):
    first = {}
    for i, t in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - window + 1):
            key = b" ".join(words[k : k + window])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for i, t in rows:
        words, gone = (t or "").encode().split(), set()
        for k in range(len(words) - window + 1):
            if i is not None and first[b" ".join(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i is None, i or 0, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_matches_brute_force(nasty):
    assert found(substring.deduplicated(nasty)) == brute(nasty_texts())


@pytest.mark.parametrize("width", [16, 1 << 16])
def test_passages_in_many_contexts(spark, width):
    """Passages in varied surroundings, overlapping and within one document; a tiny sketch overestimates all."""
    a, b = prose(40, 90).split(), prose(41, 60).split()
    rows = []
    for n in range(12):
        parts = [prose(200 + n, 20 + n).split(), a[n % 4 : 90 - n], prose(300 + n, n).split(), b[: 48 + n], a[10:70]]
        rows.append((n * 3 % 13, " ".join(w for p in parts for w in p)))
    rows += [(50, "x " * 200), (51, "x " * 120), (52, "y " + "x " * 70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert found(substring.deduplicated(docs, width=width)) == brute(rows)


def test_sketch_never_underestimates():
    rng = np.random.default_rng(1)
    keys = [np.unique(rng.integers(0, 500, 300).astype(np.uint64)) for _ in range(4)]
    merged = substring.Sketch(64, 2)
    for k in keys:
        part = substring.Sketch(64, 2)
        part.add(k)
        merged = merged.merge(substring.Sketch(64, 2, part.packed()))
    values, n = np.unique(np.concatenate(keys), return_counts=True)
    assert merged.repeated(values[n > 1]).all()


def test_cleaned(nasty, empty):
    out = substring.cleaned(nasty)
    assert out.columns == nasty.columns
    by_id = {}
    for r in out.collect():
        by_id.setdefault(r.doc_id, []).append(r)
    texts = dict(nasty_texts()[::-1])
    assert by_id[0][0].text == texts[0] and by_id[4][0].text is None and by_id[3][0].text == ""
    passage = texts[12]
    assert passage not in by_id[11][0].text and passage in by_id[10][0].text
    assert by_id[11][0].n_chars == len(by_id[11][0].text) and "\n" in by_id[11][0].text
    assert len(by_id[None]) == 2 and substring.cleaned(empty).count() == 0


def test_empty(empty):
    assert substring.deduplicated(empty).count() == 0
