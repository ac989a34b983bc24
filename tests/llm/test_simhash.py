import random
from collections import defaultdict

import pytest
import xxhash

from itemsync.llm import simhash
from itemsync.llm.components import smallest
from tests.llm.conftest import nasty_texts, prose


def plain_mark(text, size=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def test_components_match_brute_force(nasty):
    marks = [(i, plain_mark(t)) for i, t in nasty_texts()]
    found = groups({m for _, m in marks}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for i, m in marks:
        if i is not None:
            least[found[m]].append(i)
    expected = sorted((i is None, i or 0, f"{m:016x}", min(least[found[m]])) for i, m in marks)
    rows = simhash.components(nasty).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.fingerprint, r.component_id) for r in rows) == expected


def test_empty(empty):
    assert simhash.components(empty).count() == 0
    assert simhash.deduplicated(empty).count() == 0


@pytest.mark.parametrize("crowd", [2, 64])
def test_links_keep_every_component(spark, crowd):
    """Crowded blocks give the components that all pairs give."""
    rng = random.Random(5)
    marks = set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(25):
            marks.add(base ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randrange(4))}))
    signed = {m - (1 << 64) if m >> 63 else m: m for m in marks}
    df = spark.createDataFrame([(s,) for s in signed], "mark bigint")
    pairs = simhash.links(df, crowd=crowd)
    assert all((signed[r.a] ^ signed[r.b]).bit_count() <= 2 for r in pairs.collect() if crowd == 64)
    least = {r.id: r.least for r in smallest(pairs).collect()}
    expected = groups(signed, lambda a, b: (signed[a] ^ signed[b]).bit_count() <= 2)
    assert {s: least.get(s, s) for s in signed} == expected


def test_smallest_on_a_long_path(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    expected = {i: 0 for i in range(1, 41)} | {101: 100}
    assert {r.id: r.least for r in smallest(df).collect()} == expected


def test_near_duplicates(spark):
    """One row stays of every component of fingerprints, by brute force."""
    rng = random.Random(9)
    rows = []
    for n in range(12):
        words = prose(100 + n, 400).split()
        rows.append((10 * n + 5, " ".join(words)))
        for copy in range(1, 5):
            other = [*words]
            for _ in range(copy - 1):
                other[rng.randrange(len(other))] = "edited"
            rows.append((10 * n + copy, " ".join(other)))
    rows += [(1000 + n, prose(500 + n, 150)) for n in range(20)] + [(2000, None), (2001, ""), (2002, "few words"), rows[0]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    marks = [(i, simhash.fingerprint(simhash.hashes(t, simhash.SHINGLE))) for i, t in rows]
    by_mark = groups([m for _, m in marks], lambda a, b: (a ^ b).bit_count() <= simhash.DISTANCE)
    least: dict = {}
    for i, m in marks:
        least[by_mark[m]] = min(i, least.get(by_mark[m], i))
    kept = sorted(r.doc_id for r in simhash.deduplicated(docs).collect())
    assert kept == sorted(least.values())
    assert len(kept) < len({t for _, t in rows})


def test_deduplicated_keeps_columns(nasty):
    out = simhash.deduplicated(nasty)
    assert out.columns == nasty.columns and out.schema == nasty.schema
    ids = [r.doc_id for r in out.collect()]
    # 0 stays for its copies, upper-case and null-id; a changed word is more than two bits; null and blank texts are one class of no words
    assert sorted(i for i in ids if i is not None) == [0, 2, 4, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16] and None not in ids
