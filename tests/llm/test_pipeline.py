"""The pipeline's stages one after another against brute force on a few hundred texts."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from itemsync.llm import mixing, quality, simhash
from itemsync.llm.queries import OTHER_SHARE, SHARES
from tests.llm.conftest import prose
from tests.llm.test_quality import brute, plain_estimate

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string"


def made() -> tuple[list[tuple], list[tuple]]:
    rng = random.Random(21)
    items = [(n, prose(900 + n, 30)) for n in range(5)] + [(5, ""), (6, None), (7, "two words")]
    passages = [prose(700 + n, 70) for n in range(4)]
    texts = [prose(n, 150 + n % 60) for n in range(160)]
    texts += [texts[n] for n in range(12)] + [texts[n].upper() for n in range(12, 18)]
    texts += [f"{prose(300 + n, 60)} {passages[n % 4]} {prose(400 + n, 60)}" for n in range(16)]
    texts += [f"{prose(500 + n, 90)} {items[n % 5][1]} {prose(600 + n, 90)}" for n in range(10)]
    texts += [" ".join(w + "##" for w in prose(800 + n, 120).split()) for n in range(10)]
    texts += ["same words again " * 60, "", None, "short text", " \n "]
    rng.shuffle(texts)
    rows = [(n if n != 50 else None, t, "en", [*SHARES, "src9", None][n % 7], None if t is None else len(t), "x") for n, t in enumerate(texts)]
    return rows, items


def stage_quality(rows):
    found = [brute(r[1]) for r in rows]
    vectors = []
    for r, (n, chars, symbols, repeated, covered, _) in zip(rows, found, strict=True):
        lines = max(1, len([p for p in (r[1] or "").split("\n") if p.strip()]))
        n = max(n, 1)
        values = np.log(max(chars, 1) / n), np.log1p(symbols / n), np.log1p(10 * repeated / lines), np.log1p(10 * covered / n)
        vectors.append([round(float(v) * quality.GRID) for v in values])
    x, failed = np.array(vectors, float), np.array([f[-1] for f in found])
    # every source has fewer rows than an estimate needs, so that of the language counts
    mean, cov = plain_estimate(x[~failed])
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    return [r for r, bad, far in zip(rows, failed, d > quality.CUT, strict=True) if not bad and not far]


def stage_dedup(rows):
    marks = [simhash.fingerprint(simhash.hashes(r[1], simhash.SHINGLE)) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= simhash.DISTANCE and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least: dict = {}
    for r, g in zip(rows, group, strict=True):
        key = (r[0] is None, r[0] or 0)
        if g not in least or key < least[g][0]:
            least[g] = (key, r)
    return [r for _, r in least.values()]


def stage_substring(rows):
    first: dict = {}
    cut = {r[0]: r[1].split() for r in rows if r[0] is not None}
    for doc, words in sorted(cut.items()):
        for k in range(len(words) - 49):
            first.setdefault(tuple(words[k : k + 50]), doc)
    out = []
    for r in rows:
        words = r[1].split()
        gone = set()
        for k in range(len(words) - 49) if r[0] is not None else ():
            if first[tuple(words[k : k + 50])] < r[0]:
                gone |= set(range(k, k + 50))
        out.append((r[0], " ".join(w for k, w in enumerate(words) if k not in gone), *r[2:]))
    return out


def stage_decontaminate(rows, items):
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    windows = set()
    for _, text in items:
        w = cut(text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    hit = lambda w: any(tuple(w[k : k + n]) in windows for n in {*map(len, windows)} for k in range(len(w) - n + 1))
    return [r for r in rows if not hit(cut(r[1]))]


def stage_mixing(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, s or ""))
    shares = [SHARES.get(s, OTHER_SHARE) for s in sources]
    placed, total, out = mixing.period(shares), sum(shares), []
    for source, share, slots in zip(sources, shares, placed, strict=True):
        ids = [r[0] for r in rows if r[3] == source]
        ids.sort(key=lambda i: (i is not None, hashlib.md5(str(i).encode()).hexdigest() if i is not None else ""))
        for n, i in enumerate(ids):
            block = n // mixing.BLOCK_ROWS
            slot = block // share * total + slots[block % share]
            out.append((i, source, slot * mixing.BLOCK_ROWS + n % mixing.BLOCK_ROWS))
    return out


@pytest.fixture
def tables(spark, tmp_path):
    rows, items = made()
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, items


def test_run_matches_brute_force(spark, tables):
    folder, rows, items = tables
    after = [stage_quality(rows)]
    after.append(stage_dedup(after[-1]))
    after.append(stage_substring(after[-1]))
    after.append(stage_decontaminate(after[-1], items))
    sizes = [len(rows), *map(len, after)]
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4] > 100
    found = corpus_pipeline.run(spark, folder)
    order = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, found.select("doc_id", "source", "position").collect()), key=order) == sorted(stage_mixing(after[-1]), key=order)


def test_stages_keep_the_columns_of_documents(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.names == docs.columns, name
        none = stage(spark, docs.where(F.lit(False)), folder)
        assert none.schema.names == docs.columns and none.count() == 0, name
