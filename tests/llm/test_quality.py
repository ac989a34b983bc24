import re
from collections import Counter

import numpy as np

from itemsync.llm import quality
from tests.llm.conftest import nasty_texts, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {j for i, w in enumerate(windows) if n[w] > 1 for j in (i, i + 1, i + 2)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def test_base_counts_match_brute_force(nasty):
    rows = quality.judged(nasty, keep=["doc_id"]).collect()
    got = Counter(
        (r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows
    )
    assert got == Counter((i, *brute(t)) for i, t in nasty_texts())
    assert all(not r.kept for r in rows if r.base_failed)


def test_columns_and_empty_tables(nasty, empty):
    assert quality.judged(nasty).select("row.*").schema == nasty.schema
    assert quality.judged(empty).count() == 0


def test_outliers_go_and_clean_documents_stay(spark):
    rows = [(n, prose(n, 80 + n % 40), ["en", None][n % 2], "a") for n in range(300)]
    rows += [(1000 + n, " ".join(w + "###" for w in prose(n, 90).split()), ["en", None][n % 2], "a") for n in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    kept = {r.row.doc_id for r in quality.judged(docs, keep=["doc_id"]).where("kept").collect()}
    assert kept == set(range(300))


def test_symbol_spam_and_repeated_lines_go(spark):
    """One symbol a word and 40 % repeated lines are far; a repeated line of twelve and a few symbols are not."""
    lines = lambda n, k: [prose(1000 * n + i, 12) for i in range(k)]
    rows = [(n, "\n".join(lines(n, 8 + n % 5))) for n in range(200)]
    rows += [(200 + n, "\n".join([*(own := lines(300 + n, 11)), own[0]])) for n in range(8)]
    rows += [(210 + n, prose(n, 90).replace(",", "&", 3)) for n in range(8)]
    clean = {n for n, _ in rows}
    rows += [(1000 + n, " ".join(w + "#" for w in prose(n, 90).split())) for n in range(12)]
    for n in range(12):  # 10 lines, 4 of them repeats of one
        own = lines(600 + n, 6)
        rows.append((2000 + n, "\n".join([*own, *[own[0]] * 4])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' lang", "'a' source").repartition(5)
    found = quality.judged(docs, keep=["doc_id"]).collect()
    assert not any(r.base_failed for r in found)
    assert {r.row.doc_id for r in found if r.kept} == clean


def test_small_groups_are_judged(spark):
    """Sources of 1 to 20 rows, in a large language and in small ones: no group is too small for a distance."""
    langs = ["en"] * 6 + ["fr", None, "de", "es"]
    rows = [(n, prose(n, 80 + n % 40), langs[n % 10], f"s{n % 23}") for n in range(230)]
    rows += [
        (1000 + n, " ".join(w + "###" for w in prose(n, 90).split()), lang, f"t{n}")
        for n, lang in enumerate(["en", "en", "fr", None, "new"])
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    found = quality.judged(docs, keep=["doc_id"]).collect()
    assert all(r.squared is not None for r in found)
    assert {r.row.doc_id for r in found if r.kept} == set(range(230))


def test_estimate_resists_a_fifth_of_outliers(spark):
    """Mean and factor of the core against numpy, on vectors of which a fifth lie far off.

    The consistency factor is that of clean data, so the spread comes out up to half too large.
    """
    rng = np.random.default_rng(3)
    x = np.round(rng.multivariate_normal([900, 300, 500, 200], np.diag([90.0, 80, 300, 400]) ** 2, 2000)).astype(int)
    far = np.round(rng.multivariate_normal([4000, 3000, 100, 2000], np.eye(4) * 100, 500)).astype(int)
    rows = [("g", *map(int, r)) for r in np.vstack([x, far])]
    vectors = spark.createDataFrame(rows, "group string, x0 int, x1 int, x2 int, x3 int")
    found = quality.estimates(vectors).first()
    assert np.allclose([found[f"m{i}"] for i in range(4)], x.mean(axis=0), atol=25)
    factor = np.array([[found[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    floors = np.diag([(f * quality.GRID) ** 2 for f in quality.FLOORS])
    assert np.allclose(factor @ factor.T, np.cov(x.T) + floors, rtol=0.5, atol=9000)
    inverse = np.linalg.inv(factor @ factor.T)
    d = vectors.crossJoin(spark.createDataFrame([found])).select("x0", "x1", "x2", "x3", quality._squared().alias("d")).take(20)
    mean = np.array([found[f"m{i}"] for i in range(4)])
    for r in d:
        v = np.array(r[:4]) - mean
        assert np.isclose(r.d, v @ inverse @ v)


def plain_estimate(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The estimate of the least determinant by the same starts and steps, in numpy."""
    floors = np.array(quality.FLOORS) * quality.GRID
    at = lambda v, share: np.sort(v)[max(0, int(np.ceil(len(v) * share)) - 1)]
    q = np.array([[at(c, share) for share in (0.25, 0.5, 0.75)] for c in x.T])
    spread = np.maximum((q[:, 2] - q[:, 0]) / 1.349, floors)
    middle, low = np.abs(x - q[:, 1]) / spread, np.abs(x - q[:, 0]) / spread
    grid = lambda d: np.round(np.log(np.maximum(d, 1e-6)) * quality.DISTANCE_GRID)

    def step(d):
        core = x[grid(d) <= at(grid(d), quality.CORE / 100)]
        return core.mean(axis=0), quality.CONSISTENCY * np.cov(core.T, bias=True) + np.diag(floors**2)

    best = None
    for d in ((middle**2).sum(1), middle.max(1) ** 2, middle.sum(1) ** 2, (low**2).sum(1)):
        mean, cov = step(d)
        while True:
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            after = step(d)
            if not np.linalg.slogdet(after[1])[1] < np.linalg.slogdet(cov)[1] - quality.LEAST_FALL:
                break
            mean, cov = after
        if best is None or np.linalg.slogdet(cov)[1] < np.linalg.slogdet(best[1])[1]:
            best = mean, cov
    return best


def test_least_determinant_matches_a_plain_search(spark):
    """Several groups at once, one of them with a cluster that draws the medians away."""
    rng = np.random.default_rng(11)
    groups = {
        "clean": rng.normal([900, 300, 500, 200], [90, 300, 500, 400], (400, 4)),
        "two": np.vstack([rng.normal([900, 0, 0, 0], [90, 30, 50, 40], (260, 4)), rng.normal([2000, 900, 3000, 900], 60, (140, 4))]),
        "flat": np.column_stack([rng.normal(800, 50, 200), np.zeros((200, 3))]),
    }
    groups = {g: np.round(x).astype(int) for g, x in groups.items()}
    rows = [(g, *map(int, r)) for g, x in groups.items() for r in x]
    vectors = spark.createDataFrame(rows, "group string, x0 int, x1 int, x2 int, x3 int").repartition(3)
    found = {r.group: r for r in quality.estimates(vectors).collect()}
    for g, x in groups.items():
        mean, cov = plain_estimate(x.astype(float))
        r = found[g]
        factor = np.array([[r[f"l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
        assert np.allclose([r[f"m{i}"] for i in range(4)], mean) and np.allclose(factor @ factor.T, cov)


def test_verdicts_match_a_plain_search(spark):
    rows = [(n, prose(n, 80 + n % 40), "en", "a") for n in range(200)]
    rows += [(1000 + n, " ".join(w + "#" for w in prose(n, 90).split()), "en", "a") for n in range(25)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(5)
    found = quality.judged(docs, keep=["doc_id"]).collect()
    x = []
    for r in found:
        n = r.n_words
        line = max(1, len([p for p in dict(rows_of(rows))[r.row.doc_id].split("\n") if p.strip()]))
        values = np.log(r.word_chars / n), np.log1p(r.n_symbols / n), np.log1p(10 * r.n_dup_lines / line), np.log1p(10 * r.n_repeat_words / n)
        x.append([round(v * quality.GRID) for v in values])
    x = np.array(x, float)
    mean, cov = plain_estimate(x)
    d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
    assert [r.kept for r in found] == [not r.base_failed and bool(k) for r, k in zip(found, d <= quality.CUT, strict=True)]


def rows_of(rows):
    return [(i, text) for i, text, *_ in rows]
