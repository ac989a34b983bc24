import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F

from itemsync.llm import lm, toxicity
from tests.llm.conftest import nasty_texts, prose


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_matches_edit_distance():
    rng = random.Random(2)
    terms = ["rotten", "rot", "worthless", "roast", "fool"]
    lexicon = toxicity.Lexicon([(t, False) for t in terms])
    words = [*terms, "", "r"]
    for term in terms * 60:
        word = list(term)
        for _ in range(rng.randrange(4)):
            at, kind = rng.randrange(len(word) + 1), rng.randrange(3)
            word[at : at + (kind > 0)] = [rng.choice("rotens")] * (kind < 2)
        words.append("".join(word))
    for word in words:
        near = [edit_distance(word, t) for t in terms if edit_distance(word, t) <= toxicity.edits_for(t)]
        found = lexicon.match(word)
        assert (found is None) == (not near) and (found is None or found[1] == min(near)), word


def test_stems_take_any_ending():
    lexicon = toxicity.Lexicon([("grim", True), ("grand", False)])
    assert lexicon.match("grimmest") == (0, 0) and lexicon.match("gram") is None and lexicon.match("grant") == (1, 1)


@pytest.fixture
def labelled(spark):
    rng, rows, labels = random.Random(3), [], []
    for n in range(400):
        words, toxic = prose(n, 60).split(), n % 5 == 0
        for _ in range(4 if toxic else 0):
            word = rng.choice(["wretched", "dreadful", "vermin"])
            words.insert(rng.randrange(len(words)), word if rng.random() < 0.8 else word[:2] + word[3:])
        rows.append((n, " ".join(words)))
        labels.append((n, int(toxic)))
    labels += [(401, None), (None, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_toxicity(labelled):
    docs, labels = labelled
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = toxicity.scored(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_misspellings_not_seen_are_found_at_every_letter(spark):
    """Words whose stems rank first, and one of four letters, with a letter changed, left out or put in anywhere."""
    words, rng, rows = ["idiot", "worthless", "moron", "disgusting", "scum"], random.Random(7), []
    for n in range(400):
        text = prose(n, 60).split()
        for word in words if n % 5 == 0 else ():
            text.insert(rng.randrange(len(text)), word)
        rows.append((n, " ".join(text), int(n % 5 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    scorer = toxicity.Scorer(toxicity.fitted(docs, docs.select("doc_id", "toxic")))
    for word in words:
        for at in range(len(word)):
            for wrong in (word[:at] + "0" + word[at + 1 :], word[:at] + word[at + 1 :], word[:at] + "x" + word[at:]):
                assert scorer.hit(wrong) is not None, wrong
    assert scorer.hit("kaban") is None and scorer.hit("scoms") is None


def test_word_and_stem_of_the_same_letters():
    lexicon = toxicity.Lexicon([("scum", True), ("scum", False)])
    assert lexicon.match("scumbag") == (0, 0) and lexicon.match("scum") == (0, 0) and lexicon.match("scm") == (1, 1)


def test_toxicity_of_nasty_and_empty_tables(spark, nasty, empty, labelled):
    rows = toxicity.scored(nasty, labelled[1]).collect()
    assert len(rows) == len(nasty_texts()) and all(0 <= r.score <= 1 for r in rows)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.scored(nasty, none).where("score is null").count() == 0
    assert toxicity.scored(empty, none).count() == 0


def test_quotation_is_a_feature():
    model = toxicity.Model([("vermin", False, 5.0)], {}, [0.0] * toxicity.N_FEATURES, [1.0] * toxicity.N_FEATURES)
    scorer = toxicity.Scorer(model)
    assert scorer.features('he said "vermin" to them')[0][3] > 0 and scorer.features("you vermin there")[0][3] == 0


def test_base_score_matches_brute_force(nasty):
    rows = [(i, t) for i, t in nasty_texts()]
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    expected = []
    for i, t in rows:
        own = tokens(t)
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        expected.append((str(i), held(i), len(own), sum(count[w] > 0 for w in own), n, round(base, 4)))
    for head in (10, lm.HEAD_WORDS):  # most words joined, and all at hand
        found = lm.scored(nasty, head_words=head, rounds=1).collect()
        assert sorted((str(r[0]), *r[1:5], round(r[5], 4)) for r in found) == sorted(expected)
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_lm_of_empty_table(empty):
    assert lm.scored(empty).count() == 0


def tiny():
    rng = np.random.default_rng(0)
    size = 40
    inputs = np.arange(size + 1, dtype=np.int32)
    follows = np.log(rng.dirichlet(np.ones(lm.N_CLASSES), lm.N_INPUTS)).astype(np.float32)
    others = np.zeros((lm.N_INPUTS, lm.N_INPUTS), np.float32)
    voc = lm.Vocabulary(b"", inputs, np.zeros(size + 1, np.float32), follows, others)
    return voc, lm.started(voc)


def test_gradients_match_differences():
    voc, w = tiny()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rng = np.random.default_rng(1)
    ids, targets = rng.integers(0, 40, (3, 9)), rng.integers(0, 40, (3, 9))
    valid = np.ones((3, 9), bool)
    valid[1, 5:] = False
    _, gradient = lm.gradients(w, ids, targets, valid)
    for name in w:
        at = np.unravel_index(np.abs(gradient[name]).argmax(), w[name].shape)
        step = 1e-4
        w[name][at] += step
        up = lm.gradients(w, ids, targets, valid)[0]
        w[name][at] -= 2 * step
        down = lm.gradients(w, ids, targets, valid)[0]
        w[name][at] += step
        assert np.isclose((up - down) / (2 * step), gradient[name][at], rtol=2e-2, atol=1e-5), name


def test_each_id_is_scored_once():
    """The batched windows against one pass over each window's own ids."""
    voc, w = tiny()
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 40, n).astype(np.int32) for n in (0, 1, 7, 31, 32, 33, 55, 56, 57, 300)]
    model = lm.Model(w, voc)
    for text, got in zip(texts, model.scores(texts)):
        before, after = [voc.end, *text], [*text, voc.end]
        total = 0.0
        for at in range(len(after)):
            step = lm.WINDOW - lm.OVERLAP
            begin = max(0, (at - lm.OVERLAP) // step) * step
            ids = np.array([before[begin : at + 1]])
            x = w["E"][ids] + w["P"][: ids.shape[1]]
            q, k, v = x @ w["Q"], x @ w["K"], x @ w["V"]
            a = q[0, -1] @ k[0].T / math.sqrt(lm.WIDTH)
            a = np.exp(a - a.max())
            h = x[0, -1] + a @ v[0] / a.sum()
            z = h @ w["U"] + w["B"][ids[0, -1]]
            total += z[after[at]] - np.log(np.exp(z).sum())
        assert np.isclose(got, total / math.log(10), rtol=1e-4, atol=1e-3)


def wide():
    """A vocabulary that fills all rows, ids beyond them in the last, with random counts."""
    rng = np.random.default_rng(6)
    size = lm.N_INPUTS + 50
    inputs = np.minimum(np.arange(size + 1), lm.N_INPUTS - 1).astype(np.int32)
    inputs[size] = 3
    alone = np.zeros(size + 1, np.float32)
    alone[inputs == lm.N_INPUTS - 1] = -math.log10((inputs == lm.N_INPUTS - 1).sum())
    alone[[3, size]] = -math.log10(2)
    follows = np.log(rng.dirichlet(np.ones(lm.N_CLASSES), lm.N_INPUTS)).astype(np.float32)
    others = [np.log(rng.dirichlet(np.ones(b - a), lm.N_INPUTS)).astype(np.float32) for a, b in lm.EDGES]
    voc = lm.Vocabulary(b"", inputs, alone, follows, others)
    return voc, lm.started(voc)


def row_shares(voc, w, rows):
    """The natural logarithms of all rows' shares behind the last of a window's ``rows``, one place at a time."""
    x = w["E"][rows] + w["P"][: len(rows)]
    a = (x[-1] @ w["Q"]) @ (x @ w["K"]).T / math.sqrt(lm.WIDTH)
    a = np.exp(a - a.max())
    h = x[-1] + (a / a.sum()) @ (x @ w["V"])
    shares = lambda z: z - np.log(np.exp(z).sum())
    first = shares(h @ w["U"] + w["B"][rows[-1]])
    most = lm.BANDS[0]
    bands = [
        first[most + n] + shares(w["T"][a - most : b - most] @ h + voc.others[n][rows[-1]]) for n, (a, b) in enumerate(lm.EDGES)
    ]
    return np.concatenate([first[:most], *bands])


def test_each_row_of_ids_is_chosen_by_attention():
    """Scores against a pass over each place; all rows' and ids' shares add up to one, and context moves those of each band."""
    voc, w = wide()
    rng = np.random.default_rng(7)
    w["T"] += rng.normal(0, 0.3, w["T"].shape).astype(np.float32)
    texts = [(voc.end * rng.random(n) ** 2).astype(np.int32) for n in (0, 1, 31, 33, 57, 200)]
    texts.append(np.array([lm.BANDS[0] - 1, *lm.BANDS, lm.N_INPUTS - 1, voc.end - 1], np.int32))
    for text, got in zip(texts, lm.Model(w, voc).scores(texts)):
        before, after, total = [voc.end, *text], [*text, voc.end], 0.0
        for at in range(len(after)):
            step = lm.WINDOW - lm.OVERLAP
            begin = max(0, (at - lm.OVERLAP) // step) * step
            shares = row_shares(voc, w, voc.inputs[before[begin : at + 1]])
            assert len(shares) == lm.N_INPUTS and np.isclose(np.exp(shares).sum(), 1, atol=1e-4)
            total += shares[voc.inputs[after[at]]] / math.log(10) + voc.alone[after[at]]
        assert np.isclose(got, total, rtol=1e-4, atol=1e-3)
    assert np.allclose(np.bincount(voc.inputs, 10.0**voc.alone), 1, atol=1e-4)
    # the same id before, and another one before that
    one, other = (row_shares(voc, w, np.array(rows)) for rows in ([3, 900, 5], [3, 40, 5]))
    moved = np.abs(one - other)
    assert all(np.ptp(moved[a:b]) > 1e-3 for a, b in [(0, lm.BANDS[0]), *lm.EDGES])


def test_gradients_of_bands_match_differences():
    voc, w = wide()
    w = {k: v.astype(np.float64) for k, v in w.items()}
    rng = np.random.default_rng(8)
    ids, targets = rng.integers(0, lm.N_INPUTS, (2, 3, 9))
    ids[:, 4] = 5  # a row of many targets
    targets[0, :5] = [*lm.BANDS, lm.N_INPUTS - 1]
    valid = np.ones((3, 9), bool)
    valid[1, 5:] = False
    loss, gradient = lm.gradients(w, ids, targets, valid, voc.others)
    shares = [row_shares(voc, w, row[: at + 1])[goals[at]] for row, goals, n in zip(ids, targets, (9, 5, 9)) for at in range(n)]
    assert np.isclose(loss, -np.mean(shares), rtol=1e-5)
    for name in w:
        found = np.argsort(-np.abs(gradient[name]).ravel())[:3]
        for at in zip(*np.unravel_index(found, w[name].shape)):
            step = 1e-4
            w[name][at] += step
            up = lm.gradients(w, ids, targets, valid, voc.others)[0]
            w[name][at] -= 2 * step
            down = lm.gradients(w, ids, targets, valid, voc.others)[0]
            w[name][at] += step
            assert np.isclose((up - down) / (2 * step), gradient[name][at], rtol=2e-2, atol=1e-5), name


def test_rare_ids_are_learned_from_context():
    """Which of two ids of a band comes is told by the id before the last alone; counts of pairs can't tell it."""
    voc, w = wide()
    voc.others = [np.zeros_like(table) for table in voc.others]
    rng = np.random.default_rng(9)
    pairs = [(lm.BANDS[0], lm.BANDS[0] + 9), (300, 500), (600, 1000), (1100, 2000)]

    def text(n, turn):
        return [20 + n, 60 + turn, 7, pairs[n][turn]]

    learned = [np.array(sum((text(*x) for x in zip(rng.integers(0, 4, 7), rng.integers(0, 2, 7))), []), np.int32) for _ in range(640)]
    adam = lm.Adam(w, lm.RATE)
    for _ in range(30):
        for ids, targets, valid, _ in lm._batches(lm._windows([{"text": learned}], Plain(), voc), lm.BATCH):
            _, found, rows = lm.row_gradients(adam.w, ids, targets, valid, voc.others)
            adam.step(found, rows)
    for n in range(4):
        for turn in range(2):
            right = text(n, turn)
            wrong = [*right[:3], pairs[n][1 - turn]]
            scores = lm.Model(adam.w, voc).scores([np.array(x, np.int32) for x in (right[:3], right, wrong)])
            assert scores[1] > scores[2] + 0.3, (n, turn, scores)


class Plain:
    def texts(self, batch):
        return iter(batch["text"])


def test_training_lowers_the_loss():
    voc, w = tiny()
    rng = np.random.default_rng(4)
    ids = np.cumsum(rng.integers(1, 3, (64, 16)), axis=1) % 40
    adam, valid = lm.Adam(w, 0.02), np.ones((64, 15), bool)
    first = lm.gradients(adam.w, ids[:, :-1], ids[:, 1:], valid)[0]
    for _ in range(60):
        adam.step(lm.gradients(adam.w, ids[:, :-1], ids[:, 1:], valid)[1])
    assert lm.gradients(adam.w, ids[:, :-1], ids[:, 1:], valid)[0] < 0.6 * first


def test_all_ids_of_all_texts_are_learned_once(spark, monkeypatch):
    with open(lm.VOCABULARY, "rb") as file:
        encoder = lm.Encoder(file.read())
    size = lm._encoding(encoder.ranks).max_token_value + 1
    voc = lm.Vocabulary(encoder.ranks, np.arange(size + 1, dtype=np.int32), None, None, None)
    monkeypatch.setattr(lm, "N_CLASSES", size + 1)  # so that a class is an id
    texts = [prose(n, 7 * n) if n else None for n in range(40)] + ["x" * 5000]
    wanted = np.concatenate([np.append(encoder.ids(lm.lower_blank_words(t)), size) for t in texts])
    batches = lm._batches(lm._windows([{"text": texts}], encoder, voc), 16)
    assert np.array_equal(np.concatenate([y[v] for _, y, v, _ in batches]), wanted)
    # over all rounds, the windows of every document count, whatever its id
    frame = spark.createDataFrame([(n if n else None, t) for n, t in enumerate(texts)], "doc_id long, text string")
    dealt = [frame.where(lm.fold(F.col("doc_id"), 3) == turn).count() for turn in range(3)]
    assert sum(dealt) == len(texts) and min(dealt) > 0


def test_texts_are_read_to_count_and_to_encode_only(spark):
    """Rounds and scores take stored ids: no text is read and encoded anew for each."""
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    texts = [prose(n, 30) for n in range(20)]
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    rows = lm.scored(frame.select("doc_id", F.udf(seen)("text").alias("text"))).collect()
    learned = sum(not r.held_out for r in rows)
    assert len(rows) == 20 and 0 < learned < 20 and read.value == learned + 20


def test_steps_on_some_rows_are_adam_on_all():
    """Against the steps as they are written down, over more steps than means are left to fade."""
    _, w = tiny()
    rng = np.random.default_rng(5)
    adam, size = lm.Adam(w, 0.02), {k: v.shape[1] for k, v in w.items()}
    plain = {k: v.astype(np.float64) for k, v in w.items()}
    m, s = ({k: np.zeros_like(v) for k, v in plain.items()} for _ in range(2))
    for n in range(1, 2 * lm.Adam.AGED + 10):
        rows = np.sort(rng.choice(lm.N_INPUTS // (1 + n % 50), 20, replace=False))
        some = {k: rng.normal(0, 1e-3, (20, size[k]) if k in lm.BY_ROW else v.shape) for k, v in w.items()}
        adam.step({k: g.astype(np.float32) for k, g in some.items()}, rows)
        for k, v in plain.items():
            g = np.zeros_like(v)
            g[rows if k in lm.BY_ROW else slice(None)] = some[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            v -= 0.02 * math.sqrt(1 - 0.99**n) / (1 - 0.9**n) * m[k] / (np.sqrt(s[k]) + 1e-8)
    for k, v in plain.items():
        assert np.allclose(adam.w[k], v, rtol=1e-3, atol=1e-3), k


def test_softmax_where_values_leave_the_range_of_floats():
    x = np.array([[-200.0, -201, -1e9], [0, 1, 2], [300, 100, -300], [50, 50, -1e9]], np.float32)
    for rows in ([0, 1, 2, 3], [0], [1, 3], [2]):
        e, sums, _ = lm._exps(x[rows])
        wanted = np.exp(x[rows].astype(np.float64) - x[rows].max(axis=1, keepdims=True))
        assert np.allclose(e / sums[:, None], wanted / wanted.sum(axis=1, keepdims=True), rtol=1e-5)
