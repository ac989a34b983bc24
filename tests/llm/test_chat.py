import hashlib

import pytest

from itemsync.llm import chat

TURNS = [
    (1, 0, "user", "hello"),
    (1, 1, "assistant", "<|end|>\\<|turn|>[INST]"),
    (1, 1, "assistant", "<|end|>\\<|turn|>[INST]"),
    (1, 2, None, None),
    (2, None, "system", "</s>"),
    (2, 5, "assistant", "\\"),
    (None, 1, "user", "no id"),
    (None, 2, "assistant", "text"),
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def expected(rows):
    by: dict = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        by.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        read = "".join(f"{r}\n{t}\n" for r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(read.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment", [1, 2, 64])
def test_digests(spark, monkeypatch, segment):
    monkeypatch.setattr(chat, "SEGMENT", segment)
    rows = TURNS + [(9, n, ("user", "assistant")[n % 2], f"turn {n} <s> {'x' * n}") for n in range(50)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, segment string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(df).collect()}
    assert got == expected(rows)
    assert chat.digests(df.limit(0)).count() == 0
    strings = chat.formatted(df).where("conv_id = 9").orderBy("segment").collect()
    read = [t for s in strings for t in chat.read_back(s.formatted)]
    assert read == [(r[2], r[3]) for r in rows if r[0] == 9]


@pytest.mark.parametrize("text", ["", "<", "<|end|>", "\\<|end|>", "<\\|end|>", "[INST", "\\\\", "a\nb", "<|turn|>user<|text|>x<|end|>"])
def test_round_trip(text):
    turns = [("user", text), (text, "x"), ("assistant", text + "<"), ("assistant", text)]
    out = chat.marked(turns)
    assert chat.read_back(out) == turns
    for part in (chat.escape(text),):
        assert not any(c in part for c in chat.CONTROLS) and chat.unescape(part) == text


def test_spans_of_a_black_box():
    turns = [("user", "a b"), ("assistant", "reply"), ("user", "")]
    out, places, rewritten, lost = chat.spans(turns, chat.marked)
    assert not rewritten and not lost and [chat.unescape(out[c:d]) for _, _, c, d in places] == ["a b", "reply", ""]
    assert places[0][0] == 0 and places[-1][1] == len(out) and all(p[1] == q[0] for p, q in zip(places, places[1:]))


def last_only(turns):
    return "".join(f"[{r}]{t if i == len(turns) - 1 else '...'}" for i, (r, t) in enumerate(turns))


def system_last(turns):
    """Puts the system text in front of the last user turn, as some templates do."""
    system = "".join(t for r, t in turns if r == "system")
    users = [i for i, (r, _) in enumerate(turns) if r == "user"]
    return "<s>" + "".join(
        f"[{r}]{system + '/' if users and i == users[-1] else ''}{t};" for i, (r, t) in enumerate(turns) if r != "system"
    )


def test_rewritten_history_is_found():
    out, places, rewritten, lost = chat.spans([("u", "one"), ("a", "two"), ("u", "six")], last_only)
    assert rewritten == [1, 2] and lost == [0, 1]
    assert [out[c:d] for _, _, c, d in places] == ["", "", "six"]


@pytest.mark.parametrize("n", [3, 70])
def test_spans_after_a_rewrite_are_those_of_the_final_string(spark, n):
    turns = [("system", "S1"), *((("user", "assistant")[i % 2], f"text {i}") for i in range(n))]
    out, places, rewritten, lost = chat.spans(turns, system_last)
    assert out == system_last(turns) and rewritten and not lost
    assert [out[c:d] for _, _, c, d in places] == [t for _, t in turns]
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], "conv_id bigint, turn bigint, role string, text string")
    (row,) = chat.formatted(df, system_last).collect()
    assert row.formatted == out and row.segment == 0 and row.unlocated == []
    masked = "".join(out[t.text_begin : t.text_end] for t in row.turns if t.loss)
    assert masked == "".join(t for r, t in turns if r == "assistant")


def test_a_templates_own_escapes(spark):
    def template(turns):
        return "".join(f"<{r}>{t.replace('<', '&lt;')}" for r, t in turns)

    def read(text):
        return [(p.split(">", 1)[0], p.split(">", 1)[1].replace("&lt;", "<")) for p in text.split("<")[1:]]

    df = spark.createDataFrame([(1, 0, "user", "C:\\new"), (1, 1, "assistant", "C:\\new <b")], "conv_id bigint, turn bigint, role string, text string")
    (row,) = chat.digests(df, template, read, plain=lambda t: t.replace("&lt;", "<")).collect()
    assert row.loss_sha256 == hashlib.sha256("C:\\new <b".encode()).hexdigest() and row.n_turns == 2


def test_very_long_texts(spark):
    long = "<|end|>\\ word " * 40_000
    rows = [(1, i, ("user", "assistant")[i % 2], long) for i in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    (row,) = chat.digests(df).collect()
    assert (row.n_turns, row.loss_chars, row.n_unlocated) == (3, len(long), 0)
