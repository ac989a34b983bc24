import random

import pytest

VOCABULARY = [a + b for a in "ka lo mi ne ru sa ti vo".split() for b in "ban del fir gom hus jin".split()]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


#: Nulls, empty and blank texts, ties, repeats, odd white space and a very long text.
def nasty_texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    passage = prose(2, 70)
    return [
        (0, base),
        (1, base.upper()),
        (2, near),
        (3, base),
        (3, base),
        (4, None),
        (5, ""),
        (6, " \t\n\x0b\x0c\r "),
        (7, "one"),
        (8, "one two"),
        (9, "one two three"),
        (10, f"{prose(3, 40)} {passage} {prose(4, 40)}"),
        (11, f"{prose(5, 30)}\n{passage}\n{prose(6, 30)}"),
        (12, passage),
        (13, " Ünïcode wörds ½ \U0001f600 " + prose(7, 60)),
        (14, prose(8, 30_000)),
        (15, "\n".join(["same line of words here", ""] * 30)),
        (16, "a b c " * 40),
        (None, base),
        (None, None),
    ]


@pytest.fixture
def nasty(spark):
    """The texts with extra columns, among them names that operators use inside."""
    kind = (
        "doc_id bigint, text string, lang string, source string, n_chars bigint, text_key string, row string,"
        " cuts string, `group` string, _text string, hits string, n_words string, mark string, kept string"
    )
    rows = [
        (i, t, [None, "en", "fr"][k % 3], [None, "a", "b", "c"][k % 4], None if t is None else len(t), *["x"] * 9)
        for k, (i, t) in enumerate(nasty_texts())
    ]
    return spark.createDataFrame(rows, kind).repartition(3)


@pytest.fixture
def empty(nasty):
    return nasty.limit(0)
