"""Chat formatting by incremental rendering of a black-box template.

A template is a function from turns (role, text) to a string. Successive turn
prefixes are rendered; consecutive outputs give each turn's span, and an output
that does not begin with the one before it shows that the template rewrites
history. Rendering the last turn once more with a sentinel as its text gives the
place of the text within the span. Where history was rewritten, every turn is located
anew in the final string by a sentinel in its place; a turn that cannot be located so
is left out of the loss mask and counted.

A template is rendered over whole conversations. Only one that says of itself that it
puts turns behind one another (``concatenates``, as the library's does) is rendered in
segments of ``segment`` turns, which gives the same string and keeps the work of a long
conversation in proportion.

Turns are ordered by turn, role, text. Rows flow through a task in that order and
only the turns of one segment or conversation are held. A null text or role is empty, null
``turn`` comes first, rows with a null ``conv_id`` are one conversation, repeated
rows are repeated turns. Other columns of the table are neither read nor kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import map_rows, prepared

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Control strings of the template and of kindred ones (fixed values).
BEGIN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = [BEGIN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>"]
SENTINEL = "\ue000"
SEGMENT = 64

_CONTROL = re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.S)
_PART = re.compile(f"({re.escape(BEGIN)}|{re.escape(TEXT)}|{re.escape(END)})")


def escape(text: str) -> str:
    """Double backslashes, then put one behind the first character of each control string."""
    return _CONTROL.sub(r"\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def marked(turns: list[Turn]) -> str:
    """The library's template: every turn marked, control strings inside escaped."""
    return "".join(f"{BEGIN}{escape(role)}{TEXT}{escape(text)}{END}" for role, text in turns)


marked.concatenates = True


def segment_of(template: Template) -> int | None:
    """Turns rendered at once; all of a conversation unless the template only puts turns behind one another."""
    return SEGMENT if getattr(template, "concatenates", False) else None


def read_back(formatted: str) -> list[Turn]:
    """The turns of a string that ``marked`` made."""
    parts = _PART.split(formatted)
    return [(unescape(parts[i + 2]), unescape(parts[i + 4])) for i in range(0, len(parts) - 1, 6)]


def _located(turns: list[Turn], at: int, whole: str, template: Template) -> tuple[int, int] | None:
    """Where the text of a turn stands in the rendered turns; None if a sentinel does not show it."""
    probe = template([*turns[:at], (turns[at][0], SENTINEL), *turns[at + 1 :]])
    begin = probe.find(SENTINEL)
    tail = probe[begin + len(SENTINEL) :]
    if begin < 0 or SENTINEL in tail or begin + len(tail) > len(whole):
        return None
    if not whole.startswith(probe[:begin]) or not whole.endswith(tail):
        return None
    return begin, len(whole) - len(tail)


def spans(
    turns: list[Turn], template: Template
) -> tuple[str, list[tuple[int, int, int, int]], list[int], list[int]]:
    """The rendered turns; per turn (begin, end, text begin, text end); turns that rewrote history; turns not located.

    A turn that is not located has an empty text span at the end of its own.
    """
    before, found, rewritten, lost = template([]), [], [], []
    for n in range(1, len(turns) + 1):
        now = template(turns[:n])
        if not now.startswith(before):
            rewritten.append(n - 1)
        place = _located(turns[:n], n - 1, now, template)
        if place is None:
            lost.append(n - 1)
            place = (len(now), len(now))
        found.append((min(len(before), len(now)), len(now), *place))
        before = now
    if not rewritten:
        return before, found, rewritten, lost
    # history moved: spans of earlier prefixes no longer hold
    found, lost, end = [], [], 0
    for at in range(len(turns)):
        place = _located(turns, at, before, template)
        if place is None:
            lost.append(at)
            place = (end, end)
        found.append((end, max(end, place[1]), *place))
        end = found[-1][1]
    return before, found, rewritten, lost


class _Reader:
    """Running digests of one conversation, fed with formatted segments."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.chars, self.loss_chars, self.rewrites, self.lost = conv_id, 0, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, turns: list[Turn], template: Template, read: Callable[[str], list[Turn]], plain, target: str) -> None:
        formatted, places, rewritten, lost = spans(turns, template)
        back = read(formatted)
        for role, text in back:
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        for (role, _), (_, _, begin, end) in zip(back, places):
            if role == target:
                text = plain(formatted[begin:end])
                self.loss_chars += len(text)
                self.loss.update(text.encode("utf-8", "surrogatepass"))
        self.n, self.chars, self.rewrites = self.n + len(back), self.chars + len(formatted), self.rewrites + len(rewritten)
        self.lost += len(lost)


def _ordered(conversations: DataFrame) -> DataFrame:
    spark = prepared(conversations.sparkSession)
    rows = conversations.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _segments(batches, segment: int | None) -> Iterator[tuple[int | None, bool, list[Turn]]]:
    """(conversation, whether it begins here, turns), of ``segment`` turns at most if given."""
    conv, first, turns = object(), True, []
    for batch in batches:
        for conv_id, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
            if turns and (conv_id != conv or len(turns) == segment):
                yield conv, first, turns
                first, turns = False, []
            if conv_id != conv:
                conv, first = conv_id, True
            turns.append((role, text))
    if turns:
        yield conv, first, turns


FORMATTED = (
    "conv_id bigint, segment bigint, formatted string,"
    " turns array<struct<role:string,begin:int,end:int,text_begin:int,text_end:int,loss:boolean>>, rewritten array<int>,"
    " unlocated array<int>"
)


def formatted(
    conversations: DataFrame, template: Template = marked, target: str = "assistant"
) -> DataFrame:
    """Training strings: per conversation and segment the text, each turn's span, and the loss mask."""

    segment = segment_of(template)

    def run(batches):
        number = 0
        for conv, first, turns in _segments(batches, segment):
            number = 0 if first else number + 1
            text, places, rewritten, lost = spans(turns, template)
            yield {
                "conv_id": [conv],
                "segment": [number],
                "formatted": [text],
                "turns": [
                    [
                        {"role": r, "begin": p[0], "end": p[1], "text_begin": p[2], "text_end": p[3], "loss": r == target}
                        for (r, _), p in zip(turns, places)
                    ]
                ],
                "rewritten": [rewritten],
                "unlocated": [lost],
            }

    return map_rows(_ordered(conversations), run, FORMATTED)


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, n_rewrites bigint, n_unlocated bigint"
)


def digests(
    conversations: DataFrame,
    template: Template = marked,
    read: Callable[[str], list[Turn]] = read_back,
    target: str = "assistant",
    plain: Callable[[str], str] = unescape,
) -> DataFrame:
    """Per conversation the digests of what is read back from its formatted strings.

    ``read`` takes turns out of a string that ``template`` made, and ``plain`` undoes the
    template's escapes in a text; both go with the template.
    """
    segment = segment_of(template)

    def rows(done: list[_Reader]) -> dict:
        return {
            "conv_id": [d.conv_id for d in done],
            "n_turns": [d.n for d in done],
            "turns_sha256": [d.turns.hexdigest() for d in done],
            "loss_chars": [d.loss_chars for d in done],
            "loss_sha256": [d.loss.hexdigest() for d in done],
            "formatted_chars": [d.chars for d in done],
            "n_rewrites": [d.rewrites for d in done],
            "n_unlocated": [d.lost for d in done],
        }

    def run(batches):
        reader, done = None, []
        for conv, first, turns in _segments(batches, segment):
            if first:
                if reader:
                    done.append(reader)
                reader = _Reader(conv)
            reader.add(turns, template, read, plain, target)
            if len(done) == 256:
                yield rows(done)
                done = []
        if reader:
            yield rows([*done, reader])

    return map_rows(_ordered(conversations), run, DIGESTS)
