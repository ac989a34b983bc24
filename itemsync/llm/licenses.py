"""License scans: exact phrases, and fuzzy search for short notices.

Texts become lower-case words parted by single spaces. A notice that may hold ``k``
errors (letters put in, left out or changed) is split into ``k + 1`` seeds; wherever
it stands with ``k`` errors at most, one seed stands unchanged, so exact seeds locate
all candidates. Around each candidate the regex library's bounded-error matching
verifies the edits and gives the span, which begins and ends at words.

Null and empty texts have no words and no labels. Repeated rows each get their
row; other columns are neither read nor kept.
"""

from __future__ import annotations

import bisect
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemsync.llm.common import alnum_words, map_rows, prepared

#: Base phrases with their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Notices searched with errors: label and number of errors allowed (fixed values).
NOTICES = {
    "gnu general public license": ("gpl", 3),
    "gnu lesser general public license": ("lgpl", 3),
    "gnu affero general public license": ("agpl", 3),
    "apache license": ("apache", 2),
    "licensed under the apache license version": ("apache", 4),
    "mit license": ("mit", 1),
    "released under the mit license": ("mit", 3),
    "mozilla public license": ("mpl", 2),
    "eclipse public license": ("epl", 2),
    "bsd license": ("bsd", 1),
    "redistribution and use in source and binary forms": ("bsd", 4),
    "licensed under cc by": ("cc-by", 2),
    "creative commons attribution": ("cc-by", 3),
    "creative commons zero": ("cc0", 2),
    "all rights reserved": ("reserved", 2),
    "released into the public domain": ("public-domain", 3),
}


def seeds(notice: str, errors: int) -> list[tuple[str, int]]:
    """``errors + 1`` pieces of a notice with their offsets."""
    edges = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(notice[a:b], a) for a, b in zip(edges, edges[1:])]


class Notice:
    def __init__(self, text: str, label: str, errors: int):
        self.text, self.label, self.errors = text, label, errors
        self.seeds = seeds(text, errors)
        fuzzy = f"(?:{regex.escape(text)}){{e<={errors}}}"
        self.pattern = regex.compile(f"(?<![^ ]){fuzzy}(?![^ ])", regex.BESTMATCH)
        # the library puts no letter in before the first or behind the last one
        self.inner = regex.compile(fuzzy, regex.BESTMATCH)

    def find(self, joined: str) -> list[tuple[int, int, int]]:
        """(begin, end, errors) of each place, those of fewer errors first where places overlap.

        Every seed's own area is searched, of the notice's length and some more, so the work
        grows with the seeds found. Seeds that point to one begin share an area.
        """
        begins = set()
        for seed, offset in self.seeds:
            at = joined.find(seed)
            while at >= 0:
                begins.add(at - offset)
                at = joined.find(seed, at + 1)
        found = set()
        for begin in begins:
            area = (max(begin - self.errors - 1, 0), min(begin + len(self.text) + 2 * self.errors + 1, len(joined)))
            found |= {(m.start(), m.end(), sum(m.fuzzy_counts)) for m in self.pattern.finditer(joined, *area)}
            found |= {p for m in self.inner.finditer(joined, *area) if (p := self._whole_words(joined, m))}
        taken: list[tuple[int, int, int]] = []  # in order, none overlapping another
        for place in sorted(found, key=lambda p: (p[2], p[0], p[1])):
            at = bisect.bisect_left(taken, place)
            if place[1] <= place[0] or (at and taken[at - 1][1] > place[0]):
                continue
            if at == len(taken) or place[1] <= taken[at][0]:
                taken.insert(at, place)
        return taken

    def _whole_words(self, joined: str, match: regex.Match) -> tuple[int, int, int] | None:
        """The match widened to whole words, if the letters put in leave it within its errors."""
        begin = joined.rfind(" ", 0, match.start()) + 1
        end = joined.find(" ", match.end())
        end = len(joined) if end < 0 else end
        errors = sum(match.fuzzy_counts) + match.start() - begin + end - match.end()
        return (begin, end, errors) if errors <= self.errors and match.end() > match.start() else None


@lru_cache(maxsize=4)
def _notices(items: tuple) -> list[Notice]:
    return [Notice(text, *rule) for text, rule in items]


def find(text: str | None, notices: dict[str, tuple[str, int]] = NOTICES) -> tuple[int, list, list]:
    """Number of words; base places (first word, label); fuzzy places (first word, last word, label, errors, length)."""
    words = alnum_words(text)
    if not words:
        return 0, [], []
    # in code points, so that an edited letter is one error whatever its bytes
    words = [word.decode("utf-8", "surrogatepass") for word in words]
    joined = " ".join(words)
    starts: list[int] = []

    def word_at(offset: int) -> int:
        if not starts:
            at = 0
            for word in words:
                starts.append(at)
                at += len(word) + 1
        return bisect.bisect_right(starts, offset) - 1

    base = []
    for phrase, label in PHRASES.items():
        at = joined.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            if (at == 0 or joined[at - 1] == " ") and (end == len(joined) or joined[end] == " "):
                base.append((word_at(at), label))
            at = joined.find(phrase, at + 1)
    fuzzy = [
        (word_at(begin), word_at(end - 1), notice.label, errors, len(notice.text))
        for notice in _notices(tuple(notices.items()))
        for begin, end, errors in notice.find(joined)
    ]
    return len(words), base, fuzzy


FOUND = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string,"
    " labels string, score double, spans array<struct<label:string,first:bigint,last:bigint,errors:int>>"
)


def scanned(docs: DataFrame, notices: dict[str, tuple[str, int]] = NOTICES) -> DataFrame:
    """One row per document: base counts and labels, all labels, the score and the fuzzy spans in words.

    The score is that of the best place: 1 for an exact phrase, less by the share of
    its letters that are wrong for another; 0 without a place.
    """
    prepared(docs.sparkSession)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                n, base, fuzzy = find(text, notices)
                places = [at for at, _ in base]
                own = {label for _, label in base}
                spans = [{"label": label, "first": a, "last": b, "errors": e} for a, b, label, e, _ in fuzzy]
                score = max([1.0 if base else 0.0, *(1 - e / size for *_, e, size in fuzzy)])
                row = (
                    doc_id, n, len(base), min(places, default=None), max(places, default=None), ",".join(sorted(own)),
                    ",".join(sorted(own | {f[2] for f in fuzzy})), score, spans,
                )
                for name, value in zip(names, row):
                    out[name].append(value)
            yield out

    names = [part.split()[0] for part in FOUND.replace("label:string,first:bigint,last:bigint,", "").split(", ")]
    return map_rows(docs.select("doc_id", "text"), run, FOUND)


def digests(docs: DataFrame) -> DataFrame:
    return scanned(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.size("spans").cast("bigint").alias("n_fuzzy"),
    )
