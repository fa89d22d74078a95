"""License scan: fuzzy search for short notices, by exact seeds and bounded-error verification.

A text becomes its lower-case words with single spaces between them. Two things are looked for:

* *phrases*, exactly: the places where a phrase's words stand consecutively;
* *notices*, with up to ``errors`` inserted, deleted or replaced characters, from word border
  to word border. By the pigeonhole principle a notice cut into ``errors + 1`` pieces has a
  piece without an error in any such place, so the pieces are exact seeds: one automaton
  finds them all in one pass, and around a seed only the few characters that the notice can
  cover are verified by the regex library's bounded-error matching. Of overlapping matches
  of one notice the one with fewer errors (then the first) stays, and a match goes if one of
  another label with fewer errors overlaps it. The span, its errors and the words that it
  covers are reported.

Each document is scanned by itself, in one pass without a shuffle; the notices are code.

Nulls and odd rows: a null text is an empty one; texts of any length are scanned whole;
repeated rows are scanned each; the columns named in ``keep`` are returned whatever their
names (a name that a result column has is an error); an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator, Sequence
from functools import cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Lower-case letters, digits and everything outside ASCII, once A-Z are lower-cased.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


class Phrase(NamedTuple):
    words: str
    label: str


class Notice(NamedTuple):
    text: str
    label: str
    errors: int


# The phrases whose places count.
PHRASES = (
    Phrase("mit license", "mit"),
    Phrase("apache license", "apache"),
    Phrase("general public license", "gpl"),
)

# Short notices in use, and the errors that still leave each distinct from the others.
NOTICES = (
    Notice("released under the mit license", "mit", 3),
    Notice("licensed under the mit license", "mit", 3),
    Notice("the mit license", "mit", 1),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 5),
    Notice("licensed under the apache license", "apache", 3),
    Notice("apache license version 2 0", "apache", 2),
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 2),
    Notice("gnu affero general public license", "agpl", 2),
    Notice("gnu free documentation license", "gfdl", 2),
    Notice("mozilla public license", "mpl", 1),
    Notice("eclipse public license", "epl", 1),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("under the bsd license", "bsd", 1),
    Notice("licensed under cc by 4 0", "cc-by", 1),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", 1),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 1),
    Notice("licensed under cc by nd 4 0", "cc-by-nd", 1),
    Notice("creative commons attribution", "cc", 2),
    Notice("released into the public domain", "public-domain", 2),
    Notice("all rights reserved", "reserved", 1),
)

SPAN = "label string, notice string, errors int, first_word long, last_word long, first_char long, last_char long"
RESULT = f"n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<{SPAN.replace(' string', ':string').replace(' long', ':long').replace(' int', ':int')}>>"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """The notice cut into ``errors + 1`` pieces of nearly equal length, with their places."""
    n, k = len(notice.text), notice.errors + 1
    cut = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cut, cut[1:])]


class Scanner:
    """Phrases, notices and their seeds, prepared once in each worker."""

    def __init__(self, phrases: Sequence[Phrase], notices: Sequence[Notice]) -> None:
        self.notices, self.phrases = notices, phrases
        self.seeds = ahocorasick.Automaton()
        uses: dict[str, list] = {}
        for i, notice in enumerate(notices):
            for at, piece in pieces(notice):
                uses.setdefault(piece, []).append((i, at))
        for i, phrase in enumerate(phrases):
            uses.setdefault(f" {phrase.words} ", []).append((-1 - i, 0))
        for text, use in uses.items():
            self.seeds.add_word(text, (len(text), use))
        if uses:
            self.seeds.make_automaton()
        self.patterns = [regex.compile(r"(?<= )(?:%s){e<=%d}(?= )" % (regex.escape(n.text), n.errors), regex.BESTMATCH) for n in notices]

    def scan(self, text: str) -> tuple[int, list[tuple[int, str]], list[tuple]]:
        """(words, base places, spans): a base place is (first word, label); a span has the columns of ``SPAN``."""
        lower = text.translate(_LOWER) if not text.isascii() else text.lower()
        words = WORD.findall(lower)
        line = f" {' '.join(words)} "
        base, windows = [], {}
        for last, (size, use) in self.seeds.iter(line) if len(self.seeds) else ():
            for i, at in use:
                if i < 0:
                    base.append((last + 1 - size, self.phrases[-1 - i].label))
                    continue
                notice = self.notices[i]
                first = last + 1 - size - at
                # One more on either side: the borders that the match stands between.
                windows.setdefault(i, set()).add((max(0, first - notice.errors - 1), first + len(notice.text) + notice.errors + 1))
        spans = [m for i, found in windows.items() for m in self._verify(i, line, found)]
        if base or spans:
            word_at = _Places(line)
            base = [(word_at(a + 1), label) for a, label in base]
            if spans:
                spans = _clearest(spans)
                place = [m.span() for m in WORD.finditer(lower)]
                spans = [
                    (n.label, n.text, e, f, z, place[f][0], place[z][1])
                    for n, e, a, b in spans for f, z in [(word_at(a), word_at(b - 1))]
                ]
        return len(words), base, sorted(spans, key=lambda s: s[3:5] + s[:3])

    def _verify(self, i: int, line: str, windows: set[tuple[int, int]]) -> list[tuple]:
        """The places of one notice, those with fewer errors first chosen where they overlap.

        A window has room for one match only (a notice is longer than four times its errors and two), so its
        best match is, or overlaps and beats, the one that its seed belongs to.
        """
        notice, found = self.notices[i], set()
        for a, b in windows:
            if m := self.patterns[i].search(line, a, min(b, len(line))):
                found.add((sum(m.fuzzy_counts), m.start(), m.end()))
        taken: list[tuple[int, int, int]] = []  # in order of place, apart from each other
        for errors, a, b in sorted(found):
            j = bisect.bisect(taken, (a, b))
            if (j == 0 or taken[j - 1][1] <= a) and (j == len(taken) or b <= taken[j][0]):
                taken.insert(j, (a, b, errors))
        return [(notice, errors, a, b) for a, b, errors in taken]


def _clearest(spans: list[tuple]) -> list[tuple]:
    """Spans less those that overlap a span of another label with fewer errors."""
    spans = sorted(spans, key=lambda s: s[2:])
    starts, longest = [s[2] for s in spans], max(s[3] - s[2] for s in spans)

    def beaten(s: tuple) -> bool:
        near = spans[bisect.bisect_left(starts, s[2] - longest) : bisect.bisect_left(starts, s[3])]
        return any(t[1] < s[1] and t[3] > s[2] and t[0].label != s[0].label for t in near)

    return [s for s in spans if not beaten(s)]


class _Places:
    """Number of the word that a character of the line belongs to."""

    def __init__(self, line: str) -> None:
        self.line, self.at, self.word = line, 1, 0

    def __call__(self, char: int) -> int:
        if char < self.at:
            self.at, self.word = 1, 0
        self.word += self.line.count(" ", self.at, char)
        self.at = char
        return self.word


@cache
def _scanner(phrases: tuple[Phrase, ...], notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(phrases, notices)


def scan(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), phrases: tuple[Phrase, ...] = PHRASES, notices: tuple[Notice, ...] = NOTICES
) -> DataFrame:
    """``keep`` columns, counts and labels of every whole text, and the spans of the notices found in it.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are the first
    and last word that one begins with. ``labels`` adds those of the notices to ``base_labels``.
    ``score`` is 1 where a phrase stands, else the best span's share of characters without error,
    else 0.
    """
    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("_text"))
    kept = picked.schema.fields[:-1]
    names = [f.name for f in kept] + [c.split()[0] for c in RESULT.split(", spans")[0].split(", ")] + ["spans"]
    span_type = pa.list_(pa.struct([(c.split()[0], {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[c.split()[1]]) for c in SPAN.split(", ")]))
    keys = [c.split()[0] for c in SPAN.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(phrases, notices)
        for batch in batches:
            rows = [scanner.scan(t.as_py() or "") for t in batch.column(len(kept))]
            starts = [[w for w, _ in base] for _, base, _ in rows]
            own = [{label for _, label in base} for _, base, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array([len(base) for _, base, _ in rows], pa.int64()),
                    pa.array([min(s, default=None) for s in starts], pa.int64()),
                    pa.array([max(s, default=None) for s in starts], pa.int64()),
                    pa.array([",".join(sorted(o)) for o in own], pa.string()),
                    pa.array([",".join(sorted(o | {s[0] for s in spans})) for o, (_, _, spans) in zip(own, rows)], pa.string()),
                    pa.array([1.0 if base else max((1 - s[2] / len(s[1]) for s in spans), default=0.0) for _, base, spans in rows], pa.float64()),
                    pa.array([[dict(zip(keys, s)) for s in spans] for _, _, spans in rows], span_type),
                ],
                names=names,
            )

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return picked.mapInArrow(run, head + RESULT)
