"""License notices, also misspelt ones: exact seeds locate candidates, bounded-error matching verifies.

A text becomes its words, A-Z lower-cased, joined by one space; a word is a run of ASCII
letters, digits and all characters beyond ASCII. A notice of ``edits`` allowed errors is cut into
``edits + 1`` seeds: by the pigeonhole principle one of them is intact in each occurrence.
One Aho-Corasick automaton finds all seeds in one pass over the whole text; around each of
them the ``regex`` library looks for the notice with 0, 1, ... ``edits`` errors (characters
inserted, deleted or replaced), beginning and ending with words. The first bound that
matches is the number of errors.

Places of a base phrase without an error count as base and carry its label. The method's own
labels: a base phrase with errors has its label and ``~``; the longer notices have theirs.
``score`` is the best match's share of characters without error, 0 without a match.

Null text counts as empty: no words, no matches. Each row is judged on its own, so ids may be
null or repeat, and a row listed twice is scanned twice. An empty table gives no rows. Long
texts are read whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from rawstar.llm.common import short_batches

FOUND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, matches array<struct<label:string,edits:int,first_word:long,last_word:long,s:long,e:long>>"
)


@dataclass(frozen=True)
class Notice:
    """``words`` are lower-cased words joined by one space."""

    words: str
    label: str
    base: bool = False

    @property
    def edits(self) -> int:
        """One error for every ten characters, three at most."""
        return min(3, len(self.words) // 10)

    @property
    def near_label(self) -> str:
        return self.label + "~" if self.base else self.label


# The base phrases, then the opening words of common notices.
NOTICES = (
    Notice("gnu general public license", "gpl", True),
    Notice("apache license", "apache", True),
    Notice("cc by", "cc-by", True),
    Notice("mit license", "mit", True),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit-notice"),
    Notice("redistribution and use in source and binary forms", "bsd-notice"),
    Notice("you may not use this file except in compliance with the license", "apache-notice"),
    Notice("this program is free software you can redistribute it and or modify it", "gpl-notice"),
    Notice("gnu lesser general public license", "lgpl-notice"),
    Notice("mozilla public license", "mpl-notice"),
    Notice("creative commons attribution", "cc-notice"),
    Notice("all rights reserved", "rights-notice"),
)

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Search:
    """Finds ``notices`` in normalised texts."""

    def __init__(self, notices: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.notices = notices
        self.bounded = [
            [regex.compile(f"(?<= )(?:{regex.escape(n.words, special_only=True)}){{e<={k}}}(?= )") for k in range(1, n.edits + 1)]
            for n in notices
        ]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            size, parts = len(notice.words), notice.edits + 1
            cuts = [size * i // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(notice.words[a:b], []).append((number, a))
        self.seeds = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.seeds.add_word(seed, (len(seed), uses))
        self.seeds.make_automaton()
        # Common passages are verified once for each worker.
        self.verify = lru_cache(100_000)(self._verify)

    def _verify(self, number: int, window: str) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best match in ``window``."""
        for edits, pattern in enumerate(self.bounded[number], 1):
            found = pattern.search(window)
            if found:
                return edits, *found.span()
        return None

    def find(self, line: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) in ``line``, words between single spaces, one at each end."""
        found: dict[tuple[int, int, int], int] = {}
        for last, (length, uses) in self.seeds.iter(line):
            for number, offset in uses:
                notice = self.notices[number]
                size, edits = len(notice.words), notice.edits
                start = last + 1 - length - offset
                end = start + size
                if start > 0 and line.startswith(notice.words, start) and line[start - 1] == line[end] == " ":
                    found[start, end, number] = 0
                    continue
                begin = max(0, start - edits - 1)
                near = self.verify(number, line[begin : end + edits + 1]) if edits else None
                if near:
                    found.setdefault((begin + near[1], begin + near[2], number), near[0])
        return sorted((*place, edits) for place, edits in found.items())


@lru_cache(4)
def _search(notices: tuple[Notice, ...]) -> Search:
    """One for each worker process."""
    return Search(notices)


def _row(search: Search, text: bytes) -> tuple:
    words = words_of(text)
    line = b" ".join([b"", *words, b""]).decode(errors="replace")
    places = search.find(line)
    if not places:
        return len(words), 0, None, None, "", "", 0.0, []
    spans = [m.span() for m in _WORD.finditer(text.decode(errors="replace"))]
    matches, base, labels, score = [], [], set(), 0.0
    word, upto = 0, 1
    for start, end, number, edits in places:
        # The number of words before ``start``: places ascend, so each space is counted once.
        word, upto = word + line.count(" ", upto, start), start
        last = word + line.count(" ", start, end)
        notice = search.notices[number]
        label = notice.near_label if edits else notice.label
        matches.append((label, edits, word, last, spans[word][0], spans[last][1]))
        labels.add(label)
        score = max(score, 1 - edits / len(notice.words))
        if notice.base and not edits:
            base.append((word, label))
    listed = ",".join(sorted({label for _, label in base}))
    first, final = (base[0][0], base[-1][0]) if base else (None, None)
    return len(words), len(base), first, final, listed, ",".join(sorted(labels)), score, matches


def find_notices(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text); see ``FOUND``. Spans are code points, the end exclusive."""
    short_batches(docs.sparkSession)
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
    names = ["label", "edits", "first_word", "last_word", "s", "e"]
    match = pa.struct(list(zip(names, [pa.string(), pa.int32()] + [pa.int64()] * 4)))

    def run(batches):
        search = _search(notices)
        for batch in batches:
            rows = [_row(search, t or b"") for t in batch.column("text").to_pylist()]
            columns = list(zip(*rows)) or [()] * 8
            listed = [[dict(zip(names, m)) for m in row] for row in columns[7]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns[:7], kinds[1:])], pa.array(listed, pa.list_(match))],
                names=[x.split()[0] for x in FOUND.split(", ")],
            )

    return docs.selectExpr("doc_id", "cast(text as binary) as text").mapInArrow(run, FOUND)
