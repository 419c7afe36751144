"""License scans: exact places of short phrases, and short notices with a bounded number of edits.

A notice that may have k edits is split into k + 1 parts; text that matches with k edits holds one of them unchanged.
One pass of a string-set automaton over the text finds these parts (for exact phrases, k = 0, the phrase itself), and a
bounded-error pattern of the regex library then searches only the stretches around them and reports spans and edits.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hostvane.llm.shared import small_batches, texts

# Exact phrases, and wording of public license notices with the edits allowed (about one in 12 characters).
PHRASES = (("apache", "apache license"), ("gpl", "general public license"), ("mit", "mit license"))
NOTICES = (
    ("agpl", "gnu affero general public license", 2),
    ("apache", "licensed under the apache license version 2 0", 3),
    ("boost", "boost software license", 1),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    ("cc", "creative commons attribution", 2),
    ("epl", "eclipse public license", 1),
    ("gpl", "licensed under the gnu general public license", 3),
    ("gpl", "modify it under the terms of the gnu general public license", 5),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    ("lgpl", "gnu lesser general public license", 2),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("mit", "released under the mit license", 2),
    ("mpl", "mozilla public license", 1),
    ("unlicense", "free and unencumbered software released into the public domain", 5),
    ("zlib", "provided as is without any express or implied warranty", 4),
)

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label: string, first_word: long, n_words: long, edits: int>>"
)

#: Bytes of words stay, A-Z become a-z, all others become a space.
_FOLD = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def parts(notice: str, edits: int) -> list[tuple[int, str]]:
    """edits + 1 consecutive parts of nearly equal length, with their offsets."""
    cuts = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.notices = notices
        seeds: dict[str, list[tuple]] = {}
        for label, phrase in phrases:
            seeds.setdefault(f" {phrase} ", []).append((label, None, 0))
        for n, (label, notice, edits) in enumerate(notices):
            for offset, part in parts(notice, edits):
                seeds.setdefault(part, []).append((label, n, offset))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n)}){{e<={edits}}}") for _, n, edits in notices]

    def scan(self, text: str) -> tuple:
        """Values of SCHEMA behind doc_id."""
        found = words(text)
        line = f" {b' '.join(found).decode()} " if found else ""
        base: list[tuple[int, str]] = []
        near: dict[int, list[tuple[int, int]]] = {}  # by notice, stretches to search
        for end, (length, uses) in self.automaton.iter(line):
            for label, notice, offset in uses:
                start = end + 1 - length
                if notice is None:
                    base.append((start, label))
                    continue
                _, wording, edits = self.notices[notice]
                left = start - offset - edits
                near.setdefault(notice, []).append((max(0, left), left + len(wording) + 2 * edits))
        spans = []
        for notice, stretches in near.items():
            label, wording, _ = self.notices[notice]
            for at, end, edits in self._matches(self.patterns[notice], line, merged(stretches)):
                n_words = len(line[at:end].split())
                spans.append((at, label, n_words, edits, 1 - edits / len(wording)))
        base_labels = sorted({label for _, label in base})
        labels = sorted({*base_labels, *(s[1] for s in spans)})
        score = 1.0 if base else max((s[4] for s in spans), default=0.0)
        at = [line.count(" ", 0, start) for start, _ in (min(base), max(base))] if base else [None, None]
        shown = [
            {"label": label, "first_word": max(0, line.count(" ", 0, at_ + (line[at_] == " ")) - 1), "n_words": n, "edits": edits}
            for at_, label, n, edits, _ in sorted(spans)
        ]
        return len(found), len(base), *at, ",".join(base_labels), ",".join(labels), score, shown

    @staticmethod
    def _matches(pattern, line: str, stretches: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """(start, end, edits): the best match of every stretch, then those on either side of it."""
        while stretches:
            left, right = stretches.pop()
            if match := pattern.search(line, left, right):
                yield match.start(), match.end(), sum(match.fuzzy_counts)
                stretches += [(left, match.start()), (match.end(), right)]


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for left, right in sorted(stretches):
        if out and left <= out[-1][1]:
            out[-1] = (out[-1][0], max(right, out[-1][1]))
        else:
            out.append((left, right))
    return out


@functools.cache
def scanner() -> Scanner:
    return Scanner()


def license_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: numbers and places of exact phrases, labels, score, and spans of notices (see SCHEMA).

    Whole texts, A-Z lower-cased, as words of digits, a-z and characters beyond ASCII. Null text is empty: no words,
    empty labels, score 0. Null and repeated ids and repeated rows give a row each; other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        kinds.append(pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32())])))
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in small_batches(batches):
            columns = zip(*map(scanner().scan, texts(batch)), strict=True)
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scan, SCHEMA)
