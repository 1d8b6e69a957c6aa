"""License notices: exact phrases, and short notices with a few edits.

Texts are lower-cased (A-Z) and reduced to their words joined by single blanks. A notice with at
most e edits is split into e + 1 pieces; by the pigeonhole principle one of them stands in the
text unchanged. An Aho-Corasick automaton of all pieces finds these seeds, the window around each
is widened by the place of the piece and by e, and overlapping windows are joined. Inside them
the regex library finds the best match of the whole notice with bounded errors, and what lies
before and behind it is searched again, until nothing is left that matches.

Defined results: a null or empty text has no words and no places; equal labels count once in the
label lists; of equally good matches that overlap the first stays; a long text is scanned whole, in time
that grows with its length; repeated rows give repeated results; other columns are dropped; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import ALNUM, LOWER

# Phrases found exactly, and their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)


class Notice(NamedTuple):
    label: str
    text: str
    edits: int


NOTICES = (
    Notice("apache-2.0", "licensed under the apache license version 2 0", 4),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("mit", "released under the mit license", 2),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms", 7),
    Notice("gpl", "general public license", 2),
    Notice("mpl-2.0", "subject to the terms of the mozilla public license", 4),
    Notice("creative-commons", "creative commons attribution", 2),
    Notice("reserved", "all rights reserved", 2),
    Notice("spdx", "spdx license identifier", 2),
)

#: Lengths of a notice that are searched at a time.
STRETCH = 8

_TO_WORDS = bytes(int(LOWER[b]) if ALNUM[LOWER[b]] else 0x20 for b in range(256))


def pieces(notice: Notice) -> list[tuple[int, str]]:
    """The notice cut into edits + 1 parts of about the same length, each with its place."""
    cuts = np.linspace(0, len(notice.text), notice.edits + 2).round().astype(int)
    return [(int(a), notice.text[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


class Scanner:
    def __init__(self, notices: tuple[Notice, ...]) -> None:
        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, notice in enumerate(notices):
            for place, piece in pieces(notice):
                seeds.setdefault(piece, []).append((k, place))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()
        self.patterns = [regex.compile(f"(?b)(?:{regex.escape(n.text, literal_spaces=True)}){{e<={n.edits}}}") for n in notices]

    def fuzzy(self, words: str) -> list[tuple[int, int, int, int]]:
        """(notice, first character, end, edits) of the notices in a text of words."""
        windows: dict[int, list[list[int]]] = {}
        for last, (length, uses) in self.seeds.iter(words):
            for k, place in uses:
                notice = self.notices[k]
                low = max(0, last + 1 - length - place - notice.edits)
                high = min(len(words), low + len(notice.text) + 2 * notice.edits)
                mine = windows.setdefault(k, [])
                if mine and low <= mine[-1][1]:
                    mine[-1][0] = min(mine[-1][0], low)
                    mine[-1][1] = max(mine[-1][1], high)
                else:
                    mine.append([low, high])
        found = set()
        for k, mine in windows.items():
            for low, high in mine:
                found.update((k, *span) for span in self.matches(k, words, low, high))
        return sorted(found)

    def matches(self, k: int, words: str, low: int, high: int) -> Iterator[tuple[int, int, int]]:
        """(first character, end, edits) of a notice between two places: the best match, then the
        best ones before and behind it.

        The best match of each stretch of a few notices waits in a heap. One that overlaps a better one
        is sought again in what is left of its stretch, so the time grows with the places alone.
        """
        notice = self.notices[k]
        least, most = len(notice.text) - notice.edits, len(notice.text) + notice.edits
        heap: list[tuple[int, int, int, int, int]] = []
        taken: list[tuple[int, int]] = []

        def seek(low: int, high: int) -> None:
            match = self.patterns[k].search(words, low, high) if high - low >= least else None
            if match:
                heappush(heap, (sum(match.fuzzy_counts), match.start(), match.end(), low, high))

        for at in range(low, high, STRETCH * most):
            seek(at, min(high, at + (STRETCH + 1) * most))
        while heap:
            edits, start, end, low, high = heappop(heap)
            before = bisect_left(taken, (end,)) - 1
            if before >= 0 and taken[before][1] > start:
                better, behind = taken[before]
            else:
                better, behind = start, end
                insort(taken, (start, end))
                yield start, end, edits
            seek(low, min(better, high))
            seek(max(behind, low), high)


@lru_cache(maxsize=4)
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def exact_places(words: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase stands in words joined by blanks."""
    if phrase not in words:
        return []
    framed, wanted = b" " + words + b" ", b" " + phrase + b" "
    places, last, at = [], 0, framed.find(wanted)
    while at >= 0:
        places.append((places[-1] if places else 0) + framed.count(b" ", last, at))
        last, at = at, framed.find(wanted, at + 1)
    return places


def scan_text(text: str, notices: tuple[Notice, ...] = NOTICES) -> dict:
    """All results for one text."""
    words = b" ".join(text.encode().translate(_TO_WORDS).split())
    base = [(at, label) for phrase, label in PHRASES for at in exact_places(words, phrase.encode())]
    line = words.decode()
    scan = scanner(notices)
    found = scan.fuzzy(line)
    blanks = [m.start() for m in re.finditer(" ", line)] if found else []
    spans = [
        (notices[k].label, bisect_left(blanks, low), bisect_left(blanks, max(low, high - 1)) + 1, edits, edits / len(notices[k].text))
        for k, low, high, edits in found
    ]
    starts = [at for at, _ in base]
    base_labels = {label for _, label in base}
    return {
        "n_words": words.count(b" ") + 1 if words else 0,
        "n_base": len(base),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {label for label, *_ in spans})),
        "score": 1.0 if base else max((1.0 - share for *_, share in spans), default=0.0),
        "spans": [{"label": a, "start_word": b, "end_word": c, "edits": d} for a, b, c, d, _ in spans],
    }


_FIELDS = {
    "n_words": ("bigint", pa.int64()),
    "n_base": ("bigint", pa.int64()),
    "first_word": ("bigint", pa.int64()),
    "last_word": ("bigint", pa.int64()),
    "base_labels": ("string", pa.string()),
    "labels": ("string", pa.string()),
    "score": ("double", pa.float64()),
    "spans": (
        "array<struct<label:string,start_word:bigint,end_word:bigint,edits:bigint>>",
        pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int64())])),
    ),
}


def license_scan(df: DataFrame, notices: tuple[Notice, ...] = NOTICES, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Base places, labels, score and spans (words, edits) of every text."""
    schema = ", ".join(
        [*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} {kind}" for c, (kind, _) in _FIELDS.items())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.slice(low, 512)
                rows = [scan_text(value.as_py() or "", notices) for value in part.column(len(keep))]
                made = [pa.array([r[c] for r in rows], kind) for c, (_, kind) in _FIELDS.items()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*keep, *_FIELDS])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)
