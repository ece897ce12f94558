"""License scan: short notices with a bounded number of errors (operator 3).

Texts are lower-cased (A-Z) and reduced to words of letters, digits and
non-ASCII characters, joined by one space.  Each notice may occur with up to
``errors`` edits, of which a word of the notice takes at most one for every
``LETTERS_AN_EDIT`` letters: one edit makes another word of a short one ("mit"
and "kit", "bsd" and "bad"), so short words must stand as they are.  Cut into ``errors + 1`` pieces, one piece of it must occur
unchanged (pigeonhole), so exact searches for the pieces find all places where
a match can lie; there the regex library's bounded-error matching decides and
gives the span and the number of edits.  A match begins and ends with words.

The base phrases are counted exactly, word by word, beside it.

Defined results: null and empty texts have no words, no labels and score 0;
the score is 1 with a base phrase, else ``1 - edits / length`` of the best
match; rows that repeat are scanned alike; an empty table gives no rows; extra
columns are ignored.  Texts are scanned in place, one pass, no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from storefront_etl.llm.common import per_batch, table

# The phrases that are counted, and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# The notices that are searched with errors: text, label, edits.
NOTICES = (
    ("gnu general public license", "gpl", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("under the terms of the gnu general public license as published by the free software foundation", "gpl", 6),
    ("apache license", "apache", 2),
    ("licensed under the apache license version 2 0", "apache", 3),
    ("mit license", "mit", 1),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 5),
    ("bsd license", "bsd", 1),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 6),
    ("mozilla public license", "mpl", 2),
    ("creative commons attribution", "cc-by", 3),
)
LETTERS_AN_EDIT = 5

_BLANK = re.compile(b" ")
_TO_SPACE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)


def normalised(text: str | None) -> bytes:
    """The words of a text, lower-cased, joined by one space."""
    spaced = (text or "").encode("utf-8", "surrogatepass").translate(_TO_SPACE)
    return b" ".join(spaced.split())  # no white space but blanks is left


def places(words: bytes, phrase: bytes) -> list[int]:
    """Byte positions where the phrase's words stand one after the other."""
    found, at = [], words.find(phrase)
    while at >= 0:
        end = at + len(phrase)
        if (at == 0 or words[at - 1] == 32) and (end == len(words) or words[end] == 32):
            found.append(at)
        at = words.find(phrase, at + 1)
    return found


def pieces(phrase: str, errors: int) -> list[tuple[int, bytes]]:
    """(offset, piece): the phrase in ``errors + 1`` parts of nearly equal length."""
    n = len(phrase)
    cuts = [n * k // (errors + 1) for k in range(errors + 2)]
    return [(a, phrase[a:b].encode()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@dataclass
class Notice:
    text: str
    label: str
    errors: int

    def __post_init__(self) -> None:
        self.seeds = pieces(self.text, self.errors)
        words = [(regex.escape(w), len(w) // LETTERS_AN_EDIT) for w in self.text.split()]
        parts = [f"(?:{w}){{e<={most}:[^ ]}}" if most else w for w, most in words]
        self.pattern = regex.compile(rf"(?e)(?<![^ ]){' '.join(parts)}(?![^ ])")

    def windows(self, words: bytes) -> list[tuple[int, int]]:
        """Byte ranges, widened to whole words, that hold every possible match."""
        # An inserted character has up to 4 bytes; one more edit's room keeps the neighbouring blank in.
        room = 4 * self.errors + 1
        found = []
        for offset, seed in self.seeds:
            at = words.find(seed)
            while at >= 0:
                lo, hi = max(0, at - offset - room), min(len(words), at - offset + len(self.text) + room)
                lo = words.rfind(b" ", 0, lo) + 1
                hi = words.find(b" ", hi)
                found.append((lo, len(words) if hi < 0 else hi))
                at = words.find(seed, at + 1)
        merged: list[tuple[int, int]] = []
        for lo, hi in sorted(found):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        return merged

    def matches(self, words: bytes, blanks: list[int]) -> list[tuple[int, int, int]]:
        """(first word, number of words, edits) of every match (``blanks``: the places between words)."""
        found = []
        for lo, hi in self.windows(words):
            part = words[lo:hi].decode("utf-8", "replace")
            before, at, seen = bisect_left(blanks, lo), 0, 0
            for m in self.pattern.finditer(part, overlapped=True):
                edits = sum(m.fuzzy_counts)
                seen += part.count(" ", at, m.start())
                at = m.start()
                if edits <= self.errors:
                    found.append((before + seen, m.group().count(" ") + 1, edits))
        return found


def scan(text: str | None, notices: list[Notice]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans."""
    words = normalised(text)
    blanks = [m.start() for m in _BLANK.finditer(words)]
    starts, base, labels, spans = [], set(), set(), []
    for phrase, label in BASE_PHRASES:
        at = places(words, phrase.encode())
        if at:
            base.add(label)
            starts += [bisect_left(blanks, p) for p in at]
    score = 1.0 if base else 0.0
    for notice in notices:
        for first, n, edits in notice.matches(words, blanks):
            labels.add(notice.label)
            spans.append({"label": notice.label, "first_word": first, "n_words": n, "edits": edits})
            score = max(score, 1.0 - edits / len(notice.text))
    return (
        len(blanks) + 1 if words else 0, len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | labels)), score, sorted(spans, key=lambda s: (s["first_word"], s["label"], s["n_words"])),
    )


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans")
SPAN = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int64())])


def scan_licenses(docs: DataFrame, notices: tuple = NOTICES) -> DataFrame:
    """doc_id, the counts, labels and ``spans`` (label, first_word, n_words, edits): one row per document."""
    compiled: list[Notice] = []

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        if not compiled:
            compiled.extend(Notice(*n) for n in notices)
        found = [scan(text, compiled) for text in part.column("text").to_pylist()]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(SPAN)]
        columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", *COLUMNS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "spans array<struct<label: string, first_word: long, n_words: long, edits: long>>"
    )
    return per_batch(docs.select("doc_id", "text"), "text", run, schema)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
