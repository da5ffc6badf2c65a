"""License scans: short notices found in spite of a few edits.

Text and notices are compared as words in lower case joined by single blanks. A
notice of L characters may differ by k = L // 10 edits. Cut into k + 1 pieces,
at least one piece stands unchanged in every place that differs by at most k
edits; an automaton over all pieces finds these seeds. Around each seed the
regex library matches the notice with bounded errors, fewest first, so the
edits reported for a place are the least.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import append_columns


@dataclass(frozen=True)
class Notice:
    label: str
    text: str

    @property
    def edits(self) -> int:
        return len(self.text) // 10


# Phrases and the labels that they stand for.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Wordings by which licences are commonly named.
NOTICES = (
    Notice("mit", "released under the mit license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Notice("apache", "licensed under the apache license version 2 0"),
    Notice("apache", "you may not use this file except in compliance with the license"),
    Notice("gpl", "licensed under the gnu general public license"),
    Notice("gpl", "this program is free software you can redistribute it and or modify it"),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("agpl", "gnu affero general public license"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("mpl", "subject to the terms of the mozilla public license"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice("cc-by", "licensed under a creative commons attribution license"),
    Notice("cc-by-nc", "licensed under cc by nc 4 0"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain"),
)
FOUND = (
    "n_words long, base array<struct<first_word:bigint,label:string>>, "
    "hits array<struct<label:string,notice:int,first_word:bigint,last_word:bigint,edits:int,score:double,text:string>>"
)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_BLANKS = re.compile(rb"  +")


def normalised(text: str | None) -> str:
    """A blank, then each word in lower case (A-Z) with a blank after it."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    return _BLANKS.sub(b" ", b" " + raw + b" ").decode("utf-8", "surrogatepass")


def pieces_of(notice: Notice) -> list[tuple[int, str]]:
    """(place, piece): one more piece than edits are allowed, of nearly equal length."""
    n, k = len(notice.text), notice.edits + 1
    cuts = [n * i // k for i in range(k + 1)]
    return [(a, notice.text[a:b]) for a, b in zip(cuts, cuts[1:])]


class Finder:
    """Seeds of all notices in one automaton, and the patterns that verify them."""

    def __init__(self, notices: tuple[Notice, ...]):
        import ahocorasick
        import regex

        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for place, piece in pieces_of(notice):
                seeds.setdefault(piece, []).append((number, place))
        self.seeds = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.seeds.add_word(piece, (len(piece), uses))
        self.seeds.make_automaton()
        # whole words only: a blank before and after
        self.patterns = [
            [regex.compile(f"(?<= )(?:{regex.escape(n.text, literal_spaces=True)}){{e<={k}}}(?= )") for k in range(n.edits + 1)]
            for n in notices
        ]

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """For each notice the stretches that a place of it could lie in, joined where they meet."""
        found: dict[int, list[tuple[int, int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            start = end + 1 - size
            for number, place in uses:
                notice = self.notices[number]
                first = max(0, start - place - notice.edits - 1)
                last = min(len(text), start - place + len(notice.text) + notice.edits + 1)
                found.setdefault(number, []).append((first, last))
        return {number: _joined(spans) for number, spans in found.items()}

    def places(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, edits) of places that do not overlap within a notice, those of fewest edits first taken."""
        out = []
        for number, spans in self.windows(text).items():
            gaps = spans
            for edits, pattern in enumerate(self.patterns[number]):
                left = []
                for a, b in gaps:
                    at = a
                    for m in pattern.finditer(text, a, b):
                        if m.end() > m.start():
                            out.append((number, m.start(), m.end(), edits))
                            left.append((at, m.start()))
                            at = m.end()
                    left.append((at, b))
                gaps = [g for g in left if g[1] > g[0]]
        return sorted(out)


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


@cache
def finder(notices: tuple[Notice, ...]) -> Finder:
    return Finder(notices)


def phrase_places(text: str, phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(start in characters, label) of every place where the words of a phrase stand one after the other."""
    out = []
    for phrase, label in phrases.items():
        at = text.find(f" {phrase} ")
        while at >= 0:
            out.append((at + 1, label))
            at = text.find(f" {phrase} ", at + 1)
    return sorted(out)


def word_numbers(text: str, places: list[int]) -> list[int]:
    """Number of the word that starts at each of the given ascending places of a normalised text."""
    out, at, n = [], 0, -1
    for place in places:
        n += text.count(" ", at, place)
        at = place
        out.append(n)
    return out


def scan(docs: DataFrame, text_col: str = "text", keep=None, notices: tuple[Notice, ...] = NOTICES, phrases=None) -> DataFrame:
    """`docs` with `FOUND`: the number of words, the phrases' places, and the notices' places with their edits.

    Words are runs of ASCII letters, digits and all beyond ASCII, A-Z as a-z. A
    null, empty or wordless text has no words and no places; every row stays a
    row, repeated ids too; an input column with the name of a new one is
    replaced by it. A text is searched whole, however long, as a copy in
    normal form. `score` of a place is 1 - edits / characters of the notice.
    """
    phrases = PHRASES if phrases is None else phrases

    def make(piece):
        counts, base, hits = [], [], []
        own = finder(notices)
        for text in piece.column("__text").to_pylist():
            text = normalised(text)
            counts.append(text.count(" ") - 1 if len(text) > 1 else 0)
            places = phrase_places(text, phrases)
            numbers = word_numbers(text, [p for p, _ in places])
            base.append([{"first_word": n, "label": label} for n, (_, label) in zip(numbers, places)])
            rows = []
            for number, start, end, edits in own.places(text):
                first, last = word_numbers(text, [start, end])
                notice = notices[number]
                rows.append({
                    "label": notice.label, "notice": number, "first_word": first, "last_word": last, "edits": edits,
                    "score": 1 - edits / len(notice.text), "text": text[start:end],
                })
            hits.append(rows)
        kinds = [pa.struct([("first_word", pa.int64()), ("label", pa.string())]), pa.struct([
            ("label", pa.string()), ("notice", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()),
            ("edits", pa.int32()), ("score", pa.float64()), ("text", pa.string()),
        ])]
        return [pa.array(counts, pa.int64()), pa.array(base, pa.list_(kinds[0])), pa.array(hits, pa.list_(kinds[1]))]

    return append_columns(docs, text_col, FOUND, make, keep)


def digests(scanned: DataFrame) -> DataFrame:
    """`scanned` with counts, labels and the best score in place of the places; a phrase's place scores 1."""
    starts = F.transform("base", lambda p: p["first_word"])
    base, more = F.transform("base", lambda p: p["label"]), F.transform("hits", lambda h: h["label"])

    def listed(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    best = F.coalesce(F.array_max(F.transform("hits", lambda h: h["score"])), F.lit(0.0))
    return scanned.withColumns({
        "n_base": F.size("base").cast("long"),
        "first_word": F.array_min(starts),
        "last_word": F.array_max(starts),
        "base_labels": listed(base),
        "labels": listed(F.concat(base, more)),
        "score": F.when(F.size("base") > 0, 1.0).otherwise(best),
    }).drop("base", "hits")
