"""License scans: exact phrases, and short notices found with a bounded number of character edits.

A notice that may differ in k characters is cut into k + 1 seeds: with at most k edits one seed is intact
(pigeonhole). One automaton finds the seeds of all notices in a text; around each hit the regex library's
bounded-error matching decides and reports the span. A text without a seed costs one automaton pass. The words
that tell a notice from its rivals (name, variant, version) must stand unchanged, whole and in their place; edits
are allowed in the rest.

Texts are compared as words: A-Z lower-cased, every run of other ASCII characters than digits and letters one
separator, characters beyond ASCII part of words. Spans are word numbers, first and last included. The scan is
a map over whole texts without a shuffle.

Defined cases: a null or empty text has no words and no spans; notices that repeat are each reported; of matches
of one notice that overlap, and of notices that share more than half of the shorter one, the likeliest is;
repeated rows are scanned each; only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import groupby

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.llm.common import col, with_package

#: Phrases of the contract: words and label. Fixed values.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

#: Notices searched with errors: label and words. Words in brackets (name, variant, version) tell a notice from its
#: rivals and must stand as they are.
NOTICES = (
    ("agpl-3.0", "licensed under the gnu [affero] general public license version [3]"),
    ("apache-1.1", "licensed under the [apache] license version [1 1]"),
    ("apache-2.0", "licensed under the [apache] license version [2 0]"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "released under the [bsd] license"),
    ("cc-by", "licensed under [cc by 4 0]"),
    ("cc-by-nc", "licensed under [cc by nc 4 0]"),
    ("cc-by-nc-nd", "licensed under [cc by nc nd 4 0]"),
    ("cc-by-nc-sa", "licensed under [cc by nc sa 4 0]"),
    ("cc-by-nd", "licensed under [cc by nd 4 0]"),
    ("cc-by-sa", "licensed under [cc by sa 4 0]"),
    ("gpl-2.0", "licensed under the [gnu] general public license version [2]"),
    ("gpl-3.0", "licensed under the [gnu] general public license version [3]"),
    ("isc", "released under the [isc] license"),
    ("lgpl-2.1", "licensed under the gnu [lesser] general public license version [2 1]"),
    ("lgpl-3.0", "licensed under the gnu [lesser] general public license version [3]"),
    ("mit", "released under the [mit] license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl-1.1", "subject to the terms of the [mozilla] public license v [1 1]"),
    ("mpl-2.0", "subject to the terms of the [mozilla] public license v [2 0]"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("x11", "released under the [x11] license"),
)
#: One edit is allowed for so many characters of a notice.
CHARS_PER_ERROR = 10
MOST_ERRORS = 6

_SEPARATE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
            T.StructField("errors", T.IntegerType()),
            T.StructField("exact", T.BooleanType()),
            T.StructField("likeness", T.DoubleType()),
        ]
    )
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_SEPARATE).split()


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    errors: int
    required: tuple[str, ...]
    pattern: regex.Pattern

    def seeds(self) -> Iterator[tuple[str, int]]:
        """Pieces of nearly equal length and their offsets in the notice."""
        parts, size = self.errors + 1, len(self.text)
        for i in range(parts):
            a, b = i * size // parts, (i + 1) * size // parts
            yield self.text[a:b], a

    def search(self, line: str, start: int) -> regex.Match | None:
        """The best match near a place that keeps the required words and the bound of errors."""
        low, high = max(0, start - self.errors), start + len(self.text) + self.errors
        # one character more on the right, for the blank after a required last word
        if any(line.find(f" {r} ", max(0, low - 1), high + 1) < 0 for r in self.required):
            return None
        found = self.pattern.search(line, low, high + 1)
        return found if found and sum(found.fuzzy_counts) <= self.errors else None


def notice(label: str, words: str) -> Notice:
    text = words.replace("[", "").replace("]", "")
    errors = min(MOST_ERRORS, len(text) // CHARS_PER_ERROR)
    free, required = [], []
    for i, part in enumerate(words.replace("]", "[").split("[")):
        if i % 2:
            required.append(part)
            free.append(f"(?<= ){regex.escape(part)}(?= )")
        elif part:
            free.append(f"(?:{regex.escape(part)}){{e<={errors}}}")
    return Notice(label, text, errors, tuple(required), regex.compile("(?b)" + "".join(free)))


class Scanner:
    def __init__(self, phrases=PHRASES, notices=NOTICES) -> None:
        self.phrases = [(f" {p} ", label) for p, label in phrases]
        self.notices = [notice(label, text) for label, text in notices]
        at: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(self.notices):
            for seed, offset in n.seeds():
                at.setdefault(seed, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for seed, places in at.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()

    def exact(self, line: str) -> Iterator[tuple[int, int, str]]:
        for phrase, label in self.phrases:
            at = line.find(phrase)
            while at >= 0:
                yield at + 1, at + len(phrase) - 1, label
                at = line.find(phrase, at + 1)

    def fuzzy(self, line: str) -> Iterator[tuple[int, int, Notice, int]]:
        """Distinct bounded-error matches: start, end, notice and errors."""
        tried, seen = set(), set()
        for end, (size, places) in self.seeds.iter(line):
            for i, offset in places:
                n = self.notices[i]
                start = end - size + 1 - offset
                if (i, start) in tried:
                    continue
                tried.add((i, start))
                found = n.search(line, start)
                if found and (i, found.start(), found.end()) not in seen:
                    seen.add((i, found.start(), found.end()))
                    yield found.start(), found.end(), n, sum(found.fuzzy_counts)

    def scan(self, text: str) -> tuple[int, list[tuple]]:
        """Number of words and the spans in order."""
        found = words(text)
        line = " " + b" ".join(found).decode("latin-1") + " "
        spans = [(a, b, label, 0, True, 1.0) for a, b, label in self.exact(line)]
        # matches of one notice that overlap are one place: the one with the fewest errors stays
        matches = sorted(self.fuzzy(line), key=lambda m: (m[2].text, m[0]))
        places = [m for _, group in groupby(matches, lambda m: m[2].text) for m in _apart(group, 0)]
        # notices that share more than half of the shorter one are rivals for a place: the likeliest stays
        kept = _apart(sorted(places, key=lambda m: m[0]), 0.5)
        spans = sorted([*spans, *((a, b, n.label, errors, False, 1.0 - errors / len(n.text)) for a, b, n, errors in kept)])
        return len(found), list(_in_words(line, spans))


def _apart(matches: Iterable[tuple], share: float) -> Iterator[tuple]:
    """Of matches by start, those that share no more than this part of the shorter one with a better one."""
    place: list[tuple] = []
    end = 0
    for m in matches:
        if place and m[0] >= end:
            yield from _best(place, share)
            place = []
        place.append(m)
        end = max(end, m[1])
    yield from _best(place, share)


def _best(place: list[tuple], share: float) -> list[tuple]:
    """Better is fewer errors for the length, then longer, then earlier."""
    taken: list[tuple] = []
    for m in sorted(place, key=lambda x: (x[3] / len(x[2].text), -len(x[2].text), x[0])):
        if all(min(m[1], x[1]) - max(m[0], x[0]) <= share * min(m[1] - m[0], x[1] - x[0]) for x in taken):
            taken.append(m)
    return taken


def _in_words(line: str, spans: list[tuple]) -> Iterator[tuple]:
    """Spans of characters as spans of words; the line is walked once."""
    at, seen = 1, 0
    for a, b, *rest in spans:
        a += line[a] == " "
        seen += line.count(" ", at, a)
        at = a
        last = seen + line.count(" ", a, max(a, b - (line[b - 1] == " ")))
        yield (rest[0], seen, last, *rest[1:])


@cache
def scanner() -> Scanner:
    return Scanner()


def _scan(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = [kind.value_type.field(i).name for i in range(kind.value_type.num_fields)]
    scan = scanner().scan
    for batch in batches:
        got = [scan(t or "") for t in batch.column(1).to_pylist()]
        spans = [[dict(zip(names, s, strict=True)) for s in x] for _, x in got]
        columns = [batch.column(0), pa.array([n for n, _ in got], pa.int64()), pa.array(spans, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words and the spans found."""
    from pyspark.sql.pandas.types import to_arrow_type

    with_package(docs.sparkSession)
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS)])
    kind = to_arrow_type(SPANS)
    return rows.mapInArrow(lambda it: _scan(it, kind), schema)


def summary(scanned: DataFrame) -> DataFrame:
    """Per row: counts, outer places and labels of the exact phrases, all labels and the best likeness."""
    exact = F.filter("spans", lambda s: s["exact"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    rows = scanned.select("doc_id", "n_words", "spans", exact.alias("exact"))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("exact").cast("long").alias("n_base"),
        F.array_min("exact.first_word").alias("first_word"),
        F.array_max("exact.first_word").alias("last_word"),
        joined(F.col("exact")).alias("base_labels"),
        joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max("spans.likeness"), F.lit(0.0)).alias("score"),
        F.size(F.filter("spans", lambda s: ~s["exact"])).cast("long").alias("n_notices"),
    )
