"""License scans: a fuzzy search for short notices.

A text becomes its words, lower-cased and one blank apart. A notice of ``m`` characters
may have ``m // 10`` edits (a character put in, left out or replaced); it is split into
one piece more than that, so that every place where it stands has a piece unchanged. The
pieces are searched exactly; from every word near enough before a piece the regex
library's bounded-error matching tells whether the notice stands there, with how few
edits, and where it ends. Notices begin and end with words of the text, and their words
of fewer than five letters must be among them as they are: "emit license" is no notice.

Everything is done row by row, on whole texts; nothing is shuffled. A long text is
searched in one piece; memory grows with the longest text only.

Defined results: NULL and empty texts have no words and no notices; places may overlap,
but one that overlaps a place of the same notice with fewer edits is left out; ties go to
the place that starts first, unless both have no edits; rows are taken one by one, so
repeated rows, missing identifiers and extra columns change nothing, and
``find_notices`` keeps all columns but those it adds.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.llm.columns import free_name
from florin.llm.shipping import ship_package
from florin.llm.textbytes import byte_set, flat, folded_ascii, slices

# The phrases whose exact places are counted, with their labels.
BASE = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]
# Notices and labels of the scan's own; phrases are words one blank apart.
NOTICES = [
    *BASE,
    ("bsd license", "bsd"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"),
    ("creative commons", "cc"),
    ("cc by", "cc"),
    ("all rights reserved", "reserved"),
]
CHARACTERS_PER_EDIT = 10
SHORT_WORD = 5  # a word of fewer letters must stand as it is

IN_WORD = byte_set(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
FOLDED = folded_ascii()
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")

SPAN = "struct<label:string,phrase:string,word:long,start:long,end:long,edits:int,text:string>"


def allowed_edits(phrase: str) -> int:
    return len(phrase) // CHARACTERS_PER_EDIT


def pieces(phrase: str) -> list[tuple[int, str]]:
    """(offset, piece): one more than edits are allowed, of nearly equal length."""
    n = allowed_edits(phrase) + 1
    borders = [len(phrase) * i // n for i in range(n + 1)]
    return [(a, phrase[a:b]) for a, b in zip(borders, borders[1:], strict=False)]


@dataclass(frozen=True)
class Place:
    """A notice in a word stream: first byte, byte after the last, edits."""

    phrase: str
    start: int
    end: int
    edits: int


class Scan:
    """Searches word streams for notices; a stream is UTF-8, words one blank apart, texts one line feed apart."""

    def __init__(self, phrases: Iterable[str]):
        self.notices = []
        for phrase in phrases:
            edits = allowed_edits(phrase)
            bound = f"{{e<={edits}}}" if edits else ""
            pattern = regex.compile(f"(?b)(?:{regex.escape(phrase, literal_spaces=True)}){bound}(?<=[^ ])(?![^ ])")
            seeds = [(len(phrase[:at].encode()), piece.encode()) for at, piece in pieces(phrase)]
            short = {w for w in phrase.split(" ") if len(w) < SHORT_WORD}
            self.notices.append((phrase, edits, seeds, pattern, short))

    def places(self, stream: bytes) -> list[Place]:
        return [p for notice in self.notices for p in self._of_one(stream, *notice)]

    def _of_one(self, stream: bytes, phrase: str, edits: int, seeds: list, pattern: regex.Pattern, short: set) -> list[Place]:
        slack = 4 * edits  # bytes that so many characters may take
        reach = 4 * (len(phrase) + edits) + 4
        tried: dict[int, Place | None] = {}
        for offset, seed in seeds:
            hit = stream.find(seed)
            while hit >= 0:
                for start in self._word_starts(stream, max(0, hit - offset - slack), min(hit, hit - offset + slack)):
                    if start not in tried:
                        tried[start] = self._verified(stream, start, reach, phrase, pattern, short)
                hit = stream.find(seed, hit + 1)
        return self._distinct([p for p in tried.values() if p])

    @staticmethod
    def _word_starts(stream: bytes, first: int, last: int) -> list[int]:
        return [i for i in range(first, last + 1) if i == 0 or stream[i - 1] in b" \n"]

    @staticmethod
    def _verified(stream: bytes, start: int, reach: int, phrase: str, pattern: regex.Pattern, short: set) -> Place | None:
        stop = stream.find(b"\n", start, start + reach)
        window = stream[start : stop if stop >= 0 else start + reach].decode(errors="ignore")
        match = pattern.match(window)
        if not match or not short <= set(match[0].split(" ")):
            return None
        return Place(phrase, start, start + len(match[0].encode()), sum(match.fuzzy_counts))

    @staticmethod
    def _distinct(found: list[Place]) -> list[Place]:
        """Without places that overlap a better one."""
        kept: list[Place] = []
        for place in sorted(found, key=lambda p: (p.edits, p.start)):
            if not place.edits or all(place.end <= p.start or p.end <= place.start for p in kept):
                kept.append(place)
        return sorted(kept, key=lambda p: p.start)


def word_streams(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The word stream of many texts, where each text begins in it, and how many words each has."""
    inside = IN_WORD[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    last = inside & ~np.concatenate([inside[1:], [False]])[: len(inside)] if len(inside) else inside
    last |= inside & border[1:] if len(inside) else inside
    # A word takes its bytes and one more, a text one more.
    taken = np.concatenate([[0], np.cumsum(inside.astype(np.int64) + last)])
    begins = taken[offsets] + np.arange(len(offsets))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    stream = np.full(int(begins[-1]), 32, np.uint8)
    stream[taken[:-1][inside] + text[inside]] = FOLDED[data][inside]
    stream[begins[1:] - 1] = 10
    words = np.concatenate([[0], np.cumsum(last)])
    return stream.tobytes(), begins, np.diff(words[offsets])


def _spans(text: str, stream: bytes, begin: int, places: list[Place], label_of: dict[str, str]) -> list[dict]:
    """Places as spans of the text itself, in characters."""
    words = list(WORD.finditer(text))
    found = []
    for place in places:
        word = stream.count(b" ", begin, place.start)
        last = word + stream.count(b" ", place.start, place.end)
        start, end = words[word].start(), words[last].end()
        found.append(
            {
                "label": label_of[place.phrase],
                "phrase": place.phrase,
                "word": word,
                "start": start,
                "end": end,
                "edits": place.edits,
                "text": text[start:end],
            }
        )
    return sorted(found, key=lambda s: (s["word"], s["phrase"]))


def find_notices(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """``docs`` with n_words and notices: label, phrase, first word, span in characters, edits and text of each."""
    ship_package(docs.sparkSession)
    label_of = dict(notices)

    @F.arrow_udf(f"struct<n_words:long,notices:array<{SPAN}>>")
    def scanned(texts: pa.Array) -> pa.Array:
        scan = Scan(label_of)
        rows: list[dict] = []
        for start, stop in slices(texts):
            part = texts[start:stop]
            stream, begins, n_words = word_streams(*flat(part))
            by_text: dict[int, list[Place]] = {}
            for place in scan.places(stream):
                by_text.setdefault(int(np.searchsorted(begins, place.start, side="right")) - 1, []).append(place)
            for i, n in enumerate(n_words.tolist()):
                here = by_text.get(i)
                spans = _spans(part[i].as_py(), stream, int(begins[i]), here, label_of) if here else []
                rows.append({"n_words": n, "notices": spans})
        span = pa.struct(
            [("label", pa.string()), ("phrase", pa.string()), ("word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("text", pa.string())]
        )
        return pa.array(rows, pa.struct([("n_words", pa.int64()), ("notices", pa.list_(span))]))

    own = free_name(docs, "found")
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_words", "notices")]
    found = docs.select(*rest, scanned(F.col("text")).alias(own))
    return found.select(*rest, f"{own}.n_words", f"{own}.notices")


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    base = F.filter("notices", lambda s: (s["edits"] == 0) & s["phrase"].isin([phrase for phrase, _ in BASE]))
    found = find_notices(docs.select("doc_id", "text")).select("doc_id", "n_words", "notices", base.alias("base"))
    words = F.transform("base", lambda s: s["word"])

    def labels(spans: str):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    likeness = F.transform("notices", lambda s: F.lit(1.0) - s["edits"] / F.length(s["phrase"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        labels("base").alias("base_labels"),
        labels("notices").alias("labels"),
        F.coalesce(F.array_max(likeness), F.lit(0.0)).alias("score"),
    )
