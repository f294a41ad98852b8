"""Benchmark decontamination by winnowing.

Of every ``w`` consecutive k-grams of words the one with the least hash is kept as a
fingerprint. With k + w - 1 = 10, two texts that share ten words keep the same
fingerprint inside them, so no shared window is missed. Fingerprints of the benchmark
and of the documents are matched; a match is extended to the windows that contain it,
and these are compared word by word.

The benchmark's fingerprints and windows reach the tasks as bit sets of fixed size,
which only sort out what cannot match; the exact comparison is a join that shuffles,
salted against passages that many documents hold.

Defined results: NULL and empty texts have no words and are clean; an item of fewer than
ten words is one window of its own length, an item without words none; repeated rows get
equal results, each its own row; items that share an identifier count once; an item
without one marks words but is not listed; an empty benchmark leaves all clean; a window
that several items hold counts for each; texts are read whole, a very long one by itself;
other columns do not matter, and ``clean`` carries them along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florin.llm.bitset import bitset_of, in_bitset
from florin.llm.columns import free_name
from florin.llm.textbytes import Words, byte_set, flat, folded_ascii, slices
from florin.session import cut_lineage

SPAN = 10  # words of a window
SALT = 16

IN_WORD = byte_set(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
FOLDED = folded_ascii()


def gram_size(span: int) -> tuple[int, int]:
    """(k, w) of the winnowing that finds every shared span of so many words."""
    k = (span + 1) // 2
    return k, span - k + 1


def fingerprints(words: Words, span: int) -> np.ndarray:
    """For every window of ``span`` words, by its first word, the least hash of its k-grams."""
    k, w = gram_size(span)
    grams = words.grams(k)
    n = max(0, len(words.hash) - span + 1)
    least = grams[:n].copy()
    for step in range(1, w):
        np.minimum(least, grams[step : step + n], out=least)
    return least


def window_starts(words: Words, span: int) -> np.ndarray:
    """Whether a window from each word on stays in the word's text."""
    n = max(0, len(words.hash) - span + 1)
    return words.text[:n] == words.text[span - 1 : span - 1 + n]


def _window_text(words: Words, folded: bytes, first: int, span: int) -> bytes:
    return b" ".join(folded[words.start[i] : words.end[i]] for i in range(first, first + span))


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, span, window, fingerprint, hash): every window of every item."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                data, offsets = flat(batch.column("text")[start:stop])
                words = Words(data, offsets, IN_WORD, FOLDED)
                folded = FOLDED[data].tobytes()
                n_words = np.diff(words.first)
                items = batch.column("item_id")[start:stop]
                for span in range(1, SPAN + 1):
                    own = (n_words >= SPAN) if span == SPAN else (n_words == span)
                    fits = window_starts(words, span)
                    at = np.flatnonzero(fits & own[words.text[: len(fits)]]) if len(fits) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            items.take(pa.array(words.text[at])),
                            pa.array(np.full(len(at), span, np.int32)),
                            pa.array([_window_text(words, folded, i, span).decode() for i in at], pa.string()),
                            pa.array(fingerprints(words, span)[at].view(np.int64)),
                            pa.array(words.grams(span)[at].view(np.int64)),
                        ],
                        names=["item_id", "span", "window", "fingerprint", "hash"],
                    )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"item_id {kind}, span int, window string, fingerprint long, hash long"
    return benchmark.select("item_id", "text").mapInArrow(windows, schema)


def _candidates(words: Words, span: int, known: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """First words of the windows whose fingerprint and whose words may be in the benchmark."""
    least = fingerprints(words, span)
    if not len(least):
        return np.zeros(0, np.int64)
    # A fingerprint is looked up once for the neighbouring windows that share it.
    new = np.concatenate([[True], least[1:] != least[:-1]])
    hit = in_bitset(known, least[new])[np.cumsum(new) - 1]
    at = np.flatnonzero(hit & window_starts(words, span))
    return at[in_bitset(windows, words.grams(span)[at])] if len(at) else at


def scanned(docs: DataFrame, spans: list[int], known: np.ndarray, windows: np.ndarray) -> DataFrame:
    """(doc_id, h, n_words, found): every row with its candidate windows (span, at, window)."""
    shared = docs.sparkSession.sparkContext.broadcast((known, windows))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, windows = shared.value
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                data, offsets = flat(batch.column("text")[start:stop])
                words = Words(data, offsets, IN_WORD, FOLDED)
                found: list[list[dict]] = [[] for _ in range(stop - start)]
                for span in spans:
                    for i in _candidates(words, span, known, windows).tolist():
                        text = int(words.text[i])
                        low, high = int(words.start[i]), int(words.end[i + span - 1])
                        one = Words(data[low:high], np.array([0, high - low]), IN_WORD, FOLDED)
                        window = _window_text(one, FOLDED[data[low:high]].tobytes(), 0, span).decode()
                        found[text].append({"span": span, "at": i - int(words.first[text]), "window": window})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[start:stop],
                        batch.column("h")[start:stop],
                        pa.array(np.diff(words.first).astype(np.int64)),
                        pa.array(found, pa.list_(pa.struct([("span", pa.int32()), ("at", pa.int64()), ("window", pa.string())]))),
                    ],
                    names=["doc_id", "h", "n_words", "found"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").mapInArrow(
        scan, f"doc_id {kind}, h long, n_words long, found array<struct<span:int,at:long,window:string>>"
    )


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of ``docs``."""
    return contamination(docs, benchmark).drop("h")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The same with ``h``, the text's xxhash64, which tells rows of one doc_id apart."""
    item_windows = cut_lineage(benchmark_windows(benchmark))
    spans = sorted(r["span"] for r in item_windows.select("span").distinct().collect())
    known, windows = bitset_of(item_windows, "fingerprint"), bitset_of(item_windows, "hash")
    # Numbers of rows already written; by them copies of one text are told apart and dealt out.
    rows = cut_lineage(scanned(docs, spans, known, windows)).withColumn("row", F.monotonically_increasing_id())

    salted = rows.where(F.size("found") > 0).select("row", F.inline("found"))
    salted = salted.withColumn("salt", F.pmod("row", F.lit(SALT)).cast("int"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    owned = item_windows.groupBy("span", "window").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hits = salted.join(owned.select("*", every_salt), ["span", "window", "salt"])

    places = F.array_sort(F.collect_set(F.struct("at", "span")))
    by_row = hits.groupBy("row").agg(
        places.alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    zero = F.lit(0).cast("long")
    covered = F.aggregate(
        "places",
        F.struct(zero.alias("end"), zero.alias("n")),
        lambda s, p: F.struct(
            F.greatest(s["end"], p["at"] + p["span"]).alias("end"),
            (s["n"] + F.greatest(zero, p["at"] + p["span"] - F.greatest(s["end"], p["at"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    by_row = by_row.select("row", covered.alias("n_hit"), "items")
    whole = rows.select("row", "doc_id", "h", "n_words").join(by_row, "row", "left")
    n_hit = F.coalesce("n_hit", zero)
    items = F.coalesce("items", F.array().cast("array<string>"))
    return whole.select(
        "doc_id",
        "h",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark."""
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")
    dirty = contamination(docs, benchmark).where("contaminated").select("doc_id", "h").distinct().select("*", every_salt)
    own, salt = free_name(docs, "_h"), free_name(docs, "_salt")
    marked = docs.withColumn(own, F.xxhash64("text")).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALT)))
    same = docs["doc_id"].eqNullSafe(dirty["doc_id"]) & (F.col(own) == dirty["h"]) & (F.col(salt) == dirty["salt"])
    return marked.join(dirty, same, "left_anti").drop(own, salt)
