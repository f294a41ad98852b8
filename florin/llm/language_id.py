"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts of order 0 to ``order`` with frozen
counts. A byte after a context costs -log2(count / (total + distinct)); a byte the
context has not seen costs the escape, -log2(distinct / (total + distinct)), and is
then looked up in the next shorter context, down to 1/256 for any byte. The language
whose tree gives a text the fewest bits wins. Every labelled language is learned, from a
bounded number of its texts, and every gram counted in them; the model grows with the
number of languages.

Defined results: NULL text, empty text and text without a letter give ``und`` and
score 0; equal code lengths give the first language by name; without any training row
every text is ``und``; repeated rows and extra columns pass through unchanged. A very long
text is scored whole, with about forty bytes of a task's memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from florin.llm.columns import free_name
from florin.llm.textbytes import HashIndex, flat, slices, sums
from florin.session import cut_lineage

ORDER = 4  # bytes of the longest context
SAMPLE_DOCS = 300  # training documents per language at most
SAMPLE_GROUPS = 64  # of a language's rows, by which its first rows are found
LANGUAGES_AT_ONCE = 4  # languages that share tables
UNKNOWN = "und"

RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("bits_per_byte", T.DoubleType()),
    ]
)


def packed_grams(data: np.ndarray, order: int) -> np.ndarray:
    """At every byte, that byte and the ``order`` bytes before it as one number; 0 bytes before the first."""
    grams = data.astype(np.uint64)
    for back in range(1, order + 1):
        grams[back:] |= data[:-back].astype(np.uint64) << np.uint64(8 * back)
    return grams


def offsets_in_text(offsets: np.ndarray) -> np.ndarray:
    """For every byte, its place in its own text."""
    lengths = np.diff(offsets)
    return np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)


def training_rows(docs: DataFrame, sample_docs: int) -> DataFrame:
    """(lang, text) of a bounded, seeded sample: whole texts, the same number of rows per language, every language.

    The first rows by hash are found in groups of a language's rows, then among the groups'
    first ones, so that no task gets what every task of the scan has of a common language.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    place = F.struct(F.xxhash64("doc_id", F.lit(11)).alias("h"), "doc_id")
    group = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(SAMPLE_GROUPS))
    first = labelled.select("lang", place.alias("place"), group.alias("group")).select("*", "place.*")
    for part in (["lang", "group"], ["lang"]):
        by_hash = Window.partitionBy(*part).orderBy("h", "doc_id")
        first = first.withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= sample_docs).drop("nth")
    last = first.groupBy("lang").agg(F.max("place").alias("last"))
    # One row per language.
    chosen = labelled.select("lang", "text", place.alias("place")).join(F.broadcast(last), "lang")
    return chosen.where(F.col("place") <= F.col("last")).select("lang", "text")


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """(lang, k, gram, n): how often each byte follows each context of k bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.asarray(batch.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = batch.column("text").filter(pa.array(langs == lang))
                for start, stop in slices(texts):
                    data, offsets = flat(texts[start:stop])
                    place = offsets_in_text(offsets)
                    for k in range(order + 1):
                        grams, n = np.unique(packed_grams(data, k)[place >= k], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([lang] * len(grams), pa.string()),
                                pa.array(np.full(len(grams), k, np.int32)),
                                pa.array(grams.astype(np.int64)),
                                pa.array(n.astype(np.int64)),
                            ],
                            names=["lang", "k", "gram", "n"],
                        )

    counted = rows.mapInArrow(count, "lang string, k int, gram long, n long")
    return counted.groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Frozen statistics: bits of every seen gram and escape of every seen context, per language."""

    languages: list[str]
    order: int
    grams: list[HashIndex]  # by order
    bits: list[np.ndarray]  # by order: grams x languages
    contexts: list[HashIndex]  # by order
    escapes: list[np.ndarray]  # by order: contexts x languages

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language."""
        place = offsets_in_text(offsets)
        cost = np.zeros((len(data), len(self.languages)), np.float32)
        open_at = np.arange(len(data))
        full = packed_grams(data, self.order)
        for k in range(self.order, 0, -1):
            reach = place[open_at] >= k
            asked = open_at[reach]
            mask = np.uint64((1 << (8 * (k + 1))) - 1)
            grams = full[asked] & mask
            at = self.grams[k].find(grams)
            hit = at >= 0
            cost[asked[hit]] += self.bits[k][at[hit]]
            missed = asked[~hit]
            context = self.contexts[k].find(grams[~hit] >> np.uint64(8))
            known = context >= 0
            cost[missed[known]] += self.escapes[k][context[known]]
            open_at = np.concatenate([open_at[~reach], missed])
        cost[open_at] += self.bits[0][data[open_at]]
        return sums(cost.astype(np.float64), offsets)


@dataclass
class Models:
    """Trees of any number of languages, a few languages to a model, so that tables grow by what each has seen."""

    parts: list[Model]

    @property
    def languages(self) -> list[str]:
        return [name for part in self.parts for name in part.languages]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.hstack([part.code_lengths(data, offsets) for part in self.parts])


def build_model(lang: np.ndarray, k: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int) -> Model:
    languages = sorted(set(lang.tolist()))
    number = {name: i for i, name in enumerate(languages)}
    column = np.array([number[x] for x in lang.tolist()], np.int64)
    model = Model(languages, order, [], [], [], [])
    below = np.full((256, len(languages)), 8.0)  # the uniform code under all contexts
    below_index: HashIndex | None = None
    for level in range(order + 1):
        own = k == level
        keys, row = np.unique(gram[own].astype(np.uint64), return_inverse=True)
        if level == 0:
            keys, row = np.arange(256, dtype=np.uint64), gram[own].astype(np.int64)
        contexts, context_row = np.unique(keys >> np.uint64(8), return_inverse=True)
        count = np.zeros((len(keys), len(languages)))
        count[row, column[own]] = n[own]
        total = np.zeros((len(contexts), len(languages)))
        distinct = np.zeros_like(total)
        np.add.at(total, context_row, count)
        np.add.at(distinct, context_row, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0)
            seen = -np.log2(count / (total + distinct)[context_row])
        if below_index is None:
            shorter = below
        else:
            shorter = below[below_index.find(keys & np.uint64((1 << (8 * level)) - 1))]
        bits = np.where(count > 0, seen, escape[context_row] + shorter)
        index = HashIndex(keys)
        model.grams.append(index)
        model.bits.append(bits.astype(np.float32))
        model.contexts.append(HashIndex(contexts))
        model.escapes.append(escape.astype(np.float32))
        below, below_index = bits, index
    return model


def train(docs: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS) -> Models | None:
    """The model of ``docs`` (doc_id, lang, text); None where nothing can be learned.

    The counts are made where the texts are; what reaches the driver is the frozen
    model, which the sample bounds.
    """
    counts = cut_lineage(gram_counts(training_rows(docs, sample_docs), order))
    languages = sorted(row["lang"] for row in counts.select("lang").distinct().collect())
    parts = []
    for first in range(0, len(languages), LANGUAGES_AT_ONCE):
        kept = counts.where(F.col("lang").isin(languages[first : first + LANGUAGES_AT_ONCE])).toArrow()
        columns = {name: kept.column(name).to_numpy() for name in kept.column_names}
        parts.append(build_model(columns["lang"], columns["k"], columns["gram"], columns["n"], order))
    return Models(parts) if parts else None


def predicted(model: Models | None, texts: pa.Array) -> pa.Array:
    """RESULT of every text under the model."""
    names, scores, rates = [], [], []
    for start, stop in slices(texts):
        data, offsets = flat(texts[start:stop])
        if model is None:
            names += [UNKNOWN] * (stop - start)
            scores += [0.0] * (stop - start)
            rates += [None] * (stop - start)
            continue
        bits = model.code_lengths(data, offsets)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(best)), best]
        # Posterior of the winner when all languages are equally likely beforehand.
        score = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
        length = np.diff(offsets)
        names += [model.languages[i] for i in best]
        scores += score.tolist()
        rates += [b / n if n else None for b, n in zip(least.tolist(), length.tolist(), strict=True)]
    lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_pylist()
    for i, has_letter in enumerate(lettered):
        if not has_letter:
            names[i], scores[i] = UNKNOWN, 0.0
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
        names=["lang_pred", "score", "bits_per_byte"],
    )


def predictor(docs: DataFrame, model: Models | None):
    """A column function: text -> RESULT. The model travels once per executor."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        return predicted(shared.value, texts)

    return predict


def identify(docs: DataFrame, model: Models | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``, from the text alone."""
    found = predictor(docs, model)(F.col(text))
    name = free_name(docs, "_found")
    return docs.withColumn(name, found).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in RESULT.names], f"{name}.*"
    )


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: a fifth, by checksum of the identifier; never those without one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the rows that are not held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")
