"""Quality classifier from weak labels.

Overlapping heuristics vote on every document (bad, abstain, good). Expectation
maximisation over the counts of vote patterns of the whole corpus estimates how each
heuristic votes on good and on bad documents; the posteriors are the labels of a bounded
sample, on which a linear scorer over hashed features is trained. The scorer alone gives
the score of a document, and a document below the threshold is rejected.

Defined results: NULL and empty texts score 0 and are rejected; without any training
row every document with text scores by its votes' prior (1); equal texts have equal
scores; repeated rows and extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from florin.llm.textbytes import Words, byte_set, flat, folded_ascii, mixed, slices, sums

THRESHOLD = 0.4
SAMPLE_DOCS = 4000  # training documents at most
SLOTS = 4096  # hashed features
ROUNDS = 100  # of expectation maximisation, and of the scorer's training
BAD, ABSTAIN, GOOD = 0, 1, 2

_LOWER = byte_set(bytes(range(97, 123))) | (np.arange(256) >= 128)
_UPPER = byte_set(bytes(range(65, 91)))
_DIGIT = byte_set(b"0123456789")
_STOP = byte_set(b".,;:?")
_BLANK = byte_set(b" \t\n\r\x0b\x0c")
_SYMBOL = ~(_LOWER | _UPPER | _DIGIT | _STOP | _BLANK | byte_set(b"'\"()-/@+_"))
_LINE = ~byte_set(b"\n")
# Bytes as shapes: letters, digits and other kinds fall together.
_SHAPE = np.select([_LOWER, _UPPER, _DIGIT, _BLANK & (np.arange(256) != 10)], [97, 65, 48, 32], np.arange(256)).astype(
    np.uint64
)

# (name, measure, bad below, bad above, good from, good to). A measure outside the bad
# limits votes bad, one inside the good limits votes good, else the heuristic abstains.
# A heuristic that only knows one kind of junk never votes good.
NEVER = np.inf
HEURISTICS = [
    ("symbols", "symbol_share", -1.0, 0.03, NEVER, NEVER),
    ("marked words", "marked_words", -1.0, 0.15, NEVER, NEVER),
    ("shouting", "upper_share", -1.0, 0.30, NEVER, NEVER),
    ("echo", "echo_share", -1.0, 0.10, NEVER, NEVER),
    ("lines", "line_repeats", -1.0, 0.30, NEVER, NEVER),
    ("variety", "variety", 0.10, np.inf, NEVER, NEVER),
    ("length", "words", -1.0, np.inf, 20.0, np.inf),
    ("stops", "stops_per_word", -1.0, 0.80, 0.03, 0.40),
    ("letters", "letter_share", 0.20, np.inf, 0.45, 1.0),
]


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """What the heuristics look at, for every text."""
    size = np.maximum(np.diff(offsets), 1)
    share = {k: sums(t[data], offsets) for k, t in (("lower", _LOWER), ("upper", _UPPER), ("symbol", _SYMBOL), ("stop", _STOP))}
    words = Words(data, offsets, ~_BLANK, folded_ascii())
    lines = Words(data, offsets, _LINE, folded_ascii())
    n_words, n_lines = np.diff(words.first), np.diff(lines.first)
    echo = np.zeros(len(words.hash), bool)
    echo[1:] = (words.hash[1:] == words.hash[:-1]) & (words.text[1:] == words.text[:-1])
    return {
        "symbol_share": share["symbol"] / size,
        "upper_share": share["upper"] / np.maximum(share["upper"] + share["lower"], 1),
        "letter_share": (share["upper"] + share["lower"]) / size,
        "echo_share": sums(echo, words.first) / np.maximum(n_words, 1),
        "marked_words": sums(_SYMBOL[data][words.end - 1], words.first) / np.maximum(n_words, 1),
        "line_repeats": 1 - _distinct(lines) / np.maximum(n_lines, 1),
        "words": n_words.astype(float),
        "stops_per_word": share["stop"] / np.maximum(n_words, 1),
        # Long texts repeat words by nature; a square root makes lengths comparable.
        "variety": _distinct(words) / np.maximum(np.sqrt(n_words) * np.minimum(np.sqrt(n_words), 10), 1),
    }


def _distinct(words: Words) -> np.ndarray:
    """Number of different words of every text."""
    key = words.hash ^ mixed(words.text.astype(np.uint64) + np.uint64(1))
    _, at = np.unique(key, return_index=True)
    return np.bincount(words.text[at], minlength=len(words.first) - 1)


def votes(measured: dict[str, np.ndarray]) -> np.ndarray:
    """Texts x heuristics, each BAD, ABSTAIN or GOOD."""
    columns = []
    for _, name, low, high, good_from, good_to in HEURISTICS:
        value = measured[name]
        vote = np.where((value >= good_from) & (value <= good_to), GOOD, ABSTAIN)
        columns.append(np.where((value < low) | (value > high), BAD, vote))
    return np.stack(columns, axis=1)


def pattern_of(vote: np.ndarray) -> np.ndarray:
    """All votes of a text as one number."""
    return vote @ (3 ** np.arange(vote.shape[1]))


def votes_of(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3


def patterns_of(texts: pa.Array) -> pa.Array:
    found = [np.zeros(0, np.int64)]
    for start, stop in slices(texts):
        found.append(pattern_of(votes(measures(*flat(texts[start:stop])))))
    return pa.array(np.concatenate(found).astype(np.int32))


def vote_pattern(text: Column) -> Column:
    return F.arrow_udf(patterns_of, T.IntegerType())(text)


# What a heuristic is believed to do before the corpus is seen, as P(bad, abstain, good):
# on bad and on good documents, for one that never votes good and for one that may. The
# belief weighs BELIEF times the corpus; it keeps a common kind of junk from being taken
# for the good class.
BELIEVED_ONE_SIDED = [[0.30, 0.70, 0.00], [0.005, 0.995, 0.00]]
BELIEVED_TWO_SIDED = [[0.20, 0.40, 0.40], [0.02, 0.18, 0.80]]
BELIEF = 1.0


def posteriors(pattern: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every vote pattern, and P(vote | class) as heuristics x class x vote.

    The heuristics are taken as independent given the class. The first guess, which
    tells the classes apart, lets one bad vote outweigh a few good ones.
    """
    vote = votes_of(pattern)
    balance = 1.0 + (vote == GOOD).sum(axis=1) - 5.0 * (vote == BAD).sum(axis=1)
    good = 1 / (1 + np.exp(-balance))
    believed = np.array([BELIEVED_ONE_SIDED if h[4] == NEVER else BELIEVED_TWO_SIDED for h in HEURISTICS])
    table = np.zeros((len(HEURISTICS), 2, 3))
    for _ in range(rounds):
        weight = np.stack([count * (1 - good), count * good], axis=1)
        prior = (weight.sum(axis=0) + 1) / (weight.sum() + 2)
        for j in range(len(HEURISTICS)):
            for v in (BAD, ABSTAIN, GOOD):
                table[j, :, v] = weight[vote[:, j] == v].sum(axis=0) + 0.5
        table += BELIEF * weight.sum(axis=0)[None, :, None] * believed
        table /= table.sum(axis=2, keepdims=True)
        log = np.log(prior) + sum(np.log(table[j][:, vote[:, j]]).T for j in range(len(HEURISTICS)))
        good = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))
    return good, table


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x SLOTS: square roots of the shares of hashed shape sequences, echoed words, repeated lines."""
    n = len(offsets) - 1
    shape = _SHAPE[data]
    row = np.repeat(np.arange(n), np.diff(offsets))
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    table = np.zeros((n, SLOTS), np.float32)
    for length in (1, 3):
        gram = shape.copy()
        for back in range(1, length):
            gram[back:] |= shape[:-back] << np.uint64(8 * back)
        slot = (mixed(gram + np.uint64(length)) % np.uint64(SLOTS - 2)).astype(np.int64)
        own = place >= length - 1  # grams within one text
        counted = np.bincount((row * SLOTS + slot)[own], minlength=n * SLOTS).reshape(n, SLOTS)
        table += counted
    measured = measures(data, offsets)
    size = np.maximum(np.diff(offsets), 1)
    table = np.sqrt(table / size[:, None])
    table[:, SLOTS - 2] = np.sqrt(measured["echo_share"])
    table[:, SLOTS - 1] = np.sqrt(measured["line_repeats"])
    return table


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float
    good_share: np.ndarray  # heuristics x class x vote, as estimated

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(good) of every text; 0 for an empty one. Texts are taken in small slices of the table."""
        found = np.zeros(len(offsets) - 1)
        for first in range(0, len(found), 256):
            last = min(first + 256, len(found))
            part = offsets[first : last + 1]
            x = features(data[part[0] : part[-1]], part - part[0])
            found[first:last] = 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -30, 30)))
        return np.where(np.diff(offsets) > 0, found, 0.0)


def fit(x: np.ndarray, label: np.ndarray, rounds: int = 3 * ROUNDS, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, both classes weighted alike; Adam steps over all rows."""
    share = np.clip(label.mean(), 0.01, 0.99)
    weight = label / share + (1 - label) / (1 - share)
    weight = (weight / weight.sum()).astype(np.float32)
    beta = np.zeros(x.shape[1] + 1, np.float32)
    step, square = np.zeros_like(beta), np.zeros_like(beta)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ beta[:-1] + beta[-1], -30, 30)))
        error = (p - label).astype(np.float32) * weight
        gradient = np.concatenate([x.T @ error + penalty * beta[:-1], [error.sum()]]).astype(np.float32)
        step = 0.9 * step + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        beta -= 0.1 * (step / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return beta[:-1].astype(np.float64), float(beta[-1])


def _sampled(docs: DataFrame, text: str, sample_docs: int) -> DataFrame:
    """Texts of a seeded sample; only hashes are sorted, then the texts below the last are read again."""
    hashed = docs.where(F.length(text) > 0).select(F.col(text).alias("text"), F.xxhash64(F.lit(10), text).alias("h"))
    last = hashed.select("h").distinct().orderBy("h").limit(sample_docs).agg(F.max("h").alias("h")).collect()[0]["h"]
    if last is None:
        return hashed.limit(0)
    # Equal texts have one hash and count once.
    return hashed.where(F.col("h") <= last).groupBy("h").agg(F.first("text").alias("text"))


def train(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Scorer | None:
    """Vote statistics of all rows; the driver gets their patterns (at most 3^heuristics) and the weights.

    One task fits the scorer; it holds the sample's features, ``sample_docs`` x SLOTS at most.
    """
    patterns = docs.where(F.length(text) > 0).groupBy(vote_pattern(F.col(text)).alias("pattern")).count().toArrow()
    if not patterns.num_rows:
        return None
    patterns = patterns.sort_by("pattern")
    known = patterns.column("pattern").to_numpy()
    good, table = posteriors(known, patterns.column("count").to_numpy().astype(float))
    label_of = dict(zip(known.tolist(), good.tolist(), strict=True))

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start, stop in slices(texts, 1 << 18, rows=256):
                data, offsets = flat(texts[start:stop])
                x = features(data, offsets).astype(np.float16)
                pattern = pattern_of(votes(measures(data, offsets)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("h")[start:stop],
                        pa.array(pattern.astype(np.int32)),
                        pa.array([row.tobytes() for row in x], pa.binary()),
                    ],
                    names=["h", "pattern", "x"],
                )

    def fitted(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows.column("h").to_numpy())
        x, packed = np.empty((rows.num_rows, SLOTS), np.float32), rows.column("x")
        for i, at in enumerate(order.tolist()):
            x[i] = np.frombuffer(packed[at].as_buffer(), np.float16)
        label = np.array([label_of[p] for p in rows.column("pattern").to_numpy()[order].tolist()], np.float32)
        weights, bias = fit(x, label)
        return pa.table({"weights": pa.array([weights], pa.list_(pa.float64())), "bias": pa.array([bias])})

    sample = _sampled(docs, text, sample_docs).mapInArrow(featured, "h long, pattern int, x binary")
    scorer = sample.groupBy(F.lit(0).alias("all")).applyInArrow(fitted, "weights array<double>, bias double").first()
    return Scorer(np.array(scorer["weights"]), scorer["bias"], table)


def quality_score(docs: DataFrame, scorer: Scorer | None) -> Column:
    """A column of ``docs``' ``text``: P(good)."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for start, stop in slices(texts):
            data, offsets = flat(texts[start:stop])
            plain = (np.diff(offsets) > 0).astype(float)
            found.append(plain if shared.value is None else shared.value.scores(data, offsets))
        return pa.array(np.concatenate(found))

    return score(F.col("text"))


def accepted(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier, trained on them, does not reject."""
    return docs.where(quality_score(docs, train(docs)) >= threshold)


def quality_classifier(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, keep of every row."""
    scored = docs.select("doc_id", quality_score(docs, train(docs)).alias("score"))
    return scored.withColumn("keep", F.col("score") >= threshold)
