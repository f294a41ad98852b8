"""Document fingerprints: improbable features in chained Bloom filters.

Every window of 32 bytes has an entropy; how often each entropy occurs in the corpus
gives its rank, the rarest first. Among every 32 neighbouring windows the rarest counts,
and windows that count often enough are a text's features. Their hashes go into Bloom
filters of 256 bytes, 160 features each, chained in text order. Two fingerprints are
alike as far as the bits of their filters overlap beyond chance.

Defined results: NULL is an empty text; the empty text has the fingerprint ``0:`` and is
like another empty one (1) and unlike all others (0); a text shorter than a window is one
feature; equal texts have equal fingerprints; rows of equal doc_id follow each other by
hash of the text, rows equal in both in any order, rows without doc_id come last; a table of
one row is its own next. A very long text is one item of its range; its bytes take about forty
times their number in a task. Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from florin.llm.textbytes import flat, mixed, slices
from florin.session import cut_lineage

WINDOW = 32
NEIGHBOURS = 32
POPULARITY = 8  # of NEIGHBOURS that a window must win
LEVELS = 1000  # of entropy
LEAST_LEVEL = 100  # below, windows are too plain to tell texts apart
FILTER_BYTES, FILTER_FEATURES, HASHES = 256, 160, 5
FILTER_BITS = 8 * FILTER_BYTES
CHANCE = 0.3  # part of the possible overlap beyond chance that counts as chance, too

_UNIT = 1 << 16
_XLOGX = np.array([0] + [round(c * np.log2(c) * _UNIT) for c in range(1, WINDOW + 2)], np.int64)
_STEP = np.diff(_XLOGX)
_NEVER = np.iinfo(np.int64).max


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Level of the window from every byte on, in whole numbers, from a running sum of c log c."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    # Same bytes within a window's reach: positions sorted by byte, then counted by bisection.
    order = np.argsort(data, kind="stable")
    key = data[order].astype(np.int64) * (n + 2 * WINDOW) + order + WINDOW
    at = np.arange(n)
    behind, ahead = np.empty(n, np.int64), np.empty(n, np.int64)
    behind[order] = at - np.searchsorted(key, key - (WINDOW - 1))
    ahead[order] = np.searchsorted(key, key + (WINDOW - 1), side="right") - at - 1
    first = _XLOGX[np.bincount(data[:WINDOW], minlength=256)].sum()
    change = _STEP[behind[WINDOW:]] - _STEP[ahead[: n - WINDOW]]
    total = np.concatenate([[first], first + np.cumsum(change)])
    return LEVELS - (total * LEVELS) // _XLOGX[WINDOW]


def window_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte, its text, and the bytes from it to the text's end."""
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)
    return text, np.repeat(offsets[1:], lengths) - np.arange(offsets[-1])


def level_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many windows of all texts have each level."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                data, offsets = flat(batch.column(0)[start:stop])
                level = entropy_levels(data)
                _, left = window_places(offsets)
                total += np.bincount(level[left[: len(level)] >= WINDOW], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1)), pa.array(total)], names=["level", "n"])

    # A row per level leaves a task; the driver gets LEVELS + 1 sums.
    sums = docs.select(text).mapInArrow(count, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(LEVELS + 1, np.int64)
    for row in sums.collect():
        counts[row["level"]] = row["n"]
    return counts


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of every level: the rarest first, the plainest last."""
    rank = np.empty(len(counts), np.int64)
    rank[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    rank[:LEAST_LEVEL] = len(counts)
    return rank


def selected_windows(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, first byte) of the features of every text of a window or more."""
    level = entropy_levels(data)
    text, left = window_places(offsets)
    n = len(level)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text, left = text[:n], left[:n]
    place = np.arange(n)
    key = np.where(left >= WINDOW, (rank[level] << 32) | place, _NEVER)
    # Least key among the NEIGHBOURS windows from each on, by doubling.
    least, step = key.copy(), 1
    while step < NEIGHBOURS:
        least[: n - step] = np.minimum(least[: n - step], least[step:])
        step *= 2
    # Only stretches inside a text; a text with fewer windows is one stretch, from its first.
    whole = left >= WINDOW + NEIGHBOURS - 1
    lengths = np.diff(offsets)
    short = (lengths >= WINDOW) & (lengths < WINDOW + NEIGHBOURS - 1)
    for i in np.flatnonzero(short):
        first = offsets[i]
        least[first] = key[first : first + lengths[i] - WINDOW + 1].min()
    whole[offsets[:-1][short]] = True
    winner = least[whole] & 0xFFFFFFFF
    new = np.concatenate([[True], winner[1:] != winner[:-1]]) if len(winner) else np.zeros(0, bool)
    at = winner[new]
    popularity = np.diff(np.concatenate([np.flatnonzero(new), [len(winner)]]))
    owner = text[at]
    best = np.zeros(len(lengths), np.int64)
    np.maximum.at(best, owner, popularity)
    chosen = popularity >= np.minimum(POPULARITY, best[owner])
    return owner[chosen], at[chosen]


def _window_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[at]
    parts = np.ascontiguousarray(windows).view(np.uint64)
    total = np.zeros(len(at), np.uint64)
    for j in range(parts.shape[1]):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
    return total


class Fingerprints:
    """The chained filters of many texts: ``bits`` (filters x bytes), ``first`` (offsets), features per text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rank: np.ndarray):
        n = len(offsets) - 1
        owner, at = selected_windows(data, offsets, rank)
        hashes = _window_hashes(data, at) if len(at) else np.zeros(0, np.uint64)
        lengths = np.diff(offsets)
        for i in np.flatnonzero((lengths > 0) & (lengths < WINDOW)):
            digest = hashlib.sha1(data[offsets[i] : offsets[i + 1]].tobytes()).digest()
            owner = np.append(owner, i)
            hashes = np.append(hashes, np.frombuffer(digest[:8], np.uint64))
        # A feature that a text repeats counts at its first place only.
        key = hashes ^ mixed(owner.astype(np.uint64) + np.uint64(1))
        _, once = np.unique(key, return_index=True)
        once.sort()
        owner, hashes = owner[once], hashes[once]
        in_order = np.argsort(owner, kind="stable")
        owner, hashes = owner[in_order], hashes[in_order]
        self.features = np.bincount(owner, minlength=n)
        before = np.concatenate([[0], np.cumsum(self.features)])
        self.first = np.concatenate([[0], np.cumsum(-(-self.features // FILTER_FEATURES))])
        chain = self.first[owner] + (np.arange(len(owner)) - before[owner]) // FILTER_FEATURES
        bits = np.zeros((int(self.first[-1]), FILTER_BITS), bool)
        for j in range(HASHES):
            bits[chain, ((hashes >> np.uint64(11 * j)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        self.bits = np.packbits(bits, axis=1)

    def text(self, i: int) -> str:
        """``features:base64``, one form for the same bits."""
        own = self.bits[self.first[i] : self.first[i + 1]]
        return f"{self.features[i]}:{base64.b64encode(own.tobytes()).decode()}"

    def chain(self, i: int) -> np.ndarray:
        return self.bits[self.first[i] : self.first[i + 1]]


def read_fingerprint(text: str) -> np.ndarray:
    """The filters of a fingerprint's text form."""
    raw = base64.b64decode(text.split(":", 1)[1])
    return np.frombuffer(raw, np.uint8).reshape(-1, FILTER_BYTES)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean over the shorter chain of each filter's best overlap beyond chance, 0 to 1."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    a, b = a.view(np.uint64), b.view(np.uint64)
    set_a, set_b = np.bitwise_count(a).sum(axis=1, dtype=np.int64), np.bitwise_count(b).sum(axis=1, dtype=np.int64)
    total = 0.0
    for row, n in zip(a, set_a, strict=True):
        overlap = np.bitwise_count(row & b).sum(axis=1, dtype=np.int64)
        most = np.minimum(n, set_b)
        chance = n * set_b / FILTER_BITS
        border = chance + CHANCE * (most - chance)
        total += float(np.clip((overlap - border) / np.maximum(most - border, 1e-9), 0, 1).max())
    return total / len(a)


def edited(text: str, following: str) -> str:
    """The last half (rounded down) of the code points replaced by as many of the next text."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


LOWEST = -(1 << 63)


def _places(doc_id: pa.Array, not_h: pa.Array, no: pa.Array) -> np.ndarray:
    """Places in ascending order as bytes: rows without doc_id, then by doc_id, not_h and no."""
    whole = np.zeros((len(doc_id), 4), ">u8")
    whole[:, 0] = doc_id.is_valid().to_numpy(zero_copy_only=False)
    for i, column in enumerate((doc_id, not_h, no), 1):
        numbers = column.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
        whole[:, i] = numbers.view(np.uint64) ^ np.uint64(1 << 63)
    return whole.view("S32").ravel()


def _by_doc_id(rows: DataFrame, n_ranges: int) -> list[tuple] | None:
    """Borders that part the rows by doc_id, with those without one in a range below all.

    None where a doc_id, or the rows without one, would fill more than one range.
    """
    steps = [i / n_ranges for i in range(1, n_ranges)] or [0.5]
    found = rows.agg(
        F.percentile_approx("doc_id", steps, max(10_000, 4 * n_ranges)).alias("borders"),
        F.count(F.lit(1)).alias("n"),
        F.count("doc_id").alias("known"),
    ).first()
    borders = found["borders"] or []
    # In a table of few doc_ids borders repeat, too, but a range of it is small.
    crowded = found["n"] > n_ranges and len(set(borders)) < len(borders)
    if crowded or (found["n"] - found["known"]) * n_ranges > 2 * found["n"]:
        return None
    return [(LOWEST, LOWEST, LOWEST), *((value, LOWEST, LOWEST) for value in sorted(set(borders)))]


def _by_number(rows: DataFrame, n_ranges: int) -> list[tuple]:
    """Borders that part numbered rows evenly, also rows of one doc_id and equal ones."""
    key = [F.col("doc_id").asc_nulls_first(), "not_h", "no"]
    parts = rows.select("doc_id", "not_h", "no").repartitionByRange(n_ranges, *key)
    least = parts.groupBy(F.spark_partition_id()).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "not_h", "no")).alias("least"))
    found = sorted((r["least"] for r in least.collect()), key=lambda b: (b["known"], b["doc_id"] or 0, b["not_h"], b["no"]))
    return [(b["doc_id"], b["not_h"], b["no"]) for b in found[1:]]


def followed(docs: DataFrame, n_ranges: int) -> DataFrame:
    """(doc_id, text, h, range_, borrowed): ranges of doc_id, each with the first row of the range after it.

    Texts move once. Where one doc_id has, or rows without doc_id are, more than a range's share, the
    rows are written and numbered first and the ranges part them by text hash and number, too.
    The driver gets the ranges' borders and first rows, three numbers each.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    found = _by_doc_id(rows, n_ranges)
    if found is None:
        rows = cut_lineage(rows).withColumn("no", F.monotonically_increasing_id())
    else:
        rows = rows.withColumn("no", F.lit(0).cast("long"))
    rows = rows.withColumn("not_h", F.bitwise_not("h"))
    if found is None:
        found = _by_number(rows, n_ranges)
    borders = _places(*(pa.array([b[i] for b in found], pa.int64()) for i in range(3)))

    @F.arrow_udf("int")
    def range_of(ids: pa.Array, not_h: pa.Array, no: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(borders, _places(ids, not_h, no), side="right").astype(np.int32))

    ranged = rows.withColumn("range_", range_of("doc_id", "not_h", "no"))
    first = ranged.groupBy("range_").agg(F.max(F.struct("doc_id", "not_h", "no")).alias("f"))
    heads = sorted(first.collect(), key=lambda r: r["range_"])
    # In descending order the range before another is the next higher one; the lowest wraps to the top.
    lent = [(r["range_"], *r["f"], heads[(i + 1) % len(heads)]["range_"]) for i, r in enumerate(heads)]
    table = spark.createDataFrame(lent, "r int, id long, id_not_h long, id_no long, borrower int")
    same = (F.col("range_") == F.col("r")) & F.col("doc_id").eqNullSafe(F.col("id"))
    same &= (F.col("not_h") == F.col("id_not_h")) & (F.col("no") == F.col("id_no"))
    own = F.struct(F.col("range_").alias("range_"), F.lit(False).alias("borrowed"))
    copy = F.struct(F.col("borrower").alias("range_"), F.lit(True).alias("borrowed"))
    # At most n_ranges + 2 rows of five numbers.
    lending = ranged.join(F.broadcast(table), same, "left")
    where = F.when(F.col("borrower").isNotNull(), F.array(own, copy)).otherwise(F.array(own))
    dealt = lending.select("doc_id", "text", "h", "no", F.inline(where))
    return dealt.repartitionById(n_ranges + 1, "range_").sortWithinPartitions(
        "range_", "borrowed", F.desc_nulls_last("doc_id"), "h", F.desc("no")
    )


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(ids: list, texts: list[str], rank: np.ndarray) -> pa.RecordBatch:
    """RESULT of all rows but the last, each with the one after it."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    own = Fingerprints(*flat(pa.array(texts, pa.large_string())), rank)
    other = Fingerprints(*flat(pa.array(changed, pa.large_string())), rank)
    n = range(len(changed))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([own.text(i) for i in n], pa.string()),
            pa.array([other.text(i) for i in n], pa.string()),
            pa.array([likeness(own.chain(i), other.chain(i)) for i in n], pa.float64()),
            pa.array([likeness(own.chain(i), own.chain(i + 1)) for i in n], pa.float64()),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def document_fingerprints(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """RESULT of every row: fingerprints of its text and of its edited text, compared.

    ``rank``: levels by rarity, as learned from a corpus; from ``docs`` itself if not given.
    """
    spark = docs.sparkSession
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(rarity(level_counts(docs)) if rank is None else rank)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        range_ = None
        done = 0  # a borrowed row that has served as the next one ends its range
        size = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "range_", "borrowed"))
            for doc_id, text, own, borrowed in zip(*columns, strict=True):
                if own != range_:
                    ids, texts, range_, done, size = [], [], own, False, 0
                if done:
                    continue
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
                done = borrowed
                if len(texts) > 1 and (done or size >= 1 << 20):
                    yield _compared(ids, texts, shared.value)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])

    return followed(docs, n_ranges).select("doc_id", "text", "range_", "borrowed").mapInArrow(compare, RESULT)


def fingerprint(docs: DataFrame, rank: np.ndarray) -> Column:
    """A column of ``docs``' ``text``: its fingerprint under a given rank."""
    shared = docs.sparkSession.sparkContext.broadcast(rank)

    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        found: list[str] = []
        for start, stop in slices(texts):
            own = Fingerprints(*flat(texts[start:stop]), shared.value)
            found += [own.text(i) for i in range(stop - start)]
        return pa.array(found, pa.string())

    return of(F.col("text"))
