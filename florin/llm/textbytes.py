"""Arrow text columns as flat byte arrays, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Numpy needs some forty bytes of temporaries per byte of text; a slice holds at
# least one text, so the longest text bounds memory beyond this.
SLICE_BYTES = 1 << 19


def byte_lengths(texts: pa.Array) -> np.ndarray:
    """UTF-8 length of every text; NULL counts as empty."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges (first, after last) whose texts stay together under the limit, of so many rows at most."""
    ends = np.cumsum(byte_lengths(texts))
    start, done = 0, 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        stop = stop if rows is None else min(stop, start + rows)
        yield start, stop
        start, done = stop, int(ends[stop - 1])


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes one after another, and the offsets (n + 1) of the texts; NULL is empty."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offset_buffer, data_buffer = filled.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    if data_buffer is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within every [offsets[i], offsets[i + 1]), empty ranges included."""
    totals = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype if values.dtype.kind == "f" else np.int64)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        totals[full] = np.add.reduceat(values, offsets[full], axis=0, dtype=totals.dtype)
    return totals


class HashIndex:
    """Position of 64-bit keys in a fixed list, by multiplicative hashing in a few levels.

    Each level places the keys that collided in the level before; the table of a
    level has eight slots or more per key, so three or four levels suffice.
    """

    MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

    def __init__(self, keys: np.ndarray):
        self.keys = keys.astype(np.uint64)
        self.levels: list[tuple[np.uint64, np.uint64, np.ndarray]] = []
        left = np.arange(len(keys))
        while len(left):
            bits = max(4, int(np.ceil(np.log2(8 * len(left)))))
            multiplier = np.uint64((self.MULTIPLIERS[len(self.levels) % 4] + 2 * len(self.levels)) & (2**64 - 1))
            shift = np.uint64(64 - bits)
            slot = (self.keys[left] * multiplier) >> shift
            _, first = np.unique(slot, return_index=True)
            table = np.full(1 << bits, -1, np.int32)
            table[slot[first].astype(np.int64)] = left[first]
            self.levels.append((multiplier, shift, table))
            left = np.delete(left, first)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Index of every wanted key, -1 where it is not in the list."""
        found = np.full(len(wanted), -1, np.int32)
        open_at: np.ndarray | None = None
        for multiplier, shift, table in self.levels:
            asked = wanted if open_at is None else wanted[open_at]
            at = table[((asked * multiplier) >> shift).astype(np.int64)]
            hit = (at >= 0) & (self.keys[at] == asked)
            if open_at is None:
                found[hit] = at[hit]
                open_at = np.flatnonzero(~hit & (at >= 0))
            else:
                found[open_at[hit]] = at[hit]
                open_at = open_at[~hit & (at >= 0)]
            if not len(open_at):
                break
        return found


# --- words -----------------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def _grow_powers(n: int) -> None:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = 1 << int(n - 1).bit_length()
        _powers = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]).cumprod(dtype=np.uint64)
        _inverse_powers = np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE_INVERSE)]).cumprod(
            dtype=np.uint64
        )


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return values ^ (values >> np.uint64(32))


PLACES = 32  # whose numbers are drawn once for all words


def _drawn(asked: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit number for each, from a seed of 128 bits."""
    one, two = np.uint64(seed & (2**64 - 1)), np.uint64(seed >> 64 & (2**64 - 1))
    return mixed(mixed(asked.astype(np.uint64) + one) ^ two)


class Words:
    """The words of many texts: where each starts and ends, its text, and a 64-bit hash of its bytes.

    ``in_word`` and ``folded`` are tables of 256: whether a byte belongs to a word, and
    the byte it counts as. ``first`` has the offsets (n + 1) of each text's words.

    Without ``seed`` a hash is a polynomial in the bytes, which texts made for it can defeat.
    With one, drawn after the texts are fixed, every byte adds a number that depends on the
    seed, the byte and its place in the word, so that no text is known to collide.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray, folded: np.ndarray, seed: int | None = None):
        inside = in_word[data]
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        before = np.concatenate([[False], inside[:-1]]) if len(inside) else inside
        after = np.concatenate([inside[1:], [False]]) if len(inside) else inside
        self.start = np.flatnonzero(inside & (~before | border[:-1]))
        self.end = np.flatnonzero(inside & (~after | border[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        if seed is not None:
            self.hash = self._seeded(folded[data[inside]], seed)
            return
        _grow_powers(len(data) + 1)
        weighted = (folded[data].astype(np.uint64) + np.uint64(1)) * _powers[: len(data)]
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighted, dtype=np.uint64)])
        own = (running[self.end] - running[self.start]) * _inverse_powers[self.start]
        self.hash = mixed(own + (self.end - self.start).astype(np.uint64))

    def _seeded(self, word_bytes: np.ndarray, seed: int) -> np.ndarray:
        size = self.end - self.start
        if not len(size):
            return np.zeros(0, np.uint64)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(len(word_bytes)) - np.repeat(first, size)
        near = place < PLACES
        far = np.flatnonzero(~near)
        beyond = _drawn(place[far] * 256 + word_bytes[far], seed)
        place *= near
        place *= 256
        place += word_bytes
        added = _drawn(np.arange(PLACES * 256), seed)[place]
        added[far] = beyond
        return mixed(np.add.reduceat(added, first) + size.astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from every word on; the last k - 1 of all have none and are cut."""
        n = max(0, len(self.hash) - k + 1)
        total = np.zeros(n, np.uint64)
        for j in range(k):
            total = total * _BASE + self.hash[j : j + n]
        return mixed(total + np.uint64(k))


def folded_ascii() -> np.ndarray:
    """Every byte as itself, A-Z as a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def byte_set(text: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(text, np.uint8)] = True
    return table
