"""Token counts of a piece vocabulary, with a shortcut for whole tokens.

No piece of the vocabulary has a space behind another character, so no merge crosses
the border before a space: a text is a row of pre-tokens (spaces, then other
characters) whose counts add up. Vocabulary strings that the library itself encodes
as one token are proved so once and counted directly; every other pre-token is merged
by the library, once per slice of rows.

Defined results: NULL counts as empty text, empty text has no tokens, repeated rows
and extra columns are untouched, and a text of any length is counted whole.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MODEL = "piece_bpe_32k.model"
MAX_TOKENS = 4096
MEMORY = 400_000  # merged pre-tokens a worker remembers

SPACE = "▁"  # how the vocabulary writes a space
PRE_TOKEN = re.compile(" +[^ ]*")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counted:
    """Counts of pre-tokens: proved whole tokens, and those merged so far."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.vocab_size()
        pieces = [p for i in range(size) if not self._special(i) for p in [self.library.id_to_piece(i)]]
        self.splits = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        # The library puts a space before a text, so a piece is asked for without its own.
        own = [p[1:].replace(SPACE, " ") for p in pieces if len(p) > 1 and p[0] == SPACE]
        encoded = self.library.encode(own, num_threads=1)
        self.whole = {" " + text for text, ids in zip(own, encoded, strict=True) if len(ids) == 1}
        self.merged: dict[str, int] = {}

    def _special(self, i: int) -> bool:
        return self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits:
            return len(self.library.encode(text, num_threads=1))
        words = Counter(PRE_TOKEN.findall(" " + text.replace(SPACE, " ")))
        whole = merged = 0
        for word, n in words.items():
            if word in self.whole:
                whole += n
            else:
                merged += n * self._merge(word)
        return whole + merged

    def _merge(self, word: str) -> int:
        found = self.merged.get(word)
        if found is None:
            found = len(self.library.encode(word[1:], num_threads=1))
            if word == " ":  # a single trailing space: what it adds to a text
                found = len(self.library.encode("a ", num_threads=1)) - len(self.library.encode("a", num_threads=1))
            if len(self.merged) >= MEMORY:
                self.merged.clear()
            if len(word) <= 64:
                self.merged[word] = found
        return found


@lru_cache(maxsize=2)
def counter(path: str) -> Counted:
    """One per worker and vocabulary."""
    return Counted(path)


def n_tokens(text: Column, model: str = MODEL) -> Column:
    """Tokens of a text as the library gives them, without begin, end or added special tokens."""

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        counted = counter(model_path(model))
        return pa.array([counted.tokens(t.as_py() or "") for t in texts], pa.int64())

    return count(text)


def token_counts(docs: DataFrame, model: str = MODEL, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        n_tokens(F.col("text"), model).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > max_tokens)
