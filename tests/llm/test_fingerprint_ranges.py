"""Rows of one doc_id, nameless and equal ones are parted evenly, and each still meets the row after it."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from florin.llm import fingerprints as fp

N = 600
RANGES = 8
TABLES = {
    "a third nameless and equal": [(None, "one text")] * (N // 3) + [(i, f"text {i}") for i in range(N - N // 3)],
    "a third of one doc_id, all different": [(7, f"of seven {i}") for i in range(N // 3)] + [(i, f"text {i}") for i in range(10, N - N // 3)],
    "a third of one doc_id, equal": [(7, "the same")] * (N // 3) + [(i, f"text {i}") for i in range(N - N // 3)],
    "all nameless": [(None, f"text {i % 50}") for i in range(N)],
    "all equal": [(1, "equal")] * N,
    "nameless, equal and different": [(None, "one text")] * 200 + [(None, f"text {i}") for i in range(200)] + [(-5, "")] * 200,
    "distinct": [(i * 3, f"text {i}") for i in range(N)],
}


def plain(frame):
    """(doc_id, number of characters, hash of the edited text) of every row, by one sort."""
    rows = frame.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), r["h"]))
    after = rows[1:] + rows[:1]
    found = Counter()
    for row, following in zip(rows, after, strict=True):
        half = len(row["text"]) // 2
        changed = row["text"][: len(row["text"]) - half] + following["text"][:half]
        found[row["doc_id"], len(row["text"]), hashlib.sha256(changed.encode()).hexdigest()] += 1
    return found


@pytest.mark.parametrize("name", TABLES)
def test_ranges(make_documents, name):
    frame = make_documents(TABLES[name]).repartition(3)
    n = frame.count()
    sizes = [r["count"] for r in fp.followed(frame, RANGES).where("NOT borrowed").groupBy("range_").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 3 * n / RANGES
    lent = fp.followed(frame, RANGES).where("borrowed").count()
    assert lent == len(sizes)
    rows = fp.document_fingerprints(frame).select("doc_id", "n_chars", "edited_sha256").collect()
    assert Counter(tuple(r) for r in rows) == plain(frame)


def test_few_rows(make_documents):
    for rows in ([], [(None, None)], [(1, "a"), (1, "a")], [(None, "b"), (None, "c"), (2, "d")]):
        frame = make_documents(rows)
        found = fp.document_fingerprints(frame).select("doc_id", "n_chars", "edited_sha256").collect()
        assert Counter(tuple(r) for r in found) == plain(frame)
