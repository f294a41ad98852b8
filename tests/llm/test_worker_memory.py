"""What Python workers hold at a time, and what is written more than once."""

import tracemalloc

import pyarrow as pa

from florin.llm import components, jaccard_join, quality
from florin.llm.textbytes import flat, slices


def peak_mb(work):
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_a_batch_of_many_texts_takes_little_memory():
    texts = pa.array([f"{i} the quick brown fox, {i % 7} jumps over a lazy dog. " * 36 for i in range(2000)])
    assert peak_mb(lambda: quality.patterns_of(texts)) < 64
    assert peak_mb(lambda: [len(jaccard_join.shingle_sets(*flat(texts[a:b]), 7)) for a, b in slices(texts)]) < 128


def test_links_that_are_stored_are_not_stored_again(spark, monkeypatch):
    links = components.cut_lineage(spark.range(40).selectExpr("id AS u", "(id + 4) % 40 AS v").repartition(8))
    real, widths = components.cut_lineage, []

    def watched(frame):
        stored = real(frame)
        widths.append(stored.rdd.getNumPartitions())
        return stored

    monkeypatch.setattr(components, "cut_lineage", watched)
    found = components.connected_components(links, stored=True)
    assert widths == [1]
    assert {(r["node"], r["root"]) for r in found.collect()} == {(i, i % 4) for i in range(40)}
