"""Every operator and stage: empty tables, NULLs in every column, ties and repeated rows, clashing extra columns."""

import zlib

import pytest
from plain import ODD
from pyspark.sql import functions as F

import corpus_pipeline
from florin.llm import (
    decontamination,
    fingerprints,
    jaccard_join,
    language_id,
    license_scan,
    packing,
    personal_data,
    quality,
    sharding,
    token_counts,
    url_filter,
)

# Names that the operators use inside, and of their results.
CLASHES = [
    "h", "_h", "n", "k", "node", "spans", "_email", "_found", "_hash", "_range", "_source", "_rank", "_place", "_whole",
    "_total", "_fraction", "shard", "slot", "score", "lang_pred", "cluster", "size", "group", "found", "salt", "item_id",
    "n_words", "place", "held_out", "host", "path", "rule", "verdict", "difference", "rule_verdict", "component_id", "label", "notices", "found_", "base", "row",
]

OVER_DOCUMENTS = {
    "op1": language_id.language_id,
    "op2": personal_data.personal_data,
    "op3": fingerprints.document_fingerprints,
    "op4": jaccard_join.ngram_jaccard,
    "op5": packing.best_fit_packing,
    "op7": token_counts.token_counts,
    "op9": sharding.sharding,
    "op10": quality.quality_classifier,
    "op11": license_scan.license_scan,
}


def clashing(frame):
    return frame.withColumns({c: F.lit("x") for c in CLASHES if c not in frame.columns})


@pytest.fixture
def benchmark(spark):
    return spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (None, None)], "item_id long, text string")


@pytest.fixture
def operators(benchmark):
    return {**OVER_DOCUMENTS, "op6": lambda docs: decontamination.decontamination(docs, benchmark)}


@pytest.mark.parametrize("name", [*OVER_DOCUMENTS, "op6"])
def test_empty_table(operators, make_documents, name):
    assert operators[name](clashing(make_documents([]))).collect() == []


@pytest.mark.parametrize("name", [*OVER_DOCUMENTS, "op6"])
def test_nulls_repeats_and_clashes(operators, make_documents, name):
    """One row per row, for rows without identifier, text, source or language, too."""
    rows = [(None, None), (None, "nameless words of one row"), (1, None), (1, None), (2, "same"), (2, "same"), (3, "same"), *ODD]
    frame = make_documents(rows)
    plain = sorted(map(repr, operators[name](frame).collect()))
    assert len(plain) >= len(rows) and (name == "op5" or len(plain) == len(rows))
    assert sorted(map(repr, operators[name](clashing(frame)).collect())) == plain


@pytest.mark.parametrize("name", [*OVER_DOCUMENTS, "op6"])
def test_only_nulls(operators, make_documents, name):
    assert len(operators[name](make_documents([(None, None)] * 3)).collect()) == 3


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, make_documents, name, stage):
    from test_operators import SF_DIR

    assert stage(spark, clashing(make_documents([])), SF_DIR).count() == 0
    rows = [(None, None), (None, "nameless words of one row"), (1, None), (1, None), (2, "same"), (2, "same"), *ODD]
    found = stage(spark, clashing(make_documents(rows)), SF_DIR)
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert found.columns == corpus_pipeline.COLUMNS and found.count() <= len(rows)
    else:
        assert found.where("piece = 0").count() == len(rows)


def test_general_forms_keep_clashing_columns(make_documents):
    """An operator that carries the rows along keeps their columns, but for those it computes."""
    frame = clashing(make_documents([(1, "mail a@b.co"), (2, None)]))
    for build, own in (
        (lambda d: personal_data.found_spans(d), {"spans"}),
        (lambda d: personal_data.without_personal_data(d), {"text", "n_chars"}),
        (lambda d: sharding.interleave(d), {"shard", "slot"}),
        (lambda d: language_id.identify(d, None), set(language_id.RESULT.names)),
        (lambda d: quality.accepted(d, 0.0), set()),
        (lambda d: jaccard_join.one_of_each(d), set()),
        (lambda d: license_scan.find_notices(d), {"n_words", "notices"}),
    ):
        found = build(frame)
        rest = [c for c in CLASHES if c not in own]
        assert set(rest) <= set(found.columns)
        assert all(row[c] == "x" for row in found.collect() for c in rest)


def test_pages(spark):
    pages = spark.createDataFrame(
        [(None, None), (1, ""), (1, ""), (2, "http://a.com/" + "x" * 50_000), (3, "http://b.net/fr/é😀"), (4, "ftp://c.org/y")],
        "page_id long, url string",
    )
    found = {r["page_id"]: r for r in url_filter.url_filter(clashing(pages)).collect()}
    assert found[None]["host"] == found[1]["path"] == "" and found[2]["rule"] == "com/" and found[3]["verdict"] == "block"
    assert url_filter.url_filter(clashing(pages)).count() == 6
    assert url_filter.url_filter(clashing(pages.limit(0))).collect() == []
    kept = url_filter.judged(clashing(pages)).collect()
    assert all(r["_hash"] == "x" for r in kept)


def test_hot_group_of_equal_rows(make_documents):
    """A third of all rows is one text of one source: shards stay level, no bin holds two copies."""
    rows = [(i, "the same words again", None, "hot", 20) for i in range(300)]
    rows += [(1000 + i, f"text number {i} of its own", None, f"s{i % 7}", 20) for i in range(600)]
    frame = make_documents(rows)
    shards = sharding.sharding(frame).groupBy("shard").count().collect()
    assert {r["count"] for r in shards} <= {22, 23} and len(shards) == 40
    bins = packing.best_fit_packing(frame).where("doc_id < 1000").groupBy("bin_id").count()
    assert {r["count"] for r in bins.collect()} == {1}
    joined = jaccard_join.ngram_jaccard(frame).where("doc_id < 1000").select("component_id").distinct().collect()
    assert [r[0] for r in joined] == [0]


def test_held_out_rule(make_documents):
    ids = [0, 1, 5, 10**12, None]
    rows = language_id.language_id(make_documents([(i, "a") for i in ids])).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {
        i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids
    }
