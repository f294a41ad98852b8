"""Many rows without identifier, equal rows and colliding words: right results, and no task with most of them."""

import pytest
from plain import components
from pyspark.sql import functions as F

from florin.llm import decontamination, jaccard_join, sharding
from florin.llm.components import connected_components, joined_links


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_words_that_defeat_polynomial_hashes(make_documents, n):
    word = thue_morse(n)
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"one two {word} three four five"), (4, f"one two {other} three four five"), (5, f"{word} {other}"), (6, f"{other} {word}")]
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.ngram_jaccard(make_documents(rows)).collect()}
    assert found == components(rows)
    kept = jaccard_join.one_of_each(make_documents(rows)).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == [1, 2, 3, 4, 5, 6]


def test_nameless_rows_are_joined_once(spark, make_documents):
    """Rows without identifier, linked ones and copies, do not meet each other in pairs."""
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(None, f"{base} tail{i % 50}") for i in range(5000)]
    frame = make_documents(rows)
    seed = 7
    able = jaccard_join.documents_able_to_link(frame, seed)
    nodes = jaccard_join.node_table(able)
    assert nodes.count() == 50
    assert jaccard_join.sets_of(frame, nodes, seed).count() == 50
    found = jaccard_join.ngram_jaccard(frame)
    assert found.count() == 5000 and found.where("component_id IS NOT NULL").count() == 0
    assert jaccard_join.one_of_each(frame).count() == 1


def test_blocks_of_many_rows(make_documents, monkeypatch):
    """Blocks with more documents than one number holds are split."""
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 7)
    rows = [(i, f"a{i % 40} b{i % 40} c{i % 40} d{i % 40} e{i % 40}") for i in range(200)]
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.ngram_jaccard(make_documents(rows)).collect()}
    assert found == {i: i % 40 for i in range(200)}


def test_one_batch_beyond_sixteen_bits(spark, make_documents):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
    try:
        frame = spark.range(0, 140_000, 1, 1).select(
            F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id") % 70_000) for c in "abcde"]).alias("text")
        )
        wrong = jaccard_join.ngram_jaccard(frame).where("component_id <> doc_id % 70000").count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert wrong == 0


def test_equal_rows_fall_into_many_ranges(spark, make_documents):
    rows = [(None, "the same text")] * 3000 + [(i, f"text {i}") for i in range(6000)]
    frame = make_documents(rows)
    hashed = frame.select(F.lit("=").alias("_source"), F.xxhash64("doc_id", "text").alias("_hash"))
    sizes = sharding._spread(hashed).groupBy(F.pmod(F.shiftright("_hash", 32), F.lit(sharding.RANGES))).count()
    assert sizes.agg(F.max("count")).first()[0] < 40
    placed = sharding.sharding(frame).collect()
    assert len(placed) == 9000
    by_shard = {}
    for r in placed:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by_shard) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) and len(s) == 225 for s in by_shard.values())


def test_copies_of_a_contaminated_text(spark, make_documents):
    item = "one two three four five six seven eight nine ten"
    benchmark = spark.createDataFrame([(1, item), (2, "zero " + item)], "item_id long, text string")
    rows = [(None, f"x {item} y")] * 3000 + [(7, f"x {item} y")] * 2 + [(8, "clean text")] * 2 + [(None, "clean text")]
    found = decontamination.decontamination(make_documents(rows), benchmark).groupBy("doc_id", "n_hit", "n_items").count().collect()
    assert {(r["doc_id"], r["n_hit"], r["n_items"]): r["count"] for r in found} == {(None, 10, 2): 3000, (7, 10, 2): 2, (8, 0, 0): 2, (None, 0, 0): 1}
    assert sorted(str(r["doc_id"]) for r in decontamination.clean(make_documents(rows), benchmark).collect()) == ["8", "8", "None"]


@pytest.mark.parametrize("per_task", [5, 200_000])
def test_components_of_chains_stars_and_rings(spark, monkeypatch, per_task):
    """Links in one task or in many give the same components."""
    from florin.llm import components as module

    monkeypatch.setattr(module, "ROWS_PER_TASK", per_task)
    links = [(i, i + 1) for i in range(100, 160)] + [(300, 300 + i) for i in range(1, 30)] + [(500 + i, 500 + (i + 1) % 20) for i in range(20)]
    links += [(900, 901), (901, 900), (7, 7)]
    found = connected_components(spark.createDataFrame(links, "u long, v long").repartition(6))
    want = {i: 100 for i in range(100, 161)} | {300 + i: 300 for i in range(30)} | {500 + i: 500 for i in range(20)} | {900: 900, 901: 900}
    assert {r["node"]: r["root"] for r in found.collect()} == want and found.count() == len(want)
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []
    assert sorted(joined_links([(3, 2), (2, 1), (9, 8)])) == [(2, 1), (3, 1), (9, 8)]

def test_hash_ranges_grow_with_the_text(make_documents, monkeypatch):
    """More text, more ranges, whatever the session's partitions; the result is the same."""
    rows = [(i, " ".join(f"w{i % 60}x{j}" for j in range(30))) for i in range(240)]
    frame = make_documents(rows)
    configured = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    assert jaccard_join.hash_ranges(frame) == configured
    monkeypatch.setattr(jaccard_join, "RANGE_TEXT", 2000)
    ranges = jaccard_join.hash_ranges(frame)
    assert ranges > configured and ranges == -(-sum(len(text) for _, text in rows) // 2000)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.ngram_jaccard(frame).collect()}
    assert found == {i: i % 60 for i in range(240)}


def test_a_task_sends_one_row_per_range_for_many_slices(spark, make_documents, monkeypatch):
    """Slices of a task share a block, so that rows do not grow with the slices."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(400)]
    frame = make_documents(rows).coalesce(1).select("doc_id", F.xxhash64("text").alias("h"), "text")

    def sent(hashes):
        monkeypatch.setattr(jaccard_join, "BLOCK_HASHES", hashes)
        monkeypatch.setattr(jaccard_join, "slices", lambda texts, rows=None: ((i, i + 1) for i in range(len(texts))))
        return frame.mapInArrow(jaccard_join._packed_blocks(16, 5), jaccard_join.PACKED).where("kind = 0").count()

    assert sent(1 << 20) == 16
    assert sent(1) > 400


def test_a_token_of_many_rows_is_joined_apart(spark):
    """Hot, rare and one-label tokens against a plain count."""
    rows = [(i, i % 7, 1) for i in range(6000)] + [(i, 3, 2 + i % 4) for i in range(400)]
    rows += [(i, i % 2, 100 + i // 2) for i in range(2000)]
    tokens = spark.createDataFrame(rows, "node long, label long, token long")
    found = sorted(tuple(r) for r in jaccard_join.held_across(tokens).select("node", "label", "token", "holders").collect())
    holders, labels = {}, {}
    for _, label, token in rows:
        holders[token] = holders.get(token, 0) + 1
        labels.setdefault(token, set()).add(label)
    assert found == sorted((*r, holders[r[2]]) for r in rows if len(labels[r[2]]) > 1)
    assert jaccard_join.held_across(tokens.limit(0)).count() == 0
