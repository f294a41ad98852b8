import hashlib
import random
import zlib

import pytest
import sentencepiece
from plain import ODD, bench_words, components
from pyspark.sql import functions as F

import corpus_pipeline
from florin.llm import (
    decontamination,
    fingerprints,
    jaccard_join,
    language_id,
    packing,
    quality,
    sharding,
    token_counts,
    url_filter,
)
from florin.llm.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def texts_of(documents):
    return {r["doc_id"]: r["text"] for r in documents.collect()}


def with_odd(documents, make_documents):
    return documents.unionByName(make_documents(ODD)).withColumns({"h": F.lit(1), "node": F.lit(1), "score": F.lit("x")})


def test_language_of_held_out_rows(documents, make_documents):
    rows = language_id.language_id(with_odd(documents, make_documents)).collect()
    lang = {r["doc_id"]: r["lang"] for r in documents.collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] < 9000]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)
    und = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (9001, 9002, 9003)}
    assert set(und.values()) == {("und", 0.0)} and all(0 <= r["score"] <= 1 for r in rows)


def test_code_lengths_follow_the_trees():
    import numpy as np

    from florin.llm.textbytes import HashIndex  # noqa: F401

    # "ab" seen three times after the start: order 1 context a -> b.
    lang = np.array(["x"] * 4)
    k, gram, n = np.array([0, 0, 1, 1]), np.array([97, 98, 97 << 8 | 98, 98 << 8 | 97]), np.array([3, 3, 3, 2])
    model = language_id.build_model(lang, k, gram, n, 1)
    data = np.frombuffer(b"abc", np.uint8)
    bits = model.code_lengths(data, np.array([0, 3]))[0, 0]
    # a: 3/8; b after a: 3/4; c after b: escape 1/3, escape 2/8, 1/256.
    want = -np.log2(3 / 8) - np.log2(3 / 4) - np.log2(1 / 3) - np.log2(2 / 8) + 8
    assert bits == pytest.approx(want, abs=1e-4)


def test_token_counts(documents, make_documents):
    import public_tokenizers

    odd = [*ODD, (9011, "  two  spaces "), (9012, "<s> </s> ▁ a▁b"), (9013, "a\nb\tc\x00"), (9014, "日本語 ½ ﬁ\u3000x")]
    frame = documents.unionByName(make_documents(odd))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = texts_of(frame)
    for r in token_counts.token_counts(frame).collect():
        text = texts[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"]) == (len(text.encode()), len(library.encode(text))), text[:80]
        assert r["over_limit"] == (r["n_tokens"] > 4096)


def test_fingerprints(documents, make_documents):
    frame = with_odd(documents, make_documents).unionByName(make_documents([(9020, "One.")]), allowMissingColumns=True)
    rows = {r["doc_id"]: r for r in fingerprints.document_fingerprints(frame).collect()}
    texts = {i: t or "" for i, t in texts_of(frame).items()}
    order = sorted(texts, reverse=True)
    assert set(rows) == set(order)
    for i, following in zip(order, order[1:] + order[:1], strict=True):
        r, text = rows[i], texts[i]
        edited = text[: len(text) - len(text) // 2] + texts[following][: len(text) // 2]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"] == r["edited_fingerprint"]) >= (text == edited)
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if text and text == edited:
            assert r["near_edited"] == 1
    by_text = {}
    for i, r in rows.items():
        assert by_text.setdefault(texts[i], r["fingerprint"]) == r["fingerprint"]
    long = [r for i, r in rows.items() if i < 9000 and r["n_chars"] > 500]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.95 * len(long)


def near_copies(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.randint(3, 90))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, 4)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((n, " ".join(text) + " shared line of words that many texts hold" * rng.randint(0, 1)))
            n += 1
    return rows


@pytest.mark.parametrize("chunk", [4, 1024])
def test_jaccard_join(make_documents, monkeypatch, chunk):
    monkeypatch.setattr(jaccard_join, "CHUNK", chunk)
    rows = near_copies() + ODD
    frame = make_documents(rows).withColumns({"n": F.lit(1), "node": F.lit(1)})
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.ngram_jaccard(frame).collect()}
    assert found == components(rows)


def test_one_of_each(make_documents):
    rows = near_copies(2) + ODD
    frame = make_documents(rows + rows[:7])
    kept = sorted(r["doc_id"] for r in jaccard_join.one_of_each(frame).collect())
    assert kept == sorted({least for _, least in components(rows).values()})


def test_decontamination(make_documents, spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for i in range(40)]
    items += [(50, None), (50, "solo"), (None, "nameless item words"), (51, items[3][1])]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(100 + i, f"Xx {t}, Yy. {t}") for i, t in items[:40:2]] + ODD + [(200, "Nameless ITEM words and solo")]
    frame = make_documents(rows + rows[:5])
    windows = {}
    for item, text in items:
        w = bench_words(text)
        m = min(10, len(w))
        for j in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[j : j + m]), set()).update([str(item)] if item is not None else [])
    spans = {len(k) for k in windows}
    found = decontamination.decontamination(frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(found) == len(rows) + 5
    texts = dict(rows)
    for r in found:
        w, hit, own = bench_words(texts[r["doc_id"]]), set(), set()
        for m in spans:
            for j in range(len(w) - m + 1):
                if tuple(w[j : j + m]) in windows:
                    hit |= set(range(j, j + m))
                    own |= windows[tuple(w[j : j + m])]
        want = (len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit))
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == want


def test_url_rules(spark):
    urls = {
        1: ("https://WWW.Example.com/en/x?q", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        3: ("http://b.com/q#f", "b.com", "/q", "com/", "allow"),
        4: ("x://site.net/fr/", "site.net", "/fr/", "net/fr/", "block"),
        5: ("http://telecom/x", "telecom", "/x", None, None),
        6: (None, "", "", None, None),
        7: ("no scheme", "", "", None, None),
        8: ("a://b://c.net/es/", "b:", "//c.net/es/", None, None),
        9: ("http://com", "com", "", None, None),
    }
    pages = spark.createDataFrame([(i, u[0], 1) for i, u in urls.items()] * 2, "page_id long, url string, host int")
    rows = url_filter.url_filter(pages).collect()
    assert len(rows) == 18
    for r in rows:
        _, host, path, rule, verdict = urls[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block") if verdict is None else r["verdict"] == verdict
    assert url_filter.url_filter(pages.limit(0)).count() == 0


def test_sharding(documents, make_documents):
    frame = documents.unionByName(make_documents(ODD))
    rows = sharding.sharding(frame).collect()
    texts = texts_of(frame)
    by_shard, mixture = {}, {}
    source = {r["doc_id"]: r["source"] for r in frame.collect()}
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "rows")
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        mixture.setdefault(source[r["doc_id"]], [0] * 40)[r["shard"]] += 1
    assert set(by_shard) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(max(m) - min(m) <= 2 for m in mixture.values())
    assert sharding.sharding(frame.limit(0)).count() == 0


def test_packing(documents, make_documents):
    copies = make_documents([(20_000 + i, "same text", None, "src0", 9) for i in range(30)])
    frame = documents.unionByName(make_documents(ODD)).unionByName(copies)
    items = packing.items_of(frame)
    placed = packing.pack(items, capacity=5000, per_source=3, group_rows=64).collect()
    info = {r["doc_id"]: r for r in items.collect()}
    bins, pieces = {}, {}
    for r in placed:
        bins.setdefault(r["bin_id"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert set(pieces) == set(info)
    for i, own in pieces.items():
        end = 0
        for start, length in sorted(own):
            assert start == end
            end += length
        assert end == info[i]["size"]
    for own in bins.values():
        assert sum(r["length"] for r in own) <= 5000
        clusters = [info[r["doc_id"]]["cluster"] for r in own if info[r["doc_id"]]["cluster"] is not None]
        sources = [info[r["doc_id"]]["source"] for r in own if info[r["doc_id"]]["source"] is not None]
        assert len(clusters) == len(set(clusters)) and all(sources.count(s) <= 3 for s in sources)
    assert packing.best_fit([6, 5, 4, 3, 2], [None] * 5, ["a", "b", "a", "c", "d"], 10, 3) == [0, 1, 1, 0, 2]
    assert packing.best_fit_packing(frame.limit(0)).count() == 0


def test_quality(documents, make_documents, spark):
    rows = {r["doc_id"]: r for r in quality.quality_classifier(with_odd(documents, make_documents)).collect()}
    labels = [r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if r["doc_id"] in rows]
    good = [rows[r["doc_id"]]["keep"] for r in labels if r["quality"] == 1]
    bad = [rows[r["doc_id"]]["keep"] for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.2 * len(bad)
    assert rows[9001]["score"] == rows[9002]["score"] == 0 and not rows[9001]["keep"]
    assert quality.quality_classifier(documents.limit(0)).count() == 0


def test_pipeline_stages(spark, documents, make_documents):
    docs = documents.unionByName(make_documents(ODD)).withColumn("extra", F.lit(1))
    before = {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == corpus_pipeline.COLUMNS, name
        after = {r["doc_id"] for r in docs.collect()}
        assert after <= before
        before = after
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert {r["doc_id"] for r in placed.collect()} == before and len(before) > 100


def test_every_operator_is_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES if k.startswith("op")} == set(range(1, 14)) and "pipeline" in QUERIES
