import random

import numpy as np
from pyspark.sql import functions as F

from florin.llm import language_id


def labelled(languages, texts, words):
    rng = random.Random(7)
    vocabulary = {name: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(words)] for name in languages}
    return [
        (i * len(languages) + j, " ".join(rng.choices(vocabulary[name], k=40)), name)
        for i in range(texts)
        for j, name in enumerate(languages)
    ]


def test_every_counted_gram_is_learned(make_documents):
    """As one model of all counts, though more grams than a million."""
    languages = ["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "ii", "jj", "kk", "ll"]
    docs = make_documents(labelled(languages, 240, 6000))
    counts = language_id.gram_counts(docs.select("lang", "text"), language_id.ORDER).toPandas()
    assert len(counts) > 1_000_000
    whole = language_id.build_model(*(counts[c].to_numpy() for c in ("lang", "k", "gram", "n")), language_id.ORDER)
    model = language_id.train(docs)
    assert model.languages == languages
    data = np.frombuffer(b"abcdefg hijkl" + labelled(languages, 1, 50)[0][1].encode(), np.uint8)
    offsets = np.array([0, 13, len(data)])
    assert np.allclose(model.code_lengths(data, offsets), whole.code_lengths(data, offsets), rtol=1e-5)


def test_every_language_is_learned(make_documents):
    languages = [f"l{i:03}" for i in range(260)]
    model = language_id.train(make_documents([(i, f"text {i}", name) for i, name in enumerate(languages)]))
    assert model.languages == languages


def test_sample_is_the_first_rows_by_hash(make_documents):
    """Rows of one doc_id come together, other languages' rows do not count."""
    rows = [(i % 50, f"{name} {i}", name) for name in ("aa", "bb") for i in range(60)]
    docs = make_documents(rows)
    hashed = sorted(map(tuple, docs.where("lang = 'aa'").select(F.xxhash64("doc_id", F.lit(11)), "doc_id").collect()))
    first = {doc_id for _, doc_id in hashed[:20]}
    found = [(r["lang"], r["text"]) for r in language_id.training_rows(docs, 20).collect()]
    assert sorted(found) == sorted((name, text) for doc_id, text, name in rows if doc_id in first)


def test_sample_is_the_same_by_groups(spark, make_documents, monkeypatch):
    """A common language over many tasks: the first rows by hash, however they are grouped; few rows meet in one task."""
    rows = [(i, f"text {i}", "aa" if i % 10 else "bb") for i in range(4000)]
    docs = make_documents(rows).repartition(40)
    hashed = sorted(map(tuple, docs.where("lang = 'aa'").select(F.xxhash64("doc_id", F.lit(11)), "doc_id").collect()))
    expected = sorted(f"text {doc_id}" for _, doc_id in hashed[:30])
    for groups in (1, 7, 64, 5000):
        monkeypatch.setattr(language_id, "SAMPLE_GROUPS", groups)
        sample = language_id.training_rows(docs, 30).collect()
        assert sorted(r["text"] for r in sample if r["lang"] == "aa") == expected
        assert sum(r["lang"] == "bb" for r in sample) == 30
