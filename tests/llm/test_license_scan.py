"""License scans against a plain search of all runs of words."""

import random

import pytest
from plain import ODD, bench_words

from florin.llm import license_scan
from florin.llm.license_scan import BASE, NOTICES, SHORT_WORD, allowed_edits


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(text):
    """The contract's row, from every run of words."""
    words = bench_words(text)
    exact, labels, score = [], set(), 0.0
    for phrase, label in NOTICES:
        n, edits = len(phrase.split()), allowed_edits(phrase)
        short = {w for w in phrase.split() if len(w) < SHORT_WORD}
        for k in range(len(words)):
            if words[k : k + n] == phrase.split() and (phrase, label) in BASE:
                exact.append((k, label))
            for width in range(max(1, n - edits), n + edits + 1):
                run = words[k : k + width]
                if len(run) < width or abs(len(" ".join(run)) - len(phrase)) > edits or not short <= set(run):
                    continue
                far = distance(" ".join(run), phrase)
                if far <= edits:
                    labels.add(label)
                    score = max(score, 1.0 - far / len(phrase))
    places = [k for k, _ in exact]
    return (
        len(words), len(exact), min(places, default=None), max(places, default=None),
        ",".join(sorted({label for _, label in exact})), ",".join(sorted(labels)), score,
    )


FIELDS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def assert_plain(make_documents, rows):
    found = license_scan.license_scan(make_documents(rows)).collect()
    assert sorted((r["doc_id"], *(r[f] for f in FIELDS)) for r in found) == sorted((i, *plain(t)) for i, t in rows)


def mutated(rng, phrase):
    text = list(phrase)
    for _ in range(rng.randrange(4)):
        at = rng.randrange(len(text))
        text[at : at + rng.randrange(2)] = rng.choice(["", "x", "é", " ", "s", "-", "\n"])
    return "".join(c.upper() if rng.random() < 0.2 else c for c in text)


def test_random_edits_give_the_plain_result(make_documents):
    rng = random.Random(11)
    filler = ["the", "license", "public", "mit", "General", "common", "é", "rights;", "---", "permit", "cc", "by", "apache", "x" * 40]
    rows = [
        (i, rng.choice([" ", "\n", "  ", "-"]).join(rng.choice(filler) if rng.random() < 0.6 else mutated(rng, rng.choice(NOTICES)[0]) for _ in range(rng.randrange(30))))
        for i in range(400)
    ]
    assert_plain(make_documents, rows + ODD)


def test_words_around_and_between(make_documents):
    rows = [
        (1, "MIT License"), (2, "mit\n\n***license, the Apache--License"), (3, "permit license"), (4, "mit licenses mit license"),
        (5, "mit mit license license"), (6, "emit license"), (7, "MIT Licence"), (8, "General Publik Licence"),
        (9, "generalpublic license"), (10, "é mit license é"), (11, "mit"), (12, "mit license" * 3), (13, "x" * 5000 + " mit license"),
    ]
    assert_plain(make_documents, rows)


def test_notices_do_not_cross_texts(make_documents):
    found = license_scan.license_scan(make_documents([(1, "a mit"), (2, "license"), (3, "mit lice"), (4, None), (5, "nse")])).collect()
    assert {r["labels"] for r in found} == {""}


def test_spans_are_of_the_text(make_documents):
    text = "Über \U0001f600: released under the  M.I.T.\nMIT -- Licence; all rights\treserved"
    row = license_scan.find_notices(make_documents([(1, text)])).first()
    assert row["text"] == text and row["n_words"] == 13
    spans = {s["label"]: s for s in row["notices"]}
    assert set(spans) == {"mit", "reserved"}
    for span in spans.values():
        assert text[span["start"] : span["end"]] == span["text"]
    assert spans["mit"]["text"] == "MIT -- Licence" and spans["mit"]["edits"] == 1 and spans["mit"]["word"] == 8


def test_own_notices_beyond_ascii(make_documents):
    notice = [("liberté égalité fraternité", "f")]
    texts = ["Liberté, égalité, fraternité", "liberte égalité fraternité!", "liberté égalite, fraternitè", "liberte egalite fraternite"]
    found = license_scan.find_notices(make_documents(list(enumerate(texts))), notice).collect()
    assert {r["doc_id"]: [s["edits"] for s in r["notices"]] for r in found} == {0: [0], 1: [1], 2: [2], 3: []}


@pytest.mark.parametrize("copies", [1, 3])
def test_hot_text(make_documents, copies):
    """Every place counts in a text of many notices, whatever its length."""
    rows = [(None, "mit license " * 5000)] * copies
    for row in license_scan.license_scan(make_documents(rows)).collect():
        assert (row["n_base"], row["first_word"], row["last_word"], row["score"]) == (5000, 0, 9998, 1.0)
