import hashlib
import random
import re

from florin.llm.personal_data import found_spans, personal_data, without_personal_data
from pyspark.sql import functions as F

# The plain forms of the base kinds.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def plain_spans(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m[0]):
                spans.append((m.start(), rank, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def check(frame, texts):
    rows = {r["doc_id"]: r for r in personal_data(frame).collect()}
    for doc_id, text in texts.items():
        spans = plain_spans(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        row = rows[doc_id]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (text, spans, row["spans"])
        for kind in PLAIN:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in spans)
        base = [s for s in row["spans"].split(",") if s.split(":")[0] in PLAIN]
        assert base == [f"{k}:{s}:{e}" for k, s, e in spans]


def test_given_documents(documents):
    check(documents, {r["doc_id"]: r["text"] for r in documents.collect()})


def test_edges(make_documents):
    cards = ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "0" * 12, "0" * 19, "0" * 20]
    texts = [
        None, "", " ", "x@y", "x@y.z", "a@b.com.c@d.org", "x@y.com_z@w.org", "a@b_c@d.org", "@a.b", "a@.b", "é@ü.de",
        "a@b.com+1 234 567 8901", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.0255", "1.2.3", "00000000256.1.1.1",
        "+1 (168) 555-5254", "+1", "+12345678", "+123456789.", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "++49 30 1234567",
        "😀 mail a@b.co 😀 1.1.1.1", "1 " * 30, "12-34-56-78", "5- 4111111111111111", *cards, *[f"pay {c} now {c}" for c in cards],
        "4111 1111 1111 1111@x.com", "x" * 50_000 + "@", "1." * 5000, "a@" + "b." * 5000, "1 " * 20_000, "+1" + "(" * 20_000,
    ]
    rows = list(enumerate(texts))
    check(make_documents(rows + rows[:3]), dict(rows))


def test_random(make_documents):
    rng = random.Random(3)
    parts = ["@", ".", "com", "a", "1", "23", "255", "+", " ", "-", "(", ")", "4111111111111111", "_", "\n", "é", "😀", "%"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))) for i in range(3000)]
    check(make_documents(rows), dict(rows))


def test_added_kinds_and_scores(make_documents):
    text = "Konto DE89 3704 0044 0532 0130 00 or DE89 3704 0044 0532 0130 01; call 555-123-4567, ref 555-123-4567"
    frame = make_documents([(1, text)])
    spans = found_spans(frame).collect()[0]["spans"]
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in spans] == [
        ("iban", "DE89 3704 0044 0532 0130 00"),
        ("tel", "555-123-4567"),
    ]
    assert spans[0]["score"] == 1.0 and abs(spans[1]["score"] - 0.6) < 1e-9


def test_masking(make_documents, documents):
    texts = {
        1: "mail a.b@c.org, +1 (168) 555-5254 or 4111 1111 1111 1111 at 10.0.0.1.",
        2: "nothing 2024 here",
        3: None,
        4: "4111 1111 1111 1111@x.com and 1.2.3.999",
        5: "",
    }
    rows = without_personal_data(make_documents(list(texts.items()))).select("doc_id", "text")
    assert dict(map(tuple, rows.collect())) == {
        1: "mail [EMAIL], [PHONE] or [CARD] at [IP].",
        2: texts[2],
        3: None,
        4: "[CARD]@x.com and 1.2.3.999",
        5: "",
    }
    again = without_personal_data(documents)
    assert again.columns == documents.columns
    assert all(r["spans"] == "" for r in personal_data(again).collect())


def test_empty_table_and_extra_columns(make_documents):
    empty = make_documents([]).withColumn("spans", F.lit(1)).withColumn("m", F.lit(2))
    assert personal_data(empty).count() == 0
    odd = make_documents([(1, "a@b.c")]).withColumns({"spans": F.lit(1), "p": F.lit(1), "kind": F.lit(1)})
    assert found_spans(odd).collect()[0]["kind"] == 1
    assert personal_data(odd).collect()[0]["n_email"] == 1
