from florin.llm import jaccard_join


def test_missing_and_repeated_doc_ids(make_documents):
    base, other, third = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(None, base), (None, base), (None, base + " x"), (None, base.upper())]
    rows += [(5, other), (5, other + " y"), (5, other), (6, other), (None, other)]
    rows += [(None, third), (9, third + " z"), (8, third), (8, third)]
    rows += [(None, None), (None, ""), (None, ""), (7, ""), (7, "")]
    kept = [(r["doc_id"], r["text"]) for r in jaccard_join.one_of_each(make_documents(rows)).collect()]
    groups = {c: [k for k in kept if k[1] and k[1].lower().startswith(f"{c}0")] for c in "abc"}
    assert [len(g) for g in groups.values()] == [1, 1, 1]
    assert [groups[c][0][0] for c in "abc"] == [None, 5, 8]
    empty = sorted((k for k in kept if not k[1]), key=str)
    assert empty == sorted([(None, None), (None, ""), (None, ""), (7, "")], key=str)
