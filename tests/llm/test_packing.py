from florin.llm import packing


def test_equal_rows_are_dealt_to_all_groups(make_documents):
    rows = [(None, "the same words again", None, "hot", 20)] * 300
    rows += [(1000 + i, f"text number {i} of its own", None, f"s{i % 7}", 20) for i in range(600)]
    placed = packing.pack(packing.items_of(make_documents(rows)), group_rows=60).collect()
    groups = {}
    for r in placed:
        groups[r["bin_id"] >> 32] = groups.get(r["bin_id"] >> 32, 0) + 1
    assert len(placed) == 900 and max(groups.values()) < 150
