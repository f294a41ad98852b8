from florin.llm.personal_data import found_spans, without_personal_data


def test_context_of_a_list(make_documents):
    many = ", ".join(f"415-555-{i:04}" for i in range(600))
    texts = {
        1: "Phones: 415-555-1234, 415-555-9876 / 415-555-1111",
        2: "call 415-555-1234, ref 415-555-9876, 415-555-9877",
        3: "415-555-1234, 415-555-9876",
        4: f"phone {many}; item {many}",
    }
    frame = make_documents(list(texts.items()))
    found = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in found_spans(frame).collect()}
    assert found == {1: ["tel"] * 3, 2: ["tel"], 3: [], 4: ["tel"] * 600}
    masked = {r["doc_id"]: r["text"] for r in without_personal_data(frame).collect()}
    assert masked[1] == "Phones: [PHONE], [PHONE] / [PHONE]" and masked[3] == texts[3]
    assert masked[2] == "call [PHONE], ref 415-555-9876, 415-555-9877"
    assert masked[4] == "phone " + ", ".join(["[PHONE]"] * 600) + f"; item {many}"
