import numpy as np
import pyarrow as pa

from florin.llm import quality
from florin.llm.textbytes import flat

WORDS = ["alpha", "beta", "gamma", "delta", "epsilon"]


def test_sample_and_slots(make_documents):
    docs = make_documents([(i, " ".join(WORDS[i // 5**j % 5] for j in range(6))) for i in range(4500)])
    assert (quality.SAMPLE_DOCS, quality.SLOTS) == (4000, 4096)
    assert quality._sampled(docs, "text", quality.SAMPLE_DOCS).count() == 4000
    assert quality.train(docs).weights.shape == (4096,)


def test_features_are_of_the_text_alone():
    texts = pa.array(["Some short text, 1.", "??", "", "x", "a longer one of three lines\n\n- so"])
    together = quality.features(*flat(texts))
    for i in range(len(texts)):
        assert (quality.features(*flat(texts[i : i + 1])) == together[i]).all()


def plain_posteriors(patterns):
    """Expectation maximisation over single documents, vote by vote."""
    n, names = len(patterns), len(quality.HEURISTICS)
    votes = [[p // 3**j % 3 for j in range(names)] for p in patterns]
    good = []
    for v in votes:
        balance = 1.0 + v.count(quality.GOOD) - 5.0 * v.count(quality.BAD)
        good.append(1 / (1 + np.exp(-balance)))
    for _ in range(quality.ROUNDS):
        sides = [[1 - g for g in good], good]
        total = [sum(s) for s in sides]
        prior = [(t + 1) / (n + 2) for t in total]
        table = []
        for j in range(names):
            believed = quality.BELIEVED_ONE_SIDED if quality.HEURISTICS[j][4] == quality.NEVER else quality.BELIEVED_TWO_SIDED
            rows = []
            for c in (0, 1):
                row = [sum(w for w, v in zip(sides[c], votes, strict=True) if v[j] == k) + 0.5 + quality.BELIEF * total[c] * believed[c][k] for k in range(3)]
                rows.append([x / sum(row) for x in row])
            table.append(rows)
        good = []
        for v in votes:
            log = [np.log(prior[c]) + sum(np.log(table[j][c][v[j]]) for j in range(names)) for c in (0, 1)]
            good.append(1 / (1 + np.exp(log[0] - log[1])))
    return good


def test_posteriors_and_scores_by_plain_sums(documents):
    """Labels by single documents instead of patterns, and scores by one dot product a text."""
    docs = documents.where("length(text) > 0")
    rows = docs.select("text", quality.vote_pattern(docs["text"]).alias("pattern")).collect()
    known, count = np.unique([r["pattern"] for r in rows], return_counts=True)
    found, _ = quality.posteriors(known, count.astype(float))
    assert np.allclose(found[np.searchsorted(known, [r["pattern"] for r in rows])], plain_posteriors([r["pattern"] for r in rows]), atol=1e-9)

    scorer = quality.train(docs)
    label_of = dict(zip(known.tolist(), found.tolist(), strict=True))
    texts = sorted({r["text"]: r["pattern"] for r in rows}.items())
    assert len(texts) <= quality.SAMPLE_DOCS
    x = np.vstack([quality.features(*flat(pa.array([t]))) for t, _ in texts]).astype(np.float16).astype(np.float32)
    weights, bias = quality.fit(x, np.array([label_of[p] for _, p in texts], np.float32))
    scores = {r["text"]: r["score"] for r in docs.select("text", quality.quality_score(docs, scorer).alias("score")).collect()}
    for t, _ in texts:
        plain = float(quality.features(*flat(pa.array([t])))[0] @ scorer.weights + scorer.bias)
        assert abs(scores[t] - 1 / (1 + np.exp(-plain))) < 1e-5
    own = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert np.mean((own >= quality.THRESHOLD) == (np.array([scores[t] for t, _ in texts]) >= quality.THRESHOLD)) > 0.995
