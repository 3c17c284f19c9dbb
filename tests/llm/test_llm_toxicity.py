"""Toxicity: the kernel against its definition, scores of held-out and disguised insults."""

import itertools
import random

import numpy as np
import pytest
from texts import no_docs, odd_docs, prose

from veinworks.llm import toxicity as T

IDS = "doc_id long, text string"
LABELS = "doc_id long, label int"
INSULTS = ["idiot", "worthless", "vequment", "vequance", "vequis"]


def plain_kernel(a, b, decay):
    """Triples of positions of both words with the same characters, by their lengths."""
    spans = lambda w: [("".join(w[k] for k in at), at[2] - at[0] + 1) for at in itertools.combinations(range(len(w)), 3)]
    return sum(decay ** (n + m) for x, n in spans(a) for y, m in spans(b) if x == y)


@pytest.mark.parametrize("decay", [0.6, 0.9])
def test_kernel_equals_its_definition(decay):
    landmarks, words = ["^idiot$", "^aaba", "^xyz$"], ["^idiot$", "^id-iot$", "^aabaab$", "a", "^", "^zyxxyz$", "日本語"]
    want = [[plain_kernel(w, m, decay) for m in landmarks] for w in words]
    assert np.allclose(T.Kernel(landmarks, decay).sums(words), want, rtol=1e-4)


def test_gaps_and_insertions_stay_near():
    kernel = T.Kernel(["^idiot$", "^moron$"])
    near = {w: kernel([T.framed(w)])[0, 0] ** (1 / T.SHARPNESS) for w in ["idiot", "idi-ot", "idiioot", "idxiot", "idea", "the"]}
    assert near["idiot"] == pytest.approx(1) and min(near[w] for w in ("idi-ot", "idiioot", "idxiot")) > T.LEAST_MATCH
    assert max(near["idea"], near["the"]) < T.LEAST_MATCH
    assert T.spellings("(i-d-i-o-t)!") == ["^i-d-i-o-t$", "^idiot$"] and T.spellings("--") == []
    assert T.sentences("You are an i d i o t. Yes\nno") == [["idiot"], ["you", "are", "an", "i", "d", "i", "o", "t."], ["yes"], ["no"]]
    assert "idiot" in T.tokens("an i d i o t here")


def labelled(n, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    for k in range(n):
        words = prose(k, 30 + k % 90).split()
        toxic = k % 6 == 0
        for _ in range(toxic * (1 + k // 6 % 2)):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return rows, labels


def test_held_out_and_disguised_insults(spark):
    rows, labels = labelled(400)
    docs = spark.createDataFrame(rows, IDS).repartition(3)
    model = T.fit(docs, spark.createDataFrame([x for x in labels if x[0] % 4], LABELS))
    scores = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    assert all((scores[k] >= 0.3) == bool(label) for k, label in labels if k % 4 == 0)
    assert all(0 <= s <= 1 for s in scores.values())
    base = prose(999, 60)
    disguised = ["you i-d-i-o-t", "you i d i o t", "an idiiot", "so wor*thless", "a Vequtre", "an IDIOT!"]
    more = spark.createDataFrame(list(enumerate([base, "", None] + [f"{base} {d} {base}" for d in disguised])), IDS)
    got = {r["doc_id"]: r["score"] for r in T.score(more, model).collect()}
    assert [got[k] >= 0.3 for k in range(9)] == [False] * 3 + [True] * 6


def test_memory_may_be_emptied(spark, monkeypatch):
    rows, labels = labelled(120)
    docs = spark.createDataFrame(rows, IDS).repartition(1)
    model = T.fit(docs, spark.createDataFrame(labels, LABELS))
    want = sorted(map(tuple, T.score(docs, model).collect()))
    memory = T.Matches(T.Kernel(model.landmarks))
    monkeypatch.setattr(T, "TOKENS", 10)
    import pyarrow as pa

    texts = pa.array([t for _, t in rows])
    assert [model.score(r) for r in T.matched(texts, memory)] == pytest.approx([s for _, s in want])


def test_worst_sentences_decide():
    x = np.array([[1.0, 0], [0.9, 0.1], [0, 1], [0.1, 0.8], [0, 0]])
    w, b = T.machine(x, np.array([1, 1, 0, 0, 0]), ridge=1e-3)
    assert ((x @ w + b > 0) == [True, True, False, False, False]).all()
    said = T.decided(x, w, b)
    assert said[0] == pytest.approx((x @ w + b).max()) and len(said) == 4


def test_sentences_that_teach():
    rows = np.array([[1, 0], [0, 0.5], [0, 0.2], [0, 0]])
    assert T.taught(rows, 0, np.ones(2), 0.0).tolist() == [[1, 0], [0, 0.5]]
    assert T.taught(rows, 1, np.array([1.0, -1]), 0.0).tolist() == [[1, 0]]
    assert T.taught(rows[3:], 1, np.ones(2), 0.0).tolist() == [[0, 0]]


def test_odd_rows(spark):
    docs = odd_docs(spark, "score label rows")
    none = spark.createDataFrame([], LABELS)
    assert {r["score"] for r in T.score(docs, T.fit(docs, none)).collect()} == {0.0}
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (None, 1), (5, 1), (4, 1), (8, 0)], LABELS)
    model = T.fit(docs, labels)
    assert model.landmarks == [] and 0 < model.share < 1
    rows, marks = labelled(200)
    model = T.fit(spark.createDataFrame(rows, IDS), spark.createDataFrame(marks, LABELS))
    got = T.score(docs, model).collect()
    assert len(got) == docs.count() and all(r["score"] < 0.3 for r in got)
    assert T.score(no_docs(spark), model).count() == 0
