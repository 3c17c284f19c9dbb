"""Trained scores: quality and language model."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from texts import no_docs, odd_docs, prose

from veinworks.llm import lm_scoring as L, quality_classifier as Q
from veinworks.llm.charclass import CLASSES, class_counts, class_table

IDS = "doc_id long, text string"


def junk(seed, n):
    rng = random.Random(seed)
    return " ".join(w + rng.choice(["***", "$$$", "&&&"]) for w in prose(seed, n).split())


def test_class_counts():
    got = dict(zip(CLASSES, class_counts("aÀ3 \n.-#日​😀", class_table()).tolist(), strict=True))
    want = {"lower": 1, "upper": 1, "letter": 1, "digit": 1, "space": 1, "line": 1, "stop": 1, "mark": 1, "symbol": 1, "other": 2}
    assert got == want


def test_isotonic_pools_violators():
    x, y = Q.isotonic([(0, 0, 1), (1, 1, 1), (2, 0, 1), (3, 0.5, 2), (4, 2, 1)])
    assert x.tolist() == [0, 2.25, 4] and y.tolist() == [0, 0.5, 2]


def test_normal_equations_equal_direct_sums(spark):
    rng = np.random.default_rng(1)
    rows = [([float(v) for v in rng.normal(size=len(Q.STATS))], float(k % 2), k % 3) for k in range(60)]
    df = spark.createDataFrame(rows, "stats array<double>, label double, fold int").repartition(4)
    width = len(Q.STATS)
    model = Q.Model(np.zeros(width), np.ones(width), rng.normal(size=(width, 8)), np.zeros(8), np.zeros(0), np.zeros(1), np.zeros(1))
    gram, moment = Q._normal_equations(df, model, 3)
    for f in range(3):
        z = model.features(np.array([r[0] for r in rows if r[2] == f]))
        y = np.array([r[1] for r in rows if r[2] == f])
        assert np.allclose(gram[f], z.T @ z) and np.allclose(moment[f], z.T @ y)


def test_random_features_approximate_the_kernel():
    rng, width = np.random.default_rng(2), len(Q.STATS)
    waves, shift = rng.normal(size=(width, 4000)) / math.sqrt(width), rng.uniform(0, 2 * math.pi, 4000)
    model = Q.Model(np.zeros(width), np.ones(width), waves, shift, np.zeros(0), np.zeros(1), np.zeros(1))
    x = rng.normal(size=(6, width))
    z = model.features(x)[:, 1 + width :]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * width))
    assert np.abs(z @ z.T - kernel).max() < 0.1


def test_quality_of_held_out_documents(spark):
    rows = [(k, junk(k, 40 + k % 60) if k % 4 == 0 else prose(k, 40 + k % 60)) for k in range(300)]
    docs = spark.createDataFrame(rows, IDS)
    labels = spark.createDataFrame([(k, float(k % 4 != 0)) for k, _ in rows if k % 5], "doc_id long, label double")
    found = Q.stats(docs)
    model = Q.fit(found, labels, features=64)
    scores = {r["doc_id"]: r["score"] for r in Q.score_stats(found, model).collect()}
    assert all((scores[k] >= 0.3) == (k % 4 != 0) for k, _ in rows if k % 5 == 0)
    assert all(0 <= s <= 1 for s in scores.values())
    rescored = Q.score_rows(docs.selectExpr("*", "'x' as score"), model, "score").collect()
    assert {r["doc_id"]: r["score"] for r in rescored} == pytest.approx(scores)


def test_quality_of_odd_rows(spark):
    docs = odd_docs(spark, "stats score label")
    found = Q.stats(docs)
    none = spark.createDataFrame([], "doc_id long, label double")
    assert {r["score"] for r in Q.score_stats(found, Q.fit(found, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(0, 1.0), (0, 0.0), (1, None), (None, 1.0), (5, 1.0), (4, 1.0), (8, 0.0)], "doc_id long, label double")
    rows = Q.score_stats(found, Q.fit(found, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert Q.score_stats(Q.stats(no_docs(spark)), Q.fit(Q.stats(no_docs(spark)), labels)).count() == 0


def plain_model(docs):
    """Bigram and unigram interpolation by dictionaries, with weights from all left-out tokens."""
    tokens = {k: (t or "").encode().lower().split() + [None] for k, t in docs}
    fold = {k: zlib.crc32(str(k).encode()) % 5 for k in tokens}

    def counts(keys):
        one, two, n = Counter(), Counter(), 0
        for k in keys:
            one.update(tokens[k])
            two.update(zip(["<s>", *tokens[k]], tokens[k], strict=False))
            n += 1
        one["<s>"] = 0
        return one, two, n

    def parts(c, before, w):
        one, two, n = c
        total, types = sum(one.values()), sum(v > 0 for v in one.values())
        context = n if before == "<s>" else one[before]
        return (one[w] + 0.5) / (total + 0.5 * (types + 1)), two[before, w] / max(1, context), context

    kept = counts(k for k in tokens if fold[k] not in (0, 1))
    seen = {}
    for k in tokens:
        if fold[k] == 0:
            for before, w in zip(["<s>", *tokens[k]], tokens[k], strict=False):
                p1, p2, c = parts(kept, before, w)
                if c:
                    seen.setdefault(int(math.log2(c + 1)), []).append(p2 / p1)
    weight = {b: 0.5 for b in seen}
    for _ in range(L.EM_ROUNDS):
        weight = {b: sum(weight[b] * r / (weight[b] * r + 1 - weight[b]) for r in rs) / len(rs) for b, rs in seen.items()}
    every, out = counts(k for k in tokens if fold[k] != 1), {}
    for k in tokens:
        base = score = 0.0
        for before, w in zip(["<s>", *tokens[k]], tokens[k], strict=False):
            p1, p2, c = parts(every, before, w)
            b = int(math.log2(c + 1))
            lam = weight.get(b, weight.get(max((x for x in weight if x < b), default=None), 0.5)) if c else 0.0
            base, score = base + math.log10(p1), score + math.log10(lam * p2 + (1 - lam) * p1)
        known = sum(every[0][w] > 0 for w in tokens[k])
        out[k] = (fold[k] == 1, len(tokens[k]), known, sum(every[0].values()), base, score)
    return out


def test_scores_equal_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(L, "GROUP_TOKENS", 700)  # several buckets of n-grams
    docs = [(k, " ".join(prose(k % 40, 10 + k % 90).split()) + f" rare{k % 7} the of") for k in range(150)] + [(150, None), (151, " \n")]
    want = plain_model(docs)
    rows = L.score_texts(spark.createDataFrame(docs, IDS), lot_chars=4000).collect()
    assert len(rows) == len(docs)
    for r in rows:
        w = want[r["doc_id"]]
        assert tuple(r)[1:5] == w[:4]
        assert r["base_score"] == pytest.approx(w[4], rel=1e-9) and r["score"] == pytest.approx(w[5], rel=0.01)


def test_bigram_estimates_are_probabilities():
    own = L.Lot.read([0, 2], [3, 2], np.arange(4, dtype="<u8").tobytes(), L.pack(np.array([1, 2, 1, 3, 1])))
    assert own.token.tolist() == [1, 2, 1, 0, 3, 1, 0] and own.context.tolist() == [-1, 1, 2, 1, -1, 3, 1]
    words, pairs = (sum(x) for x in own.tallies(1, 0))
    unigram, bigram, context = L.estimates(own, words, pairs, 7, 4, 2)
    assert bigram.tolist() == [0.5, 1 / 3, 1.0, 2 / 3, 0.5, 1.0, 2 / 3] and context.tolist() == [2, 3, 1, 3, 2, 1, 3]
    assert unigram[0] == (3 + 0.5) / (7 + 2.5)


def test_scores_of_odd_rows(spark):
    docs = odd_docs(spark, "score fold lot")
    rows = L.score_texts(docs).collect()
    assert len(rows) == docs.count() and all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert [r["n_tokens"] for r in rows if r["doc_id"] in (0, 1, 2)] == [1, 1, 1]
    assert L.score_texts(no_docs(spark)).count() == 0
    only = spark.createDataFrame([(k, "a b") for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1], IDS)
    assert {(r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in L.score_texts(only).collect()} == {(0, 0, 0.0, 0.0)}
