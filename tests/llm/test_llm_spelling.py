"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from texts import no_docs, odd_docs

from veinworks.llm import spelling as S


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(docs, every=97):
    """The contract, word by word."""
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if key is not None and every:
                h = zlib.crc32(f"{key}:{run}".encode())
                if h % every == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    rows = {}
    for w in n:
        around = [v for v in n if near(w, v)]
        best = min(around, key=lambda v: (-n[v], v), default=None)
        rows[w] = (best if best and n[best] >= 2 * n[w] else None, len(around))

    def root(w):
        return root(rows[w][0]) if rows[w][0] else w

    return sorted((w, f, root(w), n[w], k, n[f] if f else None) for w, (f, k) in rows.items())


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    return sorted(rows)


def some_docs(n=60, seed=5):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abé×Éÿ") for _ in range(rng.randint(4, 7))) for _ in range(40)]
    out = []
    for k in range(n):
        words = []
        for _ in range(60):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "a", "b", "é", "ÿ"]) + w[at + rng.randint(0, 1) :]
            words.append(w if rng.random() < 0.8 else w.upper())
        out.append((k, rng.choice([" ", "-", "日"]).join(words)))
    return out


def test_variants_equal_brute_force(spark):
    chain = " ".join(["aaabbb"] * 30 + ["aaabbc"] * 70 + ["aaabbcd"] * 200)
    rows = some_docs() + [(None, chain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain(rows, 7)
    assert found(S.variants(S.vocabulary(docs, typo_every=7))) == want
    assert any(form for _, form, *_ in want) and any(form and root != form for _, form, root, *_ in want)


def test_rounds_and_shards_change_nothing(spark, monkeypatch):
    rows = some_docs(30, 8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(S, "SHARD_WORDS", 7)
    monkeypatch.setattr(S, "ROUND_BYTES", 5000)
    assert found(S.variants(S.vocabulary(docs))) == plain(rows, None)


def test_filter_knows_its_words_and_few_others():
    rng = np.random.default_rng(3)
    h = S.mixed(rng.integers(0, 1 << 63, 60_000).astype(np.uint64))
    bits = S.bloom(h[:30_000])
    assert len(S.known(bits, h[:30_000])) == 30_000
    assert len(S.known(bits, h[30_000:])) < 100


def test_edits_have_the_hash_of_the_edited_word():
    word, alphabet = "abbaé", np.array(sorted(map(ord, "abé")), np.uint32)
    codes = next(S.by_length([word]))[1]
    seen = set()
    for length, rows, at, new, h in S.edits(codes, alphabet):
        for c, value in zip(new, h, strict=True):
            edit = word[:at] + (chr(c) if c >= 0 else "") + word[at + 1 :]
            assert len(edit) == length and S.word_hashes(next(S.by_length([edit]))[1])[0] == value
            assert edit not in seen
            seen.add(edit)
    assert seen >= {"bbaé", "abaé", "abbé", "abba", "abbbé", "bbbaé", "abéaé"}


def test_odd_rows(spark):
    docs = odd_docs(spark, "word n form root")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(S.variants(S.vocabulary(docs, typo_every=97))) == plain(rows)
    assert S.variants(S.vocabulary(no_docs(spark))).count() == 0
    long = [(k, "x" * 30_000 + (" " + "x" * 29_999) * (k % 2)) for k in range(8)]
    df = spark.createDataFrame(long, "doc_id long, text string")
    assert [(len(w), f and len(f), n, k) for w, f, _, n, k, _ in found(S.variants(S.vocabulary(df)))] == [(29_999, 30_000, 4, 1), (30_000, None, 8, 1)]
