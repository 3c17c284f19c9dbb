"""SimHash components and benchmark passages equal brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from texts import no_docs, odd_docs, prose

from veinworks.llm import decontaminate as D, simhash as S


def plain_fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + words]), 42) for i in range(max(1, len(w) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits):
    found = {p: p for p in prints}
    near = [(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= max_bits]
    last = None
    while last != found:
        last = dict(found)
        for a, b in near:
            found[a] = found[b] = min(found[a], found[b])
    return found


def test_fingerprints(spark):
    docs = odd_docs(spark, "fp")
    got = sorted(r["fp"] & (1 << 64) - 1 for r in S.fingerprints(docs).collect())
    assert got == sorted(plain_fingerprint(r["text"]) for r in docs.collect())


@pytest.mark.parametrize("bucket", [2, 16])
@pytest.mark.parametrize("max_bits", [1, 2])
def test_links_connect_what_brute_force_connects(spark, bucket, max_bits):
    rng = random.Random(max_bits)
    prints = [0, 1, (1 << 64) - 1]
    for _ in range(4):  # crowds around a value, within and just beyond reach
        centre = rng.getrandbits(64)
        prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for _ in range(30)]
        prints += [centre ^ 1 << b for b in range(0, 64, 5)]
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    pairs = S.links(df, max_bits, bucket).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits and a != b for a, b in pairs)
    nodes = df.select(F.col("fp").alias("node"))
    got = {r["node"]: r["component"] for r in S.connected_components(nodes, S.links(df, max_bits, bucket)).collect()}
    unsigned = {p: p & (1 << 64) - 1 for p in prints}
    found = plain_components(list(unsigned.values()), max_bits)
    groups = {}
    for p in prints:
        groups.setdefault(found[unsigned[p]], set()).add(p)
    same = {}
    for p in prints:
        same.setdefault(got[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, same.values()))


def test_near_duplicates_and_deduplicate(spark):
    docs = odd_docs(spark, "fp component_id")
    rows = S.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert by_id[4] == by_id[5] == 4 and by_id[0] == by_id[1] == by_id[2] == 0 and by_id[8] == 8
    kept = S.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [0, 4, 4, 7, 8, 9, 10, 11]
    assert kept.where("doc_id is null").count() == 2
    assert S.near_duplicates(no_docs(spark)).count() == 0 and S.deduplicate(no_docs(spark)).count() == 0


def plain_edits(item, text):
    """Fewest edits that turn the item into a passage of the text."""
    a, b = D.codes(item).tolist(), D.codes(text).tolist()
    row = [0] * (len(b) + 1)
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_passages_equal_brute_force():
    rng, letters = random.Random(5), "abcde fgh "

    def noise(n):
        return "".join(rng.choice(letters) for _ in range(n))

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], [rng.choice(letters)], [text[at], rng.choice(letters)]])
        return "".join(text)

    items = [noise(rng.randint(12, 160)) for _ in range(12)]
    texts = [noise(rng.randint(0, 90)) + edited(rng.choice(items), rng.randint(0, 9)) + noise(rng.randint(0, 90)) for _ in range(80)]
    texts += ["", items[0].upper().replace(" ", "\n"), items[1] * 3]
    rows = list(enumerate(items))
    edits = D.Items.build(rows, D.Q, D.EDITS).edits
    got = {(t, i): (e, a, b) for t, i, e, a, b in D._finder(rows, D.Q, D.EDITS)(texts)}
    for t, text in enumerate(texts):
        for i, item in rows:
            want = plain_edits(item, text)
            assert (t, i) in got if want <= edits[i] else (t, i) not in got
            if (t, i) in got:
                e, a, b = got[t, i]
                assert e == want and plain_edits(item, text[a:b]) == want


def test_crowded_texts_count_the_same_bands(monkeypatch):
    rng = random.Random(9)
    items = ["x" * 60, "ab" * 40, "".join(rng.choice("abc ") for _ in range(90)), "x" * 30 + "y" + "x" * 30]
    texts = ["x" * 300, "ab" * 100 + "x" * 50 + items[2] + "ba" * 50, "x" * 70 + "y" + "x" * 90, "ab" * 10, "q" * 40]
    rows = list(enumerate(items))
    want = D._finder(rows, D.Q, D.EDITS)(texts)
    assert {(t, i) for t, i, *_ in want} >= {(0, 0), (1, 1), (1, 2), (2, 3)}
    for laid_out in (1, 7, 60, 2000):  # nearly all by correlation, some, none
        monkeypatch.setattr(D, "LAID_OUT", laid_out)
        assert D._finder(rows, D.Q, D.EDITS)(texts) == want


def test_diagonals_equal_all_pairs(monkeypatch):
    monkeypatch.setattr(D, "LAID_OUT", 16)
    rng = np.random.default_rng(3)
    position, offset = np.sort(rng.choice(200, 80, replace=False)), rng.choice(40, 25, replace=False)
    got = D.diagonal_counts(position, offset, 200, 40)
    assert got.tolist() == np.bincount((position[:, None] - offset + 39).ravel(), minlength=240).tolist()


def test_one_repeated_character_needs_little_memory():
    import tracemalloc

    find = D._finder([(1, "x" * 10_000)], D.Q, D.EDITS)
    find(["warm"])
    tracemalloc.start()
    assert find(["x" * 1_000_000]) == [(0, 0, 0, 0, 10_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20


def test_short_items_match_as_whole_words(spark):
    docs = spark.createDataFrame([(1, "say hello, you"), (2, "othello"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "Hello"), (8, ""), (9, None), (10, "zz")], "item_id long, text string")
    assert [tuple(r) for r in D.find_passages(docs, items).collect()] == [(1, 7, 0, 4, 9)]


def test_blocks_of_items_and_odd_rows(spark):
    docs = odd_docs(spark, "item_id edits start").union(odd_docs(spark, "item_id edits start").limit(0))
    passage = prose(1, 60)[20:160]
    rows = [(k, f"{prose(k, 30)} {k}") for k in range(100, 130)] + [(1, passage), (1, passage), (None, passage), (2, None)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    for block in (100, 1 << 20):
        got = sorted(tuple(r) for r in D.find_passages(docs, items, block_chars=block).where("item_id = 1").collect())
        assert [r[0] for r in got] == [4] * 4 + [5] * 4 and {r[2:] for r in got} == {(0, 20, 160)}
        clean = D.drop_contaminated(docs, items, block_chars=block)
        assert clean.columns == docs.columns and clean.count() == docs.count() - 4
    assert D.find_passages(no_docs(spark), items).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == docs.count()


def test_gram_hashes_depend_on_the_gram_only():
    chars = np.frombuffer("abcabcabcabcabcabcabc".encode("utf-32-le"), "<u4")
    for q in (1, 2, 3, 5, 7, 12):
        found = D.gram_hashes(chars, q)
        grams = [chars[i : i + q].tobytes() for i in range(len(chars) - q + 1)]
        assert len(found) == len(grams) and len(set(found.tolist())) == len(set(grams))
        assert all((found[i] == found[j]) == (grams[i] == grams[j]) for i in range(len(grams)) for j in range(len(grams)))


def test_index_entries_are_never_broadcast(spark, monkeypatch):
    """Entries are dozens of times the fingerprints, which Spark's estimate of an explode leaves out."""
    plans, kept = [], S.written

    def watched(df, name, **options):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return kept(df, name, **options)

    monkeypatch.setattr(S, "written", watched)
    prints = kept(spark.range(200).select((F.col("id") * 3).alias("fp")), "prints")
    pairs = S.links(prints, 2, 4)
    plans += [df._jdf.queryExecution().sparkPlan().toString() for df in (pairs, S.stars(prints, 1), S.stars(prints, 2))]
    assert len(plans) == 4 and not [p for p in plans if "Broadcast" in p]
