"""References of the divergence rules: every language, every distinct text."""

import json

from texts import prose

from veinworks.llm import quality_rules as R

DOCS = "doc_id long, text string, lang string"


def other(k, n=150):
    """Prose of a second language, whose words and letters are not those of ``prose``."""
    return " ".join(w[::-1].upper() + "ß" for w in prose(k, n).split())


def test_rare_languages_are_not_measured_against_others(spark):
    main = [(k, prose(k, 20_000), "en") for k in range(400)]
    rare = [(1000 + k, other(k), "de") for k in range(40)]  # 6,000 words: below 0.1 % of all, enough for a reference
    few = [(2000 + k, other(k), "xx") for k in range(3)]  # too few words
    noise = [(3000 + k, " ".join(f"zq{k}x{i}ab" for i in range(150)), "de") for k in range(3)]
    docs = spark.createDataFrame(main + rare + few + noise, DOCS).repartition(8)
    kept = {r["doc_id"]: r["kept"] for r in R.judge(docs).collect()}
    assert all(kept[k] for k, *_ in rare + few) and not any(kept[k] for k, *_ in noise)


def test_every_distinct_text_counts(spark):
    footer = " a aa aaa"  # shared by all, whichever shingle hash is smallest
    rows = [(k, f"w{k} " + prose(1, 300) + footer, "en") for k in range(30)]
    rows += [(100, rows[0][1], "en"), (101, rows[0][1], "fr"), (102, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r["lang"]: json.loads(r["reference"]) for r in R.references(docs, R.Rules(language_words=1)).collect()}
    assert {k: v["total"] for k, v in got.items()} == {"en": 30 * 304, "fr": 304}
    assert dict(zip(got["en"]["words"], got["en"]["word_counts"], strict=True))["aaa"] == 30
