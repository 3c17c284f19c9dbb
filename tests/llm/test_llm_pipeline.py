"""The pipeline, stage by stage, on small tables."""

import pytest
from texts import prose

import __spark_entry__ as entry_module
import corpus_pipeline as C
from veinworks.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    item = prose(777, 40)
    rows = [(k, prose(k, 80), "en", "s") for k in range(120)]
    rows += [(200 + k, " ".join(w + "***$$$" for w in prose(k, 80).split()), "en", "s") for k in range(60)]
    rows += [(300, prose(3, 80), "en", "s"), (301, prose(500, 30) + " " + item + " " + prose(501, 30), "en", "s")]
    rows += [(302, prose(502, 60) + " password=abcdefgh12 " + prose(503, 20), "fr", "s2"), (303, None, None, None)]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(k, int(k < 200), 0) for k, *_ in rows if k < 300]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_every_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES:
        out = C.written(stage(spark, docs, folder), f"test-{name}")
        assert name == "tokens" or out.columns == columns
        kept[name], docs = {r["doc_id"]: r.asDict() for r in out.collect()}, out
    clean = set(range(120)) | {302}
    assert clean | {300, 301} <= set(kept["quality"]) and not any(200 <= k < 300 for k in kept["quality"])
    assert set(kept["quality"]) - set(kept["near_duplicates"]) == {300}
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {301}
    assert set(kept["secrets"]) == set(kept["tokens"]) == set(kept["decontamination"]) >= clean
    text = kept["secrets"][302]["text"]
    assert "[secret]" in text and "abcdefgh12" not in text and kept["secrets"][302]["n_chars"] == len(text)
    whole = {r["doc_id"]: r.asDict() for r in C.run(spark, folder).collect()}
    assert whole == kept["tokens"]


def test_stages_of_odd_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    null = docs.where("doc_id is null or doc_id = 303").selectExpr("cast(null as long) as doc_id", *docs.columns[1:])
    odd = docs.where("doc_id in (1, 2, 303)").unionAll(docs.where("doc_id = 1")).unionAll(null)
    for rows in (odd, docs.limit(0)):
        for name, stage in C.STAGES:
            out = stage(spark, rows, folder)
            assert name == "tokens" or out.columns == docs.columns
            assert out.count() <= rows.count()
    assert sorted(r["doc_id"] for r in C.near_duplicates(spark, odd, "").where("doc_id is not null").collect()) == [1, 1, 2, 303]


def test_registered():
    names = entry_module.queries()
    assert set(queries.queries()) | {"pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
