"""The corpus pipeline: documents through stages of operators, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veinworks.llm.base import table, written
from veinworks.llm.bpe import default_tokenizer, digests, encode
from veinworks.llm.decontaminate import drop_contaminated
from veinworks.llm.quality_classifier import fit, score_rows, stats, training_labels
from veinworks.llm.secrets import mask
from veinworks.llm.simhash import deduplicate

LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of this input.

    Null texts are scored as empty ones, rows with a null id teach nothing,
    repeated rows are scored alike; no documents give no documents.
    """
    labels = training_labels(table(spark, sf_dir, "labels"))
    model = fit(stats(docs.join(labels.select("doc_id").distinct(), "doc_id", "left_semi")), labels)
    return score_rows(docs, model, "_quality").where(F.col("_quality") >= LEAST_QUALITY).drop("_quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id.

    Fingerprints of 3-word shingles link at 2 or fewer differing bits. Null
    texts count as empty and form one group; rows with a null id stay.
    """
    return deduplicate(docs, words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; null texts hold none."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents stay, null texts as they are."""
    masked = mask(docs, F.col("source"), F.concat_ws("/", "source", "lang"))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of what is left and the text that they decode to, as digests; a null text counts as empty."""
    return digests(encode(docs.select("doc_id", "text"), default_tokenizer("word_bpe_49k.json")))


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets),
    ("tokens", tokens),
]

# SQL cannot express trained models and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, from the ``documents`` of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
