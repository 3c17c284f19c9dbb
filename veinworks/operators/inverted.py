"""A stored inverted index, and ranked search that reads only what it asks for.

Postings are written once, in buckets by term, with the number of documents and
the largest count of each term; documents in buckets by id. A batch of queries
opens the buckets of its terms. The postings of these terms are dealt into blocks
of documents, the queries into blocks of their own; where two blocks meet, one
task scores all pairs as a matrix product and keeps the best of each query, so a
pair of query and document is never a row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veinworks.functions.text import tokens
from veinworks.session import durable

BUCKETS = 64
# Scores are rounded so that equal ones tie whatever the order of summation.
SCORE_DIGITS = 9
BLOCK_POSTINGS = 500_000
BLOCK_QUERIES, BLOCK_WORDS = 512, 20_000  # of a block of queries: queries, and words of all of them
CELLS = 2_000_000


def bucket_of(col: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def write_index(corpus: DataFrame, folder: str, doc_id: str = "doc_id", buckets: int = BUCKETS) -> str:
    """Write postings, terms and documents of (doc_id, title, url, text); returns the folder.

    A common term's postings may fill several files of its bucket. Null texts
    have no terms.
    """
    spark = corpus.sparkSession
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    words = corpus.select(doc_id, F.explode(tokens(F.col("text"))).alias("term"))
    counted = words.groupBy("term", doc_id).agg(F.count(F.lit(1)).alias("tf")).withColumn("bucket", bucket_of(F.col("term"), buckets))
    counted = durable(counted)  # ranges are found from it before it is dealt by them
    dealt = counted.repartitionByRange(parts, "bucket", "term", doc_id).sortWithinPartitions("bucket", "term", doc_id)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/postings")
    terms = counted.groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("df"), F.max("tf").alias("max_tf"))
    terms.repartition(buckets, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/terms")
    docs = corpus.select(doc_id, "title", "url", "text", bucket_of(F.col(doc_id), buckets).alias("bucket"))
    docs.repartition(parts, doc_id).sortWithinPartitions("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/documents")
    about = corpus.agg(F.count(F.lit(1)).alias("documents")).withColumn("buckets", F.lit(buckets))
    about.coalesce(1).write.mode("overwrite").parquet(f"{folder}/about")
    return folder


def _opened(spark: SparkSession, path: str, rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """The table at ``path``, only the buckets that the values of ``key`` lie in."""
    found = rows.select(bucket_of(F.col(key), buckets).alias("b")).distinct().collect()  # at most ``buckets`` rows
    return spark.read.parquet(path).where(F.col("bucket").isin([r["b"] for r in found])).drop("bucket")


def search_index(folder: str, queries: DataFrame, max_results: int = 10, match: str = "all", doc_id: str = "doc_id") -> DataFrame:
    """(query_id, rank, doc_id, title, url, snippet, score) for a batch of queries.

    The score sums term frequency × ln(1 + documents / documents with the term);
    ties go to the smaller id. ``match='all'`` asks for every term, ``'any'`` for
    one. A query that holds no term has no hits.
    """
    if match not in ("all", "any"):
        raise ValueError("match must be 'all' or 'any'")
    spark = queries.sparkSession
    about = spark.read.parquet(f"{folder}/about").first()
    asked = durable(queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term")))
    terms = _opened(spark, f"{folder}/terms", asked, "term", about["buckets"])
    postings = _opened(spark, f"{folder}/postings", asked, "term", about["buckets"])
    idf = F.log(1 + F.lit(about["documents"]) / F.col("df"))
    known = durable(asked.join(terms, "term").select("query_id", "term", "df", idf.alias("idf")))
    needed = asked.groupBy("query_id").agg(F.count("term").alias("needed"))
    # Queries and terms by number, as ids may be of any type.
    needed = durable(needed.withColumn("query", F.monotonically_increasing_id()))
    numbers = durable(known.select("term", "df").distinct().withColumn("number", F.monotonically_increasing_id()))
    plan = known.join(needed, "query_id").join(numbers.select("term", "number"), "term").select("query", "number", "idf", "needed")
    size = plan.agg(F.count(F.lit(1)), F.count_distinct("query")).first()
    found = numbers.agg(F.sum("df")).first()[0] or 0
    d_blocks, q_blocks = max(1, -(-found // BLOCK_POSTINGS)), max(1, -(-size[0] // BLOCK_WORDS), -(-size[1] // BLOCK_QUERIES))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    wanted = postings.where(F.col(doc_id).isNotNull()).join(numbers.select("term", "number"), "term")
    left = wanted.select("number", doc_id, "tf", F.pmod(F.xxhash64(doc_id), F.lit(d_blocks)).cast("int").alias("d"), every(q_blocks).alias("q"))
    right = plan.select("*", F.pmod(F.xxhash64("query"), F.lit(q_blocks)).cast("int").alias("q"), every(d_blocks).alias("d"))
    kind = postings.schema[doc_id].dataType.simpleString()
    best = left.groupBy("d", "q").cogroup(right.groupBy("d", "q")).applyInArrow(
        _best_of_block(doc_id, max_results, match), f"query long, `{doc_id}` {kind}, score double"
    )
    w = Window.partitionBy("query").orderBy(F.desc("score"), doc_id)
    best = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_results)
    top = durable(best.join(needed, "query").select("query_id", "rank", doc_id, F.round("score", SCORE_DIGITS).alias("score")))
    documents = _opened(spark, f"{folder}/documents", top, doc_id, about["buckets"])
    return top.join(documents, doc_id).select("query_id", "rank", doc_id, "title", "url", F.col("text").alias("snippet"), "score")


def _best_of_block(doc_id: str, k: int, match: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(query, document, score): the k best documents of a block for each query of another block.

    Scores come from a matrix product over slices of documents; of equal scores
    the smaller id is the better. ``match='all'`` leaves out documents without
    all terms of the query.
    """

    def run(postings: pa.Table, plan: pa.Table) -> pa.Table:
        ids = postings[doc_id].combine_chunks()
        names = ids.unique().sort()
        hits = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(names) and plan.num_rows:
            queries, query = np.unique(plan["query"].to_numpy(), return_inverse=True)
            words, word = np.unique(plan["number"].to_numpy(), return_inverse=True)
            weight, uses = np.zeros((len(words), len(queries))), np.zeros((len(words), len(queries)))
            np.add.at(weight, (word, query), plan["idf"].to_numpy())
            np.add.at(uses, (word, query), 1.0)
            needed = np.zeros(len(queries))
            needed[query] = plan["needed"].to_numpy()
            doc = pc.index_in(ids, names).to_numpy()
            asked, tf = postings["number"].to_numpy(), postings["tf"].to_numpy()
            at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
            own = words[at] == asked
            order = doc[own].argsort(kind="stable")
            doc, at, tf = doc[own][order], at[own][order], tf[own][order].astype(float)
            step = max(1, CELLS // max(len(words), len(queries)))
            for low in range(0, len(names), step):
                first, last = np.searchsorted(doc, [low, low + step])
                counts = np.zeros((min(step, len(names) - low), len(words)))
                counts[doc[first:last] - low, at[first:last]] = tf[first:last]
                score = np.round(counts @ weight, SCORE_DIGITS)
                fits = score > 0
                if match == "all":
                    fits &= (counts > 0).astype(float) @ uses == needed
                score = np.where(fits, score, -np.inf)
                if len(score) > k:  # those below the k best of the slice go first
                    fits &= score >= np.partition(score, len(score) - k, axis=0)[len(score) - k]
                row, column = fits.nonzero()
                hits = [np.concatenate(p) for p in zip(hits, (column, row + low, score[row, column]), strict=True)]
                order = np.lexsort((hits[1], -hits[2], hits[0]))
                hits = [h[order] for h in hits]
                place = np.arange(len(order)) - np.searchsorted(hits[0], hits[0])
                hits = [h[place < k] for h in hits]
            hits[0] = queries[hits[0]]
        columns = [pa.array(hits[0], pa.int64()), names.take(pa.array(hits[1])), pa.array(hits[2], pa.float64())]
        return pa.Table.from_arrays(columns, ["query", doc_id, "score"])

    return run
