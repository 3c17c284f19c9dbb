"""Result pages, ranked keyword search over a corpus, and its fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veinworks.functions.text import fallback_query, tokens, unwrap_redirect
from veinworks.operators.html import descendants, first, node_text, parse_pages, select_nodes
from veinworks.operators.inverted import SCORE_DIGITS, search_index
from veinworks.session import durable

# Markup of a hit on a stored result page, hits per query.
HIT = "div.result"
HIT_TITLE = "a.result__a"
HIT_SNIPPET = "a.result__snippet"
MAX_RESULTS = 10


def parse_results(pages: DataFrame, max_results: int = MAX_RESULTS, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """(keys, rank, title, url, snippet) of stored result pages.

    The first ``max_results`` hits are taken before hits without a title are
    left out; ranks count what remains.
    """
    parsed = parse_pages(pages, "html", keep)
    text, nodes = F.col("text"), F.col("nodes")

    def read(hit: Column) -> Column:
        title = first(descendants(nodes, hit, HIT_TITLE))
        snippet = first(descendants(nodes, hit, HIT_SNIPPET))
        return F.struct(
            F.when(title.isNotNull(), node_text(text, title)).alias("title"),
            unwrap_redirect(F.coalesce(title["attrs"]["href"], F.lit(""))).alias("url"),
            F.coalesce(node_text(text, snippet), F.lit("")).alias("snippet"),
        )

    taken = F.transform(F.slice(select_nodes(nodes, HIT), 1, max_results), read)
    hits = F.filter(taken, lambda h: h["title"].isNotNull())
    return parsed.select(*keep, F.posexplode(hits).alias("_place", "hit")).select(
        *keep, (F.col("_place") + 1).alias("rank"), "hit.title", "hit.url", "hit.snippet"
    )


def search(
    corpus: DataFrame, queries: DataFrame, max_results: int = MAX_RESULTS, match: str = "all", doc_id: str = "doc_id"
) -> DataFrame:
    """(query_id, rank, doc_id, title, url, snippet, score) for a batch of queries.

    ``corpus`` has (doc_id, title, url, text), ``queries`` (query_id, query).
    The score sums term frequency × ln(1 + documents / documents with the term).
    ``match='all'`` asks for every term, ``'any'`` for one. ``snippet`` is the
    whole text. Words outside the queries are dropped before the first shuffle,
    and the counts that remain are written once; which sides are broadcast and
    which terms are split is left to adaptive execution.
    """
    if match not in ("all", "any"):
        raise ValueError("match must be 'all' or 'any'")
    asked = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    words = corpus.select(doc_id, F.explode(tokens(F.col("text"))).alias("term"))
    kept = words.join(asked.select("term").distinct(), "term", "left_semi")
    counts = durable(kept.groupBy("term", doc_id).agg(F.count(F.lit(1)).alias("tf")))
    spread = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = spread.select("term", F.log(1 + F.lit(corpus.count()) / F.col("df")).alias("idf"))
    needed = asked.groupBy("query_id").agg(F.count("term").alias("needed"))
    terms = asked.join(weights, "term").join(needed, "query_id")
    scored = (
        counts.join(terms, "term")
        .groupBy("query_id", doc_id)
        .agg(F.round(F.sum(F.col("tf") * F.col("idf")), SCORE_DIGITS).alias("score"), F.count("term").alias("found"), F.max("needed").alias("needed"))
    )
    if match == "all":
        scored = scored.where("found = needed")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), doc_id)
    top = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_results)
    # At most max_results rows a query; the texts stay where they are when these are few.
    return top.join(corpus, doc_id).select(
        "query_id", "rank", doc_id, "title", "url", F.col("text").alias("snippet"), "score"
    )


def search_with_fallback(
    corpus: DataFrame | None, queries: DataFrame, max_results: int = MAX_RESULTS, doc_id: str = "doc_id", index: str | None = None
) -> DataFrame:
    """Search results plus ``level`` (0 as asked, 1 fallback) and the query used.

    A query without hits is asked once more: cut to its first two words when it
    is longer, else with a question in front unless it is one already. With
    ``index``, the folder of a stored index, no corpus is needed.
    """
    asked = queries.select("query_id", "query", fallback_query(F.col("query")).alias("_next"))
    variants = asked.select(
        "query_id",
        F.explode(
            F.filter(
                F.array(
                    F.struct(F.lit(0).alias("level"), F.col("query").alias("asked")),
                    F.struct(F.lit(1).alias("level"), F.col("_next").alias("asked")),
                ),
                lambda v: v["asked"].isNotNull(),
            )
        ).alias("v"),
    ).select(F.struct("query_id", "v.level").alias("query_id"), F.col("v.asked").alias("query"))
    hits = search_index(index, variants, max_results, "all", doc_id) if index else search(corpus, variants, max_results, "all", doc_id)
    best = F.min("query_id.level").over(Window.partitionBy("query_id.query_id"))
    chosen = hits.withColumn("_best", best).where(F.col("query_id.level") == F.col("_best")).drop("_best")
    used = variants.withColumnRenamed("query", "asked")
    return chosen.join(used, "query_id").select(
        "query_id.query_id", "query_id.level", "asked", "rank", doc_id, "title", "url", "snippet", "score"
    )
