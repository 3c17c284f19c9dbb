"""Page extraction and search queries."""

import uuid

from pyspark.sql import functions as F

from registry.base import query, r, rounded, table
from veinworks.functions import text as T
from veinworks.operators import extract as X
from veinworks.operators import html as H
from veinworks.operators import search as S
from veinworks.operators.inverted import search_index, write_index
from veinworks.session import checkpoint_folder
from veinworks.sources import tables as ST

TERMS = ["the", "der", "que"]


def pages(spark, sf):
    return table(spark, sf, "pages")


# ------------------------------------------------------------------- pages

_CLEAN = "replace(regexp_replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&amp;?', '&', 'g'), '&quot;', '\"')"
_STRIP = "trim({0}, ' ' || chr(10) || chr(13) || chr(9))"


def clean(x: str) -> str:
    return _STRIP.format(_CLEAN.format(x))


# A paragraph that is closed ends at its end tag; one that is not runs to the
# end of the article, later paragraphs included.
PAGES_SQL = f"""art AS (SELECT page_id, url, html, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS art FROM pages),
    seg AS (SELECT *, string_split(art, '<p>') AS seg FROM art),
    par AS (SELECT page_id, unnest(range(2, len(seg) + 1)) AS i, seg FROM seg),
    one AS (SELECT page_id, i - 2 AS position, CASE WHEN contains(seg[i], '</p>') THEN {clean("split_part(seg[i], '</p>', 1)")}
      ELSE {clean("array_to_string(seg[i:], '')")} END AS paragraph FROM par),
    lists AS (SELECT page_id, list(paragraph ORDER BY position) AS parts FROM one GROUP BY page_id)"""


@query("read_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def _(spark, sf):
    read = ST.read_pages(spark, f"{sf}/pages.parquet")
    return read.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


_COUNTED = ["a", "article", "b", "br", "h1", "li", "p", "title", "ul"]


@query(
    "node_counts",
    "WITH h AS (SELECT page_id, regexp_replace(html, '<script>.*?</script>', '', 'gs') AS html FROM pages) "
    + " UNION ALL ".join(
        f"SELECT page_id, '{t}' AS tag, len(regexp_extract_all(html, '<{t}[ >]'))::BIGINT AS n FROM h" for t in _COUNTED
    ),
)
def _(spark, sf):
    nodes = H.node_table(X.parsed_pages(pages(spark, sf)))
    return nodes.where(F.col("tag").isin(_COUNTED)).groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "select_nodes",
    "SELECT page_id, 1::BIGINT AS n_ads, len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a '))::BIGINT AS n_links, "
    "regexp_extract(html, '<html lang=\"([a-z]*)\"', 1) AS lang FROM pages",
)
def _(spark, sf):
    nodes = H.node_table(X.parsed_pages(pages(spark, sf)))
    node = F.struct("tag", "classes", "attrs")
    return nodes.groupBy("page_id").agg(
        F.count_if(H.matches(node, "div.ad")).alias("n_ads"),
        F.count_if(H.matches(node, "a[href]")).alias("n_links"),
        F.max(F.when(H.matches(node, "html"), F.col("attrs")["lang"])).alias("lang"),
    )


_RELATED = {
    "nav li > a": "len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a '))",
    "body nav ul a": "len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a '))",
    "nav + div.ad": "len(regexp_extract_all(html, '</nav>(<!--.*?-->)?<div class=.ad.>', 0, 's'))",
    "h1 + p": "len(regexp_extract_all(html, '</h1><p>'))",
    "article > h1, div.ad ~ article": "len(regexp_extract_all(html, '<article>')) + len(regexp_extract_all(html, '<article><h1>'))",
}


@query(
    "select_related_nodes",
    "SELECT page_id, " + ", ".join(f"({sql})::INTEGER AS n{i}" for i, sql in enumerate(_RELATED.values())) + " FROM pages",
)
def _(spark, sf):
    """Nodes that stand in a relation to others, as a user's field map may ask for them."""
    parsed = X.parsed_pages(pages(spark, sf))
    return parsed.select("page_id", *[F.size(H.select_nodes(F.col("nodes"), s)).alias(f"n{i}") for i, s in enumerate(_RELATED)])


@query(
    "page_content",
    f"""WITH {PAGES_SQL} SELECT page_id, url, true AS success, {clean("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} AS title,
    {clean("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS headings, array_to_string(parts, '|') AS paragraphs,
    len(parts)::INTEGER AS n_paragraphs, NULL::VARCHAR AS main_content FROM seg JOIN lists USING (page_id)""",
)
def _(spark, sf):
    c = X.read_content(pages(spark, sf))
    return c.select(
        "page_id", "url", "success", "title", F.array_join("headings", "|").alias("headings"),
        F.array_join("paragraphs", "|").alias("paragraphs"), F.size("paragraphs").alias("n_paragraphs"), "main_content",
    )


@query(
    "page_links",
    f"""WITH a AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]+">.*?</a>')) AS a FROM pages)
    SELECT page_id, {clean("regexp_extract(a, '>(.*?)</a>', 1)")} AS text, regexp_extract(a, 'href="([^"]*)"', 1) AS href, COUNT(*) AS n FROM a GROUP BY ALL""",
)
def _(spark, sf):
    c = X.read_content(pages(spark, sf), {"links": "a"})
    rows = c.select("page_id", F.inline("links"))
    return rows.groupBy("page_id", "text", "href").agg(F.count(F.lit(1)).alias("n"))


@query(
    "custom_fields",
    f"""SELECT page_id, regexp_extract(html, '<meta charset="([^"]*)"', 1) = 'utf-8' AS has_meta, {clean("regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')")} AS ad,
    {clean("regexp_extract(html, '<footer>(.*?)</footer>', 1, 's')")} AS footer FROM pages""",
)
def _(spark, sf):
    c = X.read_content(pages(spark, sf), {"ad": "body > div.ad", "footer": "article + footer, footer", "meta": "head meta"})
    # The two entities of the footer are put back for the comparison.
    footer = F.replace(F.replace("footer", F.lit("©"), F.lit("&copy;")), F.lit("·"), F.lit("&middot;"))
    return c.select("page_id", F.col("meta").isNotNull().alias("has_meta"), "ad", footer.alias("footer"))


@query(
    "main_content",
    f"""WITH {PAGES_SQL} SELECT page_id, array_to_string(list_filter(parts, lambda p: length(p) > 0), chr(10) || chr(10)) AS main_content FROM lists""",
)
def _(spark, sf):
    parsed = X.parsed_pages(pages(spark, sf))
    return parsed.select("page_id", X.main_content(F.col("text"), F.col("nodes")).alias("main_content"))


@query(
    "long_paragraphs",
    f"WITH {PAGES_SQL} SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY position) - 1)::INTEGER AS position, "
    "length(paragraph)::INTEGER AS n_chars FROM one WHERE length(paragraph) > 40",
)
def _(spark, sf):
    c = X.read_content(pages(spark, sf))
    each = c.select("page_id", F.posexplode(T.long_paragraphs(F.col("paragraphs"))).alias("position", "paragraph"))
    return each.select("page_id", "position", F.length("paragraph").alias("n_chars"))


@query(
    "page_articles",
    f"""SELECT page_id, {clean("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS title, NULL::VARCHAR AS author, NULL::VARCHAR AS date,
    {clean("regexp_extract(html, '<article>(.*)</article>', 1, 's')")} AS content, {clean("regexp_extract(html, '<article>(.*)</article>', 1, 's')")} AS text FROM pages""",
)
def _(spark, sf):
    return X.read_articles(pages(spark, sf)).select("page_id", "title", "author", "date", "content", "text")


_HIT_SQL = " UNION ALL ".join(
    f"SELECT page_id, '{t}' AS term, position, paragraph FROM one "
    f"WHERE regexp_matches(paragraph, '(?i)(^|[^\\p{{L}}\\p{{N}}_]){t}($|[^\\p{{L}}\\p{{N}}_])')"
    for t in TERMS
)


@query(
    "term_matches",
    f"""WITH {PAGES_SQL}, hits AS ({_HIT_SQL}) SELECT page_id, term, position::INTEGER AS position, paragraph,
    array_to_string(parts[greatest(position - 1, 1):position + 3], chr(10) || chr(10)) AS context FROM hits JOIN lists USING (page_id)""",
)
def _(spark, sf):
    return X.search_pages(pages(spark, sf), TERMS, 2).drop("url")


@query(
    "term_matches_nested",
    f"""WITH {PAGES_SQL}, hits AS ({_HIT_SQL}) SELECT page_id, COUNT(DISTINCT term)::INTEGER AS n_terms, COUNT(*) AS n_occurrences FROM hits GROUP BY page_id""",
)
def _(spark, sf):
    nested = X.nested_matches(X.search_pages(pages(spark, sf), TERMS, 1))
    total = F.aggregate("matches", F.lit(0), lambda acc, m: acc + F.size(m["occurrences"]))
    return nested.select("page_id", F.size("matches").alias("n_terms"), total.cast("long").alias("n_occurrences"))


@query(
    "pages_by_type",
    f"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'table' ELSE 'general' END AS type, page_id % 3 <> 1 AS success,
    CASE page_id % 3 WHEN 0 THEN {clean("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} WHEN 2 THEN {clean("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} END AS title FROM pages""",
)
def _(spark, sf):
    kind = F.when(F.col("page_id") % 3 == 0, "article").when(F.col("page_id") % 3 == 1, "table").otherwise("general")
    out = X.extract_by_type(pages(spark, sf).withColumn("type", kind))
    return out.select("page_id", "type", "success", F.get_json_object("result", "$.title").alias("title"))


@query(
    "pages_by_type_with_terms",
    f"""WITH {PAGES_SQL}, hits AS ({_HIT_SQL}), n AS (SELECT page_id, COUNT(DISTINCT term)::INTEGER AS n_terms FROM hits GROUP BY page_id)
    SELECT p.page_id, COALESCE(n_terms, 0)::INTEGER AS n_terms FROM pages p LEFT JOIN n ON p.page_id = n.page_id""",
)
def _(spark, sf):
    out = X.extract_by_type(pages(spark, sf).withColumn("type", F.lit("search")), TERMS)
    found = F.from_json("result", "matches array<struct<term:string>>")
    return out.select("page_id", F.size(found["matches"]).alias("n_terms"))


# ------------------------------------------------- tables derived from orders


def order_pages(spark, sf):
    """One page per customer with a table of the customer's orders.

    Headers are in thead, in the first row as th, or there are none but the
    first row itself, by customer number.
    """
    o = table(spark, sf, "orders")
    row = F.concat(
        F.lit("<tr><td> "), F.col("o_orderkey").cast("string"), F.lit("</td><td><b>"), F.col("o_orderstatus"), F.lit("</b></td></tr>")
    )
    rows = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("row")))).alias("rows"))
    body = F.array_join(F.transform("rows", lambda x: x["row"]), "\n")
    heads = "<tr><th>key</th><th>status</th></tr>"
    head = (
        F.when(F.col("o_custkey") % 3 == 0, f"<thead>{heads}</thead>").when(F.col("o_custkey") % 3 == 1, heads).otherwise("")
    )
    return rows.select(
        F.col("o_custkey").alias("page_id"), F.lit("u").alias("url"),
        F.concat(F.lit("<h2>Orders</h2><table>"), head, body, F.lit("</table>")).alias("html"),
    )


@query(
    "page_tables",
    """WITH o AS (SELECT o_custkey AS page_id, o_orderkey AS k, o_orderstatus AS s, (row_number() OVER w - 1) AS i,
      first_value(o_orderkey) OVER w AS k0, first_value(o_orderstatus) OVER w AS s0 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
    , c AS (SELECT page_id, (i - CASE WHEN page_id % 3 = 2 THEN 1 ELSE 0 END)::INTEGER AS row_idx, k, s, k0, s0 FROM o)
    SELECT page_id, 0::INTEGER AS table_idx, row_idx, 0::INTEGER AS col_idx, CASE WHEN page_id % 3 = 2 THEN k0::VARCHAR ELSE 'key' END AS header, k::VARCHAR AS value FROM c WHERE row_idx >= 0
    UNION ALL SELECT page_id, 0, row_idx, 1, CASE WHEN page_id % 3 = 2 THEN s0 ELSE 'status' END, s FROM c WHERE row_idx >= 0""",
)
def _(spark, sf):
    return X.table_cells(X.read_tables(order_pages(spark, sf)))


@query("page_tables_success", "SELECT o_custkey AS page_id, true AS success, 1::INTEGER AS n_tables FROM orders GROUP BY o_custkey")
def _(spark, sf):
    return X.read_tables(order_pages(spark, sf)).select("page_id", "success", F.size("tables").alias("n_tables"))


@query("pages_without_tables", "SELECT page_id, false AS success, 0::INTEGER AS n_tables FROM pages")
def _(spark, sf):
    return X.read_tables(pages(spark, sf)).select("page_id", "success", F.size("tables").alias("n_tables"))


# -------------------------------------------------------------------- search


def result_pages(spark, sf):
    """Stored result pages, ten hits each, made from the documents."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    key = F.col("doc_id").cast("string")
    target = F.concat(F.lit("http://"), F.col("source"), F.lit(".example/doc?id="), key)
    href = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("/l/?kh=1&amp;uddg="), F.url_encode(target))).otherwise(target)
    title = F.when(
        F.col("doc_id") % 7 != 0,
        F.concat(F.lit('<h2><a class="result__a" href="'), href, F.lit('">Document <b>'), key, F.lit("</b> &amp; more </a></h2>")),
    ).otherwise("")
    snippet = F.when(
        F.col("doc_id") % 5 != 0, F.concat(F.lit('<a class="result__snippet"> about '), F.col("source"), F.lit("</a>"))
    ).otherwise("")
    hit = F.concat(F.lit('<div class="result links">'), title, snippet, F.lit("</div>"))
    hits = d.groupBy(F.floor(F.col("doc_id") / 10).alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct("doc_id", hit.alias("hit")))).alias("hits")
    )
    return hits.select(
        "page_id", F.concat(F.lit("<html><body>"), F.array_join(F.transform("hits", lambda h: h["hit"]), ""), F.lit("</body></html>")).alias("html")
    )


@query(
    "search_result_pages",
    """WITH d AS (SELECT doc_id // 10 AS page_id, doc_id, source, row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) AS place FROM documents),
    t AS (SELECT * FROM d WHERE place <= 8 AND doc_id % 7 <> 0)
    SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY place))::INTEGER AS rank, 'Document ' || doc_id || ' & more' AS title,
    'http://' || source || '.example/doc?id=' || doc_id AS url, CASE WHEN doc_id % 5 <> 0 THEN 'about ' || source ELSE '' END AS snippet FROM t""",
)
def _(spark, sf):
    return S.parse_results(result_pages(spark, sf), 8)


def corpus(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.concat_ws(" ", "lang", "source").alias("title"), F.col("source").alias("url"), "text")


def benchmark_queries(spark, sf):
    """Every benchmark item as a query."""
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.lower("text").alias("query"))


_TOKENS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 0)"


def _search_sql(queries: str, match: str) -> str:
    keep = "WHERE found = needed" if match == "all" else ""
    return f"""w AS (SELECT doc_id, unnest({_TOKENS.format('text')}) AS term FROM documents),
    tf AS (SELECT term, doc_id, COUNT(*) AS tf FROM w GROUP BY ALL), df AS (SELECT term, COUNT(*) AS df FROM tf GROUP BY term),
    asked AS (SELECT DISTINCT query_id, unnest({_TOKENS.format('query')}) AS term FROM {queries}),
    needed AS (SELECT query_id, COUNT(*) AS needed FROM asked GROUP BY query_id),
    sc AS (SELECT query_id, doc_id, round(SUM(tf * ln(1 + (SELECT COUNT(*) FROM documents) / df::DOUBLE)), 9) AS score, COUNT(*) AS found, MAX(needed) AS needed
      FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN needed USING (query_id) GROUP BY query_id, doc_id),
    rk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM sc {keep}),
    hits AS (SELECT query_id, rank::INTEGER AS rank, rk.doc_id, lang || ' ' || source AS title, source AS url, text AS snippet, round(score, 6) AS score
      FROM rk JOIN documents d ON d.doc_id = rk.doc_id WHERE rank <= 10)"""


_Q = "q AS (SELECT item_id AS query_id, lower(text) AS query FROM benchmark)"
_INDEXES: dict[tuple[str, str], str] = {}


def stored_index(spark, sf):
    """Folder of the index over the documents, written by the first search of a session."""
    key = spark.sparkContext.applicationId, sf
    if key not in _INDEXES:
        _INDEXES[key] = write_index(corpus(spark, sf), f"{checkpoint_folder(spark)}/index-{uuid.uuid4().hex}")
    return _INDEXES[key]


for _match in ("all", "any"):

    @query(f"search_{_match}_terms", "WITH " + _Q + ", " + _search_sql("q", _match) + " SELECT * FROM hits")
    def _(spark, sf, match=_match):
        return rounded(search_index(stored_index(spark, sf), benchmark_queries(spark, sf), 10, match), ["score"])


@query(
    "search_with_fallback",
    "WITH " + _Q + """, nx AS (SELECT query_id, query, array_to_string(list_filter(regexp_split_to_array(query, '\\s+'), lambda t: length(t) > 0)[:2], ' ') AS short FROM q),
    v AS (SELECT query_id AS qid, 0 AS level, query FROM nx UNION ALL SELECT query_id, 1, CASE WHEN contains(query, ' ') AND short <> query THEN short
      ELSE 'what is ' || query END FROM nx WHERE (contains(query, ' ') AND short <> query) OR NOT regexp_matches(query, '^(what|how|why|when|where|who)')),
    vq AS (SELECT qid * 2 + level AS query_id, qid, level, query FROM v), """ + _search_sql("vq", "all") + """,
    b AS (SELECT qid, MIN(level) AS level FROM hits JOIN vq USING (query_id) GROUP BY qid)
    SELECT vq.qid AS query_id, vq.level::INTEGER AS level, query AS asked, rank, doc_id, title, url, snippet, score
    FROM hits JOIN vq USING (query_id) JOIN b ON b.qid = vq.qid AND b.level = vq.level""",
)
def _(spark, sf):
    return rounded(S.search_with_fallback(corpus(spark, sf), benchmark_queries(spark, sf), index=stored_index(spark, sf)), ["score"])


# ----------------------------------------------------------- text functions


@query("url_host", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages")
def _(spark, sf):
    return pages(spark, sf).select("page_id", T.url_host(F.col("url")).alias("host"))


@query("url_encode_query", "SELECT p_partkey, replace(url_encode(p_name), '%20', '+') AS encoded FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", T.encode_query(F.col("p_name")).alias("encoded"))


@query("unwrap_redirect", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE '/plain' END AS target FROM pages")
def _(spark, sf):
    link = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/l/?a=1&uddg="), F.url_encode("url"))).otherwise("/plain")
    return pages(spark, sf).select("page_id", T.unwrap_redirect(link).alias("target"))


@query(
    "fallback_queries",
    """WITH q AS (SELECT item_id, CASE item_id % 4 WHEN 0 THEN text WHEN 1 THEN split_part(text, ' ', 1) WHEN 2 THEN 'Whatever' ELSE 'how to' END AS q FROM benchmark),
    s AS (SELECT item_id, q, array_to_string(list_filter(regexp_split_to_array(q, '\\s+'), lambda t: length(t) > 0)[:2], ' ') AS short FROM q)
    SELECT item_id, CASE WHEN contains(q, ' ') AND short <> q THEN short WHEN NOT regexp_matches(lower(q), '^(what|how|why|when|where|who)') THEN 'what is ' || q END AS next FROM s""",
)
def _(spark, sf):
    text = F.col("text")
    q = (
        F.when(F.col("item_id") % 4 == 0, text).when(F.col("item_id") % 4 == 1, F.split_part("text", F.lit(" "), F.lit(1)))
        .when(F.col("item_id") % 4 == 2, "Whatever").otherwise("how to")
    )
    return table(spark, sf, "benchmark").select("item_id", T.fallback_query(q).alias("next"))


@query(
    "term_in_text",
    "SELECT doc_id, regexp_matches(text, '(?i)(^|[^\\p{L}\\p{N}_])the($|[^\\p{L}\\p{N}_])') AS has_the, contains(lower(text), 'the') AS contains_the FROM documents",
)
def _(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.has_term(F.col("text"), "the").alias("has_the"), F.lower("text").contains("the").alias("contains_the"))


@query(
    "split_and_join_paragraphs",
    """SELECT doc_id, len(string_split(text, chr(10)))::INTEGER AS n_lines,
    array_to_string(string_split(text, chr(10))[:1], '') AS first_line, array_to_string(string_split(text, chr(10)), chr(10) || chr(10)) AS spaced FROM documents""",
)
def _(spark, sf):
    d = table(spark, sf, "documents")
    lines = T.split_paragraphs(F.replace("text", F.lit("\n"), F.lit("\n\n")))
    return d.select(
        "doc_id", F.size(lines).alias("n_lines"), F.get(lines, F.lit(0)).alias("first_line"), T.join_paragraphs(lines).alias("spaced")
    ).withColumn("n_lines", F.col("n_lines").cast("int"))


@query("title_case", "SELECT DISTINCT p_type, upper(p_type[1]) || lower(p_type[2:]) AS first_title FROM part")
def _(spark, sf):
    first = F.split_part(F.initcap(F.lower("p_type")), F.lit(" "), F.lit(1))
    rest = F.lower(F.expr("substring(p_type, length(split_part(p_type, ' ', 1)) + 1)"))
    return table(spark, sf, "part").select("p_type", F.concat(first, rest).alias("first_title")).distinct()
