"""Markup cases for extraction, term search and stored result pages."""

import random
import sys

import pytest
from pyspark.sql import functions as F

from veinworks.functions import text as T
from veinworks.operators import extract as X
from veinworks.operators import html as H
from veinworks.session import durable
from veinworks.operators import inverted as I
from veinworks.operators import search as S

LONG = "A paragraph that is clearly longer than forty characters."


@pytest.fixture(scope="module")
def read(spark):
    def run(kind, html, **params):
        df = spark.createDataFrame([(1, "http://e.org/p", html)], "page_id long, url string, html string")
        return {"content": X.read_content, "article": X.read_articles, "tables": X.read_tables}[kind](df, **params).first()

    return run


def test_default_record(read):
    row = read(
        "content",
        "<title> A &amp; B&copy </title><h2>two</h2><h1>one</h1><p> x <b>y</b>\n</p><a>none</a><a href=''>e</a><a href='/l'> t </a>"
        "<script>var p = '<p>no</p>';</script>",
    )
    assert row["title"] == "A & B©" and row["headings"] == ["two", "one"] and row["paragraphs"] == ["x y"]
    assert [(x["text"], x["href"]) for x in row["links"]] == [("t", "/l")]
    assert row["success"] and row["main_content"] is None


def test_open_paragraph_runs_to_the_end_of_its_holder(read):
    page = "<div><p>one<b>two<p>three</p></div><p>four</p>"
    assert read("content", page)["paragraphs"] == ["onetwothree", "three", "four"]
    assert read("content", page, p_rule="html5")["paragraphs"] == ["onetwo", "three", "four"]


@pytest.mark.parametrize(
    "html,want",
    [
        (f"<main><p>in</p><p> </p><p>main</p></main><p>{LONG}</p>", "in\n\nmain"),
        (f"<article>no paragraph</article><div class='x content'><p>held</p></div><p>{LONG}</p>", "held"),
        (f"<p>short</p><p>{LONG}</p>", LONG),
        ("<body>just <i>text</i><p>short</p></body>", "just textshort"),
        ("<p>short</p>", ""),
        ("<div role='main'><p>r</p></div>", "r"),
        ("", ""),
    ],
)
def test_main_content_order(spark, html, want):
    parsed = X.parsed_pages(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"))
    assert parsed.select(X.main_content(F.col("text"), F.col("nodes"))).first()[0] == want


def test_main_content_only_when_all_else_is_empty(read):
    assert read("content", "<body>plain</body>")["main_content"] == "plain"
    assert read("content", "<body><h1></h1>plain</body>")["main_content"] is None  # a heading was found
    assert read("content", "<body>plain<b class=k>x</b></body>", fields={"k": ".k"})["main_content"] is None


def test_article(read):
    row = read("article", "<h1>T</h1><span class='byline'>By</span><time>May</time><article>Some &lt;p&gt;one&lt;/p&gt; more</article>")
    assert (row["title"], row["author"], row["date"]) == ("T", "By", "May")
    assert row["content"] == "Some <p>one</p> more" and row["text"] == "one"
    assert read("article", "<a rel='author'>R</a><article>x &amp; y</article>")["author"] == "R"
    assert read("article", "<p>no article</p>")["content"] is None


@pytest.mark.parametrize(
    "html,headers,rows",
    [
        ("<thead><tr><th>a</th><th>b</th></tr></thead><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr>", ["a", "b"], [["1", "2"], ["3", "4"]]),
        ("<thead><tr><td>a</td></tr></thead><tr><td>1</td></tr>", ["a"], [["1"]]),
        ("<tr><th>a</th></tr><tr><td>1</td></tr>", ["a"], [["1"]]),
        ("<tr><td>a</td></tr><tr><td>1</td></tr><tr><td>a</td></tr>", ["a"], [["1"]]),
        ("<tr><td>a</td></tr><tr><td class='x'>a</td></tr>", ["a"], [["a"]]),
        ("<tr></tr><tr><td>1</td></tr><tr><th>h</th><td>2</td></tr>", [], [["1"], ["h", "2"]]),
    ],
)
def test_tables(read, html, headers, rows):
    row = read("tables", f"<p>x</p><table>{html}</table>")
    assert row["success"] and [(t["headers"], t["rows"]) for t in row["tables"]] == [(headers, rows)]


def test_page_without_table_or_body(spark, read):
    assert read("tables", "<p>x</p>")["success"] is False
    row = read("content", None)
    assert row["success"] is False and row["error"] and row["paragraphs"] is None


def test_selectors(spark):
    df = spark.createDataFrame(
        [(1, '<div id="a" class="k m" data-x="1"><span class="k">s</span></div><SPAN rel=author>t</SPAN>')], "page_id long, html string"
    )
    nodes = H.node_table(H.parse_pages(df, keep=("page_id",)))
    node = F.struct("tag", "classes", "attrs")
    count = lambda s: nodes.where(H.matches(node, s)).count()
    assert [count(s) for s in (".k", "span.k", "#a", '[data-x="1"]', "[rel=author]", "div, span", "div.k.m#a", "*", "p")] == [2, 1, 1, 1, 1, 3, 1, 3, 0]
    with pytest.raises(ValueError):
        H.matches(node, "div > p")


def test_selectors_with_relations(spark):
    page = (
        '<div id="a"><p>0</p><ul class="x"><li><a href="1">1</a></li><li><b><a>2</a></b></li></ul><p class="k">3</p><i>4</i><p>5</p></div>'
        '<p>6</p><ul><li>7<ul><li><a>8</a></li></ul></li></ul><h2>9</h2><p>10</p>'
    )
    df = spark.createDataFrame([(1, page), (2, "<p>x</p>"), (3, "")], "page_id long, html string")
    parsed = durable(H.parse_pages(df, keep=("page_id",)))

    def found(selector):
        out = parsed.select("page_id", H.node_texts(F.col("text"), H.select_nodes(F.col("nodes"), selector)).alias("t")).orderBy("page_id")
        rows = [r["t"] for r in out.collect()]
        assert all(not t for t in rows[1:]) or selector in ("p", "* , p")
        return rows[0]

    assert found("ul li a") == ["1", "2", "8"] and found("li > a") == ["1", "8"] and found("div.x > p") == []
    assert found("div > p") == ["0", "3", "5"] and found("#a>p.k") == ["3"] and found("h2 + p") == ["10"]
    assert found("ul + p") == ["3"] and found("ul ~ p") == ["3", "5", "10"] and found("div ~ ul li li") == ["8"]
    assert found("ul.x a[href], h2+p , i") == ["1", "4", "10"] and found("ul ul a") == ["8"] and found('[id="a"] b > a') == ["2"]
    assert found("div p + ul > li b a") == ["2"]
    first_list = H.first(H.select_nodes(F.col("nodes"), "ul"))
    below = parsed.where("page_id = 1").select(H.node_texts(F.col("text"), H.descendants(F.col("nodes"), first_list, "div a")).alias("t"))
    assert below.first()["t"] == ["1", "2"]
    for wrong in ("> p", "p >", "a > > b", ",p", "p,,a", "", "p:first-child"):
        with pytest.raises(ValueError):
            H.select_nodes(F.col("nodes"), wrong)


def test_nodes_know_their_subtree(spark):
    df = spark.createDataFrame([(1, "<ul><li>a<br>b</li><li/>c</ul></p><i>d")], "page_id long, html string")
    rows = H.node_table(H.parse_pages(df, keep=("page_id",))).orderBy("node").collect()
    assert [(r["tag"], r["parent"], r["last"]) for r in rows] == [("ul", -1, 3), ("li", 0, 2), ("br", 1, 2), ("li", 0, 3), ("i", -1, 4)]


def test_terms_and_context(spark):
    parts = ["The cat sat", "concatenate", "CAT!", "c++x and a.b", "end cat\\E here"]
    df = spark.createDataFrame([(1, "u", parts, None)], "page_id long, url string, paragraphs array<string>, main_content string")
    out = X.find_terms(df, ["cat", "a.b", "axb", "c++", "cat\\E"], 2).collect()
    assert sorted((r["term"], r["position"]) for r in out) == [("a.b", 3), ("c++", 3), ("cat", 0), ("cat", 2), ("cat", 4), ("cat\\E", 4)]
    found = {(r["term"], r["position"]): r["context"] for r in out}
    assert ("cat", 1) not in found and ("axb", 3) not in found and ("a.b", 3) in found
    assert found["cat", 0] == "\n\n".join(parts[:3]) and found["cat", 4] == "\n\n".join(parts[2:])
    assert found["cat", 2] == "\n\n".join(parts)
    nested = X.nested_matches(X.find_terms(df, ["cat"], 0)).first()
    assert [o["position"] for o in nested["matches"][0]["occurrences"]] == [0, 2, 4]


def test_main_content_pieces_are_searched_too(spark):
    df = spark.createDataFrame([(1, "u", "<body>one needle</body>")], "page_id long, url string, html string")
    assert [r["position"] for r in X.search_pages(df, ["needle"]).collect()] == [0]


def test_result_pages(spark):
    hit = '<div class="result x">{}</div>'
    page = "".join(
        hit.format(body)
        for body in (
            '<a class="result__a" href="/l/?kh=1&amp;uddg=https%3A%2F%2Fe.org%2F%3Fa%3D1">One</a><a class="result__snippet"> s </a>',
            "<a>untitled</a>",
            '<a class="result__a" href="https://d.org">Two</a>',
            '<a class="result__a">Three</a>',
            '<a class="result__a" href="/about">Four</a>',
        )
    )
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    rows = S.parse_results(df, 4).orderBy("rank").collect()
    assert [(r["rank"], r["title"], r["url"], r["snippet"]) for r in rows] == [
        (1, "One", "https://e.org/?a=1", "s"), (2, "Two", "https://d.org", ""), (3, "Three", "", ""),
    ]


def test_search_limits_ranks_and_falls_back(spark):
    corpus = spark.createDataFrame(
        [(1, "t", "u", "red apple pie"), (2, "t", "u", "red apple apple"), (3, "t", "u", "what is zinc"), (4, "t", "u", "blue sky")],
        "doc_id long, title string, url string, text string",
    )
    queries = spark.createDataFrame(
        [(1, "red apple"), (2, "red apple tart"), (3, "Zinc"), (4, "where"), (5, "blue cheese"), (6, "sky x y")], "query_id long, query string"
    )
    hits = S.search_with_fallback(corpus, queries).collect()
    got = {}
    for r in sorted(hits, key=lambda r: r["rank"]):
        got.setdefault((r["query_id"], r["level"]), []).append(r["doc_id"])
    assert got == {(1, 0): [2, 1], (2, 1): [2, 1], (3, 0): [3]}
    assert S.search(corpus, queries.where("query_id = 1"), 1).count() == 1
    any_of = S.search(corpus, queries.where("query_id = 5"), match="any").collect()
    assert [r["doc_id"] for r in any_of] == [4]


def test_fallback_rule(spark):
    rows = [("a b c",), ("a b",), ("word",), ("Whatever",), ("how",)]
    out = [r[0] for r in spark.createDataFrame(rows, "q string").select(T.fallback_query(F.col("q"))).collect()]
    assert out == ["a b", "what is a b", "what is word", None, None]


def test_strip_and_hosts(spark):
    row = spark.createDataFrame([(" \t x \x1c\n", "https://a.b:8/c", "not a url")], "s string, u string, v string").select(
        T.strip(F.col("s")), T.url_host(F.col("u")), T.url_host(F.col("v"))
    ).first()
    assert tuple(row) == ("x", "a.b", None)


def test_pages_by_type(spark):
    rows = [(1, "u", "article", "<h1>T</h1><article>x</article>"), (2, "u", "table", "<table><tr><td>1</td></tr></table>"),
            (3, "u", "list", "<title>G</title><p>needle</p>"), (4, "u", "general", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, type string, html string")
    out = {r["page_id"]: r for r in X.extract_by_type(df).collect()}
    assert [out[i]["success"] for i in (1, 2, 3, 4)] == [True, True, True, False]
    assert '"title":"G"' in out[3]["result"]
    found = {r["page_id"]: r["result"] for r in X.extract_by_type(df, ["needle"]).collect()}
    assert '"term":"needle"' in found[3] and "headers" in found[2]


@pytest.mark.parametrize("match", ["all", "any"])
def test_stored_index_gives_the_rows_of_a_search_without_one(spark, tmp_path, match):
    draw = random.Random(6)
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join(draw.choices(words, weights=[1 / (k + 1) for k in range(30)], k=draw.randint(1, 40))) for _ in range(300)]
    corpus = spark.createDataFrame([(i, "t", "u", t) for i, t in enumerate(texts)] + [(900, "t", "u", None)], "doc_id long, title string, url string, text string")
    asked = [(i, " ".join(draw.sample(words, draw.randint(1, 8)))) for i in range(25)] + [(90, "w0 nowhere"), (91, ""), (92, None), (93, "nowhere")]
    queries = spark.createDataFrame(asked, "query_id long, query string")
    folder = I.write_index(corpus, str(tmp_path / "index"), buckets=8)
    order = ["query_id", "rank", "doc_id", "score", "snippet"]
    want = S.search(corpus, queries, 5, match).select(*order).orderBy("query_id", "rank").collect()
    found = I.search_index(folder, queries, 5, match)
    assert found.select(*order).orderBy("query_id", "rank").collect() == want and len(want) > 20
    one = I.search_index(folder, queries.where("query_id = 93 or query_id = 91"), 5, match)
    assert one.count() == 0
    plan = I._opened(spark, f"{folder}/postings", queries.limit(1).selectExpr("'w3' as term"), "term", 8)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan  # other buckets are not read


@pytest.mark.parametrize("match", ["all", "any"])
def test_search_in_many_blocks_gives_the_rows_of_one_block(spark, tmp_path, monkeypatch, match):
    draw = random.Random(8)
    texts = [" ".join(draw.choices("abcdefgh", k=draw.randint(1, 12))) for _ in range(150)]
    rows = [(f"d{i % 140}", "t", "u", t) for i, t in enumerate(texts)] + [(None, "t", "u", "a b c d")]  # ids repeat, one is missing
    corpus = spark.createDataFrame(rows, "doc_id string, title string, url string, text string")
    queries = spark.createDataFrame([(i, " ".join(draw.sample("abcdefgh", 3))) for i in range(12)] + [(3, "a b")], "query_id long, query string")
    folder, order = I.write_index(corpus, str(tmp_path / "index"), buckets=4), ["query_id", "rank", "doc_id", "score", "snippet"]
    want = I.search_index(folder, queries, 4, match).select(*order).orderBy(*order).collect()
    for name, size in (("BLOCK_POSTINGS", 60), ("BLOCK_QUERIES", 5), ("CELLS", 64)):
        monkeypatch.setattr(I, name, size)
    found = I.search_index(folder, queries, 4, match)
    assert found.select(*order).orderBy(*order).collect() == want and len(want) > 20
    assert all(r["doc_id"] is not None for r in want)


def test_pages_are_parsed_in_lots_of_few_characters():
    import pandas as pd

    bodies = pd.Series(["x" * 300_000, None, "y" * 300_000, "z" * 2_000_000, "", "w"])
    assert list(H.lots(bodies)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(H.lots(pd.Series(["a"] * 600))) == [(0, 256), (256, 512), (512, 600)]
    assert list(H.lots(pd.Series([], dtype=object))) == []


PLAIN_PAGES = [
    "<h2>Orders</h2><table><tr><th>key</th><th>state</th></tr>\n<tr><td> 1</td><td><b>O</b></td></tr></table>",
    "<table><tr><td>1<tr><td>2</table> <p>a<p>b<pre> \n </pre><br><script>x = 1</script>c",
    "<title>a<b>c</title><p>x &amp; y</p><textarea> <b> </textarea></i></p><tr><tr><td>d</tr></tr>e<",
]


@pytest.mark.parametrize("html", PLAIN_PAGES)
@pytest.mark.parametrize("p_rule", H.P_RULES)
def test_plain_tags_are_read_as_other_tags_are(html, p_rule):
    assert H.parse_page(html, p_rule) == H.parse_page(html.replace(">", " >"), p_rule)  # no tag is plain then


def test_plain_tags_take_few_calls():
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    page = "<table>" + "<tr><td>1</td><td><b>O</b></td></tr>\n" * 50 + "</table>"
    sys.setprofile(count)
    try:
        nodes = H.parse_page(page)[1]
    finally:
        sys.setprofile(None)
    assert len(nodes) == 201 and calls < 40 * len(nodes)


def test_nodes_as_columns_are_those_of_the_page(spark):
    pages = ["<div class='a b' id=\"é\"><p class>x</p></div>", "", None, *PLAIN_PAGES, "<![foo]>"]
    rows = spark.createDataFrame([(i, "u", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in X.parsed_pages(rows).collect()}
    assert [got[2]["text"], got[2]["nodes"], got[2]["error"]] == [None, [], "no page body"]
    assert got[6]["nodes"] == [] and got[6]["error"]
    for i in (0, 1, 3, 4, 5):
        assert (got[i]["text"], [n.asDict() for n in got[i]["nodes"]]) == H.parse_page(pages[i]) and got[i]["error"] is None
