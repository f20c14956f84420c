from pyspark.sql import functions as F

from labelforge.functions import html as H
from labelforge.operators import extract

PAGE = """<!DOCTYPE html><html><head><title>Head &amp; Co | Site.example</title><style>a{}</style>
<script>var s = "<h1>no</h1><a href='/item/9/x'>no</a>";</script></head><body>
<div class="page header"><div><a href="/item/1/top">top</a></div></div>
<!-- <h1>hidden</h1> -->
<div id="main"><h1> The <b>Title</b> </h1>
<a href="/item/2/a">A</a><a href="https://other/item/3/b">B</a><a class="x" href="/item/2/a">again</a><a href="/about">no</a>
<div id="summary"> Outer <div>inner text</div> tail &lt;ok&gt;</div></div>
<div id="footer"><a href="/item/4/f">f</a></div></body></html>"""
PLAIN = """<html><head><title>Only title | Site.example rest</title></head><body><section id="summary">short</section>
<div class="my summary box">A block of text that is long enough</div><p>x</p><p>longest one</p><p>longest two</p></body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, PAGE), (2, PLAIN), (3, ""), (4, None)], "page_id long, html string")


def visible(spark):
    return extract.visible_pages(pages(spark), "html")


def by_id(df, col):
    return {r["page_id"]: r[col] for r in df.collect()}


def test_titles(spark):
    got = by_id(visible(spark).select("page_id", extract.title_of("html", r"\| Site\.example.*").alias("t")), "t")
    assert got == {1: "TheTitle", 2: "Only title", 3: "", 4: ""}


def test_native_links(spark):
    got = extract.page_links(pages(spark), "html", r"/item/\d+/", "https://h", ["page_id"]).orderBy("pos").collect()
    assert [r["link"] for r in got if "9" not in r["link"]] == [
        "https://h/item/1/top", "https://h/item/2/a", "https://other/item/3/b", "https://h/item/4/f"
    ]


def test_exact_parts_follow_the_nesting(spark):
    selectors = [("div", "id", "summary", False), ("section", "id", "summary", False), ("div", "class", "summary", True)]
    parts = extract.page_parts_exact(pages(spark), "page_id", "html", selectors, ["header", "footer", "navbar"]).collect()
    links = [r["value"] for r in parts if r["kind"] == "link" and r["page_id"] == 1]
    assert links == ["/item/2/a", "https://other/item/3/b", "/about"]
    blocks = [(r["page_id"], r["selector"], r["value"]) for r in parts if r["kind"] == "block"]
    assert sorted(blocks) == [
        (1, 0, "Outerinner texttail <ok>"), (2, 1, "short"), (2, 2, "A block of text that is long enough")
    ]


def test_block_fallbacks(spark):
    side, section, box = ("div", "id", "summary", False), ("section", "id", "summary", False), ("div", "class", "summary", True)
    first = by_id(visible(spark).select("page_id", extract.first_block("html", (side, section, box)).alias("b")), "b")
    assert first[2] == "short" and first[3] == ""
    long = by_id(visible(spark).select("page_id", extract.first_block("html", (side, section, box), 20, or_page=False).alias("b")), "b")
    assert long[2] == "A block of text that is long enough"
    best = by_id(visible(spark).select("page_id", extract.longest_block("html", ("p",), 10).alias("b")), "b")
    assert best[2] == "longest one" and best[1] == extract_text(PAGE)[:10]


def extract_text(page):
    return "Head & Co | Site.exampletopTheTitleABagainnoOuterinner texttail <ok>f"


def test_page_text(spark):
    assert by_id(visible(spark).select("page_id", extract.page_text("html").alias("t")), "t")[1] == extract_text(PAGE)


def test_cards(spark):
    listing = """<div class="bookBox"><a class="bookTitle" href="/b/1"> One (Paperback)</a></div>
    <div class="bookBox"><a class="bookTitle">no target</a></div><div class="bookBox"><span>none</span></div>
    <div class="bookBox"><a class="bookTitle" href="/b/2"><b>Two</b></a></div>"""
    df = spark.createDataFrame([(1, listing), (2, "<p>no cards</p>")], "page_id long, html string")
    link = r'(?is)<a\s[^>]*class="bookTitle"[^>]*href="([^"]*)"[^>]*>(.*?)</a>'
    containers = [extract.opening("div", "class", "elementList"), extract.opening("div", "class", "bookBox")]
    got = extract.page_cards(df, "html", ["page_id"], containers, link).collect()
    assert sorted(map(tuple, got)) == [(1, "One (Paperback)", "/b/1"), (1, "Two", "/b/2")]


def test_records(spark):
    body = extract.first_block("html", [("div", "class", "summary", True)])
    df = pages(spark).withColumn("cat", F.when(F.col("page_id") == 2, "art").otherwise("other"))
    got = extract.pages_to_records(
        df, "html", body, "cat", ["page_id"], r"\| Site\.example.*", ["block of"], min_len=25,
        split=("art", ["title"], "marked", "plain"),
    ).orderBy("page_id").collect()
    assert [(r["page_id"], r["label"]) for r in got] == [(1, "other"), (2, "marked")]
    assert got[1]["text"] == "Only title. A text that is long enough"


def test_block_count(spark):
    df = spark.createDataFrame([('<div class="product x"></div><div class="my-product">',), ('<li class="product">',), ("",)], "html string")
    opens = [extract.opening(t, "class", "product") for t in ("div", "li")]
    assert [r[0] for r in df.select(extract.block_count("html", opens)).collect()] == [2, 1, 0]


SOUP = """<h1>Caf&eacute; &#8217;n&#x2019; &copy; &amp;lt;</h1><script>var t = "</style>";leak()</script>
<div id="summary">one <div>two</div> three</div><div class='side note'>single</div><p id="desc-7">open<p>inner</p></div>
<section><span data-k=prefix-9>tail</span></section>"""


def test_references_and_nesting(spark):
    df = extract.visible_pages(spark.createDataFrame([(1, SOUP), (2, None), (3, "no markup &lt;")], "page_id long, html string"), "html")
    def first(*selector):
        return by_id(df.select("page_id", F.try_element_at(extract.selector_texts("html", selector), F.lit(1)).alias("b")), "b")[1]

    assert by_id(df.select("page_id", extract.title_of("html").alias("t")), "t")[1] == "Café ’n’ © &lt;"
    assert first("div", "id", "summary", False) == "onetwothree"
    assert first("div", "class", "note", True) == "single"
    assert first(None, "data-k", "prefix", "prefix") == "tail"
    assert first("p", "id", "desc", "prefix") == "openinnertail"
    text = by_id(df.select("page_id", extract.page_text("html").alias("t")), "t")
    assert "leak" not in text[1] and text[2] == "" and text[3] == "no markup <"


def test_h1_only(spark):
    got = by_id(visible(spark).select("page_id", extract.title_of("html", h1_only=True).alias("t")), "t")
    assert got == {1: "TheTitle", 2: "", 3: "", 4: ""}
