"""HTML paragraphs/tables, wide price downloads, load monitoring."""

import datetime as dt
import os

from finlake.functions.scalar import pretty_size
from finlake.plans import monitor
from finlake.sources import html
from finlake.sources.prices import wide_to_long

from .conftest import rows

PAGE = """<html><head><script>var t = "</p>";</script><style>p{x:1}</style></head>
<body><div class="ad"><p>advert</p></div><!-- <p>comment</p> -->
<article class="story"><h1>Head</h1>
<p class="lead x"><b>First</b> &amp; <i>bold</i>&nbsp;text<br>
<p class="body">Second
  line</p><p class="other">   </p><p class='body'>Third &lt;3&gt;
</article>
<table><tr><th>Symbol</th><th>CIK</th></tr><tr><td>AAA</td><td>0001</td></tr>
<tr><td><a href="#">BBB</a></td><td>2</td></tr></table>
</body></html>"""


def _pages(spark):
    return spark.createDataFrame([(1, "http://x/1", PAGE)], "page_id long, url string, html string")


def test_paragraphs_unclosed_script_entities(spark):
    got = [tuple(r) for r in html.paragraphs(_pages(spark)).orderBy("pos").collect()]
    assert got == [(1, 0, "First & bold text"), (1, 1, "Second line"), (1, 2, "Third <3>")]


def test_paragraph_class_filter_and_whole_page(spark):
    body = html.paragraphs(_pages(spark), classes=["body"])
    assert [r.text for r in body.orderBy("pos").collect()] == ["Second line", "Third <3>"]  # either quote
    everything = html.paragraphs(_pages(spark), container=None)
    assert "advert" in [r.text for r in everything.collect()]
    assert "comment" not in [r.text for r in everything.collect()]


def test_table_rows(spark):
    got = [(r.row, list(r.cells)) for r in html.table_rows(_pages(spark)).orderBy("row").collect()]
    assert got == [(0, ["Symbol", "CIK"]), (1, ["AAA", "0001"]), (2, ["BBB", "2"])]


def test_news_from_search(spark):
    results = spark.createDataFrame([("T", 1700000000, "http://x/1"), ("U", 0, "http://none")],
                                    "title string, providerPublishTime long, link string")
    got = {r.title: (r.date, r.content) for r in html.news_from_search(results, _pages(spark)).collect()}
    assert got["T"][0] == dt.date(2023, 11, 14) and got["T"][1].startswith("First")
    assert got["U"] == (dt.date(1970, 1, 1), None)


def test_wide_to_long(spark):
    big = 3_000_000_000
    wide = spark.createDataFrame([
        (dt.date(2020, 1, 2), 1.0, 2.0, 0.5, 1.5, big, None, None, None, None, None, 0.1),
        (dt.date(2020, 1, 3), 1.1, 2.1, 0.6, 1.6, 7, 5.0, None, None, None, 9, 0.0),
    ], "Date date, `Close|AAA` double, `High|AAA` double, `Low|AAA` double, `Open|AAA` double, "
       "`Volume|AAA` long, `Close|BBB` double, `High|BBB` double, `Low|BBB` double, "
       "`Open|BBB` double, `Volume|BBB` long, `Dividends|AAA` double")
    got = rows(wide_to_long(wide))
    assert got == [
        (dt.date(2020, 1, 2), "AAA", 1.0, 2.0, 0.5, 1.5, big),      # above 2^31 kept exact
        (dt.date(2020, 1, 3), "AAA", 1.1, 2.1, 0.6, 1.6, 7),
        (dt.date(2020, 1, 3), "BBB", 5.0, None, None, None, 9),      # partly empty kept
    ]                                                               # BBB on 01-02: all empty


def test_pretty_size_and_table_sizes(spark, scratch):
    vals = spark.createDataFrame([(0,), (10239,), (10240,), (5 * 1024 ** 3,)], "n long")
    assert [r[0] for r in vals.select(pretty_size("n")).collect()] == \
        ["0 bytes", "10239 bytes", "10 kB", "5120 MB"]
    path = os.path.join(scratch, "t")
    spark.range(1000).repartition(3).write.parquet(path)
    got = monitor.table_sizes(spark, {"t": path}).collect()[0]
    on_disk = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path)
                  if f.endswith(".parquet"))
    assert got.files == 3 and got.bytes == on_disk


def test_loaded_folders_order(spark):
    led = spark.createDataFrame([("2020q1",), ("2021q3",), ("2020q4",)], "folder_name string")
    assert [r[0] for r in monitor.loaded_folders(led).collect()] == ["2021q3", "2020q4", "2020q1"]


def test_company_list_from_table(spark):
    got = rows(html.company_list(_pages(spark)))
    assert got == [("AAA", 1), ("BBB", 2)]


def test_wide_maps_to_long(spark):
    from finlake.sources.prices import long_to_wide_maps, wide_maps_to_long

    big = 3_000_000_000
    wide = spark.createDataFrame([
        (dt.date(2020, 1, 2), {"AAA": 1.0, "BBB": None}, {"AAA": 2.0}, {"AAA": 0.5}, {"AAA": 1.5},
         {"AAA": big}),
        (dt.date(2020, 1, 3), {"BBB": 5.0}, {}, {}, {}, {"BBB": 9}),
    ], "Date date, Close map<string,double>, High map<string,double>, Low map<string,double>, "
       "Open map<string,double>, Volume map<string,bigint>")
    got = rows(wide_maps_to_long(wide))
    assert got == [(dt.date(2020, 1, 2), "AAA", 1.0, 2.0, 0.5, 1.5, big),
                   (dt.date(2020, 1, 3), "BBB", 5.0, None, None, None, 9)]
    assert rows(wide_maps_to_long(long_to_wide_maps(wide_maps_to_long(wide)))) == got


ARTICLES = """<html><body><p>menu</p>
<article><p class="body x">one<h2>Title</h2><p>two<ul><li>item</li></ul><p class='other body'>three<table><tr><td>cell
</td></tr></table>loose<p>four <b>bold</b><div>box</div></article>
<article><p>five</article><article class="z">no paragraph</article></body></html>"""


def test_paragraph_ends_and_articles_by_hand(spark):
    """Expected rows written by hand from the rule in the module's head."""
    pages = spark.createDataFrame([(1, ARTICLES)], "page_id long, html string")
    texts = lambda **kw: [r.text for r in html.paragraphs(pages, **kw).orderBy("pos").collect()]
    assert texts() == ["one", "two", "three", "four bold", "five"]
    assert texts(first_only=True) == ["one", "two", "three", "four bold"]
    assert texts(classes=["body"]) == ["one", "three"]
    assert texts(container=None) == ["menu", "one", "two", "three", "four bold", "five"]


def _texts(spark, page, **kw):
    return [r.text for r in html.paragraphs(spark.createDataFrame([(1, page)], "page_id long, html string"), **kw)
            .orderBy("pos").collect()]


def _table(spark, page, index=0):
    return [list(r.cells) for r in html.table_rows(spark.createDataFrame([(1, page)], "page_id long, html string"),
                                                   table_index=index).orderBy("row").collect()]


def test_nested_articles_end_where_they_belong(spark):
    page = "<p>menu</p><article><p>a</p><article><p>b</p></article><p>after</p></article><p>foot</p><article><p>c"
    assert _texts(spark, page) == ["a", "b", "after", "c"]
    assert _texts(spark, page, first_only=True) == ["a", "b", "after"]
    assert _texts(spark, "</article><p>x</p><article></article>") == ["x"]       # nothing in an article: the page
    assert _texts(spark, "<articles><p>not one</p></articles><ARTICLE id=1><P>one") == ["one"]
    deep = "<article>" * 300 + "<p>deep</p>" + "</article>" * 299 + "<p>still in</p></article><p>out</p>"
    assert _texts(spark, deep) == ["deep", "still in"]


def test_tags_end_outside_quotes(spark):
    assert _texts(spark, """<p title="a>b" class='c>d'>one</p><p data-x=it's>two</p>3 < 4<p>5 < 6 > 5</p>""") == [
        "one", "two", "5 < 6 > 5"]


def test_entities_are_decoded_once(spark):
    page = "<p>&#8217;&#x2019;&eacute;&Eacute;&euro;&#128512;&#150;|&amp;lt;&amp;amp;&nbsp;x&#0;&#xD800;&#x110000;</p>" \
           "<p>&bogus; &amp &; & &#; 1&lt;2&gt;0</p>"
    assert _texts(spark, page) == ["’’éÉ€😀–|&lt;&amp; x���", "&bogus; &amp &; & &#; 1<2>0"]


def test_nested_tables_rows_and_spans(spark):
    page = ("<table><tr><td>1<table><tr><td>n</td></tr></table></td><td>2</td></tr><tr><td>3</td></tr></table>"
            "<table><thead><tr><th colspan=2>h<tbody><tr><td>a<td>b&amp;<tr><td title='<td>'>c</table>")
    assert _table(spark, page) == [["1n", "2"], ["3"]]
    assert _table(spark, page, 1) == [["h", "h"], ["a", "b&"], ["c"]]
    assert _table(spark, page, 2) == [] and _table(spark, "no table") == []
    assert _table(spark, "<table><tr><td>open") == [["open"]]
    assert _table(spark, None or "<table></table>") == []


def test_null_pages(spark):
    pages = spark.createDataFrame([(1, None)], "page_id long, html string")
    assert html.paragraphs(pages).count() == 0 and html.table_rows(pages).count() == 0


def test_driver_page_paragraphs_by_hand(spark):
    """The first paragraphs of the first driver page, read off its source by eye."""
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").orderBy("page_id").limit(3)
    for page in pages.collect():
        got = [r.text for r in html.paragraphs(pages.filter(f"page_id = {page.page_id}")).orderBy("pos").collect()]
        article = page.html.split("<article>", 1)[1].split("</article>", 1)[0]
        plain = re.sub(r"\s+", " ", re.sub(r"<[^>]*>", "", re.sub(r"(?s)<!--.*?-->|<script.*?</script>", "", article)))
        for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
            plain = plain.replace(a, b)
        assert got and all(t in re.sub(r"\s+", " ", plain) for t in got)
        assert len(got) <= article.count("<p")


def test_table_counts(spark, scratch):
    path = os.path.join(scratch, "c")
    spark.range(41).write.parquet(path)
    assert rows(monitor.table_counts(spark, {"c": path})) == [("c", 41)]
