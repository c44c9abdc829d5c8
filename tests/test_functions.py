"""Scalar functions against expected values and against plain Python models of what they say."""

import hashlib
import html
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions import dates, jsonattrs, markup, text, urls

WHITE = "[" + "".join(map(chr, text.WHITE_POINTS)) + "]"


def one(spark, function, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return row.select(function(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(
    ("function", "value", "expected"),
    [
        (text.strip_tags, "a<b>b</b>c", "abc"),
        (text.strip_tags, "x<a\nb>y", "x<a\nb>y"),
        (text.strip_tags, None, ""),
        (text.clean, "<p> A&nbsp;B </p>", "A&nbsp;B"),
        (text.normalise, "a .... b ----- c", "a ... b --- c"),
        (text.normalise, "a " + chr(0x200B) + " b", "a  b"),
        (text.normalise, "&amp;lt;", "&lt;"),
        (markup.short, "<p>A &amp;amp; <b>B</b></p> " + "word " * 200, ("A & B " + "word " * 200)[:500].rsplit(" ", 1)[0] + "..."),
        (markup.short, None, ""),
        (text.clean_title, "Big News - Site", "Big News"),
        (text.clean_title, "Self-Made", "Self"),
        (text.clean_title, "A | B | C", "A | B"),
        (lambda c: text.truncate_words(c, 500), "x" * 600, "x" * 500 + "..."),
        (lambda c: text.truncate_words(c, 10), "one two three four", "one two..."),
        (text.word_count, None, 0),
        (text.word_count, "a b" + chr(0xA0) + "c", 3),
        (lambda c: F.array_join(text.keywords(c), ","), "How the New York Stock Exchange Was Built in 1792", "york,stock,exchange,built,1792"),
        (text.locale, "en_US", "en"),
        (text.locale, None, "en"),
        (text.display_name, "youtube_channel_url", "Youtube Channel"),
        (text.display_name, "website", "Website"),
        (text.slug_query, "a-quiet_town", "A Quiet Town"),
        (urls.slug, "https://h/a/b/?q=1#t", "b"),
        (urls.slug, "https://h/", ""),
        (urls.is_content, "https://h/tag/x", False),
        (urls.is_content, "https://h/page/2", False),
        (urls.is_content, "https://h/a?b", False),
        (urls.is_content, "https://h/feed", False),
        (urls.is_content, "https://h/", False),
        (urls.is_content, "https://h/#top", False),
        (urls.is_content, "https://h/post", True),
        (urls.is_content, None, False),
        (lambda c: dates.iso_text(dates.iso_instant(c)), "2024-01-15T10:00:00.000Z", "2024-01-15T10:00:00+00:00"),
        (dates.iso_instant, "bad", None),
        (lambda c: dates.iso_text(dates.feed_instant(c)), "2024-01-15", "2024-01-15T00:00:00+00:00"),
        (dates.feed_instant, "Tuesday", None),
        (dates.unread, "Tuesday", True),
    ],
)
def test_values(spark, function, value, expected):
    assert one(spark, function, value) == expected


def test_reading_minutes_halves_to_even(spark):
    counts = spark.createDataFrame([(n,) for n in (0, 100, 300, 500, 700)], "n int")
    assert [r[0] for r in counts.select(text.reading_minutes(F.col("n"))).collect()] == [1, 1, 2, 2, 4]


def test_record_id(spark):
    url = "https://h/a"
    assert one(spark, urls.record_id, "WordPress/Some", url) == "Some_" + hashlib.md5(url.encode()).hexdigest()[:12]


def test_excerpt(spark):
    long = "A sentence here. " * 15 + "Then more words follow without an end " * 20
    got = one(spark, text.excerpt, long)
    end = long[:600].rfind(". ", 0, 300)
    assert got == long[: end + 1]
    assert one(spark, text.excerpt, "word " * 200) == ("word " * 200)[:300].rsplit(" ", 1)[0] + "..."


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("ab<>/ \t\n.-|&;" + chr(0xA0) + chr(0x200B) + "é"), max_size=60), min_size=1, max_size=20))
def test_models(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    got = df.select(text.clean(c), text.normalise(c), text.word_count(c), text.clean_title(c, entities=False)).collect()
    for t, (cleaned, normal, count, title) in zip(texts, got, strict=True):
        strip = lambda s: re.sub(f"^{WHITE}+|{WHITE}+$", "", s)
        assert cleaned == strip(re.sub(f"{WHITE}+", " ", re.sub("<.*?>", "", t)))
        model = re.sub(f"{WHITE}+", " ", html.unescape(t)).replace(chr(0x200B), "")
        assert normal == strip(re.sub("-{3,}", "---", re.sub(r"\.{3,}", "...", model)))
        assert count == len([w for w in re.split(f"{WHITE}+", t) if w])
        assert title == strip(re.sub(f"{WHITE}+", " ", re.sub(f"{WHITE}*[-|–—]{WHITE}*[^-|–—]+$", "", t)))


class TestAttributes:
    def test_media(self):
        assert jsonattrs.media({"data": {"attributes": {"url": "u", "width": 0}}}) == {"url": "u"}
        assert jsonattrs.media({"data": []}) == {} and jsonattrs.media(None) == {} and jsonattrs.media({"data": None}) == {}

    def test_relations(self):
        assert jsonattrs.relations({"data": [{"attributes": {"title": None}}, {"id": 1}, None]}) == [{"title": None}]
        assert jsonattrs.relations({"data": {"attributes": {"name": "n", "x": 1}}}) == [{"name": "n"}]
        assert jsonattrs.relations({"data": None}) == []

    def test_flat(self):
        got = jsonattrs.flat_attributes({"user_id": 1, "featured": False, "tags": [], "x": {"a": 1}, "description": "<p></p>"})
        assert got == {"featured": False, "tags": []}

    def test_links_first_of_equal(self):
        got = jsonattrs.links({"content": '<a href="u">one</a><a href=" v "></a>', "description": '<a href="u">two</a>', "website": "w", "facebook_url": "u"})
        assert got == [{"text": "two", "url": "u"}, {"text": " v ", "url": "v"}, {"text": "Website", "url": "w"}]

    @pytest.mark.parametrize(("ids", "expected"), [([], "0"), ([3], "3"), ([3, 4], "[3, 4]"), (["a", "b"], "0")])
    def test_application_source(self, ids, expected):
        assert jsonattrs.application_source({"applications": {"data": [{"id": i} for i in ids]}}) == expected

    def test_application_source_odd(self):
        assert jsonattrs.application_source({"applications": None}) == "0"
        assert jsonattrs.application_source({}, "X") == "X"

    def test_structured(self, spark):
        texts = ['{"title": " <b>T</b> ", "slug": null}', None, "[1]", "{cut", '{"title": 3}', '{"title": "\\ud800"}', "{}"]
        df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, attributes string")
        got = {r["id"]: r for r in jsonattrs.structured(df).collect()}
        assert (got["0"]["clean_title"], got["0"]["clean_slug"], got["0"]["clean_locale"], got["0"]["problem"]) == ("T", None, "en", None)
        assert all(got[i]["problem"] for i in "1234") and got["5"]["clean_title"] == "?" and got["6"]["clean_slug"] == ""
        with pytest.raises(ValueError, match="named like results"):
            jsonattrs.structured(df.withColumn("problem", F.lit(1)))


PAGE = """<html><head><title>Fallback - Site</title><meta property="og:title" content=" Real title "><meta name="description" content="About">
<meta property="og:locale" content="de_DE"><meta property="og:image" content="/i.png"><meta property="article:published_time" content="2024-01-01"></head><body>
<div class="byline">By <a href="/a">Ann</a></div><div class="sidebar">Nothing here</div>
<div class="entry-content x"><p>First <b>para<br>graph</b><p>Second &amp; last{filler}<script>no()</script>
<img src="a.png" width="50" height="200"><img src="b.png" width="50"><img data-src="c.png" width="50px" height="50px" alt=" c ">
<a href="https://other/x">Other</a><a href="https://h/own">own</a><a href="https://other/x">again</a><a href="https://facebook.com/share?u">s</a></div>
<a rel="category tag">News</a><a rel="tag">One</a><a rel="tag">One</a></body></html>"""


def test_page():
    page = markup.read_page("https://h/p/", PAGE.replace("{filler}", " and so on" * 12))
    assert (page["title"], page["description"], page["author"], page["locale"]) == ("Real title", "About", "Ann", "de")
    assert page["feature_image"] == {"url": "https://h/i.png", "alt": "Real title"}
    assert [i["url"] for i in page["images"]] == ["https://h/p/b.png", "https://h/p/c.png"] and page["images"][1]["alt"] == "c"
    assert page["sources"] == [{"text": "Other", "url": "https://other/x"}]
    assert (page["categories"], page["tags"]) == (["News"], ["One"])
    assert page["content"].startswith("First para graph Second & last and so on") and "no()" not in page["content"]


def test_tags_fall_back_only_without_tag_links():
    assert markup.labels(markup.parse('<a rel="category tag">C</a><div class="tags"><a>T</a></div>')) == (["C"], [])
    assert markup.labels(markup.parse('<div class="tags"><a>T</a></div>'))[1] == ["T"]


def test_furniture():
    skip = lambda c, t="x": markup._is_furniture(markup.parse(f'<div class="{c}">{t}</div>').children[0])
    assert skip("entry-header") and skip("ads-") is False and skip("ads-x") and not skip("my_header") and not skip("ad")
    assert not skip("sidebar", "y" * 501)


@pytest.mark.parametrize("page", ["", "<", "<p>" * 3000, "</div></p>", "<a href>", "plain", "<div><div></div>", "<!-- x", "<![CDATA[", None])
def test_any_page_parses(page):
    assert isinstance(markup.plain_text(page), str)


def test_articles_report_errors(spark):
    df = spark.createDataFrame([("u", None), ("v", "<h1>T</h1>"), ("w", "")], "url string, html string")
    got = {r["url"]: r for r in markup.articles(df).collect()}
    assert not got["u"]["ok"] and got["v"]["article"]["title"] == "T" and got["w"]["article"]["content"] == ""


def test_links_of():
    assert markup.links_of('<a href="x">t</a><a href=" ">no</a><a>no</a><a href="y"></a>') == [("t", "x"), ("y", "y")]


def test_white_space_class(spark):
    chars = spark.createDataFrame([(p, chr(p)) for p in range(1, 0x10000) if not 0xD800 <= p <= 0xDFFF], "id int, c string")
    assert sorted(r["id"] for r in chars.where(F.col("c").rlike(f"^[{text.WHITE}]$")).collect()) == sorted(text.WHITE_POINTS)


def test_nested_blocks_are_read_once():
    import time

    deep = lambda n: "<div>word " * n + "end" + "</div>" * n
    seconds = []
    for n in (2_000, 16_000):
        root = markup.parse(deep(n))
        start = time.perf_counter()
        assert markup.article(root) is not None and len(markup.article(root).text()) == 4 * n + 4
        seconds.append(time.perf_counter() - start)
    assert seconds[1] < max(1.0, 24 * seconds[0])  # quadratic would be 64


def test_articles_place_is_the_most_specific_then_the_first():
    found = lambda page: markup.article(markup.parse(page)).text()
    assert found('<main>M<article>A</article><p id="content">C</p><b class="post-body">B</b><b class="x entry-content">E</b><b class="entry-content">L</b></main>') == "E"
    assert found('<article>A<div class="content">in</div></article><i itemprop="articleBody">I</i>') == "in"
    assert found('<div class="content">out</div><article>A</article><article>L</article>') == "A"
    assert found('<main><p class="content">C</p></main><main>L</main>') == "C"
    assert found("<div>most of the text</div><div>few</div>") == "most of the text"


def test_content_is_read_off_the_pages_own_tree():
    inner = lambda x: markup.read_page("u", f'<div class="entry-content">{x}{" and so on" * 12}</div>')["content"].split(" and so on")[0]
    assert inner("one<!-- c -->word a<3 &amp;lt; <b>b</b>") == "oneword a<3 < b"
    assert inner('<p class="widget">no<i>t</i></p><form class="x">no</form>yes') == "yes"
    assert inner('<p class="widget">' + "y" * 500 + "<script>" + "n" * 9 + "</script></p>yes") == "yes"
    assert inner('<p class="widget">' + "y" * 501 + "</p>") == "y" * 501
    assert inner("<scripted>&lt;p&gt;</scripted>yes") == "<p> yes"  # once lost, as a tag of the copy


@pytest.mark.parametrize("tag", ['<A Href="x&amp;y" class="">', "<a href='x&amp;y' class>", '<a href="x&amp;y"\n class = "" href="z" >', '<a\thref="x&amp;y" class=""/>'])
def test_plain_and_other_tags_are_read_alike(tag):
    node = markup.parse(tag + "t</A>").children[0]
    assert (node.name, node.attrs) == ("a", {"href": "x&y", "class": ""})


def test_articles_of_some_fields(spark):
    df = spark.createDataFrame([("https://h/p/", PAGE.replace("{filler}", " and so on" * 12)), ("v", None)], "url string, html string")
    whole = {r["url"]: r for r in markup.articles(df).collect()}
    for only in (["content", "content_hash"], ["images", "categories", "tags", "sources"], ["author", "title", "feature_image"]):
        for r in markup.articles(df, only=only).collect():
            assert (r["ok"], r["error"]) == (whole[r["url"]]["ok"], whole[r["url"]]["error"])
            assert r["article"] is None if not r["ok"] else r["article"].asDict() == {x: whole[r["url"]]["article"][x] for x in only}


def test_images_and_links_once_each_whatever_their_spelling():
    body = lambda x: markup.parse(f"<p>{x}</p>")
    pictures = '<img src="a.png" width="50" height="200"><img src="a.png" alt="x"><img data-src="https://h/p/b.png" alt=" b "><img src="/p/b.png"><img src="" data-lazy-src="b.png"><img>'
    assert markup.images(body(pictures), "https://h/p/") == [{"url": "https://h/p/b.png", "alt": "b"}]
    pages = '<a href="https://o/x"> </a><a href="https://o/x">X</a><a href="http://[bad">b</a><a href="https://h/y">own</a><a href="HTTPS://o/z">Z</a><a>n</a><a href="https://o;p/x?y">P</a>'
    assert markup.external_links(body(pages), "https://h/p/") == [{"text": "https://o/x", "url": "https://o/x"}, {"text": "P", "url": "https://o;p/x?y"}]


def test_metadata_takes_the_first_element_of_each_place():
    read = lambda x: markup.metadata(markup.parse(x), "https://h/p/")
    page = '<h1>H</h1><time datetime="1">t</time><time class="x entry-date" datetime="2"><time class="published" datetime="3"><p class="byline">By <a>A</a></p><p class="author">B</p><title>T</title><title>U</title>'
    got = read(page + '<meta property="og:title" content=""><meta property="og:title" content="late"><meta name="author" content=""><meta name="og:image" content="x">')
    assert (got["title"], got["published_date"], got["author"], got["feature_image"], got["locale"]) == ("T", "2", "A", None, "en")
    got = read(page + '<meta property="og:title" content=" "><meta name="author" content=" "><meta property="article:published_time" content="4"><meta name="description" content="d" property="og:locale">')
    assert (got["title"], got["published_date"], got["author"], got["description"], got["locale"]) == (None, "4", None, "d", "d")
    assert read("<h1>H</h1>")["title"] == "H" and read("")["title"] is None and read('<title> </title><h1>H</h1>')["title"] == ""


def test_metadata_walks_the_page_once(monkeypatch):
    walks = []
    walk = markup.Node.walk
    monkeypatch.setattr(markup.Node, "walk", lambda node: walks.append(node.name) or walk(node))
    markup.metadata(markup.parse("<html><body><p>x</p></body></html>"), "u")
    assert walks == [""]
