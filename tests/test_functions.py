"""Column functions against the standard library and the reference's expected values."""

import hashlib
import html
from urllib.parse import quote, urljoin, urlparse

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillfeed.functions import text as TX
from quillfeed.functions import urls as U
from quillfeed.functions.images import first_tag_attr, is_video_url, pick_image, widest
from quillfeed.functions.scoring import dampen_popularity


def test_scrub_expected_values(spark):
    df = spark.createDataFrame(
        [("<h1>This is a title</h1>",), ("<script>alert('Hello World!')</script>",),
         ("A &amp; B <b>bold</b> <span class='x'>s</span><!-- c -->",), ('<a href="https://x" class="y">l</a>',), (None,)],
        "s string")
    got = [r[0] for r in df.select(TX.scrub_html(F.col("s"))).collect()]
    assert got == ["This is a title", "alert('Hello World!')", "A & B <b>bold</b> s", '<a href="https://x">l</a>', None]


def test_html_to_text_and_titles(spark):
    df = spark.createDataFrame([("<p>Fish &amp; chips &middot; <b>now</b></p><script>x()</script>",), ("Tom &amp;amp; Jerry",)], "s string")
    r = df.select(TX.html_to_text(F.col("s")).alias("t"), TX.title_text(F.col("s")).alias("tt")).collect()
    assert r[0]["t"] == "Fish & chips · now"
    assert r[1]["t"] == "Tom &amp; Jerry" and r[1]["tt"] == "Tom & Jerry"  # titles are decoded twice


def test_full_unescape_matches_stdlib(spark):
    vals = ["&eacute;t&eacute; &#8364; &#x1F600; &notanentity; &amp;lt;", "it&#8217;s caf&eacute;", "&amp", "&ampx; &notit; &notin;",
            "&#128;&#129;&#0;&#xD800;&#99999999999;&#1;", "a & b &c; &", "&nosuch; &Aacute &#;&#x;", "&copy2020 &lt&gt", "plain"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    assert [r[0] for r in df.select(TX.unescape_entities(F.col("s"))).collect()] == [html.unescape(v) for v in vals]


def test_word_filter(spark):
    df = spark.createDataFrame([("Hedonistic weekend",), ("a Vibrators-sale",), ("hedonisticx",), ("clean title",)], "s string")
    got = [r[0] for r in df.select(TX.contains_listed_word(F.col("s"), ["vibrators", "hedonistic"])).collect()]
    assert got == [True, True, False, False]


SEG = st.text(alphabet=st.sampled_from(list("abcXYZ019-_.~*+% !@é/?")), max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(SEG, min_size=1, max_size=8))
def test_quote_path_matches_stdlib(spark, paths):
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r[0] for r in df.select(U.quote_path(F.col("p"))).collect()]
    assert got == [quote(p) for p in paths]


def test_url_parts_match_urlparse(spark):
    urls = ["https://Example.com:8080/a/b.html?x=1#top", "http://user@m.x.org/en/1/", "//cdn.x.org/i.png",
            "/rel/path", "https://x.org", "https://x.org/a b/~c"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    rows = df.select(U.url_scheme(F.col("u")).alias("s"), U.url_netloc(F.col("u")).alias("n"), U.url_path(F.col("u")).alias("p"),
                     U.url_host(F.col("u")).alias("h"), U.url_hash(F.col("u")).alias("x"), U.is_https_url(F.col("u")).alias("ok")).collect()
    for u, r in zip(urls, rows):
        pu = urlparse(u)
        assert (r["s"], r["n"], r["p"]) == (pu.scheme, pu.netloc, pu.path + (";" + pu.params if pu.params else ""))
        assert r["h"] == pu.hostname
        assert r["x"] == hashlib.sha256(u.encode()).hexdigest()
        assert r["ok"] == bool(pu.scheme == "https" and pu.netloc)


def test_resolve_against_matches_urljoin(spark):
    pairs = [("https://www.x.org/en/page.html", "/img/a.png"), ("https://www.x.org/en/page.html", "img/a.png"),
             ("https://www.x.org/en/", "b.png"), ("https://www.x.org", "c.png"), ("https://www.x.org/a", "//cdn.y.com/i.png"),
             ("https://www.x.org/a", "https://z.org/q.png")]
    df = spark.createDataFrame(pairs, "b string, r string")
    got = [r[0] for r in df.select(U.resolve_against(F.col("b"), F.col("r"))).collect()]
    assert got == [urljoin(b, r) for b, r in pairs]


def test_ensure_https_www(spark):
    df = spark.createDataFrame([("example.com",), ("https://example.com",), ("https://www.example.com",), ("file://x.com",)], "d string")
    got = [r[0] for r in df.select(U.ensure_https_www(F.col("d"))).collect()]
    assert got == ["https://www.example.com", "https://www.example.com", "https://www.example.com", "https://www.file://x.com"]


def test_image_pick_order(spark):
    schema = ("image string, urlToImage string, mc array<struct<url:string,width:string>>, "
              "mt array<struct<url:string,width:string>>, summary string, content string")
    rows = [
        (None, None, [("a", "100"), ("b", "300"), ("c", "300")], None, None, None),  # widest, first on ties
        (None, None, None, [("t", None)], '<img src="s.png">', None),
        (None, None, [], None, '<p>x</p><img alt="y" src="z.png"/>', None),
        ("", "", None, None, None, '<div><img src="c.png"></div>'),
        ("i", "u", [("a", "1")], None, None, None),
        (None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(pick_image(F.col("image"), F.col("urlToImage"), F.col("mc"), F.col("mt"),
                                              F.col("summary"), F.col("content"))).collect()]
    assert got == ["b", "t", "z.png", "c.png", "i", ""]
    assert df.select(widest(F.col("mc"))["url"]).first()[0] == "b"
    assert df.select(first_tag_attr(F.lit("<img src='q.jpg'>"))).first()[0] == "q.jpg"


def test_video_suffix_and_dampening(spark):
    df = spark.createDataFrame([("a.mp4",), ("a.MP4",), ("a.jpg",), (None,)], "s string")
    assert [r[0] for r in df.select(is_video_url(F.col("s"))).collect()] == [True, False, False, False]
    d = spark.createDataFrame([(300.0,), (301.0,), (0.0,)], "s double")
    got = [r[0] for r in d.select(dampen_popularity(F.col("s"))).collect()]
    assert got[0] == 300.0 and got[2] == 0.0 and abs(got[1] - (299 + 2 ** (2 / 3))) < 1e-12


def test_redirect_chains(spark):
    from quillfeed.operators.clean import resolve_urls

    links = spark.createDataFrame([(1, "https://s/a"), (2, "https://s/b"), (3, "https://s/c"), (4, "https://x/final"),
                                   (5, "https://s/loop"), (6, "https://t/0")], "id int, link string")
    red = spark.createDataFrame([
        ("https://s/a", "https://s/a2", 301), ("https://s/a2", "https://t/a%20b c", 302),  # two hops
        ("https://s/b", "https://t/gone", 404),  # failed hop -> dropped
        ("https://s/c", "https://t/c", 301), ("https://s/c", "https://t/c", 301),  # repeated fetch
        ("https://s/loop", "https://s/loop", 301),  # a circle is dropped
        *[(f"https://t/{i}", f"https://t/{i + 1}", 301) for i in range(12)],  # twelve hops
    ], "src string, dst string, status int")
    got = {r["id"]: (r["url"], r["url_hash"]) for r in resolve_urls(links, red).collect()}
    assert set(got) == {1, 3, 4, 6}
    assert got[1] == ("https://t/a%2520b%20c", hashlib.sha256(b"https://t/a%20b c").hexdigest())
    assert got[3][0] == "https://t/c" and got[4][0] == "https://x/final" and got[6][0] == "https://t/12"


def test_references_resolve_like_urljoin(spark):
    refs = ["../i.png", "./a", "?q=1", "#f", "data:image/png;base64,AA", "//c.d/x", "/z", "p/q?x=/../y", "..", "../../../x/./y/..",
            "mailto:a@b", "http://o.org/a", "a/../b", ".", "x#y", "/a/../b"]
    rows = [(b, r) for b in ("https://h.org/a/b/c.html?u=1#z", "https://h.org", "https://h.org/") for r in refs]
    df = spark.createDataFrame(rows, "b string, r string").select("b", "r", U.resolve_against(F.col("b"), F.col("r")).alias("o"))
    assert [r["o"] for r in df.collect()] == [urljoin(b, r) for b, r in rows]


def test_looser_date_layouts(spark):
    from quillfeed.functions.timeparse import parse_feed_time

    vals = ["2020-11-12T00:29:41+0000", "12 November 2020 00:29:41 +0000", "12 Nov 20 00:29:41 +0000", "2020-11-12 00:29:41 +0000",
            "Nov 12, 2020 00:29:41", "Thursday, 12 November 2020 00:29:41", "2020-11-12 01:29:41+01:00", "Thu, 12 Nov 2020 00:29:41 GMT"]
    df = spark.createDataFrame([(v,) for v in vals], "s string").select(parse_feed_time(F.col("s")).cast("string").alias("t"))
    assert [r["t"] for r in df.collect()] == ["2020-11-12 00:29:41"] * len(vals)
