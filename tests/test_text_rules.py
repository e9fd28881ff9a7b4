"""Scrubbing of attributes, character references, the date grammar, word lists."""

import datetime as dt
import hashlib
import html
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillfeed.functions import text as TX
from quillfeed.functions.timeparse import parse_feed_time
from quillfeed.operators import clean
from quillfeed.plans import text_queries

TX_WORD = re.compile(r"[a-z0-9_]+")


def column(spark, values, expr):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, s string")
    return [r[1] for r in sorted(df.select("k", expr(F.col("s"))).collect())]


def test_scrub_keeps_attributes_exactly(spark):
    cases = {
        '<a title="a > b" href="https://x.y/">k</a>': '<a href="https://x.y/" title="a > b">k</a>',
        '<abbr title="Hyper">HT</abbr>': '<abbr title="Hyper">HT</abbr>',
        "<a title='say \"hi\"' href=\"mailto:a@b\">m</a>": '<a href="mailto:a@b" title="say &quot;hi&quot;">m</a>',
        "<a href=' java\tscript:x'>j</a><a href='ftp://x'>f</a>": "<a>j</a><a>f</a>",
        "<a data-x=\"href='https://no/'\" href=/rel>r</a>": '<a href="/rel">r</a>',
        '<A HREF="http://u/" HREF="http://v/">D</A>': '<a href="http://u/">D</a>',
        "3 < 5 > 2 & x &amp; y &lt;": "3 &lt; 5 &gt; 2 & x & y &lt;",
        "<!-- c > d -->x<!-- open": "x",
        "<b class='x' title='t'>b</b><p title='>'>q</p>": "<b>b</b>q",
        "plain": "plain",
    }
    assert column(spark, list(cases), TX.scrub_html) == list(cases.values())


def test_scrub_never_fails_a_row(spark):
    hard = ["<a " + 'x="y" ' * 20_000 + ">z</a>", "<" * 50_000, "<a " + '"' * 50_001, "<b>" * 20_000, "<!--" * 10_000, "a" * 300_000 + "<i>"]
    got = column(spark, hard, TX.scrub_html)
    assert got[0] == "<a>z</a>" and got[1] == "&lt;" * 50_000 and got[5].endswith("<i>")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("&;#x39ampltgqu o<>\"é")), max_size=14), min_size=1, max_size=20))
def test_references_equal_the_standard_library(spark, values):
    assert column(spark, values, TX.unescape_entities) == [html.unescape(v) for v in values]


def test_date_grammar(spark):
    at = dt.datetime(2020, 11, 12, 0, 29, 41)
    day = dt.datetime(2020, 11, 12)
    cases = {
        "Nov 12, 2020 10:00 AM": day.replace(hour=10), "Thursday, November 12, 2020 3:04 PM EST": day.replace(hour=20, minute=4),
        "Thu Nov 12 00:29:41 2020": at, "Thu Nov  12 00:29:41 UTC 2020": at, "2020/11/12": day, "1605140981": at, "1605140981123": at,
        "2020-11-12T00:29:41.123Z": at, "Thu, 12 Nov 20 00:29:41 GMT": at, "2020-11-12T05:59:41+05:30": at, "11/12/2020": day,
        "25/12/2020 13:00": dt.datetime(2020, 12, 25, 13), "12th November 2020 at 12:05 am": day.replace(minute=5), "12-Nov-2020": day,
        "12 Nov 2020 02:29 (GMT+2)": day.replace(minute=29), "Sept 5, 2021": dt.datetime(2021, 9, 5), "Nov 12, 2020 12:30 pm": day.replace(hour=12, minute=30),
        "not a date": None, "2020-13-01": None, "2020-02-30": None, "12 Nov": None, "32 Nov 2020": None, "Nov 12, 2020 13:00 PM": None,
        "": None, "Mon, 1 Jun 2020 10:00:00 XYZ": None, "12 Nov 2020 or so": None, "2020-11-12T25:00:00Z": None,
    }
    got = column(spark, [*cases, None], parse_feed_time)
    assert dict(zip(cases, got)) == cases and got[-1] is None


def test_rejected_times_are_counted_by_feed(spark):
    rows = [("f", "", "soon", None, None), ("f", None, "soon", None, None), ("g", None, None, None, None), ("g", "12 Nov 2020", None, None, None),
            ("g", "2024-02-30", "12 Nov 2020", None, None)]
    df = spark.createDataFrame(rows, "feed_url string, updated string, published string, feed_updated string, feed_published string")
    got = {(r.feed_url, r.raw): r.n for r in clean.rejected_times(df).collect()}
    assert got == {("f", "soon"): 2, ("g", None): 1, ("g", "2024-02-30"): 1}


def test_word_list_as_a_table(spark, monkeypatch):
    texts = [(1, "An Apple-pie, apple PIE"), (2, "pineapple"), (3, None), (4, ""), (5, "pie apple"), (6, "the bad word, twice: bad word")]
    rows = spark.createDataFrame(texts, "id int, t string")
    words = spark.createDataFrame([("apple",), ("Apple pie",), ("BAD-WORD",), ("bad word",), ("",), (None,), ("one two three four",)], "word string")
    want = {1: (2, "apple"), 5: (1, "apple"), 6: (1, "bad word")}
    for most in (clean.BROADCAST_WORDS, 1):  # broadcast, then sorted and merged
        monkeypatch.setattr(clean, "BROADCAST_WORDS", most)
        found = clean.flag_listed_words(rows, "id", "t", words)
        assert {r.id: (r.n_listed, r.first_listed) for r in found.collect()} == want
    assert clean.flag_listed_words(rows, "id", "t", words.limit(0)).count() == 0


def test_word_list_reads_and_cuts_each_text_once(spark, tmp_path):
    texts = [(k, t) for k, t in enumerate(["alpha beta gamma alpha", "Alpha", "", None, "x", "beta, gamma beta-gamma"] + [f"word{i} next{i} word{i}" for i in range(200)])]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    listed = text_queries.word_list(spark, str(tmp_path))
    words = [TX_WORD.findall((t or "").lower()) for _, t in texts]
    drawn = {w for ws in words for w in [*ws, *([" ".join(ws[:2])] if len(ws) > 1 else [])]}
    want = {w.upper().replace(" ", " - ") for w in drawn if len(w) >= 5 and hashlib.md5(w.encode()).hexdigest() < "10"}
    assert sorted(r.word for r in listed.collect()) == sorted(want) and any("-" in w for w in want)
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
