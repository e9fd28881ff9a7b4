"""End-to-end QRY8 on the RSS fixture: parse, clean, enrich, dedup, rank, write."""

import datetime as dt
import json
import math
import os
import tempfile

from pyspark.sql import functions as F

from quillfeed.plans.feed_build import build_locale_feeds
from quillfeed.sinks.writers import write_locale_feeds
from quillfeed.sources import feeds

HERE = os.path.dirname(os.path.abspath(__file__))
FEED = "https://www.harbor.example.org/rss"
AS_OF = dt.datetime(2024, 1, 31, 12, 0, 0)
PUB_SCHEMA = ("feed_url string, locale string, publisher_id string, publisher_name string, category string, "
              "site_url string, content_type string, creative_instance_id string, channels array<string>, "
              "max_entries int, og_images boolean")


def _docs(spark):
    with open(os.path.join(HERE, "data", "sample.rss")) as fh:
        rss = fh.read()
    return spark.createDataFrame([(FEED, rss), ("https://broken.example.com/rss", "<rss><chan")],
                                 "feed_url string, content string")


def _pubs(spark, max_entries=20):
    row = (FEED, "en_US", "pid1", "Harbor Gazette", "News", "https://www.harbor.example.org", "article", "",
           ["Top News"], max_entries, False)
    return spark.createDataFrame([row, (FEED, "de_DE") + row[2:]], PUB_SCHEMA)


def test_parse_positions_and_failures(spark):
    docs = _docs(spark)
    e = feeds.parse_feeds(docs)
    assert [r["pos"] for r in e.orderBy("pos").collect()] == [0, 1, 2, 3, 4]
    assert [r["feed_url"] for r in feeds.failed_documents(docs).collect()] == ["https://broken.example.com/rss"]


def test_build_locale_feeds(spark):
    b = build_locale_feeds(_docs(spark), _pubs(spark), as_of=AS_OF)
    rows = b.feed.collect()
    by_loc = {}
    for r in rows:
        by_loc.setdefault(r["locale"], []).append(r)
    assert set(by_loc) == {"en_US", "de_DE"}
    for loc, rs in by_loc.items():
        # untitled, home-page and 60-day-old entries are dropped
        assert [r["title"] for r in rs] == ["Tide tables & storms", "Ferry schedule changes"]
        tide, ferry = rs
        assert tide["img"] == "https://cdn.harbor.example.org/large.jpg"  # widest media:content
        assert ferry["img"] == ""
        assert tide["description"] == "Storm season begins."
        secs = (AS_OF - dt.datetime(2024, 1, 30, 12, 30)).total_seconds()
        assert abs(tide["score"] - math.log(secs) * 2) < 1e-9
        secs2 = (AS_OF - dt.datetime(2024, 1, 29, 8, 0)).total_seconds()
        assert abs(ferry["score"] - math.log(secs2) * 4) < 1e-9
        import hashlib
        assert tide["url_hash"] == hashlib.sha256(b"https://www.harbor.example.org/news/tide-tables").hexdigest()
    rep = {(r["feed_url"], r["locale"]): (r["size_after_get"], r["size_after_insert"]) for r in b.report.collect()}
    assert rep[(FEED, "en_US")] == (5, 5)


def test_first_n_entries(spark):
    b = build_locale_feeds(_docs(spark), _pubs(spark, max_entries=1), as_of=AS_OF)
    assert {r["title"] for r in b.feed.collect()} == {"Tide tables & storms"}
    rep = {r["locale"]: (r["size_after_get"], r["size_after_insert"]) for r in b.report.collect()}
    assert rep["en_US"] == (5, 1)


def test_known_articles_reused(spark):
    arts = build_locale_feeds(_docs(spark), _pubs(spark), as_of=AS_OF).feed
    stored = arts.where(F.col("locale") == "en_US").where(F.col("img") != "").select(
        "article_key", "title", "publish_time", "img", "padded_img", "category", "description", "content_type",
        "creative_instance_id", "url", "url_hash", F.lit(42.0).alias("pop_score"), "score")
    b = build_locale_feeds(_docs(spark), _pubs(spark), as_of=AS_OF, stored=stored)
    tide = [r for r in b.feed.collect() if r["title"].startswith("Tide")]
    assert {r["pop_score"] for r in tide} == {42.0}


def test_write_locale_feeds(spark):
    b = build_locale_feeds(_docs(spark), _pubs(spark), as_of=AS_OF)
    out = tempfile.mkdtemp(prefix="qf-feed-")
    write_locale_feeds(b.feed, out + "/feed")
    files = [f for f in os.listdir(out + "/feed/locale=en_US") if f.endswith(".json")]
    lines = []
    for f in sorted(files):
        with open(out + "/feed/locale=en_US/" + f) as fh:
            lines.extend(json.loads(x) for x in fh)
    assert [x["title"] for x in lines] == ["Tide tables & storms", "Ferry schedule changes"]
    assert lines[0]["publish_time"] == "2024-01-30 12:30:00"


def test_guid_links_grouped_media_and_rss_1(spark):
    from quillfeed.sources import feeds

    rss = ('<?xml version="1.0"?><rss version="2.0" xmlns:media="m"><channel><title>t</title>'
           '<item><title>A</title><guid>https://x/1</guid><media:group><media:content url="https://i/1.png" width="10"/></media:group></item>'
           '<item><title>B</title><guid isPermaLink="false">https://x/2</guid></item>'
           '<item><title>C</title><link>https://x/c</link><guid>https://x/3</guid><media:content url="https://i/3.png"/></item>'
           '</channel></rss>')
    rdf = ('<?xml version="1.0"?><rdf:RDF xmlns:rdf="r"><channel><title>t</title></channel>'
           '<item><title>E</title><link>https://y/1</link><dc:date>2020-11-12T00:29:41Z</dc:date></item></rdf:RDF>')
    docs = spark.createDataFrame([("f1", rss, 1), ("f2", rdf, 2)], "feed_url string, content string, doc_ord long")
    got = [(r["title"], r["link"], r["updated"], [m["url"] for m in r["media_content"] or []])
           for r in feeds.parse_feeds(docs).orderBy("ord").collect()]
    assert got == [("A", "https://x/1", None, ["https://i/1.png"]), ("B", None, None, []),
                   ("C", "https://x/c", None, ["https://i/3.png"]), ("E", "https://y/1", "2020-11-12T00:29:41Z", [])]
