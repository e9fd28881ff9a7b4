"""Publisher CSV sources: header unions, typing, validation, nesting, store loads."""

import hashlib
import os
import tempfile

from pyspark.sql import functions as F

from quillfeed.operators import store as ST
from quillfeed.plans.sources_build import build_sources, load_store
from quillfeed.sources.lookups import read_covers, read_favicons, read_json_map
from quillfeed.sources.publisher_csv import read_source_csvs

H1 = ("Domain,Feed,Title,Category,Status,Score,OG-Images,Content Type,Creative Instance ID,"
      "Destination Domains,Channels,Rank,Original_Feed")
H2 = ("Domain,Feed,Title,Category,Status,Score,OG-Images,Content Type,Creative ID,"
      "Destination Domains,Channels,Rank,Original_Feed")


def _write(tmp, name, header, rows):
    with open(os.path.join(tmp, name), "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(r + "\n")


def _fixture():
    tmp = tempfile.mkdtemp(prefix="qf-src-")
    _write(tmp, "sources.en_GB.csv", H1, [
        "https://www.alpha.example.com,https://www.alpha.example.com/rss,Alpha News,News,Enabled,,On,article,cid-1,alpha.example.com,Top News; World News,3,",
        "https://www.beta.example.com,https://www.beta.example.com/rss,Beta <span>Daily</span> &amp; Co,News,Disabled,2.5,,article ,,beta.example.com,,,https://orig.example.com/feed",
        "https://www.bad.example.com,https://www.bad.example.com/rss,,News,Enabled,,,article,,bad.example.com,,,",
    ])
    _write(tmp, "sources.es_ES.csv", H2, [
        "https://www.alpha.example.com,https://www.alpha.example.com/rss,Alpha News,News,Enabled,,,article,xx,alpha.example.com,Deportes,1,",
        "not-a-url,https://www.gamma.example.com/rss,Gamma,News,Enabled,,,article,,gamma.example.com,,,",
    ])
    with open(os.path.join(tmp, "favicons.json"), "w") as f:
        f.write('{"https://www.alpha.example.com": "https://icons.example.com/alpha.png"}')
    return tmp


def test_read_and_build(spark):
    tmp = _fixture()
    raw = read_source_csvs(spark, os.path.join(tmp, "sources.*_*.csv"))
    assert {r["locale"] for r in raw.collect()} == {"en_GB", "es_ES"}
    fav = read_favicons(spark, os.path.join(tmp, "favicons.json"))
    cov = read_covers(spark, os.path.join(tmp, "missing_covers.json"))
    b = build_sources(raw, fav, cov)
    assert b.quarantine.count() == 2
    rows = {(r["locale"], r["publisher_name"]): r for r in b.rows.collect()}
    beta = rows[("en_GB", "Beta Daily & Co")]
    assert beta["enabled"] is False and beta["score"] == 2.5 and beta["content_type"] == "article"
    assert beta["publisher_id"] == hashlib.sha256(b"https://orig.example.com/feed").hexdigest()
    assert beta["channels"] == [] and beta["rank"] is None and beta["og_images"] is False
    alpha_gb = rows[("en_GB", "Alpha News")]
    assert alpha_gb["channels"] == ["Top News", "World News"] and alpha_gb["rank"] == 3 and alpha_gb["og_images"] is True
    assert alpha_gb["creative_instance_id"] == "cid-1"
    assert rows[("es_ES", "Alpha News")]["creative_instance_id"] == ""  # 'Creative ID' header is ignored (T1)
    assert alpha_gb["favicon_url"] == "https://icons.example.com/alpha.png"
    g = b.global_sources.collect()
    assert [r["publisher_name"] for r in g] == ["Alpha News", "Beta Daily & Co"]
    alpha = g[0]
    assert [(x["locale"], x["rank"]) for x in alpha["locales"]] == [("en_GB", 3), ("es_ES", 1)]
    assert b.domains.count() == 2

    t = load_store(b)
    assert t["locale"].count() == 2 and t["feed"].count() == 2
    assert sorted(r["name"] for r in ST.channel_names(t).collect()) == ["Deportes", "Top News", "World News"]
    f = {(r["locale"], r["feed_url"]): r["channels"] for r in ST.feeds_by_locale(t).collect()}
    assert f[("es_ES", "https://www.alpha.example.com/rss")] == ["Deportes"]
    assert f[("en_GB", "https://www.beta.example.com/rss")] == []
    # re-loading the same sources changes nothing (idempotent insert-or-get)
    again = load_store(b, existing=t)
    for k in t:
        assert again[k].count() == t[k].count(), k


def test_json_map_missing_is_empty(spark):
    df = read_json_map(spark, "/nonexistent/x.json", read_favicons.__globals__["T"].StringType())
    assert df.count() == 0 and df.columns == ["key", "value"]


def test_upsert_idempotent(spark):
    feed = spark.createDataFrame([(1, "u", "pid")], "id long, url string, url_hash string")
    inc = spark.createDataFrame(
        [("k1", "t1", None, "https://i/1.jpg", "https://i/1.jpg", "c", "d", "article", "", "https://a/1", "h1", 1.0, 0.0, "pid", 1),
         ("k2", "t2", None, "", "", "c", "d", "article", "", "https://a/2", "h2", 2.0, 0.0, "pid", 2)],
        "article_key string, title string, publish_time timestamp, img string, padded_img string, category string, "
        "description string, content_type string, creative_instance_id string, url string, url_hash string, "
        "pop_score double, score double, publisher_id string, ord long")
    import datetime as dt
    a1 = ST.upsert_articles(None, inc, feed, dt.datetime(2024, 1, 1))
    a2 = ST.upsert_articles(a1, inc.withColumn("img", F.lit("")).withColumn("pop_score", F.lit(9.0)), feed,
                            dt.datetime(2024, 1, 2))
    got = {r["article_key"]: (r["img"], r["pop_score"], str(r["created"]), str(r["modified"])) for r in a2.collect()}
    assert got["k1"] == ("https://i/1.jpg", 9.0, "2024-01-01 00:00:00", "2024-01-02 00:00:00")
    assert a2.count() == 2
    c1 = ST.insert_cache_records(None, spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "article_id long, locale_id long"))
    c2 = ST.insert_cache_records(c1, spark.createDataFrame([(1, 1), (3, 1)], "article_id long, locale_id long"))
    assert c2.count() == 3
    c3 = ST.increment_cache_hits(c2, spark.createDataFrame([(1, 1), (1, 1), (9, 9)], "article_id long, locale_id long"))
    assert {(r[0], r[2]) for r in c3.collect()} == {(1, 2), (2, 0), (3, 0)}


def test_qry3_qry4_records_and_reruns(spark):
    import datetime as dt

    tmp = _fixture()
    raw = read_source_csvs(spark, os.path.join(tmp, "sources.*_*.csv"))
    b = build_sources(raw, read_favicons(spark, os.path.join(tmp, "favicons.json")),
                      read_covers(spark, os.path.join(tmp, "nope.json")))
    t = load_store(b)
    alpha_pid = hashlib.sha256(b"https://www.alpha.example.com/rss").hexdigest()
    inc = spark.createDataFrame(
        [("k1", "t1", None, "https://i/1.jpg", "https://i/1.jpg", "c", "d", "article", "", "https://a/1", "h1", 1.0, 0.0, alpha_pid, 1),
         ("k2", "t2", None, "", "", "c", "d", "article", "", "https://a/2", "h2", 2.0, 0.0, alpha_pid, 2)],
        "article_key string, title string, publish_time timestamp, img string, padded_img string, category string, "
        "description string, content_type string, creative_instance_id string, url string, url_hash string, "
        "pop_score double, score double, publisher_id string, ord long")
    when = dt.datetime(2024, 1, 1)
    art = ST.upsert_articles(None, inc, t["feed"], when)
    # re-running the same upsert at the same time changes nothing
    again = ST.upsert_articles(art, inc, t["feed"], when)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, art.collect()))
    keys = spark.createDataFrame([("k1",), ("k2",), ("k9",)], "article_key string")
    q3 = {r["article_key"]: r for r in ST.stored_articles(art, keys, t, "es_ES").collect()}
    assert set(q3) == {"k1"}  # k2 has no image (FLT16), k9 is unknown
    assert q3["k1"]["publisher_name"] == "Alpha News" and q3["k1"]["channels"] == ["Deportes"]
    assert q3["k1"]["publisher_id"] == alpha_pid
    q4 = {r["article_key"]: r["channels"] for r in ST.remaining_with_channels(art, keys.limit(1), t).collect()}
    assert q4 == {"k2": ["Deportes", "Top News", "World News"]}
    # cache records: inserting the same keys twice changes nothing
    recs = spark.createDataFrame([(1, 1), (2, 1)], "article_id long, locale_id long")
    c1 = ST.insert_cache_records(None, recs)
    assert sorted(map(tuple, ST.insert_cache_records(c1, recs).collect())) == sorted(map(tuple, c1.collect()))


def test_validation_rules(spark):
    from quillfeed.operators import publishers as P

    cols = ["Domain", "Feed", "Title", "Destination Domains", "Score", "Rank", "locale", "file", "row_no"]
    rows = [
        ("https://www.ok.example.com", "https://www.ok.example.com/rss", "Ok", " a.com ; b.com", "1.5", "2", "x", "f", 1),
        ("https://localhost", "https://localhost/rss", "NoTld", "a.com", "", "", "x", "f", 2),
        ("https://10.0.0.1", "https://10.0.0.1/rss", "Ip", "a.com", "", "", "x", "f", 3),
        ("https://www.s.example.com", "https://www.s.example.com/rss", "BadScore", "a.com", "high", "", "x", "f", 4),
        ("https://www.r.example.com", "https://www.r.example.com/rss", "BadRank", "a.com", "", "first", "x", "f", 5),
    ]
    raw = spark.createDataFrame(rows, ",".join(f"`{c}` string" if c != "row_no" else "row_no long" for c in cols))
    good, bad = P.split_valid(P.type_source_rows(raw))
    g = {r["publisher_name"]: r for r in good.collect()}
    assert set(g) == {"Ok", "Ip"}
    assert g["Ok"]["destination_domains"] == ["a.com", "b.com"] and g["Ok"]["score"] == 1.5 and g["Ok"]["rank"] == 2
    errs = {r["row_no"]: list(r["errors"]) for r in bad.collect()}
    assert set(errs) == {2, 4, 5} and any("Score" in e for e in errs[4]) and any("Rank" in e for e in errs[5])


def test_feed_map_projection(spark):
    tmp = _fixture()
    raw = read_source_csvs(spark, os.path.join(tmp, "sources.*_*.csv"))
    b = build_sources(raw, read_favicons(spark, os.path.join(tmp, "favicons.json")), read_covers(spark, os.path.join(tmp, "x.json")))
    cols = set(b.feed_map.columns)
    assert {"locale", "feed_url", "publisher_id", "channels", "max_entries", "og_images", "site_url"} <= cols
    assert "enabled" not in cols and "publisher_domain" not in cols
    assert b.feed_map.count() == 3


def test_csv_listing_through_hadoop_fs(spark):
    from quillfeed.sources.publisher_csv import _list_and_headers

    tmp = _fixture()
    local = _list_and_headers(spark, os.path.join(tmp, "sources.*_*.csv"))
    remote = _list_and_headers(spark, "file://" + os.path.join(tmp, "sources.*_*.csv"))
    assert [h for _, h in local] == [h for _, h in remote] and len(local) == 2
    assert "Creative ID" in local[1][1] and "Creative Instance ID" in local[0][1]
    df = read_source_csvs(spark, "file://" + os.path.join(tmp, "sources.*_*.csv"))
    assert df.count() == 5 and {r["locale"] for r in df.select("locale").collect()} == {"en_GB", "es_ES"}
