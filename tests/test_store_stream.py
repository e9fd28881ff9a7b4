"""Sinks, streaming forms, report files, freshness and the external-class store."""

import datetime as dt
import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from quillfeed.operators import enrich, quality, store
from quillfeed.sinks.writers import json_safe, publish_snapshot, read_current, write_sorted_json
from quillfeed.sources.lookups import read_report
from quillfeed.streaming import incremental as STRM
from quillfeed.streaming import keyed_store

HERE = os.path.dirname(os.path.abspath(__file__))


def test_json_sink_nulls_infinity(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, 3.5)], "id int, score double") \
        .withColumn("ts", F.lit("2024-01-30 12:30:00").cast("timestamp"))
    out = tempfile.mkdtemp(prefix="qf-json-") + "/o"
    write_sorted_json(df, out, ["id"])
    lines = []
    for f in sorted(os.listdir(out)):
        if f.endswith(".json"):
            with open(os.path.join(out, f)) as fh:
                lines.extend(json.loads(x) for x in fh)
    assert lines == [{"id": 1, "ts": "2024-01-30 12:30:00"}, {"id": 2, "score": 3.5, "ts": "2024-01-30 12:30:00"}]
    assert json_safe(df).schema["ts"].dataType.simpleString() == "string"


def test_snapshot_publish(spark):
    base = tempfile.mkdtemp(prefix="qf-snap-")
    a = publish_snapshot(spark.range(3), base, stamp="one")
    b = publish_snapshot(spark.range(5), base, stamp="two")
    assert a != b and read_current(spark, base).count() == 5
    assert spark.read.parquet(a).count() == 3  # the previous snapshot stays readable


def test_report_file_and_check(spark):
    path = tempfile.mkdtemp(prefix="qf-rep-") + "/report.json"
    with open(path, "w") as f:
        json.dump({"feed_stats": {"https://a/rss": {"size_after_get": 10, "size_after_insert": 10},
                                  "https://b/rss": {"size_after_get": 0, "size_after_insert": 0},
                                  "https://c/rss": {"size_after_get": 2, "size_after_insert": 3}}}, f)
    rep = read_report(spark, path)
    v = {(r["feed"], r["violation"]) for r in quality.report_violations(rep, key="feed").collect()}
    assert v == {("https://b/rss", "no posts downloaded"), ("https://b/rss", "no posts inserted"),
                 ("https://c/rss", "inserted more than downloaded")}
    assert not quality.report_passes(rep.withColumnRenamed("feed", "feed_url"))


def test_freshness_from_files(spark):
    d = tempfile.mkdtemp(prefix="qf-fresh-")
    for name in ("feed.json", "feed.en_GB.json"):
        open(os.path.join(d, name), "w").write("[]")
    old = time.time() - 5 * 3600
    os.utime(os.path.join(d, "feed.en_GB.json"), (old, old))
    files = quality.file_freshness(spark, [d]).withColumn("file", F.regexp_extract("file", r"([^/]+)$", 1))
    expected = spark.createDataFrame([("feed.json",), ("feed.en_GB.json",), ("feed.de_DE.json",)], "file string")
    now = dt.datetime.utcnow()
    got = {r["file"]: (r["expired"], r["status"]) for r in quality.freshness_status(files, expected, now).collect()}
    assert got["feed.json"][0] is False and got["feed.en_GB.json"][0] is True
    assert got["feed.de_DE.json"][0] is True  # missing -> 24 h old
    assert {s for _, s in got.values()} == {"expired"}  # 1 fresh of 3 < floor(0.8 * 3)


def test_external_classes_and_qry5(spark):
    art = spark.createDataFrame([(1, "k1", "T one"), (2, "k2", "T two")], "id long, article_key string, title string")
    inc = spark.createDataFrame(
        [("k1", ["Sports"], [("/Sports", 0.9), ("/News", 0.3)]), ("k9", ["X"], [("/X", 0.5)])],
        "article_key string, channels array<string>, predictions array<struct<name:string,confidence:double>>")
    ext = store.insert_external_classes(None, inc, art)
    rows = ext.collect()
    assert len(rows) == 1 and rows[0]["article_id"] == 1
    assert json.loads(rows[0]["raw_data"]) == [{"/Sports": 0.9}, {"/News": 0.3}]
    again = store.insert_external_classes(ext, inc, art)
    assert again.count() == 1
    q5 = {r["id"]: r["external_channels"] for r in store.article_with_external(art, ext).collect()}
    assert q5 == {1: ["Sports"], 2: None}  # T12: no classification -> NULL, not a failure


def test_qry7_external_channels(spark):
    a = spark.createDataFrame(
        [("k1", "A long enough title here", "", ["Top News", "Politics"]), ("k2", "Short", "", ["Top News"]),
         ("k3", "Another long title text", "", ["Fun"])],
        "article_key string, title string, description string, channels array<string>")
    ext = spark.createDataFrame([("k1", ["Sports"]), ("k2", ["Sports"]), ("k3", ["Sports"])],
                                "article_key string, ext_channels array<string>")
    got = {r["article_key"]: r["ext_channels"] for r in enrich.external_channels(a, ext).collect()}
    assert got == {"k1": ["Sports", "Top News"], "k2": [], "k3": []}


def test_streaming_upsert_and_high_water(spark):
    src = tempfile.mkdtemp(prefix="qf-src-")
    schema = ("article_key string, title string, publish_time timestamp, img string, padded_img string, "
              "category string, description string, content_type string, creative_instance_id string, url string, "
              "url_hash string, pop_score double, score double, publisher_id string, ord long")
    rows = [("k1", "t", dt.datetime(2024, 1, 1), "i1", "i1", "c", "d", "article", "", "u1", "h1", 1.0, 0.0, "p", 1)]
    spark.createDataFrame(rows, schema).write.parquet(src + "/b0")
    feed = spark.createDataFrame([(7, "p")], "id long, url_hash string")
    stream = spark.readStream.schema(spark.read.parquet(src + "/b0").schema).parquet(src + "/*")
    out = STRM.shared_dir(spark, "test-upsert")
    q = STRM.upsert_batches(stream, out + "/table", feed, dt.datetime(2024, 2, 1), out + "/ckpt")
    q.awaitTermination()
    rows2 = [("k1", "t", dt.datetime(2024, 1, 2), "", "", "c", "d2", "article", "", "u1", "h1", 5.0, 0.0, "p", 2),
             ("k2", "t2", dt.datetime(2024, 1, 3), "i2", "i2", "c", "d", "article", "", "u2", "h2", 2.0, 0.0, "p", 3)]
    spark.createDataFrame(rows2, schema).write.parquet(src + "/b1")
    q = STRM.upsert_batches(stream, out + "/table", feed, dt.datetime(2024, 2, 2), out + "/ckpt")
    q.awaitTermination()
    t = keyed_store.read(spark, out + "/table")
    got = {r["article_key"]: (r["img"], r["description"], r["pop_score"], r["feed_id"]) for r in t.collect()}
    assert got == {"k1": ("i1", "d2", 5.0, 7), "k2": ("i2", "d", 2.0, 7)}

    os.makedirs(src + "/hw")
    builds = spark.readStream.schema("feed_id long, last_build_time timestamp").parquet(src + "/hw")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (1, dt.datetime(2024, 1, 3)), (2, dt.datetime(2024, 1, 2))],
                          "feed_id long, last_build_time timestamp").write.mode("append").parquet(src + "/hw")
    hw_dir = STRM.shared_dir(spark, "test-hw")
    hw = STRM.feed_high_water_stream(builds)
    STRM.run_to_parquet(hw, hw_dir + "/data", hw_dir + "/ckpt", mode="update", keys=["feed_id"])
    r = {x["feed_id"]: x["last_build_time"] for x in STRM.read_result(spark, hw_dir + "/data", "update").collect()}
    assert r == {1: dt.datetime(2024, 1, 3), 2: dt.datetime(2024, 1, 2)}
    # a second run only sees feed 1 move; feed 2 must survive the merge
    spark.createDataFrame([(1, dt.datetime(2024, 1, 5)), (1, dt.datetime(2024, 1, 4))],
                          "feed_id long, last_build_time timestamp").write.mode("append").parquet(src + "/hw")
    STRM.run_to_parquet(hw, hw_dir + "/data", hw_dir + "/ckpt", mode="update", keys=["feed_id"])
    r = {x["feed_id"]: x["last_build_time"] for x in STRM.read_result(spark, hw_dir + "/data", "update").collect()}
    assert r == {1: dt.datetime(2024, 1, 5), 2: dt.datetime(2024, 1, 2)}


def test_feed_file_stream(spark):
    d = tempfile.mkdtemp(prefix="qf-drop-")
    with open(os.path.join(HERE, "data", "sample.rss")) as fh:
        rss = fh.read()
    for name, body in (("harbor.xml", rss), ("broken.xml", "<rss><chan")):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    entries = STRM.stream_entries(STRM.feed_file_stream(spark, d))
    out = STRM.shared_dir(spark, "test-drop")
    STRM.run_to_parquet(entries.select("feed_url", "pos", "title"), out + "/data", out + "/ckpt")
    got = sorted((r["feed_url"], r["pos"]) for r in STRM.read_result(spark, out + "/data", "append").collect())
    assert got == [("harbor.xml", i) for i in range(5)]
