"""Keyed table merges, file drop with dead letters, daily windows, high-water marks."""

import datetime as dt
import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from quillfeed.operators import store
from quillfeed.plans import stream_queries
from quillfeed.sources import feeds
from quillfeed.streaming import incremental as STRM
from quillfeed.streaming import keyed_store

ARTICLE = ("article_key string, title string, publish_time timestamp, img string, padded_img string, category string, "
           "description string, content_type string, creative_instance_id string, url string, url_hash string, "
           "pop_score double, score double, publisher_id string, ord long")


def articles(spark, keys, title, img="i"):
    rows = [(k, title, dt.datetime(2024, 1, 1), img, img, "c", "d", "article", "", "u", "h", 1.0, 0.0, "p", n) for n, k in enumerate(keys)]
    return spark.createDataFrame(rows, ARTICLE)


def files(path):
    """File names under each bucket of a table."""
    out = {}
    for folder, _, names in os.walk(f"{path}/data"):
        parts = sorted(n for n in names if n.endswith(".parquet"))
        if parts:
            out[int(folder.rsplit("=", 1)[1])] = parts
    return out


@pytest.fixture()
def table(spark):
    out = STRM.shared_dir(spark, "test-table").removeprefix("file:")
    feed = spark.createDataFrame([(7, "p")], "id long, url_hash string")
    keys = [f"k{i}" for i in range(200)]
    stored = store.upsert_articles(None, articles(spark, keys, "old"), feed, dt.datetime(2024, 1, 1))
    keyed_store.create(stored, out, ["article_key"], 8)
    return out, feed


def state(spark, path):
    return sorted(map(tuple, keyed_store.read(spark, path).collect()))


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, table):
    path, feed = table
    before = files(path)
    assert len(before) == 8

    def merge(old, new):
        return store.upsert_articles(old, new, feed, dt.datetime(2024, 2, 1))

    touched = keyed_store.merge_batch(articles(spark, ["k1", "k2", "new"], "fresh", ""), path, "w", 0, merge)
    want = sorted({r[0] for r in spark.createDataFrame([("k1",), ("k2",), ("new",)], "article_key string")
                   .select(keyed_store.bucket_of(["article_key"], 8)).collect()})
    after = files(path)
    assert touched == want and 0 < len(want) <= 3
    assert {b for b in after if after[b] != before[b]} == set(want)
    rows = {r["article_key"]: r for r in keyed_store.read(spark, path).collect()}
    assert len(rows) == 201
    assert (rows["k1"]["title"], rows["k1"]["img"], rows["k3"]["title"]) == ("fresh", "i", "old")
    assert rows["new"]["created"] == dt.datetime(2024, 2, 1) and rows["k1"]["created"] == dt.datetime(2024, 1, 1)


def test_a_replayed_batch_changes_nothing(spark, table):
    path, feed = table
    batch = articles(spark, ["k1", "x"], "fresh")

    def merge(old, new):
        return store.upsert_articles(old, new, feed, dt.datetime(2024, 2, 1))

    keyed_store.merge_batch(batch, path, "w", 0, merge)
    rows, names = state(spark, path), files(path)
    assert keyed_store.merge_batch(articles(spark, ["k5"], "other"), path, "w", 0, merge) == []
    assert (state(spark, path), files(path)) == (rows, names)
    assert keyed_store.merge_batch(articles(spark, [], "none"), path, "w", 1, merge) == []
    assert state(spark, path) == rows
    # Another writer's batch 0 is another batch.
    assert len(keyed_store.merge_batch(articles(spark, ["k5"], "other"), path, "v", 0, merge)) == 1


def test_a_batch_that_broke_off_is_finished_from_its_staging(spark, table, monkeypatch):
    path, feed = table
    write = keyed_store._write

    def merge(old, new):
        return store.upsert_articles(old, new, feed, dt.datetime(2024, 2, 1))

    def lost(rows, target, dynamic=False):
        """The driver dies after the buckets to be replaced were deleted."""
        if not dynamic:
            return write(rows, target)
        for r in rows.select(keyed_store.BUCKET).distinct().collect():
            shutil.rmtree(f"{path}/data/bucket={r[0]}", ignore_errors=True)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(keyed_store, "_write", lost)
    batch = articles(spark, ["k1", "k2", "new"], "fresh")
    with pytest.raises(RuntimeError):
        keyed_store.merge_batch(batch, path, "w", 0, merge)
    monkeypatch.undo()
    assert keyed_store.read(spark, path).count() < 200
    keyed_store.merge_batch(batch, path, "w", 0, merge)
    rows = {r["article_key"]: r["title"] for r in keyed_store.read(spark, path).collect()}
    assert len(rows) == 201 and rows["k1"] == rows["new"] == "fresh" and rows["k9"] == "old"


def test_no_feed_is_broadcast(spark, table):
    """Whatever the files' size, the feeds do not go through the driver."""
    path, feed = table
    small = STRM.shared_dir(spark, "test-feeds")
    feed.write.parquet(small)
    after = store.upsert_articles(None, articles(spark, ["k1", "k2"], "new"), spark.read.parquet(small), dt.datetime(2024, 2, 1))
    assert {(r["article_key"], r["feed_id"]) for r in after.collect()} == {("k1", 7), ("k2", 7)}
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stream_starts_from_the_existing_table(spark, table):
    path, feed = table
    drop = tempfile.mkdtemp(prefix="qf-drop-") + "/d"
    stream = stream_queries.dealt_stream([articles(spark, ["k1"], "one"), articles(spark, ["k1", "y"], "two")], drop)
    STRM.upsert_batches(stream, path, feed, lambda b: dt.datetime(2024, 2, 1 + b), path + "/ckpt").awaitTermination()
    rows = {r["article_key"]: (r["title"], r["modified"].day) for r in keyed_store.read(spark, path).collect()}
    assert len(rows) == 201 and rows["k1"] == ("two", 2) and rows["k2"] == ("old", 1)


def test_a_batch_takes_a_whole_part_of_many_files(spark):
    """Full parts, one with fewer rows than files, and one without rows."""
    out = STRM.shared_dir(spark, "test-dealt").removeprefix("file:")
    parts = [spark.range(0, 1000), spark.range(1000, 1002), spark.range(0), spark.range(2000, 3000)]
    stream = stream_queries.dealt_stream(parts, out + "/drop")
    named = {k: [n for n in os.listdir(f"{out}/drop/part={k:03d}") if n.endswith(".parquet")] for k in range(4)}
    assert {len(n) for n in named.values()} == {int(spark.conf.get("spark.sql.shuffle.partitions"))} and len(named[0]) > 1
    STRM.run_to_parquet(stream, out + "/rows", out + "/ckpt")
    got = [sorted(r.id for r in spark.read.schema("id long").parquet(f"{out}/rows/batch={k}").collect()) for k in range(4)]
    assert got == [list(range(1000)), [1000, 1001], [], list(range(2000, 3000))] and not os.path.exists(out + "/rows/batch=4")
    largest = spark.read.parquet(out + "/drop/part=000").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert largest < 500  # a task writes a share of the part


RSS = ("<?xml version='1.0'?><rss version='2.0'><channel><title>t</title>{}</channel></rss>")
ITEM = "<item><title>x</title><link>https://a.example/{}</link></item>"


def test_dead_letters_name_every_bad_document(spark):
    docs = [
        ("f", 1, RSS.format(ITEM.format(1))), ("f", 2, "<rss><chan"), ("f", 3, ""), ("f", 4, None), ("f", 5, " \n\t "),
        ("f", 6, RSS.format("")), ("f", 7, RSS.format(ITEM.format(7) + "<!--" + "y" * 3000 + "-->")), ("g", 8, "<html><body>no feed</body></html>"),
        ("f", 9, RSS.format(ITEM.format(9))[:-4]), ("f", 2, "<rss><chan"),
        ("h", 10, "<feed xmlns='http://www.w3.org/2005/Atom'><title>t</title></feed>"),
    ]
    df = spark.createDataFrame(docs, "feed_url string, doc_ord long, content string")
    parsed = feeds.parse_documents(df, max_bytes=2000)
    got = sorted((r.doc_ord, r.feed_url, r.kind) for r in feeds.failures_of(parsed).collect())
    assert got == [(2, "f", "unparsable"), (2, "f", "unparsable"), (3, "f", "empty"), (4, "f", "empty"), (5, "f", "empty"),
                   (6, "f", "no_entries"), (7, "f", "oversize"), (8, "g", "unparsable"), (9, "f", "unparsable"), (10, "h", "no_entries")]
    assert [r.link for r in feeds.entries_of(parsed).collect()] == ["https://a.example/1"]
    # The listed length decides where there is one: such content was never read.
    listed = df.limit(1).withColumn("length", F.lit(5000)).withColumn("content", F.lit(None).cast("string"))
    assert [r.kind for r in feeds.failed_documents(listed, max_bytes=2000).collect()] == ["oversize"]


def test_file_drop_into_two_sinks(spark):
    drop, out = tempfile.mkdtemp(prefix="qf-drop-"), STRM.shared_dir(spark, "test-two")
    for name, text in (("good.xml", RSS.format(ITEM.format(1) + ITEM.format(2))), ("bad.xml", "<rss"), ("blank.xml", " \n")):
        with open(f"{drop}/{name}", "w") as f:
            f.write(text)
    for _ in range(2):  # the second run finds nothing new
        STRM.ingest_documents(STRM.feed_file_stream(spark, drop), out + "/e", out + "/f", out + "/c")
    assert sorted((r.feed_url, r.pos) for r in spark.read.parquet(out + "/e").collect()) == [("good.xml", 0), ("good.xml", 1)]
    assert sorted((r.feed_url, r.kind) for r in spark.read.parquet(out + "/f").collect()) == [("bad.xml", "unparsable"), ("blank.xml", "empty")]
    # The same batch once more, as after a crash: the same rows.
    STRM.ingest_documents(STRM.feed_file_stream(spark, drop), out + "/e", out + "/f", out + "/c2")
    assert spark.read.parquet(out + "/e").count() == 2 and spark.read.parquet(out + "/f").count() == 2


def test_closed_days_leave_the_state_and_stay_in_the_table(spark):
    out = STRM.shared_dir(spark, "test-days")
    days = [spark.createDataFrame([(dt.datetime(2024, 1, d, h), "v") for h in range(0, 24, 6)], "ts timestamp, event_type string") for d in range(1, 11)]
    late = spark.createDataFrame([(dt.datetime(2024, 1, 2, 1), "v")], "ts timestamp, event_type string")
    counts = STRM.daily_counts(stream_queries.dealt_stream([*days, late], out + "/drop"), "ts", ["event_type"])
    counts = counts.select(F.col("window.start").alias("day"), "event_type", "n")
    query = STRM.update_keyed(counts, out + "/table", ["day", "event_type"], out + "/ckpt", buckets=4)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 4 < 10  # ten days went through; a day and the delay stay
    got = {r.day.day: r.n for r in keyed_store.read(spark, out + "/table").collect()}
    assert got == {d: 4 for d in range(1, 11)}  # the event that came nine days late is dropped


def test_high_water_ignores_older_builds_in_any_order(spark):
    out = STRM.shared_dir(spark, "test-water")
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    batches = [[(1, at(5), at(9)), (2, at(1), at(9))], [(1, at(4), at(10)), (1, at(5), at(10))], [(1, at(6), at(8)), (3, None, at(8))]]
    parts = [spark.createDataFrame(b, "feed_id long, last_build_time timestamp, run_at timestamp") for b in batches]
    marks = STRM.feed_high_water_stream(stream_queries.dealt_stream(parts, out + "/drop"), run="run_at")
    STRM.update_keyed(marks.where("last_build_time is not null"), out + "/table", ["feed_id"], out + "/ckpt", buckets=2)
    got = {r.feed_id: (r.last_build_time, r.last_build_timedelta) for r in keyed_store.read(spark, out + "/table").collect()}
    assert got == {1: (at(6), 2 * 86400.0), 2: (at(1), 8 * 86400.0)}
