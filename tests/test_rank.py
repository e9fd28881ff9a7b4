"""SRT2 / WIN1 / WIN2 / AGG3 against plain-Python restatements."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from quillfeed.operators import rank
from quillfeed.operators.windows import group_row_number

AS_OF = dt.datetime(2024, 2, 1)


def _python_rank(rows):
    """The reference's list semantics: stable sort newest first, dict dedup,
    running variety per publisher, recency * variety."""
    srt = sorted(rows, key=lambda r: r["publish_time"], reverse=True)
    d = {}
    for r in srt:
        d[r["url_hash"]] = r  # position of the first, content of the last
    out, variety = [], {}
    for r in d.values():
        v = variety.get(r["publisher_id"], 1.0) * 2.0
        variety[r["publisher_id"]] = v
        secs = (AS_OF - r["publish_time"]).total_seconds()
        rec = math.log(secs) if secs > 0 else 0.1
        out.append((r["url_hash"], r["ord"], round(rec * v, 6)))
    return out


def _rows(seed, n=300):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        rows.append({
            "url_hash": f"h{rnd.randint(0, 60)}",
            "publisher_id": f"p{rnd.randint(0, 5)}",
            # coarse times so ties on publish_time really happen
            "publish_time": base + dt.timedelta(hours=rnd.randint(0, 40)),
            "ord": i,
        })
    return rows


def test_rank_matches_python(spark):
    for seed in (1, 2, 3):
        rows = _rows(seed)
        df = spark.createDataFrame(rows, "url_hash string, publisher_id string, publish_time timestamp, ord long")
        for strategy in ("range", "window"):
            got = rank.rank_articles(df, as_of=AS_OF, strategy=strategy).select(
                "url_hash", "ord", F.round("score", 6).alias("score")
            ).collect()
            assert [tuple(r) for r in got] == _python_rank(rows), (seed, strategy)


def test_dedup_keys_unique_and_counts(spark):
    rows = _rows(7)
    df = spark.createDataFrame(rows, "url_hash string, publisher_id string, publish_time timestamp, ord long")
    d = rank.dedup_by_url_hash(df)
    assert d.count() == d.select("url_hash").distinct().count()
    assert d.agg(F.sum("n_copies")).first()[0] == len(rows)


def test_group_row_number_hot_key(spark):
    # one key holds most rows: the range strategy splits it across partitions
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 13).cast("string")).alias("k"),
        F.col("id").alias("o"),
    )
    a = group_row_number(df, ["k"], [F.col("o").desc()], strategy="range", num_partitions=8)
    b = group_row_number(df, ["k"], [F.col("o").desc()], strategy="window")
    assert sorted(a.collect()) == sorted(b.collect())


def test_normalize_popularity_bounds(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 5, 10, 400, 1000]], "pop_score double")
    out = [r[0] for r in rank.normalize_popularity(df).collect()]
    assert min(out) >= 1.0 and max(out) <= 100.0
    assert out[-1] == 100.0 and out[0] == 1.0
    same = spark.createDataFrame([(3.0,), (3.0,)], "pop_score double")
    assert [r[0] for r in rank.normalize_popularity(same).collect()] == [1.0, 1.0]


def test_rank_with_locales_and_hot_publisher(spark):
    # a third of the articles belong to one publisher, in two locales
    base = spark.range(0, 3000).select(
        F.sha2((F.col("id") % 1000).cast("string"), 256).alias("url_hash"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 17).cast("string")).alias("publisher_id"),
        (F.lit(1704067200) + F.col("id") * 37 % 86400).cast("timestamp").alias("publish_time"),
        F.col("id").alias("ord"),
    )
    two = base.withColumn("locale", F.lit("en_US")).unionByName(base.withColumn("locale", F.lit("de_DE")))
    a = rank.rank_articles(two, as_of=AS_OF, strategy="range", group_cols=("locale",), sort=False)
    b = rank.rank_articles(two, as_of=AS_OF, strategy="window", group_cols=("locale",), sort=False)
    cols = ["locale", "url_hash", "variety_rank", "pos_ord"]
    assert sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))
    assert a.select("locale", "url_hash").distinct().count() == a.count() == 2000
