"""Physical plan checks: broadcasts where the side is bounded, no single-partition windows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF
from quillfeed.plans import catalog
from quillfeed.plans import standins as S
from quillfeed.plans.feed_build import build_from_entries


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_single_partition_window(spark):
    p = _plan(catalog.feed_rank(spark, SF))
    assert "SinglePartition" not in p  # no window/sort funnelled into one task
    assert "rangepartitioning" in p  # global order and per-publisher numbering by range


def test_popularity_bounds_are_scalar_subqueries(spark):
    p = _plan(catalog.popularity_norm(spark, SF))
    assert "Window" not in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "Subquery" in p


def test_publisher_join_is_broadcast(spark):
    b = build_from_entries(S.feed_entries(spark, SF), S.feed_publishers(spark, SF), as_of=dt.datetime(2024, 1, 20))
    p = b.report._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scans_are_pruned(spark):
    # the source-list queries group documents by (source, lang): the large text
    # column must never be read
    p = _plan(catalog.global_sources(spark, SF))
    scans = [line for line in p.split("\n") if "Scan parquet" in line or "FileScan" in line]
    assert scans and all("text#" not in line for line in scans)


def test_bucketed_store_tables_join_without_shuffle(spark):
    from quillfeed.sinks.writers import save_bucketed

    a = spark.range(0, 2000).select(F.sha2(F.col("id").cast("string"), 256).alias("article_key"), F.col("id").alias("v"))
    import uuid

    tag = uuid.uuid4().hex[:8]  # the in-memory catalog forgets tables between sessions; their folders stay
    old = save_bucketed(a, f"qf_test_articles_a_{tag}", ["article_key"], 8)
    new = save_bucketed(a.where(F.col("v") % 2 == 0), f"qf_test_articles_b_{tag}", ["article_key"], 8)
    j = old.join(new.withColumnRenamed("v", "w"), "article_key", "full_outer")
    assert j.count() == 2000
    assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()


def test_scale_settings():
    from quillfeed.session import scale_settings

    small = scale_settings(10 << 20)
    big = scale_settings(100 << 40)  # 100 TB
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert scale_settings(1 << 40)["spark.sql.shuffle.partitions"] == "4096"  # 1 TB / 256 MB
