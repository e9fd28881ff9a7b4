"""Registered queries of files that the library writes and reads back: source CSVs with
differing headers, lookups, ordered feeds behind a pointer, sorted lists; and of the
store's external classes and cache counters (SRC1-3, SRC6, JOI2, SNK1-3, SNK7, SNK10,
SRT1, SRT3, QRY5, JOI13, SET8-10, PRJ32)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.operators import rank
from quillfeed.operators import store as ST
from quillfeed.plans import standins as S
from quillfeed.plans.registry import register
from quillfeed.plans.sources_build import build_sources
from quillfeed.session import ensure_checkpoint_dir
from quillfeed.sinks import writers
from quillfeed.sources import lookups, publisher_csv
from quillfeed.sources.tables import read_table
from quillfeed.streaming.incremental import shared_dir

# --- SRC1-3, SRC6, JOI2, SNK7: source files with three headers ----------------------------------
# The headers of a nation's file by its number: the second calls a column by a name that is not read, the third has
# other columns and another order.
HEADERS = (
    ("Domain", "Feed", "Title", "Category", "Status", "Score", "OG-Images", "Content Type", "Creative Instance ID", "Destination Domains",
     "Channels", "Rank", "Original_Feed"),
    ("Domain", "Feed", "Title", "Category", "Status", "Score", "OG-Images", "Content Type", "Creative ID", "Destination Domains", "Channels",
     "Rank", "Original_Feed"),
    ("Title", "Feed", "Domain", "Rank", "Channels", "Destination Domains", "Status", "Category"),
)


def write_source_files(spark: SparkSession, base: str, out: str) -> str:
    """``sources.<nation>.csv`` of every nation's customers; returns their pattern."""
    rows = S.customer_source_rows(spark, base)
    key = F.col("row_no")
    rows = rows.withColumns({
        "Creative Instance ID": F.concat(F.lit("c-"), key.cast("string")), "Creative ID": F.lit("unread"),
        "Title": F.concat(F.lit(' Shop "'), key.cast("string"), F.lit('", <b>&amp;</b> more ')), "Score": F.lit("2.5"), "OG-Images": F.lit("On"),
        "Channels": F.concat(F.lit(" "), "Channels", F.lit("; Top News")), "Rank": F.when(key % 2 == 0, key.cast("string")).otherwise(""),
        "_variant": F.regexp_extract("locale", r"(\d+)$", 1).cast("int") % len(HEADERS)})
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k, header in enumerate(HEADERS):
        part = rows.where(F.col("_variant") == k).repartition("locale").sortWithinPartitions("locale", "row_no")
        part.select(F.col("locale").alias("file"), *[F.col(f"`{h}`") for h in header]).write.partitionBy("file").option("header", True).option(
            "escape", '"').csv(f"{out}/variant={k}")
        # A published file has its own name: the one part of each nation is renamed.
        root = jvm.org.apache.hadoop.fs.Path(f"{out}/variant={k}")
        fs = root.getFileSystem(conf)
        for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{out}/variant={k}/file=*/part-*.csv")) or []:
            name = st.getPath().getParent().getName().removeprefix("file=")
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(f"{out}/sources.{name}.csv"))
    uri = str(jvm.org.apache.hadoop.fs.Path(out).getFileSystem(conf).getFileStatus(jvm.org.apache.hadoop.fs.Path(out)).getPath().toString())
    return f"{uri}/sources.*.csv"


CSV_SOURCES_SQL = f"""
SELECT n_name AS locale, 'Shop "' || CAST(c_custkey AS VARCHAR) || '", <b>&</b> more' AS publisher_name,
       'https://shop' || CAST(c_custkey AS VARCHAR) || '.example.com/rss' AS feed_url,
       CASE n_nationkey % 3 WHEN 0 THEN 'c-' || CAST(c_custkey AS VARCHAR) ELSE '' END AS creative_instance_id,
       CAST(CASE n_nationkey % 3 WHEN 2 THEN 0.0 ELSE 2.5 END AS DOUBLE) AS score, n_nationkey % 3 <> 2 AS og_images,
       CASE WHEN c_custkey % 2 = 0 THEN CAST(c_custkey AS INTEGER) END AS rank, c_mktsegment || '|Top News' AS channels,
       CASE WHEN c_custkey % 3 = 0 THEN 'https://f.example.com/' || CAST(c_custkey AS VARCHAR) || '.ico' END AS favicon_url,
       CASE WHEN c_custkey % 4 = 0 THEN 'https://c.example.com/' || CAST(c_custkey AS VARCHAR) || '.png' END AS cover_url,
       CASE WHEN c_custkey % 4 = 0 THEN '#0a0b0c' END AS background_color
FROM customer JOIN nation ON CAST(c_nationkey AS INTEGER) = CAST(n_nationkey AS INTEGER)"""


@register("csv_sources", CSV_SOURCES_SQL)
def csv_sources(spark: SparkSession, base: str) -> DataFrame:
    """Source files with three headers read by header, locale from the file name,
    typed, checked and joined with favicon and cover lookups that were written and
    read as files."""
    ensure_checkpoint_dir(spark)
    out = shared_dir(spark, "sources")
    pattern = write_source_files(spark, base, f"{out}/csv")
    c = read_table(spark, base, "customer").select(F.col("c_custkey").alias("k"))
    domain, name = F.concat(F.lit("https://www.shop"), F.col("k").cast("string"), F.lit(".example.com")).alias("domain"), F.col("k").cast("string")
    writers.write_sorted_json(c.where("k % 3 = 0").select(domain, F.concat(F.lit("https://f.example.com/"), name, F.lit(".ico")).alias("favicon_url")),
                              f"{out}/favicons", ["domain"])
    writers.write_sorted_json(c.where("k % 4 = 0").select(domain, F.concat(F.lit("https://c.example.com/"), name, F.lit(".png")).alias("cover_url"),
                                                          F.lit("#0a0b0c").alias("background_color")), f"{out}/covers", ["domain"])
    b = build_sources(publisher_csv.read_source_csvs(spark, pattern), lookups.read_favicons(spark, f"{out}/favicons"),
                      lookups.read_covers(spark, f"{out}/covers"))
    return b.rows.select("locale", "publisher_name", "feed_url", "creative_instance_id", "score", "og_images", "rank",
                         F.array_join("channels", "|").alias("channels"), "favicon_url", "cover_url", "background_color")


# --- SNK1, SNK2, SNK10, SRT1: ordered feeds behind a pointer -----------------------------------------
FEED_LINES_SQL = f"""
WITH a AS ({S.ARTICLES_SQL}),
d AS (SELECT *, sha256(url) AS url_hash, ['en_US', 'de_DE', 'fr_FR'][CAST(publisher_id AS BIGINT) % 3 + 1] AS locale FROM a),
g AS (SELECT locale, url_hash, max(publish_time) AS pos_ts, arg_max(ord, (publish_time, -ord)) AS pos_ord FROM d GROUP BY locale, url_hash)
SELECT locale, row_number() OVER (PARTITION BY locale ORDER BY pos_ts DESC, pos_ord) - 1 AS line, url_hash FROM g"""


@register("feed_lines", FEED_LINES_SQL)
def feed_lines(spark: SparkSession, base: str) -> DataFrame:
    """Every locale's feed published as a snapshot, after one that holds only old
    articles; read back through the pointer with the number of each line."""
    from quillfeed.functions.urls import url_hash

    locales = F.array(*[F.lit(x) for x in ("en_US", "de_DE", "fr_FR")])
    a = S.articles(spark, base).withColumn("url_hash", url_hash(F.col("url"))).withColumn(
        "locale", F.element_at(locales, (F.col("publisher_id").cast("long") % 3 + 1).cast("int")))
    ranked = rank.rank_articles(a, as_of=config.AS_OF, group_cols=("locale",), sort=False)
    out = shared_dir(spark, "published")
    writers.publish_locale_feeds(ranked.where(F.col("pos_ts") < F.lit("2024-01-20").cast("timestamp_ntz")), out, "one")
    writers.publish_locale_feeds(ranked, out, "two")
    current = spark.read.text(f"{out}/_CURRENT").first()[0]
    lines = writers.read_lines(spark, current)
    return lines.select("locale", "line", F.get_json_object("value", "$.url_hash").alias("url_hash"))


# --- SNK3, SRT3: a sorted list ---------------------------------------------------------------------
SORTED_SOURCES_SQL = """
SELECT row_number() OVER (ORDER BY 'Shop ' || CAST(c_custkey AS VARCHAR)) - 1 AS line, 'Shop ' || CAST(c_custkey AS VARCHAR) AS publisher_name
FROM customer JOIN nation ON CAST(c_nationkey AS INTEGER) = CAST(n_nationkey AS INTEGER)"""


@register("sorted_sources", SORTED_SOURCES_SQL)
def sorted_sources(spark: SparkSession, base: str) -> DataFrame:
    """Publishers written sorted by name (a range sort over many files) and read back
    with the number of each line."""
    rows = S.customer_source_rows(spark, base).select(F.col("Title").alias("publisher_name"), F.col("Feed").alias("feed_url"))
    out = f"{shared_dir(spark, 'list')}/sources"
    writers.write_sorted_json(rows, out, ["publisher_name"])
    return writers.read_lines(spark, out).select("line", F.get_json_object("value", "$.publisher_name").alias("publisher_name"))


# --- QRY5, JOI13, SET10, PRJ32: external classes ------------------------------------------------------
EXTERNAL_SQL = """
WITH c AS (
  SELECT l_orderkey, list_sort(list(DISTINCT p_type)) AS channels,
         '[' || string_agg('{"' || p_name || '":' || CAST(l_quantity / 50.0 AS VARCHAR) || '}', ',' ORDER BY l_linenumber, l_partkey, l_quantity) || ']' AS raw
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 3 <> 0 GROUP BY l_orderkey)
SELECT o_orderkey AS id, CASE WHEN c.raw IS NULL THEN NULL ELSE array_to_string(c.channels, '|') END AS external_channels, c.raw AS raw_data
FROM orders LEFT JOIN c ON c.l_orderkey = o_orderkey"""


@register("article_classes", EXTERNAL_SQL)
def article_classes(spark: SparkSession, base: str) -> DataFrame:
    """Classes of two thirds of the articles, and of keys that no article has, are
    inserted, then others for the same articles, which change nothing; every article
    comes back with its classes, or NULL."""
    articles = read_table(spark, base, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("article_key"), F.col("o_orderstatus").alias("title"))
    li, part = read_table(spark, base, "lineitem"), read_table(spark, base, "part")
    j = li.where("l_orderkey % 3 <> 0").join(part, li.l_partkey == part.p_partkey)
    one = F.struct("l_linenumber", "l_partkey", "l_quantity", F.col("p_name").alias("name"), (F.col("l_quantity") / 50.0).alias("confidence"))
    found = j.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_type")).alias("channels"), F.array_sort(F.collect_list(one)).alias("p"))
    predictions = F.transform("p", lambda x: F.struct(x["name"].alias("name"), x["confidence"].alias("confidence"))).alias("predictions")
    key = F.concat(F.lit("k"), F.col("l_orderkey").cast("string"))
    incoming = found.select(key.alias("article_key"), "channels", predictions)
    stray = found.select(F.concat(F.lit("gone-"), key).alias("article_key"), "channels", predictions)
    classes = ST.insert_external_classes(None, incoming.unionByName(stray), articles)
    classes = ST.insert_external_classes(classes, incoming.withColumn("channels", F.array(F.lit("other"))), articles)
    out = ST.article_with_external(articles, classes)
    return out.select("id", F.array_join("external_channels", "|").alias("external_channels"), "raw_data")


# --- SET8, SET9: cache counters -----------------------------------------------------------------------
CACHE_HITS_SQL = """
WITH n AS (SELECT l_orderkey, count(*) AS hits FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT o_orderkey AS article_id, CAST(c_nationkey AS BIGINT) AS locale_id, CAST(coalesce(n.hits, 0) AS INTEGER) AS cache_hit
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN n ON n.l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'"""


@register("cache_hits", CACHE_HITS_SQL)
def cache_hits(spark: SparkSession, base: str) -> DataFrame:
    """One cache record per published article and locale, inserted twice, then raised
    by the lookups of each; lookups without a record count for nothing."""
    o, c = read_table(spark, base, "orders"), read_table(spark, base, "customer")
    both = o.join(c, o.o_custkey == c.c_custkey).select(F.col("o_orderkey").alias("article_id"), F.col("c_nationkey").cast("long").alias("locale_id"), "o_orderstatus")
    keys = both.where("o_orderstatus <> 'P'")
    cache = ST.insert_cache_records(ST.insert_cache_records(None, keys), keys)
    hits = read_table(spark, base, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("article_id")).join(
        both.select("article_id", "locale_id"), "article_id")
    return ST.increment_cache_hits(cache, hits)
