"""Driver tables re-shaped into the engine's input schemas.

Each builder only renames/reshapes driver columns into the schema a job
expects (SURVEY section 7.3); it does none of the job's work. Next to each
builder is the same reshaping as a DuckDB/ANSI SQL CTE body, used by the
oracle queries so both sides start from identical input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed.sources.tables import read_table


# --- articles: one event = one fetched article copy -------------------------
# url key = (user_id, event_type); publisher = user_id; publish time = ts;
# input ordinal = event_id.
def articles(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    return e.select(
        F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/news/"), F.col("event_type")).alias("url"),
        F.concat(F.col("event_type"), F.lit(" update "), F.col("event_id").cast("string")).alias("title"),
        F.col("ts").alias("publish_time"),
        F.col("user_id").cast("string").alias("publisher_id"),
        F.col("props").alias("description"),
        F.col("event_id").alias("ord"),
    )


ARTICLES_SQL = """
SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/news/' || event_type AS url,
       event_type || ' update ' || CAST(event_id AS VARCHAR) AS title,
       ts AS publish_time,
       CAST(user_id AS VARCHAR) AS publisher_id,
       props AS description,
       event_id AS ord
FROM events"""


# --- popularity counters: (url, source, score) --------------------------------
def popularity_counters(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    return e.select(
        F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/news/"), F.col("event_type")).alias("url"),
        F.col("event_id").cast("string").alias("source"),
        F.col("value").alias("score"),
    )


POPULARITY_SQL = """
SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/news/' || event_type AS url,
       CAST(event_id AS VARCHAR) AS source,
       value AS score
FROM events"""


# --- predictions: one article per (user, day), one candidate per event -----
def prediction_candidates(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    return e.select(
        F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/day/"),
                 F.date_format("ts", "yyyy-MM-dd")).alias("url"),
        F.col("event_id").alias("ord"),
        F.col("event_type").alias("name"),
        (F.lit(1.0) - F.exp(-F.col("value") / F.lit(50.0))).alias("confidence"),
    )


PREDICTIONS_SQL = """
SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/day/' || strftime(ts, '%Y-%m-%d') AS url,
       event_id AS ord,
       event_type AS name,
       1.0 - exp(-value / 50.0) AS confidence
FROM events"""


# Channels of the article's publisher: a fixed channel vocabulary indexed by user id.
CHANNEL_VOCAB = ("Fun", "Top News", "Sports", "World News", "Business", "Top Sources", "Technology")


def prediction_articles(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    vocab = F.array(*[F.lit(c) for c in CHANNEL_VOCAB])
    n = len(CHANNEL_VOCAB)
    day = F.date_format("ts", "yyyy-MM-dd")
    per_day = e.groupBy("user_id", day.alias("day")).agg(F.min("event_id").alias("first_event"))
    return per_day.select(
        F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/day/"), F.col("day")).alias("url"),
        F.concat(F.lit("Daily digest "), F.col("day")).alias("title"),
        F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("notes "), F.col("first_event").cast("string"))).alias("description"),
        F.array(
            F.element_at(vocab, (F.col("user_id") % n + 1).cast("int")),
            F.element_at(vocab, ((F.col("user_id") + 3) % n + 1).cast("int")),
        ).alias("channels"),
    )


PRED_ARTICLES_SQL = """
SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/day/' || day AS url,
       'Daily digest ' || day AS title,
       CASE WHEN user_id % 3 = 0 THEN '' ELSE 'notes ' || CAST(first_event AS VARCHAR) END AS description,
       [['Fun','Top News','Sports','World News','Business','Top Sources','Technology'][CAST(user_id % 7 AS INTEGER) + 1],
        ['Fun','Top News','Sports','World News','Business','Top Sources','Technology'][CAST((user_id + 3) % 7 AS INTEGER) + 1]] AS channels
FROM (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, min(event_id) AS first_event FROM events GROUP BY ALL)"""


# --- taxonomy and classifications over part / lineitem ----------------------
def taxonomy_lines(spark: SparkSession, base: str) -> DataFrame:
    """Taxonomy file lines: '/TYPE/name' per part (with surrounding blanks, as read from a file)."""
    p = read_table(spark, base, "part")
    return p.select(F.concat(F.lit(" /"), F.col("p_type"), F.lit("/"), F.col("p_name"), F.lit(" ")).alias("value"))


TAXONOMY_SQL = "SELECT ' /' || p_type || '/' || p_name || ' ' AS value FROM part"


def taxonomy_rules(spark: SparkSession, base: str) -> DataFrame:
    """Channel rules: a prefix rule per part type, an exact rule per 'TYPE/first word'
    pair of a listed colour, and a skipped '~' rule - the three rule forms."""
    p = read_table(spark, base, "part")
    types = p.select("p_type").distinct()
    prefix = types.select(F.initcap("p_type").alias("channel"), F.concat(F.lit("/"), F.col("p_type"), F.lit("*")).alias("pattern"))
    words = p.select("p_type", F.split("p_name", " ").getItem(0).alias("w"), "p_name").distinct()
    exact = words.where(F.col("w").isin("red", "blue")).select(
        F.concat(F.lit("Color "), F.col("w")).alias("channel"),
        F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_name")).alias("pattern"),
    )
    skip = types.select(F.lit("Skipped").alias("channel"), F.concat(F.lit("~"), F.col("p_type")).alias("pattern"))
    return prefix.unionByName(exact).unionByName(skip)


TAXONOMY_RULES_SQL = """
SELECT upper(substr(lower(p_type), 1, 1)) || substr(lower(p_type), 2) AS channel, '/' || p_type || '*' AS pattern FROM (SELECT DISTINCT p_type FROM part)
UNION ALL
SELECT DISTINCT 'Color ' || split_part(p_name, ' ', 1) AS channel, '/' || p_type || '/' || p_name AS pattern
FROM part WHERE split_part(p_name, ' ', 1) IN ('red', 'blue')
UNION ALL
SELECT 'Skipped' AS channel, '~' || p_type AS pattern FROM (SELECT DISTINCT p_type FROM part)"""


def classifications(spark: SparkSession, base: str) -> DataFrame:
    """Classifier output per article: article = order, one category per line item."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    p = read_table(spark, base, "part").select("p_partkey", "p_type", "p_name")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_orderkey").cast("string").alias("article_key"),
        F.col("l_linenumber").alias("ord"),
        F.concat(F.lit("/"), F.col("p_type"), F.lit("/"), F.col("p_name"), F.lit(" ")).alias("name"),
        (F.col("l_quantity") / F.lit(50.0)).alias("confidence"),
    )


CLASSIFICATIONS_SQL = """
SELECT CAST(l_orderkey AS VARCHAR) AS article_key, l_linenumber AS ord,
       '/' || p_type || '/' || p_name || ' ' AS name, l_quantity / 50.0 AS confidence
FROM lineitem JOIN part ON l_partkey = p_partkey"""


# --- feed items: one event = one feed entry -----------------------------------
# The event type decides which date layout the entry carries (and 'error'
# entries carry an unparsable date); 'signup' entries link to the home page.
def feed_items(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    host = F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com"))
    ts = F.col("ts")
    rfc = F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss")
    date_s = (
        F.when(F.col("event_type") == "view", F.concat(rfc, F.lit(" +0000")))
        .when(F.col("event_type") == "click", F.concat(rfc, F.lit(" GMT")))
        .when(F.col("event_type") == "purchase", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(F.col("event_type") == "signup",
              F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .otherwise(F.lit("not a date"))
    )
    link = F.when(F.col("event_type") == "signup", F.concat(host, F.lit("/"))).otherwise(
        F.concat(host, F.lit("/news/"), F.col("event_type"), F.lit("/"), F.col("event_id").cast("string")))
    return e.select(
        F.concat(F.col("event_type"), F.lit(" &amp; more "), F.col("event_id").cast("string")).alias("title"),
        link.alias("link"),
        F.lit(None).cast("string").alias("url"),
        date_s.alias("updated"),
        F.lit(None).cast("string").alias("published"),
        F.lit(None).cast("string").alias("feed_updated"),
        F.lit(None).cast("string").alias("feed_published"),
        F.concat(F.lit("<p>"), F.col("props"), F.lit("</p>")).alias("description"),
        F.lit(None).cast("string").alias("image"),
        F.lit(None).cast("string").alias("urlToImage"),
        F.lit(None).cast("array<struct<url:string,width:string>>").alias("media_content"),
        F.lit(None).cast("array<struct<url:string,width:string>>").alias("media_thumbnail"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("content_html"),
        F.lit(None).cast("array<struct<url:string,type:string>>").alias("enclosures"),
        F.lit(None).cast("string").alias("item_category"),
        host.alias("site_url"),
        F.lit("News").alias("category"),
        F.when(F.col("user_id") % 10 == 0, F.lit("product")).otherwise(F.lit("article")).alias("content_type"),
        F.col("user_id").cast("string").alias("publisher_id"),
        F.concat(F.lit("Publisher "), F.col("user_id").cast("string")).alias("publisher_name"),
        F.array(F.lit("Top News")).alias("channels"),
        F.lit("").alias("creative_instance_id"),
        F.col("event_id").alias("ord"),
    )


# --- publisher CSV rows: one row per documents (source, lang) pair ------------
# Raw all-string rows with the source-list headers; the row's file is
# 'sources.<lang>.csv' and its row number the pair's first doc_id.
def source_rows(spark: SparkSession, base: str) -> DataFrame:
    d = read_table(spark, base, "documents")
    pairs = d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
    vocab = F.array(*[F.lit(c) for c in CHANNEL_VOCAB])
    site = F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com"))
    return pairs.select(
        site.alias("Domain"),
        F.concat(site, F.lit("/rss")).alias("Feed"),
        F.concat(F.lit("Source "), F.col("source")).alias("Title"),
        F.lit("News").alias("Category"),
        F.lit("Enabled").alias("Status"),
        F.lit("").alias("Score"),
        F.lit("").alias("OG-Images"),
        F.lit("article").alias("Content Type"),
        F.lit("").alias("Creative Instance ID"),
        F.concat(F.col("source"), F.lit(".example.com")).alias("Destination Domains"),
        F.concat(F.element_at(vocab, (F.col("n_docs") % len(CHANNEL_VOCAB) + 1).cast("int")), F.lit("; Top News")).alias("Channels"),
        F.col("n_docs").cast("string").alias("Rank"),
        F.lit("").alias("Original_Feed"),
        F.col("lang").alias("locale"),
        F.concat(F.lit("sources."), F.col("lang"), F.lit(".csv")).alias("file"),
        F.col("first_doc").alias("row_no"),
    )


SOURCE_PAIRS_SQL = """
SELECT source, lang, count(*) AS n_docs, min(doc_id) AS first_doc,
       'https://www.' || source || '.example.com' AS site_url,
       'https://www.' || source || '.example.com/rss' AS feed_url,
       'sources.' || lang || '.csv' AS file,
       ['Fun','Top News','Sports','World News','Business','Top Sources','Technology'][CAST(count(*) % 7 AS INTEGER) + 1] AS ch1
FROM documents GROUP BY source, lang"""


# --- stored / incoming articles over orders -----------------------------------
# article url key = (customer, priority); feed = customer; copies = orders.
ORDER_SPLIT = "1998-01-01"


def order_articles(spark: SparkSession, base: str, incoming: bool) -> DataFrame:
    o = read_table(spark, base, "orders")
    o = o.where(F.col("o_orderdate") >= F.lit(ORDER_SPLIT).cast("timestamp_ntz")) if incoming else \
        o.where(F.col("o_orderdate") < F.lit(ORDER_SPLIT).cast("timestamp_ntz"))
    return o.select(
        F.concat(F.lit("https://shop"), F.col("o_custkey").cast("string"), F.lit(".example.com/orders/"),
                 F.col("o_orderpriority")).alias("url"),
        F.concat(F.lit(" Priority "), F.col("o_orderpriority"), F.lit(" ")).alias("title"),
        F.col("o_orderdate").alias("publish_time"),
        F.when(F.col("o_totalprice") > 200000, F.concat(F.lit("https://img.example.com/"), F.col("o_orderkey").cast("string"),
                                                       F.lit(".jpg"))).otherwise(F.lit("")).alias("img"),
        F.lit("Shop").alias("category"),
        F.col("o_orderstatus").alias("description"),
        F.lit("article").alias("content_type"),
        F.lit("").alias("creative_instance_id"),
        (F.col("o_totalprice") / 1000.0).alias("pop_score"),
        F.lit(0.0).alias("score"),
        F.sha2(F.concat(F.lit("https://shop"), F.col("o_custkey").cast("string"), F.lit(".example.com/rss")), 256).alias("publisher_id"),
        F.col("o_orderkey").alias("ord"),
    )


def customer_feeds(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    url = F.concat(F.lit("https://shop"), F.col("c_custkey").cast("string"), F.lit(".example.com/rss"))
    return c.select(F.col("c_custkey").alias("id"), url.alias("url"), F.sha2(url, 256).alias("url_hash"))


ORDER_ARTICLES_SQL = """
SELECT 'https://shop' || CAST(o_custkey AS VARCHAR) || '.example.com/orders/' || o_orderpriority AS url,
       ' Priority ' || o_orderpriority || ' ' AS title,
       o_orderdate AS publish_time,
       CASE WHEN o_totalprice > 200000 THEN 'https://img.example.com/' || CAST(o_orderkey AS VARCHAR) || '.jpg' ELSE '' END AS img,
       o_orderstatus AS description,
       o_totalprice / 1000.0 AS pop_score,
       o_custkey AS feed_id,
       o_orderkey AS ord,
       o_orderdate < TIMESTAMP '1998-01-01' AS stored
FROM orders"""


# --- parsed feed entries and their publishers (events) ------------------------
def feed_entries(spark: SparkSession, base: str) -> DataFrame:
    """Entry columns only (as SRC4 yields them), one feed per user."""
    it = feed_items(spark, base)
    cols = ("title", "link", "url", "updated", "published", "feed_updated", "feed_published", "description",
            "image", "urlToImage", "media_content", "media_thumbnail", "summary", "content_html", "enclosures",
            "item_category", "ord")
    return it.select(
        F.concat(F.col("site_url"), F.lit("/rss")).alias("feed_url"),
        F.col("ord").alias("pos"),
        F.col("summary").alias("summary_src"),
        *cols,
    ).drop("summary_src")


FEED_LOCALES = ("en_US", "de_DE")


def feed_publishers(spark: SparkSession, base: str) -> DataFrame:
    """Publisher rows per (user feed, locale); every entry is attempted."""
    e = read_table(spark, base, "events").select("user_id").distinct()
    site = F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com"))
    return e.select(
        F.concat(site, F.lit("/rss")).alias("feed_url"),
        F.explode(F.array(*[F.lit(x) for x in FEED_LOCALES])).alias("locale"),
        F.col("user_id").cast("string").alias("publisher_id"),
        F.concat(F.lit("Publisher "), F.col("user_id").cast("string")).alias("publisher_name"),
        F.lit("News").alias("category"),
        site.alias("site_url"),
        F.when(F.col("user_id") % 10 == 0, F.lit("product")).otherwise(F.lit("article")).alias("content_type"),
        F.lit("").alias("creative_instance_id"),
        F.array(F.lit("Top News")).alias("channels"),
        F.lit(2147483647).alias("max_entries"),
        F.lit(False).alias("og_images"),
    )


# --- short links and their redirects (lineitem -> orders -> shop) -------------
def short_links(spark: SparkSession, base: str) -> DataFrame:
    li = read_table(spark, base, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.concat(
        F.lit("https://t.example.com/li/"), F.col("l_orderkey").cast("string"), F.lit("/"),
        F.col("l_linenumber").cast("string")).alias("link"))


def redirect_table(spark: SparkSession, base: str) -> DataFrame:
    """Redirect responses: line-item link -> order link (301), order link ->
    shop page (301, or 404 for orders in status P). One row per source URL."""
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders")
    hop1 = li.select(
        F.concat(F.lit("https://t.example.com/li/"), F.col("l_orderkey").cast("string"), F.lit("/"),
                 F.col("l_linenumber").cast("string")).alias("src"),
        F.concat(F.lit("https://t.example.com/o/"), F.col("l_orderkey").cast("string")).alias("dst"),
        F.lit(301).alias("status"))
    hop2 = o.select(
        F.concat(F.lit("https://t.example.com/o/"), F.col("o_orderkey").cast("string")).alias("src"),
        F.concat(F.lit("https://shop.example.com/c/"), F.col("o_custkey").cast("string"), F.lit("/o/"),
                 F.col("o_orderkey").cast("string")).alias("dst"),
        F.when(F.col("o_orderstatus") == "P", F.lit(404)).otherwise(F.lit(301)).alias("status"))
    return hop1.unionByName(hop2)


# --- image metadata (orders) --------------------------------------------------
def image_articles(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    img = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
           .when(F.col("o_orderpriority") == "1-URGENT",
                 F.concat(F.lit("https://img.example.com/"), F.col("o_orderkey").cast("string"), F.lit(".mp4")))
           .otherwise(F.concat(F.lit("https://img.example.com/"), F.col("o_orderkey").cast("string"), F.lit(".jpg"))))
    return o.select("o_orderkey", F.concat(F.lit("https://shop.example.com/o/"), F.col("o_orderkey").cast("string")).alias("url"),
                    img.alias("img"), (F.col("o_orderpriority") == "2-HIGH").alias("og_images"))


def image_meta(spark: SparkSession, base: str) -> DataFrame:
    a = image_articles(spark, base).where(F.col("img") != "")
    o = read_table(spark, base, "orders").where(F.col("o_orderstatus") != "P")
    return a.join(o, "o_orderkey").select(
        F.col("img").alias("url"),
        (F.col("o_totalprice") / 1000).cast("int").alias("width"),
        (F.col("o_totalprice") / 2000).cast("int").alias("height"),
        (F.col("o_totalprice") * 5).cast("long").alias("bytes"),
        (F.col("o_orderstatus") == "F").alias("cached"))


def page_meta(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders").where(F.col("o_orderpriority").isin("5-LOW", "2-HIGH"))
    return o.select(F.concat(F.lit("https://shop.example.com/o/"), F.col("o_orderkey").cast("string")).alias("url"),
                    F.concat(F.lit("https://og.example.com/"), F.col("o_orderkey").cast("string"), F.lit(".png")).alias("og_image"))


# --- articles for external classification (orders) ---------------------------
def order_channel_articles(spark: SparkSession, base: str) -> DataFrame:
    o = read_table(spark, base, "orders")
    ch = (F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("Top News"), F.lit("World")))
          .when(F.col("o_orderpriority") == "2-HIGH", F.array(F.lit("Fun")))
          .when(F.col("o_orderpriority") == "3-MEDIUM", F.array(F.lit("Culture"), F.lit("Politics"), F.lit("Culture")))
          .otherwise(F.array(F.lit("Business"))))
    return o.select(F.col("o_orderkey").cast("string").alias("article_key"),
                    F.concat(F.col("o_orderpriority"), F.lit(" order number "), F.col("o_orderkey").cast("string")).alias("title"),
                    F.col("o_orderstatus").alias("description"), ch.alias("channels"))


ORDER_CHANNEL_ARTICLES_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS article_key,
       o_orderpriority || ' order number ' || CAST(o_orderkey AS VARCHAR) AS title,
       o_orderstatus AS description,
       CASE WHEN o_orderpriority = '1-URGENT' THEN ['Top News', 'World']
            WHEN o_orderpriority = '2-HIGH' THEN ['Fun']
            WHEN o_orderpriority = '3-MEDIUM' THEN ['Culture', 'Politics', 'Culture']
            ELSE ['Business'] END AS channels
FROM orders"""


# --- raw RSS documents: one small document per event ---------------------------
def feed_documents(spark: SparkSession, base: str) -> DataFrame:
    """(feed_url, content) rows: each event becomes an RSS 2.0 document with
    one item (title, link, HTML description escaped as XML text, pubDate in the
    layout its event type selects), fetched for the user's feed URL."""
    it = feed_items(spark, base)
    xml = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>'),
        F.col("publisher_name"), F.lit("</title><link>"), F.col("site_url"), F.lit("</link><item><title>"),
        F.col("title"), F.lit("</title><link>"), F.col("link"), F.lit("</link><description>"),
        F.replace(F.replace(F.col("description"), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")),
        F.lit("</description><pubDate>"), F.col("updated"), F.lit("</pubDate></item></channel></rss>"),
    )
    return it.select(F.concat(F.col("site_url"), F.lit("/rss")).alias("feed_url"), xml.alias("content"), F.col("ord").alias("doc_ord"))


# --- publisher CSV rows for the order shops: one row per customer -------------
# locale = the customer's nation, channel = its market segment; the feed URL is
# the one the order articles carry as publisher.
def customer_source_rows(spark: SparkSession, base: str) -> DataFrame:
    c = read_table(spark, base, "customer")
    n = read_table(spark, base, "nation").select(F.col("n_nationkey").cast("int").alias("c_nationkey"), "n_name")
    j = c.withColumn("c_nationkey", F.col("c_nationkey").cast("int")).join(n, "c_nationkey")
    site = F.concat(F.lit("https://www.shop"), F.col("c_custkey").cast("string"), F.lit(".example.com"))
    return j.select(
        site.alias("Domain"),
        F.concat(F.lit("https://shop"), F.col("c_custkey").cast("string"), F.lit(".example.com/rss")).alias("Feed"),
        F.concat(F.lit("Shop "), F.col("c_custkey").cast("string")).alias("Title"),
        F.lit("Shop").alias("Category"),
        F.lit("Enabled").alias("Status"),
        F.lit("").alias("Score"),
        F.lit("").alias("OG-Images"),
        F.lit("article").alias("Content Type"),
        F.lit("").alias("Creative Instance ID"),
        F.concat(F.lit("shop"), F.col("c_custkey").cast("string"), F.lit(".example.com")).alias("Destination Domains"),
        F.col("c_mktsegment").alias("Channels"),
        F.lit("").alias("Rank"),
        F.lit("").alias("Original_Feed"),
        F.col("n_name").alias("locale"),
        F.concat(F.lit("sources."), F.col("n_name"), F.lit(".csv")).alias("file"),
        F.col("c_custkey").alias("row_no"),
    )


def flawed_source_rows(spark: SparkSession, base: str) -> DataFrame:
    """``customer_source_rows`` with one kind of mistake per market segment: no
    title, a feed that is no web address, a rank in words, or both a score in
    words and no destination domain. One segment stays right."""
    r = customer_source_rows(spark, base)
    seg = F.col("Channels")
    return r.select(
        *[c for c in r.columns if c not in ("Title", "Feed", "Rank", "Score", "Destination Domains")],
        F.when(seg == "BUILDING", F.lit("")).otherwise(F.col("Title")).alias("Title"),
        F.when(seg == "AUTOMOBILE", F.replace(F.col("Feed"), F.lit("https:"), F.lit("ftp:"))).otherwise(F.col("Feed")).alias("Feed"),
        F.when(seg == "MACHINERY", F.lit("first")).otherwise(F.col("Rank")).alias("Rank"),
        F.when(seg == "HOUSEHOLD", F.lit("high")).otherwise(F.col("Score")).alias("Score"),
        F.when(seg == "HOUSEHOLD", F.lit("")).otherwise(F.col("Destination Domains")).alias("Destination Domains"),
    )


def uneven_report(spark: SparkSession, base: str) -> DataFrame:
    """A run report per user feed whose entries parsed are its views and whose
    entries inserted are its clicks, so each rule of the report check can break."""
    e = read_table(spark, base, "events")
    return e.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "view").alias("size_after_get"),
        F.count_if(F.col("event_type") == "click").alias("size_after_insert"),
    ).select(F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/rss")).alias("feed_url"),
             "size_after_get", "size_after_insert")
