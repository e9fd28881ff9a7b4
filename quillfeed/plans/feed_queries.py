"""The registered run of the whole locale feed (QRY8) with every optional input:
stored articles, counters, predictions, image and page metadata, redirects, and a
limit on the entries of a document."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.timeparse import format_utc
from quillfeed.functions.urls import url_hash
from quillfeed.operators import store
from quillfeed.plans import feed_build
from quillfeed.plans import standins as S
from quillfeed.plans.registry import register
from quillfeed.sources.tables import read_table

AS_OF = _dt.datetime(2024, 1, 20)
LOCALES = (("en_US", config.DEFAULT_MAX_ENTRIES), ("de_DE", 5))  # with the entries taken of a document
CDN = "https://cdn.example.invalid/cache"


def _events(spark: SparkSession, base: str) -> DataFrame:
    """Events with the names of the feed's world: site, feed, the story that a short
    link leads to (one per user, type and day) and the title."""
    e = read_table(spark, base, "events")
    site = F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com"))
    return e.select(
        "event_id", "user_id", "event_type", "props", "value", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("t"),
        site.alias("site"), F.concat(site, F.lit("/rss")).alias("feed_url"),
        F.concat(F.lit("https://t.example.com/e/"), F.col("event_id").cast("string")).alias("short"),
        F.concat(site, F.lit("/news/"), "event_type", F.lit("/"), F.date_format("ts", "yyyy-MM-dd")).alias("story"),
        F.concat("event_type", F.lit(" & more "), F.col("event_id").cast("string")).alias("title"))


def documents(e: DataFrame) -> DataFrame:
    """One RSS document per user and third of the month, its items in the order of
    the events. Signups link to the home page, errors have no date that can be read."""
    def escaped(c):
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    link = F.when(F.col("event_type") == "signup", F.concat("site", F.lit("/"))).otherwise(F.col("short"))
    date = F.when(F.col("event_type") == "error", F.lit("soon")).otherwise(F.concat(F.date_format("t", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
    media = F.when(F.col("event_id") % 4 == 3, F.lit("")).otherwise(
        F.concat(F.lit('<media:content width="300" url="https://img.example.com/'), F.col("event_id").cast("string"), F.lit('.jpg"/>')))
    item = F.concat(F.lit("<item><title>"), escaped(F.col("title")), F.lit("</title><link>"), link, F.lit("</link><description>"),
                    escaped(F.concat(F.lit("<p>"), "props", F.lit("</p>"))), F.lit("</description><pubDate>"), date, F.lit("</pubDate>"), media, F.lit("</item>"))
    third = F.least(F.lit(2), F.expr("(dayofmonth(t) - 1) div 10")).cast("int")
    docs = e.select("feed_url", "user_id", third.alias("third"), "event_id", item.alias("item")).groupBy("feed_url", "user_id", "third").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda x: x["item"]), "").alias("items"))
    content = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/"><channel><title>t</title>'),
                       "items", F.lit("</channel></rss>"))
    return docs.select("feed_url", content.alias("content"), (F.col("user_id") * 4 + F.col("third")).alias("doc_ord"))


def publishers(e: DataFrame) -> DataFrame:
    vocab = F.array(*[F.lit(c) for c in S.CHANNEL_VOCAB])
    u = e.select("user_id", "site", "feed_url").distinct()
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("locale"), F.lit(n).alias("max_entries")) for name, n in LOCALES]))
    return u.select("feed_url", "user_id", "site", rows.alias("l")).select(
        "feed_url", "l.locale", F.col("user_id").cast("string").alias("publisher_id"),
        F.concat(F.lit("Publisher "), F.col("user_id").cast("string")).alias("publisher_name"), F.lit("News").alias("category"),
        F.col("site").alias("site_url"), F.when(F.col("user_id") % 10 == 0, F.lit("product")).otherwise(F.lit("article")).alias("content_type"),
        F.lit("").alias("creative_instance_id"),
        F.array(F.element_at(vocab, (F.col("user_id") % len(S.CHANNEL_VOCAB) + 1).cast("int")), F.lit("Culture")).alias("channels"),
        "l.max_entries", (F.col("user_id") % 4 == 0).alias("og_images"))


def stored_articles(e: DataFrame) -> DataFrame:
    """Every fifth event's article is stored, every second of them without an image."""
    i = F.col("event_id")
    img = F.when(i % 10 == 0, F.concat(F.lit("https://img.example.com/stored/"), i.cast("string"), F.lit(".jpg"))).otherwise("")
    a = e.where(i % 5 == 0).select(
        "title", (F.col("t") - F.expr("INTERVAL 1 HOUR")).alias("publish_time"), img.alias("img"), img.alias("padded_img"), F.lit("News").alias("category"),
        F.lit("stored").alias("description"), F.lit("article").alias("content_type"), F.lit("").alias("creative_instance_id"),
        F.col("story").alias("url"), url_hash(F.col("story")).alias("url_hash"), (i % 7 + 50).cast("double").alias("pop_score"), F.lit(0.0).alias("score"))
    return store.with_article_key(a)


def optional_inputs(e: DataFrame) -> dict[str, DataFrame]:
    i = F.col("event_id")
    named = F.when(i % 3 == 0, "Sports").when(i % 3 == 1, "Crime").otherwise("Top News")
    return {
        "stored": stored_articles(e),
        "counters": e.where(F.col("user_id") % 2 == 0).select(F.col("story").alias("url"), (F.col("value") * 3).alias("score")),
        "predictions": e.select(F.col("story").alias("url"), i.alias("ord"), named.alias("name"),
                                F.when(i % 2 == 0, 0.95).otherwise(0.4).alias("confidence")),
        "image_meta": e.where((i % 4 != 3) & (i % 8 != 0)).select(
            F.concat(F.lit("https://img.example.com/"), i.cast("string"), F.lit(".jpg")).alias("url"), (i % 300 + 300).cast("int").alias("width"),
            F.lit(100).alias("height"), (i % 5 * 100_000 + 900_000).cast("long").alias("bytes"), (i % 2 == 0).alias("cached")),
        "page_meta": e.where(F.col("user_id") % 3 == 0).select(
            F.col("story").alias("url"), F.concat(F.lit("https://og.example.com/"), F.col("user_id").cast("string"), F.lit("/"), "event_type", F.lit(".png"))
            .alias("og_image")).distinct(),
        "redirects": e.select(F.col("short").alias("src"), F.col("story").alias("dst"), F.when(i % 17 == 0, 404).otherwise(301).alias("status")),
    }


_VOCAB = "[" + ", ".join(f"'{c}'" for c in S.CHANNEL_VOCAB) + "]"
_EXCLUDED = ", ".join(f"'{c}'" for c in config.PRED_EXCLUDED_CHANNELS)
_AUGMENT = "[" + ", ".join(f"'{c}'" for c in config.PRED_AUGMENT_CHANNELS) + "]"
_DEFAULT = "[" + ", ".join(f"'{c}'" for c in config.PRED_DEFAULT_CHANNELS) + "]"
WHOLE_FEED_SQL = f"""
WITH e AS (
  SELECT *, date_trunc('second', ts) AS t, least(2, (dayofmonth(ts) - 1) // 10) AS third,
         'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/news/' || event_type || '/' || strftime(ts, '%Y-%m-%d') AS story,
         event_type || ' & more ' || CAST(event_id AS VARCHAR) AS title
  FROM events),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, third ORDER BY event_id) - 1 AS pos FROM e),
a AS (
  SELECT *, (user_id * 4 + third) * 1048576 + pos AS ord, sha256(story) AS url_hash, sha256(story) || sha256(trim(title)) AS article_key,
         CASE WHEN event_id % 4 = 3 THEN '' ELSE 'https://img.example.com/' || CAST(event_id AS VARCHAR) || '.jpg' END AS img0,
         [{_VOCAB}[user_id % {len(S.CHANNEL_VOCAB)} + 1], 'Culture'] AS channels
  FROM n
  WHERE event_type IN ('view', 'click', 'purchase') AND event_id % 17 <> 0
    AND (user_id % 10 = 0 OR t BETWEEN TIMESTAMP '2024-01-20 01:00:00' - INTERVAL 60 DAY AND TIMESTAMP '2024-01-20 01:00:00')),
x AS (SELECT l.locale, a.* FROM a, (VALUES {', '.join(f"('{name}', {k})" for name, k in LOCALES)}) l(locale, most) WHERE a.pos < l.most),
known AS (
  SELECT locale, url_hash, title, t - INTERVAL 1 HOUR AS publish_time, user_id, channels, ord,
         'https://img.example.com/stored/' || CAST(event_id AS VARCHAR) || '.jpg' AS img, 'stored' AS description,
         CAST(event_id % 7 + 50 AS DOUBLE) AS pop_score
  FROM x WHERE event_id % 10 = 0),
sums AS (SELECT story, sum(value * 3) AS raw FROM e WHERE user_id % 2 = 0 GROUP BY story),
d AS (
  SELECT x.*, CASE WHEN coalesce(s.raw, 1.0) <= {config.POP_SCORE_CUTOFF} THEN coalesce(s.raw, 1.0)
                   ELSE {config.POP_SCORE_CUTOFF - 1} + pow(1.0 + s.raw - {config.POP_SCORE_CUTOFF}, 2.0 / 3.0) END AS pop
  FROM x LEFT JOIN sums s ON s.story = x.story WHERE event_id % 10 <> 0),
p AS (SELECT *, min(pop) OVER (PARTITION BY locale) AS lo, max(pop) OVER (PARTITION BY locale) AS hi FROM d),
best AS (
  SELECT story, arg_max(CASE event_id % 3 WHEN 0 THEN 'Sports' WHEN 1 THEN 'Crime' ELSE 'Top News' END,
                        (CASE WHEN event_id % 2 = 0 THEN 0.95 ELSE 0.4 END, -event_id)) AS name,
         max(CASE WHEN event_id % 2 = 0 THEN 0.95 ELSE 0.4 END) AS confidence FROM e GROUP BY story),
c AS (
  SELECT p.*, CASE WHEN locale <> 'en_US' OR list_has_any(channels, {_DEFAULT}) OR length(props || title) < {config.MIN_TEXT_LEN}
                     OR name IN ({_EXCLUDED}) OR confidence < {config.PRED_CONFIDENCE_THRESHOLD} THEN channels
                   ELSE list_concat([name], list_filter(channels, lambda z: list_contains({_AUGMENT}, z))) END AS channels1,
         300 + event_id % 300 AS w, event_id % 8 <> 0 AND img0 <> '' AS sized,
         event_id % 8 <> 0 AND img0 <> '' AND 900000 + event_id % 5 * 100000 > {config.LARGE_IMAGE_BYTES} AS large
  FROM p JOIN best b ON b.story = p.story),
i1 AS (SELECT *, CASE WHEN sized AND w >= {config.MIN_IMAGE_SIZE} THEN img0 ELSE '' END AS img1 FROM c),
i2 AS (SELECT *, CASE WHEN user_id % 3 = 0 AND (img1 = '' OR user_id % 4 = 0)
                      THEN 'https://og.example.com/' || CAST(user_id AS VARCHAR) || '/' || event_type || '.png' ELSE img1 END AS img2 FROM i1),
new AS (
  SELECT locale, url_hash, title, t AS publish_time, user_id, channels1 AS channels, ord,
         CASE WHEN large AND event_id % 2 = 1 THEN '' ELSE img2 END AS img,
         CASE WHEN large AND event_id % 2 = 0 THEN '{CDN}/' || sha256(img2) || '.jpg.pad' WHEN large THEN '' ELSE img2 END AS padded_img,
         props AS description, greatest(CASE WHEN hi = lo THEN 1.0 ELSE {config.POP_SCORE_RANGE} * ((pop - lo) / (hi - lo)) END, 1.0) AS pop_score
  FROM i2),
u AS (SELECT *, {{'t': publish_time, 'o': -ord}} AS k FROM
      (SELECT * FROM new UNION ALL SELECT locale, url_hash, title, publish_time, user_id, channels, ord, img, img, description, pop_score FROM known)),
g AS (
  SELECT locale, url_hash, max(publish_time) AS pos_ts, arg_max(ord, k) AS pos_ord,
         arg_min({{'title': title, 'publish_time': publish_time, 'user_id': user_id, 'channels': array_to_string(channels, '|'), 'img': img,
                  'padded_img': padded_img, 'description': description, 'pop_score': pop_score}}, k) AS r
  FROM u GROUP BY locale, url_hash),
v AS (SELECT *, row_number() OVER (PARTITION BY locale, r.user_id ORDER BY pos_ts DESC, pos_ord) AS variety_rank,
             (epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(r.publish_time)) / 1e6 AS secs FROM g)
SELECT locale, url_hash, r.title AS title, strftime(r.publish_time, '%Y-%m-%d %H:%M:%S') AS publish_time, CAST(r.user_id AS VARCHAR) AS publisher_id,
       r.channels AS channels, r.img AS img, r.padded_img AS padded_img, r.description AS description, round(r.pop_score, 6) AS pop_score, variety_rank,
       printf('%.9e', CASE WHEN secs > 0 THEN ln(secs) ELSE 0.1 END * pow(2.0, variety_rank)) AS score
FROM v"""


@register("whole_feed", WHOLE_FEED_SQL)
def whole_feed(spark: SparkSession, base: str) -> DataFrame:
    """QRY8 from raw documents with all it can take: JOI1, TOP1, FLT1-7, JOI3, JOI4 +
    FLT16, JOI5, AGG1-3, JOI6, FLT9, FLT11-13, JOI14, PRJ28, PRJ8, SET1, SRT2, WIN1-2."""
    e = _events(spark, base)
    b = feed_build.build_locale_feeds(documents(e), publishers(e), as_of=AS_OF, cdn_base=CDN, **optional_inputs(e))
    return b.feed.select(
        "locale", "url_hash", "title", format_utc(F.col("publish_time")).alias("publish_time"), "publisher_id",
        F.array_join("channels", "|").alias("channels"), "img", "padded_img", "description", F.round("pop_score", 6).alias("pop_score"),
        "variety_rank", F.format_string("%.9e", F.col("score")).alias("score"))
