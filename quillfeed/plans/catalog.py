"""Registered queries over the driver tables and their DuckDB oracle SQL.

Every query reads the driver tables through a stand-in builder (renaming only)
and then runs the library's own operators. Floats are rounded and timestamps
written as strings so both engines produce comparable values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions.timeparse import format_utc
from quillfeed.functions.urls import url_hash
from quillfeed.operators import enrich, rank
from quillfeed.plans import standins as S
from quillfeed.plans.registry import ORACLE, QUERIES, register

AS_OF = config.AS_OF_SQL


def _hashed_articles(spark, base):
    a = S.articles(spark, base)
    return a.withColumn("url_hash", url_hash(F.col("url")))


# --- flagship: SRT2 -> WIN1 -> PRJ30/WIN2 -> SRT1 ------------------------------
FEED_RANK_SQL = f"""
WITH a AS ({S.ARTICLES_SQL}),
d AS (SELECT *, sha256(url) AS url_hash FROM a),
g AS (
  SELECT url_hash,
         max(publish_time) AS pos_ts,
         arg_max(ord, (publish_time, -ord)) AS pos_ord,
         arg_min(url, (publish_time, -ord)) AS url,
         arg_min(title, (publish_time, -ord)) AS title,
         arg_min(publish_time, (publish_time, -ord)) AS publish_time,
         arg_min(publisher_id, (publish_time, -ord)) AS publisher_id,
         count(*) AS n_copies
  FROM d GROUP BY url_hash),
r AS (
  SELECT *, row_number() OVER (PARTITION BY publisher_id ORDER BY pos_ts DESC, pos_ord ASC) AS variety_rank,
         (epoch_us({AS_OF}) - epoch_us(publish_time)) / 1000000.0 AS secs
  FROM g)
SELECT url_hash, url, publisher_id, title,
       strftime(publish_time, '%Y-%m-%d %H:%M:%S') AS publish_time,
       strftime(pos_ts, '%Y-%m-%d %H:%M:%S') AS pos_time,
       variety_rank, pow(2.0, variety_rank) AS variety,
       round(CASE WHEN secs > 0 THEN ln(secs) ELSE 0.1 END * pow(2.0, variety_rank), 6) AS score,
       n_copies
FROM r"""


@register("feed_rank", FEED_RANK_SQL)
def feed_rank(spark: SparkSession, base: str, sort: bool = True) -> DataFrame:
    """Flagship ranking: dedup by url_hash (newest position, oldest content),
    per-publisher variety 2**k, score = ln(age seconds) * variety, newest first."""
    ranked = rank.rank_articles(_hashed_articles(spark, base), as_of=config.AS_OF, sort=sort)
    return ranked.select(
        "url_hash", "url", "publisher_id", "title",
        format_utc(F.col("publish_time")).alias("publish_time"),
        format_utc(F.col("pos_ts")).alias("pos_time"),
        "variety_rank", "variety",
        F.round("score", 6).alias("score"),
        "n_copies",
    )


DEDUP_SQL = f"""
WITH a AS ({S.ARTICLES_SQL}),
d AS (SELECT *, sha256(url) AS url_hash FROM a)
SELECT url_hash,
       strftime(max(publish_time), '%Y-%m-%d %H:%M:%S') AS pos_time,
       arg_max(ord, (publish_time, -ord)) AS pos_ord,
       arg_min(title, (publish_time, -ord)) AS title,
       arg_min(description, (publish_time, -ord)) AS description,
       strftime(min(publish_time), '%Y-%m-%d %H:%M:%S') AS publish_time,
       count(*) AS n_copies
FROM d GROUP BY url_hash"""


@register("dedup_url_hash", DEDUP_SQL)
def dedup_url_hash(spark: SparkSession, base: str) -> DataFrame:
    """SRT2 alone: one row per url_hash, position of the newest copy, content of the oldest."""
    d = rank.dedup_by_url_hash(_hashed_articles(spark, base))
    return d.select(
        "url_hash", format_utc(F.col("pos_ts")).alias("pos_time"), "pos_ord", "title", "description",
        format_utc(F.col("publish_time")).alias("publish_time"), "n_copies",
    )


# --- popularity: AGG1 -> JOI5 -> PRJ29 -> AGG2/AGG3 ----------------------------
POPULARITY_SQL = f"""
WITH c AS ({S.POPULARITY_SQL}),
s AS (SELECT url, sum(score) AS pop_raw FROM c GROUP BY url),
a AS (SELECT DISTINCT url FROM ({S.ARTICLES_SQL})),
j AS (SELECT a.url, coalesce(s.pop_raw, 1.0) AS pop_raw FROM a LEFT JOIN s ON a.url = s.url),
p AS (SELECT url, pop_raw,
             CASE WHEN pop_raw <= {config.POP_SCORE_CUTOFF} THEN pop_raw
                  ELSE {config.POP_SCORE_CUTOFF - 1}.0 + pow(1.0 + pop_raw - {config.POP_SCORE_CUTOFF}.0, 2.0/3.0) END AS pop_score
      FROM j),
b AS (SELECT min(pop_score) AS lo, max(pop_score) AS hi FROM p)
SELECT url, round(pop_raw, 4) AS pop_raw, round(pop_score, 6) AS pop_score,
       round(greatest(CASE WHEN hi = lo THEN 1.0 ELSE {config.POP_SCORE_RANGE}.0 * ((pop_score - lo) / (hi - lo)) END, 1.0), 6) AS pop_norm
FROM p, b"""


@register("popularity_norm", POPULARITY_SQL)
def popularity_norm(spark: SparkSession, base: str) -> DataFrame:
    """Per-article popularity: counters summed (AGG1), left-joined with a 1.0
    default (JOI5), dampened above 300 (PRJ29), min-max normalised over the run (AGG2/3)."""
    sums = enrich.popularity_sums(S.popularity_counters(spark, base))
    urls = S.articles(spark, base).select("url").distinct()
    scored = enrich.attach_popularity(urls, sums)
    normed = rank.normalize_popularity(scored, "pop_score", out="pop_norm")
    return normed.select(
        "url", F.round("pop_raw", 4).alias("pop_raw"), F.round("pop_score", 6).alias("pop_score"),
        F.round("pop_norm", 6).alias("pop_norm"),
    )


# --- predicted channels: TOP2 -> JOI6 -> FLT9 -> PRJ31 -------------------------
PREDICTED_SQL = f"""
WITH c AS ({S.PREDICTIONS_SQL}),
t AS (SELECT url, arg_max(name, (confidence, -ord)) AS pred_name, max(confidence) AS pred_confidence FROM c GROUP BY url),
a AS ({S.PRED_ARTICLES_SQL}),
j AS (SELECT a.*, t.pred_name, t.pred_confidence FROM a LEFT JOIN t ON a.url = t.url),
k AS (SELECT *,
        (list_has_any(channels, ['Fun'])
         OR length(coalesce(description, '') || coalesce(title, '')) < {config.MIN_TEXT_LEN}
         OR pred_name IS NULL OR pred_name IN ('Crime') OR pred_confidence < {config.PRED_CONFIDENCE_THRESHOLD}) AS keep
      FROM j)
SELECT url,
       array_to_string(CASE WHEN keep THEN channels
            ELSE list_concat([pred_name], list_filter(channels,
                 lambda x, i: list_contains(['Top Sources','Top News','World News','US News','Culture'], x)
                           AND list_position(channels, x) = i)) END, '|') AS channels,
       pred_name, round(pred_confidence, 6) AS pred_confidence
FROM k"""


@register("predicted_channels", PREDICTED_SQL)
def predicted_channels(spark: SparkSession, base: str) -> DataFrame:
    """Top prediction per article (ties -> first candidate), the gate (default
    channel, short text, excluded name, low confidence) and channel replacement
    keeping augment channels."""
    top = enrich.top_prediction(S.prediction_candidates(spark, base))
    out = enrich.apply_prediction(S.prediction_articles(spark, base), top)
    return out.select(
        "url", F.array_join("channels", "|").alias("channels"), "pred_name",
        F.round("pred_confidence", 6).alias("pred_confidence"),
    )


# --- taxonomy channels: SRC7 -> JOI7 -> FLT10 -> JOI8 -> SET3 ------------------
TAXONOMY_SQL = f"""
WITH tax AS (SELECT DISTINCT trim(value) AS category FROM ({S.TAXONOMY_SQL}) WHERE trim(value) <> ''),
rules AS ({S.TAXONOMY_RULES_SQL}),
r AS (SELECT * FROM rules WHERE NOT starts_with(pattern, '~')),
m AS (
  SELECT DISTINCT category, channel FROM (
    SELECT tax.category, r.channel FROM tax JOIN r ON ends_with(r.pattern, '*')
         AND starts_with(tax.category, substr(r.pattern, 1, length(r.pattern) - 1))
    UNION ALL
    SELECT pattern AS category, channel FROM r WHERE NOT ends_with(pattern, '*'))),
c AS ({S.CLASSIFICATIONS_SQL}),
h AS (SELECT c.article_key, m.channel FROM c JOIN m ON trim(c.name) = m.category WHERE c.confidence >= {config.CLASSIFICATION_FLOOR}),
g AS (SELECT article_key, array_to_string(list_sort(list_distinct(list(channel))), '|') AS ext_channels FROM h GROUP BY article_key),
k AS (SELECT DISTINCT article_key FROM c)
SELECT k.article_key, coalesce(g.ext_channels, '') AS ext_channels
FROM k LEFT JOIN g ON k.article_key = g.article_key"""


@register("taxonomy_channels", TAXONOMY_SQL)
def taxonomy_channels(spark: SparkSession, base: str) -> DataFrame:
    """Prefix/exact/skip taxonomy rules expanded over the taxonomy lines, then
    classifier categories (>= 0.2) mapped to distinct channels per article."""
    mapping = enrich.expand_taxonomy(S.taxonomy_lines(spark, base), S.taxonomy_rules(spark, base))
    ext = enrich.classification_channels(S.classifications(spark, base), mapping)
    return ext.select("article_key", F.array_join("ext_channels", "|").alias("ext_channels"))


# --- entry cleaning: FLT1-6, PRJ9-14 over feed items --------------------------
import datetime as _dt  # noqa: E402

from quillfeed.functions import text as TX  # noqa: E402
from quillfeed.functions import urls as U  # noqa: E402
from quillfeed.operators import clean  # noqa: E402
from quillfeed.sources.tables import read_table  # noqa: E402

CLEAN_AS_OF = _dt.datetime(2024, 1, 20)
ENTRIES_SQL = """
WITH e AS (SELECT *, date_trunc('second', ts) AS t FROM events)
SELECT event_id AS ord,
       event_type || ' & more ' || CAST(event_id AS VARCHAR) AS title,
       'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/news/' || event_type || '/' || CAST(event_id AS VARCHAR) AS link,
       strftime(t, '%Y-%m-%d %H:%M:%S') AS publish_time,
       props AS description,
       CASE WHEN user_id % 10 = 0 THEN 'product' ELSE 'article' END AS content_type,
       CAST(user_id AS VARCHAR) AS publisher_id
FROM e
WHERE event_type IN ('view', 'click', 'purchase')
  AND (user_id % 10 = 0
       OR (t >= TIMESTAMP '2024-01-20 01:00:00' - INTERVAL 60 DAY AND t <= TIMESTAMP '2024-01-20 01:00:00'))"""


@register("entries_clean", ENTRIES_SQL)
def entries_clean(spark: SparkSession, base: str) -> DataFrame:
    """Feed entries -> articles: title decode, link pick, home-page links
    dropped, free-form dates parsed (RFC 822, ISO 8601 with Z/offset; bad ones
    dropped), 60-day/+1h window unless product, description to text."""
    arts = clean.entries_to_articles(S.feed_items(spark, base), as_of=CLEAN_AS_OF)
    return arts.select(
        "ord", "title", "link", format_utc(F.col("publish_time")).alias("publish_time"),
        "description", "content_type", "publisher_id",
    )


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The references that the test tables hold, in natural order; "&amp;" is applied last.
COMMON_ENTITIES = (
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"),
    ("&nbsp;", " "), ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"),
    ("&middot;", "·"), ("&hellip;", "…"), ("&mdash;", "—"), ("&ndash;", "–"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"), ("&pound;", "£"),
    ("&deg;", "°"), ("&times;", "×"), ("&bull;", "•"),
)


def _sql_unescape(x: str) -> str:
    for ent, ch in COMMON_ENTITIES:
        x = f"replace({x}, {_sql_str(ent)}, {_sql_str(ch)})"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def _sql_strip(x: str) -> str:
    x = f"regexp_replace({x}, {_sql_str(TX.COMMENT_RE)}, '', 'g')"
    x = f"regexp_replace({x}, {_sql_str(TX.SCRIPT_STYLE_RE)}, '', 'g')"
    return f"regexp_replace({x}, {_sql_str(TX.TAG_RE)}, '', 'g')"


def _sql_scrub(x: str) -> str:
    """Scrubbing for the pages' markup, whose attributes hold no ">" and no titles:
    allowed tags are put out of the way, the others removed, brackets escaped."""
    o, c = "\ue000", "\ue001"
    allowed = "|".join(TX.ALLOWED_TAGS)
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    x = rf"""regexp_replace({x}, '(?i)<a\s[^>]*?href\s*=\s*"((?:https?:|mailto:)[^">]*|[^":>]*)"[^>]*>', '{o}a href="\1"{c}', 'g')"""
    x = rf"regexp_replace({x}, '(?i)<(/?)({allowed})(\s[^>]*)?>', '{o}\1\2{c}', 'g')"
    x = f"regexp_replace({x}, '<[a-zA-Z/!][^>]*>', '', 'g')"
    x = f"replace(replace({x}, '<', '&lt;'), '>', '&gt;')"
    return f"replace(replace(replace({x}, '{o}', '<'), '{c}', '>'), '&amp;', '&')"


TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
HTML_SQL = f"""
WITH p AS (SELECT page_id, html, {_sql_unescape(_sql_strip('html'))} AS txt, {_sql_scrub('html')} AS scrubbed FROM pages)
SELECT page_id,
       {_sql_unescape(_sql_unescape(_sql_strip(f"regexp_extract(html, {_sql_str(TITLE_RE)}, 1)")))} AS title_text,
       length(txt) AS text_len, sha256(txt) AS text_sha,
       length(scrubbed) AS scrub_len, sha256(scrubbed) AS scrub_sha,
       regexp_extract(coalesce(html, ''), {_sql_str(r'''(?is)<a\b[^>]*?\shref\s*=\s*["']([^"']*)''')}, 1) AS first_link
FROM p"""


@register("html_clean", HTML_SQL)
def html_clean(spark: SparkSession, base: str) -> DataFrame:
    """Whole page HTML: scrub to the allowed tags (PRJ8), full text (PRJ9 +
    PRJ10), title decoded twice, first link target (PRJ24 pattern on <a href>)."""
    from quillfeed.functions.images import A_HREF_ATTR_RE, first_tag_attr

    p = read_table(spark, base, "pages").select(
        "page_id", "html", TX.html_to_text(F.col("html")).alias("txt"), TX.scrub_html(F.col("html")).alias("scrubbed"))
    return p.select(
        "page_id",
        TX.title_text(F.regexp_extract("html", TITLE_RE, 1)).alias("title_text"),
        F.length("txt").cast("long").alias("text_len"), F.sha2("txt", 256).alias("text_sha"),
        F.length("scrubbed").cast("long").alias("scrub_len"), F.sha2("scrubbed", 256).alias("scrub_sha"),
        first_tag_attr(F.col("html"), A_HREF_ATTR_RE).alias("first_link"),
    )


URL_MIN_PATH = 8


def _sql_re(col: str, group: int, pattern: str = U.URL_RE) -> str:
    return f"regexp_extract({col}, {_sql_str(pattern)}, {group})"


URLS_SQL = f"""
WITH p AS (SELECT page_id, url,
                  lower({_sql_re('url', 2)}) AS scheme, {_sql_re('url', 4)} AS netloc,
                  {_sql_re('url', 5)} AS path, {_sql_re('url', 7)} AS query, {_sql_re('url', 9)} AS fragment,
                  {_sql_re('url', 3)} AS auth FROM pages),
h AS (SELECT *, nullif(lower({_sql_re('netloc', 1, U.HOST_RE)}), '') AS host FROM p)
SELECT page_id, scheme, host, path, query,
       sha256(url) AS url_hash,
       (CASE WHEN {_sql_re('url', 2)} <> '' THEN {_sql_re('url', 2)} || ':' ELSE '' END)
         || (CASE WHEN auth <> '' THEN '//' || netloc ELSE '' END)
         || array_to_string(list_transform(string_split(path, '/'), lambda s: url_encode(s)), '/')
         || (CASE WHEN query <> '' THEN '?' || query ELSE '' END)
         || (CASE WHEN fragment <> '' THEN '#' || fragment ELSE '' END) AS encoded_url,
       sha256(url) || sha256(trim(page_id::VARCHAR)) AS article_key,
       replace(host, '.', '_') AS host_label,
       regexp_replace(host, '^(https://(www\\.)?)?', 'https://www.') AS www_domain,
       coalesce(scheme = 'https' AND netloc <> '', false) AS is_https
FROM h
WHERE length(path) >= {URL_MIN_PATH}"""


@register("url_parts", URLS_SQL)
def url_parts(spark: SparkSession, base: str) -> DataFrame:
    """Lenient URL split (PRJ15), url hash before re-encoding (PRJ17), path
    percent-encoding (PRJ16), article key (PRJ18), host label (PRJ33), https
    www prefix (PRJ20), https check (PRJ21); short paths dropped (FLT4 with
    min_path=8, since no page path here is shorter than 4)."""
    p = read_table(spark, base, "pages").withColumn("link", F.col("url"))
    p = clean.drop_home_links(p, "link", min_path=URL_MIN_PATH)
    u = F.col("url")
    return p.select(
        "page_id", U.url_scheme(u).alias("scheme"), U.url_host(u).alias("host"), U.url_path(u).alias("path"),
        U.url_query(u).alias("query"), U.url_hash(u).alias("url_hash"), U.reencode_url(u).alias("encoded_url"),
        U.article_key(U.url_hash(u), F.col("page_id").cast("string")).alias("article_key"),
        U.host_label(u).alias("host_label"), U.ensure_https_www(U.url_host(u)).alias("www_domain"),
        U.is_https_url(u).alias("is_https"),
    )


# Stand-in word list: the reference's two custom words plus three tokens of the invented prose.
STANDIN_WORDS = ("vibrators", "hedonistic", "enein", "chch", "ndtion")
PROFANITY_SQL = f"""
SELECT doc_id, lang, source,
       coalesce(regexp_matches(lower(text), {_sql_str(TX.word_pattern(STANDIN_WORDS))}), false) AS flagged
FROM documents"""


@register("title_profanity", PROFANITY_SQL)
def title_profanity(spark: SparkSession, base: str) -> DataFrame:
    """FLT2 over whole document texts: flag texts containing a listed word."""
    d = read_table(spark, base, "documents")
    return d.select("doc_id", "lang", "source", TX.contains_listed_word(F.col("text"), STANDIN_WORDS).alias("flagged"))


# --- publisher sources and the store: AGG5, SET4-6, QRY1, QRY2, QRY6 -----------
from quillfeed.operators import publishers as P  # noqa: E402
from quillfeed.operators import store as ST  # noqa: E402


def _valid_sources(spark, base):
    good, _bad = P.split_valid(P.type_source_rows(S.source_rows(spark, base)))
    return good


def _store_tables(spark, base):
    from quillfeed.sources.lookups import COVER_VALUE
    from pyspark.sql import types as T

    fav = spark.createDataFrame([], "domain string, favicon_url string")
    cov = spark.createDataFrame([], T.StructType([T.StructField("domain", T.StringType())] + COVER_VALUE.fields))
    nested = P.nest_locales(P.attach_lookups(_valid_sources(spark, base), fav, cov))
    nested = nested.withColumn("ord", F.struct("publisher_name", "publisher_id"))
    return ST.normalize_publishers(nested, as_of=config.AS_OF)


def _locales_str(c):
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["locale"], x["rank"].cast("string"),
                                                             F.array_join(x["channels"], ";"))), "|")


GLOBAL_SOURCES_SQL = f"""
WITH p AS ({S.SOURCE_PAIRS_SQL})
SELECT sha256(feed_url) AS publisher_id,
       arg_min('Source ' || source, (file, first_doc)) AS publisher_name,
       arg_min(site_url, (file, first_doc)) AS site_url,
       arg_min(feed_url, (file, first_doc)) AS feed_url,
       true AS enabled, 0.0 AS score,
       count(*) AS n_locales,
       string_agg(lang || ':' || CAST(n_docs AS VARCHAR) || ':' || ch1 || ';Top News', '|' ORDER BY file, first_doc) AS locales
FROM p GROUP BY feed_url"""


@register("global_sources", GLOBAL_SOURCES_SQL)
def global_sources(spark: SparkSession, base: str) -> DataFrame:
    """Source rows typed (PRJ1-7), validated (FLT15) and nested per publisher:
    first row supplies the attributes, every row appends {locale, channels, rank} (AGG5)."""
    n = P.nest_locales(_valid_sources(spark, base))
    return n.select(
        "publisher_id", "publisher_name", "site_url", "feed_url", "enabled", "score",
        F.size("locales").cast("long").alias("n_locales"), _locales_str(F.col("locales")).alias("locales"),
    )


FEEDS_BY_LOCALE_SQL = f"""
WITH p AS ({S.SOURCE_PAIRS_SQL})
SELECT lang AS locale, feed_url, 'Source ' || source AS publisher_name, 'News' AS category, site_url,
       false AS og_images, 20 AS max_entries, '' AS creative_instance_id, 'article' AS content_type,
       sha256(feed_url) AS publisher_id,
       array_to_string(list_sort(list_distinct([ch1, 'Top News'])), '|') AS channels
FROM p"""


@register("feeds_by_locale", FEEDS_BY_LOCALE_SQL)
def feeds_by_locale(spark: SparkSession, base: str) -> DataFrame:
    """Nested sources loaded into six tables (SET4-6), then every locale's feeds
    with publisher and distinct channels (QRY1: JOI9, JOI10, JOI11, AGG4)."""
    f = ST.feeds_by_locale(_store_tables(spark, base))
    return f.select(
        "locale", "feed_url", "publisher_name", "category", "site_url", "og_images",
        F.col("max_entries").cast("int").alias("max_entries"), "creative_instance_id", "content_type", "publisher_id",
        F.array_join("channels", "|").alias("channels"),
    )


PUBLISHER_LOCALES_SQL = f"""
WITH p AS ({S.SOURCE_PAIRS_SQL})
SELECT site_url, lang AS locale, 'Source ' || source AS publisher_name, feed_url, 'News' AS category,
       sha256(feed_url) AS publisher_id,
       lang || ':' || CAST(n_docs AS VARCHAR) || ':' || array_to_string(list_sort(list_distinct([ch1, 'Top News'])), ';') AS locales
FROM p"""


@register("publisher_locales", PUBLISHER_LOCALES_SQL)
def publisher_locales(spark: SparkSession, base: str) -> DataFrame:
    """QRY2 for every (publisher, locale): feeds of the publisher with their
    {locale, channels, rank} entries in that locale."""
    q = ST.publishers_with_locales(_store_tables(spark, base))
    return q.select("site_url", "locale", "publisher_name", "feed_url", "category", "publisher_id",
                    _locales_str(F.col("locales")).alias("locales"))


CHANNEL_LIST_SQL = f"""
WITH p AS ({S.SOURCE_PAIRS_SQL})
SELECT DISTINCT name FROM (SELECT ch1 AS name FROM p UNION ALL SELECT 'Top News' AS name)"""


@register("channel_list", CHANNEL_LIST_SQL)
def channel_list(spark: SparkSession, base: str) -> DataFrame:
    """QRY6: distinct channel names of the store, sorted (AGG11, SRT3)."""
    return ST.channel_names(_store_tables(spark, base))


# --- articles in the store: SET7, SET12, JOI4, FLT16, JOI12 -----------------------
STORE_AS_OF_1 = _dt.datetime(1998, 1, 1)
STORE_AS_OF_2 = _dt.datetime(2002, 1, 1)


def _keyed(df):
    return ST.with_article_key(df.withColumn("url_hash", U.url_hash(F.col("url"))).withColumn("padded_img", F.col("img")))


def _stored_articles(spark, base, feeds=None):
    feeds = feeds if feeds is not None else S.customer_feeds(spark, base)
    return ST.upsert_articles(None, _keyed(S.order_articles(spark, base, incoming=False)), feeds, STORE_AS_OF_1)


_KEYED_ORDERS_SQL = f"""
k AS (SELECT *, sha256(url) || sha256(trim(title)) AS article_key FROM ({S.ORDER_ARTICLES_SQL})),
s AS (SELECT article_key, arg_max(title, ord) AS title, arg_max(publish_time, ord) AS publish_time,
             arg_max(img, ord) AS img, arg_max(description, ord) AS description,
             arg_max(pop_score, ord) AS pop_score, arg_max(feed_id, ord) AS feed_id
      FROM k WHERE stored GROUP BY article_key),
i AS (SELECT article_key, arg_max(title, ord) AS title, arg_max(publish_time, ord) AS publish_time,
             arg_max(img, ord) AS img, arg_max(description, ord) AS description,
             arg_max(pop_score, ord) AS pop_score, arg_max(feed_id, ord) AS feed_id
      FROM k WHERE NOT stored GROUP BY article_key)"""

ARTICLE_UPSERT_SQL = f"""
WITH {_KEYED_ORDERS_SQL}
SELECT coalesce(s.article_key, i.article_key) AS article_key,
       CASE WHEN i.article_key IS NOT NULL THEN i.title ELSE s.title END AS title,
       strftime(CASE WHEN i.article_key IS NOT NULL THEN i.publish_time ELSE s.publish_time END, '%Y-%m-%d %H:%M:%S') AS publish_time,
       CASE WHEN s.article_key IS NOT NULL AND i.article_key IS NOT NULL
            THEN (CASE WHEN i.img <> '' THEN i.img ELSE s.img END)
            WHEN i.article_key IS NOT NULL THEN i.img ELSE s.img END AS img,
       CASE WHEN i.article_key IS NOT NULL THEN i.description ELSE s.description END AS description,
       round(CASE WHEN i.article_key IS NOT NULL THEN i.pop_score ELSE s.pop_score END, 6) AS pop_score,
       coalesce(s.feed_id, i.feed_id) AS feed_id,
       CASE WHEN s.article_key IS NULL THEN '2002-01-01 00:00:00' ELSE '1998-01-01 00:00:00' END AS created,
       CASE WHEN i.article_key IS NOT NULL THEN '2002-01-01 00:00:00' ELSE '1998-01-01 00:00:00' END AS modified
FROM s FULL OUTER JOIN i ON s.article_key = i.article_key"""


@register("article_upsert", ARTICLE_UPSERT_SQL)
def article_upsert(spark: SparkSession, base: str) -> DataFrame:
    """Two runs of the article upsert (SET7 + SET12): orders before 1998 load
    an empty store, later orders update hits (img kept when the new one is
    empty) and insert misses; audit columns per branch."""
    feeds = S.customer_feeds(spark, base)
    incoming = _keyed(S.order_articles(spark, base, incoming=True))
    out = ST.upsert_articles(_stored_articles(spark, base), incoming, feeds, STORE_AS_OF_2)
    return out.select(
        "article_key", "title", format_utc(F.col("publish_time")).alias("publish_time"), "img", "description",
        F.round("pop_score", 6).alias("pop_score"), "feed_id",
        format_utc(F.col("created")).alias("created"), format_utc(F.col("modified")).alias("modified"),
    )


KNOWN_SQL = f"""
WITH {_KEYED_ORDERS_SQL}
SELECT DISTINCT k.article_key, EXISTS (SELECT 1 FROM s WHERE s.article_key = k.article_key AND s.img <> '') AS known
FROM k WHERE NOT k.stored"""


@register("known_articles", KNOWN_SQL)
def known_articles(spark: SparkSession, base: str) -> DataFrame:
    """JOI4 + FLT16: incoming article keys split into known (stored with an
    image: reuse) and new (process), as semi and anti joins."""
    incoming = _keyed(S.order_articles(spark, base, incoming=True)).select("article_key").distinct()
    new, known = ST.split_known(incoming, _stored_articles(spark, base))
    return known.withColumn("known", F.lit(True)).unionByName(new.withColumn("known", F.lit(False)))


REMAINING_SQL = f"""
WITH {_KEYED_ORDERS_SQL}
SELECT s.article_key, s.title, strftime(s.publish_time, '%Y-%m-%d %H:%M:%S') AS publish_time
FROM s WHERE s.article_key NOT IN (SELECT article_key FROM i)"""


@register("remaining_articles", REMAINING_SQL)
def remaining_articles_q(spark: SparkSession, base: str) -> DataFrame:
    """JOI12 (QRY4): stored articles not in this run's published keys (anti join)."""
    published = _keyed(S.order_articles(spark, base, incoming=True)).select("article_key")
    r = ST.remaining_articles(_stored_articles(spark, base), published)
    return r.select("article_key", "title", format_utc(F.col("publish_time")).alias("publish_time"))


# --- cache hit percentages: SET8, SET9, AGG9, AGG10 ------------------------------
CACHE_SINCE = "2000-01-01 00:00:00"


def _cache_inputs(spark, base):
    o = read_table(spark, base, "orders")
    c = read_table(spark, base, "customer")
    n = read_table(spark, base, "nation")
    li = read_table(spark, base, "lineitem")
    article = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("feed_id"),
                       F.col("o_orderdate").cast("timestamp").alias("created"), "o_orderstatus")
    feed_locale = c.select(F.col("c_custkey").alias("feed_id"), F.col("c_nationkey").cast("long").alias("locale_id"))
    locale = n.select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("locale"))
    published = article.where(F.col("o_orderstatus") == "F").join(feed_locale, "feed_id") \
        .select(F.col("id").alias("article_id"), "locale_id")
    cache = ST.insert_cache_records(None, published)  # SET8
    hits = li.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("article_id")) \
        .join(published, "article_id")
    cache = ST.increment_cache_hits(cache, hits)  # SET9
    return article, cache, feed_locale, locale


_CACHE_SQL = """
pub AS (SELECT DISTINCT o_orderkey AS article_id, CAST(c_nationkey AS BIGINT) AS locale_id
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'),
today AS (SELECT o_orderkey AS article_id, CAST(c_nationkey AS BIGINT) AS locale_id
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '2000-01-01')"""

CACHE_LOCALE_SQL = f"""
WITH {_CACHE_SQL},
t AS (SELECT locale_id, count(*) AS total_articles FROM today GROUP BY locale_id),
h AS (SELECT p.locale_id, count(*) AS cache_hits FROM pub p
      WHERE EXISTS (SELECT 1 FROM today d WHERE d.article_id = p.article_id AND d.locale_id = p.locale_id)
      GROUP BY p.locale_id)
SELECT n_name AS locale, t.total_articles, coalesce(h.cache_hits, 0) AS cache_hits,
       round(coalesce(h.cache_hits, 0) / t.total_articles * 100.0, 6) AS hit_pct
FROM t LEFT JOIN h ON t.locale_id = h.locale_id JOIN nation ON n_nationkey = t.locale_id"""


@register("cache_hit_locale", CACHE_LOCALE_SQL)
def cache_hit_locale(spark: SparkSession, base: str) -> DataFrame:
    """Cache records inserted for published articles (SET8) and incremented per
    hit (SET9); per locale: records of articles created since the cut-off /
    articles created since the cut-off in the locale's feeds * 100 (AGG9)."""
    article, cache, feed_locale, locale = _cache_inputs(spark, base)
    since = F.lit(CACHE_SINCE).cast("timestamp")
    r = ST.cache_hit_percent(article, cache, since, feed_locale, locale)
    return r.select("locale", "total_articles", "cache_hits", F.round("hit_pct", 6).alias("hit_pct"))


CACHE_GLOBAL_SQL = f"""
WITH {_CACHE_SQL},
d AS (SELECT DISTINCT article_id FROM today)
SELECT (SELECT count(*) FROM d) AS total_articles,
       (SELECT count(*) FROM pub WHERE article_id IN (SELECT article_id FROM d)) AS cache_hits,
       round((SELECT count(*) FROM pub WHERE article_id IN (SELECT article_id FROM d)) / (SELECT count(*) FROM d) * 100.0, 6) AS hit_pct"""


@register("cache_hit_global", CACHE_GLOBAL_SQL)
def cache_hit_global(spark: SparkSession, base: str) -> DataFrame:
    """AGG10: the same ratio over all locales."""
    article, cache, _fl, _loc = _cache_inputs(spark, base)
    r = ST.cache_hit_percent(article, cache, F.lit(CACHE_SINCE).cast("timestamp"))
    return r.select("total_articles", "cache_hits", F.round("hit_pct", 6).alias("hit_pct"))


# --- run report, check, freshness, errors, high-water: AGG6-8, AGG13, SET11, TOP6 ----
from quillfeed.operators import quality as QL  # noqa: E402


def _feed_docs(spark, base):
    e = read_table(spark, base, "events")
    return e.select(
        F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/rss/"),
                 F.date_format("ts", "yyyy-MM-dd")).alias("feed_url"),
        F.lit(config.DEFAULT_MAX_ENTRIES).alias("max_entries"), "event_type", "event_id", "ts", "user_id", "value")


RUN_REPORT_SQL = """
SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/rss/' || strftime(ts, '%Y-%m-%d') AS feed_url,
       count(*) AS size_after_get, least(count(*), 20) AS size_after_insert
FROM events GROUP BY ALL"""


@register("run_report", RUN_REPORT_SQL)
def run_report_q(spark: SparkSession, base: str) -> DataFrame:
    """AGG6: per feed document entries parsed and entries attempted (first 20)."""
    return QL.run_report(_feed_docs(spark, base))


REPORT_CHECK_SQL = f"""
WITH r AS ({RUN_REPORT_SQL}),
v AS (SELECT feed_url, size_after_get, size_after_insert, unnest([
        CASE WHEN size_after_insert > size_after_get THEN 'inserted more than downloaded' END,
        CASE WHEN size_after_get = 0 THEN 'no posts downloaded' END,
        CASE WHEN size_after_insert = 0 THEN 'no posts inserted' END]) AS violation FROM r)
SELECT * FROM v WHERE violation IS NOT NULL"""


@register("report_check", REPORT_CHECK_SQL)
def report_check(spark: SparkSession, base: str) -> DataFrame:
    """AGG7: violations of the run report (empty = pass)."""
    return QL.report_violations(QL.run_report(_feed_docs(spark, base)))


FRESH_AS_OF = _dt.datetime(2024, 1, 31)
FRESHNESS_SQL = """
WITH f AS (SELECT 'feed.pub' || CAST(user_id AS VARCHAR) || '.json' AS file, max(ts) AS last_modified FROM events GROUP BY user_id),
x AS (SELECT file, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(last_modified)) / 1e6 > 3 * 3600 AS expired FROM f),
c AS (SELECT count(*) AS total, count(*) FILTER (WHERE expired) AS n_expired FROM x)
SELECT file, expired, CASE WHEN abs(total - n_expired) >= floor(total * 0.8) THEN 'success' ELSE 'expired' END AS status
FROM x, c"""


@register("freshness_status", FRESHNESS_SQL)
def freshness_status_q(spark: SparkSession, base: str) -> DataFrame:
    """AGG8: per published file expired if older than 3 h (as of 2024-01-31),
    overall success when fresh files >= floor(0.8 * total)."""
    e = read_table(spark, base, "events")
    files = e.groupBy("user_id").agg(F.max("ts").alias("last_modified")).select(
        F.concat(F.lit("feed.pub"), F.col("user_id").cast("string"), F.lit(".json")).alias("file"), "last_modified")
    return QL.freshness_status(files, files.select("file"), FRESH_AS_OF)


ERRORS_SQL = """
SELECT replace('pub' || CAST(user_id AS VARCHAR) || '.example.com', '.', '_') AS host_label,
       CASE WHEN value < 50 THEN 'download' ELSE 'parse' END AS kind, count(*) AS n
FROM events WHERE event_type = 'error' GROUP BY ALL"""


@register("error_counters", ERRORS_SQL)
def error_counters_q(spark: SparkSession, base: str) -> DataFrame:
    """AGG13: failures per host label (dots -> underscores) and kind."""
    d = _feed_docs(spark, base).where(F.col("event_type") == "error")
    f = d.select("feed_url", F.when(F.col("value") < 50, F.lit("download")).otherwise(F.lit("parse")).alias("kind"))
    return QL.error_counters(f)


HWM_SPLIT = "2024-01-15 00:00:00"
HWM_SQL = f"""
WITH a AS (SELECT user_id AS feed_id, max(ts) AS t FROM events WHERE ts < TIMESTAMP '{HWM_SPLIT}' GROUP BY 1),
b AS (SELECT user_id AS feed_id, max(ts) AS t FROM events WHERE ts >= TIMESTAMP '{HWM_SPLIT}' GROUP BY 1),
j AS (SELECT coalesce(a.feed_id, b.feed_id) AS feed_id,
             CASE WHEN b.t IS NOT NULL AND (a.t IS NULL OR b.t > a.t) THEN b.t ELSE a.t END AS t,
             CASE WHEN b.t IS NOT NULL AND (a.t IS NULL OR b.t > a.t) THEN {AS_OF} ELSE TIMESTAMP '{HWM_SPLIT}' END AS run_at
      FROM a FULL OUTER JOIN b ON a.feed_id = b.feed_id)
SELECT feed_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS last_build_time,
       round((epoch_us(run_at) - epoch_us(t)) / 1e6, 3) AS last_build_timedelta
FROM j"""


@register("feed_high_water", HWM_SQL)
def feed_high_water_q(spark: SparkSession, base: str) -> DataFrame:
    """SET11: two runs of the per-feed high-water mark (build times before and
    after Jan 15): newer builds replace the record and its lag, older ones are ignored."""
    e = read_table(spark, base, "events").select(F.col("user_id").alias("feed_id"), F.col("ts").alias("last_build_time"))
    split = F.lit(HWM_SPLIT).cast("timestamp_ntz")
    first = ST.feed_high_water(None, e.where(F.col("last_build_time") < split), _dt.datetime(2024, 1, 15))
    second = ST.feed_high_water(first, e.where(F.col("last_build_time") >= split), config.AS_OF)
    return second.select("feed_id", format_utc(F.col("last_build_time")).alias("last_build_time"),
                         F.round("last_build_timedelta", 3).alias("last_build_timedelta"))


LATEST_BUILD_SQL = """
SELECT user_id AS feed_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_build_time,
       arg_max(event_id, (ts, event_id)) AS record_id
FROM events GROUP BY user_id"""


@register("latest_build", LATEST_BUILD_SQL)
def latest_build_q(spark: SparkSession, base: str) -> DataFrame:
    """TOP6: newest build record per feed from a record history."""
    e = read_table(spark, base, "events").select(
        F.col("user_id").alias("feed_id"), F.col("ts").alias("last_build_time"), F.col("event_id").alias("record_id"))
    r = ST.latest_build(e)
    return r.select("feed_id", format_utc(F.col("last_build_time")).alias("last_build_time"), "record_id")


# --- page metadata extraction: JOI15 (+ PRJ19 resolution) -------------------------
from quillfeed.operators import icons as IC  # noqa: E402


def _sql_resolve(base: str, ref: str) -> str:
    # without dot segments, queries and fragments: the test tables hold none
    b_scheme, b_netloc, b_path = _sql_re(base, 2), _sql_re(base, 4), _sql_re(base, 5)
    b_dir = f"regexp_extract({b_path}, '^(.*/)', 1)"
    return (f"CASE WHEN {ref} = '' OR regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {ref} "
            f"WHEN starts_with({ref}, '//') THEN {b_scheme} || ':' || {ref} "
            f"WHEN starts_with({ref}, '/') THEN {b_scheme} || '://' || {b_netloc} || {ref} "
            f"ELSE {b_scheme} || '://' || {b_netloc} || (CASE WHEN {b_dir} = '' THEN '/' ELSE {b_dir} END) || {ref} END")


PAGE_LINKS_SQL = f"""
WITH t AS (SELECT page_id, url, regexp_extract_all(html, {_sql_str(IC.TAG_RE)}) AS tags FROM pages),
u AS (SELECT page_id, url, tags, unnest(generate_series(1, len(tags))) AS i FROM t),
v AS (SELECT page_id, url, i - 1 + {IC.CLASSES.index('link')} * {IC.CLASS_ROOM} AS pos,
             regexp_extract(tags[i], {_sql_str(r'''(?is)\bhref\s*=\s*["']([^"']*)["']''')}, 1) AS href FROM u
      WHERE regexp_matches(tags[i], '(?i)^<a\\b'))
SELECT page_id, 'link' AS class, 3 AS class_rank, pos, {_sql_resolve('url', 'href')} AS url
FROM v WHERE href <> ''"""


@register("page_links", PAGE_LINKS_SQL)
def page_links(spark: SparkSession, base: str) -> DataFrame:
    """JOI15 over whole pages: link/meta/anchor tags -> (page, class, pos, url)
    rows with references resolved against the page URL. The test pages carry no
    icon or open-graph markup, so the anchor class is what they produce."""
    p = read_table(spark, base, "pages")
    c = IC.page_candidates(p, with_links=True)
    return c.select("page_id", "class", F.col("class_rank").cast("int").alias("class_rank"),
                    F.col("pos").cast("long").alias("pos"), "url")


# --- streaming: STR1, STR2, STR5 over a file stream of the events table ------------
from quillfeed.streaming import incremental as STRM  # noqa: E402
from pyspark.sql import types as T  # noqa: E402


def _event_stream(spark, base):
    schema = read_table(spark, base, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(base)


STREAM_DEDUP_SQL = f"""
SELECT DISTINCT sha256(url) AS url_hash FROM ({S.ARTICLES_SQL})
WHERE publish_time >= TIMESTAMP '2024-02-01 01:00:00' - INTERVAL 60 DAY AND publish_time <= TIMESTAMP '2024-02-01 01:00:00'"""


@register("stream_dedup", STREAM_DEDUP_SQL)
def stream_dedup(spark: SparkSession, base: str) -> DataFrame:
    """STR1 + STR2: articles from the events file stream, late/future ones
    dropped by the 60-day/+1 h rule, repeats of a url_hash dropped within the
    60-day watermark (append mode, availableNow)."""
    e = _event_stream(spark, base)
    a = e.select(
        F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/news/"), F.col("event_type")).alias("url"),
        F.col("ts").cast("timestamp").alias("publish_time"),
    ).withColumn("url_hash", U.url_hash(F.col("url")))
    a = STRM.in_window(a, config.AS_OF)
    d = STRM.dedup_within_watermark(a, key="url_hash")
    out = STRM.shared_dir(spark, "dedup")
    STRM.run_to_parquet(d.select("url_hash"), out + "/data", out + "/ckpt", mode="append")
    return STRM.read_result(spark, out + "/data", "append", schema=T.StructType([T.StructField("url_hash", T.StringType())]))


# --- JOI3 + FLT7 + PRJ16/17: multi-hop URL resolution ---------------------------
URL_RESOLVE_SQL = """
SELECT l_orderkey, l_linenumber,
       'https://shop.example.com/c/' || CAST(o_custkey AS VARCHAR) || '/o/' || CAST(o_orderkey AS VARCHAR) AS url,
       sha256('https://shop.example.com/c/' || CAST(o_custkey AS VARCHAR) || '/o/' || CAST(o_orderkey AS VARCHAR)) AS url_hash
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE o_orderstatus <> 'P'"""


@register("url_resolve", URL_RESOLVE_SQL)
def url_resolve(spark: SparkSession, base: str) -> DataFrame:
    """Short links followed to the end of their redirect chains (the table is
    closed first, then joined once), failed and circular ones dropped (FLT7), url_hash of the final URL (PRJ17),
    final URL path re-encoded (PRJ16)."""
    r = clean.resolve_urls(S.short_links(spark, base), S.redirect_table(spark, base))
    return r.select("l_orderkey", "l_linenumber", "url", "url_hash")


# --- QRY8 chain over parsed entries -----------------------------------------------
from quillfeed.plans import feed_build as FB  # noqa: E402

LOCALE_FEEDS_SQL = """
WITH e AS (SELECT *, date_trunc('second', ts) AS t FROM events),
k AS (
  SELECT event_id AS ord, user_id,
         event_type || ' & more ' || CAST(event_id AS VARCHAR) AS title,
         'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/news/' || event_type || '/' || CAST(event_id AS VARCHAR) AS link,
         t
  FROM e
  WHERE event_type IN ('view', 'click', 'purchase')
    AND (user_id % 10 = 0
         OR (t >= TIMESTAMP '2024-01-20 01:00:00' - INTERVAL 60 DAY AND t <= TIMESTAMP '2024-01-20 01:00:00'))),
x AS (SELECT l.locale, k.* FROM k, (SELECT unnest(['en_US', 'de_DE']) AS locale) l),
r AS (SELECT *, row_number() OVER (PARTITION BY locale, user_id ORDER BY t DESC, ord ASC) AS variety_rank,
             (epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(t)) / 1000000.0 AS secs FROM x)
SELECT locale, sha256(link) AS url_hash, title, strftime(t, '%Y-%m-%d %H:%M:%S') AS publish_time,
       CAST(user_id AS VARCHAR) AS publisher_id, variety_rank,
       printf('%.9e', CASE WHEN secs > 0 THEN ln(secs) ELSE 0.1 END * pow(2.0, variety_rank)) AS score,
       1.0 AS pop_score
FROM r"""


@register("locale_feeds", LOCALE_FEEDS_SQL)
def locale_feeds(spark: SparkSession, base: str) -> DataFrame:
    """The per-locale feed build (QRY8) from parsed entries: JOI1 publishers x
    locales, TOP1, cleaning (FLT1-6), URL hash, popularity default and per-locale
    normalisation, scrub, then dedup/variety/score per locale in one job."""
    b = FB.build_from_entries(S.feed_entries(spark, base), S.feed_publishers(spark, base), as_of=CLEAN_AS_OF)
    return b.feed.select(
        "locale", "url_hash", "title", format_utc(F.col("publish_time")).alias("publish_time"), "publisher_id",
        # scores reach 2**k * ln(seconds); compare 10 significant digits
        F.col("variety_rank"), F.format_string("%.9e", F.col("score")).alias("score"),
        F.round("pop_score", 6).alias("pop_score"))


# --- SNK4 / SRC8 over the source rows ---------------------------------------------
FEED_MAP_SQL = f"""
WITH p AS ({S.SOURCE_PAIRS_SQL})
SELECT feed_url, arg_max(lang, (file, first_doc)) AS locale, arg_max(CAST(n_docs AS INTEGER), (file, first_doc)) AS rank,
       arg_max('Source ' || source, (file, first_doc)) AS publisher_name
FROM p GROUP BY feed_url"""


@register("source_feed_map", FEED_MAP_SQL)
def source_feed_map(spark: SparkSession, base: str) -> DataFrame:
    """SNK4: feed_url -> publisher row; a feed listed again later wins (by file, row)."""
    m = P.feed_source_map(_valid_sources(spark, base))
    return m.select("feed_url", "locale", "rank", "publisher_name")


DOMAINS_SQL = f"""
WITH p AS ({S.SOURCE_PAIRS_SQL}) SELECT DISTINCT site_url AS domain FROM p"""


@register("source_domains", DOMAINS_SQL)
def source_domains(spark: SparkSession, base: str) -> DataFrame:
    """SRC8 / AGG12: distinct domains over every source row."""
    return P.distinct_domains(_valid_sources(spark, base))


# --- FLT11-13, JOI14, PRJ27, PRJ28: image rules -----------------------------------------
IMAGE_RULES_SQL = """
WITH a AS (
  SELECT o_orderkey, 'https://shop.example.com/o/' || CAST(o_orderkey AS VARCHAR) AS url,
         CASE WHEN o_orderpriority = '5-LOW' THEN ''
              WHEN o_orderpriority = '1-URGENT' THEN 'https://img.example.com/' || CAST(o_orderkey AS VARCHAR) || '.mp4'
              ELSE 'https://img.example.com/' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS img,
         o_orderpriority = '2-HIGH' AS og_images
  FROM orders),
m AS (SELECT a.img AS url, CAST(trunc(o_totalprice / 1000) AS INTEGER) AS width, CAST(trunc(o_totalprice / 2000) AS INTEGER) AS height,
             CAST(trunc(o_totalprice * 5) AS BIGINT) AS bytes, o_orderstatus = 'F' AS cached
      FROM a JOIN orders ON a.o_orderkey = orders.o_orderkey WHERE a.img <> '' AND o_orderstatus <> 'P'),
p AS (SELECT 'https://shop.example.com/o/' || CAST(o_orderkey AS VARCHAR) AS url,
             'https://og.example.com/' || CAST(o_orderkey AS VARCHAR) || '.png' AS og_image
      FROM orders WHERE o_orderpriority IN ('5-LOW', '2-HIGH')),
j AS (SELECT a.*, m.width, m.height, m.bytes, m.cached, p.og_image FROM a LEFT JOIN m ON m.url = a.img LEFT JOIN p ON p.url = a.url),
s1 AS (SELECT *, img <> '' AS has,
              (ends_with(img, '.mp4') OR width IS NULL OR height IS NULL OR (width < 400 AND height < 400)) AS unusable FROM j),
s2 AS (SELECT *, has AND coalesce(bytes > 1000000, false) AS large,
              CASE WHEN NOT has OR unusable THEN '' ELSE img END AS img1 FROM s1),
s3 AS (SELECT *, CASE WHEN (img1 = '' OR og_images) AND coalesce(og_image, '') <> '' THEN og_image ELSE img1 END AS img2 FROM s2)
SELECT o_orderkey,
       CASE WHEN large AND NOT coalesce(cached, false) THEN '' ELSE img2 END AS img,
       CASE WHEN large AND coalesce(cached, false) THEN 'https://cdn.example.invalid/cache/' || sha256(img2) || '.jpg.pad'
            WHEN large THEN '' ELSE img2 END AS padded_img
FROM s3"""


@register("image_rules", IMAGE_RULES_SQL)
def image_rules(spark: SparkSession, base: str) -> DataFrame:
    """Image metadata rules in order: video suffix / unreadable / both sides <
    400 blank the image (FLT11, FLT12); og:image fills an empty image or
    replaces it for og publishers (JOI14); large images use the cached CDN
    copy or are blanked (FLT13, PRJ27, PRJ28)."""
    out = enrich.apply_image_rules(S.image_articles(spark, base), S.image_meta(spark, base), S.page_meta(spark, base))
    return out.select("o_orderkey", "img", "padded_img")


# --- QRY7: external channels with gate and augment channels ---------------------
EXT_CHANNELS_SQL = f"""
WITH tax AS (SELECT DISTINCT trim(value) AS category FROM ({S.TAXONOMY_SQL}) WHERE trim(value) <> ''),
rules AS ({S.TAXONOMY_RULES_SQL}),
r AS (SELECT * FROM rules WHERE NOT starts_with(pattern, '~')),
m AS (
  SELECT DISTINCT category, channel FROM (
    SELECT tax.category, r.channel FROM tax JOIN r ON ends_with(r.pattern, '*')
         AND starts_with(tax.category, substr(r.pattern, 1, length(r.pattern) - 1))
    UNION ALL
    SELECT pattern AS category, channel FROM r WHERE NOT ends_with(pattern, '*'))),
c AS ({S.CLASSIFICATIONS_SQL}),
h AS (SELECT c.article_key, m.channel FROM c JOIN m ON trim(c.name) = m.category WHERE c.confidence >= {config.CLASSIFICATION_FLOOR}),
g AS (SELECT article_key, list_sort(list_distinct(list(channel))) AS found FROM h GROUP BY article_key),
a AS ({S.ORDER_CHANNEL_ARTICLES_SQL}),
j AS (SELECT a.*, coalesce(g.found, []) AS found,
             list_has_any(a.channels, ['Fun']) OR length(coalesce(a.description, '') || coalesce(a.title, '')) < {config.MIN_TEXT_LEN} AS gated
      FROM a LEFT JOIN g ON a.article_key = g.article_key)
SELECT article_key,
       CASE WHEN gated THEN ''
            ELSE array_to_string(list_concat(found, list_filter(channels,
                 lambda x, i: list_contains(['Crypto', 'Culture', 'Top News', 'Top Sources'], x)
                              AND list_position(channels, x) = i)), '|') END AS ext_channels
FROM j"""


@register("external_channels", EXT_CHANNELS_SQL)
def external_channels_q(spark: SparkSession, base: str) -> DataFrame:
    """QRY7: classifier categories mapped through the taxonomy rules (JOI7,
    JOI8, FLT10, SET3); default-channel or short articles get no external
    channels; otherwise the article's augment channels follow the found ones."""
    mapping = enrich.expand_taxonomy(S.taxonomy_lines(spark, base), S.taxonomy_rules(spark, base))
    ext = enrich.classification_channels(S.classifications(spark, base), mapping)
    out = enrich.external_channels(S.order_channel_articles(spark, base), ext)
    return out.select("article_key", F.array_join("ext_channels", "|").alias("ext_channels"))


# --- QRY8 from raw RSS documents (SRC4 + FLT8 + the whole chain) --------------------
@register("xml_feeds", LOCALE_FEEDS_SQL)
def xml_feeds(spark: SparkSession, base: str) -> DataFrame:
    """The per-locale feed build from raw RSS documents: from_xml parse with
    positions (SRC4, FLT8), then the same chain as ``locale_feeds`` (JOI1,
    TOP1, cleaning, URL hash, per-locale popularity, scrub, dedup, variety,
    score). Time ties inside a publisher are broken by the documents' order and
    the position in the document."""
    b = FB.build_locale_feeds(S.feed_documents(spark, base), S.feed_publishers(spark, base), as_of=CLEAN_AS_OF)
    return b.feed.select(
        "locale", "url_hash", "title", format_utc(F.col("publish_time")).alias("publish_time"), "publisher_id",
        F.col("variety_rank"), F.format_string("%.9e", F.col("score")).alias("score"),
        F.round("pop_score", 6).alias("pop_score"))


# --- QRY3 / QRY4 over the shop store ----------------------------------------------
QRY3_LOCALE = "NATION_3"


def _shop_store(spark, base):
    from quillfeed.sources.lookups import COVER_VALUE
    from pyspark.sql import types as T

    good, _bad = P.split_valid(P.type_source_rows(S.customer_source_rows(spark, base)))
    fav = spark.createDataFrame([], "domain string, favicon_url string")
    cov = spark.createDataFrame([], T.StructType([T.StructField("domain", T.StringType())] + COVER_VALUE.fields))
    nested = P.nest_locales(P.attach_lookups(good, fav, cov)).withColumn("ord", F.struct("publisher_name", "publisher_id"))
    return ST.normalize_publishers(nested, as_of=config.AS_OF)


_SHOP_SQL = f"""
WITH {_KEYED_ORDERS_SQL},
shop AS (SELECT c_custkey, c_mktsegment, n_name FROM customer JOIN nation ON CAST(c_nationkey AS INTEGER) = CAST(n_nationkey AS INTEGER))"""

QRY3_SQL = f"""{_SHOP_SQL},
keys AS (SELECT DISTINCT article_key FROM i)
SELECT s.article_key, s.title, s.img, 'Shop ' || CAST(s.feed_id AS VARCHAR) AS publisher_name,
       sha256('https://shop' || CAST(s.feed_id AS VARCHAR) || '.example.com/rss') AS publisher_id,
       CASE WHEN shop.n_name = '{QRY3_LOCALE}' THEN shop.c_mktsegment ELSE '' END AS channels
FROM s JOIN shop ON shop.c_custkey = s.feed_id
WHERE s.img <> '' AND s.article_key IN (SELECT article_key FROM keys)"""


@register("stored_articles", QRY3_SQL)
def stored_articles_q(spark: SparkSession, base: str) -> DataFrame:
    """QRY3: incoming keys looked up in the stored articles (JOI4, FLT16),
    returned as feed records with the publisher reached through the feed
    (JOI11) and the feed's channels in one locale (JOI10, AGG4); store tables
    loaded from per-customer source rows (SET4-6)."""
    t = _shop_store(spark, base)
    keys = _keyed(S.order_articles(spark, base, incoming=True)).select("article_key")
    r = ST.stored_articles(_stored_articles(spark, base, t["feed"]), keys, t, QRY3_LOCALE)
    return r.select("article_key", "title", "img", "publisher_name", "publisher_id",
                    F.array_join("channels", "|").alias("channels"))


QRY4_SQL = f"""{_SHOP_SQL}
SELECT s.article_key, s.title, 'Shop ' || CAST(s.feed_id AS VARCHAR) AS publisher_name, shop.c_mktsegment AS channels
FROM s JOIN shop ON shop.c_custkey = s.feed_id
WHERE s.article_key NOT IN (SELECT article_key FROM i)"""


@register("remaining_with_channels", QRY4_SQL)
def remaining_with_channels_q(spark: SparkSession, base: str) -> DataFrame:
    """QRY4: stored articles not published this run (JOI12) with their feed's
    channels across all locales and the publisher through the feed."""
    t = _shop_store(spark, base)
    published = _keyed(S.order_articles(spark, base, incoming=True)).select("article_key")
    r = ST.remaining_with_channels(_stored_articles(spark, base, t["feed"]), published, t)
    return r.select("article_key", "title", "publisher_name", F.array_join("channels", "|").alias("channels"))


# --- FLT15 and AGG7 over rows that break their rules --------------------------------
QUARANTINE_SQL = """
SELECT 'sources.' || n_name || '.csv' AS file, c_custkey AS row_no,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'Title: must contain a value'
            WHEN 'AUTOMOBILE' THEN 'Feed: invalid or missing URL'
            WHEN 'MACHINERY' THEN 'Rank: not a valid integer'
            ELSE 'Destination Domains: must contain a value|Score: not a valid number' END AS errors
FROM customer JOIN nation ON CAST(c_nationkey AS INTEGER) = CAST(n_nationkey AS INTEGER)
WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')"""


@register("quarantined_sources", QUARANTINE_SQL)
def quarantined_sources(spark: SparkSession, base: str) -> DataFrame:
    """FLT15: source rows that fail validation, with every failed rule."""
    _good, bad = P.split_valid(P.type_source_rows(S.flawed_source_rows(spark, base)))
    return bad.select("file", "row_no", F.array_join("errors", "|").alias("errors"))


BROKEN_REPORT_SQL = """
WITH r AS (SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/rss' AS feed_url,
                  count(*) FILTER (event_type = 'view') AS size_after_get,
                  count(*) FILTER (event_type = 'click') AS size_after_insert FROM events GROUP BY user_id)
SELECT *, 'inserted more than downloaded' AS violation FROM r WHERE size_after_insert > size_after_get
UNION ALL SELECT *, 'no posts downloaded' FROM r WHERE size_after_get = 0
UNION ALL SELECT *, 'no posts inserted' FROM r WHERE size_after_insert = 0"""


@register("report_violations", BROKEN_REPORT_SQL)
def report_violations_q(spark: SparkSession, base: str) -> DataFrame:
    """AGG7 on a report that breaks its rules: one row per feed and broken rule."""
    return QL.report_violations(S.uneven_report(spark, base))


# Further queries, by subject; each module registers its own.
from quillfeed.plans import stream_queries  # noqa: E402, F401
from quillfeed.plans import text_queries  # noqa: E402, F401
from quillfeed.plans import media_queries  # noqa: E402, F401
from quillfeed.plans import feed_queries  # noqa: E402, F401
from quillfeed.plans import publish_queries  # noqa: E402, F401
