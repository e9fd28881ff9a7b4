"""QRY8: build every locale's feed in one job.

documents -> SRC4 parse (FLT8) -> JOI1 publishers -> TOP1 first N -> clean
(FLT1-6, PRJ9-24) -> JOI3 resolve + PRJ16/17 -> PRJ18 key -> JOI4 known/new
-> new: JOI5/AGG1/PRJ29 popularity, AGG2/3 normalise, JOI6 predictions
(listed locales), FLT11-13/JOI14/PRJ28 images, PRJ8 scrub -> SET1 union known
-> SRT2/WIN1/WIN2/SRT1 per locale.

Locale is a column: each feed entry is joined to every locale its feed is
listed in, and all dedup/rank keys include the locale, so all locales are
built by one set of shuffles instead of one process per locale.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.operators import clean, enrich, quality, rank, store
from quillfeed.sources import feeds
from quillfeed.session import cut_lineage

PUBLISHER_COLUMNS = ("feed_url", "locale", "publisher_id", "publisher_name", "category", "site_url", "content_type",
                     "creative_instance_id", "channels", "max_entries", "og_images")
FEED_COLUMNS = ("locale", "title", "publish_time", "img", "padded_img", "category", "description", "content_type",
                "publisher_id", "publisher_name", "channels", "creative_instance_id", "url", "url_hash", "pop_score",
                "score")
STORED_COLUMNS = ("title", "publish_time", "img", "padded_img", "category", "description", "content_type", "creative_instance_id",
                  "url", "url_hash", "pop_score", "score")


@dataclass
class FeedBuild:
    feed: DataFrame          # ranked articles per locale (SNK1 rows)
    report: DataFrame        # AGG6 per feed
    failures: DataFrame      # FLT8 documents
    new_articles: DataFrame  # processed this run (input of SET7 / SET8)
    known: DataFrame         # reused from the store (JOI4)


def build_locale_feeds(
    docs: DataFrame,
    publishers: DataFrame,
    as_of: _dt.datetime,
    stored: DataFrame | None = None,
    counters: DataFrame | None = None,
    predictions: DataFrame | None = None,
    predict_locales: tuple = ("en_US",),
    image_meta: DataFrame | None = None,
    page_meta: DataFrame | None = None,
    redirects: DataFrame | None = None,
    profanity: tuple = config.PROFANITY_CUSTOM_WORDS,
    cdn_base: str = "https://cdn.example.invalid/cache",
) -> FeedBuild:
    # Entries and failures come from one parse, written once.
    parsed = cut_lineage(feeds.parse_documents(docs))
    entries, failures = feeds.entries_of(parsed), feeds.failures_of(parsed)
    return build_from_entries(entries, publishers, as_of, stored=stored, counters=counters, predictions=predictions,
                              predict_locales=predict_locales, image_meta=image_meta, page_meta=page_meta,
                              redirects=redirects, profanity=profanity, cdn_base=cdn_base, failures=failures)


def build_from_entries(
    entries: DataFrame,
    publishers: DataFrame,
    as_of: _dt.datetime,
    stored: DataFrame | None = None,
    counters: DataFrame | None = None,
    predictions: DataFrame | None = None,
    predict_locales: tuple = ("en_US",),
    image_meta: DataFrame | None = None,
    page_meta: DataFrame | None = None,
    redirects: DataFrame | None = None,
    profanity: tuple = config.PROFANITY_CUSTOM_WORDS,
    cdn_base: str = "https://cdn.example.invalid/cache",
    failures: DataFrame | None = None,
) -> FeedBuild:
    """QRY8 from parsed entries (``feed_url``, ``pos`` and the SRC4 columns; an
    ``ord`` column, when present, is the input order used to break time ties)."""
    pubs = publishers.select(*PUBLISHER_COLUMNS)
    report = quality.run_report(  # AGG6 per (feed, locale)
        entries.select("feed_url").join(pubs.select("feed_url", "locale", "max_entries"), "feed_url"),
        group_cols=("locale",))

    # Cleaning reads only the entry plus content_type and site_url of its
    # publisher row, so each entry is cleaned, resolved and keyed once per
    # distinct (feed, content_type, site_url) - not once per listed locale.
    ck = F.xxhash64("content_type", "site_url")  # null-safe key of the attributes cleaning reads
    clean_keys = pubs.groupBy("feed_url", "content_type", "site_url").agg(
        F.max(F.coalesce("max_entries", F.lit(config.DEFAULT_MAX_ENTRIES))).alias("_first_n"))
    # at most one row per publisher row; Spark picks the join by its real size
    pre = entries.join(clean_keys, "feed_url").where(F.col("pos") < F.col("_first_n")).drop("_first_n")
    if "ord" not in pre.columns:
        pre = pre.withColumn("ord", F.xxhash64("feed_url", "pos"))
    arts = clean.entries_to_articles(pre, as_of=as_of, profanity=profanity, time_filter=False)
    arts = clean.resolve_urls(arts, redirects)  # JOI3, PRJ16, PRJ17
    arts = store.with_article_key(arts)  # PRJ18
    # The cleaned articles feed several branches (known/new split, per-locale
    # popularity bounds, prediction locales): materialise them once in the
    # shared checkpoint folder instead of re-running the cleaning per branch.
    # The time window (FLT5/FLT6) then filters the stored column, so the date
    # parse runs once per entry rather than once more inside the filter.
    arts = cut_lineage(arts)
    arts = arts.where(clean.time_window_keep(F.col("publish_time"), F.col("content_type"), as_of))
    # JOI1: every listed locale of the feed, then TOP1 with that row's max_entries
    locale_rows = pubs.withColumn("_ck", ck).drop("content_type", "site_url")
    arts = arts.withColumn("_ck", ck).join(locale_rows, ["feed_url", "_ck"]).drop("_ck")
    arts = feeds.first_entries(arts).drop("pos", "max_entries")

    if stored is not None:
        # JOI4 + FLT16 as one left join: a row with a usable stored article is known and
        # carries it. Written once, as both branches read it.
        both = cut_lineage(store.with_stored(arts, stored, STORED_COLUMNS))
        new = both.where("_stored is null").drop("_stored")
        known = both.where("_stored is not null").select(
            "locale", "article_key", "publisher_id", "publisher_name", "channels", "ord", "_stored.*")
    else:
        new, known = arts, None

    sums = enrich.popularity_sums(counters) if counters is not None else None  # AGG1
    if sums is not None:
        new = enrich.attach_popularity(new, sums).drop("pop_raw")  # JOI5 + PRJ29
    else:
        new = new.withColumn("pop_score", F.lit(1.0))
    new = rank.normalize_popularity(new, "pop_score", group_cols=("locale",))  # AGG2 + AGG3 per locale run (new only)

    if predictions is not None:  # JOI6 + FLT9 + PRJ31, only for the listed locales
        top = enrich.top_prediction(predictions)
        listed = F.coalesce(F.col("locale").isin(*predict_locales), F.lit(False))
        new = enrich.apply_prediction(new, top, only=listed).drop("pred_name", "pred_confidence")

    if image_meta is not None:
        new = enrich.apply_image_rules(new, image_meta, page_meta, cdn_base=cdn_base)
    else:
        new = new.withColumn("padded_img", F.col("img"))

    new = clean.scrub_strings(new, skip=("url", "url_hash", "img", "padded_img", "publisher_id", "article_key",
                                         "locale", "link"))  # PRJ8
    new = new.withColumn("score", F.lit(0.0))

    cols = [*FEED_COLUMNS, "article_key", "ord"]
    union = new.select(*cols)
    if known is not None:
        union = union.unionByName(known.select(*cols))  # SET1
    ranked = rank.rank_articles(union.drop("score"), as_of=as_of, group_cols=("locale",))
    out = ranked.select(*FEED_COLUMNS, "article_key", "pos_ts", "pos_ord", "variety_rank")
    if failures is None:
        failures = entries.limit(0).select("feed_url").withColumn("kind", F.lit(""))
    return FeedBuild(feed=out, report=report, failures=failures, new_articles=new,
                     known=known if known is not None else new.limit(0))

