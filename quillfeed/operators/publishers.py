"""Publisher source lists: typing, validation, lookups and nesting
(PRJ1-7, FLT15, JOI2, AGG5, SNK3/SNK4 shapes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillfeed import config
from quillfeed.functions import text as TX
from quillfeed.functions import urls as U

# --- fixed values: CSV header -> field (aliases of the source model) ----------
HEADER_ALIASES = {
    "Status": "enabled",
    "Title": "publisher_name",
    "Category": "category",
    "Domain": "site_url",
    "Feed": "feed_url",
    "Score": "score",
    "Destination Domains": "destination_domains",
    "Original_Feed": "original_feed",
    "OG-Images": "og_images",
    "Creative Instance ID": "creative_instance_id",
    "Content Type": "content_type",
    "Channels": "channels",
    "Rank": "rank",
}
# Keys written by the per-locale build (feed_source map) and the sources list.
FEED_INCLUDE = ("category", "publisher_name", "content_type", "publisher_domain", "publisher_id", "max_entries",
                "og_images", "creative_instance_id", "channels", "feed_url", "site_url", "destination_domains")
SOURCES_INCLUDE = ("enabled", "publisher_name", "category", "site_url", "feed_url", "favicon_url", "cover_url",
                   "background_color", "score", "channels", "rank", "publisher_id", "destination_domains")
GLOBAL_INCLUDE = ("enabled", "publisher_name", "category", "site_url", "feed_url", "favicon_url", "cover_url",
                  "background_color", "score", "destination_domains", "locales", "publisher_id")
# ---------------------------------------------------------------------------


def _raw(df: DataFrame, header: str) -> Column:
    """Trimmed + scrubbed raw CSV value (NULL when the column is absent)."""
    if header not in df.columns:
        return F.lit(None).cast("string")
    return F.trim(TX.scrub_html(F.col(f"`{header}`")))


def _nz(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _web_url(u: Column) -> Column:
    """http(s) URL whose host is a dotted name ending in a 2-63 letter top-level
    domain, or an IPv4 address (what a web-URL validator accepts)."""
    host = U.url_host(u)
    named = host.rlike(r"^([A-Za-z0-9_-]+\.)+[A-Za-z]{2,63}\.?$")
    ipv4 = host.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    return U.is_http_url(u) & F.coalesce(named | ipv4, F.lit(False))


def _split_list(c: Column) -> Column:
    """PRJ6: ';' separated, items trimmed; empty -> []."""
    return F.when(_nz(c).isNull(), F.array().cast("array<string>")).otherwise(
        F.transform(F.split(c, ";"), lambda x: F.trim(x)))


def type_source_rows(raw: DataFrame) -> DataFrame:
    """PRJ1-7 + FLT15 errors column over raw all-string CSV rows.

    ``raw`` has the CSV headers plus ``locale``, ``file`` and ``row_no``.
    The result keeps every row; ``errors`` lists failed validations."""
    site, feed = _raw(raw, "Domain"), _raw(raw, "Feed")
    title, dest = _raw(raw, "Title"), _raw(raw, "Destination Domains")
    orig = _raw(raw, "Original_Feed")
    score, rank = _nz(_raw(raw, "Score")), _nz(_raw(raw, "Rank"))
    errors = F.filter(
        F.array(
            F.when(_nz(title).isNull(), F.lit("Title: must contain a value")),
            F.when(_nz(dest).isNull(), F.lit("Destination Domains: must contain a value")),
            F.when(~_web_url(site), F.lit("Domain: invalid or missing URL")),
            F.when(~_web_url(feed), F.lit("Feed: invalid or missing URL")),
            F.when(score.isNotNull() & score.try_cast("double").isNull(), F.lit("Score: not a valid number")),
            F.when(rank.isNotNull() & rank.try_cast("int").isNull(), F.lit("Rank: not a valid integer")),
        ),
        lambda e: e.isNotNull(),
    )
    return raw.select(
        F.col("locale"), F.col("file"), F.col("row_no"),
        F.coalesce(_raw(raw, "Status") == "Enabled", F.lit(False)).alias("enabled"),  # PRJ3
        title.alias("publisher_name"),
        _raw(raw, "Category").alias("category"),
        site.alias("site_url"),
        feed.alias("feed_url"),
        F.coalesce(_nz(_raw(raw, "Score")).try_cast("double"), F.lit(0.0)).alias("score"),  # PRJ4
        F.transform(F.split(dest, ";"), lambda x: F.trim(x)).alias("destination_domains"),  # PRJ6
        _nz(orig).alias("original_feed"),
        F.coalesce(_raw(raw, "OG-Images") == "On", F.lit(False)).alias("og_images"),  # PRJ3
        F.lit(config.DEFAULT_MAX_ENTRIES).alias("max_entries"),  # PRJ4
        F.coalesce(_raw(raw, "Creative Instance ID"), F.lit("")).alias("creative_instance_id"),  # T1
        F.coalesce(_nz(_raw(raw, "Content Type")), F.lit("article")).alias("content_type"),
        F.sha2(F.coalesce(_nz(orig), feed), 256).alias("publisher_id"),  # PRJ7
        _split_list(_raw(raw, "Channels")).alias("channels"),  # PRJ6
        _nz(_raw(raw, "Rank")).try_cast("int").alias("rank"),  # PRJ5
        errors.alias("errors"),
    )


def split_valid(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """FLT15: (good, quarantine). The per-locale build aborts on any bad row
    (``fail_on_invalid``); the global build logs and skips (quarantine)."""
    good = typed.where(F.size("errors") == 0).drop("errors")
    bad = typed.where(F.size("errors") > 0)
    return good, bad


def fail_on_invalid(bad: DataFrame) -> None:
    """Per-locale build semantics: raise if any row failed validation."""
    first = bad.select("file", "row_no", "errors").limit(1).collect()
    if first:
        r = first[0]
        raise ValueError(f"invalid source row {r['file']}:{r['row_no']}: {list(r['errors'])}")


def attach_lookups(pubs: DataFrame, favicons: DataFrame, covers: DataFrame, key: str = "site_url") -> DataFrame:
    """JOI2: favicon and cover/background by domain; missing -> NULLs.
    Lookup maps are keyed one row per domain, so the joins never multiply rows."""
    fav = favicons.select(F.col("domain").alias(key), "favicon_url").dropDuplicates([key])
    cov = covers.select(F.col("domain").alias(key), "cover_url", "background_color").dropDuplicates([key])
    return pubs.join(fav, key, "left").join(cov, key, "left")


def nest_locales(rows: DataFrame) -> DataFrame:
    """AGG5: one row per publisher_id; the first row (by file, row number)
    supplies the attributes; every row appends {locale, channels, rank} in
    file order. ``min_by`` / ``collect_list`` of a sorted struct - partial
    aggregation keeps a hot publisher bounded per task."""
    attrs = [c for c in rows.columns if c not in ("publisher_id", "locale", "channels", "rank", "file", "row_no")]
    order = F.struct(F.col("file"), F.col("row_no"))
    agg = rows.groupBy("publisher_id").agg(
        F.min_by(F.struct(*attrs), order).alias("_a"),
        F.sort_array(F.collect_list(F.struct(F.col("file"), F.col("row_no"), F.col("locale"), F.col("channels"),
                                             F.col("rank")))).alias("_l"),
    )
    return agg.select(
        "publisher_id", "_a.*",
        F.transform("_l", lambda x: F.struct(x["locale"].alias("locale"), x["channels"].alias("channels"),
                                             x["rank"].alias("rank"))).alias("locales"),
    )


def feed_source_map(rows: DataFrame) -> DataFrame:
    """SNK4: feed_url -> publisher; on a repeated feed URL the *last* row wins."""
    payload = [c for c in rows.columns if c != "feed_url"]
    return rows.groupBy("feed_url").agg(
        F.max_by(F.struct(*payload), F.struct(F.col("file"), F.col("row_no"))).alias("_r")
    ).select("feed_url", "_r.*")


def distinct_domains(rows: DataFrame, col: str = "site_url") -> DataFrame:
    """SRC8 / AGG12: distinct domains across all source rows."""
    return rows.select(F.col(col).alias("domain")).where(F.col("domain").isNotNull()).distinct()
