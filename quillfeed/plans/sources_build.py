"""Entry 2: build the source lists.

SRC2 -> SRC3 -> PRJ1-8 -> FLT15 -> JOI2 -> AGG5 -> SNK5, plus the per-locale
SNK3 list and SNK4 feed map, and the store load (SET6).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillfeed.operators import publishers as P
from quillfeed.operators import store as ST


@dataclass
class SourcesBuild:
    rows: DataFrame          # typed, valid rows (one per CSV row)
    quarantine: DataFrame    # rows failing validation, with errors
    global_sources: DataFrame  # AGG5 nested, sorted by name (SNK5)
    feed_map: DataFrame      # SNK4 per locale: feed_url -> publisher (last row wins)
    sources_list: DataFrame  # SNK3 per locale, sorted by name
    domains: DataFrame       # SRC8 / AGG12


def build_sources(raw: DataFrame, favicons: DataFrame, covers: DataFrame) -> SourcesBuild:
    typed = P.type_source_rows(raw)
    good, bad = P.split_valid(typed)
    # JOI2: the per-locale build keys on the raw Domain, the global build on
    # the cleaned site url; both are the trimmed Domain value here.
    enriched = P.attach_lookups(good, favicons, covers)
    nested = P.nest_locales(enriched).orderBy("publisher_name", "publisher_id")
    keep = [c for c in P.FEED_INCLUDE if c in enriched.columns and c != "feed_url"]
    feed_map = enriched.groupBy("locale", "feed_url").agg(  # SNK4 per locale: last row wins
        F.max_by(F.struct(*keep), F.struct("file", "row_no")).alias("_r")).select("locale", "feed_url", "_r.*")
    lst = enriched.select("locale", *P.SOURCES_INCLUDE).orderBy("locale", "publisher_name")
    return SourcesBuild(rows=enriched, quarantine=bad,
                        global_sources=nested.select(*[c for c in P.GLOBAL_INCLUDE if c in nested.columns]),
                        feed_map=feed_map, sources_list=lst, domains=P.distinct_domains(good))


def load_store(sources: SourcesBuild, existing=None, as_of=None):
    """SET6: nested sources (in name order = load order) into the six tables."""
    nested = sources.global_sources.withColumn("ord", F.struct("publisher_name", "publisher_id"))
    return ST.normalize_publishers(nested, existing=existing, as_of=as_of)
