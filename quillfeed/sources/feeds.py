"""SRC4: RSS 2.0, RSS 1.0 and Atom documents -> one row per entry (FLT8, FLT14, TOP1 positions).

Documents arrive as a table ``(feed_url, content)`` (a file drop read with
``binaryFile``/``wholetext``, or a table of fetched bodies). ``from_xml``
parses each document with a fixed superset schema; a key missing from an item
is simply NULL. Entry positions come from ``posexplode`` (document order), so
"first N entries" needs no sort or window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed import config

_MEDIA = "array<struct<_url:string,_width:string,_height:string>>"
_MEDIA_FIELDS = (f"`media:content`:{_MEDIA}, `media:thumbnail`:{_MEDIA}, "
                 f"`media:group`:struct<`media:content`:{_MEDIA}, `media:thumbnail`:{_MEDIA}>")
_ITEM = (
    "array<struct<title:string, link:string, description:string, pubDate:string, "
    "`dc:date`:string, guid:struct<_VALUE:string,_isPermaLink:string>, category:array<string>, "
    f"{_MEDIA_FIELDS}, "
    "enclosure:array<struct<_url:string,_type:string,_length:string>>, "
    "`content:encoded`:string>>"
)
RSS_SCHEMA = f"channel struct<title:string, link:string, pubDate:string, lastBuildDate:string, item:{_ITEM}>"
RDF_SCHEMA = f"channel struct<title:string, link:string, `dc:date`:string>, item {_ITEM}"  # RSS 1.0: items beside the channel
ATOM_SCHEMA = (
    "title string, updated string, published string, "
    "entry array<struct<title:string, link:array<struct<_href:string,_rel:string>>, "
    "updated:string, published:string, summary:string, content:string, "
    "category:array<struct<_term:string>>, "
    f"{_MEDIA_FIELDS}>>"
)

ENTRY_COLUMNS = ("feed_url", "pos", "title", "link", "url", "updated", "published", "feed_updated", "feed_published",
                 "description", "summary", "content_html", "image", "urlToImage", "media_content",
                 "media_thumbnail", "enclosures", "item_category")


def read_feed_files(spark: SparkSession, path: str, url_from_name: bool = True) -> DataFrame:
    """STR6/SRC4 input: a folder of downloaded feed documents -> (feed_url, content, length).

    The length comes from the file listing; the content of an oversize document
    (FLT14) is not decoded, and ``parse_documents`` reports it."""
    df = spark.read.format("binaryFile").load(path)
    key = F.regexp_extract(F.col("path"), r"([^/]+)$", 1) if url_from_name else F.col("path")
    content = F.when(F.col("length") <= config.MAX_FEED_BYTES, F.decode(F.col("content"), "UTF-8"))
    return df.select(key.alias("feed_url"), content.alias("content"), "length")


def _media(i, name: str):
    """An entry's own media elements, then those inside its ``media:group``; NULL when it has none."""
    own, grouped = i[name], i["media:group"][name]
    both = F.when(own.isNull(), grouped).when(grouped.isNull(), own).otherwise(F.concat(own, grouped))
    return F.transform(both, lambda m: F.struct(m["_url"].alias("url"), m["_width"].alias("width")))


def _rss_link(i):
    """The link, or the guid unless it is marked as no permalink."""
    guid = F.when(F.coalesce(F.lower(F.trim(i["guid"]["_isPermaLink"])), F.lit("true")) != "false", F.trim(i["guid"]["_VALUE"]))
    return F.coalesce(F.nullif(i["link"], F.lit("")), F.nullif(guid, F.lit("")))


ROOT_RSS_RE = r"(?s)^\s*(<\?[^>]*>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<rss\b"
ROOT_RDF_RE = ROOT_RSS_RE.replace("<rss", "<rdf:RDF")
ROOT_ATOM_RE = r"(?s)<feed\b"


def _rss_entry(i):
    return F.struct(
        i["title"].alias("title"), _rss_link(i).alias("link"), F.lit(None).cast("string").alias("url"),
        i["dc:date"].alias("updated"), i["pubDate"].alias("published"),
        i["description"].alias("description"), i["description"].alias("summary"),
        i["content:encoded"].alias("content_html"),
        _media(i, "media:content").alias("media_content"), _media(i, "media:thumbnail").alias("media_thumbnail"),
        F.transform(i["enclosure"], lambda x: F.struct(x["_url"].alias("href"), x["_type"].alias("type"),
                                                       x["_length"].alias("length"))).alias("enclosures"),
        F.try_element_at(i["category"], F.lit(1)).alias("item_category"),
    )


def _atom_entry(i):
    alt = F.filter(i["link"], lambda l: F.coalesce(l["_rel"], F.lit("alternate")) == "alternate")
    return F.struct(
        i["title"].alias("title"),
        F.coalesce(F.try_element_at(alt, F.lit(1))["_href"], F.try_element_at(i["link"], F.lit(1))["_href"]).alias("link"),
        F.lit(None).cast("string").alias("url"),
        i["updated"].alias("updated"), i["published"].alias("published"),
        i["summary"].alias("description"), i["summary"].alias("summary"), i["content"].alias("content_html"),
        _media(i, "media:content").alias("media_content"), _media(i, "media:thumbnail").alias("media_thumbnail"),
        F.lit(None).cast("array<struct<href:string,type:string,length:string>>").alias("enclosures"),
        F.try_element_at(i["category"], F.lit(1))["_term"].alias("item_category"),
    )


OVERSIZE, EMPTY, UNPARSABLE, NO_ENTRIES = "oversize", "empty", "unparsable", "no_entries"  # kinds of failures
ROOM = 1 << 20  # positions in a document; its bytes are limited to ten times that


def parse_documents(docs: DataFrame, max_bytes: int = config.MAX_FEED_BYTES) -> DataFrame:
    """SRC4 for a mixed table in one pass, one row per document: the root element
    picks the RSS 2.0, RSS 1.0 or Atom schema, and all are mapped to one entry shape
    in ``entries``. ``kind`` says why a document has none, and is NULL for the others:

    * ``oversize``: more than ``max_bytes`` bytes, by the ``length`` column where there is one (FLT14)
    * ``empty``: nothing but white space, or NULL
    * ``unparsable``: another root element, or XML that is broken anywhere (FLT8)
    * ``no_entries``: well formed, but without an entry (FLT8)

    ``doc_ord`` puts the documents in order; without such a column a hash of the
    content stands for it."""
    doc = F.col("doc_ord").cast("long") if "doc_ord" in docs.columns else F.shiftright(F.xxhash64("feed_url", "content"), 20)
    length = F.col("length") if "length" in docs.columns else F.octet_length("content")
    d = docs.select(
        "feed_url", doc.alias("doc_ord"), F.coalesce(length > max_bytes, F.lit(False)).alias("_big"), "content")
    content = F.when(~F.col("_big"), F.col("content"))
    root = (F.when(content.rlike(ROOT_RSS_RE), F.lit("rss")).when(content.rlike(ROOT_RDF_RE), F.lit("rdf"))
            .when(content.rlike(ROOT_ATOM_RE), F.lit("atom")))
    d = d.select("feed_url", "doc_ord", "_big", content.alias("content"), root.alias("_kind"))

    def parsed(kind: str, schema: str, tag: str):
        found = F.from_xml("content", f"{schema}, _broken string", {"rowTag": tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
        return F.when(F.col("_kind") == kind, found)

    p = d.select("feed_url", "doc_ord", "_big", "_kind", F.length(F.trim(F.regexp_replace("content", r"^\s+", ""))).alias("_n"),
                 parsed("rss", RSS_SCHEMA, "rss").alias("r"), parsed("rdf", RDF_SCHEMA, "rdf:RDF").alias("d"),
                 parsed("atom", ATOM_SCHEMA, "feed").alias("a"))
    entries = F.coalesce(F.transform(F.coalesce(F.col("r.channel.item"), F.col("d.item")), _rss_entry),
                         F.transform(F.col("a.entry"), _atom_entry))
    broken = F.coalesce("r._broken", "d._broken", "a._broken").isNotNull()
    none = F.coalesce(F.size(entries), F.lit(0)) <= 0
    kind = (F.when(F.col("_big"), F.lit(OVERSIZE)).when(F.coalesce(F.col("_n"), F.lit(0)) == 0, F.lit(EMPTY))
            .when(F.col("_kind").isNull() | broken & none, F.lit(UNPARSABLE)).when(none, F.lit(NO_ENTRIES)))
    return p.select(
        "feed_url", "doc_ord", kind.alias("kind"),
        F.coalesce(F.col("r.channel.lastBuildDate"), F.col("d.channel.`dc:date`"), F.col("a.updated")).alias("feed_updated"),
        F.coalesce(F.col("r.channel.pubDate"), F.col("a.published")).alias("feed_published"), entries.alias("entries"))


def entries_of(parsed: DataFrame) -> DataFrame:
    """One row per entry of parsed documents, with its position in the document
    (TOP1) and ``ord``, which puts the documents in order, then the positions."""
    e = parsed.where("kind is null").select("feed_url", "doc_ord", "feed_updated", "feed_published", F.posexplode("entries").alias("pos", "i"))
    return e.select(
        "feed_url", "pos", "i.title", "i.link", "i.url", "i.updated", "i.published", "feed_updated", "feed_published",
        "i.description", "i.summary", "i.content_html",
        F.lit(None).cast("string").alias("image"), F.lit(None).cast("string").alias("urlToImage"),
        "i.media_content", "i.media_thumbnail", "i.enclosures", "i.item_category",
        (F.col("doc_ord") * ROOM + F.col("pos")).alias("ord"),
    )


def failures_of(parsed: DataFrame) -> DataFrame:
    """FLT8 + FLT14: one row per document without entries, with its kind, also where
    the same feed has a good document."""
    return parsed.where("kind is not null").select("feed_url", "doc_ord", "kind")


def parse_feeds(docs: DataFrame, max_bytes: int = config.MAX_FEED_BYTES) -> DataFrame:
    """Entries of all documents; those that fail to parse or hold no entry give none (FLT8)."""
    return entries_of(parse_documents(docs, max_bytes))


def failed_documents(docs: DataFrame, max_bytes: int = config.MAX_FEED_BYTES) -> DataFrame:
    """FLT8 side output: one row per document without entries."""
    return failures_of(parse_documents(docs, max_bytes))


def first_entries(entries: DataFrame, max_entries_col: str = "max_entries") -> DataFrame:
    """TOP1: the first max_entries entries of each document by position (no sort)."""
    return entries.where(F.col("pos") < F.coalesce(F.col(max_entries_col), F.lit(config.DEFAULT_MAX_ENTRIES)))
