"""Registered queries of the text and date rules whose inputs the driver tables do
not hold as they are: dates in many layouts, markup with attributes, a word list of
real size. The SQL states the expected values and shares no pattern with the rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed.functions import text as TX
from quillfeed.functions.timeparse import format_utc, parse_feed_time
from quillfeed.operators import clean
from quillfeed.plans.registry import register
from quillfeed.sources.tables import read_table

# --- PRJ13: every layout, and what no layout fits --------------------------------------
# How event k writes its time (a date pattern, a suffix, the minutes its clock is ahead of UTC) and, in SQL, what of
# the time is left. Forms without a pattern are fixed texts that are no date.
DATE_FORMS = (
    ("EEE, dd MMM yyyy HH:mm:ss", " +0000", 0, "second"), ("MMM d, yyyy h:mm a", "", 0, "minute"),
    ("EEEE, MMMM d, yyyy h:mm a", " EST", -300, "minute"), ("EEE MMM d HH:mm:ss yyyy", "", 0, "second"),
    ("yyyy/MM/dd", "", 0, "day"), ("epoch", "", 0, "second"), ("yyyy-MM-dd'T'HH:mm:ss.SSS", "Z", 0, "second"),
    ("d MMMM yyyy H:mm:ss", "", 0, "second"), ("MM/dd/yyyy HH:mm", "", 0, "minute"),
    ("yyyy-MM-dd HH:mm:ss", " +05:30", 330, "second"), ("dd-MMM-yyyy", "", 0, "day"), ("epoch", "000", 0, "second"),
    (None, "not a date", 0, None), (None, "2024-02-30", 0, None), (None, "31 Foo 2024", 0, None), (None, "", 0, None),
)


def _written(k: int, ts: Column) -> Column:
    pattern, suffix, ahead, _ = DATE_FORMS[k]
    if pattern is None:
        return F.lit(suffix)
    if pattern == "epoch":
        return F.concat(F.unix_seconds(ts).cast("string"), F.lit(suffix))
    return F.concat(F.date_format(ts + F.expr(f"INTERVAL '{ahead}' MINUTE"), pattern), F.lit(suffix))


def dated_entries(spark: SparkSession, base: str) -> DataFrame:
    """One entry per event, its time written in the layout that its id picks; every
    second entry has it as ``published``."""
    e = read_table(spark, base, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    form = F.col("event_id") % len(DATE_FORMS)
    text = F.lit(None).cast("string")
    for k in range(len(DATE_FORMS)):
        text = F.when(form == k, _written(k, F.col("ts"))).otherwise(text)
    late = (F.col("event_id") / len(DATE_FORMS)).cast("long") % 2 == 1
    return e.select("event_id", F.concat(F.lit("https://pub"), F.col("user_id").cast("string"), F.lit(".example.com/rss")).alias("feed_url"),
                    F.when(late, F.lit("")).otherwise(text).alias("updated"), F.when(late, text).alias("published"),
                    F.lit(None).cast("string").alias("feed_updated"), F.lit(None).cast("string").alias("feed_published"))


_FORM = f"event_id % {len(DATE_FORMS)}"
FEED_DATES_SQL = (
    "SELECT event_id, strftime(CASE " + _FORM + " "
    + " ".join(f"WHEN {k} THEN date_trunc('{f[3]}', ts)" for k, f in enumerate(DATE_FORMS) if f[3])
    + " END, '%Y-%m-%d %H:%M:%S') AS publish_time FROM events")


@register("feed_dates", FEED_DATES_SQL)
def feed_dates(spark: SparkSession, base: str) -> DataFrame:
    """PRJ12 + PRJ13: entry times in twelve layouts, and four texts that are none."""
    d = dated_entries(spark, base)
    return d.select("event_id", format_utc(parse_feed_time(clean.raw_time())).alias("publish_time"))


DATE_REJECTS_SQL = (
    "SELECT 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/rss' AS feed_url, CASE " + _FORM + " "
    + " ".join(f"WHEN {k} THEN nullif('{f[1]}', '')" for k, f in enumerate(DATE_FORMS) if f[0] is None)
    + f" END AS raw, count(*) AS n FROM events WHERE {_FORM} >= {next(k for k, f in enumerate(DATE_FORMS) if f[0] is None)} GROUP BY ALL")


@register("date_rejects", DATE_REJECTS_SQL)
def date_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Entries that FLT5 loses, counted by feed and by the text that fits no layout."""
    return clean.rejected_times(dated_entries(spark, base))


# --- PRJ8: attributes -------------------------------------------------------------------
# Markup of a page by its id, and what scrubbing leaves of it; {id} and {url} stand for the page's.
SCRUB_CASES = (
    ('<a title="{id} > b" href="https://x.example/{id}">k</a>', '<a href="https://x.example/{id}" title="{id} > b">k</a>'),
    ('<abbr title="Hyper {id}" class="c">H</abbr>', '<abbr title="Hyper {id}">H</abbr>'),
    ('<div data-x="1 > 0"><em class="x">{id}</em></div>', "<em>{id}</em>"),
    ('<a href="javascript:go({id})">j</a> & <A HREF=/rel/{id}>r</A>', '<a>j</a> & <a href="/rel/{id}">r</a>'),
    ("<a data-y=\"href='https://no.example/'\" href='mailto:m{id}@x.example'>m</a>", '<a href="mailto:m{id}@x.example">m</a>'),
    ("{id} < 5 &amp; 6 > 2<!-- <b>{id}</b> -->", "{id} &lt; 5 & 6 &gt; 2"),
    ('<script>var t = {id};</script><acronym title=A{id}>a</acronym>', 'var t = {id};<acronym title="A{id}">a</acronym>'),
    ('<h1>{id}</h1><ul><li id="i">x<li>y</ul><br/>', "{id}<ul><li>x<li>y</ul>"),
)


def _filled(template: str) -> Column:
    parts = template.split("{id}")
    id_ = F.col("page_id").cast("string")
    return F.concat(*[c for k, p in enumerate(parts) for c in ([F.lit(p)] if k == 0 else [id_, F.lit(p)])])


SCRUB_SQL = (
    f"SELECT page_id, replace(CASE page_id % {len(SCRUB_CASES)} "
    + " ".join(f"WHEN {k} THEN '{want}'" for k, (_, want) in enumerate(SCRUB_CASES))
    + " END, '{id}', CAST(page_id AS VARCHAR)) || '|' || url AS scrubbed FROM pages")


@register("scrub_attributes", SCRUB_SQL)
def scrub_attributes(spark: SparkSession, base: str) -> DataFrame:
    """PRJ8 on markup with quoted attributes, links of several schemes, comments and
    bare angle brackets; the SQL lists the strings that must come out."""
    p = read_table(spark, base, "pages")
    html = F.lit(None).cast("string")
    for k, (given, _) in enumerate(SCRUB_CASES):
        html = F.when(F.col("page_id") % len(SCRUB_CASES) == k, _filled(given)).otherwise(html)
    return p.select("page_id", F.concat(TX.scrub_html(html), F.lit("|"), "url").alias("scrubbed"))


# --- FLT2: a word list as a table -----------------------------------------------------
_WORDS = "regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9_]+')"
LISTED_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, unnest(list_distinct(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])))) AS entry FROM d),
l AS (SELECT DISTINCT w FROM (
  SELECT unnest(w) AS w FROM d UNION ALL SELECT w[1] || ' ' || w[2] FROM d WHERE len(w) > 1) WHERE length(w) >= 5 AND md5(w) < '10')
SELECT doc_id, count(*) AS n_listed, min(entry) AS first_listed FROM g WHERE entry IN (SELECT w FROM l) GROUP BY doc_id"""


def word_list(spark: SparkSession, base: str) -> DataFrame:
    """A list of some thousand words and two-word phrases drawn from the texts by
    their hash; the phrases are written with other signs between their words."""
    w = read_table(spark, base, "documents").select(TX.words_of(F.col("text")).alias("w"))
    # Words and pair in one array: a text is read and cut once, and only its different words are hashed.
    pair = F.when(F.size("w") > 1, F.array(F.array_join(F.slice("w", 1, 2), " "))).otherwise(F.array().cast("array<string>"))
    each = w.select(F.explode(F.array_distinct(F.concat("w", pair))).alias("w"))
    drawn = each.where((F.length("w") >= 5) & (F.md5(F.col("w").cast("binary")) < "10")).distinct()
    return drawn.select(F.upper(F.replace("w", F.lit(" "), F.lit(" - "))).alias("word"))


@register("listed_words", LISTED_SQL)
def listed_words(spark: SparkSession, base: str) -> DataFrame:
    """FLT2 over whole texts with a word list as a table: one equality join of the
    texts' words and word pairs with the list."""
    docs = read_table(spark, base, "documents")
    return clean.flag_listed_words(docs, "doc_id", "text", word_list(spark, base))
