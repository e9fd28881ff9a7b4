"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillfeed.llm import (
    alignment,
    bpe,
    exact_dedup,
    licenses,
    line_dedup,
    ngram_join,
    packing,
    prefix_trie,
    quality,
    topk,
    toxicity,
    url_filter,
    wrapper,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


@register("op2_byte_bpe")
def op2_byte_bpe(spark: SparkSession, base: str) -> DataFrame:
    """Encode every whole text, decode the ids, and return digests of both."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digest_documents(table(spark, base, "documents"), path, public_tokenizers.PATTERN)


def _template_rows() -> str:
    rows = []
    for n, t in enumerate(licenses.TEMPLATES):
        words, key = (", ".join(f"'{w}'" for w in x) for x in (t.words, t.key_words))
        rows.append(f"({n}, '{t.label}', {str(t.base).lower()}, [{words}], [{key}], {t.key_at})")
    return ", ".join(rows)


OP3_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w,
         row_number() OVER () AS r
  FROM documents),
t(n, label, base, words, key, key_at) AS (VALUES {_template_rows()}),
s AS (
  SELECT d.r, d.w, t.*, unnest(list_filter(range(len(d.w)), lambda i: d.w[i + 1] = t.key[1]
           AND d.w[i + 1 : i + len(t.key)] = t.key)) - t.key_at AS start
  FROM d, t WHERE list_contains(d.w, t.key[1])),
m AS (
  SELECT r, label, base, start,
         len(list_filter(range(len(words)), lambda j: start + j >= 0 AND w[start + j + 1] = words[j + 1])) / len(words) AS score
  FROM s),
g AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
         list_sort(list(DISTINCT label) FILTER (base)) AS bl, list_sort(list(DISTINCT label)) AS al, max(score) AS score
  FROM m WHERE base OR score >= {licenses.MIN_SCORE} GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(bl, ','), '') AS base_labels, coalesce(array_to_string(al, ','), '') AS labels,
       coalesce(score, 0.0) AS score
FROM d LEFT JOIN g ON d.r = g.r"""


@register("op3_license_scan", OP3_SQL)
def op3_license_scan(spark: SparkSession, base: str) -> DataFrame:
    """Licence templates found in every whole text by their rarest words."""
    found = licenses.scan_documents(table(spark, base, "documents"))
    basic = F.filter("matches", lambda m: m["base"])
    starts = F.transform(basic, lambda m: m["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform(basic, lambda m: m["label"])))
    return found.select(
        "doc_id", "n_words", F.size(basic).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["score"])), F.lit(0.0)).alias("score"))


@register("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, base: str) -> DataFrame:
    """Base counts and the line-first verdict for every whole text."""
    return quality.judge_documents(table(spark, base, "documents")).drop("text_kept")


# Host name parts that stand for the operator of a blocklist in the stand-in below.
LISTED_HOSTS = ("ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def listed_urls(spark: SparkSession, base: str) -> DataFrame:
    """Stand-in blocklist: the URLs of all pages on five named hosts, as they
    come (not canonical, with repeats)."""
    pages = table(spark, base, "pages")
    return pages.where(F.col("url").rlike("|".join(LISTED_HOSTS))).select("url")


def _sql_url(column: str) -> dict[str, str]:
    host = f"translate(regexp_extract(coalesce({column}, ''), '(?s)^.*?://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}')"
    path = f"regexp_extract(coalesce({column}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    query = f"regexp_extract(coalesce({column}, ''), '(?s)^.*?://[^?#]*\\?([^#]*)', 1)"
    kept = f"list_sort(list_filter(string_split({query}, '&'), lambda p: p <> '' AND NOT starts_with(p, 'utm_')))"
    canon = (f"CASE WHEN regexp_replace({host}, '^www\\.', '') <> '' THEN regexp_replace({host}, '^www\\.', '')"
             f" || regexp_replace({path}, '/+$', '')"
             f" || CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END END")
    return {"host": host, "path": path, "canonical": canon}


_U = _sql_url("url")
_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_filter.RULES)
OP5_SQL = f"""
WITH u AS (SELECT page_id, {_U['host']} AS host, {_U['path']} AS path, {_U['canonical']} AS canon, row_number() OVER () AS r FROM pages),
l AS (SELECT DISTINCT {_U['canonical']} AS canon FROM pages WHERE regexp_matches(url, '{'|'.join(LISTED_HOSTS)}')),
rules(verdict, host, path) AS (VALUES {_RULE_ROWS}),
f AS (SELECT u.r, arg_max({{'rule': rules.host || rules.path, 'verdict': rules.verdict}},
                          (length(rules.host || rules.path), length(rules.host))) AS best
      FROM u JOIN rules ON (u.host = rules.host OR ends_with(u.host, '.' || rules.host)) AND starts_with(u.path, rules.path)
      GROUP BY u.r)
SELECT page_id, u.host, u.path, f.best.rule AS rule,
       coalesce(f.best.verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       l.canon IS NOT NULL AS listed
FROM u LEFT JOIN f ON u.r = f.r LEFT JOIN l ON u.canon = l.canon"""


@register("op5_url_filter", OP5_SQL)
def op5_url_filter(spark: SparkSession, base: str) -> DataFrame:
    """Allow and block rules, then the listed URLs behind a blocked Bloom filter."""
    return url_filter.filter_urls(table(spark, base, "pages"), listed_urls(spark, base)).drop("possible_hit")


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, base: str) -> DataFrame:
    """Train on rows that are not held out, score every whole text."""
    docs = table(spark, base, "documents")
    model = toxicity.fit(docs, table(spark, base, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op10_pack_sequences")
def op10_pack_sequences(spark: SparkSession, base: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, base, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


OP9_SQL = """
WITH v AS (
  SELECT vec_id, max(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v, true), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q, v d WHERE q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5"""


@register("op9_exact_top_k", OP9_SQL)
def op9_exact_top_k(spark: SparkSession, base: str) -> DataFrame:
    """The five best inner products of every 50th vector against all others."""
    return topk.top_k(table(spark, base, "embeddings"))


@register("op7_main_text")
def op7_main_text(spark: SparkSession, base: str) -> DataFrame:
    """Main text of every page by its host's induced wrapper."""
    return wrapper.extract_main_text(table(spark, base, "pages"))


@register("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Lines of templates that recur across documents dropped from all but the first."""
    kept = line_dedup.dedup_lines(table(spark, base, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars_kept"),
                       F.sha2("text", 256).alias("text_sha256"))


OP8_SQL = """
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g FROM t),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS sh FROM s),
rare AS (SELECT doc_id, n, sh, row_number() OVER (PARTITION BY doc_id ORDER BY f, sh) AS k
         FROM (SELECT *, count(*) OVER (PARTITION BY sh) AS f FROM x)),
pre AS (SELECT doc_id, n, sh FROM rare WHERE k <= n - ceil(0.9 * n) + 1.000001),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM pre a JOIN pre b ON a.sh = b.sh AND a.doc_id < b.doc_id
      AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM c JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b
      WHERE 100 * len(list_intersect(p.g, q.g)) >= 90 * (len(p.g) + len(q.g) - len(list_intersect(p.g, q.g)))),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT s.doc_id, len(s.g) AS n_shingles, min(r.reach) AS component_id FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id, len(s.g)"""


@register("op8_ngram_jaccard", OP8_SQL)
def op8_ngram_jaccard(spark: SparkSession, base: str) -> DataFrame:
    """Components of documents that share 90 % of their 3-word shingles."""
    return ngram_join.near_duplicates(table(spark, base, "documents"))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT c.conv_id, t.k, t.role, t.text FROM c JOIN t ON t.conv_id = c.base WHERE t.k <= c.h
  UNION ALL SELECT c.conv_id, t.k + c.h, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id WHERE t.k > c.h),
s AS (
  SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.k) FILTER (r.k IS NOT NULL), []) AS seq
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS depth FROM s),
n AS (
  SELECT depth, seq[1:depth] AS prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CASE WHEN len(seq) = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends
  FROM p GROUP BY depth, prefix),
k AS (SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
v AS (
  SELECT n.depth, n.prefix, coalesce(k.n_children, 0) AS n_children,
         CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.prefix[n.depth].text, '[^\x20\x09-\x0D]+')) END AS saving
  FROM n LEFT JOIN k ON k.depth = n.depth AND k.prefix = n.prefix),
a AS (SELECT up AS depth, prefix[1:up] AS prefix, n_children, saving FROM (SELECT *, unnest(range(depth + 1)) AS up FROM v)),
w AS (SELECT depth, prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saving)::BIGINT AS saved_tokens FROM a GROUP BY depth, prefix)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, v.n_children, w.n_leaves, w.saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN v ON v.depth = n.depth AND v.prefix = n.prefix JOIN w ON w.depth = n.depth AND w.prefix = n.prefix
LEFT JOIN n u ON u.depth = n.depth - 1 AND u.prefix = n.prefix[1:n.depth - 1]"""


@register("op11_conversation_trie", OP11_SQL)
def op11_conversation_trie(spark: SparkSession, base: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.conversation_trie(table(spark, base, "conversations"))


OP12_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (
  SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g"""


@register("op12_exact_dedup", OP12_SQL)
def op12_exact_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Groups of documents with equal texts by the names of their blocks."""
    found = exact_dedup.dedup_documents(table(spark, base, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@register("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, base: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies in every whole text."""
    return alignment.align_documents(table(spark, base, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))
