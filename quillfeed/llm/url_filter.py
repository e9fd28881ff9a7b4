"""URL filter (operator 5): allow and block rules, then a list of blocked URLs
behind a blocked Bloom filter.

Listed URLs are brought to a canonical form and put into a Bloom filter made of
512-bit blocks: one hash names the block, eight six-bit slices of a second hash
set one bit in each of the block's eight 64-bit words. The filter is built by a
grouped ``bit_or`` and is a table of at most ``blocks`` rows of nine longs, so
it has a size bound whatever the list's length and is broadcast. A page whose
canonical URL misses a bit is certainly not listed. The others, the possible
hits, go to an exact hash join with the list, which removes false positives. A
list too long for the number of blocks only makes the exact join larger.

Only possible hits and the list are shuffled; the page scan reads two columns.

Defined results: a null URL, or one without ``://``, has empty host and path,
fits no rule and is never listed; null entries of the list are ignored; null
and repeated page_ids give a row per input row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path); fixed values of the task.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCKS = 16_384  # 512-bit blocks: 1 MB of filter
WORDS = 8


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """host and path without scheme, ``www.``, fragment, trailing slashes and
    ``utm_`` parameters, other parameters sorted; null if there is no host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, tail))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule (a longer host first
    among equally long ones), else null. ``rules`` is a short list of literals."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit("bits"))
    six = [F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), s) for s in six]


def bloom_filter(listed: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """Rows (block, w0..w7) of the filter over column ``canonical`` of ``listed``."""
    key = F.col("canonical")
    hashed = listed.select(_block(key, blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(key))])
    return hashed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, blocks: int = BLOCKS,
                default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict, possible_hit (by the Bloom filter) and
    listed (by the exact join) for each row of ``pages`` (page_id, url).
    ``listed`` has the blocked URLs in column ``url``."""
    url = F.col("url")
    keys = listed.select(canonical(url).alias("canonical")).where("canonical is not null").distinct()
    bits = bloom_filter(keys, blocks)
    judged = pages.select(
        F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
        canonical(url).alias("__key"),
    ).withColumn("__rule", matched_rule(F.col("host"), F.col("path"), rules)).withColumn("__block", _block(F.col("__key"), blocks))
    # At most `blocks` rows of nine longs: the broadcast has a fixed bound.
    probed = judged.join(F.broadcast(bits), judged["__block"] == bits["block"], "left")
    hit = F.lit(True)
    for i, mask in enumerate(_masks(F.col("__key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    probed = probed.select("page_id", "host", "path", "__rule", "__key", F.coalesce(hit, F.lit(False)).alias("possible_hit"))
    exact = keys.select(F.col("canonical").alias("__listed"))
    possible = probed.where("possible_hit").join(exact, F.col("__key") == F.col("__listed"), "left")
    out = possible.unionByName(probed.where("not possible_hit").withColumn("__listed", F.lit(None).cast("string")))
    is_listed = F.col("__listed").isNotNull()
    return out.select(
        "page_id", "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(is_listed, F.lit("block")).otherwise(F.lit(default))).alias("verdict"),
        "possible_hit", is_listed.alias("listed"))
