"""URL filters (operator 10): allow and block rules, then a list of URLs that
a blocked Bloom filter and an exact hash join look up. DataFrame functions only.

The filter is a table of words of 64 bits: a URL's hash picks one word, and
four more groups of its bits set or test bits of that word, so a test reads one
row. It has one word for ``LOAD`` listed URLs, by which about one of 100 other
URLs is a possible hit, whatever the list's length. Up to ``MAX_WORDS`` words it
is broadcast; a larger one is partitioned by word, and so are the URLs that no
rule decides. Hits go on to an exact join with the list, which removes the
false positives.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.llm.storage import stored

LOAD = 4  # listed URLs per 64-bit word of the filter
MAX_WORDS = 1 << 21  # a larger filter is not broadcast: 32 MB of words and bits
BITS = 4  # bits per URL

# Fixed values: (verdict, host, path) of the rules.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# Query parameters that do not change the page.
TRACKING = "utm_[a-z]*|ref|fbclid|gclid"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """Behind the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """host + path + sorted query: no scheme, www. or m. label, default port,
    index page, closing slash, tracking parameter or fragment; null without ://."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"/index\.html?$", "/"), r"/+$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda q: ~q.rlike(rf"^(({TRACKING})(=.*)?)?$")))
    return F.when(F.instr(url, "://") > 0,
                  F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def rule_verdict(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does. A rule
    fits its host and all subdomains if the path starts with the rule's; rules
    of one length go by their order."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is tested first
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _word_and_mask(key: Column, blocks: int) -> tuple[Column, Column]:
    """The filter word that a key falls into and the bits it has there: from
    one 64-bit hash, six bits per test and the rest for the word."""
    h = F.xxhash64(key)
    mask = F.lit(0).cast("bigint")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS), F.lit(blocks)), mask


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Blocked Bloom filter of a column: (word, bits), at most ``blocks`` rows."""
    word, mask = _word_and_mask(F.col(key), blocks)
    return listed.where(F.col(key).isNotNull()).groupBy(word.alias("word")).agg(F.bit_or(mask).alias("bits"))


def filter_urls(df: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
                max_words: int = MAX_WORDS) -> DataFrame:
    """Judge every URL: a rule decides where one fits, else the list does.

    ``listed``: column url, the URLs to block, as canonical URLs. Returns
    ``id_col``, host, path, rule, verdict (allow or block). A null URL or one
    without :// has an empty host and path, fits no rule and is on no list:
    allow. Repeated rows are judged each, null ids stay null, other columns
    are not read; an empty list blocks nothing, an empty table gives no row.
    """
    keys = stored(listed.select(canonical(F.col("url")).alias("key")).where("key is not null").distinct(), "listed")
    blocks = max(1, math.ceil(keys.count() / LOAD))
    words = bloom(keys, "key", blocks)
    urls = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    judged = (urls.select("id", host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("key"))
              .select("id", "host", "path", "key", rule.alias("rule"), verdict.alias("verdict")))
    word, mask = _word_and_mask(F.col("key"), blocks)
    # What no word can decide goes to a word of its own hash that no filter has, not all to one.
    spread = -1 - F.pmod(F.xxhash64("id", "path"), F.lit(1 << 20))
    asked = judged.withColumn("word", F.when(F.col("verdict").isNull() & F.col("key").isNotNull(), word).otherwise(spread))
    tested = (asked.join(F.broadcast(words) if blocks <= max_words else words, "word", "left")
              .withColumn("possible", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)))
              .select("id", "host", "path", "rule", "verdict", "possible", F.when(F.col("possible"), F.col("key")).alias("key")))
    # Urls are read, parsed and tested once; of the stored rows only possible hits are shuffled to the exact join.
    tested = stored(tested, "tested")
    out = [F.col("id").alias(id_col), "host", "path", "rule"]
    hits = tested.where("possible").join(keys.withColumn("listed", F.lit(True)), "key", "left").select(
        *out, F.when(F.col("listed"), "block").otherwise("allow").alias("verdict"))
    others = tested.where("not possible").select(*out, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    return hits.unionByName(others)
