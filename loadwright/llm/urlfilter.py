"""URL verdicts from host and path rules and a list of blocked canonical URLs.

Rules and listed URLs are both entries (host, path).  A URL's possible entries
are its host and every domain above it, with each prefix of its path that is as
long as some rule's path, and its canonical form for the list.  A blocked Bloom
filter over all entries (each key sets its bits in one 64-bit block) passes the
possible hits; an exact hash join with the entries removes false positives.

The filter has at most ``MAX_BLOCKS`` words, so what is broadcast has a fixed
bound; a longer list makes it pass more, which the join then removes.  Verdicts
are found once per distinct (host, path), so repeated URLs cost one row, and no
group is gathered in one task.

Defined results: a null URL, or one without ``://``, has an empty host and path,
matches no rule and is allowed unless listed; repeated pages are judged each;
empty tables give empty results; of rules for one (host, path) the blocking one
wins.  Only the id and URL columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import settle

BITS_PER_KEY = 16
HASHES = 6
MAX_BLOCKS = 1 << 17  # of 64 bits: 1 MB of filter

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without a closing slash."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.lit("/"), F.regexp_replace(F.regexp_replace(path, "/+$", ""), "^/", ""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> Column:
    """The bits of a key within its block."""
    h = F.xxhash64(F.lit(HASHES), key)
    out = F.lit(0).cast("long")
    for i in range(HASHES):
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 10 * i).bitwiseAND(F.lit(63).cast("long")).cast("int")))
    return out


def bloom_blocks(keys: DataFrame, column: str = "key") -> tuple[DataFrame, int]:
    """The filter as rows (block, bits) and its number of blocks, a power of two."""
    n = keys.count()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 64 < n * BITS_PER_KEY:
        blocks *= 2
    filled = keys.select(_block(F.col(column), blocks).alias("block"), _bits(F.col(column)).alias("bits"))
    return filled.groupBy("block").agg(F.bit_or("bits").alias("bits")), blocks


def may_contain(rows: DataFrame, column: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be in the filter (none that is gets lost)."""
    bits = bloom.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    own = _bits(F.col(column))
    return rows.join(F.broadcast(bits), (_block(F.col(column), blocks) == F.col("_block"))
                     & (F.col("_bits").bitwiseAND(own) == own), "left_semi")


def _rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("r|"), host, F.lit("|"), path)


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for every row of ``pages``.

    ``rules``: host, path, verdict.  ``listed``: url, the canonical URLs to block
    where no rule says otherwise.  The longest rule wins (host, then path).
    """
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect() if r[0] is not None)
    entries = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict")).select(
        _rule_key(F.col("rule_host"), F.col("rule_path")).alias("key"), F.concat("rule_host", "rule_path").alias("rule"), "verdict",
        F.length("rule_host").alias("host_size"), F.length("rule_path").alias("path_size"))
    marks = listed.where("url IS NOT NULL").select(F.concat(F.lit("u|"), "url").alias("key")).distinct().select(
        "key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"), F.lit(0).alias("host_size"), F.lit(0).alias("path_size"))
    entries = settle(entries.unionByName(marks), "url-entries")
    bloom, blocks = bloom_blocks(entries)

    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    distinct = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)), lambda p: p.isNotNull())
    keys = F.flatten(F.transform(domains, lambda d: F.transform(prefixes, lambda p: _rule_key(d, p)))) if lengths else F.array().cast("array<string>")
    own = F.array(F.concat(F.lit("u|"), canonical(F.col("host"), F.col("path"))))
    asked = distinct.select("host", "path", F.explode(F.concat(keys, own)).alias("key"))
    hits = may_contain(asked, "key", bloom, blocks).join(entries, "key")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct("host_size", "path_size", "rule", "verdict"))).alias("best")
    found = hits.groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(best, F.max(F.col("rule").isNull()).alias("listed"))
    return urls.join(found, (urls["host"] == found["h"]) & (urls["path"] == found["p"]), "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("listed"), "block"), F.lit("allow")).alias("verdict"), F.coalesce("listed", F.lit(False)).alias("listed"))
