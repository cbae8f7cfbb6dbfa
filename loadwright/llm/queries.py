"""The registered queries of this package and their DuckDB SQL.

Each query applies its operator with production parameters to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.llm import (
    decontam, kdshard, langid, packing, pii, prefix_trie, quality, simhash, token_counts, toxicity, urlfilter, wavelet, whitening,
)
from loadwright.llm.common import table

#: Host and path rules of the URL query (fixed values).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Host labels whose pages' canonical URLs make the block list (fixed values).
BLOCKED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]


def op1_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.read_documents(wavelet.write_shards(table(spark, sf_dir, "documents")))


def op2_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    host, path = urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url"))
    bad = host.rlike(r"(^|\.)(" + "|".join(BLOCKED_LABELS) + r")(\.|$)")
    listed = pages.where(bad).select(urlfilter.canonical(host, path).alias("url"))
    return urlfilter.judge(pages, spark.sql(f"SELECT * FROM VALUES {rules} AS t(host, path, verdict)"), listed)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_kdshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kdshard.assign(table(spark, sf_dir, "documents"), shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_wavelet, op2_urls, op3_language, op4_simhash, op5_packing, op6_kdshard, op7_toxicity, op8_decontam,
                            op9_quality, op10_pii, op11_whitening, op12_token_counts, op13_prefix_trie)
}

_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+', ' ', 'g'), ' '), lambda w: w <> '')"

ORACLE_SQL: dict[str, str] = {
    "op2_urls": rf"""
WITH u AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
c AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || '/' || regexp_replace(regexp_replace(path, '/+$', ''), '^/', '') AS canon,
         regexp_matches(host, '(^|\.)({"|".join(BLOCKED_LABELS)})(\.|$)') AS bad
  FROM u),
l AS (SELECT DISTINCT canon AS url FROM c WHERE bad),
r(rule_host, rule_path, verdict) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
m AS (
  SELECT c.*, (SELECT max({{'a': length(rule_host), 'b': length(rule_path), 'rule': rule_host || rule_path, 'verdict': verdict}}) FROM r
               WHERE (c.host = rule_host OR c.host LIKE '%.' || rule_host) AND starts_with(c.path, rule_path)) AS best,
         canon IN (SELECT url FROM l) AS listed
  FROM c)
SELECT CAST(page_id AS BIGINT) AS page_id, host, path, best.rule AS rule, coalesce(best.verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM m""",
    "op8_decontam": rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, row_number() OVER () AS j, {_WORDS} AS w FROM benchmark),
iw AS (SELECT item_id, j, k AS a, list_slice(w, k, least(k + 9, len(w))) AS win
       FROM (SELECT item_id, j, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (SELECT r, k, list_slice(w, k, k + n - 1) AS win, n
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, n WHERE len(w) >= n)),
h AS (SELECT r, k, dw.n, item_id, j, a FROM dw JOIN iw ON dw.win = iw.win),
e AS (SELECT r, max({{'words': words, 'before': -k}}) AS best
      FROM (SELECT r, min(k) - 1 AS k, count(*) - 1 + any_value(n) AS words
            FROM (SELECT r, j, k, n, k - a AS line, k - row_number() OVER (PARTITION BY r, j, k - a ORDER BY k) AS run FROM h) GROUP BY r, j, line, run)
      GROUP BY r),
x AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM h) GROUP BY r),
s AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM h GROUP BY r)
SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(best.words, 0) AS BIGINT) AS longest, CAST(-best.before AS BIGINT) AS longest_at
FROM d LEFT JOIN x USING (r) LEFT JOIN s USING (r) LEFT JOIN e USING (r)""",
    # crc32 of the decimal id, bit by bit; node keys are lists of turn numbers
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
         dense_rank() OVER (ORDER BY coalesce(role, ''), coalesce(text, '')) AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT c, list(id ORDER BY pos) AS ids, list(w ORDER BY pos) AS ws,
         xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda y, i: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 4 AS h
  FROM t GROUP BY c),
b AS (
  SELECT o.c, list_concat(list_slice(coalesce(p.ids, []), 1, o.h), list_slice(o.ids, o.h + 1, len(o.ids))) AS ids,
         list_concat(list_slice(coalesce(p.ws, []), 1, o.h), list_slice(o.ws, o.h + 1, len(o.ws))) AS ws
  FROM o LEFT JOIN o p ON p.c = o.c - o.c % 20),
m AS (SELECT c, ids, ws, len(ids) AS n, unnest(range(0, len(ids) + 1)) AS d FROM b),
n AS (
  SELECT list_slice(ids, 1, d) AS k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN ws[d] ELSE 0 END) AS w,
         string_agg(CASE WHEN n = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c) AS ends
  FROM m GROUP BY 1, 2),
kids AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
up AS (
  SELECT list_slice(k, 1, a) AS k, sum((n_convs - 1) * w) AS saved, sum(leaf) AS leaves
  FROM (SELECT n.k, n.n_convs, n.w, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, n.d + 1)) AS a FROM n LEFT JOIN kids ON n.k = kids.k) GROUP BY 1)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
       CAST(up.leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n LEFT JOIN kids ON n.k = kids.k JOIN up ON n.k = up.k LEFT JOIN n p ON n.d > 0 AND p.k = list_slice(n.k, 1, n.d - 1)""",
}
