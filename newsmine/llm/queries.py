"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.llm import (
    exact,
    filteraudit,
    jaccard,
    langid,
    mixing,
    packing,
    pieces,
    quality,
    substrings,
    suffixes,
    tokencount,
    turntrie,
    urlfilter,
)
from newsmine.llm.common import conversations, documents, labels, pages

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(documents(spark, folder))


@query("op2_language_id")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held = langid.held_out(F.col("doc_id"))
    coder = langid.fitted(docs.where(~held))
    found = langid.predicted(docs, coder)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op3_token_counts")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


@query("op6_piece_digests")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digests(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM n WINDOW w AS (PARTITION BY h)
"""


@query("op7_exact_dedup", EXACT_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return exact.duplicates(documents(spark, folder), digest=True)


@query("op9_line_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality.line_quality(documents(spark, folder)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"
    )


@query("op10_url_filter")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return urlfilter.url_verdicts(pages(spark, folder), urlfilter.labelled_urls(spark))


@query("op5_substring_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.without_repeats(documents(spark, folder))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_suffix_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    # Strings of 400 bytes go; repeated passages of over 50 words (200 bytes, as in the pipeline) are counted beside them.
    found = suffixes.without_repeats(documents(spark, folder), passage=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage")


@query("op4_ngram_jaccard")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.near_duplicates(documents(spark, folder), jaccard.Sets(peel=False))
    return found.select("doc_id", "n_shingles", "component_id")


# CRC-32 of the decimal conv_id: one step for each bit of each byte.
TRIE_SQL = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT DISTINCT c, c - c % 20 AS b, CAST(c AS VARCHAR) AS s FROM t),
crc AS (
  SELECT c, b, xor(list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, len(s) + 1), lambda i: [CAST(ord(s[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN CAST(3988292384 AS BIGINT) ELSE CAST(0 AS BIGINT) END)), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM own),
parts AS (
  SELECT crc.c, pos, role, text FROM crc JOIN t ON t.c = crc.b AND pos <= h
  UNION ALL SELECT crc.c, pos, role, text FROM crc JOIN t ON t.c = crc.c AND pos > h),
seq AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY pos) AS d, md5(length(role) || ':' || role || text) AS m,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM parts),
pre AS (
  SELECT c, d, list(m) OVER (PARTITION BY c ORDER BY d) AS path, w FROM seq
  UNION ALL SELECT c, 0, CAST([] AS VARCHAR[]), 0 FROM own),
ended AS (SELECT c, max(d) AS longest FROM pre GROUP BY c),
node AS (
  SELECT path, d, min(c) AS low, count(*) AS n, max(w) AS w,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = longest), '')) AS ends
  FROM pre JOIN ended USING (c) GROUP BY path, d),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS k FROM node WHERE d > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(k, 0) AS k FROM node LEFT JOIN kids USING (path)),
below AS (
  SELECT path[1:a] AS path, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS leaves, sum((n - 1) * w) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_node) GROUP BY 1)
SELECT f.low AS conv_id, CAST(f.d AS BIGINT) AS depth, p.low AS parent_conv_id, f.n AS n_convs, CAST(f.k AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, f.ends AS ends_sha256
FROM full_node f JOIN below USING (path) LEFT JOIN node p ON f.d > 0 AND p.path = f.path[1:f.d - 1]
"""


@query("op11_prefix_trie", TRIE_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    own = turntrie.encoded(conversations(spark, folder))
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return turntrie.prefix_trie(turntrie.rebuilt(own, F.col("conv") - F.col("conv") % 20, heads, 3))


MIX_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':42:' || md5(coalesce(text, ''))) AS mark FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
budget AS (SELECT CAST(sum(total) AS DOUBLE) * 150 / 100 AS b, sum(weight) AS whole FROM s),
filled AS (
  SELECT *, coalesce(sum(2 * total) OVER w, 0) AS spent, coalesce(sum(weight) OVER w, 0) AS gone FROM s
  WINDOW w AS (ORDER BY 2 * total / weight, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((b - spent) / (whole - gone)) AS v FROM filled, budget),
target AS (SELECT source, n, total, weight, least(CAST(2 * total AS DOUBLE), weight * v) AS target FROM s, level),
q AS (
  SELECT d.*, n, total, weight, target, sum(size) OVER (PARTITION BY n ORDER BY mark ROWS UNBOUNDED PRECEDING) AS queued
  FROM d JOIN target t ON d.source IS NOT DISTINCT FROM t.source),
entries AS (SELECT r, size, n, mark, (total * unnest([0, 1]) + queued) * (6 // weight) AS finish FROM q WHERE size > 0),
spent AS (SELECT r, size, sum(size) OVER (ORDER BY finish, n, mark) AS s FROM entries),
got AS (SELECT r, sum(size) AS taken FROM spent, budget WHERE s <= b GROUP BY r)
SELECT doc_id, CAST(size AS BIGINT) AS size, total AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN got USING (r)
"""


@query("op12_source_mix", MIX_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder)).rows()


AUDIT_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
j AS (
  SELECT doc_id, part, CASE WHEN len(ws) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS cell
  FROM w),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
cells AS (SELECT part, cell, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM j LEFT JOIN marks USING (doc_id) GROUP BY part, cell),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, f.bit AS own, (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE instr(filter_order[1:step - 1], g.l) > 0) AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders) JOIN f ON f.l = filter_order[step]),
counted AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN cell & (CAST(earlier AS INTEGER) | own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN cell & own > 0 AND cell & CAST(earlier AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN cell & own > 0 AND cell & CAST(earlier AS INTEGER) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN cell = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN cell & own > 0 AND cell & CAST(earlier AS INTEGER) = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN cell & own > 0 AND cell & CAST(earlier AS INTEGER) = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""


@query("op13_filter_audit", AUDIT_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return filteraudit.filter_audit(documents(spark, folder), labels(spark, folder))
