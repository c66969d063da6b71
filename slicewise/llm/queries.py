"""The registered queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    chat_format,
    decontamination,
    lexical_search,
    line_dedup,
    mixing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    suffix_dedup,
    toxicity,
    url_filters,
    window_dedup,
)
from .common import written

QUERIES, ORACLES = {}, {}


def register(query):
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_quality_rules(spark, sf_dir):
    return quality_rules.judge_documents(table(spark, sf_dir, "documents"))


ORACLES["op1_quality_rules"] = r"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(0, 8) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
c AS (
  SELECT t.doc_id, t.source AS host, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(l.dup, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS n_lines
  FROM t LEFT JOIN lines l USING (doc_id) LEFT JOIN cov USING (doc_id)),
f AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repeats,
         100 * n_symbols > 20 * n_words AS symbols, 100 * n_dup_lines > 50 * n_lines AS dup_lines
  FROM c),
h AS (
  SELECT host, count(*) AS host_docs, count(*) FILTER (short) AS host_short, count(*) FILTER (repeats) AS host_repeats,
         count(*) FILTER (symbols) AS host_symbols, count(*) FILTER (dup_lines) AS host_dup_lines,
         count(*) FILTER (short OR repeats OR symbols OR dup_lines) AS bad
  FROM f WHERE host IS NOT NULL GROUP BY host),
s AS (
  SELECT sum(host_docs) AS n, sum(bad) / sum(host_docs) AS m, sum(host_docs * host_docs) AS sq, count(*) AS k,
         sum(bad * bad / host_docs) AS pull FROM h),
p AS (
  SELECT m, 1 / CASE WHEN m * (1 - m) * (n - sq / n - (k - 1)) > 0
    THEN greatest(1e-6, least(1.0, (pull - n * m * m - m * (1 - m) * (k - 1)) / (m * (1 - m) * (n - sq / n - (k - 1)))))
    ELSE 1e-6 END - 1 AS strength FROM s),
r AS (SELECT h.*, (bad + m * strength) / (host_docs + strength) AS rate FROM h, p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND NOT coalesce(rate > 0.5, false) AS kept, f.host, host_docs, host_short, host_repeats,
       host_symbols, host_dup_lines, round(rate, 6) AS host_rate, coalesce(rate > 0.5, false) AS host_blocked
FROM f LEFT JOIN r ON f.host = r.host
"""


def remainder(n: int):
    """crc32 of the document's id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


@register
def op2_quality_classifier(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    stats = written(quality_classifier.document_statistics(docs), "statistics")
    model = quality_classifier.train(stats, labels, remainder(3) != 1)
    scored = stats.withColumn("score", quality_classifier.score_statistics(model)("stats"))
    return scored.select(
        "doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@register
def op8_toxicity(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels, remainder(5) != 0))
    return scored.select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@register
def op3_simhash_dedup(spark, sf_dir):
    linked = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return linked.select("doc_id", digits.alias("fingerprint"), "component_id")


@register
def op4_decontamination(spark, sf_dir):
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.digest(decontamination.find_matches(docs, items))


ORACLES["op4_decontamination"] = r"""
WITH split AS (
  SELECT 'd' AS side, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark),
s AS (
  SELECT side, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM split),
bw AS (
  SELECT id AS item_id, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT id, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM s WHERE side = 'b' AND len(w) > 0)),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT id AS doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM s, (SELECT DISTINCT size FROM bw) WHERE side = 'd')),
m AS (SELECT DISTINCT doc_id, i, size, item_id FROM dw JOIN bw USING (size, g)),
hit AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM m, range(0, 10) AS r(k) WHERE k < size GROUP BY doc_id),
it AS (
  SELECT doc_id, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
  FROM m GROUP BY doc_id)
SELECT CAST(s.id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit,
       coalesce(it.n, 0) AS n_items, sha256(coalesce(it.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM s LEFT JOIN hit ON s.id = hit.doc_id LEFT JOIN it ON s.id = it.doc_id WHERE side = 'd'
"""


MIN_SITES, MIN_TEXTS = 10, 10


@register
def op5_line_dedup(spark, sf_dir):
    cleaned = line_dedup.clean_documents(table(spark, sf_dir, "documents"), MIN_SITES, min_texts=MIN_TEXTS)
    return cleaned.select(
        "row.doc_id",
        "n_lines",
        "n_removed",
        F.char_length(F.coalesce("cleaned", F.lit(""))).cast("long").alias("kept_chars"),
        F.sha2(F.coalesce("cleaned", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLES["op5_line_dedup"] = r"""
WITH split AS (
  SELECT row_number() OVER () AS row_no, doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
raw AS (
  SELECT row_no, doc_id, source, text, unnest(parts) AS raw, generate_subscripts(parts, 1) AS no FROM split),
lines AS (
  SELECT *, regexp_replace(raw, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM raw),
spread AS (
  SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10 AND count(DISTINCT text) >= 10),
marked AS (SELECT l.*, s.line IS NOT NULL AS hit FROM lines l LEFT JOIN spread s ON l.line = s.line),
docs AS (
  SELECT row_no, doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (hit) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY no) FILTER (NOT hit), '') AS cleaned
  FROM marked GROUP BY row_no, doc_id)
SELECT doc_id, n_lines, n_removed, CAST(length(cleaned) AS BIGINT) AS kept_chars, sha256(cleaned) AS kept_sha256 FROM docs
"""


EXTRA_CONVERSATION = "</s>[INST] ok [/INST]"


@register
def op6_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(EXTRA_CONVERSATION).alias("text"),
    )
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(extra)))


@register
def op7_suffix_dedup(spark, sf_dir):
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@register
def op9_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filters.judge_urls(pages, url_filters.rules_of(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLES["op9_url_filters"] = r"""
WITH u AS (
  SELECT page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS raw,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
r(rule_host, rule_path, rule_verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, rule_verdict
  FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) = 1)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM m
"""


@register
def op10_mixing(spark, sf_dir):
    mixed = mixing.mix_documents(table(spark, sf_dir, "documents"))
    return mixed.select("row.doc_id", "labels.source", "labels.lang", "labels.topic", "n_tokens", "weight", "probability", "sampled")


@register
def op12_lexical_search(spark, sf_dir):
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return lexical_search.search(docs, items).select("item_id", "rank", "doc_id", "score")


ORACLES["op12_lexical_search"] = r"""
WITH rows AS (
  SELECT 'd' AS side, row_number() OVER () AS no, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark),
said AS (
  SELECT side, no, id, unnest(list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS term FROM rows),
tf AS (SELECT side, no, id, term, count(*) AS tf FROM said GROUP BY ALL),
n AS (SELECT no, count(*) AS n FROM said WHERE side = 'd' GROUP BY no),
s AS (SELECT count(*) AS n_docs, sum(n) AS n_words FROM n),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, s WHERE side = 'd' GROUP BY term, n_docs),
m AS (SELECT no, 100 - 25 + (25 * n * n_docs) // n_words AS m FROM n, s),
scored AS (
  SELECT b.no AS item, b.id AS item_id, d.no, d.id AS doc_id,
         sum(b.tf * w.w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * m.m))) AS score
  FROM tf b JOIN tf d USING (term) JOIN w USING (term) JOIN m ON m.no = d.no
  WHERE b.side = 'b' AND d.side = 'd' GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, no) AS INTEGER) AS rank, doc_id,
       CAST(score AS BIGINT) AS score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, no) <= 20
"""


@register
def op13_window_dedup(spark, sf_dir):
    done = window_dedup.remove_windows(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


ORACLES["op13_window_dedup"] = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS no,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
w AS (SELECT doc_id, no, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
win AS (
  SELECT doc_id, no, i, string_agg(word, ' ') OVER (PARTITION BY no ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS g,
         count(*) OVER (PARTITION BY no ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS size FROM w),
hit AS (
  SELECT no, i FROM win WHERE size = 20
  QUALIFY coalesce(doc_id, 9223372036854775807) > min(coalesce(doc_id, 9223372036854775807)) OVER (PARTITION BY g)
          OR i > min(i) OVER (PARTITION BY g, no)),
kept AS (
  SELECT w.no, i, word, max(hit.i IS NOT NULL) OVER (PARTITION BY w.no ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM w LEFT JOIN hit USING (no, i)),
said AS (
  SELECT no, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS text
  FROM kept GROUP BY no)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(said.text, '')) AS kept_sha256
FROM t LEFT JOIN said USING (no)
"""


@register
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


ORACLES["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
         sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, chars, digest, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM t),
h AS (
  SELECT conv_id, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(
           string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
             lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own)),
turns AS (
  SELECT h.conv_id, own.pos, own.digest, own.chars FROM h JOIN own ON own.conv_id = h.conv_id - h.conv_id % 100 AND own.pos <= h.h
  UNION ALL SELECT h.conv_id, own.pos + 6, own.digest, own.chars FROM h JOIN own USING (conv_id) WHERE own.pos > h.h),
seqs AS (
  SELECT h.conv_id, coalesce(list(digest ORDER BY pos) FILTER (pos IS NOT NULL), []) AS ds,
         coalesce(list(chars ORDER BY pos) FILTER (pos IS NOT NULL), []) AS cs
  FROM h LEFT JOIN turns USING (conv_id) GROUP BY h.conv_id),
pre AS (
  SELECT conv_id, d, array_to_string(ds[1:d], '') AS k, CASE WHEN d > 0 THEN cs[d] ELSE 0 END AS chars, len(ds) = d AS ends
  FROM (SELECT *, unnest(range(0, len(ds) + 1)) AS d FROM seqs)),
node AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM pre GROUP BY d, k),
child AS (SELECT left(k, 64 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
under AS (
  SELECT left(k, 64 * a) AS k, sum((n_convs - 1) * chars) AS saved, count(*) FILTER (n IS NULL) AS leaves
  FROM (SELECT node.*, child.n, unnest(range(0, d + 1)) AS a FROM node LEFT JOIN child USING (k)) GROUP BY ALL)
SELECT node.conv_id, node.d AS depth, p.conv_id AS parent_conv_id, node.n_convs, coalesce(child.n, 0) AS n_children,
       under.leaves AS n_leaves, CAST(under.saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN under USING (k) LEFT JOIN child USING (k)
LEFT JOIN node p ON node.d > 0 AND p.k = left(node.k, 64 * (node.d - 1))
"""
