"""The contract queries: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, table
from .decontaminate import contamination
from .filter_audit import filter_audit
from .fingerprints import fingerprints
from .gam import quality_scores
from .hard_negatives import hard_negatives
from .hilbert_shards import curve, hilbert_shards
from .isolation_forest import quality_rules
from .jaccard_join import jaccard_components
from .line_dedup import line_dedup
from .mixing import mix
from .packing import packed
from .token_counts import token_counts
from .warc import read_warc, write_warc

TOKENIZER = "byte_bpe_50k.json"


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))


def op5_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), out)
    return read_warc(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_mixing, op2_token_counts, op3_line_dedup, op4_hilbert_shards, op5_quality_gam, op6_packing, op7_isolation_rules, op8_fingerprints, op9_jaccard_join, op10_warc, op11_filter_audit, op12_hard_negatives, op13_decontamination)
}

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('1:' || coalesce(doc_id::VARCHAR, '')) AS ord FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
w AS (SELECT source, n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
-- The sources that reach twice their size are those of the least size for their weight: find how many.
o AS (SELECT *, row_number() OVER (ORDER BY n::DOUBLE / w, source NULLS LAST) AS k FROM w WHERE n > 0),
c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_n, sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest_w, sum(n) OVER ()::BIGINT AS total FROM o),
f AS (SELECT min(k) AS k FROM c WHERE (3 * total - 4 * full_n) * w <= 4 * n * rest_w),
l AS (SELECT c.full_n, c.rest_w, c.total, c.k FROM c JOIN f USING (k)),
t AS (SELECT w.source, w.n, CASE WHEN w.n = 0 THEN 0.0::DOUBLE WHEN c.k < l.k THEN 2.0::DOUBLE * w.n ELSE ((3 * l.total - 4 * l.full_n) * w.w)::DOUBLE / (2 * l.rest_w)::DOUBLE END AS target FROM w LEFT JOIN c ON w.source IS NOT DISTINCT FROM c.source LEFT JOIN l ON true),
p AS (SELECT d.*, t.n AS source_size, t.target, CASE WHEN t.n = 0 THEN 0 ELSE (floor(t.target)::BIGINT) // t.n END AS whole, CASE WHEN t.n = 0 THEN 0 ELSE (floor(t.target)::BIGINT) % t.n END AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
g AS (SELECT source, max(rest) - max(CASE WHEN upto <= rest THEN upto ELSE 0 END) AS gap FROM p GROUP BY source),
b AS (SELECT p.doc_id, p.source, p.upto, row_number() OVER (PARTITION BY p.source ORDER BY p.size DESC, p.upto) AS k FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source WHERE p.upto > p.rest AND p.size > 0 AND p.size <= g.gap)
SELECT p.doc_id, p.size, p.source_size, p.target, (p.size * (p.whole + CASE WHEN p.upto <= p.rest OR b.k = 1 THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p LEFT JOIN b ON p.source IS NOT DISTINCT FROM b.source AND p.upto = b.upto AND p.doc_id IS NOT DISTINCT FROM b.doc_id AND b.k = 1
""",
    "op3_line_dedup": r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM documents),
w AS (SELECT DISTINCT doc_id, p - 1 AS pos, x[p] || chr(10) || x[p + 1] || chr(10) || x[p + 2] AS k FROM (SELECT doc_id, x, unnest(generate_series(1, len(x) - 2)) AS p FROM l) WHERE trim(x[p], ' ') <> '' OR trim(x[p + 1], ' ') <> '' OR trim(x[p + 2], ' ') <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, pos) AS n FROM w),
c AS (SELECT doc_id, list_distinct(flatten(list([pos + 1, pos + 2, pos + 3]))) AS at FROM r WHERE n > 1 GROUP BY doc_id)
SELECT l.doc_id, CASE WHEN c.at IS NULL THEN l.text ELSE coalesce(array_to_string(list_transform(list_filter(generate_series(1, len(l.x)), lambda i: NOT list_contains(c.at, i)), lambda i: l.x[i]), chr(10)), '') END AS text,
coalesce(len(l.x), 0)::BIGINT AS n_lines, coalesce(len(c.at), 0)::BIGINT AS n_removed FROM l LEFT JOIN c USING (doc_id)
""",
    "op4_hilbert_shards": r"""
-- The remainders of CRC-32 for each byte, by eight divisions by its polynomial.
WITH RECURSIVE bit AS (SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) r(i) UNION ALL SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bit WHERE k < 8),
rest AS (SELECT list(c ORDER BY byte) AS t FROM bit WHERE k = 8),
crc AS MATERIALIZED (SELECT x, xor(4294967295::BIGINT, list_reduce(list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda h: ('0x' || h)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS c
FROM (SELECT text AS x FROM documents UNION SELECT source FROM documents UNION SELECT lang FROM documents) CROSS JOIN rest WHERE x IS NOT NULL),
d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT + 1 AS size, coalesce(a.c, 0) AS text_crc32, (coalesce(b.c, 0) % 16)::INT AS source_level, (coalesce(l.c, 0) % 16)::INT AS lang_level
FROM documents LEFT JOIN crc a ON a.x = text LEFT JOIN crc b ON b.x = source LEFT JOIN crc l ON l.x = lang),
v AS (SELECT *, least(length(bin(size)) - 1, 15)::INT AS size_level FROM d),
h AS (SELECT *, ([CURVE])[(source_level * 16 + lang_level) * 16 + size_level + 1]::INT AS curve FROM v),
r AS (SELECT *, row_number() OVER (ORDER BY curve, text_crc32, doc_id NULLS LAST) - 1 AS k, count(*) OVER () AS total FROM h),
s AS (SELECT *, (k * 8 // total)::INT AS shard FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, (row_number() OVER (PARTITION BY shard ORDER BY k) - 1)::BIGINT AS slot, NULL::INT AS grown_shard, curve, source_level, lang_level, size_level FROM s
""".replace("CURVE", curve(3, 4)),
    "op9_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (SELECT doc_id, CASE WHEN len(x) = 0 THEN [] WHEN len(x) < 5 THEN [array_to_string(x, ' ')] ELSE list_sort(list_distinct(list_transform(generate_series(1, len(x) - 4), lambda i: array_to_string(x[i:i + 4], ' ')))) END AS t FROM w),
k AS (SELECT doc_id, t, len(t)::BIGINT AS n, md5(array_to_string(t, chr(10))) AS key FROM s),
-- Equal sets are one class; links are sought between classes.
c AS (SELECT key, any_value(t) AS t, any_value(n) AS n, min(doc_id) AS id FROM k WHERE n > 0 GROUP BY key),
e AS (SELECT id, n, unnest(t) AS t FROM c),
o AS (SELECT a.id AS u, b.id AS v FROM e a JOIN e b ON a.t = b.t AND a.id < b.id GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
p AS (SELECT u, v FROM o UNION ALL SELECT v, u FROM o),
r AS (SELECT id AS u, id AS v FROM c UNION SELECT r.u, p.v FROM r JOIN p ON p.u = r.v),
m AS (SELECT u, min(v) AS component FROM r GROUP BY u)
SELECT k.doc_id, k.n AS n_shingles, coalesce(m.component, k.doc_id) AS component_id FROM k LEFT JOIN c USING (key) LEFT JOIN m ON m.u = c.id
""",
    "op10_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages),
d AS (SELECT page_id, strlen(x)::BIGINT AS n, sha1(x) AS h FROM p),
-- Five hexadecimal digits are four characters of base 32.
b AS (SELECT page_id, n, array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS digest, min(page_id) OVER (PARTITION BY h, n) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM b
""",
    "op11_filter_audit": r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents),
m AS (SELECT doc_id, part, (len(x) < 100)::INT + 2 * (100 * len(list_distinct(x)) < 80 * len(x))::INT + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT
  + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask FROM w),
l AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY doc_id),
g AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f AS (SELECT i, substr('ABCDE', i + 1, 1) AS name, (1 << i)::INT AS bit FROM (SELECT unnest([0, 1, 2, 3, 4]) AS i)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (mask & (bit | before) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM g, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
""",
    "op12_hard_negatives": r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label, b.vec_id AS other_id, b.r AS other, b.label AS other_label, list_dot_product(a.q, b.q)::BIGINT AS score FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST, other) AS place FROM p WHERE label = other_label),
n AS (SELECT t.anchor_id, t.other_id AS positive_id, t.score AS positive_score, p.other_id AS negative_id, p.score AS negative_score, row_number() OVER (PARTITION BY t.anchor, t.place ORDER BY p.score DESC, p.other_id NULLS LAST, p.other) AS rank
  FROM t JOIN p ON p.anchor = t.anchor AND p.label <> p.other_label AND 50 * t.score <= 100 * p.score AND 100 * p.score <= 95 * t.score WHERE t.place <= 5)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
    "op13_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM benchmark),
k AS (SELECT DISTINCT item_id, least(len(x), 10) AS k, unnest(list_transform(generate_series(1, greatest(len(x) - 9, 1)), lambda i: array_to_string(x[i:i + 9], ' '))) AS words FROM b WHERE len(x) > 0),
p AS (SELECT r, k, i, array_to_string(x[i:i + k - 1], ' ') AS words FROM (SELECT r, x, k, unnest(generate_series(1, len(x) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM k) WHERE len(x) >= k)),
h AS (SELECT DISTINCT r, i, p.k, item_id FROM p JOIN k ON p.words = k.words),
a AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS place FROM h) GROUP BY r),
s AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM h WHERE item_id IS NOT NULL GROUP BY r)
SELECT doc_id, len(x)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN a USING (r) LEFT JOIN s USING (r)
""",
}
