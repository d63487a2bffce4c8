"""Registered queries of the package and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from innkeeper.session import scratch_path

from . import (curriculum, hard_negatives, minhash_dedup, pii_feistel, quality_rules, secret_entropy, source_audit, substring_dedup,
               suffix_decontam, suffix_dedup, token_files, toxicity, url_rules)
from .common import table
from .components import stored

def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= toxicity.REJECT_AT).cast("int").alias("predicted"))


# The key of the registered query's pseudonyms; a deployment passes its own.
PII_SECRET = "op6-registered-query"


def op6_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii_feistel.pseudonymize(table(spark, sf_dir, "documents"), PII_SECRET)
    count = lambda kind: F.size(F.filter("found", lambda f: f["kind"] == kind)).cast("long")
    return out.select("doc_id", "text", *[count(k).alias(f"n_{k}") for k in pii_feistel.KINDS],
                      F.array_join(F.transform("found", lambda f: F.concat_ws(":", f["kind"], f["value"])), ",").alias("pseudonyms"))


def op7_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_entropy.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind_no"] < 3)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_entropy.text_of(base), 256).alias("base_sha256"),
        secret_entropy.text_of(F.col("spans")).alias("spans"))


OP7_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
pat(kind, kind_no, rx, grp) AS (VALUES
  ('assign', 0, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2),
  ('access', 1, 'AKIA[A-Z0-9]+', 0), ('hex', 2, '[0-9a-f]{24,}', 0),
  ('entropy_hex', 3, '[0-9A-Fa-f]{24,}', 0), ('entropy_base64', 4, '[A-Za-z0-9+/_=-]{24,}', 0)),
raw AS (SELECT rid, kind, kind_no, string_split_regex(t, rx) AS pieces, regexp_extract_all(t, rx) AS ms,
        CASE WHEN kind_no = 0 THEN regexp_extract_all(t, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)
             ELSE regexp_extract_all(t, rx) END AS vs FROM d, pat WHERE regexp_matches(t, rx)),
one AS (SELECT rid, kind, kind_no, unnest(range(1, len(ms) + 1)) AS i, pieces, ms, vs FROM raw),
loc AS (SELECT rid, kind, kind_no, ms[i] AS m, vs[i] AS v, length(ms[i]) AS len,
               sum(length(pieces[i]) + length(ms[i])) OVER (PARTITION BY rid, kind ORDER BY i) - length(ms[i]) AS start FROM one),
base AS (SELECT rid, kind, kind_no, start, start + len AS fin FROM loc
         WHERE (kind_no = 0 AND length(v) >= 6) OR (kind_no = 1 AND len >= 20) OR kind_no = 2),
cand AS (SELECT *, row_number() OVER () AS cid FROM loc WHERE kind_no > 2 AND NOT regexp_matches(m,
  '(^[A-Za-z]+$)|(^[0-9]+$)|(^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$)|(^[a-z0-9]+([/_-][a-z]+){2,}[/_-]?$)')),
win AS (SELECT cid, unnest(range(0, len - 23)) AS w, m FROM cand),
chr AS (SELECT cid, w, unnest(string_split(substr(m, w + 1, 24), '')) AS c FROM win),
cnt AS (SELECT cid, w, c, count(*) AS n FROM chr GROUP BY cid, w, c),
ent AS (SELECT cid, w, sum(round(1000000 * n * log2(n))) AS terms FROM cnt GROUP BY cid, w),
flag AS (SELECT cid, min(w) AS a, max(w) AS z FROM ent JOIN cand USING (cid)
         WHERE terms <= CASE WHEN kind_no = 3 THEN floor(1000000 * 24 * (log2(24) - 3.0))
                             ELSE floor(1000000 * 24 * (log2(24) - 3.9)) END GROUP BY cid),
sp AS (SELECT rid, kind, kind_no, start, fin FROM base
       UNION ALL SELECT rid, kind, kind_no, start + a, start + z + 24 FROM flag JOIN cand USING (cid)),
txt AS (SELECT rid, count(*) FILTER (kind_no = 0) AS a, count(*) FILTER (kind_no = 1) AS b, count(*) FILTER (kind_no = 2) AS c,
               string_agg(kind || ':' || start::BIGINT || ':' || fin::BIGINT, ',' ORDER BY start, kind_no) AS everything,
               string_agg(kind || ':' || start::BIGINT || ':' || fin::BIGINT, ',' ORDER BY start, kind_no) FILTER (kind_no < 3) AS basic
        FROM sp GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(basic, '')) AS base_sha256, coalesce(everything, '') AS spans
FROM d LEFT JOIN txt USING (rid)
"""


# The rule list that op8 is asked to apply (fixed by its contract).
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_rules.RULE_SCHEMA)
    out = url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("row.page_id", "host", "path", "rule", "verdict")


OP8_SQL = """
WITH u AS (SELECT row_number() OVER () AS rid, page_id,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
p AS (SELECT rid, page_id,
             translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(action, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                   ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
b AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
             arg_max(action, length(rhost || rpath)) AS action
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN b USING (rid)
"""


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.mask_of("base-1")).cast("long")) != 0
    return quality_rules.apply_policy(rows, "web-1").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failed", "sole_rule")


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
x AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
t AS (SELECT rid, i, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c FROM x
      WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT *, c IS NOT NULL AND count(*) OVER (PARTITION BY rid, word, b, c) > 1 AS twice FROM t),
m AS (SELECT rid, word, twice OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS hit
      FROM r WINDOW o AS (PARTITION BY rid ORDER BY i)),
a AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars, count(*) FILTER (hit) AS n_repeat_words,
             count(*) FILTER (regexp_matches(word, '[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS n_upper
      FROM m GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
f AS (SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines, coalesce(n_upper, 0) AS n_upper
      FROM d LEFT JOIN a USING (rid) LEFT JOIN k USING (rid)),
b AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
                 + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_dup_lines > 40 * n_lines)::INT
                 + 16 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT
                 + 32 * (2 * n_upper > n_words)::INT)::BIGINT AS failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
       failed = 0 AS kept, failed,
       CASE failed WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols'
                   WHEN 8 THEN 'repeated_lines' WHEN 16 THEN 'word_length' WHEN 32 THEN 'upper_case' END AS sole_rule
FROM b
"""


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS h FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.h = b.h AND a.doc_id <> b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id AS v, doc_id AS w FROM d UNION SELECT r.v, l.b FROM r JOIN l ON r.w = l.a),
c AS (SELECT v AS doc_id, min(w) AS component_id FROM r GROUP BY v)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.checksums(token_files.read_tokens(spark, path)).withColumnRenamed("key", "doc_id")


def op4_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest is read off the written training order: a document's copies, their words and the first one's time."""
    docs = curriculum.sized(table(spark, sf_dir, "documents"), "doc_id", "source")
    mixed = stored(curriculum.mix(stored(docs.withColumn("_row", F.monotonically_increasing_id()), "sizes")), "mixed")
    order = stored(curriculum.training_order(mixed), "training-order")
    copies = order.groupBy("_row").agg(F.sum("words").alias("_words"), F.count(F.lit(1)).cast("int").alias("_copies"),
                                       F.round(F.min("time"), 6).alias("first_time"))
    return mixed.join(copies, "_row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("_words", F.lit(0).cast("long")).alias("taken"),
        F.coalesce("_copies", F.lit(0)).alias("n_copies"), "first_time")


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
                  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
o AS (SELECT *, source_size * 2.0::DOUBLE AS most,
             (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER b, 0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(most, coalesce(weight * max(level) FILTER (most > weight * level) OVER (), most))
             AS target FROM o),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')),
             doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM d),
c AS (SELECT doc_id, size, source_size, target, pos,
             greatest(least(floor(target) - pos, size), 0)::BIGINT AS one,
             greatest(least(floor(target) - pos - source_size, size), 0)::BIGINT AS two
      FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target, one + two AS taken,
       (one > 0)::INT + (two > 0)::INT AS n_copies,
       CASE WHEN one > 0 THEN round(sqrt(0.25 + 2.0::DOUBLE * least(pos::DOUBLE / target, 1.0)) - 0.5, 6) END AS first_time
FROM c
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.size("removed_starts").alias("n_intervals"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n, ws FROM d),
v AS (SELECT rid, i, word, CASE WHEN i + 34 <= n THEN md5(array_to_string(ws[i:i + 34], ' ')) END AS win FROM x),
r AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS twice FROM v),
c AS (SELECT rid, i, word, max(twice::INT) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW)
             AS gone FROM r),
e AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), 0) = 0 AS begins FROM c),
g AS (SELECT rid, count(*) AS n_words, sum(gone) AS n_removed, count(*) FILTER (begins) AS n_intervals,
             string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM e GROUP BY rid)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_intervals, 0)::INT AS n_intervals
FROM d LEFT JOIN g USING (rid)
"""


def op10_suffix_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_decontam.find_matches(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                         table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"),
        suffix_decontam.contaminated().alias("contaminated"), F.col("_longest").alias("longest_match"),
        F.col("_longest_start").alias("longest_start"))


OP10_SQL = r"""
WITH low AS (SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t,
                    row_number() OVER () AS rid, doc_id FROM documents),
d AS (SELECT rid, doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM low),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM benchmark),
bw AS (SELECT item, ws, least(len(ws), 13) AS n, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS j FROM b WHERE len(ws) > 0),
bh AS (SELECT DISTINCT item, j, n, md5(array_to_string(ws[j:j + n - 1], ' ')) AS h FROM bw),
sizes AS (SELECT DISTINCT n FROM bh),
dw AS (SELECT rid, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
dh AS (SELECT rid, i, n, md5(array_to_string(ws[i:i + n - 1], ' ')) AS h FROM dw, sizes WHERE i + n - 1 <= len(ws)),
m AS (SELECT rid, i, j, item, n FROM dh JOIN bh USING (n, h)),
cov AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM m) GROUP BY rid),
its AS (SELECT rid, count(DISTINCT item) AS n_items,
               array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM m GROUP BY rid),
isl AS (SELECT rid, item, i, i - j AS diag, n, i - row_number() OVER (PARTITION BY rid, item, i - j ORDER BY i) AS g FROM m),
run AS (SELECT rid, any_value(n) + count(*) - 1 AS len, min(i) - 1 AS start FROM isl GROUP BY rid, item, diag, g),
top AS (SELECT rid, max(len) AS longest FROM run GROUP BY rid),
lon AS (SELECT rid, any_value(longest) AS longest, min(start) AS start FROM run JOIN top USING (rid) WHERE len = longest GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated,
       coalesce(longest, 0)::BIGINT AS longest_match, coalesce(start, -1)::BIGINT AS longest_start
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid) LEFT JOIN lon USING (rid)
"""


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed_starts").cast("long").alias("n_spans"), "kept_sha256")


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT rid, h, unnest(range(0, length(h) // 2)) AS i FROM d),
v AS (SELECT rid, i, substr(h, 2 * i + 1, 2) AS byte,
             CASE WHEN 2 * (i + 200) <= length(h) THEN md5(substr(h, 2 * i + 1, 400)) END AS win FROM w),
r AS (SELECT rid, i, byte, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS twice FROM v),
c AS (SELECT rid, i, byte, max(twice::INT) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
      FROM r),
e AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), 0) = 0 AS begins FROM c),
g AS (SELECT rid, count(*) AS n_bytes, sum(gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
             string_agg(byte, '' ORDER BY i) FILTER (gone = 0) AS kept FROM e GROUP BY rid)
SELECT doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.quantized(table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, rows.where(F.col("id") % 100 == 0))


OP12_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS label,
             list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i]))::BIGINT AS score
      FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE own = label QUALIFY k <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.own <> s.label
       AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source
           FROM documents),
w AS (SELECT rid, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * v.v) AS p,
             1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (v.lang_total + 2 * v.v) AS q
      FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
      LEFT JOIN s ON s.lang = g.lang AND s.source = g.source),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_token_files": op3_token_files,
    "op4_curriculum": op4_curriculum,
    "op5_toxicity": op5_toxicity,
    "op6_pii_feistel": op6_pii_feistel,
    "op7_secret_entropy": op7_secret_entropy,
    "op8_url_rules": op8_url_rules,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_suffix_decontam": op10_suffix_decontam,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_audit": op13_source_audit,
}

ORACLE_SQL = {
    "op1_quality_rules": OP1_SQL,
    "op2_minhash_dedup": OP2_SQL,
    "op4_curriculum": OP4_SQL,
    "op7_secret_entropy": OP7_SQL,
    "op8_url_rules": OP8_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op10_suffix_decontam": OP10_SQL,
    "op11_suffix_dedup": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_source_audit": OP13_SQL,
}
