"""One registered query for each operator of this folder, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from radpref.llm.common import table
from radpref.llm.decontamination import contamination_report
from radpref.llm.lexical_search import lexical_search
from radpref.llm.lm_scoring import lm_scoring
from radpref.llm.mixing import mixing_report
from radpref.llm.near_dedup import NearParams, near_duplicates
from radpref.llm.phrases import collocations
from radpref.llm.pii import pii
from radpref.llm.quality_rules import quality_rules
from radpref.llm.secret_scan import secret_scan
from radpref.llm.set_join import jaccard_join
from radpref.llm.suffix_dedup import suffix_dedup
from radpref.llm.token_output import token_output
from radpref.llm.toxicity import toxicity


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).withColumn("host_rate", F.round("host_rate", 6))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), NearParams(words=4))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring(table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_secret_scan, op2_pii, op3_source_mixing, op4_toxicity, op5_suffix_dedup, op6_benchmark_decontamination, op7_quality_rules, op8_token_output, op9_near_duplicates, op10_lm_scoring, op11_phrases, op12_jaccard_join, op13_lexical_search)
}

_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORD = r"[^\x20\x09-\x0D]"
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op5_suffix_dedup": """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS h FROM documents),
w AS (SELECT doc_id, i, md5_number(h[i:i + 199]) AS k FROM (SELECT doc_id, h, unnest(generate_series(1, octet_length(h) - 199)) AS i FROM d WHERE octet_length(h) >= 200)),
twice AS (SELECT k FROM w GROUP BY 1 HAVING count(*) > 1),
starts AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM w SEMI JOIN twice USING (k)),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 199 AS b FROM (SELECT doc_id, i, sum(CASE WHEN i <= p + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM starts) GROUP BY doc_id, g),
gaps AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1 AS x, a - 1 AS y FROM runs
  UNION ALL SELECT doc_id, max(b) + 1, max(octet_length(h)) FROM runs JOIN d USING (doc_id) GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(hex(h[x:y]), '' ORDER BY x) FILTER (WHERE y >= x) AS kept FROM gaps JOIN d USING (doc_id) GROUP BY 1),
gone AS (SELECT doc_id, cast(sum(b - a + 1) AS bigint) AS n, count(*) AS k FROM runs GROUP BY 1)
SELECT d.doc_id, octet_length(h) AS n_bytes, coalesce(n, 0) AS n_removed, coalesce(k, 0) AS n_spans, sha256(CASE WHEN k IS NULL THEN h ELSE unhex(coalesce(kept, '')) END) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op9_near_duplicates": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (SELECT a, b FROM sides UNION SELECT r.doc_id, sides.b FROM reach r JOIN sides ON sides.a = r.c),
least_of AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(c, w.doc_id)) AS component_id, w.doc_id <= coalesce(c, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of USING (doc_id)""",
    "op6_benchmark_decontamination": f"""
WITH w AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
item AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS i FROM b WHERE len(ws) > 0)),
doc AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM w, (SELECT DISTINCT n FROM item) WHERE len(ws) >= n)),
hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM doc JOIN item USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS x FROM hit) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op7_quality_rules": f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 7)) AS i FROM d WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM twice) GROUP BY 1),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d) WHERE regexp_matches(l, '{_WORD}') GROUP BY 1),
f AS (SELECT d.doc_id, source, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
  coalesce(lines.dup, 0) AS n_dup_lines, coalesce(lines.n, 0) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS failed FROM f),
h AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE failed) AS k FROM r GROUP BY 1),
m AS (SELECT sum(k) / sum(n)::double AS mean, sum(n)::double AS n, count(*) AS h, sum(k * k / n::double) AS kk FROM h),
b AS (SELECT mean, greatest(kk / n - mean * mean - mean * (1 - mean) * h / n, 0.0::double) AS between_hosts FROM m),
prior AS (SELECT mean, CASE WHEN between_hosts > 0 THEN least(greatest(mean * (1 - mean) / between_hosts - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM b),
rate AS (SELECT source AS host, (k + mean * strength) / (n + strength) AS rate FROM h, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept, round(rate, 6) AS host_rate
FROM r JOIN rate ON source IS NOT DISTINCT FROM host""",
    "op11_phrases": f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d, {_LOWER} AS s FROM documents),
w AS (SELECT lang, d, i, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, d, unnest(ps) AS piece, unnest(range(len(ps))) AS i FROM (SELECT *, string_split_regex(s, '[.,;:!?\x0A-\x0D]') AS ps FROM t))),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY 1),
f AS (SELECT lang, phrase, k, string_split(phrase, ' ') AS ws, count(*) AS f FROM g GROUP BY lang, phrase, k HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, ws, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
x AS (SELECT c.*, p.f AS l, q.f AS r, cast(2000000::hugeint * a // (p.f + q.f) AS bigint) AS score FROM c
  JOIN f p ON p.lang = c.lang AND p.phrase = array_to_string(c.ws[1:cut], ' ') JOIN f q ON q.lang = c.lang AND q.phrase = array_to_string(c.ws[cut + 1:], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
part AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS i FROM b, (SELECT unnest([2, 3]) AS m) WHERE k > m) GROUP BY 1, 2),
kept AS (SELECT b.* FROM b LEFT JOIN part USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (SELECT a, b FROM sides UNION SELECT r.doc_id, sides.b FROM reach r JOIN sides ON sides.a = r.c),
least_of AS (SELECT doc_id, min(c) AS c FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(c, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of USING (doc_id)""",
    "op13_lexical_search": f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS t FROM d) GROUP BY 1, 2),
s AS (SELECT count(*) AS n_docs, cast(sum(len(ts)) AS bigint) AS n_terms FROM d WHERE len(ts) > 0),
q AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark)),
w AS (SELECT t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)::double)) AS bigint) AS w FROM p SEMI JOIN q USING (t), s GROUP BY t, n_docs),
m AS (SELECT doc_id, 100 - 90 + ((90 * len(ts) * n_docs) // n_terms) AS m FROM d, s WHERE len(ts) > 0),
r AS (SELECT item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS bigint) AS score FROM q JOIN w USING (t) JOIN p USING (t) JOIN m USING (doc_id) GROUP BY 1, 2),
k AS (SELECT *, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS integer) AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10""",
}
