"""The queries opN_<name> that apply each training-data operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listloom.llm import bpe, chat, decontam, htmltext, langid, licences, quality, simhash, tokenfiles, urls
from listloom.llm.common import table

#: Where the public tokenizers' vocabulary files are: a parameter of the operators, never copied.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: Rules of op4: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conflicting = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", conflicting), (-1, 1, "assistant", conflicting)], turns.schema)
    return chat.digests(chat.render_turns(turns.unionByName(own)))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("h")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents")).drop("spans")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_chat_formatting, op3_decontamination, op4_url_filters, op5_language_id, op6_license_scan, op7_simhash, op8_html_text, op9_byte_bpe, op10_token_files)}


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP1_CUTS = ", ".join(f"({i}, {c})" for i, c in enumerate(quality.CUTOFFS))
_OP1_WORST = "greatest(" + ", ".join(f"CASE WHEN {whole} > 0 THEN CAST(floor({part} * 1000 / {whole}) AS BIGINT) ELSE 0 END" for part, whole in quality.RULES.values()) + ")"
#: The chance of k or fewer rejected among n good texts at the allowed risk is at most the level.
_OP1_TEST = f"""k <= {quality.RISK!r} * n AND k < n AND list_sum(list_transform(generate_series(0, k), lambda j: exp(lgamma(n + 1) - lgamma(j + 1) - CASE WHEN n = j THEN 0 ELSE lgamma(n - j + 1) END
  + j * ln({quality.RISK!r}) + (n - j) * ln(1 - {quality.RISK!r})))) <= (SELECT p FROM level)"""


def _op1_cut(name: str, good: str) -> str:
    """CTEs that end in name(s, c): the last cutoff of the strata s of good(s, v) up to which all tests hold."""
    return f"""{name}_k AS (SELECT s, i, c, count(*) AS n, count(*) FILTER (v > c) AS k FROM {good}, (VALUES {_OP1_CUTS}) t(i, c) GROUP BY ALL),
{name}_ok AS (SELECT *, {_OP1_TEST} AS ok FROM {name}_k),
{name} AS (SELECT s, min(c) FILTER (stands) AS c FROM (SELECT *, bool_and(ok) OVER (PARTITION BY s ORDER BY i) AS stands FROM {name}_ok) GROUP BY s)"""


_OP1_SQL = rf"""
WITH w AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM again) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
m0 AS (SELECT doc_id, lang, t, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
  length(t) - length(replace(t, '!', '')) AS n_exclaim, len(regexp_extract_all(t, '\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '\p{{L}}')) AS n_letters
  FROM w JOIN l USING (doc_id) LEFT JOIN rep USING (doc_id)),
m AS (SELECT *, {_OP1_WORST} AS v, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m0),
labelled AS (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
-- a good text counts once in its stratum, however many copies it has
good AS (SELECT lang AS s, t, any_value(v) AS v FROM m JOIN labelled USING (doc_id) WHERE NOT base_failed GROUP BY lang, t HAVING min(q) = 1),
size AS (SELECT s, count(*) AS n FROM good GROUP BY s),
level AS (SELECT {quality.DELTA!r} / greatest(1, count(*)) AS p FROM size),
own_s AS (SELECT s FROM size WHERE s IS NOT NULL AND pow(1 - {quality.RISK!r}, n) <= (SELECT p FROM level)),
own_good AS (SELECT s, v FROM good SEMI JOIN own_s USING (s)),
{_op1_cut("own", "own_good")},
few AS (SELECT v FROM good ANTI JOIN own_s USING (s)),
pool_good AS (SELECT 'pool' AS s, v FROM few WHERE (SELECT pow(1 - {quality.RISK!r}, count(*)) FROM few) <= (SELECT p FROM level)
  UNION ALL SELECT 'pool', v FROM good WHERE (SELECT pow(1 - {quality.RISK!r}, count(*)) FROM few) > (SELECT p FROM level)),
{_op1_cut("pool", "pool_good")},
rest AS (SELECT CASE WHEN (SELECT count(*) FROM few) > 0 THEN (SELECT c FROM pool) WHEN (SELECT count(*) = count(c) FROM own) THEN (SELECT max(c) FROM own) END AS c),
judged AS (SELECT m.*, CASE WHEN own_s.s IS NULL THEN (SELECT c FROM rest) ELSE own.c END AS cut FROM m LEFT JOIN own_s ON m.lang = own_s.s LEFT JOIN own ON m.lang = own.s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(v > cut, false) AS kept FROM judged"""

_OP2_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  -- a turn has its marks and one more character for each escaped control string
  CAST(sum(12 + length(role) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + 11) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

_OP3_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
i AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, array_to_string(w[j + 1:j + least(len(w), 13)], ' ') AS g, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(generate_series(0, greatest(len(w) - 13, 0))) AS j FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, j, n, array_to_string(w[j + 1:j + n], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(0, len(w) - n)) AS j FROM d, sizes WHERE len(w) >= n)),
met AS (SELECT doc_id, j, n, item_id FROM grams JOIN win USING (g, n)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(j, j + n - 1)) AS p FROM met) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

_OP4_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
r AS (SELECT h.*, m.rule, m.verdict, coalesce(m.named, false) AS named FROM h LEFT JOIN (SELECT page_id, arg_max(rh || rp, length(rh || rp)) FILTER (starts_with(path, rp)) AS rule,
  arg_max(verdict, length(rh || rp)) FILTER (starts_with(path, rp)) AS verdict, true AS named FROM h JOIN rules ON host = rh OR ends_with(host, '.' || rh) GROUP BY page_id) m USING (page_id)),
-- the pages of a host that a rule names are labelled: bad if the rules block them
hosts AS (SELECT host, CASE WHEN starts_with(bare, '[') THEN regexp_extract(bare, '^(\[[^\]]*\]?)', 1) ELSE regexp_replace(bare, ':[^:]*$', '') END AS name, n, bad
  FROM (SELECT host, regexp_replace(host, '^.*@', '') AS bare, count(*) FILTER (named) AS n, count(*) FILTER (named AND verdict = 'block') AS bad FROM r GROUP BY host)),
parts AS (SELECT *, str_split(name, '.') AS p, regexp_matches(name, '^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$') AS ip FROM hosts),
long AS (SELECT *, len(p) >= 3 AND length(p[-1]) = 2 AND p[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') AS two FROM parts),
l AS (SELECT host, n, bad, CASE WHEN ip THEN name ELSE array_to_string(p[CASE WHEN two THEN -3 ELSE -2 END:], '.') END AS domain, CASE WHEN ip THEN name ELSE array_to_string(p[CASE WHEN two THEN -2 ELSE -1 END:], '.') END AS suffix FROM long),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM l) AS prior FROM l GROUP BY suffix),
sk AS (SELECT coalesce(least(1000, greatest(1, sum(n * prior * (1 - prior)) / nullif(sum(n * pow(bad / n - prior, 2)), 0) - 1)), 1000) AS k FROM s0 WHERE n > 0),
s1 AS (SELECT suffix, (bad + (SELECT k FROM sk) * prior) / (n + (SELECT k FROM sk)) AS mean FROM s0),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad, any_value(mean) AS prior FROM l JOIN s1 USING (suffix) GROUP BY domain, suffix),
dk AS (SELECT coalesce(least(1000, greatest(1, sum(n * prior * (1 - prior)) / nullif(sum(n * pow(bad / n - prior, 2)), 0) - 1)), 1000) AS k FROM d0 WHERE n > 0),
d1 AS (SELECT domain, (bad + (SELECT k FROM dk) * prior) / (n + (SELECT k FROM dk)) AS mean FROM d0),
h0 AS (SELECT host, n, bad, mean AS prior FROM l JOIN d1 USING (domain)),
hk AS (SELECT coalesce(least(1000, greatest(1, sum(n * prior * (1 - prior)) / nullif(sum(n * pow(bad / n - prior, 2)), 0) - 1)), 1000) AS k FROM h0 WHERE n > 0),
h1 AS (SELECT host, n, bad, (bad + (SELECT k FROM hk) * prior) / (n + (SELECT k FROM hk)) AS mean FROM h0),
h2 AS (SELECT *, mean - 3 * sqrt(mean * (1 - mean) / (n + (SELECT k FROM hk) + 1)) AS bound FROM h1)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, CAST(n AS BIGINT) AS host_pages, CAST(bad AS BIGINT) AS host_bad,
  CAST(round(mean * 1000000) AS BIGINT) AS host_rate, CAST(round(bound * 1000000) AS BIGINT) AS host_bound FROM r JOIN h2 USING (host)"""


def oracle_sql() -> dict[str, str]:
    """SQL for DuckDB; the other operators are held against brute-force versions in the tests."""
    return {"op1_quality_rules": _OP1_SQL, "op2_chat_formatting": _OP2_SQL, "op3_decontamination": _OP3_SQL, "op4_url_filters": _OP4_SQL}
