"""The registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontam import find_leaks
from .html_text import extract
from .langid import identify
from .lines import dedup_lines
from .packing import pack
from .pii import find_pii
from .quality import QualityRules, quality
from .simhash import near_duplicates
from .tokens import count_tokens
from .warc import archive


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"), redacted=False)


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_decontam, op3_linededup, op4_html, op5_simhash, op6_warc, op7_pii, op8_tokens, op9_packing, op10_langid)}

_LENGTHS = (4, 5, 6, 8, 10)
_GRAMS = "tk AS (SELECT doc_id, generate_subscripts(w, 1) AS j, unnest(w) AS word FROM d), " + ", ".join(
    f"""g{n} AS (SELECT doc_id, count(*) AS words, sum(length(word)) AS chars FROM (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS j FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM (
 SELECT doc_id, j AS i, {" || ' ' || ".join(f"lead(word, {k}) OVER win" for k in range(n))} AS g FROM tk WINDOW win AS (PARTITION BY doc_id ORDER BY j)) WHERE g IS NOT NULL) WHERE n > 1) JOIN tk USING (doc_id, j) GROUP BY doc_id)"""
    for n in (3, *_LENGTHS)
)
_QUALITY = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents), {_GRAMS},
 l AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
 dup AS (SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS chars FROM l WHERE nth > 1 GROUP BY doc_id),
 m AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(g3.words, 0) AS n_repeat_words, CAST(coalesce(dup.chars, 0) AS BIGINT) AS dup_line_chars,
 {", ".join(f"CAST(coalesce(g{n}.chars, 0) AS BIGINT) AS dup_{n}gram_chars" for n in _LENGTHS)} FROM d LEFT JOIN dup USING (doc_id) {" ".join(f"LEFT JOIN g{n} USING (doc_id)" for n in (3, *_LENGTHS))}),
 b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
 SELECT *, NOT base_failed AND NOT (dup_line_chars > {QualityRules().line_limit}::DOUBLE * word_chars OR {" OR ".join(f"dup_{n}gram_chars > {limit}::DOUBLE * word_chars" for n, limit in QualityRules().ngram_limits)}) AS kept FROM b"""

_LINES = r"""WITH l AS (SELECT doc_id, line, pos, list_distinct(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL)),
 t AS (SELECT doc_id, pos, len(w) AS n, unnest(w) AS word FROM l), df AS (SELECT word, count(*) AS c FROM t GROUP BY word),
 p AS (SELECT doc_id, pos, n, word FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, pos ORDER BY c, word) AS i FROM t JOIN df USING (word)) WHERE i <= n - (4 * n + 4) // 5 + 1),
 c AS (SELECT DISTINCT x.doc_id AS xd, x.pos AS xa, y.doc_id AS yd, y.pos AS ya FROM p x JOIN p y USING (word) WHERE (x.doc_id < y.doc_id OR x.doc_id = y.doc_id AND x.pos < y.pos) AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)),
 gone AS (SELECT DISTINCT yd AS doc_id, ya AS pos FROM c JOIN l x ON x.doc_id = xd AND x.pos = xa JOIN l y ON y.doc_id = yd AND y.pos = ya WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (len(x.w) + len(y.w))),
 k AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE gone.pos IS NULL) AS kept, count(*) AS n_lines, count(gone.pos) AS n_removed FROM l LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id)
 SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text, coalesce(n_removed, 0) AS n_removed, coalesce(n_lines, 0) AS n_lines FROM documents LEFT JOIN k USING (doc_id)"""

_WARC = """WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages), k AS (SELECT h, max(page_id) AS kept FROM p GROUP BY h),
 b AS (SELECT page_id, url, strlen(h) AS payload_bytes, kept, array_to_string(list_transform(string_split(sha1(h), ''), lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), '') AS bits FROM p JOIN k USING (h)),
 d AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest FROM b)
 SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> kept THEN kept END AS refers_to, url FROM d"""

#: The others have no form in SQL: models, alignment, parsers, fingerprints and tokens.
ORACLE_SQL: dict[str, str] = {"op1_quality": _QUALITY, "op3_linededup": _LINES, "op6_warc": _WARC}
