"""Queries about extraction health and codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.operators import health
from quillstream.session import table

from .corpus_queries import _META, _sq


def extraction_health(spark: SparkSession, folder: str) -> DataFrame:
    return health.extraction_health(table(spark, folder, "raw_text"))


EXTRACTION_HEALTH = r"""
WITH r AS (SELECT DISTINCT file, text AS t FROM raw_text WHERE text IS NOT NULL),
m AS (SELECT file, list_transform(regexp_extract_all(t, '(?m)^--- PAGE ([0-9]+) ---[ \t]*$', 1), lambda x: CAST(x AS INTEGER)) AS numbers,
  list_transform(string_split_regex(t, '(?m)^--- PAGE [0-9]+ ---[ \t]*$'), lambda x: length(regexp_replace(x, '\s', '', 'g'))) AS parts, length(regexp_replace(t, '\s', '', 'g')) AS chars,
  length(regexp_replace(t, '[^\x{0900}-\x{097F}]', '', 'g')) AS devanagari, len(regexp_extract_all(t, '\x{FFFD}|\(cid:[0-9]+\)|[\x{E000}-\x{F8FF}]')) AS broken, length(regexp_replace(t, '[^\x{00C0}-\x{00FF}]', '', 'g')) AS accents FROM r),
s AS (SELECT *, len(numbers) AS pages, len(numbers) > 0 AND numbers = range(1, len(numbers) + 1) AS in_sequence, len(list_filter(CASE WHEN len(parts) > 1 THEN parts[2:] ELSE parts END, lambda n: n < 20)) AS empty_pages FROM m)
SELECT file, CAST(pages AS INTEGER) AS pages, in_sequence, CAST(chars AS INTEGER) AS chars, CAST(empty_pages AS INTEGER) AS empty_pages, CAST(devanagari AS INTEGER) AS devanagari,
  CASE WHEN chars < 500 OR chars < 300 * pages THEN 'NEEDS_OCR' WHEN NOT in_sequence OR broken > 0.01 * chars THEN 'REVIEW' WHEN empty_pages > 0 OR accents > 0.05 * chars THEN 'CHECK' ELSE 'OK' END AS status FROM s"""


def extraction_status(spark: SparkSession, folder: str) -> DataFrame:
    return extraction_health(spark, folder).groupBy("status").agg(F.count("*").alias("files"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))


EXTRACTION_STATUS = f"SELECT status, count(*) AS files, CAST(sum(pages) AS BIGINT) AS pages, CAST(sum(chars) AS BIGINT) AS chars FROM ({EXTRACTION_HEALTH}) GROUP BY status"


def repeated_pages(spark: SparkSession, folder: str) -> DataFrame:
    return health.repeated_pages(table(spark, folder, "page_records"))


REPEATED_PAGES = f"""
WITH p AS (SELECT DISTINCT source_id, page_id, {_sq('text')} AS t FROM page_records)
SELECT source_id, min(page_id) AS first_page, count(*) AS pages FROM p WHERE length(t) > 200 GROUP BY source_id, t HAVING count(*) > 1"""


def pages_numbered_apart(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "page_records").select("page_id", "source_id", "text_hash")
    return health.numbered_apart(p, "page_id", "source_id", "text_hash").select("page_key")


PAGES_NUMBERED_APART = "SELECT page_id || CASE WHEN n > 1 THEN '-dup' || n ELSE '' END AS page_key FROM (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY source_id, text_hash) AS n FROM page_records)"


def documents_out_of_sequence(spark: SparkSession, folder: str) -> DataFrame:
    return health.out_of_sequence(table(spark, folder, "page_records"))


DOCUMENTS_OUT_OF_SEQUENCE = """
SELECT source_id, count(*) AS pages, max(page_number) AS highest FROM (SELECT DISTINCT source_id, page_number FROM page_records) GROUP BY source_id HAVING min(page_number) <> 1 OR count(*) <> max(page_number)"""


def code_checks(spark: SparkSession, folder: str) -> DataFrame:
    return health.code_checks(table(spark, folder, "page_records"), table(spark, folder, "document_metadata"))


CODE_CHECKS = rf"""
WITH {_META}, p AS (SELECT DISTINCT source_id, text FROM page_records WHERE source_id IS NOT NULL),
c AS (SELECT source_id, 'plan_number' AS field, unnest(list_distinct(regexp_extract_all(text, '(?i)\bplan\s*(?:no\.?|number)\s*[:.\-]?\s*([0-9]{{3}})\b', 1))) AS code FROM p
  UNION ALL SELECT source_id, 'uin', unnest(list_distinct(regexp_extract_all(text, '\b([0-9]{{3}}[A-Z][0-9]{{3}}V[0-9]{{2}})\b', 1))) FROM p),
n AS (SELECT source_id, field, code, count(*) AS n FROM c GROUP BY ALL),
f AS (SELECT source_id, field, list(code) AS codes, string_agg(code || ' x ' || n, '; ' ORDER BY n DESC, code) AS in_text FROM n GROUP BY ALL),
k AS (SELECT source_id, 'plan_number' AS field, plan_number AS in_metadata FROM m UNION ALL SELECT source_id, 'uin', uin FROM m),
j AS (SELECT k.source_id, k.field, in_metadata, in_text, codes FROM k JOIN (SELECT DISTINCT source_id FROM p) USING (source_id) LEFT JOIN f ON f.source_id = k.source_id AND f.field = k.field),
i AS (SELECT *, CASE WHEN codes IS NOT NULL AND in_metadata IS NULL THEN 'missing_in_metadata' WHEN codes IS NULL AND in_metadata IS NOT NULL THEN 'not_found_in_text'
  WHEN codes IS NOT NULL AND NOT list_contains(codes, in_metadata) THEN 'conflict' WHEN len(codes) > 1 AND in_metadata IS NOT NULL THEN 'other_values_in_text' END AS issue FROM j)
SELECT source_id, field, issue, in_metadata, in_text FROM i WHERE issue IS NOT NULL"""

NAMES = ("extraction_health", "extraction_status", "repeated_pages", "pages_numbered_apart", "documents_out_of_sequence", "code_checks")
QUERIES = {n: globals()[n] for n in NAMES}
SQL = {n: globals()[n.upper()] for n in NAMES}
