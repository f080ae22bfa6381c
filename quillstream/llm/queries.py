"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstream.session import table

from . import boilerplate, languages, leakage, mixing, repeated_lines, residue, scanned, splitting


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, folder, "cleaned")).select("file", "line_no").distinct().withColumnRenamed("file", "source_file")


def p3_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.remove_repeated_lines(table(spark, folder, "cleaned"), table(spark, folder, "cleaning_summary"))


_LINES = """
rows AS (SELECT source_file, site, text, row_number() OVER () AS r FROM (SELECT DISTINCT source_file, site, text FROM cleaned)),
lines AS (SELECT r, source_file, site, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM rows),
keyed AS (SELECT *, regexp_replace(lower(line), '[^\\p{L}\\p{M}]', '', 'g') AS k FROM lines WHERE site IS NOT NULL),
files AS (SELECT site, count(DISTINCT source_file) AS n FROM rows WHERE site IS NOT NULL GROUP BY site),
often AS (SELECT k, site FROM keyed JOIN files USING (site) WHERE regexp_matches(k, '\\p{L}') GROUP BY k, site, n HAVING count(DISTINCT source_file) >= 5 AND count(DISTINCT source_file) >= 0.2 * n),
gone AS (SELECT DISTINCT r, source_file, site, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN often USING (site, k))
"""
P3_FOUND_SQL = f"WITH {_LINES} SELECT DISTINCT source_file, line_no FROM gone"
P3_CLEANED_SQL = f"""WITH {_LINES},
kept AS (SELECT l.r, l.source_file, l.site, string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL) AS text, count(g.line_no) AS n
         FROM lines l LEFT JOIN gone g ON l.r = g.r AND l.line_no = g.line_no GROUP BY l.r, l.source_file, l.site),
before AS (SELECT source_file, max(lines_removed) AS lines_removed FROM cleaning_summary GROUP BY source_file)
SELECT k.source_file, k.site, coalesce(k.text, '') AS text, CAST(coalesce(b.lines_removed, 0) + k.n AS INTEGER) AS lines_removed
FROM kept k LEFT JOIN before b USING (source_file)"""


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.boundary_kinds(table(spark, folder, "page_records"))


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return splitting.split_texts(table(spark, folder, "page_records").select("page_id", "text").dropDuplicates())


# A paragraph lies between lines that are empty or hold only spaces and tabs. White space is what the operator takes for it.
_SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
P5_FOUND_SQL = rf"""
WITH pages AS (SELECT DISTINCT page_id, text FROM page_records WHERE length(text) > 1200),
split AS (
  SELECT page_id, string_split_regex(text, '(^|\n)[ \t]*(\n[ \t]*)*(\n|$)') AS paragraphs, string_split(text, chr(10)) AS lines,
         string_split_regex(text, '{_SPACE}+') AS words FROM pages),
longest AS (
  SELECT page_id, list_max(list_transform(paragraphs, lambda x: length(x))) AS p, list_max(list_transform(lines, lambda x: length(x))) AS l,
         list_max(list_transform(words, lambda x: length(x))) AS w,
         list_max(list_transform(flatten(list_transform(lines, lambda x: string_split(regexp_replace(x, '([.!?।]){_SPACE}+', '\1' || chr(10), 'g'), chr(10)))), lambda x: length(x))) AS s
  FROM split)
SELECT page_id, CASE WHEN p <= 1200 THEN 'paragraph' WHEN l <= 1200 THEN 'line' WHEN s <= 1200 THEN 'sentence' WHEN w <= 1200 THEN 'word' ELSE 'none' END AS boundary
FROM longest"""


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return p7_report(spark, folder).where("short").select("source")


def p7_mixed(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_records(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


# A token of a byte-level BPE is about four letters here; no source is near the limit, so this measure gives the same sources.
P7_FOUND_SQL = """
WITH sizes AS (SELECT source, sum(strlen(coalesce(text, ''))) AS n FROM documents WHERE trim(source) <> '' GROUP BY source),
whole AS (SELECT sum(n) AS n FROM sizes)
SELECT t.source FROM mix_targets t LEFT JOIN sizes s USING (source), whole WHERE t.max_repeats * coalesce(s.n, 0) < t.target_share * whole.n"""

def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.find_residue(table(spark, folder, "documents")).select("doc_id").distinct()


def p8_kept(spark: SparkSession, folder: str) -> DataFrame:
    return residue.drop_residue(table(spark, folder, "documents"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.leaked_passages(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id").distinct()


def p6_kept(spark: SparkSession, folder: str) -> DataFrame:
    return leakage.drop_leaked(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return languages.wrong_labels(table(spark, folder, "page_records")).select("page_id", "line_no", "lang").distinct()


def p2_languages(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "page_records")
    return languages.assign_languages(pages, languages.fit_on(pages)).distinct()  # equal rows have equal results; no text is shuffled


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return scanned.scan_noise(table(spark, folder, "raw_text"))


def p4_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return scanned.repair_scans(table(spark, folder, "raw_text"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.furniture_lines(table(spark, folder, "web_texts"), table(spark, folder, "web_sources_manifest"))


def p1_main_texts(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.main_texts(table(spark, folder, "web_texts"), table(spark, folder, "web_sources_manifest"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p3_found": p3_found,
    "p3_cleaned": p3_cleaned,
    "p5_found": p5_found,
    "p5_pieces": p5_pieces,
    "p7_found": p7_found,
    "p7_report": p7_report,
    "p7_mixed": p7_mixed,
    "p8_found": p8_found,
    "p8_kept": p8_kept,
    "p6_found": p6_found,
    "p6_kept": p6_kept,
    "p2_found": p2_found,
    "p2_languages": p2_languages,
    "p4_found": p4_found,
    "p4_repaired": p4_repaired,
    "p1_found": p1_found,
    "p1_main_texts": p1_main_texts,
}
SQL: dict[str, str] = {"p3_found": P3_FOUND_SQL, "p3_cleaned": P3_CLEANED_SQL, "p5_found": P5_FOUND_SQL, "p7_found": P7_FOUND_SQL}
