"""Queries over pages, documents and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions import pages as P
from quillstream.functions import text as T
from quillstream.operators import assembly, chunking, cleaning, corpus, overlap, reports
from quillstream.session import cut, table
from quillstream.sources import records

FIELDS = ("title", "authority", "document_type", "product", "plan_number", "uin", "version", "effective_date", "status")
_BLANK = "[ \\t\\n\\x0B\\f\\r]"
_SQUASH = "trim(regexp_replace({0}, '" + _BLANK + "+', ' ', 'g'))"


def _sq(x: str) -> str:
    return _SQUASH.format(x)


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "page_records")


def _once(rows: DataFrame, key: str, *computed) -> DataFrame:
    """`computed` for each different (key, text): worked out where the text is read, so that its hash is shuffled and not the text."""
    return rows.select(key, F.xxhash64("text").alias("_text"), *computed).distinct().drop("_text")


def page_text_stats(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _once(_pages(spark, folder), "page_id", F.length(text).alias("chars"), T.word_count(text).alias("words"), T.line_count(text).alias("lines"), T.nonspace_length(text).alias("nonspace"), F.sha2("text", 256).alias("text_hash"))


PAGE_TEXT_STATS = f"""
WITH p AS (SELECT DISTINCT page_id, text FROM page_records)
SELECT page_id, length(text) AS chars, CASE WHEN {_sq('text')} = '' THEN 0 ELSE len(string_split({_sq('text')}, ' ')) END AS words,
       CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS lines, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS nonspace, sha256(text) AS text_hash FROM p"""


def page_hash_check(spark: SparkSession, folder: str) -> DataFrame:
    said = (F.col("text_hash").alias("_hash"), F.col("char_count").alias("_count"))
    return _once(_pages(spark, folder), "page_id", *said, (F.sha2("text", 256) == F.col("text_hash")).alias("hash_ok"), (F.length("text") == F.col("char_count")).alias("length_ok")).drop("_hash", "_count")


PAGE_HASH_CHECK = "WITH p AS (SELECT DISTINCT page_id, text, text_hash, char_count FROM page_records) SELECT page_id, sha256(text) = text_hash AS hash_ok, length(text) = char_count AS length_ok FROM p"


def spoken_forms(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", T.spoken_form(F.col("text")).alias("spoken"))


SPOKEN_FORMS = "SELECT doc_id, " + _sq(r"regexp_replace(lower(text), '[^\p{L}\p{N}_\s]', ' ', 'g')") + " AS spoken FROM documents"


def script_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _once(_pages(spark, folder), "page_id", T.script_label(F.col("text")).alias("script"), T.two_script_label(F.col("text")).alias("two_script"))


SCRIPT_LABELS = r"""
WITH p AS (SELECT DISTINCT page_id, text FROM page_records),
c AS (SELECT page_id, text, length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS a, length(regexp_replace(regexp_replace(text, '[^\p{L}]', '', 'g'), '[^\x{0900}-\x{097F}]', '', 'g')) AS d,
      length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS l FROM p)
SELECT page_id, CASE WHEN a < 15 THEN 'Unknown' WHEN d >= 0.7 * a THEN 'Hindi' WHEN d >= 5 AND d >= 0.03 * a THEN 'Mixed' WHEN l >= 0.8 * a THEN 'English' ELSE 'Unknown' END AS script,
       CASE WHEN NOT regexp_matches(text, '[\x{0900}-\x{097F}]') THEN 'English' WHEN NOT regexp_matches(text, '[A-Za-z]') THEN 'Hindi' ELSE 'Mixed' END AS two_script FROM c"""


def normalised_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "raw_text").distinct().select("file", T.normalised(F.col("text")).alias("text"))


NORMALISED_DOCUMENTS = rf"""
WITH r AS (SELECT DISTINCT file, text FROM raw_text),
a AS (SELECT file, regexp_replace(text, '(?im)^[ \t]*---[ \t]*page[ \t]+([0-9]+)[ \t]*---[ \t]*$', '--- PAGE \1 ---', 'g') AS t FROM r),
b AS (SELECT file, regexp_replace(t, '(?m)^([ \t\r\f\v]*)[{T.BULLET_GLYPHS}][ \t\r\f\v]*', '\1-', 'g') AS t FROM a),
c AS (SELECT file, regexp_replace(t, '[ \t]{{2,}}', ' ', 'g') AS t FROM b),
d AS (SELECT file, regexp_replace(regexp_replace(t, '\r\n?', chr(10), 'g'), '(?m)[ \t]+$', '', 'g') AS t FROM c)
SELECT file, regexp_replace(regexp_replace(t, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), '^{_BLANK}+|{_BLANK}+$', '', 'g') || chr(10) AS text FROM d"""


def empty_pages(spark: SparkSession, folder: str) -> DataFrame:
    return _once(_pages(spark, folder), "page_id", T.emptiness(F.col("text")).alias("kind"), T.analysable(F.col("text")).alias("analysable")).where("kind is not null")


EMPTY_PAGES = f"""
WITH p AS (SELECT page_id, text, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS n FROM (SELECT DISTINCT page_id, text FROM page_records))
SELECT page_id, CASE WHEN n = 0 THEN 'empty_page' ELSE 'near_empty_page' END AS kind, FALSE AS analysable FROM p WHERE n < 20"""


def extraction_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return _once(table(spark, folder, "raw_text"), "file", F.regexp_count("text", F.lit(r"\x{FFFD}")).alias("replaced"), F.size(T.anomalies(F.col("text"))).alias("kinds")).where("kinds > 0")


EXTRACTION_ANOMALIES = r"""
WITH r AS (SELECT DISTINCT file, text FROM raw_text), c AS (SELECT file, len(regexp_extract_all(text, '\x{FFFD}')) AS a, len(regexp_extract_all(text, '[\x{E000}-\x{F8FF}]')) AS b, len(regexp_extract_all(text, '\(cid:[0-9]+\)')) AS c,
  length(regexp_replace(text, '\s', '', 'g')) > 0 AND NOT regexp_matches(text, '[\p{L}\p{N}]') AS d FROM r)
SELECT file, CAST(a AS INTEGER) AS replaced, CAST((a > 0)::INT + (b > 0)::INT + (c > 0)::INT + d::INT AS INTEGER) AS kinds FROM c WHERE a > 0 OR b > 0 OR c > 0 OR d"""


def page_headings(spark: SparkSession, folder: str) -> DataFrame:
    found = _once(_pages(spark, folder), "page_id", P.headings(F.col("text")).alias("h"), P.section(F.col("text")).alias("section"))
    return found.where(F.size("h") > 0).select("page_id", F.array_join("h", "|").alias("headings"), F.array_join(P.topics(F.col("h")), "|").alias("topics"), "section")


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_contained(text: str, words: tuple[str, ...]) -> str:
    return f"len(list_filter({_sql_list(words)}, lambda w: contains(lower({text}), w)))"


_TRIMMED_LINES = r"list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda x: x <> '')"
_BARE = _sq(r"""regexp_replace(regexp_replace(x.plain, ':+$', ''), '^[\s"“”'']+|[\s"“”'']+$', '', 'g')""")
_NAMES = "|".join(n for n, _, _ in sorted(P.HEADINGS, key=lambda h: -len(h[0])))
#: Known headings of each (id, text) of a table p, in order, each once: h.
_HEADINGS = rf"""
hl AS (SELECT *, {_TRIMMED_LINES} AS lines FROM p),
hp AS (SELECT *, list_transform(lines, lambda x: {{'line': x, 'plain': trim(regexp_replace(x, '{P.LEADING_NUMBER}', ''))}}) AS parts FROM hl),
hk AS (SELECT * EXCLUDE (parts), list_transform(list_filter(parts, lambda x: length(x.line) <= 200 AND NOT regexp_matches(x.line, '^(?:- |•)') AND regexp_matches(x.plain, '^\p{{Lu}}')),
  lambda x: CASE WHEN regexp_matches(x.plain, '(?i)^({_NAMES})\s*[:–—-]\s*\S') THEN lower(regexp_extract(x.plain, '(?i)^({_NAMES})\s*[:–—-]\s*\S', 1))
    WHEN length(x.plain) <= 60 THEN lower({_BARE}) END) AS keys FROM hp),
hn AS (SELECT *, list_filter(list_transform(keys, lambda k: {_sql_list(n for n, _, _ in P.HEADINGS)}[list_position({_sql_list(n.lower() for n, _, _ in P.HEADINGS)}, k)]), lambda x: x IS NOT NULL) AS found FROM hk),
hd AS (SELECT * EXCLUDE (keys, found), list_filter(found, lambda x, i: list_position(found, x) = i) AS h FROM hn)"""


def _sql_by_heading(name: str, place: int) -> str:
    return f"{_sql_list(x[place] for x in P.HEADINGS)}[list_position({_sql_list(n for n, _, _ in P.HEADINGS)}, {name})]"


PAGE_HEADINGS = f"""
WITH p AS (SELECT DISTINCT page_id, text FROM page_records), {_HEADINGS}, t AS (SELECT page_id, h, list_transform(h, lambda x: {_sql_by_heading('x', 1)}) AS t FROM hd WHERE len(h) > 0)
SELECT page_id, array_to_string(h, '|') AS headings, array_to_string(list_filter(t, lambda x, i: list_position(t, x) = i), '|') AS topics, h[1] AS section FROM t"""


def page_tables(spark: SparkSession, folder: str) -> DataFrame:
    return _once(_pages(spark, folder), "page_id", P.table_signal(F.col("text")).alias("table_signal"))


PAGE_TABLES = r"""
WITH p AS (SELECT DISTINCT page_id, text FROM page_records),
l AS (SELECT page_id, text, string_split(text, chr(10)) AS raw, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda x: x <> '') AS lines FROM p),
c AS (SELECT page_id, len(lines) AS n, len(list_filter(lines, lambda x: length(x) <= 40 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '^[0-9\s,.%₹/\-–()]+$'))) AS num,
      len(list_filter(raw, lambda x: regexp_matches(x, '\|.*\||\t.*\t'))) AS piped, regexp_matches(text, '(?i)\btable\s+[0-9]+\b|\bpremium\s+rates?\b|\brate\s+table\b') AS titled FROM l)
SELECT page_id, CASE WHEN (num >= 12 AND num >= 0.35 * n) OR piped >= 3 THEN 'table' WHEN (num >= 6 AND num >= 0.2 * n) OR (titled AND num >= 4) THEN 'possible' ELSE 'none' END AS table_signal FROM c"""


def page_forms(spark: SparkSession, folder: str) -> DataFrame:
    found = _once(_pages(spark, folder), "page_id", P.form_evidence(F.col("text")).alias("e"))
    return found.select("page_id", P.form_signal_of(F.col("e")).alias("form_signal"), "e.*")


PAGE_FORMS = r"""
WITH p AS (SELECT DISTINCT page_id, text FROM page_records),
l AS (SELECT page_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda x: x <> '') AS lines FROM p),
c AS (SELECT page_id, len(list_filter(lines, lambda x: regexp_matches(x, '_{4,}') OR (regexp_matches(x, '\.{8,}') AND NOT regexp_matches(x, '\.{8,}\s*[0-9]+\s*$')))) AS b,
      len(list_filter(lines, lambda x: regexp_matches(x, '^[A-Z][A-Za-z /()'']{2,40}:$'))) AS l,
      len(list_distinct(list_transform(regexp_extract_all(text, '(?i)\b(signature|declaration|applicant|proposer|policyholder|life\s+assured|witness|thumb\s+impression)\b', 1), lambda w: lower(trim(regexp_replace(w, '\s+', ' ', 'g')))))) AS s FROM l)
SELECT page_id, CASE WHEN b >= 3 OR (b >= 1 AND s >= 2) THEN 'form' WHEN b >= 1 OR l >= 3 THEN 'possible' ELSE 'none' END AS form_signal,
       CAST(b AS INTEGER) AS blank_field_lines, CAST(l AS INTEGER) AS label_only_lines, CAST(s AS INTEGER) AS signature_words FROM c"""


def page_keywords(spark: SparkSession, folder: str) -> DataFrame:
    found = _once(_pages(spark, folder), "page_id", P.keyword_hits(F.col("text")).alias("hits"))
    return found.select("page_id", F.explode_outer("hits").alias("keyword")).where("keyword is not null")


PAGE_KEYWORDS = "WITH p AS (SELECT DISTINCT page_id, text FROM page_records), k AS (SELECT unnest([{}]) AS keyword) SELECT page_id, keyword FROM p, k WHERE regexp_matches(text, '(?i)\\b' || keyword || '\\b')".format(", ".join(f"'{k}'" for k in P.KEYWORDS))


def personal_data_status(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select("doc_id", P.personal_status(F.col("text")).alias("status"), F.size(P.personal_data(F.col("text"))).alias("kinds"))


_FORM_COUNTS = r"""
len(list_filter(lines, lambda x: regexp_matches(x, '_{4,}') OR (regexp_matches(x, '\.{8,}') AND NOT regexp_matches(x, '\.{8,}\s*[0-9]+\s*$')))) AS blanks,
len(list_filter(lines, lambda x: regexp_matches(x, '^[A-Z][A-Za-z /()'']{2,40}:$'))) AS labels,
len(list_distinct(list_transform(regexp_extract_all(text, '(?i)\b(signature|declaration|applicant|proposer|policyholder|life\s+assured|witness|thumb\s+impression)\b', 1), lambda w: lower(trim(regexp_replace(w, '\s+', ' ', 'g')))))) AS signatures"""
_KINDS_FOUND = " + ".join(f"CAST(regexp_matches(text, '{x}') AS INTEGER)" for x in P.PERSONAL.values())
PERSONAL_DATA_STATUS = rf"""
WITH p AS (SELECT doc_id, text, {_TRIMMED_LINES} AS lines FROM documents),
c AS (SELECT doc_id, text, {_KINDS_FOUND} AS firm, CAST(regexp_matches(text, '{P.EMAIL}') AS INTEGER) + CAST(regexp_matches(text, '{P.PHONE}') AS INTEGER) AS contacts, {_FORM_COUNTS} FROM p)
SELECT doc_id, CASE WHEN text IS NULL OR length(regexp_replace(text, '{_BLANK}', '', 'g')) < 20 OR regexp_matches(text, '\x{{FFFD}}|\(cid:[0-9]+\)') THEN 'unknown' WHEN firm > 0 THEN 'possible_pii'
  WHEN contacts > 0 THEN CASE WHEN {_sql_contained('text', P.CONTACT_WORDS)} > 0 THEN 'public_contact_information' ELSE 'possible_pii' END
  WHEN blanks > 0 OR labels >= 3 THEN 'template_fields' ELSE 'none_detected' END AS status, CAST(coalesce(firm + contacts, 0) AS INTEGER) AS kinds FROM c"""


def redacted_previews(spark: SparkSession, folder: str) -> DataFrame:
    d = table(spark, folder, "documents")
    return d.select("doc_id", T.preview(F.col("text")).alias("preview"))


def content_kinds(spark: SparkSession, folder: str) -> DataFrame:
    p = _once(_pages(spark, folder), "page_id", P.content_evidence(F.col("text")).alias("e"))
    return p.select("page_id", P.content_kind(F.col("e")).alias("kind"), F.array_join(F.transform("e", lambda e: e["basis"]), "|").alias("basis"))


#: The evidence for the kind of content of each row of hd, and the kinds of the best rank.
_CONTENT = rf"""
m AS (SELECT page_id, h, text, {_FORM_COUNTS}, len(lines) AS n, len(list_filter(lines, lambda x: length(x) <= 40 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '{P.NUMERIC_LINE}'))) AS num,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\|.*\||\t.*\t'))) AS piped, {_sql_contained('text', P.CONTACT_WORDS)} + len(regexp_extract_all(text, '{P.EMAIL}')) AS contacts,
  len(regexp_extract_all(text, '{P.DEFINED_TERM}')) AS defined, len(list_filter(lines, lambda x: regexp_matches(x, '(?i)^step\s*[0-9]+\b'))) AS steps, {_sql_contained('text', P.COMPLIANCE_PHRASES)} AS compliance FROM hd),
e AS (SELECT page_id, list_filter([
  CASE WHEN blanks >= 3 OR (blanks >= 1 AND signatures >= 2) THEN {{'kind': 'form', 'rank': CASE WHEN blanks >= 3 THEN 3 ELSE 2 END, 'basis': 'form_fields'}} END,
  CASE WHEN contacts >= 2 THEN {{'kind': 'contact', 'rank': CASE WHEN contacts >= 5 THEN 3 ELSE 2 END, 'basis': 'contact_details'}} END,
  CASE WHEN (num >= 12 AND num >= 0.35 * n) OR piped >= 3 THEN {{'kind': 'table', 'rank': 2, 'basis': 'table_lines'}} END,
  CASE WHEN defined >= 3 THEN {{'kind': 'definition', 'rank': 3, 'basis': 'defined_terms'}} END,
  CASE WHEN steps >= 2 THEN {{'kind': 'procedure', 'rank': 2, 'basis': 'step_lines'}} END,
  CASE WHEN compliance > 0 AND length(text) < 400 THEN {{'kind': 'disclaimer', 'rank': 2, 'basis': 'compliance_phrase'}} END], lambda x: x IS NOT NULL)
  || list_transform(h, lambda x: {{'kind': {_sql_by_heading('x', 2)}, 'rank': 2, 'basis': 'heading:' || x}}) AS e FROM m),
b AS (SELECT page_id, e, list_max(list_transform(e, lambda x: x.rank)) AS best FROM e),
t AS (SELECT page_id, e, list_distinct(list_transform(list_filter(e, lambda x: x.rank = best), lambda x: x.kind)) AS top FROM b)"""
CONTENT_KINDS = f"WITH p AS (SELECT DISTINCT page_id, text FROM page_records), {_HEADINGS}, {_CONTENT} SELECT page_id, CASE WHEN len(e) = 0 THEN 'unknown' WHEN len(top) = 1 THEN top[1] ELSE 'mixed' END AS kind, array_to_string(list_transform(e, lambda x: x.basis), '|') AS basis FROM t"


def plan_and_product_codes(spark: SparkSession, folder: str) -> DataFrame:
    p = _once(_pages(spark, folder), "source_id", F.concat(T.plan_numbers(F.col("text")), T.product_codes(F.col("text"))).alias("codes"))
    return p.select("source_id", F.explode_outer("codes").alias("code")).where("code is not null").groupBy("source_id", "code").agg(F.count("*").alias("pages"))


PLAN_AND_PRODUCT_CODES = r"""
WITH p AS (SELECT DISTINCT source_id, text FROM page_records),
c AS (SELECT source_id, unnest(list_concat(list_distinct(regexp_extract_all(text, '(?i)\bplan\s*(?:no\.?|number)\s*[:.\-]?\s*([0-9]{3})\b', 1)), list_distinct(regexp_extract_all(text, '\b([0-9]{3}[A-Z][0-9]{3}V[0-9]{2})\b', 1)))) AS code FROM p)
SELECT source_id, code, count(*) AS pages FROM c GROUP BY ALL"""


def code_summary(spark: SparkSession, folder: str) -> DataFrame:
    p = _once(_pages(spark, folder), "page_id", "source_id", T.product_codes(F.col("text")).alias("codes"))
    each = p.select("source_id", F.explode_outer("codes").alias("code")).where("code is not null")
    return corpus.value_summary(each, "source_id", "code")


CODE_SUMMARY = r"""
WITH p AS (SELECT DISTINCT page_id, source_id, text FROM page_records), c AS (SELECT source_id, unnest(list_distinct(regexp_extract_all(text, '\b([0-9]{3}[A-Z][0-9]{3}V[0-9]{2})\b', 1))) AS code FROM p),
n AS (SELECT source_id, code, count(*) AS n FROM c GROUP BY ALL)
SELECT source_id, string_agg(code || ' x ' || n, '; ' ORDER BY n DESC, code) AS summary FROM n GROUP BY source_id"""


def file_metadata_match(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.match_files(_pages(spark, folder), corpus.clean_metadata(table(spark, folder, "document_metadata")))


_META = "m AS (SELECT DISTINCT ON (source_id) * FROM (SELECT DISTINCT {} FROM document_metadata) ORDER BY source_id, {})"
_META_COLUMNS = ("source_id", "filename", "file_exists", "title", "authority", "document_type", "product", "plan_number", "uin", "version", "effective_date", "language", "status")
_META = _META.format(", ".join(c if c == "file_exists" else f"CASE WHEN lower(trim({c})) NOT IN ('', 'null', 'none', 'nan') THEN trim({c}) END AS {c}" for c in _META_COLUMNS), ", ".join(f"{c} NULLS LAST" for c in _META_COLUMNS if c != "source_id"))
_STEM = "lower(" + _sq(r"regexp_replace(regexp_replace({0}, '^.*[/\\]', ''), '\.[A-Za-z0-9]+$', '')") + ")"
_ID = r"CASE WHEN regexp_matches({0}, '^\s*([A-Za-z]+)[\s_\-]*([0-9]+[A-Za-z]?)') THEN upper(regexp_extract({0}, '^\s*([A-Za-z]+)[\s_\-]*([0-9]+[A-Za-z]?)', 1) || '-' || regexp_extract({0}, '^\s*([A-Za-z]+)[\s_\-]*([0-9]+[A-Za-z]?)', 2)) END"
FILE_METADATA_MATCH = f"""
WITH {_META}, f AS (SELECT DISTINCT filename AS file FROM page_records WHERE filename IS NOT NULL),
s AS (SELECT {_STEM.replace('{0}', 'filename')} AS stem, min(source_id) AS stem_source FROM m GROUP BY 1),
i AS (SELECT {_ID.replace('{0}', 'source_id')} AS id, min(source_id) AS id_source FROM m GROUP BY 1 HAVING count(DISTINCT source_id) = 1)
SELECT file, coalesce(stem_source, id_source) AS source, CASE WHEN stem_source IS NOT NULL THEN 'stem' WHEN id_source IS NOT NULL THEN 'id' ELSE 'none' END AS matched_by, coalesce(stem_source <> id_source, FALSE) AS warning
FROM f LEFT JOIN s ON {_STEM.replace('{0}', 'file')} = stem LEFT JOIN i ON {_ID.replace('{0}', 'file')} = id"""


def sources_without_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.without_partner(_pages(spark, folder), table(spark, folder, "document_metadata"), "source_id")


SOURCES_WITHOUT_METADATA = "SELECT DISTINCT source_id FROM page_records WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM document_metadata WHERE source_id IS NOT NULL)"


def metadata_without_pages(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.without_partner(table(spark, folder, "document_metadata"), _pages(spark, folder), "source_id")


METADATA_WITHOUT_PAGES = "SELECT DISTINCT source_id FROM document_metadata WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM page_records WHERE source_id IS NOT NULL)"


def metadata_differences(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.metadata_differences(_pages(spark, folder), table(spark, folder, "document_metadata"), FIELDS)


_NW = "CASE WHEN lower(trim({0})) NOT IN ('', 'null', 'none', 'nan') THEN trim({0}) END"
METADATA_DIFFERENCES = f"""
WITH {_META}, p AS (SELECT DISTINCT source_id, {', '.join(_NW.format(f) + ' AS ' + f for f in FIELDS)} FROM page_records),
e AS ({' UNION ALL '.join(f"SELECT p.source_id, '{f}' AS field, p.{f} AS page_value, m.{f} AS metadata_value FROM p JOIN m USING (source_id)" for f in FIELDS)})
SELECT DISTINCT source_id, field, page_value, metadata_value, CASE WHEN page_value IS NULL OR metadata_value IS NULL THEN 'metadata_completeness_difference' ELSE 'page_records_differ_from_metadata' END AS issue,
       CASE WHEN page_value IS NOT NULL AND metadata_value IS NOT NULL AND field IN ('plan_number', 'uin') THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM e WHERE page_value IS DISTINCT FROM metadata_value"""


def differing_fields(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.differing_fields(_pages(spark, folder), (*FIELDS, "language"))


DIFFERING_FIELDS = "SELECT * FROM (" + " UNION ALL ".join(f"SELECT source_id, '{f}' AS field, count(DISTINCT {f}) AS n FROM page_records GROUP BY source_id" for f in (*FIELDS, "language")) + ") WHERE n > 1"


def page_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.neighbours(_pages(spark, folder).select("source_id", "page_number", "page_id").distinct())


PAGE_NEIGHBOURS = "WITH p AS (SELECT DISTINCT source_id, page_number, page_id FROM page_records) SELECT page_id, lag(page_id) OVER w AS previous, lead(page_id) OVER w AS next FROM p WINDOW w AS (PARTITION BY source_id ORDER BY page_number, page_id)"


def section_carried(spark: SparkSession, folder: str) -> DataFrame:
    p = _pages(spark, folder).select("source_id", "page_number", "page_id", "section").distinct()
    return corpus.carried_section(p, "section")


SECTION_CARRIED = """
WITH p AS (SELECT DISTINCT source_id, page_number, page_id, section FROM page_records)
SELECT page_id, last_value(section IGNORE NULLS) OVER w AS section_at_start, last_value(CASE WHEN section IS NOT NULL THEN page_number END IGNORE NULLS) OVER w AS from_page
FROM p WINDOW w AS (PARTITION BY source_id ORDER BY page_number, page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def page_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.missing_pages(_pages(spark, folder))


PAGE_GAPS = """
WITH p AS (SELECT DISTINCT source_id, page_number FROM page_records WHERE page_number >= 1), s AS (SELECT *, coalesce(lag(page_number) OVER (PARTITION BY source_id ORDER BY page_number), 0) AS before FROM p)
SELECT source_id, before + 1 AS first_missing, page_number - 1 AS last_missing FROM s WHERE page_number > before + 1"""


def duplicate_page_ids(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.duplicate_keys(_pages(spark, folder), "page_id")


DUPLICATE_PAGE_IDS = "SELECT page_id, count(*) AS n FROM page_records GROUP BY page_id HAVING count(*) > 1"


def exact_classes(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.exact_classes(table(spark, folder, "documents"), "doc_id", "text")


EXACT_CLASSES = f"""
WITH d AS (SELECT doc_id, {_sq('text')} AS t FROM documents), c AS (SELECT t, min(doc_id) AS class_id, count(*) AS members FROM d WHERE t <> '' GROUP BY t)
SELECT doc_id, class_id, members FROM d JOIN c USING (t)"""


def ordered_dedup(spark: SparkSession, folder: str) -> DataFrame:
    p = _pages(spark, folder).select("page_id", "source_id", "page_number", "text").where(F.length(T.squash(F.col("text"))) > 0)
    return corpus.ordered_dedup(p, T.content_hash(F.col("text")), F.col("source_id"), F.col("page_number"), F.col("page_id")).select("page_id", "source_id", "page_number")


ORDERED_DEDUP = f"SELECT DISTINCT ON ({_sq('text')}) page_id, source_id, page_number FROM page_records WHERE {_sq('text')} <> '' ORDER BY {_sq('text')}, source_id, page_number, page_id"


def round_robin_sample(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.round_robin_sample(_pages(spark, folder).select("source_id", "page_number", "page_id").distinct(), 500)


ROUND_ROBIN_SAMPLE = """
WITH p AS (SELECT DISTINCT source_id, page_number, page_id FROM page_records), r AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY page_number, page_id) AS r FROM p)
SELECT source_id, page_number, page_id FROM r ORDER BY r, source_id, page_id LIMIT 500"""


def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.null_counts(_pages(spark, folder), (*FIELDS, "language", "section"))


NULL_COUNTS = " UNION ALL ".join(f"SELECT '{f}' AS column, count(*) - count({f}) AS nulls FROM page_records" for f in (*FIELDS, "language", "section"))


def reason_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.reason_histogram(_pages(spark, folder))


REASON_HISTOGRAM = """
WITH r AS (SELECT unnest(review_reasons) AS r FROM page_records)
SELECT CASE WHEN starts_with(r, 'doc_metadata_missing') THEN 'doc_metadata_missing' ELSE r END AS reason, count(*) AS pages FROM r GROUP BY 1"""


def source_summary(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.source_summary(_pages(spark, folder))


SOURCE_SUMMARY = """
SELECT source_id, count(*) AS pages, count_if(section IS NULL) AS no_section, count_if(content_type = 'unknown') AS unknown_type, count_if(pii_status = 'possible_pii') AS possible_pii, count_if(contains_table) AS tables,
       count_if(contains_form) AS forms, count_if(review_required) AS to_review, CAST(sum(char_count) AS BIGINT) AS characters FROM page_records GROUP BY source_id"""


def review_queue(spark: SparkSession, folder: str) -> DataFrame:
    q = corpus.review_queue(_pages(spark, folder))
    return q.withColumn("reasons", F.array_join("reasons", ","))


REVIEW_QUEUE = f"""
WITH p AS (SELECT source_id, page_number, page_id, length(regexp_replace(coalesce(text, ''), '{_BLANK}', '', 'g')) AS n, * EXCLUDE (source_id, page_number, page_id) FROM page_records),
r AS (
  SELECT source_id, page_number, page_id, unnest([
    CASE WHEN n = 0 THEN '0HIGH:empty_page' END, CASE WHEN n > 0 AND n < 20 THEN '0HIGH:near_empty_page' END, CASE WHEN pii_status = 'possible_pii' THEN '0HIGH:possible_pii' END,
    CASE WHEN contains_table THEN '1MEDIUM:table_detected' END, CASE WHEN contains_form THEN '1MEDIUM:form_detected' END, CASE WHEN signals.private_use_char_count > 0 THEN '0HIGH:extraction_anomaly' END,
    CASE WHEN signals.ocr_derived THEN '1MEDIUM:ocr_derived_verify_numbers' END, CASE WHEN language IS NULL OR lower(trim(language)) IN ('', 'null', 'none', 'nan') OR lower(language) = 'unknown' THEN '1MEDIUM:unknown_language' END,
    CASE WHEN section IS NULL THEN '2LOW:unknown_section' END, CASE WHEN content_type = 'unknown' THEN '2LOW:unknown_content_type' END, CASE WHEN content_type_confidence = 'low' THEN '2LOW:low_confidence_content_type' END,
    CASE WHEN section IS NULL AND content_type = 'unknown' THEN '1MEDIUM:no_section_and_no_content_type' END,
    CASE WHEN title IS NULL OR lower(trim(title)) IN ('', 'null', 'none', 'nan') THEN '1MEDIUM:doc_metadata_missing:title' END,
    CASE WHEN authority IS NULL OR lower(trim(authority)) IN ('', 'null', 'none', 'nan') THEN '1MEDIUM:doc_metadata_missing:authority' END]) AS x FROM p),
d AS (SELECT DISTINCT * FROM r WHERE x IS NOT NULL)
SELECT source_id, page_number, page_id, regexp_extract(min(x), '^[0-9]([A-Z]+):', 1) AS priority, string_agg(substr(x, 2), ',' ORDER BY x) AS reasons,
       bool_or(regexp_replace(x, '^[0-9][A-Z]+:', '') IN ({', '.join(repr(h) for h in corpus.HARD_REASONS)})) AS review_required
FROM d GROUP BY source_id, page_number, page_id"""


def priority_rollup(spark: SparkSession, folder: str) -> DataFrame:
    q = corpus.review_queue(_pages(spark, folder))
    return q.rollup("source_id", "priority").agg(F.count("*").alias("pages"))


PRIORITY_ROLLUP = f"WITH q AS ({REVIEW_QUEUE}) SELECT source_id, priority, count(*) AS pages FROM q GROUP BY ROLLUP (source_id, priority)"


def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    p = _pages(spark, folder)
    return p.groupBy("content_type", "pii_status").agg(F.count("*").alias("pages"), F.count_distinct("source_id").alias("sources"))


CATEGORY_COUNTS = "SELECT content_type, pii_status, count(*) AS pages, count(DISTINCT source_id) AS sources FROM page_records GROUP BY ALL"


def record_problems(spark: SparkSession, folder: str) -> DataFrame:
    found = records.record_problems(_pages(spark, folder).select("page_id", "source_id", "page_number", "text"))
    return _once(found, "page_id", "source_id", "page_number", "problems").select("page_id", F.explode("problems").alias("problem"))


RECORD_PROBLEMS = """
WITH p AS (SELECT DISTINCT page_id, source_id, page_number, text FROM page_records),
r AS (SELECT page_id, unnest([CASE WHEN source_id IS NULL OR lower(trim(source_id)) IN ('', 'null', 'none', 'nan') THEN 'missing_source_id' END, CASE WHEN page_number IS NULL THEN 'page_number_not_an_integer' END, CASE WHEN page_number < 1 THEN 'page_number_below_1' END,
  CASE WHEN page_id IS NULL OR lower(trim(page_id)) IN ('', 'null', 'none', 'nan') THEN 'missing_page_id' END, CASE WHEN text IS NULL OR trim(text) = '' THEN 'missing_text' END]) AS problem FROM p)
SELECT page_id, problem FROM r WHERE problem IS NOT NULL"""


def chunk_windows(spark: SparkSession, folder: str) -> DataFrame:
    each = _pages(spark, folder).select("page_id", F.xxhash64("text").alias("_text"), F.posexplode(T.word_windows(F.col("text"))).alias("window_no", "words"))
    return each.select("page_id", "_text", "window_no", F.size("words").alias("words"), F.sha2(F.array_join("words", " "), 256).alias("window_hash")).distinct().drop("_text")


CHUNK_WINDOWS = f"""
WITH p AS (SELECT page_id, list_filter(string_split({_sq('text')}, ' '), lambda w: w <> '') AS w FROM (SELECT DISTINCT page_id, text FROM page_records)),
i AS (SELECT page_id, w, unnest(range(0, greatest(0, CAST(ceil((len(w) - 218) / 168.0) AS BIGINT)) + 1)) AS window_no FROM p WHERE len(w) > 0),
s AS (SELECT page_id, window_no, w[window_no * 168 + 1 : window_no * 168 + 218] AS part FROM i)
SELECT page_id, CAST(window_no AS INTEGER) AS window_no, CAST(len(part) AS INTEGER) AS words, sha256(array_to_string(part, ' ')) AS window_hash FROM s"""


def chunk_pack(spark: SparkSession, folder: str) -> DataFrame:
    chunked = chunking.chunk_records(chunking.chunk_pages(_pages(spark, folder)), _pages(spark, folder))
    return chunked.select("chunk_id", "page_id", "chunk_index", "chunk_token_count", "chunk_length", "text_hash").distinct()


def chunk_token_stats(spark: SparkSession, folder: str) -> DataFrame:
    p = _pages(spark, folder)
    each = chunking.chunk_pages(p).select("page_id", "chunk_index", "chunk_token_count", F.xxhash64("text").alias("_text")).distinct().join(p.select("page_id", "source_id").distinct(), "page_id")
    return each.groupBy("source_id").agg(F.count("*").alias("chunks"), F.min("chunk_token_count").alias("least"), F.max("chunk_token_count").alias("most"), F.round(F.avg("chunk_token_count"), 4).alias("mean"), F.count_if(F.col("chunk_token_count") > chunking.LIMIT).alias("over_limit"))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.near_duplicate_classes(table(spark, folder, "documents"), "doc_id", "text")


def containment_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.containment_pairs(table(spark, folder, "documents"), "doc_id", "text")


_CONTAINED = f"""
d AS (SELECT lower({_sq('text')}) AS t, min(doc_id) AS class_id FROM documents GROUP BY 1 HAVING t <> ''),
w AS (SELECT class_id, string_split(t, ' ') AS w FROM d),
s AS (SELECT class_id, list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS marks FROM w WHERE len(w) >= 5),
e AS (SELECT class_id, len(marks) AS n, unnest(marks) AS mark FROM s),
c AS (SELECT a.class_id AS x, b.class_id AS y, a.n AS nx, b.n AS ny, count(*) AS common FROM e a JOIN e b ON a.mark = b.mark AND a.class_id < b.class_id GROUP BY ALL HAVING count(*) >= 0.8 * least(a.n, b.n) - 1e-9)"""
CONTAINMENT_PAIRS = f"""
WITH {_CONTAINED} SELECT CASE WHEN nx <= ny THEN x ELSE y END AS small, CASE WHEN nx <= ny THEN y ELSE x END AS large, CAST(common AS INTEGER) AS common, round(common / least(nx, ny), 6) AS similarity FROM c"""
NEAR_DUPLICATES = f"""
WITH RECURSIVE {_CONTAINED}, l AS (SELECT x AS a, y AS b FROM c UNION SELECT y, x FROM c),
r AS (SELECT a AS node, a AS met FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.met = l.a),
g AS (SELECT node, min(met) AS label FROM r GROUP BY node)
SELECT doc_id, coalesce(label, class_id) AS class_id FROM (SELECT doc_id, lower({_sq('text')}) AS t FROM documents) x JOIN d USING (t) LEFT JOIN g ON d.class_id = g.node"""


def banners(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaning.page_lines(table(spark, folder, "raw_text").distinct())
    return cleaning.banners(lines).select("file", "edge", "banner", "pages", "eligible", "decision")


_LINES = r"""
r AS (SELECT DISTINCT file, text FROM raw_text), l0 AS (SELECT file, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM r),
l1 AS (SELECT *, CASE WHEN regexp_matches(line, '(?i)^--- page [0-9]+ ---\s*$') THEN CAST(regexp_extract(line, '[0-9]+') AS INTEGER) END AS mark FROM l0),
l AS (SELECT file, line_no, line, last_value(mark IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS page_no FROM l1 QUALIFY mark IS NULL)"""
_FULL = "f AS (SELECT *, row_number() OVER (PARTITION BY file, page_no ORDER BY line_no) AS up, count(*) OVER (PARTITION BY file, page_no) AS n FROM l WHERE page_no IS NOT NULL AND trim(line) <> '')"
BANNERS = f"""
WITH {_LINES}, {_FULL}, e AS (SELECT file, page_no, {_sq('line')} AS banner, CASE WHEN up <= 2 THEN 'top' ELSE 'bottom' END AS edge FROM f WHERE n >= 6 AND (up <= 2 OR up > n - 2)),
g AS (SELECT file, count(DISTINCT page_no) AS eligible FROM e GROUP BY file), s AS (SELECT file, edge, banner, count(DISTINCT page_no) AS pages FROM e GROUP BY ALL),
d AS (SELECT *, CASE WHEN pages >= greatest(4, ceil(0.6 * eligible)) AND length(banner) <= 60 AND len(string_split(banner, ' ')) <= 8 AND NOT regexp_matches(banner, '[.:;,]$') AND NOT regexp_matches(banner, '[0-9]') THEN 'remove'
  WHEN pages >= greatest(4, ceil(0.25 * eligible)) THEN 'flag' END AS decision FROM s JOIN g USING (file))
SELECT file, edge, banner, pages, eligible, decision FROM d WHERE decision IS NOT NULL"""


def printed_page_numbers(spark: SparkSession, folder: str) -> DataFrame:
    lines = cleaning.page_lines(table(spark, folder, "raw_text").distinct())
    return cleaning.page_number_lines(lines)


_NUMBERED = rf"""
x AS (SELECT *, {_sq('line')} AS p, CASE WHEN up = 1 THEN lead(line) OVER w ELSE lag(line) OVER w END AS inner_line FROM f WINDOW w AS (PARTITION BY file, page_no ORDER BY line_no)),
c AS (SELECT file, page_no, line_no, line, CAST(regexp_extract(line, '[0-9]+') AS INTEGER) AS printed, regexp_matches(p, '(?i)^page [0-9]+(?: of [0-9]+)?$|^- ?[0-9]+ ?-$') AS labelled, CASE WHEN up = 1 AND n > 1 THEN 'top' ELSE 'bottom' END AS edge
  FROM x WHERE (up = 1 OR up = n) AND (regexp_matches(p, '(?i)^page [0-9]+(?: of [0-9]+)?$|^- ?[0-9]+ ?-$') OR (regexp_matches(p, '^[0-9]{{1,4}}$') AND NOT coalesce(regexp_matches({_sq('inner_line')}, '^[0-9]+$'), FALSE)))),
o AS (SELECT file, edge, printed - page_no AS off, count(*) AS pages, min(page_no) AS seen FROM c WHERE NOT labelled GROUP BY ALL),
b AS (SELECT DISTINCT ON (file, edge) file, edge, off, pages FROM o ORDER BY file, edge, pages DESC, seen),
k AS (SELECT file, count(DISTINCT page_no) AS numbered FROM l WHERE page_no IS NOT NULL GROUP BY file),
q AS (SELECT b.file, b.edge, b.off FROM b JOIN k USING (file) WHERE pages >= greatest(3, ceil(0.3 * numbered))),
z AS (SELECT c.file, c.page_no, c.line_no, c.line, CASE WHEN labelled OR abs(printed - page_no - off) = 0 THEN 'remove' WHEN abs(printed - page_no - off) <= 2 THEN 'flag' END AS decision FROM c LEFT JOIN q ON c.file = q.file AND c.edge = q.edge)"""
PRINTED_PAGE_NUMBERS = f"WITH {_LINES}, {_FULL}, {_NUMBERED} SELECT file, page_no, CAST(line_no AS INTEGER) AS line_no, line, decision FROM z WHERE decision IS NOT NULL"


def cleaning_integrity(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "raw_text").distinct()
    removed = cut(cleaning.removed_lines(cut(cleaning.page_lines(raw))))
    return cleaning.integrity(raw, cleaning.cleaned_text(raw, removed=removed), removed)


#: The lines that the cleaning takes out: banners on later pages than the first, then page numbers among the lines that are left.
_REMOVED = f"""
{_LINES}, {_FULL}, ed AS (SELECT file, page_no, line_no, line, {_sq('line')} AS banner, CASE WHEN up <= 2 THEN 'top' ELSE 'bottom' END AS edge FROM f WHERE n >= 6 AND (up <= 2 OR up > n - 2)),
el AS (SELECT file, count(DISTINCT page_no) AS eligible FROM ed GROUP BY file), sn AS (SELECT file, edge, banner, count(DISTINCT page_no) AS pages FROM ed GROUP BY ALL),
ap AS (SELECT file, edge, banner FROM sn JOIN el USING (file) WHERE pages >= greatest(4, ceil(0.6 * eligible)) AND length(banner) <= 60 AND len(string_split(banner, ' ')) <= 8 AND NOT regexp_matches(banner, '[.:;,]$') AND NOT regexp_matches(banner, '[0-9]')),
fp AS (SELECT file, min(page_no) AS first FROM l WHERE page_no IS NOT NULL GROUP BY file),
gb AS (SELECT ed.file, ed.line_no, ed.line FROM ed JOIN fp USING (file) JOIN ap ON ed.file = ap.file AND ed.edge = ap.edge AND ed.banner = ap.banner WHERE page_no > first),
lr AS (SELECT * FROM l ANTI JOIN gb USING (file, line_no)),
fr AS (SELECT *, row_number() OVER (PARTITION BY file, page_no ORDER BY line_no) AS up, count(*) OVER (PARTITION BY file, page_no) AS n FROM lr WHERE page_no IS NOT NULL AND trim(line) <> ''),
{_NUMBERED.replace('FROM f WINDOW', 'FROM fr WINDOW').replace('FROM l WHERE', 'FROM lr WHERE')},
gone AS (SELECT file, line_no, line FROM gb UNION ALL SELECT file, line_no, line FROM z WHERE decision = 'remove'),
kept AS (SELECT file, regexp_replace(string_agg(regexp_replace(line, '[ \t]+$', ''), chr(10) ORDER BY line_no), '\n(?:[ \t]*\n){{2,}}', chr(10) || chr(10), 'g') AS text FROM l0 ANTI JOIN gone USING (file, line_no) GROUP BY file),
taken AS (SELECT file, count(*) AS lines_removed, string_agg(line, '') AS taken FROM gone GROUP BY file),
proof AS (SELECT r.file, list_sort(string_split(regexp_replace(r.text, '\\s', '', 'g'), '')) = list_sort(string_split(regexp_replace(coalesce(kept.text, '') || coalesce(taken, ''), '\\s', '', 'g'), '')) AS same,
  r.text AS raw, coalesce(kept.text, '') AS cleaned, coalesce(lines_removed, 0) AS lines_removed FROM r LEFT JOIN kept USING (file) LEFT JOIN taken USING (file))"""
CLEANING_INTEGRITY = f"WITH {_REMOVED} SELECT file, CASE WHEN same THEN 'OK' ELSE 'MISMATCH' END AS verdict FROM proof WHERE regexp_matches(raw, '\\S')"


def cleaning_report(spark: SparkSession, folder: str) -> DataFrame:
    return assembly.cleaning_report(table(spark, folder, "raw_text")).select("file", "pages", "chars_raw", "chars_cleaned", "lines_removed", "integrity_check")


CLEANING_REPORT = f"""
WITH {_REMOVED}, n AS (SELECT file, count(DISTINCT page_no) AS pages FROM l WHERE page_no IS NOT NULL GROUP BY file)
SELECT file, CAST(coalesce(pages, 0) AS INTEGER) AS pages, length(raw) AS chars_raw, length(cleaned) AS chars_cleaned, CAST(lines_removed AS INTEGER) AS lines_removed, CASE WHEN same THEN 'OK' ELSE 'MISMATCH' END AS integrity_check FROM proof LEFT JOIN n USING (file)"""


def structured_pages(spark: SparkSession, folder: str) -> DataFrame:
    found = assembly.page_records(table(spark, folder, "raw_text"), table(spark, folder, "document_metadata"))
    shown = ("file", "page_number", "page_id", "previous_page_id", "next_page_id", "section", "section_at_page_start", "language", "table_signal", "form_signal", "content_type", "char_count", "word_count", "line_count", "text_hash")
    return found.select(*shown)


_PAGE_LINE = r"(?i)^[ \t]*---[ \t]*page[ \t]+[0-9]+[ \t]*---[ \t]*$"
STRUCTURED_PAGES = rf"""
WITH {_META}, rr AS (SELECT DISTINCT file, text FROM raw_text WHERE text IS NOT NULL), f AS (SELECT DISTINCT file FROM rr WHERE file IS NOT NULL),
s AS (SELECT {_STEM.replace('{0}', 'filename')} AS stem, min(source_id) AS stem_source FROM m GROUP BY 1),
i AS (SELECT {_ID.replace('{0}', 'source_id')} AS id, min(source_id) AS id_source FROM m GROUP BY 1 HAVING count(DISTINCT source_id) = 1),
src AS (SELECT file, coalesce(stem_source, id_source, {_STEM.replace('{0}', 'file')}) AS source FROM f LEFT JOIN s ON {_STEM.replace('{0}', 'file')} = stem LEFT JOIN i ON {_ID.replace('{0}', 'file')} = id),
ln AS (SELECT file, text AS whole, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line_no FROM rr),
mk AS (SELECT *, CASE WHEN regexp_matches(line, '{_PAGE_LINE}') THEN CAST(regexp_extract(line, '[0-9]+') AS INTEGER) END AS mark FROM ln),
nb AS (SELECT *, count(mark) OVER (PARTITION BY file, whole ORDER BY line_no) AS place FROM mk),
pg AS (SELECT file, whole, place, max(mark) AS page_number, coalesce(regexp_replace(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE mark IS NULL), '^\n+|\n+$', '', 'g'), '') AS text FROM nb WHERE place > 0 GROUP BY ALL),
p AS (SELECT row_number() OVER () AS page_id, file, source, place, page_number, text FROM pg LEFT JOIN src USING (file)),
{_HEADINGS}, {_CONTENT.replace('m AS (', 'mc AS (', 1).replace(' FROM m)', ' FROM mc)')},
x AS (SELECT hd.file, hd.source, hd.place, hd.page_number, hd.source || '-p' || hd.page_number AS page_id, coalesce(hd.h[1], list_filter(hd.lines, lambda x: length(x) <= 80 AND regexp_matches(x, '{P.STRUCTURAL}'))[1]) AS section, hd.text, sha256(hd.text) AS text_hash,
  length(regexp_replace(hd.text, '[^\p{{L}}]', '', 'g')) AS a, length(regexp_replace(regexp_replace(hd.text, '[^\p{{L}}]', '', 'g'), '[^\x{{0900}}-\x{{097F}}]', '', 'g')) AS d, length(regexp_replace(hd.text, '[^A-Za-z]', '', 'g')) AS l,
  n, num, piped, blanks, labels, signatures, regexp_matches(hd.text, '{P.TABLE_TITLE}') AS titled, CASE WHEN len(e) = 0 THEN 'unknown' WHEN len(top) = 1 THEN top[1] ELSE 'mixed' END AS content_type
  FROM hd JOIN mc USING (page_id) JOIN t USING (page_id))
SELECT file, page_number, page_id, lag(page_id) OVER w AS previous_page_id, lead(page_id) OVER w AS next_page_id, section,
  last_value(section IGNORE NULLS) OVER (PARTITION BY source ORDER BY page_number, place, text_hash ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS section_at_page_start,
  CASE WHEN a < 15 THEN 'Unknown' WHEN d >= 0.7 * a THEN 'Hindi' WHEN d >= 5 AND d >= 0.03 * a THEN 'Mixed' WHEN l >= 0.8 * a THEN 'English' ELSE 'Unknown' END AS language,
  CASE WHEN (num >= 12 AND num >= 0.35 * n) OR piped >= 3 THEN 'table' WHEN (num >= 6 AND num >= 0.2 * n) OR (titled AND num >= 4) THEN 'possible' ELSE 'none' END AS table_signal,
  CASE WHEN blanks >= 3 OR (blanks >= 1 AND signatures >= 2) THEN 'form' WHEN blanks >= 1 OR labels >= 3 THEN 'possible' ELSE 'none' END AS form_signal, content_type, length(text) AS char_count,
  CAST(CASE WHEN {_sq('text')} = '' THEN 0 ELSE len(string_split({_sq('text')}, ' ')) END AS INTEGER) AS word_count, CAST(CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) END AS INTEGER) AS line_count, text_hash
FROM x WINDOW w AS (PARTITION BY source ORDER BY page_number, place, text_hash)"""


def chunk_corpus(spark: SparkSession, folder: str) -> DataFrame:
    chunks = assembly.chunk_corpus(_pages(spark, folder), table(spark, folder, "web_texts"))
    return chunks.select("source_type", "parent", "chunk_index", "words", "text_hash")


_WINDOWED = f"""
t AS (SELECT DISTINCT 'pdf' AS source_type, page_id AS parent, text FROM page_records UNION SELECT DISTINCT 'web', text_file, text FROM web_texts),
w AS (SELECT source_type, parent, list_filter(string_split({_sq('text')}, ' '), lambda w: w <> '') AS w FROM t),
i AS (SELECT source_type, parent, w, unnest(range(0, greatest(0, CAST(ceil((len(w) - 218) / 168.0) AS BIGINT)) + 1)) AS chunk_index FROM w WHERE len(w) > 0),
s AS (SELECT source_type, parent, chunk_index, w[chunk_index * 168 + 1 : chunk_index * 168 + 218] AS part FROM i),
h AS (SELECT source_type, parent, CAST(chunk_index AS INTEGER) AS chunk_index, CAST(len(part) AS INTEGER) AS words, sha256(array_to_string(part, ' ')) AS text_hash FROM s),
k AS (SELECT DISTINCT ON (text_hash) * FROM h ORDER BY text_hash, source_type, parent, chunk_index)"""
CHUNK_CORPUS = f"WITH {_WINDOWED} SELECT * FROM k"


def chunk_corpus_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks and words that are left for each kind of source, and in how many parents."""
    chunks = assembly.chunk_corpus(_pages(spark, folder), table(spark, folder, "web_texts"))
    return chunks.groupBy("source_type").agg(F.count("*").alias("chunks"), F.sum("words").alias("words"), F.count_distinct("parent").alias("parents"))


CHUNK_CORPUS_COUNTS = f"WITH {_WINDOWED} SELECT source_type, count(*) AS chunks, CAST(sum(words) AS BIGINT) AS words, count(DISTINCT parent) AS parents FROM k GROUP BY source_type"


def blank_lines_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "cleaned").select("source_file", F.xxhash64("text").alias("_text"), cleaning.collapse_blank_lines(F.col("text")).alias("text"))
    return c.dropDuplicates(["source_file", "_text"]).drop("_text")


BLANK_LINES_COLLAPSED = r"SELECT source_file, regexp_replace(text, '\n(?:[ \t]*\n){2,}', chr(10) || chr(10), 'g') AS text FROM (SELECT DISTINCT source_file, text FROM cleaned)"


def cleaning_totals(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "cleaning_summary").distinct()
    return s.groupBy("integrity_check").agg(F.count("*").alias("files"), F.sum("chars_raw").alias("chars_raw"), F.sum("chars_cleaned").alias("chars_cleaned"), F.sum("lines_removed").alias("lines_removed"), F.sum("flags").alias("flags"))


CLEANING_TOTALS = "SELECT integrity_check, count(*) AS files, CAST(sum(chars_raw) AS BIGINT) AS chars_raw, CAST(sum(chars_cleaned) AS BIGINT) AS chars_cleaned, CAST(sum(lines_removed) AS BIGINT) AS lines_removed, CAST(sum(flags) AS BIGINT) AS flags FROM (SELECT DISTINCT * FROM cleaning_summary) GROUP BY integrity_check"


def latest_fetches(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "web_sources_manifest").where("status = 'success' and text_file is not null")
    best = m.groupBy("source_id").agg(F.max_by(F.struct("text_file", "http_status"), F.struct("retrieved_at_utc", "text_file")).alias("b"))
    return best.select("source_id", "b.text_file", "b.http_status")


LATEST_FETCHES = "SELECT DISTINCT ON (source_id) source_id, text_file, http_status FROM web_sources_manifest WHERE status = 'success' AND text_file IS NOT NULL ORDER BY source_id, retrieved_at_utc DESC, text_file DESC"


def texts_never_stored(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.without_partner(table(spark, folder, "web_sources_manifest"), table(spark, folder, "web_texts"), "text_file")


TEXTS_NEVER_STORED = "SELECT DISTINCT text_file FROM web_sources_manifest WHERE text_file IS NOT NULL AND text_file NOT IN (SELECT text_file FROM web_texts)"


def fetch_status(spark: SparkSession, folder: str) -> DataFrame:
    m = table(spark, folder, "web_sources_manifest").distinct()
    host = F.regexp_extract("url", r"^\w+://([^/:?#]+)", 1)
    return m.groupBy(host.alias("host")).agg(F.count_if(F.col("status") == "success").alias("success"), F.count_if(F.col("status") == "failed").alias("failed"))


FETCH_STATUS = r"SELECT regexp_extract(url, '^\w+://([^/:?#]+)', 1) AS host, count_if(status = 'success') AS success, count_if(status = 'failed') AS failed FROM (SELECT DISTINCT * FROM web_sources_manifest) GROUP BY 1"


def web_page_records(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _once(table(spark, folder, "web_texts"), "text_file", P.web_section(text).alias("section"), T.two_script_label(text).alias("script"), P.table_signal(text).alias("table_signal"), F.length("text").alias("chars"))


WEB_PAGE_RECORDS = r"""
WITH t AS (SELECT DISTINCT text_file, text FROM web_texts),
l AS (SELECT text_file, text, string_split(text, chr(10)) AS raw, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '^\s+|\s+$', '', 'g'))), lambda x: x <> '') AS lines FROM t),
c AS (SELECT *, len(lines) AS n, len(list_filter(lines, lambda x: length(x) <= 40 AND regexp_matches(x, '[0-9]') AND regexp_matches(x, '^[0-9\s,.%₹/\-–()]+$'))) AS num,
  len(list_filter(raw, lambda x: regexp_matches(x, '\|.*\||\t.*\t'))) AS piped, regexp_matches(text, '(?i)\btable\s+[0-9]+\b|\bpremium\s+rates?\b|\brate\s+table\b') AS titled FROM l)
SELECT text_file, CASE WHEN length(lines[1]) <= 150 THEN lines[1] END AS section,
  CASE WHEN NOT regexp_matches(text, '[\x{0900}-\x{097F}]') THEN 'English' WHEN NOT regexp_matches(text, '[A-Za-z]') THEN 'Hindi' ELSE 'Mixed' END AS script,
  CASE WHEN (num >= 12 AND num >= 0.35 * n) OR piped >= 3 THEN 'table' WHEN (num >= 6 AND num >= 0.2 * n) OR (titled AND num >= 4) THEN 'possible' ELSE 'none' END AS table_signal, length(text) AS chars FROM c"""


def issue_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Issues between pages and metadata by kind: how many, in how many documents, and one of them."""
    return metadata_differences(spark, folder).groupBy("issue", "severity", "field").agg(F.count("*").alias("n"), F.count_distinct("source_id").alias("sources"), F.min("source_id").alias("example"))


ISSUE_CATEGORIES = f"SELECT issue, severity, field, count(*) AS n, count(DISTINCT source_id) AS sources, min(source_id) AS example FROM ({METADATA_DIFFERENCES}) GROUP BY ALL"


def paged_texts(spark: SparkSession, folder: str) -> DataFrame:
    p = _pages(spark, folder).select("filename", "page_number", "text").where("filename is not null")
    return records.paged_text(p).select("filename", F.sha2("text", 256).alias("text_hash"), F.length("text").alias("chars"))


PAGED_TEXTS = """
WITH p AS (SELECT DISTINCT filename, page_number, coalesce(text, '') AS text FROM page_records WHERE filename IS NOT NULL),
t AS (SELECT filename, string_agg('--- PAGE ' || page_number || ' ---' || chr(10) || text || chr(10), chr(10) ORDER BY page_number, text) AS t FROM p GROUP BY filename)
SELECT filename, sha256(t) AS text_hash, length(t) AS chars FROM t"""



def _issues(spark: SparkSession, folder: str) -> DataFrame:
    return reports.page_issues(_pages(spark, folder), table(spark, folder, "document_metadata"), FIELDS)


_PAGE_ISSUES = f"""
WITH u AS (SELECT DISTINCT source_id, page_id FROM page_records WHERE page_id IS NOT NULL), md AS ({METADATA_DIFFERENCES}),
q AS (SELECT u.source_id, page_id, 'metadata_row_missing' AS issue FROM u WHERE source_id IS NOT NULL AND source_id NOT IN (SELECT source_id FROM document_metadata WHERE source_id IS NOT NULL)
  UNION ALL SELECT u.source_id, page_id, i FROM u JOIN (SELECT DISTINCT source_id, issue || ':' || field AS i FROM md) d ON u.source_id = d.source_id
  UNION ALL SELECT u.source_id, page_id, 'duplicate_page_id' FROM u WHERE page_id IN (SELECT page_id FROM page_records GROUP BY page_id HAVING count(*) > 1))"""


def page_issue_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder).select("source_id", "page_id").distinct()
    return reports.with_issues(pages, _issues(spark, folder)).select("source_id", "page_id", F.array_join("issues", "|").alias("issues"))


PAGE_ISSUE_LISTS = f"{_PAGE_ISSUES} SELECT u.source_id, u.page_id, coalesce(string_agg(DISTINCT issue, '|' ORDER BY issue), '') AS issues FROM (SELECT DISTINCT source_id, page_id FROM page_records) u LEFT JOIN q USING (page_id) GROUP BY u.source_id, u.page_id"


def issue_examples(spark: SparkSession, folder: str) -> DataFrame:
    return reports.examples(_issues(spark, folder), "issue", "source_id", "page_id").withColumn("examples", F.array_join("examples", "|"))


ISSUE_EXAMPLES = f"""{_PAGE_ISSUES}, x AS (SELECT issue, page_id FROM (SELECT DISTINCT issue, page_id FROM q) QUALIFY row_number() OVER (PARTITION BY issue ORDER BY page_id) <= 3)
SELECT q.issue, count(*) AS n, count(DISTINCT source_id) AS sources, any_value(e) AS examples FROM q JOIN (SELECT issue, string_agg(page_id, '|' ORDER BY page_id) AS e FROM x GROUP BY issue) y ON q.issue = y.issue GROUP BY q.issue"""


def ranked_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return reports.ranked_counts(_pages(spark, folder).select(F.explode("review_reasons").alias("reason")), "reason")


RANKED_REASONS = "SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, r) AS INTEGER) AS place, r AS reason, count(*) AS n FROM (SELECT unnest(review_reasons) AS r FROM page_records) GROUP BY r"


def pages_by_status(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten pages of each personal-data status, statuses in their order."""
    pages = _pages(spark, folder).select("pii_status", "source_id", "page_number", "page_id").distinct()
    return reports.by_status(reports.first_rows(pages, ["pii_status"], [F.col("source_id"), F.col("page_number"), F.col("page_id")], 10))


PAGES_BY_STATUS = f"""
SELECT *, CAST(coalesce(list_position({_sql_list(reports.STATUS_ORDER)}, pii_status), {len(reports.STATUS_ORDER) + 1}) AS INTEGER) AS status_rank FROM (SELECT DISTINCT pii_status, source_id, page_number, page_id FROM page_records)
QUALIFY row_number() OVER (PARTITION BY pii_status ORDER BY source_id NULLS FIRST, page_number NULLS FIRST, page_id NULLS FIRST) <= 10"""


def scan_confusions(spark: SparkSession, folder: str) -> DataFrame:
    found = _once(table(spark, folder, "raw_text"), "file", T.digit_confusions(F.col("text")).alias("c"), F.regexp_count("text", F.lit(T.HARD_CORRUPTION)).alias("broken"))
    return found.select("file", F.size("c").alias("confused"), "broken").where("confused > 0 or broken > 0")


SCAN_CONFUSIONS = r"""
WITH c AS (SELECT file, len(list_filter(regexp_extract_all(text, '\b[0-9OIlSB][0-9OIlSB,./-]+[0-9OIlSB]\b'), lambda x: regexp_matches(x, '[0-9]') AND regexp_matches(x, '[OIlSB]'))) AS confused,
  len(regexp_extract_all(text, '\x{FFFD}|\(cid:[0-9]+\)')) AS broken FROM (SELECT DISTINCT file, text FROM raw_text))
SELECT file, CAST(confused AS INTEGER) AS confused, CAST(broken AS INTEGER) AS broken FROM c WHERE confused > 0 OR broken > 0"""


def web_page_checks(spark: SparkSession, folder: str) -> DataFrame:
    text = F.col("text")
    return _once(table(spark, folder, "web_texts"), "text_file", P.web_personal_status(text).alias("pii_status"), P.web_flags(text).alias("f")).select("text_file", "pii_status", "f.*")


WEB_PAGE_CHECKS = rf"""
SELECT text_file, CASE WHEN {_KINDS_FOUND} > 0 THEN 'possible_pii' WHEN {_sql_contained('text', P.WEB_FIELDS)} > 0 THEN 'template_fields' ELSE 'none' END AS pii_status,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '\|.*\||\t.*\t'))) >= 3 OR {_sql_contained('text', P.WEB_TABLE_WORDS)} >= 2 AS contains_table, {_sql_contained('text', P.WEB_FORM_WORDS)} >= 2 AS contains_form
FROM (SELECT DISTINCT text_file, text FROM web_texts)"""

NAMES = (
    "page_issue_lists", "issue_examples", "ranked_reasons", "pages_by_status", "scan_confusions", "web_page_checks", "page_text_stats", "page_hash_check", "spoken_forms", "script_labels", "normalised_documents", "empty_pages", "extraction_anomalies", "page_headings", "page_tables",
    "page_forms", "page_keywords", "personal_data_status", "redacted_previews", "content_kinds", "plan_and_product_codes", "code_summary", "file_metadata_match",
    "sources_without_metadata", "metadata_without_pages", "metadata_differences", "differing_fields", "page_neighbours", "section_carried", "page_gaps",
    "duplicate_page_ids", "exact_classes", "ordered_dedup", "round_robin_sample", "null_counts", "reason_histogram", "source_summary", "review_queue",
    "priority_rollup", "category_counts", "record_problems", "chunk_windows", "chunk_pack", "chunk_token_stats", "near_duplicates", "containment_pairs",
    "banners", "printed_page_numbers", "cleaning_integrity", "blank_lines_collapsed", "cleaning_totals", "latest_fetches", "texts_never_stored", "fetch_status", "web_page_records", "issue_categories", "paged_texts",
    "cleaning_report", "structured_pages", "chunk_corpus", "chunk_corpus_counts",
)
QUERIES = {n: globals()[n] for n in NAMES}
SQL = {n: globals()[n.upper()] for n in NAMES if n.upper() in globals()}
