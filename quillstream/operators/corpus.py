"""Checks and roll-ups over a corpus of pages and its metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.text import document_id, null_words, nonspace_length, squash

from .ordered import WIDTH, with_last, with_neighbours

# Reasons that alone send a page to review, and the order of priorities.
HARD_REASONS = (
    "empty_page", "near_empty_page", "possible_pii", "possible_table", "possible_form", "extraction_anomaly", "ocr_derived_verify_numbers",
    "duplicate_page_number", "low_confidence_content_type", "unknown_language", "no_section_and_no_content_type",
)
LEVELS = ("HIGH", "MEDIUM", "LOW")


def clean_metadata(df: DataFrame, keep: str = "source_id") -> DataFrame:
    """Distinct metadata rows with textual nulls as nulls; of several rows for a key the first in column order."""
    kinds = dict(df.dtypes)
    plain = df.select(*[null_words(F.col(c)).alias(c) if kinds[c] == "string" else F.col(c) for c in df.columns]).distinct()
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != keep]
    return plain.withColumn("_n", F.row_number().over(Window.partitionBy(keep).orderBy(*rest))).where("_n = 1").drop("_n")


def file_stem(name: Column) -> Column:
    """A file name without folder and extension, in lower case with single blanks."""
    return F.lower(squash(F.regexp_replace(F.regexp_replace(name, r"^.*[/\\]", ""), r"\.[A-Za-z0-9]+$", "")))


def match_files(files: DataFrame, metadata: DataFrame, file: str = "filename", source: str = "source_id") -> DataFrame:
    """(file, source, matched_by, warning): each file's metadata row, by its stem or else by the id in its name.

    The id counts only where exactly one source has it. Where stem and id name different sources the stem holds and warning is true.
    """
    names = files.select(F.col(file).alias("file")).where("file is not null").distinct()
    by_stem = metadata.groupBy(file_stem(F.col(file)).alias("stem")).agg(F.min(source).alias("stem_source"))
    by_id = metadata.groupBy(document_id(F.col(source)).alias("id")).agg(F.count_distinct(source).alias("n"), F.min(source).alias("id_source")).where("n = 1")
    joined = names.join(by_stem, file_stem(F.col("file")) == F.col("stem"), "left").join(by_id, document_id(F.col("file")) == F.col("id"), "left")
    return joined.select(
        "file", F.coalesce("stem_source", "id_source").alias("source"),
        F.when(F.col("stem_source").isNotNull(), "stem").when(F.col("id_source").isNotNull(), "id").otherwise("none").alias("matched_by"),
        F.coalesce(F.col("stem_source") != F.col("id_source"), F.lit(False)).alias("warning"),
    )


def without_partner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key): the keys of `left` that `right` lacks, once each."""
    return left.select(key).where(F.col(key).isNotNull()).distinct().join(right.select(key).distinct(), key, "left_anti")


def metadata_differences(pages: DataFrame, metadata: DataFrame, fields: tuple[str, ...], severe: tuple[str, ...] = ("plan_number", "uin"), key: str = "source_id") -> DataFrame:
    """(key, field, page_value, metadata_value, issue, severity): fields on which a document's pages and its metadata row disagree.

    Both missing is no issue; one missing is a difference in completeness.
    """
    own = pages.select(key, *[null_words(F.col(f)).alias(f) for f in fields]).distinct()
    other = clean_metadata(metadata, key).select(F.col(key).alias("_k"), *[F.col(f).alias(f"m_{f}") for f in fields])
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("page_value"), F.col(f"m_{f}").alias("metadata_value")) for f in fields])
    each = own.join(other, F.col(key) == F.col("_k")).select(key, F.inline(pairs)).where("not (page_value <=> metadata_value)").distinct()
    lacking = F.col("page_value").isNull() | F.col("metadata_value").isNull()
    issue = F.when(lacking, "metadata_completeness_difference").otherwise("page_records_differ_from_metadata")
    severity = F.when(~lacking & F.col("field").isin(*severe), "HIGH").otherwise("MEDIUM")
    return each.select(key, "field", "page_value", "metadata_value", issue.alias("issue"), severity.alias("severity"))


def differing_fields(pages: DataFrame, fields: tuple[str, ...], key: str = "source_id") -> DataFrame:
    """(key, field, n): fields that have several values on one document's pages."""
    values = pages.select(key, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields]))).where("value is not null").distinct()
    return values.groupBy(key, "field").agg(F.count("*").alias("n")).where("n > 1")


def neighbours(pages: DataFrame, document: str = "source_id", order: str = "page_number", page: str = "page_id") -> DataFrame:
    """(page, previous, next) in the order of each document."""
    found = with_neighbours(pages.select(document, order, page), [document], [order, page], page, F.floor(F.col(order) / WIDTH), "previous", "next")
    return found.select(page, "previous", "next")


def carried_section(pages: DataFrame, own: str, document: str = "source_id", order: str = "page_number", page: str = "page_id") -> DataFrame:
    """(page, section_at_start, from_page): the last section that began on an earlier page of the document."""
    started = {"section_at_start": F.col(own), "from_page": F.when(F.col(own).isNotNull(), F.col(order))}
    found = with_last(pages.select(document, order, page, own), [document], [order, page], started, F.floor(F.col(order) / WIDTH))
    return found.select(page, "section_at_start", "from_page")


def missing_pages(pages: DataFrame, document: str = "source_id", order: str = "page_number") -> DataFrame:
    """(document, first_missing, last_missing): the gaps in a document's page numbers, which begin at 1."""
    steps = pages.select(document, order).where(F.col(order) >= 1).distinct()
    near = with_neighbours(steps, [document], [order], order, F.floor(F.col(order) / WIDTH)).withColumn("before", F.coalesce("before", F.lit(0)))
    return near.where(F.col(order) > F.col("before") + 1).select(document, (F.col("before") + 1).alias("first_missing"), (F.col(order) - 1).alias("last_missing"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def exact_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, members): rows with the same squashed text share a class, named by its smallest key; nulls and blank texts have none."""
    hashed = df.select(F.col(key), F.sha2(squash(F.col(text)), 256).alias("h")).where(F.length(squash(F.col(text))) > 0)
    classes = hashed.groupBy(F.col("h").alias("_h")).agg(F.min(key).alias("class_id"), F.count("*").alias("members"))
    return hashed.join(classes, F.col("h") == F.col("_h")).select(key, "class_id", "members")


def ordered_dedup(df: DataFrame, text_hash: Column, *order: Column) -> DataFrame:
    """The first row, in the given order, of each text hash. Only the rows' order keys are compared before the winner is taken."""
    plain = df.withColumn("_hash", text_hash)
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return plain.groupBy("_hash").agg(F.min(F.struct(place.alias("place"), row.alias("row"))).alias("m")).select("m.row.*")


def round_robin_sample(pages: DataFrame, n: int, document: str = "source_id", order: str = "page_number", page: str = "page_id") -> DataFrame:
    """(document, order, page): n pages, first the first page of every document, then the second of every one, and so on."""
    w = Window.partitionBy(document).orderBy(order, page)
    ranked = pages.select(document, order, page).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return ranked.orderBy("_r", document, page).limit(n).drop("_r")


def null_counts(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(column, nulls) over the whole table in one pass."""
    sums = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])))


def reason_histogram(pages: DataFrame, reasons: str = "review_reasons", prefix: str = "doc_metadata_missing") -> DataFrame:
    """(reason, pages), reasons that begin with the prefix counted as one."""
    each = pages.select(F.explode(reasons).alias("reason"))
    return each.select(F.when(F.col("reason").startswith(prefix), prefix).otherwise(F.col("reason")).alias("reason")).groupBy("reason").agg(F.count("*").alias("pages"))


def value_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, summary): each key's values with their counts, most frequent first, as `value x n; ...`."""
    counted = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    parts = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(value).alias("v"))))
    return counted.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: F.concat(x["v"], F.lit(" x "), (-x["o"]).cast("string"))), "; ").alias("summary"))


def source_summary(pages: DataFrame, key: str = "source_id") -> DataFrame:
    """Counts of what the pages of each document hold."""
    return pages.groupBy(key).agg(
        F.count("*").alias("pages"), F.count_if(F.col("section").isNull()).alias("no_section"), F.count_if(F.col("content_type") == "unknown").alias("unknown_type"),
        F.count_if(F.col("pii_status") == "possible_pii").alias("possible_pii"), F.count_if("contains_table").alias("tables"), F.count_if("contains_form").alias("forms"),
        F.count_if("review_required").alias("to_review"), F.sum("char_count").alias("characters"))


def review_reasons() -> Column:
    """Why a page record should be looked at, in a fixed order, from the record's own fields."""
    size = F.coalesce(nonspace_length(F.col("text")), F.lit(0))
    rules = [
        (size == 0, "empty_page"),
        ((size > 0) & (size < 20), "near_empty_page"),
        (F.col("pii_status") == "possible_pii", "possible_pii"),
        (F.col("contains_table"), "table_detected"),
        (F.col("contains_form"), "form_detected"),
        (F.col("signals.private_use_char_count") > 0, "extraction_anomaly"),
        (F.col("signals.ocr_derived"), "ocr_derived_verify_numbers"),
        (null_words(F.col("language")).isNull() | (F.lower("language") == "unknown"), "unknown_language"),
        (F.col("section").isNull(), "unknown_section"),
        (F.col("content_type") == "unknown", "unknown_content_type"),
        (F.col("content_type_confidence") == "low", "low_confidence_content_type"),
        (F.col("section").isNull() & (F.col("content_type") == "unknown"), "no_section_and_no_content_type"),
        (null_words(F.col("title")).isNull(), "doc_metadata_missing:title"),
        (null_words(F.col("authority")).isNull(), "doc_metadata_missing:authority"),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for test, name in rules]))


def needs_review(reasons: Column) -> Column:
    return F.arrays_overlap(reasons, F.array(*map(F.lit, HARD_REASONS)))


def reason_level(reason: Column) -> Column:
    high = ("empty_page", "near_empty_page", "possible_pii", "extraction_anomaly", "duplicate_page_number")
    medium = ("table_detected", "form_detected", "possible_table", "possible_form", "ocr_derived_verify_numbers", "unknown_language", "no_section_and_no_content_type")
    return F.when(reason.isin(*high), "HIGH").when(reason.isin(*medium) | reason.startswith("doc_metadata_missing"), "MEDIUM").otherwise("LOW")


def review_queue(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(source, page_number, key, priority, reasons, review_required): pages with a reason, each with its reasons by rank and name, the worst being its priority.

    Sort by rank, source and page for the reading order.
    """
    rank = F.create_map(*[F.lit(x) for i, level in enumerate(LEVELS) for x in (level, i)])
    named = pages.select("source_id", "page_number", key, review_reasons().alias("all"))
    ranked = F.array_sort(F.array_distinct(F.transform("all", lambda r: F.struct(rank[reason_level(r)].alias("rank"), r.alias("reason")))))
    queue = named.select("source_id", "page_number", key, "all", ranked.alias("ranked")).where(F.size("all") > 0)
    level = F.array(*map(F.lit, LEVELS))
    return queue.select(
        "source_id", "page_number", key, F.get(level, F.col("ranked")[0]["rank"]).alias("priority"),
        F.transform("ranked", lambda r: F.concat(F.get(level, r["rank"]), F.lit(":"), r["reason"])).alias("reasons"), needs_review(F.col("all")).alias("review_required"),
    ).distinct()
