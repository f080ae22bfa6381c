"""Whether texts came out of their files whole: extraction status, page sequence, repeated pages, and codes against metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.text import null_words, plan_numbers, product_codes, squash

from .corpus import clean_metadata

# Below these a page is empty, a file's text or its mean page too small; above these shares a text is broken.
EMPTY_PAGE, LOW_TOTAL, LOW_MEAN, BROKEN_SHARE, ACCENT_SHARE, REPEATED_PAGE = 20, 500, 300, 0.01, 0.05, 200
FIELD_CODES = (("plan_number", plan_numbers), ("uin", product_codes))


def _pages_of(text: Column) -> Column:
    """The texts between page markers."""
    return F.split(text, r"(?m)^--- PAGE [0-9]+ ---[ \t]*$")


def extraction_health(df: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, pages, in_sequence, chars, empty_pages, devanagari, status) of each distinct paged text.

    status is NEEDS_OCR where a file has hardly any text, REVIEW where the markers skip or repeat a number or signs of a broken
    extraction pass their share, CHECK where pages are empty or letters look mis-encoded, OK otherwise. A null text has no row.
    """
    rows = df.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{file}`").alias(file), F.col(f"`{text}`").alias("t")).distinct()
    numbers = F.transform(F.regexp_extract_all("t", F.lit(r"(?m)^--- PAGE ([0-9]+) ---[ \t]*$"), F.lit(1)), lambda x: x.cast("int"))
    parts = F.transform(_pages_of(F.col("t")), lambda x: F.length(F.regexp_replace(x, r"\s", "")))
    measured = rows.select(
        file, numbers.alias("numbers"), F.when(F.size(parts) > 1, F.slice(parts, 2, F.size(parts) - 1)).otherwise(parts).alias("sizes"),
        F.length(F.regexp_replace("t", r"\s", "")).alias("chars"), F.length(F.regexp_replace("t", r"[^\x{0900}-\x{097F}]", "")).alias("devanagari"),
        F.regexp_count("t", F.lit(r"\x{FFFD}|\(cid:[0-9]+\)|[\x{E000}-\x{F8FF}]")).alias("broken"), F.length(F.regexp_replace("t", r"[^\x{00C0}-\x{00FF}]", "")).alias("accents"),
    )
    pages = F.size("numbers")
    measured = measured.withColumn("pages", pages).withColumn("in_sequence", (pages > 0) & F.col("numbers").eqNullSafe(F.sequence(F.lit(1), F.greatest(pages, F.lit(1)))))
    measured = measured.withColumn("empty_pages", F.size(F.filter("sizes", lambda n: n < EMPTY_PAGE)))
    status = (
        F.when((F.col("chars") < LOW_TOTAL) | (F.col("chars") < LOW_MEAN * F.col("pages")), "NEEDS_OCR")
        .when(~F.col("in_sequence") | (F.col("broken") > BROKEN_SHARE * F.col("chars")), "REVIEW")
        .when((F.col("empty_pages") > 0) | (F.col("accents") > ACCENT_SHARE * F.col("chars")), "CHECK")
        .otherwise("OK")
    )
    return measured.select(file, "pages", "in_sequence", "chars", "empty_pages", "devanagari", status.alias("status"))


def repeated_pages(pages: DataFrame, document: str = "source_id", page: str = "page_id", text: str = "text") -> DataFrame:
    """(document, first_page, pages): longer page texts that stand several times in one document."""
    rows = pages.select(document, page, squash(F.col(text)).alias("t")).where(F.length("t") > REPEATED_PAGE).distinct()
    return rows.groupBy(document, F.sha2("t", 256).alias("h")).agg(F.min(page).alias("first_page"), F.count("*").alias("pages")).where("pages > 1").drop("h")


def numbered_apart(pages: DataFrame, page: str = "page_id", *order: str) -> DataFrame:
    """`pages` with page_key: the id, and `-dup2`, `-dup3` ... behind it for each further row with the same id, in the given order."""
    w = Window.partitionBy(page).orderBy(*order)
    n = F.row_number().over(w)
    return pages.withColumn("page_key", F.when(n == 1, F.col(page)).otherwise(F.concat(page, F.lit("-dup"), n.cast("string"))))


def out_of_sequence(pages: DataFrame, document: str = "source_id", number: str = "page_number") -> DataFrame:
    """(document, pages, highest): documents whose page numbers aren't 1 to n."""
    seen = pages.select(document, number).distinct().groupBy(document).agg(F.count("*").alias("pages"), F.max(number).alias("highest"), F.min(number).alias("lowest"))
    return seen.where((F.col("lowest") != 1) | (F.col("pages") != F.col("highest"))).select(document, "pages", "highest")


def code_checks(pages: DataFrame, metadata: DataFrame, document: str = "source_id", text: str = "text") -> DataFrame:
    """(document, field, issue, in_metadata, in_text): plan numbers and product codes of each document's text against its metadata row.

    missing_in_metadata, not_found_in_text, conflict (the text has others only) or other_values_in_text; in_text has the codes with
    the number of pages, most frequent first. Documents without a metadata row are left to the anti joins.
    """
    rows = pages.select(document, text).where(F.col(document).isNotNull()).distinct()

    def marked(field: str, codes: Column) -> Column:
        return F.transform(codes, lambda c: F.struct(F.lit(field).alias("field"), c.alias("code")))

    marks = F.flatten(F.array(*[marked(field, codes(F.col(text))) for field, codes in FIELD_CODES]))
    each = rows.select(document, F.inline_outer(marks)).where("code is not null").groupBy(document, "field", "code").agg(F.count("*").alias("n"))
    listed = each.groupBy(document, "field").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), "code"))).alias("found"))
    own = clean_metadata(metadata, document)
    wanted = own.select(F.col(document).alias("_d"), F.inline(F.array(*[F.struct(F.lit(f).alias("_f"), null_words(F.col(f)).alias("in_metadata")) for f, _ in FIELD_CODES])))
    known = rows.select(document).distinct().join(wanted, F.col(document) == F.col("_d")).select(document, F.col("_f").alias("field"), "in_metadata")
    joined = known.join(listed, [document, "field"], "left")
    codes = F.transform("found", lambda x: x["code"])
    has, says = F.col("found").isNotNull(), F.col("in_metadata").isNotNull()
    issue = (
        F.when(has & ~says, "missing_in_metadata").when(says & ~has, "not_found_in_text").when(has & says & ~F.array_contains(codes, F.col("in_metadata")), "conflict")
        .when(has & says & (F.size("found") > 1), "other_values_in_text")
    )
    shown = F.array_join(F.transform("found", lambda x: F.concat(x["code"], F.lit(" x "), (-x["o"]).cast("string"))), "; ")
    return joined.select(document, "field", issue.alias("issue"), "in_metadata", shown.alias("in_text")).where("issue is not null")
