"""Report rows: issues brought to the pages they concern, counts in order, examples and capped lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import corpus

#: The order in which kinds of personal data are shown.
STATUS_ORDER = ("possible_pii", "public_contact_information", "template_fields", "unknown", "none_detected")


def page_issues(pages: DataFrame, metadata: DataFrame, fields: tuple[str, ...], key: str = "source_id", page: str = "page_id") -> DataFrame:
    """(key, page, issue): what checks of whole documents mean for each of their pages.

    metadata_row_missing for the pages of documents without a metadata row, page_records_differ_from_metadata:field or
    metadata_completeness_difference:field where a document's pages and its row disagree, duplicate_page_id where an id comes more than once. A
    page without a document has none of the former.
    """
    each = pages.select(key, page).where(F.col(page).isNotNull()).distinct()
    missing = corpus.without_partner(pages, metadata, key).select(F.col(key).alias("_k"), F.lit("metadata_row_missing").alias("issue"))
    differ = corpus.metadata_differences(pages, metadata, fields, key=key).select(F.col(key).alias("_k"), F.concat("issue", F.lit(":"), "field").alias("issue")).distinct()
    twice = corpus.duplicate_keys(pages, page).select(F.col(page).alias("_p"), F.lit("duplicate_page_id").alias("issue"))
    by_document = each.join(missing.unionByName(differ), F.col(key) == F.col("_k")).select(key, page, "issue")
    return by_document.unionByName(each.join(twice, F.col(page) == F.col("_p")).select(key, page, "issue"))


def with_issues(pages: DataFrame, issues: DataFrame, page: str = "page_id") -> DataFrame:
    """`pages` with issues, the sorted list of theirs; empty where there is none."""
    listed = issues.groupBy(F.col(page).alias("_p")).agg(F.sort_array(F.collect_set("issue")).alias("issues"))
    return pages.join(listed, F.col(page) == F.col("_p"), "left").drop("_p").withColumn("issues", F.coalesce("issues", F.array().cast("array<string>")))


def examples(df: DataFrame, category: str, of: str, example: str, most: int = 3) -> DataFrame:
    """(category, n, sources, examples): rows and different `of` of each category, and its first `most` different examples in their order."""
    counts = df.groupBy(category).agg(F.count("*").alias("n"), F.count_distinct(of).alias("sources"))
    first = first_rows(df.select(category, example).distinct(), [category], [F.col(example)], most).groupBy(F.col(category).alias("_c")).agg(F.sort_array(F.collect_list(example)).alias("examples"))
    return counts.join(first, F.col(category).eqNullSafe(F.col("_c"))).drop("_c")


def first_rows(df: DataFrame, keys: list[str], order: list[Column], most: int) -> DataFrame:
    """The first `most` rows of each key: a capped list is what is asked for. Spark keeps no more than that of a key in any task before it shuffles."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def ranked_counts(df: DataFrame, value: str) -> DataFrame:
    """(place, value, n): values by falling count, equal counts by value. Only the counts are ordered."""
    counted = df.groupBy(value).agg(F.count("*").alias("n"))
    return counted.select(F.row_number().over(Window.orderBy(F.desc("n"), value)).alias("place"), value, "n").orderBy("place")


def by_status(pages: DataFrame, status: str = "pii_status") -> DataFrame:
    """`pages` with status_rank, in the order of STATUS_ORDER; other values come last."""
    rank = F.array_position(F.array(*map(F.lit, STATUS_ORDER)), F.col(status)).cast("int")
    return pages.withColumn("status_rank", F.when(rank > 0, rank).otherwise(len(STATUS_ORDER) + 1)).orderBy("status_rank")
