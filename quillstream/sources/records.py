"""Readers and writers of records: strict and tolerant JSON lines, CSV metadata, paged texts, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.functions.text import null_words

METADATA_COLUMNS = ("source_id", "filename", "file_exists", "title", "authority", "document_type", "product", "plan_number", "uin", "version", "effective_date", "language", "status")


def read_json_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines of which every one must fit the schema; a bad line fails the read."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_json_tolerant(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines with path and problem). Blank lines are neither."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\x{FEFF}", "").alias("line"), F.col("_metadata.file_path").alias("path")).where(F.trim("line") != "")
    with_bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.withColumn("r", F.from_json("line", with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    broken = F.col("r._bad").isNotNull() | ~F.trim("line").startswith("{")
    good = parsed.where(~broken).select(*[F.col(f"r.`{f.name}`").alias(f.name) for f in schema.fields])
    bad = parsed.where(broken).select("path", F.when(F.trim("line").startswith("{"), "invalid_json").otherwise("not_a_json_object").alias("problem"), "line")
    return good, bad


def record_problems(df: DataFrame, key: str = "page_id") -> DataFrame:
    """`df` with problems, the reasons for which a page record can't be used, in a fixed order."""
    tests = [
        (null_words(F.col("source_id")).isNull(), "missing_source_id"),
        (F.col("page_number").isNull(), "page_number_not_an_integer"),
        (F.col("page_number") < 1, "page_number_below_1"),
        (null_words(F.col(key)).isNull(), "missing_page_id"),
        (F.trim("text").isNull() | (F.trim("text") == ""), "missing_text"),
    ]
    return df.withColumn("problems", F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for t, n in tests])))


def check_records(df: DataFrame, key: str = "chunk_id", text: str = "text", show: int = 10) -> DataFrame:
    """`df` unchanged if all rows have a key and a text and no key comes twice; otherwise ValueError with the first problems."""
    lacking = df.where(F.col(key).isNull() | F.col(text).isNull() | (F.trim(text) == "")).select(F.coalesce(F.col(key).cast("string"), F.lit("(no key)")).alias("k"), F.lit("missing key or text").alias("p"))
    twice = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).count().where(F.col("count") > 1).select("k", F.lit("duplicate key").alias("p"))
    found = lacking.unionByName(twice).limit(show).collect()
    if found:
        raise ValueError("; ".join(f"{r['k']}: {r['p']}" for r in found))
    return df


def read_metadata_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metadata from CSV: header names trimmed and in lower case, a byte order mark ignored, null words as nulls."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    names = [c.replace("﻿", "").strip().lower() for c in raw.columns]
    plain = raw.toDF(*names)
    return plain.select(*[null_words(F.col(f"`{c}`")).alias(c) for c in names])


def write_metadata_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, escape='"')


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_texts(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """(file, text): one row for each text file under a folder."""
    rows = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    return rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1).alias("file"), F.col("value").alias("text"))


def read_binary(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, sha256, length): files as they lie there; two such snapshots joined tell what has changed."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", F.sha2("content", 256).alias("sha256"), "length")


def paged_text(pages: DataFrame, file: str = "filename", number: str = "page_number", text: str = "text") -> DataFrame:
    """(file, text): the pages of each file in order, each after its marker line."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), F.coalesce(F.col(text), F.lit("")).alias("t"))))
    joined = F.array_join(F.transform(parts, lambda p: F.concat(F.lit("--- PAGE "), p["n"].cast("string"), F.lit(" ---\n"), p["t"], F.lit("\n"))), "\n")
    return pages.select(file, number, text).distinct().groupBy(file).agg(joined.alias("text"))


def patch_pages(pages: DataFrame, patch: DataFrame, key: str = "page_id", text: str = "text") -> DataFrame:
    """`pages` with the texts of `patch` where it has the page."""
    new = patch.groupBy(F.col(key).alias("_k")).agg(F.max(text).alias("_new"))
    return pages.join(new, F.col(key) == F.col("_k"), "left").withColumn(text, F.coalesce("_new", F.col(text))).drop("_k", "_new")


def snapshot_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change): files added, removed or changed between two snapshots of read_binary."""
    b, a = before.select("path", F.col("sha256").alias("b")), after.select("path", F.col("sha256").alias("a"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return b.join(a, "path", "full").select("path", change.alias("change")).where("change is not null")


def write_vectors(df: DataFrame, path: str, partition: str | None = None, sort: str | None = None) -> None:
    """A vector table, rebuilt as a whole; sorted inside files so that filters can skip row groups."""
    rows = df.sortWithinPartitions(sort) if sort else df
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def verify_vectors(spark: SparkSession, path: str, expected: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(rows_written, rows_expected, different, dimensions): what a written vector table holds against what it should."""
    written = spark.read.parquet(path)
    w = written.select(key, F.sha2(F.to_json(F.struct(vector)), 256).alias("w"), F.size(vector).alias("size"))
    e = expected.select(F.col(key).alias("_k"), F.sha2(F.to_json(F.struct(vector)), 256).alias("e"))
    both = w.join(e, F.col(key) == F.col("_k"), "full")
    return both.agg(F.count("w").alias("rows_written"), F.count("e").alias("rows_expected"), F.count_if(~F.col("w").eqNullSafe(F.col("e"))).alias("different"), F.count_distinct("size").alias("dimensions"))
