"""From raw texts to records in one call: page records of paged files, chunks of pages and web texts together, and the report of a cleaning run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions import pages as P
from quillstream.functions import text as T
from quillstream.session import cut

from . import cleaning, corpus

#: What pages take over from their file's metadata.
INHERITED = ("title", "authority", "document_type", "product", "plan_number", "uin", "version", "effective_date", "status")
_MARKER = r"(?im)^--- PAGE [0-9]+ ---[ \t]*$"


def split_pages(df: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, place, page_number, text): the pages between a text's markers, in their order, with the lines' outer breaks gone.

    What stands before the first marker is no page; a text without markers has none. Null texts have no page.
    """
    marked = df.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{file}`").alias("file"), T.page_markers(F.col(f"`{text}`")).alias("t"))
    numbers = F.transform(F.regexp_extract_all("t", F.lit(r"(?im)^--- PAGE ([0-9]+) ---[ \t]*$"), F.lit(1)), lambda x: x.cast("int"))
    parts = F.slice(F.split("t", _MARKER, -1), F.lit(2), F.greatest(F.size(F.split("t", _MARKER, -1)) - 1, F.lit(0)))
    each = marked.select("file", F.posexplode(F.arrays_zip(numbers.alias("n"), parts.alias("p"))).alias("place", "x"))
    return each.select("file", "place", F.col("x.n").alias("page_number"), F.regexp_replace("x.p", r"^\n+|\n+$", "").alias("text"))


def candidate_headings(text: Column) -> Column:
    """Lines that look like headings and are no known ones: short, begun with a capital, without a stop, a figure alone or a field to fill in."""
    known = F.array(*[F.lit(n.lower()) for n, _, _ in P.HEADINGS])
    words = lambda x: F.split(x, r"\s+")
    capital = lambda x: F.size(F.filter(words(x), lambda w: w.rlike(r"^\p{Lu}")))
    fits = lambda x: (F.length(x) <= 60) & x.rlike(r"^\p{Lu}") & ~x.rlike(r"[.;,:?!।]$|_{3,}|[0-9]{3,}") & (F.size(words(x)) <= 8) & (capital(x) >= 0.6 * F.size(words(x)))
    return F.array_distinct(F.filter(P.lines_of(text), lambda x: fits(x) & ~F.array_contains(known, F.lower(x))))


def page_records(raw: DataFrame, metadata: DataFrame, file: str = "file", text: str = "text", name: str = "filename", source: str = "source_id") -> DataFrame:
    """Page records from paged texts and the table of their files' metadata.

    Files are matched to metadata by stem or id (corpus.match_files) before they are cut into pages, so what a file takes over is joined
    once a file. Each page then gets an id, its headings, candidate headings, topics and section, the section that runs at its
    start, language by script, kind of content, tables, forms, personal data, counts, a hash, its neighbours and the reasons for which it should be
    looked at. Two pages of a file with one number have the reason duplicate_page_number. A file without metadata keeps its
    stem as source and has nulls for what it would take over. Equal rows count once; several texts of one file are pages of that file.
    """
    clean = corpus.clean_metadata(metadata, source)
    match = corpus.match_files(raw.withColumnRenamed(file, name) if file != name else raw, clean, name, source)
    about = match.select(F.col("file").alias("_f"), F.col("source").alias("_s"), "matched_by").join(clean.select(F.col(source).alias("_m"), *[F.col(c) for c in INHERITED]), F.col("_s") == F.col("_m"), "left")
    texts = raw.select(F.col(f"`{file}`").alias("file"), F.col(f"`{text}`").alias("text")).dropDuplicates()
    joined = texts.join(about, F.col("file") == F.col("_f"), "left").drop("_f", "_m")
    found = split_pages(joined.withColumn("file", F.struct("file", "_s", "matched_by", *INHERITED)))
    flat = found.select("file.*", "place", "page_number", "text").withColumn("source_id", F.coalesce("_s", corpus.file_stem(F.col("file")))).drop("_s")
    t = F.col("text")
    flat = flat.select(
        "*", F.concat("source_id", F.lit("-p"), F.col("page_number").cast("string")).alias("page_id"), P.headings(t).alias("headings"), candidate_headings(t).alias("candidate_headings"),
        P.structural_markers(t).alias("structural_markers"), T.script_label(t).alias("language"), P.content_evidence(t).alias("content_evidence"), P.table_signal(t).alias("table_signal"),
        P.form_evidence(t).alias("form_evidence"), P.personal_status(t).alias("pii_status"), P.personal_data(t).alias("pii_signals"), P.keyword_hits(t).alias("keyword_hits"), T.anomalies(t).alias("anomalies"),
        F.length(t).alias("char_count"), T.word_count(t).alias("word_count"), T.line_count(t).alias("line_count"), F.sha2(t, 256).alias("text_hash"),
    )
    flat = flat.withColumn("section", F.coalesce(F.get("headings", F.lit(0)), F.get("structural_markers", F.lit(0))))
    flat = flat.withColumn("section_source", F.when(F.size("headings") > 0, "heading").when(F.col("section").isNotNull(), "structural_marker"))
    in_file = Window.partitionBy("source_id").orderBy("page_number", "place", "text_hash")  # the pages of one file
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    flat = flat.select(
        "*", F.last("section", ignorenulls=True).over(before).alias("section_at_page_start"),
        F.last(F.when(F.col("section").isNotNull(), F.col("page_number")), ignorenulls=True).over(before).alias("section_at_page_start_from_page"),
        F.lag("page_id").over(in_file).alias("previous_page_id"), F.lead("page_id").over(in_file).alias("next_page_id"),
        (F.count("*").over(Window.partitionBy("source_id", "page_number")) > 1).alias("_twice"),
    )
    form = P.form_signal_of(F.col("form_evidence"))
    kind = P.content_kind(F.col("content_evidence"))
    flat = flat.select("*", P.topics(F.col("headings")).alias("topics"), form.alias("form_signal"), kind.alias("content_type"))
    reasons = F.array_compact(F.array(
        T.emptiness(t), F.when(F.col("_twice"), "duplicate_page_number"), F.when(F.col("pii_status") == "possible_pii", "possible_pii"),
        F.when(F.col("table_signal") == "table", "table_detected").when(F.col("table_signal") == "possible", "possible_table"),
        F.when(F.col("form_signal") == "form", "form_detected").when(F.col("form_signal") == "possible", "possible_form"), F.when(F.size("anomalies") > 0, "extraction_anomaly"),
        F.when(F.col("language") == "Unknown", "unknown_language"), F.when(F.col("section").isNull(), "unknown_section"), F.when(F.col("content_type") == "unknown", "unknown_content_type"),
        F.when(F.col("section").isNull() & (F.col("content_type") == "unknown"), "no_section_and_no_content_type"),
        *[F.when(F.col(c).isNull(), f"doc_metadata_missing:{c}") for c in ("title", "authority", "document_type")],
    ))
    citation = F.concat(F.coalesce("title", "file"), F.lit(", p. "), F.col("page_number").cast("string"))
    return flat.select("*", reasons.alias("review_reasons"), corpus.needs_review(reasons).alias("review_required"), citation.alias("citation")).drop("_twice", "place", "content_evidence")


def chunk_corpus(pages: DataFrame, web: DataFrame, size: int = 218, stride: int = 168) -> DataFrame:
    """(source_type, parent, chunk_index, words, text_hash, text): windows over the words of pages (page_id, text) and of web texts (text_file, text).

    The first chunk of each text holds, pages before web texts, then by parent and place; a later one with the same hash is left
    out and leaves a gap in its parent's chunk_index. The union is hashed before it is shuffled; chunks are compared by order keys.
    """

    def windows(df: DataFrame, kind: str, key: str) -> DataFrame:
        each = df.select(F.lit(kind).alias("source_type"), F.col(key).alias("parent"), F.posexplode(T.word_windows(F.col("text"), size, stride)).alias("chunk_index", "w"))
        return each.select("source_type", "parent", "chunk_index", F.size("w").alias("words"), F.array_join("w", " ").alias("text"))

    both = windows(pages, "pdf", "page_id").unionByName(windows(web, "web", "text_file")).withColumn("text_hash", F.sha2("text", 256))
    return corpus.ordered_dedup(both, F.col("text_hash"), F.col("source_type"), F.col("parent"), F.col("chunk_index"))


def cleaning_report(raw: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, pages, chars_raw, chars_cleaned, lines_removed, flags, blank_lines_removed, page_number_offset_top, page_number_offset_bottom, integrity_check) of a cleaning run.

    One run: lines and what is taken out are written once and serve the cleaned text, the counts and the proof that nothing else was
    lost. flags counts banners and page numbers that were left in doubt. Null texts have no row; blank ones the check OK.
    """
    rows = raw.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{file}`").alias("file"), F.col(f"`{text}`").alias("text")).distinct()
    lines = cut(cleaning.page_lines(rows))
    removed = cut(cleaning.removed_lines(lines))
    cleaned = cut(cleaning.cleaned_text(rows, removed=removed))
    pages = lines.where("page_no is not null").groupBy("file").agg(F.count_distinct("page_no").alias("pages"))
    gone = removed.groupBy("file").agg(F.count("*").alias("lines_removed"))
    doubt = cleaning.banners(lines).where("decision = 'flag'").select("file").unionByName(cleaning.page_number_lines(lines).where("decision = 'flag'").select("file")).groupBy("file").agg(F.count("*").alias("flags"))
    offsets = cleaning.page_number_offsets(lines).groupBy("file").agg(F.max(F.when(F.col("edge") == "top", F.col("offset"))).alias("page_number_offset_top"), F.max(F.when(F.col("edge") == "bottom", F.col("offset"))).alias("page_number_offset_bottom"))
    sizes = rows.select("file", F.length("text").alias("chars_raw"), T.line_count(F.col("text")).alias("_all")).join(cleaned.select("file", F.length("text").alias("chars_cleaned"), T.line_count(F.col("text")).alias("_left")), "file")
    verdict = cleaning.integrity(rows, cleaned, removed).select("file", F.col("verdict").alias("integrity_check"))
    out = sizes
    for part in (pages, gone, doubt, offsets, verdict):
        out = out.join(part, "file", "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c)
    return out.select("file", none("pages"), "chars_raw", "chars_cleaned", none("lines_removed"), none("flags"), (F.col("_all") - F.col("_left") - F.coalesce("lines_removed", F.lit(0))).cast("int").alias("blank_lines_removed"), "page_number_offset_top", "page_number_offset_bottom", F.coalesce("integrity_check", F.lit("OK")).alias("integrity_check"))
