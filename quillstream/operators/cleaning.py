"""Cleaning of paged documents: running banners, printed page numbers, blank lines, and proof that nothing else was lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.functions.text import squash

MARKER = r"(?i)^--- page [0-9]+ ---\s*$"
# Banners have at most so many characters and words.
BANNER_CHARS, BANNER_WORDS = 60, 8


def page_lines(df: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, page_no, line_no, line): the lines of paged texts without the marker lines; page_no is null before the first marker.

    Markers are looked up in the text's own array of lines, so no shuffle is needed. Null texts have no line.
    """
    lines = F.split("text", "\n", -1)
    numbered = F.transform(lines, lambda x, i: F.struct((i + 1).alias("no"), x.alias("line"), F.when(x.rlike(MARKER), F.regexp_extract(x, r"[0-9]+", 0).cast("int")).alias("page")))
    plain = df.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{file}`").alias("file"), F.col(f"`{text}`").alias("text"))
    marks = plain.select("file", numbered.alias("l"), F.transform(F.filter(numbered, lambda x: x["page"].isNotNull()), lambda x: F.struct(x["no"], x["page"])).alias("m"))
    each = marks.select("file", "m", F.explode_outer("l").alias("l")).where("l.no is not null and l.page is null")
    before = F.filter("m", lambda x: x["no"] < F.col("l.no"))
    return each.select("file", F.get(before, F.size(before) - 1)["page"].alias("page_no"), F.col("l.no").cast("int").alias("line_no"), F.col("l.line").alias("line"))


def edge_lines(lines: DataFrame, edge: int = 2, least: int = 6) -> DataFrame:
    """(file, page_no, line_no, line, edge): the first and last `edge` lines that are not blank of each numbered page with at least `least` of them."""
    full = lines.where("page_no is not null and trim(line) <> ''")
    page = Window.partitionBy("file", "page_no")
    ranked = (
        full.withColumn("up", F.row_number().over(page.orderBy("line_no")))
        .withColumn("n", F.count("*").over(page))
        .where((F.col("n") >= least) & ((F.col("up") <= edge) | (F.col("up") > F.col("n") - edge)))
    )
    return ranked.select("file", "page_no", "line_no", "line", F.when(F.col("up") <= edge, "top").otherwise("bottom").alias("edge"))


def banner_verdict(line: Column, protected: tuple[str, ...] = ()) -> Column:
    """Whether a line looks like a banner and not like text: short, no full stop, no digit, no known heading."""
    plain = squash(line)
    fine = (F.length(plain) <= BANNER_CHARS) & (F.size(F.split(plain, " ")) <= BANNER_WORDS) & ~plain.rlike(r"[.:;,]$") & ~plain.rlike(r"[0-9]")
    return fine & ~F.lower(plain).isin(*[p.lower() for p in protected]) if protected else fine


def banners(lines: DataFrame, share: float = 0.6, weak: float = 0.25, least: int = 4, protected: tuple[str, ...] = ()) -> DataFrame:
    """(file, edge, banner, pages, eligible, decision): lines that repeat on page edges.

    decision is `remove` where a line stands on max(least, share) of the file's eligible pages and looks like a banner, `flag` where
    it stands on max(least, weak) of them.
    """
    edges = edge_lines(lines).withColumn("banner", squash(F.col("line")))
    eligible = edges.groupBy("file").agg(F.count_distinct("page_no").alias("eligible"))
    seen = edges.select("file", "edge", "banner", "page_no").distinct().groupBy("file", "edge", "banner").agg(F.count("*").alias("pages"))
    joined = seen.where(F.col("pages") >= least).join(eligible, "file")
    enough = F.col("pages") >= F.greatest(F.lit(least), F.ceil(F.lit(share) * F.col("eligible")))
    some = F.col("pages") >= F.greatest(F.lit(least), F.ceil(F.lit(weak) * F.col("eligible")))
    return joined.withColumn("decision", F.when(enough & banner_verdict(F.col("banner"), protected), "remove").when(some, "flag")).where("decision is not null")


def page_number_candidates(lines: DataFrame) -> DataFrame:
    """(file, page_no, line_no, line, edge, printed, labelled): page numbers at the very first or last line of a page that is not blank."""
    full = lines.where("page_no is not null and trim(line) <> ''")
    page = Window.partitionBy("file", "page_no")
    ends = (
        full.withColumn("n", F.count("*").over(page))
        .withColumn("up", F.row_number().over(page.orderBy("line_no")))
        .withColumn("inner", F.when(F.col("up") == 1, F.lead("line").over(page.orderBy("line_no"))).otherwise(F.lag("line").over(page.orderBy("line_no"))))
        .where("up = 1 or up = n")
    )
    plain = squash(F.col("line"))
    labelled = plain.rlike(r"(?i)^page [0-9]+(?: of [0-9]+)?$|^- ?[0-9]+ ?-$")
    bare = plain.rlike(r"^[0-9]{1,4}$") & ~F.coalesce(squash(F.col("inner")).rlike(r"^[0-9]+$"), F.lit(False))
    edge = F.when((F.col("up") == 1) & (F.col("n") > 1), "top").otherwise("bottom")
    return ends.where(labelled | bare).select("file", "page_no", "line_no", "line", edge.alias("edge"), F.regexp_extract("line", r"[0-9]+", 0).cast("int").alias("printed"), labelled.alias("labelled"))


def page_number_offsets(lines: DataFrame, share: float = 0.3, least: int = 3) -> DataFrame:
    """(file, edge, offset, pages): per edge the most frequent distance of bare printed numbers from the page's own, if max(least, share) of
    the numbered pages have it; of equally frequent ones the one seen first."""
    bare = page_number_candidates(lines).where("not labelled").withColumn("offset", F.col("printed") - F.col("page_no"))
    counted = bare.groupBy("file", "edge", "offset").agg(F.count("*").alias("pages"), F.min("page_no").alias("seen"))
    best = counted.groupBy("file", "edge").agg(F.max_by(F.struct("offset", "pages"), F.struct("pages", -F.col("seen"))).alias("b"))
    numbered = lines.where("page_no is not null").groupBy("file").agg(F.count_distinct("page_no").alias("numbered"))
    kept = best.join(numbered, "file").where(F.col("b.pages") >= F.greatest(F.lit(least), F.ceil(F.lit(share) * F.col("numbered"))))
    return kept.select("file", "edge", F.col("b.offset").alias("offset"), F.col("b.pages").alias("pages"))


def page_number_lines(lines: DataFrame) -> DataFrame:
    """(file, page_no, line_no, line, decision): labelled numbers and those at the file's offset are `remove`, near misses `flag`."""
    found = page_number_candidates(lines)
    offsets = page_number_offsets(lines).select(F.col("file").alias("f"), F.col("edge").alias("e"), "offset")
    away = F.abs(F.col("printed") - F.col("page_no") - F.col("offset"))
    decision = F.when(F.col("labelled") | (away == 0), "remove").when(away <= 2, "flag")
    joined = found.join(offsets, (F.col("file") == F.col("f")) & (F.col("edge") == F.col("e")), "left")
    return joined.select("file", "page_no", "line_no", "line", decision.alias("decision")).where("decision is not null")


def removed_lines(lines: DataFrame) -> DataFrame:
    """(file, page_no, line_no, line, reason): what the cleaning takes out. The first numbered page keeps its banners."""
    lead = lines.where("page_no is not null").groupBy(F.col("file").alias("f")).agg(F.min("page_no").alias("first"))
    approved = banners(lines).where("decision = 'remove'").select(F.col("file").alias("b_file"), F.col("edge").alias("b_edge"), "banner")
    edges = edge_lines(lines).join(lead, F.col("file") == F.col("f")).where("page_no > first")
    gone = edges.join(approved, (F.col("file") == F.col("b_file")) & (F.col("edge") == F.col("b_edge")) & (squash(F.col("line")) == F.col("banner")), "left_semi")
    gone = gone.select("file", "page_no", "line_no", "line", F.lit("repeated_banner").alias("reason"))
    rest = lines.join(gone.select("file", "line_no"), ["file", "line_no"], "left_anti").select("file", "page_no", "line_no", "line")
    numbers = page_number_lines(rest).where("decision = 'remove'").select("file", "page_no", "line_no", "line", F.lit("page_number").alias("reason"))
    return gone.unionByName(numbers)


def cleaned_text(df: DataFrame, file: str = "file", text: str = "text", removed: DataFrame | None = None) -> DataFrame:
    """(file, text): each distinct file without its banners and page numbers, or without the lines of `removed`, blank lines collapsed to one, blanks at line ends gone."""
    rows = df.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{file}`").alias("file"), F.col(f"`{text}`").alias("text")).distinct()
    gone = (removed_lines(page_lines(rows)) if removed is None else removed).groupBy(F.col("file").alias("g")).agg(F.collect_set("line_no").alias("gone"))
    joined = rows.join(gone, F.col("file") == F.col("g"), "left")
    out = F.coalesce("gone", F.array().cast("array<int>"))
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(out, (i + 1).cast("int")))
    return joined.select("file", collapse_blank_lines(F.array_join(F.transform(kept, lambda x: F.regexp_replace(x, r"[ \t]+$", "")), "\n")).alias("text"))


def collapse_blank_lines(text: Column, most: int = 1) -> Column:
    """At most `most` blank lines in a row."""
    return F.regexp_replace(text, "\n(?:[ \t]*\n){" + str(most + 1) + ",}", "\n" * (most + 1))


def characters(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, character, n): the multiset of a text's characters that are not white space."""
    each = df.select(F.col(f"`{key}`").alias(key), F.explode_outer(F.split(F.regexp_replace(F.col(f"`{text}`"), r"\s", ""), "")).alias("character"))
    return each.where("character <> ''").groupBy(key, "character").agg(F.count("*").alias("n"))


def _multiset(text: Column) -> Column:
    """A text's characters, white space aside, as their number and two sums of hashes: the same for the same characters in any order."""
    plain = F.split(F.regexp_replace(text, r"\s", ""), "")
    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n", "a", "b")])

    def add(total: Column, hashed: Column) -> Column:
        return F.pmod(total + hashed.bitwiseAND(F.lit((1 << 60) - 1)), F.lit((1 << 61) - 1))  # stays inside a long, however long the text

    return F.aggregate(plain, zero, lambda t, c: F.struct((t["n"] + F.length(c)).alias("n"), add(t["a"], F.xxhash64(c)).alias("a"), add(t["b"], F.xxhash64(c, F.lit(1))).alias("b")))


def integrity(raw: DataFrame, clean: DataFrame, removed: DataFrame, file: str = "file") -> DataFrame:
    """(file, verdict): OK where the characters of the raw text, white space aside, are those of the clean text and the removed lines together, else MISMATCH.

    Both sides are compared by sums over the hashes of their characters, taken in one pass over each text. Files whose raw text is blank have no row.
    """
    taken = removed.groupBy(F.col(file).alias("_t")).agg(F.array_join(F.collect_list("line"), "").alias("taken"))
    after = clean.select(F.col(file).alias("_f"), F.col("text").alias("kept")).join(taken, F.col("_f") == F.col("_t"), "left")
    after = after.select("_f", _multiset(F.concat("kept", F.coalesce("taken", F.lit("")))).alias("after"))
    both = raw.where(F.col("text").rlike(r"\S")).select(F.col(file), _multiset(F.col("text")).alias("before")).join(after, F.col(file) == F.col("_f"), "left")
    return both.select(file, F.when(F.col("before").eqNullSafe(F.col("after")), "OK").otherwise("MISMATCH").alias("verdict"))
