"""Lines repeated across one site's documents: suffix classes over line identifiers by prefix doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.session import cut


def line_key(line):
    """What makes two lines the same: their letters and the signs that belong to letters, in lower case."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}\p{M}]", "")


def _keyed(df: DataFrame, file: str, site: str, text: str) -> DataFrame:
    """The rows as (site, file, text, doc): doc is the hash of all three, so texts that differ under one file stay apart."""
    rows = df.select(F.col(f"`{site}`").alias("site"), F.col(f"`{file}`").alias("file"), F.col(f"`{text}`").alias("text"))
    gaps = F.concat(*(F.when(F.col(c).isNull(), "0").otherwise("1") for c in ("site", "file", "text")))
    return rows.withColumn("doc", F.xxhash64("site", "file", "text", gaps))


def _documents(df: DataFrame, file: str, site: str, text: str) -> DataFrame:
    """(site, file, doc, ids, at): the identifiers of a text's lines with letters, in their order, and their line numbers. An
    identifier holds its site, so lines of two sites never meet. Rows without a site, file or text belong to no site."""
    rows = _keyed(df, file, site, text).where("site is not null and file is not null and text is not null")
    keys = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(line_key(x).alias("key"), (i + 1).alias("no")))
    kept = rows.select("site", "file", "doc", F.filter(keys, lambda x: x["key"].rlike(r"\p{L}")).alias("kept"))
    ids = F.transform("kept", lambda x: F.xxhash64("site", x["key"]))
    return cut(kept.select("site", "file", "doc", ids.alias("ids"), F.transform("kept", lambda x: x["no"].cast("int")).alias("at")))  # twelve bytes a line


def _spanning(suffixes: DataFrame, need: DataFrame, min_files: int) -> DataFrame:
    """(name, documents) of the prefixes that stand in enough of their site's distinct files."""
    seen = suffixes.select("site", "name", F.xxhash64("file").alias("f")).distinct()  # spreads a hot line over its files before it is counted
    seen = seen.groupBy("site", "name").agg(F.count("*").alias("documents")).where(F.col("documents") >= min_files)
    return seen.join(need, "site").where("documents >= need").select("name", "documents")


def _levels(df: DataFrame, file: str, site: str, text: str, min_share: float, min_files: int) -> list[DataFrame]:
    """One table for each doubling, written once: (site, file, doc, idx, line_no, end_line, name, documents)."""
    documents = _documents(df, file, site, text)
    need = documents.select("site", "file").distinct().groupBy("site").agg(F.count("*").alias("files")).select("site", (F.lit(min_share) * F.col("files")).alias("need"))
    first = documents.select("site", "file", "doc", F.posexplode(F.arrays_zip("ids", "at")).alias("idx", "x"))
    first = first.select("site", "file", "doc", "idx", F.col("x.at").alias("line_no"), F.col("x.at").alias("end_line"), F.col("x.ids").alias("name"))
    names = _spanning(documents.select("site", "file", F.explode(F.array_distinct("ids")).alias("name")), need, min_files)
    levels = [cut(first.join(names, "name").distinct())]
    while True:
        n = 1 << (len(levels) - 1)
        ahead = Window.partitionBy("doc").orderBy("idx").rangeBetween(n, n)  # one text's lines at most
        longer = levels[-1].select("site", "file", "doc", "idx", "line_no", F.first("end_line").over(ahead).alias("end_line"), "name", F.first("name").over(ahead).alias("next")).where("next is not null")
        longer = cut(longer.select("site", "file", "doc", "idx", "line_no", "end_line", F.xxhash64("name", "next").alias("name")))
        level = levels[0].limit(0) if longer.isEmpty() else cut(longer.join(_spanning(longer, need, min_files), "name"))
        if level.isEmpty():
            return levels
        levels.append(level)


def spanning_blocks(df: DataFrame, file: str = "source_file", site: str = "site", text: str = "text", min_share: float = 0.2, min_files: int = 5) -> DataFrame:
    """(site, file, doc, line_no, end_line, n_lines, block, documents): blocks of 1, 2, 4, 8 ... lines that stand in at least
    `min_share` of a site's distinct files and in at least `min_files`, at every place where they stand.

    The suffixes of all texts, one from each line with letters, are grouped by prefix doubling: a suffix is named by its first
    line, then by its first two lines, four, eight and so on, the name of 2n lines being that of the two names of n lines. Suffixes
    of one name are one interval of the suffix array, with a common prefix of at least that many lines; as nothing but these
    intervals is asked for, names are hashes and nothing is sorted over the corpus. A prefix can span enough files only if both its
    halves do, so every round goes on with those alone, and rounds end when no prefix does. Any longer block is covered by two
    blocks of the largest power of two inside it, which span at least as many files; so the blocks found here cover exactly the
    lines of all blocks.

    Nulls and empty texts give no block; equal rows count once; a file with several texts is one file, and each of its texts (doc)
    has its own lines. `line_no` counts blank lines, from 1; lines without letters inside a block are passed over.
    """
    whole = None
    for k, level in enumerate(_levels(df, file, site, text, min_share, min_files)):
        blocks = level.select("site", "file", "doc", "line_no", "end_line", F.lit(1 << k).alias("n_lines"), F.col("name").alias("block"), "documents")
        whole = blocks if whole is None else whole.unionByName(blocks)
    return whole


def block_lines(df: DataFrame, file: str = "source_file", site: str = "site", text: str = "text", min_share: float = 0.2, min_files: int = 5, min_lines: int = 1) -> DataFrame:
    """(site, file, doc, line_no, block_lines, documents): the lines that blocks of `min_lines` lines or more cover, with the length
    of the longest block of spanning_blocks that covers each, and the files of that block. `min_lines` is a power of two; 2 leaves
    alone lines that come back by themselves only."""
    if min_lines < 1 or min_lines & (min_lines - 1):
        raise ValueError("min_lines must be a power of two")
    levels = _levels(df, file, site, text, min_share, min_files)
    # a longer block covers the single lines between its ends: each size's starts and ends are carried along the text's lines
    marks = levels[0].select("site", "file", "doc", "line_no", "end_line", F.lit(1).alias("n_lines"), "documents")
    for k, level in enumerate(levels[1:], 1):
        marks = marks.unionByName(level.select("site", "file", "doc", "line_no", "end_line", F.lit(1 << k).alias("n_lines"), "documents"))
    so_far = Window.partitionBy("doc").orderBy("line_no").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = [1 << k for k in range(1, len(levels))]
    reach = [F.max(F.when(F.col("n_lines") == n, F.struct("end_line", "documents"))).over(so_far).alias(f"r{n}") for n in sizes]
    found = marks.select("site", "file", "doc", "line_no", "n_lines", "documents", *reach).where("n_lines = 1")
    best = F.struct(F.lit(1).alias("n"), F.col("documents").alias("d"))
    for n in sizes:
        best = F.when(F.col(f"r{n}.end_line") >= F.col("line_no"), F.struct(F.lit(n).alias("n"), F.col(f"r{n}.documents").alias("d"))).otherwise(best)
    found = found.select("site", "file", "doc", "line_no", best.alias("b")).select("site", "file", "doc", "line_no", F.col("b.n").alias("block_lines"), F.col("b.d").alias("documents"))
    return found if min_lines == 1 else found.where(F.col("block_lines") >= min_lines)


def repeated_lines(df: DataFrame, file: str = "source_file", site: str = "site", text: str = "text", min_share: float = 0.2, min_files: int = 5, min_lines: int = 1) -> DataFrame:
    """(site, file, line_no): each line inside a block that spans enough of its site's files, of any of the file's texts. Line numbers count blank lines, from 1."""
    return block_lines(df, file, site, text, min_share, min_files, min_lines).select("site", "file", "line_no").distinct()


def remove_repeated_lines(df: DataFrame, summary: DataFrame, file: str = "source_file", site: str = "site", text: str = "text", min_share: float = 0.2, min_files: int = 5, min_lines: int = 1) -> DataFrame:
    """(file, site, text, lines_removed): each distinct row of `df` without its blocks.

    lines_removed is the largest value that `summary` has for the file (0 where it has none or null) plus the lines taken out
    of this text. A null text stays null, a file of which every line goes has the empty text.
    """
    found = block_lines(df, file, site, text, min_share, min_files, min_lines)
    gone = found.groupBy("doc").agg(F.collect_set("line_no").alias("gone"))
    before = summary.groupBy(F.col(f"`{file}`").alias("file")).agg(F.max("lines_removed").alias("before"))
    keys = _keyed(df, file, site, text).select("doc", "file").distinct().join(before, "file", "left").select("doc", "before").join(gone, "doc", "left")
    rows = _keyed(df, file, site, text).dropDuplicates(["doc"]).join(keys, "doc")  # the one shuffle of texts, both by doc
    gone_ = F.coalesce("gone", F.array().cast("array<int>"))
    lines = F.split("text", "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(1), F.size(lines)), gone_), lambda n: F.element_at(lines, n))
    return rows.select(
        F.col("file").alias(file), F.col("site").alias(site), F.when(F.col("text").isNotNull(), F.array_join(kept, "\n")).alias(text),
        (F.coalesce("before", F.lit(0)) + F.size(gone_)).cast("int").alias("lines_removed"),
    )
