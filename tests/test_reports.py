"""Checks over whole documents, page records, chunks and reports, on cases written by hand."""

from quillstream.operators import assembly, corpus, health, reports, vectors


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


META = "source_id string, filename string, title string, plan_number string, uin string"


def test_differences_between_pages_and_metadata(spark):
    pages = spark.createDataFrame([("A", "T", "101", None), ("A", "T", "102", None), ("B", None, "", "u"), ("C", "same", "1", "u"), (None, "x", "1", "u")], "source_id string, title string, plan_number string, uin string")
    meta = spark.createDataFrame([("A", "a", "T", "101", None), ("B", "b", "null", "7", "w"), ("C", "c", "same", "1", "u")], META)
    got = rows(corpus.metadata_differences(pages, meta, ("title", "plan_number", "uin")).select("source_id", "field", "page_value", "metadata_value", "issue", "severity"))
    assert got == [
        ("A", "plan_number", "102", "101", "page_records_differ_from_metadata", "HIGH"),
        ("B", "plan_number", None, "7", "metadata_completeness_difference", "MEDIUM"),
        ("B", "uin", "u", "w", "page_records_differ_from_metadata", "HIGH"),
    ]


def test_gaps_and_sequence(spark):
    pages = spark.createDataFrame([("A", 1), ("A", 2), ("A", 5), ("A", 5), ("B", 1), ("B", 2), ("C", 3), (None, 2), ("D", None)], "source_id string, page_number int")
    assert rows(corpus.missing_pages(pages.where("source_id is not null"))) == [("A", 3, 4), ("C", 1, 2)]
    assert rows(health.out_of_sequence(pages.where("source_id is not null"))) == [("A", 3, 5), ("C", 1, 3)]
    assert rows(corpus.missing_pages(pages.limit(0))) == []


def test_repeated_pages(spark):
    long = "The branch keeps a copy of the form. " * 10
    pages = spark.createDataFrame([("A", "p1", long), ("A", "p2", long + " "), ("A", "p3", "short"), ("A", "p4", "short"), ("B", "p5", long), ("A", "p1", long)], "source_id string, page_id string, text string")
    assert rows(health.repeated_pages(pages)) == [("A", "p1", 2)]


def test_every_extraction_status(spark):
    page = "the branch keeps a copy of the form with the papers " * 12
    texts = {
        "ok": f"--- PAGE 1 ---\n{page}\n--- PAGE 2 ---\n{page}", "gap": f"--- PAGE 1 ---\n{page}\n--- PAGE 3 ---\n{page}", "few": "--- PAGE 1 ---\nhardly any",
        "empty": f"--- PAGE 1 ---\n{page}{page}\n--- PAGE 2 ---\n", "broken": f"--- PAGE 1 ---\n{page}" + "�" * 40, "accents": f"--- PAGE 1 ---\n{page}" + "é" * 60, "null": None,
    }
    df = spark.createDataFrame(list(texts.items()), "file string, text string")
    got = {r["file"]: r["status"] for r in health.extraction_health(df).collect()}
    assert got == {"ok": "OK", "gap": "REVIEW", "few": "NEEDS_OCR", "empty": "CHECK", "broken": "REVIEW", "accents": "CHECK"}


def test_issues_reach_their_pages(spark):
    pages = spark.createDataFrame([("A", "a1", "T", None, None), ("A", "a2", "U", None, None), ("X", "x1", None, None, None), ("X", "x1", None, None, None), (None, "n1", None, None, None)], "source_id string, page_id string, title string, plan_number string, uin string")
    meta = spark.createDataFrame([("A", "a", "T", None, None)], META)
    issues = reports.page_issues(pages, meta, ("title", "plan_number"))
    listed = rows(reports.with_issues(pages.select("page_id").distinct(), issues))
    differ = "page_records_differ_from_metadata:title"
    assert listed == [("a1", [differ]), ("a2", [differ]), ("n1", []), ("x1", ["duplicate_page_id", "metadata_row_missing"])]
    assert rows(reports.examples(issues, "issue", "source_id", "page_id", most=1)) == [("duplicate_page_id", 1, 1, ["x1"]), ("metadata_row_missing", 1, 1, ["x1"]), (differ, 2, 1, ["a1"])]


def test_lists_in_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in reports.ranked_counts(df, "v").collect()][0] == (1, "b", 2)
    pages = spark.createDataFrame([("none_detected", 1), ("possible_pii", 2), ("odd", 3), (None, 4)], "pii_status string, n int")
    assert [r["n"] for r in reports.by_status(pages).collect()][:2] == [2, 1]
    assert rows(reports.first_rows(df, ["v"], [df["v"]], 1).groupBy().count()) == [(4,)]


RAW = "\n".join((
    "lost words", "--- PAGE 1 ---", "Grace Period", "A premium may be paid late by thirty days after it falls due.", "", "--- page 2 ---", "", "The Second Branch Office", "More of the same words stand here, on and on.",
    "--- PAGE 3 ---", "", "--- PAGE 3 ---", "1. Claims:", "Step 1 write", "Step 2 wait", "Step 3 ask again",
))


def test_page_records_from_raw_text(spark):
    raw = spark.createDataFrame([("SCN 7 plan.txt", RAW), ("SCN 7 plan.txt", RAW), ("other.txt", "--- PAGE 1 ---\nx"), ("none.txt", None), ("plain.txt", "no marker")], "file string, text string")
    meta = spark.createDataFrame([("SCN-7", "elsewhere.pdf", True, "The Plan", "Board", "guide", None, "101", None, None, None, "English", "active")], "source_id string, filename string, file_exists boolean, title string, authority string, document_type string, product string, plan_number string, uin string, version string, effective_date string, language string, status string")
    got = {(r["file"], r["page_id"], r["text_hash"]): r for r in assembly.page_records(raw, meta).collect()}
    found = sorted(got.values(), key=lambda r: (r["file"], r["page_number"], r["char_count"]))
    assert [(r["page_id"], r["section"], r["section_at_page_start"]) for r in found] == [
        ("SCN-7-p1", "Grace Period", None), ("SCN-7-p2", None, "Grace Period"), ("SCN-7-p3", None, "Grace Period"), ("SCN-7-p3", "Claims", "Grace Period"), ("other-p1", None, None),
    ]
    first, second, empty, last, other = found
    assert first["title"] == "The Plan" and first["citation"] == "The Plan, p. 1" and first["topics"] == ["grace_period"] and first["next_page_id"] == "SCN-7-p2" and first["previous_page_id"] is None
    assert second["candidate_headings"] == ["The Second Branch Office"] and second["word_count"] == 14
    assert "empty_page" in empty["review_reasons"] and "duplicate_page_number" in empty["review_reasons"] and empty["review_required"]
    assert last["content_type"] == "procedure" and other["title"] is None and "doc_metadata_missing:title" in other["review_reasons"]
    assert assembly.page_records(raw.limit(0), meta).count() == 0


def test_chunks_of_both_sources_once(spark):
    pages = spark.createDataFrame([("p1", "one two three four five six seven"), ("p2", "eight nine"), ("p2", "eight nine"), ("p3", None), ("p4", " ")], "page_id string, text string")
    web = spark.createDataFrame([("w1", "eight nine"), ("w2", "ten  eleven")], "text_file string, text string")
    got = rows(assembly.chunk_corpus(pages, web, size=4, stride=3).select("source_type", "parent", "chunk_index", "words"))
    assert got == [("pdf", "p1", 0, 4), ("pdf", "p1", 1, 4), ("pdf", "p2", 0, 2), ("web", "w2", 0, 2)]


def test_report_of_a_cleaning_run(spark):
    body = lambda i: "\n".join(f"line {w * i} of the page" for w in "abcdef")
    text = "\n".join(f"--- PAGE {i} ---\nAcme Life\n{body(i)}\n\n\n\n{i + 2}" for i in range(1, 7))
    df = spark.createDataFrame([("f", text), ("e", ""), ("n", None)], "file string, text string")
    got = {r["file"]: r for r in assembly.cleaning_report(df).collect()}
    f = got["f"]
    assert (f["pages"], f["lines_removed"], f["page_number_offset_bottom"], f["integrity_check"]) == (6, 11, 2, "OK") and f["blank_lines_removed"] > 0
    assert got["e"]["integrity_check"] == "OK" and "n" not in got


def test_requests_and_evaluation_rows(spark):
    asked = spark.createDataFrame([(1, " hello ", None), (2, "  ", 3), (3, "x", 11), (4, None, 1), (5, "y", 10)], "i int, query string, top_k int")
    got = {r["i"]: (r["query"], r["top_k"], r["problem"]) for r in vectors.checked_requests(asked).collect()}
    assert got == {1: ("hello", 5, None), 2: ("", 3, "empty_query"), 3: ("x", 11, "top_k_out_of_range"), 4: ("", 1, "empty_query"), 5: ("y", 10, None)}
    e = spark.createDataFrame([(1, [1.0, 0.0], 7), (2, [0.9, 0.1], 8), (3, [0.0, 1.0], 7)], "vec_id long, embedding array<double>, label int")
    found = rows(vectors.evaluation_rows(vectors.top_k(e, e.where("vec_id = 1"), 2), e, e).select("rank", "hit", "category", "expected", "right"))
    assert found == [(1, 1, 7, 7, True), (2, 2, 8, 7, False)]
