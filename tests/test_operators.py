import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstream.operators import chunking, cleaning, corpus, ordered, overlap, signals, vectors


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_cooldown_counts_from_the_last_kept_row(spark):
    times = [0.0, 3.0, 9.9, 10.0, 14.0, 21.0]
    df = spark.createDataFrame([("k", float(t), i) for i, t in enumerate(times)], "k string, t double, i int").withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")))
    kept = signals.cooldown(df, ["k"], "ts", 10, "i").where("decision = 'keep'").select("t")
    assert rows(kept) == [(0.0,), (10.0,), (21.0,)]


def test_cooldown_equals_a_plain_loop_over_buckets(spark):
    pick = random.Random(4)
    data = [(pick.choice("ab"), pick.randrange(0, 40 * 86_400), i) for i in range(600)]
    df = spark.createDataFrame(data, "k string, s long, i int").withColumn("ts", F.timestamp_seconds("s"))
    want = {}
    last: dict[str, int] = {}
    for k, s, i in sorted(data, key=lambda r: (r[1], r[2])):
        keep = k not in last or s - last[k] >= 100_000
        last[k] = s if keep else last[k]
        want[i] = "keep" if keep else "suppress"
    got = {r["i"]: r["decision"] for r in signals.cooldown(df, ["k"], "ts", 100_000, "i", days=3).collect()}
    assert got == want


def test_gate_thresholds(spark):
    df = spark.createDataFrame([(1, "A", 0.69), (2, "A", 0.70), (3, "A", None)], "i int, type string, confidence double").withColumn("ts", F.timestamp_seconds(F.col("i") * 100))
    got = {r["i"]: (r["decision"], r["reason"]) for r in signals.gate(df, ["type"], "ts", "i").collect()}
    assert got == {1: ("suppress", "below_confidence_threshold"), 2: ("keep", None), 3: ("suppress", "missing_confidence")}


def test_signals_in_rule_order(spark):
    df = spark.createDataFrame([(1, "This is too expensive"), (2, "I can't pay; let me speak to someone"), (3, "nothing"), (4, None)], "i int, text string")
    found = signals.detect(df, "text").select("i", "type", "matched_keywords")
    assert rows(found, "i", "type") == [(1, "PRICE_OBJECTION", ["too expensive", "expensive"]), (2, "HUMAN_SUPPORT", ["speak to someone", "let me speak to someone"]), (2, "PAYMENT_DIFFICULTY", ["can't pay"])]
    assert [r["type"] for r in signals.detect(df, "text", strict=True).where("i = 2").collect()] == ["HUMAN_SUPPORT"]


@pytest.mark.parametrize(("values", "want"), [([1366, 1174, 1134, 1144, 3229], [(0.5, 1174.0), (0.95, 1366.0)]), ([5], [(0.5, 5.0), (0.95, 5.0)]), ([7, 7, 7, 7], [(0.5, 7.0), (0.95, 7.0)]), ([], [])])
def test_floor_percentiles(spark, values, want):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    assert rows(signals.floor_percentiles(df, "v").select("share", "value")) == want


def test_floor_percentiles_against_sorting(spark):
    pick = random.Random(2)
    data = [(g, pick.choice([pick.gauss(0, 1), 1e9, 0.0])) for g in "ab" for _ in range(301)]
    got = rows(signals.floor_percentiles(spark.createDataFrame(data, "g string, v double"), "v", (0.1, 0.5, 0.99), "g", buckets=7))
    want = [(g, s, sorted(v for x, v in data if x == g)[int(s * 300)]) for g in "ab" for s in (0.1, 0.5, 0.99)]
    assert got == want


def test_neighbours_and_last_over_buckets(spark):
    data = [("d", i, f"p{i}", f"s{i}" if i % 7 == 0 else None) for i in range(1, 60) if i % 11]
    df = spark.createDataFrame(data, "d string, n int, p string, s string")
    near = ordered.with_neighbours(df, ["d"], ["n"], "p", F.floor(F.col("n") / 10))
    got = {r["p"]: (r["before"], r["after"]) for r in near.collect()}
    names = [x[2] for x in data]
    assert got == {p: (names[i - 1] if i else None, names[i + 1] if i + 1 < len(names) else None) for i, p in enumerate(names)}
    carried = {r["p"]: r["x"] for r in ordered.with_last(df, ["d"], ["n"], {"x": F.col("s")}, F.floor(F.col("n") / 10)).collect()}
    last = None
    for _, _, p, s in data:
        assert carried[p] == last
        last = s or last


def test_sections_carry_to_later_pages(spark):
    df = spark.createDataFrame([("d", 1, "a", "h1"), ("d", 2, "b", None), ("d", 3, "c", "h3"), ("d", 4, "e", None), ("d", 5, "f", None)], "source_id string, page_number int, page_id string, section string")
    assert rows(corpus.carried_section(df, "section")) == [("a", None, None), ("b", "h1", 1), ("c", "h1", 1), ("e", "h3", 3), ("f", "h3", 3)]


def test_round_robin_takes_first_pages_first(spark):
    df = spark.createDataFrame([(s, i, f"{s}{i}") for s, n in (("a", 4), ("b", 1), ("c", 3)) for i in range(1, n + 1)], "source_id string, page_number int, page_id string")
    assert sorted(r["page_id"] for r in corpus.round_robin_sample(df, 5).collect()) == ["a1", "a2", "b1", "c1", "c2"]


def test_files_match_by_stem_then_by_id(spark):
    meta = spark.createDataFrame([("ABC-001", "One Two.pdf"), ("ABC-002", "x.pdf"), ("XYZ-7", "y.pdf")], "source_id string, filename string")
    files = spark.createDataFrame([("one  two.txt",), ("ABC 002 other.txt",), ("none.txt",), ("ABC 001 x.txt",), (None,)], "filename string")
    got = {r["file"]: (r["source"], r["matched_by"]) for r in corpus.match_files(files, meta).collect()}
    assert got == {"one  two.txt": ("ABC-001", "stem"), "ABC 002 other.txt": ("ABC-002", "id"), "none.txt": (None, "none"), "ABC 001 x.txt": ("ABC-001", "id")}


def test_metadata_differences(spark):
    pages = spark.createDataFrame([("s", "T", "771", None), ("s", "T", "771", None)], "source_id string, title string, plan_number string, uin string")
    meta = spark.createDataFrame([("s", "t2", "871", "nan")], "source_id string, title string, plan_number string, uin string")
    got = corpus.metadata_differences(pages, meta, ("title", "plan_number", "uin")).select("field", "severity")
    assert rows(got) == [("plan_number", "HIGH"), ("title", "MEDIUM")]


def paged(pages):
    return "\n".join(f"--- PAGE {i} ---\n{p}" for i, p in enumerate(pages, 1))


BODY = "\n".join(f"Line {w} of the body goes on." for w in "abcdef")


def test_banners_need_enough_pages_and_spare_the_first(spark):
    text = paged([f"Acme Mutual\n{BODY}" for _ in range(5)])
    df = spark.createDataFrame([("f", text)], "file string, text string")
    assert [(r["banner"], r["decision"]) for r in cleaning.banners(cleaning.page_lines(df)).where("banner = 'Acme Mutual'").collect()] == [("Acme Mutual", "remove")]
    gone = cleaning.removed_lines(cleaning.page_lines(df)).where("reason = 'repeated_banner'")
    assert [r["page_no"] for r in gone.orderBy("page_no").collect()] == [2, 3, 4, 5]
    few = spark.createDataFrame([("f", paged([f"Acme Mutual\n{BODY}" for _ in range(3)]))], "file string, text string")
    assert cleaning.banners(cleaning.page_lines(few)).count() == 0


def test_printed_numbers_at_one_offset(spark):
    text = paged([f"{BODY}\n{i + 2}" if i in (3, 5, 7) else f"{BODY}\nPage {i} of 10" if i == 9 else f"{BODY}\n{i + 4}" if i == 8 else BODY for i in range(1, 11)])
    found = cleaning.page_number_lines(cleaning.page_lines(spark.createDataFrame([("f", text)], "file string, text string")))
    assert rows(found.select("page_no", "decision")) == [(3, "remove"), (5, "remove"), (7, "remove"), (8, "flag"), (9, "remove")]


def test_integrity(spark):
    raw = spark.createDataFrame([("f", "abc\nHEAD"), ("g", "xyz")], "file string, text string")
    clean = spark.createDataFrame([("f", "abc"), ("g", "xy")], "file string, text string")
    removed = spark.createDataFrame([("f", "HEAD")], "file string, line string")
    assert rows(cleaning.integrity(raw, clean, removed)) == [("f", "OK"), ("g", "MISMATCH")]


WORDS = st.lists(st.sampled_from("alpha beta. gamma delta! eps zeta? eta\n theta\n\n iota".split(" ")), max_size=900)


@settings(max_examples=40, deadline=None)
@given(WORDS)
def test_chunks_keep_their_limits_and_lose_no_word(parts):
    text = " ".join(parts)
    tokens = chunking.WordTokens()
    made = chunking.chunks(text, tokens)
    assert all(n <= chunking.LIMIT and n == len(tokens.encode(c)) + chunking.SPECIAL for c, n in made)
    assert bool(made) == bool(text.strip())
    left = tokens.encode(text)
    at = 0
    for c, _ in made:  # every chunk begins inside, or right after, what has been seen, and goes on from there
        own = tokens.encode(c)
        start = next(k for k in range(max(0, at - len(own)), at + 1) if left[k : k + len(own)] == own)
        at = max(at, start + len(own))
    assert at == len(left)


def test_containment_against_all_pairs(spark):
    pick = random.Random(8)
    base = [" ".join(pick.choices("a b c d e f g h".split(), k=30)) for _ in range(6)]
    docs = [(i, pick.choice(base) + " " + " ".join(pick.choices("x y z".split(), k=pick.randrange(0, 6)))) for i in range(40)] + [(90, base[0]), (91, base[0].upper()), (92, ""), (93, None)]
    df = spark.createDataFrame(docs, "i int, t string")
    got = {(r["small"], r["large"]) for r in overlap.containment_pairs(df, "i", "t").collect()}
    texts: dict[str, int] = {}
    for i, t in docs:
        plain = " ".join((t or "").lower().split())
        if plain:
            texts[plain] = min(i, texts.get(plain, i))
    marks = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for t, i in texts.items()}
    want = set()
    for a in marks:
        for b in marks:
            small, large = sorted((a, b), key=lambda x: (len(marks[x]), x))
            if a < b and len(marks[a] & marks[b]) >= 0.8 * len(marks[small]) - 1e-9:
                want.add((small, large))
    assert got == want
    classes = {r["i"]: r["class_id"] for r in overlap.near_duplicate_classes(df, "i", "t").collect()}
    assert classes[90] == classes[91] and 92 not in classes and 93 not in classes
    assert all(classes[a] == classes[b] for a, b in want)


def test_containment_broadcasts_no_shingles(spark):
    """Spark takes an array for one value, so by its estimates the shingles of all texts would go through the driver."""
    df = spark.range(40).selectExpr("id AS i", "concat_ws(' ', transform(sequence(1, 300), k -> hash(k, id div 2))) AS t")
    pairs = overlap.containment_pairs(df.withColumn("t", F.concat("t", F.lit(" "), F.col("i").cast("string"))), "i", "t")
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.count() == 20


def test_components_read_their_links_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    links = spark.range(30).selectExpr("id AS small", "id + 1 AS large").where("small % 10 < 9").mapInArrow(counted, "small long, large long")
    label = {r["node"]: r["label"] for r in overlap.linked_components(links).collect()}
    assert label == {i: i // 10 * 10 for i in range(30)}
    assert seen.value == 27


def test_index_finds_nine_in_ten(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    q = e.where("vec_id % 50 = 0")
    exact = vectors.top_k(e, q)
    centres = vectors.inverted_file(e)
    index = vectors.assign_cells(e, centres)
    found = vectors.indexed_top_k(index, q, centres, probes=vectors.tuned_probes(e, index, centres))
    assert vectors.recall(found, exact).first()["recall"] >= 0.9


def test_top_k_blocks_and_ties(spark, monkeypatch):
    e = spark.createDataFrame([(i, [1.0, float(i % 3)]) for i in range(12)] + [(99, [])], "vec_id long, embedding array<double>")
    whole = rows(vectors.top_k(e, e, k=3))
    monkeypatch.setattr(vectors, "BLOCK", 4)
    assert rows(vectors.top_k(e, e, k=3)) == whole
    assert [h for q, r, h, s in whole if q == 0] == [0, 3, 6]
    with pytest.raises(ValueError):
        vectors.top_k(e, e, k=0)


def test_extraction_health(spark):
    from quillstream.operators import health

    page = "A page of text that is long enough. " * 20
    data = [("ok", paged([page, page])), ("gap", f"--- PAGE 1 ---\n{page}\n--- PAGE 3 ---\n{page}"), ("thin", paged(["x"])), ("empty", paged([page * 2, "", page])), ("bad", paged([page + "�" * 60])), ("null", None), ("", "")]
    df = spark.createDataFrame(data + data[:1], "file string, text string")
    got = {r["file"]: r["status"] for r in health.extraction_health(df).collect()}
    assert got == {"ok": "OK", "gap": "REVIEW", "thin": "NEEDS_OCR", "empty": "CHECK", "bad": "REVIEW", "": "NEEDS_OCR"}


def test_codes_against_metadata(spark):
    from quillstream.operators import health

    pages = spark.createDataFrame([("a", "Plan No. 123 x Plan No. 456"), ("b", "UIN 512N123V01"), ("c", "none"), ("d", "Plan No. 123"), (None, "Plan No. 1")], "source_id string, text string")
    meta = spark.createDataFrame([("a", "123", None), ("b", None, "512N123V02"), ("c", "9", "nan"), ("e", "1", None)], "source_id string, plan_number string, uin string")
    got = {(r["source_id"], r["field"]): r["issue"] for r in health.code_checks(pages, meta).collect()}
    assert got == {("a", "plan_number"): "other_values_in_text", ("b", "uin"): "conflict", ("c", "plan_number"): "not_found_in_text"}
