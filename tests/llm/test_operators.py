"""Each operator on cases written by hand: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstream.llm import boilerplate, languages, leakage, mixing, repeated_lines, residue, scanned, splitting


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# 1 main content ------------------------------------------------------------------------------------------------------

WORDS = "the insurer shall keep a copy of the claim form with the policy papers until the branch has told the nominee in writing".split()


def site(n=40, host="www.a.example"):
    pick = random.Random(3)
    texts, manifest = [], []
    for i in range(n):
        topic = ["Grace period", "Death claims", "Riders", "Nomination"][i % 4]
        prose = [" ".join(pick.choices(WORDS, k=18)).capitalize() + "." for _ in range(3)]
        lines = ["Home", "Login", "Products | Claims | Search", topic, prose[0], "", prose[1], "Share this page", prose[2], "See also", "Riders", "Nomination", "Copyright 2024 A Life. All rights reserved."]
        texts.append((f"f{i}.txt", "\n".join(lines)))
        manifest.append((f"f{i}.txt", f"https://{host}/p/{i}", topic))
    return texts, manifest


def pages(spark, texts, manifest):
    t = spark.createDataFrame([(*x, "clash") for x in texts], "text_file string, text string, host string")
    m = spark.createDataFrame([(*x, "other") for x in manifest], "text_file string, url string, title string, text string")
    return t, m


def test_furniture_is_what_the_site_repeats(spark):
    texts, manifest = site()
    texts += [texts[0], (None, "x"), ("null.txt", None), ("empty.txt", ""), ("menu.txt", "Home\nLogin\nShare this page")]
    t, m = pages(spark, texts, [*manifest, manifest[0], (None, None, None)])
    got = {}
    for f, n in rows(boilerplate.furniture_lines(t, m)):
        got.setdefault(f, []).append(n)
    assert all(got[f"f{i}.txt"] == [1, 2, 3, 8, 10, 11, 12, 13] for i in range(40))
    assert got["menu.txt"] == [1, 2, 3] and "null.txt" not in got and "empty.txt" not in got
    main = dict(rows(boilerplate.main_texts(t, m)))
    assert main["f0.txt"].startswith("Grace period\n") and "Share" not in main["f0.txt"] and main["menu.txt"] == ""


def test_long_notices_on_every_page(spark):
    texts, manifest = site()
    notice = "We use cookies to " + " ".join(WORDS * 4) + " and you may change your choice at any time by the link at the foot of the page."
    assert len(notice) > boilerplate.LONG
    t, m = pages(spark, [(f, f"{notice}\n{x}") for f, x in texts], manifest)
    got = {(f, n) for f, n in rows(boilerplate.furniture_lines(t, m))}
    assert all((f, 1) in got for f, _ in texts) and not any((f, 6) in got for f, _ in texts)


def test_density_decides_labels(monkeypatch):
    kinds = boilerplate.Kinds([("home", "link", False), ("riders", "label", False), ("nomination", "label", False), ("see also", "link", False)])
    prose = " ".join(WORDS * 3) + "."
    text = f"Home\nRiders\n{prose}\n{prose}\nHome\nNomination\nSee also\nHome\nHome\nHome"
    assert [n for n, main in boilerplate.content_lines(text, "", kinds) if main] == [2, 3, 4]
    monkeypatch.setitem(boilerplate.WEIGHTS, "open", 0.0)  # a lone label without link weight is as dense as prose
    assert 6 in [n for n, main in boilerplate.content_lines(text, "", kinds) if main]


def test_hosts_keep_their_types_apart(spark):
    (a, ma), (b, mb) = site(30), site(30, "b.example")
    b = [(f"b{f}", x.replace("Home", "Start").replace("See also", "More")) for f, x in b]
    t, m = pages(spark, a + b, ma + [(f"b{f}", u, x) for f, u, x in mb])
    kinds = boilerplate.learn(boilerplate._pages(t, m))
    assert {r["host"] for r in kinds.where("type = 'start'").collect()} == {"b.example"} and {r["host"] for r in kinds.where("type = 'home'").collect()} == {"www.a.example"}
    got = {(f, n) for f, n in rows(boilerplate.furniture_lines(t, m))}
    assert {(f, 1) for f, _ in a + b} <= got


def test_no_pages(spark):
    t, m = pages(spark, [], [])
    assert rows(boilerplate.furniture_lines(t, m)) == []


def test_density_of_links_is_nothing():
    assert boilerplate.density(100, 10, 100, 10, 1000, 500) == pytest.approx(0)
    assert boilerplate.density(200, 1, 0, 0, 1000, 500) > boilerplate.density(40, 4, 0, 0, 1000, 500) > 0
    assert boilerplate.density(0, 1, 0, 0, 10, 10) == 0


# 2 languages ---------------------------------------------------------------------------------------------------------


def labelled(spark, folder="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{folder}/page_records.parquet").select("page_id", "text", "language")


def test_languages_agree_with_nearly_all_labels(spark):
    df = labelled(spark)
    model = languages.fit_on(df)
    got = {r["page_id"]: r["lang"] for r in languages.assign_languages(df, model).where("line_no = 0").collect()}
    said = {r["page_id"]: r["x"] for r in df.select("page_id", languages.named_language(df["language"]).alias("x")).collect() if r["x"]}
    both = [(got[p], x) for p, x in said.items() if p in got]
    assert sum(a == b for a, b in both) > 0.85 * len(both)  # about a tenth of the labels are wrong


def test_runs_of_a_mixed_page(spark):
    df = labelled(spark)
    english = "The nominee shall keep a copy of the policy with the papers of the branch."
    hindi = "दावेदार को निर्णय की सूचना लिखित रूप में भेजी जाती है।"
    made = [
        ("m", f"{english}\n\n12 34\n{hindi}\n{hindi}\n\n{english}", " English "), ("e", f"{english}\n{english}", " EN "), ("w", english, "Hindi"), ("u", english, "und"),
        ("n", english, None), ("s", "short text", None), ("z", "", None), ("0", None, None), ("l", f"{english}\n" * 3000, "eng"), (None, english, "xx"),
    ]
    model = languages.fit_on(df)
    extra = spark.createDataFrame([(*r, 1) for r in made], "page_id string, text string, language string, line_no int")
    got = {(r["page_id"], r["line_no"]): r["lang"] for r in languages.assign_languages(extra, model).collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == "m"} == {0: "Mixed", 1: "English", 4: "Hindi", 7: "English"}
    assert got[("l", 0)] == "English" and not {("s", 0), ("z", 0), ("0", 0)} & set(got)
    case = {(r["page_id"], r["line_no"]) for r in languages.wrong_labels(df.unionByName(extra.drop("line_no"))).collect()}
    assert {("m", 0), ("m", 4), ("w", 0), ("u", 0), ("n", 0), (None, 0)} <= case
    assert not {("e", 0), ("l", 0), ("s", 0)} & case


FOREIGN = {
    "tamil": "காப்பீட்டு நிறுவனம் முடிவை எழுத்துப்பூர்வமாக தெரிவிக்க வேண்டும். முப்பது நாட்களுக்குள் பதில் அளிக்க வேண்டும்.",
    "russian": "Страховщик обязан уведомить застрахованное лицо в письменной форме о принятом решении в течение тридцати дней.",
    "chinese": "保险公司应当在三十日内以书面形式通知被保险人有关决定。被保险人应当及时提供证明材料。",
    "french": "Le contrat d'assurance prévoit que le bénéficiaire doit informer la compagnie dans un délai de trente jours à compter de la date du décès de l'assuré.",
    "letters": "qzv wxkjq vbnzr tplkj mnbvc xzlkq wrtpg hjklz vcxbn qwrtz plkmn jhgfd",
    "gothic": "𐌰𐍄𐍄𐌰 𐌿𐌽𐍃𐌰𐍂 𐌸𐌿 𐌹𐌽 𐌷𐌹𐌼𐌹𐌽𐌰𐌼 𐍅𐌴𐌹𐌷𐌽𐌰𐌹 𐌽𐌰𐌼𐍉 𐌸𐌴𐌹𐌽",
}


def test_other_languages_are_rejected(spark):
    df = labelled(spark)
    english = "The nominee shall keep a copy of the policy with the papers of the branch."
    made = [(k, v) for k, v in FOREIGN.items()] + [("part", f"{english}\n{FOREIGN['russian']}\n{FOREIGN['russian']}\n{english}")]
    extra = spark.createDataFrame(made, "page_id string, text string")
    got = {(r["page_id"], r["line_no"]): r["lang"] for r in languages.assign_languages(extra, languages.fit_on(df)).collect()}
    assert all(got[(k, 0)] == "Unknown" for k in FOREIGN)
    assert {k[1]: v for k, v in got.items() if k[0] == "part"} == {0: "English", 1: "English", 2: "Unknown", 4: "English"}


def test_languages_come_from_the_labels(spark):
    texts = {"ru": FOREIGN["russian"], "ta": FOREIGN["tamil"]}
    df = spark.createDataFrame([(f"{k}{i}", v, k) for k, v in texts.items() for i in range(5)], "page_id string, text string, language string")
    model = languages.fit_on(df, labels={"ru": "Russian", "ta": "Tamil"})
    assert {(r["page_id"][:2], r["lang"]) for r in languages.assign_languages(df, model).collect()} == {("ru", "Russian"), ("ta", "Tamil")}


def test_no_labelled_rows(spark):
    df = spark.createDataFrame([], "page_id string, text string, language string")
    assert rows(languages.wrong_labels(df)) == []


# 3 repeated lines ----------------------------------------------------------------------------------------------------


def plain_repeated(data, share=0.2, least=5):
    import regex

    files, seen, docs = {}, {}, set(data)
    key = lambda x: regex.sub(r"[^\p{L}\p{M}]", "", x.lower())
    for s, f, t in docs:
        if s is not None and f is not None and t is not None:
            files.setdefault(s, set()).add(f)
            for x in t.split("\n"):
                if regex.search(r"\p{L}", key(x)):
                    seen.setdefault((s, key(x)), set()).add(f)
    return sorted((s, f, n) for s, f, t in docs if s is not None and f is not None and t is not None for n, x in enumerate(t.split("\n"), 1) if len(seen.get((s, key(x)), ())) >= max(least, share * len(files[s])))


def test_repeated_lines_against_counting(spark):
    pick = random.Random(6)
    pool = ["Share this!", "share THIS", "All rights reserved 2024", "Page 1", "***", "", "नमस्ते", "Ünïcode"] + [f"own {w}" for w in "abcdefgh"]
    data = [(pick.choice(["s1", "s1", "s1", "s2", "s3"]), f"f{i}", "\n".join(pick.choices(pool, k=pick.randrange(0, 9)))) for i in range(90)]
    data += data[:9] + [(None, "n", "Share this!"), ("s1", None, "x"), ("s1", "nulltext", None), ("s1", "long", "\n".join(["Share this!"] * 4000))]
    df = spark.createDataFrame([(*r, 0) for r in data], "site string, source_file string, text string, block int")
    assert rows(repeated_lines.repeated_lines(df)) == plain_repeated(data)


def test_blocks_are_found_over_several_lines(spark):
    block = "By the desk\nAll rights reserved\n\n12\nPrint this page"
    data = [("s", f"f{i}", f"own {chr(97 + i)}\n{block}\nend {chr(97 + i)}") for i in range(8)] + [("s", "g", "Print this page\nx"), ("s", "g", "other\nBy the desk")]
    df = spark.createDataFrame(data, "site string, source_file string, text string")
    found = repeated_lines.spanning_blocks(df).where("file = 'f0'").select("line_no", "end_line", "n_lines", "documents")
    assert rows(found) == [(2, 2, 1, 9), (2, 3, 2, 8), (3, 3, 1, 8), (3, 6, 2, 8), (6, 6, 1, 9)]
    lines = repeated_lines.block_lines(df).where("file in ('f0', 'g')").select("file", "line_no", "block_lines", "documents")
    assert rows(lines) == [("f0", 2, 2, 8), ("f0", 3, 2, 8), ("f0", 6, 2, 8), ("g", 1, 1, 9), ("g", 2, 1, 9)]
    several = repeated_lines.block_lines(df, min_lines=2).where("file in ('f0', 'g')").select("file", "line_no")
    assert rows(several) == [("f0", 2), ("f0", 3), ("f0", 6)]


def test_blocks_of_any_length(spark):
    block = "\n".join(f"legal {chr(97 + k)}" for k in range(11))
    df = spark.createDataFrame([("s", f"f{i}", f"own {chr(97 + i)}\n{block}") for i in range(6)], "site string, source_file string, text string")
    assert rows(repeated_lines.spanning_blocks(df).groupBy("n_lines").count()) == [(1, 66), (2, 60), (4, 48), (8, 24)]
    assert {r["block_lines"] for r in repeated_lines.block_lines(df).collect()} == {8}


def test_texts_of_one_file_stay_apart_and_count_as_one_file(spark):
    data = [("s", f"f{i}", f"own {chr(97 + i)}\nFooter") for i in range(5)] + [("s", "f0", "Footer\nlast words\nof f")] + [("s", "g", f"Seen in one file only\n{w}") for w in ("a", "b", "c", "d", "e", "f")]
    df = spark.createDataFrame(data, "site string, source_file string, text string")
    summary = spark.createDataFrame([("f0", 2)], "source_file string, lines_removed int")
    got = rows(repeated_lines.remove_repeated_lines(df, summary).where("source_file in ('f0', 'g')").select("source_file", "text", "lines_removed"))
    assert got == [("f0", "last words\nof f", 3), ("f0", "own a", 3)] + [("g", f"Seen in one file only\n{w}", 0) for w in "abcdef"]


def test_removal_raises_the_summary(spark):
    data = [(f"f{i}", "s", f"Footer line\nown {chr(97 + i)}" if i else "Footer line") for i in range(6)] + [("g", None, "Footer line"), ("h", "s2", None)]
    df = spark.createDataFrame(data + data[:1], "source_file string, site string, text string")
    summary = spark.createDataFrame([("f0", 3), ("f0", 3), ("f1", None)], "source_file string, lines_removed int")
    got = {r["source_file"]: (r["text"], r["lines_removed"]) for r in repeated_lines.remove_repeated_lines(df, summary).collect()}
    assert got["f0"] == ("", 4) and got["f1"] == ("own b", 1) and got["f2"] == ("own c", 1) and got["g"] == ("Footer line", 0) and got["h"] == (None, 0)


def test_no_files(spark):
    assert rows(repeated_lines.repeated_lines(spark.createDataFrame([], "site string, source_file string, text string"))) == []


# 4 scanned pages -----------------------------------------------------------------------------------------------------


def scans(n=30):
    pick = random.Random(9)
    words = "policy premium nominee branch certificate assured trustee annuity surrender maturity instalment guardian".split()
    out = []
    for i in range(n):
        parts = ["--- PAGE 1 ---", "Acme Life", f"Title Number {chr(97 + i % 26)}", "Edition of May"]
        for p in (2, 3, 4):
            body = [" ".join(pick.choices(words, k=8)) for _ in range(8)]
            if i == 0 and p == 2:
                body[2] += " certifi-"
                body[3] = "cate " + body[3]
                body[5] += " p0licy"
                body[7] += " trus-"
            if i == 0 and p == 3:
                body[0] = "tee " + body[0]
            parts += [f"--- PAGE {p} ---", "ACME LIFE MUTUAL", *body, f"Page {p} of 4"]
        out.append((f"SCN {i:04d} file {i}.txt", "\n".join(parts)))
    return out


def test_scanned_texts_are_worked_on_in_small_parts():
    """A batch of 10,000 texts as words, or of 10,000 words as candidates, would fill a worker's memory."""
    texts = [None, "", *("Some words of a page\n" * 20_000 for _ in range(6)), "last"]
    batch = pa.RecordBatch.from_pydict({"file": pa.array([f"f{k}" for k in range(len(texts))]), "text": pa.array(texts, pa.string())})
    assert [x for part in scanned._parts(iter([batch])) for x in part.column("text").to_pylist()] == texts
    assert max(part.num_rows for part in scanned._parts(iter([batch.slice(2, 6)]))) == 2
    lines = list(scanned._lines(iter([batch.slice(2)])))
    assert sum(x.num_rows for x in lines) == 6 * 20_000 + 1 and max(x.num_rows for x in lines) <= 40_001
    words = pa.RecordBatch.from_pydict({"word": pa.array(["abcdefghij" * 20 + f"k{'x' * k}" for k in range(100)]), "n": pa.array([1] * 100, pa.int64())})
    found = list(scanned._candidates(iter([words])))
    assert len(found) > 3 and max(x.nbytes for x in found) < 4 * scanned.PART
    assert sum(x.column("kind").to_pylist().count("any") for x in found) == sum(201 + k for k in range(100))


def test_scan_noise(spark):
    data = scans()
    df = spark.createDataFrame([(*r, "k") for r in [*data, data[0], (None, "--- PAGE 1 ---\nx"), ("none.txt", None), ("empty.txt", "")]], "file string, text string, kind string")
    found = [r for r in rows(scanned.scan_noise(df).where("file is not null"))]
    first = [(n, k) for f, n, k in found if f == data[0][0]]
    assert first == [(6, "header"), (9, "hyphen"), (12, "misread"), (14, "hyphen"), (15, "page_number"), (17, "header"), (26, "page_number"), (28, "header"), (37, "page_number")]
    assert all(k in ("header", "page_number") for f, n, k in found if f != data[0][0])
    text = dict(rows(scanned.repair_scans(df.where("file is not null"))))[data[0][0]]
    assert "certificate" in text and "certifi-" not in text and "p0licy" not in text and "ACME LIFE" not in text and "Page 2" not in text and "trustee" in text


def test_texts_of_one_file_are_repaired_each(spark):
    data = scans(6)
    other = "\n".join(f"--- PAGE {p} ---\n" + "\n".join(f"policy premium nominee branch certificate {w}" for w in ("assured", "trustee", "annuity", "surrender", "maturity", "policy", "branch")) for p in (1, 2, 3))
    df = spark.createDataFrame([*data, (data[0][0], other)], "file string, text string")
    got = [t for f, t in rows(scanned.repair_scans(df)) if f == data[0][0]]
    assert len(got) == 2 and sum(t.count("certificate surrender") == 3 and t.count("policy premium") == 21 for t in got) == 1


def test_long_files_take_their_pages_one_by_one():
    import time

    body = "\n".join(f"This is line {w} of it." for w in "abcdef")
    chapters = [f"Of {w} and other matters" for w in ("storms", "ladders", "beehives", "quarries", "harbours")]
    text = "\n".join(f"--- PAGE {i} ---\n{chapters[i // 40 % 5]}\n{body.replace('line', f'line {i * 7919 % 1000}')}\n{i - 8 if i > 9 else 'i' * (i % 4)}" for i in range(1, 401))
    begun = time.time()
    found = [k for _, _, k, x in scanned.layout(text) if x in chapters]
    assert found == ["header"] * 400 and time.time() - begun < 20
    numbers = [k for _, p, k, x in scanned.layout(text) if x.isdigit()]
    assert set(numbers) == {"page_number"}


def test_no_scans(spark):
    assert rows(scanned.scan_noise(spark.createDataFrame([], "file string, text string"))) == []


def test_page_numbers_by_offset():
    body = "\n".join(f"This is line {w} of it." for w in "abcdef")
    text = "\n".join(f"--- PAGE {i} ---\n{body}\n{v}" for i, v in ((1, "iv"), (2, "v"), (3, "vi"), (4, "99")))
    assert [k for _, _, k, x in scanned.layout(text) if x in ("iv", "v", "vi")] == ["page_number"] * 3
    assert [k for _, _, k, x in scanned.layout(text) if x == "99"] != ["page_number"]


# 5 splitting ---------------------------------------------------------------------------------------------------------

TEXTS = st.text(alphabet="ab .!?\n\t।é", max_size=600)


def plain_kind(text, limit):
    import re

    paragraphs = [p for p in re.split(r"(?:^|\n)[ \t]*(?:\n[ \t]*)*(?:\n|\Z)", text)]
    pieces = [("paragraph", paragraphs), ("line", text.split("\n")), ("sentence", [s for x in text.split("\n") for s in re.split(r"(?<=[.!?।])\s+", x)]), ("word", text.split())]
    return next((k for k, parts in pieces if all(len(p) <= limit for p in parts)), "none")


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.sampled_from([(20, 5), (40, 0), (7, 6)]))
def test_cuts_against_a_plain_loop(text, sizes):
    limit, overlap = sizes
    found = splitting.units(text, limit, limit - overlap)
    assert all(b - a <= limit for a, b, _ in found)
    assert "".join(text[a:b] for a, b, _ in found).replace(" ", "").replace("\n", "").replace("\t", "") == "".join(text.split())
    if not found:
        return
    spans = np.array(found)
    first, after = splitting.greedy_cuts(spans[:, 0], spans[:, 1], np.zeros(len(found), np.int64), limit, overlap)
    i, want = 0, []
    while i < len(found):
        back = found[i - 1][1] if i else found[0][0]
        j = max((k for k in range(i + 1, len(found) + 1) if found[k - 1][1] - back + (overlap if i else 0) <= limit), default=i)
        if j == i:
            j = max(k for k in range(i + 1, len(found) + 1) if found[k - 1][1] - found[i][0] <= limit)
        want.append((i, j))
        i = j
    assert list(zip(first.tolist(), after.tolist(), strict=True)) == want


def test_pieces_and_boundaries(spark):
    texts = {
        "whole": "x" * 1200, "paragraph": "p" * 700 + "\n \t\n" + "q" * 700, "line": "l" * 900 + "\n" + "m" * 900, "sentence": ("s" * 500 + ". ") * 3,
        "word": ("w" * 300 + " ") * 6, "none": "n" * 5000, "empty": "", "blank": " " * 1300,
    }
    df = spark.createDataFrame([(k, t, 0) for k, t in texts.items()] + [("null", None, 0), ("word", texts["word"], 0)], "page_id string, text string, start int")
    kinds = dict(rows(splitting.boundary_kinds(df)))
    assert kinds == {k: k for k in ("paragraph", "line", "sentence", "word", "none")}
    for key, text in texts.items():
        pieces = sorted({(r["piece_no"], r["start"], r["end"], r["new_from"], r["text"]) for r in splitting.split_texts(df).where(f"page_id = '{key}'").collect()})
        assert all(len(t) <= 1200 and t == text[a:b] and a <= new for _, a, b, new, t in pieces)
        assert all(0 <= pieces[k][2] - pieces[k + 1][1] <= 150 or pieces[k + 1][1] == pieces[k + 1][3] for k in range(len(pieces) - 1))
        assert "".join(text[new:b] for _, _, b, new, _ in pieces).replace(" ", "") == "".join(text.split()) or len(text) <= 1200
    assert [r["text"] for r in splitting.split_texts(df).where("page_id = 'empty'").collect()] == [""]
    with pytest.raises(ValueError):
        splitting.split_texts(df, limit=100, overlap=100)


# 6 leakage -----------------------------------------------------------------------------------------------------------

PASSAGE = "In 1987 a potter called Vemor signed up for a plan at Luthen; both sisters stood by. Then Vemor lost a ladder in the great flood of the river. It took nine letters before the court sent the whole matter back for want of any proof."


def test_leaks_whole_partly_and_disguised(spark):
    w = PASSAGE.split()
    sentences = PASSAGE.split(". ")
    filler = "The branch shall keep a copy of every form with the papers. " * 5
    docs = {
        1: filler + PASSAGE + filler, 2: filler + " ".join(w[: int(len(w) * 0.6)]) + ". " + filler, 3: filler + " ".join(w[:10]) + filler, 4: PASSAGE.upper().replace(" ", "\n"),
        5: " ".join("certain" if i % 8 == 5 else x for i, x in enumerate(w)), 6: sentences[2] + " " + sentences[0] + ". " + sentences[1] + ".",
        7: f'> "{PASSAGE.replace("a ", "a &quot;")}"'.replace(" Then", "\\nThen"), 8: filler.join(sentences[0].split()), 9: "", 11: PASSAGE + " " + filler * 500,
    }
    df = spark.createDataFrame([(k, t, 5) for k, t in docs.items()] + [(10, None, 5), (1, docs[1], 5)], "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(7, PASSAGE), (7, PASSAGE), (8, ""), (9, None), (10, "two words")], "item_id long, passage string")
    found = leakage.leaked_passages(df, items)
    assert [r[:2] for r in rows(found)] == [(k, 7) for k in (1, 2, 4, 5, 6, 7, 11)]
    assert {r["doc_id"] for r in leakage.drop_leaked(df, items).collect()} == {3, 8, 9, 10}


def test_words_replaced_after_runs_of_four_and_three(spark):
    w = [f"w{i}" for i in range(45)]
    dense = " ".join("other" if i % 9 in (4, 8) else x for i, x in enumerate(w))  # 35 of 45 words stay, 20 of them in runs of four
    df = spark.createDataFrame([(1, f"so it was said {dense} and so on"), (2, " ".join(w[:4]) + " and " + " ".join(w[9:13]))], "doc_id long, text string")
    found = leakage.leaked_passages(df, spark.createDataFrame([(7, " ".join(w))], "item_id long, passage string"))
    assert [r[:4] for r in rows(found)] == [(1, 7, 35, 45)]


def test_short_passages_and_scripts_without_blanks(spark):
    chinese = "保险公司应当在三十日内以书面形式通知被保险人有关决定"
    docs = [(1, f"前言。{chinese}，此后不再另行通知。"), (2, f"其他内容{chinese[:16]}等等"), (3, f"其他内容{chinese[:6]}等等"), (4, "he said two words and left"), (5, "two or more words"), (6, "grace"), (7, "one two three four")]
    items = [(1, chinese), (2, "Two words."), (3, "GRACE"), (4, "two, three: four"), (5, "four five six")]
    df, test = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string")
    assert [r[:2] for r in rows(leakage.leaked_passages(df, test))] == [(1, 1), (2, 1), (4, 2), (6, 3), (7, 4)]


def test_blocks_of_passages_and_shards_change_nothing(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    df, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/eval_items.parquet")
    whole = rows(leakage.leaked_passages(df, items))
    monkeypatch.setattr(leakage, "BLOCK_CHARS", 30_000)
    assert rows(leakage.leaked_passages(df, items)) == whole and whole


def test_matches_against_a_plain_search(spark):
    pick = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    passages = [(i, " ".join(pick.choices(vocabulary, k=20))) for i in range(5)]
    docs = []
    for d in range(60):
        _, p = pick.choice(passages)
        part = p.split()[pick.randrange(0, 8) : pick.randrange(9, 21)]
        docs.append((d, " ".join(pick.choices(vocabulary, k=30) + part + pick.choices(vocabulary, k=30))))
    got = {(r[0], r[1]) for r in rows(leakage.leaked_passages(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(passages, "item_id int, passage string")))}
    for d, t in docs:
        for i, p in passages:
            longest = max((b - a for a in range(20) for b in range(a + 4, 21) if " " + " ".join(p.split()[a:b]) + " " in f" {t} "), default=0)
            if longest >= 10:
                assert (d, i) in got
            if longest < 4:
                assert (d, i) not in got


def test_empty_sides(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, passage string")
    assert rows(leakage.leaked_passages(none, items)) == []
    assert rows(leakage.leaked_passages(spark.createDataFrame([(1, "x")], "doc_id long, text string"), items)) == []


# 7 mixing ------------------------------------------------------------------------------------------------------------


def test_rates_reach_targets_or_their_caps(spark):
    texts = {"a": 10, "b": 30, "c": 5}
    docs = [(i, f"{s} tells of {s}{s} and more words {s}", s, "x") for i, s in enumerate(k for k, n in texts.items() for _ in range(n))]
    docs += [(100, "a tells of aa", None, "x"), (101, None, "a", "x"), (102, "", "b", "x"), (103, "b tells of bb", "  ", "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, tokens string")
    targets = spark.createDataFrame([("a", 0.4, 5), ("b", 0.2, 1), ("c", 0.3, 1), ("gone", 0.1, 3), (None, 0.5, 1), ("a", 0.4, 5)], "source string, target_share double, max_repeats int")
    got = {r["source"]: r for r in mixing.mix_report(df, targets).collect()}
    assert set(got) == {"a", "b", "c", "gone"}
    assert {s for s, r in got.items() if r["short"]} == {"c", "gone"}
    assert got["c"]["repeats"] == 1.0 and got["gone"]["mixed_tokens"] == 0
    whole = sum(got[s]["tokens"] for s in "abc")
    assert got["a"]["mixed_tokens"] == pytest.approx(0.4 * whole, rel=0.1) and got["b"]["mixed_tokens"] == pytest.approx(0.2 * whole, rel=0.1)
    assert all(0 <= r["repeats"] <= r["max_repeats"] for r in got.values())


def test_shares_of_sources_that_are_not_short(spark):
    folder = "/root/testdata/sf0.01"
    df, targets = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/mix_targets.parquet")
    got = mixing.mix_report(df, targets).collect()
    assert {r["short"] for r in got} == {True, False}
    assert all(r["goal_share"] == pytest.approx(r["target_share"], rel=0.01) for r in got if not r["short"])
    assert all(r["repeats"] == pytest.approx(r["max_repeats"]) or not r["documents"] for r in got if r["short"])
    assert 0.97 < sum(r["reached_share"] for r in got) <= 1
    mixed = mixing.mixed_records(df, targets)
    taken = {r["source"]: r["n"] for r in mixed.groupBy("source").agg({"tokens": "max"}).withColumnRenamed("max(tokens)", "n").collect()}
    assert taken and {r["source"] for r in got if r["documents"]} <= set(taken)
    limits = {r["source"]: r["max_repeats"] for r in got}
    assert all(1 <= r["repeats"] <= limits.get(r["source"], 99) for r in mixed.collect())


def test_posteriors_follow_text_and_label():
    log_p = np.log(np.full((2, mixing.BUCKETS), 1e-6))
    log_p[0, 5] = log_p[1, 9] = np.log(0.9)
    model = mixing.Membership(log_p, np.array([True, True]))
    p = model.posteriors([[5, 5], [9], [], [9], []], np.array([-1, -1, -1, 0, 1]), 0.98)
    assert p[0, 0] > 0.99 and p[1, 1] > 0.99 and p[2, 0] == pytest.approx(0.5)
    assert p[3, 1] > 0.99 and p[4, 1] == pytest.approx(0.98)
    unknown = mixing.Membership(log_p, np.array([True, False]))
    assert unknown.posteriors([[9], [9]], np.array([1, -1]), 0.98).tolist() == [[0.0, 1.0], [1.0, 0.0]]


def test_no_documents_or_targets(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    assert [(r["source"], r["documents"], r["short"]) for r in mixing.mix_report(none, targets).collect()] == [("a", 0, False)]
    assert rows(mixing.mix_report(none, targets.limit(0))) == []


# 8 residue -----------------------------------------------------------------------------------------------------------


def test_slots_and_their_explanations(spark):
    filled = [f"Dear {{{{customer_name}}}}, your policy {{{{{v}}}}} falls due soon." for v in ("policy_no", "branchName")]
    docs = [
        (1, filled[0]), (2, filled[1]), (3, "Dear Ranvika, your policy 12 falls due soon."), (4, "Templates use markers such as {{policy_no}}; the system fills them in."),
        (5, "Our templates use markers such as {{policy_no}}; the system fills them at night."), (6, "Pay [[policy_no]] by <<customer_name>> today"), (7, "He wrote teh [sic] word."),
        (8, "I ______ holder of policy ______ declare"), (9, None), (10, ""), (1, filled[0]), (11, "x" * 100_000 + " ${customer_name} stands there"),
    ]
    df = spark.createDataFrame([(*r, "n") for r in docs], "doc_id long, text string, name string")
    assert sorted({r["doc_id"] for r in residue.open_slots(df).collect()}) == [1, 2, 6, 11]


def test_slots_that_other_records_fill(spark):
    letter = "Dear {}, your policy is due on {} May at the {} branch in your town."
    docs = [(i, letter.format(n, 3 + i, b)) for i, (n, b) in enumerate([("Ranvika Rao", "north"), ("Ode", "harbour"), ("Tam", "hill")])]
    docs += [(10, letter.format("{{customer_name}}", 9, "south")), (11, letter.format("{{customer_name}}", 12, "hill")), (12, letter.format("Ines", 5, "[Branch]"))]
    docs += [(20 + i, f"Templates use markers such as {{{{policy_no}}}}; the system fills them {w}.") for i, w in enumerate(("in", "at night"))]
    docs += [(30, "He wrote that this was teh [sic] word of the day."), (31, "It is paid to him under [the] policy terms as agreed."), (32, "It is paid to him under the policy terms as agreed."), (33, "It is paid to him under these policy terms as agreed.")]
    docs += [(40, "In the end it was that Rs 500 [sic] changed hands there.")] + [(41 + i, f"In the end it was that Rs {n} changed hands there.") for i, n in enumerate((700, 900))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted({r["doc_id"] for r in residue.open_slots(df).collect()}) == [10, 11, 12]


def test_records_of_one_template_that_all_kept_a_marker(spark):
    docs = [(i, f"Dear {{{{customer_name}}}}, your policy KL-{100 + i} falls due on {i + 3} May.") for i in range(5)]
    docs += [(10 + i, f"Notice of {t}\nPlease pay {{{{amount}}}} in time.\nYours, the branch manager") for i, t in enumerate(("Rain", "Snow", "Hail"))]
    docs += [(20 + i, f"{t} is the word.\nLetters hold markers such as {{{{due_date}}}} for values.\nSo much for {t}.") for i, t in enumerate(("Rain", "snow now", "all hail and more"))]
    df = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string")
    assert sorted({r["doc_id"] for r in residue.open_slots(df).collect()}) == [0, 1, 2, 3, 4, 10, 11, 12]


@pytest.mark.parametrize("marker", ["{{customer-name}}", "{{ x | default('y') }}", "{!Contact.FirstName}", "*|FNAME|*", "{0}", "%(amount)s", "$name", "N/A", "( )", "undefined"])
def test_markers_of_many_kinds(spark, marker):
    letter = "The sum of the policy is paid to {} at the branch of the town by the first of May."
    docs = [(i, letter.format(n)) for i, n in enumerate(("Ranvika Rao", "Ode", "Tam Lin", "Ines"))] + [(9, letter.format(marker))]
    assert {r["doc_id"] for r in residue.open_slots(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == {9}


def test_copies_of_a_real_document_are_no_template(spark):
    text = "Grace period\nThe insurer shall keep a copy of the claim form with the papers of the branch for ten years from the day on which it came in."
    docs = [(i, text, f"s{i % 7}") for i in range(40)] + [(100 + i, "Please switch scripts on to see this page.", f"s{i}") for i in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert {r["doc_id"] for r in residue.empty_pages(df).collect()} == set(range(100, 106))


def test_line_forms_without_work_on_plain_texts(spark):
    """Lone blanks are no white space to squeeze: most texts go through no replacement of it, and forms, filler and hints stay what they were."""
    wide = ["a  b", "a\tb", "a\x0bb", "a\x0cb", "a\r b", "a\u00a0b", "a\u2003 b", "a\u2028b", "a\u3000b", "A b"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(wide)], "i int, t string")
    assert {tuple(r[0]) for r in df.select(residue._skeletons(F.col("t"))).collect()} == {("a b",)}
    assert "WHEN" in df.select(residue._skeletons(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    lines = {"lorem ipsum dolor sit": True, "lorem ipsum dolor word": False, "word lorem ipsum dolor sit": True, "one two lorem ipsum dolor sit": False, "ab ab ab ab ab ab": True, "ab cd ab cd cd ab": True, "ab cd ef ab cd ef": False, "ab ab cd ef ab cd": False, "": False}
    got = {r["s"]: r["f"] for r in spark.createDataFrame([(x,) for x in lines], "s string").select("s", residue._filler(F.col("s")).alias("f")).collect()}
    assert got == lines
    texts = ["Dear {name}", "to NaN", "( )", '" "', "XxX", "a *|b|* c", "plain words (so) \"said\"", "__x__"]
    hinted = spark.createDataFrame([(x,) for x in texts], "t string").where(residue._hinted(F.col("t"))).collect()
    assert {r["t"] for r in hinted} == {*texts} - {texts[6]}


def test_blanks_of_any_white_space_are_markers(spark):
    texts = ["Dear (\u00a0), welcome", 'Dear "\u2003", welcome', "Dear (so), welcome"]
    assert [bool(residue._MARK.search(t)) for t in texts] == [True, True, False]
    df = spark.createDataFrame([(t,) for t in texts], "t string").where(residue._hinted(F.col("t")))
    assert {r["t"] for r in df.collect()} == {*texts[:2]}


def test_words_without_a_loop_over_words():
    """Words come out of arrays of characters as the pattern has them; equal words have equal numbers, all figures one."""
    pick = random.Random(3)
    numbers, of = residue._Numbers(), {}
    for _ in range(400):
        texts = ["".join(pick.choices("ab1 2.,/:-_\u00b2\u2462\u0967\u093e\u0915\n\x02\x03\u00e9\U0001d7d8\U00010400", k=pick.randrange(14))) for _ in range(pick.randrange(1, 5))]
        found = list(zip(*(x.tolist() for x in residue._words(texts)), strict=True))
        for k, t in enumerate(texts):
            assert [(s, e) for _, i, s, e in found if i == k] == [(-1, 0), *(m.span() for m in residue._TOKEN.finditer(t)), (len(t), len(t) + 1)]
        for n, k, s, e in found:
            word = residue._START if s < 0 else residue._END if e > len(texts[k]) else texts[k][s:e]
            assert n == numbers[word] == of.setdefault("#" if word[:1].isdigit() else word, n)
    assert len(set(of.values())) == len(of) > 50
    parts = list(residue._parts(["a" * 10, "b" * residue.PART, "c", "d"]))
    assert [len(x) for x in parts] == [1, 1, 2]


def test_latin_filler_is_judged_by_two_known_words_first():
    pick = random.Random(4)
    lines = ["".join(pick.choice(["lorem", "in", "do", "sit", "ut", "reprehenderit", *["word", "\u0915\u093e"] * (n % 2)]) + pick.choice([" ", ", ", "-", "1"]) for _ in range(n % 13)) for n in range(3000)]
    words = [re.findall(r"[a-z\u0915\u093e]+", x) for x in lines]
    want = [len(w) >= 4 and sum(x in residue.FILLER_WORDS for x in w) >= 0.8 * len(w) for w in words]
    assert residue._latin(pa.array(lines)).to_pylist() == want and 100 < sum(want) < 2900
    assert residue._latin(pa.array([None, ""], pa.string())).to_pylist() == [False, False]


def test_skeletons_mask_figures_in_one_pass(spark):
    pick = random.Random(5)
    texts = ["".join(pick.choices(["1", "23", "#", " ", " ", "\n", "-", ".", "/", "may", "A"] + ["\u00e9", "\u0967", "\u00a0"] * (k % 2), k=pick.randrange(16))) for k in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace(F.lower(F.regexp_replace("t", r"[\s\p{Z}&&[^\n]]+", " ")), r"\p{N}+", "#")
    twice = F.split(F.trim(F.regexp_replace(plain, r"#(?:[ /.,-]{1,2}(?:\p{L}+ )?#)+", "#")), r" ?\n[ \n]*")
    assert df.select("t", residue._skeletons(F.col("t")).alias("one"), twice.alias("two")).where("one <> two").collect() == []


def test_pages_of_nothing_but_residue(spark):
    pick = random.Random(2)
    prose = [" ".join(pick.choices(WORDS, k=25)).capitalize() + "." for _ in range(60)]
    docs = [(i, f"Grace period\n{prose[i]}\n{prose[i + 1]}\n{prose[i + 2]}\n{prose[i + 3]}") for i in range(40)]
    docs += [(100 + i, f"Grace period\nError {i}: the page could not be found.\nCopyright {2000 + i} A Life") for i in range(6)]
    docs += [(200, "Lorem ipsum dolor sit amet. Consectetur adipiscing elit sed do."), (201, "test test test test test test test"), (202, f"{prose[50]}\nError 7: the page could not be found."), (203, "Grace period"), (204, None), (205, "")]
    df = spark.createDataFrame([(*r, True) for r in docs], "doc_id long, text string, filler boolean")
    got = {r["doc_id"] for r in residue.empty_pages(df).collect()}
    assert got == {*range(100, 106), 200, 201}
    kept = {r["doc_id"] for r in residue.drop_residue(df).collect()}
    assert kept == {d for d, _ in docs} - got


def test_no_documents(spark):
    assert rows(residue.find_residue(spark.createDataFrame([], "doc_id long, text string"))) == []
