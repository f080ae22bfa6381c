"""Repair of text from scanned pages: headers and footers, page numbers, broken words and misread characters."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import cut

MARKER = re.compile(r"--- PAGE (\d+) ---\s*\Z")
#: Lines looked at on each edge of a page, the likeness of running lines, and the most lines that a cover page has.
EDGE, LIKE, COVER = 3, 0.8, 5
#: A page is compared with so many before and behind it, so a file's cost grows with its pages only; and a page number may be one of so many in a row.
NEAR, ROW = 24, 3
HYPHENS = "-‐­¬"
# What scanners read in place of what, as (seen, meant).
CONFUSIONS = (
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("9", "g"), ("8", "b"), ("2", "z"), ("¥", "y"), ("¢", "c"), ("á", "a"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"),
    ("c", "e"), ("e", "c"), ("ii", "u"), ("cl", "d"), ("rn", "m"), ("m", "rn"), ("ri", "n"), ("f", "t"), ("fi", "ti"), ("ﬁ", "fi"), ("ﬁ", "ti"), ("h", "li"), ("b", "h"), ("vv", "w"), ("li", "h"), ("d", "cl"),
)
DIGITS = str.maketrans("OoIlSBZ", "0011582")
_BROKEN = re.compile(r"�|[¥¢~|](?=[\wऀ-ॿ])|(?<=[\wऀ-ॿ])[¥¢~|]|[ऀ-ॣ०-ॿ][A-Za-z]|[A-Za-z][ऀ-ॣ०-ॿ]|(?<=[^\W\d_])!(?=[^\W\d_])|^![^\W\d_]")
_NUMBER = re.compile(r"[\d,./\-]*\d[\d,./\-]*\Z")
_LABELLED = re.compile(r"(?i)\W*(?:p\s*a\s*g\s*e|pg|p|seite|hal(?:aman)?|पृष्ठ|पान)\W*([0-9OIlSBZ]+|[ivxl]+)(?:\W*(?:of|/|dari|में से)\W*[0-9OIlSBZ]+)?\W*\Z")
_BARE = re.compile(r"\W*([0-9OIlSBZ]+|[ivxl]+|[IVXL]+)(?:\s*(?:/|of)\s*([0-9OIlSBZ]+))?\W*\Z")
_ALONE = re.compile(r"[\[(\-– ]*(?:[0-9]{1,3}(?: ?/ ?[0-9]{1,3})?|[ivxl]{1,5})[\])\-– ]*\Z")
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50}
_EDGE_MARKS = "\"'“”‘’()[]{}<>.,;:?*•«»।…"


def _value(text: str) -> int | None:
    """A page number's value, arabic with misread digits or roman."""
    if any(c.isdigit() for c in text):
        fixed = text.translate(DIGITS)
        return int(fixed) if fixed.isdigit() else None
    low = text.lower()
    if low and set(low) <= set(_ROMAN):
        total = 0
        for a, b in zip(low, low[1:] + " ", strict=False):
            total += -_ROMAN[a] if _ROMAN.get(b, 0) > _ROMAN[a] else _ROMAN[a]
        return total
    return None


def _letters(line: str) -> str:
    low = re.sub(r"(?<=[a-z])[015](?=[a-z])", lambda m: "ols"["015".index(m[0])], line.lower().replace("á", "a"))
    return re.sub(r"[\W\d_]+", "", low)


def _running(line: str) -> bool:
    """Whether a line can be a running one: short, not the middle of a sentence and not a numbered heading."""
    first = next((c for c in line if c.isalpha()), "")
    return len(line.strip()) <= 75 and not first.islower() and line.rstrip()[-1:] not in ",;.।?" and not re.search(r", [a-z]|[a-z]{2}\. [A-Z]|^\s*\d+\. ", line)


def _edge_key(line: str) -> str:
    """What running lines of different files share: their first part, or all of a line without parts."""
    return _letters(re.split(r" [-|–] |,|\s{3,}", line.strip())[0])[:12]


def layout(text: str, title: str = "") -> list[tuple[int, int, str, str]]:
    """(line number, page, kind, line) of each line but the page markers and blank lines; kind is body, edge, header, page_number or
    cover, where edge lines are body lines outermost on a page.

    A page number has a label, or its value less the page's place is the same on 40 % of the NEAR pages on each side (two at least) or
    on ROW pages in a row, or, in a file without such pages, it stands alone on the very edge with no other number beside it. A header or
    footer is a line on a page's edge whose letters come again, about the same, on the same edge of 34 % of the NEAR pages on each side, or
    are those of the file's title.
    """
    pages: list[list[tuple[int, str]]] = [[]]
    for n, line in enumerate(text.split("\n"), 1):
        if MARKER.match(line):
            if pages[-1] or len(pages) > 1:
                pages.append([])
        elif line.strip():
            pages[-1].append((n, line))
    kind: dict[int, str] = {}
    cover = len(pages) > 1 and 0 < len(pages[0]) <= COVER and max(map(len, pages[1:])) > COVER
    if cover:
        kind |= {n: "cover" for n, _ in pages[0]}
    body = [p for p in pages[cover:]]
    edges = [[(k, n, x) for k, (n, x) in enumerate(p[:EDGE])] + [(-1 - k, n, x) for k, (n, x) in enumerate(reversed(p[-EDGE:])) if n not in {m for m, _ in p[:EDGE]}] for p in body]
    # page numbers
    offsets: dict[int, set[int]] = {}
    bare: list[tuple[int, int, int]] = []
    for place, edge in enumerate(edges):
        for _, n, x in edge:
            squashed = x.strip()
            if (m := _LABELLED.match(squashed)) and _value(m[1]) is not None and len(squashed) <= 24:
                kind[n] = "page_number"
            elif len(squashed) <= 16 and (m := _BARE.match(squashed)) and (v := _value(m[1])) is not None:
                bare.append((place, n, v))
                offsets.setdefault(v - place, set()).add(place)
    settled: set[tuple[int, int]] = set()  # (offset, place)
    for o, pages_ in offsets.items():
        places = sorted(pages_)
        for i, at in enumerate(places):
            near = bisect_right(places, at + NEAR) - bisect_left(places, at - NEAR)
            row = {k for k in range(max(0, i - ROW + 1), i + 1) if k + ROW <= len(places) and places[k + ROW - 1] - places[k] == ROW - 1}
            if row or near >= 2 and near >= 0.4 * (min(len(body), at + NEAR + 1) - max(0, at - NEAR)):
                settled.add((o, at))
    for place, n, v in bare:
        edge = edges[place]
        at = next(i for i, (_, m, _) in enumerate(edge) if m == n)
        near = [x for k, _, x in edge if abs(k - edge[at][0]) == 1 and (k < 0) == (edge[at][0] < 0)]
        alone = edge[at][0] in (0, -1) and _ALONE.match(edge[at][2].strip()) and len(body[place]) > COVER and not any(_BARE.match(x.strip()) for x in near)
        if (v - place, place) in settled or alone and not settled:
            kind[n] = "page_number"
    heading = _letters(re.sub(r"\.\w+\Z", "", re.sub(r"\A[A-Z]+ \d+ ", "", title)))
    able = {n for edge in edges for _, n, x in edge if _running(x)}
    # headers and footers, outermost first: a line counts if nothing but such lines stands between it and the edge
    for top in (True, False):
        outer = [[(n, x) for k, n, x in edge if (k >= 0) == top] for edge in edges]
        keys = [[(n, _letters(x)) for n, x in o] for o in outer]
        for place, own in enumerate(keys):
            for n, key in own:
                if kind.get(n) == "page_number":
                    continue
                if len(key) < 4 or n not in able or not (len(heading) >= 8 and _like(key, heading) or _again(keys, kind, place, key)):
                    kind.setdefault(n, "edge")
                    break
                kind[n] = "header"
    return [(n, place + 1, kind.get(n, "body"), x) for place, p in enumerate(pages) for n, x in p]


def _again(keys: list[list[tuple[int, str]]], kind: dict[int, str], place: int, key: str) -> bool:
    """Whether about the same letters stand on the same edge of enough of the pages near this one."""
    low, high = max(0, place - NEAR), min(len(keys), place + NEAR + 1)
    need = max(1, 0.34 * (high - low - 1))
    for p in range(low, high):
        if p != place and any(_like(key, other) for m, other in keys[p] if kind.get(m) != "page_number"):
            need -= 1
            if need <= 0:
                return True
        elif need > high - p:
            return False
    return False


def _like(a: str, b: str) -> bool:
    if a == b:
        return True
    if not 0.6 < len(a) / max(1, len(b)) < 1.67:
        return False
    match = SequenceMatcher(None, a, b, autojunk=False)
    return match.real_quick_ratio() >= LIKE and match.quick_ratio() >= LIKE and match.ratio() >= LIKE


def _bare_word(token: str) -> str:
    return token.strip(_EDGE_MARKS).lower()


#: Bytes of text that are worked on at a time, and letters of candidates handed over at a time: the words of a whole batch take many times the room of its text.
PART = 1 << 20
#: Between a file's name and the hash of its text, which together tell texts of one file apart.
_GLUE, _NO_FILE = "\x00", "\x01"


def _texts(df: DataFrame, file: str, text: str) -> DataFrame:
    """(file, text): the rows, file being its name and the hash of its text. Equal rows have the same."""
    name = F.concat(F.coalesce(F.col(f"`{file}`"), F.lit(_NO_FILE)), F.lit(_GLUE), F.coalesce(F.hex(F.xxhash64(F.col(f"`{text}`"))), F.lit("")))
    return df.select(name.alias("file"), F.col(f"`{text}`").alias("text"))


def _named(df: DataFrame, file: str) -> DataFrame:
    """The result with the file's own name again."""
    name = F.substring_index("file", _GLUE, 1)
    return df.withColumn("file", F.when(name != _NO_FILE, name)).withColumnRenamed("file", file)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut up into parts of about PART bytes of text, or one text that is longer."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column("text")), 0).cast(pa.int64())).to_pylist()
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, bisect_right(ends, (ends[at - 1] if at else 0) + PART))
            yield batch.slice(at, end - at)
            at = end


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, line_no, kind, edge, first, second, follows, words): the kind of a line, its key if it is a running line or outermost,
    the two parts where it ends in a broken word and the line of the second one, and its whole words."""
    for batch in _parts(batches):
        rows = []
        for k, (text, name) in enumerate(zip(batch.column("text").to_pylist(), batch.column("file").to_pylist(), strict=True)):
            body = []
            for n, _, kind, x in layout(text, name.split(_GLUE)[0]):
                if kind in ("body", "edge"):
                    body.append((n, x.replace("\xa0", " "), _edge_key(x) if kind == "edge" else None))
                elif kind != "cover":
                    rows.append((k, n, kind, _edge_key(x), None, None, None, []))
            carried = False
            for i, (n, x, edge) in enumerate(body):
                tokens = x.split()
                first = second = None
                if i + 1 < len(body) and tokens and len(tokens[-1]) > 1 and tokens[-1][-1] in HYPHENS and tokens[-1][-2].isalpha() | ("ऀ" <= tokens[-1][-2] <= "ॿ") | (tokens[-1][-2] in "!¥¢�0156"):
                    follow = body[i + 1][1].split()
                    if follow and (follow[0][0].isalpha() or follow[0][0] in "!¥¢�0156"):
                        first, second = tokens[-1][:-1].lstrip(_EDGE_MARKS).lower(), follow[0].rstrip(_EDGE_MARKS).lower()
                whole = tokens[1 if carried else 0 : len(tokens) - (first is not None)]
                carried = first is not None
                rows.append((k, n, "body", edge, first, second, body[i + 1][0] if carried else None, [w.strip(_EDGE_MARKS) for w in whole]))
        cols = list(zip(*rows, strict=True)) or [()] * 8
        yield pa.RecordBatch.from_arrays(
            [batch.column("file").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.string()) for c in cols[2:6]), pa.array(cols[6], pa.int32()), pa.array(cols[7], pa.list_(pa.string()))],
            names=["file", "line_no", "kind", "edge", "first", "second", "follows", "words"],
        )


def _fixes(word: str) -> list[str]:
    """What a word may have been: each confusion undone at one place, or at all places."""
    out = set()
    for seen, meant in CONFUSIONS:
        at = word.find(seen)
        if at >= 0:
            out.add(word.replace(seen, meant))
        while at >= 0:
            out.add(word[:at] + meant + word[at + len(seen) :])
            at = word.find(seen, at + 1)
    digits = word.replace("0", "o").replace("1", "l").replace("5", "s").replace("6", "b").replace("9", "g")
    out.add(digits)
    for part in ("'s", "-"):
        if part in word:
            out.add(word.replace(part, ""))
    out.discard(word)
    return sorted(x for x in out if x)


def _shape(word):
    return F.regexp_replace(word, r"[0-9]", "9")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, fix, kind) for words that may be misread: kind `broken` needs no proof, `fix` a frequent word, `any` a frequent word that differs in one letter, `shape` a frequent form of numbers."""
    rows, letters = [], 0
    for batch in batches:
        for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
            for fix, kind in _readings(word):
                rows.append((word, n, fix, kind))
                letters += len(word) + len(fix)
                if letters > PART:
                    yield _candidate_rows(rows)
                    rows, letters = [], 0
    yield _candidate_rows(rows)


def _readings(word: str) -> Iterator[tuple[str, str]]:
    low = word.lower()
    if _BROKEN.search(word):
        yield low, "broken"
    if any(c.isdigit() for c in word) or set(word) <= set("OlSBZ,./-"):
        fixed = word.translate(DIGITS)
        if fixed != word and any(c.isdigit() for c in fixed):
            yield re.sub("[0-9]", "9", fixed), "shape"
    if not _NUMBER.match(low) and (len(low) >= 3 or any(not c.isalpha() for c in low)):
        yield from ((f, "fix") for f in _fixes(low))
    if len(low) >= 5 and low.isalpha():
        yield from ((low[:i] + "?" + low[i + 1 :], "any") for i in range(len(low)))


def _candidate_rows(rows: list[tuple[str, int, str, str]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())], names=["word", "n", "fix", "kind"])


def misread_words(words: DataFrame, often: int = 15, far: int = 300) -> DataFrame:
    """(word, fix, sure) from (word, n), the corpus vocabulary: misread words and the word each most likely was.

    A word is misread if it has signs that no word has (`broken`), if undoing a known confusion gives a word that the corpus has
    `often` times as much, if a word that differs in one letter comes `far` times as much, or if its digits, with letters
    read as digits, give a form of number that is `often` times as frequent.
    """
    low = words.groupBy(F.lower("word").alias("fix")).agg(F.sum("n").alias("m"))
    shapes = words.where(F.col("word").rlike(r"[0-9]")).groupBy(_shape(F.col("word")).alias("fix")).agg(F.sum("n").alias("m"))
    all_ = words.join(low.withColumnRenamed("fix", "l").withColumnRenamed("m", "lower_n"), F.lower("word") == F.col("l")).select("word", F.col("lower_n").alias("n"))
    maybe = all_.mapInArrow(_candidates, "word string, n long, fix string, kind string")
    fixed = maybe.where("kind = 'fix'").join(low, "fix").where(F.col("m") >= often * F.col("n")).select("word", "fix", "m")
    own = words.select(F.col("word").alias("w"), _shape(F.col("word")).alias("s")).join(shapes.withColumnRenamed("fix", "s").withColumnRenamed("m", "own"), "s", "left").select("w", "own")
    numbers = maybe.where("kind = 'shape'").join(shapes, "fix").join(own, F.col("word") == F.col("w")).where(F.col("m") >= often * F.coalesce("own", F.lit(1)))
    numbers = numbers.select("word", F.translate("word", "OoIlSBZ", "0011582").alias("fix"), "m")
    wild = maybe.where("kind = 'any'")
    best = wild.groupBy("fix").agg(F.max(F.struct("n", F.lower("word").alias("w"))).alias("b"))
    near = wild.join(best, "fix").where(F.col("b.n") >= far * F.col("n")).select("word", F.col("b.w").alias("fix"), F.col("b.n").alias("m"))
    broken = maybe.where("kind = 'broken'").select("word", F.lit(None).cast("string").alias("fix"), F.lit(0).cast("long").alias("m"))
    known = fixed.unionByName(numbers).withColumn("rank", F.lit(2))  # a known confusion before any other letter
    found = known.unionByName(near.withColumn("rank", F.lit(1))).unionByName(broken.withColumn("rank", F.lit(0)))
    return found.groupBy("word").agg(F.max(F.struct("rank", "m", "fix")).alias("b")).select("word", F.col("b.fix").alias("fix"))


def scan_lines(df: DataFrame, file: str = "file", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The lines of all distinct files, read from text once and kept in the checkpoint folder, and (file, line_no) of those body lines
    that are running lines after all: outermost ones that begin like the running lines of several files."""
    rows = _texts(df, file, text).where("text is not null").dropDuplicates(["file"])
    lines = cut(rows.mapInArrow(_lines, "file string, line_no int, kind string, edge string, first string, second string, follows int, words array<string>"))
    known = lines.where("kind = 'header' and length(edge) >= 8").groupBy(F.col("edge").alias("known")).agg(F.count("*").alias("n"), F.min(F.substring_index("file", _GLUE, 1)).alias("a"), F.max(F.substring_index("file", _GLUE, 1)).alias("b")).where("n >= 4 and a <> b").select("known")
    titles = _texts(df, file, text).select(F.substring(F.regexp_replace(F.lower(F.regexp_replace(F.substring_index("file", _GLUE, 1), r"^[A-Z]+ \d+ ", "")), r"[^\p{L}]", ""), 1, 12).alias("known")).distinct()
    known = known.join(titles, "known", "left_anti")  # a file's own title has been looked for in the file
    return lines, lines.where("kind = 'body' and edge is not null").join(known, F.col("edge") == F.col("known"), "left_semi").select("file", "line_no")


def _vocabulary(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode("words").alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def _broken_words(lines: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(file, line_no, first, second, follows) of lines that end in the first part of a word written without a hyphen: the corpus has the joined word at least as often as the compound."""
    pairs = lines.where("first is not null").select("file", "line_no", "first", "second", "follows")
    low = vocabulary.groupBy(F.translate(F.lower("word"), "‐­¬", "---").alias("w")).agg(F.sum("n").alias("n"))
    joined, compound = low.select(F.col("w").alias("j"), F.col("n").alias("n_j")), low.select(F.col("w").alias("c"), F.col("n").alias("n_c"))
    counted = pairs.join(joined, F.concat("first", "second") == F.col("j"), "left").join(compound, F.concat("first", F.lit("-"), "second") == F.col("c"), "left")
    # a second part that is a whole compound's end without evidence for either reading: the prefix decides over all compounds that begin so
    prefix = low.where("w like '%-%'").groupBy(F.substring_index("w", "-", 1).alias("p")).agg(F.sum("n").alias("n_p"))
    counted = counted.join(prefix, F.col("first") == F.col("p"), "left").join(low.select(F.col("w").alias("whole"), F.col("n").alias("n_w")), F.col("first") == F.col("whole"), "left")
    nothing = F.lit(0)
    plain = F.coalesce("n_j", nothing) >= F.greatest(F.coalesce("n_c", nothing), F.lit(1))
    unseen = F.col("n_j").isNull() & F.col("n_c").isNull() & (F.coalesce("n_p", nothing) <= F.coalesce("n_w", nothing) + 5)
    return cut(counted.where(plain | unseen).select("file", "line_no", "first", "second", "follows"))


def scan_noise(df: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, line_no, kind): hyphen, misread, header and page_number lines of scanned files. A body line may have the first two.

    Line numbers count every line, from 1. Equal rows count once; texts of one file are judged each, and a line is listed once; null and
    empty texts have no line; a file without page markers is one page, on which no line can repeat.
    """
    lines, lone = scan_lines(df, file, text)
    vocabulary = cut(_vocabulary(lines))
    broken = _broken_words(lines, vocabulary)
    joined = broken.select("file", "line_no", "first", "second", "follows", F.concat("first", "second").alias("word"))
    bad = cut(misread_words(vocabulary.unionByName(joined.groupBy("word").agg(F.count("*").alias("n"))).groupBy("word").agg(F.sum("n").alias("n"))))
    edge = lines.where("kind <> 'body'").select("file", "line_no", "kind").unionByName(lone.withColumn("kind", F.lit("header")))
    words = lines.select("file", "line_no", F.explode("words").alias("word")).join(_common(vocabulary, bad), "word", "left_anti")
    misread = words.join(bad, "word", "left_semi").select("file", "line_no").unionByName(_misread_parts(joined, bad)).distinct()
    hyphen = broken.select("file", "line_no", F.lit("hyphen").alias("kind"))
    inner = hyphen.unionByName(misread.withColumn("kind", F.lit("misread"))).join(lone, ["file", "line_no"], "left_anti")
    return _named(edge.unionByName(inner), file).distinct()


def _misread_parts(joined: DataFrame, bad: DataFrame) -> DataFrame:
    """(file, line_no) of the lines with the misread part of a broken word: the one that its right reading doesn't begin, or end, with."""
    found = joined.join(bad, "word")
    odd = lambda c: ~F.col(c).rlike(r"^[\p{L}\p{M}'’-]+$")
    early = F.coalesce(~F.startswith("fix", "first"), odd("first"))
    late = F.coalesce(~F.endswith("fix", "second"), odd("second"))
    lines = F.array_compact(F.array(F.when(early | ~late, F.col("line_no")), F.when(late, F.col("follows"))))
    return found.select("file", F.explode(lines).alias("line_no"))


def _common(vocabulary: DataFrame, bad: DataFrame) -> DataFrame:
    """The words that make up at least a 20,000th of the corpus each, so at most 20,000; they are taken out before the rare ones are shuffled."""
    whole = vocabulary.agg(F.sum("n")).first()[0] or 0
    return F.broadcast(vocabulary.where(F.col("n") * 20000 >= whole).join(bad, "word", "left_anti").select("word"))


def _rebuilder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _parts(batches):
        out = []
        for row in batch.to_pylist():
            text, gone, broken, fixes = row["text"], set(row["gone"] or ()), set(row["broken"] or ()), dict((f["word"], f["fix"]) for f in row["fixes"] or ())
            out.append(None if text is None else rebuild(text, gone, broken, fixes))
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(out, pa.string())], names=["file", "text"])


def rebuild(text: str, gone: set[int], broken: set[int], fixes: dict[str, str]) -> str:
    """Paragraphs with one blank line between: running lines and page numbers left out, lines and broken words joined, known misread words replaced."""
    paragraphs: list[str] = []
    glue, page_turned = "", False
    new = True
    for n, line in enumerate(text.split("\n"), 1):
        if MARKER.match(line):
            page_turned = True
            continue
        if n in gone:
            continue
        line = " ".join(line.split())
        if not line:
            new = not page_turned or new
            continue
        if page_turned and paragraphs and not glue and paragraphs[-1][-1:] not in ".!?।:":
            new = False
        page_turned = False
        if new and not glue or not paragraphs:
            paragraphs.append(line)
        else:
            paragraphs[-1] += ("" if glue else " ") + line
        new, glue = False, ""
        if n in broken and paragraphs[-1][-1] in HYPHENS:
            paragraphs[-1], glue = paragraphs[-1][:-1], "joined"
        elif paragraphs[-1][-1] in HYPHENS and paragraphs[-1][-2:-1].isalnum():
            paragraphs[-1], glue = paragraphs[-1][:-1] + "-", "compound"

    def fix(m: re.Match) -> str:
        token = m[0]
        core = token.strip(_EDGE_MARKS)
        meant = fixes.get(core)
        if not meant:
            return token
        meant = meant.upper() if core.isupper() and len(core) > 1 and meant.isalpha() else meant[:1].upper() + meant[1:] if core[:1].isupper() else meant
        return token.replace(core, meant)

    return "\n\n".join(re.sub(r"\S+", fix, p) for p in paragraphs)


def repair_scans(df: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(file, text): each distinct file as continuous paragraphs. A misread word without a certain reading stays as it is; a null text stays null, an empty one empty."""
    lines, lone = scan_lines(df, file, text)
    vocabulary = cut(_vocabulary(lines))
    broken = _broken_words(lines, vocabulary)
    joined = broken.select("file", F.concat("first", "second").alias("word"))
    bad = cut(misread_words(vocabulary.unionByName(joined.groupBy("word").agg(F.count("*").alias("n"))).groupBy("word").agg(F.sum("n").alias("n"))).where("fix is not null"))
    gone = lines.where("kind <> 'body'").select("file", "line_no").unionByName(lone).groupBy("file").agg(F.collect_set("line_no").alias("gone"))
    ends = broken.groupBy("file").agg(F.collect_set("line_no").alias("broken"))
    words = lines.select("file", F.explode("words").alias("word")).join(_common(vocabulary, bad), "word", "left_anti").unionByName(joined)
    fixes = words.join(bad, "word").groupBy("file").agg(F.collect_set(F.struct("word", "fix")).alias("fixes"))
    rows = _texts(df, file, text).dropDuplicates(["file"])
    whole = rows.join(gone, "file", "left").join(ends, "file", "left").join(fixes, "file", "left").select("file", "text", "gone", "broken", "fixes")
    return _named(whole.mapInArrow(_rebuilder, "file string, text string"), file)
