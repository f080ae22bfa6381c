"""Template residue and error-page text: induced slots that kept their variable, and repeated whole-page templates."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import cut

# The signs by which template languages mark a variable, as patterns with the variable's name in group 1. They only say
# where to look; whether a marked place is an unfilled slot is decided by aligning records.
_NAME = r"[^\W\d_][\w.-]*(?: [\w.]+){0,2}"
_FILTERS = r"(?:\s*\|[^{}\n|]{1,40}){0,3}"
STYLES = {
    "double brace": r"\{\{\s*(" + _NAME + r")" + _FILTERS + r"\s*\}\}",
    "statement": r"\{[%#]-?\s*(" + _NAME + r")" + _FILTERS + r"\s*-?[%#]\}",
    "dollar brace": r"\$\{\s*(" + _NAME + r")(?::?-[^{}\n]{0,40})?\s*\}",
    "merge brace": r"\{!\s*(" + _NAME + r")\s*\}",
    "brace": r"(?<![{$])\{\s*(" + _NAME + r"|\d{1,2})\s*(?::[^{}\n]{0,20})?\}(?!\})",
    "star pipe": r"\*\|(" + _NAME + r")(?::[^|\n]{1,20})?\|\*",
    "tag": r"<%=?\s*(" + _NAME + r")\s*%>",
    "double angle": r"<<\s*(" + _NAME + r")\s*>>",
    "angle": r"(?<![<])<(" + _NAME + r")>(?!>)",
    "guillemets": r"«\s*(" + _NAME + r")\s*»",
    "double bracket": r"\[\[\s*(" + _NAME + r")\s*\]\]",
    "insert": r"\[(?:Insert|Enter|Your)\s+(" + _NAME + r")\s+here\]",
    "bracket": r"(?<!\[)\[(" + _NAME + r")\](?!\])",
    "at": r"@@(" + _NAME + r")@@",
    "hash": r"#(" + _NAME + r")#",
    "percent": r"%(" + _NAME + r")%",
    "format": r"%\((" + _NAME + r")\)[sdif]",
    "dollar": r"\$(" + _NAME + r")\$",
    "shell": r"(?<![\w$])\$([A-Za-z_][\w.]*\w)(?![\w$])",
    "underscores": r"(?<!_)__(" + r"[^\W\d_][A-Za-z.]*(?:[_ ][A-Za-z.]+){0,2}" + r")__(?!_)",
    "default": r"(?<![\w/.-])(null|NULL|undefined|NaN|N/A|n/a|[Xx]{3,8}|\[object Object\])(?![\w/-])",
    "blank": r"([\[({<«]\s{0,3}[\])}>»]|\"\s{0,3}\")",
}
# The words of the customary Latin filler.
FILLER_WORDS = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split()
)
_MARK = re.compile("|".join(f"(?:{p})" for p in STYLES.values()))
# Some sign of a marker, found by a rare first letter, or as a word; they let through no fewer texts than STYLES find markers in.
_GAP = r"[\s\x1C-\x1F\x85\p{Z}]"
_HINTS = r"(?=[{}<>«»\[\]@#%$_*XxN(\"])(?:[{}<>«»\[\]@#%$]|__|\*\||[Xx]{3}|NULL|NaN|N/A|\(" + _GAP + r"*\)|\"" + _GAP + r"{0,3}\")"
_HINT_WORDS = ("null", "n/a", "undefined")
_VARIABLE = re.compile(r"\w[_.-]\w|[a-z][A-Z]")
_WORD = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,/:-]\d+)*")
#: Words on each side that make a place, and the most words and characters of a value.
SIDE, VALUE_WORDS, VALUE_CHARS = 3, 8, 80
#: Bits of each filter through which texts are read for values; fuller filters let more places through to the join, nothing else.
FILTER_BITS = 1 << 24
#: Characters that are cut into words at a time.
PART = 1 << 19
_START, _END = "\x02", "\x03"
# Kinds of characters, the number of all figures and the base of words' hashes.
_OTHER, _LETTERS, _RAISED, _DIGITS, _INSIDE, _FIRST, _LAST = range(7)
_FIGURE, _BASE = np.uint64(0x2545F4914F6CDD1D), 0xD1342543DE82EF95
# Styles that editors, markup and forms use as well, and tags that stand without a closing one.
_LOOSE = ("bracket", "angle", "default", "blank")
# Styles that nothing but templates use, whatever the name.
_STRICT = ("double brace", "statement", "dollar brace", "merge brace", "star pipe", "tag", "format")
_SINGLE_TAGS = frozenset("br hr p li img input".split())
_EDGE = 200
_SENTENCE_END = re.compile(r"[.!?।:;](?=\s)|\n")
_SLOT_WORDS = re.compile(r"(?:[^\W\d_]*\d[\w.,/:-]*|[A-Z]\w*)(?:\W+(?:\w*\d[\w.,/:-]*|[A-Z]\w*))*")


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b + np.uint64(0x9E3779B97F4A7C15) + (a << np.uint64(6)) + (a >> np.uint64(2)))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _spread(x: np.ndarray) -> np.ndarray:
    """The mixing step of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _characters(size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each code point below size: its kind (letters and other signs of words, those of them that are figures, digits, signs inside numbers, or none of these) and its hash."""
    every = "".join(map(chr, range(size)))
    kinds = np.full(size, _OTHER, np.uint8)
    for kind, pattern in ((_LETTERS, r"[^\W\d_]+"), (_DIGITS, r"\d+"), (_INSIDE, r"[.,/:-]+")):
        for m in re.finditer(pattern, every):
            kinds[m.start() : m.end()] = kind
    kinds[[k for k in np.flatnonzero(kinds == _LETTERS).tolist() if every[k].isdigit()]] = _RAISED
    return kinds, _spread(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a fixed odd number and of its inverse, modulo 2 ** 64."""
    up, down = (np.full(size, x, np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, text, start, end) of the words of all texts, as _TOKEN has them, between a _START and an _END for each text.

    A word's number is a hash of its letters, the same in every task; all figures have one, as they differ between records of one template.
    """
    codes = np.frombuffer("".join(f"{_START}{t}{_END}" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds, hashes = _characters(0x10000 if codes.max(initial=0) < 0x10000 else 0x110000)
    kind = kinds[codes]
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    kind[ends - sizes], kind[ends - 1] = _FIRST, _LAST
    raised = kind == _RAISED
    kind[raised] = _LETTERS
    inside = np.flatnonzero(kind == _INSIDE)  # an end of the text is on either side
    kind[inside] = np.where((kind[inside - 1] == _DIGITS) & (kind[inside + 1] == _DIGITS), _DIGITS, _OTHER)
    turns = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]))
    word = kind[turns[:-1]] != _OTHER
    start, end = turns[:-1][word], turns[1:][word]
    n = 1 << max(16, len(codes).bit_length())
    up, down = _powers(n) if n <= 2 * PART else _powers.__wrapped__(n)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes[codes] * up[: len(codes)], dtype=np.uint64)))
    number = _spread((sums[end] - sums[start]) * down[start])
    number[(kind[start] == _DIGITS) | raised[start]] = _FIGURE
    text = np.cumsum(kind[start] == _FIRST) - 1
    before = (ends - sizes + 1)[text]
    return number, text, start - before, end - before


class _Numbers(dict):
    """The number that _words gives a word, or an end of a text."""

    def __missing__(self, word: str) -> np.uint64:
        if len(self) > 500_000:
            self.clear()
        ends = {_START: 0, _END: 1}
        self[word] = n = _words([""])[0][ends[word]] if word in ends else _words([word])[0][1]
        return n


def _grams(numbers: np.ndarray, after: bool) -> list[np.ndarray]:
    """For each length up to SIDE: the hash of so many words that end at (before a value) or begin at (after one) each word."""
    out = [_mix(numbers, np.uint64(7 + after))]
    for k in range(1, SIDE):
        moved = np.zeros_like(numbers)
        if after:
            moved[:-k] = numbers[k:]
        else:
            moved[k:] = numbers[:-k]
        out.append(_mix(out[-1], moved))
    return out


def _value_hash(value: str) -> int:
    return _hash(" ".join(re.findall(r"\w+", value.replace("_", " ").lower())))


def _sides(text: str, start: int, end: int, last: int, following: int) -> tuple[list[str], list[str]]:
    """Up to SIDE words on each side of a marker, no further than the markers beside it; the ends of the text are words of their own."""
    low, high = max(last, start - _EDGE), min(following, end + _EDGE)
    left, right = _TOKEN.findall(text[low:start].lower()), _TOKEN.findall(text[end:high].lower())
    if low == 0:
        left = [_START, *left]
    elif low != last:
        left = left[1:]  # may be cut
    if high == len(text):
        right = [*right, _END]
    elif high != following:
        right = right[:-1]
    return left[-SIDE:], right[:SIDE]


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _frames(text: str, start: int, end: int) -> tuple[int, int, int | None]:
    """(sentence, wording, beside): hashes of a marker's sentence with figures and capital words as one slot, of that sentence as it
    stands, and of the lines before and after the marker's with their slots masked, null where the text is that line alone."""
    low = max((m.end() for m in _SENTENCE_END.finditer(text, max(0, start - 2000), start)), default=max(0, start - 2000))
    after = _SENTENCE_END.search(text, end)
    sentence = text[low:start] + " \x00 " + text[end : after.start() if after else len(text)]
    sentence = " ".join(sentence.split())
    first, last = text.rfind("\n", 0, start), text.find("\n", end)
    before = text[text.rfind("\n", 0, first) + 1 : first] if first > 0 else _START
    beyond = text[last + 1 :].split("\n", 1)[0] if last >= 0 else _END
    beside = None if (before, beyond) == (_START, _END) else _hash(_SLOT_WORDS.sub("#", before) + "\x00" + _SLOT_WORDS.sub("#", beyond))
    return _hash(_SLOT_WORDS.sub("#", sentence)), _hash(sentence), beside


def _markers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    styles = list(STYLES)
    numbers = _Numbers()
    for batch in batches:
        out = []
        for k, text in enumerate(batch.column("text").to_pylist()):
            marks = list(_MARK.finditer(text))
            for i, m in enumerate(marks):
                style, name = styles[m.lastindex - 1], m.group(m.lastindex)
                left = _WORD.findall(text[max(0, m.start() - 60) : m.start()])[-3:]
                right = _WORD.findall(text[m.end() : m.end() + 60])[:3]
                one, two = _sides(text, m.start(), m.end(), marks[i - 1].end() if i else 0, marks[i + 1].start() if i + 1 < len(marks) else len(text))
                real = sum(w[0].isalpha() for w in (*one, *two))
                place = [None] * 3
                if one and two and real >= 2:
                    n1, n2 = (np.array([numbers[w] for w in x], np.uint64) for x in (one, two))
                    before, after = _grams(n1, False)[len(one) - 1][-1:], _grams(n2, True)[len(two) - 1][:1]
                    place = [int(x.view(np.int64)[0]) for x in (before, after, _mix(before, after))]
                tag = style == "angle" and (name.lower() in _SINGLE_TAGS or f"</{name}>" in text) or style == "bracket" and text[m.end() : m.end() + 1] == "("
                firm = real >= (4 if style in _LOOSE else 2) and not tag
                variable = style in _STRICT or bool(_VARIABLE.search(name))
                out.append((k, style, name, " ".join(left).lower(), " ".join(right).lower(), variable, *place, firm, _value_hash(name), *_frames(text, m.start(), m.end())))
        cols = list(zip(*out, strict=True)) or [()] * 14
        names = ("style", "name", "before", "after")
        yield pa.RecordBatch.from_pydict(
            {c: batch.column(c).take(pa.array(cols[0], pa.int64())) for c in ("id", "copy")}
            | {n: pa.array(c, pa.string()) for n, c in zip(names, cols[1:5], strict=True)}
            | {"variable": pa.array(cols[5], pa.bool_())}
            | {n: pa.array(c, pa.int64()) for n, c in zip(("left", "right", "place"), cols[6:9], strict=True)}
            | {"firm": pa.array(cols[9], pa.bool_())}
            | {n: pa.array(c, pa.int64()) for n, c in zip(("value", "sentence", "wording", "beside"), cols[10:], strict=True)}
        )


def _filter(marks: DataFrame, column: str) -> np.ndarray:
    """A bit for each hash of the column, FILTER_BITS in all: at most FILTER_BITS / 32 rows come to the driver."""
    at = F.pmod(F.col(column), F.lit(FILTER_BITS))
    words = marks.where(F.col(column).isNotNull()).groupBy(F.shiftright(at, 5).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({column}, 32) as int))")).alias("b"))
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    got = words.toPandas()
    bits[got["w"].to_numpy(np.int64)] = got["b"].to_numpy(np.int64).astype(np.uint32)
    return bits


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def _parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts in turn, about PART characters at a time."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) + 2 > PART:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t) + 2
    if part:
        yield part


def _values(filters) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (place, value, empty): what stands in texts between the words of a marked place, and whether that is nothing."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, both = filters.value
        for batch in batches:
            found = set()
            for texts in _parts([t.lower() for t in batch.column("text").to_pylist()]):
                flat, text_of, start, end = _words(texts)
                ends = np.cumsum(np.bincount(text_of, minlength=len(texts)))
                afters = _grams(flat, True)
                for before in _grams(flat, False):
                    at = np.flatnonzero(_in(left, before))
                    for gap in range(VALUE_WORDS + 1):
                        near = at[at + gap + 1 < ends[text_of[at]]]
                        for after in afters:
                            hit = near[_in(right, after[near + gap + 1])]
                            place = _mix(before[hit], after[hit + gap + 1])
                            fits = _in(both, place)
                            for i, p in zip(hit[fits].tolist(), place[fits].view(np.int64).tolist(), strict=True):
                                value = texts[text_of[i]][end[i] : start[i + gap + 1]]
                                if len(value) <= VALUE_CHARS and not _MARK.search(value):
                                    found.add((p, _value_hash(value), not gap))
            cols = list(zip(*found, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_pydict({"place": pa.array(cols[0], pa.int64()), "value": pa.array(cols[1], pa.int64()), "empty": pa.array(cols[2], pa.bool_())})

    return scan


def _hinted(text):
    """Whether a text can hold a marker."""
    hinted = text.rlike(_HINTS)
    for word in _HINT_WORDS:
        hinted |= text.contains(word)
    return hinted


def open_slots(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, style, name, before, after): slots that kept a variable in place of a value.

    Marked names are aligned by the words on both sides, which same-template records share, with each other and with the values that
    any text has between these words. A place where the records differ is a slot. A place that holds the very same marker in each
    of two or more different records, and a value in none, is a slot where these are records of one template: where they
    fill another slot of the same sentence (figures and capital words) in different ways, or stand between the same lines, slots masked.
    Else it belongs to the words of a text that explains markers, and is no slot. A name counts where its style is one that nothing but templates use,  where the corpus marks it in two styles or more, where it looks like a variable (customer_name,
    branchName, agent.code), or where other texts have two values or more at its place, none of them the name itself, and none
    goes on there without any; places that others leave out must be the fewer ones of a name. So an editor's [sic] or [the] is none.

    A place reaches to SIDE words or numbers on each side, but not over another marker, and needs two words in all to be compared with values;
    in brackets and angles, which editors and markup use too, a name without other signs needs four. Places travel as hashes;
    filters of a fixed size, sent to the tasks, say which words of a text can be one.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("id"), F.xxhash64(f"`{text}`").alias("copy"), F.col(f"`{text}`").alias("text")).where(_hinted(F.col("text")))
    marks = rows.mapInArrow(_markers, f"id {kind}, copy long, style string, name string, before string, after string, variable boolean, left long, right long, place long, firm boolean, value long, sentence long, wording long, beside long").distinct()
    marks = cut(marks)  # the marked places only
    names = marks.groupBy("name").agg((F.max(F.col("variable").cast("int")) + F.when(F.min("style") != F.max("style"), 1).otherwise(0)).alias("signs")).where("signs > 0")
    place = marks.groupBy("before", "after").agg(
        F.when(F.min("copy") != F.max("copy"), F.lit(True)).otherwise(F.lit(False)).alias("many"),
        (F.min(F.struct("style", "name")) == F.max(F.struct("style", "name"))).alias("constant"),
    )
    # records of one template differ in the other slots of the marker's sentence, or have the same lines around it
    frames = marks.groupBy("before", "after", "sentence").agg((F.min("wording") != F.max("wording")).alias("varied")).where("varied").select("before", "after")
    beside = marks.where("beside is not null").groupBy("before", "after", "beside").agg((F.min("copy") != F.max("copy")).alias("again")).where("again").select("before", "after")
    own = place.where("many and constant").select("before", "after").join(frames.unionByName(beside), ["before", "after"], "left_anti").withColumn("own", F.lit(True))
    judged = marks.join(names.withColumn("signed", F.lit(True)), "name", "left").join(own, ["before", "after"], "left")
    judged = cut(judged.withColumn("signed", F.coalesce("signed", F.lit(False))).withColumn("own", F.coalesce("own", F.lit(False))).drop("signs", "copy", "sentence", "wording", "beside"))
    sure, doubt = judged.where("signed and not own"), judged.where("(own and signed) or (firm and not signed)")
    open_ = doubt.where("place is not null").select("left", "right", "place").distinct()
    filters = df.sparkSession.sparkContext.broadcast([_filter(open_, c) for c in ("left", "right", "place")])
    texts = df.select(F.col(f"`{text}`").alias("text")).where(F.length("text") > 0)
    values = texts.mapInArrow(_values(filters), "place long, value long, empty boolean").join(open_.select("place").distinct(), "place", "left_semi").distinct()
    values = cut(values)  # the values at marked places only
    held = F.when(~F.col("empty"), F.col("value"))
    known = values.groupBy("place").agg(F.min(held).isNotNull().alias("some"), (F.min(held) != F.max(held)).alias("differ"), F.max("empty").alias("empty"))
    met = doubt.join(known, "place")
    plain = met.where("not signed").join(values.select("place", "value"), ["place", "value"], "left_anti")
    left_out = F.sum(F.when(F.col("empty"), 1).when(F.col("differ"), -1).otherwise(0))
    slots = met.where("not signed").select("name", "place", "empty", "differ").distinct().groupBy("name").agg(left_out.alias("n")).where("n < 0")
    named = plain.where("differ and not empty").join(slots, "name", "left_semi").select(*met.columns).unionByName(met.where("signed and some"))
    columns = [F.col("id").alias(key), "style", "name", "before", "after"]
    return sure.select(*columns).unionByName(named.select(*columns))


#: White space but the blank and the line feed.
_WIDE = r"\t\x0B\f\r\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
_NARROW = ("  ", "\t", "\x0b", "\f", "\r")
#: Signs of lines that a blank or an empty line is next to.
_LOOSE_LINES = ("\n\n", " \n", "\n ")


def _figures(digit: str, letter: str) -> str:
    """A number, an amount or a date with or without a month's name."""
    number = f"[{digit}#](?:(?<!#)[{digit}]++)?"
    return rf"{number}(?:[ /.,-]{{1,2}}(?:[{letter}]+ )?{number})*"


def _skeletons(text):
    """A text's lines in lower case, with one blank for any white space and one # for a number, an amount or a date with or without a month's name."""
    ascii_ = F.length(text) == F.octet_length(text)  # most texts are; they are searched for single strings and short classes
    wide = ~ascii_ & text.rlike(f"[{_WIDE}]")
    for space in _NARROW:
        wide |= text.contains(space)
    loose = wide
    for sign in _LOOSE_LINES:
        loose |= text.contains(sign)
    low = F.lower(F.when(wide, F.regexp_replace(text, rf"[ {_WIDE}]+", " ")).otherwise(text))
    figures = F.when(ascii_, F.lit(_figures("0-9", "a-z"))).otherwise(F.lit(_figures(r"\p{N}", r"\p{L}")))
    return F.split(F.trim(F.regexp_replace(low, figures, F.lit("#"))), F.when(loose, F.lit(r" ?\n[ \n]*")).otherwise(F.lit("\n")))


def _one_of(words) -> str:
    """A pattern of whole words, by their first letters."""
    heads = sorted({w[0] for w in words})
    return "(?:" + "|".join(f"{h}(?:{'|'.join(sorted(w[1:] for w in words if w[0] == h))})" for h in heads) + ")"


_LETTER, _NO_LETTER = r"[\p{L}\p{M}]", r"[^\p{L}\p{M}]"
#: Two words of Latin filler in a row, and two equal ones of a line's first three; no filler is without one of them.
_TWO_KNOWN = f"(?:^|{_NO_LETTER}){_one_of(FILLER_WORDS)}{_NO_LETTER}+{_one_of(FILLER_WORDS)}(?:{_NO_LETTER}|$)"
_TWO_EQUAL = rf"^{_NO_LETTER}*({_LETTER}++){_NO_LETTER}+(?:\1{_NO_LETTER}|({_LETTER}++){_NO_LETTER}+(?:\1|\2){_NO_LETTER})"


def _latin(lines: pa.Array) -> pa.Array:
    """Lines of four words or more of which four fifths are Latin filler."""
    held = pc.fill_null(pc.match_substring_regex(lines, _TWO_KNOWN), False)
    some = lines.filter(held)
    words = pc.split_pattern(pc.utf8_trim(pc.replace_substring_regex(some, f"{_NO_LETTER}+", " "), " "), " ")
    n = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    known = pc.is_in(words.flatten(), value_set=pa.array(sorted(FILLER_WORDS))).to_numpy(zero_copy_only=False)
    latin = np.bincount(np.repeat(np.arange(len(n)), n), weights=known, minlength=len(n))
    out = np.zeros(len(lines), bool)
    out[np.flatnonzero(held.to_numpy(zero_copy_only=False))] = (n >= 4) & (latin >= 0.8 * n)
    return pa.array(out)


def _filler(skeleton):
    """Lines of nothing but Latin filler, or of one or two words over and over."""
    words = F.split(F.trim(F.regexp_replace(skeleton, f"{_NO_LETTER}+", " ")), " ")
    again = F.when(F.concat(skeleton, F.lit(" ")).rlike(_TWO_EQUAL), (F.size(words) >= 6) & (F.size(F.array_distinct(words)) <= 2)).otherwise(F.lit(False))
    return F.arrow_udf(_latin, "boolean")(skeleton) | again


#: Lines of four short parts or more; they don't count where a text's length is measured.
_MENU = r"(?m)^(?:[^|\n]{1,25}\|){3,}[^|\n]{1,25}$"


def _lines(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(id, source, chars, name, heading-like, menu, filler): each distinct line of each document, with digits masked."""
    body = df.where(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{key}`").alias("id"), (F.xxhash64(f"`{source}`") if source in df.columns else F.lit(0)).alias("source"), F.xxhash64(f"`{text}`").alias("copy"), F.length(F.when(F.contains(f"`{text}`", F.lit("|")), F.regexp_replace(f"`{text}`", _MENU, "")).otherwise(F.col(f"`{text}`"))).alias("chars"), F.array_distinct(_skeletons(F.col(f"`{text}`"))).alias("all"))
    body = body.select("id", "source", "copy", "chars", F.explode_outer("all").alias("s")).where("s <> ''")
    items = F.when(F.contains("s", F.lit("|")), F.size(F.split("s", r" ?\| ?"))).otherwise(1)
    head = (F.length("s") <= 60) & ~F.col("s").rlike(r"[.!?।:;]$")
    return body.select("id", "source", "copy", "chars", F.xxhash64("s").alias("name"), head.alias("head"), ((items >= 4) & (F.length("s") <= 25 * items)).alias("menu"), _filler(F.col("s")).alias("filler"))


def page_templates(df: DataFrame, key: str = "doc_id", text: str = "text", short: int = 400, share: float = 0.3, source: str = "source", line: int = 120) -> DataFrame:
    """(name, kind, documents): lines, with digits masked, that repeat over different texts.

    kind is `page` where a line stands for a whole page: of the texts that hold it, `share` or more (two of them not
    counted) have no more than `short` characters beside their menus; error messages, notices and fillers come that way, while a real
    sentence that happens to recur stands in texts of all lengths. Equal texts count once, however many keys they have, so copies of a
    document make no template; one of at most `line` characters counts once for each `source` that has it, as several
    sites come to the same line by a template only. Kind `heading` has other repeated short lines without a full stop.
    """
    return _templates(_lines(df, key, text, source), short, share, line)


def _templates(lines: DataFrame, short: int, share: float, line: int) -> DataFrame:
    once = F.when(F.col("chars") > line, F.lit(0)).otherwise(F.col("source"))
    texts = lines.where("not filler").groupBy("name", "copy", once.alias("of")).agg(F.max("chars").alias("chars"), F.max("head").alias("head"))
    seen = texts.groupBy("name").agg(F.count("*").alias("documents"), F.sum(F.when(F.col("chars") <= short, 1).otherwise(0)).alias("tiny"), F.max("head").alias("head"))
    kind = F.when(F.col("tiny") - 2 >= share * F.col("documents"), "page").when(F.col("head"), "heading")
    return seen.where("documents >= 3").select("name", kind.alias("kind"), "documents").where("kind is not null")


def empty_pages(df: DataFrame, key: str = "doc_id", text: str = "text", short: int = 400, share: float = 0.3, source: str = "source", line: int = 120) -> DataFrame:
    """(key) of the documents of which every line is a page template, filler, a heading or a menu, and at least one is not of the latter two."""
    lines = cut(_lines(df, key, text, source))  # a few numbers a line, read twice
    lines = lines.join(_templates(lines, short, share, line), "name", "left")
    bad = F.col("filler") | F.coalesce(F.col("kind") == "page", F.lit(False))
    fine = bad | F.col("menu") | F.coalesce(F.col("kind") == "heading", F.lit(False))
    return lines.groupBy("id").agg(F.bool_and(fine).alias("all"), F.bool_or(bad).alias("any")).where("all and any").select(F.col("id").alias(key))


def find_residue(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, reason): documents with an open slot (`placeholder`) or with no content but residue (`page`).

    Null and empty texts have neither. Equal texts under several keys are each reported, equal rows once; a document may have both reasons.
    """
    slots = open_slots(df, key, text).select(key, F.lit("placeholder").alias("reason"))
    return slots.unionByName(empty_pages(df, key, text).withColumn("reason", F.lit("page"))).distinct()


def drop_residue(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df` without those that find_residue lists. Rows with a null key stay."""
    return df.join(find_residue(df, key, text).select(F.col(key).alias("_residue")).distinct(), F.col(f"`{key}`") == F.col("_residue"), "left_anti")
