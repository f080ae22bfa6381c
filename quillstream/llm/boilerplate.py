"""Main content of web pages: composite text density over a page's line tree, with link weights learnt from the whole corpus."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import cut

#: A line is a type of the corpus if it stands on this share of all pages, or on this share of one host's pages, and on LEAST pages.
SHARE, HOST_SHARE, LEAST = 0.0008, 0.01, 3
#: Pages of one host that are looked at together, beside the types that stand on that host.
GROUP = 500
#: How much of a line counts as linked: labels that head a section or stand by themselves are links most of the time.
WEIGHTS = {"body": 0.0, "link": 1.0, "head": 0.98, "open": 0.98}
#: Tables and lists are sparser than prose; a section stays down to this part of the threshold.
SLACK = 0.2
_SPLIT = r"\s*[|›»>]\s*|\s+/\s+|\s{3,}"
_SPLITTER = re.compile(_SPLIT)
_BULLET = re.compile(r"^[-*•·▪–]\s+")
_TAIL = re.compile(r"\s*(?:\+|>|\(#\))$")
_DATE = re.compile(r"#(?:[/-]#){2}|# \w{3,12} #")
_DIGITS = re.compile(r"\d+")
_LETTER = re.compile(r"[^\W\d_]")
_ENDS = ".!?।:"


#: Types longer than this are known by a hash and their last sign.
LONG = 300


def _plains(lines):
    """Column: lines as types, without case, digits, bullets, and the marks that menus hang on. Two transforms, as what a lambda says twice is worked out twice."""

    def form(line):
        x = F.regexp_replace(F.trim(F.regexp_replace(F.lower(line), r"[\s\p{Z}]+", " ")), r"\p{Nd}+", "#")
        return F.regexp_replace(F.regexp_replace(x, r"^[-*•·▪–] | ?(?:\+|>|\(#\))$", ""), r"#(?:[/-]#){2}|# \p{L}{3,12} #", "#")

    return F.transform(F.transform(lines, form), lambda x: F.when(F.length(x) <= LONG, x).otherwise(F.concat(F.sha2(x, 256), F.substring(x, -1, 1))))


def plain(line: str) -> str:
    """The same for one line in a task."""
    return _short_plain(line) if len(line) <= 100 else _any_plain(line)


def _any_plain(line: str) -> str:
    x = _DIGITS.sub("#", " ".join(line.lower().split()))
    x = _DATE.sub("#", _TAIL.sub("", _BULLET.sub("", x)))
    return x if len(x) <= LONG else hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() + x[-1]


_short_plain = lru_cache(maxsize=1 << 16)(_any_plain)  # menus and notices come again on page after page


def _pages(texts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(file, text, host, title, part): each text once with what the manifest says; of several rows for a file the largest values hold. A
    host's pages fall into parts of about GROUP pages, so that no task has more of a hot host than of others."""
    host = F.lower(F.regexp_extract("url", r"^\w+://([^/:?#]+)", 1))
    about = manifest.where("text_file is not null").groupBy(F.col("text_file").alias("file")).agg(F.max(host).alias("host"), F.max("title").alias("title"))
    rows = texts.where("text_file is not null and text is not null").select(F.col("text_file").alias("file"), "text")
    files = rows.select("file").distinct().join(about, "file", "left").select("file", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("title", F.lit("")).alias("title"))
    sizes = files.groupBy(F.col("host").alias("h")).agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    placed = files.join(sizes, F.col("host") == F.col("h")).select(F.col("file").alias("f"), "host", "title", F.pmod(F.xxhash64("file"), F.col("parts")).cast("int").alias("part"))
    whole = rows.join(placed, F.col("file") == F.col("f")).withColumn("copy", F.xxhash64("text")).dropDuplicates(["file", "copy"])
    return cut(whole.select("file", "text", "host", "title", "part"))


def line_types(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(type, pages, label) and (host, type): lines, and parts of lines with separators, that are frequent in the corpus or on a host, and the
    hosts on which each stands; label tells that pages have it as title or part of one."""
    lines = F.split("text", "\n")
    parts = F.flatten(F.transform(lines, lambda x: F.when(x.rlike(_SPLIT), F.concat(F.array(x), F.split(F.trim(x), _SPLIT))).otherwise(F.array(x))))
    each = pages.select("host", F.explode(F.array_distinct(F.filter(_plains(parts), lambda x: x.rlike(r"\p{L}")))).alias("type"))
    by_host = cut(each.groupBy("type", "host").agg(F.count("*").alias("n")))
    sizes = pages.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("size"))
    whole = pages.count()
    share = by_host.join(sizes, F.col("host") == F.col("h")).groupBy("type").agg(F.sum("n").alias("pages"), F.max(F.when((F.col("n") >= LEAST) & (F.col("host") != ""), F.col("n") / F.col("size"))).alias("share"))
    often = share.where((F.col("pages") >= LEAST) & ((F.col("pages") >= SHARE * whole) | (F.col("share") >= HOST_SHARE)))
    heads = pages.where("title <> ''").select(F.explode(F.array_distinct(_plains(F.concat(F.array("title"), F.split("title", " - "))))).alias("t")).groupBy("t").count().where(F.col("count") >= 2)
    types = cut(often.join(heads, F.col("type") == F.col("t"), "left").select("type", "pages", F.col("t").isNotNull().alias("label")))
    return types, by_host.join(types.select("type"), "type", "left_semi").select("host", "type")


@lru_cache(maxsize=1 << 16)
def _is_row(line: str) -> bool:
    """A table's row: two parts or more, at least half of them a number with little beside."""
    parts = [p for p in _SPLITTER.split(line.strip()) if p]
    return len(parts) > 1 and 2 * sum(any(c.isdigit() for c in p) and len(_LETTER.findall(p)) <= 4 for p in parts) >= len(parts)


class Kinds:
    """What the corpus says of a line: `link` for furniture, `label` for what is a heading here and a link there, `body`, or nothing."""

    def __init__(self, types: list[tuple[str, str, bool]]):
        self.label = {t for t, kind, _ in types if kind == "label"}
        self.link = {t for t, kind, _ in types if kind == "link"}
        self.body = {t for t, kind, _ in types if kind == "body"}
        self.captions = {t for t, _, caption in types if caption}
        self._seen: dict[str, str] = {}

    def of(self, line: str) -> str:
        if len(line) > 100:
            return self._of(line)
        if line not in self._seen:
            if len(self._seen) > 1 << 16:
                self._seen.clear()
            self._seen[line] = self._of(line)
        return self._seen[line]

    def _of(self, line: str) -> str:
        key = plain(line)
        if key in self.label:
            return "label"
        if _is_row(line):
            return "body"
        if key in self.body:
            return "list" if "#" in key and len(key) < 90 else "body"
        if key in self.link:
            return "link"
        parts = [p for p in (plain(p) for p in _SPLITTER.split(line.strip())) if p]
        if len(parts) > 1:
            known = sum(p in self.link or p in self.label or len(p) < 3 for p in parts)
            return "link" if 2 * known >= len(parts) else "body"
        return "rare"


def _is_prose(line: str) -> bool:
    return len(line) >= 40 and not _SPLITTER.search(line.strip())


def _is_sentence(key: str) -> bool:
    return len(key) >= 40 and key[-1] in _ENDS


def _scan(pages: pa.Table, types: pa.Table) -> pa.Table:
    """Counts (type, said, follow, lines, after, near): in how many other, longer lines a type stands word for word, how often two labels
    follow it, how often it comes, how often right after prose, and how often, being a sentence, after prose or another such sentence."""
    import ahocorasick

    known = dict(zip(types["type"].to_pylist(), types["label"].to_pylist(), strict=True))
    search = ahocorasick.Automaton()
    for t, label in known.items():
        if not label and " " in t:
            search.add_word(t, t)
    search.make_automaton()
    count: Counter = Counter()
    for text in pages["text"].to_pylist():
        lines = [x for x in text.split("\n") if x.strip()]
        keys = [plain(x) for x in lines]
        good = False
        for k, key in enumerate(keys):
            label = known.get(key)
            if label is False:
                count[key, "follow"] += known.get(keys[k + 1] if k + 1 < len(keys) else "", False) and known.get(keys[k + 2] if k + 2 < len(keys) else "", False)
                count[key, "lines"] += 1
                count[key, "after"] += k > 0 and keys[k - 1] not in known and _is_prose(lines[k - 1])
                if _is_sentence(key):
                    count[key, "near"] += good
            elif label is None and len(search) and len(key) >= 50 and _is_prose(lines[k]):
                for t in {t for end, t in search.iter(key) if len(t) + 10 <= len(key) and not key[end + 1 : end + 2].isalnum() and not key[end - len(t) : end - len(t) + 1].isalnum()}:
                    count[t, "said"] += 1
            good = _is_prose(lines[k]) if label is None else label is False and _is_sentence(key)
    names = sorted({t for t, _ in count})
    return pa.table({"type": pa.array(names, pa.string())} | {c: pa.array([int(count[t, c]) for t in names], pa.int64()) for c in _COUNTS})


_COUNTS = ("said", "follow", "lines", "after", "near")


def _beside(pages: DataFrame, hosted: DataFrame, use: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """use(pages, types) for each part of a host's pages with the types that stand on this host, shuffled to one place; nothing goes through the driver."""
    parts = pages.select(F.col("host").alias("_host"), F.col("part").alias("_part")).distinct()
    types = hosted.join(parts, F.col("host") == F.col("_host")).drop("host")
    return pages.groupBy("host", "part").cogroup(types.groupBy("_host", "_part")).applyInArrow(use, schema)


def learn(pages: DataFrame) -> DataFrame:
    """(host, type, kind, caption): the corpus's line types with their link weights, on each host where they stand.

    A type is `label` as line_types has it; `body` where prose has it word for word, where it is a sentence that comes in the course of
    prose only, or an item that begins with a label and has a figure; `link` otherwise. A caption is a type that labels follow.
    """
    types, by_host = line_types(pages)
    counts = _beside(pages.select("host", "part", "text"), by_host.join(types.select("type", "label"), "type"), _scan, "type string, " + ", ".join(f"{c} long" for c in _COUNTS))
    counts = counts.groupBy(F.col("type").alias("t")).agg(*[F.sum(c).alias(c) for c in _COUNTS])
    words = F.split("type", " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda i: F.array_join(F.slice(words, 1, i), " "))
    begun = types.where("not label and type like '%#%' and type like '% %'").select("type", F.explode(heads).alias("head"))
    items = begun.join(types.where("label").select(F.col("type").alias("l")), F.col("head") == F.col("l"), "left_semi").select(F.col("type").alias("i")).distinct()
    both = types.join(counts, F.col("type") == F.col("t"), "left").join(items, F.col("type") == F.col("i"), "left")
    n = {c: F.coalesce(c, F.lit(0)) for c in _COUNTS}
    sentence = (F.length("type") >= 40) & F.substring("type", -1, 1).isin(*_ENDS)
    course = sentence & (n["lines"] > 0) & (n["after"] >= 0.2 * n["lines"]) & (n["near"] >= 0.9 * n["lines"])
    said = F.when(course, n["lines"]).otherwise(n["said"])
    spoken = (said >= F.greatest(F.when(sentence, 1.0).otherwise(2.0), 0.02 * F.col("pages"))) & F.contains("type", F.lit(" "))
    kind = F.when(F.col("label"), "label").when(F.col("i").isNotNull() | spoken, "body").otherwise("link")
    kinds = both.select("type", kind.alias("kind"), ((n["lines"] >= 2) & (n["follow"] >= 0.6 * n["lines"])).alias("caption"))
    return cut(by_host.join(kinds, "type"))


def _settle(lines: list[str], kinds: list[str], captions: set[str], title: str) -> list[str]:
    """Labels and rare lines become body or link by what stands beside them; or, where that tells nothing, `head` (of the section that follows) or `open`, for the density to decide."""
    out = list(kinds)
    keys = [plain(x) for x in lines]
    n = len(lines)
    for i, kind in enumerate(kinds):  # ends of wrapped paragraphs, single sentences
        if kind == "rare":
            if len(lines[i]) >= 40 or lines[i].rstrip()[-1:] in _ENDS or i and out[i - 1] == "body" and lines[i - 1].rstrip()[-1:] not in _ENDS:
                out[i] = "body"
    for i in range(n):
        if out[i] == "rare":
            near = [out[j] for j in (i - 1, i + 1) if 0 <= j < n]
            out[i] = "body" if any(k in ("body", "list") for k in near) and "link" not in near else "open"
    first_body = next((i for i, k in enumerate(out) if k in ("body", "list")), n)
    titles = [i for i in range(n) if title and keys[i] == title and out[i] in ("label", "link", "body", "open")]
    at = max((i for i in titles if i < first_body), default=titles[0] if titles else -1)
    if at >= 0 and (first_body < n):
        out[at] = "title"
    i = 0
    while i < n:
        if out[i] not in ("label", "title"):
            i += 1
            continue
        end = i
        while end < n and out[end] in ("label", "title", "list"):
            end += 1
        listed = any(k == "list" for k in out[i:end]) or i and out[i - 1] == "list"
        after = out[end] if end < n else "end"
        k, soon = end, False  # content behind one or two lines of furniture that head no list of links
        while k < n and k < end + 3 and out[k] == "link" and keys[k] not in captions:
            k += 1
        soon = k < n and k > end and out[k] in ("body", "list")
        caption = i > 0 and out[i - 1] == "link" and keys[i - 1] in captions
        named = next((j for j in range(i, end) if out[j] == "title"), -1)
        if named >= 0:
            for j in range(i, end):
                out[j] = "link" if j < named and out[j] == "label" else "body"
        elif listed:
            for j in range(i, end):
                out[j] = "body"
        elif caption:
            for j in range(i, end):
                out[j] = "link"
        else:
            for j in range(i, end):
                out[j] = "head" if after == "body" or soon and end - i <= 2 else "open"
        i = end
    return ["body" if k in ("list", "title") else k for k in out]


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_chars: int, page_link_chars: int) -> float:
    """Composite text density of a node: characters a tag, weighted by how little of them is linked."""
    if not chars:
        return 0.0
    base = math.log(chars / max(1, chars - link_chars) * link_chars + page_link_chars / max(1, page_chars) * chars + math.e)
    inner = chars / max(1, link_chars) * tags / max(1, link_tags)
    return chars / max(1, tags) * math.log(inner) / math.log(base) if inner > 0 and base > 1 else 0.0


def content_lines(text: str, title: str, kinds: Kinds) -> list[tuple[int, bool]]:
    """(line number, whether it is main content) of each line that is not blank.

    The page's tree has lines as leaves (each part between separators is a tag, and WEIGHTS tells how much of it is linked) and, between
    them and the page, sections: the stretches that links don't interrupt, with the labels that head them. The section of the largest density sum gives the threshold, SLACK of the least density
    on the way from it up to the page; content are the sections at or above it. What is all link has no density.
    """
    rows = [(n, x) for n, x in enumerate(text.split("\n"), 1) if x.strip()]
    lines = [x for _, x in rows]
    settled = _settle(lines, [kinds.of(x) for x in lines], kinds.captions, plain(title))
    leaf = []
    for x, kind in zip(lines, settled, strict=True):
        chars, tags = sum(map(len, x.split())), max(1, len([p for p in _SPLITTER.split(x.strip()) if p]))
        leaf.append((chars, tags, chars * WEIGHTS[kind], tags * WEIGHTS[kind]))
    sections: list[list[int]] = []
    heads: list[int] = []
    for i, kind in enumerate(settled):
        if kind == "head":
            heads.append(i)
        elif sections and settled[i - 1] == kind:
            sections[-1].append(i)
        else:
            sections.append([i])
            if kind == "body" and heads:
                sections[-1], heads = [*heads, i], []
    if heads:
        sections.append(heads)
    total = [sum(x[k] for x in leaf) for k in range(4)]
    measure = lambda own: density(*(sum(leaf[i][k] for i in own) for k in range(4)), total[0], total[2])
    sums = [sum(measure([i]) for i in s) for s in sections]
    best = max(range(len(sections)), key=sums.__getitem__, default=-1)
    content: set[int] = set()
    if best >= 0 and sums[best] > 0:
        threshold = min(measure(sections[best]), density(*total, total[0], total[2]))
        content = {i for s in sections if measure(s) >= SLACK * threshold for i in s}
    return [(n, i in content) for i, (n, _) in enumerate(rows)]


def _kinds(types: pa.Table) -> Kinds:
    return Kinds(list(zip(types["type"].to_pylist(), types["kind"].to_pylist(), types["caption"].to_pylist(), strict=True)))


def _furniture(pages: pa.Table, types: pa.Table) -> pa.Table:
    kinds, files, numbers = _kinds(types), [], []
    for file, text, title in zip(pages["file"].to_pylist(), pages["text"].to_pylist(), pages["title"].to_pylist(), strict=True):
        out = [n for n, main in content_lines(text, title, kinds) if not main]
        files += [file] * len(out)
        numbers += out
    return pa.table({"text_file": pa.array(files, pa.string()), "line_no": pa.array(numbers, pa.int32())})


def _main(pages: pa.Table, types: pa.Table) -> pa.Table:
    kinds, out = _kinds(types), []
    for text, title in zip(pages["text"].to_pylist(), pages["title"].to_pylist(), strict=True):
        lines = text.split("\n")
        out.append("\n".join(lines[n - 1] for n, main in content_lines(text, title, kinds) if main))
    return pa.table({"text_file": pages["file"], "main_text": pa.array(out, pa.string())})


def furniture_lines(texts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(text_file, line_no): each non-blank line outside its page's main content; line numbers count blank lines, from 1.

    Null and empty texts have no line; equal rows count once; a file without a manifest row is judged without title and host; a
    page of nothing but furniture has no content; of a file with several texts a line is listed once.
    """
    pages = _pages(texts, manifest)
    return _beside(pages, learn(pages), _furniture, "text_file string, line_no int").distinct()


def main_texts(texts: DataFrame, manifest: DataFrame) -> DataFrame:
    """(text_file, main_text): the main content of each stored text, line by line."""
    pages = _pages(texts, manifest)
    return _beside(pages, learn(pages), _main, "text_file string, main_text string")
