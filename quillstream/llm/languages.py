"""Language of pages and of the stretches of mixed pages: nearest of several clustered centroids by cosine over TF-IDF n-grams."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Names and ISO 639 codes of the languages that labels may name. Other maps may be given to fit_on and named_language.
LABELS = {
    "english": "English", "en": "English", "eng": "English",
    "hindi": "Hindi", "hi": "Hindi", "hin": "Hindi",
    "marathi": "Marathi", "mr": "Marathi", "mar": "Marathi",
    "indonesian": "Indonesian", "id": "Indonesian", "ind": "Indonesian",
    "filipino": "Filipino", "fil": "Filipino", "tl": "Filipino", "tgl": "Filipino",
    "mixed": "Mixed", "mul": "Mixed",
}
#: Buckets for hashed letter trigrams.
BUCKETS = 1 << 14
#: The centroids are fitted on at most so many labelled pages a language, a sample over all pages.
FIT_PAGES = 800
CENTROIDS = 3
#: A line is of no known language where its cosine to every centroid is below REJECT, or for lines of n letters below REJECT_ROOT * sqrt(n),
#: as short lines of a language are further from its centroids.
REJECT, REJECT_ROOT = 0.14, 0.016
UNKNOWN, MIXED = "Unknown", "Mixed"
#: A page with fewer letters is no case.
LEAST_LETTERS = 15


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: 2 for a letter, 1 for a sign that belongs to letters, 0 otherwise."""
    import unicodedata

    kind = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        name = unicodedata.category(chr(c))
        kind[c] = 2 if name[0] == "L" else 1 if name[0] == "M" else 0
    return kind


def _grams(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, bucket, count) of the different trigrams, and the letters of each line."""
    text = " " + "  ".join(lines).lower() + " "
    if len(text) != 2 + sum(map(len, lines)) + 2 * max(0, len(lines) - 1):  # a letter whose lower case is longer
        lines = [x.lower() for x in lines]
        text = " " + "  ".join(lines) + " "
    code = np.frombuffer(text.encode("utf-32-" + sys.byteorder[:1] + "e", "surrogatepass"), np.uint32).copy()
    kind = _letters()[code]
    sizes = np.array([len(x) + 2 for x in lines], np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(lines)), sizes)
    letters = np.bincount(owner[kind == 2], minlength=len(lines))
    code[kind == 0] = 32
    here = np.flatnonzero(code[1:-1] != 32) + 1
    bucket = ((code[here - 1] * np.uint32(0x9E3779B1)) ^ (code[here] * np.uint32(0x85EBCA77)) ^ (code[here + 1] * np.uint32(0xC2B2AE3D))) >> np.uint32(18)
    pairs, count = np.unique(owner[here] * np.int64(BUCKETS) + bucket, return_counts=True)
    assert ends[-1] == len(code)
    return pairs // BUCKETS, pairs % BUCKETS, count.astype(np.float32), letters


@dataclass
class Centroids:
    """The fitted classifier: idf by bucket, and the centroids (idf already multiplied in) with the language of each."""

    idf: np.ndarray
    weights: np.ndarray  # buckets x centroids
    language: np.ndarray
    names: tuple[str, ...]

    def cosines(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each line its cosine to the nearest centroid of each language, and its letters."""
        line, bucket, count, letters = _grams(lines)
        close = np.zeros((len(lines), len(self.names)), np.float32)
        if len(line):
            starts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))
            value = count * self.idf[bucket]
            norm = np.sqrt(np.add.reduceat(value * value, starts))
            dots = np.add.reduceat(self.weights[bucket] * count[:, None], starts) / np.maximum(norm, 1e-9)[:, None]
            for k in range(len(self.names)):
                own = self.language == k
                if own.any():
                    close[line[starts], k] = dots[:, own].max(axis=1)
        return close, letters


def languages_of(labels: dict[str, str]) -> tuple[str, ...]:
    """The languages that a map of labels names."""
    return tuple(dict.fromkeys(x for x in labels.values() if x != MIXED))


def fit(texts: list[str], labels: list[str], names: tuple[str, ...] = languages_of(LABELS), seed: int = 5) -> Centroids:
    """Centroids from labelled texts of which some labels are wrong.

    Lines are the units. The mean of each label gives a first centroid; every line then goes to the nearest mean, which
    undoes wrong labels, and the lines of each language are clustered by spherical k-means.
    """
    lines, of = [], []
    for text, label in zip(texts, labels, strict=True):
        for x in text.split("\n"):
            if len(x) >= 30:
                lines.append(x)
                of.append(names.index(label))
    label = np.array(of, np.int64)
    if not lines:
        return Centroids(np.ones(BUCKETS, np.float32), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.int64), names)
    line, bucket, count, _ = _grams(lines)
    seen = np.bincount(bucket, minlength=BUCKETS)
    idf = (np.log((1 + len(lines)) / (1 + seen)) + 1).astype(np.float32)
    value = count * idf[bucket]
    value /= np.sqrt(np.bincount(line, value * value, len(lines)))[line]

    def means(group: np.ndarray, groups: int) -> np.ndarray:
        total = np.bincount(group[line] * BUCKETS + bucket, value, groups * BUCKETS).reshape(groups, BUCKETS)
        return total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)

    def nearest(centroids: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        dots = np.stack([np.bincount(line, value * c[bucket], len(lines)) for c in centroids], axis=1)
        return (dots if allowed is None else np.where(allowed, dots, -1)).argmax(axis=1)

    for _ in range(3):
        label = nearest(means(label, len(names)))
    pick = np.random.default_rng(seed)
    cluster = label * CENTROIDS + pick.integers(0, CENTROIDS, len(lines))
    language = np.repeat(np.arange(len(names)), CENTROIDS)
    for _ in range(6):
        cluster = nearest(means(cluster, len(language)), language[None, :] == label[:, None])
    centroids = means(cluster, len(language))
    used = np.linalg.norm(centroids, axis=1) > 0
    return Centroids(idf, np.ascontiguousarray((centroids[used] * idf).T.astype(np.float32)), language[used], names)


def _labels(model: Centroids, texts: list[str | None]) -> list[list[tuple[int, int, int, float, bool]]]:
    """For each text its lines with letters as (line number, language, letters, confidence, rejected).

    The cheapest path over a text's lines: a line pays for what its cosine lacks to the best, the more the longer it is; a change
    of language costs, most of all inside a paragraph's sentence. A rejected line, too far from every centroid, pays nothing and
    takes the language of its neighbours along, for those who want no other.
    """
    rows, lines, at = [], [], []
    for k, text in enumerate(texts):
        open_ = False
        for n, x in enumerate((text or "").split("\n"), 1):
            if x and not x.isspace():
                rows.append((k, n, open_))
                lines.append(x)
                open_ = x.rstrip()[-1:] not in ".!?।:;" and len(x) > 25
            else:
                open_ = False
    out: list[list[tuple[int, int, int, float, bool]]] = [[] for _ in texts]
    if not lines or not model.names:
        return out
    close, letters = model.cosines(lines)
    best = close.max(axis=1, keepdims=True)
    known = (letters > 0) & (best[:, 0] >= np.minimum(REJECT, REJECT_ROOT * np.sqrt(letters)))
    cost = np.where(known[:, None], (best - close) * np.sqrt(np.minimum(letters, 200))[:, None], 0.0)
    owner = np.array([r[0] for r in rows])
    change = np.where(np.array([r[2] for r in rows]), 2.0, 0.5)
    first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    count = np.diff(np.append(first, len(rows)))
    order = np.argsort(-count, kind="stable")  # longest first, so that a step's texts are a prefix
    first, count = first[order], count[order]
    path = np.zeros((len(rows), len(model.names)), np.int64)
    total = cost[first].astype(np.float64)
    for step in range(1, int(count.max())):
        live = int(np.searchsorted(-count, -step, "left"))
        here = first[:live] + step
        low = total[:live].argmin(axis=1)
        moved = total[np.arange(live), low][:, None] + change[here][:, None]
        stay = total[:live] <= moved
        path[here] = np.where(stay, np.arange(len(model.names))[None, :], low[:, None])
        total[:live] = np.where(stay, total[:live], moved) + cost[here]
    chosen = np.zeros(len(rows), np.int64)
    state = total.argmin(axis=1)
    for step in range(int(count.max()) - 1, -1, -1):
        live = int(np.searchsorted(-count, -step, "left"))
        here = first[:live] + step
        chosen[here] = state[:live]
        state[:live] = path[here, state[:live]]
    own = close[np.arange(len(rows)), chosen]
    rest = close.copy()
    rest[np.arange(len(rows)), chosen] = 0
    sure = own / np.maximum(own + rest.max(axis=1), 1e-9)
    for r, c, n, s, k in zip(rows, chosen.tolist(), letters.tolist(), sure.tolist(), known.tolist(), strict=True):
        if n:
            out[r[0]].append((r[1], c, n, s, not k))
    return out


def _verdicts(found: list[tuple[int, int, int, float, bool]], names: tuple[str, ...], strict: bool) -> list[tuple[int, str, float, int]]:
    """(line number or 0, language, confidence, letters) of one text from its lines. `strict` takes rejected lines along with their
    neighbours; else stretches of them with LEAST_LETTERS letters or more are of an unknown language."""
    total = sum(n for _, _, n, _, _ in found)
    if total < LEAST_LETTERS:
        return []
    trusted = [x for x in found if not x[4]]
    if sum(x[2] for x in trusted) == 0:
        return [(0, UNKNOWN, 1.0 - sum(x[2] * x[3] for x in found) / total, total)]
    kinds = [c for _, c, _, _, _ in found]
    if not strict:
        k = 0
        while k < len(found):
            end = k
            while end < len(found) and found[end][4]:
                end += 1
            if sum(x[2] for x in found[k:end]) >= LEAST_LETTERS:
                kinds[k:end] = [-1] * (end - k)
            k = max(end, k + 1)
    runs: list[list] = []
    for (line, _, n, sure, _), c in zip(found, kinds, strict=True):
        if not runs or runs[-1][1] != c:
            runs.append([line, c, 0, 0.0])
        runs[-1][2] += n
        runs[-1][3] += n * (sure if c >= 0 else 1 - sure)
    languages = {r[1] for r in runs} - {-1}
    whole = MIXED if len(languages) > 1 else names[languages.pop()] if languages else UNKNOWN
    out = [(0, whole, sum(r[3] for r in runs if r[1] >= 0 or whole == UNKNOWN) / max(1, sum(r[2] for r in runs if r[1] >= 0 or whole == UNKNOWN)), total)]
    if len({r[1] for r in runs}) > 1:
        out += [(r[0], names[r[1]] if r[1] >= 0 else UNKNOWN, r[3] / r[2], r[2]) for r in runs]
    return out


def _assigner(model: Centroids, strict: bool):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pa.table(whole).to_batches(max_chunksize=1000):
                ids, rows = batch.column("id"), []
                for k, found in enumerate(_labels(model, batch.column("text").to_pylist())):
                    rows += [(k, *v) for v in _verdicts(found, model.names, strict)]
                cols = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.float64()), pa.array(cols[4], pa.int32())],
                    names=["id", "line_no", "lang", "confidence", "letters"],
                )

    return assign


def named_language(label, labels: dict[str, str] = LABELS):
    """The language that a label names, `Mixed` for several, null where it names none."""
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return known[F.lower(F.trim(F.regexp_replace(label, r"[\s\p{Z}]+", " ")))]


def fit_on(df: DataFrame, text: str = "text", label: str = "language", pages: int = FIT_PAGES, labels: dict[str, str] = LABELS) -> Centroids:
    """Centroids from a sample of at most `pages` labelled rows a language, drawn over all rows of `df`. `labels` maps what labels say,
    in lower case, to languages; the languages are those it names."""
    names = languages_of(labels)
    rows = df.select(F.col(f"`{text}`").alias("text"), named_language(F.col(f"`{label}`"), labels).alias("label")).where(F.col("label").isin(*names) & (F.length("text") >= 100))
    total = rows.count()
    wanted = 40 * pages * len(names)
    rows = rows.sample(fraction=wanted / total, seed=11) if total > wanted else rows
    rows = rows.withColumn("r", F.xxhash64("text")).withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("r", "text"))).where(F.col("n") <= pages)
    sample = rows.select("text", "label").collect()  # at most `pages` rows a language
    return fit([r["text"] for r in sample], [r["label"] for r in sample], names)


def assign_languages(df: DataFrame, model: Centroids, key: str = "page_id", text: str = "text") -> DataFrame:
    """(key, line_no, lang, confidence, letters): for line_no 0 each row's language, `Mixed` where it has several, `Unknown` where every
    line is rejected; and for a row of several languages, or with an unknown stretch, each maximal run of lines in one language,
    line_no being its first line. A row of one language and unknown stretches has that language.

    confidence is the cosine to the language's nearest centroid against the best of the others (0.5 to 1 where it is the nearest),
    averaged over letters; for `Unknown` it is what is left of 1. Texts with fewer than LEAST_LETTERS letters, empty and null ones have no row; a line without letters
    belongs to no run and ends none. Rows are judged on their own, without a shuffle; equal rows are judged each.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(_assigner(model, False), f"id {kind}, line_no int, lang string, confidence double, letters int").withColumnRenamed("id", key)


def wrong_labels(df: DataFrame, key: str = "page_id", text: str = "text", label: str = "language", labels: dict[str, str] = LABELS) -> DataFrame:
    """(key, line_no, lang, confidence): rows whose label names no language or a wrong one, with the right one at line_no 0, and the
    runs of all mixed rows. Rows of which every line is rejected have no right label to give and no row; other rejected lines,
    as codes in a page's prose, belong to the run around them."""
    model = fit_on(df, text, label, labels=labels)
    kind = df.schema[key].dataType.simpleString()
    packed = df.select(F.struct(F.col(f"`{key}`").alias("key"), named_language(F.col(f"`{label}`"), labels).alias("said")).alias("id"), F.col(f"`{text}`").alias("text"))
    found = packed.mapInArrow(_assigner(model, True), f"id struct<key: {kind}, said: string>, line_no int, lang string, confidence double, letters int")
    found = found.where(F.col("lang") != UNKNOWN)
    case = (F.col("line_no") > 0) | ~F.col("id.said").eqNullSafe(F.col("lang"))
    return found.where(case).select(F.col("id.key").alias(key), "line_no", "lang", "confidence")
