"""Evaluation texts leaking into training text: suffix arrays over shards of the corpus, searched with every test suffix."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.session import cut

#: Words that a verbatim match must have. Fewer would make every common turn of phrase a match; a passage with fewer words must stand there whole.
SEED = 4
#: Texts of one style share turns of phrase that may add up to half a passage. So short of SURE of its words, one stretch of STRETCH must stand there verbatim.
SURE, STRETCH = 0.65, 0.25
#: Words in a shard, for which one suffix array is built in memory.
SHARD_WORDS = 1_500_000
#: Letters of test passages that are sent to the tasks at once, so that the corpus is read once for each so many.
BLOCK_CHARS = 20_000_000
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_BREAK = re.compile(r"\\[nrtfv\"'\\/]")
# Scripts that are written without blanks: each of their characters is a word. Thai to Lao, Myanmar, Khmer, kana, Han and its compatibility forms.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W_{_UNSPACED}](?:(?![{_UNSPACED}])[\w\u0900-\u0963\u0966-\u097f\u200c\u200d])*")


def words(text: str) -> list[str]:
    """A text's words without case, punctuation, quoting, escapes and line breaks."""
    if "&" in text:
        text = html.unescape(text)
    if "\\" in text:
        text = _BREAK.sub(" ", _ESCAPE.sub(lambda m: chr(int(m[1], 16)), text))
    if "_" in text:
        text = text.replace("_", " ")
    return _WORD.findall(text.lower().replace("\u00ad", ""))


class Passages:
    """The test passages: their word numbers end to end, and their suffixes of SEED words or more in the order of a suffix array.

    Ranks are made by prefix doubling: a pair of words has the place of its two numbers among the passages' pairs, and four words the places of their two
    pairs, so a rank is never wider than 32 bits and its order is that of the words.
    """

    def __init__(self, items: list[tuple[object, str]]):
        split = [(i, w) for i, w in ((i, words(t)) for i, t in items) if w]
        self.ids = [i for i, _ in split]
        self.number = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in split for w in ws}))}
        self.sizes = np.array([len(w) for _, w in split], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.array([self.number[w] for _, ws in split for w in ws] + [0] * SEED, np.uint64)
        owner = np.repeat(np.arange(len(split)), self.sizes)
        ends = (self.starts + self.sizes)[owner] if split else np.zeros(0, np.int64)
        place = np.arange(len(owner))
        self.owner, self.ends = owner, ends
        pairs = _pairs(self.flat)
        self.pairs = np.unique(pairs[:-1][place[place + 2 <= ends]]) if len(place) else np.zeros(0, np.uint64)
        rank = self.rank(pairs)
        self.suffixes = place[place + SEED <= ends]
        self.keys = _doubled(rank, self.suffixes)
        # passages under SEED words: (words, first word or rank of the first pair, third word) by size
        self.short = {n: np.flatnonzero(self.sizes == n) for n in range(1, SEED)}
        self.short_keys = {n: self.short_key(n, self.flat, rank, self.starts[which]) for n, which in self.short.items()}

    def rank(self, pairs: np.ndarray) -> np.ndarray:
        """One more than the place of each pair among the passages' pairs, 0 for other pairs."""
        if not len(self.pairs):
            return np.zeros(len(pairs), np.uint64)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, at + 1, 0).astype(np.uint64)

    @staticmethod
    def short_key(n: int, flat: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        return flat[at] if n == 1 else rank[at] if n == 2 else (rank[at] << np.uint64(32)) | flat[at + 2]


def _pairs(numbers: np.ndarray) -> np.ndarray:
    return (numbers << np.uint64(32)) | np.append(numbers[1:], np.uint64(0))


def _doubled(rank: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (rank[at] << np.uint64(32)) | rank[at + 2]


def _shard_matches(docs: list[list[int]], test: Passages, share: float, sure: float = SURE, stretch: float = STRETCH) -> list[tuple[int, int, int, int, int]]:
    """(document, passage, words matched, longest match, word of the document where it starts) of the shard's hits."""
    sizes = np.array([len(d) + SEED for d in docs], np.int64)
    text = np.zeros(int(sizes.sum()) + SEED, np.uint64)
    begins = np.cumsum(sizes) - sizes
    for b, d in zip(begins.tolist(), docs, strict=True):
        text[b : b + len(d)] = d
    rank = test.rank(_pairs(text))
    hits = _short_matches(text, rank, begins, test)
    # the suffix array: the shard's suffixes of SEED known words or more, in the order of ranks doubled twice
    at = np.flatnonzero(rank[:-SEED])
    at = at[rank[at + 2] > 0]
    key = _doubled(rank, at)
    further = _doubled(rank, np.minimum(at + SEED, len(rank) - SEED - 1))
    order = np.lexsort((further, key))
    suffix, key = at[order], key[order]
    low, high = np.searchsorted(key, test.keys, "left"), np.searchsorted(key, test.keys, "right")
    found = high - low
    if not found.any():
        return hits
    q = np.repeat(test.suffixes, found)
    p = suffix[np.repeat(low - np.cumsum(found) + found, found) + np.arange(found.sum())]
    # longest verbatim matches: those that go on to the left are parts of others
    starts_item = q == test.starts[test.owner[q]]
    maximal = starts_item | (p == 0) | (text[np.maximum(p - 1, 0)] != test.flat[np.maximum(q - 1, 0)])
    q, p = q[maximal], p[maximal]
    length, going, limit = np.full(len(q), SEED), np.arange(len(q)), test.ends[q]
    while len(going):
        going = going[q[going] + length[going] < limit[going]]
        going = going[text[p[going] + length[going]] == test.flat[q[going] + length[going]]]
        length[going] += 1
    item, doc = test.owner[q], np.searchsorted(begins, p, "right") - 1
    # an upper bound first: all matches of a document and passage together, each with the words in line beside it that _densest may add
    reach = length.copy()
    for k in range(SEED):
        for a, b, inside in ((p + length + k, q + length + k, q + length + k < limit), (p - 1 - k, q - 1 - k, q - 1 - k >= test.starts[item])):
            inside = inside & (a >= 0) & (a < len(text))
            reach += inside & (text[np.where(inside, a, 0)] == test.flat[np.where(inside, b, 0)])
    group = doc * np.int64(len(test.ids)) + item
    order = np.lexsort((p, group))
    q, p, length, reach, item, doc, group = (x[order] for x in (q, p, length, reach, item, doc, group))
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sums = np.add.reduceat(reach, edge)
    for a in edge[sums >= share * test.sizes[item[edge]]].tolist():
        b = int(np.searchsorted(group, group[a], "right"))
        n, start = int(test.sizes[item[a]]), int(test.starts[item[a]])
        best = _densest(p[a:b], q[a:b] - start, length[a:b], n, text, test.flat[start : start + n])
        k = a + int(np.argmax(length[a:b]))
        if best >= share * n and (best >= sure * n or length[k] >= stretch * n):
            hits.append((int(doc[a]), int(item[a]), best, int(length[k]), int(p[k] - begins[doc[a]])))
    return hits


def _short_matches(text: np.ndarray, rank: np.ndarray, begins: np.ndarray, test: Passages) -> list[tuple[int, int, int, int, int]]:
    """The first place in each document of each passage that has fewer than SEED words, whole."""
    hits = []
    for n, which in test.short.items():
        if not len(which):
            continue
        order = np.argsort(test.short_keys[n], kind="stable")
        keys, which = test.short_keys[n][order], which[order]
        at = np.flatnonzero(rank[:-SEED] if n > 1 else text[:-SEED])
        key = test.short_key(n, text, rank, at)
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        found = high - low
        p = np.repeat(at, found)
        item = which[np.repeat(low - np.cumsum(found) + found, found) + np.arange(found.sum())]
        doc = np.searchsorted(begins, p, "right") - 1
        _, first = np.unique(doc * np.int64(len(test.ids)) + item, return_index=True)
        hits += [(int(doc[k]), int(item[k]), n, n, int(p[k] - begins[doc[k]])) for k in first]
    return hits


def _densest(p: np.ndarray, q: np.ndarray, length: np.ndarray, n: int, text: np.ndarray, passage: np.ndarray) -> int:
    """The most words of the passage that matches within 2n words of the document cover, a word of either counting once. Words between two replaced ones count where they stand in line with a match beside them."""
    best, j = 0, 0
    for i in range(len(p)):
        j = max(j, i)
        while j < len(p) and p[j] + length[j] - p[i] <= 2 * n:
            j += 1
        covered, used = np.zeros(n, bool), set()
        for k in range(i, j):
            covered[q[k] : q[k] + length[k]] = True
            used.update(range(p[k], p[k] + length[k]))
            for side in (range(q[k] + length[k], min(n, q[k] + length[k] + SEED)), range(q[k] - 1, max(-1, q[k] - 1 - SEED), -1)):
                for w in side:
                    at = p[k] + w - q[k]
                    if 0 <= at < len(text) and text[at] == passage[w]:
                        covered[w] = True
                        used.add(at)
        best = max(best, min(int(covered.sum()), len(used)))
        if j == len(p) or best == n:
            break
    return best


def _scanner(test: Passages, share: float, sure: float, stretch: float, types: pa.Schema):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        docs: list[list[int]] = []
        held = 0

        def emit() -> pa.RecordBatch:
            rows = _shard_matches(docs, test, share, sure, stretch)
            cols = [[ids[r[0]] for r in rows], [test.ids[r[1]] for r in rows], [r[2] for r in rows], [int(test.sizes[r[1]]) for r in rows], [r[3] for r in rows], [r[4] for r in rows]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.types, strict=True)], schema=types)

        number = test.number
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                docs.append([number.get(w, 0) for w in words(t)])
                held += len(docs[-1])
                if held >= SHARD_WORDS:
                    yield emit()
                    ids, docs, held = [], [], 0
        if docs:
            yield emit()

    return scan


def leaked_passages(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "passage", share: float = 0.5, sure: float = SURE, stretch: float = STRETCH) -> DataFrame:
    """(key, item, words_matched, passage_words, longest, at_word): documents with at least `share` of a passage's words in one place.

    Each task cuts its documents into shards of SHARD_WORDS words and builds a suffix array for each, of the suffixes that begin with
    words of the passages; every suffix of every passage is looked up by binary search, and each match of SEED words or more is extended to the longest. The matches inside
    a stretch of twice the passage's words count together, in any order, so sentences may stand in another order and single
    words be replaced (with `sure` and `stretch` as a check that it is the passage's wording and not its style, which `sure` = `share` turns off; where no SEED words in a row are left, nothing is found); longest and at_word tell the longest verbatim match and its place. The corpus is read once and never
    shuffled; passages of more than BLOCK_CHARS letters in all are taken in blocks, one after the other, each with a read of its own. Null or
    empty texts and passages match nothing; a passage under SEED words must stand in the document whole; characters of scripts without blanks
    are words; equal rows give equal results once.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    sized = items.where(F.length(F.trim(passage)) > 0).select(F.col(f"`{item}`").alias("i"), F.col(f"`{passage}`").alias("t")).distinct()
    total = sized.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // BLOCK_CHARS))
    kinds = [df.schema[key].dataType, items.schema[item].dataType]
    schema = f"{key} {kinds[0].simpleString()}, {item} {kinds[1].simpleString()}, words_matched int, passage_words int, longest int, at_word int"
    types = pa.schema([(key, to_arrow_type(kinds[0])), (item, to_arrow_type(kinds[1])), *((n, pa.int32()) for n in ("words_matched", "passage_words", "longest", "at_word"))])
    rows = df.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where(F.length("t") > 0)
    found = None
    for b in range(blocks):
        block = sized.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b).collect()  # about BLOCK_CHARS letters
        part = rows.mapInArrow(_scanner(Passages([(r["i"], r["t"]) for r in block]), share, sure, stretch, types), schema)
        part = cut(part) if blocks > 1 else part  # one block after the other, each written before the next is read
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def drop_leaked(df: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "passage", share: float = 0.5, sure: float = SURE, stretch: float = STRETCH) -> DataFrame:
    """The rows of `df` without the documents that hold a passage. Rows with a null key stay."""
    bad = leaked_passages(df, items, key, text, item, passage, share, sure, stretch).select(F.col(key).alias("_leaked")).distinct()
    return df.join(bad, F.col(f"`{key}`") == F.col("_leaked"), "left_anti")
