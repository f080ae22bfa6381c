"""Splitting oversized texts at natural boundaries: greedy cuts by pointer doubling."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: From coarse to fine. `whole` is a text that fits as it is.
KINDS = ("whole", "paragraph", "line", "sentence", "word", "none")
_PARAGRAPH, _LINE, _SENTENCE, _WORD, _NONE = range(1, 6)
_SENTENCE_END = re.compile(r"(?<=[.!?।])\s+")
_BLANK = re.compile(r"[ \t]*\Z")


def _pieces_between(text: str, start: int, end: int, gap: re.Pattern) -> list[tuple[int, int]]:
    """The spans of text[start:end] between the matches of `gap`, without empty ones."""
    spans, at = [], start
    for m in gap.finditer(text, start, end):
        if m.start() > at:
            spans.append((at, m.start()))
        at = m.end()
    return spans + ([(at, end)] if end > at else [])


_SPACE = re.compile(r"\s+")


def units(text: str, limit: int, step: int) -> list[tuple[int, int, int]]:
    """(start, end, kind of the boundary before it): paragraphs, and inside a paragraph over the limit its lines, and so on down to stretches of `step` characters."""
    out: list[tuple[int, int, int]] = []

    def add(start: int, end: int, before: int, inside: int) -> None:
        if end - start <= limit:
            out.append((start, end, before))
        elif inside == _NONE:
            out.extend((a, min(a + step, end), before if a == start else _NONE) for a in range(start, end, step))
        else:
            spans = lines_of[start] if inside == _LINE else _pieces_between(text, start, end, _SENTENCE_END if inside == _SENTENCE else _SPACE)
            for k, (a, b) in enumerate(spans):
                add(a, b, inside if k else before, inside + 1)

    paragraphs: list[list[tuple[int, int]]] = [[]]
    at = 0
    for line in text.split("\n"):
        if _BLANK.match(line):
            paragraphs.append([])
        else:
            paragraphs[-1].append((at, at + len(line)))
        at += len(line) + 1
    lines_of = {p[0][0]: p for p in paragraphs if p}
    for p in paragraphs:
        if p:
            add(p[0][0], p[-1][1], _PARAGRAPH, _LINE)
    return out


def greedy_cuts(starts: np.ndarray, ends: np.ndarray, page: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """(first unit, unit after the last) of every greedy piece of all pages at once.

    Each boundary is joined to its farthest legal successor: the piece from unit i may take units up to j where its new text,
    from the end of unit i-1 on, and the whole overlap fit the limit; failing that, where the new text alone fits. Then the
    successor table is squared again and again, and what is marked is carried along: after r rounds all cuts within 2**r pieces
    of a page's start are marked.
    """
    n = len(starts)
    far = np.int64(max(int(ends.max(initial=0)), limit) * 2 + 2 * limit + 2)
    s, e = starts + page * far, ends + page * far
    lead = np.ones(n, bool)
    lead[1:] = page[1:] != page[:-1]
    last = np.searchsorted(page, page, side="right")
    from_ = np.where(lead, s, np.concatenate((s[:1], e[:-1])))
    with_overlap = np.minimum(np.searchsorted(e, from_ + limit - np.where(lead, 0, overlap), side="right"), last)
    alone = np.minimum(np.searchsorted(e, s + limit, side="right"), last)
    here = np.arange(n)
    follows = np.where(with_overlap > here, with_overlap, alone)
    jump = np.where(follows < last, follows, here)  # the last piece's boundary points to itself
    marked = lead.copy()
    while True:
        reached = marked.copy()
        reached[jump[marked]] = True
        if np.array_equal(reached, marked):
            break
        marked, jump = reached, jump[jump]
    cuts = np.flatnonzero(marked)
    return cuts, follows[cuts]


def _splitter(limit: int, overlap: int, with_text: bool):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pa.table(batch).to_batches(max_chunksize=2000):
                yield from _split_batch(part, limit, overlap, with_text)

    return split


def _split_batch(batch: pa.RecordBatch, limit: int, overlap: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    texts = batch.column("text").to_pylist()
    rows: list[tuple] = []  # (row of the batch, piece, start, end, start of its new text, kind of the cut before)
    table, owner = [], []
    for k, text in enumerate(texts):
        if text is None:
            continue
        if len(text) <= limit:
            rows.append((k, 1, 0, len(text), 0, 0))
        else:
            found = units(text, limit, limit - overlap)
            table += found
            owner += [k] * len(found)
    if table:
        spans = np.array(table, dtype=np.int64)
        page = np.array(owner, dtype=np.int64)
        first, after = greedy_cuts(spans[:, 0], spans[:, 1], page, limit, overlap)
        piece, of = 0, -1
        for i, j in zip(first.tolist(), after.tolist(), strict=True):
            piece, of = (piece + 1, of) if of == owner[i] else (1, owner[i])
            start, end = table[i][0], table[j - 1][1]
            begin = start
            if piece > 1:
                back = table[i - 1][1]
                begin = max(back - overlap, end - limit)
                if begin >= back:
                    begin = start
                elif not texts[of][begin - 1].isspace() and (gap := _SPACE.search(texts[of], begin, back)):
                    begin = gap.end()
            rows.append((of, piece, begin, end, start, table[i][2] if piece > 1 else 0))
    rows.sort(key=lambda r: r[:2])
    cols = list(zip(*rows, strict=True)) or [()] * 6
    ids = batch.column("id").take(pa.array(cols[0], pa.int64()))
    out = {"id": ids} | {n: pa.array(c, pa.int32()) for n, c in zip(("piece_no", "start", "end", "new_from"), cols[1:5], strict=True)}
    out["cut"] = pa.array([KINDS[c] for c in cols[5]], pa.string())
    if with_text:
        out["text"] = pa.array([texts[r[0]][r[2] : r[3]] for r in rows], pa.string())
    yield from pa.table(out).combine_chunks().to_batches()


def split_texts(df: DataFrame, key: str = "page_id", text: str = "text", limit: int = 1200, overlap: int = 150, with_text: bool = True) -> DataFrame:
    """(key, piece_no, start, end, new_from, cut[, text]): the pieces of each row's text.

    Every piece has at most `limit` code points; its own part runs from new_from to end, and before it stand up to `overlap`
    code points from the end of the piece before, from a word's start where there is one. A cut lies between paragraphs; only
    a paragraph over the limit is cut between its lines, a line over it between sentences, a sentence between words, a word
    anywhere. `cut` names the kind of the boundary before the piece (`whole` for first pieces). White space between pieces
    belongs to none of them unless the overlap holds it. Rows are independent and never shuffled. A null text gives no piece,
    a text within the limit one piece, also if it is empty; a longer text of nothing but blanks gives none. A null key stays
    null and equal rows are split each on their own. Other columns of `df` are left out.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and smaller than limit")
    kind = df.schema[key].dataType.simpleString()
    schema = f"id {kind}, piece_no int, start int, end int, new_from int, cut string" + ", text string" * with_text
    return df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text")).mapInArrow(_splitter(limit, overlap, with_text), schema).withColumnRenamed("id", key)


def boundary_kinds(df: DataFrame, key: str = "page_id", text: str = "text", limit: int = 1200, overlap: int = 150) -> DataFrame:
    """(key, boundary) of each text over the limit: the finest boundary at which the splitter had to cut it, as a unit over the
    limit can't lie in one piece and is cut inside only. A text of `limit` blanks or more has no unit and no row."""
    pieces = split_texts(df.where(F.length(text) > limit), key, text, limit, overlap, with_text=False)
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("cut"))
    worst = pieces.groupBy(key).agg(F.max(rank).alias("worst"))
    return worst.select(key, F.element_at(F.array(*map(F.lit, KINDS)), F.col("worst").cast("int")).alias("boundary"))
