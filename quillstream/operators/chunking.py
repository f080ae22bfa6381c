"""Token-aware chunks of pages with overlap between neighbours."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens a chunk should have, tokens carried over, tokens it may have at most, and the tokens that a model adds to every text.
TARGET, OVERLAP, LIMIT, SPECIAL = 200, 50, 220, 2
_SENTENCE = re.compile(r"(?<=[.!?।])\s+")
_BLANKS = re.compile(r"[ \t]+")
_GAPS = re.compile(r"\n{3,}")


class WordTokens:
    """The default tokenizer: words and single marks. Anything with encode and decode can take its place."""

    _token = re.compile(r"\w+|[^\w\s]")

    def encode(self, text: str) -> list[str]:
        return self._token.findall(text)

    def decode(self, tokens: list[str]) -> str:
        return " ".join(tokens)


def chunks(text: str, tokens: WordTokens, target: int = TARGET, overlap: int = OVERLAP, limit: int = LIMIT) -> list[tuple[str, int]]:
    """(chunk, tokens with specials) of one page.

    Units are paragraphs, or the lines of a paragraph over the target, or the sentences of such a line; a unit over the limit is
    cut into windows of tokens. Units are packed with an empty line between up to the target. A new chunk begins with the last
    units of the one before, as far as their tokens stay within the overlap; if that and the next unit pass the target, with the
    last `overlap` tokens instead, and if that does too, with nothing.
    """
    plain = _GAPS.sub("\n\n", _BLANKS.sub(" ", text.replace("\r\n", "\n").replace("\r", "\n"))).strip()
    if not plain:
        return []
    size = lambda t: len(tokens.encode(t)) + SPECIAL
    room = limit - SPECIAL

    def windows(t: str) -> Iterator[str]:
        ids = tokens.encode(t)
        for at in range(0, max(1, len(ids)), room - overlap):
            yield tokens.decode(ids[at : at + room])
            if at + room >= len(ids):
                return

    def parts(t: str, level: int) -> Iterator[str]:
        if size(t) <= target or level == 3:
            yield from [t] if size(t) <= limit else windows(t)
        else:
            for p in t.split("\n\n") if level == 0 else t.split("\n") if level == 1 else _SENTENCE.split(t):
                if p.strip():
                    yield from parts(p.strip(), level + 1)

    out: list[str] = []
    pack: list[str] = []  # the units of the open chunk, without what was carried over
    open_ = ""
    for unit in parts(plain, 0):
        joined = f"{open_}\n\n{unit}" if open_ else unit
        if not open_ or size(joined) <= target:
            open_ = joined
            pack.append(unit)
            continue
        out.append(open_)
        carried: list[str] = []
        held = 0
        for u in reversed(pack):
            if held + size(u) > overlap:
                break
            held += size(u)
            carried.insert(0, u)
        start = "\n\n".join([*carried, unit])
        if size(start) > target:
            start = tokens.decode(tokens.encode(open_)[-overlap:]) + "\n\n" + unit
        open_ = start if size(start) <= target else unit
        pack = [unit]
    if open_:
        out.append(open_)
    final: list[str] = []
    for c in out:
        final += [c] if size(c) <= limit else list(windows(c))
    return [(c, size(c)) for c in final]


def chunk_pages(df: DataFrame, key: str = "page_id", text: str = "text", tokenizer: Callable[[], WordTokens] = WordTokens, target: int = TARGET, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """(key, chunk_index, chunk_token_count, text): the chunks of each row. `tokenizer` makes the tokenizer, once a task. Null and blank texts have no chunk."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer()
        for batch in batches:
            rows = [(k, i, n, c) for k, t in enumerate(batch.column("text").to_pylist()) for i, (c, n) in enumerate(chunks(t or "", own, target, overlap, limit))]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.string())],
                names=["id", "chunk_index", "chunk_token_count", "text"],
            )

    rows = df.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, chunk_index int, chunk_token_count int, text string").withColumnRenamed("id", key)


def chunk_records(chunked: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Chunks with what their page says, an id each, and the hash of their text."""
    about = pages.select(key, "source_id", "page_number", "citation", "title", "authority", "document_type", "language", "section", "content_type", "pii_status").dropDuplicates([key])
    number = F.when(F.col("page_number").isNotNull(), F.concat(F.lit("-p"), F.col("page_number").cast("string"))).otherwise(F.lit("-web"))
    joined = chunked.join(about, key)
    return joined.withColumn("chunk_id", F.concat("source_id", number, F.lit("-c"), F.col("chunk_index").cast("string"))).withColumn("text_hash", F.sha2("text", 256)).withColumn("chunk_length", F.length("text"))
