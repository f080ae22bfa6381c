"""Vectors: norms, exact top-k by cosine in blocks of queries, and an inverted-file index with measured recall."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillstream.session import cut

#: Queries in a block, which each task holds as one matrix.
BLOCK = 2048


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def norm_check(df: DataFrame, key: str = "vec_id", vector: str = "embedding", tolerance: float = 1e-3) -> DataFrame:
    """(key, dimensions, norm, unit): the length of each vector and whether it is one within the tolerance."""
    size = norm(F.col(vector))
    return df.select(key, F.size(vector).alias("dimensions"), F.round(size, 4).alias("norm"), (F.abs(size - 1) <= tolerance).alias("unit"))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return np.asarray(column.flatten(), np.float32).reshape(rows, -1).astype(np.float64) if rows else np.zeros((0, 0))


def _scorer(ids: np.ndarray, block: np.ndarray, k: int):
    """Each task keeps the k best rows it has seen for every query of the block."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_s, best_i = np.full((len(ids), 0), -np.inf), np.zeros((len(ids), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1))
            rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
            own = np.broadcast_to(np.asarray(batch.column(0), np.int64), (len(ids), batch.num_rows))
            s, i = np.concatenate([best_s, block @ rows.T], axis=1), np.concatenate([best_i, own], axis=1)
            order = np.lexsort((i, -np.round(s, 6)), axis=1)[:, :k]
            best_s, best_i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        m = best_s.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, m)), pa.array(best_i.ravel()), pa.array(best_s.ravel())], names=["query_id", "hit", "score"])

    return score


def _by_blocks(wanted: DataFrame, search: Callable[[np.ndarray, np.ndarray], DataFrame]) -> DataFrame:
    """search(ids, unit vectors) for each block of about BLOCK of the queries (q, v); with several blocks each result is written before the next block is read."""
    n = wanted.count()
    blocks = max(1, -(-n // BLOCK))
    found = None
    for b in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).orderBy("q").collect()  # about BLOCK rows
        block = np.array([r["v"] for r in rows], np.float64) if rows else np.zeros((0, 1))
        block = block / np.maximum(np.linalg.norm(block, axis=1, keepdims=True), 1e-12)
        part = search(np.array([r["q"] for r in rows], np.int64), block)
        part = cut(part) if blocks > 1 else part
        found = part if found is None else found.unionByName(part)
    return found


def top_k(corpus: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, hit, score): for each query the k rows of the corpus with the largest cosine; ties in its first six places go to the smaller key.

    Queries are taken in blocks of BLOCK, one block after the other; each task multiplies its rows with a block and keeps k a query, and
    only those are shuffled. Null and empty vectors are left out on both sides.
    """
    if not 1 <= k:
        raise ValueError("k must be at least 1")
    usable = corpus.where(F.size(vector) > 0).select(F.col(key).cast("long"), F.col(vector))
    wanted = queries.where(F.size(vector) > 0).select(F.col(key).cast("long").alias("q"), F.col(vector).alias("v")).dropDuplicates(["q"])
    found = _by_blocks(wanted, lambda ids, block: usable.mapInArrow(_scorer(ids, block, k), "query_id long, hit long, score double"))
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 6)), "hit")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "hit", F.round("score", 4).alias("score"))


def checked_requests(requests: DataFrame, query: str = "query", k: str = "top_k", most: int = 10, usual: int = 5) -> DataFrame:
    """`requests` with the query trimmed, top_k (`usual` where none is given) and problem: empty_query, top_k_out_of_range or null."""
    wanted = F.coalesce(F.col(k), F.lit(usual))
    text = F.trim(F.regexp_replace(F.coalesce(F.col(query), F.lit("")), r"^\s+|\s+$", ""))
    problem = F.when(text == "", "empty_query").when((wanted < 1) | (wanted > most), "top_k_out_of_range")
    return requests.withColumn(query, text).withColumn(k, wanted).withColumn("problem", problem)


def evaluation_rows(hits: DataFrame, payload: DataFrame, expected: DataFrame, key: str = "vec_id", category: str = "label") -> DataFrame:
    """(query_id, rank, score, hit, category, expected, right): each hit with its payload's category and whether it is the query's own; hits without payload stay, with nulls."""
    about = payload.select(F.col(key).alias("_h"), F.col(category).alias("category"))
    wanted = expected.select(F.col(key).alias("_q"), F.col(category).alias("expected"))
    joined = hits.join(about, F.col("hit") == F.col("_h"), "left").join(wanted, F.col("query_id") == F.col("_q"), "left")
    return joined.select("query_id", "rank", "score", "hit", "category", "expected", F.coalesce(F.col("category") == F.col("expected"), F.lit(False)).alias("right"))


def inverted_file(corpus: DataFrame, cells: int | None = None, sample: int = 100_000, seed: int = 3, vector: str = "embedding") -> np.ndarray:
    """Cell centres fitted by k-means on a random sample of about `sample` rows. There are about sqrt(n) cells unless told otherwise, but no
    more than a 20th of the sample, so that what tasks are sent has a bound."""
    rows = corpus.where(F.size(vector) > 0)
    n = rows.count()
    if not n:
        return np.zeros((0, 0))
    cells = cells or min(int(np.sqrt(n)), sample // 20)
    fit = rows.sample(fraction=sample / n, seed=seed) if n > sample else rows
    model = KMeans(k=max(1, min(cells, n)), seed=seed, maxIter=10, distanceMeasure="cosine").fit(fit.select(array_to_vector(vector).alias("features")))
    centres = np.array(model.clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def assign_cells(corpus: DataFrame, centres: np.ndarray, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, vector, cell): every usable row with its nearest centre. Written partitioned by cell this is the index: a search then reads the cells it probes."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = (_matrix(batch.column(1)) @ centres.T).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell)], names=["id", "vector", "cell"])

    usable = corpus.where(F.size(vector) > 0).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    return usable.mapInArrow(assign, f"id long, vector {corpus.schema[vector].dataType.simpleString()}, cell int")


def _cell_scorer(ids: np.ndarray, block: np.ndarray, probed: np.ndarray, k: int):
    """Like _scorer, but rows of a cell meet only the queries that probe it, as one product of matrices a cell."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_s, best_i = np.full((len(ids), k), -np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
        for batch in batches:
            if not batch.num_rows:
                continue
            own, cell, rows = np.asarray(batch.column(0), np.int64), np.asarray(batch.column(2)), _matrix(batch.column(1))
            rows = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)
            for c in np.unique(cell):
                asked, at = np.flatnonzero(probed[:, c]), np.flatnonzero(cell == c)
                if len(asked):
                    s = np.concatenate([best_s[asked], block[asked] @ rows[at].T], axis=1)
                    i = np.concatenate([best_i[asked], np.broadcast_to(own[at], (len(asked), len(at)))], axis=1)
                    order = np.lexsort((i, -np.round(s, 6)), axis=1)[:, :k]
                    best_s[asked], best_i[asked] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
        q, r = np.nonzero(np.isfinite(best_s))
        yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(best_i[q, r]), pa.array(best_s[q, r])], names=["query_id", "hit", "score"])

    return score


def indexed_top_k(index: DataFrame, queries: DataFrame, centres: np.ndarray, k: int = 5, probes: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, hit, score) like top_k, but each query meets only the rows of `index` (assign_cells) in its `probes` nearest cells; cells that no query of a block probes aren't read."""
    wanted = queries.where(F.size(vector) > 0).select(F.col(key).cast("long").alias("q"), F.col(vector).alias("v")).dropDuplicates(["q"])

    def search(ids: np.ndarray, block: np.ndarray) -> DataFrame:
        probed = np.zeros((len(ids), len(centres)), bool)
        if len(ids) and len(centres):
            np.put_along_axis(probed, np.argsort(-(block @ centres.T), axis=1, kind="stable")[:, :probes], True, axis=1)
        read = np.flatnonzero(probed.any(axis=0)).tolist()
        rows = index if len(read) == len(centres) else index.where(F.col("cell").isin(read))
        return rows.select("id", "vector", "cell").mapInArrow(_cell_scorer(ids, block, probed, k), "query_id long, hit long, score double")

    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 6)), "hit")
    return _by_blocks(wanted, search).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "hit", F.round("score", 4).alias("score"))


def tuned_probes(corpus: DataFrame, index: DataFrame, centres: np.ndarray, k: int = 5, target: float = 0.95, asked: int = 200, key: str = "vec_id", vector: str = "embedding") -> int:
    """The least number of cells, doubled or so from one, at which about `asked` rows of the corpus find `target` of their exact neighbours; all cells reach it by themselves."""
    n = corpus.count()
    sample = cut(corpus.where(F.pmod(F.xxhash64(key), F.lit(max(1, n // asked))) == 0).select(key, vector))
    exact = cut(top_k(corpus, sample, k, key, vector))
    probes = 1
    while probes < len(centres):
        if (recall(indexed_top_k(index, sample, centres, k, probes, key, vector), exact).first()["recall"] or 1.0) >= target:
            return probes
        probes = max(probes + 1, int(probes * 1.5))
    return len(centres)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(recall): the share of the exact hits that were found."""
    return exact.select("query_id", "hit").join(found.select("query_id", "hit", F.lit(1).alias("f")), ["query_id", "hit"], "left").agg(F.avg(F.coalesce("f", F.lit(0))).alias("recall"))
