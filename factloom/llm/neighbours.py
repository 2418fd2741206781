"""Nearest neighbours by additive quantisation, with exact reranking.

A unit vector is the sum of one entry from each of several full-dimensional
codebooks, learnt stage by stage on residuals; beam search picks the entries.
An index row keeps its codes and the norm of the sum. Queries go past the index
in waves of bounded size: a table of the query's products with all entries gives
each row's estimated cosine by lookups, rows within a margin of the best estimates
are candidates, and candidates are scored exactly on the original vectors. A task
keeps the best few of each query, so what is shuffled grows with the queries alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, small_or_shuffled


@dataclass
class AdditiveQuantiser:
    """``books``: stages x entries x dimensions; ``error``: root mean square of what codes miss."""

    books: np.ndarray
    beam: int
    error: float = 0.0

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x stages, bytes) and the sums they stand for."""
        n, stages = len(unit), len(self.books)
        rest, codes = unit[:, None, :], np.zeros((n, 1, 0), np.uint8)
        for book in self.books:
            cost = (book * book).sum(axis=1) - 2 * (rest @ book.T) + (rest * rest).sum(axis=2, keepdims=True)
            flat = cost.reshape(n, -1)
            keep = min(self.beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            best = np.take_along_axis(best, np.argsort(np.take_along_axis(flat, best, axis=1), axis=1), axis=1)
            origin, entry = best // len(book), best % len(book)
            rest = np.take_along_axis(rest, origin[:, :, None], axis=1) - book[entry]
            codes = np.concatenate([np.take_along_axis(codes, origin[:, :, None], axis=1), entry[:, :, None].astype(np.uint8)], axis=2)
        return codes[:, 0].reshape(n, stages), unit - rest[:, 0]


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors.astype(np.float64), axis=1, keepdims=True)).astype(np.float32)


def fit_quantiser(unit: np.ndarray, stages: int = 12, entries: int = 256, beam: int = 4, rounds: int = 8, seed: int = 11) -> AdditiveQuantiser:
    """Learn one codebook after another by k-means on what the earlier ones leave."""
    rng, books, rest = np.random.default_rng(seed), [], unit.astype(np.float32)
    for _ in range(stages):
        book = rest[rng.choice(len(rest), entries, replace=len(rest) < entries)].copy()
        for _ in range(rounds):
            near = np.argmin((book * book).sum(axis=1) - 2 * rest @ book.T, axis=1)
            count = np.bincount(near, minlength=entries)
            total = np.zeros_like(book)
            np.add.at(total, near, rest)
            book = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], book)
        books.append(book)
        rest = rest - book[np.argmin((book * book).sum(axis=1) - 2 * rest @ book.T, axis=1)]
    model = AdditiveQuantiser(np.stack(books), beam)
    _, sums = model.encode(unit)
    model.error = float(np.sqrt(((unit - sums) ** 2).sum(axis=1).mean()))
    return model


def takes_part(vector: str) -> Column:
    """Not null, not empty, all components there and finite, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)


def one_row_each(rows: DataFrame) -> DataFrame:
    """Rows (id, v, asks) with one row for each id: of repeated ids the smallest vector, asking if any row asks."""
    repeated = settle(rows.groupBy("id").count().where("count > 1").select("id"))
    n = repeated.count()
    if not n:
        return rows
    marks = small_or_shuffled(repeated, n * 16)
    merged = rows.join(marks, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v"), F.bool_or("asks").alias("asks"))
    return rows.join(marks, "id", "left_anti").unionByName(merged)


def best_of(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each query: largest score, then smallest id."""
    order = np.lexsort((vec, -score, query))
    q = query[order]
    first = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    return order[rank < k]


def nearest(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", sample: int = 8192, block: int = 4096, query_block: int = 16384, margin: float = 4.0) -> DataFrame:
    """The ``k`` rows of largest cosine for every row where ``queries`` holds: query_id, rank, vec_id, score.

    Scores are cosines of the original vectors in double precision; ties go to
    the smaller id; rows with the query's own id are no candidates. The index
    holds every row; ``sample`` (those of the smallest id hashes) only bounds
    what the codebooks are learnt on. A candidate is any row of a block whose
    estimate is within ``margin`` standard errors of the k-th best there, so a
    crowd of like vectors is scored exactly, however large. ``query_block`` queries
    at a time (fewer, if they are over 16 MB) are sent to all tasks.

    Rows whose id is null or whose vector is null, empty, zero or holds null or
    non-finite components take no part. Vectors are compared with those of their
    own length, each length with codebooks of its own. Rows that repeat an id
    count once, with the smallest of its vectors (as arrays are ordered), as a
    query and as a candidate. Fewer candidates than k give fewer rows, an empty
    table none. Other columns are not read.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")).where(F.col("id").isNotNull() & takes_part("v"))
    rows = one_row_each(rows)
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count_if("asks").alias("q")).where("q > 0").orderBy("d").collect()
    found = [_nearest(rows.where(F.size("v") == r["d"]), r["d"], r["q"], k, sample, block, query_block, margin) for r in lengths]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(rows: DataFrame, dims: int, asked: int, k: int, sample: int, block: int, query_block: int, margin: float) -> DataFrame:
    """(query_id, vec_id, score): the k best of each task, for vectors of one length."""
    spark = rows.sparkSession
    learnt = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    model = fit_quantiser(unit_rows(np.stack(learnt["v"].to_numpy())))
    sent = spark.sparkContext.broadcast(model)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                vectors = np.stack(part["v"].to_numpy()).astype(np.float32)
                codes, sums = sent.value.encode(unit_rows(vectors))
                norms = np.linalg.norm(sums, axis=1).astype(np.float32)
                yield pd.DataFrame({"id": part["id"], "asks": part["asks"], "v": [x.tobytes() for x in vectors], "codes": [x.tobytes() for x in codes], "norm": norms})

    indexed = settle(rows.select("id", "v", "asks").mapInPandas(index, "id long, asks boolean, v binary, codes binary, norm float"))
    waves = ceil(asked / max(1, min(query_block, (1 << 24) // (4 * dims))))
    wave = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(waves)).cast("int")
    # As many tasks as run at once: what they return is k rows for each query and task.
    stored = indexed.select("id", "codes", "norm", "v").coalesce(max(1, spark.sparkContext.defaultParallelism))
    out = []
    for w in range(waves):
        own = indexed.where(F.col("asks") & (wave == w)).select("id", "v").toPandas()
        if len(own):
            out.append(stored.mapInPandas(_searched(sent, spark.sparkContext.broadcast((own["id"].to_numpy(np.int64), b"".join(own["v"]))), dims, k, block, margin), "query_id long, vec_id long, score double"))
            if waves > 1:
                out[-1] = settle(out[-1])
    return reduce(DataFrame.unionByName, out)


def _searched(sent: Broadcast, asked: Broadcast, dims: int, k: int, block: int, margin: float):
    """Index rows -> the k best of them for each query of a wave."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = sent.value
        query_ids, vectors = asked.value[0], np.frombuffer(asked.value[1], np.float32).reshape(-1, dims)
        slack = margin * model.error / np.sqrt(dims)
        flat_books = model.books.reshape(-1, dims)
        exact_queries = vectors.astype(np.float64)
        query_norm = np.sqrt((exact_queries * exact_queries).sum(axis=1))
        query, vec, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for ids, codes, norms, exact in blocks_of(batches, block, dims):
            exact_norm = np.sqrt((exact * exact).sum(axis=1))
            fresh = [(query, vec, score)]
            spots = codes.T.astype(np.int64) + np.arange(codes.shape[1])[:, None] * model.books.shape[1]
            for at in range(0, len(query_ids), 64):
                tables = unit_rows(vectors[at : at + 64]) @ flat_books.T
                guess = np.zeros((len(tables), len(ids)), np.float32)
                for spot in spots:
                    guess += np.take(tables, spot, axis=1)
                guess /= np.maximum(norms, 1e-12)
                guess[query_ids[at : at + 64, None] == ids] = -np.inf
                bound = np.partition(guess, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))] - slack
                i, near = np.nonzero((guess >= bound[:, None]) & (guess > -np.inf))
                for part in range(0, len(i), 1 << 16):  # a crowd may be a whole block
                    x, y = i[part : part + (1 << 16)] + at, near[part : part + (1 << 16)]
                    cosine = np.einsum("ij,ij->i", exact_queries[x], exact[y]) / (query_norm[x] * exact_norm[y])
                    keep = best_of(x, ids[y], cosine, k)
                    fresh.append((x[keep], ids[y][keep], cosine[keep]))
            query, vec, score = (np.concatenate(x) for x in zip(*fresh))
            keep = best_of(query, vec, score, k)
            query, vec, score = query[keep], vec[keep], score[keep]
        for at in range(0, len(query), 10_000):
            yield pd.DataFrame({"query_id": query_ids[query[at : at + 10_000]], "vec_id": vec[at : at + 10_000], "score": score[at : at + 10_000]})

    return run


def blocks_of(batches: Iterator[pd.DataFrame], block: int, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, codes, norms, vectors in double precision) of about ``block`` rows at a time."""

    def arrays(held: list[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        x = pd.concat(held)
        codes = np.frombuffer(b"".join(x["codes"]), np.uint8).reshape(len(x), -1)
        return x["id"].to_numpy(np.int64), codes, x["norm"].to_numpy(np.float32), np.frombuffer(b"".join(x["v"]), np.float32).reshape(len(x), dims).astype(np.float64)

    held, count = [], 0
    for batch in batches:
        for at in range(0, len(batch), block):
            held.append(batch.iloc[at : at + block])
            count += len(held[-1])
            if count >= block:
                yield arrays(held)
                held, count = [], 0
    if count:
        yield arrays(held)
