"""Quality by nearest-neighbour voting in a latent-semantic space.

Texts become counts of byte pairs, hashed to a few thousand terms, damped and
weighted by how rare a term is, beside a few shares that describe the shape of
the text (repeated words, capitals, digits, marks). A truncated SVD of a bounded
sample of labelled texts gives the latent space. The labelled vectors there are broadcast (their
number is a parameter) and every document is compared with all of them in
blocks; the nearest ones vote with weights that grow with their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, text_of, unpacked

TERMS, SHAPES = 2048, 4
#: Weight of a whole share beside the unit vector of the terms.
SHAPE_WEIGHT = 2.0
#: Training rows that are unpacked at a time.
STEP = 512
#: 1 for A-Z, 2 for 0-9, 3 for other ASCII marks, 0 for the rest.
BYTE_KINDS = np.array([1 if chr(b).isupper() else 2 if chr(b).isdigit() else 3 if 32 < b < 127 and not chr(b).isalpha() else 0 for b in range(128)] + [0] * 128)


def term_counts(text: str) -> np.ndarray:
    """log(1 + count) of the hashed byte pairs of the whole text, then its shape as shares from 0 to 1."""
    raw = np.frombuffer(text.encode(), np.uint8)
    wide = raw.astype(np.uint32)
    pairs = ((wide[:-1] << np.uint32(8)) | wide[1:]) * np.uint32(2654435761) >> np.uint32(21)
    words, kinds = text.split(), np.bincount(BYTE_KINDS[raw], minlength=4)
    shape = [sum(map(eq, words, words[1:])) / max(1, len(words) - 1), *(kinds[1:] / max(1, len(raw)))]
    return np.concatenate([np.log1p(np.bincount(pairs, minlength=TERMS)), shape]).astype(np.float32)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of idf-weighted terms, with the shares of the shape behind them."""
    terms = counts[:, :TERMS] * idf
    terms /= np.maximum(np.linalg.norm(terms, axis=1, keepdims=True), 1e-12)
    return np.hstack([terms, counts[:, TERMS:] * np.float32(SHAPE_WEIGHT)])


@dataclass
class VotingModel:
    """Latent space and labelled vectors; ``prior`` is the score where nothing can be compared."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int = 15
    sharpness: float = 8.0

    def project(self, counts: np.ndarray) -> np.ndarray:
        latent = weigh(counts, self.idf) @ self.basis
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        cosine = self.project(counts) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        best = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(cosine, best, axis=1).astype(np.float64)
        weight = np.exp(self.sharpness * (near - 1))
        vote = (weight * self.labels[best]).sum(axis=1) / weight.sum(axis=1)
        return np.where(counts[:, :TERMS].any(axis=1), np.clip(vote, 0, 1), self.prior)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by 5."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def leading(square: np.ndarray, n: int, spare: int = 80, rounds: int = 300) -> np.ndarray:
    """The eigenvectors of the ``n`` largest eigenvalues of a symmetric positive matrix, the largest first.

    By subspace iteration with ``spare`` further vectors, until the eigenvalues
    stand still: a whole decomposition would hold several copies of the matrix.
    """
    last = np.zeros(n)
    basis = np.random.default_rng(0).standard_normal((len(square), min(n + spare, len(square))))
    for _ in range(rounds):
        basis, _ = np.linalg.qr(square @ basis)
        image = square @ basis
        values, turn = np.linalg.eigh(basis.T @ image)
        values, basis = values[::-1][:n], image @ turn[:, ::-1]
        if np.allclose(values, last, rtol=1e-13, atol=1e-13 * values[0]):
            break
        last = values
    return np.linalg.qr(basis)[0][:, :n]


def learnt(counts: np.ndarray, labels: np.ndarray, dims: int) -> VotingModel:
    """The model of the two-byte counts and labels of the training rows.

    Wide copies are made of ``STEP`` rows at a time: the driver's memory is scarce.
    """
    if not len(counts):
        return VotingModel(np.ones(TERMS, np.float32), np.zeros((TERMS + SHAPES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    parts = [counts[at : at + STEP] for at in range(0, len(counts), STEP)]
    idf = (np.log((1 + len(counts)) / (1 + sum((x[:, :TERMS] > 0).sum(axis=0) for x in parts))) + 0.1).astype(np.float32)
    products = np.zeros((TERMS + SHAPES, TERMS + SHAPES))
    for x in parts:
        weighted = weigh(x.astype(np.float32), idf)
        products += weighted.T @ weighted
    basis = np.ascontiguousarray(leading(products, min(dims, len(counts))), np.float32)
    model = VotingModel(idf, basis, np.zeros((0, basis.shape[1])), labels, float(labels.mean()))
    model.vectors = np.concatenate([model.project(x.astype(np.float32)) for x in parts])
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, dims: int = 48, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> VotingModel:
    """Fit on at most ``sample`` labelled rows outside the held-out fold, those of the smallest id hashes.

    The driver receives ``sample`` rows of 2,052 two-byte numbers (16 MB).
    Rows with a null label or id are no training rows; an id labelled twice
    counts with its mean label, and one that has several texts with that of the
    smallest hash, chosen before anything reaches the driver. Without any row,
    scores are one half.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    texts = texts.groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("hash"), F.col("_text").alias("text")))["text"].alias("_text"))

    @F.pandas_udf("binary")
    def counted(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: term_counts(t).astype(np.float16).tobytes())

    rows = texts.select("_id", "_label", counted("_text").alias("c")).toPandas().sort_values("_id", kind="stable")
    counts, found = np.empty((len(rows), TERMS + SHAPES), np.float16), rows.pop("c")
    for i, c in enumerate(found):
        counts[i] = np.frombuffer(c, np.float16)
    del found
    return learnt(counts, rows["_label"].to_numpy(float), dims)


def score_quality(docs: DataFrame, model: VotingModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add held_out (boolean), score (0 to 1) and predicted (1 if score >= threshold, else 0) to every row.

    Only the text is scored. A null or empty text, or one of a single byte, has
    nothing to compare and gets the share of label 1 among the training rows.
    Very long texts are read whole; repeated rows score alike. All input columns
    are returned; one with an output's name is replaced.
    """
    columns = docs.columns
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            parts = [sent.value.score(np.stack([term_counts(t) for t in batch.iloc[i : i + 256]])) for i in range(0, len(batch), 256)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    scored = packed(docs, _score=scores(text_of(text_col)), _held=held_out(id_col))
    return unpacked(scored, columns, held_out=F.col("_held"), score=F.col("_score"), predicted=F.when(F.col("_score") >= threshold, 1).otherwise(0).cast("int"))
