"""Quality by nearest labelled neighbours in a latent-semantic space.

A bounded sample of labelled documents gives term weights, a projection (truncated singular vectors of the weighted
term matrix) and labelled vectors; both are broadcast, their size set by :class:`Settings` and not by the corpus.
Every document is projected, its cosine with every labelled vector is computed in blocks, and the nearest labels
vote with their similarity. Terms are hashed words, word shapes and repeats; ids, languages and sources are not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellspan.llm.common import text_slices
from cellspan.plans.bounded import bounded_rows


@dataclass(frozen=True)
class Settings:
    per_class: int = 2000  # labelled documents per label, the first by hash of doc_id
    words: int = 2048  # hashed words
    shapes: int = 512  # hashed word shapes
    rank: int = 48  # latent dimensions
    neighbours: int = 25
    sharpness: float = 4.0  # power of the similarity in a vote
    threshold: float = 0.3


@dataclass
class Model:
    weights: np.ndarray  # of each term
    projection: np.ndarray  # terms x rank
    vectors: np.ndarray  # labelled documents x rank, unit length
    labels: np.ndarray
    settings: Settings


_TERMS: dict[str, tuple[int, int]] = {}
_CACHE_WORDS = 400_000


def _shape(word: str) -> str:
    """Letters and digits as classes, runs shortened, other characters as they are."""
    out = []
    for c in word:
        k = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if len(out) < 2 or not (out[-1] == out[-2] == k):
            out.append(k)
    return "".join(out)


def _terms(word: str, s: Settings) -> tuple[int, int]:
    import xxhash

    known = _TERMS.get(word)
    if known is None:
        if len(_TERMS) > _CACHE_WORDS:
            _TERMS.clear()
        known = (xxhash.xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass")) % s.words,
                 s.words + xxhash.xxh32_intdigest(_shape(word).encode("utf-8", "surrogatepass"), seed=1) % s.shapes)
        _TERMS[word] = known
    return known


def features(text: str, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(term numbers, counts scaled within their kind). A blank text has the one term kept for it."""
    words = text.split()
    n = len(words)
    if not n:
        return np.array([s.words + s.shapes]), np.ones(1, dtype=np.float32)
    pairs = np.array([_terms(w, s) for w in words])
    plain, counts = np.unique(pairs[:, 0], return_counts=True)
    shapes, shape_counts = np.unique(pairs[:, 1], return_counts=True)
    repeats = float((pairs[1:] == pairs[:-1]).all(axis=1).sum()) / n
    tf = np.log1p(counts).astype(np.float32)
    tf /= np.linalg.norm(tf)
    share = np.sqrt(shape_counts / n).astype(np.float32)
    extra = np.array([np.sqrt(repeats), np.sqrt(len(plain) / n)], dtype=np.float32)
    return (
        np.concatenate([plain, shapes, s.words + s.shapes + 1 + np.arange(2)]),
        np.concatenate([tf, 1.5 * share, 1.5 * extra]),
    )


def _sparse(s: Settings):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in text_slices(frames):
            found = [features(t, s) for t in part["text"]]
            yield pd.DataFrame({"label": part["label"], "terms": [x[0].astype(np.int32) for x in found], "values": [x[1] for x in found]})

    return run


def _lowest_hashes(labelled: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, label, h): of each label the ranges of hashes that hold its first ``per_class`` rows, by counts."""
    marked = labelled.where("label is not null").select("doc_id", "label", F.xxhash64("doc_id").alias("h"))
    marked = marked.withColumn("__range", F.shiftright("h", 52))
    counts = marked.groupBy("label", "__range").agg(F.count(F.lit(1)).alias("n"))  # 4096 ranges of a label at most
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("__range"))
    low = counts.withColumn("before", upto - F.col("n")).where(F.col("before") < per_class).select("label", "__range")
    return marked.join(F.broadcast(low), ["label", "__range"], "left_semi").drop("__range")


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Fit on (doc_id, text, label); None when there is no labelled row.

    Takes at most ``per_class`` rows of each label, by hash of ``doc_id``. Rows with a null label are left out.
    """
    s = settings
    bounded = _lowest_hashes(labelled, s.per_class)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))
    # ids only: the first per label, then their texts
    chosen = bounded.withColumn("r", rank).where(F.col("r") <= s.per_class)
    texts = labelled.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").where("label is not null").dropDuplicates(["doc_id"])
    rows = bounded_rows(texts.select("doc_id", "text", F.col("label").cast("int")).orderBy("doc_id").mapInPandas(_sparse(s), "label int, terms array<int>, values array<float>"), 4 * s.per_class, "labelled sample")
    if not rows:
        return None
    width = s.words + s.shapes + 3
    matrix = np.zeros((len(rows), width), dtype=np.float32)
    for i, r in enumerate(rows):
        matrix[i, np.asarray(r["terms"])] = r["values"]
    df = (matrix > 0).sum(axis=0)
    weights = np.log((1 + len(rows)) / (1 + df)).astype(np.float32) + 0.2
    weights[s.words :] = 1.0  # shapes tell by their share, also where every document has them
    matrix *= weights
    rank_now = min(s.rank, *matrix.shape)
    random = np.random.default_rng(1)
    basis = np.linalg.qr(matrix.T @ (matrix @ random.standard_normal((width, min(rank_now + 10, *matrix.shape))).astype(np.float32)))[0]
    for _ in range(3):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, right = np.linalg.svd(matrix @ basis, full_matrices=False)
    projection = np.ascontiguousarray((basis @ right.T)[:, :rank_now], dtype=np.float32)
    return Model(weights, projection, _unit(matrix @ projection), np.array([r["label"] for r in rows], dtype=np.float32), s)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def vote(vectors: np.ndarray, model: Model, block: int = 512) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors; labels weigh alike in total."""
    s, y = model.settings, model.labels
    share = y.mean()
    balance = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)).astype(np.float32)
    k = min(s.neighbours, len(y))
    out = np.empty(len(vectors))
    for at in range(0, len(vectors), block):
        cosine = vectors[at : at + block] @ model.vectors.T
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3) ** s.sharpness * balance[near]
        out[at : at + block] = (weight * y[near]).sum(axis=1) / weight.sum(axis=1)
    return np.clip(out, 0.0, 1.0)


def score(docs: DataFrame, model: Model | None, out: str = "score") -> DataFrame:
    """``docs`` with ``out``, 0 to 1, higher where label 1 is likelier; 1.0 everywhere without a model.

    Null text is empty text, which has a score like any other. All columns pass through; one named ``out`` is
    replaced. The score depends on the text alone.
    """
    docs = docs.drop(out)
    if model is None:
        return docs.withColumn(out, F.lit(1.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for column in frames:
            vectors = np.empty((len(column), m.projection.shape[1]), dtype=np.float32)
            for i, text in enumerate(column):
                terms, values = features(text or "", m.settings)
                vectors[i] = (values * m.weights[terms]) @ m.projection[terms]
            yield pd.Series(vote(_unit(vectors), m))

    return docs.withColumn(out, F.pandas_udf(run, "double")("text"))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) of labelled documents outside the held-out fold."""
    marked = labels.where(~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label"))
    return docs.select("doc_id", "text").join(marked, "doc_id")


def predictions(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score(docs.select("doc_id", "text"), fit(training_rows(docs, labels), settings))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, labelled_texts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that are not rejected, their columns unchanged."""
    name = "__score"
    return score(docs, fit(training_rows(labelled_texts, labels), settings), name).where(F.col(name) >= settings.threshold).drop(name)
