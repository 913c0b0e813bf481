"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms are hashed words, hashed byte pairs and binned shape measures (capitals, symbols, repetition,
...). Latent directions are the leading right singular vectors of the weighted term matrix of a
bounded sample of labelled documents; that sample's vectors and labels are broadcast. Every document
is projected and compared with all of them in blocks (exact cosines by matrix products); its nearest
ones vote with their similarities as weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T

TRAIN_DOCS = 4000  # labelled documents that the space is fitted on and that vote, at most
RANK = 64
NEIGHBOURS = 25
_WORDS, _PAIRS, _BINS = 2048, 1024, 8
_MEASURES = 8
TERMS = _WORDS + _PAIRS + _MEASURES * _BINS
_WEIGHT = (1.0, 1.0, 1.5)  # of the three blocks' unit vectors
_U = np.uint64


def _class_of_bytes():
    kind = np.zeros(256, np.int64)  # 0 other, 1 capital, 2 symbol, 3 digit, 4 sentence mark
    kind[65:91] = 1
    kind[[ord(c) for c in "#*$%&|<>@^~=+_\\{}[]"]] = 2
    kind[48:58] = 3
    kind[[ord(c) for c in ".,;:!?"]] = 4
    return kind


def term_counts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Dense counts (texts x TERMS) of a slice of texts."""
    n = len(off) - 1
    out = np.zeros((n, TERMS), np.float32)
    hashes, doc = T.words(raw, off)
    n_words = np.bincount(doc, minlength=n)
    out[:, :_WORDS] = np.bincount(doc * _WORDS + (hashes % _U(_WORDS)).astype(np.int64), minlength=n * _WORDS).reshape(n, -1)
    size = np.diff(off)
    owner = np.repeat(np.arange(n), size)
    if len(raw) > 1:
        same = owner[1:] == owner[:-1]
        pair = ((raw[:-1].astype(np.int64) * 257 + raw[1:]) * 40503 >> 4) % _PAIRS
        out[:, _WORDS: _WORDS + _PAIRS] = np.bincount(owner[:-1][same] * _PAIRS + pair[same], minlength=n * _PAIRS).reshape(n, -1)
    kinds = np.bincount(owner * 5 + _class_of_bytes()[raw], minlength=n * 5).reshape(n, 5) if len(raw) else np.zeros((n, 5))
    lines = np.bincount(owner[raw == 10], minlength=n) + 1 if len(raw) else np.ones(n)
    again = np.zeros(n)
    if len(doc) > 1:
        again = np.bincount(doc[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    runs, whose = T.shingles(hashes, doc, n)
    distinct = np.diff(T.distinct_sets(runs, whose, n)[1])
    n_runs = np.bincount(whose, minlength=n)
    chars, many = np.maximum(1, size), np.maximum(1, n_words)
    shares = [kinds[:, 1] / chars * 4, kinds[:, 2] / chars * 8, kinds[:, 3] / chars * 8, kinds[:, 4] / chars * 8, again / many * 2, (n_runs - distinct) / np.maximum(1, n_runs),
              np.log2(1 + n_words) / 14, many / lines / 200]
    for i, s in enumerate(shares):
        b = np.minimum(_BINS - 1, (np.sqrt(np.maximum(0, s)) * _BINS).astype(np.int64))
        out[np.arange(n), _WORDS + _PAIRS + i * _BINS + b] = n_words > 0
    return out


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic counts times inverse document frequency, each block scaled to its weight."""
    x = np.log1p(counts) * idf
    at = np.cumsum([0, _WORDS, _PAIRS, _MEASURES * _BINS])
    for lo, hi, w in zip(at[:-1], at[1:], _WEIGHT):
        norm = np.linalg.norm(x[:, lo:hi], axis=1, keepdims=True)
        x[:, lo:hi] *= w / np.where(norm > 0, norm, 1)
    return x


class Space:
    """Projection, and the labelled vectors that vote."""

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int, seed: int = 0):
        n = len(counts)
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if n else 0.5
        self.idf = np.log((1 + n) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 1 if n else np.ones(TERMS, np.float32)
        x = weighted(counts, self.idf)
        rank = max(1, min(rank, n))
        rnd = np.random.default_rng(seed)
        q = rnd.normal(size=(TERMS, rank + 16)).astype(np.float32)
        for _ in range(4 if n else 0):  # power iterations towards the leading singular vectors
            q, _ = np.linalg.qr(x.T @ (x @ q))
        if n:
            _, _, v = np.linalg.svd(x @ q, full_matrices=False)
            q = q @ v.T
        self.directions = q[:, :rank].astype(np.float32)
        self.vectors = self._unit(x @ self.directions)

    @staticmethod
    def _unit(v):
        norm = np.linalg.norm(v, axis=1, keepdims=True)
        return (v / np.where(norm > 1e-12, norm, 1)).astype(np.float32)

    def project(self, counts: np.ndarray) -> np.ndarray:
        return self._unit(weighted(counts, self.idf) @ self.directions)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled documents; the prior without any."""
        if not len(self.vectors):
            return np.full(len(counts), self.prior)
        cosine = self.project(counts) @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        w = np.maximum(0, np.take_along_axis(cosine, near, axis=1)).astype(np.float64) ** 4
        return (np.sum(w * self.labels[near], axis=1) + 0.01 * self.prior) / (w.sum(axis=1) + 0.01)


def _counts_fn(batches):
    """Nonzero term counts of each text, packed."""
    for batch in batches:
        raw, off = T.text_buffers(batch.column(1))
        for i, j in T.slices(off):
            o = off[i: j + 1]
            for lo in range(0, j - i, 512):
                part = o[lo: min(lo + 512, j - i) + 1]
                c = term_counts(raw[part[0]: part[-1]], part - part[0])
                terms = [np.flatnonzero(r) for r in c]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i + lo, len(c)), pa.array([t.astype(np.uint16).tobytes() for t in terms], pa.binary()),
                                                  pa.array([r[t].tobytes() for r, t in zip(c, terms)], pa.binary())], ["label", "terms", "counts"])


def fitted_space(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fold: tuple[int, int] = (3, 1),
                 train_docs: int = TRAIN_DOCS, rank: int = RANK, seed: int = 1) -> Space:
    """The space of a sample, by id hash, of at most ``train_docs`` labelled rows outside the held-out fold."""
    mod, held = fold
    key = F.col(id_col)
    mine = labels.where(key.isNotNull() & F.col(label_col).isNotNull() & (F.crc32(key.cast("string").cast("binary")) % mod != held))
    mine = mine.groupBy(key.alias("l_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("label"))
    n = mine.count()
    share = min(1.0, 0.95 * train_docs / max(1, n))
    mine = mine.withColumn("place", F.xxhash64("l_id", F.lit(seed)))
    sample = mine.where(F.pmod("place", F.lit(1 << 30)) < int(share * (1 << 30))).orderBy("place", "l_id").limit(train_docs)
    texts = docs.select(key.alias("d_id"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(sample), F.col("d_id") == F.col("l_id"))
    # repeated ids may give more texts: the bound then takes the first ones by hash, the same in every run
    order = texts.select("label", "t", "place", F.xxhash64("t").alias("text_place")).orderBy("place", "text_place", "t").limit(2 * train_docs)
    rows = order.select("label", "t").mapInArrow(_counts_fn, "label int, terms binary, counts binary").toPandas()  # a few kB each
    rows = rows.sort_values(["label", "terms", "counts"]).reset_index(drop=True)[:train_docs] if len(rows) > train_docs else rows
    counts = np.zeros((len(rows), TERMS), np.float32)
    for i, (t, c) in enumerate(zip(rows["terms"], rows["counts"])):
        counts[i, np.frombuffer(t, np.uint16)] = np.frombuffer(c, np.float32)
    return Space(counts, rows["label"].to_numpy(float), rank, seed)


def _score_fn(shared):
    def run(batches):
        space = T.received(shared)
        for batch in batches:
            raw, off = T.text_buffers(batch.column(1))
            for i, j in T.slices(off):
                o = off[i: j + 1]
                for lo in range(0, j - i, 512):  # a block of documents against all labelled vectors
                    part = o[lo: min(lo + 512, j - i) + 1]
                    s = space.scores(term_counts(raw[part[0]: part[-1]], part - part[0]))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i + lo, len(s)), pa.array(s.astype(np.float64))], ["id", "score"])
    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fold: tuple[int, int] = (3, 1), **kw) -> DataFrame:
    """(id, held_out, score, predicted) for each row of ``docs``; only its text goes into the score.

    held_out: crc32(id as text) mod fold[0] is fold[1] (a null id counts as the empty text); such
    rows' labels are not learned. Several labels of an id count by their mean, null ones and labels
    without a document do not count. Very long texts are counted whole. Null and empty texts score the training labels' mean. Repeated
    rows score alike. Other columns are not read. Without labels every score is 0.5.
    """
    space = fitted_space(docs, labels, id_col, text_col, label_col, fold, **kw)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    kind = base.schema["id"].dataType.simpleString()
    out = base.mapInArrow(_score_fn(T.send(docs.sparkSession, space)), f"id {kind}, score double")
    held = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % fold[0] == fold[1]
    return out.select(F.col("id").alias(id_col), held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
