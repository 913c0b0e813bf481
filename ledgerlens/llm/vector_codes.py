"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Vectors are cut into equal parts; each part has a codebook that a fixed number of rounds refines.
Orchard's search keeps, for every entry, all entries in order of their distance to it. From a first
guess it walks the guess's list; a nearer entry found there becomes the guess and its list is walked
next. Entries already looked at are marked and not measured again. The walk ends at the first entry
farther from the guess than twice the vector's distance to the guess: whatever comes after is, by the
triangle inequality, no nearer. Tasks walk a block of vectors in step.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import bounded, null_safe_join
from ledgerlens.session import materialize

from . import _text as T

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
_FAN_IN = 32  # partial sums merged by one task
_BLOCK = 4096  # vectors walked in step


def usable(v: Column) -> Column:
    """A vector that is not null, not empty and holds finite components only."""
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def floors(values: np.ndarray, exact: type) -> np.ndarray:
    """floor(SCALE * x): as 64-bit integers, or as Python integers where those could be exceeded."""
    if exact is object:
        return np.array([int(x) * SCALE if abs(x) > 2.0 ** 60 else int(np.floor(x * SCALE)) for x in values.ravel().tolist()], object).reshape(values.shape)
    return np.floor(values.astype(np.float64) * SCALE).astype(exact)


def _bounds(d: int) -> list[tuple[int, int]]:
    ends = np.cumsum([0] + [len(x) for x in np.array_split(np.arange(d), PARTS)])  # equal parts where d allows
    return list(zip(ends[:-1].tolist(), ends[1:].tolist()))


class Codebook:
    """Entries of one part with their neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n = len(entries)
        apart = np.stack([self._squares(entries - e) for e in entries]) if n else np.zeros((0, 0), np.int64)
        self.near = np.stack([np.argsort(row, kind="stable") for row in apart]) if n else np.zeros((0, 0), int)
        self.gap = np.take_along_axis(apart, self.near, 1)
        self.by_sum = np.argsort(entries.sum(1), kind="stable")
        self.sums = entries.sum(1)[self.by_sum]

    @staticmethod
    def _squares(diff: np.ndarray) -> np.ndarray:
        return (diff * diff).sum(1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to each row's nearest entry (of equal ones the lowest index)."""
        n = len(x)
        at = np.minimum(np.searchsorted(self.sums, x.sum(1)), len(self.sums) - 1)
        guess = self.by_sum[at]  # any entry would do; one of a similar sum is often near
        best = self._squares(x - self.entries[guess])
        seen = np.zeros((n, len(self.entries)), bool)
        seen[np.arange(n), guess] = True
        step = np.zeros(n, np.int64)
        live = np.arange(n)
        while len(live):
            g, s = guess[live], step[live]
            on = s < len(self.entries)
            on[on] = self.gap[g[on], s[on]] <= 4 * best[live[on]]  # squared: farther than twice the distance ends the walk
            live, g, s = live[on], g[on], s[on]
            c = self.near[g, s]
            step[live] += 1
            new = ~seen[live, c]
            rows, c = live[new], c[new]
            seen[rows, c] = True
            d = self._squares(x[rows] - self.entries[c])
            better = (d < best[rows]) | ((d == best[rows]) & (c < guess[rows]))
            rows = rows[better]
            best[rows], guess[rows], step[rows] = d[better], c[better], 0
        return guess, best


class Books:
    """The codebooks of all parts."""

    def __init__(self, entries: np.ndarray, exact: type):
        self.exact, self.entries = exact, entries
        self.bounds = _bounds(entries.shape[1])
        self.parts = [Codebook(entries[:, a:b]) for a, b in self.bounds]

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry index and squared error of each part of each row."""
        found = [[book.nearest(x[i:i + _BLOCK, a:b]) for i in range(0, len(x), _BLOCK)] for (a, b), book in zip(self.bounds, self.parts)]
        return (np.stack([np.concatenate([c for c, _ in p]) for p in found], 1), np.stack([np.concatenate([e for _, e in p]) for p in found], 1))

    def sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry the sum of the parts assigned to it, and their number by part."""
        code, _ = self.codes(x)
        total = np.zeros(self.entries.shape, object if self.exact is object else np.int64)
        count = np.zeros((len(self.entries), PARTS), np.int64)
        for p, (a, b) in enumerate(self.bounds):
            np.add.at(total[:, a:b], code[:, p], x[:, a:b])
            np.add.at(count[:, p], code[:, p], 1)
        return total, count

    def refined(self, total: np.ndarray, count: np.ndarray) -> Books:
        """Componentwise floor of the means; an unused entry stays."""
        entries = self.entries.copy()
        for p, (a, b) in enumerate(self.bounds):
            used = count[:, p] > 0
            entries[used, a:b] = total[used, a:b] // count[used, p][:, None]
        return Books(entries.astype(self.exact), self.exact)

    def digest(self) -> str:
        listed = ",".join(str(int(x)) for a, b in self.bounds for x in self.entries[:, a:b].ravel())
        return hashlib.sha256(listed.encode()).hexdigest()


def _matrix(col: pa.Array, d: int, exact: type) -> np.ndarray:
    return floors(col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d), exact)


def _sums_fn(shared, d):
    def run(batches):
        books, total, count = T.received(shared), 0, 0
        for batch in batches:
            if batch.num_rows:
                t, c = books.sums(_matrix(batch.column(0), d, books.exact))
                total, count = total + t, count + c
        if not isinstance(count, int):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((total, count))], pa.binary())], ["sums"])

    return run


def _merge(batches):
    total, count = 0, 0
    for batch in batches:
        for x in batch.column(0).to_pylist():
            t, c = pickle.loads(x)
            total, count = total + t, count + c
    if not isinstance(count, int):
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((total, count))], pa.binary())], ["sums"])


def _codes_fn(shared, d):
    def run(batches):
        books = T.received(shared)
        for batch in batches:
            code, error = books.codes(_matrix(batch.column("v"), d, books.exact))
            total = [int(e) if int(e) < 1 << 63 else None for e in error.sum(1)]
            text = [bytes(row).hex() for row in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(total, pa.int64())], ["id", "label", "code", "error"])

    return run


def train(rows: DataFrame) -> tuple[Books, int] | None:
    """Codebooks of ``rows`` (id, v), and the vectors' length; None without rows.

    The length is the one that most vectors have (of equally frequent ones the greatest); 256 first
    vectors, one length table and merged sums of 256 vectors' size are all that the driver sees."""
    spark = rows.sparkSession
    longest = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("k"), F.max(F.array_max(F.transform("v", F.abs))).alias("m"))
    most = longest.orderBy(F.desc("k"), F.desc("d")).first()
    if most is None:
        return None
    d, widest = most["d"], 2 * (float(most["m"]) * SCALE + 1)  # no difference of two components is wider
    squares = -(-d // PARTS) * widest * widest
    exact = np.int32 if squares < 2 ** 28 else np.int64 if squares < 2 ** 60 and widest < 2 ** 26 else object
    fit = rows.where(F.size("v") == d)
    first = fit.orderBy(F.col("id").asc_nulls_last(), "v").limit(ENTRIES).collect()
    books = Books(floors(np.array([r["v"] for r in first], np.float64), exact), exact)
    vectors = fit.select("v")
    for _ in range(ROUNDS):
        part = vectors.mapInArrow(_sums_fn(T.send(spark, books), d), "sums binary")
        tasks = vectors.rdd.getNumPartitions()
        while tasks > _FAN_IN:
            tasks = -(-tasks // _FAN_IN)
            part = part.repartition(tasks).mapInArrow(_merge, "sums binary")
        total, count = 0, 0
        for r in part.collect():  # at most _FAN_IN rows
            t, c = pickle.loads(r["sums"])
            total, count = total + t, count + c
        books = books.refined(total, count)
    return books, d


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) for each usable row of ``vectors``.

    Rows whose vector is null, empty, holds a null or non-finite component, or has another length
    than most vectors are dropped. Components become floor(1024 * x). Each of the 4 parts (the first
    ones longer by one where the length is no multiple of 4) starts with the parts of the 256
    smallest ids (null ids last, equal ids by vector; fewer vectors: fewer entries) and is refined in
    4 rounds: nearest entry by squared distance (ties: lowest index), then floor of the mean, unused
    entries stay. ``code`` has two hex digits a part, ``error`` is the squared distance summed over
    the parts, ``label_error`` its sum over equal labels (nulls together). All arithmetic is exact,
    with Python integers where components are large; an error beyond a long is null. Repeated rows
    are rows of their own. Long vectors have long parts. Only the three named columns are read, so
    others may have any name. No usable rows give no rows.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector_col].dataType.elementType.typeName()
    v = F.col(vector_col) if kind in ("float", "double") else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v")).where(usable(F.col("v")))
    types = {c: rows.schema[c].dataType.simpleString() for c in ("id", "label")}
    with T.lean_batches(spark):
        made = train(rows)
        if made is None:
            coded, digest = rows.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
        else:
            books, d = made
            digest = books.digest()
            coded = rows.where(F.size("v") == d).mapInArrow(_codes_fn(T.send(spark, books), d), f"id {types['id']}, label {types['label']}, code string, error long")
        coded = materialize(coded)
    by_label = coded.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(38, 0))) as long)").alias("label_error"))
    out = null_safe_join(coded, bounded(by_label), "label")
    return out.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error", F.lit(digest).cast("string").alias("codebooks_sha256"))
