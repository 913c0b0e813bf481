"""Vectorised word and shingle hashing of Arrow text batches (numpy inside Spark tasks).

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D`` after A-Z became a-z. UTF-8 keeps the
bytes of other characters above 0x7F, so splitting bytes and splitting code points agree.
Hashes have 64 bits: over 10^13 shingles some pairs of different shingles share one, which can move
a pair's overlap by one where the pair holds both; no other effect.
"""

from __future__ import annotations

import ctypes
import pickle
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from ledgerlens.session import ensure_checkpoint_dir

def frugal() -> None:
    """Let this Python worker hand large freed blocks back to the system at once (glibc; elsewhere nothing).

    A worker lives on between tasks beside its executor's JVM; without this it keeps its peak."""
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-8, 1)  # M_ARENA_MAX: threads share one heap
        libc.mallopt(-3, 1 << 19)  # M_MMAP_THRESHOLD: blocks of 512 kB and more are mapped on their own


@contextmanager
def lean_batches(spark, size: int = 8 << 20):
    """Jobs started inside hand Arrow batches of at most so many bytes to Python; the setting is put back after."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df):
    """``df`` written once to a table in the shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def send(spark, value):
    """Broadcast a value of this package's classes; unlike a plain broadcast it needs no installed copy of them."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared):
    """The value that ``send`` broadcast, in a task."""
    return pickle.loads(shared.value)


_U = np.uint64
_BLOCK = 1 << 18  # bytes hashed at a time
SLICE = 2 << 20  # bytes of text handled at a time


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = np.asarray(x, dtype=_U)
    with np.errstate(over="ignore"):
        x = x + _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _tables():
    byte = mix(np.arange(256, dtype=_U))
    byte[65:91] = byte[97:123]  # A-Z as a-z
    sep = np.zeros(256, dtype=bool)
    sep[[9, 10, 11, 12, 13, 32]] = True
    return byte, sep


_BYTE, SEP = _tables()
_ODD = _U(0xD6E8FEB86659FD93)
_MUL = mix(np.arange(1, 9, dtype=_U) * _U(7919)) | _U(1)
_pow: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd constant and of its inverse modulo 2^64."""
    if not _pow or len(_pow[0]) < n:
        m = max(n, _BLOCK + 4096)
        inv = _U(pow(int(_ODD), -1, 1 << 64))
        out = []
        for base in (_ODD, inv):
            a = np.full(m, base, dtype=_U)
            a[0] = 1
            with np.errstate(over="ignore"):
                np.multiply.accumulate(a, out=a)
            out.append(a)
        _pow[:] = out
    return _pow[0], _pow[1]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n+1 offsets; a null text is an empty one."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(off) == 0:
        off = np.zeros(1, np.int64)
    return raw[off[0]: off[-1]], off - off[0]


def slices(off: np.ndarray, most: int = SLICE):
    """Ranges of texts of about ``most`` bytes each (a longer text is alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the index of its text, in order."""
    n = len(raw)
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    hashes, begins = [], []
    lo = 0
    while lo < n:
        hi = min(lo + _BLOCK, n)
        while hi < n and not (SEP[raw[hi]] or edge[hi]):  # cut where no word is open
            window = SEP[raw[hi: hi + 4096]] | edge[hi: min(hi + 4096, n)]
            hi = hi + int(np.argmax(window)) if window.any() else min(hi + 4096, n)
        part = raw[lo:hi]
        inside = ~SEP[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[lo + 1: hi]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[lo + 1: hi]
        s, e = np.flatnonzero(first), np.flatnonzero(last)
        if len(s):
            up, down = _powers(hi - lo)
            with np.errstate(over="ignore"):
                total = np.cumsum(_BYTE[part] * up[: hi - lo])
                value = (total[e] - np.where(s > 0, total[s - 1], _U(0))) * down[s]
                hashes.append(mix(value + (e - s + 1).astype(_U) * _MUL[7]))
            begins.append(s + lo)
        lo = hi
    if not hashes:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = np.concatenate(begins)
    return np.concatenate(hashes), np.searchsorted(off, at, side="right") - 1


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text index of each run of ``size`` words; a shorter text's words are one run."""
    count = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    out, owner = [], []
    with np.errstate(over="ignore"):
        for k in range(1, size + 1):
            if k < size:
                at = first[count == k]
            else:
                m = len(hashes) - size + 1
                at = np.flatnonzero(doc[:m] == doc[size - 1:]) if m > 0 else np.zeros(0, np.int64)
            if len(at):
                h = np.full(len(at), mix(_U(k)), dtype=_U)
                for j in range(k):
                    h = h + hashes[at + j] * _MUL[j]
                out.append(mix(h))
                owner.append(doc[at])
    if not out:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def distinct_sets(sh: np.ndarray, owner: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text, one after the other, and the n+1 offsets."""
    order = np.argsort(owner, kind="stable")
    sh, count = sh[order], np.bincount(owner, minlength=n_docs)
    ends = np.cumsum(count)
    parts = [np.unique(sh[e - c: e]) if c > 1 else sh[e - c: e] for c, e in zip(count, ends)]
    sizes = np.fromiter((len(p) for p in parts), dtype=np.int64, count=n_docs)
    return (np.concatenate(parts) if parts else np.zeros(0, _U)), np.concatenate(([0], np.cumsum(sizes)))


def shingle_sets(raw: np.ndarray, off: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle sets of the texts in ``raw``."""
    h, d = words(raw, off)
    return distinct_sets(*shingles(h, d, len(off) - 1, size), len(off) - 1)


def set_hash(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One hash of each set (0 for an empty one)."""
    n = np.diff(off)
    out = np.zeros(len(n), _U)
    if len(values):
        with np.errstate(over="ignore"):
            total = np.concatenate((np.zeros(1, _U), np.cumsum(mix(values ^ _U(0x5851F42D4C957F2D)))))
            some = n > 0
            out[some] = mix((total[off[1:]] - total[off[:-1]])[some] + n[some].astype(_U) * _MUL[6])
    return out


def planes(a: np.ndarray) -> bytes:
    """The array's bytes, all lowest bytes first: runs and small numbers then compress well."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes()


def from_planes(b, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)
