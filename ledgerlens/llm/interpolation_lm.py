"""Language-model scoring by deleted interpolation.

A bigram model over words and an end mark: P(w | v) = l2*c(v,w)/c(v) + l1*c(w)/N + l0/(V+1). The
weights depend on the bucket of the context's count c(v) (powers of two) and are learned by
expectation-maximisation on held-out counts: one tenth of the training documents is deleted from the
counts, and its n-grams are predicted from the rest. Counts then come from all training documents.

Every count is a shuffle over all documents. The words above a count chosen so that at most
``head_words`` of them remain are broadcast with their counts; all other words' counts are met where
their occurrences are shuffled to, so no word is left out. Pairs of a frequent context are dealt by
the pair, pairs of a rare context by the context.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T
from .ngram_join import deal_steps

_U = np.uint64
_TOP = _U(1 << 63)
_END = int((T.mix(_U(0xE0D)) | _TOP).view(np.int64))  # the end mark's code
_FLUSH = 600_000  # tokens a task holds before it sends its pairs on
_COUNT_FLUSH = 1_500_000  # and before it sends its words' counts on
_BUCKET = 1_500_000  # tokens one reducing task reads
_BUCKETS = 20  # of context counts: 0, 1, 2-3, 4-7, ...
_STEP, _BINS = 4, 160  # held-out events are tallied by probability, in quarters of a power of two


def _tokens(raw, off):
    """Codes of all tokens (each text's words, then the end mark) and their text's index."""
    n = len(off) - 1
    h, d = T.words(raw, off)
    code = np.full(len(h) + n, _U(np.int64(_END).view(np.uint64)), _U)
    who = np.empty(len(code), np.int64)
    code[np.arange(len(h)) + d] = h | _TOP
    who[np.arange(len(h)) + d] = d
    ends = np.cumsum(np.bincount(d, minlength=n) + 1) - 1
    who[ends] = np.arange(n)
    return code, who, ends


def _flushes(batches, most):
    """Runs of a task's documents of about ``most`` tokens: (ids, rests, codes, text index, ends)."""
    T.frugal()
    held, size = [], 0

    def joined():
        shift = np.cumsum([0] + [len(x[1]) for x in held])
        tokens = np.cumsum([0] + [len(x[2]) for x in held])
        return ([x[0] for x in held], np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held]),
                np.concatenate([x[3] + s for x, s in zip(held, shift)]), np.concatenate([x[4] + t for x, t in zip(held, tokens)]))

    for batch in batches:
        raw, off = T.text_buffers(batch.column(2))
        rest = batch.column(1).to_numpy(zero_copy_only=False)
        for i, j in T.slices(off):
            o = off[i: j + 1]
            code, who, ends = _tokens(raw[o[0]: o[-1]], o - o[0])
            held.append((batch.column(0).slice(i, j - i), rest[i:j], code, who, ends))
            size += len(code)
            if size >= most:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def _count_fn(batches):
    """Occurrences of each word, summed over a flush: all, in training, in the deleted part."""
    for _, rest, code, who, _ in _flushes(batches, _COUNT_FLUSH):
        w, at = np.unique(code, return_inverse=True)
        many = lambda on: np.bincount(at, weights=on[who].astype(float), minlength=len(w)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(np.bincount(at)), pa.array(many(rest != 0)), pa.array(many(rest == 1))], ["w", "t", "c", "f"])


class _Head:
    """Counts of the frequent words, by code 1.. in the order of their hashes; code 0 is a text's begin."""

    def __init__(self, words, c, f, docs_c, docs_f):
        order = np.argsort(words)
        self.words = words[order]
        self.c = np.concatenate(([docs_c], c[order])).astype(np.float64)
        self.f = np.concatenate(([docs_f], f[order])).astype(np.float64)


def _short(head, code):
    """Codes with the frequent words' replaced by their small numbers."""
    if not len(head.words):
        return code
    at = np.minimum(np.searchsorted(head.words, code), len(head.words) - 1)
    return np.where(head.words[at] == code, (at + 1).astype(_U), code)


_FAT = "p int, flushes binary, f binary, v binary, w binary, d binary, ids array<{id}>, facts binary"
_FAT_NAMES = ["p", "flushes", "f", "v", "w", "d", "ids", "facts"]


def _part_of(hashed, n):
    """Of n parts the one of each hash; more parts that are a multiple of n refine them."""
    return (((hashed >> _U(32)) * _U(n)) >> _U(32)).astype(np.int64)


def _home(flushes, n):
    """Of n groups the one that collects each flush's documents. A flush is (scan partition, number there)."""
    with np.errstate(over="ignore"):
        return _part_of(T.mix(flushes[:, 0].astype(_U) * _U(0x9E3779B1) + T.mix(flushes[:, 1].astype(_U))), n)


def _local(f, n):
    """Index of each entry's flush in its row's list; nothing is written where the row has one flush."""
    return T.from_planes(f, np.uint32).astype(np.int64) if f else np.zeros(n, np.int64)


def _listed(flushes, local):
    """The flushes of all rows, and the index there of each entry's flush."""
    every, of = np.unique(np.concatenate(flushes), axis=0, return_inverse=True)
    of, start = of.reshape(-1), np.cumsum([0, *map(len, flushes)])
    return every, np.concatenate([of[s + x] for x, s in zip(local, start)])


def _some(flushes, at):
    """The flushes that occur in ``at``, and each entry's index among them (nothing for one flush)."""
    used, local = np.unique(at, return_inverse=True)
    return flushes[used].tobytes(), T.planes(local.astype(np.uint32)) if len(used) > 1 else b""


def _flush_list(x):
    return np.frombuffer(x, np.int64).reshape(-1, 2)


def _pair_rows(flushes, at, v, w, d, buckets, id_type):
    """The pairs of some flushes, one row for each bucket. ``at``: each pair's flush."""
    bits = max(20, int(buckets).bit_length())
    rare = v >= _TOP
    with np.errstate(over="ignore"):
        p = _part_of(T.mix(np.where(rare, v, v * _U(0x9E3779B1) + T.mix(w))), buckets)
    order = np.argsort((p.astype(_U) << _U(64 - bits)) | (np.where(rare, v >> _U(20), (v << _U(22)) | (w & _U((1 << 22) - 1))) >> _U(bits - 20)))
    p = p[order]
    cut = np.flatnonzero(np.diff(p, prepend=-1))
    none = pa.array([[]], pa.list_(id_type))
    for lo, hi in zip(cut, np.append(cut[1:], len(p))):
        o = order[lo:hi]
        listed, f = _some(flushes, at[o])
        yield pa.RecordBatch.from_arrays([pa.array([p[lo]], pa.int32()), *(pa.array([x], pa.binary()) for x in (listed, f, T.planes(v[o]), T.planes(w[o]), T.planes(d[o]))),
                                          none, pa.array([b""], pa.binary())], _FAT_NAMES)


def _deal_fn(shared, buckets, n, v_size):
    """A flush's pairs by bucket, and its documents' own facts as a row of their own.

    A flush is named by the scan partition and its number there, a document by its index in the flush."""

    def run(batches):
        head = T.received(shared)
        part = TaskContext.get().partitionId()
        for seq, (ids, rest, code, who, ends) in enumerate(_flushes(batches, _FLUSH)):
            w = _short(head, code)
            v = np.empty_like(w)
            v[1:] = w[:-1]
            v[0] = 0
            v[ends[:-1] + 1] = 0
            d = (who.astype(np.uint32) << np.uint32(2)) | ((rest[who] == 1).astype(np.uint32) << np.uint32(1)) | (rest[who] != 0)
            known = w < _TOP
            c = np.zeros(len(w))
            c[known] = head.c[w[known].astype(np.int64)]
            base = np.where(known, np.log10((c + 0.1) / (n + 0.1 * (v_size + 1))), 0.0)
            docs = len(rest)
            facts = np.stack((rest == 0, np.bincount(who, minlength=docs), np.bincount(who, weights=known & (c > 0), minlength=docs),
                              np.bincount(who, weights=base, minlength=docs))).astype(np.float64)
            me, mine = np.array([[part, seq]], np.int64), pa.concat_arrays(ids)
            yield from _pair_rows(me, np.zeros(len(w), np.int8), v, w, d, buckets, mine.type)
            yield pa.RecordBatch.from_arrays([pa.array(_home(me, buckets), pa.int32()), pa.array([me.tobytes()], pa.binary()), *[pa.array([b""], pa.binary())] * 4,
                                              pa.ListArray.from_arrays(pa.array([0, len(mine)], pa.int32()), mine), pa.array([facts.tobytes()], pa.binary())], _FAT_NAMES)

    return run


def _redeal_fn(buckets):
    """The rows of a partition, which hold few buckets, put together and dealt to more ``buckets``."""

    def run(batches):
        T.frugal()
        held, size, id_type = [], 0, None

        def dealt():
            listed, f, v, w, d = zip(*held)
            flushes, at = _listed([_flush_list(x) for x in listed], [_local(x, len(y) // 4) for x, y in zip(f, d)])
            col = lambda rows, t: np.concatenate([T.from_planes(x, t) for x in rows])
            return _pair_rows(flushes, at, col(v, _U), col(w, _U), col(d, np.uint32), buckets, id_type)

        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            for i, (facts, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("facts", "flushes", "f", "v", "w", "d")))):
                if facts:
                    yield pa.RecordBatch.from_arrays([pa.array(_home(_flush_list(row[0]), buckets), pa.int32()), *(batch.column(c).slice(i, 1) for c in _FAT_NAMES[1:])], _FAT_NAMES)
                    continue
                held.append(row)
                size += len(row[-1]) // 4
                if size >= _FLUSH:
                    yield from dealt()
                    held, size = [], 0
        if held:
            yield from dealt()

    return run


def bucket_of(count):
    """Bucket of a context's count: 0, then one for each power of two, the last one open."""
    return np.minimum(_BUCKETS - 1, np.ceil(np.log2(np.asarray(count) + 1)).astype(np.int64))


def probability_bin(p):
    """0 for p = 0, else its logarithm in steps of a quarter of a power of two."""
    p = np.asarray(p, dtype=np.float64)
    return np.where(p > 0, 1 + np.minimum(_BINS - 2, np.round(-np.log2(np.where(p > 0, p, 1)) * _STEP)), 0).astype(np.int64)


def _meet(rows, head):
    """All pairs of a bucket with the counts that are known there."""
    T.frugal()
    col = lambda name, t: np.concatenate([T.from_planes(r[name], t) for r in rows]) if rows else np.zeros(0, t)
    v, w, d = col("v", _U), col("w", _U), col("d", np.uint32)
    train, fold = (d & 1).astype(float), ((d >> 1) & 1).astype(float)

    def sums(key):
        _, at = np.unique(key, return_inverse=True)
        return np.bincount(at, weights=train)[at], np.bincount(at, weights=fold)[at]

    if not len(v):
        z = np.zeros(0)
        return v, w, d, fold, z, z, z, z
    with np.errstate(over="ignore"):
        cvw, fvw = sums(T.mix(v * _U(0x9E3779B1) + T.mix(w)))
    cv, fv = np.zeros(len(v)), np.zeros(len(v))
    rare = v >= _TOP
    cv[~rare], fv[~rare] = head.c[v[~rare].astype(np.int64)], head.f[v[~rare].astype(np.int64)]
    if rare.any():
        _, at = np.unique(v[rare], return_inverse=True)
        cv[rare], fv[rare] = np.bincount(at, weights=train[rare])[at], np.bincount(at, weights=fold[rare])[at]
    return v, w, d, fold, cvw, fvw, cv, fv


def _ratio(a, b):
    return np.divide(a, b, out=np.zeros(len(a)), where=b > 0)


def _tally_fn(shared, n, n_fold):
    """Held-out events of a bucket: context bucket, bins of the bigram and unigram probability, number.

    Where the word's count is not known here, its code stands in for the unigram bin."""

    def run(rows):
        head = T.received(shared)
        _, w, _, fold, cvw, fvw, cv, fv = _meet(list(rows), head)
        on = fold > 0
        w, b = w[on], bucket_of(cv[on] - fv[on])
        two = probability_bin(_ratio(cvw[on] - fvw[on], cv[on] - fv[on]))
        known = w < _TOP
        i = w[known].astype(np.int64)
        one = probability_bin((head.c[i] - head.f[i]) / max(1, n - n_fold))
        cell, many = np.unique((b[known] * _BINS + two[known]) * _BINS + one, return_counts=True)
        tail, tail_many = np.unique(np.stack(((b * _BINS + two)[~known], w[~known].view(np.int64))), axis=1, return_counts=True)
        yield cell.astype(np.int64).tobytes(), many.astype(np.int64).tobytes(), tail.astype(np.int64).tobytes(), tail_many.astype(np.int64).tobytes()

    return run


def _tail_cells(batches):
    for batch in batches:
        for tail, many in zip(batch.column("tail").to_pylist(), batch.column("tail_many").to_pylist()):
            x = np.frombuffer(tail, np.int64).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(x[1]), pa.array(x[0]), pa.array(np.frombuffer(many, np.int64))], ["w", "cell", "many"])


def _head_cells(batches):
    for batch in batches:
        for cell, many in zip(batch.column("cell").to_pylist(), batch.column("many").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(cell, np.int64)), pa.array(np.frombuffer(many, np.int64))], ["cell", "many"])


def learn_weights(cell: np.ndarray, many: np.ndarray, v_size: int, rounds: int = 60) -> np.ndarray:
    """Mixture weights (bucket x order 2, 1, 0) by expectation-maximisation on tallied held-out events."""
    value = lambda i: np.where(i > 0, 2.0 ** (-(i - 1) / _STEP), 0.0)
    b = cell // (_BINS * _BINS)
    p = np.stack((value(cell // _BINS % _BINS), value(cell % _BINS), np.full(len(cell), 1 / (v_size + 1))), axis=1)
    weight = np.full((_BUCKETS, 3), 1 / 3)
    weight[0] = [0, 0.5, 0.5]  # a context that was never seen says nothing
    for _ in range(rounds):
        share = weight[b] * p
        share *= (many / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        total = np.stack([np.bincount(b, weights=share[:, k], minlength=_BUCKETS) for k in range(3)], axis=1) + 1e-3 * (weight > 0)
        weight = total / total.sum(axis=1, keepdims=True)
    return weight


_SUMS = "g int, kind int, a binary, b binary, c binary, flushes binary, ids array<{id}>"
_SUM_NAMES = ["g", "kind", "a", "b", "c", "flushes", "ids"]


def _sum_rows(flushes, u, total, groups):
    """Documents' sums, one row for each group of flushes. ``u``: a document's flush and index, each once."""
    g = _home(flushes, groups)[u >> 32]
    order = np.argsort(g, kind="stable")
    g = g[order]
    cut = np.flatnonzero(np.diff(g, prepend=-1))
    for lo, hi in zip(cut, np.append(cut[1:], len(g))):
        o = order[lo:hi]
        listed, f = _some(flushes, u[o] >> 32)
        yield int(g[lo]), 0, T.planes((u[o] & 0xFFFFFFFF).astype(np.uint32)), T.planes(total[o]), f, listed, []


def _score_fn(shared, weights, n, v_size, groups):
    """Sums of log probabilities by document, and the occurrences whose word's count is elsewhere."""

    def run(rows):
        head = T.received(shared)
        rows = list(rows)
        if not rows:
            return
        # flushes are numbered in this task only
        flushes, flush = _listed([_flush_list(r["flushes"]) for r in rows], [_local(r["f"], len(r["d"]) // 4) for r in rows])
        _, w, d, _, cvw, _, cv, _ = _meet(rows, head)
        doc = (d >> 2).astype(np.int64)
        b = bucket_of(cv)
        two = weights[b, 0] * _ratio(cvw, cv)
        known = w < _TOP
        log = np.log10(two[known] + weights[b[known], 1] * head.c[w[known].astype(np.int64)] / max(1, n) + weights[b[known], 2] / (v_size + 1))
        uid = (flush << 32) | doc
        u, at = np.unique(uid[known], return_inverse=True)
        yield from _sum_rows(flushes, u, np.bincount(at, weights=log, minlength=len(u)), groups)
        for r in rows:
            if r["facts"]:
                yield int(_home(_flush_list(r["flushes"]), groups)[0]), 1, b"", b"", bytes(r["facts"]), bytes(r["flushes"]), r["ids"]
        rest = ~known
        if rest.any():
            o = np.flatnonzero(rest)
            o = o[np.argsort(uid[o], kind="stable")]
            yield -1, 2, T.planes(w[o]), T.planes(np.concatenate((cvw[o], cv[o])).astype(np.uint64)), T.planes(uid[o]), flushes.tobytes(), []

    return run


def _resum_fn(groups):
    """The sums of a partition, which holds few groups, added up and dealt to more ``groups``."""

    def run(batches):
        T.frugal()
        held, size, kind = [], 0, None

        def dealt():
            a, b, c, listed = zip(*held)
            flushes, at = _listed([_flush_list(x) for x in listed], [_local(x, len(y) // 4) for x, y in zip(c, a)])
            u, to = np.unique((at << 32) | np.concatenate([T.from_planes(x, np.uint32) for x in a]).astype(np.int64), return_inverse=True)
            total = np.bincount(to, weights=np.concatenate([T.from_planes(x, np.float64) for x in b]), minlength=len(u))
            for g, k, *parts, ids in _sum_rows(flushes, u, total, groups):
                yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([k], pa.int32()), *(pa.array([x], pa.binary()) for x in parts), pa.array([ids], kind)], _SUM_NAMES)

        for batch in batches:
            kind = batch.schema.field("ids").type
            for i, (of, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("kind", "a", "b", "c", "flushes")))):
                if of == 1:
                    yield pa.RecordBatch.from_arrays([pa.array(_home(_flush_list(row[-1]), groups), pa.int32()), *(batch.column(c).slice(i, 1) for c in _SUM_NAMES[1:])], _SUM_NAMES)
                    continue
                held.append(row)
                size += len(row[0]) // 4
                if size >= _FLUSH:
                    yield from dealt()
                    held, size = [], 0
        if held:
            yield from dealt()

    return run


def _tail_fn(weights):
    def run(batches):
        for batch in batches:
            for w, x, u, of in zip(*(batch.column(k).to_pylist() for k in ("a", "b", "c", "flushes"))):
                cvw, cv = T.from_planes(x, np.uint64).reshape(2, -1).astype(float)
                b = bucket_of(cv)
                uid = T.from_planes(u, np.int64)
                part, seq = np.frombuffer(of, np.int64).reshape(-1, 2)[uid >> 32].T
                yield pa.RecordBatch.from_arrays([pa.array(T.from_planes(w, np.int64)), pa.array(part.astype(np.int32)), pa.array(seq), pa.array((uid & 0xFFFFFFFF).astype(np.int32)),
                                                  pa.array(weights[b, 0] * _ratio(cvw, cv)), pa.array(b.astype(np.int32))], ["w", "part", "seq", "doc", "two", "b"])

    return run


def _sum_fn(table):
    """A group's documents with the sums that the buckets returned."""
    kind = table["kind"].to_numpy()
    own = np.flatnonzero(kind == 1)
    value = lambda name, i: table[name][int(i)].as_py()
    flushes = np.concatenate([_flush_list(value("flushes", i)) for i in own])
    facts = [np.frombuffer(value("c", i), np.float64).reshape(4, -1) for i in own]
    sizes = [x.shape[1] for x in facts]
    start = np.cumsum([0, *sizes])
    number = {tuple(x): s for x, s in zip(flushes.tolist(), start.tolist())}
    score = np.zeros(start[-1])
    for i in np.flatnonzero(kind == 0):
        doc = T.from_planes(value("a", i), np.uint32).astype(np.int64)
        at = np.array([number[tuple(x)] for x in _flush_list(value("flushes", i)).tolist()])
        score[at[_local(value("c", i), len(doc))] + doc] += T.from_planes(value("b", i), np.float64)  # a document once in each row
    ids = table["ids"].chunk(0) if table["ids"].num_chunks == 1 else pa.concat_arrays(table["ids"].chunks)
    facts = np.concatenate(facts, axis=1)
    return pa.table({"id": ids.take(pa.array(own)).flatten(), "part": np.repeat(flushes[:, 0], sizes).astype(np.int32), "seq": np.repeat(flushes[:, 1], sizes),
                     "doc": np.concatenate([np.arange(k, dtype=np.int32) for k in sizes]), "held_out": facts[0] > 0,
                     "n_tokens": facts[1].astype(np.int64), "known": facts[2].astype(np.int64), "base": facts[3], "score": score})


def interpolated_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split: int = 10, head_words: int = 1 << 18) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    Rows whose crc32(id as text) mod ``split`` is 0 are held out: they are scored but not counted;
    those with remainder 1 are deleted while the weights are learned and counted afterwards. A null
    id counts as the empty text, a null text as no words (its one token is the end mark). Repeated
    rows are counted and scored each. A very long text is one row of its flush, whose sums are
    doubles. Without training rows only the uniform part is left. Other
    columns are not read. No rows give an empty table.
    """
    with T.lean_batches(docs.sparkSession):  # all that reads texts runs in here
        return _scores(docs, id_col, text_col, split, head_words)


def _scores(docs: DataFrame, id_col: str, text_col: str, split: int, head_words: int) -> DataFrame:
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(split)).alias("r"),
                       F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    uni = T.stored(base.mapInArrow(_count_fn, "w long, t long, c long, f long").groupBy("w").agg(*(F.sum(x).alias(x) for x in "tcf")))
    tokens, n, n_fold, v_size = (x or 0 for x in uni.agg(F.sum("t"), F.sum("c"), F.sum("f"), F.count_if(F.col("c") > 0)).first())
    ends = uni.where(F.col("w") == _END).select("c", "f").first() or (0, 0)

    # the least count at which no more than head_words words remain; counts have few distinct values
    steps = uni.where("t > 1").groupBy("t").count().orderBy(F.desc("t")).toPandas()
    inside = steps["t"][steps["count"].cumsum() <= head_words]
    top = uni.where(F.col("t") >= (int(inside.min()) if len(inside) else 1 << 62)).select("w", "c", "f").toPandas()
    head = _Head(top["w"].to_numpy(np.int64).view(_U), top["c"].to_numpy(), top["f"].to_numpy(), ends[0], ends[1])
    shared = T.send(spark, head)

    buckets = max(1, -(-int(tokens) // _BUCKET))
    first, *more = deal_steps(buckets)  # the rows of a flush do not grow with the number of buckets
    fat = base.mapInArrow(_deal_fn(shared, first, n, v_size), _FAT.format(id=id_type))
    for before, after in zip([first, *more], more):
        fat = fat.repartitionById(before, "p").mapInArrow(_redeal_fn(after), _FAT.format(id=id_type))
    dealt = fat.repartitionById([first, *more][-1], "p").rdd
    # both jobs below read the files of this one shuffle
    tally = spark.createDataFrame(dealt.mapPartitions(_tally_fn(shared, n, n_fold)), "cell binary, many binary, tail binary, tail_many binary", verifySchema=False).cache()
    left = max(1, n - n_fold)
    # the same bins as probability_bin
    rare = (tally.select("tail", "tail_many").mapInArrow(_tail_cells, "w long, cell long, many long").groupBy("w", "cell").agg(F.sum("many").alias("many")).join(uni, "w")
            .withColumn("p", (F.col("c") - F.col("f")) / F.lit(float(left)))
            .select((F.col("cell") * _BINS + F.when(F.col("p") > 0, 1 + F.least(F.lit(float(_BINS - 2)), F.rint(-F.log2("p") * _STEP))).otherwise(0)).cast("long").alias("cell"), "many"))
    cells = tally.select("cell", "many").mapInArrow(_head_cells, "cell long, many long").unionByName(rare).groupBy("cell").agg(F.sum("many").alias("many")).toPandas()
    tally.unpersist()
    weights = learn_weights(cells["cell"].to_numpy(np.int64), cells["many"].to_numpy(float), v_size)

    # the documents' sums go back the same way, to groups of flushes
    sums = _SUMS.format(id=id_type)
    scored = T.stored(spark.createDataFrame(dealt.mapPartitions(_score_fn(shared, weights, n, v_size, first)), sums, verifySchema=False))
    back = scored.where("kind < 2")
    for before, after in zip([first, *more], more):
        back = back.repartition(before, "g").mapInArrow(_resum_fn(after), sums)
    known = back.groupBy("g").applyInArrow(_sum_fn, f"id {id_type}, part int, seq long, doc int, held_out boolean, n_tokens long, known long, base double, score double")
    c = F.coalesce("c", F.lit(0))
    weight = lambda k: F.get(F.array(*(F.lit(float(x)) for x in weights[:, k])), F.col("b"))
    rest = (
        scored.where("kind = 2").select("a", "b", "c", "flushes").mapInArrow(_tail_fn(weights), "w long, part int, seq long, doc int, two double, b int").join(uni.select("w", "c"), "w", "left")
        .groupBy("part", "seq", "doc").agg(
            F.sum(F.log10(F.col("two") + weight(1) * c / F.lit(float(max(1, n))) + weight(2) / F.lit(v_size + 1.0))).alias("more_score"),
            F.sum(F.log10((c + 0.1) / F.lit(n + 0.1 * (v_size + 1)))).alias("more_base"), F.sum((c > 0).cast("long")).alias("more_known"))
    )
    none = lambda x: F.coalesce(x, F.lit(0))
    return known.join(rest, ["part", "seq", "doc"], "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("known") + none("more_known")).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + none("more_base")).alias("base_score"), (F.col("score") + none("more_score")).alias("score"))
