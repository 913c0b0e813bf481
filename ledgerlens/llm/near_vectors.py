"""Embedding near-dedup: cross-polytope hashing with multiprobe buckets and verified pairs.

A hash function rotates a unit vector by three rounds of random signs and a fast Hadamard transform
and takes the nearest corner of the cross-polytope (the largest coordinate and its sign). A table
concatenates some functions; how many follows from the number of vectors, and the number of tables
from the collision rate of simulated pairs at the threshold. A vector lies in its own bucket of each
table and also probes the buckets that are next nearest; two vectors are a candidate where one lies in
a bucket that the other lies in or probes. Tasks multiply a bucket's vectors block by block and count
each pair at or above the threshold once, in the first bucket where the two meet; pairs are never rows.

Large groups: vectors closer to a bucket's centre than half the threshold's angle all link with each
other. Such a ball's links are counted from its size, and its blocks are not multiplied with each other.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import bounded
from ledgerlens.session import materialize

from . import _text as T
from ._graph import Linked, connected_components

PROBES = 4  # further buckets of each table that a vector probes
MISS = 0.001  # share of the pairs at the threshold itself that all tables together may miss
TILE = 2048  # vectors of one side of a product
PACK = 8192  # rows of small buckets that one task call takes
BALL = 32  # members of a bucket for which a centre is taken
_CENTRE = 64  # about so many members make the centre
_CHUNK = 1 << 21  # cosines held at a time
_SLACK = 1e-9  # cosines this near the threshold are computed again, one by one


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, without overflow or underflow."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Hashes:
    """The hash functions of all tables for vectors of one length."""

    def __init__(self, d: int, functions: int, tables: int):
        self.d, self.functions, self.tables = d, functions, tables
        self.width = max(16, 1 << (d - 1).bit_length())
        rnd = np.random.default_rng([d, functions])
        self.signs = rnd.choice([-1.0, 1.0], (tables, functions, 3, self.width))
        changes = [dict(zip(at, to)) for r in (0, 1, 2) for at in combinations(range(functions), r) for to in product((1, 2, 3), repeat=r)]
        self.alts = np.array([[c.get(f, 0) for f in range(functions)] for c in changes])  # which of its four nearest corners each function takes; at most two take another than the first

    @property
    def corners(self) -> int:
        return 2 * self.width

    def _rotated(self, u: np.ndarray, signs: np.ndarray) -> np.ndarray:
        x = np.zeros((len(u), self.width))
        x[:, :self.d] = u
        y = np.empty_like(x)
        for s in signs:
            x *= s / np.sqrt(self.width)
            h = 1
            while h < self.width:
                a, b = x.reshape(len(u), -1, 2, h), y.reshape(len(u), -1, 2, h)
                np.add(a[:, :, 0], a[:, :, 1], out=b[:, :, 0])
                np.subtract(a[:, :, 0], a[:, :, 1], out=b[:, :, 1])
                x, y = y, x
                h *= 2
        return x

    def table(self, u: np.ndarray, t: int) -> np.ndarray:
        """Codes of the buckets of table ``t``: each vector's own, then those that it probes."""
        loss = np.zeros((len(u), len(self.alts)))
        code = np.zeros((len(u), len(self.alts)), np.int64)
        for f in range(self.functions):
            x = self._rotated(u, self.signs[t, f])
            size = np.abs(x)
            top = np.argpartition(size, self.width - 4, axis=1)[:, -4:]
            value = np.take_along_axis(size, top, 1)
            order = np.argsort(-value, axis=1, kind="stable")
            top, value = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
            corner = 2 * top + (np.take_along_axis(x, top, 1) < 0)
            loss += ((value[:, :1] - value) ** 2)[:, self.alts[:, f]]
            code += corner[:, self.alts[:, f]] * self.corners ** f
        loss[:, 0] = np.inf
        most = min(PROBES, loss.shape[1] - 1)
        probes = np.argpartition(loss, most - 1, axis=1)[:, :most]
        return np.concatenate((code[:, :1], np.take_along_axis(code, probes, 1)), 1)

    def codes(self, u: np.ndarray) -> np.ndarray:
        return np.stack([self.table(u, t) for t in range(self.tables)], 1)


def _meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether one of each two vectors lies in a bucket that the other lies in or probes."""
    return (a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)


def planned(d: int, n: int, threshold: float) -> Hashes:
    """Functions so that buckets outnumber the vectors, and tables for the allowed miss."""
    width = 2 * max(16, 1 << (d - 1).bit_length())
    k = 1
    while width ** k < 16 * n and width ** (k + 1) < 1 << 52:
        k += 1
    rnd = np.random.default_rng(d)
    x = units(rnd.normal(size=(1000, d)))
    y = x  # in one dimension there is no other angle
    if d > 1:
        z = rnd.normal(size=x.shape)
        z = units(z - (z * x).sum(1, keepdims=True) * x)
        y = threshold * x + np.sqrt(1 - threshold * threshold) * z
    trial = Hashes(d, k, 2)
    rate = np.mean([_meet(trial.table(x, t), trial.table(y, t)).mean() for t in range(2)])
    rate = min(0.999, max(0.01, rate - 0.02))
    return Hashes(d, k, min(1 << 9, int(np.ceil(np.log(MISS) / np.log(1 - rate)))))


def _vectors(col: pa.Array, d: int) -> np.ndarray:
    return units(col.flatten().to_numpy(zero_copy_only=False).reshape(-1, d))


def _buckets_fn(shared, first_only: bool):
    """Rows (d, key, node, own) of the buckets in which a vector lies (own) or which it probes."""

    def run(batches):
        T.frugal()
        plans = T.received(shared)
        for batch in batches:
            size, node = batch.column("d").to_numpy(), batch.column("node").to_numpy()
            for d in np.unique(size).tolist():
                rows = np.flatnonzero(size == d)
                h = plans[d]
                for i in range(0, len(rows), TILE):
                    at = rows[i:i + TILE]
                    u = _vectors(batch.column("v").take(pa.array(at)), d)
                    for t in range(1 if first_only else h.tables):
                        code = (h.table(u, t)[:, :1] if first_only else h.table(u, t)) * h.tables + t
                        own = np.zeros(code.shape, bool)
                        own[:, 0] = True
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(code.size, d, np.int32)), pa.array(code.ravel()), pa.array(np.repeat(node[at], code.shape[1])), pa.array(own.ravel())],
                                                         ["d", "key", "node", "own"])

    return run


def _centre(table: pa.Table) -> pa.Table:
    d = table["d"][0].as_py()
    mean = _vectors(table["v"].combine_chunks(), d).mean(0)
    return pa.table({"d": table["d"].slice(0, 1), "key": table["key"].slice(0, 1), "centre": pa.array([mean.tobytes()], pa.binary())})


def _balls_fn(threshold: float):
    """Which vectors are nearer to their bucket's centre than half the threshold's angle."""
    least = float(np.cos(np.arccos(threshold) / 2 - 1e-6))

    def run(batches):
        for batch in batches:
            size = batch.column("d").to_numpy()
            for d in np.unique(size).tolist():
                rows = pa.array(np.flatnonzero(size == d))
                c = np.stack([np.frombuffer(x) for x in batch.column("centre").take(rows).to_pylist()])
                length = np.sqrt((c * c).sum(1))
                dot = (_vectors(batch.column("v").take(rows), d) * c).sum(1)
                inside = pa.array((length > 0) & (dot >= least * length))
                yield pa.RecordBatch.from_arrays([batch.column("node").take(rows).filter(inside), batch.column("key").take(rows).filter(inside)], ["node", "ball"])

    return run


def _candidates(u, key, side, at, least):
    """Row positions and cosines of the pairs of equal ``key`` whose cosine is at least ``least``, in blocks.

    ``at`` gives each row's vector in ``u``. Small buckets are multiplied together by their size; of a
    large one with two sides, only pairs across them are."""
    order = np.argsort(key, kind="stable")
    _, start, size = np.unique(key[order], return_index=True, return_counts=True)
    for s in np.unique(size[size > 1]).tolist():
        of = start[size == s]
        if s <= 64:
            step = max(1, _CHUNK // (s * s))
            x, y = np.triu_indices(s, 1)
            for k in range(0, len(of), step):
                rows = order[of[k:k + step, None] + np.arange(s)]
                v = u[at[rows]]
                cos = np.matmul(v, v.transpose(0, 2, 1))[:, x, y]
                b, p = np.nonzero(cos >= least)
                yield rows[b, x[p]], rows[b, y[p]], cos[b, p]
            continue
        for o in of:
            rows = order[o:o + s]
            across = side[rows].any()
            left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if across else (rows, rows)
            step = max(1, _CHUNK // max(1, len(right)))
            for k in range(0, len(left), step):
                cos = u[at[left[k:k + step]]] @ u[at[right]].T
                i, j = np.nonzero(cos >= least)
                if not across:
                    i, j = i[j > i + k], j[j > i + k]
                yield left[i + k], right[j], cos[i, j]


def _product_fn(shared, threshold: float):
    """Links of a pack of small buckets or of two tiles of a large one."""

    def run(table: pa.Table) -> pa.Table:
        T.frugal()
        plans = T.received(shared)
        d = table["d"][0].as_py()
        h = plans[d]
        key, own, side = table["key"].to_numpy(), table["own"].to_numpy(), table["side"].to_numpy()
        node, first, at = np.unique(table["node"].to_numpy(), return_index=True, return_inverse=True)
        u = _vectors(table["v"].combine_chunks().take(pa.array(first)), d)
        ball = table["ball"].to_numpy()[first]
        linked = Linked(table["copies"].to_numpy()[first])
        codes, known = np.zeros((len(u), h.tables, 0), np.int64), np.zeros(len(u), bool)
        for x, y, cos in _candidates(u, key, side, at, threshold - _SLACK):
            i, j = at[x], at[y]
            hit = (own[x] | own[y]) & ((ball[i] < 0) | (ball[i] != ball[j]))
            close = np.flatnonzero(hit & (np.abs(cos - threshold) <= _SLACK))
            hit[close] = (u[i[close]] * u[j[close]]).sum(1) >= threshold
            x, i, j = x[hit], i[hit], j[hit]
            if not len(i):
                continue
            new = np.unique(np.concatenate((i, j)))
            new = new[~known[new]]  # only vectors with links need their codes
            for k in range(0, len(new), TILE):
                got = h.codes(u[new[k:k + TILE]])
                if not codes.shape[2]:
                    codes = np.zeros((len(u), *got.shape[1:]), np.int64)
                codes[new[k:k + TILE]] = got
            known[new] = True
            table_no, code = key[x] % h.tables, key[x] // h.tables
            count = np.ones(len(i), bool)  # only in the first bucket where the two meet
            for t in range(h.tables):
                later = np.flatnonzero(count & (table_no > t))
                count[later] = ~_meet(codes[i[later], t], codes[j[later], t])
                here = np.flatnonzero(count & (table_no == t))
                a, b = codes[i[here], t], codes[j[here], t]
                both = (a[:, :1] == b).any(1) & (b[:, :1] == a).any(1)  # they meet in both own buckets of this table
                count[here] = ~both | (code[here] == np.minimum(a[:, 0], b[:, 0]))
            linked.add(i[count], j[count])
        a, b = linked.forest()
        got = linked.links > 0
        return pa.table({"a": np.concatenate((node[a], node[got])), "b": np.concatenate((node[b], node[got])),
                         "links": np.concatenate((np.zeros(len(a), np.int64), linked.links[got]))})

    return run


def _clean(v: Column) -> Column:
    """Whether a vector can link: not null or empty, finite components, one of them not zero."""
    return (v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0))


def _balls(reps: DataFrame, plans, threshold: float) -> DataFrame:
    """(node, ball): the vectors that are in the ball of their bucket of the first table."""
    home = reps.select("d", "node", "v").mapInArrow(_buckets_fn(plans, True), "d int, key long, node long, own boolean")
    many = materialize(home.groupBy("d", "key").agg(F.count("*").alias("members")).where(F.col("members") >= BALL))
    inside = home.join(bounded(many), ["d", "key"]).join(reps.select("node", "v"), "node")
    sample = inside.where(F.pmod(F.xxhash64("node"), "members") < _CENTRE).select("d", "key", "v")
    centres = materialize(sample.groupBy("d", "key").applyInArrow(_centre, "d int, key long, centre binary"))
    return inside.join(bounded(centres), ["d", "key"]).select("d", "key", "node", "v", "centre").mapInArrow(_balls_fn(threshold), "node long, ball long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """(id, n_links, component_id, kept) for each row of ``vectors``.

    Two rows link when their vectors have the same length and a cosine, in double precision, of at
    least ``threshold`` and the tables find the pair (pairs at the threshold itself are missed with a
    probability of about MISS, nearer ones more seldom; none below it links). Vectors that are null,
    empty, all zero or hold a null or non-finite component link with nothing. ``n_links`` counts the
    linked rows, ``component_id`` is the smallest id reachable by links (the row's own included), and
    ``kept`` says that it is the row's own. Rows with equal vectors link with each other and are one
    vector of the products; repeated ids are rows of their own. A null id counts as no id: its row gets
    the smallest other id of its component, and is kept only if there is none. Vectors may be of any
    length. Only the two named columns are read, so others may have any name. No rows give no rows.
    """
    with T.lean_batches(vectors.sparkSession):
        return _near(vectors, id_col, vector_col, threshold)


def _near(vectors: DataFrame, id_col: str, vector_col: str, threshold: float) -> DataFrame:
    spark = vectors.sparkSession
    kind = vectors.schema[vector_col].dataType.elementType.typeName()
    v = F.col(vector_col) if kind in ("float", "double") else F.col(vector_col).cast("array<double>")
    zero = F.lit(0).cast(kind if kind in ("float", "double") else "double")
    rows = vectors.select(F.col(id_col).alias("id"), F.when(_clean(v), F.transform(v, lambda x: x + zero)).alias("v"))  # -0.0 becomes 0.0
    rows = rows.withColumn("h", F.when(F.col("v").isNotNull(), F.struct(F.xxhash64("v"), F.xxhash64(F.lit(1), "v"))))
    reps = rows.where("v IS NOT NULL").groupBy("h", "v").agg(F.min("id").alias("sid"), F.count("*").alias("copies"))
    reps = materialize(reps.withColumn("node", F.monotonically_increasing_id()).withColumn("d", F.size("v")))
    plans = T.send(spark, {r["d"]: planned(r["d"], r["count"], threshold) for r in reps.groupBy("d").count().collect()})  # a row a length

    balled = reps.join(_balls(reps, plans, threshold).withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").drop("of")
    reps = materialize(balled.withColumn("ball", F.coalesce("ball", F.lit(-1))))
    balls = reps.where("ball >= 0").groupBy("d", "ball").agg(F.min("node").alias("hub"), F.sum("copies").alias("weight"))
    in_ball = materialize(reps.where("ball >= 0").select("d", "ball", "node", "copies").join(bounded(balls), ["d", "ball"]).select("node", "hub", (F.col("weight") - F.col("copies")).alias("links")))

    met = reps.select("d", "node", "v").mapInArrow(_buckets_fn(plans, False), "d int, key long, node long, own boolean")
    shared = met.groupBy("d", "key").agg(F.count("*").alias("members"), F.max("own").alias("some")).where("members > 1 AND some").drop("some")
    placed = materialize(met.join(shared, ["d", "key"]).join(reps.select("node", "ball"), "node"))
    # a large bucket's tiles: those of each large ball in it, and those of the rest
    parts = placed.where(F.col("members") > TILE).groupBy("d", "key", "ball").agg(F.count("*").alias("k"))
    parts = parts.withColumn("part", F.when((F.col("ball") >= 0) & (F.col("k") > TILE // 2), F.col("ball")).otherwise(-1))
    sized = parts.groupBy("d", "key", "part").agg(F.ceil(F.sum("k") / TILE).cast("int").alias("tiles"))
    listed = sized.groupBy("d", "key").agg(F.sort_array(F.collect_list(F.struct("part", "tiles"))).alias("all"))  # at most two parts for each TILE rows
    tiled = materialize(listed.join(parts, ["d", "key"]).select(
        "d", "key", "ball", "part", F.expr("aggregate(filter(all, x -> x.part < part), 0, (s, x) -> s + x.tiles)").alias("start"),
        F.expr("filter(all, x -> x.part = part)[0].tiles").alias("tiles"), F.expr("aggregate(all, 0, (s, x) -> s + x.tiles)").alias("total")))
    small = placed.where(F.col("members") <= TILE)
    packs = max(1, -(-small.count() // PACK))
    none = F.lit(0)
    small = small.select("d", "key", "node", "own", F.lit(False).alias("big"), F.pmod(F.xxhash64("key"), F.lit(packs)).alias("grp"), none.alias("i"), none.alias("j"), none.alias("side"))
    large = (
        placed.where(F.col("members") > TILE).join(bounded(tiled), ["d", "key", "ball"])
        .withColumn("tile", (F.col("start") + F.pmod(F.xxhash64("node"), "tiles")).cast("int"))
        .withColumn("other", F.explode(F.expr("filter(sequence(0, total - 1), x -> part < 0 OR x < start OR x >= start + tiles)")))
        .select("d", "key", "node", "own", F.lit(True).alias("big"), F.col("key").alias("grp"), F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
                F.when(F.col("tile") <= F.col("other"), 0).otherwise(1).alias("side")))
    dealt = small.unionByName(large).join(reps.select("node", "copies", "ball", "v"), "node")
    linked = materialize(dealt.groupBy("big", "d", "grp", "i", "j").applyInArrow(_product_fn(plans, threshold), "a long, b long, links long"))

    edges = linked.where("a <> b").select("a", "b").unionByName(in_ball.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    comps = connected_components(edges, reduced=True)
    links = linked.select(F.col("a").alias("node"), "links").unionByName(in_ball.select("node", "links")).groupBy("node").agg(F.sum("links").alias("more"))
    named = reps.select("node", "h", "sid", "copies").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("sid").alias("least"))
    found = named.join(least, "comp").join(links, "node", "left").select(F.col("h").alias("of"), "least", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    out = rows.select("id", "h").join(found, F.col("h") == F.col("of"), "left")
    component = F.when(F.col("of").isNotNull(), F.col("least")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
