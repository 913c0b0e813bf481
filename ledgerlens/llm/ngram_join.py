"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence matrix.

The columns (shingles) are dealt by hash range into blocks, as many as the rows' sizes call for: two
rows of sizes a <= b that reach the similarity differ in at most d = (1-t)/(1+t)*(a+b) columns, so with
more blocks than that they agree on a whole non-empty block; the first on which they agree has at most
d others before it in either row, so a row's first d + 1 non-empty blocks are its keys. Columns that many rows share (common lines and
passages) are left out of the blocks, which takes nothing from that bound; a row with too few other
columns uses its rarest columns as keys instead. Rows that agree on a key are joined into candidate
components; the sparse product is then computed tile by tile over each component's rows, overlap
counts are accumulated per pair, and pairs under the bound that their two sizes give are discarded.
The result is exact: no pair at or above the threshold is missed, whichever columns count as common.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import bounded
from ledgerlens.session import materialize

from . import _text as T
from ._graph import Linked, components, connected_components

_U = np.uint64
_FLUSH = 500_000  # block keys a task holds before it sends them on
_BUCKET = 800_000  # block keys one reducing group reads
TILE = 200_000  # shingles of one side of a product's tile
TILE_ROWS = 8_000  # and its rows
FAN = 128  # buckets that a task deals to at a time; more are reached in steps
_ROW_KEYS = 128  # or as many buckets as leave each row of a flush so many keys: a step more writes all keys again
_KEYS_EACH = 0.4  # block keys for each shingle, about
_COMMON_RUN, _COMMON_IN_RUN = 1_500_000, 8  # a shingle of 8 different sets among so many shingles is common
_COMMON_MOST = 1 << 18  # common shingles that are broadcast at most, the most frequent ones


def size_classes(largest: int, threshold: Fraction) -> list[tuple[int, int]]:
    """(least size, blocks) of each class of set sizes.

    A set's partners of the same or larger size fall into its class or the next one."""
    ratio = 1 / threshold ** 2
    out, low = [], 1
    while low <= largest:
        high = max(low + 1, int(low * ratio))
        k = most_apart(high - 1, int((high - 1) / threshold), threshold) + 1
        for n in (low, high - 1):  # enough blocks of a set of n are not empty
            need = most_apart(n, int(n / threshold), threshold) + 1
            top = 4 * need + 4
            while k > 1 and k * (1 - np.exp(-n / k)) < need + 2 * np.sqrt(k * np.exp(-n / k)) and k < top:
                k += max(1, k // 100)
        out.append((low, k))
        low = high
    return out


def most_apart(a, b, threshold: Fraction):
    """Most columns in which sets of sizes ``a`` and ``b`` at the threshold differ."""
    num, den = threshold.numerator, threshold.denominator
    return (den - num) * (a + b) // (den + num)


class Common:
    """Common shingles, sorted, with the number of sets they were seen in."""

    def __init__(self, shingle, count):
        order = np.argsort(shingle)
        self.shingle, self.count = shingle[order], count[order]

    def counts(self, values) -> np.ndarray:
        if not len(self.shingle):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(self.shingle, values), len(self.shingle) - 1)
        return np.where(self.shingle[at] == values, self.count[at], 0)


def block_keys(values, off, node, threshold: Fraction, common: Common) -> tuple[np.ndarray, np.ndarray]:
    """(key, node) of each set: a key for each of its first non-empty column blocks, one more than it can differ in."""
    n = np.diff(off)
    if not len(values):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    seen = common.counts(values)
    owner = np.repeat(np.arange(len(n)), n)
    all_values, all_seen = values, seen
    values, owner = values[seen == 0], owner[seen == 0]
    classes = size_classes(int(n.max()), threshold)
    low, ks = np.array([c[0] for c in classes]), np.array([c[1] for c in classes])
    own = np.searchsorted(low, n, side="right") - 1
    num, den = threshold.numerator, threshold.denominator
    total = np.concatenate((np.zeros(1, _U), np.cumsum(T.mix(values))))
    keys, nodes = [], []
    weak = np.zeros(len(n), bool)
    for back in (0, 1):  # as the smaller partner, and as the larger partner of the class below
        c = own - back
        # partners are at most n / t large, and in the class below they are smaller than this one's least size
        use = (c >= 0) & ((-(-n * num // den) < low[own]) if back else (n > 0))
        differ = most_apart(n, low[own] - 1 if back else n * den // num, threshold)
        k = np.where(use, ks[np.maximum(c, 0)], 1)
        block = ((values >> _U(32)) * k[owner].astype(_U)) >> _U(32)
        new = np.ones(len(values), bool)
        new[1:] = (block[1:] != block[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        ends = np.append(at[1:], len(values)) if len(at) else at
        who = owner[at]
        blocks = np.bincount(who, minlength=len(n))
        weak |= use & (blocks <= differ)
        rank = np.arange(len(at)) - (np.cumsum(blocks) - blocks)[who]
        ok = use[who] & (rank <= differ[who])
        with np.errstate(over="ignore"):
            salt = T.mix(block[at] + (c[who].astype(_U) << _U(40)))
            key = T.mix(total[ends] - total[at] + salt)
        keys.append(key[ok])
        nodes.append(node[who[ok]])
    for i in np.flatnonzero(weak):  # too few non-empty blocks to be sure: such a set's rarest shingles are keys too
        own_values, own_seen = all_values[off[i]: off[i + 1]], all_seen[off[i]: off[i + 1]]
        p = int(n[i]) - -(-int(n[i]) * threshold.numerator // threshold.denominator) + 1
        first = np.lexsort((own_values, own_seen))[:p]
        keys.append(T.mix(own_values[first] ^ _U(0xA5A5A5A5A5A5A5A5)))
        nodes.append(np.full(p, node[i]))
    return np.concatenate(keys), np.concatenate(nodes)


def _sets_of(batch, size):
    """Slices of a batch (.., text last): rows, distinct sets, offsets, set hashes."""
    raw, off = T.text_buffers(batch.column(batch.num_columns - 1))
    for i, j in T.slices(off):
        o = off[i: j + 1]
        values, so = T.shingle_sets(raw[o[0]: o[-1]], o - o[0], size)
        yield i, j, values, so, T.set_hash(values, so).view(np.int64)


def _sizes_fn(size):
    """Size and hash of each text's set, and (with ``common``) the shingles that many sets of a run share."""

    def run(batches):
        T.frugal()
        held, total, nodes, blank = [], 0, [], None

        def shared():
            _, first = np.unique(np.concatenate(nodes), return_index=True)
            s, c = np.unique(np.concatenate([held[i] for i in first]), return_counts=True)
            s, c = s[c >= _COMMON_IN_RUN], c[c >= _COMMON_IN_RUN]
            return pa.RecordBatch.from_arrays([pa.nulls(len(s), blank), pa.array(c), pa.array(s.view(np.int64)), pa.array(np.ones(len(s), bool))], ["id", "n", "node", "common"])

        for batch in batches:
            blank = batch.column(0).type
            for i, j, values, so, node in _sets_of(batch, size):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(so)), pa.array(node), pa.array(np.zeros(j - i, bool))], ["id", "n", "node", "common"])
                held += [values[x:y] for x, y in zip(so[:-1], so[1:])]
                nodes.append(node)
                total += len(values)
                if total >= _COMMON_RUN:
                    yield shared()
                    held, total, nodes = [], 0, []
        if held:
            yield shared()

    return run


def _star(keys, nodes):
    """First node of each key with its other nodes, and the keys and nodes that are first."""
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    head = nodes[first][np.cumsum(first) - 1]
    link = head != nodes
    return head[link], nodes[link], keys[first], nodes[first]


def _distinct_pairs(a, b):
    if not len(a):
        return a, b
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


_PACKED = "p int, keys binary, nodes binary, a binary, b binary"


def _packed(keys, nodes, a, b, size: int) -> pa.RecordBatch | None:
    """A row for each bucket of ``size`` that has keys. Of a key's nodes one goes on, the others are linked to it here."""
    x, y, keys, nodes = _star(np.concatenate(keys), np.concatenate(nodes))
    a, b = _distinct_pairs(np.concatenate([x, *a]), np.concatenate([y, *b]))
    p = ((keys >> _U(32)) * _U(size)) >> _U(32)  # ascends with the keys
    cut = np.concatenate((np.flatnonzero(np.diff(p, prepend=~p[:1])), [len(p)]))
    rows = []
    for k, (lo, hi) in enumerate(zip(cut, cut[1:])):
        o = lo + np.argsort(nodes[lo:hi], kind="stable")
        e = slice(len(a) * k // (len(cut) - 1), len(a) * (k + 1) // (len(cut) - 1))  # links may go anywhere
        rows.append((int(p[lo]), T.planes(keys[o]), T.planes(nodes[o]), T.planes(a[e]), T.planes(b[e])))
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]], ["p", "keys", "nodes", "a", "b"])


def _keys_fn(size, threshold, buckets, common):
    """Keys of a task's documents, combined and dealt to ``buckets``."""

    def run(batches):
        T.frugal()
        keys, nodes, held, often = [], [], 0, T.received(common)
        for batch in batches:
            for _, _, values, so, node in _sets_of(batch, size):
                k, n = block_keys(values, so, node, threshold, often)
                keys.append(k)
                nodes.append(n)
                held += len(k)
                if held >= _FLUSH:
                    yield _packed(keys, nodes, [], [], buckets)
                    keys, nodes, held = [], [], 0
        if held:
            yield _packed(keys, nodes, [], [], buckets)

    return run


def _redeal_fn(buckets):
    """The rows of a partition, which hold few buckets, combined again and dealt to more ``buckets``."""

    def run(batches):
        T.frugal()
        held, n = ([], [], [], []), 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("keys", "nodes", "a", "b"))):
                for out, x, t in zip(held, row, (_U, np.int64, np.int64, np.int64)):
                    out.append(T.from_planes(x, t))
                n += len(held[0][-1]) + len(held[2][-1])
                if n >= _FLUSH:
                    yield _packed(*held, buckets)
                    held, n = ([], [], [], []), 0
        if n:
            yield _packed(*held, buckets)

    return run


def deal_steps(buckets: int, most: int | None = None) -> list[int]:
    """Numbers of buckets after each step, each at most ``most`` (FAN) times the one before; the last is at least ``buckets``."""
    most, steps = most or FAN, 1
    while most ** steps < buckets:
        steps += 1
    fan = next(f for f in range(1, most + 1) if f ** steps >= buckets)
    return [fan ** k for k in range(1, steps + 1)]


def _meet(table: pa.Table) -> pa.Table:
    """A spanning forest of the links among the nodes that share a key of this bucket."""
    T.frugal()
    col = lambda c, t: np.concatenate([T.from_planes(x.as_py(), t) for x in table[c]])
    a, b, _, _ = _star(col("keys", _U), col("nodes", np.int64))
    a, b = _distinct_pairs(np.concatenate((a, col("a", np.int64))), np.concatenate((b, col("b", np.int64))))
    if len(a):
        a, b = components(a, b)
        a, b = a[a != b], b[a != b]
    return pa.table({"a": a, "b": b})


def _bitmap(nodes: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """A bit set over hashed nodes, at most 8 MB whatever their number (more nodes: a weaker filter)."""
    bits = 1 << min(26, max(16, (8 * count).bit_length()))
    at = F.col("node").bitwiseAND(F.lit(bits - 1))
    words = (nodes.select((at / 32).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast((node & {bits - 1}L) % 32 as int))").alias("m"))
             .groupBy("w").agg(F.bit_or("m").alias("m")).toPandas())
    out = np.zeros(bits // 32, np.uint64)
    out[words["w"].to_numpy(dtype=np.int64)] = words["m"].to_numpy(dtype=np.int64).astype(np.uint64)
    return out.astype(np.uint32), bits


def _fetch_fn(size, bitmap, bits):
    """Sets of the documents whose node may be wanted (the join that follows is exact)."""

    def run(batches):
        T.frugal()
        want = bitmap.value
        for batch in batches:
            for i, j, values, so, node in _sets_of(batch, size):
                low = (node & (bits - 1)).astype(np.int64)
                hit = np.flatnonzero((want[low >> 5] >> (low & 31).astype(np.uint32)) & np.uint32(1))
                if len(hit):
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(hit + i)), pa.array(node[hit]),
                        pa.array([values[so[x]: so[x + 1]].tobytes() for x in hit], pa.binary())], ["fid", "fnode", "items"])
    return run


def product_tile(side, sets, across: bool, threshold: Fraction):
    """Linked pairs of a tile, row by row: (position, later positions linked to it), by accumulating overlap counts.

    ``across``: only pairs of the two sides (0 and 1) count. Nothing of a row is kept for the next."""
    size = np.array([len(s) for s in sets])
    items = np.concatenate(sets) if len(sets) else np.zeros(0, _U)
    row = np.repeat(np.arange(len(sets)), size)
    _, col = np.unique(items, return_inverse=True)
    order = np.argsort(col, kind="stable")
    by_col, ptr = row[order], np.concatenate(([0], np.cumsum(np.bincount(col)))) if len(col) else np.zeros(1, int)
    start = np.concatenate(([0], np.cumsum(size)))
    num, den = threshold.numerator, threshold.denominator
    for i in range(len(sets)):
        c = col[start[i]: start[i + 1]]
        many = ptr[c + 1] - ptr[c]
        c = c[many > 1]
        if not len(c):
            continue
        many = ptr[c + 1] - ptr[c]
        ends = np.cumsum(many)
        who = by_col[np.arange(ends[-1]) - np.repeat(ends - many - ptr[c], many)]
        overlap = np.bincount(who[who > i] - i, minlength=len(sets) - i)
        # the bound: overlap >= t/(1+t) * (a + b)
        hit = np.flatnonzero((num + den) * overlap >= num * (size[i] + size[i:]))
        hit = hit[(hit > 0) & (overlap[hit] > 0)] + i
        if across:
            hit = hit[side[hit] != side[i]]
        if len(hit):
            yield i, hit


def _most_common(read: DataFrame) -> Common:
    """The common shingles, at most _COMMON_MOST: those above a count that leaves no more."""
    counted = read.groupBy("node").agg(F.sum("n").alias("n"))
    steps = counted.groupBy("n").count().orderBy(F.desc("n")).limit(_COMMON_MOST).toPandas()
    inside = steps["n"][steps["count"].cumsum() <= _COMMON_MOST]
    got = counted.where(F.col("n") >= (int(inside.min()) if len(inside) else 1 << 62)).toPandas()
    return Common(got["node"].to_numpy(np.int64).view(_U), got["n"].to_numpy(np.int64))


def _tile_fn(threshold):
    def run(table: pa.Table) -> pa.Table:
        T.frugal()
        node, at = np.unique(table["node"].to_numpy(), return_index=True)  # a document that is there twice counts once
        side, copies = table["side"].to_numpy()[at], table["copies"].to_numpy()[at]
        sets = [np.frombuffer(table["items"][int(i)].as_py(), _U) for i in at]
        linked = Linked(copies)
        for i, hit in product_tile(side, sets, table["across"][0].as_py(), threshold):
            linked.add_row(i, hit)
        # of the links a spanning forest goes on, and each row's number of them
        a, b = linked.forest()
        got = linked.links > 0
        return pa.table({
            "a": np.concatenate((node[a], node[got])), "b": np.concatenate((node[b], node[got])),
            "links": np.concatenate((np.zeros(len(a), np.int64), linked.links[got]))})
    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: Fraction = Fraction(4, 5), size: int = 5) -> DataFrame:
    """(id, n_shingles, component_id, n_links) for each row of ``docs``, in any number of partitions.

    Two rows link when their distinct ``size``-word shingle sets have a Jaccard similarity of at
    least ``threshold``; fewer words form one shingle, and rows with equal non-empty sets link.
    component_id is the smallest id reachable by links (the row's own included); n_links counts the
    linked rows. Null and empty texts have no shingles: they link with nothing and keep their own id.
    Repeated rows are rows of their own that link with each other; a null id counts as no id, so its
    row gets the smallest non-null id of its component (null if there is none). Very long texts are
    read whole: words and shingles are made some at a time, and a set is one row of its tile. Other
    columns of ``docs`` are not read. No rows give an empty table.
    """
    with T.lean_batches(docs.sparkSession):  # all that Python does runs in here
        return _components(docs, id_col, text_col, threshold, size)


def _components(docs: DataFrame, id_col: str, text_col: str, threshold: Fraction, size: int) -> DataFrame:
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    read = materialize(base.mapInArrow(_sizes_fn(size), f"id {id_type}, n long, node long, common boolean"), release=True)
    rows = read.where("NOT common")
    common = T.send(spark, _most_common(read.where("common")))
    total = rows.agg(F.sum("n")).first()[0] or 0
    sets = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("sid"), F.count("*").alias("copies"), F.first("n").alias("n"))
    buckets = max(1, -(-int(total * _KEYS_EACH) // _BUCKET))

    first, *more = deal_steps(buckets, max(FAN, _FLUSH // _ROW_KEYS))  # the rows of a flush do not grow with the number of buckets beyond that
    packed = base.select("text").mapInArrow(_keys_fn(size, threshold, first, common), _PACKED)
    for buckets in more:
        packed = packed.repartition(first, "p").mapInArrow(_redeal_fn(buckets), _PACKED)
        first = buckets
    pairs = packed.repartition(first, "p").groupBy("p").applyInArrow(_meet, "a long, b long")
    cand = connected_components(pairs, reduced=True)
    cand = materialize(cand.join(sets, "node"), release=True)
    n_cand, = cand.agg(F.count("*")).first()
    bitmap, bits = _bitmap(cand.select("node"), n_cand)
    fetched = base.mapInArrow(_fetch_fn(size, spark.sparkContext.broadcast(bitmap), bits), f"fid {id_type}, fnode long, items binary")

    # a row weighs its shingles, or its share of TILE_ROWS if that is more, so tiles are bounded in rows too
    cand = cand.withColumn("load", F.greatest("n", F.lit(-(-TILE // TILE_ROWS))))
    weight = cand.groupBy("comp").agg(F.sum("load").alias("w"))
    small = weight.where(F.col("w") <= TILE).agg(F.sum("w")).first()[0] or 0
    packs = max(1, -(-int(small) // TILE))
    # rows of a large component are tiled by size class: partners are in the same class or the next one
    step = float(1 / threshold) * 1.01
    classed = cand.join(weight, "comp").withColumn("class", F.when(F.col("w") > TILE, F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(step))))).otherwise(0).cast("int"))
    tiles = classed.where(F.col("w") > TILE).groupBy("comp", "class").agg(F.ceil(F.sum("load") / TILE).cast("int").alias("tiles"))
    up, down = (tiles.select(F.col("comp").alias(f"{x}_comp"), (F.col("class") + d).alias(f"{x}_class"), F.col("tiles").alias(f"{x}_tiles")) for x, d in (("up", -1), ("down", 1)))
    tiles = tiles.join(up, (F.col("comp") == F.col("up_comp")) & (F.col("class") == F.col("up_class")), "left").join(
        down, (F.col("comp") == F.col("down_comp")) & (F.col("class") == F.col("down_class")), "left")
    tiles = materialize(tiles.select(F.col("comp").alias("of"), F.col("class").alias("of_class"), "tiles", F.coalesce("up_tiles", F.lit(0)).alias("up_tiles"), F.coalesce("down_tiles", F.lit(0)).alias("down_tiles")), release=True)
    upto = lambda n: F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(1), n)
    cell = lambda low, across, i, j, side: F.struct(low.alias("low"), across.alias("across"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    # cells: with each tile of its own class (of two, the lower is side 0), of the class above and of the class below
    own = F.transform(upto(F.col("tiles")), lambda x: F.when(F.col("tile") <= x, cell(F.col("class"), F.col("tile") != x, F.col("tile"), x, 0)).otherwise(cell(F.col("class"), F.lit(True), x, F.col("tile"), 1)))
    above = F.transform(upto(F.col("up_tiles")), lambda x: cell(F.col("class"), F.lit(True), F.col("tile"), -1 - x, 0))
    below = F.transform(upto(F.col("down_tiles")), lambda x: cell(F.col("class") - 1, F.lit(True), x, -1 - F.col("tile"), 1))
    zero = F.lit(0)
    placed = (
        classed.join(bounded(tiles), (F.col("comp") == F.col("of")) & (F.col("class") == F.col("of_class")), "left")
        .withColumn("big", F.col("tiles").isNotNull())
        .withColumn("tile", F.coalesce(F.pmod(F.xxhash64("node"), "tiles"), zero).cast("int"))
        .withColumn("grp", F.when(F.col("big"), F.col("comp")).otherwise(F.pmod(F.xxhash64("comp"), F.lit(packs))))
        .join(fetched, (F.col("node") == F.col("fnode")) & F.col("sid").eqNullSafe(F.col("fid")))
        .withColumn("cell", F.explode(F.when(F.col("big"), F.concat(own, above, below)).otherwise(F.array(cell(zero, F.lit(False), zero, zero, 0)))))
        .select("big", "grp", "cell.low", "cell.across", "cell.i", "cell.j", "cell.side", "node", "copies", "items")
    )
    linked = materialize(placed.groupBy("big", "grp", "low", "across", "i", "j").applyInArrow(_tile_fn(threshold), "a long, b long, links long"), release=True)

    comps = connected_components(linked.where("a <> b"), reduced=True)
    links = linked.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("more"))
    named = sets.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = named.groupBy("comp").agg(F.min("sid").alias("component_id"))
    found = named.join(least, "comp").join(links, "node", "left").select(
        F.col("node").alias("of"), "component_id", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    return rows.join(found, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"))
