"""Personal data by a skip-chain conditional random field.

A text's nodes are the spans of four base patterns (e-mail, IP address, card, phone), whose labels
are fixed, and candidate mentions outside them: digit groups, spelled-out addresses, names that an
address in the text has before its "@". Neighbouring nodes are linked in a chain; distant nodes with
the same or similar content (equal digits, equal ending digits, equal names) are linked by skip
edges, each occurrence to the one before it and to the content's first known node of each label.
Sum-product messages pass over the loopy graph until they settle, so that mentions of one entity get
one label. Weights are fitted by pseudo-likelihood on a bounded number of
the documents with base spans, for each kind, whose spans are repeated in other spellings.
"""

from __future__ import annotations

import pickle
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as T

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_DOCS = 20_000  # documents that the weights are fitted on at most
SETTLED = 1e-5  # a text whose messages change by no more is done
PATIENCE = 1000  # rounds after which messages that still swing are damped more and more, so that they settle

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a run of digits is tried from its first digit only: from a later one it fails likewise
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_GROUP = re.compile(r"\(?[0-9](?:[().\x20/-]{0,3}[0-9])+")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]{1,63})+")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_CUES = [re.compile(x, re.IGNORECASE) for x in (r"mail|contact|write to", r"\bip\b|host|server|addr", r"card|visa|credit|amex|account", r"tel|phone|call|fax|mobile|cell")]
N_FEATURES = 27


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches: the longest run of address characters before an "@", not before the last match."""
    done = 0
    for m in _DOMAIN.finditer(text):
        at = lo = m.start()
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        if lo < at:
            yield lo, m.end()
            done = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches, by start and kind."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(int(x[-4:]) <= 255 and not x[:-4].strip("0") for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def _spell(s: str) -> str:
    s = re.sub(r"\x20?[\[(]at[\])]\x20?", "@", s, flags=re.IGNORECASE)
    return re.sub(r"\x20?[\[(]dot[\])]\x20?", ".", s, flags=re.IGNORECASE).lower()


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


_SEPARATORS = [re.compile(x) for x in (r"[^0-9]*/[^0-9]*", r"[^0-9]{3,}", r"[^0-9]{2,}", r"\x20", r"\.", r"[^0-9]")]  # the strongest first


def _numbers(text: str, a: int, b: int, level: int = 0) -> list[tuple[int, int]]:
    """The numbers of 7 to 19 digits in a digit group; one with more digits is parted at its strongest separators.

    Parts that are too short for a number are joined again: by the period of their lengths, else up to 19 digits.
    A run of more than 19 digits is no number of a known kind."""
    n = len(_digits(text[a:b]))
    if n <= 19:
        return [(a, b)] if n >= 7 else []
    while level < len(_SEPARATORS) and not (cuts := [m.span() for m in _SEPARATORS[level].finditer(text, a + (text[a] == "("), b)]):
        level += 1
    if level == len(_SEPARATORS):
        return []
    # an opening bracket belongs to the number that it begins
    parts = list(zip([a] + [y - (text[y - 1] == "(") for _, y in cuts], [x for x, _ in cuts] + [b]))
    out, short = [], []
    for x, y in [*parts, (b, b)]:
        size = len(_digits(text[x:y]))
        if 0 < size < 7:
            short.append((x, y, size))
            continue
        out += _joined(short)
        short = []
        out += _numbers(text, x, y, level + 1)
    return out


def _joined(parts: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Neighbouring short parts (start, end, digits) as numbers."""
    sizes = [n for _, _, n in parts]
    for p in range(1, min(19, len(sizes)) + 1):
        if 7 <= sum(sizes[:p]) <= 19 and len(sizes) % p == 0 and sizes[p:] == sizes[:-p]:
            return [(parts[i][0], parts[i + p - 1][1]) for i in range(0, len(parts), p)]
    out, held = [], 0
    for x, y, n in parts:
        if out and held + n <= 19:
            out[-1], held = (out[-1][0], y, held + n), held + n
        else:
            out.append((x, y, n))
            held = n
    return [(x, y) for x, y, n in out if n >= 7]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Mentions outside base spans that may be personal data, in order, not overlapping."""
    taken = sorted((a, b) for a, _, b in base)
    found = [x for m in _GROUP.finditer(text) for x in _numbers(text, *m.span())] if _DIGIT.search(text) else []
    low = text.lower() if "at" in text or "AT" in text else ""
    if "(at)" in low or "[at]" in low:
        found += [m.span() for m in _SPELLED.finditer(text)]
    names = {text[a:b].split("@")[0].lower() for a, k, b in base if k == 0}
    names = {n for n in names if len(n) >= 5 and not n.isalpha()}
    if names:
        for m in _NAME.finditer(text):
            n = m[0].rstrip(".").lower()
            if n in names:
                found.append((m.start(), m.start() + len(n)))
    out, end, i = [], 0, 0
    reach = 0
    for a, b in sorted(found, key=lambda x: (x[0], -x[1])):
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if a >= end and a >= reach:
            out.append((a, b))
            end = b
    return out


def features(text: str, a: int, b: int) -> list[int]:
    s, before = text[a:b], text[max(0, a - 24): a]
    d = _digits(s)
    n = len(d)
    named = "@" in s or "(at)" in s.lower() or "[at]" in s.lower()
    parts = s.split(".")
    address = len(parts) == 4 and all(p.isdigit() and len(p) < 4 and int(p) <= 255 for p in parts)
    return [1, *(int(n == k) for k in range(7, 12)), int(12 <= n <= 15), int(n == 16), int(n > 16), int(n == 0), int(0 < n < 7), int(s[:1] == "+"), int("(" in s), int("-" in s), int(" " in s), int("." in s),
            int("/" in s), int(12 <= n <= 19 and luhn(d)), int(named), int(address), int(any("a" <= c.lower() <= "z" for c in s)), int(n > 0 and n == len(s)), int(len(s) > 2 * n), *(int(bool(c.search(before))) for c in _CUES)]


def keys(s: str) -> list[str]:
    """What makes two mentions the same or similar: their digits, their last seven digits, their address or its name."""
    spelled = _spell(s)
    if "@" in spelled:
        return ["a" + spelled, "n" + spelled.split("@")[0]]
    d = _digits(s)
    if any(c.isalpha() for c in s):
        return ["n" + s.lower()]
    return ["d" + d, "e" + d[-7:]] if len(d) >= 7 else ["d" + d + s]


class Graph:
    """Nodes and edges of many texts."""

    def __init__(self):
        self.features: list[list[int]] = []
        self.labels: list[int] = []  # -1: not known
        self.chain: list[tuple[int, int]] = []
        self.skip: list[tuple[int, int]] = []
        self.first: list[int] = []  # first node of each text

    def add(self, text: str, nodes: list[tuple[int, int, int]]) -> int:
        """Add a text's nodes (start, end, label or -1) in order; returns the first one's number."""
        first = len(self.labels)
        self.first.append(first)
        own = [keys(text[a:b]) for a, b, _ in nodes]
        known: dict[str, dict[int, int]] = {}
        for i, (_, _, label) in enumerate(nodes, first):
            if label > 0:
                for k in own[i - first]:
                    known.setdefault(k, {}).setdefault(label, i)
        last: dict[str, int] = {}
        linked = set()

        def link(i, j):
            edge = (min(i, j), max(i, j))
            if i != j and edge not in linked:
                linked.add(edge)
                self.skip.append(edge)

        for i, (a, b, label) in enumerate(nodes, first):
            self.features.append(features(text, a, b))
            self.labels.append(label)
            if i > first and a - nodes[i - first - 1][1] <= 40:
                self.chain.append((i - 1, i))
            for k in own[i - first]:
                if k in last:
                    link(last[k], i)
                last[k] = i
                for j in known.get(k, {}).values():
                    link(j, i)
        return first


def respelled(text: str, spans: list[tuple[int, int, int]], rnd: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with some base spans repeated in other spellings, and some look-alikes, with all nodes and labels."""
    nodes = [(a, b, k + 1) for a, k, b in spans] + [(a, b, 0) for a, b in candidates(text, spans)]
    tail = [text]
    at = len(text)

    def append(s, label):
        nonlocal at
        gap = " " + "x" * rnd.randrange(0, 60) + " "
        tail.append(gap + s)
        nodes.append((at + len(gap), at + len(gap) + len(s), label))
        at += len(gap) + len(s)

    for a, k, b in spans:
        s = text[a:b]
        d = _digits(s)
        if k == 0:
            local, domain = s.split("@", 1)
            if rnd.random() < 0.5:
                append(rnd.choice([f"{local} (at) {domain}", f"{local}[at]{domain.replace('.', '[dot]')}"]), 1)
            elif len(local) >= 5 and not local.isalpha():
                append(local, 1)
        elif k >= 2:
            if rnd.random() < 0.6:
                short = d[-10:] if k == 3 and rnd.random() < 0.5 else d
                append(rnd.choice([short, "-".join(short[i:i + 3] for i in range(0, len(short), 3)), " ".join(short[i:i + 4] for i in range(0, len(short), 4)), ".".join(short[i:i + 4] for i in range(0, len(short), 4))]), k + 1)
            if rnd.random() < 0.6:  # as long, but another number
                append("".join(rnd.choice("0123456789") for _ in d), 0)
    return "".join(tail), sorted(nodes)


class Weights:
    def __init__(self):
        self.unary = np.zeros((len(LABELS), N_FEATURES))
        self.chain = np.zeros((len(LABELS), len(LABELS)))
        self.skip = 0.0
        self.trained = False


def _neighbours(graph: Graph, n: int):
    e = lambda x: np.array(x, dtype=np.int64).reshape(-1, 2)
    return e(graph.chain), e(graph.skip)


def fit(graph: Graph, steps: int = 300, rate: float = 0.1, penalty: float = 1e-3) -> Weights:
    """Pseudo-likelihood: each node's label given its features and its neighbours' labels."""
    w = Weights()
    y = np.array(graph.labels, dtype=np.int64)
    if not len(y) or not (y > 0).any():
        return w
    x = np.array(graph.features, dtype=float)
    chain, skip = _neighbours(graph, len(y))
    one = np.eye(len(LABELS))
    left, right, same = np.zeros((len(y), len(LABELS))), np.zeros((len(y), len(LABELS))), np.zeros((len(y), len(LABELS)))
    np.add.at(left, chain[:, 1], one[y[chain[:, 0]]])
    np.add.at(right, chain[:, 0], one[y[chain[:, 1]]])
    np.add.at(same, skip[:, 0], one[y[skip[:, 1]]])
    np.add.at(same, skip[:, 1], one[y[skip[:, 0]]])
    params = [w.unary, w.chain, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        score = x @ params[0].T + left @ params[1] + right @ params[1].T + params[2] * same
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        r = (p - one[y]) / len(y)
        grads = [r.T @ x, left.T @ r + r.T @ right, np.array([(r * same).sum()])]
        for i, g in enumerate(grads):
            g = g + penalty * params[i] / 10
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] -= rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    w.unary, w.chain, w.skip, w.trained = params[0], params[1], max(0.0, float(params[2][0])), True
    return w


def marginals(graph: Graph, w: Weights, rounds: int | None = None) -> np.ndarray:
    """Label probabilities of all nodes by damped sum-product messages; known labels are fixed.

    Messages are sent until they settle, each text's for themselves, or ``rounds`` times."""
    n, k = len(graph.labels), len(LABELS)
    unary = np.array(graph.features, dtype=float).reshape(n, -1) @ w.unary.T
    known = np.array(graph.labels)
    fixed = known >= 0
    unary[fixed] = -1e3
    unary[np.flatnonzero(fixed), known[fixed]] = 0
    chain, skip = _neighbours(graph, n)
    # each edge in both directions: source, target, table[source label, target label]
    src = np.concatenate((chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]))
    dst = np.concatenate((chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]))
    agree = w.skip * np.eye(k)
    tables = np.stack((w.chain, w.chain.T, agree, agree))
    kind = np.repeat([0, 1, 2, 3], [len(chain), len(chain), len(skip), len(skip)])
    back = np.concatenate((np.arange(len(chain)) + len(chain), np.arange(len(chain)), 2 * len(chain) + len(skip) + np.arange(len(skip)), 2 * len(chain) + np.arange(len(skip))))
    message = np.zeros((len(src), k))
    text = np.searchsorted(np.array(graph.first, dtype=np.int64), src, side="right")
    live, done, rate = np.arange(len(src)), 0, 0.7
    while len(live) and (rounds is None or done < rounds):
        belief = unary.copy()
        np.add.at(belief, dst[live], message[live])
        out = belief[src[live]] - message[back[live]]
        out = np.log(np.exp((out - out.max(axis=1, keepdims=True))[:, :, None] + tables[kind[live]]).sum(axis=1))
        out -= out.max(axis=1, keepdims=True)
        step = rate * (out - message[live])
        message[live] += step
        done += 1
        rate *= 1 if done < PATIENCE else 0.9
        if rounds is None:
            moved = np.zeros(len(graph.first) + 1)
            np.maximum.at(moved, text[live], np.abs(step).max(axis=1))
            live = live[moved[text[live]] > SETTLED]
    belief = unary.copy()
    np.add.at(belief, dst, message)
    p = np.exp(belief - belief.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def find_spans(texts: list[str], w: Weights) -> list[tuple[list, list]]:
    """For each text its base spans and all spans, as (start, kind, end) by start and kind."""
    graph, places = Graph(), []
    for text in texts:
        base = base_spans(text)
        more = candidates(text, base) if w.trained else []
        places.append((base, more, 0, []))
        if more:
            nodes = sorted([(a, b, k + 1) for a, k, b in base] + [(a, b, -1) for a, b in more])
            places[-1] = (base, more, graph.add(text, nodes), nodes)
    p = marginals(graph, w) if graph.labels else None
    out = []
    for base, _, first, nodes in places:
        extra = []
        for i, (a, b, label) in enumerate(nodes, first):
            if label < 0:
                best = int(np.argmax(p[i]))
                if best and p[i, best] >= 0.5:
                    extra.append((a, best - 1, b))
        out.append((base, sorted(base + extra)))
    return out


def _kinds_fn(batches):
    """(kind, hash) of the base patterns that each text holds."""
    for batch in batches:
        held = [(k, h) for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for k in {k for _, k, _ in base_spans(text)}]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int32()), pa.array([h for _, h in held], pa.int64())], ["kind", "h"])


def _sample_fn(seed):
    """The training graph of each run of sampled documents, pickled."""

    def run(batches):
        for batch in batches:
            graph = Graph()
            for text in batch.column(0).to_pylist():
                spans = base_spans(text or "")
                if spans:
                    new, nodes = respelled(text, spans, random.Random(f"{seed} {len(text)} {spans}"))
                    graph.add(new, nodes)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((graph.features, graph.labels, graph.chain, graph.skip))], pa.binary())], ["graph"])
    return run


def training_texts(docs: DataFrame, text_col: str = "text", train_docs: int = TRAIN_DOCS, seed: int = 1) -> DataFrame:
    """(h, t): for each kind, of the different texts that hold its base pattern those of the smallest hashes.

    A kind has at most a quarter of ``train_docs`` texts, all if it has no more, and at least one if
    any text holds it, however rare it is."""
    h = F.xxhash64("t", F.lit(seed)).bitwiseAND(F.lit((1 << 62) - 1))
    rows = docs.select(F.col(text_col).cast("string").alias("t")).where(F.col("t").rlike("[0-9@]")).select(h.alias("h"), "t")
    seen = T.stored(rows.mapInArrow(_kinds_fn, "kind int, h long").distinct())
    # hashes are counted by the logarithm's sixteenths, a bounded table; a kind's last step is the one that still fits
    step = F.floor(F.log2(F.col("h") + 1.0) * 16).cast("int")
    last = {}
    total = dict.fromkeys(range(len(KINDS)), 0)
    for r in seen.groupBy("kind", step.alias("step")).count().orderBy("kind", "step").collect():
        total[r.kind] += r["count"]
        if total[r.kind] <= train_docs // len(KINDS) or r.kind not in last:
            last[r.kind] = r.step
    if not last:
        return rows.limit(0)
    fits = F.lit(False)
    for k, most in last.items():
        fits = fits | ((F.col("kind") == k) & (step <= most))
    return rows.join(F.broadcast(seen.where(fits).select("h").distinct()), "h", "left_semi").dropDuplicates(["h"])  # about train_docs hashes


def trained_weights(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", train_docs: int = TRAIN_DOCS, seed: int = 1) -> Weights:
    """Weights fitted on texts that hold base spans, ``train_docs`` of them at most, each kind's share by hash."""
    whole = Graph()
    for row in training_texts(docs, text_col, train_docs, seed).select("t").mapInArrow(_sample_fn(seed), "graph binary").collect():
        f, y, chain, skip = pickle.loads(row.graph)
        at = len(whole.labels)
        whole.features += f
        whole.labels += y
        whole.chain += [(a + at, b + at) for a, b in chain]
        whole.skip += [(a + at, b + at) for a, b in skip]
    return fit(whole)


def _scan_fn(shared):
    def run(batches):
        w = T.received(shared)
        for batch in batches:
            _, off = T.text_buffers(batch.column(1))
            for i, j in T.slices(off):
                texts = [t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]
                found = find_spans(texts, w)
                write = lambda spans: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
                count = [pa.array([sum(s[1] == k for s in base) for base, _ in found], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *count, pa.array([write(b) for b, _ in found]), pa.array([write(s) for _, s in found])],
                                                 ["id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"])
    return run


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: Weights | None = None) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_spans, spans) for each row of ``docs``.

    The counts are of base spans; spans has those and the mentions that the field labels, each as
    ``kind:start:end`` in code points, by start and then kind, comma-joined. A null text is an empty
    one and has none. Very long texts are searched whole; their field has a few edges a mention, so
    it grows with the mentions alone. Repeated rows get the same result each; ids may repeat or be
    null. Other columns are not read. Only where no document has base spans are there no weights, and nothing is added.
    """
    w = weights or trained_weights(docs, id_col, text_col)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, spans string"
    return base.mapInArrow(_scan_fn(T.send(docs.sparkSession, w)), schema).withColumnRenamed("id", id_col)
