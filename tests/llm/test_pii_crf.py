"""Personal data: base patterns against re, messages against enumeration, labels on held-out respellings."""

import itertools
import random
import re

import numpy as np
import pytest

from ledgerlens.llm import pii_crf as P

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_base(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(x) > 255 for x in m[0].split(".")) or k == 2 and not (12 <= len(d) <= 19 and P.luhn(d)) or k == 3 and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def random_text(rnd):
    bits = ["a.b@c.d", "@", ".", "x@y", "a@b.c@d.e", "1", "23", " ", "-", "+", "(", ")", "255.1.2.3", "1.2.3.4.5.6.7.8", "300.1.1.1", "4111 1111 1111 1111", "+1 (736) 555-2678", "é", "000255.0.0.1", "word ", "\n", "_%+-@q-.z",
            "49927398716 8", "+12.3.4.5.6.7.8.9"]
    return "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 20)))


def test_base_spans_match_the_patterns():
    rnd = random.Random(1)
    for _ in range(20000):
        text = random_text(rnd)
        assert P.base_spans(text) == brute_base(text), repr(text)


def test_base_spans_of_long_runs_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "a." * 100_000 + "@", "1." * 100_000, "+1" * 100_000, "a@" * 100_000, "1 " * 100_000, "(1" * 100_000):
        P.find_spans([text], P.Weights())
        P.candidates(text, P.base_spans(text))


def tiny_graph(rnd, tree):
    g = P.Graph()
    n = 5
    g.features = [[rnd.random() for _ in range(P.N_FEATURES)] for _ in range(n)]
    g.labels = [-1, 2, -1, -1, -1]
    g.chain = [(0, 1), (1, 2)] if tree else [(0, 1), (1, 2), (2, 3), (3, 4)]
    g.skip = [(0, 3), (3, 4)] if tree else [(0, 3), (1, 4)]
    w = P.Weights()
    r = np.random.default_rng(rnd.randrange(1000))
    w.unary, w.chain, w.skip, w.trained = r.normal(size=w.unary.shape) * 0.2, r.normal(size=w.chain.shape) * 0.5, 0.8, True
    return g, w


def exact(g, w):
    u = np.array(g.features) @ w.unary.T
    p = np.zeros((len(g.labels), len(P.LABELS)))
    for y in itertools.product(range(len(P.LABELS)), repeat=len(g.labels)):
        if any(a >= 0 and a != b for a, b in zip(g.labels, y)):
            continue
        s = sum(u[i, b] for i, b in enumerate(y) if g.labels[i] < 0) + sum(w.chain[y[a], y[b]] for a, b in g.chain) + sum(w.skip * (y[a] == y[b]) for a, b in g.skip)
        for i, b in enumerate(y):
            p[i, b] += np.exp(s)
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("tree,error", [(True, 1e-6), (False, 0.05)])
def test_messages_give_the_marginals(tree, error):
    """Exactly on a tree, closely on a loopy graph."""
    rnd = random.Random(3)
    for _ in range(5):
        g, w = tiny_graph(rnd, tree)
        assert np.abs(P.marginals(g, w, 60) - exact(g, w)).max() < error


def people(seed, n):
    rnd = random.Random(seed)
    num = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))

    def card():
        while True:
            d = num(16)
            if P.luhn(d):
                return rnd.choice([d, " ".join(d[i:i + 4] for i in range(0, 16, 4))])

    out = []
    for _ in range(n):
        makers = [lambda: f"u{num(3)}.{num(2)}@mail{num(1)}.example.com", lambda: f"+1 ({num(3)}) {num(3)}-{num(4)}", card, lambda: ".".join(str(rnd.randrange(256)) for _ in range(4)), lambda: "order " + num(8)]
        out.append(" lorem ipsum dolor " + " sit amet ".join(rnd.choice(makers)() for _ in range(rnd.randrange(1, 6))) + " end")
    return out


def graph_of(texts, seed):
    g = P.Graph()
    for i, t in enumerate(texts):
        g.add(*P.respelled(t, P.base_spans(t), random.Random(seed + i)))
    return g


def test_held_out_respellings_are_labelled():
    w = P.fit(graph_of(people(1, 600), 10))
    assert w.trained and w.skip > 0
    found = wanted = right = 0
    for i, t in enumerate(people(2, 300)):
        text, nodes = P.respelled(t, P.base_spans(t), random.Random(i))
        base, spans = P.find_spans([text], w)[0]
        assert base == P.base_spans(text) and set(base) <= set(spans)
        truth = {(a, k - 1, b) for a, b, k in nodes if k} - set(base)
        extra = set(spans) - set(base)
        taken = {(a, b) for a, k, b in base}
        truth = {x for x in truth if not any(a < x[2] and x[0] < b for a, b in taken)}
        found, wanted, right = found + len(extra), wanted + len(truth), right + len(extra & truth)
    assert right >= 0.9 * found and right >= 0.8 * wanted, (found, wanted, right)


def test_skip_edges_carry_the_label():
    """A number is a phone where the document writes it as one elsewhere, and is left alone otherwise."""
    w = P.fit(graph_of(people(1, 600), 10))
    _, spans = P.find_spans(["reach me: +1 (736) 555-2678 " + "word " * 100 + "17365552678 again"], w)[0]
    assert [k for _, k, _ in spans] == [3, 3]
    _, spans = P.find_spans(["word " * 100 + "17365552678 again"], w)[0]
    assert spans == []


def test_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    rows = P.personal_data(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_base(texts[r.doc_id])
        assert r.base_spans == ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in want) for k in range(4)]
        assert set(filter(None, r.base_spans.split(","))) <= set(r.spans.split(","))


def test_nulls_empty_long_repeats_and_other_columns(spark):
    rows = [(1, None), (2, ""), (3, "a.b1@c.de"), (3, "a.b1@c.de"), (None, "+1 (736) 555-2678 é"), (4, "word " * 20000 + "10.0.0.1")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_email int, spans string").repartition(3)
    got = sorted(((r.doc_id, r.base_spans) for r in P.personal_data(df).collect()), key=str)
    assert got == sorted(((i, ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in brute_base(t or ""))) for i, t in rows), key=str)


def test_empty_table(spark):
    assert P.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rare_personal_data_is_trained_on(spark):
    """One card, one address and many phones among documents without any: each kind's texts are chosen."""
    rare = ["pay 4111 1111 1111 1111 now", "from 10.0.0.1 on"]
    phones = [f"call +1 (736) 555-{i:04d}" for i in range(300)]
    texts = [f"page {i} of 9" for i in range(3000)] + rare * 3 + phones + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = [r.t for r in P.training_texts(df, train_docs=40).collect()]
    assert len(got) == len(set(got)) and set(rare) <= set(got) and 1 <= len(set(got) & set(phones)) <= 10 and set(got) <= set(rare + phones)
    assert P.trained_weights(df, train_docs=40).trained
    assert P.trained_weights(df.where("text LIKE 'pay%' OR text LIKE 'page%'"), train_docs=4).trained
    assert not P.trained_weights(df.where("text LIKE 'page%'")).trained


@pytest.mark.parametrize("phone_at", [0, 25, 50])
def test_all_repeats_of_a_number_get_its_label(phone_at):
    """Fifty plain repeats, far apart, before and after the one place with the base form."""
    w = P.fit(graph_of(people(1, 600), 10))
    mentions = ["17365552678"] * 50
    mentions.insert(phone_at, "+1 (736) 555-2678")
    text = "".join("word " * 20 + m + " " for m in mentions)
    _, spans = P.find_spans([text], w)[0]
    assert [k for _, k, _ in spans] == [3] * 51
    alone = [P.find_spans([t], w)[0] for t in (text, "word 17365552678 again")]
    assert P.find_spans([text, "word 17365552678 again"], w) == alone


def test_messages_run_until_they_settle():
    """A chain of 60 nodes whose first label is known: the messages reach the last one exactly."""
    g, w = P.Graph(), P.Weights()
    n = 60
    g.features, g.labels, g.chain = [[0] * P.N_FEATURES] * n, [3] + [-1] * (n - 1), [(i, i + 1) for i in range(n - 1)]
    w.chain, w.trained = 6 * np.eye(len(P.LABELS)), True
    step = np.exp(w.chain)
    step /= step.sum(axis=1, keepdims=True)
    assert np.abs(P.marginals(g, w)[-1] - np.linalg.matrix_power(step, n - 1)[3]).max() < 1e-2
    assert np.abs(P.marginals(g, w, 12)[-1] - np.linalg.matrix_power(step, n - 1)[3]).max() > 0.1


@pytest.mark.parametrize("text,want", [
    ("020 7946 0958 / 020 7946 0959", ["020 7946 0958", "020 7946 0959"]), ("020 7946 0958/020 7946 0959", ["020 7946 0958", "020 7946 0959"]),
    ("(020) 7946 0958 / (020) 7946 0959", ["(020) 7946 0958", "(020) 7946 0959"]), ("020 7946 0958 020 7946 0959", ["020 7946 0958", "020 7946 0959"]),
    ("17365552678 " * 50, ["17365552678"] * 50), ("020-7946-0958   020-7946-0959", ["020-7946-0958", "020-7946-0959"]), ("020 7946 0958", ["020 7946 0958"]),
    ("555-2678 / 555-2679 / 12 / 555-2680 / 17365552678", ["555-2678", "555-2679", "555-2680", "17365552678"]), ("1" * 22, []), ("12 / 34", [])])
def test_long_digit_groups_are_split(text, want):
    assert [text[a:b] for a, b in P.candidates(text, [])] == want
