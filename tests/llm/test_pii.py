"""Patterns against plain regular expressions, messages against enumeration, and consistency across a text."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from rowgauge.llm import pii
from rowgauge.llm.pii import base_spans, beliefs, find_pii, tokens_of, train

# as the contract words them
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, s):
    digits = re.sub(r"[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in double) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in re.finditer(p, text) if holds(k, m[0])]


@pytest.mark.parametrize("alphabet", ["a@.1-+ ", "0123456789. ", "4 -1+()", "ab@.%_é ", "192.168@+ a"])
def test_patterns(alphabet):
    rng = random.Random(alphabet)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60)))
        assert base_spans(text) == plain(text), text


def test_known_spans_and_long_runs():
    text = "é x@y.org, 4111 1111-1111 1111; +1 (017) 555-7713 at 10.0.0.255 or 10.0.0.256"
    assert base_spans(text) == plain(text) and [s[0] for s in base_spans(text)] == ["email", "ip", "card", "phone"]
    for long in ("9" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 100_000, "+1" + "(" * 200_000, "0" * 5000 + ".1.1.1"):
        base_spans(long)


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(1)
    own = rng.normal(size=(4, 3))
    edges = np.array([(0, 1), (1, 2), (1, 3)])
    between = np.array([m + m.T for m in rng.normal(size=(3, 3, 3))])
    want = np.zeros((4, 3))
    for y in itertools.product(range(3), repeat=4):
        score = sum(own[i, y[i]] for i in range(4)) + sum(between[e][y[a], y[b]] for e, (a, b) in enumerate(edges))
        for i in range(4):
            want[i, y[i]] += np.exp(score)
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(beliefs(own, edges, between, rounds=60), want, atol=1e-9)


def test_edges_stay_in_proportion():
    text = "4111111111111111 " * 500
    t = tokens_of(text, base_spans(text))
    assert len(t.spans) == 500 and len(t.skip) < 1000 and len(t.chain) == 499


def card(rng):
    digits = [rng.randrange(10) for _ in range(15)]
    for last in range(10):
        if pii.luhn("".join(map(str, [*digits, last]))):
            return "".join(map(str, [*digits, last]))


def corpus(rng, n):
    for i in range(n):
        number = card(rng)
        phone = f"+{rng.randrange(1, 9)} ({rng.randrange(100, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"
        yield i, f"the {number} of {rng.randrange(10**15, 10**16 - 1)} and {phone} in {rng.randrange(2100)} then {number} it {phone} {rng.randrange(99)} ok"


def test_consistency_across_a_document(spark):
    rng = random.Random(5)
    docs = spark.createDataFrame(list(corpus(rng, 400)), "doc_id long, text string")
    field = train(docs)
    number = card(rng)
    dotted = ".".join(number[i : i + 4] for i in range(0, 16, 4))
    other = "1234.5678.9012.3457"
    rows = [
        (1, f"the {number} of it\n" + "word " * 300 + f"and {dotted} again", "x"),
        (2, f"and {other} again in 2024", "x"),
        (3, None, "x"),
        (4, "", None),
        (5, "no data here", "x"),
        (None, f"card {number}", "x"),
        (1, f"the {number} of it\n" + "word " * 300 + f"and {dotted} again", "x"),
    ]
    found = find_pii(spark.createDataFrame(rows, "doc_id long, text string, base string"), field).collect()
    first = [r for r in found if r["doc_id"] == 1]
    at = rows[0][1].index(dotted)
    assert [tuple(s) for s in first[0]["base"]] == [("card", 4, 20)]
    assert [tuple(s) for s in first[0]["added"]] == [("card", at, at + 19)] and first[0] == first[1]
    assert all(not r["added"] for r in found if r["doc_id"] in (2, 3, 4, 5))
    assert [tuple(s) for r in found if r["doc_id"] is None for s in r["base"]] == [("card", 5, 21)]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    assert train(docs) is None and train(docs.limit(0)) is None
    assert [r["base"] for r in find_pii(docs, None).collect()] == [[], []]
    assert find_pii(docs.limit(0), None).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    found = {r["doc_id"]: r for r in find_pii(docs, train(docs)).collect()}
    n = added = 0
    for d in docs.collect():
        r = found[d["doc_id"]]
        base = sorted(plain(d["text"]), key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert [tuple(s) for s in r["base"]] == base
        n, added = n + len(base), added + len(r["added"])
    assert n > 50 and added <= 0.03 * n + 2


def test_sample_of_any_ids(spark, monkeypatch):
    """Null or repeated ids, and many copies of a row, change nothing in what is learned."""
    from rowgauge.llm import pii

    monkeypatch.setattr(pii, "TRAIN_DOCS", 100)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = train(docs)
    for other in (docs.selectExpr("CAST(NULL AS bigint) AS doc_id", "text"), docs.selectExpr("1L AS doc_id", "text"), docs.union(docs)):
        got = train(other)
        assert all((a == b).all() if hasattr(a, "all") else a == b for a, b in zip(vars(got).values(), vars(want).values()))
