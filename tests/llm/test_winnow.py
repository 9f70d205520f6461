"""Winnowing against a plain version, and neighbours against a sort."""

from __future__ import annotations

import random

import pytest
from rowgauge.llm.winnow import K, WINDOW, as_text, beside_next, edited, fingerprints, likeness, winnow


def grams(text: str, k: int) -> list[tuple[int, int]]:
    """The operator's own hash of each k-gram alone, with its place."""
    kept = [(i, c) for i, c in enumerate(text) if c.isalnum()]
    out = []
    for at in range(len(kept) - k + 1):
        run = kept[at : at + k]
        h, _ = winnow("".join(c for _, c in run), k, 1)
        out.append((int(h[0]), run[0][0]))
    return out


def plain(text: str, k: int, w: int) -> list[tuple[int, int]]:
    hashed = grams(text, k)
    w = min(w, len(hashed))
    picked = []
    for at in range(len(hashed) - w + 1):
        window = hashed[at : at + w]
        low = min(h for h, _ in window)
        best = [x for x in window if x[0] == low][-1]
        if best not in picked:
            picked.append(best)
    return picked


@pytest.mark.parametrize("seed", range(6))
def test_rightmost_minimum(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice("abAé .\n9") for _ in range(rng.randrange(20, 300)))
    k, w = rng.choice([(3, 4), (5, 7), (4, 1)])
    hashes, places = winnow(text, k, w)
    assert list(zip(hashes.tolist(), places.tolist())) == plain(text, k, w)


def test_match_guarantee():
    rng = random.Random(3)
    for _ in range(30):
        shared = "".join(rng.choice("abcdefgh") for _ in range(K + WINDOW - 1))
        a, b = ("".join(rng.choice("xyz ") for _ in range(rng.randrange(80))) + shared + "!" * rng.randrange(9) for _ in "ab")
        assert set(winnow(a)[0].tolist()) & set(winnow(b)[0].tolist())


def test_short_and_empty():
    for text in ("", " ", "...", "a", "a b", "A b"):
        assert len(winnow(text)[0]) == 1
    assert as_text(winnow("a b")[0]) == as_text(winnow("A-B")[0])
    assert likeness(winnow("")[0], winnow(".")[0]) == 0.0


@pytest.mark.parametrize("parts", [1, 7])
def test_neighbours(spark, parts):
    rng = random.Random(parts)
    rows = [(i * 3, "".join(rng.choice("abcde fg") for _ in range(rng.randrange(200))), 1) for i in range(60)]
    rows += [(None, "zz top", 1), (5, None, 1), (7, "", 1), (1000, "x" * 5000, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, places int").repartition(parts)
    found = {r.doc_id: r for r in beside_next(docs).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(found) == len(rows)
    for at, (doc_id, text, _) in enumerate(order):
        following = order[(at + 1) % len(order)][1] or ""
        text, row = text or "", found[doc_id]
        other = edited(text, following)
        assert row.n_chars == len(text)
        assert row.fingerprint == as_text(winnow(text)[0]) and row.edited_fingerprint == as_text(winnow(other)[0])
        assert row.near_edited == likeness(winnow(text)[0], winnow(other)[0])
        assert row.near_next == likeness(winnow(text)[0], winnow(following)[0])


def test_ties_one_row_and_none(spark):
    tied = spark.createDataFrame([(1, "a")] * 5 + [(2, "b")] * 3, "doc_id long, text string")
    assert sorted(r.doc_id for r in beside_next(tied).collect()) == [1] * 5 + [2] * 3
    one = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert beside_next(one).first().near_next == 1.0
    assert beside_next(one.limit(0)).count() == 0 and fingerprints(one.limit(0)).count() == 0
    assert fingerprints(one).first().places == [0]
