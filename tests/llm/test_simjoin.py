"""The similarity join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from rowgauge.llm import simjoin
from rowgauge.llm.components import components
from rowgauge.llm.simjoin import depth_for, overlaps, shingles, similar_documents, word_hashes, without_near_copies


def grams(text, n=5):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset((n, *words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, threshold=0.8):
    """Per row: number of links, and the least (id, row) of its class."""
    sets = [grams(t) for _, t in rows]
    links = [[] for _ in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i].append(j)
                links[j].append(i)
    root = [None] * len(rows)
    for i in range(len(rows)):
        if root[i] is None:
            seen, queue = {i}, [i]
            while queue:
                for j in links[queue.pop()]:
                    if j not in seen:
                        seen.add(j)
                        queue.append(j)
            for j in seen:
                root[j] = min(seen, key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    return [(i, rows[r][0], len(x)) for (i, _), r, x in zip(rows, root, links)]


def near_copies(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(rng.randrange(60, 160))]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        yield " ".join(copy)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts = []
    for _ in range(25):
        texts += near_copies(rng, words, rng.randrange(1, 9), 4)
    texts += [passage + " " + t for t in texts[:15]]
    texts += texts[:10] + [t.upper().replace(" ", "  \n") for t in texts[10:20]]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


def test_words_and_sets():
    a, b = word_hashes("The  cat\tsat on"), word_hashes("the CAT sat on")
    assert (a == b).all() and len(a) == 4
    assert len(shingles("")) == len(shingles(" \n")) == 0 and len(shingles("a b c")) == 1
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdef") * rng.randrange(1, 4) for _ in range(3000))
    assert len(shingles(text)) == len(grams(text))
    stretch, simjoin.STRETCH = simjoin.STRETCH, 50
    try:
        assert (shingles(text) == whole(text, stretch)).all()
    finally:
        simjoin.STRETCH = stretch


def whole(text, stretch):
    short, simjoin.STRETCH = simjoin.STRETCH, stretch
    try:
        return shingles(text)
    finally:
        simjoin.STRETCH = short


def test_depth_shortens_to_the_recall():
    assert depth_for(0.5) > depth_for(0.9995) >= 3
    d = depth_for(0.9995)
    assert 1 - (1 - 0.8**d) ** simjoin.TREES >= 0.9995 > 1 - (1 - 0.8 ** (d + 1)) ** simjoin.TREES


def labelled(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return simjoin.signed(docs, "doc_id", "text", 5).where("node IS NOT NULL").dropDuplicates(["node"])


def test_prefixes_are_shortened_as_far_as_the_data_ask(spark):
    """Near copies with one edit in long texts are found by whole labels; looser ones need shorter prefixes."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    floor = depth_for(0.9995)

    def depths(edits, length):
        base = [rng.choice(words) for _ in range(length)]
        texts = []
        for _ in range(40):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(length)] = rng.choice(words)
            texts.append(" ".join(copy))
        found = simjoin.candidate_edges(labelled(spark, texts), 0.8, floor).where("b IS NOT NULL").collect()
        return [r["depth"] for r in found]

    close, loose = depths(1, 2000), depths(4, 250)
    assert sum(d == simjoin.MAX_DEPTH for d in close) > 0.9 * len(close)
    assert min(loose) == floor and sum(loose) / len(loose) < sum(close) / len(close) - 1


@pytest.mark.parametrize("floor", [2, 4, 6])
def test_descent_against_all_pairs_of_a_run(floor):
    rng = np.random.default_rng(floor)
    least = simjoin.fewest_bits()
    for n in (2, 3, 40, 200):
        hashes = np.cumsum(rng.random((n, simjoin.MAX_DEPTH)) < 0.2, axis=1) * (rng.integers(0, 3, (n, 1)) + 1)
        hashes[:, :floor] = 7
        packed = [sum(hashes[:, 4 * h + i].astype(np.int64) << (48 - 16 * i) for i in range(4)) for h in (0, 1)]
        order = np.lexsort(packed[::-1])
        high, low = packed[0][order], packed[1][order]
        sizes = rng.integers(80, 130, n)
        bits = rng.integers(0, 1 << 63, (6, 2), dtype=np.uint64)[rng.integers(0, 6, n)]
        small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
        near = (small >= 0.8 * large - 1e-9) & (np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2) <= simjoin.HASHES - least)
        want = partition(n, zip(*np.nonzero(near)))
        found = list(simjoin.descend(high, low, sizes, bits, floor, 0.8, least))
        assert partition(n, [(a, b) for a, b, _ in found]) == want
        assert len(found) == n - len(set(want))  # a forest
        for a, b, depth in found:
            assert (hashes[order][a, :depth] == hashes[order][b, :depth]).all()


def partition(n, edges):
    root = list(range(n))
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("size", [2, 7])
def test_cut_runs_are_joined(spark, monkeypatch, size):
    """Runs cut everywhere give the cells of runs that are whole."""
    nodes = simjoin.settle(labelled(spark, [t for _, t in corpus(5)]), "test-nodes")
    floor = depth_for(0.9995)

    def cells():
        by_cell = {}
        for r in simjoin.candidate_cells(nodes, 0.8, floor).collect():
            by_cell.setdefault(r["cell"], set()).add(r["node"])
        return sorted(sorted(c) for c in by_cell.values())

    whole_runs = cells()
    monkeypatch.setattr(simjoin, "SLICE", size)
    monkeypatch.setattr(simjoin, "BLOCK", size)
    assert cells() == whole_runs and max(map(len, whole_runs)) >= 8


def test_overlaps_by_matrix():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 5000, rng.integers(1, 900))).astype(np.uint64) for _ in range(70)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[40:]] for a in sets[:40]]
    assert overlaps(sets[:40], sets[40:]).tolist() == want


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    found = similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == sorted(brute(rows))


def test_one_large_class_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    rows = list(enumerate(near_copies(rng, words, 150, 3)))
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    want = sorted(brute(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(simjoin, "BLOCK", 32)
    found = similar_documents(docs).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, "One  two"), (None, "one two"), (None, "a b c d e f g"), (7, "x"), (7, "x"), (8, "y " * 30_000), (9, "Y " * 30_001)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, class_id int")
    found = similar_documents(docs).collect()
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in found), key=repr)
    assert got == sorted(brute(rows), key=repr)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, None, None, 7, 8], key=repr)
    assert similar_documents(docs.limit(0)).count() == 0 and without_near_copies(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    want = {(x, top(x)) for e in edges if e[0] != e[1] for x in e}
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["root"]) for r in found} == want and len(found) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = similar_documents(docs).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == sorted(brute(rows))
