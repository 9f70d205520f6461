"""The forest against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from rowgauge.llm import neighbours
from rowgauge.llm.neighbours import build, lifted, nearest, share_to_search

def every():
    return F.pmod(F.col("vec_id"), F.lit(20)) == 0


def brute(rows, k=20):
    """By query: its true neighbours, the same measure and ties."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in good:
        if q % 20 == 0:
            near = sorted((-(v * w).sum(), i) for i, w in good if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, true):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in near}) for q, near in true.items())
    return hits / max(1, sum(map(len, true.values())))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_given_vectors(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    true = brute([(r["vec_id"], r["embedding"]) for r in vectors.select("vec_id", "embedding").collect()])
    found = answers(nearest(vectors, every()))
    assert found.keys() == true.keys() and all(len(x) == 20 for x in found.values())
    assert recall(found, true) >= 0.92
    exact = {q: dict(near) for q, near in true.items()}
    for q, near in found.items():
        assert all(exact[q].get(i, s) == s for i, s in near)


def test_tiny_odd_and_copies(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=3).round(2)]) for i in range(200)]
    rows += [(1000 + i, [0.5, 0.5, 0.5]) for i in range(150)]  # a common vector
    rows += [(2000, None), (2020, [0.0] * 3), (2040, [1.0, None, 2.0]), (2060, [1.0, float("nan"), 0.0])]
    rows += [(2080, [float("inf"), 0.0, 0.0]), (2100, [1.0]), (None, [1.0, 0.0, 0.0]), (2120, [])]
    df = spark.createDataFrame([(*r, 9) for r in rows], "vec_id long, embedding array<float>, rank int").repartition(5)
    given = [(r["vec_id"], r["embedding"]) for r in df.collect() if not (r["embedding"] and len(r["embedding"]) == 1)]
    found, true = answers(nearest(df, every())), brute(given)
    assert found.keys() == true.keys()
    assert recall(found, true) >= 0.95
    # the common vector's own queries: ties to smaller ids, never themselves
    for q in range(1000, 1150, 20):
        near = [i for i, s in found[q] if s == 0.75]
        assert q not in near and near == sorted(near)


def test_fewer_than_asked_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    found = answers(nearest(few, every()))
    assert {q: [i for i, _ in near] for q, near in found.items()} == {0: [20, 3], 20: [0, 3]}
    assert nearest(few.limit(0), every()).count() == 0
    assert nearest(few.limit(1), every()).count() == 0


def test_query_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = answers(nearest(df, F.pmod(F.col("vec_id"), F.lit(2)) == 0, k=5))
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 30)
    assert answers(nearest(df, F.pmod(F.col("vec_id"), F.lit(2)) == 0, k=5)) == one


def test_share_falls_with_structure():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16)) * 10
    tight = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.1
    loose = rng.normal(size=(4000, 16))
    shares = []
    for x in (tight, loose):
        longest = float(np.sqrt((x**2).sum(axis=1).max()))
        shares.append(share_to_search(build(lifted(x, longest)), x, longest, 10))
    assert shares[0] < shares[1]


def test_ties_go_to_smaller_ids_wherever_they_are_met():
    """Equal scores met with large ids first: the smaller ids stay."""
    import numpy as np
    from rowgauge.llm.neighbours import _Best

    best = _Best(5)
    best.add(999, np.array([1.0, 0.0]), [1, 2])
    near = lambda ids: (np.array(ids), np.array([[1.0, float(i)] for i in ids]))
    best.search(1, *near(range(100, 140)))
    best.search(2, *near(range(40)))
    assert sorted(best.found[0].tolist()) == [0, 1, 2, 3, 4]


def test_one_id_for_all_rows(spark):
    """A row is no neighbour of its own id, so there are none; the sample is drawn by vector too."""
    rows = [(1, [float(i), 1.0]) for i in range(200)] + [(2, [5.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest(df, F.col("vec_id") == 2, k=3).collect()
    assert {(r.query_id, r.vec_id) for r in found} == {(2, 1)} and len(found) == 1
