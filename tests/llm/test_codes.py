"""Vector codes against a plain version of the contract."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from rowgauge.llm.codes import (
    compress,
    decode_vectors,
    encode_vectors,
    first_codebooks,
    hex_code,
    largest_component,
    nearest_entries,
    padded,
    walsh_hadamard,
)

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return [], ""
    width = max(len(v) for _, v, _ in kept)
    part = max(1, -(-width // parts))
    whole = [[math.floor(256 * x) for x in v] + [0] * (parts * part - len(v)) for _, v, _ in kept]
    cut = [[w[p * part : (p + 1) * part] for p in range(parts)] for w in whole]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[cut[k][p] for k in order] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [near(c[p], books[p])[1] for c in cut]
            for e in range(len(books[p])):
                if mine := [c[p] for c, o in zip(cut, own) if o == e]:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, l), e in zip(kept, error):
        total[l] = total.get(l, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    rows = [(i, "".join(f"{c:02x}" for _, c in f), e, total[l]) for (i, _, l), f, e in zip(kept, found, error)]
    return sorted(rows, key=repr), sha


def run(spark, rows, **how):
    coded, books = compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **how)
    got = coded.select("id", hex_code(F.col("codes")), "error", "label_error").collect()
    return sorted((tuple(r) for r in got), key=repr), books and books.sha256()


@pytest.mark.parametrize("size", [1, 2, 4, 8, 64])
def test_transform(size):
    rows = walsh_hadamard(np.eye(size, dtype=np.int64)).T
    assert (rows @ rows.T == size * np.eye(size)).all()
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(size))  # in sequency order


@pytest.mark.parametrize("part", [1, 3, 4, 11])
def test_nearest_entry_is_exact(part):
    rng = np.random.default_rng(part)
    x, book = rng.integers(-4, 4, (500, part)), rng.integers(-4, 4, (64, part))
    entry, dist = nearest_entries(walsh_hadamard(padded(x)), walsh_hadamard(padded(book)))
    every = ((x[:, None] - book) ** 2).sum(2)
    assert (entry == every.argmin(1)).all() and (dist == every.min(1)).all()  # argmin: ties to the lower index


@pytest.mark.parametrize("width, n", [(64, 300), (32, 40), (20, 100), (5, 90)])
def test_against_plain(spark, width, n):
    rng = np.random.default_rng(width)
    rows = [(int(i), rng.normal(0, 0.2, width).tolist(), int(i) % 4 or None) for i in rng.permutation(n)]
    assert run(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    vector = rng.normal(0, 1, 32).tolist()
    rows = [(i, rng.normal(0, 1, 32).tolist(), None) for i in range(20)]
    rows += [(1, None, 1), (2, [1.0, None], 1), (3, [float("nan")] * 32, 1), (4, [float("-inf")] * 32, 2)]
    rows += [(5, vector, 3)] * 90 + [(None, vector, 4), (None, [0.0] * 32, None), (6, [], 5), (7, [0.5] * 7, 5)]
    assert run(spark, rows) == plain(rows)


def test_empty(spark):
    for rows in ([], [(1, None, 1)]):
        assert run(spark, rows) == ([], None)
    coded, _ = compress(spark.createDataFrame([], SCHEMA))
    assert coded.columns == ["id", "label", "codes", "error", "label_error"]


def test_clashing_names(spark):
    rows = [(i, [float(i), 1.0], i % 2) for i in range(9)]
    plainly = spark.createDataFrame(rows, SCHEMA)
    more = plainly.withColumns({c: F.lit("x") for c in ("id", "v", "codes", "error", "n", "sums", "_label", "position")})
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(compress(more)[0]) == key(compress(plainly)[0])


def test_decoding_gives_the_entries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 20).tolist()) for i in range(70)]
    kept = spark.createDataFrame(rows, "id long, v array<double>")
    books = first_codebooks(kept)
    back = {r.id: r.vector for r in decode_vectors(encode_vectors(kept, books), books).collect()}
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    assert all(back[i] == whole[i] for i in range(64))  # the first ids are the entries
    error = {r.id: r.error for r in encode_vectors(kept, books).collect()}
    assert all(error[i] == sum((a - b) ** 2 for a, b in zip(back[i], whole[i])) for i in whole)


def test_too_large_raises(spark):
    limit = largest_component(16, 1)
    fine = [(i, [limit / 256 - 1.0] * 16, 0) for i in range(3)]
    assert run(spark, fine) == plain(fine)
    with pytest.raises(Exception, match="range of a long"):
        run(spark, [*fine, (9, [1e30] * 16, 0)])
