"""The trie of conversation prefixes against a plain version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from rowgauge.llm import trie
from rowgauge.llm.trie import conversation_trie


def plain(rows, share):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            r, t = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0), hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest(), (r, t)))
    turns = {c: [x[2] for x in sorted(own[c])] for c in own}
    if share:
        built = {}
        for c in turns:
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = turns.get(c - c % 5, [])[:h] + turns[c][h:]
        turns = built
    nodes = [{"up": None, "depth": 0, "size": 0, "members": list(turns), "kids": {}, "ends": []}]
    for c in turns:
        at = 0
        for role, text in turns[c]:
            kids = nodes[at]["kids"]
            if (role, text) not in kids:
                kids[role, text] = len(nodes)
                nodes.append({"up": at, "depth": nodes[at]["depth"] + 1, "size": len(text.encode()), "members": [], "kids": {}, "ends": []})
            at = kids[role, text]
            nodes[at]["members"].append(c)
        nodes[at]["ends"].append(c)
    for n in reversed(nodes):  # children come after their parents
        n["leaves"] = n.get("leaves", 0) + (not n["kids"])
        n["saved"] = n.get("saved", 0) + (len(n["members"]) - 1) * n["size"]
        if n["up"] is not None:
            for name in ("leaves", "saved"):
                nodes[n["up"]][name] = nodes[n["up"]].get(name, 0) + n[name]
    for n in nodes if turns else ():
        ends = hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest()
        up = None if n["up"] is None else min(nodes[n["up"]]["members"])
        yield (min(n["members"]), n["depth"], up, len(n["members"]), len(n["kids"]), n["leaves"], n["saved"], ends)


SCHEMA = "conv_id long, turn int, role string, text string"


def found(spark, rows, share=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return sorted((tuple(r) for r in conversation_trie(df, share).collect()), key=repr)


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(200), 40):
        for turn in range(rng.choice([1, 2, 3, 7, 8, 9, 16, 17, 30])):
            # few texts, so that long prefixes are shared; every third conversation is its forerunner's
            text = f"é{turn}" if c % 3 == 0 else rng.choice("ab")
            rows.append((c, turn, rng.choice([None, "user"]) if c % 3 else "user", text))
    return rows


@pytest.mark.parametrize("share", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_against_plain(spark, seed, share):
    rows = random_rows(seed)
    assert found(spark, rows, share) == sorted(plain(rows, share), key=repr)


def test_odd_rows(spark):
    rows = [(0, None, "user", None), (0, None, None, "x"), (0, 1, "", ""), (0, 1, "", "")]  # null turns, ties, equal rows
    rows += [(1, 0, "user", "long " * 50_000), (None, 0, "user", "nobody's"), (7, 2, "a", "b"), (7, 2, "ab", ""), (8, 0, "user", "only")]
    rows += [(9, 5, "user", "again")] * 400  # one turn many times: a chain of equal turns, more than a run of copies
    for share in (False, True):
        assert found(spark, rows, share) == sorted(plain(rows, share), key=repr)


def test_one_conversation_holds_most(spark):
    rows = [(3, t, "user", f"{t % 7}") for t in range(3_000)] + [(4, t, "user", f"{t % 7}") for t in range(2_500)]
    rows += [(c, 0, "user", "hello") for c in range(10, 40)]
    assert found(spark, rows) == sorted(plain(rows, False), key=repr)


def test_empty_and_clashing_names(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_trie(none).count() == 0 and conversation_trie(none, True).count() == 0
    rows = random_rows(5)
    more = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("depth", "a", "part", "n", "size", "block", "run")})
    assert sorted((tuple(r) for r in conversation_trie(more, True).collect()), key=repr) == sorted(plain(rows, True), key=repr)


def test_ids_are_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 200)
    ids = [*range(-5, 1_200, 3), 10**15]
    ends = spark.createDataFrame([(1, 2, i) for i in ids] + [(1, 3, 8)], "a long, b long, conv_id long").repartition(7)
    got = {(r.a, r.b): r.ends_sha256 for r in trie.digest_of_ids(ends).collect()}
    assert got == {(1, b): hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for b, x in ((2, ids), (3, [8]))}
