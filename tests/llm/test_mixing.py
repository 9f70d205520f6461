"""Posteriors, rates against plain projected gradient, and copies."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rowgauge.llm import mixing
from rowgauge.llm.keys import row_key
from rowgauge.llm.mixing import KEEP, copies, fit_rates, mix, mixed, token_shares

TARGETS = {"clean": 0.9, "rude": 0.0, "torn": 0.1}


def corpus(rng, n):
    words = [f"word{i}" for i in range(300)]
    for i in range(n):
        kind = rng.choices(["clean", "rude", "torn"], [0.7, 0.12, 0.18])[0]
        said = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        if kind == "rude":
            said += rng.choices(["idiot", "fool", "moron"], k=4)
        if kind == "torn":
            said = [w + rng.choice(["###", "&&&", ""]) for w in said]
        rng.shuffle(said)
        yield i, " ".join(said), kind


@pytest.fixture(scope="module")
def made(spark):
    rows = list(corpus(random.Random(3), 900))
    docs = spark.createDataFrame([(i, t, "s", len(t)) for i, t, _ in rows], "doc_id long, text string, key string, copies int")
    labels = spark.createDataFrame([(i, k) for i, _, k in rows if i % 3], "doc_id long, domain string")
    return rows, docs.repartition(4), labels


def test_domains_and_targets(made):
    rows, docs, labels = made
    kinds = {i: k for i, _, k in rows}
    found = mix(docs, labels, TARGETS).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(kinds)
    right = sum(max(TARGETS, key=lambda d: r[f"p_{d}"]) == kinds[r["doc_id"]] for r in found)
    assert right >= 0.97 * len(found)
    assert all(abs(sum(r[f"p_{d}"] for d in TARGETS) - 1) < 1e-9 and r["rate"] >= 0 for r in found)
    totals = {d: sum(r["rate"] * r["tokens"] * r[f"p_{d}"] for r in found) for d in TARGETS}
    assert totals["clean"] / sum(totals.values()) == pytest.approx(0.9, abs=0.03)
    clean = [r for r in found if kinds[r["doc_id"]] == "clean"]
    assert sum(r["copies"] >= 1 for r in clean) >= 0.97 * len(clean)
    rude = [r for r in found if kinds[r["doc_id"]] == "rude"]
    assert sum(r["copies"] for r in rude) <= 0.1 * len(rude)


def test_rates_are_projected_gradient(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    tokens = rng.integers(0, 500, 200)
    often = rng.integers(1, 4, 200)
    df = spark.createDataFrame(
        [(int(t), int(n), *map(float, x)) for t, n, x in zip(tokens, often, p)], "tokens long, n_rows long, p0 double, p1 double, p2 double"
    )
    goal, budget = np.array([0.7, 0.3, 0.0]), 30_000.0
    rated, steps, totals = fit_rates(df, goal.tolist(), budget)
    load = tokens * often
    r = np.ones(200)
    scale = load @ p
    gram = p.T @ (load[:, None] * p)
    pace = 1 / np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max()
    for _ in steps:
        r = np.maximum(0, r - pace * p @ (((load * r) @ p - goal * budget) / scale))
    assert np.allclose((load * r) @ p, totals, rtol=1e-5)
    got = [x["rate"] for x in rated.collect()]
    assert np.allclose(sorted(got), sorted(r), rtol=1e-4, atol=1e-5)
    far = lambda x: (((load * x) @ p - goal * budget) ** 2 / scale).sum()
    assert far(r) < 0.05 * far(np.ones(200))


def best_rates(p, load, goal, keep):
    """The rates by plain steps until nothing moves."""
    scale = load @ p
    steep = np.linalg.eigvalsh(p.T @ (load[:, None] * p) / np.sqrt(np.outer(scale, scale))).max() + keep
    r = np.ones(len(load))
    for _ in range(200_000):
        new = np.maximum(0, r - (p @ (((load * r) @ p - goal) / scale) + keep * (r - 1)) / steep)
        if np.abs(new - r).max() < 1e-12:
            break
        r = new
    return r


@pytest.mark.parametrize("goal", [[0.7, 0.3, 0.0], [0.1, 0.1, 0.8], [1.0, 0.0, 0.0]])
def test_rates_come_to_rest_at_the_best(spark, goal):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    load = rng.integers(0, 500, 200)
    df = spark.createDataFrame([(int(t), 1, *map(float, x)) for t, x in zip(load, p)], "tokens long, n_rows long, p0 double, p1 double, p2 double")
    rated, steps, totals = fit_rates(df.coalesce(1), goal, 30_000.0, KEEP)
    got = np.array([x["rate"] for x in rated.collect()])
    want = best_rates(p, load, np.array(goal) * 30_000, KEEP)
    assert len(steps) < 200 and rated.columns == [*df.columns, "rate"]
    assert np.sqrt((load * (got - want) ** 2).sum() / load.sum()) < 0.005
    assert np.allclose((load * got) @ p, totals, rtol=1e-6)


def test_unreachable_rest_raises(spark, monkeypatch):
    df = spark.createDataFrame([(10, 1, 0.9, 0.1), (10, 1, 0.2, 0.8)], "tokens long, n_rows long, p0 double, p1 double")
    monkeypatch.setattr(mixing, "MOST_STEPS", 2)
    with pytest.raises(RuntimeError, match="still move"):
        fit_rates(df, [1.0, 0.0], 10.0, KEEP)


def test_query_against_plain_rates(spark):
    """The registered query's rates are the best for its own posteriors."""
    from rowgauge.llm.queries import MIX, QUERIES

    found = QUERIES["op9_mixing"](spark, "/root/testdata/sf0.01")
    rows = found.collect()
    p = np.array([[r[f"p_{d}"] for d in sorted(MIX)] for r in rows])
    load = np.array([r["tokens"] * r["n_rows"] for r in rows], float)
    share = np.array([MIX[d] for d in sorted(MIX)])
    goal = share * min(s / t for s, t in zip(load @ p, share) if t > 0)
    want = best_rates(p, load, goal, KEEP)
    assert np.sqrt((load * (np.array([r["rate"] for r in rows]) - want) ** 2).sum() / load.sum()) < 0.005
    told = {r["domain"]: r for r in token_shares(found, MIX).collect()}
    totals = (load * want) @ p
    for d, x in zip(sorted(MIX), totals / totals.sum()):
        assert told[d]["expected"] == pytest.approx(x, abs=0.002) and told[d]["target"] == MIX[d]
        assert told[d]["drawn"] == pytest.approx(x, abs=0.03)


def test_keys_tell_nulls(spark):
    rows = [(None, "1:x"), (1, "x"), (1, None), (1, ""), (None, None), (None, ""), (11, "x"), (1, "1:x")]
    keys = spark.createDataFrame(rows, "i long, t string").select(row_key(F.col("i"), F.col("t")).alias("k")).distinct()
    assert keys.count() == len(rows)


def test_copies(spark):
    df = spark.range(20_000).select("id", F.lit(2.4).alias("r"))
    got = [r[0] for r in df.select(copies(F.col("r"), F.col("id"))).collect()]
    assert set(got) == {2, 3} and abs(sum(got) / len(got) - 2.4) < 0.02
    whole = spark.createDataFrame([(1, 0.0), (2, 0.95), (3, 1.1), (4, 2.0)], "id long, r double")
    assert [r[0] for r in whole.orderBy("id").select(copies(F.col("r"), F.col("id"))).collect()] == [0, 1, 1, 2]


def test_odd_rows(spark, made):
    _, docs, labels = made
    odd = spark.createDataFrame(
        [(5000, None, "a", 1), (5001, "", "a", 1), (None, "word1 word2", None, None), (5002, "word3 " * 50_000, "b", 2), (5003, "word4", "c", 1), (5003, "word4", "c", 1)],
        docs.schema,
    )
    every = docs.union(odd)
    more = labels.union(spark.createDataFrame([(5000, "other"), (None, "clean"), (99_999, "clean"), (0, None)], labels.schema))
    found = mix(every, more, TARGETS).collect()
    assert len(found) == 905 and {r["doc_id"]: r["n_rows"] for r in found}[5003] == 2
    by = {r["doc_id"]: r for r in found}
    assert by[5000]["tokens"] == by[5001]["tokens"] == 0 and by[5002]["tokens"] == 50_000
    kept = mixed(every, more, TARGETS)
    assert kept.columns == every.columns
    want = sum(r["copies"] * r["n_rows"] for r in found)
    assert kept.count() == want
    # twice the tokens asked for: documents are repeated
    again = mix(docs, labels, {"clean": 1.0, "rude": 0.0, "torn": 0.0}, budget=2.0 * sum(r["tokens"] for r in found if r["p_clean"] > 0.5))
    assert again.agg(F.max("copies")).first()[0] >= 2


def test_nothing_to_learn(spark, made):
    _, docs, labels = made
    found = mix(docs.limit(5), labels.limit(0), TARGETS).collect()
    assert len(found) == 5 and all(r["p_clean"] == pytest.approx(1 / 3) for r in found)
    assert mix(docs.limit(0), labels, TARGETS).count() == 0
    assert mixed(docs.limit(0), labels.limit(0), TARGETS).count() == 0


def test_given_documents(spark):
    from rowgauge.llm.queries import MIX, domain_labels

    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), domain_labels(spark, sf)
    found = mixing.mix(docs, labels, MIX).join(labels, "doc_id").collect()
    of = lambda d: [r for r in found if r["domain"] == d]
    assert sum(r["copies"] >= 1 for r in of("clean")) >= 0.98 * len(of("clean"))
    assert sum(r["copies"] == 0 for r in of("toxic")) >= 0.85 * len(of("toxic"))


def test_drawn_tokens_meet_targets(spark):
    """Domains that must be thinned to a fifth or less keep their share of the tokens that are drawn."""
    kinds = ["clean"] * 3200 + ["rude"] * 400 + ["torn"] * 400
    marks = {"clean": "good", "rude": "idiot", "torn": "###"}
    rng = random.Random(7)
    texts = [" ".join([f"word{rng.randrange(300)}" for _ in range(40)] + [marks[k]] * 3) for k in kinds]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(list(enumerate(kinds)), "doc_id long, domain string")
    targets = {"clean": 0.4, "rude": 0.3, "torn": 0.3}
    drawn = mixed(docs, labels, targets).join(labels, "doc_id").groupBy("domain").count().collect()
    got = {r["domain"]: r["count"] for r in drawn}
    for domain, share in targets.items():
        assert got.get(domain, 0) / sum(got.values()) == pytest.approx(share, abs=0.04)
    # a null or repeated id does not share one draw
    same = spark.createDataFrame([(None if i % 2 else 7, f"good {i} " + t) for i, t in enumerate(texts[:1000])], docs.schema)
    found = mix(docs.union(same), labels, targets).where("doc_id IS NULL OR doc_id = 7").groupBy("doc_id").agg(F.countDistinct("copies").alias("n")).collect()
    assert len(found) == 2 and all(r["n"] > 1 for r in found)


def test_training_keeps_unlike_rows(spark):
    """Only rows whose words are nearly the same go, and the smallest key of them stays."""
    rng = random.Random(5)
    words = [f"word{i}" for i in range(3000)]
    usual = [f"usual{i}" for i in range(40)]
    unlike = [rng.sample(words, 60) + usual for _ in range(300)]
    page = rng.sample(words, 200)
    near = [page[:i] + [f"new{i}"] + page[i + 1 :] for i in range(60)]
    again = [page[::-1] + page[:i] for i in range(1, 20)]
    rows = [(i, " ".join(t)) for i, t in enumerate(unlike + near + again)]
    made = mixing.with_features(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).withColumn("domain", F.lit("clean"))
    kept = {r["doc_id"]: bytes(r["key"]) for r in mixing.without_near_copies(made).collect()}
    assert set(range(300)) <= set(kept)
    left = [k for i, k in kept.items() if i >= 300]
    assert len(left) <= 3 and min(bytes(r["key"]) for r in made.where("doc_id >= 300").collect()) in left


def plain_calibration(rows, domains, prior, counts):
    """Of rows (domain, logits): priors and softness, in plain Python."""
    have = {d: sum(k == d for k, _ in rows) for d in domains}
    every = sum(counts[d] for d in domains if have[d])
    shares = [counts[d] / every if have[d] else 0.0 for d in domains]
    stands = {d: s / have[d] for d, s in zip(domains, shares) if have[d]}

    def posterior(at, logits):
        x = np.array(logits) / at[1] + np.array(at[0])
        e = np.exp(x - x.max())
        return e / e.sum()

    tried = [(list(prior), softer) for softer in mixing.SOFTER]
    for at in tried:
        for _ in range(mixing.ROUNDS):
            mean = sum(posterior(at, x) * stands[k] for k, x in rows)
            for d, share in enumerate(shares):
                at[0][d] += float(np.log(max(share, 1e-4) / max(mean[d], 1e-4)))
    return min(tried, key=lambda at: sum(-np.log(posterior(at, x)[domains.index(k)]) * stands[k] for k, x in rows))


@pytest.mark.parametrize("seen", [["a", "b", "c"], ["a", "c"]])
def test_calibration_is_the_plain_one(spark, monkeypatch, seen):
    """And its plans do not grow with what is tried: what sums it asks for are of one trial."""
    rng, domains = np.random.default_rng(9), ["a", "b", "c"]
    rows = [(k, [float(x) for x in rng.normal(0, 4, 3) + 3 * np.eye(3)[domains.index(k)]]) for k in rng.choice(seen, 150)]
    df = spark.createDataFrame([(str(k), *x) for k, x in rows], "domain string, l0 double, l1 double, l2 double").repartition(3)
    prior, counts, asked = [-0.5, -1.5, -1.7], {"a": 900, "b": 60, "c": 40}, []
    plain = plain_calibration(rows, domains, prior, counts)
    true_sum = F.sum
    monkeypatch.setattr(mixing.F, "sum", lambda c: asked.append(c) or true_sum(c))
    found = mixing._calibrated(df, domains, prior, counts)
    assert found[1] == plain[1] and found[0] == pytest.approx(plain[0], rel=1e-9)
    assert len(asked) <= 3 * len(domains) < len(mixing.SOFTER) * len(domains)


def test_nothing_held_back_is_not_calibrated(spark):
    none = spark.createDataFrame([], "domain string, l0 double, l1 double")
    assert mixing._calibrated(none, ["a", "b"], [-0.1, -2.0], {}) == ([-0.1, -2.0], 1.0)
