"""The registered queries: against their SQL, or against plain versions of their contracts."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
import sentencepiece
from rowgauge.llm.oracle import ORACLE
from rowgauge.llm.queries import QUERIES, SHARDS, piece_model
from rowgauge.llm.winnow import edited
from tests.compare import connect, differences

from .test_neighbours import brute as nearest_brute
from .test_pii import corpus
from .test_pii import plain as plain_spans
from .test_simjoin import brute as similar_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def by_id(df):
    rows = df.collect()
    found = {r["doc_id"]: r for r in rows}
    assert len(found) == len(rows)
    return found


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert differences(spark, connect(SF), SF, QUERIES[name], ORACLE[name]) == []


def test_op1(spark, texts):
    found = by_id(QUERIES["op1_sharding"](spark, SF))
    load, places = defaultdict(int), defaultdict(list)
    for i, t in texts.items():
        r = found[i]
        assert r["size"] == len(t.encode()) + 8 and r["text_crc32"] == zlib.crc32(t.encode())
        assert r["law"] == "bytes" and 0 <= r["shard"] < SHARDS and r["grown_shard"] is None
        load[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
    assert len(found) == len(texts)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load.values()) <= max(r["size"] for r in found.values())


def test_op3(spark, texts):
    found = by_id(QUERIES["op3_language"](spark, SF))
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [i for i, r in found.items() if r["held_out"]]
    assert sum(found[i]["lang_pred"] == langs[i] for i in held) >= 0.97 * len(held)


def test_op4(spark, texts):
    found = by_id(QUERIES["op4_winnowing"](spark, SF))
    order = sorted(texts, reverse=True)
    for i, following in zip(order, [*order[1:], order[0]]):
        assert found[i]["n_chars"] == len(texts[i])
        assert found[i]["edited_sha256"] == sha(edited(texts[i], texts[following]))
    near = [r["near_edited"] for r in found.values()]
    assert sum(near) / len(near) > 0.35 > 0.1 > sum(r["near_next"] for r in found.values()) / len(near)


def test_op5(spark, texts):
    found = QUERIES["op5_jaccard"](spark, SF).collect()
    want = similar_brute(list(texts.items()))
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in found) == sorted(want)


def test_op6(spark, texts):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    found = by_id(QUERIES["op6_pieces"](spark, SF))
    for i, t in texts.items():
        ids = library.encode(t)
        r = found[i]
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids))


def test_op7(spark, texts):
    found = by_id(QUERIES["op7_pii"](spark, SF))
    kinds = ("email", "ip", "card", "phone")
    for i, t in texts.items():
        base = sorted(plain_spans(t), key=lambda s: (kinds.index(s[0]), s[1]))
        words = [f"{k}:{a}:{b}" for k, a, b in base]
        r = found[i]
        assert r["base_sha256"] == sha(",".join(words))
        spans = [s for s in r["spans"].split(",") if s]
        assert set(words) <= set(spans) and len(spans) == len(words) + r["n_added"]
        assert spans == sorted(spans, key=lambda s: (kinds.index(s.split(":")[0]), int(s.split(":")[1])))
        assert [r[f"n_{k}"] for k in kinds] == [sum(s.startswith(k) for s in spans) for k in kinds]


def test_op7_counts_base_spans(spark, tmp_path):
    """What the field adds stands in ``spans``, and in no kind's count."""
    number = "4111111111111111"
    again = f"the {number} of it\nand {'.'.join(number[i : i + 4] for i in range(0, 16, 4))} again"
    rows = [*corpus(random.Random(5), 400), (-1, again)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op7_pii"](spark, str(tmp_path)).where("doc_id = -1 OR n_added > 0").collect()
    (r,) = [r for r in found if r["doc_id"] == -1]
    assert r["spans"] == "card:4:20,card:31:50" and r["base_sha256"] == sha("card:4:20") and r["n_added"] == 1
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (0, 0, 1, 0)
    for r in found:
        counted = sum(r[f"n_{k}"] for k in ("email", "ip", "card", "phone"))
        assert counted == len(r["spans"].split(",")) - r["n_added"]


def test_op10(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    true = nearest_brute([tuple(r) for r in rows])
    found = defaultdict(list)
    for r in QUERIES["op10_forest"](spark, SF).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    hits = sum(len(set(found[q]) & {i for i, _ in near}) for q, near in true.items())
    assert hits >= 0.9 * sum(map(len, true.values()))
