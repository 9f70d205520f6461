"""Byte-level BPE against the tokenizer library."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from rowgauge.llm.bytepairs import (
    EditableText,
    PieceTable,
    PrefixTokens,
    Splitter,
    decode_texts,
    encode_edited,
    encode_texts,
    read_ranks,
    vocabulary_of,
)
from rowgauge.llm.queries import byte_ranks


def file_of(name):
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def both(request):
    data = file_of(request.param)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(data), special_tokens={})
    return vocabulary_of(data), Splitter(public_tokenizers.PATTERN), library


def odd_text(rng):
    kind = rng.randrange(6)
    if kind == 0:
        chars = (chr(rng.choice([rng.randrange(32, 127), rng.randrange(0x110000)])) for _ in range(rng.randrange(40)))
        return "".join(chars).encode("utf-8", "ignore").decode()
    if kind == 1:
        return "".join(rng.choice("ab ") for _ in range(rng.randrange(200)))
    if kind == 2:
        return "".join(rng.choice(["the", "ing", " ", "  ", "\n", "'s", "'re", "12", "é", "　", "!!", "a"]) for _ in range(rng.randrange(60)))
    if kind == 3:
        return "a" * rng.randrange(300)
    if kind == 4:
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(300)))
    # code points of different Unicode versions, and blanks of all kinds
    return "".join(chr(rng.choice([0x558, 0x88F, 0x16FF2, 0x3D000, 0x1C89, 0x85, 0x1C, 0xA0, 0x61, 0x20])) for _ in range(rng.randrange(20)))


def test_equals_library(both):
    vocabulary, splitter, library = both
    rng = random.Random(11)
    texts = ["", " ", "\n\n x", "'s's 'S", *[odd_text(rng) for _ in range(600)]]
    table = PieceTable(vocabulary, limit=2_000)  # emptied now and then
    for t in texts:
        ids, _ = table.encode([splitter.split(t)])
        assert ids.tolist() == library.encode_ordinary(t)
        assert vocabulary.decode(ids.tolist()) == t.encode()


def test_every_prefix_and_append(both):
    vocabulary, _, library = both
    rng = random.Random(3)
    for _ in range(30):
        data = odd_text(rng).encode()[:80]
        state = PrefixTokens(vocabulary)
        for b in data:
            state.append(bytes([b]))
        assert state.last == PrefixTokens(vocabulary, data).last
        for end in range(1, len(data) + 1):
            want = library._core_bpe.encode_single_piece(data[:end])
            whole = vocabulary.ids.get(data[:end])
            assert ([whole] if whole is not None else state.tokens(end)) == want


def test_edits_equal_library_and_stay_near(both):
    vocabulary, splitter, library = both
    rng = random.Random(5)
    for _ in range(250):
        state = EditableText(vocabulary, splitter, odd_text(rng) + odd_text(rng))
        for _ in range(4):
            a = rng.randrange(len(state.text) + 1)
            b = rng.randrange(a, min(len(state.text), a + rng.choice([0, 1, 5, 50])) + 1)
            state.replace(a, b, odd_text(rng)[: rng.choice([0, 1, 3, 100])])
            assert state.tokens() == library.encode_ordinary(state.text)
    long = PrefixTokens(vocabulary, "".join(rng.choice("abcdefgh") for _ in range(20_000)).encode())
    before = long.worked
    long.replace(10_000, 10_003, b"zz")
    assert long.worked - before < 20 * vocabulary.longest
    assert long.tokens() == library._core_bpe.encode_single_piece(long.data)


def test_a_token_that_no_merge_makes():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257, b"xyz": 258}
    data = b"\n".join(__import__("base64").b64encode(t) + b" %d" % i for t, i in ranks.items())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    vocabulary = vocabulary_of(data)
    for piece in ("xyz", "xyzz", "abc", "aabcab", "wxyz"):
        assert vocabulary.encode(piece.encode()) == library.encode_ordinary(piece)
    with pytest.raises(ValueError, match="no token for the bytes"):
        vocabulary_of(data.split(b"\n", 1)[1])


def test_tables(spark):
    ranks, pattern = byte_ranks()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})
    rng = random.Random(8)
    texts = [None, "", "same", "same", "word " * 60_000, "x" * 100_000, *[odd_text(rng) for _ in range(40)]]
    docs = spark.createDataFrame([(i if i else None, t, "x", "y", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded string, n int")
    found = encode_texts(docs.repartition(4), ranks, pattern, decoded=True).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        r = by_id[i if i else None]
        assert r.ids == library.encode_ordinary(t or "") and bytes(r.decoded) == (t or "").encode()
    back = decode_texts(spark.createDataFrame(found).select("doc_id", "ids"), ranks).collect()
    assert {r.doc_id: bytes(r.decoded) for r in back} == {i: bytes(r.decoded) for i, r in by_id.items()}
    assert encode_texts(docs.limit(0), ranks, pattern).count() == 0


def test_edited_tables(spark):
    ranks, pattern = byte_ranks()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})
    text = "The quick brown fox. " * 2_000
    edits = [(4, 9, "slow"), (len(text), None, " The end"), None, (10**9, 3, None)]
    rows = [(1, text, edits), (2, None, [(0, 0, "new")]), (3, "kept", None), (4, "gone", [(0, 4, None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start: int, stop: int, new: string>>")
    found = {r.doc_id: r for r in encode_edited(docs.withColumn("worked", F.lit(1)), ranks, pattern).collect()}
    edited = text[:4] + "slow" + text[9:]
    edited = edited[: len(text)] + " The end" + edited[len(text) :] if len(edited) > len(text) else edited + " The end"
    for i, (was, now) in enumerate([(text, edited), ("", "new"), ("kept", "kept"), ("gone", "")], 1):
        assert found[i].ids == library.encode_ordinary(was) and found[i].edited_ids == library.encode_ordinary(now)
    assert found[1].n_again < 100 and found[3].n_again == 0
