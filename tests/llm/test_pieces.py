"""Chunk-wise encoding against the library's own."""

from __future__ import annotations

import random

import sentencepiece
from rowgauge.llm import pieces
from rowgauge.llm.pieces import MARK, ChunkTable, decode_pieces, encode_pieces
from rowgauge.llm.queries import piece_model

ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "   a   b   ", "\n", "a\nb", " \n ", "\t x\t", MARK, f"a{MARK}b {MARK}",
    "<s> </s> <unk>", "éàü ß 漢字 😀 ‍ x", "x" * 300, "wor" * 40 + " d", "0123 45 6789", "<0x0A>", "\u0000 a", "ab" * 5000,
]


def test_table_is_the_library():
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    pieces.check_vocabulary(library)
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice("ab é\n▁0,😀 thein") for _ in range(rng.randrange(60))) for _ in range(1500)]
    table = ChunkTable(library, limit=50)  # emptied again and again
    for at in range(0, len(texts), 40):
        some = texts[at : at + 40]
        ids, ends = table.encode(some)
        starts = [0, *ends[:-1]]
        assert [ids[a:b].tolist() for a, b in zip(starts, ends)] == library.encode(some)


def test_documents(spark):
    library = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(99, None, "x"), (0, "", "x"), (None, "a b", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    found = encode_pieces(docs, piece_model(), decoded=True).collect()
    want = sorted(((i, tuple(library.encode(t or "")), library.decode(library.encode(t)) if t else "") for i, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, tuple(r.ids), r.decoded) for r in found), key=repr) == want
    back = decode_pieces(encode_pieces(docs, piece_model()), piece_model()).collect()
    assert sorted((repr(r.doc_id), r.decoded) for r in back) == sorted((repr(i), d) for i, _, d in want)
    assert encode_pieces(docs.limit(0), piece_model(), decoded=True).count() == 0
