"""SentencePiece encoding and decoding through a table of distinct chunks.

In a vocabulary whose pieces hold the whitespace marker only as a run at their
start, no merge can join what stands before a marker to the marker. A text then
falls into chunks, a run of markers and what follows up to the next one, that
are segmented on their own. A task segments each distinct chunk it meets once,
keeps the ids in one flat table, and puts a text's ids together by position. The
texts stay where they are: nothing is shuffled. The table is emptied when its
chunks exceed ``TABLE_CHARS`` characters, which costs repeated work but no result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .batches import map_batches, text_slices

MARK = "▁"
TABLE_CHARS = 4_000_000
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def check_vocabulary(processor) -> None:
    """Raise unless chunks can be segmented on their own with this model."""
    for i in range(processor.get_piece_size()):
        if MARK in processor.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} holds the marker inside: chunks can't be segmented on their own")
    probe = "  a  b "
    if "".join(processor.encode(probe, out_type=str)) != MARK + probe.replace(" ", MARK):
        raise ValueError("the model's normalisation changes texts: chunks can't be segmented on their own")


class ChunkTable:
    """Chunks to rows, rows to ids."""

    def __init__(self, processor, limit: int = TABLE_CHARS):
        self.processor, self.limit = processor, limit
        self.lone = processor.piece_to_id(MARK)
        self.empty()

    def empty(self) -> None:
        self.rows: dict[str, int] = {}
        self.chars = 0
        self.ends = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.int32)

    def add(self, chunks: list[str]) -> None:
        # the library sets the first marker itself, but none before an empty text
        found = [ids or [self.lone] for ids in self.processor.encode([c[1:] for c in chunks], num_threads=1)]
        n = len(self.rows)
        self.rows.update((c, n + i) for i, c in enumerate(chunks))
        self.chars += sum(map(len, chunks))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, np.fromiter((x for ids in found for x in ids), np.int32, int(lengths.sum()))])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and where each text's end."""
        split = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if self.chars > self.limit:
            self.empty()
        rows = self.rows
        if new := {c for chunks in split for c in chunks if c not in rows}:
            self.add(list(new))
        code = np.fromiter((rows[c] for chunks in split for c in chunks), np.int64)
        start = self.ends[code]
        size = self.ends[code + 1] - start
        till = np.concatenate([[0], np.cumsum(size)])
        out = self.ids[np.repeat(start - till[:-1], size) + np.arange(till[-1])]
        return out, till[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]


def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def encode_pieces(
    docs: DataFrame, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",), decoded: bool = False
) -> DataFrame:
    """The columns in ``keep``, ``ids`` and, if asked for, ``decoded`` (the ids through the library's decode).

    Ids are exactly the library's, without begin or end ids. A null or empty
    text has no ids and decodes to the empty text. Columns not kept are left
    behind, so that no name can clash.
    """
    check_vocabulary(_processor(model))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary file: fixed size
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)]
        + [T.StructField("decoded", T.StringType(), False)] * decoded
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(shared.value)
        table = ChunkTable(processor)
        for part, texts in text_slices(batches, len(keep)):
            texts = [t or "" for t in texts]
            ids, ends = table.encode(texts)
            offsets = np.concatenate([[0], ends])
            columns = [part.column(i) for i in range(len(keep))]
            columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))
            if decoded:
                columns.append(
                    pa.array([processor.decode(ids[a:b].tolist()) if b > a else "" for a, b in zip(offsets, offsets[1:])], pa.string())
                )
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs.select(*keep, docs[text].alias("_text")), encode, schema)


def decode_pieces(
    encoded: DataFrame, model: bytes, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns in ``keep`` and ``decoded``; null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField("decoded", T.StringType(), False)])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(shared.value)
        for batch in batches:
            texts = [processor.decode(x) if x else "" for x in batch.column(len(keep)).to_pylist()]
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=schema.names)

    return map_batches(encoded.select(*keep, encoded[ids].alias("_ids")), decode, schema)
