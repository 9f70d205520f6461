"""Winnowing fingerprints of whole texts, and of texts beside their neighbours.

A text is folded to its letters and digits in lower case; every k-gram gets a
rolling hash; of each window of w hashes the smallest is taken, the rightmost
of equals. Hashes are kept with the place, in the original text, where their
k-gram starts. Two texts that share w + k - 1 folded characters in a row share
a fingerprint hash at those places.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import map_batches, text_slices

K = 12
WINDOW = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_FOLD: list[np.ndarray] = []


def _fold_table() -> np.ndarray:
    """Code point to its folded one, 0 for all but letters and digits."""
    if not _FOLD:
        folded = np.zeros(0x110000, np.uint32)
        for i in range(0x30000):
            if (c := chr(i)).isalnum():
                folded[i] = ord(low) if len(low := c.lower()) == 1 else i
        _FOLD.append(folded)
    return _FOLD[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _rolling(chars: np.ndarray, k: int) -> np.ndarray:
    """The hash of every k-gram, put together from those of halves."""
    if k == 1:
        return chars.astype(np.uint64) + np.uint64(1)
    half = k // 2
    low, high = _rolling(chars, half), _rolling(chars, k - half)
    n = len(chars) - k + 1
    return low[:n] * _power(k - half) + high[half : half + n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h >> np.uint64(32)


def _window_min(values: np.ndarray, w: int) -> np.ndarray:
    """The least of every w in a row, by doubling."""
    span = 1
    while span < w:
        step = min(span, w - span)
        values = np.minimum(values[:-step], values[step:])
        span += step
    return values


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes and the code points they start at, in order of place; at least one.

    A text of fewer than k letters and digits has one hash, that of all of
    them, or, without any, of the text as it is.
    """
    chars = code_points(text)
    folded = _fold_table()[chars]
    place = np.flatnonzero(folded)
    kept = folded[place]
    with np.errstate(over="ignore"):
        if len(kept) < k:
            few = kept if len(kept) else chars
            whole = int.from_bytes(hashlib.blake2b(few.tobytes(), digest_size=4).digest(), "big")
            return np.array([whole], np.uint64), place[:1] if len(place) else np.zeros(1, np.int64)
        grams = _mixed(_rolling(kept, k))
    at = np.arange(len(grams), dtype=np.uint64)
    # the smaller hash, then the later place
    least = _window_min((grams << np.uint64(32)) | (_LOW - at), min(window, len(grams)))
    least = least[np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))]
    return least >> np.uint64(32), place[(_LOW - (least & _LOW)).astype(np.int64)]


def as_text(hashes: np.ndarray) -> str:
    """Eight hex digits for each hash, in order of place."""
    return hashes.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Shared hashes over all hashes of two fingerprints, as sets."""
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), k: int = K, window: int = WINDOW) -> DataFrame:
    """The columns in ``keep``, ``hashes`` and ``places`` of every row; a null text counts as empty."""
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + [T.StructField(c, T.ArrayType(T.LongType(), False), False) for c in ("hashes", "places")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, len(keep)):
            found = [winnow(t or "", k, window) for t in texts]
            arrays = [pa.array([x[i].astype(np.int64) for x in found], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), *arrays], names=schema.names)

    return map_batches(docs.select(*keep, docs[text].alias("_text")), run, schema)


# ---- neighbours in the order of ids ----

LEAST = -(2**63)


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``key``; a coarse step, then a fine one, so that many bounds cost little."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.size(F.filter(F.lit(bounds[::step]), lambda b: b <= key))
    first = F.greatest(coarse - 1, F.lit(0)) * step
    return first + F.size(F.filter(F.slice(F.lit(bounds), first + 1, F.lit(step)), lambda b: b <= key))


def in_descending_order(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``bucket, follower, key, tie, doc_id, body`` in descending order of id within each bucket.

    Buckets are runs of ids of near equal counts. A bucket ends with its
    follower: a copy of the row that comes after it, the head of the next bucket
    that has rows, or of the first bucket after the last one. The driver sees an
    id per bucket. Equal ids are ordered by a hash of their text; null ids come
    last; a null text counts as empty.
    """
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.coalesce(docs[id_col].cast("long"), F.lit(LEAST)).alias("key"),
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("body"),
    )
    shares = [(i + 1) / buckets for i in range(buckets - 1)]
    bounds = rows.select(F.percentile_approx("key", shares or [0.5], 10_000)).first()[0] if shares else []
    bounds = sorted(set(bounds or []))
    rows = rows.withColumn("bucket", _bucket(F.col("key"), bounds))
    tie = F.xxhash64("body")
    heads = {
        r.bucket: tuple(r.head)
        for r in rows.groupBy("bucket").agg(F.min(F.struct(F.bitwise_not("key").alias("rank"), tie.alias("tie"))).alias("head")).collect()
    }
    order = sorted(heads, reverse=True)
    after = [(bucket, *heads[order[(i + 1) % len(order)]]) for i, bucket in enumerate(order)]
    followers = spark.createDataFrame(after, "bucket int, rank long, tie long")
    copies = (
        rows.drop("bucket")
        .withColumn("rank", F.bitwise_not("key"))
        .withColumn("tie", tie)
        .join(F.broadcast(followers), ["rank", "tie"])  # a row per bucket
        .select("bucket", F.lit(True).alias("follower"), "key", "tie", "doc_id", "body")
    )
    own = rows.select("bucket", F.lit(False).alias("follower"), "key", tie.alias("tie"), "doc_id", "body")
    return (
        _packed(own.union(copies))
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "follower", F.desc("key"), "tie")
    )


def _packed(rows: DataFrame) -> DataFrame:
    """``body`` in compressed bytes: the texts are all that is shuffled."""
    schema = T.StructType([*rows.schema[:-1], T.StructField("body", T.BinaryType(), False)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        for part, texts in text_slices(batches, len(schema) - 1):
            columns = [part.column(i) for i in range(len(schema) - 1)]
            columns.append(pa.array([squeeze(t.encode()) for t in texts], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(rows, pack, schema)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the head of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def beside_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """A row per row of ``docs``: its fingerprint, its edited text's, and how like they and the next one's are.

    Rows stream past in descending order of id, so a task holds two texts and a
    slice at a time. A table of one row is its own next; an empty one gives no
    rows; columns other than id and text are left behind.
    """
    schema = T.StructType(
        [docs.schema[id_col], *T.StructType.fromDDL(
            "n_chars long, edited_sha256 string, fingerprint string, places array<long>, "
            "edited_fingerprint string, near_edited double, near_next double"
        )]
    )
    schema[0].name = "doc_id"
    schema.names[0] = "doc_id"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor().decompress
        last = None  # bucket, id, text, hashes, places, whether it is a follower
        for part, packed in text_slices(batches, 5):
            out: list[list] = [[] for _ in schema.names]
            for bucket, follower, doc_id, body in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(4).to_pylist(), packed
            ):
                if last and last[5] and last[0] == bucket:
                    continue  # copies of a follower that is there more than once
                body = spread(body).decode()
                hashes, places = winnow(body, k, window)
                if last and last[0] == bucket:
                    other = edited(last[2], body)
                    changed = winnow(other, k, window)[0]
                    row = (
                        last[1], len(last[2]), hashlib.sha256(other.encode()).hexdigest(), as_text(last[3]),
                        last[4].astype(np.int64), as_text(changed), likeness(last[3], changed), likeness(last[3], hashes),
                    )
                    for column, value in zip(out, row):
                        column.append(value)
                last = (bucket, doc_id, body, hashes, places, follower)
            types = [part.schema.field(4).type, pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=schema.names)

    return map_batches(in_descending_order(docs, id_col, text), run, schema)
