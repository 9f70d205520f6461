"""Vector code compression: product codes whose nearest entries are found exactly, in integers.

A vector becomes whole numbers and is cut into equal parts; each part is replaced by
the index of the nearest entry of its position's codebook. Parts and entries are padded with
zeros to a power of two and taken through the integer Walsh-Hadamard transform, which
multiplies squared distances by its size. Scaled squared differences are then added up one
coefficient at a time, in sequency order, where the first say most; an entry goes as soon
as its sum exceeds the whole distance of another. All of it is exact in 64-bit integers.

Codebooks are refined by rounds of assigning and averaging: a round is one pass, and
a task hands on one row of sums per codebook entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import map_batches
from .spread import join_counted
from .storage import settle

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
ROWS = 2_048  # vectors held at a time


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of the last axis, whose length is a power of two, in sequency order (by the number of sign changes)."""
    size = x.shape[-1]
    done, half = x.astype(np.int64), 1
    while half < size:
        pairs = done.reshape(*x.shape[:-1], size // (2 * half), 2, half)
        done = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(x.shape)
        half *= 2
    return done[..., sequency(size)]


def sequency(size: int) -> np.ndarray:
    """Places of the transform's rows by rising sequency: Gray codes with their bits turned round."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    return sum((((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)), np.zeros(size, np.int64))


def nearest_entries(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of each part's nearest entry (ties to the lower one) and the squared distance, exactly.

    ``parts`` and ``book`` are transformed. The entry nearest in the first coefficient sets the bound that the others must
    keep below or reach.
    """
    n, size = parts.shape
    sums = (parts[:, :1] - book[:, 0]) ** 2
    first = sums.argmin(1)
    bound = ((parts - book[first]) ** 2).sum(1)
    row, entry = np.nonzero(sums <= bound[:, None])
    sums = sums[row, entry]
    for s in range(1, size):
        sums = sums + (parts[row, s] - book[entry, s]) ** 2
        stays = sums <= bound[row]
        if not stays.all():
            row, entry, sums = row[stays], entry[stays], sums[stays]
    # every row keeps the entry that set its bound; pairs lie by row, then entry
    starts = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(sums, starts) if n else sums
    best = np.flatnonzero(sums == least[row])
    at = best[np.searchsorted(row[best], np.arange(n))]
    return entry[at], least // size


@dataclass(frozen=True)
class Codebooks:
    width: int  # components of a vector
    entries: np.ndarray  # position, entry, component

    @property
    def part(self) -> int:
        return self.entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def transformed(self) -> np.ndarray:
        return walsh_hadamard(padded(self.entries))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The whole-number vectors that codes (a row each) stand for."""
        found = self.entries[np.arange(codes.shape[1]), codes]
        return found.reshape(len(codes), -1)[:, : self.width]


def padded(x: np.ndarray) -> np.ndarray:
    """Zeros up to a power of two in the last axis."""
    size = 1 << (x.shape[-1] - 1).bit_length()
    return np.concatenate([x, np.zeros((*x.shape[:-1], size - x.shape[-1]), x.dtype)], axis=-1)


def usable(vector: Column) -> Column:
    """Whether a vector is there and its components are there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def largest_component(width: int, part: int) -> int:
    """Whole numbers up to this keep a part's scaled distance, and a vector's distance, below 2**63."""
    size = 1 << (part - 1).bit_length()
    return int((2**61 / (max(size * size, width, 1))) ** 0.5)


def _integers(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """Vectors as whole numbers, row x part x component; shorter ones end in zeros."""
    part = max(1, -(-width // parts))
    lists = column.cast(pa.list_(pa.float64()))
    ends = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    flat = np.floor(flat * SCALE)
    limit = largest_component(width, part)
    if flat.size and np.abs(flat).max() > limit:
        raise ValueError(f"a component times {SCALE} exceeds {limit}: distances would leave the range of a long")
    sizes = np.diff(ends)
    out = np.zeros((len(lists), parts * part), np.int64)
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat.astype(np.int64)
    return out.reshape(len(lists), parts, part)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """Codebooks of the ``entries`` smallest ids' parts (``id, v``); fewer if there are fewer rows, None if there are none.

    Ids that are null come last, rows of equal id in the order of their vectors. The width is that of the longest vector.
    """
    width = kept.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return None
    rows = kept.orderBy(F.asc_nulls_last("id"), "v").limit(entries).select("v").toArrow()
    books = _integers(rows.column(0).combine_chunks(), width, parts)
    return Codebooks(width, np.ascontiguousarray(books.transpose(1, 0, 2)))


def refined(kept: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, every entry to its parts' mean, rounded down; unused entries stay."""
    parts, entries, part = books.entries.shape
    width = books.width
    shared = kept.sparkSession.sparkContext.broadcast(books.transformed())  # of the codebooks' size
    names = ["position", "entry", "n", "sums"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, part), np.int64)
        for batch in _slices(batches):
            vectors = _integers(batch.column(0), width, parts)
            for p in range(parts):
                entry, _ = nearest_entries(walsh_hadamard(padded(vectors[:, p])), shared.value[p])
                held[p] += np.bincount(entry, minlength=entries)
                np.add.at(sums[p], entry, vectors[:, p])
        position, entry = np.nonzero(held)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(entry) + 1) * part, pa.int32()), pa.array(sums[position, entry].ravel()))
        columns = [pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(held[position, entry]), lists]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    found = map_batches(kept.select("v"), assign, "position int, entry int, n long, sums array<long>")
    totals = found.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(part)])
    moved = books.entries.copy()
    for r in totals.collect():  # a row per codebook entry at most
        moved[r["position"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(part)]
    return Codebooks(width, moved)


def encode_vectors(kept: DataFrame, books: Codebooks, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """The columns in ``keep``, ``codes`` (an index per part) and ``error`` (the squared distance to what they stand for)."""
    parts = books.entries.shape[0]
    width = books.width
    shared = kept.sparkSession.sparkContext.broadcast(books.transformed())
    schema = ", ".join([f"`{c}` {dict(kept.dtypes)[c]}" for c in keep] + ["codes array<int>", "error long"])
    names = [*keep, "codes", "error"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            vectors = _integers(batch.column(len(keep)), width, parts)
            found = [nearest_entries(walsh_hadamard(padded(vectors[:, p])), shared.value[p]) for p in range(parts)]
            codes = np.stack([x for x, _ in found], axis=1).astype(np.int32)
            error = sum(d for _, d in found)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * parts, pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], lists, pa.array(error, pa.int64())], names=names)

    return map_batches(kept.select(*keep, "v"), encode, schema)


def decode_vectors(encoded: DataFrame, books: Codebooks, codes: str = "codes", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """The columns in ``keep`` and ``vector``, the whole numbers (``SCALE`` times a component) that the codes stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(books)
    schema = ", ".join([f"`{c}` {dict(encoded.dtypes)[c]}" for c in keep] + ["vector array<long>"])
    parts = books.entries.shape[0]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lists = batch.column(len(keep))
            flat = lists.flatten().to_numpy().reshape(-1, parts)
            vectors = shared.value.decode(flat)
            out = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * shared.value.width, pa.int32()), pa.array(vectors.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], out], names=[*keep, "vector"])

    return map_batches(encoded.select(*keep, encoded[codes].alias("_codes")), decode, schema)


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over rows of equal label, nulls together."""
    totals = settle(coded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("_times")), "label-errors")
    total = totals.agg(F.sum("_times")).first()[0] or 0
    return join_counted(coded, totals, F.col(label).eqNullSafe(F.col("_label")), "_times", total).drop("_label", "_times")


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks | None]:
    """``id, label, codes, error, label_error`` of every usable vector, and the codebooks.

    Rows whose vector is null or holds null or non-finite components go. Components become floor(256 x). A vector shorter
    than the longest, or a width that parts do not divide, is filled up with zeros. Repeated rows are rows each; ids may be null.
    An empty table has no rows and no codebooks. Other columns are left behind. A component so large that a
    distance could leave the range of a long raises.
    """
    good = vectors.where(usable(vectors[vector])).select(vectors[id_col].alias("id"), vectors[label].alias("label"), vectors[vector].alias("v"))
    books = first_codebooks(good, parts, entries)
    if books is None:
        none = good.select("id", "label", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("long").alias("error"))
        return none.withColumn("label_error", F.lit(None).cast("long")), None
    for _ in range(rounds):
        books = refined(good, books)
    coded = settle(encode_vectors(good, books, ("id", "label")), "codes")
    return with_label_error(coded), books


def hex_code(codes: Column) -> Column:
    """Two lower-case hex digits per index, in order."""
    return F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
