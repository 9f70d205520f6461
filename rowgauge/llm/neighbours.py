"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are built on the driver from a bounded sample (``SAMPLE`` rows, fewer if
vectors are long): a node parts its rows at the median of their projections on
the difference of two of them. Every row then goes down every tree, in tasks. A
query descends all trees through one priority queue, always into the branch,
of any tree, whose worst margin is the least, until the leaves it has reached
hold enough rows; what is enough is measured on the sample, as the share of rows
that finds ``RECALL`` of the true neighbours. Leaves are searched exhaustively
with exact inner products, and a query's best over all leaves are its answer.

Trees part by distance, the measure is the inner product: for the trees a row
has one component more, which brings all rows to the length of the longest. Among rows of
one length the nearest are those of the largest inner product; a query has 0 there.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .batches import map_batches
from .storage import settle

TREES = 12
SAMPLE = 20_000
SAMPLE_BYTES = 64 << 20
LEAF = 64  # sampled rows in a leaf
RECALL = 0.96  # aimed at on the sample; 0.9 is asked for
PROBES = 120  # sampled queries to measure it
QUERY_BLOCK = 20_000
SLACK = 8  # kept beyond the number asked for until scores are compared across leaves
CHUNK = 1_024
PART_ROWS = 250_000  # of a tree, searched by one task for a block of queries
HELD = 256


@dataclass
class Forest:
    normal: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    cut: np.ndarray = field(default_factory=lambda: np.zeros(0))
    child: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int64))  # a leaf l is -l - 1
    roots: list[int] = field(default_factory=list)
    tree_of: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # by leaf

    def margins(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.normal.T - self.cut if len(self.cut) else np.zeros((len(vectors), 0))

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree; margins of a few vectors are held at a time."""
        out = np.empty((len(vectors), len(self.roots)), np.int64)
        for first in range(0, len(vectors), HELD):
            some = slice(first, first + HELD)
            margins = self.margins(vectors[some])
            for t, root in enumerate(self.roots):
                node = np.full(len(margins), root)
                while (inner := np.flatnonzero(node >= 0)).size:
                    node[inner] = self.child[node[inner], (margins[inner, node[inner]] > 0).astype(int)]
                out[some, t] = -node - 1
        return out

    def visits(self, margins: np.ndarray, rows: np.ndarray, enough: float) -> list[int]:
        """Leaves in the order of the queue, until they hold ``enough`` rows."""
        queue = [(-math.inf, root) for root in self.roots]
        heapq.heapify(queue)
        found, held = [], 0
        child = self.child
        while queue and held < enough:
            worst, node = heapq.heappop(queue)
            if node < 0:
                found.append(-node - 1)
                held += rows[-node - 1]
                continue
            side = margins[node]
            left, right = child[node]
            heapq.heappush(queue, (max(worst, side), int(left)))
            heapq.heappush(queue, (max(worst, -side), int(right)))
        return found


def build(sample: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    normals, cuts, children, tree_of = [], [], [], []

    def grow(rows: np.ndarray, tree: int) -> int:
        if len(rows) > leaf:
            for _ in range(3):
                a, b = rng.choice(rows, 2, replace=False)
                normal = sample[a] - sample[b]
                if (size := np.linalg.norm(normal)) == 0:
                    continue
                along = sample[rows] @ (normal / size)
                cut = np.median(along)
                if 0 < (right := along > cut).sum() < len(rows):
                    at = len(cuts)
                    normals.append(normal / size)
                    cuts.append(cut)
                    children.append(None)
                    children[at] = (grow(rows[~right], tree), grow(rows[right], tree))
                    return at
        tree_of.append(tree)
        return -len(tree_of)

    roots = [grow(np.arange(len(sample)), t) for t in range(trees)]
    return Forest(
        np.array(normals).reshape(len(cuts), sample.shape[1]),
        np.array(cuts),
        np.array(children, np.int64).reshape(-1, 2),
        roots,
        np.array(tree_of, np.int32),
    )


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that brings them to the length of the longest."""
    rest = np.sqrt(np.maximum(longest**2 - (vectors**2).sum(axis=1), 0.0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def as_query(vectors: np.ndarray) -> np.ndarray:
    return np.concatenate([vectors, np.zeros((len(vectors), 1))], axis=1)


def share_to_search(forest: Forest, sample: np.ndarray, longest: float, k: int, recall: float = RECALL) -> float:
    """Rows to look at (counted once per tree they are met in), as a share of all rows, for the recall."""
    leaf_of = forest.leaves(lifted(sample, longest))
    rows = np.bincount(leaf_of.ravel(), minlength=len(forest.tree_of))
    probes = np.linspace(0, len(sample) - 1, min(PROBES, len(sample))).astype(int)
    margins = forest.margins(as_query(sample[probes]))
    needed = []
    for probe, margin in zip(probes, margins):
        scores = sample @ sample[probe]
        scores[probe] = -np.inf
        true = np.argsort(-scores, kind="stable")[: min(k, len(sample) - 1)]
        order = forest.visits(margin, rows, math.inf)
        till = np.empty(len(rows))
        till[order] = np.cumsum(rows[order])
        needed.append(till[leaf_of[true]].min(axis=1))
    needed = np.sort(np.concatenate(needed)) if needed else np.zeros(0)
    if not len(needed):
        return math.inf
    return float(needed[min(len(needed) - 1, math.ceil(recall * len(needed)) - 1)]) / len(sample)


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, every component there and finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for at in range(0, batch.num_rows, CHUNK):
            yield batch.slice(at, CHUNK)


def _one_by_one(forest: Forest, vectors: np.ndarray) -> Iterator[np.ndarray]:
    for first in range(0, len(vectors), HELD):
        yield from forest.margins(vectors[first : first + HELD])


class _Best:
    """The best so far of a block of queries in one part of one tree."""

    def __init__(self, k: int):
        self.k = k
        self.ids: list[int] = []
        self.parts: list[np.ndarray] = []
        self.by_leaf: dict[int, list[int]] = {}
        self.vectors = None

    def add(self, query: int, vector: np.ndarray, leaves: list[int]) -> None:
        for leaf in leaves:
            self.by_leaf.setdefault(leaf, []).append(len(self.ids))
        self.ids.append(query)
        self.parts.append(vector)

    def search(self, leaf: int, ids: np.ndarray, members: np.ndarray) -> None:
        asked = self.by_leaf.get(leaf)
        if not asked:
            return
        if self.vectors is None:
            self.vectors, self.query = np.array(self.parts), np.array(self.ids)
            self.score = np.full((len(self.ids), self.k), -np.inf)
            self.found = np.zeros((len(self.ids), self.k), np.int64)
        asked = np.array(asked)
        score = self.vectors[asked] @ members.T
        score[self.query[asked][:, None] == ids[None, :]] = -np.inf
        both = np.concatenate([self.score[asked], score], axis=1)
        every = np.concatenate([self.found[asked], np.broadcast_to(ids, score.shape)], axis=1)
        # rounded, so that equal vectors tie whatever the order of summation; of equals the smaller ids stay
        order = np.lexsort((every, -np.round(both, 13)), axis=1)[:, : self.k]
        best = np.take_along_axis(both, order, axis=1)
        row, place = np.nonzero((order >= self.k) & (best > -np.inf))
        # the sum of products in one fixed order, the same wherever the pair is met
        best[row, place] = (self.vectors[asked[row]] * members[order[row, place] - self.k]).sum(axis=1)
        self.score[asked] = best
        self.found[asked] = np.take_along_axis(every, order, axis=1)

    def rows(self) -> pa.RecordBatch | None:
        if self.vectors is None:
            return None
        row, place = np.nonzero(self.score > -np.inf)
        columns = [self.query[row], self.found[row, place], self.score[row, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", trees: int = TREES
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every row that ``queries`` picks.

    Nearness is the inner product in double precision, ties go to the smaller
    id; a row is no neighbour of its own id. Vectors that are null, zero, of
    another length than most, or that hold null or non-finite components, and
    rows without an id take no part. Of equal vectors only the k + 1 smallest
    ids can be in an answer, so only these are indexed; all of them may ask. An
    empty table has no answers; other columns are left behind.
    """
    spark = vectors.sparkSession
    good = vectors.where(usable(vectors[vector]) & vectors[id_col].isNotNull()).select(
        vectors[id_col].cast("long").alias("id"), vectors[vector].alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    lengths = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    good = good.where(F.size("v") == lengths["n"])
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    rows = settle(good.withColumn("nth", nth).where((F.col("nth") <= k + 1)).select("id", "v"), "vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    total, longest = rows.agg(F.count("*"), F.max(length)).first()
    size = max(k + 2, min(SAMPLE, SAMPLE_BYTES // (4 * lengths["n"])))
    spread = F.pmod(F.xxhash64("id", "v", F.lit("forest")), F.lit(1 << 40))
    sampled = rows.where(spread < min(1 << 40, (1 << 40) * size // max(1, total))).orderBy("id", "v").select("v").toArrow()
    sample = _matrix(sampled.column(0).combine_chunks()) if sampled.num_rows else np.zeros((0, lengths["n"]))
    forest = build(lifted(sample, longest), trees)
    share = share_to_search(forest, sample, longest, k)
    shared = spark.sparkContext.broadcast(forest)  # bounded by the sample

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            leaves = shared.value.leaves(lifted(_matrix(batch.column(1)), longest))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, leaves.size + 1, leaves.shape[1]), pa.int32()), pa.array(leaves.ravel().astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["id", "v", "leaves"])

    kind = dict(rows.dtypes)["v"]
    placed = settle(map_batches(rows, place, f"id long, v {kind}, leaves array<int>"), "placed")
    held = np.zeros(len(forest.tree_of), np.int64)
    for r in placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():  # a row per leaf
        held[r["leaf"]] = r["count"]
    enough = max(share * total, float(trees * (k + 2)))
    each = max(1, math.ceil(total / PART_ROWS))  # parts of a tree
    part_of = forest.tree_of.astype(np.int64) * each + np.arange(len(forest.tree_of)) % each
    known = spark.sparkContext.broadcast((held, part_of))  # a number per leaf
    asking = good.where("asks").select("id", "v")
    blocks = max(1, math.ceil(asking.count() / QUERY_BLOCK))
    layout = f"part int, block int, member boolean, leaf int, leaves array<int>, id long, v {kind}"
    names = ["part", "block", "member", "leaf", "leaves", "id", "v"]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part_of = known.value
        for batch in _batches(batches):
            lines = []
            for i, margin in enumerate(_one_by_one(shared.value, as_query(_matrix(batch.column(1))))):
                by_part: dict[int, list[int]] = {}
                for leaf in shared.value.visits(margin.tolist(), held, enough):
                    by_part.setdefault(int(part_of[leaf]), []).append(leaf)
                lines += [(i, part, leaves) for part, leaves in by_part.items()]
            at = pa.array([x[0] for x in lines], pa.int64())
            n = len(lines)
            ids = batch.column(0).take(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[1] for x in lines], pa.int32()),
                    pa.array((ids.to_numpy() * 2654435761 % 2**31 % blocks).astype(np.int32)),
                    pa.array(np.zeros(n, bool)),
                    pa.nulls(n, pa.int32()),
                    pa.array([x[2] for x in lines], pa.list_(pa.int32())),
                    ids,
                    batch.column(1).take(at),
                ],
                names=names,
            )

    tree = F.posexplode("leaves")
    members = placed.select("id", "v", tree.alias("tree", "leaf")).select(
        (F.col("tree") * each + F.col("leaf") % each).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.lit(True).alias("member"),
        "leaf",
        F.lit(None).cast("array<int>").alias("leaves"),
        "id",
        "v",
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        for batch in _batches(batches):
            parts, block, member = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            leaf = batch.column(3).to_numpy(zero_copy_only=False)
            ids, matrix = batch.column(5).to_numpy(), _matrix(batch.column(6))
            lists = batch.column(4)
            i = 0
            while i < batch.num_rows:
                if now != (key := (parts[i], block[i])):
                    if best and (out := best.rows()):
                        yield out
                    now, best = key, _Best(k + SLACK)
                same = (parts[i:] == key[0]) & (block[i:] == key[1]) & (member[i:] == member[i])
                if member[i]:
                    same &= leaf[i:] == leaf[i]
                end = i + (len(same) if same.all() else int(same.argmin()))
                if member[i]:
                    best.search(int(leaf[i]), ids[i:end], matrix[i:end])
                else:
                    for j in range(i, end):
                        best.add(int(ids[j]), matrix[j], lists[j].as_py())
                i = end
        if best and (out := best.rows()):
            yield out

    dealt = (
        map_batches(asking, route, layout)
        .unionByName(members)
        .repartition(trees * each, "part", "block")
        .sortWithinPartitions("part", "block", "member", "leaf", "id")
    )
    met = map_batches(dealt, search, "query_id long, vec_id long, score double")
    once = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # a pair may meet in several trees
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
