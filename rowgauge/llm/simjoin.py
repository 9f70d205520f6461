"""N-gram Jaccard join: documents whose sets of word n-grams are alike, through a MinHash LSH forest.

1. Every text becomes its set of word n-grams, hashed. Equal sets are one node
   from here on, with the number of its copies.
2. A node has a label in each of ``TREES`` prefix tries: ``MAX_DEPTH`` min-hashes. The labels of all
   tries are sorted over the cluster, in ranges of equal size, so a prefix is a run.
3. Runs are met with their whole labels first. A matched prefix is shortened, hash by hash, as long as that
   can bring something: it ends where all nodes of the next longer run are connected already, or where a pair right at
   the threshold shares a prefix with the target recall, whichever comes first. Nodes whose sizes and one-bit sketches allow the
   threshold are connected, by a search that emits a spanning tree and no pairs.
   What is connected over all tries is a cell.
4. Runs that a range or a slice cut in two are met again, if they hold nodes of several cells: in
   blocks, those of the run's first cell against the others.
5. In each cell all pairs are verified exactly, block against block, so that a
   large cell is shared out over tasks. A block gives each node's number of
   links and a spanning tree of them; their components are the classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import map_batches, text_slices
from .components import components
from .spread import join_counted
from .storage import settle

N = 5
THRESHOLD = 0.8
TREES = 16
MAX_DEPTH = 8
HASHES = TREES * MAX_DEPTH
RECALL = 0.9995
#: A pair at the threshold falls short of its sketch's bound about once in 10^8.
SKETCH_DEVIATIONS = 5.6
BLOCK = 1_024
#: Nodes of a run that a task holds at a time.
SLICE = 4_096
FEW = 24  # a block of fewer nodes is verified pair by pair
STRETCH = 1 << 20  # code points hashed at a time

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE: list[np.ndarray] = []
_POWERS: dict[int, np.ndarray] = {}
_rng = np.random.default_rng(20240229)
_MULTIPLY = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACES = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def depth_for(recall: float, threshold: float = THRESHOLD, trees: int = TREES) -> int:
    """The longest prefix with which a pair at the threshold shares a run with that recall."""
    depth = MAX_DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 14), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps)
    return have


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word: lower case, parted by white space."""
    if not _SPACE:
        _SPACE.append(np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000))
    chars = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    word = np.concatenate([[False], ~_SPACE[0][chars], [False]])
    turns = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = turns[::2], turns[1::2]
    out = []
    first = 0
    while first < len(starts):  # stretches of whole words
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + STRETCH, "right")))
        low, high = starts[first], ends[last - 1]
        values = chars[low:high].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(_BASE, len(values))[: len(values)])])
        s, e = starts[first:last] - low, ends[first:last] - low
        out.append(_mixed((sums[e] - sums[s]) * _powers(_INVERSE, len(values))[s] + (e - s).astype(np.uint64)))
        first = last
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(text: str, n: int = N) -> np.ndarray:
    """Sorted hashes of the n-grams of words; of fewer words, all of them are one; without words, none."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(n, len(words))
    grams = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        grams += words[i : i + len(grams)] * _PLACES[i]
    return np.unique(_mixed(grams))


def signature(grams: np.ndarray) -> np.ndarray:
    """The least of each hash function over a set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2_048):
        values = grams[at : at + 2_048, None] * _MULTIPLY + _ADD
        least = np.minimum(least, values.min(axis=0))
    return _mixed(least)


def labels(values: np.ndarray) -> np.ndarray:
    """By tree, its whole label: two longs of four hashes, sixteen bits each."""
    rows = values.reshape(2 * TREES, MAX_DEPTH // 2) & np.uint64(0xFFFF)
    out = np.zeros(2 * TREES, np.uint64)
    for i in range(MAX_DEPTH // 2):
        out = (out << np.uint64(16)) | rows[:, i]
    return out.view(np.int64)


def sketch(values: np.ndarray) -> np.ndarray:
    """One bit of every min-hash, in longs."""
    return np.packbits((values >> np.uint64(40)).astype(np.uint8) & 1).view(np.int64)


def fewest_bits(threshold: float = THRESHOLD) -> int:
    """Equal bits of two sketches below which the threshold is out of reach."""
    mean = (1 + threshold) / 2
    return math.floor(HASHES * mean - SKETCH_DEVIATIONS * math.sqrt(HASHES * mean * (1 - mean)))


SIGNED = "doc_id, text_key, node, size, labels, sketch"


def signed(docs: DataFrame, id_col: str, text: str, n: int) -> DataFrame:
    """``doc_id, text_key, node, size, labels, sketch`` of every row; the node, a hash of the whole set, is null without words."""
    rows = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text]).alias("text_key"), docs[text].alias("text"))
    schema = T.StructType([*rows.schema[:2], *T.StructType.fromDDL("node binary, size int, labels array<long>, sketch array<long>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 2):
            nodes, sizes, tries, bits = [], [], [], []
            with np.errstate(over="ignore"):
                for t in texts:
                    grams = shingles(t or "", n)
                    values = signature(grams) if len(grams) else None
                    nodes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                    sizes.append(len(grams))
                    tries.append(None if values is None else labels(values))
                    bits.append(None if values is None else sketch(values))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                    pa.array(tries, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return map_batches(rows, run, schema)


def shared_depths(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many hashes each label of a sorted run shares with the one before."""
    out = np.zeros(len(high) - 1, np.int64)
    same = np.ones(len(high) - 1, bool)
    for half in (high, low):
        differ = half[1:] ^ half[:-1]
        for shift in (48, 32, 16, 0):
            same &= (differ >> shift) & 0xFFFF == 0
            out += same
    return out


def spanning(rows: np.ndarray, tree: np.ndarray, sizes: np.ndarray, bits: np.ndarray, threshold: float, least: int) -> Iterator[tuple]:
    """Edges that connect those trees of ``rows`` whose nodes may reach the threshold with each other.

    ``tree`` tells which nodes are connected already, and is brought up to date. A node is
    compared with those not reached yet only, so near copies, which
    are nearly all reached at once, cost little however many they are.
    """
    rest = rows[np.argsort(sizes[rows], kind="stable")]
    most = HASHES - least
    while len(rest):
        own = tree[rest] == tree[rest[0]]
        name = tree[rest[0]]
        queue, rest = rest[own].tolist(), rest[~own]
        while queue and len(rest):
            node = queue.pop()
            small, large = np.minimum(sizes[rest], sizes[node]), np.maximum(sizes[rest], sizes[node])
            near = small >= threshold * large - 1e-9
            near[near] = np.bitwise_count(bits[rest[near]] ^ bits[node]).sum(axis=1) <= most
            if near.any():
                reached, first = np.unique(tree[rest[near]], return_index=True)
                for other in rest[near][first]:
                    yield node, int(other)
                near = np.isin(tree[rest], reached)
                tree[np.isin(tree, reached)] = name
                queue.extend(rest[near].tolist())
                rest = rest[~near]


def descend(high: np.ndarray, low: np.ndarray, sizes: np.ndarray, bits: np.ndarray, floor: int, threshold: float, least: int):
    """``(a, b, depth)``: what connects the nodes of a sorted run, longest shared prefixes first.

    Prefixes are shortened until all nodes are connected or ``floor`` hashes are left.
    """
    shared = shared_depths(high, low)
    tree = np.arange(len(high))
    for depth in range(MAX_DEPTH, floor - 1, -1):
        if (tree == tree[0]).all():
            return
        if not (shared == depth).any():  # the same runs as one hash before
            continue
        starts = np.flatnonzero(np.concatenate([[True], shared < depth]))
        for at, to in zip(starts, [*starts[1:], len(high)]):
            if to - at > 1 and (shared[at : to - 1] == depth).any() and (tree[at:to] != tree[at]).any():
                for a, b in spanning(np.arange(at, to), tree, sizes, bits, threshold, least):
                    yield a, b, depth


def _runs(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows of one key after the other, of sorted batches; a single row of a key comes as well."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in key]
        keys = list(zip(*columns))
        starts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for at, to in zip(starts, [*starts[1:], len(keys)]):
            if keys[at] != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[at]
            held.append(batch.slice(at, to - at))
    if held:
        yield pa.Table.from_batches(held)


def prefix_masks(depth: int) -> tuple[int, int]:
    """Masks that leave that many hashes of a label's two longs."""

    def mask(hashes: int) -> int:
        return -(1 << 16 * (4 - hashes)) if hashes > 0 else 0

    return mask(min(depth, 4)), mask(depth - 4)


def forest(nodes: DataFrame, *more: str) -> DataFrame:
    """``tree, high, low`` (a label), ``node, size, sketch`` and ``more`` of every node in every trie."""
    trees = nodes.select("node", "size", "sketch", *more, "labels", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    at = 2 * F.col("tree") + 1
    return trees.select("tree", F.get("labels", at - 1).alias("high"), F.get("labels", at).alias("low"), "node", "size", "sketch", *more)


EDGES = "a binary, b binary, depth int, tree int, high long, low long"


def _bits(group: pa.Table) -> np.ndarray:
    return group["sketch"].combine_chunks().flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(group.num_rows, -1)


def candidate_edges(nodes: DataFrame, threshold: float, floor: int) -> DataFrame:
    """``a, b, depth``: the spanning edges of every run of every trie, and the hashes that were shared.

    Rows with a null ``b`` name runs (``tree, high, low`` of ``floor`` hashes) that were cut, at the ends of a task's
    range or after ``SLICE`` nodes: what lies on both sides of the cut has not been compared.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = fewest_bits(threshold)
    masks = prefix_masks(floor)
    most = SLICE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        cuts: set[tuple] = set()

        def out() -> pa.RecordBatch:
            rows = [(*e, None, None, None) for e in found] + [(None, None, None, *c) for c in sorted(cuts)]
            found.clear(), cuts.clear()
            kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["a", "b", "depth", "tree", "high", "low"]
            )

        last = None
        for key, group, cut in _runs(_without_lone(batches, masks), masks, most):
            if last is None or cut:
                cuts.add(key)  # the first run of a range may have begun in the one before
            last = key
            if group.num_rows > 1:
                group = group.combine_chunks()
                node = group["node"].to_pylist()
                high, low, size = (group[c].to_numpy() for c in ("high", "low", "size"))
                found += [(node[a], node[b], d) for a, b, d in descend(high, low, size, _bits(group), floor, threshold, least)]
            if len(found) > 10_000:
                yield out()
        if last is not None:
            cuts.add(last)
        yield out()

    ordered = forest(nodes).repartitionByRange(parts, "tree", "high", "low", "node").sortWithinPartitions("tree", "high", "low", "node")
    return map_batches(ordered, run, EDGES)


def _prefixes(batch: pa.RecordBatch, masks: tuple[int, int]) -> np.ndarray:
    tree, high, low = (batch.column(c).to_numpy() for c in ("tree", "high", "low"))
    return np.stack([tree.astype(np.int64), high & masks[0], low & masks[1]])


def _without_lone(batches: Iterator[pa.RecordBatch], masks: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Sorted batches without the rows whose prefix differs from both neighbours'; those at an edge stay."""
    for batch in batches:
        if batch.num_rows:
            keys = _prefixes(batch, masks)
            same = (keys[:, 1:] == keys[:, :-1]).all(axis=0)
            yield batch.filter(pa.array(np.concatenate([[True], same]) | np.concatenate([same, [True]])))


def _runs(batches: Iterator[pa.RecordBatch], masks: tuple[int, int], most: int) -> Iterator[tuple[tuple, pa.Table, bool]]:
    """Prefix, rows and whether it was cut, run after run of sorted batches; a longer run comes in slices."""
    held: list[pa.RecordBatch] = []
    last, n, cut = None, 0, False
    for batch in batches:
        keys = _prefixes(batch, masks)
        starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        for at, to in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(keys[:, at].tolist())
            if key != last:
                if held:
                    yield last, pa.Table.from_batches(held), cut
                held, last, n, cut = [], key, 0, False
            while at < to:
                if n == most:
                    yield last, pa.Table.from_batches(held), True
                    held, n, cut = [], 0, True
                step = min(to - at, most - n)
                held.append(batch.slice(at, step))
                at, n = at + step, n + step
    if held:
        yield last, pa.Table.from_batches(held), cut


def across_cuts(nodes: DataFrame, cells: DataFrame, cuts: DataFrame, threshold: float, floor: int) -> DataFrame:
    """``a, b``, cells: what connects the cells of those cut runs that hold nodes of several.

    The run's first cell needs no comparison with itself: the nodes of all other cells are cut into blocks of ``BLOCK``, and
    each block meets itself, the blocks after it and, block by block, the first cell.
    """
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = fewest_bits(threshold)
    masks = prefix_masks(floor)
    entries = forest(nodes.join(cells, "node", "left").withColumn("cell", F.coalesce("cell", "node")), "cell")
    entries = entries.withColumns({"high": F.col("high").bitwiseAND(masks[0]), "low": F.col("low").bitwiseAND(masks[1])})
    run_key = ["tree", "high", "low"]
    met = settle(entries.join(cuts, run_key), "cut-runs")
    by_cell = met.groupBy(*run_key, "cell").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "cell"))
    runs = by_cell.groupBy(*run_key).agg(largest.alias("main"), F.sum("n").alias("n"), F.count("*").alias("n_cells")).where("n_cells > 1")
    runs = runs.select(
        *run_key,
        F.col("main.cell").alias("main"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("others"),
        F.ceil(F.col("main.n") / BLOCK).cast("int").alias("mains"),
    )
    in_main = F.col("cell") == F.col("main")
    deal = F.xxhash64("node")
    block = F.when(in_main, F.col("others") + F.pmod(deal, F.col("mains"))).otherwise(F.pmod(deal, F.col("others"))).cast("int")
    till = F.when(in_main, F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    dealt = met.join(runs, run_key).select(
        *run_key, "cell", "node", "size", "sketch", block.alias("block"), F.explode(F.sequence(F.lit(0), till)).alias("other")
    )
    pair = [*run_key, "first", "second"]
    dealt = dealt.withColumns({"first": F.least("block", "other"), "second": F.greatest("block", "other")})
    dealt = dealt.select(*pair, "cell", "node", "size", "sketch").repartition(parts, *pair).sortWithinPartitions(*pair, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, tuple(pair)):
            group = group.combine_chunks()
            cell = group["cell"].to_pylist()
            names = {c: i for i, c in enumerate(dict.fromkeys(cell))}
            tree = np.array([names[c] for c in cell])
            found = list(spanning(np.arange(len(cell)), tree, group["size"].to_numpy(), _bits(group), threshold, least))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([cell[e[i]] for e in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return map_batches(dealt, run, "a binary, b binary")


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows of one key after the other, of sorted batches; a single row of a key comes as well."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(k).to_pylist() for k in key]))
        starts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for at, to in zip(starts, [*starts[1:], len(keys)]):
            if keys[at] != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[at]
            held.append(batch.slice(at, to - at))
    if held:
        yield pa.Table.from_batches(held)


def candidate_cells(nodes: DataFrame, threshold: float, floor: int) -> DataFrame:
    """``node, cell`` of every node that the forest connects with another; a cell is named by one of its nodes."""
    found = settle(candidate_edges(nodes, threshold, floor), "candidates")
    cells = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("root", "cell")
    cuts = found.where("b IS NULL").select("tree", "high", "low").distinct()
    joined = settle(across_cuts(nodes, cells, cuts, threshold, floor), "joined")
    if joined.isEmpty():
        return cells
    roots = components(joined).withColumnsRenamed({"node": "cell", "root": "top"})
    # a cell of one node gets a row when it is joined
    alone = roots.select(F.col("cell").alias("node"), "cell").join(cells, "node", "left_anti")
    return cells.unionByName(alone).join(roots, "cell", "left").select("node", F.coalesce("top", "cell").alias("cell"))


def overlaps(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of one list shares with each of the other."""
    if len(rows) * len(columns) <= FEW * FEW:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in columns] for a in rows]).reshape(len(rows), len(columns))
    n = len(rows)
    sets = [*rows, *columns]
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[code] > 1
    owner, code = owner[shared], code[shared]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    code = np.cumsum(np.concatenate([[0], code[1:] != code[:-1]])) if len(code) else code
    out = np.zeros((n, len(columns)), np.float32)
    width = 2_048
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, [first, first + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], code[a:b] - first] = 1
        out += held[:n] @ held[n:].T
    return out


def verified(sets: list[np.ndarray], copies: np.ndarray, first: np.ndarray, second: np.ndarray, threshold: float):
    """Links between nodes of two blocks (indexes; the same block twice: within it).

    Gives each index's links, counted with copies, and a spanning forest of the links.
    """
    size = np.array([len(s) for s in sets])
    shared = overlaps([sets[i] for i in first], [sets[i] for i in second])
    joint = size[first][:, None] + size[second][None, :] - shared
    linked = shared >= threshold * joint - 1e-9
    if first is second:
        np.fill_diagonal(linked, False)
    links = np.zeros(len(sets), np.int64)
    links[first] += linked @ copies[second]
    if first is not second:
        links[second] += linked.T @ copies[first]
    near = np.zeros((len(sets), len(sets)), bool)
    near[np.ix_(first, second)] |= linked
    near |= near.T
    edges, fresh = [], np.ones(len(sets), bool)
    for start in range(len(sets)):
        if fresh[start]:
            fresh[start] = False
            queue = [start]
            while queue:
                node = queue.pop()
                reached = np.flatnonzero(near[node] & fresh)
                fresh[reached] = False
                edges += [(node, int(i)) for i in reached]
                queue.extend(reached.tolist())
    return links, edges


def verify(members: DataFrame, n: int, threshold: float) -> DataFrame:
    """``a, b, links``: a node's number of links found in a block pair (b null), or a spanning edge (links null).

    ``members``: cell, blocks (of the cell), node, copies, text.
    """
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = members.select("cell", "blocks", "node", "copies").schema
    schema = T.StructType([*schema, T.StructField("packed", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part, texts in text_slices(batches, 4):
            packed = pa.array([squeeze((t or "").encode()) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:4], packed], names=schema.names)

    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        map_batches(members.select("cell", "blocks", "node", "copies", "text"), pack, schema)
        .select("cell", "node", "copies", "packed", block.alias("block"), other)
        .select("cell", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "copies", "packed")
        .repartition(parts, "cell", "low", "high")
        .sortWithinPartitions("cell", "low", "high", "node")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor().decompress
        for group in _groups(batches, ("cell", "low", "high")):
            nodes, packed = group["node"].to_pylist(), group["packed"].to_pylist()
            keep, sets = [], []
            with np.errstate(over="ignore"):
                for i, (node, body) in enumerate(zip(nodes, packed)):
                    if not keep or nodes[keep[-1]] != node:  # rows that repeat
                        keep.append(i)
                        sets.append(shingles(spread(body).decode(), n))
            block = group["block"].to_numpy()[keep]
            low, high = group["low"][0].as_py(), group["high"][0].as_py()
            first = np.flatnonzero(block == low)
            second = first if low == high else np.flatnonzero(block == high)
            links, edges = verified(sets, group["copies"].to_numpy()[keep], first, second, threshold)
            some = np.flatnonzero(links)
            a = [nodes[keep[i]] for i in some] + [nodes[keep[i]] for i, _ in edges]
            b = [None] * len(some) + [nodes[keep[j]] for _, j in edges]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array([*links[some].tolist(), *[None] * len(edges)], pa.int64())],
                names=["a", "b", "links"],
            )

    return map_batches(dealt, run, "a binary, b binary, links long")


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """A row for each row of ``docs``.

    ``doc_id, text_key`` (a hash of the text), ``class_id`` and ``class_key`` (id
    and text hash of the class's first document), ``copy_of`` (the least id with the same set of
    n-grams), ``n_links`` (documents whose sets reach the threshold with this one's, copies counted).
    Classes are what links connect. A text of fewer than n words is one n-gram;
    one without words, or null, has no links and is a class of its own. Null ids come first
    in a class. Other columns are left behind; repeated rows are copies.
    """
    rows = settle(signed(docs, id_col, text, n), "signed")
    nodes = settle(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.min(F.struct("doc_id", "text_key")).alias("head"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("labels").alias("labels"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    cells = candidate_cells(nodes, threshold, depth_for(recall, threshold))
    cells = settle(cells, "cells")
    sizes = settle(cells.groupBy(F.col("cell").alias("named")).agg(F.count("*").alias("members")), "cell-sizes")
    sized = join_counted(cells, sizes, F.col("cell") == F.col("named"), "members", cells.count())
    sized = sized.select("node", "cell", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    heads = nodes.select("node", "copies", F.col("head.doc_id").alias("head_id"), F.col("head.text_key").alias("head_key"))
    wanted = sized.join(heads, "node")
    bodies = docs.select(docs[id_col].alias("body_id"), docs[text].alias("text")).withColumn("body_key", F.xxhash64("text"))
    members = bodies.join(
        wanted, F.col("body_id").eqNullSafe(F.col("head_id")) & (F.col("body_key") == F.col("head_key"))
    ).select("cell", "blocks", "node", "copies", "text")
    found = settle(verify(members, n, threshold), "links")
    links = found.where("links IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    first = roots.join(nodes.select("node", "head"), "node").groupBy("root").agg(F.min("head").alias("first"))
    known = settle(  # as a table of its own, so that the join below can split a node of very many copies
        nodes.select("node", "head", "copies")
        .join(links, "node", "left")
        .join(roots.join(first, "root").select("node", "first"), "node", "left")
        .select(
            "node",
            F.col("head.doc_id").alias("copy_of"),
            F.coalesce("first", "head").alias("first"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "known",
    )
    alone = F.col("node").isNull()
    return rows.select("doc_id", "text_key", "node").join(known, "node", "left").select(
        "doc_id",
        "text_key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, F.col("text_key")).otherwise(F.col("first.text_key")).alias("class_key"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the first document of each class; rows equal in id and text count as one document."""
    found = similar_documents(docs, id_col, text, **options)
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")) & F.col("text_key").eqNullSafe(F.col("class_key")))
    heads = heads.select(F.col("doc_id").alias("head_id"), F.col("text_key").alias("head_key")).distinct()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        docs[id_col].alias("row_id"),
        F.xxhash64(docs[text]).alias("row_key"),
    )
    same = F.col("row_id").eqNullSafe(F.col("head_id")) & (F.col("row_key") == F.col("head_key"))
    return rows.join(heads, same, "left_semi").dropDuplicates(["row_id", "row_key"]).select("row.*")
