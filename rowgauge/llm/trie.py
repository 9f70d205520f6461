"""The trie of conversation prefixes, through ROLLUP over positional turn-id columns.

A turn's id is a digest of its place, role and text, of 128 bits. The turns of a conversation fall
into blocks of ``BLOCK`` columns; a block is keyed by the node at which the block
before it ends, and one Spark SQL ROLLUP over the columns aggregates all prefixes
of all blocks together, ``grouping_id`` telling how many turns a row stands for.
A node's key is the exclusive or of the ids on its way: any order of folding
gives the same key, so long conversations need no rounds.

A node is told by its depth and its smallest member. What a subtree sums is
summed over members instead: every node counts for its smallest member, and what
that one had before the node is taken off again. So depth costs nothing either.

Turns are ordered by a range partitioning with counts per part, and all else per
conversation goes by bounded runs of it, so that one conversation may hold most of the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import map_batches
from .spread import before, beside, join_counted
from .storage import settle

BLOCK = 8
RUN = 128  # blocks, or copies of a row, that are handled as one run
PIECE = 1 << 16  # characters of joined ids handed to the digest at once

TURNS = [f"t{i}" for i in range(BLOCK)]


def _whole(x: Column, y: int) -> Column:
    """x divided by y, without the rest; exact for any long that is not negative."""
    return F.call_function("div", x, F.lit(y))


def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, ida, idb, size, n, part, n_before``: each turn with the number of turns before it in its conversation.

    Turns go by ``turn``, nulls first, and equal ones by their digest; ``n`` equal rows are one.
    A null role or text is empty. Rows without a conversation id belong to none and are left out.
    """
    said = F.coalesce(conversations[text], F.lit(""))
    who = F.coalesce(conversations[role].cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said))
    turns = (
        conversations.where(conversations[conv].isNotNull())
        .select(
            conversations[conv].cast("long").alias("conv_id"),
            conversations[turn].alias("turn"),
            F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("ida"),
            F.conv(F.substring(digest, 16, 15), 16, 10).cast("long").alias("idb"),
            F.octet_length(said).cast("long").alias("size"),
        )
        .groupBy("conv_id", "turn", "ida", "idb")
        .agg(F.max("size").alias("size"), F.count("*").alias("n"))
        .repartitionByRange("conv_id", "turn", "ida", "idb")
        .withColumn("part", F.spark_partition_id())
    )
    return before(settle(turns, "turns"), "conv_id", "part", ["turn", "ida", "idb"], ["n"], F.sum, add)


def with_shared_starts(ordered: DataFrame, family: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations as rebuilt: the first h turns of conversation ``c - c % family``, then c's own after its first h.

    h is the unsigned crc32 of the decimal c, modulo ``most``. Gives ``conv_id, start, count, ida, idb, size`` (``count``
    equal turns from the place ``start`` on) and ``conv_id, length`` of all conversations.
    """
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = ordered.groupBy("conv_id").agg(F.sum("n").alias("own"))
    convs = convs.select("conv_id", "own", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("source"))
    sources = convs.select(F.col("conv_id").alias("source"), F.col("own").alias("source_own"))
    convs = settle(convs.join(sources, "source", "left").withColumn("given", F.least("h", F.coalesce("source_own", F.lit(0)))), "conversations")
    from_h = F.greatest(F.col("n_before") - F.col("h"), F.lit(0))
    skipped = F.greatest(F.col("h") - F.col("n_before"), F.lit(0))
    own = beside(ordered, "conv_id", "part", convs.select("conv_id", "h", "given")).select(
        "conv_id", (F.col("given") + from_h).alias("start"), (F.col("n") - skipped).alias("count"), "ida", "idb", "size"
    )
    firsts = ordered.where(F.col("n_before") < most - 1).select(
        F.col("conv_id").alias("source"), F.col("n_before").alias("start"), "n", "ida", "idb", "size"
    )
    given = firsts.join(convs.select("conv_id", "source", "h"), "source").select(
        "conv_id", "start", F.least("n", F.col("h") - F.col("start")).alias("count"), "ida", "idb", "size"
    )
    lengths = convs.select("conv_id", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return own.unionByName(given).where("count > 0"), lengths


def as_they_are(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations as they are, in the form of ``with_shared_starts``."""
    turns = ordered.select("conv_id", F.col("n_before").alias("start"), F.col("n").alias("count"), "ida", "idb", "size")
    return turns, ordered.groupBy("conv_id").agg(F.sum("n").alias("length"))


def _fold(name: str) -> Column:
    """The exclusive or of a part of the turn ids of a block."""
    values = [F.coalesce(F.col(t)[name], F.lit(0)) for t in TURNS]
    return reduce(Column.bitwiseXOR, values)


def turn_blocks(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``conv_id, block, run, t0, ..., a_before, b_before, length``: a row per block, keyed by where the block before it ends.

    A conversation without turns has one block without turns.
    """
    last = F.col("count") - 1
    runs = turns.select("*", F.explode(F.sequence(F.lit(0).cast("long"), _whole(last, RUN))).alias("nth"))
    first = F.col("start") + F.col("nth") * RUN
    till = F.least(F.col("start") + last, first + RUN - 1)
    each = runs.select("conv_id", "ida", "idb", "size", F.explode(F.sequence(first, till)).alias("at"))
    placed = [F.xxhash64(F.lit(seed), "at", "ida", "idb").alias(name) for seed, name in ((1, "a"), (2, "b"))]
    parts = ("a", "b", "size")
    none = lengths.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("at"), *[F.lit(None).cast("long").alias(c) for c in parts])
    each = each.select("conv_id", "at", *placed, "size")
    slot = F.pmod("at", F.lit(BLOCK))
    blocks = (
        each.unionByName(none)
        .groupBy("conv_id", _whole(F.col("at"), BLOCK).alias("block"))
        .agg(*[F.max(F.when(slot == i, F.col(c))).alias(f"{c}{i}") for i in range(BLOCK) for c in parts])
        .select(
            "conv_id",
            "block",
            _whole(F.col("block"), RUN).alias("run"),
            *[F.when(F.col(f"a{i}").isNotNull(), F.struct(*[F.col(f"{c}{i}").alias(c) for c in parts])).alias(TURNS[i]) for i in range(BLOCK)],
        )
    )
    blocks = settle(blocks.withColumn("a", _fold("a")).withColumn("b", _fold("b")), "blocks")
    keyed = before(blocks, "conv_id", "run", ["block"], ["a", "b"], F.bit_xor, lambda x, y: x.bitwiseXOR(y))
    return settle(beside(keyed.drop("a", "b"), "conv_id", "run", lengths), "keyed-blocks")


def all_prefixes(blocks: DataFrame, **sums: str) -> DataFrame:
    """``a, b`` (the node's key), ``up_a, up_b`` (its parent's, null for the root), ``depth, size`` and the aggregates in ``sums``: a row per node."""
    listed = ", ".join(TURNS)
    wanted = ", ".join(f"{sql} AS {name}" for name, sql in sums.items())
    level = f"{BLOCK} - bit_count(grouping_id() & {(1 << BLOCK) - 1})"
    last = f"CASE {level} " + " ".join(f"WHEN {i + 1} THEN {t} IS NOT NULL" for i, t in enumerate(TURNS)) + " ELSE block = 0 END"
    rolled = blocks.sparkSession.sql(
        f"SELECT block, a_before, b_before, {listed}, {level} AS level, {wanted} FROM {{blocks}} "
        f"GROUP BY block, a_before, b_before, ROLLUP({listed}) HAVING {last}",
        blocks=blocks,
    )
    at = F.col("level")
    last_turn = F.coalesce(*[F.col(t) for t in reversed(TURNS)])
    own = {name: F.col(f"{name}_before").bitwiseXOR(_fold(name)) for name in ("a", "b")}
    return rolled.select(
        *[key.alias(name) for name, key in own.items()],
        *[F.when(at > 0, key.bitwiseXOR(last_turn[name])).alias(f"up_{name}") for name, key in own.items()],
        (F.col("block") * BLOCK + at).cast("long").alias("depth"),
        F.coalesce(last_turn["size"], F.lit(0)).alias("size"),
        *sums,
    )


def digest_of_ids(ends: DataFrame) -> DataFrame:
    """``a, b, ends_sha256``: the digest of the ids at each node, ascending, comma-joined.

    Ids are sorted and joined to pieces in parts of bounded size, wherever a node's ids lie. Only the pieces
    meet in one task, which streams them through the digest and holds one at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, ids = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
            step = PIECE // 20
            starts = np.unique(np.concatenate([cuts, np.arange(0, len(a), step)]))
            words = ids.astype(str)
            texts = [",".join(words[x:y]) for x, y in zip(starts, [*starts[1:], len(a)])]
            yield pa.RecordBatch.from_arrays([*[pa.array(c[starts]) for c in (a, b, ids)], pa.array(texts, pa.string())], names=["a", "b", "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            done = []
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (a, b) == at:
                    state.update(b"," + text.encode())
                    continue
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = (a, b), hashlib.sha256(text.encode())
            if done:
                yield _rows(done)
        if at is not None:
            yield _rows([(*at, state.hexdigest())])

    dealt = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    pieces = map_batches(dealt.select("a", "b", "conv_id"), join, "a long, b long, first long, ids string")
    sorted_pieces = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return map_batches(sorted_pieces, digest, "a long, b long, ends_sha256 string")


def _rows(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, sha = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sha, pa.string())], names=["a", "b", "ends_sha256"])


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per node of the trie of conversations; see ``conversation_trie``."""
    blocks = turn_blocks(turns, lengths)
    nodes = all_prefixes(blocks, conv_id="min(conv_id)", n_convs="count(*)")
    nodes = settle(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = settle(nodes.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "inner-nodes")

    saving = (F.col("n_convs") - 1) * F.col("size")
    own = nodes.groupBy("conv_id").agg(F.sum(saving).alias("saves"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("ends_alone"))
    carried = beside(blocks, "conv_id", "run", own)
    sums = all_prefixes(carried, saved="sum(coalesce(saves, 0))", n_leaves="sum(coalesce(ends_alone, 0))").select("a", "b", "saved", "n_leaves")

    shared = nodes.where("n_convs > 1").select("a", "b", "conv_id", "depth", _whole(F.col("depth"), RUN * BLOCK).alias("run"), saving.alias("saving"))
    spent = before(shared, "conv_id", "run", ["depth"], ["saving"], F.sum, add).select("a", "b", "saving_before")

    ending = blocks.where(F.col("block") == _whole(F.greatest(F.col("length") - 1, F.lit(0)), BLOCK))
    ends = ending.select("conv_id", *[F.col(f"{name}_before").bitwiseXOR(_fold(name)).alias(name) for name in ("a", "b")])
    whole = (
        nodes.join(sums, ["a", "b"])
        .join(spent, ["a", "b"], "left")
        .join(digest_of_ids(ends), ["a", "b"], "left")
        .withColumn("saved_tokens", F.when(F.col("n_convs") > 1, F.col("saved") - F.col("saving_before")).otherwise(0))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    )
    parents = nodes.where("n_children > 0").select(
        F.col("a").alias("top_a"), F.col("b").alias("top_b"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings")
    )
    whole = whole.select("up_a", "up_b", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    found = join_counted(whole, parents, (F.col("up_a") == F.col("top_a")) & (F.col("up_b") == F.col("top_b")), "siblings", nodes.count())
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversation_trie(conversations: DataFrame, share: bool = False) -> DataFrame:
    """The trie of all prefixes of conversations (``conv_id, turn, role, text``): a row per node.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (null for the root), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (childless nodes in the subtree), ``saved_tokens`` (bytes of last texts times members but one,
    over the subtree) and ``ends_sha256`` (of the ids that end here). ``share`` first rebuilds conversations
    with ``with_shared_starts``. Null roles and texts are empty, null turns come first, ties go by digest; rows without a
    conversation id are left out; other columns are ignored. An empty table has no nodes.
    """
    ordered = settle(ordered_turns(conversations), "ordered")
    return prefix_trie(*(with_shared_starts(ordered) if share else as_they_are(ordered)))
