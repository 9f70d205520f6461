"""Sharding by fixed virtual slots.

A record hashes into one of a fixed number of slots; bytes and rows are summed
per slot; a stored map takes slots to shards. The map is an edit log: a version
holds only the slots that it moves, so that rebalancing rewrites a few rows and
moves only the records of those slots. Whatever the input's size, the driver
sees one row per slot.
"""

from __future__ import annotations

import bisect
import heapq
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rowgauge.session import path_exists

SLOTS = 8192
#: Shards may differ by this part of their mean size before slots are moved.
TOLERANCE = 0.0005
RECORD_OVERHEAD = 8

MAP_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("virtual_slot", T.LongType()),
        T.StructField("shard", T.IntegerType()),
    ]
)


def with_slots(docs: DataFrame, id_col: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``doc_id, size, text_crc32, row_hash, virtual_slot`` of every row.

    Size: UTF-8 bytes of the text (null: none) plus 8. The hash covers id and
    text, so that null or repeated ids with different texts still spread.
    """
    body = F.encode(F.coalesce(docs[text], F.lit("")), "utf-8")
    return docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(body) + RECORD_OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(docs[id_col], docs[text]).alias("row_hash"),
        F.pmod(F.xxhash64(docs[id_col], docs[text]), F.lit(slots)).alias("virtual_slot"),
    )


def spread_copies(slotted: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows that repeat until they outweigh an average slot, fewer than there are slots, get a slot each.

    Such copies can't be told apart, so which gets which is left to where they lie: write the result before reading it twice.
    """
    total = slotted.agg(F.sum("size")).first()[0] or 0
    copies = slotted.groupBy("row_hash").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    heavy = copies.where((F.col("n") > 1) & (F.col("bytes").cast("decimal(38,0)") * slots > total))
    marked = slotted.join(F.broadcast(heavy.select("row_hash", F.lit(True).alias("heavy"))), "row_hash", "left")
    own = F.pmod(F.xxhash64("row_hash", F.monotonically_increasing_id()), F.lit(slots))
    return marked.withColumn("virtual_slot", F.when(F.col("heavy"), own).otherwise(F.col("virtual_slot"))).drop("heavy", "row_hash")


def slot_weights(slotted: DataFrame) -> DataFrame:
    """``virtual_slot, bytes, rows``: at most one row per slot."""
    return slotted.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def first_map(shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Equal runs of slots."""
    return {slot: slot * shards // slots for slot in range(slots)}


def rebalance(
    placed: dict[int, int], weight: dict[int, int], shards: int, tolerance: float = TOLERANCE
) -> dict[int, int]:
    """The edits (slot to new shard) that even out the shards' weights.

    Between the heaviest shard and the lightest that can help, the slot, or the
    pair of slots, is moved whose difference comes nearest to half their gap.
    Every step lowers the heaviest pair, so it ends: within the tolerance, or
    when no move or swap is left.
    """
    held: dict[int, list[tuple[int, int]]] = defaultdict(list)
    load = [0] * shards
    for slot, shard in placed.items():
        if weight.get(slot):
            bisect.insort(held[shard], (weight[slot], slot))
            load[shard] += weight[slot]
    allowed = tolerance * sum(load) / shards
    moved: dict[int, int] = {}

    def step(high: int, low: int) -> bool:
        gap = load[high] - load[low]
        best = None
        for size, slot in [(0, None), *held[low]]:
            at = bisect.bisect_left(held[high], (size + gap / 2, -1))
            for w, other in held[high][max(0, at - 1) : at + 1]:
                delta = w - size
                if 0 < delta < gap and (best is None or abs(2 * delta - gap) < best[0]):
                    best = (abs(2 * delta - gap), (w, other), (size, slot))
        if best is None:
            return False
        for give, source, target in ((best[1], high, low), (best[2], low, high)):
            if give[1] is not None:
                held[source].remove(give)
                bisect.insort(held[target], give)
                load[source] -= give[0]
                load[target] += give[0]
                moved[give[1]] = target
        return True

    while max(load) - min(load) > allowed:
        high = load.index(max(load))
        lighter = sorted((x for x in range(shards) if load[high] - load[x] > allowed), key=load.__getitem__)
        if not any(step(high, low) for low in lighter):
            break
    return {slot: shard for slot, shard in moved.items() if placed[slot] != shard}


def fill(placed: dict[int, int], weight: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """Shards for the slots that have none among the first ``shards``: heaviest first, each to the lightest shard."""
    load = [0] * shards
    homeless = []
    for slot in range(slots):
        if 0 <= placed.get(slot, -1) < shards:
            load[placed[slot]] += weight.get(slot, 0)
        else:
            homeless.append(slot)
    lightest = [(x, shard) for shard, x in enumerate(load)]
    heapq.heapify(lightest)
    found = {}
    for slot in sorted(homeless, key=lambda s: (-weight.get(s, 0), s)):
        x, shard = heapq.heappop(lightest)
        found[slot] = shard
        heapq.heappush(lightest, (x + weight.get(slot, 0), shard))
    return found


def write_edits(spark: SparkSession, path: str, version: int, edits: dict[int, int]) -> None:
    """Append a version to the stored map: only the slots that it places anew."""
    rows = [(version, slot, shard) for slot, shard in sorted(edits.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def last_version(spark: SparkSession, path: str) -> int:
    return spark.read.schema(MAP_SCHEMA).parquet(path).agg(F.max("version")).first()[0]


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``virtual_slot, shard`` as of a version (the latest if none is given)."""
    log = spark.read.schema(MAP_SCHEMA).parquet(path)
    if version is not None:
        log = log.where(F.col("version") <= version)
    return log.groupBy("virtual_slot").agg(F.max_by("shard", "version").alias("shard"))


def place(slotted: DataFrame, weights: dict[int, tuple[int, int]], placed: dict[int, int]) -> DataFrame:
    """``slotted`` with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    A slot starts where the slots before it in its shard end, so rows are only
    numbered within their virtual slot.
    """
    spark = slotted.sparkSession
    start: dict[int, int] = defaultdict(int)
    rows = []
    for slot in sorted(weights):
        shard = placed[slot]
        rows.append((slot, shard, start[shard]))
        start[shard] += weights[slot][1]
    places = spark.createDataFrame(rows, "virtual_slot long, shard int, first long")
    within = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        slotted.withColumn("nth", F.row_number().over(within))
        .join(F.broadcast(places), "virtual_slot")  # a row per slot, however large the input
        .withColumn("slot", F.col("first") + F.col("nth") - 1)
        .drop("nth", "first")
    )


def shard_documents(
    docs: DataFrame, shards: int, map_path: str, settled, id_col: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> DataFrame:
    """Every row of ``docs`` in a shard from 0, shards near equal in bytes.

    ``map_path`` holds the map. Where there is none yet, version 1 are equal runs of slots. The latest
    version is then edited, and the edits are appended as the next one: slots of shards that are no more find new
    ones, and those move that the slots' bytes call for. ``settled`` writes and rereads the
    narrow slotted rows, so that texts are read once. Returns ``doc_id, size,
    text_crc32, virtual_slot, shard, slot``; other columns are left behind. An
    empty table gives an empty result and a map of equal runs.
    """
    spark = docs.sparkSession
    slotted = settled(spread_copies(settled(with_slots(docs, id_col, text, slots)), slots))
    weights = {r.virtual_slot: (r.bytes, r.rows) for r in slot_weights(slotted).collect()}
    weight = {slot: w[0] for slot, w in weights.items()}
    if not path_exists(spark, map_path):
        write_edits(spark, map_path, 1, first_map(shards, slots))
    stored = {r.virtual_slot: r.shard for r in read_map(spark, map_path).collect()}  # a row per slot
    placed = stored | fill(stored, weight, shards, slots)
    placed |= rebalance(placed, weight, shards)
    edits = {slot: shard for slot, shard in placed.items() if stored.get(slot) != shard}
    if edits:
        write_edits(spark, map_path, last_version(spark, map_path) + 1, edits)
    current = {r.virtual_slot: r.shard for r in read_map(spark, map_path).collect()}
    return place(slotted, weights, current)
