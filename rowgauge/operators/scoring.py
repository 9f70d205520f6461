"""Failure counts, scores and issue rows.

``measure`` reduces a table to one row per run, called facts: the row count,
the failed rows of each check, the rows failing any check of a dimension and
the first failing values. Everything reported derives from facts by projection.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import json_scalar, named, round_score, round_share, type_of
from ..model import DIMENSIONS, SCORE_COLUMNS
from .checks import Check, any_of, balanced
from .normalize import GENERATED_ROW_ID
from .uniqueness import flag_duplicates, is_hot, key_columns, key_counts, key_values, mark_keys

# Sample sizes of an issue row.
SAMPLES_PER_CHECK = 5
BLANKS_WITHOUT_COLUMN = 3

# Beyond every row.
UNBOUNDED = 2**63 - 1

# Rows fall into this many slots to bound where samples can lie.
REACH_SLOTS = 16

# So many checks share one pattern of flags: at most 2 to this power patterns a chunk, whatever the rows.
CHUNK = 12
# The chunk number of the pattern that tells in which groups of checks a row fails.
BY_GROUP = -1

# The rows that completeness drops, in facts. A repeated key may lower that score, but drops no row.
INCOMPLETE = "incomplete"


def attach_flags(
    df: DataFrame,
    checks: Sequence[Check],
    row_id: str,
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
    shared_only: bool = False,
) -> tuple[DataFrame, list[Check]]:
    """Resolve uniqueness checks into row flags, so that they are row predicates too.

    With ``shared_only`` just those are resolved that share their dimension
    with another check; alone in its dimension a uniqueness check needs counts
    per key and no flags.

    Row predicates are evaluated first: what the flags' joins may have to
    shuffle is keys, booleans and the columns to ``keep``, not their inputs.
    """

    def to_resolve(check: Check) -> bool:
        alone = sum(c.dimension == check.dimension for c in checks) == 1
        return bool(check.keys) and not (shared_only and alone)

    if not any(to_resolve(check) for check in checks):
        return df, list(checks)
    columns = dict.fromkeys([*by, row_id, *keep, *[k for check in checks for k in check.keys]])
    evaluated, plain = [], []
    for i, check in enumerate(checks):
        if check.failed is not None:
            evaluated.append(check.failed.alias(f"_failed{i}"))
        if check.sample is not None:
            value = check.sample if check.failed is None else F.when(check.failed, check.sample)
            evaluated.append(value.alias(f"_sample{i}"))
        plain.append(
            replace(
                check,
                failed=None if check.failed is None else F.col(f"_failed{i}"),
                sample=None if check.sample is None else F.col(f"_sample{i}"),
            )
        )
    df = df.select(*[named(c) for c in columns], *evaluated)
    for i, check in enumerate(checks):
        if to_resolve(check):
            excused = check.keys if check.excuse_nulls else ()
            df = flag_duplicates(df, (*by, *check.keys), row_id, f"_dup{i}", excused)
            plain[i] = replace(plain[i], keys=(), failed=F.col(f"_dup{i}"))
    return df, plain


def any_name(dimension: str) -> str:
    return f"any_{dimension.lower()}"


def _sampled(checks: Sequence[Check]) -> dict[int, Check]:
    """The row predicates whose failing values are listed."""
    return {i: c for i, c in enumerate(checks) if c.failed is not None and c.sample is not None}


def first_failures(
    df: DataFrame, checks: Sequence[Check], row_id: str, by: Sequence[str], reach: Column | None = None
) -> DataFrame:
    """The first failing values of each check in row order, as JSON items.

    Ranking keeps at most five rows per check in every task before the shuffle.
    ``reach`` gives, per check, a row that the first five failing ones do not lie
    beyond (``bounds``; none: any row may be among them), and the largest of these (``most``).
    Rows without an id come first and lie within every bound.
    """
    carried = [named(b) for b in by]
    entries = []
    if reach is not None:
        df = df.withColumn("_reach", reach)

    def within(bound: Column) -> Column:
        return named(row_id).isNull() | (named(row_id) <= bound)

    for i, check in _sampled(checks).items():
        entries.append(F.when(check.failed, F.struct(F.lit(i).alias("check"), check.sample.alias("value"))))
    shape = [*by, "_row", "check", "value"]
    parts = []
    leads = []
    if not by:
        # rows of the leading keys are met in the same reading of the input
        for i, check in enumerate(checks):
            if check.keys:
                df = _mark_leading(df, check, row_id, f"_lead{i}")
                leads.append(F.col(f"_lead{i}").isNotNull())
                entries.append(F.when(leads[-1], F.struct(F.lit(i).alias("check"), check.sample.alias("value"))))
    if entries:
        near = df if reach is None else df.where(any_of([within(F.col("_reach.most")), *leads]))
        # no filter on the predicates ahead of the explode: it would evaluate them twice
        def listed(e: Column) -> Column:
            if reach is None:
                return e.isNotNull()
            # leading keys are listed wherever they lie: they have no bound
            bound = F.coalesce(F.try_element_at("_reach.bounds", e["check"]), F.lit(UNBOUNDED))
            return e.isNotNull() & within(bound)

        failing = F.filter(F.array(*entries), listed)
        exploded = near.select(*carried, named(row_id).alias("_row"), F.explode(failing).alias("e"))
        parts.append(exploded.select(*by, "_row", "e.*"))
    for i, check in enumerate(checks):
        if not check.keys or not by:
            continue
        # The first five failing rows belong to the five repeated keys that
        # start first, so only those keys go back to the rows.
        counts = key_counts(df, check.keys, by, row_id, check.excuse_nulls)
        # the second half is always true: reading the first row, all uses share one aggregation
        repeated = counts.where((F.col("_n") > 1) & (F.col("_first").isNotNull() | (F.col("_n") > 0)))
        names = [*by, *[f"_k{j}" for j in range(len(check.keys))]]
        rows = df.select(
            *carried, *key_columns(df, check.keys), named(row_id).alias("_row"), check.sample.alias("value")
        )
        order = Window.partitionBy(*by).orderBy("_first")
        leading = repeated.withColumn("_rank", F.row_number().over(order))
        leading = leading.where(F.col("_rank") <= SAMPLES_PER_CHECK).select(*names, "_n")
        marks = repeated.where(is_hot(counts)).select(*names, F.lit(False).alias("_mark"))
        marks = marks.unionByName(leading.where(is_hot(counts)).select(*names, F.lit(True).alias("_mark")))
        hot = marks.groupBy(*names).agg(F.max("_mark").alias("_mark"))
        rows = mark_keys(rows, names, hot, leading.where(~is_hot(counts)), "_row", "_leads").where("_leads")
        parts.append(rows.withColumn("check", F.lit(i)).select(*shape))
    hits = parts[0]
    for part in parts[1:]:
        hits = hits.unionByName(part)
    order = Window.partitionBy(*by, "check").orderBy("_row")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLES_PER_CHECK)
    return ranked.withColumn("item", json_scalar(F.col("value")))


def _mark_leading(df: DataFrame, check: Check, row_id: str, mark: str) -> DataFrame:
    """Add ``mark``, set where the row's key is one of the five repeated ones that start first.

    The first five failing rows belong to these keys.
    """
    repeated = key_counts(df, check.keys, (), row_id, check.excuse_nulls).where(F.col("_n") > 1)
    names = [f"_k{j}" for j in range(len(check.keys))]
    leading = repeated.orderBy("_first").limit(SAMPLES_PER_CHECK)
    leading = leading.select(*[F.col(n).alias(f"{mark}{n}") for n in names], F.lit(True).alias(mark))
    on = [key.eqNullSafe(F.col(f"{mark}{n}")) for key, n in zip(key_values(df, check.keys), names)]
    return df.join(F.broadcast(leading), on, "left").drop(*[f"{mark}{n}" for n in names])


def packed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, list[Check]]:
    """Evaluate every row predicate once, into bits of ``_pack0, _pack1, ...``, and let the checks read their bit.

    Bit ``i % CHUNK`` of pack ``i // CHUNK`` is that of check ``i``.
    """
    packs = {}
    for k in range(0, max(1, len(checks)), CHUNK):
        bits = [F.when(c.failed, F.lit(1 << j)).otherwise(F.lit(0)) for j, c in enumerate(checks[k : k + CHUNK]) if c.failed is not None]
        packs[f"_pack{k // CHUNK}"] = balanced(bits, Column.bitwiseOR) if bits else F.lit(0)

    def read(i: int, check: Check) -> Check:
        if check.failed is None:
            return check
        return replace(check, failed=F.col(f"_pack{i // CHUNK}").bitwiseAND(1 << i % CHUNK) != 0)

    return df.withColumns(packs), [read(i, c) for i, c in enumerate(checks)]


def _groups(checks: Sequence[Check], plain: Sequence[int]) -> dict[str, list[int]]:
    """The checks behind each figure of a run: those of a dimension, and those whose failing rows aren't kept."""
    groups = {any_name(d): [i for i, c in enumerate(checks) if c.dimension == d and c.failed is not None] for d in DIMENSIONS}
    return {**groups, INCOMPLETE: list(plain)}


def _group_bits(groups: Mapping[str, Sequence[int]], packs: Sequence[Column]) -> Column:
    """Bit ``g``: a check of group ``g`` fails."""
    bits = []
    for d, members in enumerate(groups.values()):
        masks = [0] * len(packs)
        for i in members:
            masks[i // CHUNK] |= 1 << i % CHUNK
        hits = [pack.bitwiseAND(mask) != 0 for pack, mask in zip(packs, masks) if mask]
        if hits:
            bits.append(F.when(any_of(hits), F.lit(1 << d)).otherwise(F.lit(0)))
    return balanced(bits, Column.bitwiseOR) if bits else F.lit(0)


def _patterns(
    df: DataFrame, checks: Sequence[Check], groups: Mapping[str, Sequence[int]], by: Sequence[str], row_id: str, firsts: bool
) -> DataFrame:
    """How many rows have each pattern of flags, chunk by chunk: ``_chunk, _pattern, _tally``.

    One aggregate with partial aggregation, whose groups are bounded by ``CHUNK``
    and not by the number of checks. The chunk ``BY_GROUP`` covers all rows, the others those that fail
    in them. With ``firsts`` groups are told apart by ``REACH_SLOTS`` row slots, and ``_tally`` also holds the first
    row; it is one array, so that whoever reads part of it shares the aggregation with whoever reads the rest.
    """
    packs = [F.col(f"_pack{k}") for k in range(math.ceil(max(1, len(checks)) / CHUNK))]
    row = named(row_id).cast("bigint")
    slot = [F.pmod(F.xxhash64(row), F.lit(REACH_SLOTS)).alias("_slot")] if firsts else []
    carried = [*[named(b) for b in by], *slot, *([row.alias("_row")] if firsts else [])]
    chunks = [F.struct(F.lit(BY_GROUP).alias("_chunk"), _group_bits(groups, packs).alias("_pattern"))]
    chunks += [F.struct(F.lit(k).alias("_chunk"), pack.alias("_pattern")) for k, pack in enumerate(packs)]
    if len(packs) == 1:  # the one pattern tells the dimensions too
        counted = df.select(*carried, F.lit(0).alias("_chunk"), packs[0].alias("_pattern"))
    else:
        worth = F.filter(F.array(*chunks), lambda c: (c["_chunk"] == BY_GROUP) | (c["_pattern"] != 0))
        counted = df.select(*carried, F.inline(worth))
    tally = [F.count(F.lit(1)), *([F.min("_row")] if firsts else [])]
    names = [*by, "_chunk", "_pattern", *(["_slot"] if firsts else [])]
    return counted.groupBy(*names).agg(F.array(*tally).alias("_tally"))


def _run_tally(patterns: DataFrame, checks: Sequence[Check], groups: Mapping[str, Sequence[int]], by: Sequence[str]) -> DataFrame:
    """The rows of each run, and those that fail in each group of checks."""
    single = len(checks) <= CHUNK
    bits = _group_bits(groups, [F.col("_pattern")]) if single else F.col("_pattern")
    # no filter on the chunk, which would move below the aggregation: it would be done once more for it
    n = F.when(F.col("_chunk") == (0 if single else BY_GROUP), F.get("_tally", F.lit(0)))
    failing = [F.sum(F.when(bits.bitwiseAND(1 << d) != 0, n)).alias(name) for d, name in enumerate(groups)]
    return patterns.groupBy(*by).agg(F.sum(n).alias("rows"), *failing)


def _by_check(patterns: DataFrame) -> DataFrame:
    """The patterns once for each check that fails in them, named ``_check``.

    The count is read with the bits, as a filter on the pattern alone would move below the aggregation: it would be
    done once more for it, on rows whose predicates a join's condition repeats.
    """
    counted = (F.col("_chunk") != BY_GROUP) & (F.get("_tally", F.lit(0)) > 0)
    at = F.filter(F.sequence(F.lit(0), F.lit(CHUNK - 1)), lambda j: counted & (F.getbit("_pattern", j) == 1))
    return patterns.withColumn("_bit", F.explode(at)).withColumn("_check", F.col("_chunk") * CHUNK + F.col("_bit"))


def _reach(patterns: DataFrame, checks: Sequence[Check]) -> Column:
    """How far the first five failing rows of each check can lie, and the farthest of these bounds.

    The first rows of five groups of patterns and slots are five failing rows, none beyond the fifth
    smallest. With fewer such groups there is no bound.
    """
    first = F.get("_tally", F.lit(1))
    listed = _by_check(patterns).where(first.isNotNull() & F.col("_check").isin(*_sampled(checks)))
    firsts = listed.groupBy("_check").agg(F.array_sort(F.collect_list(first)).alias("_firsts"))
    bound = F.coalesce(F.get("_firsts", F.lit(SAMPLES_PER_CHECK - 1)), F.lit(UNBOUNDED))
    bounds = firsts.select("_check", bound.alias("_bound"))
    listing = F.map_from_entries(F.collect_list(F.struct("_check", "_bound")))
    return bounds.agg(F.struct(listing.alias("bounds"), F.max("_bound").alias("most"))).scalar()


def measure(
    df: DataFrame, checks: Sequence[Check], row_id: str, by: Sequence[str] = (), samples: bool = True
) -> DataFrame:
    """Facts per run, where ``by`` names the columns that tell runs apart.

    Every row predicate is evaluated once, into packs of flags; the rows are counted by
    pattern of flags in one scan, with partial aggregation, and all further figures come from these
    counts. Plans therefore grow in proportion to the number of checks. Each lone uniqueness check adds one
    aggregation by key that reads the key column only. Samples are bounded during the count if the row id is the table's
    own: a generated one can differ between two readings of the input.
    """
    plain = [i for i, c in enumerate(checks) if c.dimension == "Completeness" and c.failed is not None]
    df, checks = attach_flags(df, checks, row_id, by, shared_only=True)
    df, checks = packed(df, checks)
    groups = _groups(checks, plain)
    own_id = row_id != GENERATED_ROW_ID and isinstance(type_of(df, row_id), T.IntegralType)
    bounded = bool(samples and not by and _sampled(checks) and own_id)
    patterns = _patterns(df, checks, groups, by, row_id, bounded)
    counts = _by_check(patterns).groupBy(*by, "_check").agg(F.sum(F.get("_tally", F.lit(0))).alias("_n"))
    parts = [_run_tally(patterns, checks, groups, by), counts.select(*by, F.struct("_check", "_n").alias("count"))]
    reach = _reach(patterns, checks) if bounded else None

    for i, check in enumerate(checks):
        if not check.keys:
            continue
        repeated = F.col("_n") > 1
        if samples:
            # always true; reading the first row too makes this aggregation the
            # same as the one behind the samples, so Spark runs it once
            repeated = repeated & (F.col("_first").isNotNull() | (F.col("_n") > 0))
        failed = F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0))
        counted = key_counts(df, check.keys, by, row_id, check.excuse_nulls).groupBy(*by).agg(failed.alias("_n"))
        parts.append(counted.select(*by, F.struct(F.lit(i).alias("_check"), "_n").alias("count"), F.col("_n").alias(any_name(check.dimension))))
    if samples and any(c.sample is not None for c in checks):
        found = first_failures(df, checks, row_id, by, reach)
        parts.append(found.select(*by, F.struct("check", "rank", "item").alias("sample")))

    facts = parts[0]
    for part in parts[1:]:
        facts = facts.unionByName(part, allowMissingColumns=True)
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ["rows", *groups]]
    # a count for each check and at most five samples
    totals.append(F.map_from_entries(F.collect_list("count")).alias("failed"))
    if "sample" in facts.columns:
        totals.append(F.collect_list("sample").alias("samples"))
    return facts.groupBy(*by).agg(*totals)


def dimension_score(checks: Sequence[Check], dimension: str) -> Column:
    """Share of rows passing every check of the dimension, in percent; 0 without rows."""
    if any(c.zero_score for c in checks if c.dimension == dimension):
        return F.lit(0.0)
    share = F.col(any_name(dimension)) / F.col("rows")
    return F.when(F.col("rows") > 0, round_score((1 - share) * 100)).otherwise(F.lit(0.0))


def overall_score(scores: Mapping[str, Column], weights: Mapping[str, float] | None = None) -> Column:
    """Mean of the rounded dimension scores, weighted if weights are given."""
    if not weights:
        total = sum((scores[d] for d in DIMENSIONS[1:]), scores[DIMENSIONS[0]])
        return round_score(total / 4.0)
    used = [d for d in DIMENSIONS if weights.get(d)]
    total = sum((scores[d] * weights[d] for d in used[1:]), scores[used[0]] * weights[used[0]])
    return round_score(total / math.fsum(weights[d] for d in used))


def with_scores(
    facts: DataFrame, checks: Sequence[Check], weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Add the four dimension scores and the overall score to facts."""
    scored = facts.withColumns({SCORE_COLUMNS[d]: dimension_score(checks, d) for d in DIMENSIONS})
    overall = overall_score({d: F.col(SCORE_COLUMNS[d]) for d in DIMENSIONS}, weights)
    return scored.withColumn(SCORE_COLUMNS["Overall"], overall)


def failed_pct(failed: Column, rows: Column) -> Column:
    return F.when(rows > 0, round_share(failed / rows * 100)).otherwise(F.lit(0.0))


def check_rows(facts: DataFrame, checks: Sequence[Check], keep: Sequence[str] = ()) -> DataFrame:
    """One row per run and check, with its failed count, share and samples if measured."""
    sampled = "samples" in facts.columns

    def told(value, kind: str) -> Column:
        return F.lit([value(c) for c in checks]).cast(f"array<{kind}>")

    def samples(i: Column, failed: Column) -> Column:
        blanks = F.array_repeat(F.lit('""'), F.least(failed, F.lit(BLANKS_WITHOUT_COLUMN)).cast("int"))
        mine = F.array_sort(F.filter("samples", lambda s: s["check"] == i))
        listed = F.transform(mine, lambda s: s["item"])
        items = F.when(F.get(told(lambda c: c.sample is None, "boolean"), i), blanks).otherwise(listed)
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))

    def row(i: Column) -> Column:
        failed = F.coalesce(F.try_element_at("failed", i), F.lit(0).cast("bigint"))
        fields = [
            i.alias("check_no"),
            F.get(told(lambda c: c.dimension, "string"), i).alias("dimension"),
            F.get(told(lambda c: c.rule, "string"), i).alias("rule"),
            F.get(told(lambda c: c.column, "string"), i).alias("column"),
            F.get(told(lambda c: c.severity or "", "string"), i).alias("severity"),
            failed.alias("failed_count"),
        ]
        return F.struct(*fields, *([samples(i, failed).alias("sample_values")] if sampled else []))

    numbers = F.lit(list(range(len(checks)))).cast("array<int>")
    rows = facts.select(*keep, "rows", F.inline(F.transform(numbers, row)))
    rows = rows.withColumn("severity", F.nullif("severity", F.lit("")))
    return rows.withColumn("failed_pct", failed_pct(F.col("failed_count"), F.col("rows"))).drop("rows")


def issue_rows(facts: DataFrame, checks: Sequence[Check], keep: Sequence[str] = ()) -> DataFrame:
    """The checks that failed somewhere."""
    return check_rows(facts, checks, keep).where(F.col("failed_count") > 0)
