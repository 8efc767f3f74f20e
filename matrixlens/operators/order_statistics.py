"""Exact statistics and quartiles of groups of any size.

Quartiles need the values of a group in order.  Two ways lead there, chosen by a bound on
the group size that is known before:

*Small groups* are sorted.  Values are counted per distinct value first, then running
counts within the group tell which value holds each rank.  Every step spills to disk.

*Large groups* are never gathered:

1. One scan counts values per group and *octave bin* (sign and binary logarithm, a few
   hundred bins for usual data).  Partial aggregation shrinks the data to bins before the
   shuffle, so a group holding most of the rows costs no more than any other.  The bins
   carry enough to merge exact counts, means, deviations and extremes.
2. Running counts over the bins of a group tell which bin holds each wanted rank, and at
   which offset.
3. A bin still too large for one task is split into equal slices of its actual range and
   counted again; each such scan divides it by up to ``REFINE_BINS``, so a handful of
   scans suffice for any double.
4. The few rows of the final bins are sorted and the wanted ranks read off.

Nothing is sampled: every rank is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from matrixlens import session
from matrixlens.session import repeatable, stable

#: First-level resolution: bins per doubling of the magnitude.  Few enough that rows combine
#: before the shuffle even where a task sees only some hundred values of each of many groups;
#: finer bins would seldom save a refinement.
BINS_PER_OCTAVE = 8
#: Slices per refinement of a bin.
REFINE_BINS = 4096
#: A group or bin with at most this many rows is sorted by a single task.
SORTED_ROWS = 1 << 20

QUARTILES = (0.25, 0.5, 0.75)
STATISTICS = ("count", "nan_count", "mean", "std", "min", "p25", "p50", "p75", "max")

_BEYOND_LN = 710.0  # above the logarithm of the largest double, for infinities
_BINS_PER_UNIT = BINS_PER_OCTAVE / math.log(2)
_BIN_SHIFT = 1075 * BINS_PER_OCTAVE + 1  # makes the step of the smallest double positive


def _octave_bin(value: Column) -> Column:
    """Integer that never decreases as the value grows; null for null."""
    # The natural logarithm: log2 computes two of them per value.
    magnitude = F.least(F.ln(F.abs(value)), F.lit(_BEYOND_LN))
    step = (F.floor(magnitude * _BINS_PER_UNIT) + _BIN_SHIFT).cast("int")
    return F.when(value == 0, F.lit(0)).when(value > 0, step).when(value < 0, -step)


def _running(keys: Sequence[str], order: str) -> Column:
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum("n").over(window)


def _ranks_within(ranks: Column, base: Column, n: Column) -> Column:
    return F.filter(ranks, lambda r: (r >= base) & (r < base + n))


def _read_off_edges(targets: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Ranks answered by a bin's smallest and largest value, and those still open."""
    last = F.col("base") + F.col("n") - 1
    known = targets.select(*keys, "base", "lo", "hi", last.alias("last"), F.explode("ranks").alias("rank"))
    known = known.filter((F.col("lo") == F.col("hi")) | (F.col("rank") == F.col("base")) | (F.col("rank") == F.col("last")))
    known = known.select(*keys, "rank", F.when(F.col("rank") == F.col("base"), F.col("lo")).otherwise(F.col("hi")).alias("value"))
    inner = F.filter("ranks", lambda r: (r != F.col("base")) & (r != last))
    still_open = targets.filter("lo < hi").withColumn("ranks", inner).filter(F.size("ranks") > 0)
    return known, still_open


def _members(values: DataFrame, keys: Sequence[str], targets: DataFrame, n_targets: int, n_values: int) -> DataFrame:
    """Rows that fall into an open bin, with the bin's id and bounds; ``n_values`` of them in all.

    Too many bins to broadcast are told apart by the rows they hold.  Fewer than ``BROADCAST_ROWS``
    can hold more than that part of all rows: these are broadcast, and their rows stay where they
    are.  Only rows of the others are dealt by key, of which no key has many.
    """
    side = targets.select(*keys, "_bin", "_target", "lo", "hi", "n")
    rows = values.filter(F.col("value").isNotNull()).select(*keys, "value", _octave_bin(F.col("value")).alias("_bin"))
    on = [*keys, "_bin"]
    if n_targets <= session.BROADCAST_ROWS:
        met = rows.join(F.broadcast(side), on)
    else:
        full = side.filter(F.col("n") > n_values // max(1, session.BROADCAST_ROWS))
        rest = rows.join(F.broadcast(full.select(*on)), on, "left_anti")
        met = rows.join(F.broadcast(full), on).unionByName(rest.join(side, on))
    return met.filter(F.col("value").between(F.col("lo"), F.col("hi"))).select("_target", "lo", "hi", "value")


def _values_at_ranks(values: DataFrame, keys: Sequence[str], located: DataFrame) -> DataFrame:
    """Exact ``(keys, rank, value)`` for bins that contain wanted ranks."""
    known, still_open = _read_off_edges(located, keys)
    answers = [known]
    while True:
        targets = stable(still_open.withColumn("_target", F.monotonically_increasing_id()))
        largest, n_targets, n_values = targets.agg(F.max("n"), F.count(F.lit(1)), F.sum("n")).first()
        if not n_targets:
            break
        rows = _members(values, keys, targets, n_targets, n_values)
        identity = targets.select("_target", *keys, "_bin", F.col("base").alias("start"), "ranks")
        if largest <= SORTED_ROWS:
            counted = rows.groupBy("_target", "value").agg(F.count(F.lit(1)).alias("n"))
            counted = counted.withColumn("before", _running(["_target"], "value") - F.col("n")).join(identity, "_target")
            hit = _ranks_within(F.col("ranks"), F.col("start") + F.col("before"), F.col("n"))
            answers.append(counted.select(*keys, F.explode(hit).alias("rank"), "value"))
            break
        piece = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * REFINE_BINS).cast("int")
        pieces = rows.groupBy("_target", piece.alias("_piece")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        )
        pieces = pieces.withColumn("before", _running(["_target"], "_piece") - F.col("n")).join(identity, "_target")
        pieces = pieces.withColumn("base", F.col("start") + F.col("before"))
        pieces = pieces.withColumn("ranks", _ranks_within(F.col("ranks"), F.col("base"), F.col("n")))
        narrowed = stable(pieces.filter(F.size("ranks") > 0).select(*keys, "_bin", "n", "base", "lo", "hi", "ranks"))
        known, still_open = _read_off_edges(narrowed, keys)
        answers.append(known)
    result = answers[0]
    for more in answers[1:]:
        result = result.unionByName(more)
    return result


def _weighted(
    values: DataFrame, keys: Sequence[str], groups: DataFrame | None = None, stub: float | None = None
) -> DataFrame:
    """``(keys, value, n)``: one per row, and for every listed group a ``stub`` of weight zero.

    The latter makes groups without any row appear in the result.
    """
    rows = values.select(*keys, "value", F.lit(1).cast("bigint").alias("n"))
    if groups is None:
        return rows
    nothing = [F.lit(stub).cast("double").alias("value"), F.lit(0).cast("bigint").alias("n")]
    return rows.unionByName(groups.select(*keys, *nothing))


def _binned(weighted: DataFrame, keys: Sequence[str]) -> DataFrame:
    value = F.col("value")
    return weighted.groupBy(*keys, _octave_bin(value).alias("_bin")).agg(
        F.sum("n").alias("n"),
        F.avg(value).alias("mean"),
        F.var_pop(value).alias("var"),
        F.min(value).alias("lo"),
        F.max(value).alias("hi"),
    )


def _not_negative(zeros: Column) -> Column:
    error = F.raise_error(F.lit("more cells are stored than there are: a cell is stored more than once"))
    return F.when(zeros < 0, error.cast("bigint")).otherwise(zeros)


def rank_pair(quantile: float, count: Column) -> tuple[Column, Column, Column]:
    """Neighbouring ranks and the weight of the upper one, linear interpolation."""
    position = F.lit(quantile) * (count - 1)
    low = F.floor(position).cast("bigint")
    return low, F.ceil(position).cast("bigint"), position - low


def interpolate(low: Column, high: Column, weight: Column) -> Column:
    return F.when(low == high, low).otherwise(low + (high - low) * weight)


def describe_small_groups(
    values: DataFrame,
    keys: Sequence[str],
    groups: DataFrame | None = None,
    cells: int | None = None,
    together: bool = False,
) -> DataFrame:
    """As ``describe_groups``, for groups that one task can sort.

    With ``together`` the rows of a group are moved once, as they are.  Otherwise equal
    values are counted before they move, which pays off where values recur.
    """
    value = F.col("value")
    rows = _weighted(values, keys, groups)
    if together:
        rows = rows.repartition(*keys)
    counted = rows.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    # One order for all windows: the values of a group are sorted once.
    ordered = Window.partitionBy(*keys).orderBy("value")
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = ordered.rowsBetween(Window.unboundedPreceding, 0)
    present = F.when(value.isNotNull(), F.col("n")).otherwise(F.lit(0))
    zeros = F.lit(0).cast("bigint") if cells is None else _not_negative(F.lit(cells) - F.sum("n").over(group))
    counted = counted.select(
        *keys,
        "value",
        "n",
        zeros.alias("zeros"),
        present.alias("present"),
        (F.sum(present).over(group) + zeros).alias("count"),
        F.sum(F.col("n") * value).over(group).alias("total"),
        (F.sum(present).over(ordered) - present).alias("before"),
    )
    # The cells not stored are zeros: they come after the negative values and before the others.
    counted = counted.select(
        *keys,
        "value",
        "n",
        "zeros",
        "present",
        "count",
        F.when(F.col("count") > 0, F.coalesce("total", F.lit(0.0)) / F.col("count")).alias("mean"),
        (F.col("before") + F.when(value > 0, F.col("zeros")).otherwise(F.lit(0))).alias("start"),
        (F.col("present") + F.when(value == 0, F.col("zeros")).otherwise(F.lit(0))).alias("width"),
    )
    pairs = {f"p{int(q * 100)}": rank_pair(q, F.col("count")) for q in QUARTILES}

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("start") + F.col("width")), value))

    picks = {f"{p}_{side}": at(rank) for p, (low, high, _) in pairs.items() for side, rank in (("low", low), ("high", high))}
    stats = counted.groupBy(*keys).agg(
        F.max("count").alias("count"),
        F.sum(F.col("n") - F.col("present")).alias("nan_count"),
        F.max("mean").alias("mean"),
        F.sum(F.col("present") * F.pow(value - F.col("mean"), 2)).alias("spread"),
        F.max("zeros").alias("zeros"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        *[pick.alias(name) for name, pick in picks.items()],
    )
    zero = F.when(F.col("zeros") > 0, F.lit(0.0))
    spread = F.coalesce("spread", F.lit(0.0)) + F.col("zeros") * F.pow("mean", F.lit(2))
    result = {
        "std": F.when(F.col("count") > 0, F.sqrt(spread / F.col("count"))),
        "min": F.least("lo", zero),
        "max": F.greatest("hi", zero),
        **{p: interpolate(F.coalesce(f"{p}_low", zero), F.coalesce(f"{p}_high", zero), pairs[p][2]) for p in pairs},
    }
    return stats.select(*keys, *[result[s].alias(s) if s in result else F.col(s) for s in STATISTICS])


def describe_groups(
    values: DataFrame, keys: Sequence[str], groups: DataFrame | None = None, cells: int | None = None
) -> DataFrame:
    """Statistics per group of ``(keys, value double)``; null values are missing.

    ``groups`` lists keys that must appear even without rows.  ``cells`` marks sparse data:
    every group has that many cells, and those not among the rows are zeros.
    """
    # The rows are read more than once, and ranks hold for one reading only.
    values = values if repeatable(values) else stable(values)
    # In sparse data every group gets a bin for its zeros, to be filled below.
    bins = _binned(_weighted(values, keys, groups, None if cells is None else 0.0), keys)
    ordered = Window.partitionBy(*keys).orderBy("_bin")
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if cells is not None:
        zeros = F.lit(cells) - F.sum("n").over(group)
        bins = bins.withColumn("n", F.col("n") + F.when(F.col("_bin") == 0, _not_negative(zeros)).otherwise(F.lit(0)))
        bins = bins.filter("n > 0")
    present = F.when(F.col("_bin").isNotNull(), F.col("n")).otherwise(F.lit(0))
    count = F.sum(present).over(group)
    bins = bins.withColumn("count", count).withColumn("center", F.sum(present * F.col("mean")).over(group) / F.when(count > 0, count))
    bins = bins.withColumn("base", F.sum(present).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    bins = stable(bins)

    spread = F.col("n") * (F.col("var") + F.pow(F.col("mean") - F.col("center"), 2))
    summary = bins.groupBy(*keys).agg(
        F.max("count").alias("count"),
        F.coalesce(F.sum(F.when(F.col("_bin").isNull(), F.col("n"))), F.lit(0)).alias("nan_count"),
        F.max("center").alias("mean"),
        F.sqrt(F.sum(spread) / F.max("count")).alias("std"),
        F.min("lo").alias("min"),
        F.max("hi").alias("max"),
    )
    pairs = {q: rank_pair(q, F.col("count")) for q in QUARTILES}
    ranks = F.array_distinct(F.array(*[rank for low, high, _ in pairs.values() for rank in (low, high)]))
    located = bins.filter(F.col("_bin").isNotNull())
    located = located.withColumn("ranks", _ranks_within(ranks, F.col("base"), F.col("n"))).filter(F.size("ranks") > 0)
    answers = _values_at_ranks(values, keys, located.select(*keys, "_bin", "n", "base", "lo", "hi", "ranks"))
    # At most six ranks per group, so the map stays tiny.
    lookup = answers.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def answer(rank: Column) -> Column:
        lost = F.raise_error(F.lit("a rank was not found again: the input changed between two readings")).cast("double")
        return F.when(F.col("count") > 0, F.coalesce(F.try_element_at("at", rank), lost))

    quartile = {f"p{int(q * 100)}": interpolate(answer(low), answer(high), weight) for q, (low, high, weight) in pairs.items()}
    joined = summary.join(lookup, list(keys), "left")
    return joined.select(*keys, *[quartile[s].alias(s) if s in quartile else F.col(s) for s in STATISTICS])


def values_at_ranks(values: DataFrame, ranks: Sequence[int]) -> list[float]:
    """The values at zero-based ``ranks`` of one column ``value``, ascending."""
    keyed = values.select(F.lit(0).alias("_all"), F.col("value").cast("double").alias("value"))
    keyed = keyed if repeatable(keyed) else stable(keyed)
    bins = _binned(_weighted(keyed, ["_all"]), ["_all"]).filter(F.col("_bin").isNotNull())
    bins = stable(bins.withColumn("base", _running(["_all"], "_bin") - F.col("n")))
    wanted = F.array(*[F.lit(int(r)).cast("bigint") for r in sorted(set(ranks))])
    located = bins.withColumn("ranks", _ranks_within(wanted, F.col("base"), F.col("n"))).filter(F.size("ranks") > 0)
    rows = _values_at_ranks(keyed, ["_all"], located.select("_all", "_bin", "n", "base", "lo", "hi", "ranks")).collect()
    found = {row["rank"]: row["value"] for row in rows}
    return [found[r] for r in ranks]
