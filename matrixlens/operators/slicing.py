"""Slices by position, with the meaning slices have in Python.

Positions are unique.  At every size a slice is an error if rows that it returns, or whose rank it
would cut apart, share a position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from matrixlens.functions.columns import POSITION
from matrixlens.operators.positions import assign_positions
from matrixlens.session import repeatable, stable

Bounds = tuple[int | None, ...]

#: Up to this end position a slice of unnumbered rows is a plain top-k.
TOP_ROWS = 10_000
#: Stretches of positions that rows are counted by, as powers of two: one count for each million
#: positions, and then for each thousand, and for each position, of the stretches that hold a wanted rank.
STRETCHES = (20, 10, 0)


def needs_length(rows: Bounds) -> bool:
    """Open or negative ends are relative to the number of rows."""
    start, stop, step = (*rows, None)[:3]
    known = start is not None and start >= 0 and stop is not None and stop >= 0
    return not known or (step or 1) < 0


def resolve(rows: Bounds, length: int) -> range:
    """The positions a slice selects out of ``length``."""
    return range(length)[slice(*rows)]


def selects(pos: Column, picked: range) -> Column:
    """Condition: is the position one of ``picked``?"""
    if not picked:
        return F.lit(False)
    low, high = min(picked[0], picked[-1]), max(picked[0], picked[-1])
    inside = (pos >= low) & (pos <= high)
    step = abs(picked.step)
    return inside if step == 1 else inside & ((pos - low) % step == 0)


def as_array(picked: range | list[int]) -> Column:
    """The positions as an array column."""
    if isinstance(picked, range) and picked:
        first, last, step = (F.lit(n).cast("bigint") for n in (picked[0], picked[-1], picked.step))
        return F.sequence(first, last, step)
    return F.lit(list(picked)).cast("array<bigint>")


def _by_position(df: DataFrame, picked: range) -> DataFrame:
    return df.filter(selects(F.col(POSITION), picked))


def _once(ordered: DataFrame, name: str) -> DataFrame:
    """Rows in order of position, each position once; the order serves the window too."""
    error = F.raise_error(F.lit("positions repeat: rows cannot be sliced by position")).cast("boolean")
    counted = ordered.withColumn("_slice_times", F.count(F.lit(1)).over(Window.partitionBy(name)))
    return counted.filter(F.when(F.col("_slice_times") > 1, error).otherwise(F.lit(True))).drop("_slice_times")


def in_order(df: DataFrame, at_most: int, name: str = POSITION, descending: bool = False) -> DataFrame:
    """Sort by position: as a top-k where few rows are expected, else as a distributed sort.

    ``at_most`` rows are expected of unique positions.
    """
    # Windows sort upwards; so do their partitions.
    key = "_slice_back" if descending else name
    ordered = (df.withColumn(key, -F.col(name)) if descending else df).orderBy(key)
    # Were there more rows than positions, one more would show a position twice.
    ordered = _once(ordered.limit(at_most + 1) if at_most <= TOP_ROWS else ordered, key)
    return ordered.drop(key) if descending else ordered


def _counted(positions: DataFrame, shift: int, within: Sequence[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """``(first position, rows)`` of each stretch that has rows, in order, of those inside some ranges."""
    if within:
        inside = F.lit(False)
        for low, high in within:
            inside = inside | F.col(POSITION).between(low, high)
        positions = positions.filter(inside)
    stretch = F.shiftright(POSITION, shift).alias("stretch")
    return sorted((row[0] << shift, row[1]) for row in positions.groupBy(stretch).agg(F.count(F.lit(1))).collect())


def _at_ranks(positions: DataFrame, ranks: Sequence[int], counted: list[tuple[int, int]]) -> list[int]:
    """The positions at zero-based ranks, from the counts by the widest stretches.

    The rows are counted as a whole once; then only the stretches that hold a rank are read, which
    Parquet tells by position.
    """
    ends: list[tuple[int, int]] = []
    for level, shift in enumerate(STRETCHES):
        if level:
            counted = _counted(positions, shift, [(start, start + (1 << STRETCHES[level - 1]) - 1) for start in {start for start, _ in ends}])
        found = []
        for place, rank in enumerate(ranks):
            first, rest = ends[place] if level else (0, rank)
            for start, n in counted:
                if level and start < first:
                    continue
                if n > 1 << shift:
                    raise ValueError("positions repeat: rows cannot be sliced by position")
                if rest < n:
                    found.append((start, rest))
                    break
                rest -= n
            else:
                raise ValueError("a rank was not found again: the rows changed between two readings")
        ends = found
    return [start for start, _ in ends]


def slice_rows(df: DataFrame, rows: Bounds, gaps: bool = False, length: int | None = None) -> DataFrame:
    """Rows ``start:stop[:step]`` of a table with positions, in that order.

    ``gaps`` says that the stored positions are not 0..n-1 any more, as after a filter; the
    slice then counts the rows that are left.
    """
    counted: list[tuple[int, int]] | None = None
    positions = df.select(POSITION)
    if length is None:
        if not needs_length(rows):
            length = max(rows[0], rows[1])
        elif gaps:
            positions = positions if repeatable(positions) else stable(positions)
            counted = _counted(positions, STRETCHES[0])
            length = sum(n for _, n in counted)
        else:
            length = df.count()
    picked = resolve(rows, length)
    if not gaps:
        return in_order(_by_position(df, picked), len(picked), descending=picked.step < 0)
    if not picked:
        return df.filter(F.lit(False))
    if picked.step == 1:
        if picked.stop <= TOP_ROWS:
            # With its neighbours, which must not share its ends' positions.
            before = min(picked.start, 1)
            around = df.orderBy(POSITION).offset(picked.start - before).limit(before + len(picked) + 1)
            return _once(around, POSITION).orderBy(POSITION).offset(before).limit(len(picked))
        # Further in: find the positions at both ends and filter by them.
        if counted is None:
            positions = positions if repeatable(positions) else stable(positions)
            counted = _counted(positions, STRETCHES[0])
        last = min(picked.stop, sum(n for _, n in counted)) - 1
        if last < picked.start:
            return df.filter(F.lit(False))
        low, high = _at_ranks(positions, [picked.start, last], counted)
        return in_order(df.filter(F.col(POSITION).between(low, high)), last - picked.start + 1)
    # Rank the positions alone, then fetch the rows they name.
    ranked = assign_positions(df.select(F.col(POSITION).alias("_stored")), "_stored")
    wanted = _by_position(ranked, picked).select(F.col("_stored").alias(POSITION))
    return in_order(df.join(wanted, POSITION, "left_semi"), len(picked), descending=picked.step < 0)
