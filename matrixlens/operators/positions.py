"""Numbering rows 0, 1, 2, ... in a given order without gathering them in one task."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from matrixlens.functions.columns import POSITION, column
from matrixlens.session import small_side, stable

_UNHASHABLE = re.compile(r"\b(map|variant)\b")
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def assign_positions(df: DataFrame, *order: str | Column, name: str = POSITION) -> DataFrame:
    """Add the rank of every row under ``order``, counted from zero.

    Rows that tie are put in an arbitrary but repeatable order, by a hash of the row.  It
    also lets the range partitioning split a key that holds many rows.  The sorted rows are
    written once; the partition sizes, one number per partition, then give each partition
    its starting rank.
    """
    hashable = [column(f.name) for f in df.schema.fields if not _UNHASHABLE.search(f.dataType.simpleString())]
    order = (*order, F.xxhash64(*hashable))
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stable(ordered.withColumn("_slot", F.monotonically_increasing_id()))
    part = F.shiftright("_slot", _ROW_BITS)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition: a running sum over them is small by construction.
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    placed = numbered.withColumn("_part", part).join(small_side(starts, sizes.count()), "_part")
    rank = F.col("_start") + F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.withColumn(name, rank).drop("_part", "_start", "_slot")
