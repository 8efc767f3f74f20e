"""Describe for matrices: all cells, per row, per column, dense or sparse.

Cells arrive as ``(row_pos, col_pos, value double)`` with null for missing.  In a sparse
matrix the cells that are not stored are zeros; they are counted, never generated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.operators.order_statistics import (
    QUARTILES,
    SORTED_ROWS,
    STATISTICS,
    describe_groups,
    describe_small_groups,
    interpolate,
    rank_pair,
)
from matrixlens.operators.sketches import describe_sketched


def describe_cells(
    cells: DataFrame,
    keys: Sequence[str],
    n_cells: int,
    groups: DataFrame | None = None,
    repeating: bool = False,
    error: float | None = None,
) -> DataFrame:
    """Statistics of the cells per ``keys``; ``n_cells`` is the most a group can hold.

    ``groups`` marks a sparse matrix: it lists every group, stored cells or not, and each
    has exactly ``n_cells`` cells.  ``repeating`` says that values recur, as counts do, so
    that counting them before they are moved pays off.  With ``error`` the quartiles may be off by
    that share of ranks, and come from sketches.
    """
    keyed = cells if keys else cells.withColumn("_all", F.lit(0))
    by = list(keys) or ["_all"]
    complete = n_cells if groups is not None else None
    if error is not None:
        stats = describe_sketched(keyed, by, error, groups, complete)
    elif n_cells <= SORTED_ROWS:
        stats = describe_small_groups(keyed, by, groups, complete, together=bool(keys) and not repeating)
    else:
        stats = describe_groups(keyed, by, groups, complete)
    return stats if keys else stats.drop("_all")


def describe_rows_of_arrays(rows: DataFrame) -> DataFrame:
    """Per-row statistics of ``(row_pos, values)``: no shuffle, each row has its own cells."""
    value = F.filter(F.col("values").cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v))
    rows = rows.select("row_pos", F.size("values").cast("bigint").alias("cells"), F.array_sort(value).alias("sorted"))
    n = F.size("sorted").cast("bigint")
    total = F.aggregate("sorted", F.lit(0.0), lambda acc, v: acc + v)
    rows = rows.select("row_pos", "cells", "sorted", n.alias("count"), F.when(n > 0, total / n).alias("mean"))
    square = F.aggregate("sorted", F.lit(0.0), lambda acc, v: acc + F.pow(v - F.col("mean"), F.lit(2)))

    def quartile(q: float) -> Column:
        low, high, weight = rank_pair(q, F.col("count"))
        return interpolate(F.get("sorted", low.cast("int")), F.get("sorted", high.cast("int")), weight)

    values = {
        "count": F.col("count"),
        "nan_count": F.col("cells") - F.col("count"),
        "mean": F.col("mean"),
        "std": F.when(F.col("count") > 0, F.sqrt(square / F.col("count"))),
        "min": F.array_min("sorted"),
        "max": F.array_max("sorted"),
        **{f"p{int(q * 100)}": quartile(q) for q in QUARTILES},
    }
    return rows.select("row_pos", *[values[s].alias(s) for s in STATISTICS])
