"""Where names lie on an axis: a side table of a stored dataset, sorted by the hashes of the names.

A look-up reads the pages of the few hashes asked for, and then the rows at the positions found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from matrixlens.functions.columns import INDEX, POSITION, column
from matrixlens.session import small_side

#: Up to so many names are a condition on the hash, which Parquet compares with its pages; more are joined.
INLINE_NAMES = 10


def names_of(axis: DataFrame) -> DataFrame | None:
    """``(_hash, _index, _pos)`` of an axis table, in the order they are stored; None where names are no text.

    The position is part of the order, so that a name most rows bear is no single task's.
    """
    if {INDEX, POSITION} - set(axis.columns) or not isinstance(axis.schema[INDEX].dataType, T.StringType):
        return None
    table = axis.where(F.col(INDEX).isNotNull()).select(F.xxhash64(INDEX).alias("_hash"), INDEX, POSITION)
    return table.repartitionByRange("_hash", POSITION).sortWithinPartitions("_hash", POSITION)


def rows_named(names: DataFrame, wanted: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the side table that bear one of the ``wanted`` names, each as often as it occurs.

    Names may also be given as the first column of a table of any size.
    """
    if isinstance(wanted, DataFrame):
        asked = wanted.select(column(wanted.columns[0]).cast("string").alias(INDEX))
        return names.join(asked.select(F.xxhash64(INDEX).alias("_hash"), INDEX), ["_hash", INDEX], "left_semi")
    wanted = sorted(set(wanted))
    if not wanted:
        return names.filter(F.lit(False))
    if len(wanted) <= INLINE_NAMES:
        hashes = names.sparkSession.range(1).select(*[F.xxhash64(F.lit(w)) for w in wanted]).first()
        return names.filter(F.col("_hash").isin(list(hashes)) & F.col(INDEX).isin(wanted))
    asked = names.sparkSession.createDataFrame([(w,) for w in wanted], T.StructType([T.StructField(INDEX, T.StringType())]))
    size = sum(1 + len(w) // 64 for w in wanted)
    return names.join(small_side(asked.select(F.xxhash64(INDEX).alias("_hash"), INDEX), size), ["_hash", INDEX], "left_semi")
