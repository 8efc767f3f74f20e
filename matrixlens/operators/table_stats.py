"""Describe and value counts for tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.functions.columns import as_text, clean_double, column, is_numeric, user_columns
from matrixlens.functions.globs import select_names
from matrixlens.operators.order_statistics import SORTED_ROWS, describe_groups, describe_small_groups
from matrixlens.operators.sketches import describe_sketched

#: Result columns of a table description, in order, whatever the column types described.
DESCRIBE_SCHEMA = (
    "column string, count bigint, mean double, std double, min double, p25 double, p50 double, "
    "p75 double, max double, nan_count bigint, unique bigint, top string, freq bigint, is_numeric boolean"
)
_DESCRIBE_COLUMNS = [part.split()[0] for part in DESCRIBE_SCHEMA.split(", ")]
_DESCRIBE_TYPES = dict(part.split() for part in DESCRIBE_SCHEMA.split(", "))


def requested_columns(df: DataFrame, columns: Sequence[str] | None) -> list[str]:
    """Columns of a describe request: names or globs, each of which must exist."""
    available = user_columns(df.schema)
    if not columns:
        return available
    chosen: dict[str, None] = {}
    missing = []
    for wanted in columns:
        names = [wanted] if wanted in available else select_names(available, [wanted])[0]
        if not names:
            missing.append(wanted)
        chosen.update(dict.fromkeys(names))
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return list(chosen)


def _request_order(names: Sequence[str]) -> Column:
    return F.array_position(F.lit(list(names)), F.col("column"))


def as_description(df: DataFrame) -> DataFrame:
    """Bring a partial description to the fixed schema; frequencies default to zero."""
    def field(name: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        value = value.cast(_DESCRIBE_TYPES[name])
        return F.coalesce(value, F.lit(0)).cast("bigint").alias(name) if name == "freq" else value.alias(name)

    return df.select(*[field(name) for name in _DESCRIBE_COLUMNS])


def _melted(df: DataFrame, names: Sequence[str], values: Sequence[Column]) -> DataFrame:
    """One row ``(column, value)`` per cell of the given columns."""
    # Expressions first, so that unpivot only repeats references.
    named = df.select(*[v.alias(name) for name, v in zip(names, values)])
    return named.unpivot([], [column(name) for name in names], "column", "value")


def describe_numeric(df: DataFrame, names: Sequence[str], n_rows: int, error: float | None = None) -> DataFrame:
    """Count, mean, deviation, extremes, quartiles and missing count per numeric column."""
    cells = _melted(df, names, [clean_double(column(c), df.schema[c].dataType) for c in names])
    # A table may be empty; its columns are described all the same.
    groups = df.sparkSession.range(1).select(F.explode(F.lit(list(names))).alias("column"))
    if error is not None:
        stats = describe_sketched(cells, ["column"], error, groups)
    else:
        stats = (describe_small_groups if n_rows <= SORTED_ROWS else describe_groups)(cells, ["column"], groups)
    return as_description(stats.withColumn("is_numeric", F.lit(True)))


def category_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for every distinct value, missing included, in one shuffle."""
    cells = _melted(df, names, [as_text(column(c), df.schema[c].dataType) for c in names])
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def describe_categorical(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, distinct, most frequent value and its frequency, and missing count per column.

    Ties for the most frequent value go to the smallest one.
    """
    counts = category_counts(df, names)
    aggregates = []
    for i, name in enumerate(names):
        here = F.col("column") == F.lit(name)
        present = here & F.col("value").isNotNull()
        best = F.min(F.when(present, F.struct((-F.col("n")).alias("minus_n"), "value")))
        aggregates += [
            F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias(f"count_{i}"),
            F.coalesce(F.sum(F.when(here & F.col("value").isNull(), F.col("n"))), F.lit(0)).alias(f"nan_count_{i}"),
            F.count(F.when(present, F.lit(1))).alias(f"unique_{i}"),
            best.alias(f"best_{i}"),
        ]
    # No grouping key: partial rows merge without sorting the distinct values.
    rows = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"count_{i}").alias("count"),
            F.col(f"nan_count_{i}").alias("nan_count"),
            F.col(f"unique_{i}").alias("unique"),
            F.col(f"best_{i}.value").alias("top"),
            (-F.col(f"best_{i}.minus_n")).alias("freq"),
        )
        for i, name in enumerate(names)
    ]
    stats = counts.agg(*aggregates).select(F.inline(F.array(*rows)))
    return as_description(stats.withColumn("is_numeric", F.lit(False)))


def describe_table(
    df: DataFrame, columns: Sequence[str] | None = None, n_rows: int | None = None, error: float | None = None
) -> DataFrame:
    """One row of statistics per column, numeric and categorical ones in the same schema.

    ``n_rows`` may be given where it is known; it only decides how quartiles are computed.
    With ``error`` quartiles may be off by that share of ranks, and the numeric columns are read once.
    """
    names = requested_columns(df, columns)
    numeric = [c for c in names if is_numeric(df.schema[c].dataType)]
    categorical = [c for c in names if c not in numeric]
    parts = []
    if numeric:
        parts.append(describe_numeric(df, numeric, df.count() if n_rows is None and error is None else n_rows or 0, error))
    if categorical:
        parts.append(describe_categorical(df, categorical))
    if not parts:
        return df.sparkSession.createDataFrame([], DESCRIBE_SCHEMA)
    result = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # One row per column.  A global sort would first run the plan once more to sample it.
    return result.repartition(1).sortWithinPartitions(_request_order(names))


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, count)`` of the categorical columns, missing values included.

    Columns in request order, then the most frequent value first, ties by value.
    """
    names = [c for c in requested_columns(df, columns) if not is_numeric(df.schema[c].dataType)]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint")
    counts = category_counts(df, names).withColumnRenamed("n", "count")
    return counts.orderBy(_request_order(names), F.desc("count"), F.col("value").asc_nulls_last())
