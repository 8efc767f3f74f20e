"""CSV text of tables and of blocks of arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from matrixlens.functions.columns import INDEX, POSITION, column, user_columns

#: Quotes inside quoted text are doubled, as spreadsheet programs and data tools expect.
_OPTIONS = {"quote": '"', "escape": '"'}


def table_lines(df: DataFrame, columns: Sequence[str] | None = None, index: bool = True) -> DataFrame:
    """``(_pos, line)``: each row of a table as CSV, its name first if ``index``."""
    names = list(columns) if columns is not None else user_columns(df.schema)
    shown = ([INDEX] if index and INDEX in df.columns else []) + names
    kept = [POSITION] if POSITION in df.columns else []
    return df.select(*kept, F.to_csv(F.struct(*[column(c) for c in shown]), _OPTIONS).alias("line"))


def array_lines(df: DataFrame) -> DataFrame:
    """``(row_pos, line)``: each row of a matrix block as CSV, without header or index."""
    return df.select("row_pos", F.array_join(F.col("values").cast("array<string>"), ",", "").alias("line"))


def write_table(df: DataFrame, path: str, index: bool = True) -> None:
    """Write a table as CSV files with a header, the row name first if ``index``."""
    shown = ([INDEX] if index and INDEX in df.columns else []) + user_columns(df.schema)
    df.select(*[column(c) for c in shown]).write.options(header=True, **_OPTIONS).csv(path)


def write_block(df: DataFrame, path: str) -> None:
    """Write a block of arrays as CSV files without header or index."""
    array_lines(df).select("line").write.text(path)
