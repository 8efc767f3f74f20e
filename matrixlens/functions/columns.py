"""Column references and type families."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

#: Columns every axis table carries next to the user's own ones.
POSITION = "_pos"
INDEX = "_index"

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def column(name: str) -> Column:
    """Reference a column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def user_columns(schema: T.StructType) -> list[str]:
    """Names of the columns that belong to the user, in table order."""
    return [f.name for f in schema.fields if f.name not in (POSITION, INDEX)]


def is_numeric(dtype: T.DataType) -> bool:
    """Numeric for statistics.  Booleans are described as categories."""
    return isinstance(dtype, T.NumericType)


def is_missing(col: Column, dtype: T.DataType) -> Column:
    """NaN and null both count as missing."""
    return col.isNull() | F.isnan(col) if isinstance(dtype, FLOATING) else col.isNull()


def clean_double(col: Column, dtype: T.DataType) -> Column:
    """The value as a double, with every missing value as null."""
    value = col.cast("double")
    return F.when(~F.isnan(value), value) if isinstance(dtype, FLOATING) else value


def shape_text(rows: Column, cols: Column) -> Column:
    """``(rows, cols)``, or ``NA`` when there is no shape."""
    text = F.format_string("(%d, %d)", rows.cast("bigint"), cols.cast("bigint"))
    return F.when(rows.isNull() | cols.isNull(), F.lit("NA")).otherwise(text)


def utc_text(col: Column) -> Column:
    """A moment as text in UTC, whatever the session's time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), epoch).cast("string")


def as_text(col: Column, dtype: T.DataType) -> Column:
    """The value as text; times with a zone in UTC."""
    return utc_text(col) if isinstance(dtype, T.TimestampType) else col.cast("string")
