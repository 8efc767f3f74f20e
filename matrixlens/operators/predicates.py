"""The eight filter operators, with missing values behaving as data analysts expect.

SQL's three-valued logic drops rows with missing values from every comparison.  Here
``!=`` and ``notin`` keep them, the other six never match them, and NaN is missing too.
A literal of another type family than the column equals nothing.
"""

from __future__ import annotations

import math
from datetime import datetime
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal, localcontext
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

from matrixlens.functions.columns import FLOATING, INDEX, INTEGRAL, TEMPORAL, column
from matrixlens.session import small_side

OPERATORS = ("==", "!=", ">", ">=", "<", "<=", "isin", "notin")

#: Longer value lists become a semi or anti join instead of an expression.
INLINE_VALUES = 1_000

_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1


def _resolve(schema: T.StructType, name: str) -> tuple[Column, T.DataType]:
    """Column and type of a filter column; ``index`` always means the row names."""
    real = INDEX if name == "index" else name
    if real not in schema.names:
        raise ValueError(f"no column named '{name}'")
    col, dtype = column(real), schema[real].dataType
    return (col.cast("int"), T.IntegerType()) if isinstance(dtype, T.BooleanType) else (col, dtype)


def _is_nan(value: Any) -> bool:
    return value is None or (isinstance(value, float) and math.isnan(value))


def _normalised(dtype: T.DataType, value: Any) -> Any:
    """The value as one of the column's type, or None if it cannot equal any.

    The only rule for what a literal means: one value, a short list and a long one follow it.
    """
    if isinstance(dtype, T.NumericType):
        if not isinstance(value, (bool, int, float, Decimal)) or _is_nan(value):
            return None
        if isinstance(dtype, FLOATING):
            return float(value)
        if math.isinf(value):
            return None
        exact = _decimal(value)
        if isinstance(dtype, INTEGRAL):
            return int(exact) if exact == int(exact) and _LONG_MIN <= exact <= _LONG_MAX else None
        return _on_grid(exact, dtype, ROUND_FLOOR) if exact == _on_grid(exact, dtype, ROUND_FLOOR) else None
    if isinstance(dtype, TEMPORAL):
        if not isinstance(value, str):
            return None
        try:
            moment = datetime.fromisoformat(value)
        except ValueError:
            return None
        if isinstance(dtype, T.DateType):
            return moment.date().isoformat()
        return (moment.replace(tzinfo=None) if isinstance(dtype, T.TimestampNTZType) else moment).isoformat(" ")
    if isinstance(dtype, T.StringType):
        return value if isinstance(value, str) else None
    return None


def _decimal(value: Any) -> Decimal:
    """The number as it is written: 0.1 is one tenth."""
    return value if isinstance(value, Decimal) else Decimal(int(value)) if isinstance(value, (bool, int)) else Decimal(repr(value))


def _on_grid(value: Decimal, dtype: T.DecimalType, rounding: str) -> Decimal | None:
    """The neighbouring value a decimal column can hold, None beyond its range."""
    with localcontext() as context:
        context.prec = 400
        rounded = value.quantize(Decimal(1).scaleb(-dtype.scale), rounding=rounding)
    return rounded if abs(rounded) < Decimal(10) ** (dtype.precision - dtype.scale) else None


def _typed_literal(dtype: T.DataType, value: Any) -> Column | None:
    """The value as a literal of the column's own type, or None if it cannot equal any.

    Keeping the column uncast is what lets the comparison reach the Parquet reader.
    """
    value = _normalised(dtype, value)
    if value is None:
        return None
    return F.lit(value) if isinstance(dtype, (*INTEGRAL, T.StringType)) else F.lit(value).cast(dtype)


def _never(col: Column) -> Column:
    """False for every row, but still a condition on the column."""
    return col.isNull() & F.lit(False)


def _ordered(col: Column, dtype: T.DataType, op: str, value: Any) -> Column:
    compare = {
        ">": lambda a, b: a > b,
        ">=": lambda a, b: a >= b,
        "<": lambda a, b: a < b,
        "<=": lambda a, b: a <= b,
    }[op]
    if isinstance(dtype, TEMPORAL):
        literal = _typed_literal(dtype, value)
        if literal is None:
            raise ValueError(f"'{value}' is not a date or time")
        return compare(col, literal)
    number = float(value)
    if not isinstance(dtype, T.NumericType):
        raise TypeError(f"'{op}' needs a numeric column, not {dtype.simpleString()}")
    if math.isnan(number):
        return _never(col)
    if isinstance(dtype, FLOATING):
        return ~F.isnan(col) & compare(col, F.lit(number).cast(dtype))
    if isinstance(dtype, T.DecimalType):
        if math.isinf(number):
            return col.isNotNull() if (number < 0) == (op[0] == ">") else _never(col)
        edge = _on_grid(_decimal(value if isinstance(value, (int, float, Decimal)) else number), dtype, ROUND_FLOOR if op in (">", "<=") else ROUND_CEILING)
        if edge is None:
            return col.isNotNull() if (number < 0) == (op[0] == ">") else _never(col)
        return compare(col, F.lit(edge).cast(dtype))
    # Integers against any real bound: round the bound, not the column.
    if math.isinf(number) or abs(number) > _LONG_MAX:
        return col.isNotNull() if (number < 0) == (op[0] == ">") else _never(col)
    bound = math.floor(number) if op in (">", "<=") else math.ceil(number)
    if not _LONG_MIN <= bound <= _LONG_MAX:
        return col.isNotNull() if (number < 0) == (op[0] == ">") else _never(col)
    return compare(col, F.lit(bound))


def row_filter(schema: T.StructType, name: str, op: str, value: Any) -> Column:
    """Condition for ``DataFrame.filter``: null counts as "drop", so it can be pushed down."""
    col, dtype = _resolve(schema, name)
    if op not in OPERATORS:
        raise ValueError(f"'{op}' is not one of the operators {', '.join(OPERATORS)}")
    if op in ("==", "!="):
        if isinstance(value, (list, tuple, set)):
            raise ValueError(f"'{op}' compares with one value; use isin or notin for a list")
        literal = _typed_literal(dtype, value)
        if literal is None:
            return _never(col) if op == "==" else ~_never(col)
        return col == literal if op == "==" else ~col.eqNullSafe(literal)
    if op in ("isin", "notin"):
        values = list(value) if isinstance(value, (list, tuple, set)) else [value]
        literals = [lit for lit in (_typed_literal(dtype, v) for v in values) if lit is not None]
        found = col.isin(literals) if literals else _never(col)
        if any(_is_nan(v) for v in values):
            found = found | (col.isNull() | F.isnan(col) if isinstance(dtype, FLOATING) else col.isNull())
            return found if op == "isin" else ~F.coalesce(found, F.lit(False))
        return found if op == "isin" else col.isNull() | ~found
    return _ordered(col, dtype, op, value)


def mask(schema: T.StructType, name: str, op: str, value: Any) -> Column:
    """The same condition as a value: true or false on every row, never null."""
    return F.coalesce(row_filter(schema, name, op, value), F.lit(False))


def filter_rows(df: DataFrame, name: str, op: str, value: Any) -> DataFrame:
    """Rows of one table that satisfy a filter; nothing else is touched."""
    if op in ("isin", "notin") and isinstance(value, (list, tuple, set)) and len(value) > INLINE_VALUES:
        return _filter_by_join(df, name, op, value)
    return df.filter(row_filter(df.schema, name, op, value))


def _filter_by_join(df: DataFrame, name: str, op: str, values: Any) -> DataFrame:
    """Long value lists: an equi-join, for which the optimizer chooses the strategy.

    Missing values meet as nulls, so a missing member matches missing rows and no others.
    """
    col, dtype = _resolve(df.schema, name)
    members = {m for m in (_normalised(dtype, v) for v in values) if m is not None}
    plain = dtype if isinstance(dtype, (T.DecimalType, *FLOATING)) else T.LongType() if isinstance(dtype, INTEGRAL) else T.StringType()
    rows = [(m,) for m in sorted(members)] + [(None,)] * any(_is_nan(v) for v in values)
    side = df.sparkSession.createDataFrame(rows, T.StructType([T.StructField("_member", plain)]))
    # Long texts count as several rows of a few numbers.
    size = sum(1 + len(m) // 64 if isinstance(m, str) else 1 for m in members)
    side = small_side(side.select(F.col("_member").cast(dtype).alias("_member")) if isinstance(dtype, TEMPORAL) else side, size)
    key = F.when(~F.isnan(col), col) if isinstance(dtype, FLOATING) else col
    return df.join(side, key.eqNullSafe(F.col("_member")), "left_semi" if op == "isin" else "left_anti")


def check_triple(**parts: Any) -> bool:
    """True if a filter was asked for; an incomplete one names what is missing."""
    given = {k: v is not None for k, v in parts.items()}
    if any(given.values()) and not all(given.values()):
        missing = ", ".join(k for k, present in given.items() if not present)
        raise ValueError(f"a filter needs a column, an operator and a value; missing: {missing}")
    return all(given.values())
