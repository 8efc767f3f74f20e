"""The parts a dataset is made of: matrices, tables and free-form values."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from matrixlens.functions.columns import clean_double
from matrixlens.functions.nested import variant_path
from matrixlens.operators.alignment import KeptPositions

LAYOUTS = ("dense", "long", "sparse")


def tile_names(n: int) -> list[str]:
    """Names of the columns of the first ``n`` tiles."""
    return [f"tile_{t}" for t in range(n)]


@dataclass(frozen=True)
class Matrix:
    """A matrix as a DataFrame.

    ``dense``: one row ``(row_pos, values array)`` per matrix row.  Where it is stored in tiles of
    columns, ``tiled`` has ``(row_pos, tile_0, tile_1, ...)`` with ``tile`` values each, the last one
    with the rest; ``df`` joins them, and picking columns reads only the tiles that hold them.
    ``long``: one row ``(row_pos, col_pos, value)`` per cell.
    ``sparse``: as ``long``, but the cells not present are zeros.  Cells with the same
    position add up if ``repeated`` says that there may be such; else they are an error.

    ``shape`` may be left out where the dataset's axes or the layout give it.  A sparse matrix
    must state the lengths that no axis gives: its stored cells do not tell.
    """

    df: DataFrame
    layout: str
    shape: tuple[int | None, int | None] | None = None
    repeated: bool = False
    #: The matrix that this one is a filtered part of; its width is this one's.
    origin: Matrix | None = None
    tiled: DataFrame | None = None
    tile: int = 0

    @classmethod
    def of_tiles(cls, tiled: DataFrame, tile: int, shape: tuple[int | None, int | None] | None = None) -> Matrix:
        """A dense matrix whose rows are stored as ``tiled`` describes."""
        values = F.concat(*(F.col(name) for name in tile_names(len(tiled.columns) - 1)))
        return cls(tiled.select("row_pos", values.alias("values")), "dense", shape, tiled=tiled, tile=tile)

    def __post_init__(self) -> None:
        if self.layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}, got '{self.layout}'")
        needed = {"row_pos", "values"} if self.layout == "dense" else {"row_pos", "col_pos", "value"}
        if not needed <= set(self.df.columns):
            raise ValueError(f"a {self.layout} matrix needs the columns {sorted(needed)}")

    @property
    def element_type(self) -> T.DataType:
        if self.layout == "dense":
            return self.df.schema["values"].dataType.elementType
        return self.df.schema["value"].dataType

    def cells(self) -> DataFrame:
        """``(row_pos, col_pos, value double)``, missing values as null."""
        if self.layout == "dense":
            cells = self.df.select("row_pos", F.posexplode("values").alias("col_pos", "value"))
        else:
            cells = self.unique().df
        value = clean_double(F.col("value"), self.element_type)
        return cells.select("row_pos", F.col("col_pos").cast("bigint").alias("col_pos"), value.alias("value"))

    def unique(self) -> Matrix:
        """The same matrix with each cell stored once at most."""
        if not self.repeated:
            return self
        summed = self.df.groupBy("row_pos", "col_pos").agg(F.sum("value").cast(self.element_type).alias("value"))
        return replace(self, df=summed, repeated=False)

    def keep_rows(self, kept: KeptPositions) -> Matrix:
        """Only the rows at kept positions; the width stays what it was."""
        width = None if self.shape is None else self.shape[1]
        if self.tiled is not None:
            rows = Matrix.of_tiles(kept.rows_of(self.tiled, "row_pos"), self.tile, (None, width))
            return replace(rows, origin=self.origin or self)
        return replace(self, df=kept.rows_of(self.df, "row_pos"), shape=(None, width), origin=self.origin or self)

    def picking(self, positions: DataFrame | Iterable[int], name: str = "_pos") -> tuple[DataFrame, Callable[[Column], Column]]:
        """Rows of a dense matrix that have the columns at ``positions``, and the cell of a row at one of them.

        The positions are numbers, or a table's column ``name``.  Only the numbers of their tiles come
        to the driver, no more than the matrix has.
        """
        if self.tiled is None:
            return self.df, lambda p: F.get("values", p.cast("int"))
        last = len(self.tiled.columns) - 2
        if isinstance(positions, DataFrame):
            numbers = [r[0] for r in positions.select(F.least(F.floor(F.col(name) / self.tile), F.lit(last)).alias("t")).distinct().collect()]
        else:
            numbers = {min(p // self.tile, last) for p in positions}
        names = {t: tile_names(last + 1)[t] for t in sorted(numbers)}

        def cell(p: Column) -> Column:
            tile = F.least(F.floor(p / self.tile), F.lit(last))
            held = [F.when(tile == t, F.get(tile_name, (p - t * self.tile).cast("int"))) for t, tile_name in names.items()]
            return F.coalesce(*held) if held else F.lit(None).cast(self.element_type)

        return self.tiled.select("row_pos", *names.values()), cell

    def keep_cols(self, kept: KeptPositions) -> Matrix:
        """Only the columns at kept positions; positions do not change.

        A dense matrix becomes a long one.  Its kept positions travel as one array: each of
        its rows holds an array of all columns anyway, so that array is never the larger.
        """
        if self.layout == "dense":
            positions = kept.positions.agg(F.array_sort(F.collect_list("_pos"))).scalar()
            held, at = self.picking(kept.positions)
            rows = held.withColumn("_kept", positions)
            cells = F.transform("_kept", lambda p: F.struct(p.alias("col_pos"), at(p).alias("value")))
            return Matrix(rows.select("row_pos", F.inline(cells)), "long", origin=self.origin or self)
        return replace(self, df=kept.rows_of(self.df, "col_pos"), origin=self.origin or self)

    def _length(self, axis: int, what: str) -> int:
        if self.shape is not None and self.shape[axis] is not None:
            return self.shape[axis]
        if self.layout == "sparse":
            raise ValueError(f"a sparse matrix whose {what} no axis gives must state its shape")
        last = self.df.agg(F.max("col_pos" if axis else "row_pos")).first()[0]
        return 0 if last is None else last + 1

    def width(self) -> int:
        """Number of columns, read from one row where the layout allows."""
        if self.shape is not None and self.shape[1] is not None:
            return self.shape[1]
        if self.origin is not None:
            return self.origin.width()
        if self.layout == "dense":
            first = self.df.select(F.size("values")).first()
            return first[0] if first else 0
        return self._length(1, "width")

    def height(self) -> int:
        """Number of rows."""
        if self.layout == "dense" and (self.shape is None or self.shape[0] is None):
            return self.df.count()
        return self._length(0, "height")


@dataclass(frozen=True)
class Document:
    """A scalar or nested value: one row with a VARIANT column ``value``."""

    df: DataFrame

    @classmethod
    def of(cls, spark: SparkSession, value: Any) -> Document:
        return cls.from_json(spark.range(1).select(F.lit(json.dumps(value)).alias("value")))

    @classmethod
    def from_json(cls, df: DataFrame) -> Document:
        """From one row with JSON text in ``value``."""
        return cls(df.select(F.parse_json("value").alias("value")))

    def at(self, keys: list[str | int]) -> Document:
        """The value under a path of keys."""
        for end in range(1, len(keys) + 1):
            inner = self.df.select(F.try_variant_get("value", variant_path(keys[:end]), "variant").alias("value"))
            if inner.filter(F.col("value").isNotNull()).isEmpty():
                raise KeyError(f"nothing at key path {' -> '.join(map(str, keys[:end]))}")
        return Document(inner) if keys else self

    def type_text(self) -> str:
        return self.df.select(F.schema_of_variant("value")).first()[0]

    def text(self) -> DataFrame:
        """The value as plain text."""
        return self.df.select(F.coalesce(F.try_variant_get("value", "$", "string"), F.to_json("value")).alias("value"))

    def entries(self) -> DataFrame:
        """``(key, type)`` of the fields of a mapping."""
        fields = self.df.sparkSession.tvf.variant_explode(F.col("value").outer())
        fields = self.df.select("value").lateralJoin(fields.select("key", F.col("value").alias("field")))
        return fields.select("key", F.schema_of_variant("field").alias("type"))


Component = Matrix | DataFrame | Document


@dataclass
class Components(Mapping[str, Component]):
    """Named parts, each opened on first use only."""

    openers: dict[str, Component | Callable[[], Component]]
    _opened: dict[str, Component] = field(default_factory=dict)

    def __getitem__(self, key: str) -> Component:
        if key not in self._opened:
            part = self.openers[key]
            self._opened[key] = part() if callable(part) else part
        return self._opened[key]

    def __iter__(self) -> Iterator[str]:
        return iter(self.openers)

    def __len__(self) -> int:
        return len(self.openers)

    def map(self, change: Callable[[Component], Component]) -> Components:
        return Components({key: (lambda key=key: change(self[key])) for key in self.openers})
