"""The annotated dataset: a matrix with the tables that describe its rows and columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from matrixlens import session
from matrixlens.components import Component, Components, Document, Matrix
from matrixlens.functions.columns import INDEX, INTEGRAL, POSITION, column, user_columns
from matrixlens.functions.globs import select_names
from matrixlens.functions.nested import nested_value
from matrixlens.operators import table_stats
from matrixlens.operators.alignment import KeptPositions
from matrixlens.operators.matrix_stats import describe_cells, describe_rows_of_arrays
from matrixlens.operators.positions import assign_positions
from matrixlens.operators.predicates import check_triple, filter_rows
from matrixlens.operators.selection import first_positions, match_names, unmatched_patterns
from matrixlens.operators.slicing import Bounds, as_array, in_order, needs_length, resolve, selects, slice_rows
from matrixlens.plans.summary import entries_frame, summary_frame
from matrixlens.session import small_side, stable
from matrixlens.sources.names import rows_named

KEYED = ("layers", "obsm", "varm", "obsp", "varp", "uns")
SECTIONS = ("X", "obs", "var", *KEYED)

#: Axes of each section's rows and columns; None where the section brings its own.
AXES = {
    "X": ("obs", "var"),
    "layers": ("obs", "var"),
    "obsm": ("obs", None),
    "varm": ("var", None),
    "obsp": ("obs", "obs"),
    "varp": ("var", "var"),
    "uns": (None, None),
}

MATRIX_STATISTICS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


class AnnotatedDataset:
    """Named DataFrames sharing two axes: observations (``obs``) and variables (``var``).

    ``obs`` and ``var`` carry ``_pos`` (0, 1, 2, ...) and ``_index`` (the row name) next to
    the user's columns.  Everything is lazy: parts are opened on first use, and operators
    return DataFrames.
    """

    def __init__(
        self,
        obs: DataFrame,
        var: DataFrame | None = None,
        X: Matrix | None = None,
        *,
        layers: Mapping[str, Any] | None = None,
        obsm: Mapping[str, Any] | None = None,
        varm: Mapping[str, Any] | None = None,
        obsp: Mapping[str, Any] | None = None,
        varp: Mapping[str, Any] | None = None,
        uns: Mapping[str, Any] | None = None,
        raw: Any = None,
        path: str | None = None,
        sizes: Mapping[str, int] | None = None,
        names: Mapping[str, Callable[[], DataFrame]] | None = None,
    ) -> None:
        self._single = Components({k: v for k, v in {"obs": obs, "var": var, "X": X, "raw": raw}.items() if v is not None})
        given = {"layers": layers, "obsm": obsm, "varm": varm, "obsp": obsp, "varp": varp, "uns": uns}
        self._keyed = {s: parts if isinstance(parts, Components) else Components(dict(parts or {})) for s, parts in given.items()}
        self._sizes = dict(sizes or {})
        self._names = dict(names or {})
        self._kept: dict[str, KeptPositions] = {}
        self._base = self
        self.path = path

    # ---- parts -------------------------------------------------------------------------

    @property
    def spark(self) -> SparkSession:
        return self.obs.sparkSession

    @property
    def obs(self) -> DataFrame:
        return self._single["obs"]

    @property
    def var(self) -> DataFrame:
        if "var" not in self._single:
            raise KeyError("the dataset has no section 'var'")
        return self._single["var"]

    @property
    def X(self) -> Matrix:
        return self.get("X")

    def parts(self) -> Iterator[tuple[str, str | None, Component]]:
        """Every part as ``(section, key, part)``, ``raw`` included."""
        for section, part in self._single.items():
            yield section, None, part
        for section, parts in self._keyed.items():
            for key, part in parts.items():
                yield section, key, part

    @property
    def has_raw(self) -> bool:
        return "raw" in self._single

    def has(self, section: str) -> bool:
        """Is the section present?  Keyed sections always are, if only empty."""
        return section in self._keyed or section in self._single

    def keys(self, section: str) -> list[str]:
        return list(self._keyed[section])

    @cached_property
    def n_obs(self) -> int:
        return self._length("obs")

    @cached_property
    def n_vars(self) -> int:
        return self._length("var")

    def _length(self, axis: str) -> int:
        if axis in self._kept:
            return self._kept[axis].count
        return self._sizes[axis] if axis in self._sizes else (self.obs if axis == "obs" else self.var).count()

    def axis_length(self, axis: str) -> int:
        return self.n_obs if axis == "obs" else self.n_vars

    def get(self, section: str, key: str | Sequence[str | int] | None = None) -> Component | Components:
        """A section, or the part of it under a key or a path of keys."""
        if section not in SECTIONS:
            raise KeyError(f"the dataset has no section '{section}'")
        path = [] if key is None else [key] if isinstance(key, str) else list(key)
        if section in self._keyed:
            parts = self._keyed[section]
            if not path:
                return parts
            if path[0] not in parts:
                raise KeyError(f"section '{section}' has nothing at {' -> '.join(map(str, path))}")
            return _inside(parts[path[0]], path[1:], section, path)
        if section not in self._single:
            raise KeyError(f"the dataset has no section '{section}'")
        return _inside(self._single[section], path, section, path)

    # ---- filters -----------------------------------------------------------------------

    def where(self, axis: str, name: str, op: str, value: Any) -> AnnotatedDataset:
        """Keep the observations or variables that satisfy a filter, in every part.

        Positions keep their values; ``view`` counts the rows that are left.
        """
        if axis not in ("obs", "var"):
            raise ValueError(f"filter axis must be 'obs' or 'var', got '{axis}'")
        check_triple(filter_column=name, filter_operator=op, filter_value=value)
        table = self._filtered(axis, self.obs if axis == "obs" else self.var, name, op, value)
        result = AnnotatedDataset.__new__(AnnotatedDataset)
        # Parts are cut from the unfiltered dataset, once for each axis however many filters it has.
        base = result._base = self._base
        result._names = base._names
        result._kept = {**self._kept, axis: KeptPositions(table)}

        def along(part: Component, row_axis: str | None, col_axis: str | None) -> Component:
            for one, kept in result._kept.items():
                if isinstance(part, DataFrame):
                    part = kept.rows_of(part, POSITION) if row_axis == one else part
                elif isinstance(part, Matrix):
                    part = part.keep_rows(kept) if row_axis == one else part
                    part = part.keep_cols(kept) if col_axis == one else part
            return part

        single = {**base._single.openers, **{a: self._single.openers[a] for a in self._kept}, axis: table}
        if "X" in single:
            single["X"] = lambda: along(base._single["X"], *AXES["X"])
        result._single = Components(single)
        result._keyed = {
            s: parts if s == "uns" else parts.map(lambda part, s=s: along(part, *AXES[s]))
            for s, parts in base._keyed.items()
        }
        result._sizes = {a: n for a, n in base._sizes.items() if a not in result._kept}
        result.path = self.path
        return result

    def _filtered(self, section: str, table: DataFrame, name: str, op: str, value: Any) -> DataFrame:
        """Rows of a table that satisfy a filter; names of a stored axis are looked up first.

        The filter itself stays: the look-up only says which rows it need look at.
        """
        if section in self._names and name in ("index", INDEX) and op in ("==", "isin"):
            asked = list(value) if isinstance(value, (list, tuple, set)) else [value]
            # Missing values are not in the side table; what is no text equals no name.
            if not any(v is None or v != v for v in asked):
                found = rows_named(self._names[section](), [v for v in asked if isinstance(v, str)])
                table = KeptPositions(found).rows_of(table, POSITION)
        return filter_rows(table, name, op, value)

    def positions_of(self, names: Sequence[str] | DataFrame, axis: str = "var") -> DataFrame:
        """``(name, position)``: where each of the names occurs first on an axis; names that are not there have no row.

        Many names may be given as the first column of a table.
        """
        if axis not in ("obs", "var"):
            raise ValueError(f"axis must be 'obs' or 'var', got '{axis}'")
        table = self.obs if axis == "obs" else self.var
        if axis in self._names:
            found = rows_named(self._names[axis](), names)
            if axis in self._kept:
                found = self._kept[axis].rows_of(found, POSITION)
        elif isinstance(names, DataFrame):
            asked = names.select(column(names.columns[0]).cast("string").alias(INDEX))
            found = table.join(asked, INDEX, "left_semi")
        else:
            found = filter_rows(table, "index", "isin", list(names))
        return first_positions(found)

    def require_rows(self) -> AnnotatedDataset:
        """Raise if a filter left no observation or no variable."""
        for axis, what in (("obs", "observations"), ("var", "variables")):
            # The counts are kept: they also tell joins and statistics how to proceed.
            if self._kept and axis in self._single and self.axis_length(axis) == 0:
                raise ValueError(f"the filter leaves no {what}")
        return self

    # ---- selection ---------------------------------------------------------------------

    def features(self, patterns: Sequence[str]) -> DataFrame:
        """``(name, pattern_no, position)`` of the variables that names or globs select."""
        return match_names(self.var, patterns)

    def _chosen(self, patterns: Sequence[str]) -> DataFrame:
        """The selected features, matched once and written down."""
        chosen = stable(self.features(patterns))
        if chosen.isEmpty():
            raise ValueError(f"no variable matches {list(patterns)}")
        return chosen

    def unmatched(self, patterns: Sequence[str]) -> DataFrame:
        """``(pattern_no, pattern)`` of the patterns that select no variable."""
        return unmatched_patterns(self.var, patterns)

    # ---- statistics --------------------------------------------------------------------

    def describe(
        self,
        section: str,
        key: str | Sequence[str] | None = None,
        columns: Sequence[str] | None = None,
        axis: int | None = None,
        error: float | None = None,
    ) -> DataFrame:
        """Descriptive statistics of a table or matrix.

        Tables give one row per column, a matrix one row for all its cells, or with
        ``axis=0`` one per column and with ``axis=1`` one per row.  ``columns`` selects
        table columns, or features of ``X`` and layers, by name or glob.

        Everything is exact.  With ``error``, say 0.01, quartiles may be values whose rank is off by that
        share of the rows, and the data are read once; see ``describe_sketched``.  Rows of dense
        matrices are exact all the same.
        """
        if key is not None and section in ("obs", "var", "X"):
            raise ValueError("obs, var and X have no keys: choose columns instead")
        part = self.require_rows().get(section, key)
        if isinstance(part, DataFrame):
            known = self.axis_length(section) if section in ("obs", "var") else None
            return table_stats.describe_table(part, columns, known, error)
        if isinstance(part, Components):
            raise ValueError(f"'{section}' holds several parts: key required")
        if isinstance(part, Document):
            raise ValueError(f"{key} in '{section}' is neither a table nor a matrix")
        if columns is not None and not columns and section in ("X", "layers"):
            raise ValueError("an empty list selects no variable")
        if columns:
            if section not in ("X", "layers"):
                raise ValueError(f"features cannot be selected in {section}")
            return self._describe_features(part, columns, error)
        return self._describe_matrix(part, section, axis, error)

    def shape_of(self, part: Matrix, section: str) -> tuple[int, int]:
        """Rows and columns of a matrix in ``section``."""
        row_axis, col_axis = AXES[section]
        rows = self.axis_length(row_axis) if row_axis else part.height()
        return rows, self.axis_length(col_axis) if col_axis else part.width()

    def _describe_matrix(self, part: Matrix, section: str, axis: int | None, error: float | None) -> DataFrame:
        n_rows, n_cols = self.shape_of(part, section)
        sparse = part.layout == "sparse"
        repeating = isinstance(part.element_type, INTEGRAL)
        row_axis, col_axis = AXES[section]
        if axis is None:
            groups = self.spark.range(1).select(F.lit(0).alias("_all")) if sparse else None
            stats = describe_cells(part.cells(), [], n_rows * n_cols, groups, repeating, error)
            return stats.select(*MATRIX_STATISTICS)
        if axis == 0:
            groups = self._positions(col_axis, n_cols, "col_pos") if sparse else None
            return describe_cells(part.cells(), ["col_pos"], n_rows, groups, repeating, error)
        if axis != 1:
            raise ValueError(f"axis must be None, 0 or 1, got {axis}")
        if part.layout == "dense":
            return describe_rows_of_arrays(part.df)
        groups = self._positions(row_axis, n_rows, "row_pos") if sparse else None
        return describe_cells(part.cells(), ["row_pos"], n_cols, groups, repeating, error)

    def _positions(self, axis: str | None, length: int, name: str) -> DataFrame:
        if axis is None:
            return self.spark.range(length).select(F.col("id").alias(name))
        return self._single[axis].select(F.col(POSITION).alias(name))

    def _describe_features(self, part: Matrix, patterns: Sequence[str], error: float | None) -> DataFrame:
        chosen = self._chosen(patterns)
        cells = part.keep_cols(KeptPositions(chosen.select(F.col("position").alias(POSITION)))).cells()
        groups = chosen.select(F.col("position").alias("col_pos")) if part.layout == "sparse" else None
        repeating = isinstance(part.element_type, INTEGRAL)
        stats = describe_cells(cells, ["col_pos"], self.n_obs, groups, repeating, error)
        named = chosen.withColumnRenamed("position", "col_pos").join(stats, "col_pos")
        named = named.orderBy("pattern_no", "col_pos").withColumnRenamed("name", "column")
        return table_stats.as_description(named.withColumn("is_numeric", F.lit(True)))

    def value_counts(
        self, section: str, key: str | Sequence[str] | None = None, columns: Sequence[str] | None = None
    ) -> DataFrame:
        """How often each value of the categorical columns of a table occurs, missing included."""
        part = self.require_rows().get(section, key)
        if not isinstance(part, DataFrame):
            raise ValueError(f"'{section}' at {key} is not a table")
        return table_stats.value_counts(part, columns)

    # ---- views -------------------------------------------------------------------------

    def view(
        self,
        section: str,
        key: str | Sequence[str | int] | None = None,
        columns: Sequence[str] | None = None,
        rows: Bounds = (0, 5),
        cols: Bounds | list[int] = (0, 5),
        where: tuple[str, str, Any] | None = None,
    ) -> DataFrame:
        """Rows of a table or a block of a matrix, by position.

        Tables give ``_index`` and the selected columns.  Matrices give ``(row_pos, values)``
        with the cells of the column range, of a list of column positions, or of the
        selected features, in the order asked for.  A section without a key lists its entries; scalars and mappings give their text.
        ``where`` filters the viewed table only, and positions then count what is left.
        """
        part = self.get(section, key)
        if where is not None and not isinstance(part, DataFrame):
            raise ValueError("only tables can be filtered in a view")
        if isinstance(part, Components):
            return self.entries(section)
        if isinstance(part, Document):
            return part.entries() if part.type_text().startswith("OBJECT") else part.text()
        if isinstance(part, DataFrame):
            table, names, gaps = self._viewed_table(part, section, columns, where)
            shown = ([INDEX] if INDEX in table.columns else []) + names
            sliced = slice_rows(table, rows, gaps, length=self._known_length(section, gaps))
            return sliced.select(*[column(c) for c in shown])
        if columns is not None and section not in ("X", "layers"):
            raise ValueError(f"features cannot be selected in {section}")
        return self._matrix_block(part, section, columns, rows, cols)

    def view_shape(
        self,
        section: str,
        key: str | Sequence[str | int] | None = None,
        columns: Sequence[str] | None = None,
        rows: Bounds = (0, 5),
        cols: Bounds | list[int] = (0, 5),
        where: tuple[str, str, Any] | None = None,
    ) -> DataFrame:
        """One row ``(full_shape, slice_shape)``: after the filter, before and after slicing.

        Values without rows and columns have neither.
        """
        part = self.get(section, key)
        if isinstance(part, DataFrame):
            table, names, _ = self._viewed_table(part, section, columns, where)
            n_rows, n_cols = table.count(), len(user_columns(part.schema))
            picked = len(names)
        elif isinstance(part, Matrix):
            n_rows, n_cols = self.shape_of(part, section)
            if columns is not None:
                picked = self.features(columns).count()
            else:
                picked = len(cols) if isinstance(cols, list) else len(resolve(cols, n_cols))
        else:
            return self.spark.range(1).select(*[F.lit(None).cast("string").alias(c) for c in ("full_shape", "slice_shape")])
        taken = len(resolve(rows, n_rows))
        return self.spark.range(1).select(
            F.lit(f"({n_rows}, {n_cols})").alias("full_shape"), F.lit(f"({taken}, {picked})").alias("slice_shape")
        )

    def named_cells(self, section: str = "X", key: str | None = None) -> DataFrame:
        """``(row_pos, feature, value)``: the cells of ``X`` or a layer with variable names.

        The form for many features, where one column per feature would not do.
        """
        if section not in ("X", "layers"):
            raise ValueError(f"{section} has no features")
        part = self.get(section, key)
        if not isinstance(part, Matrix):
            raise ValueError(f"'{section}' holds several matrices: key required")
        names = self.var.select(F.col(POSITION).alias("col_pos"), F.col(INDEX).alias("feature"))
        return part.cells().join(names, "col_pos").select("row_pos", "feature", "value")

    def _known_length(self, section: str, gaps: bool) -> int | None:
        return self._sizes.get(section) if not gaps else None

    def _viewed_table(
        self, part: DataFrame, section: str, columns: Sequence[str] | None, where: tuple[str, str, Any] | None
    ) -> tuple[DataFrame, list[str], bool]:
        available = user_columns(part.schema)
        names = available if columns is None else select_names(available, columns)[0]
        if not names:
            raise ValueError(f"no column matches {list(columns or [])}")
        gaps = AXES.get(section, (section,))[0] in self._kept
        if where is None or not check_triple(**dict(zip(("filter_column", "filter_operator", "filter_value"), where))):
            return part, names, gaps
        table = self._filtered(section, part, *where)
        if table.isEmpty():
            raise ValueError("the filter leaves no rows")
        return table, names, True

    def _matrix_block(
        self, part: Matrix, section: str, features: Sequence[str] | None, rows: Bounds, cols: Bounds | list[int]
    ) -> DataFrame:
        row_axis, col_axis = AXES[section]
        gaps = row_axis in self._kept
        length = self.shape_of(part, section)[0] if row_axis is None else self.axis_length(row_axis) if needs_length(rows) else None
        # Positions of the wanted rows; at most as many as the slice asks for.
        part = part.unique()
        axis_rows = self._single[row_axis].select(POSITION) if row_axis else self.spark.range(length).select(F.col("id").alias(POSITION))
        wanted = slice_rows(axis_rows, rows, gaps, length)
        at_most = len(resolve(rows, length if length is not None else max(rows[0], rows[1])))

        def of_rows(block: DataFrame) -> DataFrame:
            if gaps or part.layout != "dense":
                return block.join(wanted, POSITION, "left_semi")
            return slice_rows(block, rows, False, length)

        kept: DataFrame | None = None
        if features is not None:
            kept = self._chosen(features).select(F.col("position").alias(POSITION), "pattern_no")
        elif col_axis in self._kept:
            if isinstance(cols, list):
                raise ValueError("columns of a filtered dataset are selected by range or by name")
            kept = slice_rows(self._single[col_axis].select(POSITION), cols, True, self.axis_length(col_axis))
            kept = kept.withColumn("pattern_no", F.lit(0))
        element, numbered = part.element_type, None
        n_kept = kept.count() if kept is not None else 0
        if part.layout != "dense" and n_kept > session.BROADCAST_ROWS:
            # Too many columns to name in an array beside each row: they are numbered instead.
            numbered = assign_positions(kept, "pattern_no", POSITION, name="_out").select(F.col(POSITION).alias("col_pos"), "_out")
            positions = as_array(range(n_kept))
        elif kept is not None:
            ordered = F.array_sort(F.collect_list(F.struct("pattern_no", POSITION)))
            positions = kept.agg(ordered[POSITION]).scalar()
            inside = None
        else:
            width = self.axis_length(col_axis) if col_axis else part.width()
            picked = cols if isinstance(cols, list) else resolve(cols, width)
            positions = as_array(picked)
            inside = selects(F.col("col_pos"), picked) if isinstance(picked, range) else F.col("col_pos").isin(picked)

        if part.layout == "dense":
            held, at = part.picking(picked if kept is None else kept, POSITION)
            block = of_rows(held.withColumnRenamed("row_pos", POSITION)).withColumn("_picked", positions)
            values = F.transform("_picked", at)
            return in_order(block.select(F.col(POSITION).alias("row_pos"), values.alias("values")), at_most, "row_pos")
        block, place = of_rows(part.df.withColumnRenamed("row_pos", POSITION)), F.col("col_pos")
        if kept is None:
            block = block.filter(inside)
        elif numbered is not None:
            block, place = block.join(numbered, "col_pos"), F.col("_out")
        else:
            block = block.join(small_side(kept.select(F.col(POSITION).alias("col_pos")), n_kept), "col_pos", "left_semi")
        absent = F.lit(0 if part.layout == "sparse" else None).cast(element)
        cell = F.struct(place.cast("bigint").alias("place"), F.col("value"))
        stored = block.groupBy(POSITION).agg(F.collect_list(cell).alias("cells"))
        twice = F.size(F.array_distinct(F.col("cells.place"))) < F.size("cells")
        error = F.raise_error(F.lit("a cell is stored more than once; say so with Matrix(..., repeated=True)"))
        stored = stored.select(POSITION, F.map_from_entries(F.when(twice, error).otherwise(F.col("cells"))).alias("stored"))
        filled = wanted.join(stored, POSITION, "left").withColumn("_picked", positions)
        stored_map = F.coalesce("stored", F.create_map().cast(f"map<bigint,{element.simpleString()}>"))
        filled = filled.withColumn("stored", stored_map)
        values = F.transform(
            "_picked",
            lambda p: F.when(F.map_contains_key("stored", p), F.try_element_at("stored", p)).otherwise(absent),
        )
        return in_order(filled.select(F.col(POSITION).alias("row_pos"), values.alias("values")), at_most, "row_pos")

    # ---- metadata ----------------------------------------------------------------------

    def entries(self, section: str) -> DataFrame:
        """``(section, key, type, dtype, n_rows, n_cols, shape)`` of a keyed section's entries."""
        return entries_frame(self, section)

    def summary(self) -> DataFrame:
        """Everything there is to know about the dataset without reading its values."""
        return summary_frame(self)


def _inside(part: Component, path: list[str | int], section: str, whole: list[str | int]) -> Component:
    """Follow the rest of a key path into a part."""
    if not path:
        return part
    try:
        if isinstance(part, Document):
            return part.at(path)
        if isinstance(part, DataFrame) and path[0] in part.columns:
            name = str(path[0])
            value = nested_value(column(name), part.schema[name].dataType, path[1:])
            axis = [c for c in (POSITION, INDEX) if c in part.columns]
            return part.select(*axis, value.alias(str(path[-1])))
    except KeyError as error:
        raise KeyError(f"section '{section}' has nothing at {' -> '.join(map(str, whole))}") from error
    raise KeyError(f"section '{section}' has nothing at {' -> '.join(map(str, whole))}")
