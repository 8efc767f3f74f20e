"""Summary frames.  They are built from schemas, counts and the manifest, not from values."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, functions as F

from matrixlens.components import Component, Document, Matrix
from matrixlens.functions.columns import shape_text, user_columns, utc_text

if TYPE_CHECKING:
    from matrixlens.dataset import AnnotatedDataset

_KEYED = ("obsm", "varm", "obsp", "varp", "uns", "layers")
_ENTRY = "section string, key string, type string, dtype string, n_rows bigint, n_cols bigint"
_SUMMARY = _ENTRY + ", value string"

Row = tuple[str, str | None, str, str | None, int | None, int | None]


def _entry(ds: AnnotatedDataset, section: str, key: str | None, part: Component) -> Row:
    if isinstance(part, Matrix):
        return section, key, f"{part.layout} matrix", part.element_type.simpleString(), *ds.shape_of(part, section)
    if isinstance(part, Document):
        return section, key, "value", part.type_text().lower(), None, None
    rows = ds.axis_length(section) if section in ("obs", "var") else part.count()
    return section, key, "table", None, rows, len(user_columns(part.schema))


def entries_frame(ds: AnnotatedDataset, section: str) -> DataFrame:
    rows = [_entry(ds, section, key, part) for key, part in ds.get(section).items()]
    return _with_shape(ds.spark.createDataFrame(rows, _ENTRY))


def _with_shape(df: DataFrame) -> DataFrame:
    shape = shape_text(F.col("n_rows"), F.col("n_cols")).alias("shape")
    columns = df.columns
    return df.select(*columns[:6], shape, *columns[6:])


def summary_frame(ds: AnnotatedDataset) -> DataFrame:
    rows: list[tuple] = []
    for section in ("obs", "var"):
        if ds.has(section):
            table = ds.get(section)
            rows.append((*_entry(ds, section, None, table), None))
            rows += [
                (section, name, "column", table.schema[name].dataType.simpleString(), None, None, None)
                for name in user_columns(table.schema)
            ]
    x = _entry(ds, "X", None, ds.X) if ds.has("X") else ("X", None, None, None, None, None)
    rows.append((*x, None))
    for section in _KEYED:
        rows += [(*_entry(ds, section, key, part), None) for key, part in ds.get(section).items()]
    rows.append(("raw", None, "presence", None, None, None, str(ds.has_raw).lower()))
    frame = _with_shape(ds.spark.createDataFrame(rows, _SUMMARY))
    if ds.path is None:
        return frame
    from matrixlens.sources.catalog import last_modified

    modified = last_modified(ds.spark, ds.path).select(
        F.lit("last_modified").alias("section"),
        F.lit(None).cast("string").alias("key"),
        F.lit("timestamp").alias("type"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("dtype", "string"), ("n_rows", "bigint"), ("n_cols", "bigint"))],
        F.lit("NA").alias("shape"),
        utc_text(F.col("last_modified")).alias("value"),
    )
    return frame.unionByName(modified)
