"""Datasets on disk: a folder of Parquet tables with a small manifest for each version.

``manifest/version=N`` lists the parts of version N and where each lies, below a folder of its own
in ``parts``.  A version is there once its manifest, a single file, is; nothing that a version
refers to is ever written again.  So whoever has opened a dataset goes on reading the version it
opened while another one is written, and a writer that fails leaves the last version as it was.
``vacuum_dataset`` deletes what earlier versions hold.
"""

from __future__ import annotations

import re
import time
import uuid
from typing import Any
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from matrixlens.components import Component, Components, Document, Matrix, tile_names
from matrixlens.dataset import KEYED, AnnotatedDataset
from matrixlens.functions.columns import POSITION, user_columns
from matrixlens.sources.files import children, delete, visible_files
from matrixlens.sources.names import names_of

#: Folder of the tables that list a dataset's parts, each written last in its version, and folder of the parts.
MANIFEST, PARTS = "manifest", "parts"
#: Kind, and folder, of the tables that tell where the names of an axis lie.
NAMES = "names"
_MANIFEST = "section string, key string, kind string, dtype string, n_rows bigint, n_cols bigint, folder string, tile int"
#: Columns of a dense matrix that are stored, and read, together.
TILE_COLUMNS = 128
_VERSION = re.compile(r"version=(\d+)$")

#: Short scheme names and the Hadoop filesystems that serve them.
SCHEME_ALIASES = {"s3": "s3a", "gcs": "gs", "az": "abfs"}


def resolve_location(path: str) -> str:
    """Path or URI as Spark's filesystems know it."""
    scheme, separator, rest = path.partition("://")
    if not separator:
        return path
    if scheme in ("http", "https"):
        raise ValueError("datasets cannot be read over plain http; copy them to a file system or object store")
    return f"{SCHEME_ALIASES.get(scheme, scheme)}://{rest}"


def _folder(section: str, key: str | None) -> str:
    return "/".join([section] + ([quote(key, safe="")] if key is not None else []))


def versions_of(spark: SparkSession, root: str) -> dict[int, list[Any]]:
    """File states of the manifest of every whole version of a dataset; 0 is one without versions, as earlier releases wrote."""
    listed = children(spark, f"{root}/{MANIFEST}")
    found = {0: visible_files(listed)}
    for state in listed:
        name = _VERSION.match(state.getPath().getName())
        if name and state.isDirectory():
            found[int(name[1])] = visible_files(children(spark, state.getPath().toString()))
    return {version: files for version, files in found.items() if files}


def _manifest_folder(root: str, version: int) -> str:
    return f"{root}/{MANIFEST}/version={version}" if version else f"{root}/{MANIFEST}"


def _listed(spark: SparkSession, files: list[Any]) -> list[Any]:
    """Rows of a manifest; its files by name, since that of version 0 lies beside the folders of others."""
    return spark.read.schema(_MANIFEST).parquet(*(f.getPath().toString() for f in files)).collect()


def _kind(part: Component) -> tuple[str, str | None]:
    if isinstance(part, Matrix):
        return part.layout, part.element_type.simpleString()
    return ("document", None) if isinstance(part, Document) else ("table", None)


def _in_tiles(part: Matrix, width: int, tile: int) -> DataFrame:
    """Rows ``(row_pos, tile_0, ...)``: columns that are read together lie together, others are not read."""
    names = tile_names(-(-width // tile))
    whole = F.lit(2**31 - 1)
    cut = [F.slice("values", t * tile + 1, tile if t < len(names) - 1 else whole).alias(name) for t, name in enumerate(names)]
    return part.df.select("row_pos", *cut)


def _stored_form(part: Component, width: int | None, tile: int) -> DataFrame:
    """Rows in position order within files, so position ranges skip most row groups."""
    if isinstance(part, Document):
        return part.df.select(F.to_json("value").alias("value"))
    df = part.df if isinstance(part, Matrix) else part
    if isinstance(part, Matrix) and part.layout == "dense" and width is not None and width > tile:
        df = _in_tiles(part, width, tile)
    order = [c for c in (POSITION, "row_pos", "col_pos") if c in df.columns]
    return df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df


def write_dataset(ds: AnnotatedDataset, path: str, mode: str = "errorifexists", tile: int = TILE_COLUMNS) -> int:
    """Write every part of a dataset as Parquet, then the manifest that makes them a version; returns its number.

    Dense matrices of more than ``tile`` columns are stored in tiles of so many, and reading some
    features reads only their tiles.

    ``mode`` says what to do if there is a dataset already: raise an error, or ``overwrite`` it, which
    adds a version that readers find from then on.  Of two writers at once, the second to
    finish may fail, but no version mixes what they wrote.
    """
    if mode not in ("errorifexists", "error", "overwrite"):
        raise ValueError(f"mode must be 'errorifexists' or 'overwrite', got '{mode}'")
    root = resolve_location(path).rstrip("/")
    versions = versions_of(ds.spark, root)
    if versions and mode != "overwrite":
        raise ValueError(f"there is a dataset in {path} already; mode='overwrite' adds a version")
    version = max(versions, default=0) + 1
    manifest, own = [], f"{PARTS}/{version}-{uuid.uuid4().hex}"
    for section, key, part in ds.parts():
        part = part.unique() if isinstance(part, Matrix) else part
        folder = f"{own}/{_folder(section, key)}"
        rows: int | None = None
        cols: int | None = None
        if isinstance(part, Matrix) and section != "raw":
            rows, cols = ds.shape_of(part, section)
        tiled = isinstance(part, Matrix) and part.layout == "dense" and cols is not None and cols > tile
        _stored_form(part, cols, tile).write.parquet(f"{root}/{folder}")
        if isinstance(part, DataFrame):
            # Counted from what was written, of which the footers suffice.
            rows, cols = ds.spark.read.schema(part.schema).parquet(f"{root}/{folder}").count(), len(user_columns(part.schema))
        manifest.append((section, key, *_kind(part), rows, cols, folder, tile if tiled else None))
    for axis, folder in [(row[0], row[6]) for row in manifest if row[0] in ("obs", "var")]:
        # From what was written: the axis is not computed again.
        names = names_of(ds.spark.read.parquet(f"{root}/{folder}"))
        if names is not None:
            names.write.parquet(f"{root}/{own}/{NAMES}/{axis}")
            manifest.append((axis, None, NAMES, None, None, None, f"{own}/{NAMES}/{axis}", None))
    table = ds.spark.createDataFrame(manifest, _MANIFEST)
    table.coalesce(1).write.parquet(_manifest_folder(root, version))
    return version


def vacuum_dataset(spark: SparkSession, path: str, keep: int = 1, orphan_hours: float = 24) -> list[int]:
    """Delete all but the newest ``keep`` versions of a dataset, with their parts; returns the versions deleted.

    Readers that opened one of them can no longer read it.  Parts that no version refers to, as a failed
    writer leaves, go once they are ``orphan_hours`` old: younger ones may belong to a writer at work.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    root = resolve_location(path).rstrip("/")
    versions = versions_of(spark, root)
    gone, kept = sorted(versions)[:-keep], sorted(versions)[-keep:]

    def places(numbers: list[int]) -> set[str]:
        rows = (row for version in numbers for row in _listed(spark, versions[version]))
        return {row["folder"].split("/")[1] if row["folder"] else _folder(row["section"], row["key"]) for row in rows}

    needed, passed = places(kept), places(gone)
    # Manifests first: what is half deleted is no version.
    for version in gone:
        for state in versions[version]:
            delete(spark, state.getPath().toString())
        if version:
            delete(spark, _manifest_folder(root, version))
    for place in passed - needed:
        # Version 0 has its parts beside the manifest.
        delete(spark, f"{root}/{place}" if 0 in gone and not re.match(r"\d+-", place) else f"{root}/{PARTS}/{place}")
    for state in children(spark, f"{root}/{PARTS}"):
        place = state.getPath().getName()
        if place not in needed | passed and state.getModificationTime() < (time.time() - 3600 * orphan_hours) * 1000:
            delete(spark, state.getPath().toString())
    return gone


def open_dataset(spark: SparkSession, path: str, version: int | None = None) -> AnnotatedDataset:
    """Open the newest version of a stored dataset, or the one asked for.

    Reads the manifest only; parts are opened on first use, and are those of this version
    whatever is written later.
    """
    root = resolve_location(path).rstrip("/")
    versions = versions_of(spark, root)
    if not versions or (version is not None and version not in versions):
        raise FileNotFoundError(f"no dataset in {path}" if not versions else f"no version {version} of {path}; there are {sorted(versions)}")
    listed = _listed(spark, versions[max(versions) if version is None else version])

    def opener(row):
        def open_part() -> Component:
            df = spark.read.parquet(f"{root}/{row['folder'] or _folder(row['section'], row['key'])}")
            if row["kind"] == "table":
                return df
            if row["kind"] == "document":
                return Document.from_json(df)
            shape = None if row["n_rows"] is None else (row["n_rows"], row["n_cols"])
            return Matrix.of_tiles(df, row["tile"], shape) if row["tile"] else Matrix(df, row["kind"], shape)

        return open_part

    names = {row["section"]: f"{root}/{row['folder']}" for row in listed if row["kind"] == NAMES}
    listed = [row for row in listed if row["kind"] != NAMES]
    single = {row["section"]: opener(row) for row in listed if row["key"] is None}
    keyed = {
        section: Components({row["key"]: opener(row) for row in listed if row["section"] == section and row["key"] is not None})
        for section in KEYED
    }
    sizes = {row["section"]: row["n_rows"] for row in listed if row["section"] in ("obs", "var")}
    return AnnotatedDataset(
        single["obs"], single.get("var"), single.get("X"), raw=single.get("raw"), path=root, sizes=sizes, **keyed,
        names={axis: lambda folder=folder: spark.read.parquet(folder) for axis, folder in names.items()},
    )
