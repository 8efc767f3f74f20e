"""Finding datasets below a folder."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from matrixlens.sources.files import children
from matrixlens.sources.layout import MANIFEST, resolve_location, versions_of

_FOUND = "path string, kind string, last_modified timestamp"


def _newest(states: list[Any]) -> datetime | None:
    times = [s.getModificationTime() for s in states]
    return datetime.fromtimestamp(max(times) / 1000, timezone.utc) if times else None


def modified_at(spark: SparkSession, path: str) -> datetime | None:
    """When a dataset was last written: the time of its manifest, which is written last.

    Of any other folder, the newest time among its direct children; None for nothing.
    """
    versions = versions_of(spark, path)
    return _newest(versions[max(versions)] if versions else children(spark, path))


def _walk(spark: SparkSession, listed: list[Any], recursive: bool) -> Iterator[tuple[str, str, datetime | None]]:
    """What is found among the ``listed`` children of a folder and, with ``recursive``, below them."""
    for state in listed:
        path = state.getPath()
        name, full = path.getName(), path.toString() if path.toUri().getScheme() != "file" else path.toUri().getPath()
        if state.isFile():
            if name.endswith(".h5ad"):
                yield full, "h5ad", _newest([state])
            continue
        inside = children(spark, full)
        if name.endswith(".zarr"):
            yield full, "zarr", _newest(inside or [state])
        elif any(child.getPath().getName() == MANIFEST for child in inside):
            yield full, "dataset", modified_at(spark, full)
        elif recursive:
            yield from _walk(spark, inside, recursive)


def locate_datasets(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """``(path, kind, last_modified)`` of the datasets below ``root``; none is no error.

    Found are folders in this library's layout (``dataset``), ``*.h5ad`` files (``h5ad``)
    and ``*.zarr`` stores (``zarr``), by their names alone; ``open_dataset`` opens those of this
    library's layout.  A folder is listed once, by the driver; what is inside a dataset's parts never,
    and without ``recursive`` nothing below the children of ``root``.
    """
    found = list(_walk(spark, children(spark, resolve_location(root).rstrip("/")), recursive))
    return spark.createDataFrame(found, _FOUND)


def last_modified(spark: SparkSession, path: str) -> DataFrame:
    """One row ``(last_modified timestamp)``: see ``modified_at``."""
    return spark.createDataFrame([(modified_at(spark, resolve_location(path).rstrip("/")),)], "last_modified timestamp")
