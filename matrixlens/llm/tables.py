"""What the operators of this package share: reading inputs and writing intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matrixlens.session import shared_folder

#: White space of the text contracts: the blank and the five ASCII controls from tab to return.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, *partitions: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the written rows.

    Cuts the lineage like a checkpoint, but columnar and compressed, so later steps read
    only the columns they need and lost executors cost no recomputation of earlier steps.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_scratch(df, *partitions))


def write_scratch(df: DataFrame, *partitions: str) -> str:
    """The new folder in shared storage that ``df`` was written to."""
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/matrixlens-llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(folder)
    if _open:
        _open[-1].append(folder)
    return folder


#: Folders written in each ``scratch`` under way.
_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """The folders written inside, which are deleted at the end, but for those taken off the list."""
    folders: list[str] = []
    _open.append(folders)
    try:
        yield folders
    finally:
        _open.pop()
    for folder in folders:
        discard(spark, folder)


def hand_on(folders: list[str]) -> str:
    """Take the folder written last off a ``scratch`` list and leave it to the one around, if any."""
    last = folders.pop()
    if len(_open) > 1:
        _open[-2].append(last)
    return last


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a folder of ``write_scratch`` that nothing will read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _UPPER.lower())


def in_fold(doc_id: str | Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
