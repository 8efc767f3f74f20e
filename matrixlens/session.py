"""Session helpers: the settings the operators rely on, and lineage cutting."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows a side table of a few numbers may have to be broadcast: some 50 MB per executor.
#: Every broadcast hint in this library is behind a count checked against it.
BROADCAST_ROWS = 400_000


def small_side(df: DataFrame, n_rows: int) -> DataFrame:
    """The side of a join, to be broadcast if its counted rows are few enough."""
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, used for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session, where one
    machine runs everything, falls back to a temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is not None:
        return current
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="matrixlens-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


#: Operators of a plan that give the same rows each time it runs.
_REPEATABLE = re.compile(r"^[\s:+\-|]*(Project|Filter|Relation|LocalRelation|LogicalRDD|Generate|Union|Range|Expand|OneRowRelation)\b")
_RANDOM = re.compile(r"\b(rand|randn|uuid|shuffle|monotonically_increasing_id|\w*[uU][dD][fF])\b")


def repeatable(df: DataFrame) -> bool:
    """Whether reading ``df`` again surely gives the same values to the last digit.

    True for scans and what is done row by row.  Sums of floats, for one, depend on the order
    in which parts arrive.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return all(_REPEATABLE.match(line) for line in plan.splitlines() if line.strip()) and not _RANDOM.search(plan)


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Later reads survive the loss of executors and see the same rows, in the same
    partitions, every time.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
