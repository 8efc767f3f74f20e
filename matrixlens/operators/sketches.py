"""Statistics in one pass: all of them exact but for quartiles, which come from mergeable sketches.

An option for those who need not know the quartiles exactly.  Tasks sketch what they see of each
group (KLL sketches, as Spark has them) and only sketches are moved and merged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.operators.order_statistics import QUARTILES, STATISTICS

#: Fixed values of the sketch: its rank error is 2.296 / k ** 0.9723 at 99 % confidence, for k from 8 to 65535.
_FACTOR, _POWER, _LEAST, _MOST = 2.296, 0.9723, 8, 65535


def sketch_size(error: float) -> int:
    """Parameter k of sketches whose ranks are off by at most half of ``error``, as a share of the group.

    The other half is kept in hand: the sketch's own bound holds for 99 of 100 sketches, twice
    the bound practically always.
    """
    size = math.ceil((2 * _FACTOR / error) ** (1 / _POWER)) if 0 < error < 1 else 0
    if not _LEAST <= size <= _MOST:
        raise ValueError(f"the rank error must lie between 0.0001 and 0.5, got {error}")
    return size


def _at_rank(share: Column, error: float) -> Column:
    """Value of the sketch at a share that differs from group to group, to a quarter of ``error``."""
    steps = math.ceil(2 / error)
    grid = F.kll_sketch_get_quantile_double("sketch", F.lit([i / steps for i in range(steps + 1)]))
    return F.get(grid, F.round(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * steps).cast("int"))


def describe_sketched(
    values: DataFrame, keys: Sequence[str], error: float, groups: DataFrame | None = None, cells: int | None = None
) -> DataFrame:
    """As ``describe_groups``, with quartiles that are values of the group near the wanted ranks.

    A quartile is a value whose place in the sorted group is off by at most ``error`` times the group's
    size; it is not interpolated, and may differ from run to run.  A group of no more values than a
    sketch holds is sketched whole.  In sparse data (``cells``) the sketch holds the stored cells
    but zeros, and zeros are counted.
    """
    size = sketch_size(error)
    value = F.col("value")
    sketched = value if cells is None else F.when(value != 0, value)
    stats = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("present"),
        F.avg("value").alias("center"),
        F.var_pop("value").alias("var"),
        F.min("value").alias("lo"),
        F.max("value").alias("hi"),
        F.count_if(value < 0).alias("below"),
        F.count(sketched).alias("held"),
        F.kll_sketch_agg_double(sketched, F.lit(size)).alias("sketch"),
    )
    if groups is not None:
        stats = groups.join(stats, list(keys), "full").fillna(0, ["rows", "present", "below", "held"])
    error_text = F.lit("more cells are stored than there are: a cell is stored more than once")
    spare = F.lit(0).cast("bigint") if cells is None else F.lit(cells) - F.col("rows")
    stats = stats.withColumn("spare", F.when(spare < 0, F.raise_error(error_text).cast("bigint")).otherwise(spare))
    count = F.col("present") + F.col("spare")
    center = F.coalesce("center", F.lit(0.0))
    mean = center * F.col("present") / F.col("count")
    spread = F.col("present") * (F.coalesce("var", F.lit(0.0)) + F.pow(center - F.col("mean"), 2)) + F.col("spare") * F.pow("mean", F.lit(2))
    zero = F.when(F.col("spare") > 0, F.lit(0.0))

    def quartile(q: float) -> Column:
        if cells is None:
            return F.when(F.col("held") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
        rank = F.lit(q) * F.col("count")
        zeros = F.col("count") - F.col("held")
        found = F.when(rank < F.col("below"), _at_rank(rank / F.col("held"), error))
        found = found.when(rank < F.col("below") + zeros, F.lit(0.0))
        return F.when(F.col("count") > 0, found.otherwise(F.when(F.col("held") > 0, _at_rank((rank - zeros) / F.col("held"), error))))

    some = F.col("count") > 0
    stats = stats.withColumn("count", count).withColumn("mean", F.when(some, mean))
    result = {
        "nan_count": F.col("rows") - F.col("present"),
        "std": F.when(some, F.sqrt(spread / F.col("count"))),
        "min": F.least("lo", zero),
        "max": F.greatest("hi", zero),
        **{f"p{int(q * 100)}": quartile(q) for q in QUARTILES},
    }
    return stats.select(*keys, *[result[s].alias(s) if s in result else F.col(s) for s in STATISTICS])
