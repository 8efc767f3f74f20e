"""Choosing features by name or glob."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from matrixlens.functions.columns import INDEX, POSITION, column
from matrixlens.functions.globs import GRAM, glob_grams, glob_match, glob_to_regex, is_plain, literal_runs, name_grams
from matrixlens.session import small_side

#: Up to so many patterns are one expression over the names; more are joined.
INLINE_PATTERNS = 50


def _by_case(names: DataFrame, patterns: list[tuple[int, str]]) -> DataFrame:
    """``(name, position, pattern_no)`` of the first of a few patterns that matches each name."""
    number = F.lit(None).cast("int")
    for i, pattern in reversed(patterns):
        number = F.when(glob_match(F.col("name"), pattern), F.lit(i)).otherwise(number)
    return names.select("name", "position", number.alias("pattern_no")).filter("pattern_no IS NOT NULL")


def _by_grams(names: DataFrame, globs: list[tuple[int, str]]) -> DataFrame:
    """``(name, position, pattern_no)`` of every match of many globs.

    What a glob says literally, its begin and end included, is cut into runs of three characters,
    and names are counted by those runs that some glob has.  A glob then meets, by an equi-join,
    only the names that have the rarest of its runs; what it meets is matched as a whole.  A glob
    that says nothing literally meets every name.  Equal globs meet them once.
    """
    spark = names.sparkSession
    numbers: dict[str, list[int]] = {}
    for i, pattern in globs:
        numbers.setdefault(pattern, []).append(i)
    forms = [(k, glob_to_regex(p), literal_runs(p), n) for k, (p, n) in enumerate(numbers.items())]
    forms = spark.createDataFrame(forms, "_glob int, _regex string, _runs array<string>, _numbers array<int>")
    asked = forms.select("_glob", F.explode(glob_grams(F.col("_runs"))).alias("_gram"))
    wanted = asked.select("_gram").distinct()
    # Few names may lie in one file; whatever their number, all cores match them.
    spread = names.repartition(spark.sparkContext.defaultParallelism, "name")
    cut = spread.select("name", "position", F.explode(name_grams(F.col("name"))).alias("_gram")).join(small_side(wanted, GRAM * sum(map(len, numbers))), "_gram")
    often = cut.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    rarest = asked.join(often, "_gram").groupBy("_glob").agg(F.count(F.lit(1)).alias("_found"), F.min(F.struct("_n", "_gram")).alias("_best"))
    # A glob with a run that no name has matches none.
    runs = asked.groupBy("_glob").agg(F.count(F.lit(1)).alias("_said"))
    side = rarest.join(runs, "_glob").where("_found = _said").join(forms, "_glob").select(F.col("_best._gram").alias("_gram"), "_regex", "_numbers")
    met = cut.join(small_side(side, len(numbers)), "_gram").filter(F.rlike("name", F.col("_regex")))
    return met.select("name", "position", F.explode("_numbers").alias("pattern_no"))


def _hits(names: DataFrame, patterns: Sequence[str], every: bool) -> DataFrame:
    """``(name, position, pattern_no)`` of matches: of every one, or at least the first of each name."""
    numbered = list(enumerate(patterns))
    if not every and len(numbered) <= INLINE_PATTERNS:
        return _by_case(names, numbered)
    plain, globs = ([(i, p) for i, p in numbered if is_plain(p) == kind] for kind in (True, False))
    side = names.sparkSession.createDataFrame(plain, "pattern_no int, name string")
    hits = names.join(small_side(side, len(plain)), "name").select("name", "position", "pattern_no")
    return hits.unionByName(_by_grams(names, globs)) if globs else hits


def match_names(names: DataFrame, patterns: Sequence[str], name: str = INDEX, position: str = POSITION) -> DataFrame:
    """``(name, pattern_no, position)`` of the names that match any pattern.

    Each name appears once, with the first pattern it matches and its first position, so
    ordering by ``pattern_no, position`` gives pattern order then item order.
    """
    numbered = names.select(column(name).alias("name"), column(position).alias("position"))
    matched = _hits(numbered, patterns, every=False)
    return matched.groupBy("name").agg(F.min("pattern_no").alias("pattern_no"), F.min("position").alias("position"))


def unmatched_patterns(names: DataFrame, patterns: Sequence[str], name: str = INDEX) -> DataFrame:
    """``(pattern_no, pattern)`` of the patterns that match no name at all."""
    item = names.select(column(name).alias("name"), F.lit(0).alias("position"))
    found = _hits(item, patterns, every=True).select("pattern_no").distinct()
    asked = names.sparkSession.createDataFrame(list(enumerate(patterns)), "pattern_no int, pattern string")
    return asked.join(found, "pattern_no", "left_anti")


def first_positions(names: DataFrame, name: str = INDEX, position: str = POSITION) -> DataFrame:
    """``(name, position)``: where each name occurs first."""
    return names.groupBy(column(name).alias("name")).agg(F.min(column(position)).alias("position"))


def arrays_to_columns(block: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(row_pos, name, ...)``: a block ``(row_pos, values)`` as a table with one column per name."""
    width = block.select(F.size("values")).first()
    if width is not None and width[0] != len(names):
        raise ValueError(f"{len(names)} names for {width[0]} columns")
    return block.select("row_pos", *[F.get("values", F.lit(i)).alias(n) for i, n in enumerate(names)])
