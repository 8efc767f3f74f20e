"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from matrixlens.dataset import AnnotatedDataset
from matrixlens.functions.nested import nested_value
from matrixlens.operators import table_stats
from matrixlens.operators.order_statistics import describe_groups
from matrixlens.operators.positions import assign_positions
from matrixlens.operators.predicates import filter_rows, mask
from matrixlens.operators.selection import arrays_to_columns, first_positions, match_names, unmatched_patterns
from matrixlens.operators.slicing import TOP_ROWS, slice_rows
from matrixlens.plans import fixtures
from matrixlens.sources.catalog import locate_datasets, modified_at
from matrixlens.sources.csv import array_lines, table_lines
from matrixlens.sources.layout import NAMES, open_dataset, write_dataset
from matrixlens.session import shared_folder, small_side, stable

Query = Callable[[SparkSession, str], DataFrame]

#: Filters shown on the documents: query name to (column, operator, value).
FILTERS: dict[str, tuple[str, str, Any]] = {
    "filter_eq": ("quality", "==", 1),
    "filter_ne": ("quality", "!=", 1),
    "filter_gt": ("n_chars", ">", "2000"),
    "filter_ge": ("quality", ">=", 0.5),
    "filter_lt": ("quality", "<", 1),
    "filter_le": ("n_chars", "<=", 2000.5),
    "filter_isin": ("lang", "isin", ["de", "fr", 3.0]),
    "filter_notin": ("quality", "notin", [1]),
}
DOC_COLUMNS = ["n_chars", "quality", "toxic", "lang", "source"]
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_CATEGORIES = ["l_returnflag", "l_linestatus", "l_shipdate"]
PATTERNS = ["part_1?", "part_7", "part_*[05]", "nothing_*", "part_1*"]
FEATURES = ["part_1?", "part_7", "part_2[0-4]"]


def rounded(df: DataFrame, mean: int = 5) -> DataFrame:
    """Statistics rounded to digits that do not depend on the order of summation."""
    digits = {"mean": mean, "std": 4, **dict.fromkeys(("min", "p25", "p50", "p75", "max"), 6)}
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _doc_filter(triple: tuple[str, str, Any]) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return filter_rows(fixtures.documents(spark, sf).obs, *triple)

    return run


def _flattened(block: DataFrame) -> DataFrame:
    """``(row_pos, col_no, value)`` of a block, to compare it cell by cell."""
    cells = block.select("row_pos", F.posexplode("values").alias("col_no", "value"))
    value = F.round(F.col("value").cast("double"), 6).alias("value")
    return cells.select("row_pos", F.col("col_no").cast("bigint").alias("col_no"), value)


def filter_nan_guard(spark: SparkSession, sf: str) -> DataFrame:
    return filter_rows(fixtures.events(spark, sf).obs.select("_pos", "value", "partial"), "partial", ">", 50).drop("partial")


def filter_index(spark: SparkSession, sf: str) -> DataFrame:
    return filter_rows(fixtures.embeddings(spark, sf).obs, "index", "isin", ["vec_3", "vec_17", "vec_x"])


def filter_type_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    obs = fixtures.documents(spark, sf).obs
    equal, unequal = mask(obs.schema, "n_chars", "==", "many"), mask(obs.schema, "quality", "!=", "good")
    return obs.select("_pos", equal.alias("equal"), unequal.alias("unequal"))


def filter_long_list(spark: SparkSession, sf: str) -> DataFrame:
    obs = fixtures.documents(spark, sf).obs.select("_pos", "n_chars")
    return filter_rows(obs, "n_chars", "notin", list(range(2000)))


def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(table_stats.describe_table(fixtures.table(spark, sf, "lineitem"), LINE_COLUMNS), mean=4)


def describe_categorical(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(table_stats.describe_table(fixtures.table(spark, sf, "lineitem"), LINE_CATEGORIES))


def describe_mixed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.documents(spark, sf).describe("obs", columns=DOC_COLUMNS))


def describe_all_missing(spark: SparkSession, sf: str) -> DataFrame:
    obs = fixtures.documents(spark, sf).obs.filter("quality IS NULL")
    gone = obs.select("quality", F.when(F.col("quality") == 1, F.col("lang")).alias("good_lang"), "n_chars")
    return rounded(table_stats.describe_table(gone))


def describe_with_nan(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.events(spark, sf).describe("obs", columns=["value", "partial"]))


def describe_filtered(spark: SparkSession, sf: str) -> DataFrame:
    bought = fixtures.events(spark, sf).where("obs", "event_type", "==", "purchase")
    return rounded(bought.describe("obs", columns=["value", "event_type"]))


def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    obs = fixtures.documents(spark, sf).obs
    grade = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "bad")
    return table_stats.value_counts(obs.withColumn("grade", grade), ["lang", "source", "grade", "n_chars"])


def value_counts_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).where("obs", "quality", "==", 1).value_counts("obs", columns=["lang", "source"])


def matrix_describe_all(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.embeddings(spark, sf).describe("X"))


def matrix_describe_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.embeddings(spark, sf).describe("X", axis=0))


def matrix_describe_by_obs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.embeddings(spark, sf).describe("X", axis=1))


def matrix_describe_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("X"))


def matrix_describe_sparse_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("X", axis=0))


def matrix_describe_sparse_by_obs(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("X", axis=1))


def layer_describe_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("layers", "revenue", columns=FEATURES), mean=2)


def features_of_dense(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.embeddings(spark, sf).describe("X", columns=["dim_6*", "dim_0"]))


def obs_filter_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).where("obs", "s_acctbal", ">", 4000).describe("X"))


def var_filter_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).where("var", "p_type", "==", "PROMO").describe("X", axis=0))


def var_filter_dense(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.embeddings(spark, sf).where("var", "mean_value", ">", 0).describe("X"))


def both_axes(spark: SparkSession, sf: str) -> DataFrame:
    some = fixtures.trade(spark, sf).where("obs", "s_nationkey", "<", 12).where("var", "p_brand", "isin", ["Brand#2", "Brand#17"])
    return rounded(some.describe("layers", "revenue"), mean=2)


def obs_filter_pairwise(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).where("obs", "s_acctbal", ">", 4000).describe("obsp", "lead_supplier"))


def obs_filter_var_table(spark: SparkSession, sf: str) -> DataFrame:
    some = fixtures.trade(spark, sf).where("obs", "s_acctbal", ">", 4000)
    return rounded(some.describe("var", columns=["p_size", "p_type"]))


def obsm_describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).where("obs", "s_nationkey", "!=", 3).describe("obsm", "profile"))


def varm_describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("varm", "size_price", axis=0))


def obsp_describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("obsp", "lead_supplier"))


def varp_describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("varp", "lead_part", axis=1))


def uns_describe(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(fixtures.trade(spark, sf).describe("uns", "nation"))


def glob_columns(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trade(spark, sf).view("var", columns=["p_[bt]*", "p_s?ze", "absent*"], rows=(None, None))


def glob_features(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trade(spark, sf).features(PATTERNS)


def glob_order_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return match_names(fixtures.parts(spark, sf), ["*bolt", "small *", "red bolt", "[!a-p]* ring"])


def glob_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return unmatched_patterns(fixtures.parts(spark, sf), ["*bolt", "xyz*", "small ?ing", "small ring", "abc"])


def name_to_position_first(spark: SparkSession, sf: str) -> DataFrame:
    return first_positions(fixtures.parts(spark, sf))


def view_table_slice(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).view("obs", columns=["lang", "n_chars"], rows=(10, 25))


def view_filtered_slice(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).view("obs", rows=(2, 12), where=("quality", "notin", [1]))


def view_deep_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The last third of the filtered rows: ends found by rank, not by sorting everything."""
    rows = filter_rows(fixtures.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "_pos"), "o_orderstatus", "!=", "F")
    n = rows.count()
    return slice_rows(rows, (n - n // 3, n + TOP_ROWS), gaps=True)


def view_strided(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).view("obs", columns=["lang"], rows=(3, None, 7))


def view_strided_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).view("obs", columns=["lang"], rows=(None, None, -5), where=("lang", "!=", "en"))


def view_negative_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.documents(spark, sf).view("obs", columns=["source"], rows=(-30, -10))


def view_matrix_block(spark: SparkSession, sf: str) -> DataFrame:
    return _flattened(fixtures.embeddings(spark, sf).view("X", rows=(5, 15), cols=(60, 70)))


def view_sparse_block(spark: SparkSession, sf: str) -> DataFrame:
    return _flattened(fixtures.trade(spark, sf).view("X", rows=(0, 20), cols=(10, 40)))


def view_matrix_features(spark: SparkSession, sf: str) -> DataFrame:
    return _flattened(fixtures.embeddings(spark, sf).view("X", columns=["dim_6?", "dim_1"], rows=(0, 10)))


def view_sparse_features(spark: SparkSession, sf: str) -> DataFrame:
    return _flattened(fixtures.trade(spark, sf).view("layers", "revenue", columns=FEATURES, rows=(None, None)))


def view_filtered_dataset(spark: SparkSession, sf: str) -> DataFrame:
    some = fixtures.trade(spark, sf).where("obs", "s_acctbal", ">", 4000).where("var", "p_type", "==", "PROMO")
    return _flattened(some.view("X", rows=(3, 13), cols=(2, 12)))


def view_shapes(spark: SparkSession, sf: str) -> DataFrame:
    ds = fixtures.documents(spark, sf)
    return ds.view_shape("obs", columns=["lang", "n_*"], rows=(0, 50), where=("quality", "==", 1))


def document_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Text of a mapping built from the data: the highest event count by type, as JSON."""
    counts = fixtures.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    from matrixlens.components import Document

    # One entry per event type, a handful by design.
    entries = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("m"))
    doc = Document.from_json(entries.select(F.to_json("m").alias("value")))
    return doc.entries()


def nested_key(spark: SparkSession, sf: str) -> DataFrame:
    obs = fixtures.events(spark, sf).obs
    k = nested_value(F.col("props"), obs.schema["props"].dataType, ["k"], "bigint")
    return obs.groupBy(k.alias("k")).agg(F.count(F.lit(1)).alias("n"))


def section_listing(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trade(spark, sf).view("uns")


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.trade(spark, sf).summary()


def csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    nation = fixtures.trade(spark, sf).get("uns", "nation")
    return table_lines(nation)


def csv_block(spark: SparkSession, sf: str) -> DataFrame:
    return array_lines(fixtures.trade(spark, sf).view("X", rows=(None, None), cols=(0, 8)))


def matrix_to_columns(spark: SparkSession, sf: str) -> DataFrame:
    block = fixtures.embeddings(spark, sf).view("X", columns=["dim_3", "dim_41"], rows=(None, None))
    wide = arrays_to_columns(block, ["dim_3", "dim_41"])
    return wide.select("row_pos", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("dim_3", "dim_41")])


def view_column_list(spark: SparkSession, sf: str) -> DataFrame:
    return _flattened(fixtures.embeddings(spark, sf).view("X", rows=(None, None), cols=[9, 2, 33]))


def named_cells(spark: SparkSession, sf: str) -> DataFrame:
    cells = fixtures.trade(spark, sf).named_cells("layers", "revenue")
    return cells.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 4).alias("largest"))


def distributed_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """The bin-by-bin algorithm itself, whatever the size."""
    lines = fixtures.table(spark, sf, "lineitem")
    return rounded(describe_groups(lines.select("l_linestatus", F.col("l_extendedprice").alias("value")), ["l_linestatus"]), mean=2)


def _within(df: DataFrame, stats: DataFrame, keys: list[str], error: float) -> DataFrame:
    """Statistics with, for each approximate quartile, whether its rank in the data is as near as it must be."""
    places = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    # A few rows of statistics, known once: a sketch made again may say something else.
    stats = stable(stats)
    # Few keys have many values each: the statistics go to the values, not all values of a key to one task.
    stats = small_side(stats, stats.count())
    met = df.join(stats, keys).groupBy(*keys).agg(
        F.count("value").alias("_n"),
        *[F.count_if(F.col("value") < F.col(p)).alias(f"_lt_{p}") for p in places],
        *[F.count_if(F.col("value") <= F.col(p)).alias(f"_le_{p}") for p in places],
    )
    near = [
        ((F.col(f"_lt_{p}") / F.col("_n") - error <= q) & (q <= F.col(f"_le_{p}") / F.col("_n") + error)).alias(f"{p}_near")
        for p, q in places.items()
    ]
    return stats.join(met, keys).select(*keys, "count", "nan_count", F.round("mean", 2).alias("mean"), F.round("std", 2).alias("std"), "min", "max", *near)


def describe_numeric_sketched(spark: SparkSession, sf: str) -> DataFrame:
    """Quartiles to one in a hundred ranks, against the ranks they have."""
    lines = fixtures.table(spark, sf, "lineitem").select(*LINE_COLUMNS)
    stats = table_stats.describe_table(lines, error=0.01)
    return _within(lines.unpivot([], LINE_COLUMNS, "column", "value"), stats, ["column"], 0.01)


def matrix_sketched_by_feature(spark: SparkSession, sf: str) -> DataFrame:
    """The same of a sparse matrix, its zeros included."""
    ds = fixtures.trade(spark, sf)
    stats = ds.describe("layers", "revenue", axis=0, error=0.02)
    stored = ds.get("layers", "revenue").cells()
    # Ranks among all cells: those not stored are one row with a weight.
    stored = stored.join(stable(stats.select("col_pos", "p25", "p50", "p75")), "col_pos")
    zeros = F.lit(ds.n_obs) - F.count(F.lit(1))
    marks = [
        F.struct(
            (F.count_if(F.col("value") < F.col(p)) + F.when(F.max(p) > 0, zeros).otherwise(0)).alias("lt"),
            (F.count_if(F.col("value") <= F.col(p)) + F.when(F.max(p) >= 0, zeros).otherwise(0)).alias("le"),
        ).alias(p)
        for p in ("p25", "p50", "p75")
    ]
    met = stored.groupBy("col_pos").agg(*marks)
    near = [
        ((F.col(f"{p}.lt") / ds.n_obs - 0.02 <= q) & (q <= F.col(f"{p}.le") / ds.n_obs + 0.02)).alias(f"{p}_near")
        for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
    ]
    return met.select("col_pos", *near)


def positions_by_order(spark: SparkSession, sf: str) -> DataFrame:
    customers = fixtures.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return assign_positions(customers, "c_acctbal", "c_custkey")


def stored_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Write a dataset, find it, open it again and describe a layer."""
    folder = _scratch(spark)
    write_dataset(fixtures.trade(spark, sf), f"{folder}/trade")
    return rounded(open_dataset(spark, f"{folder}/trade").describe("layers", "revenue", axis=1), mean=2)


def stored_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Describe features of a dense matrix that is stored in tiles of ten columns."""
    folder = _scratch(spark)
    write_dataset(fixtures.embeddings(spark, sf), f"{folder}/emb", tile=10)
    return rounded(open_dataset(spark, f"{folder}/emb").describe("X", columns=["dim_6*", "dim_0"]))


def stored_names(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by name, out of a stored dataset and its side table of names."""
    folder = _scratch(spark)
    write_dataset(fixtures.documents(spark, sf), f"{folder}/docs")
    ds = open_dataset(spark, f"{folder}/docs")
    few = ds.where("obs", "lang", "!=", "xx").where("obs", "index", "isin", ["doc_3", "doc_17", "doc_150", "doc_x", 7]).obs
    return few.unionByName(ds.where("obs", "index", "==", "doc_42").obs)


def stored_names_of_table(spark: SparkSession, sf: str) -> DataFrame:
    """Positions of the documents that have a label, by their names."""
    folder = _scratch(spark)
    write_dataset(fixtures.documents(spark, sf), f"{folder}/docs")
    named = fixtures.table(spark, sf, "labels").select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("name"))
    return open_dataset(spark, f"{folder}/docs").positions_of(named, "obs")


def stored_name_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Where each of many names, some of which repeat, occurs first among the parts."""
    folder = _scratch(spark)
    write_dataset(AnnotatedDataset(fixtures.parts(spark, sf)), f"{folder}/parts")
    there = [f"{size} {thing}" for size in ("red", "small", "hot") for thing in ("plate", "ring", "rod", "widget")]
    return open_dataset(spark, f"{folder}/parts").positions_of([*there, *(f"absent {i}" for i in range(1500))], "obs")


def locate(spark: SparkSession, sf: str) -> DataFrame:
    folder = _scratch(spark)
    write_dataset(fixtures.documents(spark, sf), f"{folder}/docs")
    write_dataset(fixtures.events(spark, sf), f"{folder}/deeper/events")
    found = locate_datasets(spark, folder)
    return found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "kind")


def filter_long_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Days of one month out of three, among more text that is no date."""
    lines = fixtures.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"))
    days = [f"{1990 + i // 360}-{1 + i // 30 % 12:02d}-{1 + i % 28:02d}" for i in range(0, 3600, 3)]
    return filter_rows(lines, "day", "isin", [*days, *(f"no day {i}" for i in range(1500)), "1995-01", "1996-W01-1"])


def filter_long_notin_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Low values are NaN here; a list with NaN drops them as well."""
    obs = fixtures.events(spark, sf).obs.select("_pos", "partial")
    return filter_rows(obs, "partial", "notin", [*(i / 100 for i in range(3000)), float("nan")])


def filter_decimal(spark: SparkSession, sf: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(14,2)").alias("price")
    lines = fixtures.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", price)
    return filter_rows(filter_rows(lines, "price", ">", 20000.005), "price", "<=", 40000)


def sparse_obsm_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Empty rows and columns count after a filter too: cells of the whole width, and their statistics."""
    ds = fixtures.shipments(spark, sf).where("obs", "s_nationkey", "!=", 3)
    stats = ds.describe("obsm", "returns", axis=0).select("col_pos", "count", F.round("mean", 4).alias("mean"), "max")
    block = _flattened(ds.view("obsm", "returns", rows=(None, None), cols=(None, None)))
    total = block.groupBy(F.col("col_no").alias("col_pos")).agg(F.count("value").alias("viewed"), F.sum("value").alias("total"))
    return stats.join(total, "col_pos")


def sparse_uns_by_row(spark: SparkSession, sf: str) -> DataFrame:
    stats = fixtures.shipments(spark, sf).describe("uns", "balances", axis=1)
    return stats.select("row_pos", "count", F.round("mean", 5).alias("mean"), F.round("p75", 6).alias("p75"), "max")


def view_integer_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Counts stay whole numbers in a view and in its text."""
    block = fixtures.shipments(spark, sf).view("layers", "lines", rows=(0, 30), cols=(5, 25))
    return block.join(array_lines(block), "row_pos").select("row_pos", F.get("values", F.lit(3)).alias("third"), "line")


def obs_filter_most_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Most observations stay, and two filters of one axis are one."""
    some = fixtures.trade(spark, sf).where("obs", "s_acctbal", ">", -500).where("obs", "s_nationkey", "!=", 7)
    return rounded(some.describe("X"), mean=4)


def glob_many(spark: SparkSession, sf: str) -> DataFrame:
    """Thousands of names and globs at once."""
    globs = [p for i in range(1000) for p in (f"part_{i}7*", f"part_?{i % 100}", f"part_{3 * i}", f"none_{i}*", f"*{i:03d}4")]
    return fixtures.trade(spark, sf).features(globs)


def refusals(spark: SparkSession, sf: str) -> DataFrame:
    """What is refused: filters that leave nothing, incomplete ones, unknown names and operators."""
    ds = fixtures.documents(spark, sf)
    trade = fixtures.trade(spark, sf)
    cases: dict[str, Callable[[], Any]] = {
        "no observation left": lambda: ds.where("obs", "n_chars", "<", 0).describe("obs"),
        "no variable left": lambda: trade.where("var", "p_size", ">", 1e9).describe("X"),
        "no row left in a view": lambda: ds.view("obs", where=("lang", "==", "xx")),
        "some rows left": lambda: ds.where("obs", "n_chars", ">=", 0).describe("obs", columns=["n_chars"]),
        "incomplete filter": lambda: ds.where("obs", "n_chars", "<", None),
        "unknown column": lambda: ds.where("obs", "nothing", "==", 1).describe("obs"),
        "unknown operator": lambda: ds.where("obs", "lang", "~", "e").describe("obs"),
        "list for one value": lambda: ds.where("obs", "lang", "==", ["en"]).describe("obs"),
        "text for a number": lambda: ds.where("obs", "n_chars", ">", "many").describe("obs"),
        "order of texts": lambda: ds.where("obs", "lang", ">", 1).describe("obs"),
        "no feature asked for": lambda: trade.describe("X", columns=[]),
    }

    def raised(case: Callable[[], Any]) -> bool:
        try:
            case()
        except (KeyError, TypeError, ValueError):
            return True
        return False

    rows = [(name, raised(case)) for name, case in cases.items()]
    return spark.createDataFrame(rows, "case string, raised boolean")


def modified(spark: SparkSession, sf: str) -> DataFrame:
    """Write a dataset; its time is its manifest's, and lies between beginning and end of the writing."""
    folder = f"{_scratch(spark)}/docs"
    before = datetime.now(timezone.utc).replace(microsecond=0)
    ds = fixtures.documents(spark, sf)
    write_dataset(ds, folder)
    # The index of names is listed there too, but is no part.
    parts = spark.read.parquet(f"{folder}/manifest").where(F.col("kind") != NAMES)
    manifest = parts.select(F.col("_metadata.file_modification_time").alias("written"), "n_rows")
    found = modified_at(spark, folder)
    in_time = before <= found <= datetime.now(timezone.utc) + timedelta(seconds=1)
    return manifest.select((F.col("written") == F.lit(found)).alias("of_manifest"), F.lit(in_time).alias("in_time"), "n_rows")


def _scratch(spark: SparkSession) -> str:
    """A new folder in shared storage."""
    import uuid

    return f"{shared_folder(spark)}/matrixlens-{uuid.uuid4().hex}"


def registered() -> dict[str, Query]:
    found: dict[str, Query] = {name: _doc_filter(triple) for name, triple in FILTERS.items()}
    for query in (
        filter_nan_guard, filter_index, filter_type_mismatch, filter_long_list,
        describe_numeric, describe_categorical, describe_mixed, describe_all_missing, describe_with_nan,
        describe_filtered, value_counts, value_counts_filtered,
        matrix_describe_all, matrix_describe_by_feature, matrix_describe_by_obs,
        matrix_describe_sparse, matrix_describe_sparse_by_feature, matrix_describe_sparse_by_obs,
        layer_describe_features, features_of_dense,
        obs_filter_matrix, var_filter_matrix, var_filter_dense, both_axes, obs_filter_pairwise, obs_filter_var_table,
        obsm_describe, varm_describe, obsp_describe, varp_describe, uns_describe,
        glob_columns, glob_features, glob_order_dedup, glob_unmatched, name_to_position_first,
        view_table_slice, view_filtered_slice, view_deep_slice, view_strided, view_strided_filtered,
        view_negative_bounds, view_matrix_block, view_sparse_block, view_matrix_features, view_sparse_features,
        view_filtered_dataset, view_shapes, document_entries, nested_key, section_listing, summary,
        csv_rows, csv_block, matrix_to_columns, view_column_list, named_cells, distributed_quartiles, positions_by_order,
        describe_numeric_sketched, matrix_sketched_by_feature,
        stored_dataset, stored_tiles, stored_names, stored_names_of_table, stored_name_positions, locate, filter_long_dates, filter_long_notin_missing, filter_decimal,
        sparse_obsm_filtered, sparse_uns_by_row, view_integer_layer, obs_filter_most_rows, glob_many, refusals,
    ):
        found[query.__name__] = query
    found["last_modified"] = modified
    return found
