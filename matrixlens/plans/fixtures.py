"""The driver's tables seen as annotated datasets (see FIXTURES.md).

Nothing is generated: every row derives from the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from matrixlens.components import Document, Matrix
from matrixlens.dataset import AnnotatedDataset


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _axis(df: DataFrame, position: str, index: Column, *columns: str | Column) -> DataFrame:
    return df.select(F.col(position).cast("bigint").alias("_pos"), index.alias("_index"), *columns)


def embeddings(spark: SparkSession, sf_dir: str) -> AnnotatedDataset:
    """EMB, dense: one vector per observation."""
    source = table(spark, sf_dir, "embeddings")
    obs = _axis(source, "vec_id", F.concat(F.lit("vec_"), F.col("vec_id")), "label")
    X = Matrix(source.select(F.col("vec_id").alias("row_pos"), F.col("embedding").alias("values")), "dense")
    dims = X.cells().groupBy("col_pos").agg(F.avg("value").alias("mean_value"))
    var = _axis(dims, "col_pos", F.concat(F.lit("dim_"), F.col("col_pos")), "mean_value")
    return AnnotatedDataset(obs, var, X, sizes={"var": X.width()})


def trade(spark: SparkSession, sf_dir: str) -> AnnotatedDataset:
    """TRADE, sparse: suppliers by parts."""
    lines = table(spark, sf_dir, "lineitem")
    supplier, part = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part")

    def cells(value: Column) -> Matrix:
        by = [F.col("l_suppkey").alias("row_pos"), F.col("l_partkey").alias("col_pos")]
        return Matrix(lines.groupBy(*by).agg(F.sum(value).alias("value")), "sparse")

    def lead(axis: str, within: str) -> Matrix:
        """How many lines of i belong to a group whose lowest member is j: linear, no pairs."""
        lowest = lines.groupBy(within).agg(F.min(axis).alias("col_pos"))
        edges = lines.select(within, F.col(axis).alias("row_pos")).join(lowest, within)
        counted = edges.groupBy("row_pos", "col_pos").agg(F.count(F.lit(1)).cast("double").alias("value"))
        return Matrix(counted, "sparse")

    n_lines = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    profile = supplier.join(n_lines, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(
        F.col("s_suppkey").alias("row_pos"),
        F.array("s_acctbal", F.coalesce("n", F.lit(0)).cast("double")).alias("values"),
    )
    size_price = part.select(
        F.col("p_partkey").alias("row_pos"), F.array(F.col("p_size").cast("double"), F.col("p_retailprice")).alias("values")
    )
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return AnnotatedDataset(
        _axis(supplier, "s_suppkey", F.col("s_name"), "s_nationkey", "s_acctbal"),
        _axis(
            part, "p_partkey", F.concat(F.lit("part_"), F.col("p_partkey")),
            "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
        ),
        cells(F.col("l_quantity")),
        layers={"revenue": cells(F.col("l_extendedprice") * (1 - F.col("l_discount")))},
        obsm={"profile": Matrix(profile, "dense")},
        varm={"size_price": Matrix(size_price, "dense")},
        obsp={"lead_supplier": lead("l_suppkey", "l_partkey")},
        varp={"lead_part": lead("l_partkey", "l_orderkey")},
        uns={
            "nation": _axis(nation, "n_nationkey", F.col("n_name"), "n_nationkey", "n_regionkey"),
            "region": _axis(region, "r_regionkey", F.col("r_name"), "r_regionkey"),
            "currency": Document.of(spark, "USD"),
        },
    )


def shipments(spark: SparkSession, sf_dir: str) -> AnnotatedDataset:
    """SHIP, sparse parts with integer cells, empty rows and empty columns."""
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")

    def counted(df: DataFrame, row: Column, col: Column) -> DataFrame:
        by = [row.cast("bigint").alias("row_pos"), col.cast("bigint").alias("col_pos")]
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("value"))

    number = F.col("l_linenumber")
    returned = lines.filter(F.col("l_returnflag") == "R")
    balance = F.floor((F.col("s_acctbal") + 1000) / 1000)
    return AnnotatedDataset(
        _axis(supplier, "s_suppkey", F.col("s_name"), "s_nationkey", "s_acctbal"),
        _axis(table(spark, sf_dir, "part"), "p_partkey", F.concat(F.lit("part_"), F.col("p_partkey")), "p_size"),
        layers={"lines": Matrix(counted(lines, F.col("l_suppkey"), F.col("l_partkey")), "sparse")},
        # Line numbers end at seven: the last columns are empty.
        obsm={"returns": Matrix(counted(returned, F.col("l_suppkey"), number), "sparse", (None, 12))},
        uns={"balances": Matrix(counted(supplier, F.col("s_nationkey") * 2, balance), "sparse", (60, 12))},
    )


def documents(spark: SparkSession, sf_dir: str) -> AnnotatedDataset:
    """DOCS: documents with labels, which many of them lack."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels, "doc_id", "left")
    index = F.concat(F.lit("doc_"), F.col("doc_id"))
    return AnnotatedDataset(_axis(joined, "doc_id", index, "lang", "source", "n_chars", "quality", "toxic"))


def events(spark: SparkSession, sf_dir: str) -> AnnotatedDataset:
    """EVENTS: the event log; low values are additionally given as NaN."""
    source = table(spark, sf_dir, "events")
    with_nan = F.when(F.col("value") < 5, F.lit(float("nan"))).otherwise(F.col("value"))
    index = F.concat(F.lit("event_"), F.col("event_id"))
    return AnnotatedDataset(_axis(source, "event_id", index, "event_type", "value", with_nan.alias("partial"), "props"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A variable table whose names repeat."""
    return _axis(table(spark, sf_dir, "part"), "p_partkey", F.col("p_name"), "p_brand", "p_type", "p_size")
