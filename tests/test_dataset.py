"""Datasets: statistics, filters over both axes, views, summary, storage, discovery."""

from __future__ import annotations

import datetime
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from matrixlens import AnnotatedDataset, Matrix, locate_datasets, open_dataset, session, vacuum_dataset, write_dataset
from matrixlens.operators import alignment, matrix_stats, table_stats
from matrixlens.operators.alignment import KeptPositions
from matrixlens.plans import queries
from matrixlens.sources.catalog import last_modified
from matrixlens.sources.csv import array_lines, table_lines, write_block, write_table
from matrixlens.sources.layout import resolve_location
from matrixlens.sources.names import rows_named
from tests.sample import N_OBS, N_VARS, sparse
from tests.test_statistics import assert_stats


def whole(row, values):
    values = np.asarray(values, dtype=float)
    assert_stats({**row.asDict(), "nan_count": int(np.isnan(values).sum())}, np.ravel(values))


def cells(block):
    rows = block.orderBy("row_pos").collect()
    return [r["row_pos"] for r in rows], np.array([r["values"] for r in rows], dtype=float)


def same(block, values):
    assert np.allclose(cells(block)[1], values, equal_nan=True)


@pytest.fixture(params=["small", "large"])
def path(request, monkeypatch):
    if request.param == "large":
        monkeypatch.setattr(matrix_stats, "SORTED_ROWS", 1)
        monkeypatch.setattr(table_stats, "SORTED_ROWS", 1)


@pytest.fixture(params=["positions", "bitmap", "shuffle"])
def alignment_by(request, monkeypatch):
    if request.param != "positions":
        monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    if request.param == "shuffle":
        monkeypatch.setattr(alignment, "BITMAP_BYTES", 0)
    return request.param


def test_statistics_of_every_part(sample, path):
    ds = sample.ds
    for section, key, values in [
        ("X", None, sample.readings), ("layers", "detections", sample.detections), ("layers", "whole", sample.detections), ("obsm", "profile", sample.profile),
        ("obsm", "species", sample.species), ("varm", "weights", sample.weights), ("obsp", "flow", sample.flow), ("varp", "affinity", sample.affinity), ("uns", "calendar", sample.calendar),
    ]:
        whole(ds.describe(section, key).first(), values)
    for row in ds.describe("obs", columns=["depth", "vis*"]).collect():
        assert_stats(row, sample.obs[row["column"]].astype(float))
    for row in ds.describe("uns", "log").collect():
        assert_stats(row, sample.visits[row["column"]])


@pytest.mark.parametrize("axis, name", [(0, "col_pos"), (1, "row_pos")])
@pytest.mark.parametrize("section, key", [("X", None), ("layers", "detections"), ("obsm", "species"), ("uns", "calendar"), ("varm", "weights")])
def test_statistics_along_an_axis(sample, path, axis, name, section, key):
    values = {"X": sample.readings, "layers": sample.detections, "obsm": sample.species, "uns": sample.calendar, "varm": sample.weights}[section].astype(float)
    lines = values.T if axis == 0 else values
    rows = {r[name]: r for r in sample.ds.describe(section, key, axis=axis).collect()}
    assert sorted(rows) == list(range(len(lines)))
    for position, row in rows.items():
        assert_stats(row, lines[position])


def test_statistics_of_features(sample):
    rows = sample.ds.describe("X", columns=["oil-03", "metal-0[2-4]", "lead*", "metal-*"]).collect()
    assert [r["column"] for r in rows] == ["oil-03", "metal-02", "metal-03", "metal-04", *(f"metal-0{i}" for i in (0, 1, 5, 6, 7, 8, 9))]
    for row in rows:
        assert_stats(row, sample.readings[:, list(sample.var.index).index(row["column"])])
    with pytest.raises(ValueError, match="no variable matches"):
        sample.ds.describe("X", columns=["lead*"])
    with pytest.raises(ValueError, match="empty list"):
        sample.ds.describe("layers", "whole", columns=[])


FILTERS = [
    ("depth", ">=", 4, lambda o: o.depth >= 4),
    ("depth", "!=", 4.0, lambda o: o.depth != 4.0),
    ("basin", "notin", ["oder", "elbe"], lambda o: ~o.basin.isin(["oder", "elbe"])),
    ("basin", "isin", ["rhine", None], lambda o: o.basin.isin(["rhine"]) | o.basin.isna()),
    ("automatic", "==", 1, lambda o: o.automatic),
    ("index", "isin", ["km 4", "km 190", "km 5"], lambda o: o.index.isin(["km 4", "km 190"])),
]


@pytest.mark.parametrize("name, op, value, keep", FILTERS)
def test_station_filters_reach_every_part(sample, name, op, value, keep):
    kept = np.asarray(keep(sample.obs), dtype=bool)
    ds = sample.ds.where("obs", name, op, value)
    assert (ds.n_obs, ds.n_vars) == (kept.sum(), N_VARS)
    whole(ds.describe("X").first(), sample.readings[kept])
    whole(ds.describe("obsp", "flow").first(), sample.flow[kept][:, kept])
    whole(ds.describe("obsm", "species").first(), sample.species[kept])
    assert ds.get("obsm", "log").count() == kept.sum()
    assert ds.get("uns", "log").count() == N_OBS


def test_alignment_three_ways(sample, alignment_by):
    rows, cols = (sample.obs.visits > 15).to_numpy(), (sample.var.limit < 6).to_numpy()
    ds = sample.ds.where("obs", "visits", ">", 15).where("var", "limit", "<", 6).where("obs", "visits", "!=", 18)
    rows &= (sample.obs.visits != 18).to_numpy()
    whole(ds.describe("layers", "detections").first(), sample.detections[rows][:, cols])
    whole(ds.describe("varp", "affinity").first(), sample.affinity[cols][:, cols])
    whole(ds.describe("obsp", "flow").first(), sample.flow[rows][:, rows])
    plan = ds.get("obsp", "flow").df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    where, block = cells(ds.view("layers", "detections", rows=(1, 9), cols=(2, 7)))
    assert where == np.flatnonzero(rows)[1:9].tolist() and np.array_equal(block, sample.detections[rows][:, cols][1:9, 2:7])


def test_bitmap_moves_no_matrix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 0)
    spark.range(300_000).select(F.col("id").alias("row_pos"), F.lit(1.0).alias("value")).write.parquet(str(tmp_path / "m"))
    positions = spark.range(0, 300_000, 3).select(F.col("id").alias("_pos")).union(spark.createDataFrame([(1,), (299_999,), (32_767,), (32_768,)], "_pos long")).distinct()
    left = KeptPositions(positions).rows_of(spark.read.parquet(str(tmp_path / "m")), "row_pos")
    plan = left._jdf.queryExecution().executedPlan().toString()
    stream = plan.split("BroadcastHashJoin", 1)[1].split("BroadcastExchange", 1)[0]
    assert "Exchange" not in stream and "PushedFilters: [IsNotNull(row_pos), GreaterThanOrEqual(row_pos,0)" in plan
    assert left.columns == ["row_pos", "value"]
    assert sorted(r[0] for r in left.select("row_pos").collect()) == sorted({*range(0, 300_000, 3), 1, 299_999, 32_767, 32_768})


def test_widths_survive_filters(sample):
    few = sample.ds.where("obs", "index", "isin", ["km 1", "km 4", "km 16"])
    same(few.view("obsm", "species", rows=(None, None), cols=(None, None)), sample.species[[0, 1, 5]])
    assert few.describe("obsm", "species").first()["count"] == 3 * 14
    assert few.view_shape("obsm", "species").first()["full_shape"] == "(3, 14)"
    same(sample.ds.view("uns", "calendar", rows=(0, 7), cols=(1, 7)), sample.calendar[:7, 1:7])
    none = sample.ds.where("obs", "visits", "<", 0)
    assert none.view_shape("obsm", "profile").first()["full_shape"] == "(0, 6)"


def test_sparse_parts_state_the_lengths_no_axis_gives(spark, sample):
    loose = sparse(spark, np.eye(3))
    ds = AnnotatedDataset(sample.ds.obs, sample.ds.var, obsm={"loose": loose}, uns={"loose": loose})
    for section in ("obsm", "uns"):
        with pytest.raises(ValueError, match="must state its shape"):
            ds.describe(section, "loose")


def test_repeated_cells_add_up_or_are_refused(spark, sample):
    stored = spark.createDataFrame([(0, 0, 2), (0, 0, 5), (1, 2, 1), (1, 2, -1), (1, 1, 4)], "row_pos long, col_pos long, value long")
    values = np.array([[7, 0, 0], [0, 4, 0]])
    obs, var = sample.ds.obs.filter("_pos < 2"), sample.ds.var.filter("_pos < 3")
    ds = AnnotatedDataset(obs, var, Matrix(stored, "sparse", repeated=True))
    whole(ds.describe("X").first(), values)
    same(ds.view("X", rows=(0, 2), cols=(0, 3)), values)
    strict = AnnotatedDataset(obs, var, Matrix(stored, "sparse"))
    with pytest.raises(Exception, match="stored more than once"):
        strict.view("X", rows=(0, 2), cols=(0, 3)).collect()
    crowded = spark.createDataFrame([(0, 0, 2)] * 9, "row_pos long, col_pos long, value long")
    with pytest.raises(Exception, match="stored more than once"):
        AnnotatedDataset(obs, var, Matrix(crowded, "sparse")).describe("X").collect()


def test_explicit_zeros_are_cells(spark, sample):
    stored = spark.createDataFrame([(0, 0, 0.0), (1, 2, -3.0)], "row_pos long, col_pos long, value double")
    ds = AnnotatedDataset(sample.ds.obs.filter("_pos < 2"), sample.ds.var.filter("_pos < 3"), Matrix(stored, "sparse"))
    whole(ds.describe("X").first(), [[0, 0, 0], [0, 0, -3]])


def test_filters_that_leave_nothing(sample):
    for axis, name, section in (("obs", "visits", "var"), ("var", "limit", "X")):
        with pytest.raises(ValueError, match="leaves no"):
            sample.ds.where(axis, name, "<", -1).describe(section)
    with pytest.raises(ValueError, match="leaves no rows"):
        sample.ds.view("obs", where=("basin", "==", "danube"))


@pytest.mark.parametrize(
    "error, text, call",
    [
        (KeyError, "'varm' has nothing at loadings", lambda ds: ds.describe("varm", "loadings")),
        (KeyError, "no section 'weather'", lambda ds: ds.view("weather")),
        (ValueError, "have no keys", lambda ds: ds.describe("var", "limit")),
        (ValueError, "neither a table nor a matrix", lambda ds: ds.describe("uns", "survey")),
        (ValueError, "key required", lambda ds: ds.describe("layers", columns=["oil-01"])),
        (ValueError, "cannot be selected", lambda ds: ds.view("obsm", "profile", columns=["oil-01"])),
        (ValueError, "only tables", lambda ds: ds.view("layers", "whole", where=("depth", ">", 1))),
        (ValueError, "missing: filter_value", lambda ds: ds.where("obs", "depth", ">", None)),
        (ValueError, "missing: filter_column, filter_value", lambda ds: ds.view("obs", where=(None, "==", None))),
        (ValueError, "no column matches", lambda ds: ds.view("var", columns=["?"])),
        (ValueError, "no variable matches", lambda ds: ds.view("X", columns=["salt"])),
        (ValueError, "must be 'obs' or 'var'", lambda ds: ds.where("X", "depth", ">", 1)),
    ],
)
def test_what_is_refused(sample, error, text, call):
    with pytest.raises(error, match=text):
        call(sample.ds)


def test_table_views(sample):
    ds = sample.ds
    assert ds.view("obs").columns == ["_index", "basin", "depth", "visits", "automatic"]
    assert ds.view("obs", columns=["[dv]*", "basin"]).columns == ["_index", "depth", "visits", "basin"]
    assert [r[0] for r in ds.view("var", rows=(-2, None)).collect()] == ["oil-08", "oil-09"]
    got = ds.view("obs", rows=(2, 5), where=("basin", "==", "rhine")).toPandas()
    assert got["_index"].tolist() == sample.obs[sample.obs.basin == "rhine"].index[2:5].tolist()
    assert [r["visits"] for r in ds.view("obs", "visits", rows=(10, 14)).collect()] == sample.obs.visits[10:14].tolist()
    assert ds.view("obsm", "log", rows=(60, 90)).count() == 4


def test_matrix_views(sample):
    ds = sample.ds
    where, _ = cells(ds.view("X"))
    assert where == [0, 1, 2, 3, 4]
    same(ds.view("X"), sample.readings[:5, :5])
    same(ds.view("layers", "detections", rows=(60, 99), cols=(-4, None)), sample.detections[60:, -4:])
    same(ds.view("obsp", "flow", rows=(2, 50, 7), cols=[63, 0, 8]), sample.flow[2:50:7][:, [63, 0, 8]])
    same(ds.view("X", columns=["salt-0[89]", "metal-05"], rows=(0, 6)), sample.readings[:6][:, [18, 19, 5]])
    same(ds.view("layers", "detections", columns=["oil-*", "salt-01"], rows=(0, 9)), sample.detections[:9][:, [*range(20, 30), 11]])
    assert cells(ds.view("uns", "drift", rows=(9, 20)))[1].shape == (2, 3)


def test_views_of_very_many_features_number_them(sample, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_ROWS", 3)
    same(sample.ds.view("layers", "detections", columns=["oil-*", "salt-01"], rows=(0, 9)), sample.detections[:9][:, [*range(20, 30), 11]])


def test_values_keep_their_type(spark, sample):
    big = 2**53 + 1
    obs, var = sample.ds.obs.filter("_pos < 2"), sample.ds.var.filter("_pos < 3")
    stored = {
        "sparse": spark.createDataFrame([(0, 1, big)], "row_pos long, col_pos long, value long"),
        "dense": spark.createDataFrame([(0, [0, big, 0]), (1, [0, 0, 0])], "row_pos long, values array<long>"),
    }
    for layout, df in stored.items():
        block = AnnotatedDataset(obs, var, Matrix(df, layout)).view("X", rows=(0, 2), cols=(0, 3))
        assert block.schema["values"].dataType.simpleString() == "array<bigint>"
        assert [r["line"] for r in array_lines(block).orderBy("row_pos").collect()] == [f"0,{big},0", "0,0,0"]
    long = Matrix(spark.createDataFrame([(0, 0, 1.5), (1, 1, 2.0)], "row_pos long, col_pos long, value double"), "long")
    rows = AnnotatedDataset(obs, var, long).view("X", rows=(0, 2), cols=(0, 2)).collect()
    assert [r["values"] for r in rows] == [[1.5, None], [None, 2.0]]


def test_shapes(sample):
    def shape(*args, **kwargs):
        return tuple(sample.ds.view_shape(*args, **kwargs).first())

    assert shape("obs") == (f"({N_OBS}, 4)", "(5, 4)")
    n = int((sample.obs.basin == "oder").sum())
    assert shape("obs", columns=["*e*"], where=("basin", "==", "oder")) == (f"({n}, 4)", "(5, 1)")
    assert shape("X", rows=(50, 200), cols=(28, 60)) == (f"({N_OBS}, {N_VARS})", "(14, 2)")
    assert shape("layers", "whole", columns=["oil-*"]) == (f"({N_OBS}, {N_VARS})", "(5, 10)")
    assert shape("uns", "calendar") == ("(9, 7)", "(5, 5)")
    assert shape("uns", "survey") == (None, None)


def test_free_form_values(sample):
    ds = sample.ds
    assert ds.view("uns", "note").first()[0] == "high water"
    assert ds.view("uns", ["survey", "gear", "nets", 1]).first()[0] == "7"
    assert {r["key"] for r in ds.view("uns", "survey").collect()} == {"year", "lead", "gear"}
    with pytest.raises(KeyError, match="nothing at survey -> month"):
        ds.view("uns", ["survey", "month"])
    listed = {r["key"]: (r["type"], r["shape"]) for r in ds.view("uns").collect()}
    assert listed["calendar"] == ("sparse matrix", "(9, 7)") and listed["note"][1] == "NA" and listed["log"] == ("table", f"({N_OBS}, 2)")


def test_value_counts(sample):
    rows = sample.ds.value_counts("obs", columns=["basin", "automatic"]).collect()
    got = {(r["column"], r["value"]): r["count"] for r in rows}
    assert got["basin", None] == sample.obs.basin.isna().sum() and got["automatic", "true"] == sample.obs.automatic.sum()
    assert sum(n for (c, _), n in got.items() if c == "basin") == N_OBS


def test_named_cells(sample):
    rows = sample.ds.where("obs", "index", "==", "km 13").named_cells("layers", "whole").collect()
    assert {r["feature"]: r["value"] for r in rows} == dict(zip(sample.var.index, sample.detections[4].astype(float), strict=True))


def check_summary(rows):
    by = {(r["section"], r["key"]): r for r in rows if r["type"] != "column"}
    shapes = {k: r["shape"] for k, r in by.items()}
    assert shapes["obs", None] == f"({N_OBS}, 4)" and shapes["X", None] == f"({N_OBS}, {N_VARS})"
    assert shapes["obsm", "species"] == f"({N_OBS}, 14)" and shapes["varp", "affinity"] == f"({N_VARS}, {N_VARS})"
    assert by["layers", "whole"]["dtype"] == "bigint" and by["layers", "detections"]["type"] == "sparse matrix"
    assert by["raw", None]["value"] == "true"
    columns = [(r["key"], r["dtype"]) for r in rows if r["section"] == "var" and r["type"] == "column"]
    assert columns == [("limit", "double"), ("regulated", "bigint")]


def test_summary(sample):
    check_summary(sample.ds.summary().collect())
    bare = AnnotatedDataset(sample.ds.obs).summary().collect()
    assert {(r["section"], r["value"]) for r in bare if r["section"] == "raw"} == {("raw", "false")}


def test_store_and_open(spark, sample, tmp_path):
    begun = time.time()
    write_dataset(sample.ds, str(tmp_path / "survey"))
    ds = open_dataset(spark, str(tmp_path / "survey"))
    check_summary(ds.summary().collect())
    whole(ds.describe("X").first(), sample.readings)
    whole(ds.where("obs", "visits", ">", 15).describe("obsm", "species").first(), sample.species[(sample.obs.visits > 15).to_numpy()])
    same(ds.view("uns", "calendar", rows=(0, 9), cols=(0, 7)), sample.calendar)
    assert ds.view("uns", ["survey", "lead"]).first()[0] == "Ada"
    plan = ds.view("obs", rows=(3, 8))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_pos,3)" in plan
    written = last_modified(spark, str(tmp_path / "survey")).first()[0]
    assert begun - 1 <= written.timestamp() <= time.time()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        text = [r["value"] for r in ds.summary().collect() if r["section"] == "last_modified"][0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(datetime.datetime.fromisoformat(text).replace(tzinfo=datetime.timezone.utc).timestamp() - written.timestamp()) < 0.01


def test_versions(spark, sample, tmp_path):
    """A reader keeps the version it opened; failed writers and vacuum leave the newest one whole."""
    path = str(tmp_path / "survey")

    def make(n, key):
        obs = spark.range(n).select(F.col("id").alias("_pos"), F.col("id").cast("string").alias("_index"), (F.col("id") * 2).alias("twice"))
        return AnnotatedDataset(obs, uns={key: obs.select("_pos", "twice")})

    assert write_dataset(make(5, "old"), path) == 1
    before = open_dataset(spark, path)
    with pytest.raises(ValueError, match="already"):
        write_dataset(make(7, "new"), path)
    with pytest.raises(ValueError, match="mode"):
        write_dataset(make(7, "new"), path, mode="append")
    assert write_dataset(make(7, "new"), path, mode="overwrite") == 2
    # The old reader opens its parts only now.
    assert before.n_obs == 5 and before.obs.count() == 5 and [k for part, k, _ in before.parts() if part == "uns"] == ["old"]
    after = open_dataset(spark, path)
    assert after.n_obs == 7 and after.obs.count() == 7 and [k for part, k, _ in after.parts() if part == "uns"] == ["new"]
    assert open_dataset(spark, path, version=1).obs.count() == 5
    with pytest.raises(FileNotFoundError, match=r"\[1, 2\]"):
        open_dataset(spark, path, version=9)

    class Failing(AnnotatedDataset):
        def parts(self):
            yield from super().parts()
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        write_dataset(Failing(make(9, "x").obs), path, mode="overwrite")
    assert open_dataset(spark, path).obs.count() == 7 and after.obs.count() == 7
    (tmp_path / "survey" / "manifest" / "version=3").mkdir()  # a manifest whose file has not come
    assert open_dataset(spark, path).n_obs == 7
    modified = last_modified(spark, path).first()[0].timestamp()
    assert abs(modified - max(f.stat().st_mtime for f in (tmp_path / "survey" / "manifest" / "version=2").glob("part-*"))) < 0.01
    (tmp_path / "survey" / "manifest" / "version=3").rmdir()

    assert vacuum_dataset(spark, path) == [1]
    assert len(list((tmp_path / "survey" / "parts").iterdir())) == 2  # that of version 2 and that of the failed writer, which is young
    assert vacuum_dataset(spark, path, orphan_hours=-1) == []
    assert [p.name[:2] for p in (tmp_path / "survey" / "parts").iterdir()] == ["2-"]
    assert after.obs.count() == 7 and open_dataset(spark, path).get("uns", "new").count() == 7
    with pytest.raises(FileNotFoundError):
        open_dataset(spark, str(tmp_path / "absent"))
    assert {r["kind"] for r in locate_datasets(spark, str(tmp_path)).collect()} == {"dataset"}


def test_tiles(spark, tmp_path):
    """A matrix in tiles gives what it gave before, and features are read from their tiles alone."""
    rng = np.random.default_rng(4)
    values = np.where(rng.random((40, 23)) < 0.1, np.nan, rng.random((40, 23)))
    obs = spark.range(40).select(F.col("id").alias("_pos"), F.format_string("o%d", "id").alias("_index"), (F.col("id") % 3).alias("third"))
    var = spark.range(23).select(F.col("id").alias("_pos"), F.format_string("f%02d", "id").alias("_index"), (F.col("id") % 2).alias("odd"))
    x = spark.createDataFrame([(i, [None if j == 3 and i < 5 else float(v) for j, v in enumerate(row)]) for i, row in enumerate(values)], "row_pos long, values array<double>")
    plain = AnnotatedDataset(obs, var, Matrix(x, "dense"), obsm={"same": Matrix(x, "dense")})
    write_dataset(plain, str(tmp_path / "t"), tile=5)
    tiled = open_dataset(spark, str(tmp_path / "t"))
    assert [c for c in tiled.get("X").tiled.columns] == ["row_pos", "tile_0", "tile_1", "tile_2", "tile_3", "tile_4"]

    def asked(ds):
        yield ds.describe("X")
        yield ds.describe("X", axis=1)
        yield ds.describe("obsm", "same", axis=0)
        yield ds.describe("X", columns=["f1?", "f03", "f22"])
        yield ds.where("var", "odd", "==", 1).describe("X", axis=0)
        yield ds.where("obs", "third", "<", 2).where("var", "odd", "==", 0).describe("X")
        yield ds.view("X", rows=(3, 30, 7), cols=(4, 23, 3))
        yield ds.view("X", rows=(-3, None), cols=[22, 0, 9, 9])
        yield ds.view("X", columns=["f20", "f0?"], rows=(0, 4))
        yield ds.where("obs", "third", "==", 1).view("X", rows=(1, 5), cols=(-2, None))
        yield ds.view("obsm", "same", rows=(None, None), cols=(None, None))
        yield ds.summary().where("section in ('X', 'obsm')").select("section", "key", "shape", "dtype")

    for one, other in zip(asked(plain), asked(tiled), strict=True):
        assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    for df in (tiled.view("X", columns=["f06", "f08"], rows=(None, None)), tiled.view("X", rows=(0, 9), cols=(5, 9)), tiled.get("X").keep_cols(KeptPositions(var.where("_pos in (6, 7)").select("_pos"))).df):
        read = re.findall(r"ReadSchema: struct<([^>]*tile[^>]*)", df._jdf.queryExecution().executedPlan().toString())
        assert read and all("tile_1" in r and not re.search("tile_[0234]", r) for r in read)


def test_names_of_a_stored_dataset(spark, tmp_path):
    """Look-ups by name give what filters give, and read the pages of the names asked for."""
    n = 60_000
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.format_string("o%d", F.col("id") % 30_000))
    obs = spark.range(n).select(F.col("id").alias("_pos"), name.alias("_index"), (F.col("id") % 7).alias("day"))
    var = spark.createDataFrame([(0, 5), (1, 6)], "_pos long, _index long")  # names that are no text have no side table
    plain = AnnotatedDataset(obs, var)
    write_dataset(plain, str(tmp_path / "n"))
    stored = open_dataset(spark, str(tmp_path / "n"))
    assert set(stored._names) == {"obs"} and [row[:2] for row in stored.parts()] == [("obs", None), ("var", None)]

    asked = [
        ("==", "o5"), ("==", "absent"), ("==", 5), ("==", "hot"), ("!=", "hot"), ("isin", ["o5", "o29999", 4, "o5"]), ("isin", []),
        ("isin", ["o7", None]), ("isin", ["o7", float("nan")]), ("isin", "o8"), ("notin", ["hot"]), ("isin", [f"o{i}" for i in range(0, 3000, 2)]),
    ]
    for op, value in asked:
        one, other = (ds.where("obs", "index", op, value).where("obs", "day", "<", 5).obs for ds in (plain, stored))
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), (op, value)
        turned = stored.where("obs", "day", "<", 5).where("obs", "index", op, value)
        assert turned.n_obs == one.count()
    assert stored.where("var", "index", "==", 6).n_vars == 1
    for ds in (plain, stored):
        with pytest.raises(ValueError, match="one value"):
            ds.where("obs", "index", "==", ["o5"])
        assert ds.view("obs", rows=(0, 9), where=("index", "==", "o5")).collect() == [("o5", 5), ("o5", 30_005 % 7)]
        found = ds.positions_of(["o7", "hot", "absent", "hot"], "obs")
        assert {tuple(r) for r in found.collect()} == {("o7", 7), ("hot", 0)}
        from_table = ds.positions_of(spark.createDataFrame([("o7",), ("hot",), ("absent",), ("hot",), (None,)], "n string"), "obs")
        assert {tuple(r) for r in from_table.collect()} == {("o7", 7), ("hot", 0)}
        kept = ds.where("obs", "day", "==", 3).positions_of(["hot", *(f"absent{i}" for i in range(20))], "obs")
        assert [tuple(r) for r in kept.collect()] == [("hot", 3)]
        with pytest.raises(ValueError, match="axis"):
            ds.positions_of(["o7"], "uns")

    looked = rows_named(stored._names["obs"](), ["o5"])
    looked.collect()
    plan = looked._jdf.queryExecution().executedPlan()
    assert "EqualTo(_hash" in plan.toString() or "In(_hash" in plan.toString()
    leaf = plan.collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() <= 25_000


def test_datasets_without_versions(spark, tmp_path):
    """What earlier releases wrote: parts beside one manifest."""
    old = f"{tmp_path}/old"
    spark.range(4).selectExpr("id AS _pos", "string(id) AS _index").write.parquet(f"{old}/obs")
    rows = [("obs", None, "table", None, 4, 0)]
    spark.createDataFrame(rows, "section string, key string, kind string, dtype string, n_rows bigint, n_cols bigint").coalesce(1).write.parquet(f"{old}/manifest")
    ds = open_dataset(spark, old)
    assert ds.n_obs == 4 and ds.obs.count() == 4
    assert write_dataset(ds, old, mode="overwrite") == 1
    assert open_dataset(spark, old).obs.count() == 4 and open_dataset(spark, old, version=0).obs.count() == 4
    assert vacuum_dataset(spark, old) == [0]
    assert open_dataset(spark, old).obs.count() == 4 and not (tmp_path / "old" / "obs").exists()


def test_locate(spark, tmp_path):
    for name in ("top.h5ad", "deep/er/x.h5ad", "plain/notes.txt", "dots.zarr/.zgroup", "v3.zarr/zarr.json", "v3.zarr/inner.zarr/zarr.json", "v3.zarr/x.h5ad", "ds/manifest/part-0.parquet"):
        file = tmp_path / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text("{}")

    def found(**how):
        return {(r["path"].removeprefix(f"{tmp_path}/"), r["kind"]) for r in locate_datasets(spark, str(tmp_path), **how).collect()}

    direct = {("top.h5ad", "h5ad"), ("dots.zarr", "zarr"), ("v3.zarr", "zarr"), ("ds", "dataset")}
    assert found(recursive=False) == direct
    assert found() == direct | {("deep/er/x.h5ad", "h5ad")}
    assert locate_datasets(spark, str(tmp_path / "plain")).count() == 0
    assert locate_datasets(spark, str(tmp_path / "absent")).count() == 0


def test_locations():
    assert [resolve_location(p) for p in ("rel/x", "s3://b/k", "gcs://b", "az://c/x", "hdfs://n/x")] == ["rel/x", "s3a://b/k", "gs://b", "abfs://c/x", "hdfs://n/x"]
    with pytest.raises(ValueError, match="http"):
        resolve_location("http://host/data")


def test_csv(spark, sample, tmp_path):
    lines = table_lines(sample.ds.obs, ["visits", "automatic"]).orderBy("_pos").limit(2).collect()
    assert [r["line"] for r in lines] == [f"km {3 * i + 1},{sample.obs.visits.iloc[i]},{str(bool(sample.obs.automatic.iloc[i])).lower()}" for i in range(2)]
    block = array_lines(sample.ds.view("layers", "detections", rows=(0, 3), cols=(0, 6))).orderBy("row_pos").collect()
    assert [r["line"] for r in block] == [",".join(map(str, sample.detections[i, :6])) for i in range(3)]
    tricky = spark.createDataFrame([(0, 'say "yes", or', None, "")], "_pos int, t string, u string, v string")
    assert table_lines(tricky).first()["line"].startswith('"say ""yes"", or",')
    write_table(sample.ds.var, str(tmp_path / "var"))
    assert spark.read.csv(str(tmp_path / "var"), header=True).columns == ["_index", "limit", "regulated"]
    write_block(sample.ds.view("X", rows=(0, 4)), str(tmp_path / "x"))
    assert spark.read.csv(str(tmp_path / "x")).count() == 4


def test_one_scan_per_describe(spark, sample, tmp_path):
    sample.ds.obs.write.parquet(str(tmp_path / "obs"))
    stored = spark.read.parquet(str(tmp_path / "obs"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (table_stats.describe_table(stored, ["depth", "visits"]), table_stats.describe_table(stored, ["basin"]), table_stats.value_counts(stored, ["basin"])):
        assert plan(df).count("FileScan parquet") == 1
    assert "ReadSchema: struct<visits:bigint>" in plan(table_stats.describe_table(stored, ["visits"]))


def test_time_of_a_dataset_with_names(spark, tmp_path):
    """The index of names is in the manifest beside the parts, and is none of the dataset's parts."""
    docs = [(i, f"text {i}", "en", "web", 6) for i in range(12)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [tuple(r) for r in queries.modified(spark, str(tmp_path)).collect()] == [(True, True, 12)]
