"""A river survey with every section, next to the arrays it holds.

Stations by substances: readings with missing values, integer counts of detections with empty
rows and columns, a few vectors per station and substance, sparse links between them.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession

from matrixlens import AnnotatedDataset, Document, Matrix

N_OBS, N_VARS = 64, 30
BASINS = ("elbe", "rhine", "oder", None)


def dense(spark: SparkSession, values: np.ndarray) -> Matrix:
    rows = pd.DataFrame({"row_pos": range(len(values)), "values": [row.tolist() for row in values]})
    element = "bigint" if values.dtype.kind == "i" else "double"
    return Matrix(spark.createDataFrame(rows, f"row_pos bigint, values array<{element}>"), "dense")


def sparse(spark: SparkSession, values: np.ndarray, shape: tuple[int | None, int | None] | None = None) -> Matrix:
    i, j = np.nonzero(values)
    kind = "bigint" if values.dtype.kind == "i" else "double"
    cells = pd.DataFrame({"row_pos": i, "col_pos": j, "value": values[i, j]})
    return Matrix(spark.createDataFrame(cells, f"row_pos bigint, col_pos bigint, value {kind}"), "sparse", shape)


def axis(spark: SparkSession, names: list[str], columns: dict[str, list], types: str):
    rows = [(i, name, *(values[i] for values in columns.values())) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, f"_pos bigint, _index string, {types}")


def sample_dataset(spark: SparkSession) -> SimpleNamespace:
    rng = np.random.default_rng(2024)
    stations = [f"km {3 * i + 1}" for i in range(N_OBS)]
    substances = [f"{group}-{i:02d}" for group in ("metal", "salt", "oil") for i in range(N_VARS // 3)]
    depth = [None if i % 9 == 4 else round(float(d), 2) for i, d in enumerate(rng.gamma(3, 2, N_OBS))]
    obs = {
        "basin": [BASINS[i * 7 % 4] for i in range(N_OBS)],
        "depth": depth,
        "visits": [int(v) for v in rng.poisson(20, N_OBS)],
        "automatic": [i % 3 == 0 for i in range(N_OBS)],
    }
    var = {"limit": [float(x) for x in rng.exponential(5, N_VARS)], "regulated": [None if i % 7 == 0 else i % 2 for i in range(N_VARS)]}
    readings = np.where(rng.random((N_OBS, N_VARS)) < 0.1, np.nan, rng.lognormal(0, 2, (N_OBS, N_VARS)))
    detections = rng.poisson(0.6, (N_OBS, N_VARS))
    detections[5], detections[-1] = 0, 0  # an empty row inside and at the end
    detections[:, 11], detections[:, -2:] = 0, 0  # and empty columns
    profile = rng.normal(size=(N_OBS, 6))
    species = np.where(rng.random((N_OBS, 14)) < 0.2, rng.integers(1, 9, (N_OBS, 14)), 0)
    species[:, 12:] = 0
    weights = rng.normal(size=(N_VARS, 4))
    flow = np.where(rng.random((N_OBS, N_OBS)) < 0.08, rng.normal(size=(N_OBS, N_OBS)), 0.0)
    affinity = np.where(rng.random((N_VARS, N_VARS)) < 0.1, rng.random((N_VARS, N_VARS)) - 0.5, 0.0)
    calendar = np.zeros((9, 7))
    calendar[[0, 5], [2, 4]] = (3.5, -1.0)
    visits = {"first": [float(x) for x in rng.random(N_OBS)], "last": [float(x) for x in rng.random(N_OBS)]}
    ds = AnnotatedDataset(
        axis(spark, stations, obs, "basin string, depth double, visits bigint, automatic boolean"),
        axis(spark, substances, var, "limit double, regulated bigint"),
        dense(spark, readings),
        layers={"detections": sparse(spark, detections), "whole": dense(spark, detections)},
        obsm={"profile": dense(spark, profile), "species": sparse(spark, species, (None, 14)), "log": axis(spark, stations, visits, "first double, last double")},
        varm={"weights": dense(spark, weights)},
        obsp={"flow": sparse(spark, flow)},
        varp={"affinity": sparse(spark, affinity)},
        uns={
            "drift": dense(spark, rng.normal(size=(11, 3))),
            "calendar": sparse(spark, calendar, calendar.shape),
            "log": axis(spark, stations, visits, "first double, last double"),
            "survey": Document.of(spark, {"year": 2031, "lead": "Ada", "gear": {"nets": [4, 7]}}),
            "note": Document.of(spark, "high water"),
        },
        raw=dense(spark, readings[:, :10]),
    )
    frame = pd.DataFrame(obs, index=stations)
    return SimpleNamespace(
        ds=ds, obs=frame, var=pd.DataFrame(var, index=substances), readings=readings, detections=detections, profile=profile,
        species=species, weights=weights, flow=flow, affinity=affinity, calendar=calendar, visits=pd.DataFrame(visits, index=stations),
    )
