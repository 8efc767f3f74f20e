from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tests.compare import local_session
from tests.sample import sample_dataset


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = local_session("4")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def sample(spark):
    """The synthetic dataset and the numpy arrays it was made from."""
    return sample_dataset(spark)
