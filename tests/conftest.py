import os
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
PATHS = [HERE, os.path.dirname(HERE)]
sys.path[:0] = PATHS
# Functions defined in tests run in Spark's Python workers, which import them by name.
os.environ["PYTHONPATH"] = os.pathsep.join(PATHS + [p for p in [os.environ.get("PYTHONPATH")] if p])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frames_of(spark):
    """Frame form of an (n, h, w) array."""
    from stackweave.model import frame_batch

    def make(stack, key="t", first=0):
        stack = np.asarray(stack, dtype=float)
        if len(stack) == 0:
            return spark.createDataFrame([], f"{key} long, h int, w int, px array<double>")
        batch = frame_batch({key: pa.array(np.arange(first, first + len(stack)), pa.int64())}, stack)
        return spark.createDataFrame(pa.Table.from_batches([batch])).repartition(3)

    return make


def array_of(frames, key="t"):
    """The (n, h, w) array of a frame table, in order."""
    rows = frames.select(key, "h", "w", "px").orderBy(key).collect()
    return np.array([np.array(r["px"], dtype=float).reshape(r["h"], r["w"]) for r in rows])


@pytest.fixture
def rng():
    return np.random.default_rng(3)
