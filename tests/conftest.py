import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["one_block", "small_blocks"])
def blocks(request, spark):
    """Run a test with every episode in one block, and with blocks and hot-group limits of a few rows."""
    small = request.param == "small_blocks"
    spark.conf.set("spark.trajspark.blockRows", "7" if small else "65536")
    spark.conf.set("spark.trajspark.hotGroupRows", "9" if small else "2000000")
    yield request.param
    spark.conf.unset("spark.trajspark.blockRows")
    spark.conf.unset("spark.trajspark.hotGroupRows")


@pytest.fixture(scope="session")
def lengths():
    """One long episode and a few short ones."""
    return [60, 1, 5, 23, 8]


@pytest.fixture(scope="session")
def rows(lengths):
    import numpy as np

    rng = np.random.default_rng(0)
    out, index = [], 0
    for e, n in enumerate(lengths):
        for f in range(n):
            state = rng.normal(size=2).round(3).tolist()
            out.append((e, f, index, f / 10, e % 2, state, float(rng.integers(0, 5)), f == n - 1, n))
            index += 1
    return out


@pytest.fixture(scope="session")
def frames(spark, rows):
    schema = (
        "episode_index long, frame_index long, index long, timestamp double, task_index long, `observation.state` array<double>, "
        "reward double, is_last boolean, episode_length long"
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def dataset(spark, frames, lengths):
    from trajspark import EpisodicDataset

    start, eps = 0, []
    for e, n in enumerate(lengths):
        eps.append((e, n, start, start + n, [f"task_{e % 2}"]))
        start += n
    episodes = spark.createDataFrame(eps, "episode_index long, length long, dataset_from_index long, dataset_to_index long, tasks array<string>")
    tasks = spark.createDataFrame([(0, "task_0"), (1, "task_1")], "task_index long, task string")
    features = {
        "observation.state": {"dtype": "float64", "shape": [2], "names": ["x", "y"]},
        "reward": {"dtype": "float64", "shape": [1], "names": None},
    }
    return EpisodicDataset(frames, episodes, tasks, {"fps": 10, "features": features})
