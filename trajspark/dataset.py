"""The dataset value passed between operators."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame

# Fixed values of the on-disk format.
REQUIRED_COLUMNS = ("timestamp", "frame_index", "episode_index", "index", "task_index")
FORMAT_VERSION = "v3.0"
CHUNK_FILES = 1000
DATA_FILE_MB = 100
VIDEO_FILE_MB = 200

DEFAULT_FEATURES = {
    "timestamp": {"dtype": "float32", "shape": [1], "names": None},
    "frame_index": {"dtype": "int64", "shape": [1], "names": None},
    "episode_index": {"dtype": "int64", "shape": [1], "names": None},
    "index": {"dtype": "int64", "shape": [1], "names": None},
    "task_index": {"dtype": "int64", "shape": [1], "names": None},
}


@dataclass(frozen=True)
class EpisodicDataset:
    """Four tables and an ``info`` dictionary.

    ``frames``: one row per timestep. ``episodes``: one row per episode with ``length`` and the half-open global range
    ``[dataset_from_index, dataset_to_index)``. ``tasks``: ``task_index``, ``task``. ``stats``: long table
    ``(feature, dim, min, max, mean, std, count, q01, q10, q50, q90, q99)``; ``episode_stats`` has the same columns plus
    ``episode_index``.
    """

    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    info: dict = field(default_factory=dict)
    stats: DataFrame | None = None
    episode_stats: DataFrame | None = None
    subtasks: DataFrame | None = None

    def with_(self, **changes) -> "EpisodicDataset":
        return replace(self, **changes)

    @property
    def fps(self) -> float:
        return self.info.get("fps", 1)

    @property
    def features(self) -> dict:
        return self.info.get("features", {})

    def user_features(self) -> dict:
        return {k: v for k, v in self.features.items() if k not in REQUIRED_COLUMNS}
