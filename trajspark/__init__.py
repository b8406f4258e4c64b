"""Episodic time-series datasets on Spark: windowed reads, dataset algebra, statistics, labels and streams."""

from trajspark.dataset import EpisodicDataset

__all__ = ["EpisodicDataset"]
__version__ = "0.1.0"
