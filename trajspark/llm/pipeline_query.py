"""Registers the pipeline at the repository's top as query ``pipeline``."""

from __future__ import annotations

import corpus_pipeline
from trajspark.llm.registry import query

query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
