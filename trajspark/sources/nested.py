"""Nested episode records to frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.functions.columns import c


def load_episodic_from_nested(records: DataFrame, key: str, state: Sequence[str], steps: str = "steps") -> DataFrame:
    """One row per step of each record.

    The state is the concatenation of the named step fields as float32; the task is ``language_instruction`` and
    ``success`` tells whether the file path holds ``/success/``. ``frame_index`` counts the steps of a record.
    """
    rows = records.select(
        c(key),
        F.posexplode(c(steps)).alias("_f", "step"),
        F.col("language_instruction").alias("task"),
        F.col("episode_metadata.file_path").contains("/success/").alias("success"),
        F.col("episode_metadata").alias("episode_metadata"),
    )
    fields = {f.name: f.dataType for f in rows.schema["step"].dataType.fields}
    parts = [F.col("step")[n] if isinstance(fields[n], T.ArrayType) else F.array(F.col("step")[n]) for n in state]
    return rows.withColumn("observation.state", F.concat(*parts).cast("array<float>")).withColumnRenamed("_f", "frame_index")
