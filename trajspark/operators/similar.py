"""Dropping observations too similar to the last kept one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.functions.columns import block_of, c
from trajspark.operators.layout import EPISODE, FRAME, block_rows, set_checkpoint_dir


def keep_flags(values: np.ndarray, steps: np.ndarray, must: np.ndarray, last: np.ndarray | None, handled: set[int], atol: float):
    """Flags of kept rows in order, and the last kept value after them; ``handled`` takes in the steps of kept rows.

    Used by the batch and the streaming operator. Distances to the last kept row are taken for many rows at once, up to
    the first row that is kept.
    """
    kept, at, width = np.zeros(len(values), bool), 0, 16
    while at < len(values):
        part = slice(at, at + width)
        go = np.ones(min(width, len(values) - at), bool) if last is None else np.sqrt(np.square(values[part] - last).sum(axis=1)) >= atol
        free = last is None
        hits = np.flatnonzero(go | must[part]) + at
        hit = next((i for i in hits if free or must[i] or int(steps[i]) not in handled), None)
        if hit is None:
            at, width = at + width, min(2 * width, 4096)
            continue
        kept[hit], last, at, width = True, values[hit], hit + 1, 16
        handled.add(int(steps[hit]))
    return kept, last


def _with_last_block(base: DataFrame) -> DataFrame:
    """Adds the last block in which the row's step occurs; the join key includes the block, which bounds its rows."""
    key = [EPISODE, "_s", "_block"]
    last = F.max("_block").over(Window.partitionBy(EPISODE, "_s"))
    per = base.select(*key).distinct().withColumn("_until", last)
    return base.join(per.filter(F.col("_until") > F.col("_block")), key, "left").withColumn("_until", F.coalesce("_until", "_block"))


def similar_filter(frames: DataFrame, vector: str, atol: float, must_go: str | None = None, step: str = FRAME) -> DataFrame:
    """Keep an observation unless its distance to the last *kept* one is below ``atol`` or its step was kept before.

    A step is handled once one of its rows is kept; ``must_go`` rows and the first row of an episode are always kept.

    What a block keeps depends on the last kept row before it. All blocks first run as if nothing came before; a block
    whose predecessor turned out to end in another state runs again, until no state changes. Usually a few rounds are
    enough, because two runs that keep the same row once agree from there on. The state table has one row per block and
    is checkpointed each round. Episodes of one block need no rounds at all. The state of a block
    also lists its handled steps that occur again in a later block, so it is empty where repeats are near each other.
    """
    size = block_rows(frames)
    base = frames.select(
        EPISODE,
        FRAME,
        block_of(c(FRAME), size).alias("_block"),
        c(vector).cast("array<double>").alias("_v"),
        c(step).cast("long").alias("_s"),
        (c(must_go) if must_go else F.lit(False)).alias("_m"),
    )
    base = _with_last_block(base) if step != FRAME else base.withColumn("_until", F.col("_block"))
    fields = [T.StructField(EPISODE, T.LongType()), T.StructField("_block", T.LongType())]
    state = [T.StructField("_last", T.ArrayType(T.DoubleType())), T.StructField("_handled", T.ArrayType(T.LongType()))]

    def run(pdf: pd.DataFrame):
        pdf = pdf.sort_values(FRAME)
        last, before = pdf["_last"].iloc[0], pdf["_handled"].iloc[0]
        handled = set() if before is None else {int(x) for x in before}
        values, last = np.stack(pdf["_v"].to_numpy()), None if last is None else np.asarray(last)
        kept, last = keep_flags(values, pdf["_s"].to_numpy(), pdf["_m"].to_numpy(), last, handled, atol)
        return pdf, kept, last, handled

    def exits(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, _, last, handled = run(pdf)
        head = pdf.iloc[0]
        over = set(pdf.loc[pdf["_until"] <= head["_block"], "_s"])  # no later block holds these
        return pd.DataFrame([{EPISODE: head[EPISODE], "_block": head["_block"], "_last": list(last), "_handled": sorted(handled - over)}])

    def flags(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, kept, _, _ = run(pdf)
        return pd.DataFrame({EPISODE: pdf[EPISODE], FRAME: pdf[FRAME], "_kept": kept})

    def entries_of(state_after: DataFrame) -> DataFrame:
        return state_after.withColumn("_block", F.col("_block") + 1)

    entries = None
    if base.select(F.max("_block")).first()[0]:
        set_checkpoint_dir(frames)
        fresh = base.withColumns({"_last": F.lit(None).cast("array<double>"), "_handled": F.lit(None).cast("array<long>")})
        by_block = [EPISODE, "_block"]
        after = fresh.groupBy(*by_block).applyInPandas(exits, T.StructType([*fields, *state])).checkpoint()
        entries = entries_of(after).join(after.select(*by_block), by_block, "left_semi").checkpoint()
        changed = entries
        while not changed.isEmpty():
            again = base.join(changed, by_block).groupBy(*by_block).applyInPandas(exits, T.StructType([*fields, *state]))
            new = again.select(*by_block, F.struct("_last", "_handled").alias("_new"))
            merged = after.join(new, by_block, "left")
            old = F.struct("_last", "_handled")
            merged = merged.withColumn("_to", F.coalesce("_new", old)).withColumn("_moved", F.col("_to") != old)
            merged = merged.select(*by_block, F.col("_to._last").alias("_last"), F.col("_to._handled").alias("_handled"), "_moved").checkpoint()
            after = merged.drop("_moved")
            entries = entries_of(after).join(after.select(*by_block), by_block, "left_semi")
            moved = merged.filter("_moved").select(EPISODE, (F.col("_block") + 1).alias("_block"))
            changed = entries.join(moved, by_block, "left_semi").checkpoint()
    if entries is None:
        ready = base.withColumns({"_last": F.lit(None).cast("array<double>"), "_handled": F.lit(None).cast("array<long>")})
    else:
        ready = base.join(entries, [EPISODE, "_block"], "left")
    schema = T.StructType([*fields[:1], T.StructField(FRAME, T.LongType()), T.StructField("_kept", T.BooleanType())])
    kept = ready.groupBy(EPISODE, "_block").applyInPandas(flags, schema).filter("_kept").drop("_kept")
    return frames.join(kept, [EPISODE, FRAME], "left_semi")
