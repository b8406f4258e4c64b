"""Sampling, shuffling and routing (P9-P16). Draws come from row hashes, so a retried task draws the same."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.functions.columns import c, hash_uniform
from trajspark.operators.algebra import union_all
from trajspark.operators.layout import EPISODE, join_episodes, positions
from trajspark.operators.schema import nan_check


def sample_transitions(
    transitions: DataFrame, n: int, capacity: int, seed: int = 0, order: str = "index", next_from_following: bool = False, state: str = "observation.state"
) -> DataFrame:
    """``n`` uniform draws with replacement from the newest ``capacity`` rows, with a ``draw`` number.

    Draws are a table of row numbers joined to the log, so every draw costs one lookup. ``next_from_following`` leaves out
    the newest row and takes the state of the following row as ``next_state``.
    """
    row = transitions.agg(F.max(c(order)).alias("hi"), F.min(c(order)).alias("lo")).first()
    if row["hi"] is None:
        raise ValueError("cannot sample from an empty table")
    low, high = max(row["lo"], row["hi"] - capacity + 1), row["hi"] - (1 if next_from_following else 0)
    span = high - low + 1
    if span <= 0:
        raise ValueError("not enough rows to sample from")
    draws = transitions.sparkSession.range(n).withColumnRenamed("id", "draw")
    draws = draws.withColumn(order, F.lit(low) + F.floor(hash_uniform(seed, F.col("draw")) * span))
    out = draws.join(transitions, order)
    if next_from_following:
        following = transitions.select((c(order) - 1).alias(order), c(state).alias("next_state"))
        out = out.join(following, order)
    return out


def mix_online_offline(online: DataFrame, offline: DataFrame, n: int, capacity: int, seed: int = 0) -> DataFrame:
    """Equal draws from two logs in one batch; columns only one side has are null in the other."""
    half = n // 2
    parts = [
        sample_transitions(online, n - half, capacity, seed).withColumn("source", F.lit("online")),
        sample_transitions(offline, half, capacity, seed + 1).withColumn("source", F.lit("offline")),
    ]
    return union_all(parts)


def weighted_subset(key: Sequence[Column], items: Sequence[str], weights: Sequence[float], k: int, seed: int = 0, keep_order: bool = True) -> Column:
    """``k`` of a fixed list of names without replacement, drawn per row in proportion to their weights.

    Each item gets the key ``-ln(u) / w``; the ``k`` smallest keys are such a sample.
    """
    if k > sum(1 for w in weights if w > 0):
        raise ValueError("more items asked for than have a positive weight")
    drawn = [
        F.struct((-F.log(hash_uniform(seed, *key, F.lit(i))) / F.lit(float(w))).alias("k"), F.lit(i).alias("i"), F.lit(n).alias("n"))
        for i, (n, w) in enumerate(zip(items, weights))
        if w > 0
    ]
    best = F.slice(F.array_sort(F.array(*drawn)), 1, k)
    if keep_order:
        best = F.array_sort(F.transform(best, lambda x: F.struct(x["i"].alias("i"), x["n"].alias("n"))))
    return F.transform(best, lambda x: x["n"])


def sample_fraction_per_episode(frames: DataFrame, episodes: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    """``max(1, int(n * fraction))`` frames of every episode, those with the smallest draws."""
    hashed = frames.withColumn("_h", hash_uniform(seed, F.col("index")))
    ranked = positions(hashed, "_rank", ["_h", "index"], [EPISODE])
    wanted = F.greatest(F.lit(1), F.floor(F.col("length") * F.lit(fraction)))
    sized = join_episodes(ranked, episodes.select(EPISODE, "length", wanted.alias("_k")))
    extra = [] if "length" in frames.columns else ["length"]
    return sized.filter(F.col("_rank") < F.col("_k")).drop("_rank", "_k", "_h", *extra)


def shuffle(frames: DataFrame, seed: int, epoch: int = 0, key: str = "index") -> DataFrame:
    """Every row once, in an order drawn per epoch; a range-partitioned sort of hashes."""
    return frames.orderBy(F.xxhash64(c(key), F.lit(seed), F.lit(epoch)), c(key))


def random_shift_plan(images: DataFrame, pad: int, seed: int, key: str = "index") -> DataFrame:
    """Per-image offsets ``0 … 2 * pad`` in both directions."""
    draw = lambda salt: F.floor(hash_uniform(seed, c(key), F.lit(salt)) * (2 * pad + 1)).cast("int")
    return images.withColumns({"shift_y": draw(0), "shift_x": draw(1)})


def random_crop_plan(images: DataFrame, height: int, width: int, out_height: int, out_width: int, seed: int, key: str = "index") -> DataFrame:
    top = F.floor(hash_uniform(seed, c(key), F.lit(0)) * (height - out_height + 1)).cast("int")
    left = F.floor(hash_uniform(seed, c(key), F.lit(1)) * (width - out_width + 1)).cast("int")
    return images.withColumns({"crop_top": top, "crop_left": left})


def perturb_labels(rows: DataFrame, p: float, seed: int, text: str, replacement: str, targets: Sequence[str], key: str = "index") -> DataFrame:
    """With probability ``p`` replace the text and zero the targets; ``perturbed`` tells which."""
    hit = hash_uniform(seed, c(key)) < p
    changed = {t: F.when(F.col("perturbed"), F.lit(0)).otherwise(c(t)).cast(rows.schema[t].dataType) for t in targets}
    flagged = rows.withColumn("perturbed", hit)
    return flagged.withColumns({text: F.when(F.col("perturbed"), F.lit(replacement)).otherwise(c(text)), **changed})


def route_transitions(transitions: DataFrame, columns: Sequence[str], flag: str = "is_intervention", key: str = "index") -> tuple[DataFrame, DataFrame]:
    """(online, offline): all rows without NaN, and those of them made by an intervention."""
    bad = nan_check(transitions, columns, (key,)).select(key)
    online = transitions.join(bad, key, "left_anti")
    return online, online.filter(F.coalesce(c(flag), F.lit(False)))
