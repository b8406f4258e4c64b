"""Statistics of features, rollouts, tables and labels."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark.functions.columns import block_of, c
from trajspark.operators.layout import EPISODE, FRAME, block_rows, dictionary_join, join_episodes, positions, set_checkpoint_dir, sorted_running

# Fixed values of the statistics format.
QUANTILES = (0.01, 0.10, 0.50, 0.90, 0.99)
BINS = 5000
EDGE = 1e-10
WIDE_SLOTS = 32  # up to this many numbers per frame, ranges are aggregated without exploding
STATS = ("min", "max", "mean", "std", "count")
TILE_NUMBERS = 1024  # episodes with fewer numbers are worked out as one row
TILES_AT_ONCE = 1000


def quantile_key(q: float) -> str:
    return f"q{round(q * 100):02d}"


# ---------------------------------------------------------------- vectors as slots


def numeric_slots(features: Mapping[str, Mapping]) -> list[tuple[str, int]]:
    """(feature, dim) of every number in a frame, in order; strings, images and videos have none."""
    slots = []
    for name, spec in features.items():
        if spec["dtype"] in ("string", "image", "video"):
            continue
        size = 1
        for n in spec["shape"]:
            size *= n
        slots += [(name, d) for d in range(size)]
    return slots


def flat_vector(features: Mapping[str, Mapping]) -> Column:
    """All numeric features of a frame as one ``array<double>`` in slot order."""
    parts = []
    for name in dict.fromkeys(n for n, _ in numeric_slots(features)):
        rank = len(features[name]["shape"])
        value = c(name)
        if list(features[name]["shape"]) == [1] and not features[name].get("is_array", False):
            parts.append(F.array(value.cast("double")))
            continue
        for _ in range(rank - 1):
            value = F.flatten(value)
        parts.append(F.transform(value, lambda x: x.cast("double")))
    return F.concat(*parts)


def array_features(frames: DataFrame, features: Mapping[str, Mapping]) -> dict[str, dict]:
    """Mark features of shape (1,) that are stored as one-element arrays."""
    kinds = dict(frames.dtypes)
    return {
        n: {**s, "is_array": kinds.get(n, "").startswith("array")} for n, s in features.items() if n in kinds
    }


def name_slots(df: DataFrame, slots: Sequence[tuple[str, int]]) -> DataFrame:
    names = F.array(*[F.lit(n) for n, _ in slots])
    dims = F.array(*[F.lit(d) for _, d in slots])
    rest = [n for n in df.columns if n != "slot"]
    at = F.col("slot") + 1
    return df.select(*[c(n) for n in rest], F.element_at(names, at).alias("feature"), F.element_at(dims, at).alias("dim"))


# ---------------------------------------------------------------- histogram quantiles


def bin_of(x: Column, low: Column, high: Column, bins: int = BINS) -> Column:
    """Number of the equal-width bin on ``[low - 1e-10, high + 1e-10]``."""
    lo, hi = low - EDGE, high + EDGE
    at = F.floor((x - lo) / (hi - lo) * bins)
    return F.when(hi == lo, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), at))).cast("int")


def stats_from_bins(
    counts: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = QUANTILES, bins: int = BINS
) -> DataFrame:
    """All statistics from ``(keys, bin, n, s1, s2, lo, hi)``: at most ``bins`` rows per key reach the window.

    ``s1`` and ``s2`` are sums of ``value - lo`` and its square, so a large common offset does not cancel. A quantile lies
    in the first bin whose running count reaches ``q * total``; it is the lower end of the range in bin 0 and interpolated
    inside the bin otherwise. Bin number and running counts grow together, so each can be taken with its own ``min``,
    which keeps the aggregate on plain numbers. Fewer than two values: deviation 0, every quantile the mean (S4).
    """
    key_cols = [c(k) for k in keys]
    over = Window.partitionBy(*key_cols).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*key_cols)
    summed = counts.withColumns({"_cum": F.sum("n").over(over), "_all": F.sum("n").over(whole)})
    hits = []
    for i, q in enumerate(quantiles):
        reached = F.col("_cum") >= F.lit(q) * F.col("_all")
        hits += [
            F.min(F.when(reached, F.col("bin"))).alias(f"_bin{i}"),
            F.min(F.when(reached, F.col("_cum"))).alias(f"_cum{i}"),
            F.min(F.when(reached, F.col("_cum") - F.col("n"))).alias(f"_before{i}"),
        ]
    first = summed.groupBy(*key_cols).agg(
        F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("n").alias("count"), F.sum("s1").alias("_s1"), F.sum("s2").alias("_s2"), *hits
    )
    n = F.col("count")
    shift = F.col("_s1") / n
    mean, few = F.col("min") + shift, n < 2
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("_s2") / n - shift * shift))
    lo, hi = F.col("min") - EDGE, F.col("max") + EDGE
    width = (hi - lo) / bins
    out = []
    for i, q in enumerate(quantiles):
        at, cum, before = F.col(f"_bin{i}"), F.col(f"_cum{i}"), F.col(f"_before{i}")
        share = (F.lit(q) * n - before) / (cum - before)
        inside = F.when(at == 0, lo).otherwise(lo + at * width + share * width)
        out.append(F.when(few, mean).otherwise(inside).alias(quantile_key(q)))
    return first.select(
        *key_cols, "min", "max", mean.alias("mean"), F.when(few, F.lit(0.0)).otherwise(std).alias("std"), "count", *out
    )


def bin_counts(values: DataFrame, keys: Sequence[str], n: Column | None = None) -> DataFrame:
    """Bins of ``(keys, value, lo, hi)`` rows, each counting ``n`` times; combined on the map side."""
    n = F.lit(1).cast("long") if n is None else n
    off = F.col("value") - F.col("lo")
    binned = values.filter(F.col("value").isNotNull()).select(
        *[c(k) for k in keys],
        "lo",
        "hi",
        bin_of(F.col("value"), F.col("lo"), F.col("hi")).alias("bin"),
        n.alias("n"),
        (off * n).alias("s1"),
        (off * off * n).alias("s2"),
    )
    return binned.groupBy(*[c(k) for k in keys], "bin").agg(
        F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def exact_percentiles(values: DataFrame, value: str, quantiles: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact percentiles with linear interpolation, as columns of ``quantile_key`` names.

    The values are ranked by ``positions``, which splits large groups, and the two ranks around each percentile are looked
    up. Nothing keeps the distinct values of a group in memory.
    """
    key_cols = [c(k) for k in keys]
    known = values.filter(c(value).isNotNull() & ~F.isnan(c(value))).select(*key_cols, c(value).cast("double").alias("_v"))
    wanted = _asked_ranks(known.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_n")), quantiles, keys)
    found = positions(known, "_rank", ["_v"], keys).join(wanted, [*keys, "_rank"])
    return found.groupBy(*key_cols).agg(
        *[F.sum(F.when(F.col("_i") == i, F.col("_w") * F.col("_v"))).alias(quantile_key(q)) for i, q in enumerate(quantiles)]
    )


def _asked_ranks(sizes: DataFrame, quantiles: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """The two ranks around each quantile and their weights, from the ``_n`` values of each key."""
    asked = []
    for i, q in enumerate(quantiles):
        at = F.lit(float(q)) * (F.col("_n") - 1)
        low = F.floor(at)
        for rank, weight in ((low, 1 - (at - low)), (F.least(low + 1, F.col("_n") - 1), at - low)):
            asked.append(F.struct(F.lit(i).alias("i"), rank.alias("rank"), weight.alias("w")))
    key_cols = [c(k) for k in keys]
    wanted = sizes.select(*key_cols, F.explode(F.array(*asked)).alias("_a"))
    return wanted.select(*key_cols, F.col("_a.rank").alias("_rank"), F.col("_a.i").alias("_i"), F.col("_a.w").alias("_w"))


def counted_percentiles(rows: DataFrame, value: str, quantiles: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """``exact_percentiles`` for few keys whose values repeat: only distinct values with their counts are sorted.

    Running counts tell where the ranks of a value end, and each asked rank takes the first value that ends after it. No
    task holds more values of a key than ``spark.trajspark.hotGroupRows``. Keys must not be null.
    """
    set_checkpoint_dir(rows)
    key_cols = [c(k) for k in keys]
    counts = rows.filter(c(value).isNotNull()).groupBy(*key_cols, c(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
    counts = counts.checkpoint()
    ends = sorted_running(counts, {"_until": ("sum", F.col("_k"))}, ["_v"], keys).select(*key_cols, "_until", F.lit(0).alias("_asked"), "_v")
    wanted = _asked_ranks(counts.groupBy(*key_cols).agg(F.sum("_k").alias("_n")), quantiles, keys)
    wanted = wanted.withColumnRenamed("_rank", "_until").withColumn("_asked", F.lit(1))
    both = ends.withColumn("_end", F.struct("_v")).drop("_v").unionByName(wanted, allowMissingColumns=True)
    found = sorted_running(both, {"_found": ("next", F.col("_end"))}, ["_until", "_asked"], keys).filter("_asked = 1")
    # A weight of 0 takes no value, which may be infinite.
    part = F.when(F.col("_w") > 0, F.col("_w") * F.col("_found._v"))
    return found.groupBy(*key_cols).agg(*[F.sum(F.when(F.col("_i") == i, part)).alias(quantile_key(q)) for i, q in enumerate(quantiles)])


def _moments(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    v = F.col("value")
    return values.groupBy(*[c(k) for k in keys]).agg(
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.avg(v).alias("mean"),
        F.stddev_pop(v).alias("std"),
        F.count(v).alias("count"),
    )


def _episode_ranges(flat: DataFrame, slots: int) -> DataFrame:
    """One row per episode: its length and an array with the range of every slot."""
    if slots <= WIDE_SLOTS:
        x = [F.col("_x")[i] for i in range(slots)]
        ranges = [F.struct(F.min(v).alias("min"), F.max(v).alias("max")) for v in x]
        return flat.groupBy(EPISODE).agg(F.array(*ranges).alias("_r"), F.count(F.lit(1)).alias("_length"))
    values = flat.select(EPISODE, F.posexplode("_x").alias("slot", "value"))
    per_slot = values.groupBy(EPISODE, "slot").agg(F.min("value").alias("min"), F.max("value").alias("max"), F.count(F.lit(1)).alias("_n"))
    # As many entries as there are numbers in a frame.
    per_episode = per_slot.groupBy(EPISODE).agg(
        F.array_sort(F.collect_list(F.struct("slot", "min", "max"))).alias("_r"), F.max("_n").alias("_length")
    )
    return per_episode.withColumn("_r", F.transform("_r", lambda r: F.struct(r["min"].alias("min"), r["max"].alias("max"))))


def _stats_of_groups(key: np.ndarray, x: np.ndarray, quantiles: Sequence[float], bins: int = BINS) -> list[np.ndarray]:
    """The columns of ``stats_from_bins`` for numbers ``x`` of groups ``key``, the groups in order before them.

    The bin in which the running count first reaches ``q * n`` is that of the number of rank ``ceil(q * n)``.
    """
    order = np.lexsort((x, key))
    key, x = key[order], x[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    n = np.diff(np.r_[starts, len(key)])
    group = np.repeat(np.arange(len(n)), n)
    low, high = x[starts], x[starts + n - 1]  # NaN is the largest, as in Spark
    off = x - low[group]
    lo, hi = low - EDGE, high + EDGE
    at = np.floor((x - lo[group]) / (hi - lo)[group] * bins)
    at = np.where((hi == lo)[group] | np.isnan(at), 0, np.clip(at, 0, bins - 1)).astype(np.int64)
    shift = np.add.reduceat(off, starts) / n
    mean, few = low + shift, n < 2
    std = np.sqrt(np.maximum(0.0, np.add.reduceat(off * off, starts) / n - shift * shift))
    width, place = (hi - lo) / bins, group * bins + at
    out = [key[starts], low, high, mean, np.where(few, 0.0, std), n]
    for q in quantiles:
        b = at[starts + np.maximum(np.ceil(q * n).astype(np.int64), 1) - 1]
        wanted = np.arange(len(n)) * bins + b
        cum, before = (np.searchsorted(place, wanted, side) - starts for side in ("right", "left"))
        inside = np.where(b == 0, lo, lo + b * width + (q * n - before) / (cum - before) * width)
        out.append(np.where(few, mean, inside))
    return out


def _tile_stats(tiles: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """Statistics per (episode, slot) of episodes that are one row each, with their frames in ``_xs``."""
    names = [quantile_key(q) for q in quantiles]
    schema = f"{EPISODE} {tiles.schema[EPISODE].dataType.simpleString()}, slot int, min double, max double, mean double, std double, count long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for whole in batches:
                for first in range(0, whole.num_rows, TILES_AT_ONCE):
                    batch = whole.slice(first, TILES_AT_ONCE)
                    tile = batch.column(1)
                    frames = tile.flatten()
                    width = frames.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                    owner = np.repeat(np.arange(batch.num_rows), tile.value_lengths().to_numpy(zero_copy_only=False))
                    values = frames.flatten()
                    slot = np.arange(len(values)) - np.repeat(np.cumsum(width) - width, width)
                    known = values.is_valid().to_numpy(zero_copy_only=False)
                    if not known.any():
                        continue
                    slots = int(width.max())
                    key = (np.repeat(owner, width) * slots + slot)[known]
                    at, *rest = _stats_of_groups(key, values.filter(values.is_valid()).to_numpy(), quantiles)
                    columns = [batch.column(0).take(pa.array(at // slots)), pa.array(at % slots, pa.int32()), *map(pa.array, rest)]
                    yield pa.RecordBatch.from_arrays(columns, [EPISODE, "slot", *STATS, *names])

    return tiles.select(EPISODE, "_xs").mapInArrow(run, schema + "".join(f", {n} double" for n in names))


def episode_stats(
    frames: DataFrame, features: Mapping[str, Mapping], quantiles: Sequence[float] = QUANTILES, mode: str = "histogram"
) -> DataFrame:
    """Statistics per (episode, feature, dim).

    Frames are gathered once into tiles of at most ``TILE_NUMBERS`` numbers. An episode with less than a tile is worked out
    there. Longer ones take two passes: ranges, then bins, both combined on the map side. Ranges return to the frames on
    ``(episode, block)``, so a very long episode is spread over tasks in both. ``mode='exact'`` replaces the histogram
    quantiles by exact percentiles.
    """
    features = array_features(frames, features)
    slots = numeric_slots(features)
    flat = frames.select(EPISODE, FRAME, flat_vector(features).alias("_x"))
    keys = [EPISODE, "slot"]
    if mode == "exact":
        values = flat.select(EPISODE, F.posexplode("_x").alias("slot", "value"))
        stats = _moments(values, keys).join(exact_percentiles(values, "value", quantiles, keys), keys)
    else:
        rows = max(1, min(block_rows(frames), TILE_NUMBERS // max(1, len(slots))))
        tiles = flat.groupBy(EPISODE, block_of(c(FRAME), rows).alias("_tile")).agg(
            F.collect_list(F.struct(FRAME, "_x")).alias("_f"), F.count(F.lit(1)).alias("_n")
        )
        # Frame numbers are dense: a first tile that is not full is the whole episode.
        short = F.col(EPISODE).isNotNull() & (F.col("_tile") == 0) & (F.col("_n") < rows)
        whole = tiles.filter(short).select(EPISODE, F.expr("filter(transform(_f, f -> f._x), x -> x IS NOT NULL)").alias("_xs"))
        flat = tiles.filter(~short).select(EPISODE, F.explode("_f").alias("_f")).select(EPISODE, "_f.*")
        sized = join_episodes(flat, _episode_ranges(flat, len(slots)), length="_length")
        with_range = F.zip_with("_x", "_r", lambda x, r: F.struct(x.alias("value"), r["min"].alias("lo"), r["max"].alias("hi")))
        rows = sized.select(EPISODE, F.posexplode(with_range).alias("slot", "_v")).select(*keys, "_v.*")
        stats = stats_from_bins(bin_counts(rows, keys), keys, quantiles).unionByName(_tile_stats(whole, quantiles))
    return name_slots(stats, slots).select(EPISODE, "feature", "dim", *STATS, *[quantile_key(q) for q in quantiles])


def dataset_quantiles(
    frames: DataFrame, features: Mapping[str, Mapping], quantiles: Sequence[float] = QUANTILES, pooled: bool = False
) -> DataFrame:
    """Statistics over all frames, per (feature, dim), or per feature over all dims when ``pooled`` (axis None)."""
    features = array_features(frames, features)
    slots = numeric_slots(features)
    values = frames.select(EPISODE, FRAME, F.posexplode(flat_vector(features)).alias("slot", "value"))
    if pooled:
        first = {n: slots.index((n, 0)) for n, _ in slots}
        values = values.withColumn("slot", F.element_at(F.array(*[F.lit(first[n]) for n, _ in slots]), F.col("slot") + 1))
    ranges = values.groupBy("slot").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    sized = dictionary_join(values, ranges, "slot", [EPISODE, FRAME], "inner")
    stats = stats_from_bins(bin_counts(sized, ["slot"]), ["slot"], quantiles)
    return name_slots(stats, slots).select("feature", "dim", *STATS, *[quantile_key(q) for q in quantiles])


def row_stats(rows: DataFrame, vector: str, key: str, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Statistics across the entries of each row's vector (axis 1). The range comes from the row, so nothing is joined."""
    x = F.transform(c(vector), lambda v: v.cast("double"))
    wide = rows.select(c(key), x.alias("_x")).withColumns({"lo": F.array_min("_x"), "hi": F.array_max("_x")})
    values = wide.select(c(key), "lo", "hi", F.explode("_x").alias("value"))
    return stats_from_bins(bin_counts(values, [key]), [key], quantiles)


def stats_by_axis(frames: DataFrame, features: Mapping[str, Mapping], axis: int | tuple | None) -> DataFrame:
    """Axis modes: 0 per dimension, 1 per row, None over everything; images use ``image_stats``."""
    if axis in (0, (0,)):
        return dataset_quantiles(frames, features)
    if axis is None:
        return dataset_quantiles(frames, features, pooled=True)
    if axis in (1, (1,)):
        if len(features) != 1:
            raise ValueError("axis 1 takes one vector feature")
        return row_stats(frames, next(iter(features)), "index")
    raise ValueError(f"unsupported axis {axis}")


def combine_stats(parts: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Merge statistics of parts per (feature, dim).

    Weighted mean, parallel variance, extremes, and the count-weighted mean of quantiles, which is kept only when every
    part has it. The mean is known before deviations from it are summed, so large offsets do not cancel.
    """
    keys = ["feature", "dim"]
    n = F.col("count")
    names = [quantile_key(q) for q in quantiles if quantile_key(q) in parts.columns]
    totals = parts.groupBy(*keys).agg(F.sum(n).alias("_n"), (F.sum(n * F.col("mean")) / F.sum(n)).alias("_m"))
    salt_by = [EPISODE] if EPISODE in parts.columns else ["mean", "count"]
    with_mean = dictionary_join(parts, totals, keys, salt_by, "inner")
    spread = F.col("std") * F.col("std") + (F.col("mean") - F.col("_m")) * (F.col("mean") - F.col("_m"))
    return with_mean.groupBy(*keys).agg(
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.first("_m").alias("mean"),
        F.sqrt(F.sum(n * spread) / F.sum(n)).alias("std"),
        F.sum(n).alias("count"),
        *[F.when(F.count(q) == F.count(F.lit(1)), F.sum(n * F.col(q)) / F.sum(n)).alias(q) for q in names],
    )


def augment_quantiles(
    frames: DataFrame, features: Mapping[str, Mapping], stats: DataFrame | None, overwrite: bool = False
) -> DataFrame:
    """Dataset statistics with quantiles; existing ones that already have a quantile are returned as they are."""
    if stats is not None and not overwrite:
        have = [quantile_key(q) for q in QUANTILES if quantile_key(q) in stats.columns]
        if have and not stats.filter(" OR ".join(f"{q} IS NOT NULL" for q in have)).isEmpty():
            return stats
    return combine_stats(episode_stats(frames, features))


def validate_stats(stats: DataFrame, features: Mapping[str, Mapping]) -> DataFrame:
    """Rows that break a rule of the statistics format, with the rule."""
    visual = [n for n, s in features.items() if s["dtype"] in ("image", "video")]
    dims = stats.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_dims"),
        F.countDistinct("count").alias("_counts"),
        F.sum(F.when(F.col("min").isNull() | F.col("max").isNull() | F.col("mean").isNull() | F.col("std").isNull(), 1).otherwise(0)).alias("_empty"),
    )
    is_visual = F.col("feature").isin(visual) if visual else F.lit(False)
    rules = F.array_compact(
        F.array(
            F.when(F.col("_empty") > 0, "missing value"),
            F.when(F.col("_counts") != 1, "count must have shape (1)"),
            F.when(is_visual & (F.col("_dims") != 3), "image stats must have shape (3,1,1)"),
        )
    )
    return dims.select("feature", F.explode(rules).alias("violation"))


def image_stats(images: DataFrame, pixels: str, channels: int, height: int, width: int, keys: Sequence[str] = ()) -> DataFrame:
    """Per-channel statistics of raw ``channels x height x width`` byte images, divided by 255.

    Images with a side of 300 or more are read with a stride. Pixels become value counts on the map side: at most 256
    rows per channel leave a task, whatever the number of images. ``count`` is the number of images.
    """
    side = max(height, width)
    stride = 1 if side < 300 else int((width if width > height else height) / 150)
    source = c(pixels)
    on_grid = lambda _, i: ((i % width) % stride == 0) & ((F.floor(i / width) % height) % stride == 0)
    picked = source if stride == 1 else F.filter(source, on_grid)
    per_channel = -(-height // stride) * -(-width // stride)
    key_cols = [c(k) for k in keys]
    values = images.select(*key_cols, F.posexplode(picked).alias("_i", "_v"))
    values = values.groupBy(*key_cols, F.floor(F.col("_i") / per_channel).cast("int").alias("dim"), "_v").agg(F.count(F.lit(1)).alias("n"))
    values = values.withColumn("value", F.col("_v").cast("double"))
    group = [*keys, "dim"]
    ranges = values.groupBy(*[c(k) for k in group]).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    out = stats_from_bins(bin_counts(values.join(ranges, group), group, F.col("n")), group)
    scaled = ["min", "max", "mean", "std", *[quantile_key(q) for q in QUANTILES]]
    return out.withColumns(
        {**{n: F.col(n) / 255.0 for n in scaled}, "count": (F.col("count") / per_channel).cast("long")}
    )


# ---------------------------------------------------------------- sampling heuristic


def sample_size(n: Column) -> Column:
    """``max(min(100, n), min(int(n ** 0.75), 10000))``."""
    return F.greatest(F.least(F.lit(100), n), F.least(F.floor(F.pow(n, F.lit(0.75))), F.lit(10000))).cast("long")


def sample_indices(n: Column) -> Column:
    """Evenly spaced positions ``rint(linspace(0, n - 1, k))``."""
    k = sample_size(n)
    step = F.when(k > 1, (n - 1) / (k - 1)).otherwise(F.lit(0.0))
    return F.transform(F.sequence(F.lit(0).cast("long"), k - 1), lambda i: F.rint(i * step).cast("long"))


def sampled_frames(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Frames at the sampled positions of each episode, at most 10000.

    The positions ``rint(i * step)`` are at least 1 apart, so a frame tells by itself which ``i`` could have given it. Only
    lengths are joined, on ``(episode, block)``; no list of positions is made.
    """
    size = block_rows(frames)
    lengths = episodes.select(EPISODE, F.col("length").alias("_n"))
    lengths = lengths.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), block_of(F.greatest("_n", F.lit(1)) - 1, size))))
    k, at = sample_size(F.col("_n")), F.col("f." + FRAME)
    step = F.when(k > 1, (F.col("_n") - 1) / (k - 1)).otherwise(F.lit(0.0))
    near = F.when(step > 0, F.floor(at / step)).otherwise(F.lit(0))
    hit = F.lit(False)
    for away in (-1, 0, 1):
        i = near + away
        hit = hit | ((i >= 0) & (i < k) & (F.rint(i * step).cast("long") == at))
    blocked = frames.withColumn("_block", block_of(c(FRAME), size)).alias("f")
    same = [F.col(f"f.{x}") == F.col(f"l.{x}") for x in (EPISODE, "_block")]
    return blocked.join(lengths.alias("l"), [*same, hit], "left_semi").drop("_block")


# ---------------------------------------------------------------- rollouts and timing


def rollout_returns(rollouts: DataFrame, keys: Sequence[str] = (EPISODE,), step: str = "step", reference_mask: bool = False) -> DataFrame:
    """Per episode: sum and maximum of reward and any success up to the first done.

    The first done is an aggregate joined back per episode and step range, so nothing is ordered. ``reference_mask``
    keeps one step past done and counts masked rewards as 0 in the maximum; a rollout without done then keeps the
    first two steps only.
    """
    key_cols = [c(k) for k in keys]
    ends = rollouts.groupBy(*key_cols).agg(F.min(F.when(F.col("done"), F.col(step))).alias("_done"), (F.max(step) + 1).alias("_n"))
    wide = join_episodes(rollouts, ends, length="_n", keys=keys, order=step)
    if reference_mask:
        live = F.col(step) <= F.coalesce(F.col("_done"), F.lit(0)) + 1
        reward = F.when(live, F.col("reward")).otherwise(F.lit(0.0))
        good = F.max(live & F.col("success"))
        return wide.groupBy(*key_cols).agg(
            F.sum(reward).alias("sum_reward"), F.max(reward).alias("max_reward"), good.alias("success")
        )
    kept = wide.filter(F.col("_done").isNull() | (F.col(step) <= F.col("_done")))
    return kept.groupBy(*key_cols).agg(
        F.sum("reward").alias("sum_reward"), F.max("reward").alias("max_reward"), F.max("success").alias("success")
    )


def eval_summary(returns: DataFrame, group: str = "task_group", task: str = "task") -> DataFrame:
    """Means per task, per group and overall in one rollup; NaN values are skipped."""

    def mean(name: str) -> Column:
        return F.avg(F.when(~F.isnan(name), c(name)))

    return returns.rollup(c(group), c(task)).agg(
        F.count(F.lit(1)).alias("n_episodes"),
        mean("sum_reward").alias("avg_sum_reward"),
        mean("max_reward").alias("avg_max_reward"),
        (F.avg(F.col("success").cast("double")) * 100).alias("pc_success"),
    )


def fps_metrics(observations: DataFrame, keys: Sequence[str], timestamp: str) -> DataFrame:
    """(n - 1) / span per key; 0 when the span is at most 1e-6."""
    span = F.max(timestamp) - F.min(timestamp)
    n = F.count(F.lit(1))
    return observations.groupBy(*[c(k) for k in keys]).agg(
        n.alias("n"), F.when(span > 1e-6, (n - 1) / span).otherwise(F.lit(0.0)).alias("avg_fps")
    )


def progress_stats(progress: DataFrame, value: str) -> DataFrame:
    """Mean, sample deviation, minimum and maximum without NaN."""
    v = F.when(~F.isnan(c(value)), c(value).cast("double"))
    return progress.agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
    )


def token_length_stats(tokens: DataFrame, tokens_col: str, horizon: int, dims: int) -> DataFrame:
    """Length distribution of token lists and the compression ratio ``horizon * dims / mean``."""
    n = F.size(tokens_col)
    return tokens.agg(
        F.avg(n).alias("mean"),
        F.min(n).cast("long").alias("min"),
        F.max(n).cast("long").alias("max"),
        F.percentile(n, F.lit(0.99)).alias("p99"),
        (F.lit(horizon * dims) / F.avg(n)).alias("compression_ratio"),
    )


def image_quality_report(pairs: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Per cell: mean squared error and PSNR (averaged per frame), size ratio and load-time ratio.

    ``pairs`` has ``original`` and ``decoded`` pixel vectors scaled to [0, 1], ``video_bytes``, ``image_bytes``,
    ``video_load_s`` and ``image_load_s``.
    """
    diff = F.zip_with("original", "decoded", lambda a, b: (a - b) * (a - b))
    mse = F.aggregate(diff, F.lit(0.0), lambda s, x: s + x) / F.size("original")
    wide = pairs.withColumn("_mse", mse)
    return wide.groupBy(*[c(k) for k in cell]).agg(
        F.count(F.lit(1)).alias("frames"),
        F.avg("_mse").alias("avg_mse"),
        F.avg(F.when(F.col("_mse") > 0, 10 * F.log10(1 / F.col("_mse")))).alias("avg_psnr"),
        (F.sum("video_bytes") / F.sum("image_bytes")).alias("size_ratio"),
        (F.sum("video_load_s") / F.sum("image_load_s")).alias("load_time_ratio"),
    )


def joint_limits(frames: DataFrame, vector: str) -> DataFrame:
    """Minimum and maximum per dimension."""
    values = frames.select(F.posexplode(c(vector)).alias("dim", "value"))
    return values.groupBy("dim").agg(F.min("value").alias("min"), F.max("value").alias("max"))


def rate_stats(durations: DataFrame, seconds: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and 90th-percentile rate of a timed step."""
    rates = durations.filter(c(seconds) > 0).select(*[c(k) for k in keys], (1 / c(seconds)).alias("_rate"))
    mean = rates.groupBy(*[c(k) for k in keys]).agg(F.avg("_rate").alias("avg_rate"))
    high = exact_percentiles(rates, "_rate", [0.9], keys).withColumnRenamed("q90", "p90_rate")
    if keys:
        return mean.join(high, list(keys))
    one = F.lit(1).alias("_one")
    return mean.select("*", one).join(high.select("*", one), "_one").drop("_one")


# ---------------------------------------------------------------- subtasks and distributions


def subtask_proportions(intervals: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Mean share of an episode per subtask name, renormalised to 1.

    ``intervals`` has ``episode_index``, ``pos``, ``name``, ``duration``. A repeated name counts with its last duration
    while the total counts all; episodes of zero total are left out.
    """
    per_name = intervals.groupBy(EPISODE, "name").agg(F.max_by("duration", "pos").alias("_d"))
    totals = intervals.groupBy(EPISODE).agg(F.sum("duration").alias("_t")).filter(F.col("_t") > 0)
    shares = per_name.join(totals, EPISODE).groupBy("name").agg(F.avg(F.col("_d") / F.col("_t")).alias("_p"))
    total = F.sum("_p").over(Window.partitionBy())  # one row per subtask name
    out = shares.select("name", F.when(total > 0, F.col("_p") / total).otherwise(F.col("_p")).alias("proportion"))
    if order is not None:
        out = out.withColumn("pos", F.array_position(F.array(*[F.lit(n) for n in order]), F.col("name")) - 1)
    return out


def value_distribution(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(c(key)).agg(F.count(F.lit(1)).alias("n"))


def stats_to_frame(spark: SparkSession, nested: Mapping[str, Mapping[str, Sequence]]) -> DataFrame:
    """``{feature: {stat: nested list}}`` as the long table; metadata of a few numbers per feature."""
    rows = []
    names = [*STATS[:4], *[quantile_key(q) for q in QUANTILES]]

    def flat(v):
        return [y for x in v for y in flat(x)] if isinstance(v, (list, tuple)) else [v]

    for feature, stats in nested.items():
        count = int(flat(stats["count"])[0])
        cols = {s: flat(stats[s]) for s in names if s in stats}
        for d in range(len(cols["mean"])):
            rows.append((feature, d, *[float(cols[s][d]) if s in cols else None for s in names[:4]], count,
                         *[float(cols[s][d]) if s in cols else None for s in names[4:]]))
    schema = "feature string, dim int, min double, max double, mean double, std double, count long, " + ", ".join(
        f"{q} double" for q in names[4:]
    )
    return spark.createDataFrame(rows, schema)
