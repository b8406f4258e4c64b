"""Joins and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajspark.functions.columns import c
from trajspark.operators.layout import EPISODE, FRAME, dictionary_join, look_around, running, sorted_running


def with_task_text(frames: DataFrame, tasks: DataFrame) -> DataFrame:
    """Task text by key, the same as by position for a dense dictionary."""
    return dictionary_join(frames, tasks.select("task_index", "task"), "task_index", ["index"])


def with_subtask_text(frames: DataFrame, subtasks: DataFrame | None) -> DataFrame:
    """Subtask text where both the column and the dictionary exist."""
    if subtasks is None or "subtask_index" not in frames.columns:
        return frames
    return dictionary_join(frames, subtasks.select("subtask_index", "subtask"), "subtask_index", ["index"])


def frame_to_episode(queries: DataFrame, episodes: DataFrame, index: str = "index") -> DataFrame:
    """Episode of a global index by the half-open range it falls in; indices outside every range get episode 0.

    Starts of ranges and asked indices are sorted together and the range that started last is carried along, block by
    block, so the work is linear in both. Every index is looked up once, however often it is asked. Ranges must not
    overlap; empty ones hold nothing.
    """
    starts = episodes.filter("dataset_to_index > dataset_from_index").select(
        F.col("dataset_from_index").cast("long").alias("_i"), F.struct(F.col(EPISODE).alias("e"), F.col("dataset_to_index").alias("to")).alias("_r")
    )
    asked = queries.select(c(index).cast("long").alias("_i")).filter("_i IS NOT NULL").distinct()
    both = starts.withColumn("_asked", F.lit(0)).unionByName(asked.withColumn("_asked", F.lit(1)), allowMissingColumns=True)
    both = running(both.withColumn("_o", F.col("_i") * 2 + F.col("_asked")), {"_now": ("last", F.col("_r"))}, (), "_o")
    hits = both.filter((F.col("_asked") == 1) & (F.col("_i") < F.col("_now.to"))).select("_i", F.col("_now.e").alias("_episode"))
    joined = queries.join(hits, c(index).cast("long") == F.col("_i"), "left").drop("_i")
    return joined.withColumn(EPISODE, F.coalesce(F.col("_episode"), F.lit(0).cast("long"))).drop("_episode")


def index_join(frames: DataFrame, values: DataFrame, how: str = "left") -> DataFrame:
    """Per-frame values aligned by the global index, which is unique on both sides."""
    return frames.join(values, "index", how)


def nearest_frame(
    queries: DataFrame, frames: DataFrame, tolerance: float, query_id: str, keys: Sequence[str] = (EPISODE,), at: str = "query_time"
) -> DataFrame:
    """Frame with the timestamp nearest to ``at`` per key; the earlier frame wins a tie.

    ``queries`` holds a unique ``query_id``, ``keys`` and ``at``; ``frames`` holds ``keys``, ``frame_index`` and
    ``timestamp``. Only distances under ``tolerance`` count. Frames and queries of a key are sorted by time together; the
    frame before and the frame after each query are carried to it, so the work is linear whatever the tolerance holds. Of
    frames at one time the first counts. Queries without a candidate come back with ``is_violation`` true.
    """
    known = c("timestamp").isNotNull() & ~F.isnan(c("timestamp").cast("double"))
    for k in keys:
        known = known & c(k).isNotNull()
    frame = F.struct(F.col("_t").alias("t"), F.col("_f").alias("f"))
    source = frames.filter(known).groupBy(*[c(k) for k in keys], c("timestamp").cast("double").alias("_t")).agg(F.min(FRAME).alias("_f"))
    source = source.withColumns({"_asked": F.lit(0), "_frame": frame})
    asked = queries.withColumns({"_t": c(at).cast("double"), "_asked": F.lit(1)})
    both = asked.unionByName(source.drop("_f"), allowMissingColumns=True)
    carried = {"_before": ("last", F.col("_frame")), "_after": ("next", F.col("_frame"))}
    met = sorted_running(both, carried, ["_t", "_asked", query_id], keys).filter("_asked = 1")

    def candidate(name: str) -> Column:
        d = F.abs(F.col(f"{name}.t") - F.col("_t"))
        return F.when(d < tolerance, F.struct(d.alias("d"), F.col(f"{name}.t").alias("t"), F.col(f"{name}.f").alias("f")))

    out = met.withColumn("_b", F.least(candidate("_before"), candidate("_after")))
    return out.select(
        *[c(n).cast(queries.schema[n].dataType).alias(n) if n in keys else c(n) for n in queries.columns],
        F.col("_b.f").alias("nearest_frame"),
        F.col("_b.t").alias("nearest_time"),
        F.col("_b.d").alias("distance"),
        F.col("_b").isNull().alias("is_violation"),
    )


def first_cover(intervals: DataFrame, start: str, end: str, rank: Column, keys: Sequence[str] = (EPISODE,)) -> DataFrame:
    """Steps ``(keys, _p, _first)``: from ``_p`` up to the next step, the smallest ``rank`` of the intervals that cover it.

    Intervals ``start..end`` include both ends and may overlap in any order; ``_first`` is null where none covers. An
    interval is cut into aligned cells of powers of two, at most two of each size, and a step looks at the one cell of
    each size it lies in. So rows grow with the intervals times the logarithm of their length, never with their overlaps.
    """
    valid = c(start) <= c(end)
    names = [c(k) for k in keys]
    for name in names:
        valid = valid & name.isNotNull()
    spans = intervals.filter(valid).select(*names, c(start).cast("long").alias("_a"), (c(end).cast("long") + 1).alias("_e"), rank.alias("_rank"))
    # Cell x of size 2^l is used if it lies within [_a, _e) and the cell of twice its size around it does not.
    cells = spans.withColumn("_l", F.explode(F.expr("sequence(0, length(bin(_e - _a)) - 1)")))
    cells = cells.withColumns({"_from": F.expr("-shiftright(-_a, _l)"), "_to": F.expr("shiftright(_e, _l)")}).filter("_from < _to")
    cells = cells.withColumn("_cell", F.explode(F.expr("array_distinct(array(_from, _to - 1))")))
    cells = cells.filter("shiftleft(shiftright(_cell, 1), _l + 1) < _a OR shiftleft(shiftright(_cell, 1) + 1, _l + 1) > _e")
    cells = cells.groupBy(*names, "_l", "_cell").agg(F.min("_rank").alias("_rank"))
    top = spans.groupBy(*names).agg(F.max(F.length(F.bin(F.col("_e") - F.col("_a"))) - 1).alias("_top"))
    points = spans.select(*names, F.explode(F.array("_a", "_e")).alias("_p")).distinct()
    asked = points.join(top, list(keys)).withColumn("_l", F.explode(F.expr("sequence(0, _top)")))
    asked = asked.withColumn("_cell", F.expr("shiftright(_p, _l)"))
    return asked.join(cells, [*keys, "_l", "_cell"], "left").groupBy(*names, "_p").agg(F.min("_rank").alias("_first"))


def carry_steps(frames: DataFrame, steps: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Frames with the latest non-null value of each column over the steps at or before them.

    Steps hold ``episode_index``, ``_p`` and columns of their own and are sorted in among the frames of their block, so
    each frame is sorted once and no list of steps travels with it.
    """
    own = [n for n in steps.columns if n not in (EPISODE, "_p")]
    marks = steps.withColumns({EPISODE: c(EPISODE).cast(frames.schema[EPISODE].dataType), "_o": F.col("_p") * 2, "_step": F.lit(True)})
    placed = frames.withColumns({"_o": c(FRAME).cast("long") * 2 + 1, "_step": F.lit(False)})
    both = placed.unionByName(marks.drop("_p"), allowMissingColumns=True)
    # A frame has no values of its own; a struct of its nulls would not be null and would hide the step before it.
    carried = running(both, {name: ("last", F.when(F.col("_step"), value)) for name, value in columns.items()}, order="_o")
    return carried.filter(~F.col("_step")).drop("_o", "_step", *own)


def subtask_of_frame(frames: DataFrame, intervals: DataFrame) -> DataFrame:
    """Subtask of each frame: the first interval in order with ``start <= f <= end``.

    Frames in a gap take the interval before it with ``tau`` 1; frames outside all intervals get nulls. ``intervals`` has
    ``episode_index, pos, name, start_frame, end_frame`` with dense ``pos``. Gaps become intervals of their own, after all
    others in order; intervals may overlap, and each frame finds the first that covers it by the steps of ``first_cover``.
    """
    following = look_around(intervals.select(EPISODE, "pos", "name", "start_frame", "end_frame"), {"_next": (F.col("start_frame"), 1)}, order="pos")
    both = F.array(
        F.struct(F.lit(0).alias("gap"), F.col("start_frame").alias("a"), F.col("end_frame").alias("b")),
        F.struct(F.lit(1).alias("gap"), (F.col("end_frame") + 1).alias("a"), (F.col("_next") - 1).alias("b")),
    )
    pieces = following.withColumn("_g", F.explode(both)).withColumns({"_a": F.col("_g.a"), "_b": F.col("_g.b")})
    entry = F.struct(F.col("_g.gap").alias("gap"), "pos", "name", "start_frame", "end_frame")
    steps = first_cover(pieces, "_a", "_b", entry)
    joined = carry_steps(frames, steps, {"_w": F.struct("_first")})
    f = c(FRAME)
    span = (F.col("_s.end_frame") - F.col("_s.start_frame")).cast("double")
    tau = (
        F.when(F.col("_s").isNull(), None)
        .when(F.col("_s.gap") == 1, 1.0)
        .when(span <= 0, 1.0)
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (f - F.col("_s.start_frame")) / span)))
    )
    out = joined.withColumn("_s", F.col("_w._first"))
    return out.withColumns(
        {
            "subtask": F.col("_s.name"),
            "subtask_pos": F.col("_s.pos"),
            "tau": tau,
            "in_gap": F.coalesce(F.col("_s.gap") == 1, F.lit(False)),
        }
    ).drop("_w", "_s")


def common_columns_union(members: Sequence[DataFrame]) -> DataFrame:
    """Concatenate members on the columns all of them have and add ``dataset_index``."""
    common = [n for n in members[0].columns if all(n in m.columns for m in members)]
    if not common:
        raise ValueError("the datasets have no column in common")
    out = None
    for i, member in enumerate(members):
        part = member.select(*[c(n) for n in common], F.lit(i).alias("dataset_index"))
        out = part if out is None else out.unionByName(part)
    return out


def missing_units(expected: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Expected units without output."""
    return expected.select(c(key)).join(done.select(c(key)).distinct(), key, "left_anti")


def missing_files(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected relative paths that no listed path ends with; listing paths are cut at the dataset root beforehand."""
    return expected.select("path").distinct().join(listing.select("path"), "path", "left_anti")
