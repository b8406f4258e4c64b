"""How ordered work inside an episode is spread over tasks.

An episode may hold a large share of all rows, so no operator in this package sorts a whole episode in one task.
Frames carry a dense ``frame_index``; cutting it into blocks of ``spark.trajspark.blockRows`` rows gives groups of equal
size whatever the episode lengths are. Three tools build on that:

* ``with_halo`` copies the few rows near a block edge into the neighbour block, so look-around of a bounded number of
  rows is exact inside ``(episode, block)``;
* ``running`` splits an unbounded scan into a scan per block and a scan over one row per block;
* ``join_episodes`` joins per-episode rows to frames on ``(episode, block)``.

``positions`` creates the dense order in the first place.
"""

from __future__ import annotations

import tempfile
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark.functions.columns import block_of, c

EPISODE = "episode_index"
FRAME = "frame_index"
BLOCK_ROWS_CONF = "spark.trajspark.blockRows"
HOT_ROWS_CONF = "spark.trajspark.hotGroupRows"
SALTS_CONF = "spark.trajspark.salts"
DEFAULT_BLOCK_ROWS = 65_536
DEFAULT_HOT_ROWS = 2_000_000
DEFAULT_SALTS = 32
# Texts of up to this many bytes are sent to every task instead of shuffling the frames to them.
DICTIONARY_BYTES = 8 << 20


def _conf(df: DataFrame, name: str, default: int) -> int:
    return int(df.sparkSession.conf.get(name, str(default)))


def block_rows(df: DataFrame, at_least: int = 1) -> int:
    """Rows per block; never smaller than the look-around asked for."""
    return max(_conf(df, BLOCK_ROWS_CONF, DEFAULT_BLOCK_ROWS), at_least)


def hot_rows(df: DataFrame) -> int:
    """Rows above which a group is hot."""
    return _conf(df, HOT_ROWS_CONF, DEFAULT_HOT_ROWS)


def with_halo(df: DataFrame, before: int, after: int, keys: Sequence[str] = (EPISODE,), order: str = FRAME) -> tuple:
    """Add ``_block`` and copy edge rows so that each row sees ``before`` rows back and ``after`` rows ahead.

    Returns the frame, the window to evaluate look-around in, and the condition that keeps each row once. The window
    holds copies, so unbounded frames over it are only meaningful for rows inside the look-around.
    """
    size = block_rows(df, max(before, after, 1))
    home, at = block_of(c(order), size), F.pmod(c(order), F.lit(size))
    blocks = [home]
    if after > 0:
        blocks.append(F.when((at < after) & (home > 0), home - 1))
    if before > 0:
        blocks.append(F.when(at >= size - before, home + 1))
    spread = F.explode(F.array_compact(F.array(*blocks))) if len(blocks) > 1 else home
    out = df.withColumn("_home", home).withColumn("_block", spread)
    window = Window.partitionBy(*[c(k) for k in keys], F.col("_block")).orderBy(c(order))
    return out, window, F.col("_block") == F.col("_home")


def drop_halo(df: DataFrame, keep: Column) -> DataFrame:
    return df.filter(keep).drop("_block", "_home")


def look_around(
    df: DataFrame, columns: Mapping[str, tuple[Column, int]], keys: Sequence[str] = (EPISODE,), order: str = FRAME
) -> DataFrame:
    """Add ``name = expression evaluated k rows away`` (null outside the episode)."""
    before = max([-k for _, k in columns.values()] + [0])
    after = max([k for _, k in columns.values()] + [0])
    wide, window, keep = with_halo(df, before, after, keys, order)
    added = {name: (F.lag(e, -k) if k < 0 else F.lead(e, k)).over(window) for name, (e, k) in columns.items()}
    return drop_halo(wide.withColumns(added), keep)


def running(
    df: DataFrame,
    columns: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (EPISODE,),
    order: str = FRAME,
    inclusive: bool = True,
    at_most: int | None = None,
) -> DataFrame:
    """Unbounded scans along ``order`` inside ``keys``, in two levels.

    Kinds: ``sum``, ``min``, ``max``, ``last`` (latest non-null value so far) and ``next`` (nearest non-null value at or
    after the row). With ``inclusive=False`` the row itself is left out. A caller that knows the table has ``at_most`` so
    few rows that they fit one block gets a plain window.
    """
    size = block_rows(df)
    key_cols = [c(k) for k in keys]
    if at_most is not None and at_most <= size:
        return df.withColumns({n: _scan(kind, e, key_cols, order, inclusive) for n, (kind, e) in columns.items()})
    base = df.withColumn("_block", block_of(c(order), size))
    values = {f"_v_{n}": e for n, (_, e) in columns.items()}
    base = base.withColumns(values)

    aggregates, carries, local = [], {}, {}
    until = 0 if inclusive else -1
    over_rows = Window.partitionBy(*key_cols, F.col("_block")).orderBy(c(order))
    from_end = Window.partitionBy(*key_cols, F.col("_block")).orderBy(c(order).desc())
    over_blocks = Window.partitionBy(*key_cols).orderBy("_block")
    for name, (kind, _) in columns.items():
        v, part, carry = F.col(f"`_v_{name}`"), f"_p_{name}", f"_c_{name}"
        before = over_blocks.rowsBetween(Window.unboundedPreceding, -1)
        # "next" scans from the end: a frame that grows costs one pass, one that shrinks is evaluated anew for every row.
        rows = (from_end if kind == "next" else over_rows).rowsBetween(Window.unboundedPreceding, until)
        if kind in ("sum", "min", "max"):
            fn = getattr(F, kind)
            aggregates.append(fn(v).alias(part))
            carries[carry] = fn(c(part)).over(before)
            local[f"_l_{name}"] = fn(v).over(rows)
        elif kind == "last":
            aggregates.append(F.max_by(v, F.when(v.isNotNull(), c(order))).alias(part))
            carries[carry] = F.last(c(part), ignorenulls=True).over(before)
            local[f"_l_{name}"] = F.last(v, ignorenulls=True).over(rows)
        elif kind == "next":
            aggregates.append(F.min_by(v, F.when(v.isNotNull(), c(order))).alias(part))
            after = Window.partitionBy(*key_cols).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
            carries[carry] = F.last(c(part), ignorenulls=True).over(after)
            local[f"_l_{name}"] = F.last(v, ignorenulls=True).over(rows)
        else:
            raise ValueError(f"unknown scan {kind!r}")

    per_block = base.groupBy(*key_cols, F.col("_block")).agg(*aggregates)
    carry_names = list(carries)
    carried = per_block.withColumns(carries).select(*key_cols, "_block", *[c(n) for n in carry_names])
    carried = carried.filter(_any_not_null(carry_names))
    joined = base.join(carried, [*keys, "_block"], "left").withColumns(local)

    results = {}
    for name, (kind, _) in columns.items():
        here, carry = c(f"_l_{name}"), c(f"_c_{name}")
        if kind == "sum":
            results[name] = F.when(here.isNull() & carry.isNull(), None).otherwise(
                F.coalesce(here, F.lit(0)) + F.coalesce(carry, F.lit(0))
            )
        elif kind in ("min", "max"):
            results[name] = (F.least if kind == "min" else F.greatest)(here, carry)
        else:
            results[name] = F.coalesce(here, carry)
    scratch = ["_block"] + [f"{p}{n}" for n in columns for p in ("_v_", "_l_", "_c_")]
    return joined.withColumns(results).drop(*scratch)


def _scan(kind: str, value: Column, keys: Sequence[Column], order: str, inclusive: bool) -> Column:
    by = c(order).desc() if kind == "next" else c(order)
    rows = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    if kind in ("last", "next"):
        return F.last(value, ignorenulls=True).over(rows)
    return getattr(F, kind)(value).over(rows)


def _any_not_null(names: Sequence[str]) -> Column:
    found = c(names[0]).isNotNull()
    for name in names[1:]:
        found = found | c(name).isNotNull()
    return found


def join_episodes(
    frames: DataFrame,
    episodes: DataFrame,
    how: str = "inner",
    length: str = "length",
    keys: Sequence[str] = (EPISODE,),
    order: str = FRAME,
) -> DataFrame:
    """Join one row per episode to its frames on ``(episode, block)``; ``episodes`` must hold the episode length.

    The episode side grows by one row per block, so the join has no hot key, and Spark still broadcasts it when its
    size is under ``spark.sql.autoBroadcastJoinThreshold``.
    """
    size = block_rows(frames)
    last = block_of(F.greatest(c(length), F.lit(1)) - 1, size)
    spread = episodes.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    if length in frames.columns and length not in keys:
        spread = spread.drop(length)
    return frames.withColumn("_block", block_of(c(order), size)).join(spread, [*keys, "_block"], how).drop("_block")


def dictionary_join(
    rows: DataFrame, entries: DataFrame, on: str | Sequence[str], salt_by: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join to a dictionary whose keys may be very unevenly used.

    Each entry is repeated once per salt, and rows pick a salt from ``salt_by``; when Spark finds the dictionary under
    its broadcast threshold it broadcasts, otherwise a frequent key is still spread over ``salts`` tasks.
    """
    salts = _conf(rows, SALTS_CONF, DEFAULT_SALTS)
    keys = [on] if isinstance(on, str) else list(on)
    salted = entries.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64(*[c(s) for s in salt_by]), F.lit(salts)).cast("int")
    return rows.withColumn("_salt", salt).join(salted, [*keys, "_salt"], how).drop("_salt")


def join_numbered(frames: DataFrame, episodes: DataFrame, key: str, longest: int) -> DataFrame:
    """``join_episodes`` for frames that ``positions`` has numbered within ``key``.

    If no group is hot they lie by key already and meet the episode table there; blocks would shuffle them again.
    """
    if longest > hot_rows(frames):
        return join_episodes(frames, episodes, keys=(key,))
    return frames.join(episodes.drop("length") if "length" in frames.columns else episodes, key)


def text_join(rows: DataFrame, entries: DataFrame, on: str, salt_by: Sequence[str], how: str = "left") -> DataFrame:
    """``dictionary_join`` to texts that are kept: their bytes, not an estimate, tell whether they are broadcast."""
    held = entries.agg(F.sum(F.octet_length(c(on)) + 16)).first()[0] or 0
    if held > DICTIONARY_BYTES:
        return dictionary_join(rows, entries, on, salt_by, how)
    return rows.join(F.broadcast(entries), on, how)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session, as in tests, may go without and gets a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="trajspark-")


def set_checkpoint_dir(df: DataFrame) -> None:
    """Checkpoint to the shared folder, unless the session has a checkpoint folder already."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))


def has_hot_group(df: DataFrame, keys: Sequence[str] = ()) -> bool:
    """Whether a group has more than ``spark.trajspark.hotGroupRows`` rows; one counting pass over the keys."""
    hot_rows = _conf(df, HOT_ROWS_CONF, DEFAULT_HOT_ROWS)
    counts = df.groupBy(*[c(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return not counts.filter(F.col("_n") > hot_rows).isEmpty()


def sorted_running(
    df: DataFrame, columns: Mapping[str, tuple[str, Column]], order: Sequence[str], keys: Sequence[str] = (EPISODE,)
) -> DataFrame:
    """``running`` along any sort order instead of a dense number.

    Without a hot group the scans are plain windows over one sort per direction. With one, rows are numbered by
    ``positions`` and scanned in blocks. Keys must not be null.
    """
    if has_hot_group(df, keys):
        return running(positions(df, "_at", order, keys), columns, keys, "_at").drop("_at")
    rows = Window.partitionBy(*[c(k) for k in keys])
    until = (Window.unboundedPreceding, Window.currentRow)
    up = rows.orderBy(*[c(o).asc() for o in order]).rowsBetween(*until)
    down = rows.orderBy(*[c(o).desc() for o in order]).rowsBetween(*until)
    scans = {
        "sum": lambda e: F.sum(e).over(up),
        "min": lambda e: F.min(e).over(up),
        "max": lambda e: F.max(e).over(up),
        "last": lambda e: F.last(e, ignorenulls=True).over(up),
        "next": lambda e: F.last(e, ignorenulls=True).over(down),
    }
    return df.withColumns({name: scans[kind](e) for name, (kind, e) in columns.items()})


def positions(
    df: DataFrame, name: str, order: Sequence[str], keys: Sequence[str] = (), at_most: int | None = None
) -> DataFrame:
    """Add the dense 0-based position of each row in its group, in the given order.

    One pass over the key column tells whether a group is above ``spark.trajspark.hotGroupRows`` rows. Without any, a plain
    window does the work. Otherwise the rows are range-partitioned by keys and order, so a hot group is cut into as many
    pieces as it fills partitions, equal leading values by the next order column; each row's piece is fixed by a
    checkpoint, and the counts per piece make the positions exact. Rows equal in keys and order are told apart by a hash of
    their other columns, so only repeated rows stay together. A caller that knows the table has ``at_most`` rows below the threshold saves the pass.
    """
    hot_rows = _conf(df, HOT_ROWS_CONF, DEFAULT_HOT_ROWS)
    key_cols = [c(k) for k in keys]
    order_cols = [c(o) for o in order]
    if (at_most is not None and at_most <= hot_rows) or not has_hot_group(df, keys):
        window = Window.partitionBy(*key_cols).orderBy(*order_cols)
        return df.withColumn(name, (F.row_number().over(window) - 1).cast("long"))

    set_checkpoint_dir(df)
    parts = max(_conf(df, "spark.sql.shuffle.partitions", 200), -(-df.count() // hot_rows))
    tie = F.xxhash64(*[c(f.name) for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    order_cols = [*order_cols, F.col("_tie")]
    ranged = df.withColumn("_tie", tie).repartitionByRange(parts, *key_cols, *order_cols)
    pieces = ranged.withColumn("_piece", F.spark_partition_id()).checkpoint()
    # A null key is a group like any other, which an equi-join would lose: keys travel as one struct inside an array.
    group = F.array(F.struct(*key_cols)) if keys else F.lit(0)
    pieces = pieces.withColumn("_group", group)
    counts = pieces.groupBy("_group", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_piece_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = Window.partitionBy("_group", "_piece").orderBy(*order_cols)
    ranked = pieces.withColumn("_piece_at", F.row_number().over(local) - 1).join(offsets, ["_group", "_piece"])
    place = (F.col("_piece_from") + F.col("_piece_at")).cast("long")
    return ranked.withColumn(name, place).drop("_piece_at", "_piece_from", "_piece", "_group", "_tie")
