"""Reading and writing dataset directories.

A directory holds ``meta/info.json``, ``meta/stats.json``, ``meta/tasks.parquet``, optionally ``meta/subtasks.parquet``,
``meta/episodes/**`` and ``data/**``. Data files are packed by size; a file of the plan is a directory
``data/chunk_index=C/file_index=F`` that Spark's committer fills, so a lost executor leaves no partial file. An episode
larger than a file is written by several tasks. ``publish_names`` gives files the ``chunk-CCC/file-FFF.parquet`` names.
"""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.dataset import CHUNK_FILES, DATA_FILE_MB, FORMAT_VERSION, VIDEO_FILE_MB, EpisodicDataset
from trajspark.functions.columns import block_of, c
from trajspark.functions.text import path_number
from trajspark.operators.algebra import lay_out, new_episode_parts
from trajspark.operators.layout import EPISODE, FRAME, block_rows, join_episodes, positions, set_checkpoint_dir
from trajspark.operators.packing import pack_files
from trajspark.operators.schema import SHORT_LIST, filter_episodes, infer_features
from trajspark.operators.stats import combine_stats, stats_to_frame

DATA_PATH = "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet"
VIDEO_PATH = "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4"
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


# ---------------------------------------------------------------- metadata files


def _read_text(spark: SparkSession, path: str) -> str | None:
    """Whole small metadata file through Spark's file systems; None when it does not exist."""
    try:
        return spark.read.option("wholetext", "true").text(path).first()[0]
    except Exception as e:  # noqa: BLE001 - only a missing path is expected
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    import pyarrow.fs as pafs

    fs, where = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    fs.create_dir(where.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(where) as out:
        out.write(text.encode())


def check_version(info: Mapping) -> None:
    """An older major version raises, an older minor version warns."""

    def parts(v: str) -> tuple[int, int]:
        numbers = [int(x) for x in v.lstrip("v").split(".")]
        return numbers[0], numbers[1] if len(numbers) > 1 else 0

    have, want = parts(info.get("codebase_version", FORMAT_VERSION)), parts(FORMAT_VERSION)
    if have[0] < want[0]:
        raise ValueError(f"dataset version {info['codebase_version']} is too old, convert it to {FORMAT_VERSION} first")
    if have < want:
        warnings.warn(f"dataset version {info['codebase_version']} is older than {FORMAT_VERSION}", stacklevel=3)


def read_info(spark: SparkSession, root: str) -> dict:
    text = _read_text(spark, f"{root}/meta/info.json")
    if text is None:
        raise FileNotFoundError(f"{root}/meta/info.json")
    return json.loads(text)


def read_stats(spark: SparkSession, root: str) -> DataFrame | None:
    text = _read_text(spark, f"{root}/meta/stats.json")
    return None if text is None else stats_to_frame(spark, json.loads(text))


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta/tasks.parquet")


def read_subtasks(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{root}/meta/subtasks.parquet")
    except Exception as e:  # noqa: BLE001 - the dictionary is optional
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def read_episodes(spark: SparkSession, root: str, with_stats: bool = False) -> DataFrame:
    """Episode table; its ``stats/*`` columns are only read when asked for."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    table = reader.parquet(f"{root}/meta/episodes")
    return table if with_stats else table.select(*[c(n) for n in table.columns if not n.startswith("stats/")])


def _open_folders(spark: SparkSession, reader: DataFrameReader, paths: Sequence[str]) -> DataFrame:
    """Load a tree with a folder per file; a few tasks list many folders each, where Spark would start a task per folder."""
    before = spark.conf.get(LISTING_CONF, None)
    spark.conf.set(LISTING_CONF, 2 * spark.sparkContext.defaultParallelism)
    try:
        return reader.option("recursiveFileLookup", "true").load(list(paths))
    finally:
        if before is None:
            spark.conf.unset(LISTING_CONF)
        else:
            spark.conf.set(LISTING_CONF, before)


def read_dataset(spark: SparkSession, root: str, episodes: Sequence[int] | None = None) -> EpisodicDataset:
    """Open a dataset lazily; an episode list becomes a predicate on the scan, and on the files where their names allow."""
    info = read_info(spark, root)
    check_version(info)
    table = read_episodes(spark, root)
    reader = spark.read.format("parquet")
    if "frame_schema" in info:
        reader = reader.schema(T.StructType.fromJson(info["frame_schema"]))
    paths = [f"{root}/data"]
    if episodes is not None:
        table = filter_episodes(table, episodes)
        if info.get("exact_names", True) and len(episodes) <= SHORT_LIST and "data/chunk_index" in table.columns:
            named = episode_file_paths(table).limit(SHORT_LIST + 1).collect()
            if 0 < len(named) <= SHORT_LIST:
                # A file that several tasks wrote has numbered ones beside it.
                paths = [f"{root}/{r['path'].removesuffix('.parquet')}{{.parquet,-*.parquet}}" for r in named]
    frames = _open_folders(spark, reader, paths)
    if episodes is not None:
        frames = filter_episodes(frames, episodes)
    return EpisodicDataset(frames, table, read_tasks(spark, root), info, read_stats(spark, root), None, read_subtasks(spark, root))


def episode_file_paths(episodes: DataFrame, video_keys: Sequence[str] = ()) -> DataFrame:
    """Distinct data and video files of the given episodes."""
    out = episodes.select(F.format_string("data/chunk-%03d/file-%03d.parquet", c("data/chunk_index"), c("data/file_index")).alias("path"))
    for key in video_keys:
        name = F.format_string(f"videos/{key}/chunk-%03d/file-%03d.mp4", c(f"videos/{key}/chunk_index"), c(f"videos/{key}/file_index"))
        out = out.unionByName(episodes.select(name.alias("path")))
    return out.distinct()


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path relative to the root, bytes) of all files; contents are not read."""
    files = _open_folders(spark, spark.read.format("binaryFile").option("pathGlobFilter", pattern), [root])
    base = root.rstrip("/") + "/"
    at = F.locate(base, F.col("path"))
    return files.filter(at > 0).select(F.substr(F.col("path"), at + len(base)).alias("path"), "length")


def validate_files(spark: SparkSession, root: str, video_keys: Sequence[str] = ()) -> DataFrame:
    """Files the episode table names but the directory lacks; no episode at all is an error."""
    from trajspark.operators.joins import missing_files

    episodes = read_episodes(spark, root)
    if episodes.isEmpty():
        raise ValueError("the dataset has no episodes")
    return missing_files(episode_file_paths(episodes, video_keys), list_files(spark, root, "*"))


# ---------------------------------------------------------------- writing


def frame_bytes(frames: DataFrame) -> int:
    """Estimated bytes of one frame from its types; arrays by the length found in one row."""
    row, width = frames.first(), 0
    sizes = {"float": 4, "int": 4, "double": 8, "bigint": 8, "boolean": 1, "smallint": 2, "tinyint": 1}
    for name, kind in frames.dtypes:
        n, value, base = 1, None if row is None else row[name], kind
        while base.startswith("array<"):
            n *= len(value) if value else 1
            value, base = (value[0] if value else None), base[6:-1]
        width += n * sizes.get(base, len(str(value)) if value is not None else 8)
    return max(width, 1)


def _write_frames(frames: DataFrame, episodes: DataFrame, path: str, mode: str, partitions: str = "static") -> None:
    size = block_rows(frames)
    plan = episodes.select(EPISODE, "length", c("data/chunk_index").alias("chunk_index"), c("data/file_index").alias("file_index"))
    extra = [] if "length" in frames.columns else ["length"]
    placed = join_episodes(frames, plan).drop(*extra)
    # A task gets the rows of one file, or one block of an episode that is larger than that.
    spread = placed.repartition("chunk_index", "file_index", block_of(c(FRAME), size))
    ordered = spread.sortWithinPartitions("chunk_index", "file_index", EPISODE, FRAME)
    writer = ordered.write.mode(mode).option("partitionOverwriteMode", partitions)
    writer.partitionBy("chunk_index", "file_index").parquet(path)


def write_dataset(ds: EpisodicDataset, root: str, max_mb: float = DATA_FILE_MB, bytes_per_frame: int | None = None) -> EpisodicDataset:
    """Write all parts of a dataset and open the result.

    The file plan packs episodes in order up to ``max_mb`` of estimated uncompressed bytes.
    """
    spark = ds.frames.sparkSession
    per_frame = bytes_per_frame or frame_bytes(ds.frames)
    sized = ds.episodes.drop("data/chunk_index", "data/file_index").withColumn("_bytes", F.col("length") * per_frame)
    planned = pack_files(sized, "_bytes", max_mb).drop("_bytes")
    planned = _with_stats_columns(planned, ds.episode_stats)
    planned.sort(EPISODE).write.mode("overwrite").parquet(f"{root}/meta/episodes")
    episodes = read_episodes(spark, root)
    _write_frames(ds.frames, episodes, f"{root}/data", "overwrite")
    ds.tasks.select("task_index", "task").write.mode("overwrite").parquet(f"{root}/meta/tasks.parquet")
    if ds.subtasks is not None:
        ds.subtasks.write.mode("overwrite").parquet(f"{root}/meta/subtasks.parquet")
    if ds.stats is not None:
        _write_text(spark, f"{root}/meta/stats.json", json.dumps(nested_stats(ds.stats)))
    totals = episodes.agg(F.count(F.lit(1)).alias("e"), F.coalesce(F.sum("length"), F.lit(0)).alias("f")).first()
    features = ds.features or infer_features(ds.frames)
    info = {
        "codebase_version": FORMAT_VERSION,
        "robot_type": None,
        "chunks_size": CHUNK_FILES,
        "data_files_size_in_mb": max_mb,
        "video_files_size_in_mb": VIDEO_FILE_MB,
        "data_path": DATA_PATH,
        "video_path": VIDEO_PATH,
        **ds.info,
        "features": features,
        "total_episodes": totals["e"],
        "total_frames": totals["f"],
        "total_tasks": ds.tasks.count(),
        "splits": ds.info.get("splits", {"train": f"0:{totals['e']}"}),
        "exact_names": False,
        "bytes_per_frame": per_frame,
        "frame_schema": json.loads(ds.frames.schema.json()),
    }
    _write_text(spark, f"{root}/meta/info.json", json.dumps(info))
    return read_dataset(spark, root)


def _with_stats_columns(episodes: DataFrame, episode_stats: DataFrame | None) -> DataFrame:
    """Per-episode statistics as ``stats/<feature>/<stat>`` arrays; one row per number of a frame joins per episode."""
    if episode_stats is None:
        return episodes
    names = [n for n in episode_stats.columns if n not in (EPISODE, "feature", "dim")]
    features = sorted(r[0] for r in episode_stats.select("feature").distinct().collect())
    aggs = []
    for f in features:
        for n in names:
            pairs = F.collect_list(F.when(F.col("feature") == f, F.struct("dim", n)))
            aggs.append(_stat_array(pairs, n).alias(f"stats/{f}/{n}"))
    return episodes.join(episode_stats.groupBy(EPISODE).agg(*aggs), EPISODE, "left")


def _stat_array(pairs, name: str):
    return F.transform(F.array_sort(pairs), lambda x: x[name])


def nested_stats(stats: DataFrame) -> dict:
    """Long table to ``{feature: {stat: [per dim]}}`` with one count per feature."""
    from trajspark.operators.numeric import stats_literals

    out = stats_literals(stats)
    return {f: {k: (v[:1] if k == "count" else v) for k, v in s.items()} for f, s in out.items()}


def append_dataset(
    spark: SparkSession, root: str, rows: DataFrame, key: str, order: Sequence[str], key_column: str | None = None
) -> EpisodicDataset:
    """Append episodes to a written dataset: indices continue, new rows go to the files after the last one.

    The rows of the episode table are the commit: they are written last, and an attempt that failed before is written
    over, since it was given the same file numbers. ``key_column`` keeps the source key of each episode under that name.
    """
    ds = read_dataset(spark, root)
    before = ds.episodes.agg(F.max(F.struct(c("data/chunk_index").alias("c"), c("data/file_index").alias("f"))).alias("at")).first()
    at = before["at"]
    frames, episodes, tasks = new_episode_parts(ds, rows, key, order)
    per_frame = ds.info.get("bytes_per_frame") or frame_bytes(ds.frames)
    dense = positions(episodes, "_at", [EPISODE]).withColumn("_bytes", F.col("length") * per_frame)
    limit = ds.info.get("data_files_size_in_mb", DATA_FILE_MB)
    planned = pack_files(dense, "_bytes", limit, CHUNK_FILES, "_at").drop("_at", "_bytes")
    first = 0 if at is None else at["c"] * CHUNK_FILES + at["f"] + 1
    number = F.lit(first) + c("data/chunk_index") * CHUNK_FILES + c("data/file_index")
    planned = planned.withColumns({"data/chunk_index": F.floor(number / CHUNK_FILES), "data/file_index": number % CHUNK_FILES})
    planned = planned.withColumnRenamed(key, key_column) if key_column else planned.drop(key)
    set_checkpoint_dir(rows)
    planned = planned.checkpoint()
    dictionary = [tuple(r) for r in tasks.select("task_index", "task").collect()]
    _write_frames(frames, planned, f"{root}/data", "overwrite", "dynamic")
    schema = ds.tasks.select("task_index", "task").schema
    spark.createDataFrame(dictionary, schema).write.mode("overwrite").parquet(f"{root}/meta/tasks.parquet")
    planned.write.mode("append").parquet(f"{root}/meta/episodes")
    totals = read_episodes(spark, root).agg(F.count(F.lit(1)).alias("e"), F.sum("length").alias("f")).first()
    info = {
        **ds.info,
        "total_episodes": totals["e"],
        "total_frames": totals["f"],
        "total_tasks": len(dictionary),
        "splits": {"train": f"0:{totals['e']}"},
        "exact_names": False,
    }
    _write_text(spark, f"{root}/meta/info.json", json.dumps(info))
    return read_dataset(spark, root)


def publish_names(spark: SparkSession, root: str) -> DataFrame:
    """Move written files to ``data/chunk-CCC/file-FFF.parquet``; the moves run as tasks, one row per file.

    A file of the plan that several tasks wrote becomes ``file-FFF-1.parquet`` and so on; readers take all of ``data``.
    """
    files = list_files(spark, f"{root}/data").filter(F.col("path").contains("chunk_index="))
    numbered = files.select(
        F.col("path").alias("source"), path_number(F.col("path"), "chunk_index=").alias("chunk"), path_number(F.col("path"), "file_index=").alias("file")
    )
    numbered = positions(numbered, "part", ["source"], ["chunk", "file"])
    suffix = F.when(F.col("part") == 0, "").otherwise(F.format_string("-%d", F.col("part")))
    target = F.concat(F.format_string("chunk-%03d/file-%03d", "chunk", "file"), suffix, F.lit(".parquet"))

    def move(parts):
        import pyarrow.fs as pafs

        base = f"{root}/data"
        fs, where = pafs.FileSystem.from_uri(base) if "://" in base else (pafs.LocalFileSystem(), base)
        for pdf in parts:
            for src, dst in zip(pdf["source"], pdf["target"]):
                fs.create_dir(f"{where}/{dst.split('/')[0]}", recursive=True)
                # A retried task finds its earlier moves done.
                if fs.get_file_info(f"{where}/{src}").type != pafs.FileType.NotFound:
                    fs.move(f"{where}/{src}", f"{where}/{dst}")
            yield pdf

    pairs = numbered.select("source", target.alias("target"))
    moved = pairs.mapInPandas(move, pairs.schema)
    moved.write.format("noop").mode("overwrite").save()
    info = {**read_info(spark, root), "exact_names": True}
    _write_text(spark, f"{root}/meta/info.json", json.dumps(info))
    return episode_file_paths(read_episodes(spark, root))


# ---------------------------------------------------------------- older layout


def read_legacy(spark: SparkSession, root: str) -> EpisodicDataset:
    """One Parquet file per episode and JSON-lines metadata; episode statistics become long rows."""
    info = read_info(spark, root)
    files = _open_folders(spark, spark.read.format("parquet"), [f"{root}/data"])
    named = files.withColumn("_file_episode", path_number(F.col("_metadata.file_path"), "episode_"))
    episodes = spark.read.json(f"{root}/meta/episodes.jsonl")
    tasks = spark.read.json(f"{root}/meta/tasks.jsonl").select(F.col("task_index").cast("long").alias("task_index"), "task")
    stats = _legacy_stats(spark, f"{root}/meta/episodes_stats.jsonl")
    return EpisodicDataset(named, episodes, tasks, info, None, stats)


def _legacy_stats(spark: SparkSession, path: str) -> DataFrame | None:
    text = spark.read.text(path)
    kind = "map<string, map<string, array<double>>>"
    parsed = text.select(F.get_json_object("value", "$.episode_index").cast("long").alias(EPISODE), F.from_json(F.get_json_object("value", "$.stats"), kind).alias("_s"))
    rows = parsed.select(EPISODE, F.explode("_s").alias("feature", "_m"))
    at = lambda n: F.get(F.col("_m")[n], F.col("dim"))
    rows = rows.select(EPISODE, "feature", "_m", F.explode(F.sequence(F.lit(0), F.size(F.col("_m")["mean"]) - 1)).alias("dim"))
    return rows.select(EPISODE, "feature", "dim", *[at(n).alias(n) for n in ("min", "max", "mean", "std")], F.col("_m")["count"][0].cast("long").alias("count"))


def convert_legacy(spark: SparkSession, root: str, out: str, max_mb: float = DATA_FILE_MB, chunks: tuple[int, int] | None = None) -> EpisodicDataset:
    """Old layout to the current one: pack files, join all per-episode tables, combine statistics, rewrite the info.

    The episode numbers of files, metadata and statistics must be the same set. ``chunks`` converts a range of source
    chunks only and re-bases the totals.
    """
    old = read_legacy(spark, root)
    frames = old.frames
    if chunks is not None:
        number = path_number(F.col("_metadata.file_path"), "chunk-")
        frames = frames.filter((number >= chunks[0]) & (number < chunks[1]))
    sizes = frames.groupBy(F.col("_file_episode").alias(EPISODE)).agg(
        F.count(F.lit(1)).alias("length"), F.max(F.col("_metadata.file_size")).alias("_bytes")
    )
    # One row per episode, kept: each use would open all files again.
    set_checkpoint_dir(frames)
    sizes = sizes.checkpoint()
    if sizes.isEmpty():
        raise ValueError(f"no episode files under {root}/data")
    for name, other in (("metadata", old.episodes), ("statistics", old.episode_stats)):
        if other is None:
            continue
        ids = other.select(F.col(EPISODE).cast("long").alias(EPISODE)).distinct()
        lacking = sizes.join(ids, EPISODE, "left_anti")
        surplus = ids.join(sizes, EPISODE, "left_anti") if chunks is None else ids.limit(0)
        if not lacking.isEmpty() or not surplus.isEmpty():
            raise ValueError(f"episodes of data files and {name} differ")
    meta = old.episodes.select(F.col(EPISODE).cast("long").alias(EPISODE), "tasks")
    dense = positions(sizes, "_at", [EPISODE])
    laid = lay_out(dense.withColumnRenamed(EPISODE, "_id").withColumnRenamed("_at", EPISODE)).withColumnRenamed(EPISODE, "_at").withColumnRenamed("_id", EPISODE)
    packed = pack_files(laid, "_bytes", max_mb, order="_at").drop("_at", "_bytes")
    episodes = packed.join(meta, EPISODE)
    plan = episodes.select(EPISODE, "length", "dataset_from_index")
    moved = join_episodes(frames.drop("_file_episode", "index"), plan)
    moved = moved.withColumn("index", F.col("dataset_from_index") + F.col(FRAME)).drop("dataset_from_index", "length")
    stats = None
    per_episode = old.episode_stats
    if per_episode is not None:
        per_episode = per_episode.join(sizes.select(EPISODE), EPISODE, "left_semi")
        stats = combine_stats(per_episode)
    planned = _with_stats_columns(episodes, per_episode)
    planned.sort(EPISODE).write.mode("overwrite").parquet(f"{out}/meta/episodes")
    _write_frames(moved, read_episodes(spark, out), f"{out}/data", "overwrite")
    old.tasks.write.mode("overwrite").parquet(f"{out}/meta/tasks.parquet")
    if stats is not None:
        _write_text(spark, f"{out}/meta/stats.json", json.dumps(nested_stats(stats)))
    totals = read_episodes(spark, out).agg(F.count(F.lit(1)).alias("e"), F.sum("length").alias("f")).first()
    fps = int(old.info["fps"])
    info = {k: v for k, v in old.info.items() if k not in ("total_chunks", "total_videos")}
    features = {k: (v if v["dtype"] == "video" else {**v, "fps": fps}) for k, v in old.features.items()}
    info |= {
        "codebase_version": FORMAT_VERSION,
        "fps": fps,
        "features": features,
        "data_files_size_in_mb": max_mb,
        "video_files_size_in_mb": VIDEO_FILE_MB,
        "data_path": DATA_PATH,
        "total_episodes": totals["e"],
        "total_frames": totals["f"],
        "splits": {"train": f"0:{totals['e']}"},
        "exact_names": False,
    }
    _write_text(spark, f"{out}/meta/info.json", json.dumps(info))
    return read_dataset(spark, out)
