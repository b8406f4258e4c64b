"""Projections, validation and schema work."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.dataset import REQUIRED_COLUMNS, EpisodicDataset
from trajspark.functions.columns import c
from trajspark.operators.layout import EPISODE, FRAME

# Feature dtypes and their Spark types.
SPARK_TYPES = {
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "int8": T.ByteType(),
    "uint8": T.ShortType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
}
IMAGE_TYPE = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])
MAX_RANK = 5
SHORT_LIST = 1_000


# ---------------------------------------------------------------- feature spec and schema


def feature_type(name: str, spec: Mapping) -> T.DataType | None:
    """Spark type of a feature; videos have no column."""
    if "/" in name:
        raise ValueError(f"feature name {name!r} must not contain '/'")
    dtype, shape = spec["dtype"], list(spec["shape"])
    if dtype == "video":
        return None
    if dtype == "image":
        return IMAGE_TYPE
    base = SPARK_TYPES[dtype]
    if shape == [1] or dtype == "string":
        return base
    if len(shape) > MAX_RANK:
        raise ValueError(f"feature {name!r} has rank {len(shape)}, at most {MAX_RANK} is supported")
    for _ in shape:
        base = T.ArrayType(base)
    return base


def frame_schema(features: Mapping[str, Mapping]) -> T.StructType:
    """Frame schema of a feature spec; shape and names are kept as field metadata."""
    fields = []
    for name, spec in features.items():
        kind = feature_type(name, spec)
        if kind is not None:
            fields.append(T.StructField(name, kind, True, {"shape": list(spec["shape"]), "names": spec.get("names"), "dtype": spec["dtype"]}))
    return T.StructType(fields)


def infer_features(frames: DataFrame) -> dict[str, dict]:
    """Feature spec from one row: scalars, vectors and nested arrays as float32 unless integer, boolean or string.

    A rank-3 array whose first side is 1 or 3 is an image.
    """
    row = frames.first()
    out = {}
    for field in frames.schema.fields:
        kind, value, shape = field.dataType, None if row is None else row[field.name], []
        while isinstance(kind, T.ArrayType):
            shape.append(len(value) if value is not None else 0)
            value = value[0] if value else None
            kind = kind.elementType
        dtype = {
            T.LongType: "int64",
            T.IntegerType: "int32",
            T.BooleanType: "bool",
            T.StringType: "string",
            T.DoubleType: "float32",
        }.get(type(kind), "float32")
        if len(shape) == 3 and shape[0] in (1, 3):
            dtype = "image"
        out[field.name] = {"dtype": dtype, "shape": shape or [1], "names": None}
    return out


# ---------------------------------------------------------------- filters and column edits


def filter_episodes(frames: DataFrame, ids: Sequence[int] | DataFrame) -> DataFrame:
    """Frames of some episodes, keeping the absolute ``index``; a short list becomes a pushed-down predicate.

    A table of ids is joined as it is: it may be long, and copies of it for salts would reach the driver in a broadcast.
    A semi join needs no distinct ids, and Spark can cut the frames of an episode that fills a partition.
    """
    if isinstance(ids, DataFrame):
        return frames.join(ids.select(EPISODE), EPISODE, "left_semi")
    if len(ids) <= SHORT_LIST:
        return frames.filter(F.col(EPISODE).isin([int(i) for i in ids]))
    table = frames.sparkSession.createDataFrame([(int(i),) for i in ids], f"{EPISODE} long")
    return filter_episodes(frames, table)


def subset(ds: EpisodicDataset, ids: Sequence[int]) -> EpisodicDataset:
    """View of a dataset on some episodes; totals follow, episode numbers and indices stay."""
    episodes = ds.episodes.filter(F.col(EPISODE).isin([int(i) for i in ids]))
    return ds.with_(frames=filter_episodes(ds.frames, ids), episodes=episodes)


def subset_columns(ds: EpisodicDataset, names: Sequence[str]) -> EpisodicDataset:
    """View of a dataset on some features; the required columns stay."""
    kept = [n for n in ds.frames.columns if n in names or n in REQUIRED_COLUMNS]
    features = {k: v for k, v in ds.features.items() if k in names or k in REQUIRED_COLUMNS}
    return ds.with_(frames=ds.frames.select(*[c(n) for n in kept]), info={**ds.info, "features": features})


def totals(ds: EpisodicDataset) -> DataFrame:
    return ds.episodes.agg(F.count(F.lit(1)).alias("num_episodes"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("num_frames"))


def remove_features(ds: EpisodicDataset, names: Sequence[str]) -> EpisodicDataset:
    return modify_features(ds, remove=names)


def add_features(ds: EpisodicDataset, features: Mapping[str, tuple]) -> EpisodicDataset:
    return modify_features(ds, add=features)


def modify_features(
    ds: EpisodicDataset, add: Mapping[str, tuple] | None = None, remove: Sequence[str] | None = None
) -> EpisodicDataset:
    """Add and remove frame columns in one pass.

    A value to add is a ``Column``, a DataFrame ``(index, value)`` aligned by the global index, or a function
    ``fn(row, episode_index, frame_index)`` evaluated batch-wise. Statistics of removed features go, new ones get none.
    """
    if not add and not remove:
        raise ValueError("nothing to add or remove")
    known = set(ds.frames.columns) | set(ds.features)
    for name in remove or ():
        if name not in known:
            raise ValueError(f"feature {name!r} is not in the dataset")
        if name in REQUIRED_COLUMNS:
            raise ValueError(f"feature {name!r} is required and cannot be removed")
    for name, (_, spec) in (add or {}).items():
        if name in known:
            raise ValueError(f"feature {name!r} already exists")
        if "dtype" not in spec or "shape" not in spec:
            raise ValueError(f"the spec of {name!r} needs 'dtype' and 'shape'")

    frames = ds.frames.drop(*(remove or ()))
    features = {k: v for k, v in ds.features.items() if k not in (remove or ())}
    for name, (value, spec) in (add or {}).items():
        features[name] = dict(spec)
        kind = feature_type(name, spec)
        if isinstance(value, DataFrame):
            column = F.col("value")
            if list(spec["shape"]) == [1] and isinstance(value.schema["value"].dataType, T.ArrayType):
                column = column[0]
            frames = frames.join(value.select("index", column.cast(kind).alias(name)), "index", "left")
        elif isinstance(value, Column):
            frames = frames.withColumn(name, value.cast(kind))
        else:
            frames = row_feature(frames, name, value, kind)
    stats = ds.stats
    if stats is not None and remove:
        stats = stats.filter(~F.col("feature").isin(list(remove)))
    return ds.with_(frames=frames, info={**ds.info, "features": features}, stats=stats)


def map_batches(frames: DataFrame, fn: Callable, schema: T.StructType) -> DataFrame:
    """``mapInPandas`` for columns whose names hold dots; ``fn`` sees and returns the real names."""
    real, made = frames.columns, [f.name for f in schema.fields]
    safe_in = frames.toDF(*[f"c{i}" for i in range(len(real))])
    safe_out = T.StructType([T.StructField(f"o{i}", f.dataType) for i, f in enumerate(schema.fields)])

    def batches(parts):
        for pdf in fn(p.set_axis(real, axis=1) for p in parts):
            yield pdf[made].set_axis([f"o{i}" for i in range(len(made))], axis=1)

    return safe_in.mapInPandas(batches, safe_out).toDF(*made)


def row_feature(frames: DataFrame, name: str, fn: Callable, kind: T.DataType) -> DataFrame:
    """Column from a row function, in Arrow batches."""
    schema = T.StructType([*frames.schema.fields, T.StructField(name, kind)])

    def batches(parts):
        for pdf in parts:
            rows = pdf.to_dict("records")
            yield pdf.assign(**{name: [fn(r, r[EPISODE], r[FRAME]) for r in rows]})

    return map_batches(frames, batches, schema)


def rename_columns(frames: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return frames.withColumnsRenamed(dict(names))


def rename_stats(stats: DataFrame, names: Mapping[str, str]) -> DataFrame:
    if not names:
        return stats
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return stats.withColumn("feature", F.coalesce(pairs[F.col("feature")], F.col("feature")))


# ---------------------------------------------------------------- validation


def schema_problems(frames: DataFrame, features: Mapping[str, Mapping]) -> list[str]:
    """Missing and extra features and wrong types, from the schema alone."""
    expected = {f.name: f.dataType for f in frame_schema(features).fields}
    actual = {f.name: f.dataType for f in frames.schema.fields}
    problems = [f"missing feature {n}" for n in expected if n not in actual]
    problems += [f"extra feature {n}" for n in actual if n not in features and n not in REQUIRED_COLUMNS and n != "task"]
    for name in expected:
        if name in actual and features[name]["dtype"] != "image" and actual[name] != expected[name]:
            problems.append(f"feature {name} has type {actual[name].simpleString()}, expected {expected[name].simpleString()}")
    return problems


def _shape_rules(name: str, spec: Mapping) -> list[Column]:
    shape = list(spec["shape"])
    if spec["dtype"] in ("string", "video") or shape == [1]:
        return []
    sizes, value = [], c(name)
    for _ in shape:
        sizes.append(F.size(value))
        value = value[0]
    ok = sizes[0] == shape[0]
    for size, want in zip(sizes[1:], shape[1:]):
        ok = ok & (size == want)
    if spec["dtype"] == "image" and len(shape) == 3:
        h_w_c = [shape[1], shape[2], shape[0]]
        other = sizes[0] == h_w_c[0]
        for size, want in zip(sizes[1:], h_w_c[1:]):
            other = other & (size == want)
        ok = ok | other
    return [F.when(c(name).isNull() | ~ok, F.lit(f"feature {name} does not have shape {tuple(shape)}"))]


def validate_frames(frames: DataFrame, features: Mapping[str, Mapping]) -> DataFrame:
    """Rows whose values break the spec, with all their messages."""
    problems = schema_problems(frames, features)
    if any(p.startswith("missing") for p in problems):
        raise ValueError("; ".join(problems))
    rules = [r for n, s in features.items() if n in frames.columns for r in _shape_rules(n, s)]
    rules += [
        F.when(c(n).isNull(), F.lit(f"feature {n} is null"))
        for n, s in features.items()
        if n in frames.columns and list(s["shape"]) == [1] and s["dtype"] != "video"
    ]
    bad = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    keys = [k for k in ("index", EPISODE, FRAME) if k in frames.columns]
    return frames.select(*keys, bad.alias("messages")).filter(F.size("messages") > 0)


def validate_episodes(frames: DataFrame, total_episodes: int = 0) -> DataFrame:
    """Per new episode: row count, missing tasks, gaps in the frame order and whether numbering continues the dataset."""
    task = F.col("task") if "task" in frames.columns else F.col("task_index")
    per = frames.groupBy(EPISODE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(task.isNull(), 1).otherwise(0)).alias("_no_task"),
        (F.max(FRAME) + 1).alias("_span"),
    )
    messages = F.array_compact(
        F.array(
            F.when(F.col("_no_task") > 0, "task is missing"),
            F.when(F.col("_span") != F.col("rows"), "frame_index is not dense"),
            F.when(F.col(EPISODE) < total_episodes, "episode_index is already used"),
        )
    )
    return per.select(EPISODE, "rows", messages.alias("messages")).filter(F.size("messages") > 0)


def compat_problems(specs: Sequence[Mapping]) -> list[str]:
    """Differences in fps, robot_type and features (without their ``info``) against the first dataset."""

    def plain(features):
        return {k: {a: list(b) if isinstance(b, tuple) else b for a, b in v.items() if a != "info"} for k, v in features.items()}

    first, out = specs[0], []
    for i, spec in enumerate(specs[1:], 1):
        for key in ("fps", "robot_type"):
            if spec.get(key) != first.get(key):
                out.append(f"dataset {i}: {key} is {spec.get(key)!r}, expected {first.get(key)!r}")
        if plain(spec.get("features", {})) != plain(first.get("features", {})):
            out.append(f"dataset {i}: features differ")
    return out


def nan_check(transitions: DataFrame, columns: Sequence[str], keys: Sequence[str] = ("index",)) -> DataFrame:
    """Rows with a NaN, with the columns that hold one."""

    def bad(name: str) -> Column:
        kind = transitions.schema[name].dataType
        return F.exists(c(name), lambda x: F.isnan(x)) if isinstance(kind, T.ArrayType) else F.isnan(c(name))

    found = F.array_compact(F.array(*[F.when(bad(n), F.lit(n)) for n in columns]))
    return transitions.select(*[c(k) for k in keys], found.alias("nan_columns")).filter(F.size("nan_columns") > 0)


# ---------------------------------------------------------------- vectors


def infer_vectors(raw: DataFrame, prefix: str) -> dict[str, dict]:
    """All numeric scalars form one ``{prefix}`` vector in column order."""
    scalars = [f.name for f in raw.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    if any("/" in n for n in raw.columns):
        raise ValueError("column names must not contain '/'")
    name = "action" if prefix == "action" else "observation.state"
    return {name: {"dtype": "float32", "shape": [len(scalars)], "names": scalars}} if scalars else {}


def build_vectors(raw: DataFrame, features: Mapping[str, Mapping] | None = None, prefix: str = "observation", keep: Sequence[str] = ()) -> DataFrame:
    """Pack named scalar columns into float vectors in the order of the spec."""
    features = features if features is not None else infer_vectors(raw.drop(*keep), prefix)
    vectors = []
    for name, spec in features.items():
        if spec["dtype"] in ("image", "video"):
            continue
        vectors.append(F.array(*[c(n) for n in spec["names"]]).cast("array<float>").alias(name))
    return raw.select(*[c(k) for k in keep], *vectors)


def unpack_vector(frames: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """One column per entry, replacing the vector."""
    rest = [c(n) for n in frames.columns if n != vector]
    return frames.select(*rest, *[c(vector)[i].alias(n) for i, n in enumerate(names)])


def merge_vector_specs(*specs: Mapping[str, Mapping]) -> dict[str, dict]:
    """One spec for all: vectors list every entry name once, in order of appearance; other features are as last given."""
    rows = [(key, spec) for features in specs for key, spec in features.items()]
    named = [(k, s) for k, s in rows if s["dtype"] not in ("image", "video", "string") and len(s["shape"]) == 1 and s.get("names")]
    kinds = dict.fromkeys((k, s["dtype"]) for k, s in named)
    vectors = dict(kinds)
    clashes = sorted({k for k, _ in vectors if sum(k == other for other, _ in vectors) > 1})
    if clashes:
        raise ValueError(f"dtype mismatch for {clashes}")
    entries = list(dict.fromkeys((k, n) for k, s in named for n in s["names"]))
    merged = {k: dict(s) for k, s in rows}
    for key, dtype in vectors:
        names = [n for k, n in entries if k == key]
        merged[key] = {"dtype": dtype, "names": names, "shape": [len(names)]}
    return merged


def align_vectors(members: Sequence[tuple[DataFrame, Mapping[str, Mapping]]]) -> DataFrame:
    """Union of datasets with every vector in the merged name order; entries a member lacks are null."""
    merged = merge_vector_specs(*[s for _, s in members])
    out = None
    for frames, spec in members:
        changed = {}
        for key, target in merged.items():
            if key in spec and target.get("names") and key in frames.columns:
                at = {n: i for i, n in enumerate(spec[key]["names"])}
                kind = frames.schema[key].dataType.elementType
                entries = [c(key)[at[n]] if n in at else F.lit(None).cast(kind) for n in target["names"]]
                changed[key] = F.array(*entries)
        part = frames.withColumns(changed)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


# What is taken off the front of feature keys, and what marks an image key.
FRONT = re.compile(r"^(action|observation\.state|state|observation\.images|images)\.")
IMAGE_KEY = re.compile(r"(^|\.)images\.")


def clean_name(key: str) -> str:
    return FRONT.sub("", key, count=1)


def _chosen(keys: Sequence[str], images: set[str], patterns: Sequence[str] | None, use_videos: bool) -> list[str]:
    """Images by the switch, all other keys by the patterns."""
    pattern = re.compile("|".join(f"(?:{p})" for p in patterns) if patterns else "" if patterns is None else "(?!)")
    return [k for k in keys if (use_videos if k in images else pattern.search(k))]


def select_pipeline_features(
    action: Mapping[str, object], observation: Mapping[str, object], patterns: Sequence[str] | None = None, use_videos: bool = True
) -> dict[str, dict[str, object]]:
    """Kept keys with clean names: patterns filter action and state keys, ``use_videos`` keeps or drops images."""
    images = {k for k, v in observation.items() if IMAGE_KEY.search(k) or (isinstance(v, tuple) and len(v) == 3)}
    parts = {
        "action": {clean_name(k): action[k] for k in _chosen(list(action), set(), patterns, use_videos)},
        "observation": {clean_name(k): observation[k] for k in _chosen(list(observation), images, patterns, use_videos)},
    }
    return {name: part for name, part in parts.items() if part}


def select_feature_columns(frames: DataFrame, patterns: Sequence[str] | None, use_videos: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``select_pipeline_features`` under their clean names; images are known by their keys."""
    own = [n for n in frames.columns if n == "action" or n.startswith(("action.", "observation."))]
    images = {n for n in own if IMAGE_KEY.search(n) and n.startswith("observation.")}
    ordered = sorted(own, key=lambda n: n.startswith("observation."))
    return frames.select(*[c(k) for k in keep], *[c(n).alias(clean_name(n)) for n in _chosen(ordered, images, patterns, use_videos)])


def regroup_transition(frames: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns as observation / action / reward / done / truncated / info / complementary parts, with defaults."""
    names = frames.columns
    observation = [n for n in names if n.startswith("observation.")]
    extra = [n for n in names if "_is_pad" in n or n in ("task", "subtask", "index", "task_index", "episode_index")]

    def part(cols: Sequence[str]) -> Column:
        return F.struct(*[c(n) for n in cols]) if cols else F.lit(None)

    def value(name: str, default: object) -> Column:
        return c(name) if name in names else F.lit(default)

    return frames.select(
        *[c(k) for k in keep],
        part(observation).alias("observation"),
        value("action", None).alias("action"),
        value("next.reward", 0.0).alias("reward"),
        value("next.done", False).alias("done"),
        value("next.truncated", False).alias("truncated"),
        part([n for n in names if n.startswith("info.")]).alias("info"),
        part(extra).alias("complementary_data"),
    )


def ungroup_transition(transitions: DataFrame) -> DataFrame:
    """Inverse of ``regroup_transition``."""
    parts = []
    for group in ("observation", "info", "complementary_data"):
        kind = transitions.schema[group].dataType
        if isinstance(kind, T.StructType):
            parts += [c(group)[n].alias(n) for n in kind.names]
    return transitions.select(
        F.col("action"), F.col("reward").alias("next.reward"), F.col("done").alias("next.done"), F.col("truncated").alias("next.truncated"), *parts
    )


def standardise_observation(df: DataFrame, channels_last: tuple[int, int, int] | None = None) -> DataFrame:
    """Rename simulator outputs and scale pixels.

    ``pixels`` (one image, or a struct of images) becomes ``observation.image`` / ``observation.images.<key>``, channel
    first and in [0, 1]; ``environment_state`` and ``agent_pos`` become float vectors. Images are nested arrays
    height x width x channels of bytes with fewer channels than rows and columns.
    """

    def image(value: Column) -> Column:
        if channels_last is not None:
            h, w, ch = channels_last
            if not (ch < h and ch < w):
                raise ValueError(f"expected channel-last images, got shape {channels_last}")
        planes = F.sequence(F.lit(0), F.size(value[0][0]) - 1)
        return F.transform(
            planes, lambda ch: F.transform(value, lambda row: F.transform(row, lambda px: (F.get(px, ch) / 255.0).cast("float")))
        )

    out = []
    for field in df.schema.fields:
        name = field.name
        if name == "pixels" and isinstance(field.dataType, T.StructType):
            out += [image(c(name)[k]).alias(f"observation.images.{k}") for k in field.dataType.names]
        elif name == "pixels":
            out.append(image(c(name)).alias("observation.image"))
        elif name == "environment_state":
            out.append(c(name).cast("array<float>").alias("observation.environment_state"))
        elif name == "agent_pos":
            out.append(c(name).cast("array<float>").alias("observation.state"))
        else:
            out.append(c(name))
    return df.select(*out)


def concat_state(df: DataFrame, order: Sequence[str], out: str = "observation.state") -> DataFrame:
    """Concatenate state parts in the given order, flattening inner dimensions, as float32."""
    parts = []
    for name in order:
        kind, value = df.schema[name].dataType, c(name)
        if not isinstance(kind, T.ArrayType):
            value = F.array(value)
        while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
            value, kind = F.flatten(value), kind.elementType
        parts.append(value.cast("array<float>"))
    return df.withColumn(out, F.concat(*parts))


def pad_or_truncate(vector: Column, dim: int) -> Column:
    """Zero-pad or cut an array to ``dim`` entries."""
    return F.slice(F.concat(vector, F.array_repeat(F.lit(0.0), dim)), 1, dim)


def pad_mask(vector: Column, dim: int) -> Column:
    """True on the entries that were there before padding."""
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: i < F.size(vector))


def pad_horizon(chunk: Column, horizon: int) -> Column:
    """Repeat the last action up to ``horizon``, or cut."""
    return F.slice(F.concat(chunk, F.array_repeat(F.element_at(chunk, -1), horizon)), 1, horizon)


def add_constant_column(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def to_long_series(frames: DataFrame, vectors: Mapping[str, str], scalars: Sequence[str]) -> DataFrame:
    """(episode_index, frame_index, timestamp, entity, value); vectors give ``name/0``, ``name/1``, …"""
    def point(entity: Column, value: Column) -> Column:
        return F.struct(entity.alias("entity"), value.cast("double").alias("value"))

    def entries(label: str, col: str) -> Column:
        return F.transform(c(col), lambda x, i: point(F.concat(F.lit(f"{label}/"), i.cast("string")), x))

    parts = [entries(label, col) for label, col in vectors.items()]
    parts += [F.array(point(F.lit(s), c(s))) for s in scalars if s in frames.columns]
    rows = frames.select(EPISODE, FRAME, "timestamp", F.explode(F.concat(*parts)).alias("_p"))
    return rows.select(EPISODE, FRAME, "timestamp", "_p.entity", "_p.value")
