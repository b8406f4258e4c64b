"""String, path and JSON functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.functions.columns import c
from trajspark.operators.joins import carry_steps, first_cover
from trajspark.operators.layout import EPISODE, FRAME, dictionary_join, positions

# ---------------------------------------------------------------- times (F1)


def mmss_to_seconds(text: Column) -> Column:
    """``MM:SS`` or ``SS``."""
    parts = F.split(text, ":")
    return F.when(F.size(parts) == 2, parts[0].cast("int") * 60 + parts[1].cast("int")).otherwise(parts[0].cast("int"))


def seconds_to_mmss(seconds: Column) -> Column:
    whole = seconds.cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60), whole % 60)


# ---------------------------------------------------------------- prompts


def clean_task(task: Column) -> Column:
    return F.translate(F.regexp_replace(task, r"^\s+|\s+$", ""), "_\n", "  ")


def prompt(task: Column, bins: Column, with_action: bool = True) -> Column:
    """``Task: …, State: 1 2 …;`` from a text and discretised states."""
    end = ";\nAction: " if with_action else ";\n"
    return F.concat(F.lit("Task: "), clean_task(task), F.lit(", State: "), F.array_join(bins.cast("array<string>"), " "), F.lit(end))


def ensure_suffix(task: Column, suffix: str, default: str | None = None) -> Column:
    done = F.when(task.endswith(suffix), task).otherwise(F.concat(task, F.lit(suffix)))
    return F.when(task.isNull(), F.lit(default)).otherwise(done)


# Display names of cameras and the marks of the chat format.
CAMERA_NAMES = {
    "face_view": "front view",
    "left_wrist_view": "left wrist view",
    "right_wrist_view": "right wrist view",
    "move1_view": "move view",
    "move2_view": "move view",
    "wall_view": "wall view",
    "top_view": "top view",
}
START, END = "<|im_start|>", "<|im_end|>"
IMAGE = "<|vision_start|><|image_pad|><|vision_end|>"
STATE, ACTION, ACTION_FAST = "<|propri|>", "<|action|>", "<|action_fast|>"


def camera_label(key: Column) -> Column:
    """Spoken name of a camera: the fixed one, else the key with blanks, which ends in ``view`` where it has none."""
    name = F.regexp_replace(key, r"observation\.images\.", "")
    fixed = F.create_map(*[F.lit(x) for pair in CAMERA_NAMES.items() for x in pair])[name]
    return F.coalesce(fixed, F.when(name.contains("view"), F.translate(name, "_", " ")).otherwise(F.concat(name, F.lit(" view"))))


def chat_prompt(instruction: Column, chunk_size: int, cameras: Sequence[str] = (), subtask: Column | None = None) -> Column:
    """System line, observation, instruction and answer. With ``subtask`` the answer is its text instead of actions."""
    head = [F.lit(f"{START}system\nYou are a helpful assistant.{END}\n{START}user\nObservation:")]
    for key in cameras:
        head += [F.lit(" "), camera_label(F.lit(key)), F.lit(f": {IMAGE}")]
    head.append(F.lit("\nInstruction: "))
    if subtask is not None:
        ask = f"\nPredict the next action in language.\n{END}\n{START}assistant\n"
        return F.concat(*head, instruction, F.lit(ask), subtask, F.lit(f"\n{END}"))
    ask = f"\nPredict the next action in robot action.\nProprioception: {STATE}\n{END}\n"
    answer = f"{START}assistant\n{ACTION_FAST}{END}\n{ACTION * chunk_size}"
    return F.concat(*head, instruction, F.lit(ask + answer))


# ---------------------------------------------------------------- JSON and paths

CAPTION_KEYS = ("semantic_motion", "short_caption", "motion_sequence")  # fixed values


def parse_caption(raw: Column) -> Column:
    """JSON object to three keys with "" defaults; text that is not JSON becomes the short caption."""
    is_json = F.try_parse_json(raw).isNotNull()
    out = []
    for key in CAPTION_KEYS:
        plain = raw if key == "short_caption" else F.lit("")
        out.append(F.when(raw.isNull(), "").when(is_json, F.coalesce(F.get_json_object(raw, f"$.{key}"), F.lit(""))).otherwise(plain).alias(key))
    return F.struct(*out)


def map_path(path: Column, prefix: str = "oss://", local: str = "/home/") -> Column:
    return F.when(path.startswith(prefix), F.concat(F.lit(local), F.substring(path, len(prefix) + 1, 1 << 30))).otherwise(path)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    """Last path element without its extension; a leading dot does not start an extension."""
    return F.regexp_replace(file_name(path), r"^(\.*[^.].*)\.[^.]*$", "$1")


def path_number(path: Column, prefix: str) -> Column:
    """Number after ``chunk-``, ``file-`` or ``episode_``."""
    return F.try_element_at(F.regexp_extract_all(path, F.lit(rf"{prefix}(\d+)"), F.lit(1)), F.lit(-1)).cast("long")


def flatten_columns(df: DataFrame, sep: str = "/") -> DataFrame:
    """Nested structs to columns ``a/b``."""

    def walk(kind: T.StructType, value, path: str) -> list[Column]:
        out = []
        for f in kind.fields:
            v, name = (c(f.name) if value is None else value[f.name]), path + f.name
            out += walk(f.dataType, v, name + sep) if isinstance(f.dataType, T.StructType) else [v.alias(name)]
        return out

    return df.select(*walk(df.schema, None, ""))


def unflatten_columns(df: DataFrame, sep: str = "/") -> DataFrame:
    """Columns ``a/b`` back to nested structs."""
    tree: dict = {}
    for name in df.columns:
        at, parts = tree, name.split(sep)
        for p in parts[:-1]:
            at = at.setdefault(p, {})
        at[parts[-1]] = c(name)

    def build(node: dict) -> list[Column]:
        return [(F.struct(*build(v)) if isinstance(v, dict) else v).alias(k) for k, v in node.items()]

    return df.select(*build(tree))


def annotation_record(manifest: Mapping[str, Column], caption: Column, extra: Mapping[str, Column]) -> Column:
    """Annotation as JSON: manifest entry (its text is the short caption), caption and further parts; nulls are kept."""
    entry = F.struct(*[v.alias(k) for k, v in manifest.items()], caption["short_caption"].alias("text"))
    record = F.struct(entry.alias("manifest_entry"), caption.alias("caption"), *[v.alias(k) for k, v in extra.items()])
    return F.to_json(record, {"ignoreNullFields": "false"})


def slim_struct(value: Column, drop: Sequence[str]) -> Column:
    """Nested payload without the given fields, named by path (``slam_data.disps``)."""
    return value.dropFields(*drop)


# ---------------------------------------------------------------- tokens


def vocabulary(texts: DataFrame, text: str, size: int | None = None) -> DataFrame:
    """Tokens by falling frequency, ties by token: ``token, n, token_id``."""
    tokens = texts.select(F.explode(words(c(text))).alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("_o", -F.col("n"))
    ranked = positions(counts, "token_id", ["_o", "token"]).drop("_o")
    return ranked if size is None else ranked.filter(F.col("token_id") < size)


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def tokenize(
    texts: DataFrame, key: str, text: str, vocab: DataFrame, max_len: int, unknown: int = -1, pad: int = 0, out: str = "tokens"
) -> DataFrame:
    """Token ids per text, cut or padded to ``max_len``, with a mask of real tokens.

    Only the first ``max_len`` words are looked up, since the rest is cut anyway. ``key`` is unique, so a group is one text.
    """
    kept = F.slice(words(c(text)), 1, max_len)
    rows = texts.select(c(key), F.posexplode(kept).alias("_pos", "token"))
    found = dictionary_join(rows, vocab.select("token", "token_id"), "token", [key, "_pos"])
    ids = found.groupBy(c(key)).agg(
        F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("token_id", F.lit(unknown).cast("long")).alias("id")))).alias("_t")
    )
    joined = texts.join(ids, key, "left")
    ordered = F.coalesce(F.transform("_t", lambda x: x["id"]), F.array().cast("array<bigint>"))
    return pad_tokens(joined.withColumn("_ids", ordered), "_ids", max_len, pad, out).drop("_t", "_ids")


def pad_tokens(df: DataFrame, ids: str, max_len: int, pad: int = 0, out: str = "tokens") -> DataFrame:
    padded = F.slice(F.concat(c(ids), F.array_repeat(F.lit(pad).cast("long"), max_len)), 1, max_len)
    mask = F.transform(F.sequence(F.lit(0), F.lit(max_len - 1)), lambda i: i < F.size(c(ids)))
    return df.withColumns({out: padded, f"{out}_mask": mask})


def action_tokens(df: DataFrame, ids: str, vocab_size: int, skip: int, bos: int, lead: Sequence[int], end: Sequence[int], max_len: int) -> DataFrame:
    """Action token ids mirrored into the text vocabulary and wrapped, cut or padded to ``max_len``."""

    def fixed(values: Sequence[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values]) if values else F.array().cast("array<bigint>")

    mirrored = F.transform(c(ids), lambda t: F.lit(vocab_size - 1 - skip) - t)
    wrapped = df.withColumn("_w", F.concat(fixed([bos, *lead]), mirrored.cast("array<bigint>"), fixed(end)))
    return pad_tokens(wrapped, "_w", max_len, 0, "action_tokens").drop("_w")


# ---------------------------------------------------------------- lookups


def float_member(values: Column, x: Column, tol: float = 1e-6) -> Column:
    """Position of the first entry within ``tol`` of ``x``, or -1."""
    hits = F.filter(F.transform(values, lambda v, i: F.when(F.abs(v - x) < tol, i)), lambda i: i.isNotNull())
    return F.coalesce(F.get(hits, 0), F.lit(-1))


def rescale_points(text: Column, old: tuple[Column, Column], new: tuple[Column, Column] | None = None) -> Column:
    """Rescale coordinates inside ``<point>…</point>``; sizes are (width, height).

    With ``new`` the result is in pixels of that size, rounded half to even and clamped; without it, on a 0-1000 scale.
    Points of two or four numbers change, other lists are written as they are.
    """
    points = F.regexp_extract_all(text, F.lit("<point>(.*?)</point>"), F.lit(1))
    between = F.split(text, "<point>.*?</point>", -1)

    def number(x: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, old[0]).otherwise(old[1])
        if new is None:
            v = F.least(F.lit(999.999), x / size * 1000)
            return F.when(v <= 0, "0").otherwise(v.cast("string"))
        target = F.when(i % 2 == 0, new[0]).otherwise(new[1])
        return F.greatest(F.lit(0), F.least(F.rint(x * (target / size)).cast("long"), target - 1)).cast("string")

    def render(point: Column) -> Column:
        raw = F.regexp_extract_all(point, F.lit(r"(\d+)"), F.lit(1))
        moved = F.transform(raw.cast("array<bigint>"), number)
        known = (F.size(raw) == 2) | (F.size(raw) == 4)
        plain = F.transform(raw.cast("array<bigint>"), lambda v: v.cast("string"))
        return F.concat(F.lit("<point>["), F.array_join(F.when(known, moved).otherwise(plain), ", "), F.lit("]</point>"))

    tail = F.transform(points, lambda p, i: F.concat(render(p), F.get(between, i + 1)))
    return F.concat(F.get(between, 0), F.array_join(tail, ""))


# Instruction fields in order of priority.
PRIORITY = ("subtask_generation", "subtask_generation_zh", "distribute", "distribute_zh")


def frame_instruction(frames: DataFrame, instructions: DataFrame, priority: Sequence[str] = PRIORITY) -> DataFrame:
    """Instruction text per frame.

    ``instructions`` has ``episode_index, pos, key, frame_range, text``; a range ``"start end"`` holds for
    ``start <= f < end`` and for ``f = start``, a null range for the whole episode. The first match per key counts; the
    first key of ``priority`` with a text wins (written on a new line), else the plain ``instruction``.
    """
    ends = F.split("frame_range", " ")
    ranged = F.col("frame_range").isNotNull()
    lengths = frames.groupBy(EPISODE).agg((F.max(FRAME) + 1).alias("_n"))
    placed = instructions.join(lengths, EPISODE).withColumns(
        {"_a": F.when(ranged, ends[0].cast("long")).otherwise(0), "_e": F.when(ranged, ends[1].cast("long")).otherwise(F.col("_n"))}
    )
    placed = placed.withColumn("_b", F.least(F.col("_n") - 1, F.greatest(F.col("_e") - 1, F.col("_a"))))
    wanted = [*priority, "instruction"]
    placed = placed.filter(F.col("key").isin(wanted)).withColumnRenamed("key", "_key")
    steps = first_cover(placed, "_a", "_b", F.struct("pos", "_a", "_b", "text"), (EPISODE, "_key"))
    columns = {f"_at_{i}": F.when(F.col("_key") == k, F.struct("_first")) for i, k in enumerate(wanted)}
    joined = carry_steps(frames, steps, columns)

    def text(key: str) -> Column:
        return F.col(f"_at_{wanted.index(key)}._first.text")

    chosen = [F.when(text(k) != "", F.concat(F.lit("\n"), text(k))) for k in priority]
    return joined.withColumn("instruction", F.coalesce(*chosen, text("instruction"), F.lit(""))).drop(*columns)
