"""Exact duplicates through an extendible-hash index on shared files.

Texts are normalised (each run of white space is one space) and hashed to 64 bits. A directory of hash prefixes doubles
until no bucket holds more than ``CAPACITY`` keys. Owner tasks take contiguous ranges of buckets, chain texts whose keys
collide, compare their bytes, and write the entries of their buckets to the shared folder. Documents are then looked up
in these files.

A text that many documents share is reduced where it is read (one copy per ``WINDOW_BYTES`` of distinct text), so an
owner meets a hot text once per window, not once per document.

Defined results. Null text counts as empty. The smallest id of a group stays; null ids stay only where a group has no
other. Rows with the same id and text are tied: ``find`` marks all of them, ``keep_first`` returns one. An empty table
gives an empty result. Other columns are not read by ``find`` and all kept by ``keep_first``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import SPACE, arrow_map, document_table, new_path, shared_join, stored
from trajspark.llm.registry import query

#: Keys a bucket may hold before it is split.
CAPACITY = 4096
#: The directory has at most 2^16 entries; buckets that stay overfull there just grow longer.
MAX_DEPTH = 16
#: Distinct text a reading task holds while it merges copies.
WINDOW_BYTES = 16 << 20
#: Owners per shuffle partition, so that ranges can be dealt evenly.
OWNERS = 4


class Directory:
    """Prefix directory of an extendible hash table, built from the number of keys per 16-bit prefix.

    One bucket covers everything at first. An overfull bucket is split in two; when its depth has reached that of the
    directory, the directory doubles.
    """

    def __init__(self, cells: np.ndarray, capacity: int = CAPACITY):
        sums = np.concatenate([[0], np.cumsum(cells)])
        self.depth, local, todo = 0, {0: 0}, [0]  # local: first prefix of a bucket -> depth of the bucket
        while todo:
            start = todo.pop()
            depth = local[start]
            width = 1 << (MAX_DEPTH - depth)
            if depth == MAX_DEPTH or sums[start + width] - sums[start] <= capacity:
                continue
            self.depth = max(self.depth, depth + 1)
            half = start + width // 2
            local[start] = local[half] = depth + 1
            todo += [start, half]
        self.starts = np.array(sorted(local), dtype=np.int64)
        self.local = np.array([local[x] for x in sorted(local)])
        entries = np.arange(1 << self.depth) << (MAX_DEPTH - self.depth)
        self.slots = np.searchsorted(self.starts, entries, side="right") - 1
        ends = np.append(self.starts[1:], 1 << MAX_DEPTH)
        self.loads = sums[ends] - sums[self.starts]

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return self.slots[keys.astype(np.int64).view(np.uint64) >> np.uint64(64 - self.depth)] if self.depth else np.zeros(len(keys), np.int64)

    def owners(self, count: int) -> np.ndarray:
        """Owner of each bucket: contiguous ranges of about equal load."""
        before = np.cumsum(self.loads) - self.loads
        return np.minimum(before * count // max(1, int(self.loads.sum())), count - 1)


def normal_text(text: str = "text") -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ")


def _merge_copies(directory: Directory, owner: np.ndarray, names: list[str]):
    """Reading tasks: one row per distinct text of a window, with its owner, its number of copies and smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            keys = np.array([v[0] for v in held.values()], dtype=np.int64)
            bucket = directory.bucket(keys)
            rows = list(held.values())
            columns = [
                pa.array(owner[bucket], pa.int64()),
                pa.array(bucket, pa.int64()),
                pa.array(keys),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array(list(held), pa.binary()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], id_type),
            ]
            return pa.RecordBatch.from_arrays(columns, names)

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for one, key, sha, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                row = held.get(text)
                if row is None:
                    held[text] = [key, sha, 1, one]
                    size += len(text)
                    if size > WINDOW_BYTES:
                        yield flush()
                        held.clear()
                        size = 0
                else:
                    row[2] += 1
                    if one is not None and (row[3] is None or one < row[3]):
                        row[3] = one
        if held:
            yield flush()

    return run


def _own(names: list[str]):
    """Owner tasks: rows come sorted by bucket and key; texts that share a key are chained and compared byte by byte."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: list[list] = []
        place: tuple | None = None
        done: list[tuple] = []
        id_type = pa.int64()

        def close() -> None:
            if len({link[1] for link in chain}) < len(chain):
                raise ValueError("two different texts have one SHA-256 digest")
            done.extend((*place, at, sha, len(text), n, keep) for at, (text, sha, n, keep) in enumerate(chain))
            chain.clear()

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int64(), id_type]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
            done.clear()
            return out

        for batch in batches:
            id_type = batch.schema.field(6).type
            for owner, bucket, key, sha, text, n, keep in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if place != (owner, bucket, key):
                    if place is not None:
                        close()
                    place = (owner, bucket, key)
                for link in chain:
                    if link[0] == text:
                        link[2] += n
                        if keep is not None and (link[3] is None or keep < link[3]):
                            link[3] = keep
                        break
                else:
                    chain.append([text, sha, n, keep])
            if len(done) > 5000:
                yield flush()
        if place is not None:
            close()
        if done:
            yield flush()

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    norm = docs.select(F.col(id_col).alias("doc_id"), normal_text(text).alias("norm"))
    return norm.select("doc_id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("text_sha256"))


def build_index(docs: DataFrame, prints: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Write the index of all texts to the shared folder: one entry per distinct text.

    Columns: owner, bucket, key, chain (place among the texts of the key), text_sha256, bytes, group_size, keep_id. The
    directory has 2^16 entries at most, whatever the number of documents, and lies beside the entries.
    """
    spark = docs.sparkSession
    cell = F.call_function("shiftrightunsigned", F.col("key"), F.lit(64 - MAX_DEPTH))
    cells = np.zeros(1 << MAX_DEPTH, dtype=np.int64)
    for row in prints.select("key").distinct().groupBy(cell.alias("cell")).count().collect():
        cells[row["cell"]] = row["count"]
    directory = Directory(cells, capacity)
    owner = directory.owners(OWNERS * int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    layout = zip(directory.starts.tolist(), directory.local.tolist(), owner.tolist(), strict=True)
    layout = spark.createDataFrame(list(layout), "first_prefix long, depth long, owner long")
    layout.write.parquet(new_path(spark, "dedup-directory"))

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), normal_text(text).alias("norm"))
    rows = rows.select("doc_id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("sha"), F.col("norm").cast("binary"))
    names = ["owner", "bucket", "key", "text_sha256", "text", "group_size", "keep_id"]
    types = ["long", "long", "long", "string", "binary", "long", kind]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    merged = arrow_map(rows, _merge_copies(directory, owner, names), schema)
    owned = merged.repartition("owner").sortWithinPartitions("owner", "bucket", "key")
    out = ["owner", "bucket", "key", "chain", "text_sha256", "bytes", "group_size", "keep_id"]
    kinds = ["long", "long", "long", "long", "string", "long", "long", kind]
    entries = owned.mapInArrow(_own(out), ", ".join(f"{n} {t}" for n, t in zip(out, kinds, strict=True)))
    return stored(entries, "dedup-index")


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    prints = stored(fingerprints(docs, id_col, text), "dedup-keys")
    index = build_index(docs, prints, id_col, text, capacity).select("key", "text_sha256", "group_size", "keep_id")
    looked_up = shared_join(prints, index, ["key", "text_sha256"], "group_size", ["doc_id"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return looked_up.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document per text, with its columns: that with the smallest id."""
    prints = stored(fingerprints(docs, id_col, text), "dedup-keys")
    index = build_index(docs, prints, id_col, text)
    own = [f"_in{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, own, strict=True))
    renamed = docs.toDF(*own)
    norm = normal_text(names[text])
    rows = renamed.withColumns({"_key": F.xxhash64(norm), "_sha": F.sha2(norm, 256), "_id": F.col(names[id_col]).cast("string")})
    rows = rows.withColumn("_id", F.concat_ws("", F.lit("="), "_id"))  # a null id is not equal to any other in a join
    stay = index.select(
        F.col("key").alias("_key"), F.col("text_sha256").alias("_sha"), F.concat_ws("", F.lit("="), F.col("keep_id").cast("string")).alias("_id")
    )
    on = ["_key", "_sha", "_id"]
    return rows.join(stay, on, "left_semi").dropDuplicates(on).select(*[F.col(o).alias(c) for c, o in names.items()])


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


@query("op3_exact_dedup", SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(document_table(spark, sf_dir))
