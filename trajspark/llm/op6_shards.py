"""Sharding by minimax contiguous partition.

Documents with equal text are one atomic group. Groups lie on a line in the order of their text's MD5, and the line is cut
into contiguous shards so that the largest shard is as small as possible: a binary search over the capacity, each step
checked greedily (every shard takes groups while they fit), then the cuts of the smallest feasible capacity.

The greedy check only asks for the last group end at or before a place on the line. The driver holds the sizes of at most
2^20 cells of the MD5 space, and fetches the groups of the few cells in which a cut may fall, at most shards - 1 at once.

Defined results. Null text counts as empty, so both are one group; its CRC is 0. Null ids and repeated rows each get a
slot of their own. Fewer groups than shards leave shards empty. Empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import buckets_for, document_table, numbered, stored
from trajspark.llm.registry import query

SHARDS = 8
#: Groups a cell should hold, and the most bits (of the 20 used) that cells are told apart by.
CELL_GROUPS = 256
CELL_BITS = 20


class Line:
    """Group sizes along the line: cells are known, the groups of a cell once they have been fetched."""

    def __init__(self, cells: np.ndarray, fetch):
        self.cum = np.concatenate([[0], np.cumsum(cells, dtype=np.int64)])
        self.total = int(self.cum[-1])
        self.fetch = fetch
        self.ends: dict[int, np.ndarray] = {}
        self.keys: dict[int, list[str]] = {}

    def _cell(self, at: int) -> int:
        return int(np.searchsorted(self.cum, at, "right")) - 1

    def floor(self, at: int, missing: set[int]) -> int:
        """Last group end at or before ``at``; notes the cell when its groups are not here yet."""
        if at >= self.total:
            return self.total
        cell = self._cell(at)
        if self.cum[cell] == at:
            return at
        if cell not in self.ends:
            missing.add(cell)
            return int(self.cum[cell])
        ends = self.ends[cell]
        found = int(np.searchsorted(ends, at, "right"))
        return int(ends[found - 1]) if found else int(self.cum[cell])

    def cuts(self, capacity: int, shards: int) -> list[int]:
        """Greedy cuts, one per shard; the partition is feasible when the last one is the total."""
        while True:
            missing: set[int] = set()
            at, out = 0, []
            for _ in range(shards):
                at = self.floor(at + capacity, missing)
                out.append(at)
            if not missing:
                return out
            for cell, (keys, sizes) in self.fetch(sorted(missing)).items():
                self.ends[cell] = self.cum[cell] + np.cumsum(sizes, dtype=np.int64)
                self.keys[cell] = keys

    def minimax(self, shards: int, largest: int) -> list[int]:
        """Cuts for the smallest capacity that is feasible."""
        low = max(largest, -(-self.total // shards))
        high = -(-self.total // shards) + largest  # always feasible: a full shard lacks less than one group
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards)[-1] == self.total:
                high = middle
            else:
                low = middle + 1
        return self.cuts(low, shards)

    def first_key(self, cut: int, bits: int) -> str:
        """Smallest key that can lie after ``cut``."""
        if cut >= self.total:
            return "g"  # after all hexadecimal digits
        cell = self._cell(cut)
        if self.cum[cell] == cut:
            return format(cell << (CELL_BITS - bits), "05x")
        return self.keys[cell][int(np.searchsorted(self.ends[cell], cut, "right"))]


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.md5(body.cast("binary")).alias("_key"),
    )
    rows = stored(rows, "shard-sizes")
    groups = rows.groupBy("_key").agg(F.sum("size").alias("bytes"))
    prefix = F.conv(F.substring("_key", 1, 5), 16, 10).cast("int")
    groups = groups.withColumn("prefix", prefix).repartitionByRange("_key").sortWithinPartitions("_key")
    groups = stored(groups, "shard-groups")
    whole = groups.agg(F.count(F.lit(1)).alias("n"), F.max("bytes").alias("most")).first()
    bits = min(CELL_BITS, max(0, int(whole["n"] // CELL_GROUPS).bit_length()))
    cell = F.shiftright("prefix", CELL_BITS - bits)
    cells = np.zeros(1 << bits, dtype=np.int64)
    for row in groups.groupBy(cell.alias("cell")).agg(F.sum("bytes").alias("bytes")).collect():
        cells[row["cell"]] = row["bytes"]

    def fetch(wanted: list[int]) -> dict[int, tuple[list[str], np.ndarray]]:
        width = 1 << (CELL_BITS - bits)
        inside = None
        for c in wanted:  # ranges of the sorted column, so that files and row groups are skipped
            own = F.col("prefix").between(c * width, (c + 1) * width - 1)
            inside = own if inside is None else inside | own
        got = groups.filter(inside).select("_key", "bytes", cell.alias("cell")).toPandas().sort_values("_key")
        return {c: (part["_key"].tolist(), part["bytes"].to_numpy()) for c, part in got.groupby("cell")}

    line = Line(cells, fetch)
    starts = [line.first_key(cut, bits) for cut in line.minimax(shards, whole["most"] or 0)[:-1]] if line.total else []
    number = F.lit(0)
    for start in starts:
        number = number + (F.col("_key") >= start).cast("int")
    total = rows.count()
    bucket = F.pmod(F.xxhash64("doc_id", "_key"), F.lit(buckets_for(total // shards)))
    return numbered(rows.withColumn("shard", number), "slot", bucket, [F.col("doc_id"), F.col("_key")], ["shard"]).drop("_key")


@query("op6_minimax_shards")
def minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(document_table(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
