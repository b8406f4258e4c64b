"""SimHash near duplicates: vantage-point trees over 64-bit fingerprints, exact for every pair within the limit.

Fingerprints that differ in at most 4 bits differ in at most 2 bits of their lower or of their upper half, so there is a
tree per half and a search radius of 2 in each. A half is cut into disjoint blocks; a level of the tree sorts fingerprints
by their Hamming distance to a vantage point within one block. By the triangle inequality two fingerprints at distance r
have vantage distances that differ by at most r, and since blocks are disjoint these differences add up: branches whose
differences sum to more than 2 are pruned.

The upper levels make the shards. A fingerprint lives in one shard and visits those neighbour shards its ball reaches,
each pair of shards in one direction only. Inside a shard the lower levels are walked as sorted leaf codes; pairs that
survive are compared bit by bit, and a shard returns the links of a spanning forest, not all its pairs. Equal fingerprints
are one point. Components come from alternating star contraction over the links.

Defined results. Null text has no words; texts without words have fingerprint zero and are linked. Null ids are ignored
as component ids unless a component has no other. Repeated rows each get their row. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table, shared_join, stored
from trajspark.llm.registry import query

SHINGLE = 4
MAX_BITS = 4
SEED = 42
HALVES = 2
#: Radius within a half: floor(MAX_BITS / HALVES).
RADIUS = MAX_BITS // HALVES
#: A leaf code has the vantage distances (0 to 4) of the eight 4-bit blocks of a half.
LEAF_BLOCKS = 8
#: Vantage point of each half; any fixed point keeps the result, this one has no structure.
VANTAGE = xxhash.xxh64_intdigest(b"vantage", SEED)
#: Shard levels (blocks per half) and the largest number of points for which a level is used.
SHARD_LEVELS = ((2, 20_000), (4, 30_000_000), (8, None))
#: Rows a task walks at a time, in whole shards, and pairs it holds at a time.
WALK_ROWS = 400_000
PAIRS = 1 << 21


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """SimHash of one text: bit set where over half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the six white spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    last = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """doc_id and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, fp long")


def _leaf_levels(fps: np.ndarray, tree: int) -> np.ndarray:
    """Vantage distances of the eight 4-bit blocks of a half, one row per fingerprint."""
    x = (fps ^ np.uint64(VANTAGE)) >> np.uint64(32 * tree)
    nibbles = [(x >> np.uint64(4 * b)) & np.uint64(15) for b in range(LEAF_BLOCKS)]
    return np.stack([np.bitwise_count(n) for n in nibbles], axis=1).astype(np.int64)


def _shard_levels(leaf: np.ndarray, blocks: int) -> np.ndarray:
    return leaf.reshape(len(leaf), blocks, LEAF_BLOCKS // blocks).sum(axis=2)


def _offsets(dims: int) -> np.ndarray:
    """All integer vectors whose absolute values sum to at most RADIUS."""
    found = {tuple([0] * dims)}
    for _ in range(RADIUS):
        found |= {tuple(v[j] + s * (j == i) for j in range(dims)) for v in found for i in range(dims) for s in (1, -1)}
    return np.array(sorted(v for v in found if sum(map(abs, v)) <= RADIUS), dtype=np.int64)


def _code(levels: np.ndarray, base: int) -> np.ndarray:
    return levels @ (base ** np.arange(levels.shape[1], dtype=np.int64))


def _visits(blocks: int):
    """Each point at home (visitor false) and in the higher neighbour shards that its ball reaches."""
    base, width = 32 // blocks + 1, 32 // blocks
    steps = _offsets(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for tree in range(HALVES):
                home = _shard_levels(_leaf_levels(fps, tree), blocks)
                code = _code(home, base)
                for step in steps:
                    there = home + step
                    up = _code(there, base)
                    reached = ((there >= 0) & (there <= width)).all(axis=1) & ((up > code) if step.any() else True)
                    if reached.any():
                        shard = pa.array(up[reached] * HALVES + tree)
                        visitor = pa.array(np.full(int(reached.sum()), bool(step.any())))
                        yield pa.RecordBatch.from_arrays([shard, visitor, pa.array(fps[reached].view(np.int64))], ["shard", "visitor", "fp"])

    return run


def _hook(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs in ``parent`` (every entry points at its root before and after)."""
    while len(a):
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def _walk(shard: np.ndarray, visitor: np.ndarray, fps: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, root) among the rows of whole shards."""
    base = 32 // blocks + 1
    parent = np.arange(len(fps))
    steps = _offsets(LEAF_BLOCKS)
    coarse = _code(_shard_levels(steps, blocks), 64)
    for tree in range(HALVES):
        of = np.flatnonzero(shard % HALVES == tree)
        if not len(of):
            continue
        leaf = _leaf_levels(fps[of], tree)
        here = shard[of] // HALVES
        place = np.stack([here // base**i % base for i in range(blocks)], axis=1)
        away = _code(place - _shard_levels(leaf, blocks), 64)  # shard offset each row has come by
        codes = _code(leaf, 5)
        home = np.flatnonzero(~visitor[of])
        home = home[np.argsort(codes[home], kind="stable")]
        sorted_codes = codes[home]
        for step, shift in zip(steps, coarse, strict=True):
            rows = np.flatnonzero(away == shift)
            if not len(rows):
                continue
            there = leaf[rows] + step
            rows = rows[((there >= 0) & (there <= 4)).all(axis=1)]
            target = codes[rows] + _code(step[None, :], 5)[0]
            lo, hi = np.searchsorted(sorted_codes, target, "left"), np.searchsorted(sorted_codes, target, "right")
            full = hi > lo
            rows, lo, n = rows[full], lo[full], (hi - lo)[full]
            for first, last in _pieces(n):
                left, right = _expand(rows[first:last], lo[first:last], n[first:last])
                right = home[right]
                # Rows of one leaf meet twice; the smaller row keeps the pair.
                near = (np.bitwise_count(fps[of[left]] ^ fps[of[right]]) <= MAX_BITS) & ((left < right) | visitor[of[left]])
                _hook(parent, of[left[near]], of[right[near]])
    # The same fingerprint may be here several times: at home and as a visitor of other shards.
    linked = parent != np.arange(len(fps))
    return fps[linked], fps[parent[linked]]


def _pieces(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most PAIRS pairs each (one row may have more)."""
    at, ends = 0, np.cumsum(counts)
    while at < len(counts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
        yield at, to
        at = to


def _expand(rows: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = np.repeat(rows, n)
    inside = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
    return left, np.repeat(lo, n) + inside


def _links(blocks: int):
    """Walk whole shards; rows come sorted by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def walk(parts: list) -> Iterator[pa.RecordBatch]:
            shard, visitor, fps = (np.concatenate(x) for x in zip(*parts, strict=True))
            a, b = _walk(shard, visitor, fps.view(np.uint64), blocks)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            part = tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns)
            held.append(part)
            size += len(part[0])
            if size >= WALK_ROWS and len(part[0]):
                cut = int(np.searchsorted(part[0], part[0][-1], "left"))  # the last shard may go on
                whole = [*held[:-1], tuple(x[:cut] for x in part)]
                if cut == 0 and not any(len(h[0]) and h[0][-1] != part[0][-1] for h in held[:-1]):
                    continue
                if cut == 0:  # the open shard began in an earlier batch
                    joined = tuple(np.concatenate(x) for x in zip(*held, strict=True))
                    cut = int(np.searchsorted(joined[0], joined[0][-1], "left"))
                    whole, part = [tuple(x[:cut] for x in joined)], joined
                yield from walk(whole)
                held = [tuple(x[cut:] for x in part)]
                size = len(held[0][0])
        if size:
            yield from walk(held)

    return run


def links(points: DataFrame, count: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints (column ``fp``, distinct) within MAX_BITS of each other."""
    blocks = next(b for b, most in SHARD_LEVELS if most is None or count <= most)
    visits = points.select("fp").mapInArrow(_visits(blocks), "shard long, visitor boolean, fp long")
    return visits.repartition("shard").sortWithinPartitions("shard").mapInArrow(_links(blocks), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for all nodes of ``edges`` (a, b), by star contraction.

    A large star links all larger neighbours of a node to its smallest one, a small star does so with the smaller ones.
    Rounds alternate until nothing changes; each is written to the shared folder, so the plan does not grow.
    """
    order = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = stored(edges.filter("a <> b").select(*order).distinct(), "links")
    mark = None
    while True:
        both = now.union(now.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "links")
        large = shared_join(both, least, ["a"], "n", ["b"], "inner").filter(F.col("b") > F.col("a"))
        large = large.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b").distinct()
        large = stored(large, "links")
        least = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "links")
        small = shared_join(large, least, ["a"], "n", ["b"], "inner").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = state


def grouped(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fp, root (the smallest fingerprint of its component), component_id (its smallest id)."""
    prints = stored(fingerprints(docs, id_col, text, width), "simhash")
    points = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    points = stored(points, "simhash-points")
    found = components(links(points, points.count()))
    sizes = found.groupBy("root").agg(F.count(F.lit(1)).alias("_k"))
    # Roots are members of their components too.
    members = stored(found.union(sizes.select(F.col("root").alias("node"), "root")), "simhash-members")
    named = points.join(members.withColumnRenamed("node", "fp"), "fp", "left")
    named = stored(named.withColumn("root", F.coalesce("root", "fp")), "simhash-named")
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("k"))
    classes = shared_join(named.select("fp", "n", "root"), stored(ids, "simhash-ids"), ["root"], "k", ["fp"])
    classes = stored(classes.select("fp", "n", "root", "component_id"), "simhash-classes")
    return shared_join(prints, classes, ["fp"], "n", ["doc_id"]).select("doc_id", "fp", "root", "component_id")


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return grouped(docs, id_col, text, width).select("doc_id", hexed, "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each component, with its columns; documents without id stay.

    An id is decided as a whole where all its rows fall alike. Where one id has rows that stay and rows that go, or several
    rows in one component, the rows are told apart by fingerprint and one row per component stays.
    """
    found = stored(grouped(docs, id_col, text).filter("doc_id IS NOT NULL"), "simhash-found")
    stays = F.col("doc_id") == F.col("component_id")
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(stays.cast("long")).alias("stay"))
    drop = ids.filter("stay = 0").select(F.col("doc_id").alias("_drop"))
    several = stored(ids.filter("stay > 0 AND rows > 1").select(F.col("doc_id").alias("_several")), "simhash-several")
    own = [f"_in{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, own, strict=True))
    rows = docs.toDF(*own).join(drop, F.col(names[id_col]) == F.col("_drop"), "left_anti")
    back = [F.col(o).alias(c) for c, o in names.items()]
    if several.isEmpty():
        return rows.select(*back)

    @F.pandas_udf("long")
    def fp_of(texts):
        return texts.map(lambda t: int(np.uint64(fingerprint(t)).astype(np.int64)))

    at = F.col(names[id_col]) == F.col("_several")
    heads = found.filter(stays).groupBy("doc_id", "root").agg(F.min("fp").alias("_fp")).select(F.col("doc_id").alias("_several"), "_fp").distinct()
    told = rows.join(several, at, "left_semi").withColumn("_fp", fp_of(F.coalesce(F.col(names[text]), F.lit(""))))
    told = told.withColumn("_several", F.col(names[id_col])).join(heads, ["_several", "_fp"], "left_semi").dropDuplicates(["_several", "_fp"])
    return rows.join(several, at, "left_anti").select(*back).union(told.select(*back))


@query("op4_simhash_vantage_trees")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(document_table(spark, sf_dir))
