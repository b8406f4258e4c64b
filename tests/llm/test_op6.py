"""Shards against a plain search over all capacities."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.llm import op6_shards as op

SF = "/root/testdata/sf0.001"


def slow_capacity(sizes, shards):
    def fits(c):
        at = used = 0
        for s in sizes:
            if s > c:
                return False
            if used + s > c:
                at, used = at + 1, 0
            used += s
        return at < shards

    low, high = 1, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


@pytest.mark.parametrize("seed", range(30))
def test_line(seed):
    rng = random.Random(seed)
    n, cells, shards = rng.randint(1, 200), rng.choice([1, 4, 16]), rng.randint(1, 9)
    of = sorted(rng.randrange(cells) for _ in range(n))
    sizes = [rng.choice([1, 2, 7, 50, rng.randint(1, 2000)]) for _ in range(n)]
    sums = np.zeros(cells, dtype=np.int64)
    np.add.at(sums, of, sizes)
    keys = [f"{i:05d}" for i in range(n)]

    def fetch(wanted):
        return {c: ([k for k, o in zip(keys, of, strict=True) if o == c], np.array([s for s, o in zip(sizes, of, strict=True) if o == c])) for c in wanted}

    line = op.Line(sums, fetch)
    cuts = line.minimax(shards, max(sizes))
    assert cuts[-1] == sum(sizes)
    ends = {0, *np.cumsum(sizes).tolist()}
    assert set(cuts) <= ends
    assert max(np.diff([0, *cuts])) == slow_capacity(sizes, shards)


def check(docs, rows, shards):
    got = op.shard(docs, shards).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(len((t or "").encode()) + 1)
    import hashlib

    order = sorted(groups, key=lambda t: hashlib.md5(t.encode()).hexdigest())
    best = slow_capacity([sum(groups[t]) for t in order], shards)
    loads, slots = [0] * shards, {}
    for r in got:
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert max(loads) == best
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_text = {}
    for r in got:
        by_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())


def test_documents(spark, monkeypatch):
    monkeypatch.setattr(op, "CELL_GROUPS", 8)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()], 8)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "a"), (None, None), (4, "ä" * 50000), (5, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("size", F.lit("s")).withColumn("slot", F.lit(0))
    check(docs, rows, 8)
    check(docs, rows, 2)
    assert op.shard(docs.filter("1 = 0")).count() == 0
