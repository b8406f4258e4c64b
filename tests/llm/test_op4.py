"""SimHash against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from trajspark.llm import op4_simhash as op

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows):
    """rows: (id, fingerprint)."""
    fps = np.array([f for _, f in rows], dtype=np.uint64)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            a, b = root(i), root(int(j))
            label[max(a, b)] = min(a, b)
    least = {}
    for i, (one, _) in enumerate(rows):
        least.setdefault(root(i), []).append(one)
    return [min((x for x in least[root(i)] if x is not None), default=None) for i in range(len(rows))]


@pytest.mark.parametrize("blocks", [2, 4, 8])
def test_walk_loses_no_link(spark, blocks, monkeypatch):
    rng = random.Random(blocks)
    base = [rng.getrandbits(64) for _ in range(300)]
    points = set(base)
    for x in base[:150]:
        for _ in range(6):
            y = x
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                y ^= 1 << bit
            points.add(y)
    points = sorted(points)
    monkeypatch.setattr(op, "SHARD_LEVELS", ((blocks, None),))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in points]
    found = op.components(op.links(spark.createDataFrame(signed, "fp long"), len(points)))
    root = {r["node"]: r["root"] for r in found.collect()}
    got = {}
    for (p,) in signed:
        got.setdefault(root.get(p, p), set()).add(p)
    want = {}
    for (p,), c in zip(signed, slow_components([(i, x) for i, x in enumerate(points)]), strict=True):
        want.setdefault(c, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = [(r["doc_id"], slow_fingerprint(r["text"])) for r in docs]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(want, slow_components(want), strict=True)}
    assert {tuple(r) for r in op.simhash(spark, SF).collect()} == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "One"), (None, "ONE"), (5, "One"), (6, "x " * 30000), (7, "ÄB cd é f g"), (8, "Äb CD é f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1)).withColumn("n", F.lit("x"))
    want = [(d, slow_fingerprint(t)) for d, t in rows]
    want = [(d, f"{f:016x}", c) for (d, f), c in zip(want, slow_components(want), strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in op.find(docs).collect()), key=key) == sorted(want, key=key)
    kept = op.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 6, 7]
    empty = docs.filter("1 = 0")
    assert op.find(empty).count() == 0 and op.keep_one(empty).count() == 0


def test_keep_one_with_repeated_ids(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcd")
    rows = [(1, a), (5, a), (5, b), (7, c), (8, c), (8, d), (9, d), (2, b + " "), (3, "x y"), (3, "x y"), (3, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_fp", F.lit(0)).withColumn("root", F.lit("r"))
    kept = sorted((r["doc_id"], r["text"].strip()) for r in op.keep_one(docs).collect())
    assert kept == sorted([(1, a), (2, b), (7, c), (8, d), (3, "x y"), (3, "other words here")])
    alone = spark.createDataFrame([(1, a), (5, a), (5, b), (7, c)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in op.keep_one(alone).collect()) == [(1, a), (5, b), (7, c)]
