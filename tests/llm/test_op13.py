"""The join against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.llm import op13_jaccard as op

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = ["".join(c.lower() if c.isascii() else c for c in w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=80):
    """rows: (id, text). Per row (id, set size, component)."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    x, y = root(i), root(j)
                    label[max(x, y)] = min(x, y)
    least = {}
    for i, (one, _) in enumerate(rows):
        least.setdefault(root(i), []).append(one)
    return Counter((d, len(sets[i]), min((x for x in least[root(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows))


def answer(df):
    return Counter(tuple(r) for r in df.collect())


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert answer(op.jaccard(spark, SF)) == brute(rows)


@pytest.mark.parametrize("seed, small", [(0, False), (1, True), (2, True)])
def test_planted(spark, monkeypatch, seed, small):
    if small:  # chunks of few sets, few tokens common, tiles of few entries
        for name, value in (("CHUNK_TOKENS", 400), ("CHUNK_SETS", 7), ("COMMON", 2 + seed), ("LEAST_RANGES", 1), ("RANGE_TOKENS", 999), ("TILE", 3)):
            monkeypatch.setattr(op, name, value)
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(25):
        base = [word() for _ in range(rng.randint(5, 80))]
        for _ in range(rng.randint(1, 5)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = word()
            texts.append(copy)
    big = [word() for _ in range(100)]
    for _ in range(25):  # near copies of which not all pairs are linked
        copy = list(big)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(100)] = word()
        texts.append(copy)
    texts += [passage + [word() for _ in range(rng.randint(1, 60))] for _ in range(30)]
    texts += [[word() for _ in range(k)] for k in (1, 1, 2, 4, 4)] + [["a"], ["a"], ["A"], ["a", "b"], ["a"] * 9, ["a"] * 30]
    rng.shuffle(texts)
    rows = [(i * 3, " ".join(t)) for i, t in enumerate(texts)]
    got = answer(op.find(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert got == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 977} u{i % 1013}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \t"), (None, None), (4, "one two"), (5, "One\ntwo"), (None, "ONE two"), (5, "one two"), (5, "x y z"), (6, long), (None, long + " end"), (None, "alone here"), (7, "ÄB cd é f g h"), (8, "Äb CD é f g h"), (9, "äb cd é f g h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("sid", "n", "token", "root", "a")})
    assert answer(op.find(docs)) == brute(rows)
    assert op.find(docs.filter("1 = 0")).count() == 0
    assert answer(op.find(docs.filter("text IS NULL"))) == brute([r for r in rows if r[1] is None])
    names = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    assert answer(op.find(names)) == brute([(None if d is None else f"d{d}", t) for d, t in rows])


def test_other_thresholds(spark):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (50, 90):
        assert answer(op.find(docs, percent=percent)) == brute(rows, percent)


def test_near_copies_without_links_make_few_pairs(spark):
    """Copies that share most shingles, but not enough of them, are not handed to the verification pair by pair."""
    rng = random.Random(3)
    rows = []
    for i in range(80):
        copy = [f"w{k}" for k in range(200)]
        for at in range(10, 200, 20):
            copy[at] = f"x{rng.randrange(3)}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = np.empty(0, dtype=np.uint64)
    sets = op.stored(op.shared_tokens(op.frequencies(docs, "text", 5, none, none, 64), 80), "test-sets")
    index = op._entries(sets)
    met = index.alias("l").join(index.alias("r"), (F.col("l.token") == F.col("r.token")) & (F.col("l.sid") < F.col("r.sid")) & op._may_link(80, "l", "r"))
    got = {(r["a"], r["b"]) for r in met.select(F.col("l.sid").alias("a"), F.col("r.sid").alias("b")).distinct().collect()}
    held = {op._sid(t): set(t.tolist()) for t in (op.tokens_of(text, op._Words()) for _, text in rows)}
    linked = {(a, b) for a in held for b in held if a < b and 100 * len(held[a] & held[b]) >= 80 * len(held[a] | held[b])}
    print(len(got), len(linked), len(rows))
    assert linked <= got and len(got) <= 2 * len(linked) + len(rows)
