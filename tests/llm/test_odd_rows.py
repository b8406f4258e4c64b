"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.llm import op1_mix, op2_warc, op3_exact_dedup, op5_language, op7_url_rules, op8_toxicity, op10_quality
from trajspark.llm.common import new_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [(1, None), (2, ""), (3, " a  b\n"), (4, "\ta b "), (4, "\ta b "), (None, " a b "), (None, None), (5, "ä#$ é\n\nä#$ é\nx"), (6, "w " * 40000), (7, " ".join(f"w{i % 7} v{i}" for i in range(3000)))]
EXTRA = ["size", "_source", "kept", "_words", "target", "n", "host", "failed", "_q", "key", "norm"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, None if (d or 0) % 3 == 0 else f"s{(d or 0) % 3}", "en" if (d or 0) % 2 else None) for d, t in TEXTS]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return df.withColumns({n: F.lit("x") for n in EXTRA})


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def test_mix(spark, docs):
    got = op1_mix.mix(docs).collect()
    size = Counter((d, len(WORD.findall(t or ""))) for d, t in TEXTS)
    assert Counter((r["doc_id"], r["size"]) for r in got) == size
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    targets = {(r["source_size"], r["target"]) for r in got}
    assert sum(r["taken"] for r in got) == pytest.approx(sum(size_ * n for (_, size_), n in size.items()), abs=2) and len(targets) == 3
    assert sorted(map(key, got)) == sorted(map(key, op1_mix.mix(docs).collect()))
    assert op1_mix.mix(docs.filter("1 = 0")).count() == 0


def test_warc(spark):
    big, other = "<p>" + "x" * 2000, "y" * 999
    rows = [(1, "http://a/ b\r\n", big), (2, None, big), (9, "u", big), (9, "u", big), (None, "u", big), (3, "u", other), (4, "u", other), (5, "u", None), (6, "u", ""), (7, "ü", "é\r\n\r\nWARC/1.1\r\n" * 90), (8, "u", "z" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1)).withColumn("n", F.lit(2))
    folder = new_path(spark, "warc")
    manifest = op2_warc.write_archives(pages, folder)
    got = op2_warc.read_archives(manifest, folder).collect()
    want = []
    for p, _, h in rows:
        body = (h or "").encode()
        revisit = len(body) >= 1000 and h == big and p != 9
        want.append((p, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", 9 if revisit else None))
        assert revisit or body in [r["payload"] for r in got if r["page_id"] == p]
    have = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(map(key, have)) == sorted(map(key, want))
    none = op2_warc.write_archives(pages.filter("1 = 0"), new_path(spark, "warc"))
    assert none.count() == 0 and op2_warc.read_archives(none, folder).count() == 0


def test_warc_dictionary():
    rng = random.Random(1)
    records = [op2_warc._record(i, f"http://h/{i}", ("<html><body>" + "".join(rng.choice("abcdef ") for _ in range(300))).encode(), 312, "00" * 20, None) for i in range(400)]
    import io
    import tempfile

    folder = tempfile.mkdtemp()
    name, count, _ = op2_warc._write_archive(folder, records)
    raw = open(f"{folder}/{name}", "rb").read()
    assert raw[:4] == (0x184D2A5D).to_bytes(4, "little") and count == 400
    blocks = [block for _, block in op2_warc.records_of(io.BytesIO(raw))]
    assert len(blocks) == 400 and all(r.endswith(b + b"\r\n\r\n") for r, b in zip(records, blocks, strict=True))


@pytest.mark.parametrize("capacity", [1, 3, 4096])
def test_exact(spark, docs, capacity):
    got = op3_exact_dedup.find(docs, capacity=capacity).collect()
    norm = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in TEXTS]
    first, size = {}, Counter(t for _, t in norm)
    for d, t in norm:
        first[t] = min((x for x in (d, first.get(t)) if x is not None), default=None)
    want = [(d, first[t], size[t], d == first[t], hashlib.sha256(t.encode()).hexdigest()) for d, t in norm]
    assert sorted(map(key, got)) == sorted(map(key, want))
    kept = op3_exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == len(size)
    empty = docs.filter("1 = 0")
    assert op3_exact_dedup.find(empty).count() == 0 and op3_exact_dedup.keep_first(empty).count() == 0


def test_directory():
    rng = np.random.default_rng(0)
    for capacity in (1, 10, 500):
        cells = np.where(rng.random(1 << 16) < 0.02, rng.integers(0, 50, 1 << 16), 0)
        d = op3_exact_dedup.Directory(cells, capacity)
        assert all(load <= capacity or depth == 16 for load, depth in zip(d.loads, d.local, strict=True))
        keys = rng.integers(-(2**63), 2**63, 1000)
        prefix = keys.view(np.uint64) >> np.uint64(48)
        assert (d.starts[d.bucket(keys)] <= prefix).all() and d.loads.sum() == cells.sum()
        owners = d.owners(7)
        assert (np.diff(owners) >= 0).all() and owners.max() < 7


def slow_phrases(model, text):
    n = at = 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at : at + size + 1] in model:
            size += 1
        at += max(size, 1)
        n += 1
    return n


def test_suffix_automaton():
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        other = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 60)))
        assert op5_language.SuffixAutomaton(text).phrases(other) == slow_phrases(text, other)


def test_language(spark, docs):
    train = [(i, f"the of and {'ing ' * (i % 4)}", "en") for i in range(10, 30)] + [(i, "der die und heit", "de") for i in range(30, 50)]
    both = docs.select("doc_id", "text", "lang").union(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    words = op5_language.training_words(both)
    assert [w[0] for w in words] == ["de", "en"]
    got = op5_language.predict(both, words).collect()
    assert len(got) == len(TEXTS) + 40 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["lang_pred"] == lang for i, _, lang in train for r in got if r["doc_id"] == i)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2)} == {"und"}
    assert {r["lang_pred"] for r in op5_language.predict(docs, []).collect()} == {"und"}
    empty = both.filter("1 = 0")
    assert op5_language.predict(empty, op5_language.training_words(empty)).count() == 0


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_language.language(spark, sf).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) >= 0.98 * len(held)


def test_urls(spark):
    hosts = ["com", "example.com", "www.example.com", "xexample.com", "net", "a.net", "a.b.net", "b.org", "EXAMPLE.COM", "", "com.", "example.com:80"]
    urls = [f"http://{h}{p}" for h in hosts for p in ("", "/", "/en/", "/en", "/es/x", "?q=/en/", "#/", "/en/?x#y", "/en//://z")] + [None, "", "com/", "://com/", "http:/com/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0]), (None, urls[2])], "page_id long, url string").withColumn("key", F.lit(1))
    rules = [*op7_url_rules.RULES, ("block", "com", "/en/"), ("allow", "com", "/en/"), ("allow", "b.org", ""), ("block", "a.b.net", "/")]
    got = op7_url_rules.judge(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()

    def slow(u):
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fits = [(len(h), len(p), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *max(fits)[3:]) if fits else (host, path, None, "allow")

    want = [(i, *slow(u)) for i, u in enumerate(urls)] + [(0, *slow(urls[0])), (None, *slow(urls[2]))]
    assert sorted(map(key, got)) == sorted(map(key, want))
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert {r["verdict"] for r in op7_url_rules.judge(pages, none).collect()} == {"allow"}
    assert op7_url_rules.judge(pages.filter("1 = 0"), none).count() == 0


def test_block_max_index():
    rng = random.Random(2)
    for _ in range(20):
        vectors = [{t: rng.choice([0.2, 0.5, 0.9]) for t in rng.sample(range(12), rng.randint(0, 4))} for _ in range(300)]
        index = op8_toxicity.BlockMaxIndex(vectors, 12)
        query = {t: rng.random() for t in rng.sample(range(12), 3)}
        scores = sorted(((round(sum(w * v.get(t, 0) for t, w in query.items()), 9), i) for i, v in enumerate(vectors)), key=lambda f: (-f[0], f[1]))
        scores = [s for s in scores if s[0] > 0]
        want = [s for s in scores if s[0] >= scores[min(14, len(scores) - 1)][0]]
        got = index.search(query, 15)
        assert [i for _, i in got] == [i for _, i in want]


def test_toxicity(spark, docs):
    train = [(100 + i, f"plain word{i % 9} text bad{i % 2}" if i % 4 == 0 else f"plain word{i % 9} text", int(i % 4 == 0)) for i in range(400)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame([t[:2] for t in train], "doc_id long, text string"))
    labels = spark.createDataFrame([(i, y) for i, _, y in train] + [(100, 1), (None, 1), (5, None)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    got = op8_toxicity.score(both, op8_toxicity.examples(both, labels)).collect()
    assert len(got) == len(TEXTS) + 400 and all(0 <= r["score"] <= 1 for r in got)
    none = op8_toxicity.score(both, op8_toxicity.examples(both, labels.filter("1 = 0"))).collect()
    assert {r["score"] for r in none} == {0.0}
    assert op8_toxicity.score(both.filter("1 = 0"), op8_toxicity.examples(both, labels)).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in op8_toxicity.toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in toxic]
    flagged = [toxic[r["doc_id"]] for r in rows if r["predicted"]]
    assert sum(flagged) >= 0.93 * len(flagged) and sum(flagged) >= 0.8 * sum(toxic[r["doc_id"]] for r in rows)


def test_quality(spark, docs):
    got = op10_quality.judge(docs).collect()
    want = []
    for d, t in TEXTS:
        words = WORD.findall(t or "")
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        often = Counter(grams)
        repeats = len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)})
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        want.append((d, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeats, len(words) < 50 or 100 * repeats > 50 * len(words)))
    assert sorted(map(key, [tuple(r)[:7] for r in got])) == sorted(map(key, want))
    assert all(not r["kept"] for r in got if r["base_failed"])
    good = op10_quality.keep_good(docs)
    assert good.columns == docs.columns and {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert op10_quality.judge(docs.filter("1 = 0")).count() == 0 and op10_quality.keep_good(docs.filter("1 = 0")).count() == 0


def test_bad_host_falls(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text if i % 20 == 0 else "short", "bad") for i in range(400)] + [(1000 + i, text, f"good{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r["host"]: r["kept"] for r in op10_quality.judge(docs).collect() if not r["base_failed"]} == {"bad": False} | {f"good{i}": True for i in range(5)}
    assert op10_quality.keep_good(docs).count() == 400
