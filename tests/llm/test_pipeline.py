"""The pipeline against plain Python, stage by stage, each on its own input."""

import re
from collections import Counter

import public_tokenizers
import corpus_pipeline
from tests.llm.test_op4 import slow_components, slow_fingerprint
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_repeats(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    return len({i + d for i, g in enumerate(grams) if often[g] > 1 for d in range(3)})


def good(text):
    words = WORD.findall(text or "")
    return len(words) >= 50 and 100 * slow_repeats(words) <= 50 * len(words)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "exact_dedup", "near_dedup", "mix_sources", "bpe_tokens"]

    kept = corpus_pipeline.stored(stage["quality_rules"](spark, docs, SF), "t")
    assert kept.columns == docs.columns
    want = sorted(tuple(r) for r in docs.collect() if good(r["text"]))
    assert rows(kept) == want

    single = corpus_pipeline.stored(stage["exact_dedup"](spark, kept, SF), "t")
    assert single.columns == docs.columns
    first = {}
    for r in want:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or ""), r)
    assert rows(single) == sorted(first.values())

    near = corpus_pipeline.stored(stage["near_dedup"](spark, single, SF), "t")
    prints = [(r[0], slow_fingerprint(r[1])) for r in sorted(first.values())]
    stay = {d for (d, _), c in zip(prints, slow_components(prints), strict=True) if d == c}
    want = sorted(r for r in first.values() if r[0] in stay)
    assert rows(near) == want

    mixed = corpus_pipeline.stored(stage["mix_sources"](spark, near, SF), "t")
    assert mixed.columns == docs.columns
    source = {r[0]: r for r in want}
    words, target = Counter(), {}
    got = rows(mixed)
    sizes = Counter()
    for r in want:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    for r in got:
        whole = source[r[0]]
        assert whole[1].startswith(r[1]) and (r[0], *r[2:]) == (whole[0], *whole[2:])
        words[r[3]] += len(WORD.findall(r[1]))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    total, left = sum(sizes.values()), dict(weights)
    while True:
        rest = total - sum(target.values())
        share = {s: rest * w / sum(left.values()) for s, w in left.items()}
        over = [s for s in left if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3 * sizes[s]
            del left[s]
    assert all(abs(words[s] - target[s]) <= 1 for s in sizes)
    assert max(Counter(r[0] for r in got).values()) <= 3

    tokens = stage["bpe_tokens"](spark, mixed, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sorted((r["doc_id"], r["n_tokens"], tuple(r["ids"])) for r in tokens) == sorted(
        (r[0], len(ids), tuple(ids)) for r in got for ids in [library.encode(r[1], add_special_tokens=False).ids]
    )


def test_run_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("1 = 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, None, None, 0, 1, "a"), (2, "", "en", "s", None, 2, "b"), (3, long, None, None, 5, 3, None), (3, long, None, None, 5, 3, None), (4, f"  {long} x", "en", "s", 1, 4, "c"), (None, long + " y z", "en", "s", 1, 5, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n long, _key string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF), "t")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "_key"], name
        assert set(r["doc_id"] for r in docs.collect()) <= {3, 4, None}
    assert corpus_pipeline.bpe_tokens(spark, docs, SF).count() == docs.count()
