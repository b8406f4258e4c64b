"""The automaton against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trajspark.llm import op9_bpe as op

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return op.Encoder(op.vocabulary())


def texts():
    rng = random.Random(3)
    letters = "aaaabcdeeiinnorstthxyzABCÄéßñçœİΣςσ'0123456789½²!?.,;:-_#*$%&|<>()[]{}\"\\/~^`@+= \t\n\r\x0b\x0c\x00\x1c\x1f\x7f\x85\xa0 　中文日本語ひらカタ한국어🙂👍🏽ȩ́ﬁǅ"
    for _ in range(1500):
        yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
    for _ in range(500):
        yield "".join(rng.choice("aabetin h") for _ in range(rng.randint(0, 80)))
    yield from ["", " ", "a", "a" * 5000, "the" * 3000, "<|endoftext|>", "x<|startoftext|> y <|endoftext|><|endoftext|>z", "<|ENDOFTEXT|>", "it's we'll I'D they've 'tis 's", "É", "É", "!!!!!!!!", "1234567", "İstanbul ΟΔΟΣ"]


def test_equal_to_library(library, encoder):
    for t in texts():
        want = library.encode(t, add_special_tokens=False).ids
        assert encoder.encode(t) == want, t
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False), t


def test_chunks(library, encoder):
    """Blanks next to marks, apostrophes, other white space and special tokens."""
    odd = ["'s", "it's", "I' m", "\u0301a", "a\u0301", "e \u0301", "\u00a0", "a\u00a0b", "\u2028", "x\u2028y", "<|endoftext|>", "<|startoftext|>b", "ΟΔΟΣ", "Σ", "\u1100", "\u1161", "\x85", "\x1c", "a\nb", "\r\n", "\t", "", " ", "é", "ﬁ", "!!", "12a"]
    odd += [chr(c) for c in range(0x80, 0x250)]
    rng = random.Random(9)
    for _ in range(12000):
        t = rng.choice(["", " "]).join(rng.choice(odd) for _ in range(rng.randint(1, 6)))
        want = library.encode(t, add_special_tokens=False).ids
        assert encoder.encode(t) == want, repr(t)
        assert " ".join(c[1] for c in encoder.read(t)) == " ".join(map(str, want))
        assert " ".join(c[2] for c in encoder.read(t)) == library.decode(want, skip_special_tokens=False)


def test_query(spark, library):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.add((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in op.bpe(spark, SF).collect()} == want


def test_tables(spark, library):
    rows = [(1, None, "x"), (1, "", "x"), (None, "Hello world", None), (2, "hello " * 50000, "y"), (2, "a", "y"), (2, "a", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    tokens = op.encode(docs)
    back = op.decode(tokens).collect()
    assert sorted(r["text"] for r in back) == sorted(library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t, _ in rows)
    assert op.digests(docs).count() == 6 and op.digests(docs.filter("1 = 0")).count() == 0
