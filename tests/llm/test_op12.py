"""The audit against plain Python."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from trajspark.llm import op12_divergence as op

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def slow_audit(rows, least, top):
    """rows: (text, lang, source)."""
    docs = [("".join(c.lower() if c.isascii() else c for c in t or ""), g or "", s or "") for t, g, s in rows]
    count, within, out = {}, {}, []
    for text, lang, source in docs:
        terms = Counter(TERM.findall(text))
        count.setdefault((lang, source), Counter()).update(terms)
        within.setdefault(lang, Counter()).update(terms.keys())
    for lang, held in within.items():
        kept = [t for t, n in held.items() if n >= least]
        groups = {s: c for (g, s), c in count.items() if g == lang}
        whole = sum(groups.values(), Counter())

        def shares(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in groups if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if groups[s][t] > 0 and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms, 1)]
    return sorted(out)


ROWS = [
    ("The cat sat, THE CAT!", "en", "a"),
    ("the dog and the cat", "en", "b"),
    ("naïve Straße ÄÖ äö the", "en", "a"),
    ("the the the\x00the\x7fthe", "en", "c"),
    ("der Hund", "de", "a"),
    (None, "de", None),
    ("", None, "b"),
    ("12 34 !!", "fr", "x"),
    ("the dog and the cat", "en", "b"),
    ("cat " * 20000 + "日本語 语", None, None),
    ("日本語 cat", None, "b"),
    ("İ ß K", "en", "ü"),
]


@pytest.mark.parametrize("least, top", [(1, 50), (2, 2), (3, 1), (99, 5)])
@pytest.mark.parametrize("tiles", [(2, 3), (128, 4096)])
def test_against_python(spark, monkeypatch, least, top, tiles):
    monkeypatch.setattr(op, "TILE", tiles[0])
    monkeypatch.setattr(op, "SLICE", tiles[1])
    docs = spark.createDataFrame(ROWS, "text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "n", "p", "kept", "at")})
    got = sorted(tuple(r) for r in op.audit(docs.repartition(3), min_docs=least, top=top).collect())
    assert got == slow_audit(ROWS, least, top)


def test_many_small_sums(spark, monkeypatch):
    monkeypatch.setattr(op, "HELD", 3)
    docs = spark.createDataFrame(ROWS, "text string, lang string, source string")
    assert sorted(tuple(r) for r in op.audit(docs, min_docs=2).collect()) == slow_audit(ROWS, 2, 50)
    assert op.audit(docs.filter("1 = 0")).count() == 0


def test_large_counts(spark):
    row = spark.range(1).select(op.share(F.lit(10**15), F.lit(3 * 10**15), F.lit(10**6))).first()[0]
    assert row == 1 + 10**9 * (10**15 + 5) // (3 * 10**15 + 5 * 10**6)
