"""Toxicity neighbours over all words, against plain TF-IDF."""

import random

from trajspark.llm import op8_toxicity as op


def text(rng, words, n=40):
    return " ".join(rng.choice(words) for _ in range(n))


def sample(n=400):
    """One toxic text in ten, and no word that shows it."""
    rng = random.Random(3)
    words = [f"{rng.getrandbits(20):05x}" for _ in range(3000)]
    return [(i, text(rng, words), int(i % 10 == 0)) for i in range(n)]


def test_copy_of_a_toxic_example_is_flagged():
    rows = sample()
    model = op.Model(rows)
    assert not model.terms
    got = model.scores([t for _, t, _ in rows])
    assert [s >= op.LIMIT for s, _ in got] == [bool(y) for *_, y in rows]
    assert all(evidence[0] == i for (i, *_), (_, evidence) in zip(rows, got, strict=True))


def test_clean_examples_are_neighbours():
    rows = sample()
    clean = next(t for _, t, y in rows if not y)
    near = op.Model(rows).index.search(dict.fromkeys(range(50), 0.1), 15)
    assert len(near) >= 15
    score, evidence = op.Model(rows).score(clean.replace(" ", "  ", 3) + " unheard")
    assert score < op.LIMIT and evidence


def test_few_labelled_rows():
    rng = random.Random(5)
    bad, good = [f"bad{c}" for c in "abcdefgh"], [f"good{c}" for c in "ijklmnop"]
    rows = [(i, text(rng, bad if i % 2 else good, 12), i % 2) for i in range(12)]
    model = op.Model(rows)
    assert not model.terms
    got = model.scores([text(rng, bad, 12), text(rng, good, 12)])
    assert got[0][0] > got[1][0]


def test_copies_with_other_labels_stay():
    one = text(random.Random(7), [f"w{i}" for i in range(500)], 60)
    assert len(op._without_copies([(1, one, 1), (2, one, 1), (3, one, 0), (4, one, 0)])) == 2
    assert op.Model([(1, one, 1), (2, one, 0)]).score(one)[0] == 0.5
