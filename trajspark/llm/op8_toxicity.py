"""Toxicity by nearest labelled examples: exact TF-IDF cosine over all words, by a block-max inverted index.

Fit, on a bounded sample of labelled rows (EXAMPLES of them in the order of their id's MD5, texts of EXAMPLE_CHARS at most):
near copies among the examples are dropped where their labels agree. Every example becomes a unit TF-IDF vector over all
words of the examples. Weights follow the labels: terms that speak for toxicity (chi-square and an exact binomial test;
words, beginnings of words and how often they occur) weigh in full, all other words PLAIN as much. Examples are sorted by
label and terms into blocks; rare terms have lists of postings, frequent ones a matrix, and per frequent term a block keeps
its largest weight. A search visits blocks by their upper bound and leaves out those that cannot hold a better example, so
the neighbours are exact; all examples tied with the last one count too.

Neighbours vote with weight 1 / (distance + 0.1) against a prior, and votes are calibrated by isotonic regression on the
examples themselves, each judged without itself. Where an example has a cosine of COPY or more, such examples alone vote,
and the vote is the score: calibration has seen no copies. A text without any word of the examples gets the rate of such
examples, or the rate of all.

Defined results. Null and empty texts have no terms. No labelled rows: score 0. Conflicting labels of an id: the larger
counts. Repeated rows each get their row; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table
from trajspark.llm.op4_simhash import fingerprint
from trajspark.llm.op5_language import remainder
from trajspark.llm.registry import query

EXAMPLES = 6000
EXAMPLE_CHARS = 10_000
#: Examples whose SimHash differs in fewer bits than this from an earlier one are copies of it.
COPY_BITS = 10
#: A term of full weight needs this chi-square, and so exact a share of toxic examples that chance picks TERM_ERRORS terms
#: in all; the strongest TERMS have it.
CHI_SQUARE = 20.0
TERM_ERRORS = 0.05
TERMS = 5000
#: Weight of all other words beside those.
PLAIN = 0.1
NEIGHBOURS = 15
#: Examples this near are copies of a text.
COPY = 0.95
BLOCK = 64
#: Terms that one in so many examples has are kept as a matrix; texts searched at once; steps in which blocks are visited.
FREQUENT = 16
BATCH = 64
WAVES = 4
PRIOR_VOTES = 2.0
LIMIT = 0.7
WORD = re.compile(r"\w+")
#: Besides whole words, the first letters of longer ones are terms: forms of a word then meet.
PREFIXES = (4, 5, 6, 7)
#: Words whose terms a task remembers.
WORDS = 200_000


#: A term that a text has so often is a term of its own too.
LEVELS = (2, 4, 8)
#: Terms of full weight are evidence of toxicity: at least this share of the examples that have one is toxic.
SHARE = 0.6


def word_terms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def levels(term: str, n: int) -> list[str]:
    return [term, *(f"{term} {k}" for k in LEVELS if n >= k)]


#: Terms and their weights.
Vector = tuple[np.ndarray, np.ndarray]
NONE, MARKED = -1, -2


class BlockMaxIndex:
    """Unit vectors in blocks of BLOCK; ``search`` returns the examples at or above the k-th best cosine, exactly."""

    def __init__(self, vectors: Sequence[dict[int, float] | Vector], terms: int):
        vectors = [_pair(v) if isinstance(v, dict) else v for v in vectors]
        self.size = len(vectors)
        self.blocks = -(-max(1, self.size) // BLOCK)
        rows, ids, weights = _flat(vectors)
        have = np.bincount(ids, minlength=terms)
        frequent = np.flatnonzero(have * FREQUENT >= max(1, self.size))
        self.place = np.full(terms, -1)
        self.place[frequent] = np.arange(len(frequent))
        at = self.place[ids]
        self.frequent = np.zeros((self.blocks, len(frequent), BLOCK))
        self.frequent[rows[at >= 0] // BLOCK, at[at >= 0], rows[at >= 0] % BLOCK] = weights[at >= 0]
        self.most = self.frequent.max(axis=2).T
        order = np.flatnonzero(at < 0)[np.argsort(ids[at < 0], kind="stable")]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(ids[order], minlength=terms))])
        self.number, self.weight = rows[order], weights[order]

    def search(self, vector: dict[int, float], k: int) -> list[tuple[float, int]]:
        """(cosine, number) of positive cosine, best first; ties with the k-th are all there."""
        return self.search_all([_pair(vector)], k)[0]

    def search_all(self, vectors: Sequence[Vector], k: int) -> list[list[tuple[float, int]]]:
        return [found for at in range(0, len(vectors), BATCH) for found in self._batch(vectors[at : at + BATCH], k)]

    def _batch(self, vectors: Sequence[Vector], k: int) -> list[list[tuple[float, int]]]:
        rows, ids, weights = _flat(vectors)
        at, n = self.place[ids], len(vectors)
        dense = np.zeros((n, len(self.most)))
        dense[rows[at >= 0], at[at >= 0]] = weights[at >= 0]
        rare = at < 0
        begin = self.start[ids[rare]]
        many = self.start[ids[rare] + 1] - begin
        postings = np.arange(many.sum()) + np.repeat(begin - np.cumsum(many) + many, many)
        cells = np.repeat(rows[rare] * (self.blocks * BLOCK), many) + self.number[postings]
        scores = np.bincount(cells, np.repeat(weights[rare], many) * self.weight[postings], n * self.blocks * BLOCK)
        scores = scores.astype(float).reshape(n, self.blocks, BLOCK)
        bounds = dense @ self.most + scores.max(axis=2)
        best = np.zeros((n, k))
        for wave in np.array_split(np.argsort(-bounds.max(axis=0), kind="stable"), min(WAVES, self.blocks)):
            top = bounds[:, wave].max(axis=1)
            live = (top > 0) & (top >= best.min(axis=1) - 1e-8)
            for block in wave.tolist():
                if live.all():
                    scores[:, block] += dense @ self.frequent[block]
                else:
                    scores[live, block] += dense[live] @ self.frequent[block]
                    scores[~live, block] = 0.0
            own = scores[:, wave].reshape(n, -1)
            best = np.partition(np.hstack([best, own]), -k, axis=1)[:, -k:]
        out = []
        for of_row, least in zip(scores.reshape(n, -1), best.min(axis=1), strict=True):
            places = np.flatnonzero((of_row > 0) & (of_row >= least - 1e-8))
            found = [(round(score, 9), place) for score, place in zip(of_row[places].tolist(), places.tolist(), strict=True)]
            found.sort(key=lambda f: (-f[0], f[1]))
            out.append([f for f in found if len(found) <= k or f[0] >= found[k - 1][0]])
        return out


def _pair(vector: dict[int, float]) -> Vector:
    return np.fromiter(vector, np.int64, len(vector)), np.fromiter(vector.values(), float, len(vector))


def _flat(vectors: Sequence[Vector]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vector number, term and weight of all entries."""
    ids, weights = (np.concatenate([v[i] for v in vectors] or [np.zeros(0)]) for i in (0, 1))
    return np.repeat(np.arange(len(vectors)), [len(v[0]) for v in vectors]), ids.astype(np.int64), weights


class Numbers(dict):
    """Number of each word: that of the word as a term of weight PLAIN, MARKED where it has terms of full weight, or else NONE."""

    def __init__(self, words: dict[str, int], stems: set[str]):
        self.words, self.stems = words, stems
        #: Most words begin like no term of full weight.
        self.heads = {t.rstrip("*")[: PREFIXES[0]] for t in stems}

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS:
            self.clear()
        marked = word[: PREFIXES[0]] in self.heads and any(t in self.stems for t in word_terms(word))
        self[word] = number = MARKED if marked else self.words.get(word, NONE)
        return number

    def __reduce__(self):
        return Numbers, (self.words, self.stems)


class Model:
    """Fitted on (id, text, label) examples."""

    def __init__(self, examples: Sequence[tuple]):
        examples = _without_copies(examples)
        counts = [Counter(WORD.findall((text or "").lower())) for _, text, _ in examples]
        labels = [int(label) for *_, label in examples]
        total, toxic = len(labels), sum(labels)
        present: Counter = Counter()
        with_label: Counter = Counter()
        for words, label in zip(counts, labels, strict=True):
            times = Counter()
            for word, n in words.items():
                for term in word_terms(word):
                    times[term] += n
            own = {leveled for term, n in times.items() for leveled in levels(term, n)}
            present.update(own)
            if label:
                with_label.update(own)
        strength = {}
        for word, n in present.items():
            a = with_label[word]
            bottom = n * (total - n) * toxic * (total - toxic)
            chi = total * (a * (total - n - toxic + a) - (n - a) * (toxic - a)) ** 2 / bottom if bottom else 0.0
            if a >= SHARE * n and chi >= CHI_SQUARE and _log_tail(a, n, toxic / total) <= math.log(TERM_ERRORS / len(present)):
                strength[word] = chi
        chosen = sorted(sorted(strength, key=lambda w: (-strength[w], w))[:TERMS])
        self.terms = {w: i for i, w in enumerate(chosen)}
        self.stems = {t.partition(" ")[0] for t in self.terms}
        # Words that are no such term come after them.
        others = sorted({w for words in counts for w in words} - self.terms.keys())
        self.numbers = Numbers({w: i for i, w in enumerate(others, len(chosen))}, self.stems)
        idf = [math.log((1 + total) / (1 + present[w])) + 1 for w in [*chosen, *others]]
        self.idf = np.array(idf) * np.repeat([1.0, PLAIN], [len(chosen), len(others)])
        # Blocks hold one label and similar terms where possible: bounds are tighter then.
        vectors = [self._vector(c) for c in counts]
        order = sorted(range(total), key=lambda i: (labels[i], np.sort(vectors[i][0]).tolist(), i))
        self.labels = [labels[i] for i in order]
        self.ids = [examples[i][0] for i in order]
        vectors = [vectors[i] for i in order]
        self.index = BlockMaxIndex(vectors, len(idf))
        plain = [y for v, y in zip(vectors, self.labels, strict=True) if not len(v[0])]
        self.prior = toxic / total if total else 0.0
        self.plain = sum(plain) / len(plain) if plain else self.prior
        judged = []
        for i, found in enumerate(self.index.search_all(vectors, NEIGHBOURS + 1)):
            near = [f for f in found if f[1] != i]
            if len(vectors[i][0]) and not _copies(near):
                judged.append((self._vote(near), self.labels[i]))
        self.steps = _isotonic(judged)

    def _vector(self, counts: Counter) -> Vector:
        ids = np.fromiter(map(self.numbers.__getitem__, counts), np.int64, len(counts))
        ns = np.fromiter(counts.values(), float, len(counts))
        if MARKED in ids:
            words, times, found = list(counts), Counter(), {}
            for i in np.flatnonzero(ids == MARKED).tolist():
                word = words[i]
                ids[i] = self.numbers.words.get(word, NONE)
                for term in word_terms(word):
                    times[term] += counts[word]
            found = {self.terms[t]: n for term, n in times.items() for t in levels(term, n) if t in self.terms}
            ids, ns = np.append(ids, list(found)).astype(np.int64), np.append(ns, list(found.values()))
        ids, ns = ids[ids >= 0], ns[ids >= 0]
        raw = (1 + np.log(ns)) * self.idf[ids]
        return ids, raw / math.sqrt(raw @ raw) if len(ids) else raw

    def _vote(self, near: list[tuple[float, int]]) -> float:
        weights = [1 / (1.1 - s) for s, _ in near]
        toxic = sum(w for w, (_, i) in zip(weights, near, strict=True) if self.labels[i])
        return (toxic + PRIOR_VOTES * self.prior) / (sum(weights) + PRIOR_VOTES)

    def scores(self, texts: Sequence[str | None]) -> list[tuple[float, list]]:
        """Score, and the ids of the three nearest examples, of each text."""
        vectors = [self._vector(Counter(WORD.findall((text or "").lower()))) for text in texts]
        out = []
        for near in self.index.search_all(vectors, NEIGHBOURS):
            copies = _copies(near)
            value = self._vote(copies) if copies else float(np.interp(self._vote(near), *self.steps)) if near else self.plain
            out.append((value, [self.ids[i] for _, i in near[:3]]))
        return out

    def score(self, text: str | None) -> tuple[float, list]:
        return self.scores([text])[0]


def _copies(near: list[tuple[float, int]]) -> list[tuple[float, int]]:
    return [f for f in near if f[0] >= COPY]


def _log_tail(a: int, n: int, rate: float) -> float:
    """Log of the binomial chance of at least ``a`` (or, where that is less likely, at most ``a``) of ``n`` at this rate."""
    ks = range(a, n + 1) if a > n * rate else range(a + 1)
    logs = [math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate) for k in ks]
    top = max(logs)
    return top + math.log(sum(math.exp(x - top) for x in logs))


def _without_copies(examples: Sequence[tuple]) -> list[tuple]:
    """Of examples that are copies of each other, the first of each label."""
    kept, prints = [], {label: [] for label in (0, 1)}
    for example in examples:
        own, seen = np.uint64(fingerprint(example[1])), prints[int(bool(example[2]))]
        if not seen or np.bitwise_count(np.array(seen) ^ own).min() >= COPY_BITS:
            seen.append(own)
            kept.append(example)
    return kept


def _isotonic(pairs: list[tuple[float, int]]) -> tuple[list[float], list[float]]:
    """Increasing step means of label over vote (pool adjacent violators), each with one toxic and one clean vote more."""
    pools: list[list[float]] = []  # votes, labels, count
    for vote, label in sorted(pairs):
        pools.append([vote, float(label), 1.0])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if not pools:
        return [0.0, 1.0], [0.0, 1.0]
    means = np.maximum.accumulate([(y + 0.5) / (n + 1) for _, y, n in pools]).tolist()
    return [v / n for v, _, n in pools], means


def examples(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> list[tuple]:
    """The sample of learnable labelled rows: at most EXAMPLES ids, in the order of their MD5."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    known = known.filter(remainder("doc_id") != 1).groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(EXAMPLES)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).filter(F.length("text") <= EXAMPLE_CHARS)
    rows = texts.join(F.broadcast(drawn), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "label").collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


def score(docs: DataFrame, sample: Sequence[tuple], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, evidence (ids of the nearest examples) for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(sample))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = model.scores(batch.column(1).to_pylist())
            evidence = pa.array([f[1] for f in found], pa.list_(batch.schema.field(0).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.float64()), evidence], ["doc_id", "score", "evidence"])

    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, score double, evidence array<{kind}>")


@query("op8_toxicity_neighbours")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = document_table(spark, sf_dir)
    out = score(docs, examples(docs, document_table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= LIMIT).cast("int")
    return out.select("doc_id", (remainder() == 1).alias("held_out"), "score", predicted.alias("predicted"), "evidence")
