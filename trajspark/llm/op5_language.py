"""Language identification by cross-parsing.

Per language, labelled text is indexed in a suffix automaton. A text is parsed against it from left to right into longest
matches; a foreign language needs more and shorter phrases. Phrases times log2 of the indexed length, per character, is an
estimate of the cross entropy in bits, and the language with the least wins.

Phrases end at word bounds: the parsed unit is a run of letters between two blanks, lower case. So a word has the same
phrases wherever it stands, tasks parse each distinct word once, and a text of any length is a sum over its words.

The model is fitted on a bounded sample: per language the first SAMPLE_DOCS labelled documents in the order of their id's
MD5, and of those as many distinct words as fit its share of MODEL_CHARS. Prediction covers every whole text.

Defined results. Null text, or text without a letter: ``und`` with score 0; so is everything when no language was learned.
Ties go to the first language in code point order. Repeated rows each get their row; empty tables give empty results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table
from trajspark.llm.registry import query

SAMPLE_DOCS = 300
#: A language's ids are ranked in so many parts before the first of all parts are.
SAMPLE_PARTS = 16
#: Characters in all automata together, and in one.
MODEL_CHARS = 400_000
LANGUAGE_CHARS = 40_000
#: Words a task remembers; longer words are parsed anew each time.
WORDS = 150_000
LONG_WORD = 64
LETTERS = re.compile(r"[^\W\d_]+")


class SuffixAutomaton:
    """All substrings of a text; ``phrases`` counts the greedy longest matches that cover another text."""

    def __init__(self, text: str):
        self.size = len(text)
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for ch in text:
            state = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and ch not in self.next[at]:
                self.next[at][ch] = state
                at = link[at]
            if at >= 0:
                target = self.next[at][ch]
                if length[target] == length[at] + 1:
                    link[state] = target
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[target]))
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and self.next[at].get(ch) == target:
                        self.next[at][ch] = copy
                        at = link[at]
                    link[target] = link[state] = copy
            last = state

    def phrases(self, text: str) -> int:
        count, at, n, moves = 0, 0, len(text), self.next
        while at < n:
            state, start = 0, at
            while at < n and (to := moves[state].get(text[at])) is not None:
                state = to
                at += 1
            at += at == start  # an unknown character is a phrase of its own
            count += 1
        return count


class Model:
    """One automaton per language; ``words`` has (language, words) pairs."""

    def __init__(self, words: Sequence[tuple[str, str]]):
        self.languages = [lang for lang, _ in words]
        self.automata = [SuffixAutomaton(text) for _, text in words]
        self.bits = np.array([math.log2(a.size + 2) for a in self.automata])
        self.known: dict[str, int] = {}
        self.counts = np.zeros((WORDS + 1, len(words) + 1), dtype=np.int64)

    def _parse(self, word: str) -> list[int]:
        """Letters of the word, then its phrases per language; nothing for a run of other numerals."""
        if not any(c.isalpha() for c in word):
            return [0] * (len(self.automata) + 1)
        return [len(word), *(a.phrases(f" {word} ") for a in self.automata)]

    def predict(self, text: str | None) -> tuple[str, float]:
        total = np.zeros(len(self.automata) + 1, dtype=np.int64)
        rows: list[int] = []
        for word in LETTERS.findall((text or "").lower()):
            row = self.known.get(word)
            if row is None:
                if len(word) > LONG_WORD:
                    total += self._parse(word)
                    continue
                if len(self.known) >= WORDS:
                    total += self.counts[rows].sum(axis=0)
                    rows = []
                    self.known.clear()
                row = self.known[word] = len(self.known)
                self.counts[row] = self._parse(word)
            rows.append(row)
        total += self.counts[rows].sum(axis=0)
        if not total[0] or not self.languages:
            return "und", 0.0
        bits = total[1:] * self.bits / total[0]
        best = int(bits.argmin())
        rest = np.delete(bits, best)
        return self.languages[best], float(rest.min() / (rest.min() + bits[best])) if len(rest) else 1.0


def remainder(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 3; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def training_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """(language, distinct words) pairs of the sample. What reaches the driver is bounded by the parameters above."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    labelled = labelled.filter("lang is not null and text is not null and doc_id is not null").filter(remainder("doc_id") != 1)
    order = [F.md5(F.col("doc_id").cast("string")), F.col("doc_id")]
    drawn = labelled.select("doc_id", "lang").withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_PARTS)))
    for keys in (["lang", "_part"], ["lang"]):  # the first of each part, then the first of those
        drawn = drawn.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= SAMPLE_DOCS)
    # SAMPLE_DOCS small rows per language, and the languages are what the driver builds a model of: texts stay in place.
    drawn = F.broadcast(drawn.drop("_part"))
    texts = labelled.join(drawn, ["doc_id", "lang"]).select("lang", "rank", F.substring(F.lower("text"), 1, LANGUAGE_CHARS).alias("text"))
    letters = F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), 1)
    words = texts.select("lang", "rank", F.posexplode(letters).alias("place", "word")).filter(F.length("word") <= LONG_WORD)
    words = words.groupBy("lang", "word").agg(F.min(F.struct("rank", "place")).alias("first"))
    first = Window.partitionBy("lang").orderBy("first", "word")
    used = F.sum(F.length("word") + 1).over(first.rowsBetween(Window.unboundedPreceding, 0))
    kept = words.withColumn("used", used).filter(F.col("used") <= LANGUAGE_CHARS)
    found = kept.groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "word"))), lambda x: x["word"]), " ").alias("words"))
    rows = sorted((r["lang"], r["words"]) for r in found.collect())
    share = MODEL_CHARS // max(1, len(rows))
    return [(name, f" {w[:share]} ") for name, w in rows]


def predict(docs: DataFrame, words: Sequence[tuple[str, str]], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(list(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(1)]
            columns = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, lang_pred string, score double")


_MODELS: dict[int, Model] = {}


def _model(shared) -> Model:
    """The worker's model; a worker keeps the last one it built."""
    key = hash(tuple(shared.value))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Model(shared.value)
    return _MODELS[key]


@query("op5_language_cross_parsing")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = document_table(spark, sf_dir)
    out = predict(docs, training_words(docs))
    return out.select("doc_id", (remainder() == 1).alias("held_out"), "lang_pred", "score")
