"""BPE encoding and decoding by a tokenization automaton.

Merges are compiled into a deterministic automaton whose arcs carry tokens and whose paths are exactly the token
sequences that the merges produce. It starts as one state with an arc per base symbol. The merge (u, v) inserts a gadget:
the state behind u is split off and loses its arc v, and wherever u can start, an arc uv leads to where v led. All arcs of
a token enter one state, so a state is split only when other tokens share it. Splits are kept as versions (parent, time)
and lost arcs with their time, which makes compiling linear in the number of merges; whether a state has an arc is looked
up through the versions once and then stands in the transition table.

A word is read by following arcs, the longest first; since every prefix of a word has one encoding, a position is reached
in one state only, and one that leads nowhere is left for good. Decoding emits the labels of the arcs. Words, and in texts
of other scripts what lies between white space, are read once per task and then known with their tokens and labels, in
tables of bounded size.

Defined results. Null text encodes like the empty text: no tokens, empty decoded text. Special tokens of the file are
recognised in texts. Repeated rows each get their row; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table
from trajspark.llm.registry import query

#: Words and chunks longer than this are not kept in a task's tables, which start anew at WORDS entries each.
LONG_WORD = 64
WORDS = 400_000
#: Stands for the word-end mark inside symbol strings, so that every mark is one character.
END = "\ue000"
#: Text the plain splitter may read: ASCII without its separators, and Latin letters and signs up to U+017F without U+0130.
#: There, normalisation is the identity, lower case is letter by letter, and the classes of the split pattern are these.
PLAIN = re.compile(r"[\t-\r -~\xa1-\u012f\u0131-\u017f]*")
LATIN = r"a-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LATIN}]+|[{NUMBER}]|[^\t-\r {LATIN}{NUMBER}]+")
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SYMBOLS = {b: chr(b) for b in PRINTABLE} | {b: chr(0x100 + k) for k, b in enumerate(b for b in range(0x100) if b not in PRINTABLE)}
#: Python takes these for white space, the split pattern does not.
SEPARATOR = re.compile("[\x1c-\x1f]")


class Automaton:
    """Deterministic automaton of a merge list; tokens are numbers, ``base`` tokens are the single symbols."""

    def __init__(self, tokens: int, base: list[int], merges: list[tuple[int, int, int]]):
        """``merges``: (left, right, result) in rank order."""
        self.parent, self.birth = [0], [0]
        self.lost: dict[tuple[int, int], int] = {}
        self.created = [-1] * tokens
        self.left = [-1] * tokens
        self.into = [-1] * tokens  # the state all arcs of a token enter
        for t in base:
            self.created[t], self.into[t] = 0, 0
        sharers = [len(base)]
        for time, (u, v, result) in enumerate(merges, 1):
            if self.created[u] < 0 or self.created[v] < 0 or self.created[result] >= 0:
                raise ValueError(f"merge {time} uses a token before its own merge, or makes one twice")
            behind = self.into[u]
            if not self._arc(behind, v, time - 1):
                continue  # u is never followed by v: the merge can't apply
            self.created[result], self.left[result] = time, u
            self.into[result] = self.into[v]
            sharers[self.into[v]] += 1
            if sharers[behind] > 1:
                sharers[behind] -= 1
                sharers.append(1)
                self.parent.append(behind)
                self.birth.append(time)
                behind = self.into[u] = len(self.parent) - 1
            self.lost[behind, v] = time
        self.now = len(merges)
        self.width = tokens
        self.table: dict[int, bool] = {}

    def _arc(self, state: int, token: int, time: int) -> bool:
        """Whether ``state`` has an arc ``token`` after the merge number ``time``."""
        while True:
            gone = self.lost.get((state, token))
            if gone is not None and gone <= time:
                return False
            made = self.created[token]
            if self.birth[state] > made:  # the state took over this arc, or its absence, when it was split off
                time = self.birth[state] - 1
                state = self.parent[state]
            elif made == 0:
                return True
            else:  # the arc came with its merge, wherever the left part could start
                token, time = self.left[token], made

    def arc(self, state: int, token: int) -> bool:
        place = state * self.width + token
        found = self.table.get(place)
        if found is None:
            if len(self.table) > 1_000_000:
                self.table.clear()
            found = self.table[place] = self.created[token] >= 0 and self._arc(state, token, self.now)
        return found


#: Tokens, their numbers and their labels, both joined by blanks.
Read = tuple[tuple[int, ...], str, str]


def symbols(word: str) -> str:
    """A word in the byte symbols of the file: printable bytes of Latin-1 stand for themselves, the others follow U+0100."""
    return "".join(map(BYTE_SYMBOLS.__getitem__, word.encode()))


class Known(dict):
    """What was read, by text. Neither normalisation nor the split pattern reaches across white space."""

    def __init__(self, make: Callable[[str], Read]):
        super().__init__()
        self.make = make

    def __missing__(self, text: str) -> Read:
        got = self.make(text)
        if len(text) <= LONG_WORD:
            if len(self) >= WORDS:
                self.clear()
            self[text] = got
        return got


class Encoder:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        spec = json.loads(file)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        if model["type"] != "BPE" or not suffix or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError("a BPE vocabulary with word ends and no decoder is needed")
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: t for t, i in vocab.items()} | {i: t for t, i in added.items()}
        self.numbers = {i: str(i) for i in self.labels}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        results = {a + b for a, b in pairs}
        ids = {t: i for t, i in vocab.items() if t not in added}
        base = [i for t, i in ids.items() if t not in results]
        self.automaton = Automaton(max(self.labels) + 1, base, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.ids = {t[: -len(suffix)] + END if t.endswith(suffix) else t: i for t, i in ids.items()}
        self.tree: dict = {}  # symbol to [token that ends here or -1, subtree]
        for t, i in self.ids.items():
            below = self.tree
            for symbol in t:
                node = below.setdefault(symbol, [-1, {}])
                below = node[1]
            node[0] = i
        self.added = added
        self.specials = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        library = Tokenizer.from_str(file)
        self.normal, self.split = library.normalizer, library.pre_tokenizer
        self.words, self.chunks = Known(self._word), Known(self._chunk)

    def word(self, word: str) -> tuple[int, ...]:
        """Tokens of one pre-split word, given in the symbols of the file: the only path of the automaton that reads it.

        Longest arcs are tried first; a position is reached in one state only, so one that leads nowhere is not tried again.
        """
        text, tree, auto = word + END, self.tree, self.automaton
        table, width, into = auto.table, auto.width, auto.into
        n, i, here = len(text), 0, 0
        out: list[int] = []
        trail: list[tuple[int, int, list]] = []
        dead: set[int] = set()
        while True:
            arcs, below = [], tree
            for j in range(i, n):
                node = below.get(text[j])
                if node is None:
                    break
                token, below = node
                if token >= 0:
                    arcs.append((j + 1, token))
            while True:
                if arcs:
                    j, token = arcs.pop()
                    if j in dead:
                        continue
                    follows = table.get(here * width + token)
                    if follows or (follows is None and auto.arc(here, token)):
                        break
                elif trail:
                    dead.add(i)
                    out.pop()
                    i, here, arcs = trail.pop()
                else:
                    raise ValueError(f"no token for a symbol of {word!r}")
            out.append(token)
            if j == n:
                return tuple(out)
            trail.append((i, here, arcs))
            i, here = j, into[token]

    def _word(self, word: str) -> Read:
        return self._emitted(self.word(word if word.isascii() else symbols(word)))

    def _chunk(self, text: str) -> Read:
        if PLAIN.fullmatch(text):
            return self._emitted(tuple(chain.from_iterable(self.words[w][0] for w in PLAIN_WORDS.findall(text.lower()))))
        words = self.split.pre_tokenize_str(self.normal.normalize_str(text))
        return self._emitted(tuple(chain.from_iterable(self.word(w) for w, _ in words)))

    def _emitted(self, ids: tuple[int, ...]) -> Read:
        return ids, " ".join(map(self.numbers.__getitem__, ids)), self.decode(ids)

    def read(self, text: str | None) -> list[Read]:
        """What a text is made of: words of plain text, special tokens, and chunks between white space of other text."""
        out: list[Read] = []
        for k, part in enumerate(self.specials.split(text or "") if self.specials else [text or ""]):
            if k % 2:
                out.append(self._emitted((self.added[part],)))
            elif PLAIN.fullmatch(part):
                out.extend(map(self.words.__getitem__, PLAIN_WORDS.findall(part.lower())))
            elif SEPARATOR.search(part):
                out.extend(filter(itemgetter(0), map(self.chunks.__getitem__, part.split(" "))))
            else:
                out.extend(map(self.chunks.__getitem__, part.split()))
        return out

    def encode(self, text: str | None) -> list[int]:
        return list(chain.from_iterable(map(itemgetter(0), self.read(text))))

    def decode(self, ids: Sequence[int]) -> str:
        return " ".join(map(self.labels.__getitem__, ids))


@lru_cache(maxsize=2)
def _encoder(file: str) -> Encoder:
    return Encoder(file)


def vocabulary(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """doc_id and ``ids`` (array of int). The vocabulary file is read by the driver and broadcast (a few MB)."""
    file = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file.value)
        for batch in batches:
            ids = pa.array((encoder.encode(t.as_py()) for t in batch.column(1)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), run, f"doc_id {kind}, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """Add ``text`` to rows with ``ids``."""
    file = tokens.sparkSession.sparkContext.broadcast(vocabulary(path))

    @F.pandas_udf("string")
    def text_of(ids):
        return ids.map(lambda x: _encoder(file.value).decode(x.tolist()))

    return tokens.withColumn("text", text_of("ids"))


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """Encode and decode in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    file = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file.value)
        for batch in batches:
            counts, tokens, texts = [], [], []
            for value in batch.column(1):
                read = encoder.read(value.as_py())
                ids = " ".join([numbers for _, numbers, _ in read])
                counts.append(ids.count(" ") + 1 if ids else 0)
                tokens.append(hashlib.sha256(ids.encode()).hexdigest())
                texts.append(hashlib.sha256(" ".join([labels for _, _, labels in read]).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(tokens, pa.string()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), run, schema)


@query("op9_bpe_automaton")
def bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(document_table(spark, sf_dir))
