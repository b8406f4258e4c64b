"""N-gram Jaccard join: prefix filters under three global token orders, intersected before any pair is verified.

A document is the set of its distinct word shingles (tokens). If two sets of Jaccard similarity t or more are sorted by the
same order, their first ``n - ceil(t n) + 1`` tokens share one, whatever the order is. All three orders put rare tokens
first, so that passages of many documents come last; they differ in how tokens of like frequency follow each other. The
first order makes the candidates by an inverted index; those of the other two travel as bit sets of the prefix, and a
candidate pair must have a bit in common under each of them, besides sizes and a place of the shared token that still allow
the similarity. Tokens of one set only, and places of two parity bit maps that differ, are tokens that the pair does not share;
there may be at most ``(100 - t) / (100 + t)`` of both sizes. What passes is verified on the tokens that the sets can have in common.

1. ``token_sets``: per document the 128-bit hash of its token set (equal sets are one class from here on), and the tokens
   that many documents of a task share, whose number has a bound.
2. ``frequencies``: token sets of a task go out as packets by token range; a range returns, per task, the tokens that more
   than one set has. Common tokens of step 1 are not sent.
3. ``shared_tokens``: per set the returned tokens, the index entries of its prefix, the bit sets. A token of one set only
   can't make a candidate or add to an overlap; it takes its place in the prefix and is dropped.
4. Every index entry first meets a few pivots of its token, a linear number of pairs. Their verified links make classes, and
   then only entries of different classes meet, in tiles of bounded size. So a large group of near copies costs no pairs of
   its members, and no link between different classes is lost.

Tokens are 64-bit hashes; two different shingles of one pair of sets with equal hashes would count as one.

Defined results. Null text, and text without words, has the empty set, is linked with nothing and has its own doc_id as
component_id. Null ids are ignored as component ids unless a component has no other. Repeated rows each get their row.
Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table, shared_join, stored
from trajspark.llm.op4_simhash import components
from trajspark.llm.registry import query

WIDTH = 5
#: Least similarity in hundredths.
PERCENT = 80
#: A packet source holds at most this many tokens and sets.
CHUNK_TOKENS = 2_000_000
CHUNK_SETS = 60_000
#: A token is common if the chunks report it more often than this times their number, and they report from this on: at most
#: CHUNK_TOKENS / COMMON tokens are common whatever the data.
COMMON = 16
#: Tokens of one range when all are evenly spread.
RANGE_TOKENS = 4_000_000
LEAST_RANGES = 64
#: Entries of one token that meet in one task, and pairs of one set.
TILE = 1000
#: Pivots of a token.
PIVOTS = 6
#: Frequencies of common tokens start here.
ABOVE = 1 << 40
#: Words a task keeps the hashes of.
WORDS = 400_000
PRIMES = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]
BITS = ("b0", "b1", "c0", "c1")
#: Parities of a set's shared tokens by 64 * len(PARITY) places.
PARITY = ("x0", "x1", "x2", "x3", "x4", "x5", "x6", "x7")
MARKS = (*BITS, "alone", *PARITY)


class _Words(dict):
    """Hashes of words, looked up or made."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def _mixed(x: np.ndarray, prime: np.uint64 = PRIMES[0]) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * prime
    x = (x ^ (x >> np.uint64(29))) * PRIMES[1]
    return x ^ (x >> np.uint64(32))


def tokens_of(text: str | None, words: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text: all ``width`` words, or the whole sequence where it is shorter."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and the six white spaces
    if not parts:
        return np.empty(0, dtype=np.uint64)
    each = np.fromiter(map(words.__getitem__, parts), dtype=np.uint64, count=len(parts))
    n = max(1, len(parts) - width + 1)
    out = np.full(n, min(width, len(parts)), dtype=np.uint64)
    for k in range(min(width, len(parts))):
        out = _mixed(out + each[k : k + n])
    return np.unique(out)


def _sid(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def _chunks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list[bytes], list[np.ndarray]]]:
    """Distinct token sets of a task in chunks of bounded size, the empty one left out; ids are not kept."""
    words, sets, held = _Words(), {}, 0
    for batch in batches:
        for value in batch.column(batch.num_columns - 1):
            tokens = tokens_of(value.as_py(), words, width)
            sid = _sid(tokens)
            if len(tokens) and sid not in sets:
                if held + len(tokens) > CHUNK_TOKENS or len(sets) >= CHUNK_SETS:
                    yield list(sets), list(sets.values())
                    sets, held = {}, 0
                sets[sid] = tokens
                held += len(tokens)
    if sets:
        yield list(sets), list(sets.values())


def token_sets(docs: DataFrame, id_col: str, text: str, width: int) -> DataFrame:
    """Rows of documents (doc_id, sid, n) and, with null sid, of tokens that are frequent in a chunk (token, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "sid", "n", "token", "count"]
        words, sets, held, kind = _Words(), {}, 0, None

        def report() -> pa.RecordBatch:
            token, count = np.unique(np.concatenate(list(sets.values()) or [np.empty(0, np.uint64)]), return_counts=True)
            token, count = token[count >= COMMON].view(np.int64), count[count >= COMMON]
            rows = len(token) + 1  # the first row stands for the chunk
            columns = [pa.nulls(rows, kind), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.int64())]
            columns += [pa.array([None, *token.tolist()], pa.int64()), pa.array([None, *count.tolist()], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            kind = batch.schema.field(0).type
            sids, sizes = [], []
            for value in batch.column(1):
                tokens = tokens_of(value.as_py(), words, width)
                sid = _sid(tokens)
                sids.append(sid)
                sizes.append(len(tokens))
                if len(tokens) and sid not in sets:
                    if held + len(tokens) > CHUNK_TOKENS or len(sets) >= CHUNK_SETS:
                        yield report()
                        sets, held = {}, 0
                    sets[sid] = tokens
                    held += len(tokens)
            rows = len(sids)
            columns = [batch.column(0), pa.array(sids, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], names)
        if sets:
            yield report()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return arrow_map(rows, run, f"doc_id {kind}, sid binary, n long, token long, count long")


def _planes(values: np.ndarray) -> bytes:
    """Bytes by significance: those of sorted numbers compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def frequencies(docs: DataFrame, text: str, width: int, common: np.ndarray, counts: np.ndarray, ranges: int) -> DataFrame:
    """Per chunk: one row with its sets (sids, sizes, common tokens), and the tokens of several sets with their frequency."""
    shared = docs.sparkSession.sparkContext.broadcast((common, counts))
    shift = np.uint64(64 - int(math.log2(ranges)))
    fields = ["range", "chunk", "sids", "sizes", "tokens", "places", "counts"]
    schema = "range int, chunk long, sids binary, sizes binary, tokens binary, places binary, counts binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, counts = shared.value
        for sids, sets in _chunks(batches, width):
            token = np.concatenate(sets)
            sizes = np.array([len(s) for s in sets], dtype=np.uint32)
            place = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
            order = np.argsort(token, kind="stable")
            token, place = token[order], place[order]
            at = np.minimum(np.searchsorted(common, token), max(0, len(common) - 1))
            known = common[at] == token if len(common) else np.zeros(len(token), dtype=bool)
            chunk = xxhash.xxh3_64_intdigest(b"".join(sids)) >> 1
            often = counts[at[known]] if len(common) else np.empty(0, np.uint64)
            rows = [(int(chunk % ranges), b"".join(sids), _planes(sizes), _planes(token[known]), _planes(place[known]), _planes(often))]
            token, place = token[~known], place[~known]
            part = (token >> shift).astype(np.int64)
            cuts = np.searchsorted(part, np.arange(ranges + 1))
            rows += [(r, None, None, _planes(token[a:b]), _planes(place[a:b]), None) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            for row in rows:
                columns = [pa.array([row[0]], pa.int32()), pa.array([chunk], pa.int64()), *(pa.array([x], pa.binary()) for x in row[1:])]
                yield pa.RecordBatch.from_arrays(columns, fields)

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        packets = [(r["chunk"], _numbers(r["tokens"], "<u8"), r["places"]) for r in rows if r["sids"] is None]
        token, n = np.unique(np.concatenate([p[1] for p in packets] or [np.empty(0, np.uint64)]), return_counts=True)
        token, n = token[n > 1], n[n > 1].astype(np.uint64)
        out = [r for r in rows if r["sids"] is not None]
        for chunk, here, places in packets:
            at = np.minimum(np.searchsorted(token, here), max(0, len(token) - 1))
            known = token[at] == here if len(token) else np.zeros(len(here), dtype=bool)
            if known.any():
                found = (here[known], _numbers(places, "<u2")[known], n[at[known]])
                out.append(dict.fromkeys(fields) | {"chunk": chunk} | dict(zip(fields[4:], map(_planes, found), strict=True)))
        return pa.Table.from_pylist(out, schema=table.schema)

    packets = arrow_map(docs.select(F.col(text).alias("text")), send, schema)
    return packets.groupBy("range").applyInArrow(count, schema)


def shared_tokens(counted: DataFrame, percent: int) -> DataFrame:
    """Per set that can have a partner: sid, n, ``tokens`` (sorted bytes), index entries, bit sets of two more prefixes."""

    def assemble(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        side = next(r for r in rows if r["sids"] is not None)
        sids = [side["sids"][i : i + 16] for i in range(0, len(side["sids"]), 16)]
        n = _numbers(side["sizes"], "<u4").astype(np.int64)
        # Equal chunks of two tasks have one number: their repeated sides and packets say the same.
        packets = {(r["tokens"], r["places"]): r for r in rows if r["tokens"]}.values()
        parts = [[_numbers(r[name], kind) for r in packets] for name, kind in (("tokens", "<u8"), ("places", "<u2"), ("counts", "<u8"))]
        token, place, often = (np.concatenate(p or [np.empty(0, kind)]) for p, kind in zip(parts, ("<u8", "<u2", "<u8"), strict=True))
        place = place.astype(np.int64)
        known = np.bincount(place, minlength=len(n))
        alone = n - known  # tokens of this set only: they come first in every order
        room = np.maximum(0, prefix_length(n, percent) - alone)
        ends = np.cumsum(known)

        def prefix(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            order = np.lexsort((*keys, place))
            at = np.arange(len(order)) - (ends - known)[place[order]]
            inside = at < room[place[order]]
            return order[inside], at[inside]

        first, at = prefix(token, often)
        width = np.log2(often.astype(np.float64)).astype(np.int64)
        bits, parities = [], []
        for key, classes in ((_mixed(token, PRIMES[1]), width), (_mixed(token, PRIMES[2]), width // 2)):
            entry, _ = prefix(key, classes)
            spot = _mixed(token[entry], PRIMES[0]) & np.uint64(127)
            for half in (0, 1):
                held = np.zeros(len(n), dtype=np.uint64)
                mine = (spot >> np.uint64(6)) == half
                np.bitwise_or.at(held, place[entry[mine]], np.uint64(1) << (spot[mine] & np.uint64(63)))
                bits.append(held.view(np.int64))
        spot = _mixed(token ^ PRIMES[1], PRIMES[2]) % np.uint64(64 * len(PARITY))
        for word in range(len(PARITY)):
            held = np.zeros(len(n), dtype=np.uint64)
            mine = (spot >> np.uint64(6)) == word
            np.bitwise_xor.at(held, place[mine], np.uint64(1) << (spot[mine] & np.uint64(63)))
            parities.append(held.view(np.int64))
        rest = n[place[first]] - alone[place[first]] - at  # tokens from the entry on
        keep = np.flatnonzero(room > 0)
        starts = np.searchsorted(place[first], keep)
        stops = np.searchsorted(place[first], keep, "right")
        full, starts, stops = keep[stops > starts], starts[stops > starts], stops[stops > starts]
        by_set = np.lexsort((token, place))
        token_sorted = token[by_set]
        listed = [token_sorted[ends[i] - known[i] : ends[i]].tobytes() for i in full.tolist()]
        lists = [[x[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)] for x in (token[first].view(np.int64), rest)]
        columns = [pa.array([sids[i] for i in full.tolist()], pa.binary()), pa.array(n[full]), pa.array(listed, pa.binary())]
        columns += [pa.array(x, pa.list_(pa.int64())) for x in lists] + [pa.array(b[full]) for b in (*bits, alone, *parities)]
        return pa.table(columns, names=["sid", "n", "tokens", "entry", "rest", *MARKS])

    schema = "sid binary, n long, tokens binary, entry array<long>, rest array<long>, " + ", ".join(f"{b} long" for b in MARKS)
    return counted.groupBy("chunk").applyInArrow(assemble, schema).dropDuplicates(["sid"])


def _may_link(percent: int, a: str, b: str):
    """Sizes, places, prefixes under the other orders and the tokens known to differ allow the similarity."""
    both = (F.col(f"{a}.n") + F.col(f"{b}.n")) * percent
    reach = F.least(f"{a}.rest", f"{b}.rest") * (100 + percent)
    ok = reach >= both
    for x, y in (BITS[:2], BITS[2:]):
        ok = ok & ((F.col(f"{a}.{x}").bitwiseAND(F.col(f"{b}.{x}")) != 0) | (F.col(f"{a}.{y}").bitwiseAND(F.col(f"{b}.{y}")) != 0))
    # A token of both sets leaves no trace in the difference of their parities, one of a single set flips one place.
    differ = F.col(f"{a}.alone") + F.col(f"{b}.alone")
    for x in PARITY:
        differ = differ + F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}")))
    return ok & (differ * (100 + percent) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent))


def _entries(sets: DataFrame) -> DataFrame:
    at = F.explode(F.arrays_zip("entry", "rest")).alias("e")
    rows = sets.select("sid", "n", *MARKS, at).select(F.col("e.entry").alias("token"), "sid", "n", F.col("e.rest").alias("rest"), *MARKS)
    return stored(rows, "jaccard-index")


def pivot_pairs(index: DataFrame, percent: int) -> DataFrame:
    """Each entry with the pivots of its token: the sets with the least values of PIVOTS hashes, so near copies share few."""
    own = F.struct("sid", "n", "rest", *MARKS)
    least = [F.min(F.struct(F.xxhash64("sid", F.lit(k)).alias("h"), own.alias("row"))) for k in range(PIVOTS)]
    pivots = index.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.array(*least).alias("p")).filter("k > 1")
    pivots = stored(pivots.select("token", "k", F.array_distinct(F.transform("p", lambda x: x["row"])).alias("p")), "jaccard-pivots")
    met = shared_join(index.withColumn("own", own), pivots, ["token"], "k", ["sid"], "inner").withColumn("p", F.explode("p"))
    met = met.filter(F.col("p.sid") != F.col("own.sid")).filter(_may_link(percent, "p", "own"))
    return met.select(F.least("p.sid", "sid").alias("a"), F.greatest("p.sid", "sid").alias("b")).distinct()


def class_pairs(index: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """All pairs of entries of one token whose sets are in different classes; a token's entries are cut into tiles."""
    sized = classes.groupBy("node").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("k"))
    index = index.join(sized.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    tokens = index.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.min("root").alias("least"), F.max("root").alias("most"))
    tokens = tokens.filter("least <> most").select("token", "k", F.ceil(F.col("k") / TILE).alias("tiles"))
    mixed = stored(shared_join(index, stored(tokens, "jaccard-tokens"), ["token"], "k", ["sid"], "inner"), "jaccard-mixed")
    tile = F.pmod(F.xxhash64("sid"), F.col("tiles"))
    dealt = mixed.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    dealt = dealt.withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")})
    left, right = dealt.filter("tile = lo").alias("l"), dealt.filter("tile = hi").alias("r")
    apart = (F.col("l.root") != F.col("r.root")) & ((F.col("l.lo") != F.col("l.hi")) | (F.col("l.sid") < F.col("r.sid")))
    same = [F.col(f"l.{x}") == F.col(f"r.{x}") for x in ("token", "lo", "hi")]
    met = left.join(right, [*same, apart, _may_link(percent, "l", "r")])
    return met.select(F.least("l.sid", "r.sid").alias("a"), F.greatest("l.sid", "r.sid").alias("b")).distinct()


def _with_tokens(pairs: DataFrame, sets: DataFrame, side: str, other: str) -> DataFrame:
    """``pairs`` with the size and tokens of ``side``; a set of many pairs is copied, its pairs are dealt to the copies."""
    many = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("k")).withColumn("copies", F.ceil(F.col("k") / TILE))
    many = stored(many, "jaccard-copies")
    dealt = shared_join(pairs, many, [side], "k", [other], "inner").withColumn("copy", F.pmod(F.xxhash64(other), F.col("copies")))
    wanted = sets.select(F.col("sid").alias(side), F.col("n").alias(f"n_{side}"), F.col("tokens").alias(f"t_{side}")).join(many, side)
    wanted = wanted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).drop("k", "copies")
    return dealt.drop("copies").join(wanted, [side, "copy"]).drop("copy")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(batch.schema.get_field_index(x)) for x in ("t_a", "t_b"))
            n = sum(batch.column(batch.schema.get_field_index(x)).to_numpy(zero_copy_only=False) for x in ("n_a", "n_b"))
            both = [len(np.intersect1d(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"), True)) for x, y in zip(a, b, strict=True)]
            both = np.array(both, dtype=np.int64)
            good = pa.array(100 * both >= percent * (n - both), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(x)).filter(good) for x in ("a", "b")], ["a", "b"])

    pairs = stored(pairs, "jaccard-pairs")
    rows = _with_tokens(_with_tokens(pairs, sets, "a", "b"), sets, "b", "a")
    return arrow_map(rows.select("a", "b", "n_a", "n_b", "t_a", "t_b"), run, "a binary, b binary")


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable)."""
    found = stored(token_sets(docs, id_col, text, width), "jaccard-sets")
    members = found.filter("sid IS NOT NULL").select("doc_id", "sid", "n")
    reports = found.filter("sid IS NULL")
    chunks, total = reports.filter("token IS NULL").count(), members.agg(F.sum("n")).first()[0] or 0
    often = reports.filter("token IS NOT NULL").groupBy("token").agg(F.sum("count").alias("k")).filter(F.col("k") > COMMON * chunks).collect()
    common = np.array([r["token"] for r in often], dtype=np.int64).view(np.uint64)
    order = np.argsort(common)
    counts = np.array([r["k"] + ABOVE for r in often], dtype=np.uint64)[order]
    ranges = 1 << max(LEAST_RANGES, -(-total // RANGE_TOKENS)).bit_length()
    counted = frequencies(docs, text, width, common[order], counts, ranges)
    sets = stored(shared_tokens(counted, percent), "jaccard-shared")

    index = _entries(sets)
    links = stored(verified(pivot_pairs(index, percent), sets, percent), "jaccard-links")
    classes = components(links)
    more = stored(verified(class_pairs(index, classes, percent), sets, percent), "jaccard-links")
    if not more.isEmpty():
        classes = components(links.union(more))

    points = members.filter("n > 0").groupBy("sid").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("k"))
    roots = classes.union(classes.select(F.col("root").alias("node"), "root").distinct())
    named = points.join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    named = stored(named, "jaccard-named")
    ids = stored(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("sets")), "jaccard-ids")
    owned = stored(shared_join(named, ids, ["root"], "sets", ["sid"]).select("sid", "k", "component_id"), "jaccard-classes")
    out = shared_join(members, owned, ["sid"], "k", ["doc_id"])
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


@query("op13_ngram_jaccard")
def jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(document_table(spark, sf_dir))
