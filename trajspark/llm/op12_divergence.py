"""Source divergence audit: how far the word use of each source lies from the others and from its language.

One translate table lowers A-Z and blanks every separator in a single pass over a document's bytes; ``bytes.split`` and a
Counter per document give its frequencies. Counters of one (lang, source) group are added up inside a task, so a group that
holds a third of all rows leaves a task as one row per term. A language keeps the terms of at least ``min_docs`` documents.

A group's share of a term is p = 1 + floor(10^9 (count + 5) / (N + 5 V)) over the V kept terms of its language. Distances of
two sources sum |p - q| over all V terms. Terms that neither source has all differ by the same amount, so tasks work on
the sparse counts of a slice of terms and of two tiles of sources, and the rest is added as one product.

Defined results. Null text, lang and source count as ''. A group without terms has count 0 everywhere; a language without
kept terms has pairs of value 0 and no term rows. Repeated rows count each. Empty tables give empty results. Columns other
than the three are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table, stored
from trajspark.llm.registry import query

MIN_DOCS = 30
TOP_TERMS = 50
#: Share of a term in billionths, with this many occurrences added to each term.
SCALE = 1_000_000_000
PRIOR = 5
#: Letters of ASCII lower-cased, other ASCII to a blank, bytes of other characters as they are.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: A task gives its sums away when it holds this many terms.
HELD = 500_000
#: Terms in a slice, and sources in a tile: a task compares two tiles over one slice.
SLICE = 4096
TILE = 128


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Per (lang, source, term) occurrences ``n`` and documents ``d``, dealt by (lang, term): one shuffle of the tasks' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[dict, dict]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (of, src), (total, within) in groups.items():
                terms = list(total)
                columns = [
                    pa.array([of] * len(terms), pa.string()),
                    pa.array([src] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array(total.values(), pa.int64()),
                    pa.array(map(within.__getitem__, total), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "d"])
            groups.clear()

        for batch in batches:
            for value, of, src in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                total, within = groups.setdefault((of or "", src or ""), ({}, {}))
                before = len(total)
                for term, n in Counter((value or "").encode("utf-8", "surrogatepass").translate(TABLE).split()).items():
                    total[term] = total.get(term, 0) + n
                    within[term] = within.get(term, 0) + 1
                held += len(total) - before
                if held >= HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    parts = arrow_map(rows, run, "lang string, source string, term string, n long, d long").repartition("lang", "term")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """p in billionths, by whole-number division of decimals, so that no count is too large; 0 where nothing is kept."""
    part = F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(20,0)")
    whole = (total + F.lit(PRIOR) * kept).cast("decimal(20,0)")
    return F.when(kept > 0, F.call_function("div", part, whole) + F.lit(1)).otherwise(F.lit(0)).cast("long")


def _compare(table: pa.Table) -> pa.Table:
    """Sums of |p - q| over the terms of one slice that any source of two tiles has, for all pairs of these sources.

    Rows without a term name a source, with the share of the terms it lacks.
    """
    at = table.column("at").to_numpy()
    tile, share_ = table.column("tile").to_numpy(), table.column("p").to_numpy()
    terms = table.column("term").combine_chunks().dictionary_encode()
    mark = terms.indices.is_null().to_numpy(zero_copy_only=False)
    order = np.flatnonzero(mark)[np.argsort(at[mark])]
    numbers, zero, home = at[order], share_[order], tile[order]
    names = table.column("source").take(pa.array(order)).to_pylist()
    row = np.searchsorted(numbers, at[~mark])
    code = terms.indices.drop_null().to_numpy()
    shares = np.repeat(zero[:, None], len(terms.dictionary), axis=1)
    shares[row, code] = share_[~mark]
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    columns: list[list] = [[], [], [], []]
    for a in np.flatnonzero(home == lo):
        others = np.flatnonzero((home == hi) & (numbers != numbers[a]))
        far = np.abs(shares[others] - shares[a]).sum(axis=1)
        gap = np.abs(zero[others] - zero[a])
        for b, value, each in zip(others.tolist(), far.tolist(), gap.tolist(), strict=True):
            for source, item in ((a, b), (b, a)) if lo != hi else ((a, b),):
                for column, x in zip(columns, (names[source], names[item], value, each), strict=True):
                    column.append(x)
    n = len(columns[0])
    texts, longs = pa.string(), pa.int64()
    of, kept = table.column("lang")[0].as_py(), table.column("kept")[0].as_py()
    arrays = [pa.array([of] * n, texts), pa.array(columns[0], texts), pa.array(columns[1], texts), pa.array(columns[2], longs)]
    arrays += [pa.array(columns[3], longs), pa.array([shares.shape[1]] * n, longs), pa.array([kept] * n, longs)]
    return pa.table(arrays, names=["lang", "source", "item", "value", "gap", "seen", "kept"])


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return df.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    in_term = Window.partitionBy("lang", "term")  # a row per source
    counts = term_counts(docs, text, lang, source).withColumns({"docs": F.sum("d").over(in_term), "lang_n": F.sum("n").over(in_term)})
    cells = stored(counts.filter(F.col("docs") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "divergence-cells")

    sizes = cells.select("lang", "term", "lang_n").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    found = docs.select(*[F.coalesce(F.col(x), F.lit("")).alias(y) for x, y in ((lang, "lang"), (source, "source"))]).distinct()
    groups = found.join(totals, ["lang", "source"], "left").join(sizes, ["lang"], "left")
    groups = groups.fillna(0, ["total", "kept", "lang_total"])
    in_lang = Window.partitionBy("lang")
    groups = groups.withColumns(
        {
            "zero": share(F.lit(0), F.col("total"), F.col("kept")),
            "at": F.row_number().over(in_lang.orderBy("source")).cast("long") - 1,
            "tiles": F.ceil(F.count(F.lit(1)).over(in_lang) / TILE),
            "slices": F.greatest(F.lit(1), F.ceil(F.col("kept") / SLICE)),
        }
    ).withColumn("tile", F.floor(F.col("at") / TILE))
    groups = stored(groups, "divergence-groups")

    named = cells.join(groups, ["lang", "source"])
    named = named.withColumns({"p": share(F.col("n"), F.col("total"), F.col("kept")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))})
    top_terms = named.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    columns = ["lang", "slice", "tile", "tiles", "at", "source", "term", "p", "kept"]
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    marks = groups.select("*", slices.alias("slice"), F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"))
    terms = named.withColumns({"slice": F.pmod(F.xxhash64("term"), F.col("slices")), "source": F.lit(None).cast("string")})
    # Every row meets every tile of sources of its language, in either order.
    rows = terms.select(columns).union(marks.select(columns)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.withColumns({"lo": F.least("tile", "other"), "hi": F.greatest("tile", "other")}).drop("other", "tiles")
    parts = rows.groupBy("lang", "slice", "lo", "hi").applyInArrow(
        _compare, "lang string, source string, item string, value long, gap long, seen long, kept long"
    )
    pairs = parts.groupBy("lang", "source", "item").agg(*[F.sum(x).alias(x) for x in ("value", "seen")], *[F.max(x).alias(x) for x in ("gap", "kept")])
    pairs = pairs.withColumn("value", F.col("value") + (F.col("kept") - F.col("seen")) * F.col("gap"))
    return _ranked(pairs, "pair").union(_ranked(top_terms, "term").filter(F.col("rank") <= top))


SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
per_doc AS (
  SELECT lang, source, id, term, count(*) AS n
  FROM (SELECT lang, source, row_number() OVER () AS id, words FROM docs), unnest(words) AS u(term)
  GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS lang_n FROM per_doc GROUP BY lang, term HAVING count(*) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, sum(n) AS n FROM per_doc JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * s.v) AS BIGINT) AS p,
    CAST(1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (s.lang_total + 5 * s.v) AS BIGINT) AS q
  FROM grp g JOIN kept k USING (lang) JOIN sizes s USING (lang) LEFT JOIN totals t USING (lang, source)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT lang, source, 'pair' AS part, item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) FROM terms)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query("op12_source_divergence", SQL)
def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(document_table(spark, sf_dir))
