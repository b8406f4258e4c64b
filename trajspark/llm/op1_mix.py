"""Mixing sources to target weights.

Each document gets a random key (the MD5 of its id). Within a source, documents are ordered by key in ranges of the key
space, and a distributed prefix sum of their sizes (per range, then over ranges) places every document on a line. A
source's budget is cut from that line, going round as often as the budget asks for: whole epochs first, then the documents
up to the cut, of which the last gives just the words that are still missing.

Targets are shares of all words by weight, none above ``MAX_EPOCHS`` times its source; what is over is dealt again by weight.

Defined results. A null text has size 0. A null source is a source of its own, last in order. Sizes of 0 are never taken.
Rows with equal id and size are tied and order does not matter; null ids come first. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajspark.llm.common import SPACE, WORD, document_table, shared_join, stored
from trajspark.llm.registry import query

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Documents per range of the key space: this many, or the square root of a source's where that is more.
RANGE_ROWS = 1000


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: str) -> Column:
    """Code point order with null last, never null itself."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source).cast("string")))


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source (``_source``, ``source_size``).

    With sources sorted by how soon their cap binds (cap / weight), the shares of the uncapped ones after the first k
    follow from two prefix sums, and the first k whose share stays below its own cap is the answer. All of this is over
    one row per source; ranks and prefix sums are windows over that table alone.
    """
    order = Window.orderBy("_source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank"), F.lit(len(weights))) + 1).cast("int"))
    ranked = sources.withColumn("_rank", F.row_number().over(order) - 1).withColumn("_w", weight)
    ranked = ranked.withColumn("_cap", F.col("source_size") * F.lit(max_epochs))
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = ranked.withColumns({
        "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
        "_weights": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)),
    })
    level = F.col("_left") / F.col("_weights")
    filled = filled.withColumn("_level", F.when(level * F.col("_w") <= F.col("_cap"), level))
    filled = filled.withColumn("_level", F.first("_level", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("_level").isNull(), F.col("_cap").cast("double")).otherwise(F.col("_level") * F.col("_w"))
    return filled.select("_source", "source_size", target.alias("target"), *[c for c in sources.columns if c not in ("_source", "source_size")])


def mix(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    sized = docs.select(F.col(id_col).alias("doc_id"), n_words(text).alias("size"), _source_key(source).alias("_source"))
    sized = stored(sized.withColumn("_key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), "mix-sizes")
    sources = sized.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_docs"))
    planned = stored(targets(stored(sources, "mix-sources"), weights, max_epochs), "mix-targets")
    ranges = F.ceil(F.col("_docs") / F.greatest(F.lit(RANGE_ROWS), F.sqrt("_docs"))).cast("long")
    joined = shared_join(sized, planned.withColumn("_ranges", ranges).withColumn("_n", F.col("_docs")), ["_source"], "_n", ["doc_id"])
    at = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    rows = joined.withColumn("_range", F.floor(at * F.col("_ranges") / F.lit(float(1 << 32))).cast("long"))
    rows = stored(rows.drop("_n", "_ranges", "_docs"), "mix-ranges")

    sums = rows.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_from", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inside = Window.partitionBy("_source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_before", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(sums, ["_source", "_range"])

    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    part = F.least(F.greatest(rest - F.col("_from") - F.col("_before"), F.lit(0)), F.col("size"))
    return placed.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space as it is."""
    words = F.slice(F.array_remove(F.split(text, SPACE), ""), 1, n.cast("int"))
    gaps = F.slice(F.split(text, WORD), 1, n.cast("int"))
    return F.substring(text, F.lit(1), F.length(F.array_join(words, "")) + F.length(F.array_join(gaps, "")))


def repeat(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed corpus: each document as often as it is taken, the one at a source's cut with its first words only.

    Ids are taken to be unique; rows that share one share what is taken of it. Rows without id are taken as they are.
    """
    taken = mix(docs, id_col, text, source).filter("doc_id is not null").groupBy("doc_id").agg(F.max("size").alias("_size"), F.max("taken").alias("_taken"))
    own = [f"_in{i}" for i in range(len(docs.columns))]
    names = dict(zip(docs.columns, own, strict=True))
    rows = docs.toDF(*own).join(taken.withColumnRenamed("doc_id", "_id"), F.col(names[id_col]) == F.col("_id"), "left")
    whole = F.when(F.col("_size") > 0, F.floor(F.col("_taken") / F.col("_size"))).otherwise(F.lit(0)).cast("int")
    more = F.when(F.col("_size") > 0, F.col("_taken") % F.col("_size")).otherwise(F.lit(0))
    copies = F.array_repeat(F.lit(-1).cast("long"), whole)
    copies = F.concat(copies, F.when(more > 0, F.array(more)).otherwise(F.array().cast("array<bigint>")))
    copies = F.when(F.col("_id").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(copies)
    rows = rows.withColumn("_words", F.explode(copies))
    body = F.col(names[text])
    cut = F.when(F.col("_words") < 0, body).otherwise(first_words(body, F.col("_words")))
    return rows.select(*[(cut if c == text else F.col(o)).alias(c) for c, o in names.items()])


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS z, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM d GROUP BY source),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
c AS (SELECT *, row_number() OVER (ORDER BY 3 * z / w, r) AS o, sum(z) OVER () AS total, sum(w) OVER () AS weights FROM w),
b AS (
  SELECT *, total - coalesce(sum(3 * z) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         weights - coalesce(sum(w) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rw FROM c),
l AS (SELECT arg_min(rest / rw, o) AS level, min(o) AS o FROM b WHERE rest / rw * w <= 3 * z),
t AS (
  SELECT source, z AS source_size, CASE WHEN b.o < l.o OR l.o IS NULL THEN (3 * z)::DOUBLE ELSE l.level * w END AS target
  FROM b, l),
p AS (
  SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE
         budget // source_size * size + least(greatest(budget % source_size - before, 0), size) END::BIGINT AS taken
FROM p
"""


@query("op1_mix_sources", SQL)
def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(document_table(spark, sf_dir))
