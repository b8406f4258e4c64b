"""Quality rules by host, in DataFrame functions only.

Every document is held against the rules; failures are summed per host, the failure rate of a host is shrunk towards the
corpus by a beta prior fitted to all hosts, and a host whose shrunk rate passes a limit loses all its documents.

Defined results. Null text has no words. A null host is one host of its own. Repeated rows count as often as they occur.
An empty table gives an empty result. Other columns, also ones named like those made here, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import SPACE, document_table, shared_join, stored
from trajspark.llm.registry import query

#: A host falls when the shrunk share of its documents that break a rule is above this.
HOST_LIMIT = 0.8
#: The prior weighs between this many documents at least and at most.
PRIOR_WEIGHT = (2.0, 1000.0)
#: Rejected hosts are broadcast up to this many rows, and joined by shuffle beyond.
BROADCAST_HOSTS = 10_000
MIN_WORDS = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _with_repeat_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Add the number of words inside 3-word windows that occur twice or more in their text.

    Windows are packed as (leading bits of their hash, position) and sorted as plain longs; a window whose leading bits
    have an equal neighbour is a candidate. Candidates alone are sorted again by their whole hash, those with an equal
    neighbour are marked, and each marked window adds the words up to the next marked one, three at most.
    """
    n = F.size(words)

    def window_hash(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    bits = F.when(n < 1 << 24, F.lit(24)).otherwise(F.lit(31))
    df = df.withColumn("_bits", bits)

    def lead(x: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, F.col("_bits"))

    def packed(i: Column) -> Column:
        return F.call_function("shiftleft", lead(window_hash(i)), F.col("_bits")).bitwiseOR(i.cast("long"))

    places = F.sequence(F.lit(0), n - 3)
    df = df.withColumn("_sorted", F.when(n >= 3, F.sort_array(F.transform(places, packed))))
    near = F.filter(
        "_sorted", lambda x, i: (lead(x) == lead(F.get("_sorted", i + 1))) | (lead(x) == lead(F.get("_sorted", i - 1)))
    )
    position = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1
    found = F.transform(near, lambda x: x.bitwiseAND(position).cast("int"))
    order = F.array_sort(F.transform(found, lambda i: F.struct(window_hash(i).alias("h"), i.alias("i"))))
    df = df.withColumn("_order", order)
    same = F.filter(
        "_order", lambda x, k: (x["h"] == F.get("_order", k + 1)["h"]) | (x["h"] == F.get("_order", k - 1)["h"])
    )
    df = df.withColumn("_at", F.sort_array(F.transform(same, lambda x: x["i"])))
    steps = F.transform("_at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_at", k + 1) - p, F.lit(3))))
    total = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    return df.withColumn(name, F.coalesce(total, F.lit(0)).cast("long")).drop("_bits", "_sorted", "_order", "_at")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of ``COUNTS`` (long) under one struct column ``_q``."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    df = df.withColumn("_words", F.array_remove(F.split(body, SPACE), "")).withColumn("_lines", lines)
    df = _with_repeat_words(df, "_words", "_repeated")
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.col("_repeated"),
    }
    out = df.withColumn("_q", F.struct(*[v.cast("long").alias(k) for k, v in counts.items()]))
    return out.drop("_words", "_lines", "_repeated")


def base_failed(q: str = "_q") -> Column:
    n = F.col(f"{q}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{q}.n_repeat_words") > 50 * n)


def host_verdicts(failures: DataFrame) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and ``host_ok``; ``failures`` has ``host`` and ``failed``.

    The prior is fitted by moments: its mean is the pooled rate, its weight follows from how much the rates of the hosts
    differ beyond what chance alone gives.
    """
    hosts = failures.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("failed").cast("long")).alias("f"))
    hosts = stored(hosts, "hosts")
    n, f = F.sum("n"), F.sum("f")
    moments = hosts.agg(
        (f / n).alias("m"),
        (F.sum(F.col("f") * F.col("f") / F.col("n")) / n).alias("square"),
        (F.count(F.lit(1)) / n).alias("noise"),
    ).first()
    mean = moments["m"] or 0.0
    spread = (moments["square"] or 0.0) - mean * mean - mean * (1 - mean) * (moments["noise"] or 0.0)
    weight = mean * (1 - mean) / spread - 1 if spread > 0 else PRIOR_WEIGHT[1]
    weight = min(max(weight, PRIOR_WEIGHT[0]), PRIOR_WEIGHT[1])
    rate = (F.col("f") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.withColumn("host_rate", rate).withColumn("host_ok", rate <= HOST_LIMIT)


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text", host: Column | None = None) -> DataFrame:
    """One row per document: id, counts, ``base_failed``, ``host``, ``host_rate``, ``kept``."""
    host = F.col("source") if host is None else host
    counted = with_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"), host.alias("host")))
    counted = counted.withColumn("failed", base_failed()).select("doc_id", "host", "_q", "failed")
    counted = stored(counted, "quality")
    verdicts = host_verdicts(counted)
    # A null host needs a key of its own in an equi-join.
    key = F.concat_ws("", F.when(F.col("host").isNull(), F.lit("0")).otherwise(F.lit("1")), "host")
    verdicts = verdicts.select(key.alias("_host"), F.col("n").alias("_n"), "host_rate", "host_ok")
    joined = shared_join(counted.withColumn("_host", key), verdicts, ["_host"], "_n", ["doc_id", "_q"])
    out = joined.withColumn("kept", ~F.col("failed") & F.col("host_ok"))
    return out.select("doc_id", *[F.col(f"_q.{c}").alias(c) for c in COUNTS], F.col("failed").alias("base_failed"), "host", "host_rate", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns. Texts are not shuffled unless very many hosts fall."""
    host = F.col("source")
    counted = with_counts(docs.select("text", host.alias("host"))).select("host", base_failed().alias("failed"))
    key = F.concat_ws("", F.when(F.col("host").isNull(), F.lit("0")).otherwise(F.lit("1")), "host")
    bad = host_verdicts(counted).filter(~F.col("host_ok")).select(key.alias("_host"))
    own = [f"_in{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*own)
    names = dict(zip(docs.columns, own, strict=True))
    # The row number is always true here. It keeps the optimizer from writing out the counts inside a pushed-down filter,
    # where every column they are built from would be repeated at each use.
    numbered = with_counts(renamed, names["text"]).withColumn("_row", F.monotonically_increasing_id())
    good = numbered.filter(~base_failed() & (F.col("_row") >= 0)).drop("_q", "_row")
    found = bad.limit(BROADCAST_HOSTS + 1).count()
    if found:
        side = F.col(names["source"])
        good = good.withColumn("_host", F.concat_ws("", F.when(side.isNull(), F.lit("0")).otherwise(F.lit("1")), side))
        good = good.join(F.broadcast(bad) if found <= BROADCAST_HOSTS else bad, "_host", "left_anti").drop("_host")
    return good.select(*[F.col(o).alias(c) for c, o in names.items()])


SQL = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM base),
g AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
g2 AS (SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS k FROM g),
g3 AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g2) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + d) AS n FROM g3, (VALUES (0), (1), (2)) AS o(d) GROUP BY r),
ln AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM base),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
q AS (
  SELECT w.r, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM j GROUP BY source),
m AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS sq, count(*) / sum(n) AS noise FROM h),
p AS (SELECT m, CASE WHEN sq - m * m - m * (1 - m) * noise > 0
        THEN least(greatest(m * (1 - m) / (sq - m * m - m * (1 - m) * noise) - 1, 2.0), 1000.0) ELSE 1000.0 END AS k FROM m),
v AS (SELECT source, (f + m * k) / (n + k) <= 0.8 AS ok FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source
"""


@query("op10_quality_hosts", SQL)
def quality_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(document_table(spark, sf_dir)).drop("host", "host_rate")
