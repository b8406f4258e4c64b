"""URL rules by a sort-merge range join.

A host is written backwards, label by label (``www.example.com`` is ``com/example/www/``), so a rule's host and all its
subdomains are one interval of keys, and intervals of rules nest or are apart. URLs and rules are sorted by key together;
a sweep keeps the stack of rules whose interval is open, and the deepest host with a fitting path decides, longest path
first. Ranges of the sorted keys are dealt to tasks: cut points come from a sample of the keys and only steer balance, a
key that many URLs share is cut by a hash of the row, and a rule goes to every range that its interval touches.

Defined results. A null url, or one without ``://``, has empty host and path and no rule. No rule: the verdict is
``DEFAULT``. Of rules with equal host and path, block wins. Repeated rows each get their row; empty tables give empty
results, and without rules all get the default. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table, stored
from trajspark.llm.registry import query

#: (verdict, host, path) of the query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
DEFAULT = "allow"
#: Key ranges, at most, sampled keys per range, and characters of a key that a cut point keeps.
RANGES = 2048
SAMPLES = 32
CUT_CHARS = 200
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(pages: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, key and a hash that tells rows of one key apart."""
    u = F.coalesce(F.col(url), F.lit(""))
    host = F.translate(F.regexp_extract(u, r"://([^/?#]*)", 1), UPPER, LOWER)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), F.regexp_extract(u, r"://[^/?#]*([^?#]*)", 1).alias("path"))
    key = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "/"), F.lit("/"))
    return rows.withColumn("key", key).withColumn("tie", F.xxhash64("page_id", "path"))


def _cut_points(rows: DataFrame, ranges: int) -> list[tuple[str, int]]:
    """At most ``ranges`` - 1 cut points, from about SAMPLES keys per range picked by hash."""
    every = max(1, rows.count() // (ranges * SAMPLES))
    drawn = rows.filter(F.pmod(F.xxhash64("tie"), F.lit(every)) == 0).select(F.substring("key", 1, CUT_CHARS).alias("key"), "tie")
    got = sorted((r["key"], r["tie"]) for r in drawn.limit(2 * ranges * SAMPLES).collect())
    step = max(1, len(got) // ranges)
    return got[step::step][: ranges - 1]


def _ranges_of(cuts: list[tuple[str, int]]):
    """Number of the range of each URL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ties = batch.column("key").to_pylist(), batch.column("tie").to_pylist()
            at = [bisect_right(cuts, kt) for kt in zip(keys, ties, strict=True)]
            n = len(at)
            nothing = pa.nulls(n, pa.string())
            columns = [pa.array(at, pa.int64()), batch.column("key"), pa.array([1] * n, pa.int32()), batch.column("page_id"), batch.column("host"), batch.column("path"), nothing]
            yield pa.RecordBatch.from_arrays(columns, ["range", "key", "kind", "page_id", "host", "path", "verdict"])

    return run


def _ranges_touched(cuts: list[tuple[str, int]], id_type: pa.DataType):
    """Each rule in all ranges that its interval touches."""
    least = -(1 << 63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, path, verdict in zip(*(batch.column(c).to_pylist() for c in ("host", "path", "verdict")), strict=True):
                key = "/".join(reversed(host.split("."))) + "/"
                first = bisect_right(cuts, (key, least))
                last = bisect_right(cuts, (key[:-1] + "0", least))  # "0" follows "/"
                for at in range(first, last + 1, 1000):
                    span = range(at, min(at + 1000, last + 1))
                    n = len(span)
                    columns = [pa.array(span, pa.int64()), pa.array([key] * n), pa.array([0] * n, pa.int32()), pa.nulls(n, id_type), pa.array([host] * n), pa.array([path] * n), pa.array([verdict] * n)]
                    yield pa.RecordBatch.from_arrays(columns, ["range", "key", "kind", "page_id", "host", "path", "verdict"])

    return run


class _Host:
    """Rules of one host: verdict by path, and the lengths of their paths, longest first."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.paths, self.sizes = key, host, {}, []

    def add(self, path: str, verdict: str) -> None:
        if self.paths.get(path) != "block":
            self.paths[path] = verdict
        if len(path) not in self.sizes:
            self.sizes = sorted({*self.sizes, len(path)}, reverse=True)

    def rule(self, path: str) -> str | None:
        return next((path[:n] for n in self.sizes if n <= len(path) and path[:n] in self.paths), None)


def _sweep(default: str):
    """Rows come sorted by range, key and kind (rules first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, stack = None, []
        for batch in batches:
            out: list[tuple] = []
            for at, key, kind, page_id, host, path, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != here:
                    here, stack = at, []
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Host(key, host))
                    stack[-1].add(path, verdict)
                    continue
                for open_host in reversed(stack):
                    rule = open_host.rule(path)
                    if rule is not None:
                        out.append((page_id, host, path, open_host.host + rule, open_host.paths[rule]))
                        break
                else:
                    out.append((page_id, host, path, None, default))
            if out:
                types = [batch.schema.field("page_id").type] + [pa.string()] * 4
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    return run


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``rules`` has host, path and verdict (allow or block)."""
    spark = pages.sparkSession
    rows = stored(parsed(pages, id_col, url), "url-keys")
    cuts = _cut_points(rows, min(RANGES, 2 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
    kind = pages.schema[id_col].dataType.simpleString()
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    schema = f"range long, key string, kind int, page_id {kind}, host string, path string, verdict string"
    dealt = arrow_map(rows.select("key", "tie", "page_id", "host", "path"), _ranges_of(cuts), schema)
    lower = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").filter("host is not null and path is not null")
    both = dealt.union(lower.mapInArrow(_ranges_touched(cuts, id_type), schema))
    swept = both.repartition("range").sortWithinPartitions("range", "key", "kind")
    return swept.mapInArrow(_sweep(default), f"page_id {kind}, host string, path string, rule string, verdict string")


SQL = r"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
m AS (SELECT *, row_number() OVER () AS id FROM u),
f AS (
  SELECT id, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY id ORDER BY length(h) DESC, length(p) DESC) AS k
  FROM m JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM m LEFT JOIN (SELECT * FROM f WHERE k = 1) AS b USING (id)
"""


@query("op7_url_rules", SQL)
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return judge(document_table(spark, sf_dir, "pages"), rules)
