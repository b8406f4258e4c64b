"""Small helpers the operators of this subpackage share: word patterns, shared files, joins with hot keys, Arrow tasks."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: A key is hot above this fraction of all rows, so there are fewer than this many hot keys whatever the data.
HOT_PARTS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Only a local session without one gets a folder of its own."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="trajspark-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here, and lost executors take nothing along."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def document_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def shared_join(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], count: str, spread: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join of ``rows`` to one row per key, whatever share of the rows a key holds.

    ``groups`` has the number of rows of each key in ``count``. Keys above 1/1000 of all rows are fewer than 1000, so
    they are broadcast; their rows then travel under a salt made of ``spread`` and meet nobody in the ordinary join. Keys
    must not be null. ``how`` is left or inner. ``count`` is not part of the result unless it is named twice.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_PARTS > total
    values = [x for x in groups.columns if x not in keys]
    hot = groups.filter(is_hot).select(*keys, F.struct(*values).alias("_hot"))
    cold = groups.filter(~is_hot).select(*keys, F.struct(*values).alias("_cold"), F.lit(-1).cast("long").alias("_salt"))
    salt = F.when(F.col("_hot").isNull(), F.lit(-1)).otherwise(F.pmod(F.xxhash64(*spread), F.lit(1 << 30)))
    salted = rows.join(F.broadcast(hot), list(keys), "left").withColumn("_salt", salt.cast("long"))
    joined = salted.join(cold, [*keys, "_salt"], "left").withColumn("_got", F.coalesce("_hot", "_cold"))
    if how == "inner":
        joined = joined.filter(F.col("_got").isNotNull())
    return joined.select(*rows.columns, *[F.col(f"_got.{v}").alias(v) for v in values])


def numbered(df: DataFrame, name: str, bucket: Column, order: Sequence[Column], keys: Sequence[str] = ()) -> DataFrame:
    """Gapless 0-based numbers within ``keys``, in order of (bucket, order); no task sorts more than one bucket."""
    from pyspark.sql import Window

    rows = df.withColumn("_bucket", bucket)
    counts = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    placed = rows.withColumn("_at", F.row_number().over(inside) - 1).join(offsets, [*keys, "_bucket"])
    return placed.withColumn(name, (F.col("_from") + F.col("_at")).cast("long")).drop("_bucket", "_from", "_at")


def buckets_for(rows: int, least: int = 1000) -> int:
    """Buckets of ``least`` rows, or of as many rows as there are buckets where that is more."""
    return max(1, -(-rows // max(least, math.isqrt(rows))))


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches small enough for long texts: a batch is cut by rows here, by bytes where Spark can."""
    spark = df.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > 2000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df.mapInArrow(fn, schema)
