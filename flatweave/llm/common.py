"""Helpers that several operators share: stored intermediates, scalable running sums, links."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flatweave.session import shared_folder, table_prefix

#: Rows that one task orders at a time where rows are numbered within groups.
ROWS_PER_BUCKET = 4096


#: Bytes of rows after which a batch of texts goes to a Python worker, and the setting for it.
BATCH_BYTES = 2 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """Write to the cluster's shared folder and read back; cuts lineage and survives lost executors."""
    spark, path = frame.sparkSession, None
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is planned and stored meanwhile hands texts to Python workers some MB at a time.

    By default a batch is 10,000 rows of any size, often a whole task's texts, which the executor
    holds outside its heap and the worker once more.
    """
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme that Spark would read it by, so that workers read the same place."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system.makeQualified(place).toString()


def shards_for(texts: DataFrame, text: Column, share: float, shard_bytes: int) -> int:
    """Parts for a share of the texts' bytes, none above shard_bytes; as many as Spark shuffles to at least."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               -(-int(size * share) // shard_bytes))


def bucketed(frame: DataFrame, key: str, buckets: int) -> DataFrame:
    """Write to the shared folder in buckets of one key and read back.

    Joins and groups by the key shuffle only the other side. The table has a name of its own in
    the session's catalog.
    """
    spark, path = frame.sparkSession, shared_folder(frame.sparkSession)
    name = table_prefix(spark) + uuid.uuid4().hex
    frame.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def column(frame: DataFrame, name: str) -> Column:
    """A column by its exact name, also if the name holds dots or backticks."""
    return frame["`" + name.replace("`", "``") + "`"]


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo something; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that no other column has, in any case."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def running_totals(rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str],
                   weight: str, out: str) -> DataFrame:
    """Exact sums of weight over the rows before each row of its group.

    Rows are ordered by (bucket, order); bucket must not fall as the order rises. Each task
    orders one bucket of one group only; buckets are summed first and their running sums,
    one row per bucket, joined back by the partitioning that the order has made. So a group may be
    of any size. Group and bucket must not be null.
    """
    sums = rows.groupBy(*group, bucket).agg(F.sum(weight).alias("_sum"))
    ahead = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = (sums.withColumn("_start", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
              .drop("_sum"))
    inside = (Window.partitionBy(*group, bucket).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = rows.withColumn("_inside", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    return (local.join(starts, [*group, bucket])
            .withColumn(out, F.col("_start") + F.col("_inside")).drop("_start", "_inside"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): for every id in the links (a, b), the smallest id reachable.

    Alternating star contraction: every round hangs each neighbour on the smallest one, first
    the larger neighbours, then the smaller ones, until only stars are left. A row per link and
    round; aggregation by node combines before the shuffle, so a node with very many links is no
    hot task.
    """
    links = stored(links.where("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct())
    for _ in range(rounds):
        if _settled(links):
            break
        large = _stars(links.unionByName(links.select(F.col("b").alias("a"),
                                                      F.col("a").alias("b"))), larger=True)
        links = stored(_stars(large, larger=False))
    else:
        raise RuntimeError(f"links were not contracted in {rounds} rounds")
    return (links.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")))
            .groupBy("id").agg(F.min("component").alias("component")))


def _settled(links: DataFrame) -> bool:
    """Whether links (a, b), all with a > b, are stars: one b for every a, and no b that is an a."""
    ends = (links.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(links.select(F.col("b").alias("id"), F.lit(0).alias("up"),
                                      F.lit(1).alias("down")))
            .groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """One star step over (a, b): neighbours b of a move to the least of a and its neighbours."""
    least = links.groupBy("a").agg(F.min("b").alias("_least")).withColumn(
        "_least", F.least("a", "_least"))
    joined = links.join(least, "a")
    if larger:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        moved = joined.select("b", "_least").where("b <> _least").select(
            F.col("b").alias("a"), F.col("_least").alias("b"))
        moved = moved.unionByName(least.where("a <> _least").select(
            "a", F.col("_least").alias("b")))
    return moved.where("a <> b").distinct()


def strings(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
