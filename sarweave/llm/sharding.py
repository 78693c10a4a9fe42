"""Two-pass external shuffle of documents into shards.

Pass one sums the text bytes and fixes the number of buckets by them alone, so that a bucket fits in a
task's memory, and counts the rows that a seeded hash sends to each. Pass two scatters the rows into
the buckets, a partition for each, and orders each by a seeded Fisher-Yates permutation. The buckets laid end to end
are one uniformly shuffled sequence; it is dealt to the shards in turn, so that shard sizes
differ by one row at most. The result depends on the rows, the seed and bucket_bytes only: not on
the order or the partitions of the input, nor on Spark's settings.

A row is known by a 128-bit hash of all its columns and, where rows are equal in all of them, by its number among
the equals, so that one row repeated without end is scattered too. Nulls count as values: a null doc_id or text is
hashed like any other, a null text has no bytes. An empty table gives no rows. Columns of the input
named like the added ones (shard, slot) are replaced; all others are kept. Columns with maps are hashed as JSON.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sarweave.session import materialize, text_batches

#: Most text bytes a bucket should hold.
BUCKET_BYTES = 32 << 20
#: Most partitions of the scatter; with more buckets each takes several neighbours, one after the other.
PARTITIONS = 100_000


def row_hash(docs: DataFrame, seed: int) -> Column:
    """A hash of all columns; a null differs from any value."""
    parts = []
    for f in docs.schema.fields:
        c = F.col(f"`{f.name}`")
        parts += [F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c, c.isNull()]
    return F.xxhash64(F.lit(seed), *parts)


def numbered(docs: DataFrame, seed: int) -> DataFrame:
    """docs with __sw_k1 and __sw_k2, hashes of the row and of its number among equal rows.

    Only rows that occur more than once are brought together for that: as one row with a count, which Spark sums
    on both sides of the shuffle.
    """
    keyed = docs.withColumns({"__sw_k1": row_hash(docs, seed), "__sw_k2": row_hash(docs, seed + 1)})
    keys = ["__sw_k1", "__sw_k2"]
    again = keyed.groupBy(*keys).count().where("count > 1").select(*keys)
    again = materialize(again, "repeated-rows")
    if again.isEmpty():
        return keyed
    once = keyed.join(again, keys, "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    many = keyed.join(again, keys, "left_semi").groupBy(*keys).agg(F.first(F.struct(*columns)).alias("__sw_row"), F.count("*").alias("__sw_n"))
    many = many.select(*keys, "__sw_row", F.explode(F.sequence(F.lit(1).cast("long"), "__sw_n")).alias("__sw_i"))
    number = lambda k: F.when(F.col("__sw_i") > 1, F.xxhash64(k, "__sw_i")).otherwise(F.col(k)).alias(k)
    return once.unionByName(many.select("__sw_row.*", *map(number, keys)))


def shuffle_into_shards(docs: DataFrame, n_shards: int = 8, seed: int = 17, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """docs with shard (0 .. n_shards - 1) and slot (gapless from 0 within the shard).

    Broadcast: one count for each bucket, 8 bytes per bucket_bytes of text.
    """
    spark = docs.sparkSession
    text_batches(spark)
    docs = docs.drop("shard", "slot")
    total = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    n_buckets = max(1, -(-total // bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), "__sw_k1"), F.lit(n_buckets)).cast("int")
    scattered = numbered(docs, seed).withColumn("__sw_bucket", bucket)
    n_parts = min(n_buckets, PARTITIONS)
    part = F.expr(f"int(bigint(__sw_bucket) * {n_parts} div {n_buckets})")
    counts = np.zeros(n_buckets, np.int64)
    for b, n in scattered.groupBy("__sw_bucket").count().toLocalIterator():
        counts[b] = n
    begins = spark.sparkContext.broadcast(np.concatenate(([0], np.cumsum(counts)[:-1])))
    schema = T.StructType([*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])

    def ordered(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = int(key[1].as_py())
        order = np.array(pc.sort_indices(rows, [("__sw_k1", "ascending"), ("__sw_k2", "ascending")]))
        rng = np.random.Generator(np.random.PCG64([seed, bucket]))
        for i in range(len(order) - 1, 0, -1):
            j = int(rng.integers(0, i + 1))
            order[i], order[j] = order[j], order[i]
        at = begins.value[bucket] + np.arange(len(order))
        out = rows.drop_columns(["__sw_k1", "__sw_k2", "__sw_bucket", "__sw_part"]).take(pa.array(order))
        return out.append_column("shard", pa.array((at % n_shards).astype(np.int32))).append_column("slot", pa.array(at // n_shards))

    dealt = scattered.withColumn("__sw_part", part).repartitionById(n_parts, "__sw_part")
    return dealt.groupBy("__sw_part", "__sw_bucket").applyInArrow(ordered, schema)


def write_shards(shards: DataFrame, path: str) -> None:
    """Write each shard as Parquet, its rows in slot order."""
    n = max(1, shards.sparkSession.sparkContext.defaultParallelism)
    ranged = shards.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.mode("overwrite").partitionBy("shard").parquet(path)
