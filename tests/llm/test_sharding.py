import zlib

import numpy as np
from pyspark.sql import functions as F

from sarweave.llm import queries, sharding

SF = "/root/testdata/sf0.001"


def placed(df):
    return sorted(map(repr, df.collect()))


def odd(spark):
    rows = [(i if i % 5 else None, None if i % 7 == 0 else "é word " * (i % 40), i % 3 or None) for i in range(400)]
    rows += [(7, "the same row", 1)] * 3000 + [(7, f"same id {i}", 1) for i in range(500)] + [(None, None, None)] * 20 + [(1, "x" * 200_000, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, extra int")


def test_same_result_whatever_the_partitions(spark):
    docs = odd(spark)
    want = placed(sharding.shuffle_into_shards(docs, 7, bucket_bytes=20_000))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts, shuffles in ((1, "3"), (13, "29")):
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            assert placed(sharding.shuffle_into_shards(docs.orderBy(F.rand(parts)).repartition(parts), 7, bucket_bytes=20_000)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_against_a_plain_version(spark):
    docs, seed, limit = odd(spark), 17, 20_000
    keyed = sharding.numbered(docs, seed)
    total = sum(len((r.text or "").encode()) + 1 for r in docs.collect())
    n = -(-total // limit)
    of = keyed.withColumn("b", F.pmod(F.xxhash64(F.lit(seed + 1), "__sw_k1"), F.lit(n))).collect()
    assert len({(r["__sw_k1"], r["__sw_k2"]) for r in of}) == len(of) == docs.count()
    want, at = [], 0
    for b in range(n):
        rows = sorted((r for r in of if r.b == b), key=lambda r: (r["__sw_k1"], r["__sw_k2"]))
        rng = np.random.Generator(np.random.PCG64([seed, b]))
        for i in range(len(rows) - 1, 0, -1):
            j = int(rng.integers(0, i + 1))
            rows[i], rows[j] = rows[j], rows[i]
        for r in rows:
            want.append((r.doc_id, r.text, r.extra, at % 7, at // 7))
            at += 1
    got = [tuple(r) for r in sharding.shuffle_into_shards(docs, 7, bucket_bytes=limit).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_a_repeated_row_is_scattered(spark):
    docs = spark.range(100_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one and the same text").alias("text"))
    keyed = sharding.numbered(docs, 17).withColumn("b", F.pmod(F.xxhash64(F.lit(18), "__sw_k1"), F.lit(40)))
    sizes = [r["count"] for r in keyed.groupBy("b").count().collect()]
    assert len(sizes) == 40 and max(sizes) < 3000
    out = sharding.shuffle_into_shards(docs, 8, bucket_bytes=100_000).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m"), F.countDistinct("slot").alias("d")).collect()
    assert [(r.n, r.m, r.d) for r in out] == [(12_500, 12_499, 12_500)] * 8


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op7_sharding(spark, SF).collect()
    assert len(out) == len(docs) and {r.doc_id for r in out} == set(docs)
    for r in out:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    slots = [sorted(r.slot for r in out if r.shard == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in slots) and max(map(len, slots)) - min(map(len, slots)) <= 1


def test_columns_of_any_type(spark):
    docs = spark.createDataFrame([(1, "a", {"k": 1}, [1.5])] * 3 + [(1, "a", {"k": 2}, None)], "doc_id long, text string, m map<string,int>, l array<double>")
    out = sharding.shuffle_into_shards(docs.withColumn("shard", F.lit("x")), 2)
    assert out.count() == 4 and out.columns == [*docs.columns, "shard", "slot"] and sharding.shuffle_into_shards(docs.limit(0)).count() == 0


def test_a_partition_for_each_bucket(spark, monkeypatch):
    docs = odd(spark)
    n = -(-docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] // 20_000)
    out = sharding.shuffle_into_shards(docs, 7, bucket_bytes=20_000)
    want = placed(out)
    assert out.rdd.getNumPartitions() == n > 8
    monkeypatch.setattr(sharding, "PARTITIONS", 5)
    out = sharding.shuffle_into_shards(docs, 7, bucket_bytes=20_000)
    assert out.rdd.getNumPartitions() == 5 and placed(out) == want
