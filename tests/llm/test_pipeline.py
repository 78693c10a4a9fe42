from collections import Counter

import corpus_pipeline as c
from pyspark.sql import functions as F

from sarweave.llm import quality_crf, sharding
from tests.llm import brute
from tests.llm.test_decontaminate import brute_leaks

SF = "/root/testdata/sf0.001"


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = {}
    for k, (name, stage) in enumerate(c.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        seen[k] = (docs, spark.read.parquet(f"{tmp_path}/{k}"))
        docs = seen[k][1]
    before, after = seen[0]
    told = quality_crf.quality(before, labels).where("predicted = 1")
    assert ids(after) == ids(told)
    before, after = seen[1]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    assert ids(after) == Counter(d for d, _, _, kept in brute.op8(rows, 80) if kept)
    before, after = seen[2]
    rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
    leaks = brute_leaks(rows, [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert leaks and ids(after) == Counter(d for d, _ in rows if d not in {x for x, _ in leaks})
    before, after = seen[3]
    clean = labels.where("quality = 1 AND toxic = 0").join(before, "doc_id")
    assert clean.join(after, "doc_id", "left_anti").count() <= 0.02 * clean.count()
    before, after = seen[4]
    assert ids(after) == ids(before)
    by_shard = {}
    for r in after.collect():
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (None, "One fine line of words that is here."), (None, "One fine line of words that is here."), (3, long), (3, long), (4, long + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("own") for n in ("score", "leaks", "copies", "rate", "copy", "shard", "rank", "node")})
    for _, stage in c.STAGES:
        out = stage(spark, docs, SF)
        assert set(docs.columns) <= set(out.columns)
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert c.near_duplicate_stage(spark, docs, SF).count() == 4


def test_shuffle(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 5 > 0, F.col("id") % 900).alias("doc_id"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("t"), F.col("id") % 50)).alias("text"), F.lit("own").alias("slot"))
    out = sharding.shuffle_into_shards(docs, 7).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(tuple(r) for r in docs.select("doc_id", "text").collect())
    slots = {s: sorted(r.slot for r in out if r.shard == s) for s in range(7)}
    assert all(v == list(range(len(v))) for v in slots.values()) and {len(v) for v in slots.values()} <= {428, 429}
    again = sharding.shuffle_into_shards(docs.repartition(5), 7)
    assert again.where("doc_id IS NOT NULL").count() == 2400
    assert sharding.shuffle_into_shards(docs.limit(0), 7).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sharding.write_shards(sharding.shuffle_into_shards(docs, 4), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count() and back.groupBy("shard").count().count() == 4
