"""Physical-plan properties that matter at scale."""

import re

from pyspark.sql import functions as F

from scriptorium.functions import tokens as K
from scriptorium.operators import clean as C
from scriptorium.operators import pack as P
from scriptorium.plans import fixtures

DOCS = "/root/testdata/sf0.001/documents.parquet"


def plan(spark, df):
    df.createOrReplaceTempView("_plan_probe")
    return spark.sql("EXPLAIN FORMATTED SELECT * FROM _plan_probe").first()[0]


def test_cleaning_is_narrow_and_pruned(spark):
    d = spark.read.parquet(DOCS)
    c = C.clean_corpus(fixtures.framed_documents(d)).select("doc_id", F.md5("clean"))
    p = plan(spark, c)
    assert "Exchange" not in p
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", p)


def test_packing_has_one_regroup_shuffle_and_broadcast_offsets(spark):
    d = spark.read.parquet(DOCS)
    toks = d.select(F.col("doc_id").alias("ord"), K.codepoint_ids(F.col("text")).alias("input_ids"))
    packed = P.pack_sequences(toks, 256)
    p = plan(spark, packed)
    assert len(re.findall(r"Exchange\n.*\n.*hashpartitioning\(seq_id", p)) == 1 or \
        p.count("hashpartitioning(seq_id") == 1
    assert "BroadcastHashJoin" in p
    assert "collect_list" in p and "partial_collect_list" in p  # map-side partial aggregation


def test_packing_without_broadcast_joins_on_order_key(spark):
    d = spark.read.parquet(DOCS)
    toks = d.select(F.col("doc_id").alias("ord"), K.codepoint_ids(F.col("text")).alias("input_ids"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no size-based broadcast either
    try:
        p = plan(spark, P.pack_sequences(toks, 256))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(ord" in p and "SortMergeJoin" in p
