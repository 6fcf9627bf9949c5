"""Bucketed tables: only touched buckets are written, failed writes leave no trace, results equal a full rewrite."""

import os

import pytest
from pyspark.sql import functions as F

from lexloom.operators import dedupe, reconcile
from lexloom.sources import bucketed


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def base(spark, tmp_path):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.md5(F.col("id").cast("string")).alias("v")).unionByName(spark.createDataFrame([(None, "null")], "k string, v string"))
    bucketed.create(df, str(tmp_path), "k", 32)
    return df, str(tmp_path)


def test_upsert_and_delete_equal_a_full_rewrite(spark, base):
    df, path = base
    assert rows(bucketed.read(spark, path, df.schema)) == rows(df)
    changes = spark.createDataFrame([("5", "changed"), ("new", "added"), ("77", "changed")], df.schema)
    assert bucketed.upsert(path, changes, "k") == 1
    want = dedupe.upsert(df, changes, "k")
    assert rows(bucketed.read(spark, path, df.schema)) == rows(want)
    gone = spark.createDataFrame([("5",), ("6",), ("absent",)], "k string")
    assert bucketed.delete_by(path, df.schema, gone, "k") == 2
    assert rows(bucketed.read(spark, path, df.schema)) == rows(dedupe.delete_by(want, gone, "k"))
    assert bucketed.upsert(path, changes.limit(0), "k") == 2


def test_bytes_written_follow_the_changes(spark, base):
    df, path = base
    bucketed.upsert(path, spark.createDataFrame([("5", "changed")], df.schema), "k")
    assert size(f"{path}/v=1") < size(f"{path}/v=0") / 20
    assert sum(n.startswith("bucket=") for n in os.listdir(f"{path}/v=1")) == 1


def test_a_failed_write_changes_nothing(spark, base):
    df, path = base
    changes = spark.createDataFrame([("5", "changed"), ("6", "changed")], df.schema)
    broken = changes.withColumn("v", F.when(F.col("k") == "6", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        bucketed.upsert(path, broken, "k")
    assert rows(bucketed.read(spark, path, df.schema)) == rows(df)
    # rows were written, but the manifest wasn't
    changes.withColumn("bucket", F.lit(3)).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/v=1")
    assert rows(bucketed.read(spark, path, df.schema)) == rows(df)
    bucketed.upsert(path, changes, "k")
    assert rows(bucketed.read(spark, path, df.schema)) == rows(dedupe.upsert(df, changes, "k"))


def test_a_bucket_can_become_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    bucketed.create(df, str(tmp_path), "k", 8)
    bucketed.delete_by(str(tmp_path), df.schema, df.select("k"), "k")
    assert bucketed.read(spark, str(tmp_path), df.schema).count() == 0
    bucketed.upsert(str(tmp_path), df, "k")
    assert rows(bucketed.read(spark, str(tmp_path), df.schema)) == rows(df)


def test_decisions_on_edges(spark, tmp_path):
    edges = spark.createDataFrame([(f"{s}:{i}", s, i, "CITES", "", False, False, False) for s in range(200) for i in range(3)],
                                  "edge_id string, src int, dst int, type string, details string, verified boolean, modified boolean, extracted boolean")
    decisions = spark.createDataFrame([(1, "7:0", 7, "REMOVE", None, None, None), (2, "7:1", 7, "MODIFY", 99, "AFFECTS", "x"), (3, None, 7, "ADD", 2, None, None), (4, None, 8, "ADD", 50, None, "y")],
                                      "ord int, edge_id string, src int, action string, new_dst int, new_type string, details string")
    bucketed.create(edges, str(tmp_path), "src", 64)
    counters = bucketed.apply_decisions(str(tmp_path), edges.schema, decisions)
    whole, tally = reconcile.reconcile(edges.select("edge_id", "src", "dst", "type", "details"), decisions)
    assert rows(bucketed.read(spark, str(tmp_path), edges.schema)) == rows(whole.select(*edges.columns)) and rows(counters) == rows(tally)
    assert size(f"{tmp_path}/v=1") < size(f"{tmp_path}/v=0") / 4
