"""Chunked scans and numberings equal plain windows, hot keys included."""

from pyspark.sql import Window, functions as F

from lexloom.operators import ordered


def _skewed(spark):
    # key 0 owns a third of the rows; ords have gaps
    k = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50)
    return spark.range(6000).select(k.alias("k"), (F.col("id") * 3).alias("o"), F.when(F.col("id") % 97 == 0, F.col("id")).alias("v"), F.lit(1).alias("one"))


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scan_matches_window(spark):
    df, w = _skewed(spark), Window.partitionBy("k").orderBy("o")
    want = df.select("*", F.row_number().over(w).cast("long").alias("n"), F.last("v", True).over(w).alias("c"), F.lead("v").over(w).alias("nx"))
    for chunk in (64, 4096, 10**9):
        _same(ordered.scan(df, ["k"], "o", {"n": "one"}, {"c": "v"}, {"nx": "v"}, chunk=chunk), want)


def test_split_row_number_matches_window(spark):
    df, w = _skewed(spark), Window.partitionBy("k").orderBy("o")
    want = df.withColumn("rn", F.row_number().over(w).cast("long"))
    for chunk in (64, 10**9):
        _same(ordered.split_row_number(df, ["k"], [F.floor(F.col("o") / chunk)], ["o"]), want)


def test_hot_keys_are_numbered_in_pieces(spark):
    df, w = _skewed(spark).withColumn("k", F.nullif("k", F.lit(7))), Window.partitionBy("k").orderBy("o")
    want = df.withColumn("rn", F.row_number().over(w).cast("long"))
    for hot in (10, 500, 10**9):
        _same(ordered.split_row_number(df, ["k"], [F.floor(F.col("o") / 64)], ["o"], hot=hot), want)


def test_cold_keys_are_shuffled_once(spark):
    """Rows move once, to the window; counts and hot keys are small beside them."""
    df = spark.range(20000).select((F.col("id") % 500).alias("k"), F.col("id").alias("o"), F.lit(1).alias("one"))
    for out in (ordered.split_row_number(df, ["k"], [F.floor(F.col("o") / 64)], ["o"]), ordered.scan(df, ["k"], "o", {"n": "one"})):
        plan = out._jdf.queryExecution().executedPlan()
        assert len(out.collect()) == 20000
        assert plan.toString().split("Initial Plan")[0].count("Exchange hashpartitioning") <= 2


def test_global_scan_is_one_total_order(spark):
    df = _skewed(spark).select("o", "one")
    got = ordered.global_scan(df, [F.col("o").desc()], {"cum": "one"})
    assert got.filter("rank <> cum").count() == 0
    assert got.filter("rank = 1").first()["o"] == 5999 * 3
    assert got.agg(F.countDistinct("rank")).first()[0] == 6000


def test_first_row_and_top_k(spark):
    df = _skewed(spark)
    first = ordered.first_row(df, ["k"], ["o"])
    assert first.filter("k = 0").first()["o"] == 0
    assert ordered.top_k(df, ["k"], [F.col("o").desc()], 2).filter("k = 0").count() == 2


def test_lookup_join_spreads_rows_without_a_key(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(8000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 7).cast("string").alias("k"), F.create_map(F.lit("a"), "id").alias("m"))
        table = spark.createDataFrame([("0", "x"), ("3", "y"), (None, "z")], "t string, v string")
        got = ordered.lookup_join(df, table, "k", "t").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in got.groupBy("p").count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 4000
        want = [(i, {"0": "x", "3": "y"}.get(str(i % 7)) if i % 10 == 0 else None) for i in range(8000)]
        assert sorted(tuple(r) for r in got.select("id", "v").collect()) == want
        assert got.columns == ["id", "k", "m", "t", "v", "p"]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
