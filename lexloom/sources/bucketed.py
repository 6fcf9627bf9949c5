"""Tables in hash buckets, of which a change rewrites only those it touches.

A table is a folder. ``v=<n>/bucket=<b>`` holds the rows of bucket b as version n wrote them, ``manifest/<n>`` names the
buckets that version n wrote, with their row counts. A version counts once its manifest is there, which is one file that
appears by a rename; a reader takes each bucket from the last version that names it. A write that fails leaves files that
nothing names, and the next one writes the same version anew. There is one writer at a time.
"""

from functools import reduce

from pyspark.sql import functions as F

from lexloom.operators import dedupe, reconcile

BUCKETS = 64
MANIFEST = "version int, bucket int, n long, buckets int, key string"


def _bucket(key, buckets):
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _commit(df, path, version, key, buckets, touched):
    """Writes df, which has all rows of the touched buckets, as a version, and names it."""
    spark = df.sparkSession
    rows = df.withColumn("bucket", _bucket(key, buckets))
    at = f"{path}/v={version}"
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(at)
    sizes = spark.read.schema(rows.schema).parquet(at).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    named = spark.createDataFrame([(b,) for b in touched], "bucket int").join(sizes, "bucket", "left")
    named = named.select(F.lit(version).alias("version"), "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.lit(buckets).alias("buckets"), F.lit(key).alias("key"))
    named.coalesce(1).write.mode("overwrite").json(f"{path}/manifest/{version}")


def create(df, path, key, buckets=BUCKETS):
    """A new table of df's rows by ``key``. A NULL key is a key. ``buckets`` should keep one in a task's memory."""
    _commit(df, path, 0, key, buckets, range(buckets))


def _state(spark, path):
    """(last version, key, buckets, {bucket: version} of those with rows): at most ``buckets`` rows come to the driver."""
    m = spark.read.schema(MANIFEST).json(f"{path}/manifest/*")
    last = m.groupBy("bucket").agg(F.max_by(F.struct("version", "n", "buckets", "key"), "version").alias("x")).select("bucket", "x.*").collect()
    return max(r["version"] for r in last), last[0]["key"], last[0]["buckets"], {r["bucket"]: r["version"] for r in last if r["n"]}


def read(spark, path, schema, only=None):
    """The table's rows, or those of some buckets. ``schema`` is that of the rows."""
    version, _, _, where = _state(spark, path)
    held = {}
    for b, v in where.items():
        if only is None or b in only:
            held.setdefault(v, []).append(f"{path}/v={v}/bucket={b}")
    parts = [spark.read.schema(schema).parquet(*paths) for _, paths in sorted(held.items())]
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], schema)


def rewrite(spark, path, schema, keys, change):
    """Replaces the rows of the buckets that ``keys`` (column ``key``) fall into by ``change`` of them. Returns the version."""
    version, key, buckets, _ = _state(spark, path)
    touched = sorted(r[0] for r in keys.select(_bucket("key", buckets)).distinct().collect())
    if touched:
        _commit(change(read(spark, path, schema, set(touched))), path, version + 1, key, buckets, touched)
    return version + bool(touched)


def upsert(path, changes, key):
    """SET4: replace rows by key, append new ones, in the buckets of the changes."""
    return rewrite(changes.sparkSession, path, changes.schema, changes.select(F.col(key).alias("key")), lambda old: dedupe.upsert(old, changes, key))


def delete_by(path, schema, gone, key):
    """SET4: drop the rows whose key is in ``gone``."""
    return rewrite(gone.sparkSession, path, schema, gone.select(F.col(key).alias("key")), lambda old: dedupe.delete_by(old, gone, key))


def apply_decisions(path, schema, decisions):
    """INC4 on a table of edges in buckets of ``src``: an edge keeps its source, so only the decided sources' buckets change.

    Returns the counters per source. The flags of earlier reviews are replaced for the edges that are read.
    """
    seen = {}

    def change(old):
        edges, seen["counters"] = reconcile.reconcile(old.select("edge_id", "src", "dst", "type", "details"), decisions)
        return edges.select(*schema.fieldNames())

    rewrite(decisions.sparkSession, path, schema, decisions.select(F.col("src").alias("key")), change)
    return seen.get("counters")
