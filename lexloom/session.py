"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings that pay off at any size. AQE coalesces small shuffle partitions and splits
# hot ones; forcing the skew-join split keeps it on even if it costs another exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def local_session(cores="8", app="lexloom", **extra):
    """Session for tests and the bench; on a cluster the submitter owns these settings."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "12g")
         .config("spark.sql.shuffle.partitions", "8"))
    for k, v in {**RUNTIME_CONF, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or getattr(sc, "_lexloom_dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="lexloom-")
        sc._lexloom_dir = named
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, cols) -> DataFrame:
    """The rows over all cores, before work on them that costs far more than the move; files may come in few large splits."""
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(parts, F.xxhash64(*cols))


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: ends the lineage and survives lost executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label="rows") -> DataFrame:
    """The rows as compressed columns in a scratch folder: written in one pass, for what is large and read more than once."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
