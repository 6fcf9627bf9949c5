"""Helpers shared by the training-data operators."""

import os
import tempfile
import zipfile

import pyarrow as pa
from pyspark.sql import functions as F

import lexloom
from lexloom.session import tune


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ship(sc):
    """Gives the package to the Python workers through Spark's file server, as spark-submit --py-files would."""
    if getattr(sc, "_lexloom_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(lexloom.__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="lexloom-package-"), "lexloom.zip")
    with zipfile.ZipFile(at, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.join("lexloom", os.path.relpath(os.path.join(folder, n), top)))
    sc.addPyFile(at)
    sc._lexloom_shipped = True


def small_batches(spark, rows=2000, size="8m"):
    """Arrow batches bounded by rows and bytes, so that a task's memory doesn't follow the length of its texts."""
    tune(spark)
    _ship(spark.sparkContext)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark


def own_name(df, label):
    """A column name that no column of df has, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, f"_{label}"
    while name in taken:
        name = f"_{name}"
    return name


def texts(batch, column="text"):
    """Texts of an Arrow batch; NULL is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def with_columns(batch, **arrays):
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays.values()], names=[*batch.schema.names, *arrays])


def digest(text):
    """Lower-case hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)
