"""Exact top-k search by the three-phase uniform threshold.

A score is a sum over lists: each list holds one group of vector components. Phase 1 gathers the best entries of every
list and resolves them; the k-th best resolved score is a safe lower bound. Phase 2 sends every query the cutoff bound /
number of lists: a vector that could reach the bound is at or above it in some list, and only such entries are collected.
Phase 3 drops those whose upper bound stays under the bound and resolves the others exactly.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.llm import vectors as exact
from lexloom.llm.base import small_batches, table
from lexloom.session import cut

LISTS = 2
BLOCK = 4096  # vectors, and queries, in a block
SHELF = 8  # blocks of vectors that a block of queries meets in one place, at most
MOST = 1 << 62  # no list's part of a score may reach it, so that sums of bounds stay longs


def _quantise_task(batches):
    """vec_id and its whole-number components; vectors with missing or non-finite components are left out."""
    for b in batches:
        rows = [(i, v.astype("<f8").tobytes()) for i, v in zip(b.column("vec_id").to_pylist(), exact.quantise(b.column("embedding"))) if i is not None and v is not None]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([v for _, v in rows], pa.binary())], names=["vec_id", "vector"])


def _matrix(blobs, lists):
    """Matrix with a whole number of columns for each list; shorter vectors are filled up with 0."""
    width = max((len(x) // 8 for x in blobs), default=0)
    return exact.matrix(blobs, width + -width % lists)


def _products(a, b):
    return exact.products(a, b, MOST)


def _aligned(a, b, lists):
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))).reshape(len(m), lists, -1) for m in (a, b))


def _by_query(batches):
    """Rows of one query block and one corpus block: (queries' ids, vectors, bounds, corpus ids, vectors)."""
    for b in batches:
        for r in b.to_pylist():
            yield r


def _local_best(k, lists):
    """Phase 1: the k best entries of each list in the block, with their whole scores."""

    def task(batches):
        for r in _by_query(batches):
            q, c = _aligned(_matrix(r["q_vectors"], lists), _matrix(r["c_vectors"], lists), lists)
            q_ids, c_ids = np.array(r["q_ids"], np.int64), np.array(r["c_ids"], np.int64)
            total, picks = np.zeros((len(q), len(c)), np.int64), []
            n = min(k, len(c))
            for g in range(lists):
                part = _products(q[:, g], c[:, g])
                total += part
                picks.append(np.argpartition(-part, n - 1, axis=1)[:, :n])
            at = np.concatenate(picks, axis=1)
            rows = np.repeat(np.arange(len(q)), at.shape[1])
            pairs = np.unique(rows * len(c) + at.ravel())
            rows, at = pairs // len(c), pairs % len(c)
            yield _entries(q_ids[rows], c_ids[at], total[rows, at])

    return task


def _above_cutoff(lists):
    """Phases 2 and 3: entries at or above bound / lists in some list; those whose upper bound reaches the bound are resolved."""

    def task(batches):
        for r in _by_query(batches):
            q, c = _aligned(_matrix(r["q_vectors"], lists), _matrix(r["c_vectors"], lists), lists)
            q_ids, c_ids = np.array(r["q_ids"], np.int64), np.array(r["c_ids"], np.int64)
            low = np.array(r["q_bounds"], np.int64)[:, None]
            cutoff = -(-low // lists)  # the least whole number at or above bound / lists
            seen, upper, parts = np.zeros((len(q), len(c)), bool), np.zeros((len(q), len(c)), np.int64), []
            for g in range(lists):
                part = _products(q[:, g], c[:, g])
                hit = part >= cutoff
                seen |= hit
                upper += np.where(hit, part, cutoff - 1)  # an unseen entry is under the cutoff
                parts.append(part)
            rows, at = np.nonzero(seen & (upper >= low))
            score = sum(p[rows, at] for p in parts)
            keep = score >= low[rows, 0]
            yield _entries(q_ids[rows[keep]], c_ids[at[keep]], score[keep])

    return task


def _entries(q, c, score):
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(c), pa.array(score)], names=["q", "c", "score"])


ENTRY = "q long, c long, score long"


def _blocks(df, ident, n, prefix, *more):
    """Blocks of about BLOCK rows by a hash of the id."""
    b = F.pmod(F.xxhash64(ident), F.lit(n)).cast("int").alias(f"{prefix}_block")
    rows = F.sort_array(F.collect_list(F.struct(F.col(ident).alias("i"), "vector", *more)))
    df = df.groupBy(b).agg(rows.alias("_r"))
    return df.select(f"{prefix}_block", F.col("_r.i").alias(f"{prefix}_ids"), F.col("_r.vector").alias(f"{prefix}_vectors"), *[F.col(f"_r.{m}").alias(f"{prefix}_{m}s") for m in more])


def search(vectors, queries, k, lists=LISTS, block=BLOCK):
    """The k best other vectors for each query: query_id, rank, vec_id, score.

    vectors: vec_id, embedding; queries: the ids (vec_id) of the rows to search for. Components x count as floor(256 x),
    whatever their size; a list's part of a score of 2^62 or more is an error.
    Vectors that are NULL or hold NULL or non-finite components take no part, nor do rows without an id; of rows that
    share an id one counts, that with the smallest vector. Shorter vectors are filled up with 0. Ties go to the smaller
    id. Fewer than k others give fewer rows; an empty table gives none.

    Equal vectors are one class for which the k + 1 smallest ids stand: no query needs more. Blocks of queries meet blocks
    of classes, so a task holds one pair of blocks, and each list of it. A block of queries is moved once to each shelf of
    blocks of classes; the number of partitions follows the cores, not the blocks.
    """
    spark = small_batches(vectors.sparkSession, rows=1)
    whole = vectors.selectExpr("CAST(vec_id AS LONG) AS vec_id", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding").mapInArrow(_quantise_task, "vec_id long, vector binary").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    whole = cut(whole)
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    members = cut(whole.withColumn("_n", rank).filter(F.col("_n") <= k + 1).withColumn("cls", F.first_value("vec_id").over(Window.partitionBy("vector").orderBy("_n"))).select("cls", "vec_id", "vector", "_n"))
    classes = members.filter("_n = 1").select("cls", "vector")
    asked = whole.join(queries.select("vec_id").distinct(), "vec_id").join(classes, "vector").select("vec_id", "cls")
    asked = cut(asked)
    heads = classes.join(asked.select("cls").distinct(), "cls")
    n_c, n_q = (max(1, -(-d.count() // block)) for d in (classes, heads))
    cores = spark.sparkContext.defaultParallelism
    shelves = min(n_c, max(2 * cores, -(-n_c // SHELF)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * cores)
    corpus = cut(_blocks(classes, "cls", n_c, "c").withColumn("shelf", F.pmod("c_block", F.lit(shelves))).repartition(parts, "shelf"))

    def pairs(heads, *more):
        q = _blocks(heads, "cls", n_q, "q", *more).withColumn("shelf", F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))))
        return q.repartition(parts, "shelf").join(corpus, "shelf")

    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    # a class can stand for the query's own row alone, so one more class than k bounds the k-th other row
    gathered = pairs(heads).mapInArrow(_local_best(k + 1, lists), ENTRY).withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1)
    bounds = gathered.groupBy("q").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    heads = heads.join(bounds, heads["cls"] == bounds["q"]).select("cls", "vector", F.when(F.col("n") > k, F.col("low")).otherwise(F.lit(-(1 << 62) // (lists * lists))).alias("bound"))
    found = pairs(heads, "bound").mapInArrow(_above_cutoff(lists), ENTRY)
    found = found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k + 1).select("q", "c", "score")
    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    rows = found.join(members.select(F.col("cls").alias("c"), "vec_id"), "c").withColumn("_n", F.row_number().over(top)).filter(F.col("_n") <= k + 1)
    out = asked.select(F.col("vec_id").alias("query_id"), F.col("cls").alias("q")).join(rows, "q").filter("query_id <> vec_id")
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op1_exact_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 50 = 0"), 5)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
