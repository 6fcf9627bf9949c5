"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments so that two fingerprints within the radius differ by at most one bit in some segment.
Every fingerprint stands in one table for each segment; it asks each table for all segment values of its small Hamming
ball (the value and all with one bit flipped), and the hits are verified on the complete fingerprints.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.llm.base import small_batches, table, texts
from lexloom.operators.traverse import components
from lexloom.session import cut

SHINGLE, SEED, RADIUS = 3, 42, 3
BITS = 64
_CHUNK = 1 << 16


def fingerprint(text, shingle=SHINGLE):
    """64-bit fingerprint of a text, as a signed long; 0 without words.

    A-Z is lower-cased, words are runs of other than ASCII white space; a bit is set if over half of the shingles' XXH64
    have it. Fewer words than a shingle make one of them all.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    stops = ends[k - 1:].tolist()
    starts = [0, *(ends[:len(stops) - 1] + 1).tolist()]
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(stops), _CHUNK):
        values = np.array([h(whole[a:b], SEED) for a, b in zip(starts[i:i + _CHUNK], stops[i:i + _CHUNK])], "<u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(stops), bitorder="little").view("<i8")[0])


def fingerprints(docs, shingle=SHINGLE):
    """doc_id, text_key (hash of the text) and fp for every row of docs (doc_id, text); NULL texts are empty."""
    small_batches(docs.sparkSession)

    def task(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array([fingerprint(t, shingle) for t in texts(b)], pa.int64())], names=["doc_id", "text_key", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(task, "doc_id long, text_key long, fp long")


def links(fps, radius=RADIUS):
    """All pairs a < b of distinct fingerprints (column fp) that differ by at most `radius` bits.

    With (radius + 1) / 2 segments, rounded down but at least one, some segment differs by one bit or none. Ball values are
    made by column expressions, and the whole distance is tested inside the join, so only links come out. A fingerprint
    has a bounded number of neighbours within the radius, whatever the size of its group.
    """
    n = max(1, (radius + 1) // 2)
    edges = [BITS * i // n for i in range(n + 1)]
    entry, ask = [], []
    for i, (a, b) in enumerate(zip(edges, edges[1:])):
        value = F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1 if b - a < 64 else -1))
        key = lambda v, segment=i: F.struct(F.lit(segment).alias("segment"), v.alias("value"))
        entry.append(key(value))
        ask += [key(value)] + [key(value.bitwiseXOR(F.lit(1 << k if k < 63 else -(1 << 63)))) for k in range(b - a)]
    held = fps.select(F.col("fp").alias("b"), F.inline(F.array(*entry)))
    asked = fps.select(F.col("fp").alias("a"), F.inline(F.array(*ask)))
    return asked.join(held, ["segment", "value"]).filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b").distinct()


def groups(marked, radius=RADIUS):
    """marked (doc_id, fp, ...) with component_id: the smallest doc_id reachable over links.

    Rows with one fingerprint are one node, so copies are never paired. A NULL doc_id belongs to its fingerprint's
    component but does not name it, unless there is no other. An empty table gives none.
    """
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    pairs = cut(links(nodes.select("fp"), radius))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    linked = components(ends, pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnRenamed("id", "fp")
    nodes = nodes.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    named = nodes.join(nodes.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    return marked.join(named, "fp")


def near_texts(docs, shingle=SHINGLE, radius=RADIUS):
    """Pairs (a, b) of text keys: each text with the first of its fingerprint, and the first texts of linked fingerprints.

    They connect all texts whose fingerprints are linked, without pairing a large group.
    """
    marked = cut(fingerprints(docs, shingle).select("fp", "text_key").distinct())
    firsts = marked.groupBy("fp").agg(F.min("text_key").alias("first"))
    same = marked.join(firsts, "fp").filter("first <> text_key").select(F.col("first").alias("a"), F.col("text_key").alias("b"))
    of = lambda c: firsts.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_first"))
    near = links(firsts.select("fp"), radius).join(of("a"), "a").join(of("b"), "b").select(F.col("a_first").alias("a"), F.col("b_first").alias("b"))
    return same.unionByName(near)


def survivors(docs, shingle=SHINGLE, radius=RADIUS):
    """docs without near-duplicates: of each component the row with the smallest doc_id stays, with all its columns.

    Ties (rows that share that doc_id) go to the smallest text hash; repeated rows leave one. A NULL doc_id counts as
    larger than any.
    """
    return first_of_component(docs, groups(cut(fingerprints(docs, shingle)), radius))


def first_of_component(docs, marked):
    """The rows of docs that survivors keeps, by marked (doc_id, text_key, fp, component_id)."""
    first = Window.partitionBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
    keep = marked.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"))
    rows = docs.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64("text") == F.col("_k")), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])


def op4_simhash(spark, sf_dir):
    marked = cut(fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return groups(marked).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
