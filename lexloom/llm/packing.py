"""Packing of token pieces into sequences by shortest-pack-first over the length histogram.

Documents are cut into pieces of the sequence length and a rest. The histogram of piece lengths has at most as many
entries as a sequence has tokens; it alone comes to the driver. Lengths are placed longest first, each into the shortest
packs that still have room, which updates counts of packing patterns, not of documents. A piece's rank among those of its
length then tells which sequence of which pattern it belongs to.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.llm import tokens
from lexloom.llm.base import small_batches, table, texts
from lexloom.session import cut

SIZE = 1024
BUCKET = 50_000  # pieces ranked together


def shortest_pack_first(histogram, size):
    """Patterns and their counts: [((lengths, longest first), count)]. histogram: {length: pieces}."""
    room = [[] for _ in range(size + 1)]  # by free tokens: [pattern, count]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        free = size
        while left:
            while free >= length and not room[free]:
                free -= 1
            if free < length:
                room[size - length].append(((length,), left))
                break
            pattern, count = room[free].pop()
            n = min(count, left)
            if count > n:
                room[free].append((pattern, count - n))
            room[free - length].append(((*pattern, length), n))
            left -= n
    return [p for held in room for p in held]


def slots(patterns):
    """For each length the ranks at which slots begin, with the first sequence and the offset of each slot."""
    found, sequence = {}, 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            begin, first, at, total = found.setdefault(length, ([], [], [], [0]))
            begin.append(total[0])
            first.append(sequence)
            at.append(offset)
            total[0] += count
            offset += length
        sequence += count
    return {length: tuple(np.array(x, np.int64) for x in v[:3]) for length, v in found.items()}


PIECES = "doc_id long, text_key long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs, path=None, size=SIZE):
    """Rows of PIECES for docs (doc_id, text): every id of every document, END included, lies in exactly one piece.

    NULL and empty texts have END alone. Repeated rows have their own pieces. A NULL doc_id stays NULL.
    """
    small_batches(docs.sparkSession)
    path = path or tokens.default_path()

    def task(batches):
        for b in batches:
            ids, at = tokens.encoder(path).encode(texts(b))
            n = np.diff(at)
            per = -(-n // size)
            doc = np.repeat(np.arange(len(n)), per)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)) * size
            length = np.minimum(size, n[doc] - start)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * i:4 * (i + k)]) for i, k in zip((at[doc] + start).tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc)), b.column("text_key").take(pa.array(doc)), *(pa.array(x.astype(np.int64)) for x in (start, length)), pa.array(crc, pa.int64()), pa.array(n[doc].astype(np.int64))], names=[c.split()[0] for c in PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(task, PIECES)


def place(cut_pieces, size=SIZE):
    """cut_pieces (written, so that ranks don't change) with sequence_id and offset; gapless from offset 0.

    Ranks are counted in buckets of a hash and shifted by the bucket totals, so a length that all documents share is not
    one group. An empty table gives none.
    """
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = slots(shortest_pack_first(counts, size))
    buckets = max(1, -(-sum(counts.values()) // BUCKET))
    p = cut_pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "text_key", "start"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    shift = p.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n")).select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    local = F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "text_key", "start"))
    ranked = p.withColumn("_local", local).join(shift, ["length", "_b"]).withColumn("_rank", F.col("_shift") + F.col("_local") - 1).drop("_b", "_local", "_shift")

    def task(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for k in np.unique(length):
                rows = np.flatnonzero(length == k)
                begin, first, at = where[int(k)]
                i = np.searchsorted(begin, rank[rows], side="right") - 1
                sequence[rows], offset[rows] = first[i] + rank[rows] - begin[i], at[i]
            b = b.drop_columns(["_rank"])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sequence), pa.array(offset)], names=[*b.schema.names, "sequence_id", "offset"])

    names = [c for c in ranked.columns if c != "_rank"]
    kinds = dict(ranked.dtypes)
    return ranked.select(*names, "_rank").mapInArrow(task, ", ".join(f"{c} {kinds[c]}" for c in names) + ", sequence_id long, offset long")


def pack(docs, path=None, size=SIZE):
    """Placement of every piece of docs (doc_id, text): PIECES, sequence_id, offset."""
    return place(cut(pieces(docs, path, size)), size)


def sequences(docs, placed, path=None, size=SIZE):
    """The packed token ids: sequence_id, ids (little-endian unsigned 32-bit), n_tokens, doc_starts (where pieces begin)."""
    path = path or tokens.default_path()
    schema = "sequence_id long, offset long, ids binary"

    def task(batches):
        for b in batches:
            ids, at = tokens.encoder(path).encode(texts(b))
            rows = [(p["sequence_id"], p["offset"], ids[at[i] + p["start"]:at[i] + p["start"] + p["length"]].astype("<u4").tobytes()) for i, held in enumerate(b.column("_p").to_pylist()) for p in held]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], names=["sequence_id", "offset", "ids"])

    wanted = placed.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("_p"))
    texts_ = docs.select(F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_k"), "text").dropDuplicates(["_d", "_k"])
    rows = texts_.join(wanted, F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_k") == F.col("text_key"))).select("text", "_p").mapInArrow(task, schema)
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    packed = rows.groupBy("sequence_id").agg(held.alias("_r"))
    joined = F.aggregate("_r.ids", F.lit(b""), lambda a, x: F.concat(a, x))
    return packed.select("sequence_id", joined.alias("ids"), (F.length(joined) / 4).cast("int").alias("n_tokens"), F.col("_r.offset").alias("doc_starts"))


def op8_packing(spark, sf_dir):
    placed = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
