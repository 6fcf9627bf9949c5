"""Token ids as compressed binary blocks: an adaptive context-mixing range coder.

Ids are predicted from the two ids before (order 2), the one before (order 1) and the block so far (order 0). One binary
decision says whether the id is the prediction of the highest order that has one; its probability mixes the opinions of
orders 2 and 1 and the hit rate so far, with weights that adapt. Other ids are coded by an order-0 model of their high
byte, refreshed as the block goes on, and the low bits as they are. Blocks are reset independently and carry a checksum;
all blocks of a batch are coded in step, one numpy lane each, with integer arithmetic only, so every machine decodes alike.

A file set is a table of blocks: part, block, n_ids, bits, crc32, payload, and the documents that begin in the block
(doc_ids, doc_tokens). Parts are ranges of doc_id in ascending order.
"""

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.llm import tokens
from lexloom.llm.base import small_batches, table, texts
from lexloom.session import scratch_path

BLOCK = 4096  # ids
LANES = 1024  # blocks coded in step
_ORDER1, _ORDER2 = 1024, 2048  # context slots of a block
_U, _W = np.uint32, np.uint64
_TOP, _BOT = _W(1 << 56), _W(1 << 48)
_RATE, _LEARN = 5, 10
_HIT, _HIGH = 12, 15  # bits of the totals of both decisions


@functools.cache
def _curves():
    """Logistic function of -2047..2047 (256 a unit) in 1..4095, and its inverse."""
    squash = np.array([min(4095, max(1, int(4096 / (1 + math.exp(-x / 256)) + 0.5))) for x in range(-2047, 2048)], np.int32)
    return squash, (np.searchsorted(squash, np.arange(4096)) - 2047).clip(-2047, 2047).astype(np.int32)


class _Model:
    """Predictions and statistics of n blocks in step. Arrays are used up to the lanes still open."""

    def __init__(self, n, bits):
        self.low_bits = max(0, bits - 8)
        self.squash, self.stretch = _curves()
        self.lane = np.arange(n)
        self.base = (self.lane * _ORDER1, self.lane * _ORDER2)
        self.slots = (np.zeros(n * _ORDER1, np.uint64), np.zeros(n * _ORDER2, np.uint64))  # id << 4 | confidence
        self.prob = np.full((3, n * 32), 2048, np.int32)  # of a hit, by order, lane, agreement and confidence
        self.weight = np.full((3, n), 3 << 13, np.int32)
        self.before1, self.before2 = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.seen = np.zeros((n, 256), np.int32)
        self.sums = np.tile((np.arange(257) << (_HIGH - 8)).astype(np.uint16), (n, 1))  # before each high byte
        self.step, self.due = 0, 16

    def predict(self, k):
        """Candidate ids and the probability (of 4096) that they come next."""
        h1 = (self.before1[:k] * _U(0x9E3779B1)) >> _U(22)
        h2 = ((self.before1[:k] * _U(0x85EBCA6B)) ^ (self.before2[:k] * _U(0xC2B2AE35))) * _U(0x9E3779B1) >> _U(21)
        self.at = (self.base[0][:k] + h1, self.base[1][:k] + h2)
        held = [t[i] for t, i in zip(self.slots, self.at)]
        self.says = [(h >> _W(4)).astype(np.uint32) for h in held]
        self.sure = [(h & _W(15)).astype(np.int64) for h in held]
        self.guess = np.where(self.sure[1] > 0, self.says[1], self.says[0])
        lane = self.lane[:k] << 5
        self.state = [lane + ((says == self.guess) << 4) + sure for says, sure in zip(self.says, self.sure)] + [lane]
        self.odds = [p[s] for p, s in zip(self.prob, self.state)]
        self.input = [self.stretch[p] for p in self.odds]
        mixed = sum((x >> 2) * (w[:k] >> 2) for x, w in zip(self.input, self.weight)) >> 12
        self.p = self.squash[mixed.clip(-2047, 2047) + 2047]
        return self.guess, self.p.astype(np.uint64)

    def update(self, ids, hit):
        k = len(ids)
        target = np.where(hit, np.int32(4095), np.int32(0))
        error = target - self.p
        for x, w, p, state, odds in zip(self.input, self.weight, self.prob, self.state, self.odds):
            w[:k] = (w[:k] + ((x * error) >> _LEARN)).clip(-(1 << 18), 1 << 18)
            p[state] = odds + ((target - odds) >> _RATE)
        for slots, at, says, sure in zip(self.slots, self.at, self.says, self.sure):
            same = says == ids
            keep = same | (sure > 1)
            sure = np.where(same, np.minimum(sure + 1, 15), np.maximum(sure >> 1, 1))
            slots[at] = (np.where(keep, says, ids).astype(np.uint64) << _W(4)) | sure.astype(np.uint64)
        self.before2[:k] = self.before1[:k]
        self.before1[:k] = ids

    def count(self, lanes, high):
        self.seen[lanes, high] += 1

    def refresh(self):
        """New order-0 sums at fixed steps: every symbol keeps a share, the last one takes what rounding leaves."""
        self.step += 1
        if self.step == self.due:
            self.due += min(self.due, 256)
            share = self.seen * ((1 << _HIGH) - 256) // np.maximum(self.seen.sum(axis=1, keepdims=True), 1) + 1
            self.sums[:, 1:] = np.cumsum(share, axis=1)
            self.sums[:, 256] = 1 << _HIGH


class _Encoder:
    def __init__(self, n, size):
        self.low, self.range = np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64)
        self.out, self.at = np.zeros((n, size * 6 + 32), np.uint8), np.zeros(n, np.int64)

    def settle(self, k):
        """Writes the leading bytes that can't change any more."""
        low, rng, rows = self.low[:k], self.range[:k], None
        while True:
            same = (low ^ (low + rng)) < _TOP
            tight = rng < _BOT
            m = np.flatnonzero(same | tight)
            if not len(m):
                break
            if rows is None:
                rows, low, rng = m, low[m], rng[m]
            else:
                self.low[rows], self.range[rows] = low, rng
                rows, low, rng = rows[m], low[m], rng[m]
            cut = tight[m] & ~same[m]
            if cut.any():
                rng = np.where(cut, (~low + _W(1)) & (_BOT - _W(1)), rng)
            self.out[rows, self.at[rows]] = low >> _W(56)
            self.at[rows] += 1
            low, rng = low << _W(8), rng << _W(8)
        if rows is not None:
            self.low[rows], self.range[rows] = low, rng

    def end(self):
        for _ in range(8):
            self.out[np.arange(len(self.at)), self.at] = self.low >> _W(56)
            self.at += 1
            self.low <<= _W(8)
        return [self.out[i, :n].tobytes() for i, n in enumerate(self.at)]


class _Decoder:
    def __init__(self, payloads):
        n = len(payloads)
        self.data = np.zeros((n, max(map(len, payloads)) + 32), np.uint8)
        for i, p in enumerate(payloads):
            self.data[i, :len(p)] = np.frombuffer(p, np.uint8)
        self.low, self.range, self.word = np.zeros(n, np.uint64), np.full(n, (1 << 64) - 1, np.uint64), np.zeros(n, np.uint64)
        self.at = np.full(n, 8, np.int64)
        for i in range(8):
            self.word = (self.word << _W(8)) | self.data[:, i]

    def settle(self, k):
        low, rng, rows = self.low[:k], self.range[:k], None
        while True:
            same = (low ^ (low + rng)) < _TOP
            tight = rng < _BOT
            m = np.flatnonzero(same | tight)
            if not len(m):
                break
            if rows is None:
                rows, low, rng = m, low[m], rng[m]
            else:
                self.low[rows], self.range[rows] = low, rng
                rows, low, rng = rows[m], low[m], rng[m]
            cut = tight[m] & ~same[m]
            if cut.any():
                rng = np.where(cut, (~low + _W(1)) & (_BOT - _W(1)), rng)
            self.word[rows] = (self.word[rows] << _W(8)) | self.data[rows, np.minimum(self.at[rows], self.data.shape[1] - 1)]
            self.at[rows] += 1
            low, rng = low << _W(8), rng << _W(8)
        if rows is not None:
            self.low[rows], self.range[rows] = low, rng


def _low_parts(bits):
    """Widths in which the low bits are coded; the first shares a step with both decisions."""
    return [min(16, bits - i) for i in range(0, bits, 16)]


def encode(blocks):
    """Payloads of blocks of ids (uint32 arrays) and the bits of the largest id."""
    bits = max(8, int(max((b.max(initial=0) for b in blocks), default=0)).bit_length())
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    sizes = np.array([len(blocks[i]) for i in order])
    width = int(sizes[0])
    ids = np.zeros((width, len(blocks)), np.uint32)
    for lane, i in enumerate(order):
        ids[:len(blocks[i]), lane] = blocks[i]
    model, coder = _Model(len(blocks), bits), _Encoder(len(blocks), width)
    for t in range(width):
        k = int(np.searchsorted(-sizes, -t))  # lanes that are longer than t
        now = ids[t, :k]
        guess, p = model.predict(k)
        hit = guess == now
        share = coder.range[:k] >> _W(_HIT)
        coder.low[:k] += np.where(hit, _W(0), p * share)
        coder.range[:k] = share * np.where(hit, p, _W(1 << _HIT) - p)
        lanes = np.flatnonzero(~hit)
        if len(lanes):
            missed, left = now[lanes], model.low_bits
            high = (missed >> _U(left)).astype(np.int64)
            begin = model.sums[lanes, high].astype(np.uint64)
            low, share = coder.low[lanes], coder.range[lanes] >> _W(_HIGH)
            low += begin * share
            share *= model.sums[lanes, high + 1].astype(np.uint64) - begin
            model.count(lanes, high)
            for i, n in enumerate(_low_parts(left)):
                if i:
                    coder.low[lanes], coder.range[lanes] = low, share
                    coder.settle(k)
                    low, share = coder.low[lanes], coder.range[lanes]
                left -= n
                share >>= _W(n)
                low += ((missed >> _U(left)) & _U((1 << n) - 1)).astype(np.uint64) * share
            coder.low[lanes], coder.range[lanes] = low, share
        coder.settle(k)
        model.update(now, hit)
        model.refresh()
    done = coder.end()
    payloads = [None] * len(blocks)
    for lane, i in enumerate(order):
        payloads[i] = done[lane]
    return payloads, bits


def decode(payloads, sizes, bits):
    """Blocks of ids."""
    order = sorted(range(len(payloads)), key=lambda i: -sizes[i])
    lengths = np.array([sizes[i] for i in order])
    width = int(lengths[0])
    ids = np.zeros((width, len(payloads)), np.uint32)
    model, coder = _Model(len(payloads), bits), _Decoder([payloads[i] for i in order])
    for t in range(width):
        k = int(np.searchsorted(-lengths, -t))
        guess, p = model.predict(k)
        share = coder.range[:k] >> _W(_HIT)
        split = p * share
        hit = coder.word[:k] - coder.low[:k] < split
        coder.low[:k] += np.where(hit, _W(0), split)
        coder.range[:k] = share * np.where(hit, p, _W(1 << _HIT) - p)
        now = guess.copy()
        lanes = np.flatnonzero(~hit)
        if len(lanes):
            low, share, word = coder.low[lanes], coder.range[lanes] >> _W(_HIGH), coder.word[lanes]
            at = np.minimum((word - low) // share, _W((1 << _HIGH) - 1)).astype(np.uint16)
            # the high byte whose sums enclose the point: its upper half first, then among sixteen
            half = (model.sums[lanes, 16:256:16] <= at[:, None]).sum(axis=1) << 4
            high = half + (model.sums[lanes[:, None], half[:, None] + np.arange(1, 16)] <= at[:, None]).sum(axis=1)
            begin = model.sums[lanes, high].astype(np.uint64)
            low += begin * share
            share *= model.sums[lanes, high + 1].astype(np.uint64) - begin
            model.count(lanes, high)
            found, left = high.astype(np.uint32), model.low_bits
            for i, n in enumerate(_low_parts(left)):
                if i:
                    coder.low[lanes], coder.range[lanes] = low, share
                    coder.settle(k)
                    low, share, word = coder.low[lanes], coder.range[lanes], coder.word[lanes]
                share >>= _W(n)
                at = np.minimum((word - low) // share, _W((1 << n) - 1))
                low += at * share
                found = (found << _U(n)) | at.astype(np.uint32)
            coder.low[lanes], coder.range[lanes] = low, share
            now[lanes] = found
        coder.settle(k)
        model.update(now, hit)
        model.refresh()
        ids[t, :k] = now
    out = [None] * len(payloads)
    for lane, i in enumerate(order):
        out[i] = ids[:lengths[lane], lane].copy()
    return out


FILE = "part int, block long, n_ids int, bits int, crc32 long, payload binary, doc_ids array<long>, doc_tokens array<long>"
_FILE_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
_FILE_NAMES = [c.split()[0] for c in FILE.split(", ")]


def _checksum(n, bits, payload):
    return zlib.crc32(payload, zlib.crc32(b"%d %d" % (n, bits)))


def write_ids(docs, out_path, path=None, block=BLOCK):
    """Encodes docs (doc_id, text) in ascending doc_id order and writes the blocks to out_path.

    NULL doc_ids come first, ties are ordered by text; NULL and empty texts have END alone. An empty table writes none.
    """
    small_batches(docs.sparkSession)
    path = path or tokens.default_path()

    def task(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held, n_held, begun = [], 0, []  # ids not yet coded; (place among them, doc_id, tokens) of documents

        def flush(last):
            nonlocal held, n_held, begun, number
            ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
            use = len(ids) if last else len(ids) // block * block
            cut = [ids[i:min(i + block, use)] for i in range(0, use, block)]
            if cut:
                payloads, bits = encode(cut)
                docs_of = [([], []) for _ in cut]
                for at, doc, n in begun:
                    if at < use:
                        docs_of[at // block][0].append(doc)
                        docs_of[at // block][1].append(n)
                rows = [(part, number + i, len(c), bits, _checksum(len(c), bits, p), p, *d) for i, (c, p, d) in enumerate(zip(cut, payloads, docs_of))]
                number += len(cut)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FILE_TYPES)], names=_FILE_NAMES)
            held, n_held, begun = [ids[use:]], len(ids) - use, [(at - use, doc, n) for at, doc, n in begun if at >= use]

        for b in batches:
            ids, at = tokens.encoder(path).encode(texts(b))
            begun += zip((at[:-1] + n_held).tolist(), b.column("doc_id").to_pylist(), np.diff(at).tolist())
            held.append(ids)
            n_held += len(ids)
            if n_held >= block * LANES:
                yield from flush(False)
        yield from flush(True)

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(task, FILE).write.mode("errorifexists").option("compression", "none").parquet(out_path)


def _read_task(batches):
    """Documents of a part, whose blocks come in order; a document may span blocks."""
    names, last, waiting, open_doc = ["part", "ord", "doc_id", "n_tokens", "ids_crc32"], None, [], None
    rows = []

    def take(blocks):
        nonlocal last, open_doc
        for bits in {b["bits"] for b in blocks}:
            same = [b for b in blocks if b["bits"] == bits]
            for b in same:
                if _checksum(b["n_ids"], bits, b["payload"]) != b["crc32"]:
                    raise ValueError(f"block {b['block']} of part {b['part']} is damaged")
            for b, ids in zip(same, decode([b["payload"] for b in same], [b["n_ids"] for b in same], bits)):
                b["ids"] = ids
        for b in blocks:
            if b["part"] != last:
                last, open_doc = b["part"], [0, 0, 0]  # next document's number, ids still to come, their crc32 so far
                docs = []
            raw, at = memoryview(b["ids"].astype("<u4").tobytes()), 0
            todo = list(zip(b["doc_ids"], b["doc_tokens"]))
            while at < b["n_ids"]:
                if not open_doc[1]:
                    (doc, n), todo = todo[0], todo[1:]
                    open_doc[1:] = [n, 0]
                    open_doc.append((doc, n))
                n = min(open_doc[1], b["n_ids"] - at)
                open_doc[2] = zlib.crc32(raw[4 * at:4 * (at + n)], open_doc[2])
                open_doc[1] -= n
                at += n
                if not open_doc[1]:
                    doc, total = open_doc.pop()
                    rows.append((last, open_doc[0], doc, total, open_doc[2]))
                    open_doc[0] += 1

    def out():
        held, rows[:] = list(rows), []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), (pa.int32(), *[pa.int64()] * 4))], names=names)

    for batch in batches:
        waiting += batch.to_pylist()
        while len(waiting) >= LANES:
            take(waiting[:LANES])
            waiting = waiting[LANES:]
            if rows:
                yield out()
    if waiting:
        take(waiting)
        if rows:
            yield out()


def read_ids(spark, in_path):
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32. Damaged blocks raise."""
    small_batches(spark)
    blocks = spark.read.schema(FILE).parquet(in_path)
    docs = blocks.repartition("part").sortWithinPartitions("part", "block").mapInArrow(_read_task, "part int, ord long, doc_id long, n_tokens long, ids_crc32 long")
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return (docs.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(before, "part")
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))


def op5_token_binary(spark, sf_dir):
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return read_ids(spark, path)
