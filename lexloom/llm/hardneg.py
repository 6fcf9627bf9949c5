"""Hard negatives from Hilbert-ordered blocks with zone maps.

Candidates are written as Parquet in the order of label and Hilbert curve, a block of neighbouring vectors to a row, with
the least and the greatest value of every dimension (the zone map) beside it. An anchor's inner product with anything in
a block lies between two sums of products with those bounds. A request asks for an anchor's best scores within a window;
only blocks whose interval meets the window are read for it. Two passes answer requests: the most promising blocks give
the k-th best score so far, which narrows the window; then every block that the narrowed window meets is read.

Requests travel in groups of neighbouring anchors and zone maps in pages, so a task holds a group with a page or a block.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexloom.llm.base import small_batches, table
from lexloom.llm.vectors import matrix, products, quantised, widened
from lexloom.session import cut, scratch_path

GROUP, BLOCK, PAGE = 256, 1024, 512  # anchors in a group, vectors in a block, zone maps in a page
SEEDS = 2  # blocks that are read first for a request
DIMENSIONS, BITS = 16, 4  # of the Hilbert curve: the dimensions of greatest variance, bits of each
LEAST, MOST = -(1 << 63), (1 << 63) - 1
ORDER = ["label", "place", "vec_id"]
WINDOWS = "windows array<struct<key:long,low:long,high:long>>"


def hilbert(cells, bits):
    """Position of every row of cells (whole numbers under 2 ** bits) on the Hilbert curve, as bytes in order of the curve."""
    x = cells.astype(np.int64).T.copy()
    q = 1 << bits - 1
    while q > 1:  # undo the turns of every level, from the top
        p = q - 1
        for row in x:
            flip = (row & q) != 0
            swap = np.where(flip, 0, (x[0] ^ row) & p)
            x[0] ^= np.where(flip, p, swap)
            row ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], np.int64), 1 << bits - 1
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    digits = np.stack([row >> b & 1 for b in range(bits - 1, -1, -1) for row in x], axis=1).astype(np.uint8)
    return [r.tobytes() for r in np.packbits(digits, axis=1)]


def _frame(rows):
    """Dimensions of the curve, their means and widths of a cell, from the sums over all rows."""

    def task(batches):
        n, total, square = np.zeros(0), np.zeros(0), np.zeros(0)
        for b in batches:
            m = matrix(b.column("vector").to_pylist())
            with np.errstate(over="ignore"):
                n, total, square = (np.pad(x, (0, max(0, m.shape[1] - len(x)))) for x in (n, total, square))
                n[:m.shape[1]] += len(m)
                total[:m.shape[1]] += m.sum(axis=0)
                square[:m.shape[1]] += (m * m).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n), dtype=np.int32)), *map(pa.array, (n, total, square))], names=["d", "n", "total", "square"])

    sums = rows.select("vector").mapInArrow(task, "d int, n double, total double, square double").groupBy("d").agg(F.sum("n"), F.sum("total"), F.sum("square")).collect()
    with np.errstate(all="ignore"):
        spread = [(float(np.nan_to_num(s / n - (t / n) ** 2, nan=0.0, posinf=1e300)), d, t / n) for d, n, t, s in sums]
    best = sorted(spread, key=lambda x: (-x[0], x[1]))[:DIMENSIONS]
    return [d for _, d, _ in best], np.array([m for _, _, m in best]), np.sqrt([max(v, 0.0) for v, _, _ in best])


def placed(rows):
    """rows (vec_id, label, vector) with `place` on the Hilbert curve over cells of half a standard deviation."""
    dims, mean, sigma = _frame(rows)

    def task(batches):
        for b in batches:
            m = matrix(b.column("vector").to_pylist())
            m = widened(m, max(dims, default=0) + 1)[:, dims]
            with np.errstate(all="ignore"):
                cells = np.nan_to_num((m - mean) / sigma * (1 << BITS - 2) + (1 << BITS - 1), nan=1 << BITS - 1, posinf=0, neginf=0)
            place = hilbert(np.clip(cells, 0, (1 << BITS) - 1), BITS) if dims else [b""] * len(m)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(place, pa.binary())], names=[*b.schema.names, "place"])

    return rows.mapInArrow(task, "vec_id long, label long, vector binary, place binary")


def _packed(df, size, columns, row, parts=None):
    """df in curve order, `size` neighbours packed into a row by `row`, written and read again. A row has a number as first column."""
    names = [c.split()[0] for c in columns.split(", ")]

    def task(batches):
        first, held, n = TaskContext.get().partitionId() << 32, [], 0

        def out():
            values = row(held)
            return pa.RecordBatch.from_arrays([pa.array([first + n], pa.int64()), *[pa.array([v]) for v in values]], names=names)

        for b in batches:
            for r in b.to_pylist():
                # a block is cut where the label changes, unless it is small
                if held and (len(held) == size or (held[-1].get("label") != r.get("label") and len(held) * 4 >= size)):
                    yield out()
                    held, n = [], n + 1
                held.append(r)
        if held:
            yield out()

    if parts is None:
        df = df.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    path = scratch_path(df.sparkSession, "hardneg")
    df.mapInArrow(task, columns).write.parquet(path)
    return df.sparkSession.read.parquet(path)


_bytes = lambda values, kind: np.array(values, kind).tobytes()
_read = lambda blob, kind: np.frombuffer(blob, kind)


def _block_row(held):
    held = sorted(held, key=lambda r: r["vec_id"])
    m, labels = matrix([r["vector"] for r in held]), [r["label"] for r in held]
    return len(held), min(labels), max(labels), _bytes([r["vec_id"] for r in held], "<i8"), _bytes(labels, "<i8"), m.astype("<f8").tobytes(), m.min(axis=0).astype("<f8").tobytes(), m.max(axis=0).astype("<f8").tobytes()


def _page_row(held):
    lo, hi = (matrix([r[c] for r in held]) for c in ("lo", "hi"))
    return len(held), *[_bytes([r[c] for r in held], "<i8") for c in ("block", "least", "most")], lo.tobytes(), hi.tobytes()


def _group_row(held):
    asks = [(i, w["key"], w["low"], w["high"]) for i, r in enumerate(held) for w in r["windows"]]
    return len(held), *[_bytes([r[c] for r in held], "<i8") for c in ("vec_id", "label")], matrix([r["vector"] for r in held]).tobytes(), *[_bytes([a[i] for a in asks], "<i8") for i in range(4)]


class Store:
    """Candidate blocks, and pages of their zone maps, in the shared folder."""

    def __init__(self, rows):
        self.blocks = _packed(rows, BLOCK, "block long, n long, least long, most long, ids binary, labels binary, vectors binary, lo binary, hi binary", _block_row)
        zones = self.blocks.select("block", "least", "most", "lo", "hi")
        pages = _packed(zones, PAGE, "page long, zones long, block binary, least binary, most binary, lo binary, hi binary", _page_row, parts="as they are")
        self.n = max(1, pages.count())
        self.pages = pages.withColumn("bucket", F.pmod(F.xxhash64("page"), F.lit(self.n)))


def _groups(anchors):
    return _packed(anchors, GROUP, "g long, n long, ids binary, labels binary, vectors binary, anchor binary, key binary, low binary, high binary", _group_row)


def _group(r):
    n = r["n"]
    return (_read(r["ids"], "<i8"), _read(r["labels"], "<i8"), _read(r["vectors"], "<f8").reshape(n, -1), *[_read(r[c], "<i8") for c in ("anchor", "key", "low", "high")])


def _intervals(a, lo, hi):
    """Bounds of the inner products of the rows of a with anything between lo and hi, a little wider than rounding."""
    width = max(a.shape[1], lo.shape[1])
    a, lo, hi = (widened(m, width) for m in (a, lo, hi))
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    with np.errstate(all="ignore"):
        slack = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T * (1e-15 * (width + 1))
        return plus @ lo.T + minus @ hi.T - slack, plus @ hi.T + minus @ lo.T + slack


def _meets(r, same):
    """For a row of a group and a page: requests x blocks, whether a block may hold an answer, and how high a one."""
    _, labels, a, anchor, _, low, high = _group(r)
    lo, hi = (_read(r[c], "<f8").reshape(r["zones"], -1) for c in ("z_lo", "z_hi"))
    least, most = (_read(r[c], "<i8") for c in ("z_least", "z_most"))
    under, over = _intervals(a, lo, hi)
    own = labels[:, None]
    fits = (least <= own) & (own <= most) if same else ~((least == own) & (own == most))
    low, high = np.nextafter(low.astype(float), -np.inf)[:, None], np.nextafter(high.astype(float), np.inf)[:, None]
    under, over = under[anchor], over[anchor]
    return fits[anchor] & ~(over < low) & ~(under > high), np.minimum(over, high) + 1e-6 * (under + over)


def _seed_task(same):
    """The blocks of a page that each request should read first: those that can come nearest to the top of its window."""

    def task(batches):
        for b in batches:
            for r in b.to_pylist():
                meets, promise = _meets(r, same)
                away = np.where(meets, -np.nan_to_num(promise), np.inf)
                first = np.argsort(away, axis=1, kind="stable")[:, :SEEDS]
                ask, j = np.repeat(np.arange(len(away)), first.shape[1]), first.ravel()
                keep = np.isfinite(away[ask, j])
                ask, j = ask[keep], j[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ask), r["g"])), pa.array(ask.astype(np.int32)), pa.array(_read(r["z_block"], "<i8")[j]), pa.array(away[ask, j])], names=["g", "ask", "block", "away"])

    return task


def _need_task(same):
    """Blocks of a page that a group must read, each with the requests that must read it."""

    def task(batches):
        for b in batches:
            for r in b.to_pylist():
                meets = _meets(r, same)[0]
                at = np.flatnonzero(meets.any(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r["g"])), pa.array(_read(r["z_block"], "<i8")[at]), pa.array([np.flatnonzero(meets[:, j]).astype(np.int32) for j in at], pa.list_(pa.int32()))], names=["g", "block", "asks"])

    return task


def _score_task(same, k):
    """The k best answers to each request from one block: anchor, key, found, score."""
    names = ["anchor", "key", "found", "score"]

    def task(batches):
        for b in batches:
            for r in b.to_pylist():
                ids, labels, a, anchor, key, low, high = _group(r)
                asks = np.array(sorted(set(r["asks"])), np.int64)
                c_ids, c_labels, c = _read(r["c_ids"], "<i8"), _read(r["c_labels"], "<i8"), _read(r["c_vectors"], "<f8").reshape(r["c_n"], -1)
                used, at = np.unique(anchor[asks], return_inverse=True)
                whole = products(a[used], c)
                allowed = (labels[used][:, None] == c_labels) == same
                allowed &= ids[used][:, None] != c_ids
                for i in range(0, len(asks), GROUP):
                    part, where = asks[i:i + GROUP], at[i:i + GROUP]
                    score = whole[where]
                    ok = allowed[where] & (score >= low[part][:, None]) & (score <= high[part][:, None])
                    score[~ok] = LEAST
                    n = np.arange(len(part))
                    for _ in range(k):
                        j = score.argmax(axis=1)  # the first of equal scores has the smallest id
                        good = ok[n, j]
                        if not good.any():
                            break
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[anchor[part[good]]], key[part[good]], c_ids[j[good]], score[n[good], j[good]])], names=names)
                        score[n, j], ok[n, j] = LEAST, False

    return task


def _to_pages(groups, store):
    """Every group with every page: the stated requests against all zone maps, in blocks."""
    asked = groups.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(store.n - 1).cast("long"))))
    pages = store.pages.select("bucket", "zones", *[F.col(c).alias(f"z_{c}") for c in ("block", "least", "most", "lo", "hi")])
    return asked.join(pages, "bucket")


def _answers(needs, groups, store, same, k):
    """The k best answers of the needed blocks to each request: anchor, key, found, score, rank."""
    blocks = store.blocks.select("block", *[F.col(c).alias(f"c_{c}") for c in ("n", "ids", "labels", "vectors")])
    best = Window.partitionBy("anchor", "key").orderBy(F.desc("score"), "found")
    found = needs.join(groups, "g").join(blocks, "block").mapInArrow(_score_task(same, k), "anchor long, key long, found long, score long")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _needs(groups, store, same):
    return _to_pages(groups, store).mapInArrow(_need_task(same), "g long, block long, asks array<int>")


def search(anchors, store, same, k):
    """The k best scores in each window of each anchor: anchor, key, found, score, rank (from 1).

    anchors: vec_id, label, vector, place, windows (key, low, high; both ends count). `same`: whether candidates carry the
    anchor's label or another one; an anchor is never its own answer. Ties go to the smaller id.
    """
    groups = _groups(anchors)
    nearest = Window.partitionBy("g", "ask").orderBy("away", "block")
    first = _to_pages(groups, store).mapInArrow(_seed_task(same), "g long, ask int, block long, away double")
    first = first.withColumn("_n", F.row_number().over(nearest)).filter(F.col("_n") <= SEEDS).groupBy("g", "block").agg(F.collect_list("ask").alias("asks"))
    bounds = _answers(first, groups, store, same, k).filter(F.col("rank") == k).groupBy(F.col("anchor").alias("vec_id")).agg(F.map_from_entries(F.collect_list(F.struct("key", "score"))).alias("bounds"))
    higher = F.transform("windows", lambda w: F.struct(w["key"].alias("key"), F.greatest(w["low"], F.try_element_at("bounds", w["key"])).alias("low"), w["high"].alias("high")))
    groups = _groups(anchors.join(bounds, "vec_id", "left").withColumn("windows", higher).drop("bounds"))
    return _answers(_needs(groups, store, same), groups, store, same, k)


def mine(vectors, anchors, positives=5, negatives=3, low=50, high=95):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hardest negatives that are still safe.

    vectors: vec_id, label, embedding; anchors: the ids (vec_id) to mine for. Components x count as floor(256 x). An
    anchor's positives are its `positives` best other rows of the same label (all, if fewer). For each, the `negatives`
    best rows of another label whose score is `low` to `high` percent of the positive's come out; fewer if there are
    fewer, so a negative positive score gives none. Ties go to the smaller id.

    Rows without id, label or vector, or with a NULL or non-finite component, take no part; of rows that share an id, that
    with the smallest label, then vector counts. Shorter vectors are filled up with 0. Anchors that are NULL or no row
    give nothing, repeated ones count once, an empty table gives none. A score beyond a long is an error.
    """
    small_batches(vectors.sparkSession, rows=1024)
    rows = quantised(vectors).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("r")).select("vec_id", "r.label", "r.vector")
    rows = cut(placed(cut(rows)))
    store = Store(rows)
    anchors = rows.join(anchors.select(F.col("vec_id").cast("long")).distinct(), "vec_id")
    kind = WINDOWS.split(" ", 1)[1]
    everything = F.array(F.struct(F.lit(0).alias("key"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"))).cast(kind)
    near = cut(search(anchors.withColumn("windows", everything), store, True, positives).select("anchor", F.col("found").alias("key"), F.col("score").alias("positive_score")))
    percent = lambda p: F.lit(p).cast("decimal(9,0)") * F.col("positive_score").cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")
    windows = near.select("anchor", F.struct("key", F.ceil(percent(low)).cast("long").alias("low"), F.floor(percent(high)).cast("long").alias("high")).alias("w")).filter("w.low <= w.high")
    windows = windows.groupBy(F.col("anchor").alias("vec_id")).agg(F.sort_array(F.collect_list("w")).cast(kind).alias("windows"))
    hard = search(anchors.join(windows, "vec_id"), store, False, negatives)
    return hard.join(near, ["anchor", "key"]).select(F.col("anchor").alias("anchor_id"), F.col("key").alias("positive_id"), "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return mine(vectors, vectors.filter("vec_id % 50 = 0"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same WHERE 100 * s.score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
