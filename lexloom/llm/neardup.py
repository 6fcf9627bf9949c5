"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The fingerprint of a text has 40 segments; a segment is the hash of six minima of the shingles under random orders, so two
texts agree in one with probability similarity ** 6. A table is kept for each segment and texts that agree in any are
compared by their whole shingle sets. Bits of a SimHash can't take this place: at 0.8 they differ by 15 % on average, and
segments short enough to differ by a bit or two are then shared by texts that have nothing in common.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lexloom.llm.base import small_batches, texts
from lexloom.llm.simhash import first_of_component
from lexloom.operators.traverse import roots
from lexloom.session import cut

SHINGLE, SEED = 5, 42
SEGMENTS, MINIMA = 40, 6  # a pair of similarity 0.8 agrees nowhere with probability 5e-6
START = 64  # shingles of the start of a set's order that a key carries
_CHUNK = 1024
_TURNS = np.array([xxhash.xxh64_intdigest(b"%d" % i, SEED) | 1 for i in range(SEGMENTS * MINIMA)], np.uint64)
_FOLD = np.array([xxhash.xxh64_intdigest(b"fold %d" % i, SEED) | 1 for i in range(MINIMA)], np.uint64)


def shingles(text, shingle=SHINGLE):
    """Sorted distinct XXH64 of a text's shingles, words as in simhash.fingerprint; fewer words make one of them all."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    starts = [0, *(ends[:len(stops) - 1] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((h(whole[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(stops)))


def segments(found):
    """The segments of a shingle set as 32-bit numbers; none for an empty set."""
    if not len(found):
        return []
    least = np.full(len(_TURNS), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), _CHUNK):
        np.minimum(least, (_TURNS[:, None] * found[None, i:i + _CHUNK]).min(axis=1), out=least)
    return ((least.reshape(SEGMENTS, MINIMA) * _FOLD).sum(axis=1, dtype=np.uint64) >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist()


def _name(found):
    return int(np.array([xxhash.xxh3_64_intdigest(found.tobytes())], np.uint64).view(np.int64)[0])


def fingerprints(docs):
    """doc_id, text_key, fp (hash of the whole shingle set), n (its size) and segments for every row of docs."""
    small_batches(docs.sparkSession)

    def task(batches):
        for b in batches:
            sets = [shingles(t) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array([_name(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                                              pa.array([segments(s) for s in sets], pa.list_(pa.int32()))], names=["doc_id", "text_key", "fp", "n", "segments"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(task, "doc_id long, text_key long, fp long, n int, segments array<int>")


def _sets(docs, wanted):
    """fp and shingles of the texts named by wanted (fp, text_key)."""

    def task(batches):
        for b in batches:
            sets = [shingles(t) for t in texts(b)]
            yield pa.RecordBatch.from_arrays([pa.array([_name(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["fp", "shingles"])

    rows = docs.select(F.xxhash64("text").alias("text_key"), "text").join(wanted.select("text_key"), "text_key", "left_semi")
    return rows.dropDuplicates(["text_key"]).mapInArrow(task, "fp long, shingles array<long>")


def _similar(pairs, sets):
    """The pairs (a, b, ...) whose sets have a similarity of 0.8 or more, tested on the whole sets in integers."""
    side = lambda c: sets.select(F.col("fp").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(F.size(F.array_intersect("a_set", "b_set")) * 9 >= (F.size("a_set") + F.size("b_set")) * 4).select(*pairs.columns)


def _near_sizes(n, m):
    return (n * 5 >= m * 4) & (m * 5 >= n * 4)


def across(wide, sets):
    """Pairs (a, b, a_component, b_component) of sets in different components that can be similar, by exact prefix filtering.

    wide: fp, component. A set's shingles are ordered by how many of the sets hold them, rarest first. Two sets of
    similarity 0.8 share one of the rarest fifth (and one more) of either, so only these are keys, and only if sets of
    several components hold them: what a copy has of its own pairs it with nothing, nor does a passage that all hold.
    A pair comes out where its sets first agree, whose place bounds their overlap; the start of its order, which a key
    carries, tells whether they agree before (past it a pair can come out more than once).
    """
    held = wide.join(sets.select("fp", F.explode("shingles").alias("s")), "fp")
    often = held.groupBy("s").agg(F.count(F.lit(1)).alias("often"), (F.min("component") < F.max("component")).alias("several"))
    order = held.join(often, "s").groupBy("fp", "component").agg(F.sort_array(F.collect_list(F.struct("often", "s", "several"))).alias("order"))
    n = F.size("order")
    keys = order.select("fp", "component", n.alias("n"), F.transform(F.slice("order", 1, START), lambda x: x["s"]).alias("start"),
                        F.posexplode(F.slice("order", F.lit(1), n - F.floor((n * 4 + 4) / 5).cast("int") + 1)).alias("at", "x"))
    keys = cut(keys.filter("x.several").select("x.s", "fp", "component", "n", "at", F.slice("start", F.lit(1), F.col("at")).alias("before")))
    side = lambda c: keys.select("s", *[F.col(k).alias(f"{c}_{k}") for k in ("fp", "component", "n", "at", "before")])
    pairs = side("a").join(side("b"), "s").filter((F.col("a_fp") < F.col("b_fp")) & (F.col("a_component") != F.col("b_component")) & _near_sizes(F.col("a_n"), F.col("b_n")))
    rest = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    pairs = pairs.filter((rest * 9 >= (F.col("a_n") + F.col("b_n")) * 4) & ~F.arrays_overlap("a_before", "b_before"))
    return pairs.select(F.col("a_fp").alias("a"), F.col("b_fp").alias("b"), "a_component", "b_component").distinct()


def _named_pairs(named, nodes, marked):
    """Pairs (a, b) of shingle sets of near sizes, from pairs of text keys."""
    of = lambda c: marked.select(F.col("text_key").alias(c), F.col("fp").alias(f"{c}_fp")).distinct()
    size = lambda c: nodes.select(F.col("fp").alias(f"{c}_fp"), F.col("n").alias(f"{c}_n"))
    pairs = named.join(of("a"), "a").join(of("b"), "b").filter("a_fp <> b_fp").join(size("a"), "a_fp").join(size("b"), "b_fp")
    return pairs.filter(_near_sizes(F.col("a_n"), F.col("b_n"))).select(F.least("a_fp", "b_fp").alias("a"), F.greatest("a_fp", "b_fp").alias("b")).distinct()


def groups(docs, named=None):
    """doc_id, text_key, fp and component_id (the smallest doc_id reachable over similar pairs) for every row of docs.

    Rows with one shingle set are one node, as are all texts without words: they form a group. Repeated rows stay, a NULL
    text is empty, a NULL doc_id belongs to its group but doesn't name it unless there is no other; an empty table gives
    none. A segment's bucket is linked through its smallest member first. What that leaves in other components, and all
    that shares a bucket with it, is searched by `across`. So every similar pair of a bucket is linked or lies in one
    component, and a large group of copies is never paired. named: pairs (a, b) of text keys that are tested as well, such
    as those of ``simhash.near_texts``.
    """
    marked = cut(fingerprints(docs))
    nodes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("segments").alias("segments")))
    rows = nodes.select("fp", "n", F.posexplode("segments").alias("i", "v")).select("fp", "n", F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("segment"))
    firsts = rows.groupBy("segment").agg(F.min(F.struct("fp", "n")).alias("head"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("segment", F.col("head.fp").alias("head"), F.col("head.n").alias("head_n"))
    held = cut(rows.join(firsts, "segment"))
    asked = cut(_named_pairs(named, nodes, marked)) if named is not None else None
    used = held.select("fp") if asked is None else held.select("fp").unionByName(asked.select(F.explode(F.array("a", "b")).alias("fp")))
    wanted = nodes.join(used.distinct(), "fp", "left_semi").select("fp", "text_key")
    sets = cut(_sets(docs, wanted))

    pairs = held.filter((F.col("head") != F.col("fp")) & _near_sizes(F.col("n"), F.col("head_n"))).select(F.col("head").alias("a"), F.col("fp").alias("b")).distinct()
    linked = cut(_similar(pairs, sets))
    named = cut(_labelled(nodes.select("fp"), "fp", roots(linked.select(F.col("a").alias("src"), F.col("b").alias("dst")))))
    of = lambda c, name: named.select(F.col("fp").alias(c), F.col("component").alias(name))
    here = cut(held.join(of("fp", "component"), "fp").join(of("head", "head_component"), "head"))
    split = here.filter("component <> head_component").select("segment").distinct()
    wide = cut(here.join(split, "segment", "left_semi").select("fp", "component").distinct())
    more = across(wide, sets)
    if asked is not None:
        # of the named pairs those that the buckets leave apart; a pair's sets travel for each test
        apart = asked.join(of("a", "a_component"), "a").join(of("b", "b_component"), "b").filter("a_component <> b_component")
        more = more.unionByName(apart.select(more.columns)).distinct()
    more = _similar(more, sets).select(F.col("a_component").alias("src"), F.col("b_component").alias("dst"))
    whole = _labelled(named, "component", roots(more))
    nodes = nodes.join(whole, "fp")
    ids = nodes.join(nodes.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("fp", "component_id")
    return marked.select("doc_id", "text_key", "fp").join(ids, "fp")


def _labelled(rows, of, found):
    """rows (fp, ...) with the component of `of`: fp, component."""
    found = found.select(F.col("id").alias(of), F.col("component").alias("_root"))
    return rows.join(found, of, "left").select("fp", F.coalesce("_root", of).alias("component"))


def survivors(docs, named=None):
    """docs without near copies: of each component the row with the smallest doc_id stays, ties as in simhash.survivors."""
    return first_of_component(docs, groups(docs.select("doc_id", "text"), named))
