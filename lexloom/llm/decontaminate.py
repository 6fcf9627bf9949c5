"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared as lower-case words with single spaces; in scripts written without spaces every character is
a word. An item may differ by one edit for every `per_edit` characters, so a short one must stand there word for word. Cut into one piece more than that budget, at least one piece is unchanged: exact piece hits are
found by an Aho-Corasick automaton over all pieces, and each hit's surroundings are verified with Myers' bit-parallel
distance.
"""

import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.base import own_name, small_batches, table, texts, with_columns

PER_EDIT = 20  # characters of an item for each edit allowed
SLICE = 16 << 20  # characters of items that one pass holds; more items take more passes
# fixed values: blocks of the scripts written without spaces (Thai, Lao, Myanmar, Khmer, Japanese, Chinese)
_SOLID = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD, _CHARACTER, _EITHER = re.compile(r"\w+"), re.compile(f"[{_SOLID}]"), re.compile(rf"(?=\w)[{_SOLID}]|[^\W{_SOLID}]+")


def normal(text):
    """Words between single spaces, with a space at either end; empty if there is no word."""
    text = text.lower()
    words = (_EITHER if _CHARACTER.search(text) else _WORD).findall(text)
    return f" {' '.join(words)} " if words else ""


def myers(item, text):
    """(smallest edit distance of item to any part of text, first end of such a part)."""
    m = len(item)
    masks = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, at = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        if score < best:
            best, at = score, j + 1
    return best, at


class Matcher:
    """Finds items (item_id, text) in texts."""

    def __init__(self, items, per_edit=PER_EDIT):
        import ahocorasick

        self.items, held = [], {}
        for ident, text in items:
            item = normal(text or "")
            if not item:
                continue
            budget = len(item) // per_edit
            for i in range(budget + 1):
                a, b = len(item) * i // (budget + 1), len(item) * (i + 1) // (budget + 1)
                held.setdefault(item[a:b], []).append((len(self.items), b))
            self.items.append((ident, item, budget))
        self.pieces = ahocorasick.Automaton()
        for piece, where in held.items():
            self.pieces.add_word(piece, where)
        if held:
            self.pieces.make_automaton()

    def find(self, text):
        """[(item_id, edits, end in the normal text)], one for each item that is in the text."""
        text = normal(text)
        if not self.items or not text:
            return []
        spots = {}
        for end, where in self.pieces.iter(text):
            for i, behind in where:
                _, item, budget = self.items[i]
                start = end + 1 - behind  # of the item, if no edit stands before the piece
                a, b = max(0, start - budget), min(len(text), start + len(item) + budget)
                known = spots.setdefault(i, [])
                if known and a <= known[-1][1] and known[-1][0] <= b:
                    known[-1] = (min(a, known[-1][0]), max(b, known[-1][1]))
                else:
                    known.append((a, b))
        found = []
        for i, windows in spots.items():
            ident, item, budget = self.items[i]
            edits, end = min((d, a + at) for a, b in windows for d, at in [myers(item, text[a:b])])
            if edits <= budget:
                found.append((ident, edits, end))
        return found


def _passes(benchmark):
    """The items in slices of bounded size, one after the other on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // SLICE)
    for i in range(n):
        yield [tuple(r) for r in items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()]


HIT = "doc_id long, item_id long, edits int, end_at long"


def find(docs, benchmark, per_edit=PER_EDIT):
    """Which items of benchmark (item_id, text) are in which docs (doc_id, text): doc_id, item_id, edits, end_at.

    One row for each item and row of docs, with the fewest edits. NULL and empty texts hold nothing; items that are NULL or
    have no word are in no text; items with one text are found each; empty tables give none.
    """
    spark = small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    out = spark.createDataFrame([], HIT)
    for items in _passes(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def task(batches, shared=shared):
            matcher = Matcher(shared.value, per_edit)
            for b in batches:
                rows = [(d, *hit) for d, t in zip(b.column("doc_id").to_pylist(), texts(b)) for hit in matcher.find(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64()))], names=["doc_id", "item_id", "edits", "end_at"])

        out = out.unionByName(docs.mapInArrow(task, HIT))
    return out


def clean(docs, benchmark, per_edit=PER_EDIT):
    """The rows of docs that hold no item, with all their columns."""
    spark = small_batches(docs.sparkSession)
    for items in _passes(benchmark):
        shared, flag = spark.sparkContext.broadcast(items), own_name(docs, "leak")

        def task(batches, shared=shared, flag=flag):
            matcher = Matcher(shared.value, per_edit)
            for b in batches:
                yield with_columns(b, **{flag: pa.array([bool(matcher.find(t)) for t in texts(b)], pa.bool_())})

        docs = docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(flag, T.BooleanType())])).filter(~F.col(flag)).drop(flag)
    return docs


def op3_decontamination(spark, sf_dir):
    return find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
