"""Near copies of the pipeline against brute force over five-word shingle sets."""

import random

import corpus_pipeline
import plain
from conftest import EDGE
from pyspark.sql import functions as F

from lexloom.llm import neardup


def sets(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar_pairs(docs):
    held = [(d, sets(t)) for d, t in docs]
    return [(a, b) for i, (a, x) in enumerate(held) for b, y in held[i + 1:] if 4 * max(len(x), len(y)) <= 5 * min(len(x), len(y)) and 5 * len(x & y) >= 4 * len(x | y)]


def least(docs, pairs):
    root = {d: d for d, _ in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {d: find(d) for d in root}


def test_components_equal_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    pairs = similar_pairs(docs)
    text = dict(docs)
    near = [(a, b) for a, b in pairs if text[a] != text[b]]
    far = [(a, b) for a, b in near if (plain.fingerprint(text[a]) ^ plain.fingerprint(text[b])).bit_count() > 3]
    assert far  # near copies that three bits of the contract do not see
    found = {r["doc_id"]: r["component_id"] for r in neardup.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == least(docs, pairs)


def test_pipeline_stage_drops_far_near_copies(spark):
    words = [f"word{i}" for i in range(300)]
    other = [f"new{i}" if i in (40, 120, 200) else w for i, w in enumerate(words)]
    chain = [f"more{i}" if i in (80, 160, 240) else w for i, w in enumerate(other)]
    apart = [f"far{i}" if i % 10 == 0 else w for i, w in enumerate(words)]
    docs = [(i, " ".join(w)) for i, w in enumerate((words, other, chain, apart))]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), None)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(set(least(docs, similar_pairs(docs)).values())) == [0, 3]


def test_pipeline_stage_links_by_simhash(spark, monkeypatch):
    """Without any table of minima the stage still joins what SimHash links, checked on whole sets."""
    monkeypatch.setattr(corpus_pipeline.neardup, "segments", lambda found: [])
    words = [f"word{i}" for i in range(3000)]
    near = [f"new{i}" if i == 1500 else w for i, w in enumerate(words)]
    docs = [(0, " ".join(words)), (1, " ".join(near)), (2, "altre text"), (3, None)]
    assert 0 < (plain.fingerprint(docs[0][1]) ^ plain.fingerprint(docs[1][1])).bit_count() <= 3 or plain.fingerprint(docs[0][1]) == plain.fingerprint(docs[1][1])
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), None)
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 3]


def test_edge_rows(spark, edge, none):
    found = neardup.groups(edge).collect()
    assert len(found) == len(EDGE) and neardup.groups(none).count() == 0 and neardup.survivors(none).count() == 0
    held = list(enumerate(r[1] for r in EDGE))
    group = least(held, similar_pairs(held) + [(i, j) for i, a in held for j, b in held if i < j and not (a or "").split() and not (b or "").split()])
    want = {i: min((EDGE[j][0] for j in group if group[j] == group[i] and EDGE[j][0] is not None), default=None) for i in group}
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["component_id"]) for r in found) == sorted((r[0] is not None, r[0], want[i]) for i, r in enumerate(EDGE))
    kept = neardup.survivors(edge)
    assert kept.columns == edge.columns and kept.count() == len(set(group.values()))


def test_large_group_makes_no_pairs(spark):
    """Copies of one text, each with a tenth of the words changed: most are under 0.8 to each other, and are never paired."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    docs = [(0, " ".join(words))] + [(d, " ".join(f"x{d}a{i}" if rng.random() < (0.02 if d % 10 == 0 else 0.06) else w for i, w in enumerate(words))) for d in range(1, 600)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["doc_id"]: r["component_id"] for r in neardup.groups(df).collect()} == least(docs, similar_pairs(docs))
    marked = neardup.fingerprints(df)
    sets = neardup._sets(df, marked.select("fp", "text_key"))
    apart = marked.select("fp", F.col("fp").alias("component"))
    linked = len(similar_pairs(docs))
    assert linked <= neardup.across(apart, sets).count() < 600 * 599 / 2 / 4


def test_named_pairs_that_buckets_link_are_not_tested(spark, monkeypatch):
    """In a group of near copies SimHash links nearly every pair; only those that the buckets leave apart are compared."""
    words = [f"word{i}" for i in range(400)]
    docs = [(k, " ".join([*words, f"tail{k}"])) for k in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    keys = [r["k"] for r in df.select(F.xxhash64("text").alias("k")).collect()]
    named = spark.createDataFrame([(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]], "a long, b long")
    tested, similar = [], neardup._similar

    def counted(pairs, sets):
        tested.append(pairs.count())
        return similar(pairs, sets)

    monkeypatch.setattr(neardup, "_similar", counted)
    found = {r["component_id"] for r in neardup.groups(df, named).collect()}
    assert found == {0} and sum(tested) < 66
