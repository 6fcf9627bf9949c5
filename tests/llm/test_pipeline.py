"""The pipeline against the plain versions, stage by stage."""

import corpus_pipeline
import plain
from conftest import EDGE, SMALL
from test_neardup import least, similar_pairs

from lexloom.llm import langid
from lexloom.session import scratch_path


def staged(spark, docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        yield name, docs


def floor(scores):
    """The language stage's floor by all labelled texts' scores: as far under the lowest hundredth as that is under the median."""
    scores = sorted(scores)
    at = lambda p: scores[max(0, -(-int(len(scores) * p * 1000) // 1000) - 1)]
    return max(0.0, 2 * at(0.01) - at(0.5)) if len(scores) >= langid.FLOOR_ROWS else 0.0


def expected(rows, items):
    """(doc_id, text) kept by each filtering stage. rows: doc_id, text, lang."""
    profile = plain.profiles([(t, lang) for d, t, lang in rows if not plain.held_out(d)])
    named = [plain.language(t, profile) for _, t, _ in rows]
    least_score = floor([s for (d, _, lang), (p, s) in zip(rows, named) if not plain.held_out(d) and lang is not None and p != "und"])
    now = [(d, t) for (d, t, _), (p, s) in zip(rows, named) if (p != "und" and s >= least_score - 1e-12 if profile else any(c.isalpha() for c in t or ""))]
    yield now
    lines = plain.line_dedup(set(now))
    now = [(d, lines[d, t][2]) for d, t in now if not lines[d, t][1] or lines[d, t][2].strip()]
    yield now
    # repeated ids with other texts are apart until a similarity joins them
    held = list(dict.fromkeys(now))
    group = least(list(enumerate(t for _, t in held)), similar_pairs(list(enumerate(t for _, t in held))))
    first = {}
    for i, (d, t) in sorted(enumerate(held), key=lambda x: (x[1][0] is None, x[1][0])):
        first.setdefault(group[i], (d, t))
    now = list(first.values())
    yield now
    leaked = {d for d, _ in plain.leaks(now, items)}
    now = [(d, t) for d, t in now if d not in leaked]
    yield now


def check(spark, docs, sf_dir):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    order = lambda p: (p[0] is not None, p)
    want = list(expected(rows, items))
    for i, (name, out) in enumerate(staged(spark, docs, sf_dir)):
        if i < 4:
            assert out.columns == docs.columns, name
            found = out.collect()
            assert sorted(((r["doc_id"], r["text"]) for r in found), key=order) == sorted(want[i], key=order), name
        else:
            plain.check_packing(out.collect(), want[3])
    return want


def test_stages(spark):
    want = check(spark, spark.read.parquet(f"{SMALL}/documents.parquet"), SMALL)
    sizes = [len(w) for w in want]
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] or sizes[1] >= sizes[2] >= sizes[3]


def test_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    kept = list(expected([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], items))[-1]
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] or set(out.columns) >= {"doc_id", "start", "length"}
    plain.check_packing(out.collect(), kept)


def test_edges(spark, edge):
    check(spark, edge.filter("doc_id IS NOT NULL"), SMALL)
    names = [n for n, _ in staged(spark, edge, SMALL)]
    assert names == [n for n, _ in corpus_pipeline.STAGES] and len(EDGE) == edge.count()


def test_empty(spark, none):
    for name, out in staged(spark, none, SMALL):
        assert out.count() == 0, name
