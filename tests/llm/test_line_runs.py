"""Line dedup against brute force over every run length."""

import random

import pytest

from lexloom.llm import linededup


def kept(docs, min_chars):
    cut = {d: [x.strip(" \t\r") for x in t.split("\n")] for d, t in docs}
    first, out = {}, {}
    for d in sorted(cut):
        for i in range(len(cut[d])):
            for n in range(1, len(cut[d]) - i + 1):
                first.setdefault(tuple(cut[d][i:i + n]), (d, i))
    for d, text in docs:
        gone = set()
        for i in range(len(cut[d])):
            for n in range(1, len(cut[d]) - i + 1):
                run = cut[d][i:i + n]
                if sum(map(len, run)) >= min_chars and first[tuple(run)] < (d, i):
                    gone.update(range(i, i + n))
        out[d] = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
    return out


def check(spark, docs, min_chars=30):
    out = linededup.dedup(spark.createDataFrame(docs, "doc_id long, text string"), min_chars)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == kept(docs, min_chars)


@pytest.mark.parametrize("sizes", [(12, 12, 12), (5, 5, 25), (25, 5, 5), (7, 0, 9, 0, 15), (4,) * 9])
def test_runs_of_short_lines_go_whole(spark, sizes):
    run = "\n".join(chr(97 + i) * n for i, n in enumerate(sizes))
    docs = [(1, f"one\n{run}\nend of one"), (2, f"{run}\ntwo"), (3, f"three\n{run}")]
    assert kept(docs, 30) == {1: docs[0][1], 2: "two", 3: "three"}
    check(spark, docs)


def test_random_lines_equal_brute_force(spark):
    rng = random.Random(5)
    docs = [(d, "\n".join(rng.choice("abc") * rng.choice((0, 1, 3, 8)) for _ in range(rng.randint(1, 25)))) for d in range(60)]
    check(spark, docs, 10)
