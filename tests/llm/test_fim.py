"""Fill-in-middle against a plain version: every edge row, long texts, other marks and shares, clashing columns."""

import hashlib
import re

import pytest
from conftest import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import fim


def plain(doc_id, text, marks=fim.MARKS, plain=10, spm=20):
    """(output, form, n, prefix_chars, middle_chars)"""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(m in text for m in marks) or h[2] % 100 >= 100 - plain:
        return text, "plain", n, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    p, s, m = marks
    if h[3] % 100 < spm:
        return s + suf + p + pre + m + mid, "spm", n, len(pre), len(mid)
    return p + pre + s + suf + m + mid, "psm", n, len(pre), len(mid)


TEXTS = ["", None, "a", "<", "<P", "P>", "x<P>y", "<S>", "word <M>", "$1 \\ $2 {3} \\E", "\n\n\r\n", "naïve 日本語 text 𝒳𝒴 😀😀 end\n", "a" * 100_000, "a b" * 100_000, "-" * 50_000 + "\n", "<<P <S M> <"]


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "output", "form", "n", "prefix_chars", "middle_chars").collect()]


def test_equals_plain(spark):
    rows = [(d * 1000 + i, t) for i, t in enumerate(TEXTS) for d in range(8)] + [(None, "no id at all")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim.transform(docs)
    found = rows_of(out)
    assert len(found) == len(rows) and {r[3] for r in found} == {"plain", "spm", "psm"}
    for d, t, *rest in found:
        assert tuple(rest) == plain(d, t), (d, (t or "")[:30])
    back = out.select("text", fim.restore(F.col("output"), F.col("form")).alias("back")).collect()
    assert all((t or "") == b for t, b in back)


@pytest.mark.parametrize("share", [(0, 0), (0, 100), (100, 50)])
def test_other_marks_and_shares(spark, share):
    marks = ("$1", "\\2", "(m)")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["one two, three", "has $1 inside", "x (m", "tail\n"])], "doc_id long, text string")
    out = fim.transform(docs, marks=marks, plain=share[0], spm=share[1])
    for d, t, *rest in rows_of(out):
        assert tuple(rest) == plain(d, t, marks, *share)
    assert all(t == b for t, b in out.select("text", fim.restore(F.col("output"), F.col("form"), marks)).collect())


def test_edge_rows_and_columns(spark, edge, none):
    out = fim.transform(edge)
    assert out.columns == [*edge.columns, "output", "form", "n", "prefix_chars", "middle_chars"] and out.count() == len(EDGE)
    assert sorted(map(str, rows_of(out))) == sorted(str((r[0], r[1], *plain(r[0], r[1]))) for r in EDGE)
    clash = edge.withColumnsRenamed({"Rank": "N", "_leak": "Output"}).withColumn("_fim_text", F.lit(1))
    again = fim.transform(clash)
    assert again.columns == ["doc_id", "text", "lang", "source", "n_chars", "_fim_text", "output", "form", "n", "prefix_chars", "middle_chars"]
    assert sorted(map(str, rows_of(again))) == sorted(map(str, rows_of(out)))
    assert fim.transform(none).count() == 0


def test_no_python_and_one_match(spark, edge):
    plan = fim.transform(edge)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and plan.count("regexp_replace") == 1


@settings(max_examples=100, deadline=None)
@given(st.text("ab<PSM> é\n", max_size=12))
def test_marks_stay_unique(text):
    for pre, mid, suf in ((text[:i], text[i:j], text[j:]) for i in range(len(text) + 1) for j in range(i, len(text) + 1)):
        if not any(m in text for m in fim.MARKS):
            for out in (f"<P>{pre}<S>{suf}<M>{mid}", f"<S>{suf}<P>{pre}<M>{mid}"):
                assert all(out.count(m) == 1 for m in fim.MARKS)
