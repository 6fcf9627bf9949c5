"""Registered queries over whole tables, against SQL or plain versions."""

import zlib
from collections import Counter

import duckdb
import plain
import pytest
from check import rows_of
from conftest import SMALL

from lexloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(names, want.fetchall())


def test_suffix_dedup(spark, small):
    rows = queries.QUERIES["op2_suffix_dedup"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(plain.suffix_dedup(small))


def test_decontamination(spark, small):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = queries.QUERIES["op3_decontamination"](spark, SMALL).collect()
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in rows}
    assert len(found) == len(rows)
    assert found and found == plain.leaks(small, items)


def test_simhash(spark, small):
    rows = queries.QUERIES["op4_simhash"](spark, SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(plain.simhash_components(small))


def test_token_binary(spark, small):
    rows = sorted(map(tuple, queries.QUERIES["op5_token_binary"](spark, SMALL).collect()))
    want, start = [], 0
    for (d, _), ids in zip(small, plain.token_ids([t for _, t in small])):
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert rows == want


def test_packing(spark, small):
    assert plain.check_packing(queries.QUERIES["op8_packing"](spark, SMALL).collect(), small) < 0.05


def test_language_id(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    profile = plain.profiles([(t, lang) for d, t, lang in docs if not plain.held_out(d)])
    rows = {r["doc_id"]: r for r in queries.QUERIES["op9_language_id"](spark, SMALL).collect()}
    right = Counter()
    for d, text, lang in docs:
        pred, score = plain.language(text, profile)
        assert rows[d]["held_out"] == plain.held_out(d)
        assert rows[d]["lang_pred"] == pred and abs(rows[d]["score"] - score) < 1e-9
        right[plain.held_out(d), pred == lang] += 1
    assert right[True, True] > 0.9 * (right[True, True] + right[True, False])
