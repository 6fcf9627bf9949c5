"""Readers and the streaming refresh on real files."""

import json

from pyspark.sql import functions as F

from lexloom.operators import flatten
from lexloom.sources import readers, writers
from lexloom.streaming import refresh


def test_index_array_is_split_by_record(spark, tmp_path):
    rows = [{"documentId": str(i), "title": f"Títol, {{{i}}}\n  }},", "loc": {"lat": i, "tags": [{"a": 1}]}} for i in range(50)]
    p = tmp_path / "index.json"
    for data, indent in ((rows, 2), (rows[:1], 2), (rows, None), (rows, 4), (rows[:1], None), (rows, 1)):
        p.write_text(json.dumps(data, indent=indent, ensure_ascii=False), encoding="utf-8")
        df, bad = readers.read_index(spark, str(p), "documentId string, title string, loc struct<lat:int,tags:array<struct<a:int>>>", "array")
        assert bad.count() == 0
        got = df.orderBy("ingest_ord").collect()
        assert [(r["ingest_ord"], r["documentId"], r["title"], r["loc"]["lat"]) for r in got] == [(i, x["documentId"], x["title"], x["loc"]["lat"]) for i, x in enumerate(data)]


def test_index_keeps_broken_lines_apart(spark, tmp_path):
    (tmp_path / "i.json").write_text('{"a": 1}\n{"a": 2\n\n{"a": 3}\n')
    ok, bad = readers.read_index(spark, str(tmp_path / "i.json"), "a int")
    assert [(r["ingest_ord"], r["a"]) for r in ok.orderBy("ingest_ord").collect()] == [(0, 1), (1, 3)]
    assert [r["value"] for r in bad.collect()] == ['{"a": 2']


def test_malformed_laws_are_returned(spark, tmp_path):
    (tmp_path / "l.xml").write_text("<documento><metadatos><identificador>A</identificador></metadatos></documento>\n<documento><metadatos><identificador>B</metadatos></documento>\n")
    laws, _, _, bad = readers.read_gazette_xml(spark, str(tmp_path / "l.xml"), "lines")
    assert [r["law_id"] for r in laws.collect()] == ["A"] and bad.count() == 1


def test_summary_of_any_shape(spark):
    doc = lambda t: {"title": t, "linkDownloadDocumentPDF": f"x?documentId={len(t)}"}
    tree = {"numDOGC": "9", "dateDOGC": "01/02/2020", "title": "Top", "document": [doc("a")],
            "section": {"title": "S", "header": {"title": "H", "header": [{"title": "HH", "subheader": {"document": doc("deep")}}, {"subheader": [{"title": "U", "document": [doc("b"), doc("c")]}]}]}}}
    want = [("a", "Top", "Top"), ("deep", "HH", "Top"), ("b", "U", "Top"), ("c", "U", "Top")]
    for shape in (tree, {"sumaris": [tree, {}]}):
        df = spark.createDataFrame([(json.dumps(shape),), ("broken",), (json.dumps({"sumaris": []}),)], "j string")
        got = flatten.flatten_summary(df, F.col("j")).orderBy("pos").collect()
        assert [r["title"] for r in got] == [t for t, _, _ in want] and [r["organisme"] for r in got] == [o for _, o, _ in want]
        assert {r["dogc_number"] for r in got} == {"9"} and [r["section"] for r in got][0] == "Top"


def test_structured_dir_reports_bad_files(spark, tmp_path):
    for i, body in enumerate(['{"documentId": "1",\n "ca": {"title": "a"}}', "{broken", '{"documentId": "None"}', '{"ca": {"title": "b"}}']):
        (tmp_path / f"d{i}_structured.json").write_text(body)
    (tmp_path / "other.json").write_text('{"documentId": "9"}')
    ok, bad = readers.read_structured(spark, str(tmp_path), "documentId string, ca struct<title:string>")
    assert [r["documentId"] for r in ok.collect()] == ["1"] and bad.count() == 1


def test_xml_files_and_csv_mark(spark, tmp_path):
    (tmp_path / "l.xml").write_text('<?xml version="1.0"?>\n<documento>\n<metadatos><identificador>B1</identificador></metadatos>\n<texto>\n<p class="articulo">Art 1</p>\n<p>x</p></texto></documento>', encoding="utf-8")
    laws, paras, refs, _bad = readers.read_gazette_xml(spark, str(tmp_path / "*.xml"))
    assert laws.first()["law_id"] == "B1" and [(r["cls"], r["text"]) for r in paras.orderBy("ord").collect()] == [("articulo", "Art 1"), (None, "x")] and refs.count() == 1
    (tmp_path / "f.csv").write_bytes("﻿NOM_ENS,RESUM,ENLLAÇ,DATA_PUB,VIGENT\nGirona,a,https://x/a.pdf,1/2/2020,\n".encode())
    df = readers.read_open_data_csv(spark, str(tmp_path / "f.csv"), "NOM_ENS string, RESUM string, `ENLLAÇ` string, DATA_PUB string, VIGENT string")
    r = readers.conform_csv_feed(df.selectExpr("*", "0 AS ingest_ord")).first()
    assert (r["id"], r["url_pdf"], r["is_vigent"]) == ("bopg_ckan_1", "https://x/a.pdf", None)


def test_bulk_columns_are_the_sorted_key_union(spark):
    n = spark.createDataFrame([(1, ["A", "B"], {"z": "1"}), (2, ["A"], {"a": "2"})], "id int, labels array<string>, props map<string,string>")
    e = spark.createDataFrame([(1, 2, "X", {})], "src int, dst int, type string, props map<string,string>")
    nodes, edges = writers.to_bulk_csv(n, e)
    assert nodes.columns == ["id:ID", ":LABEL", "a", "z"] and tuple(nodes.orderBy("id:ID").first()) == (1, "A;B", "", "1") and edges.columns == [":START_ID", ":END_ID", ":TYPE"]


def test_refresh_is_idempotent(spark, tmp_path):
    b = str(tmp_path)
    d = spark.range(10).selectExpr("id", "cast(id as string) AS title")
    run = lambda ck: refresh.refresh_table(spark, f"{b}/feed", d.schema, f"{b}/table", f"{b}/{ck}", "id", "title")
    d.write.parquet(f"{b}/feed")
    assert run("c1").count() == 10
    assert run("c1").count() == 10
    assert run("c2").count() == 10  # a lost checkpoint replays everything and adds nothing


def test_refresh_work_follows_the_batch(spark, tmp_path):
    b = str(tmp_path)
    schema = "id bigint, title string, n int"
    d = lambda rows: spark.createDataFrame(rows, schema)
    run = lambda ck: {r["id"]: r["title"] for r in refresh.refresh_table(spark, f"{b}/feed", d([]).schema, f"{b}/table", f"{b}/{ck}", "id", "n").collect()}
    d([(i, f"first {i}", 1) for i in range(50)]).write.parquet(f"{b}/feed")
    first = run("c1")
    assert first == {i: f"first {i}" for i in range(50)}
    # known keys, new ones, and one that arrives three times
    d([(i, "again", 2) for i in range(40, 50)] + [(60, "later", 5), (60, "earliest", 3), (60, "last", 9), (None, "no id", 1)]).write.mode("append").parquet(f"{b}/feed")
    want = {**first, 60: "earliest", None: "no id"}
    assert run("c1") == want
    folders = sorted(x.name for x in (tmp_path / "table").iterdir() if x.is_dir())
    assert spark.read.parquet(f"{b}/table/{folders[-1]}").count() == 2 and len(folders) == 2
    # the last batch is lost after it was written: its folder is written again
    commits = sorted((x for x in (tmp_path / "c1" / "commits").iterdir() if x.name.isdigit()), key=lambda x: int(x.name))
    for f in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        f.unlink(missing_ok=True)
    assert run("c1") == want and spark.read.option("recursiveFileLookup", True).schema(schema).parquet(f"{b}/table").count() == 52
    # a lost checkpoint replays all deliveries, and starts from the keys of the table
    assert run("c2") == want and spark.read.option("recursiveFileLookup", True).schema(schema).parquet(f"{b}/table").count() == 52


def test_bulk_csv_files_encode_lists_and_objects(spark, tmp_path):
    n = spark.createDataFrame([(1, ["A", "B"], (["x, y", 'z"'], None, 5, None)), (2, ["A"], (None, {"k": "v"}, None, None))], "id int, labels array<string>, props struct<tags:array<string>,more:map<string,string>,n:int,unused:string>")
    e = spark.createDataFrame([(1, 2, "X", {"l": [1, 2]})], "src int, dst int, type string, props map<string,array<int>>")
    writers.write_bulk_csv(n, e, str(tmp_path))
    read = lambda name: [r.asDict() for r in spark.read.options(header=True, escape='"').csv(str(tmp_path / name)).collect()]
    assert sorted(read("nodes"), key=lambda r: r["id:ID"]) == [
        {"id:ID": "1", ":LABEL": "A;B", "more": None, "n": "5", "tags": json.dumps(["x, y", 'z"'], separators=(",", ":"))},
        {"id:ID": "2", ":LABEL": "A", "more": '{"k":"v"}', "n": None, "tags": None}]
    assert read("relationships") == [{":START_ID": "1", ":END_ID": "2", ":TYPE": "X", "l": "[1,2]"}]


def test_graph_load_joins_each_end_once(spark):
    n = spark.createDataFrame([("a", "X", "1", 1), ("a", "Y", "2", 2), ("b", "X", "3", 1), (None, "X", "4", 1)], "id string, label string, title string, ingest_ord int")
    e = spark.createDataFrame([("a", "b", "T", "old", 1), ("a", "b", "T", "new", 2), ("a", "c", "T", "", 1), (None, "b", "T", "", 1), ("b", None, "T", "", 1)], "src string, dst string, type string, details string, ingest_ord int")
    nodes, edges = writers.prepare_graph_load(n, e)
    assert edges._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2
    assert [tuple(r) for r in edges.select("src", "dst", "type", "details", "src_type", "dst_type").collect()] == [("a", "b", "T", "new", "Y", "X")]
    assert {(r["id"], r["label"]) for r in nodes.collect()} == {("a", "Y"), ("b", "X"), (None, "X")}
