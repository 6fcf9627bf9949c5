"""Counts and summaries."""

from lexloom.operators import audit


def test_build_summary_reads_a_table_once(spark):
    cites = spark.range(10).selectExpr("CASE WHEN id < 9 THEN id % 3 = 0 END AS is_mapped")
    edges = spark.createDataFrame([("a",), ("a",), (None,)], "type string")
    got = audit.build_summary({"documents": spark.range(3), "citations": cites, "edges": edges})
    # only the table without kinds is counted below
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1
    assert {(r["metric"], r["value"]) for r in got.collect()} == {("rows:documents", 3.0), ("rows:citations", 10.0), ("rows:edges", 3.0), ("citations:mapped", 3.0),
                                                                  ("citations:unmapped", 7.0), ("edge:a", 2.0), (None, 1.0)}
    none = audit.build_summary({"citations": cites.limit(0), "edges": edges.limit(0)})
    assert {(r["metric"], r["value"]) for r in none.collect()} == {("rows:citations", 0.0), ("rows:edges", 0.0)}
