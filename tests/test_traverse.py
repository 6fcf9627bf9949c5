"""Graph walks, components and budgets against plain Python."""

import random

from pyspark.sql import functions as F

from lexloom.operators import sample, traverse


def _graph(spark, seed=5, n=60, m=45):
    rnd = random.Random(seed)
    edges = [(f"s{rnd.randint(0, n - 1)}", f"s{rnd.randint(0, n - 1)}", "CITES") for _ in range(m)]
    return [f"s{i}" for i in range(n)], edges, spark.createDataFrame(edges, "src string, dst string, type string")


def _components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b, _ in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return {n: min(g) for g in groups.values() for n in g}


def test_components_with_a_hub_and_a_chain(spark):
    nodes, edges, df = _graph(spark)
    extra = [("s0", f"s{i}", "X") for i in range(1, 20)] + [(f"s{i}", f"s{i + 1}", "X") for i in range(40, 58)]
    df2 = df.unionByName(spark.createDataFrame(extra, df.schema))
    for d, e in ((df, edges), (df2, edges + extra)):
        got = {r["id"]: r["component"] for r in traverse.components(spark.createDataFrame([(n,) for n in nodes], "id string"), d).collect()}
        assert got == _components(nodes, e)


def test_budget_selection_is_the_sequential_greedy(spark):
    rnd = random.Random(6)
    stats = [(f"c{i:02d}", rnd.randint(100, 900), rnd.randint(0, 3)) for i in range(40)]
    docs = [(f"d{i}", rnd.randint(10, 400)) for i in range(25)]
    need = {(c, rnd.choice(docs)[0]) for c, _, _ in stats for _ in range(rnd.randint(0, 3))}
    cost = {d: n * 13 + 4000 for d, n in docs}  # tenths of a byte
    for target in (3000, 9000, 10**9):
        left, have, want = target * 10, set(), {}
        for c, size, cites in sorted(stats, key=lambda s: (-(s[2] > 0), -s[2], s[1], s[0])):
            new = {d for k, d in need if k == c} - have
            inc = size * 10 + cites * 2500 + sum(cost[d] for d in new)
            if inc <= left:
                left, have, want[c] = left - inc, have | new, inc / 10
        s = spark.createDataFrame(stats, "component string, size bigint, n_citations bigint").withColumns(
            {"has_citation": F.col("n_citations") > 0, "section_tenths": F.col("size") * 10, "fixed_tenths": F.col("size") * 10 + F.col("n_citations") * 2500})
        for limit in (1, 7, 1000):  # rows of a block
            got = traverse.select_components(s, spark.createDataFrame(sorted(need), "component string, document string"), spark.createDataFrame(docs, "document string, n_chars bigint"), target, limit)
            assert {r["component"]: r["bytes"] for r in got.collect()} == want


def test_budget_rounds_follow_blocks(spark, monkeypatch):
    """Many components that don't fit, in between: no round for each, and a document that all share is paid once."""
    n = 3000
    stats = spark.range(n).select(F.format_string("c%05d", "id").alias("component"), F.lit(True).alias("has_citation"), (F.lit(n) - F.col("id")).alias("n_citations"),
                                  F.lit(100).alias("section_tenths"), F.when(F.col("id") % 3 == 1, 60_000).otherwise(30).cast("long").alias("fixed_tenths"))
    need = stats.select("component", F.lit("hub").alias("document")).unionByName(stats.select("component", F.concat(F.lit("d"), F.substring("component", 2, 4)).alias("document")))
    docs = need.select("document").distinct().withColumn("n_chars", F.lit(10).cast("long"))
    blocks, greedy = [], traverse.global_scan
    monkeypatch.setattr(traverse, "global_scan", lambda *a, **k: blocks.append(1) or greedy(*a, **k))
    got = {r["component"]: r["bytes"] for r in traverse.select_components(stats, need, docs, 20_000, limit=2000).collect()}
    left, have, want = 200_000, set(), {}
    for i in range(n):
        new = {"hub", f"d{i // 10:04d}"} - have
        inc = (60_000 if i % 3 == 1 else 30) + len(new) * (10 * 13 + 4000)
        if inc <= left:
            left, have, want[f"c{i:05d}"] = left - inc, have | new, inc / 10
    assert got == want and len(blocks) == 1


def test_bfs_levels_and_limits(spark):
    e = spark.createDataFrame([("a", "b", "X"), ("c", "a", "X"), ("b", "d", "X"), ("d", "e", "X"), ("x", "y", "X")], "src string, dst string, type string")
    start = spark.createDataFrame([("a",)], "id string")
    lv = lambda k: {r["id"]: r["level"] for r in traverse.bfs(e, start, k).collect()}
    assert lv(99) == {"a": 0, "b": 1, "c": 1, "d": 2, "e": 3} and lv(2) == {"a": 0, "b": 1}
    info = spark.createDataFrame([("a", False, 10), ("b", False, 10), ("c", True, 10), ("d", True, 10), ("e", True, 10)], "id string, is_section boolean, n_bytes bigint")
    sized = lambda b, m: [r["id"] for r in traverse.bfs_sized(e, start, info, b, m).orderBy("level", F.col("is_section").desc(), "id").collect()]
    assert sized(20, 99) == ["a", "c"] and sized(1000, 3) == ["a", "c", "b"] and sized(1000, 99) == ["a", "c", "b", "d", "e"]


def test_small_levels_read_the_edges_where_they_are(spark, monkeypatch):
    """A walk of few nodes collects no neighbours of others; a larger one does and finds the same."""
    edges = [(f"n{i}", f"n{(i * 3 + 1) % 50}", "X") for i in range(50)] + [("n1", "n1", "X"), (None, "n3", "X"), ("n3", None, "X")]
    edges = spark.createDataFrame(edges + edges[:9], "src string, dst string, type string")
    start = spark.createDataFrame([("n1",), ("n2",)], "id string")
    info = spark.createDataFrame([(f"n{i}", i % 3 == 0, 10 + i) for i in [*range(50), 4]], "id string, is_section boolean, n_bytes bigint")
    made, adjacency = [], traverse.adjacency
    monkeypatch.setattr(traverse, "adjacency", lambda *a: made.append(1) or adjacency(*a))
    seen = []
    for small in (traverse.SMALL, 0):
        monkeypatch.setattr(traverse, "SMALL", small)
        walks = [traverse.bfs(edges, start, k) for k in (9, 99)]
        assert len(made) == (2 if small == 0 else 0)
        seen.append([sorted(map(tuple, w.collect())) for w in [*walks, *[traverse.bfs_sized(edges, start, info, b, 99) for b in (300, 10_000)]]])
    assert seen[0] == seen[1] and len(made) == 2 and [len(w) for w in seen[0]][0] == 9


def test_a_level_moves_its_frontier_only(spark, monkeypatch):
    monkeypatch.setattr(traverse, "NEIGHBOURS", 10)
    edges = spark.createDataFrame([("hub", f"n{i:03d}", "X") for i in range(100)] + [(f"n{i:03d}", f"m{i:03d}", "X") for i in range(100)] + [("a", "a", "X")], "src string, dst string, type string")
    adj = traverse.adjacency(edges)
    rows = [(r["u"], v) for r in adj.collect() for v in r["vs"]]
    assert sorted(rows) == sorted(tuple(r) for r in traverse.both_ways(edges).collect()) and adj.filter("u = 'hub'").count() >= 8
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        visited = spark.createDataFrame([("hub", 0)], "id string, level int")
        level = traverse._next_level(adj, visited, 0)
        plan = level._jdf.queryExecution().executedPlan().toString()
        # exchanges: the frontier by u, then ids found and ids visited; none over the scan of the adjacency
        below = plan[plan.index("LeftSemi"):plan.index("Bucketed: true")]
        assert "Exchange" not in below.split("FileScan")[0] and level.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_quota_sample_keeps_quotas_and_caps(spark):
    rnd = random.Random(7)
    rows = [(i, "normatives-locals" if i % 3 == 0 else "subvencions", rnd.random() < .4, f"inst{rnd.randint(0, 150)}", 2000 + i % 6, rnd.choice(["BOPB", "TA"])) for i in range(2000)]
    df = spark.createDataFrame(rows, "unit_id int, type string, appears_in_dogc boolean, institucio string, year int, butlleti string")
    got = sample.quota_sample(df).collect()
    n = lambda b, g: sum(r["bucket"] == b and r["in_gazette"] == g for r in got)
    assert (n("normative", True), n("normative", False), n("non_normative", True), n("non_normative", False)) == (9, 21, 21, 49)
    per = {}
    for r in got:
        k = (r["bucket"], r["in_gazette"], r["institucio"])
        per[k] = per.get(k, 0) + 1
    assert max(per.values()) <= 2 and len({r["year"] for r in got}) == 6
    few = df.filter("unit_id < 30").withColumn("institucio", F.lit("same"))
    # the caps leave buckets short, so the rest tops them up
    assert sample.quota_sample(few).count() == min(30, sample.quota_sample(few).count()) and sample.quota_sample(few).filter("bucket = 'normative'").count() == few.filter("type = 'normatives-locals'").count()
