"""Walks, components and subgraphs. Iterative jobs write each round to reliable checkpoints."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from lexloom import rules
from lexloom.operators.match import induced_edges, parent_document
from lexloom.operators.ordered import global_scan, split_row_number
from lexloom.session import cut, scratch_path, stored


def seeds(nodes, edges):
    """GRF1: smallest node of every label, and both ends of one edge of every type.

    nodes: id, labels (array).
    """
    a = nodes.select("id", F.explode("labels").alias("label")).groupBy("label").agg(F.min("id").alias("id")).select("id")
    e = edges.groupBy("type").agg(F.min(F.struct("src", "dst")).alias("e")).select(F.explode(F.array("e.src", "e.dst")).alias("id"))
    return a.union(e).distinct()


def _pairs(edges):
    pair = lambda a, b: F.struct(F.col(a).alias("u"), F.col(b).alias("v"))
    return edges.select(F.inline(F.array(pair("src", "dst"), pair("dst", "src")))).filter("u <> v")


def both_ways(edges):
    """Undirected adjacency, one pass over the edges."""
    return _pairs(edges).distinct()


NEIGHBOURS = 4096  # of a node in a row, about


def adjacency(edges, buckets=None):
    """Undirected neighbours in compact rows: u, vs. A hub's are split over several rows.

    The rows are a table in hash buckets of ``u``, as many as there are shuffle partitions, so a
    join on ``u`` reads them where they are: a level of a walk moves its frontier, not the edges.
    """
    spark = edges.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = stored(both_ways(edges), "pairs")
    parts = pairs.groupBy("u").agg(F.ceil(F.count(F.lit(1)) / NEIGHBOURS).alias("_parts"))
    rows = pairs.join(parts, "u").groupBy("u", F.pmod(F.xxhash64("v"), F.col("_parts")).alias("_part")).agg(F.sort_array(F.collect_list("v")).alias("vs"))
    path = scratch_path(spark, "adjacency")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    rows.select("u", "vs").repartition(buckets, "u").write.bucketBy(buckets, "u").sortBy("u").option("path", path).saveAsTable(name)
    return spark.table(name)


def _next_level(adj, visited, level):
    frontier = visited.filter(F.col("level") == level).select(F.col("id").alias("u"))
    return adj.join(frontier, "u", "left_semi").select(F.explode("vs").alias("id")).distinct().join(visited.select("id"), "id", "left_anti")


SMALL = 100_000  # ids that every task is handed, at most


def _handed(df, n):
    """``df`` of ``n`` rows for a join: with few rows it goes to the other side, which then isn't moved."""
    return F.broadcast(df) if n <= SMALL else df


def bfs(edges, start, limit):
    """GRF2: nodes reached from the seeds, level by level, until ``limit`` nodes.

    The last level is cut in id order. A level of few nodes reads the edges where they are; the
    first that is larger has their neighbours collected.
    """
    edges, adj = stored(edges.select("src", "dst"), "edges"), None
    visited = cut(start.select("id").distinct().withColumn("level", F.lit(0)))
    n, level = visited.count(), 0
    last = n
    while n < limit:
        if last <= SMALL:
            frontier = visited.filter(F.col("level") == level).select(F.col("id").alias("u"))
            found = _pairs(edges).join(F.broadcast(frontier), "u", "left_semi").select(F.col("v").alias("id")).distinct().join(visited.select("id"), "id", "left_anti")
        else:
            adj = adjacency(edges) if adj is None else adj
            found = _next_level(adj, visited, level)
        found = cut(found)
        k = found.count()
        if k == 0:
            break
        if n + k > limit:
            found = found.orderBy("id").limit(limit - n)
        level += 1
        visited = cut(visited.unionByName(found.withColumn("level", F.lit(level))))
        last = min(k, limit - n)
        n += last
    return visited


def bfs_sized(edges, start, nodes, target_bytes, max_nodes, edge_bytes=None):
    """GRF3: as ``bfs``, sections first inside a level, until the serialised size of the
    collected nodes and of the edges between them reaches the target or the node cap is met.

    nodes: id, is_section, n_bytes. An edge counts with the later of its ends; its size is
    that of its JSON text unless ``edge_bytes`` gives it. A level reads the edges once, for
    those at its nodes, which are all that its sizes and the next level's search need.
    """
    size_of = edge_bytes if edge_bytes is not None else F.length(F.to_json(F.struct("src", "dst", "type"))).cast("long")
    sized = stored(edges.select("src", "dst", size_of.alias("_bytes")), "edges")
    cols = ["id", "is_section", "n_bytes"]
    info = nodes.select(*cols)

    def at(ids, n):
        """Edges with an end among ids."""
        end = lambda c: _handed(ids.select(F.col("id").alias(c), F.lit(True).alias(f"_{c}")).distinct(), n)
        return stored(sized.join(end("src"), "src", "left").join(end("dst"), "dst", "left").filter("_src OR _dst").select("src", "dst", "_bytes"), "edges-at")

    def with_edges(place, n):
        """Bytes of the edges that each place (1, 2, ...) closes; place 0 holds what is settled."""
        end = lambda c, p: _handed(place.select(F.col("id").alias(c), F.col("_place").alias(p)), n)
        e = near.join(end("src", "_a"), "src").join(end("dst", "_b"), "dst")
        return e.groupBy(F.greatest("_a", "_b").alias("_place")).agg(F.sum("_bytes").alias("_edges"))

    first = cut(start.select("id").distinct())
    visited = cut(info.join(_handed(first, first.count()), "id", "left_semi").withColumn("level", F.lit(0)))
    settled = visited.select("id", F.lit(0).cast("long").alias("_place"))
    n, size = visited.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    near = at(visited, n)
    size += with_edges(settled, n).agg(F.coalesce(F.sum("_edges"), F.lit(0))).first()[0]
    level, last = 0, n
    while n < max_nodes and size < target_bytes:
        frontier = visited.filter(F.col("level") == level).select(F.col("id").alias("u"))
        found = cut(_pairs(near).join(_handed(frontier, last), "u", "left_semi").select(F.col("v").alias("id")).distinct().join(_handed(visited.select("id"), n), "id", "left_anti"))
        found = info.join(_handed(found, found.count()), "id", "left_semi")
        ranked = cut(global_scan(found, [F.col("is_section").desc(), F.col("id")], {}, "_place"))
        many = ranked.count()
        near = at(ranked, many)
        closed = with_edges(settled.unionByName(ranked.select("id", "_place")), n + many)
        ranked = ranked.join(closed, "_place", "left").withColumn("_all", F.col("n_bytes") + F.coalesce("_edges", F.lit(0)))
        ranked = global_scan(ranked, [F.col("_place")], {"cum": "_all"})
        # a node is still added while the size before it is under the target
        ranked = cut(ranked.filter((F.col("rank") <= max_nodes - n) & (F.col("cum") - F.col("_all") + size < target_bytes)))
        k, more = ranked.agg(F.count(F.lit(1)), F.coalesce(F.sum("_all"), F.lit(0))).first()
        if k == 0:
            break
        level, last = level + 1, k
        visited = cut(visited.unionByName(ranked.select(*cols).withColumn("level", F.lit(level))))
        settled = visited.select("id", F.lit(0).cast("long").alias("_place"))
        n, size = n + k, size + more
    return visited


def subgraph(nodes, edges, chosen, skip_types=()):
    """GRF4: chosen nodes and the edges with both ends among them."""
    kept = nodes.join(chosen.select("id").distinct(), "id", "left_semi")
    e = edges.filter(~F.col("type").isin(list(skip_types))) if skip_types else edges
    return kept, induced_edges(e, kept)


def _fingerprint(pairs):
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def roots(edges):
    """Smallest member of its component for every end of an edge (src, dst) that isn't it: id, component.

    Ends that aren't numbers are numbered first, in any order, so that the rounds move numbers;
    the smallest member of each component is looked up at the end.
    """
    if isinstance(edges.schema["src"].dataType, (LongType, IntegerType)):
        return _number_roots(edges)
    edges = stored(edges.filter("src <> dst").select("src", "dst"), "edges")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    ends = stored(ends.select("id", F.monotonically_increasing_id().alias("n")), "ends")
    end = lambda c, n: ends.select(F.col("id").alias(c), F.col("n").alias(n))
    found = _number_roots(edges.join(end("src", "a"), "src").join(end("dst", "b"), "dst").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    found = ends.join(found.select(F.col("id").alias("n"), "component"), "n", "left").select("id", F.coalesce("component", "n").alias("_root"))
    least = found.groupBy("_root").agg(F.min("id").alias("component"))
    return found.join(least, "_root").filter("id <> component").select("id", "component")


def _number_roots(edges):
    """``roots`` of ends that are numbers.

    Alternating large-star and small-star rounds: each is a minimum per node joined back on
    a unique key, so a hub with a third of the edges is one aggregate row on that side.
    """
    pairs = stored(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct(), "pairs")
    mark = _fingerprint(pairs)
    while mark[0]:
        both = pairs.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.inline(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))).filter("a <> b").distinct()
        pairs = stored(small, "pairs")
        now = _fingerprint(pairs)
        if now == mark:
            break
        mark = now
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))


def components(nodes, edges, ident="id"):
    """GRF5: component of every node (its smallest member); lone nodes included."""
    found = roots(induced_edges(edges.select("src", "dst"), nodes, ident)).select(F.col("id").alias(ident), F.col("component").alias("_c"))
    return nodes.select(F.col(ident)).distinct().join(found, ident, "left").select(ident, F.coalesce("_c", ident).alias("component"))


def topology(nodes, edges):
    """GRF9: section and document sizes, section-section and section-document edges.

    nodes: id, label, n_chars. Document-to-section edges count unless structural.
    """
    sec = nodes.filter("label = 'DocumentSection'").select("id", "n_chars")
    doc = nodes.filter("label = 'Document'").select("id", "n_chars")
    kind = nodes.select(F.col("id").alias("_i"), "label")
    e = (edges.select("src", "dst", "type").join(kind.withColumnRenamed("label", "sl"), F.col("src") == F.col("_i")).drop("_i")
         .join(kind.withColumnRenamed("label", "dl"), F.col("dst") == F.col("_i")).drop("_i"))
    e = stored(e.filter("sl = 'DocumentSection' OR (dl = 'DocumentSection' AND type <> 'HAS_SECTION')"), "topology")
    s2s = e.filter("sl = 'DocumentSection' AND dl = 'DocumentSection'").select("src", "dst", "type")
    s2d = e.filter("sl = 'DocumentSection' AND dl = 'Document'").select(F.col("src").alias("section"), F.col("dst").alias("document"), "type").unionByName(
        e.filter("sl = 'Document' AND dl = 'DocumentSection' AND type <> 'HAS_SECTION'").select(F.col("dst").alias("section"), F.col("src").alias("document"), "type"))
    return sec, doc, s2s, s2d


def component_stats(sec, s2s, s2d, comp):
    """Size, edge count and citation count of each component. comp: id, component.

    Sizes are exact integers in tenths of a byte.
    """
    per, fixed = rules.SECTION_BYTES
    size = sec.join(comp, "id").groupBy("component").agg(F.sum(F.col("n_chars") * round(per * 10) + fixed * 10).alias("section_tenths"))
    c = lambda k: comp.select(F.col("id").alias(k), "component")
    rel = (s2d.join(c("section"), "section").select("component", (F.col("type") != "HAS_SECTION").cast("int").alias("cites"))
           .unionByName(s2s.join(c("src"), "src").select("component", F.lit(1).alias("cites"))))
    rel = rel.groupBy("component").agg(F.count(F.lit(1)).alias("n_edges"), F.sum("cites").alias("n_citations"))
    s = size.join(rel, "component", "left").fillna(0, ["n_edges", "n_citations"])
    return s.withColumns({"has_citation": F.col("n_citations") > 0, "fixed_tenths": F.col("section_tenths") + F.col("n_edges") * rules.EDGE_BYTES * 10})


GREEDY_ROWS = 500_000  # components and shared documents that one task decides


def _greedy(batches, budget):
    """The components taken, of rows sorted by rank: first the component (document NULL), then the documents it shares."""
    paid, new, now, out = set(), set(), None, []

    def settle():
        nonlocal budget
        if now and now[2] <= budget:
            budget -= now[2]
            paid.update(new)
            out.append(now)

    schema = None
    for b in batches:
        schema = b.schema
        for rank, component, document, tenths in zip(*(b.column(c).to_pylist() for c in ("rank", "component", "document", "tenths"))):
            if now is None or rank != now[1]:
                settle()
                now, new = (component, rank, tenths), set()
            elif document not in paid:
                now = (component, rank, now[2] + tenths)
                new.add(document)
    settle()
    if out:
        names = ["component", "rank", "tenths"]
        yield pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*out))], names=names)


def select_components(stats, comp_docs, docs, target_bytes, limit=GREEDY_ROWS):
    """GRF6: components in order of (cites, citations, smaller), each taken whole if it
    fits what is left of the byte budget; a document is paid for once.

    A component's own part is what its sections, edges and the documents that no other needs
    cost. Components whose own part exceeds the rest are dropped in bulk at any time, as the
    rest only shrinks. The others come in blocks of the order with at most ``limit`` rows: a
    row for a component and for each unpaid document that it shares. One task decides a block
    in order, which equals the sequential greedy. Rounds are bounded by the rows over ``limit``.

    comp_docs: component, document (distinct). docs: document, n_chars.
    """
    per, fixed = rules.DOCUMENT_BYTES
    cost = docs.select("document", (F.col("n_chars") * round(per * 10) + fixed * 10).alias("doc_tenths"))
    need = cut(comp_docs.join(cost, "document"))
    users = need.groupBy("document").agg(F.count(F.lit(1)).alias("_users"))
    need = need.join(users, "document")
    own = need.filter("_users = 1").groupBy("component").agg(F.sum("doc_tenths").alias("_own"))
    shared = cut(need.filter("_users > 1").select("component", "document", "doc_tenths"))
    comps = stats.join(own, "component", "left").join(shared.groupBy("component").agg(F.count(F.lit(1)).alias("_n")), "component", "left")
    comps = comps.withColumns({"least": F.col("fixed_tenths") + F.coalesce("_own", F.lit(0)), "rows": F.lit(1) + F.coalesce("_n", F.lit(0))})
    order = [F.col("has_citation").desc(), F.col("n_citations").desc(), F.col("section_tenths"), F.col("component")]
    ranked = cut(global_scan(comps, order, {"cum": "rows"}, "rank").select("component", "rank", F.col("least").cast("long").alias("least"), "rows", "cum"))
    budget, last = target_bytes * 10, 0
    chosen = ranked.select("component", "rank", F.col("least").alias("tenths")).limit(0)
    while True:
        left = ranked.filter((F.col("rank") > last) & (F.col("least") <= budget))
        start = left.agg(F.min(F.struct("rank", "cum", "rows")).alias("x")).first()["x"]
        if start is None:
            return chosen.select("component", "rank", (F.col("tenths") / 10).alias("bytes"))
        block = left.filter((F.col("cum") <= start["cum"] - start["rows"] + limit) | (F.col("rank") == start["rank"]))
        last = block.agg(F.max("rank")).first()[0]
        rows = block.select("rank", "component", F.lit(None).cast(shared.schema["document"].dataType).alias("document"), F.col("least").alias("tenths")).unionByName(
            shared.join(block.select("component", "rank"), "component").select("rank", "component", "document", F.col("doc_tenths").cast("long").alias("tenths")))
        one = rows.repartition(1).sortWithinPartitions("rank", F.col("document").asc_nulls_first())
        taken = cut(one.mapInArrow(lambda batches, rest=budget: _greedy(batches, rest), chosen.schema))
        budget -= taken.agg(F.coalesce(F.sum("tenths"), F.lit(0))).first()[0]
        paid = shared.join(taken.select("component"), "component", "left_semi").select("document").distinct()
        shared = cut(shared.join(paid, "document", "left_anti"))
        chosen = chosen.unionByName(taken)


def neighbourhood(ids, nodes, edges):
    """GRF7: edges in and out of chosen nodes by group, with the other end's title and
    parent document, one row per edge."""
    group = (F.when(F.col("type") == "CITES", "citation").when(F.col("type").isin(rules.AFFECTATION_TYPES), "affectation")
             .when(F.col("type").isin(rules.STRUCTURAL_TYPES), "structural").when(F.col("type").isin(rules.TOPIC_TYPES), "topic").otherwise("other"))
    want = ids.select("id").distinct()
    side = lambda d, me, other: edges.join(want, F.col(me) == F.col("id"), "left_semi").select(F.col(me).alias("id"), F.lit(d).alias("direction"), F.col(other).alias("other"), "type")
    e = side("out", "src", "dst").unionByName(side("in", "dst", "src")).withColumn("edge_group", group)
    par = parent_document(nodes, edges).select(F.col("id").alias("other"), F.col("parent_id").alias("other_parent"))
    return e.join(nodes.select(F.col("id").alias("other"), F.col("title").alias("other_title")), "other", "left").join(par, "other", "left")


def section_map(edges):
    """GRF8: sections of each document in order, one row per section."""
    e = edges.filter("type = 'HAS_SECTION'").select(F.col("src").alias("document_id"), F.col("dst").alias("section_id"), F.col("order"))
    return split_row_number(e, ["document_id"], [F.floor(F.col("order") / 4096)], ["order", "section_id"], "position")
