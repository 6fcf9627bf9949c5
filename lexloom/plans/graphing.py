"""Graph, traversal and refresh queries."""

from pyspark.sql import functions as F


from lexloom.operators import flatten, graph, reconcile, segment, traverse
from lexloom.plans.flattening import structured_docs
from lexloom.plans.matching import resolved_pubs
from lexloom.plans.registry import query
from lexloom.session import scratch_path, stored
from lexloom.streaming import refresh

ELI = "concat('eli/es-cat/doc/', split_part(date_dogc,'/',3), '/', split_part(date_dogc,'/',2), '/', split_part(date_dogc,'/',1), '/', CAST(document_id AS VARCHAR))"
MODULE = "CASE type WHEN 'normatives-locals' THEN 'cido-norm' WHEN 'subvencions' THEN 'cido-subv' WHEN 'contractacions' THEN 'cido-cont' WHEN 'oposicions' THEN 'cido-opos' ELSE 'cido-conv' END"


# ---- nodes ------------------------------------------------------------------------------------
@query("nod1_issue_nodes", """SELECT dogc_number, arg_min(date_dogc, ingest_ord) AS date_dogc, CAST(arg_min(year, ingest_ord) FILTER (WHERE ingest_ord % 3 <> 0) AS VARCHAR) AS year FROM legal_docs GROUP BY 1""")
def _(t):
    d = t.legal_docs.withColumn("year", F.when(F.col("ingest_ord") % 3 != 0, F.col("year")))
    return graph.issue_nodes(d).select("dogc_number", "date_dogc", F.nullif("year", F.lit("")).alias("year"))


@query("nod2_document_nodes", f"""SELECT document_id, title, coalesce(type, split_part(title, ' ', 1)) AS type_of_law, CASE WHEN section = '' THEN 'Unknown' ELSE section END AS section, concat(upper(split_part(title, ' ', 1)[1]), lower(split_part(title, ' ', 1)[2:])) AS label, {ELI} AS eli_id, document_id % 6 = 0 AS is_bilingual FROM legal_docs""")
def _(t):
    d = t.legal_docs.withColumn("title_es", F.when(F.col("document_id") % 6 == 0, F.concat(F.lit("es "), "title")).otherwise(""))
    return graph.document_nodes(d).select("document_id", "title", "type_of_law", "section", "label", "eli_id", "is_bilingual")


@query("nod3_record_nodes", f"""SELECT record_id, concat('eli/es-cat/', {MODULE}, '/', replace(date, '-', '/'), '/', CAST(record_id AS VARCHAR)) AS eli_id, CASE type WHEN 'normatives-locals' THEN 'NormativesLocals' ELSE concat(upper(type[1]), type[2:]) END AS label, coalesce(es_vigent, TRUE) AS es_vigent, url_record AS url FROM records""")
def _(t):
    return graph.record_nodes(t.records).select("record_id", "eli_id", "label", "es_vigent", "url")


def topic_sources(t):
    """Topics of documents and of local records."""
    docs = flatten.descriptors(structured_docs(t)).withColumn("ord", F.struct("document_id", "pos"))
    recs = t.records.select("record_id", F.concat(F.lit("t"), (F.col("record_id") % 12).cast("string")).alias("descriptor_id"), F.col("type").alias("name"), F.lit("Local").alias("type"),
                            F.struct(F.col("record_id").alias("document_id"), F.lit(0).alias("pos")).alias("ord"))
    return docs, recs


@query("nod4_descriptor_nodes", """WITH a AS (SELECT document_id AS o, dogc_number AS id, organisme AS name, 'Organism' AS type, 0 AS s FROM legal_docs UNION ALL SELECT document_id, concat('t', CAST(document_id % 9 AS VARCHAR)), type, 'Thematic', 0 FROM legal_docs WHERE type IS NOT NULL
 UNION ALL SELECT record_id, concat('t', CAST(record_id % 12 AS VARCHAR)), type, 'Local', 1 FROM records)
SELECT id AS descriptor_id, concat('eli/es-cat/materia/', id) AS eli_id, arg_min(name, (s, o)) AS name, arg_min(concat(type, 'Descriptor'), (s, o)) AS label FROM a GROUP BY id""")
def _(t):
    return graph.descriptor_nodes(*topic_sources(t)).select("descriptor_id", "eli_id", "name", "label")


@query("nod5_section_nodes", """SELECT section_id, CASE WHEN type = 'article' THEN 'Article' ELSE 'Annex' END AS type, CASE WHEN type = 'article' THEN 'Article' END AS label, title, text, CASE WHEN ord % 3 = 0 THEN '' ELSE concat('es ', text) END AS text_es, ord % 3 <> 0 AS is_bilingual,
 CASE WHEN heading = '' THEN title ELSE concat(title, ' - ', heading) END AS full_title, CASE WHEN type = 'article' THEN CAST(ord AS VARCHAR) END AS article_number FROM legal_sections""")
def _(t):
    es = t.legal_sections.filter("ord % 3 <> 0").withColumn("text", F.concat(F.lit("es "), "text"))
    n = graph.section_nodes(segment.align_sections(t.legal_sections, es))
    return n.select("section_id", "type", "label", "title", "text", "text_es", "is_bilingual", "full_title", "article_number")


# ---- edges --------------------------------------------------------------------------------------
@query("edg1_published_in", "SELECT document_id AS src, dogc_number AS dst, CASE WHEN section = '' THEN 'Unknown' ELSE section END AS section FROM legal_docs")
def _(t):
    return graph.published_in(t.legal_docs).select("src", "dst", "section")


@query("edg1_contains", f"""SELECT concat('eli/es-cat/dogc/', split_part(date_dogc,'/',3), '/', split_part(date_dogc,'/',2), '/', split_part(date_dogc,'/',1), '/', dogc_number) AS src, {ELI} AS dst, CASE WHEN section = '' THEN 'Disposicions generals' ELSE section END AS macrosection, NULL AS butlleti, NULL AS fase, NULL AS num_butlleti, NULL AS data_publicacio, NULL AS all_sources, NULL AS is_multi_source, NULL AS is_url_active, NULL AS url_status FROM legal_docs
UNION ALL SELECT concat('eli/es-cat/', {MODULE.replace('type', 'p.type')}, '/', replace(r.date, '-', '/'), '/', CAST(p.record_id AS VARCHAR)), coalesce({ELI.replace('document_id', 'd.document_id')}, concat('eli/es-cat/doc/local/', CAST(p.record_id AS VARCHAR), '/', CAST(p.pos AS VARCHAR))), NULL, coalesce(p.butlleti, ''), coalesce(p.fase, ''), 0, coalesce(p.data_publicacio, ''), coalesce(p.butlleti, ''), FALSE, TRUE, 'active'
 FROM publications p JOIN records r USING (record_id) LEFT JOIN legal_docs d ON CAST(d.document_id AS VARCHAR) = nullif(regexp_extract(coalesce(p.url_pdf, ''), 'documentId=(\\d+)', 1), '')""".replace("concat('eli/es-cat/doc/', split_part(date_dogc,'/',3), '/', split_part(date_dogc,'/',2), '/', split_part(date_dogc,'/',1), '/', CAST(d.document_id AS VARCHAR))", "CASE WHEN d.document_id IS NOT NULL THEN concat('eli/es-cat/doc/', split_part(d.date_dogc,'/',3), '/', split_part(d.date_dogc,'/',2), '/', split_part(d.date_dogc,'/',1), '/', CAST(d.document_id AS VARCHAR)) END"))
def _(t):
    return graph.contains_edges(t.legal_docs, resolved_pubs(t)).select("src", "dst", "macrosection", "butlleti", "fase", "num_butlleti", "data_publicacio", F.array_join("all_sources", ",").alias("all_sources"), "is_multi_source", "is_url_active", "url_status")


@query("nod2_local_documents", """SELECT concat('cido_doc_', CAST(p.record_id AS VARCHAR), '_', CAST(p.pos AS VARCHAR)) AS document_id, concat('eli/es-cat/doc/local/', CAST(p.record_id AS VARCHAR), '/', CAST(p.pos AS VARCHAR)) AS eli_id, p.descripcio AS title, p.data_publicacio AS date,
 coalesce(p.url_pdf, r.url_record) AS url, coalesce(p.url_pdf, '') AS pdf_url, 'LocalBulletin' AS label, coalesce(p.butlleti, '') AS butlleti FROM publications p JOIN records r USING (record_id)
 LEFT JOIN legal_docs d ON CAST(d.document_id AS VARCHAR) = nullif(regexp_extract(coalesce(p.url_pdf, ''), 'documentId=(\\d+)', 1), '') WHERE d.document_id IS NULL""")
def _(t):
    pubs = resolved_pubs(t).drop("url_record").join(t.records.select("record_id", "url_record"), "record_id")
    return graph.local_document_nodes(t.legal_docs, pubs).select("document_id", "eli_id", "title", "date", "url", "pdf_url", "label", "butlleti")


@query("edg2_has_section", """SELECT document_id AS src, section_id AS dst, ord - 1 AS "order" FROM legal_sections""")
def _(t):
    return graph.has_section(t.legal_sections).select("src", "dst", "order")


@query("edg3_topic_edges", """SELECT CAST(document_id AS VARCHAR) AS src, concat('eli/es-cat/materia/', dogc_number) AS dst, 'organism' AS category FROM legal_docs UNION ALL SELECT CAST(document_id AS VARCHAR), concat('eli/es-cat/materia/t', CAST(document_id % 9 AS VARCHAR)), 'thematic' FROM legal_docs WHERE type IS NOT NULL
UNION ALL SELECT CAST(record_id AS VARCHAR), concat('eli/es-cat/materia/t', CAST(record_id % 12 AS VARCHAR)), 'local' FROM records""")
def _(t):
    docs, recs = topic_sources(t)
    a = graph.topic_edges(docs, "document_id").withColumn("src", F.col("src").cast("string"))
    return a.unionByName(graph.topic_edges(recs, "record_id").withColumn("src", F.col("src").cast("string"))).select("src", "dst", "category")


@query("edg4_metadata_affectations", f"""WITH e AS (SELECT document_id AS id, {ELI} AS eli FROM legal_docs) SELECT s.eli AS src, coalesce(d.eli, concat('eli/es-cat/doc/0000/00/00/', CAST(a.target_document_id AS VARCHAR))) AS dst, 'CITES' AS type, a.text AS raw_text
FROM legal_affs a JOIN e s ON s.id = a.document_id LEFT JOIN e d ON d.id = a.target_document_id""")
def _(t):
    return graph.metadata_edges(t.legal_affs, t.legal_docs).select("src", "dst", "type", "raw_text")


def catalogue(t):
    return t.graph_nodes.select("id", "label", "title", F.when(F.col("label") == "DocumentSection", F.concat(F.lit("d"), F.col("document_id").cast("string"))).alias("parent_id"))


@query("edg5_materialise_nodes", """WITH g AS (SELECT * FROM graph_nodes WHERE document_id % 3 = 0 AND label = 'Document'), w AS (SELECT * FROM graph_nodes WHERE label = 'DocumentSection' AND document_id % 5 = 0)
SELECT id, label FROM w UNION SELECT concat('d', CAST(document_id AS VARCHAR)), 'Document' FROM w WHERE concat('d', CAST(document_id AS VARCHAR)) NOT IN (SELECT id FROM g)""")
def _(t):
    g = t.graph_nodes.filter("document_id % 3 = 0 AND label = 'Document'").select("id")
    w = t.graph_nodes.filter("label = 'DocumentSection' AND document_id % 5 = 0").select("id")
    return graph.import_nodes(w, g, catalogue(t))[0].select("id", "label")


@query("edg5_materialise_edges", """SELECT concat('d', CAST(document_id AS VARCHAR)) AS src, id AS dst FROM graph_nodes WHERE label = 'DocumentSection' AND document_id % 5 = 0""")
def _(t):
    g = t.graph_nodes.filter("document_id % 3 = 0 AND label = 'Document'").select("id")
    w = t.graph_nodes.filter("label = 'DocumentSection' AND document_id % 5 = 0").select("id")
    return graph.import_nodes(w, g, catalogue(t))[1].select("src", "dst")


@query("edg6_create_targets", """WITH u AS (SELECT *, CASE WHEN document_number <> '' THEN concat('num:', document_number) WHEN cited_title <> '' THEN concat('title:', lower(replace(cited_title, ',', ''))) WHEN dogc_number <> '' THEN concat('gaz:', dogc_number) END AS k FROM items),
f AS (SELECT k, min(source_id * 1000 + item_no) AS o, arg_min(doc_type, source_id * 1000 + item_no) AS type_of_law FROM u WHERE k IS NOT NULL GROUP BY k)
SELECT k AS entity_key, type_of_law, row_number() OVER (ORDER BY o) + (SELECT max(document_id) FROM legal_docs) AS id FROM f""")
def _(t):
    i = t.items.withColumn("eli_uri", F.lit(""))
    i = i.select(graph.entity_key_of("document_number", "cited_title", "eli_uri", "dogc_number").alias("entity_key"), F.col("cited_title").alias("title"), "document_number", "eli_uri", "dogc_number", "doc_type", "year",
                 (F.col("source_id") * 1000 + F.col("item_no")).alias("o"))
    new = graph.create_targets(i, None, ["o"], t.legal_docs.agg(F.max("document_id").alias("m")))
    return new.select("entity_key", "type_of_law", "id")


# ---- traversal ------------------------------------------------------------------------------------
def labelled(t):
    return t.graph_nodes.select("id", F.array_compact(F.array("label", "extra_label")).alias("labels"))


@query("grf1_seed_nodes", """WITH l AS (SELECT id, unnest([label, extra_label]) AS l FROM graph_nodes), m AS (SELECT l, min(id) AS id FROM l WHERE l IS NOT NULL GROUP BY l), e AS (SELECT type, min((src, dst)) AS e FROM graph_edges GROUP BY 1)
SELECT id FROM m UNION SELECT e[1] FROM e UNION SELECT e[2] FROM e""")
def _(t):
    return traverse.seeds(labelled(t), t.graph_edges)


SQL_BFS = """WITH RECURSIVE adj AS (SELECT src AS u, dst AS v FROM graph_edges UNION SELECT dst, src FROM graph_edges),
r(id, level) USING KEY (id) AS (SELECT id, 0 FROM graph_nodes WHERE document_id = 1 AND label = 'Document'
  UNION SELECT a.v, min(r.level) + 1 FROM r JOIN adj a ON a.u = r.id LEFT JOIN recurring.r k ON k.id = a.v WHERE k.id IS NULL GROUP BY a.v)"""


@query("grf2_bfs_expand", SQL_BFS + " SELECT id, level FROM r ORDER BY level, id LIMIT 400")
def _(t):
    start = t.graph_nodes.filter("document_id = 1 AND label = 'Document'").select("id")
    return traverse.bfs(t.graph_edges, start, 400)


# The walk's order, and the bytes that each node adds: its own and those of the edges that it closes.
SQL_SIZED = """WITH RECURSIVE l AS (SELECT id, unnest([label, extra_label]) AS l FROM graph_nodes), m AS (SELECT l, min(id) AS id FROM l WHERE l IS NOT NULL GROUP BY l), t AS (SELECT type, min((src, dst)) AS e FROM graph_edges GROUP BY 1),
seed AS (SELECT id FROM m UNION SELECT e[1] FROM t UNION SELECT e[2] FROM t),
n AS (SELECT id, label = 'DocumentSection' AS is_section, length(concat('{"id":"', id, '","label":"', label, '","title":"', title, '"}')) AS b FROM graph_nodes),
adj AS (SELECT src AS u, dst AS v FROM graph_edges JOIN n ON n.id = dst UNION SELECT dst, src FROM graph_edges JOIN n ON n.id = src),
r(id, level) USING KEY (id) AS (SELECT id, 0 FROM seed JOIN n USING (id) UNION SELECT a.v, min(r.level) + 1 FROM r JOIN adj a ON a.u = r.id LEFT JOIN recurring.r k ON k.id = a.v WHERE k.id IS NULL GROUP BY a.v),
o AS (SELECT id, level, is_section, b, CASE WHEN level = 0 THEN 0 ELSE row_number() OVER (PARTITION BY level > 0 ORDER BY level, is_section DESC, id) END AS place FROM r JOIN n USING (id)),
c AS (SELECT greatest(x.place, y.place) AS place, sum(length(concat('{"src":"', src, '","dst":"', dst, '","type":"', type, '"}'))) AS eb FROM graph_edges g JOIN o x ON x.id = g.src JOIN o y ON y.id = g.dst GROUP BY 1),
z AS (SELECT o.*, sum(b + coalesce(eb, 0)) OVER (ORDER BY o.place) - b - coalesce(eb, 0) AS before FROM o LEFT JOIN c ON c.place = o.place WHERE o.place > 0)
SELECT id, level, is_section, b AS n_bytes FROM o WHERE place = 0
UNION ALL SELECT id, level, is_section, b FROM z WHERE before + (SELECT sum(b) FROM o WHERE place = 0) + coalesce((SELECT eb FROM c WHERE place = 0), 0) < 200000"""


@query("grf3_bfs_sized", SQL_SIZED)
def _(t):
    start = traverse.seeds(labelled(t), t.graph_edges)
    info = t.graph_nodes.select("id", (F.col("label") == "DocumentSection").alias("is_section"), F.length(F.to_json(F.struct("id", "label", "title"))).cast("long").alias("n_bytes"))
    return traverse.bfs_sized(t.graph_edges, start, info, 200_000, 50_000).select("id", "level", "is_section", "n_bytes")


@query("grf4_induced_subgraph", """WITH c AS (SELECT DISTINCT id FROM graph_nodes WHERE document_id % 4 = 1) SELECT e.src, e.dst, e.type FROM graph_edges e JOIN c a ON a.id = e.src JOIN c b ON b.id = e.dst WHERE e.type <> 'HAS_SECTION'""")
def _(t):
    chosen = t.graph_nodes.filter("document_id % 4 = 1").select("id")
    return traverse.subgraph(t.graph_nodes, t.graph_edges, chosen, ["HAS_SECTION"])[1].select("src", "dst", "type")


def sections_only(t):
    return t.graph_nodes.filter("label = 'DocumentSection'").select("id")


@query("grf5_connected_components", """WITH RECURSIVE n AS (SELECT id FROM graph_nodes WHERE label = 'DocumentSection'), e AS (SELECT src, dst FROM graph_edges WHERE src IN (SELECT id FROM n) AND dst IN (SELECT id FROM n)), adj AS (SELECT src AS u, dst AS v FROM e UNION SELECT dst, src FROM e),
cc(id, comp) USING KEY (id) AS (SELECT id, id FROM n UNION SELECT u.id, min(v.comp) FROM recurring.cc u JOIN adj ON adj.u = u.id JOIN recurring.cc v ON v.id = adj.v WHERE v.comp < u.comp GROUP BY u.id)
SELECT id, comp AS component FROM cc""")
def _(t):
    return traverse.components(sections_only(t), t.graph_edges)


def topology_of(t):
    n = t.graph_nodes.select("id", "label", (F.length("title") * 40).alias("n_chars"))
    return traverse.topology(n, t.graph_edges)


# A component a step is too slow in SQL; tests compare with a plain loop.
@query("grf6_budget_selection")
def _(t):
    sec, doc, s2s, s2d = topology_of(t)
    comp = stored(traverse.components(sections_only(t), t.graph_edges), "components")
    stats = traverse.component_stats(sec, s2s, s2d, comp)
    docs_of = s2d.join(comp.select(F.col("id").alias("section"), "component"), "section").select("component", "document").distinct()
    return traverse.select_components(stats, docs_of, doc.select(F.col("id").alias("document"), "n_chars"), 2_000_000)


@query("grf7_neighbourhood_report", """WITH w AS (SELECT id FROM graph_nodes WHERE document_id % 2 = 0), e AS (SELECT src AS id, 'out' AS direction, dst AS other, type FROM graph_edges WHERE src IN (SELECT id FROM w) UNION ALL SELECT dst, 'in', src, type FROM graph_edges WHERE dst IN (SELECT id FROM w))
SELECT e.id, direction, CASE type WHEN 'CITES' THEN 'citation' WHEN 'HAS_SECTION' THEN 'structural' ELSE 'affectation' END AS edge_group, count(*) AS n, count(DISTINCT CASE WHEN n.id IS NULL THEN NULL WHEN n.label = 'Document' THEN n.id ELSE concat('d', CAST(n.document_id AS VARCHAR)) END) AS n_parents
FROM e LEFT JOIN graph_nodes n ON n.id = e.other GROUP BY 1, 2, 3""")
def _(t):
    r = traverse.neighbourhood(t.graph_nodes.filter("document_id % 2 = 0").select("id"), t.graph_nodes, t.graph_edges)
    return r.groupBy("id", "direction", "edge_group").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("other_parent").alias("n_parents"))


@query("grf8_section_map", "SELECT document_id, section_id, row_number() OVER (PARTITION BY document_id ORDER BY ord) AS position FROM legal_sections")
def _(t):
    return traverse.section_map(graph.has_section(t.legal_sections)).select("document_id", "section_id", "position")


@query("grf9_topology_frames", """WITH k AS (SELECT e.*, a.label AS sl, b.label AS dl FROM graph_edges e JOIN graph_nodes a ON a.id = e.src JOIN graph_nodes b ON b.id = e.dst)
SELECT 'sections' AS frame, count(*) AS n FROM graph_nodes WHERE label = 'DocumentSection' UNION ALL SELECT 'documents', count(*) FROM graph_nodes WHERE label = 'Document' UNION ALL SELECT 'section-section', count(*) FROM k WHERE sl = 'DocumentSection' AND dl = 'DocumentSection'
UNION ALL SELECT 'section-document', count(*) FROM k WHERE (sl = 'DocumentSection' AND dl = 'Document') OR (sl = 'Document' AND dl = 'DocumentSection' AND type <> 'HAS_SECTION')""")
def _(t):
    out = None
    for name, df in zip(("sections", "documents", "section-section", "section-document"), topology_of(t)):
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("frame"), "n")
        out = one if out is None else out.unionByName(one)
    return out


# ---- refresh and corrections -------------------------------------------------------------------------
@query("inc1_incremental_append", """SELECT document_id, title, document_id % 3 = 0 AS is_new FROM legal_docs""")
def _(t):
    d = t.legal_docs.select("document_id", "title")
    return reconcile.append_new(d.filter("document_id % 2 = 0 OR document_id % 3 = 0"), d.filter("document_id % 3 <> 0"), "document_id")


SQL_SINCE = """WITH s AS (SELECT * FROM publications WHERE data_publicacio < '2000-06-01' AND ingest_ord % 10 <> 0) SELECT ingest_ord, data_publicacio FROM publications WHERE data_publicacio >= (SELECT max(data_publicacio) FROM s) AND ingest_ord NOT IN (SELECT ingest_ord FROM s)"""


@query("inc2_resume_from_max_date", SQL_SINCE)
def _(t):
    p = t.publications.select("ingest_ord", "data_publicacio")
    return reconcile.since_last(p, p.filter("data_publicacio < '2000-06-01' AND ingest_ord % 10 <> 0"), "ingest_ord", "data_publicacio")


@query("inc2_streaming_refresh", "SELECT document_id, title FROM legal_docs")
def _(t):
    d = t.legal_docs.select("document_id", "title")
    base = scratch_path(t.spark, "refresh")
    run = lambda: refresh.refresh_table(t.spark, f"{base}/feed", d.schema, f"{base}/table", f"{base}/checkpoint", "document_id", "title")
    d.filter("document_id % 3 <> 0").write.mode("append").parquet(f"{base}/feed")
    run()
    # the second delivery repeats half of the first
    d.filter("document_id % 2 = 0 OR document_id % 3 = 0").write.mode("append").parquet(f"{base}/feed")
    return run()


@query("inc3_attempt_flags", """SELECT ingest_ord, ingest_ord % 3 = 0 OR ingest_ord % 4 = 0 AS attempted, coalesce(butlleti = 'DOGC', FALSE) OR ingest_ord % 12 = 0 AS appears_in_dogc, CASE WHEN ingest_ord % 12 = 0 THEN CAST(ingest_ord AS VARCHAR) END AS dogc_document_id FROM publications""")
def _(t):
    none = F.lit(None).cast("string")
    p = t.publications.select("ingest_ord", (F.col("ingest_ord") % 4 == 0).alias("attempted"), F.coalesce(F.col("butlleti") == "DOGC", F.lit(False)).alias("appears_in_dogc"), none.alias("dogc_document_id"), none.alias("url_html"), none.alias("matched_record"))
    m = t.legal_docs.filter("document_id % 12 = 0").select(F.col("document_id").alias("ingest_ord"), "document_id", "html_url", F.col("title").alias("summary"))
    return reconcile.apply_resolution(p, m, t.legal_docs.filter("document_id % 3 = 0").select(F.col("document_id").alias("ingest_ord")), "ingest_ord").select("ingest_ord", "attempted", "appears_in_dogc", "dogc_document_id")


def review(t):
    """Edges of editorial links and a decision about each, plus additions."""
    a = t.legal_affs
    key = F.concat_ws(":", F.col("document_id").cast("string"), F.col("ord").cast("string"))
    edges = a.select(key.alias("edge_id"), F.col("document_id").alias("src"), F.col("target_document_id").alias("dst"), F.lit("CITES").alias("type"), F.lit("").alias("details"))
    n = F.col("target_document_id") % 5
    act = F.when(n == 0, "keep").when(n == 1, "MODIFY").when(n == 2, "REMOVE").when(n == 3, "ADD").otherwise("CREATE_NEW_EDGE")
    d = a.select((F.col("document_id") * 10 + F.col("ord")).alias("ord"), F.when(n < 3, key).alias("edge_id"), F.col("document_id").alias("src"), act.alias("action"),
                 F.when(n == 1, F.col("target_document_id") + 7).when(n >= 3, F.col("target_document_id")).alias("new_dst"), F.when(n == 1, "MODIFY").otherwise("CITES").alias("new_type"), F.lit("art 1").alias("details"))
    return edges, d


SQL_REVIEW = """a AS (SELECT *, target_document_id % 5 AS n FROM legal_affs)"""


@query("inc4_reconcile_edges", f"""WITH {SQL_REVIEW} SELECT document_id AS src, CASE WHEN n = 1 THEN target_document_id + 7 ELSE target_document_id END AS dst, CASE WHEN n = 1 THEN 'MODIFY' ELSE 'CITES' END AS type, n = 0 AS verified, n = 1 AS modified, FALSE AS extracted FROM a WHERE n <> 2
UNION ALL SELECT document_id, target_document_id, 'CITES', FALSE, FALSE, TRUE FROM a WHERE n = 4""")
def _(t):
    return reconcile.reconcile(*review(t))[0].select("src", "dst", "type", "verified", "modified", "extracted")


@query("inc4_reconcile_counters", f"""WITH {SQL_REVIEW} SELECT document_id AS src, count(*) FILTER (WHERE n = 0) AS kept, count(*) FILTER (WHERE n = 1) AS modified, count(*) FILTER (WHERE n = 2) AS removed, count(*) FILTER (WHERE n = 4) AS added FROM a WHERE n <> 3 GROUP BY 1""")
def _(t):
    return reconcile.reconcile(*review(t))[1]


@query("inc5_target_rule", """SELECT i.source_id, i.item_no, CASE WHEN i.is_general OR s.section_id IS NULL THEN CAST(i.source_id AS VARCHAR) ELSE s.section_id END AS target, CASE WHEN NOT i.is_general AND s.section_id IS NOT NULL THEN 'section' ELSE 'document' END AS target_kind
FROM items i LEFT JOIN legal_sections s ON s.document_id = i.source_id AND s.title = i.article_or_section""")
def _(t):
    return reconcile.final_target(t.items.withColumn("document_id", F.col("source_id")), t.legal_sections)


@query("inc6_update_nodes_flags", f"""WITH {SQL_REVIEW}, c AS (SELECT document_id, count(*) FILTER (WHERE n = 0) AS kept, count(*) FILTER (WHERE n = 4) AS added FROM a WHERE n <> 3 GROUP BY 1)
SELECT d.document_id AS id, d.title, CASE WHEN d.document_id % 2 = 0 THEN 'true' END AS processed, CASE WHEN d.document_id % 2 = 0 THEN CAST(coalesce(c.kept, 0) AS VARCHAR) END AS kept, CASE WHEN d.document_id % 2 = 0 THEN CAST(coalesce(c.added, 0) AS VARCHAR) END AS added FROM legal_docs d LEFT JOIN c USING (document_id)""")
def _(t):
    nodes = t.legal_docs.select(F.col("document_id").alias("id"), F.create_map(F.lit("title"), F.col("title")).alias("props"))
    out = reconcile.flag_nodes(nodes, t.legal_docs.filter("document_id % 2 = 0").select(F.col("document_id").alias("id")), reconcile.reconcile(*review(t))[1])
    p = lambda k: F.try_element_at("props", F.lit(k))
    return out.select("id", p("title").alias("title"), p("processed").alias("processed"), p("citations_kept").alias("kept"), p("citations_added").alias("added"))
