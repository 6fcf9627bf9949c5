"""Duplicate, order, set, audit and sample queries."""

from pyspark.sql import functions as F

from lexloom.functions import ids
from lexloom.operators import audit, dedupe, sample
from lexloom.operators.ordered import top_k
from lexloom.plans.extraction import SQL_CITES, citations
from lexloom.plans.projections import sql_title_key
from lexloom.plans.registry import query
from lexloom.session import scratch_path
from lexloom.sources import bucketed


# ---- duplicates -----------------------------------------------------------------------------
@query("ded1_first_by_link", """SELECT min(ingest_ord) AS ingest_ord, coalesce(trim(link_to_text), category) AS link FROM bulletin_feed GROUP BY 2""")
def _(t):
    f = t.bulletin_feed.select("ingest_ord", F.trim("link_to_text").alias("link_to_text"), "category")
    return dedupe.dedupe_first(f, ["link_to_text", "category"]).select("ingest_ord", F.coalesce("link_to_text", "category").alias("link"))


def phase_texts(t):
    """Publications whose descriptions repeat with small changes inside a record and phase."""
    n = F.col("ingest_ord")
    d = (F.when(n % 5 == 0, F.concat("descripcio", F.lit(" (bis)"))).when(n % 7 == 0, F.concat(F.lit("Anunci "), (n % 4).cast("string"))).when(n % 11 == 0, "")
         .otherwise(F.concat(F.lit("acte "), (n % 13).cast("string"), F.lit(" nota "), (n % 3).cast("string"))))
    return t.publications.withColumn("descripcio", d)


SQL_SIMILAR = """(length(x.t) >= 15 AND length(r.t) >= 15 AND (contains(x.t, r.t) OR contains(r.t, x.t))
  OR len(list_intersect(x.w, r.w)) / greatest(len(x.w), len(r.w)) >= 0.82 OR len(list_filter(list_intersect(x.w, r.w), lambda v: length(v) >= 5)) >= 2)"""


@query("ded2_cluster_publications", f"""WITH RECURSIVE p AS (SELECT record_id, fase, ingest_ord, CASE WHEN ingest_ord % 5 = 0 THEN concat(descripcio, ' (bis)') WHEN ingest_ord % 7 = 0 THEN concat('Anunci ', CAST(ingest_ord % 4 AS VARCHAR)) WHEN ingest_ord % 11 = 0 THEN ''
   ELSE concat('acte ', CAST(ingest_ord % 13 AS VARCHAR), ' nota ', CAST(ingest_ord % 3 AS VARCHAR)) END AS d FROM publications),
k AS (SELECT *, {sql_title_key('d')} AS t FROM p),
g AS (SELECT *, row_number() OVER (PARTITION BY record_id, fase ORDER BY o) AS n FROM (SELECT record_id, fase, t, min(ingest_ord) AS o, list_distinct(list_filter(string_split(t, ' '), lambda v: v <> '')) AS w FROM k WHERE t <> '' GROUP BY record_id, fase, t)),
s(record_id, fase, n, rep, reps) AS (
  SELECT record_id, fase, n, o, [{{'t': t, 'w': w, 'o': o}}] FROM g WHERE n = 1
  UNION ALL SELECT x.record_id, x.fase, x.n, coalesce(list_filter(s.reps, lambda r: {SQL_SIMILAR})[1].o, x.o),
    CASE WHEN len(list_filter(s.reps, lambda r: {SQL_SIMILAR})) > 0 THEN s.reps ELSE list_append(s.reps, {{'t': x.t, 'w': x.w, 'o': x.o}}) END
  FROM s JOIN g x ON x.record_id = s.record_id AND x.fase = s.fase AND x.n = s.n + 1)
SELECT k.record_id, k.fase, k.ingest_ord, coalesce(s.rep, k.ingest_ord) AS cluster FROM k LEFT JOIN g USING (record_id, fase, t) LEFT JOIN s ON s.record_id = g.record_id AND s.fase = g.fase AND s.n = g.n""")
def _(t):
    return dedupe.cluster_publications(phase_texts(t), ["record_id", "fase"], "descripcio").select("record_id", "fase", "ingest_ord", "cluster")


@query("ded3_pick_source", """WITH p AS (SELECT *, CASE WHEN butlleti = 'DOGC' AND url_pdf LIKE '%documentId=%' THEN 4 WHEN butlleti = 'DOGC' THEN 3 WHEN butlleti LIKE 'BOP%' THEN 2 ELSE 1 END AS prio FROM publications)
SELECT record_id, fase, arg_min(ingest_ord, (-prio, ingest_ord)) AS ingest_ord, coalesce(string_agg(DISTINCT butlleti, ',' ORDER BY butlleti), '') AS all_sources, count(DISTINCT butlleti) > 1 AS is_multi_source FROM p GROUP BY 1, 2""")
def _(t):
    p = t.publications.withColumn("known", F.coalesce(F.col("url_pdf").contains("documentId="), F.lit(False)))
    return dedupe.pick_source(p, ["record_id", "fase"]).select("record_id", "fase", "ingest_ord", F.array_join("all_sources", ",").alias("all_sources"), "is_multi_source")


@query("ded4_last_by_key", "SELECT title, max(ingest_ord) AS ingest_ord FROM legal_docs GROUP BY 1")
def _(t):
    return dedupe.last_by(t.legal_docs, ["title"]).select("title", "ingest_ord")


@query("ded5_first_by_key", """SELECT dogc_number, min(ingest_ord) AS ingest_ord, arg_min(type, ingest_ord) FILTER (WHERE type IS NOT NULL) AS type, arg_min(section, ingest_ord) FILTER (WHERE section <> '') AS section FROM legal_docs GROUP BY 1""")
def _(t):
    return dedupe.first_by(t.legal_docs.select("dogc_number", "type", "section", "ingest_ord"), ["dogc_number"], ["type", "section"])


@query("ded6_unique_edges", "SELECT DISTINCT src, dst, type FROM graph_edges")
def _(t):
    return dedupe.unique_edges(t.graph_edges)


@query("ded7_distinct_ordered", "SELECT record_id, butlleti, min(pos) AS pos FROM publications GROUP BY 1, 2")
def _(t):
    return dedupe.distinct_ordered(t.publications, ["record_id"], "butlleti", "pos")


@query("win1_number_sections", """SELECT section_id, row_number() OVER (PARTITION BY document_id ORDER BY ord) AS section_no, row_number() OVER (PARTITION BY document_id ORDER BY ord) - 1 AS "order" FROM legal_sections""")
def _(t):
    return dedupe.number_sections(t.legal_sections).select("section_id", "section_no", "order")


@query("win2_synthetic_ids", """SELECT f.id AS feed_id, row_number() OVER (ORDER BY f.ingest_ord) + (SELECT max(document_id) FROM legal_docs) AS id FROM bulletin_feed f""")
def _(t):
    new = t.bulletin_feed.select(F.col("id").alias("feed_id"), "ingest_ord")
    return dedupe.assign_ids(new, t.legal_docs.select(F.col("document_id").alias("id")), [F.col("ingest_ord")]).select("feed_id", "id")


@query("win3_top_k_per_group", """SELECT organisme, document_id, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY organisme ORDER BY year DESC, document_id) AS rank FROM legal_docs) WHERE rank <= 3""")
def _(t):
    return top_k(t.legal_docs, ["organisme"], [F.col("year").desc(), "document_id"], 3).select("organisme", "document_id", "rank")


@query("win4_share_of_total", """SELECT section, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM legal_docs), 6) AS pct FROM legal_docs GROUP BY 1""")
def _(t):
    return dedupe.share_of_total(t.legal_docs.groupBy("section").agg(F.count(F.lit(1)).alias("n")))


@query("srt1_natural_issue_order", """WITH i AS (SELECT DISTINCT CASE WHEN document_id % 50 = 0 THEN '' WHEN document_id % 50 = 1 THEN concat('E-', dogc_number) ELSE dogc_number END AS issue FROM legal_docs)
SELECT issue, row_number() OVER (ORDER BY issue <> '', coalesce(TRY_CAST(regexp_replace(issue, '[^0-9]', '', 'g') AS BIGINT), 0), issue) AS position FROM i""")
def _(t):
    from lexloom.operators.ordered import global_scan
    issue = F.when(F.col("document_id") % 50 == 0, "").when(F.col("document_id") % 50 == 1, F.concat(F.lit("E-"), "dogc_number")).otherwise(F.col("dogc_number"))
    return global_scan(t.legal_docs.select(issue.alias("issue")).distinct(), [dedupe.issue_order("issue")], {}, "position")


@query("set1_union_documents", """SELECT CAST(document_id AS VARCHAR) AS id, title, dogc_number FROM legal_docs UNION ALL SELECT id, title, NULL FROM bulletin_feed""")
def _(t):
    return dedupe.union_documents(t.legal_docs.select(F.col("document_id").cast("string").alias("id"), "title", "dogc_number"), t.bulletin_feed.select("id", "title"))


@query("set2_placeholders", """SELECT document_id, concat('Referenced Law (Placeholder - Document ID ', CAST(document_id AS VARCHAR), ')') AS title FROM
 (SELECT document_id FROM legal_affs UNION SELECT target_document_id FROM legal_affs EXCEPT SELECT document_id FROM legal_docs)""")
def _(t):
    e = t.legal_affs.select(F.col("document_id").alias("src"), F.col("target_document_id").alias("dst"))
    return dedupe.placeholders(e, t.legal_docs).select("document_id", "title")


@query("set3_key_space_union", "SELECT DISTINCT unnest(json_keys(props)) AS key FROM events UNION SELECT concat('turn', CAST(turn AS VARCHAR)) FROM conversations")
def _(t):
    a = t.events.select(F.from_json("props", "map<string,string>").alias("props"))
    b = t.conversations.select(F.create_map(F.concat(F.lit("turn"), F.col("turn").cast("string")), F.col("role")).alias("props"))
    return dedupe.key_space(a.unionByName(b))


@query("set4_upsert_delete", """SELECT annotation_id, CASE WHEN ingest_ord % 4 = 0 THEN 'changed' ELSE category END AS category FROM spans WHERE ingest_ord % 7 <> 0 UNION ALL SELECT concat('new', annotation_id), 'changed' FROM spans WHERE ingest_ord % 100 = 1""")
def _(t):
    s = t.spans.select("annotation_id", "category", "ingest_ord")
    changed = s.filter("ingest_ord % 4 = 0").withColumn("category", F.lit("changed"))
    new = s.filter("ingest_ord % 100 = 1").withColumns({"annotation_id": F.concat(F.lit("new"), "annotation_id"), "category": F.lit("changed"), "ingest_ord": F.lit(1).cast("long")})
    path = scratch_path(t.spark, "spans")
    bucketed.create(s, path, "annotation_id")
    bucketed.upsert(path, changed.unionByName(new), "annotation_id")
    bucketed.delete_by(path, s.schema, s.filter("ingest_ord % 7 = 0").select("annotation_id"), "annotation_id")
    return bucketed.read(t.spark, path, s.schema).select("annotation_id", "category")


# ---- audits -----------------------------------------------------------------------------------
@query("agg1_docs_per_type", "SELECT coalesce(type, 'Unknown') AS type, count(*) AS n FROM legal_docs GROUP BY 1")
def _(t):
    return audit.counts(t.legal_docs, "type", by_count=True)


@query("agg1_docs_per_year", "SELECT CAST(year AS VARCHAR) AS year, count(*) AS n FROM legal_docs GROUP BY 1")
def _(t):
    return audit.counts(t.legal_docs, "year")


@query("agg2_docs_per_issue", "SELECT dogc_number, min(date_dogc) AS date_dogc, min(year) AS year, count(*) AS n FROM legal_docs GROUP BY 1")
def _(t):
    return audit.docs_per_issue(t.legal_docs)


def gappy(t):
    n = F.col("document_id")
    return t.legal_docs.withColumns({"html_url": F.when(n % 17 != 0, F.col("html_url")), "document_id_": n, "document_id": F.when(n % 23 == 0, "").otherwise(n.cast("string"))})


@query("agg3_completeness_audit", """WITH m AS (SELECT count(*) AS n, count(*) FILTER (WHERE document_id % 23 = 0) AS a, count(*) FILTER (WHERE document_id % 17 = 0) AS b, count(*) FILTER (WHERE pdf_url = 'None') AS c, count(*) FILTER (WHERE section = '') AS d FROM legal_docs),
u AS (SELECT unnest(['document_id', 'html_url', 'pdf_url', 'section', 'title', 'organisme', 'date_dogc', 'year']) AS field, unnest([a, b, c, d, 0, 0, 0, 0]) AS missing, n FROM m)
SELECT field, missing, round(100.0 * missing / n, 6) AS pct FROM u""")
def _(t):
    return audit.completeness(gappy(t))


@query("agg3_incomplete_rows", """SELECT ingest_ord, concat_ws(',', CASE WHEN document_id % 23 = 0 THEN 'document_id' END, CASE WHEN document_id % 17 = 0 THEN 'html_url' END, CASE WHEN pdf_url = 'None' THEN 'pdf_url' END, CASE WHEN section = '' THEN 'section' END) AS missing
FROM legal_docs WHERE document_id % 23 = 0 OR document_id % 17 = 0 ORDER BY ingest_ord LIMIT 30""")
def _(t):
    return audit.incomplete_rows(gappy(t)).select("ingest_ord", F.array_join("missing", ",").alias("missing"))


@query("agg4_match_report", """WITH m AS (SELECT category, cido_id IS NOT NULL OR link_to_text IS NOT NULL AS m FROM bulletin_feed), d AS (SELECT 'category' AS dimension, category AS value, m FROM m UNION ALL SELECT 'all', 'all', m FROM m)
SELECT dimension, value, count(*) AS total, count(*) FILTER (WHERE m) AS matched, count(*) FILTER (WHERE NOT m) AS unmatched, round(100.0 * count(*) FILTER (WHERE m) / count(*), 6) AS pct FROM d GROUP BY 1, 2""")
def _(t):
    f = t.bulletin_feed.withColumn("matched_id", F.coalesce(F.col("cido_id").cast("string"), "link_to_text"))
    return audit.match_report(f, ["category"])


@query("agg4_match_samples", """SELECT ingest_ord, m AS is_matched FROM (SELECT ingest_ord, cido_id IS NOT NULL AS m, row_number() OVER (PARTITION BY cido_id IS NOT NULL ORDER BY ingest_ord) AS n FROM bulletin_feed) WHERE n <= 50""")
def _(t):
    return audit.match_samples(t.bulletin_feed, "cido_id").select("ingest_ord", "is_matched")


@query("agg5_module_summary", """WITH per AS (SELECT record_id, count(*) AS n, count(*) FILTER (WHERE butlleti = 'DOGC' AND url_pdf LIKE '%documentId=%') AS res, count(*) FILTER (WHERE butlleti = 'DOGC' AND NOT coalesce(url_pdf LIKE '%documentId=%', FALSE)) AS unres FROM publications GROUP BY 1),
r AS (SELECT type, coalesce(n, 0) AS n, coalesce(res, 0) AS res, coalesce(unres, 0) AS unres FROM records LEFT JOIN per USING (record_id))
SELECT coalesce(type, 'Total / All Modules') AS module, count(*) AS records, count(*) FILTER (WHERE n = 0) AS with_0, count(*) FILTER (WHERE n = 1) AS with_1, count(*) FILTER (WHERE n > 1) AS with_more,
 CAST(sum(res) AS BIGINT) AS resolved, CAST(sum(unres) AS BIGINT) AS unresolved, CAST(sum(n - res - unres) AS BIGINT) AS others, CAST(sum(n) AS BIGINT) AS publications FROM r GROUP BY ROLLUP (type)""")
def _(t):
    p = t.publications.select("record_id", "butlleti", F.coalesce(F.col("url_pdf").contains("documentId="), F.lit(False)).alias("resolved"))
    return audit.module_summary(t.records, p)


@query("agg6_build_summary", f"""WITH {SQL_CITES} SELECT 'rows:documents' AS metric, CAST(count(*) AS DOUBLE) AS value FROM legal_docs UNION ALL SELECT 'rows:citations', count(*) FROM r
UNION ALL SELECT CASE WHEN target_id IS NULL THEN 'citations:unmapped' ELSE 'citations:mapped' END, count(*) FROM r GROUP BY 1
UNION ALL SELECT 'rows:edges', count(*) FROM graph_edges UNION ALL SELECT concat('edge:', type), count(*) FROM graph_edges GROUP BY 1""")
def _(t):
    return audit.build_summary({"documents": t.legal_docs, "citations": citations(t), "edges": t.graph_edges})


def units(t):
    """Publications as sample units with landed page counts and reachability."""
    n = F.col("ingest_ord")
    return t.publications.select(n.alias("unit_id"), "type", "butlleti", "institucio", F.coalesce(F.col("butlleti") == "DOGC", F.lit(False)).alias("appears_in_dogc"),
                                 ids.leading_year("data_publicacio").alias("year"), (n % 4 + 1).cast("int").alias("pages"), (n % 10 != 0).alias("reachable"))


SQL_UNITS = """u AS (SELECT ingest_ord AS unit_id, type, butlleti, institucio, coalesce(butlleti = 'DOGC', FALSE) AS gaz, CAST(data_publicacio[1:4] AS INT) AS year, CAST(ingest_ord % 4 + 1 AS INT) AS pages, ingest_ord % 10 <> 0 AS reachable FROM publications)"""


@query("agg7_subset_report", f"""WITH {SQL_UNITS}, i AS (SELECT institucio AS value, count(*) AS n FROM u GROUP BY 1)
SELECT 'type' AS dimension, type AS value, count(*) AS n FROM u GROUP BY 2 UNION ALL SELECT 'butlleti', coalesce(butlleti, 'OTHER'), count(*) FROM u GROUP BY 2 UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FROM u GROUP BY 2
UNION ALL SELECT 'pages', CAST(pages AS VARCHAR), count(*) FROM u GROUP BY 2
UNION ALL SELECT 'normative x gazette', concat(CASE WHEN type = 'normatives-locals' THEN 'normative' ELSE 'non_normative' END, ' x ', CASE WHEN gaz THEN 'gazette' ELSE 'other' END), count(*) FROM u GROUP BY 2
UNION ALL (SELECT 'top institution', value, n FROM i ORDER BY n DESC, value LIMIT 5) UNION ALL SELECT 'institutions', 'distinct', count(*) FROM i""")
def _(t):
    return audit.subset_report(units(t))


@query("agg8_module_volumes", """WITH r AS (SELECT type, count(*) AS records FROM records GROUP BY 1), p AS (SELECT type, count(*) AS publications FROM publications GROUP BY 1)
SELECT r.type, records, publications, round(100.0 * records / sum(records) OVER (), 6) AS record_pct, round(100.0 * publications / sum(publications) OVER (), 6) AS publication_pct, round(publications / records, 6) AS per_record FROM r JOIN p USING (type)""")
def _(t):
    return audit.module_volumes(t.records, t.publications)


@query("agg8_corpus_distribution", """WITH v AS (SELECT 'butlleti' AS dimension, coalesce(butlleti, 'Other') AS value FROM publications UNION ALL SELECT 'validity', CASE WHEN es_vigent THEN 'Vigent' WHEN NOT es_vigent THEN 'No Vigent' ELSE 'Unknown / Null' END FROM records
 UNION ALL SELECT 'type', coalesce(type, 'Unknown') FROM legal_docs UNION ALL SELECT 'year', CAST(year AS VARCHAR) FROM legal_docs), c AS (SELECT dimension, value, count(*) AS n FROM v GROUP BY 1, 2)
SELECT * FROM (SELECT dimension, value, n, round(100.0 * n / sum(n) OVER (PARTITION BY dimension), 6) AS pct FROM c) WHERE dimension <> 'year' OR CAST(value AS INT) >= 1999""")
def _(t):
    return audit.corpus_distribution(t.records, t.publications, t.legal_docs, 1999)


@query("agg9_link_coverage", """WITH p AS (SELECT butlleti, nullif(regexp_extract(coalesce(url_pdf, ''), 'documentId=(\\d+)', 1), '') AS uid, ingest_ord FROM publications), g AS (SELECT * FROM p WHERE butlleti = 'DOGC' OR uid IS NOT NULL),
d AS (SELECT count(*) AS documents, count(*) FILTER (WHERE CAST(document_id AS VARCHAR) IN (SELECT uid FROM g WHERE uid IS NOT NULL)) AS linked FROM legal_docs)
SELECT count(*) AS gazette_publications, count(uid) AS explicit_id, count(*) FILTER (WHERE uid IS NOT NULL AND ingest_ord % 3 <> 0) AS embedded_record, count(*) FILTER (WHERE uid IS NULL) AS implicit,
 any_value(documents) AS documents, any_value(linked) AS linked_documents, any_value(documents - linked) AS unlinked_documents, round(100.0 * any_value(linked) / any_value(documents), 6) AS linked_pct FROM g, d""")
def _(t):
    p = t.publications.withColumn("dogc_document_id", ids.url_doc_id("url_pdf"))
    return audit.link_coverage(p.withColumn("embedded", F.col("dogc_document_id").isNotNull() & (F.col("ingest_ord") % 3 != 0)), t.legal_docs)


@query("agg10_era_histogram", """SELECT CASE WHEN year <= 1996 THEN 'early' WHEN year <= 1999 THEN 'middle' ELSE 'late' END AS era, count(*) AS n, round(count(*) / CASE WHEN max(year) <= 1996 THEN 2 WHEN max(year) <= 1999 THEN 3 ELSE 2 END, 6) AS per_year FROM legal_docs GROUP BY 1""")
def _(t):
    return audit.era_histogram(t.legal_docs, [("early", 1995, 1996), ("middle", 1997, 1999), ("late", 2000, 2001)]).select("era", "n", "per_year")


def audited_graph(t):
    """Graph with review flags spread over nodes and edges."""
    h = F.col("document_id")
    n = t.graph_nodes.select("id", "label", F.array_compact(F.array("label", "extra_label")).alias("labels"), "title", F.col("title").alias("text"),
                             ((F.col("label") == "DocumentSection") & (h % 2 == 0)).alias("processed"), (h % 97 == 5).alias("created"),
                             (h % 3).alias("kept"), (h % 5).alias("modified"), (h % 2 + 1).alias("added"))
    e = t.graph_edges.withColumn("k", F.length("dst") % 4).filter("type <> 'HAS_SECTION'").select(
        F.concat_ws("|", "src", "dst", "type").alias("edge_id"), "src", "dst", "type", (F.col("k") == 0).alias("extracted"), (F.col("k") == 1).alias("modified"), (F.col("k") == 2).alias("verified"))
    return n, e


@query("agg11_graph_audit", """WITH n AS (SELECT *, concat_ws(':', CASE WHEN extra_label < label THEN extra_label END, label, CASE WHEN extra_label >= label THEN extra_label END) AS labels, label = 'DocumentSection' AND document_id % 2 = 0 AS processed, document_id % 97 = 5 AS created FROM graph_nodes),
e AS (SELECT *, length(dst) % 4 AS k FROM graph_edges WHERE type <> 'HAS_SECTION')
SELECT 'summary' AS dimension, 'total_nodes' AS value, count(*) AS n FROM n UNION ALL SELECT 'summary', 'nodes_processed', count(*) FROM n WHERE processed UNION ALL SELECT 'summary', 'nodes_created', count(*) FROM n WHERE created
UNION ALL SELECT 'summary', 'citations_kept', CAST(sum(document_id % 3) AS BIGINT) FROM n WHERE processed UNION ALL SELECT 'summary', 'citations_modified', CAST(sum(document_id % 5) AS BIGINT) FROM n WHERE processed UNION ALL SELECT 'summary', 'citations_added', CAST(sum(document_id % 2 + 1) AS BIGINT) FROM n WHERE processed
UNION ALL SELECT 'labels', labels, count(*) FROM n GROUP BY 2 UNION ALL SELECT 'created labels', labels, count(*) FROM n WHERE created GROUP BY 2
UNION ALL SELECT 'edge type', type, count(*) FROM e GROUP BY 2 UNION ALL SELECT 'provenance', CASE k WHEN 0 THEN 'extracted (ADD)' WHEN 1 THEN 'modified (MODIFY/FIX)' WHEN 2 THEN 'verified (KEEP)' ELSE 'original_or_other' END, count(*) FROM e GROUP BY 2
UNION ALL SELECT 'summary', 'total_edges', count(*) FROM e""")
def _(t):
    return audit.graph_audit(*audited_graph(t))


@query("agg12_node_audit", """WITH e AS (SELECT *, length(dst) % 4 AS k, concat_ws('|', src, dst, type) AS edge_id FROM graph_edges WHERE type <> 'HAS_SECTION'),
n AS (SELECT *, label = 'DocumentSection' AND document_id % 2 = 0 AS processed FROM graph_nodes)
SELECT e.src, e.edge_id, CASE k WHEN 0 THEN 'added' WHEN 1 THEN 'modified' ELSE 'kept' END AS action, coalesce(d.title, '') AS target_title, CASE WHEN d.id IS NULL THEN NULL WHEN d.label = 'Document' THEN d.id ELSE concat('d', CAST(d.document_id AS VARCHAR)) END AS target_parent,
 CASE WHEN k = 1 THEN concat(e.dst, '_old') END AS before_dst FROM e JOIN n ON n.id = e.src AND n.processed LEFT JOIN graph_nodes d ON d.id = e.dst WHERE k < 3""")
def _(t):
    n, e = audited_graph(t)
    before = e.select("edge_id", F.concat("dst", F.lit("_old")).alias("dst"), "type")
    flags = F.lit(False)
    structure = t.graph_edges.filter("type = 'HAS_SECTION'").select(F.lit(None).cast("string").alias("edge_id"), "src", "dst", "type", flags.alias("extracted"), flags.alias("modified"), flags.alias("verified"))
    a = audit.node_audit(n, e.unionByName(structure), before)
    return a.select("src", "edge_id", "action", F.coalesce("target_title", F.lit("")).alias("target_title"), "target_parent", "before_dst")


@query("agg13_url_status_summary", """SELECT CASE WHEN document_id % 7 IN (0, 1, 2, 3) THEN 'active' ELSE 'eliminated' END AS url_status, count(*) AS n FROM legal_docs GROUP BY 1""")
def _(t):
    code = F.get(F.array(*[F.lit(x) for x in (200, 301, 307, 308, 404, 500)]), (F.col("document_id") % 7).cast("int"))
    return audit.url_status(t.legal_docs.withColumn("status_code", code))


@query("agg14_annotation_stats", """WITH s AS (SELECT *, ingest_ord % 6 > 1 AS f FROM spans), d AS (SELECT 'document' AS dimension, CAST(doc_id AS VARCHAR) AS value, f FROM s UNION ALL SELECT 'category', category, f FROM s UNION ALL SELECT 'all', 'all', f FROM s)
SELECT dimension, value, count(*) AS annotations, count(*) FILTER (WHERE f) AS with_key_values FROM d GROUP BY 1, 2""")
def _(t):
    k = F.col("ingest_ord") % 6
    return audit.annotation_stats(t.spans.withColumn("key_values_json", F.when(k == 0, "{}").when(k == 1, "").otherwise(F.col("key_values_json"))))


@query("agg15_subset_summary", f"""WITH {SQL_UNITS} SELECT count(*) AS total, count(*) FILTER (WHERE pages = 1) AS one_page, count(*) FILTER (WHERE pages = 2) AS two_pages, count(*) FILTER (WHERE reachable) AS reachable,
 count(*) FILTER (WHERE type = 'normatives-locals') AS normative, count(*) FILTER (WHERE gaz) AS in_gazette, min(year) AS min_year, max(year) AS max_year FROM u""")
def _(t):
    return audit.subset_summary(units(t))


# ---- samples ----------------------------------------------------------------------------------
@query("smp1_quota_sample", f"""WITH {SQL_UNITS}, i AS (SELECT CASE WHEN type = 'normatives-locals' THEN 'normative' ELSE 'non_normative' END AS bucket, gaz AS in_gazette, institucio, count(*) AS k FROM u GROUP BY 1, 2, 3),
b AS (SELECT bucket, in_gazette, sum(k) AS n, sum(least(k, 2)) AS under_cap, CASE WHEN bucket = 'normative' AND in_gazette THEN 9 WHEN bucket = 'normative' THEN 21 WHEN in_gazette THEN 21 ELSE 49 END AS quota FROM i GROUP BY 1, 2)
SELECT bucket, in_gazette, CAST(least(n, quota) AS BIGINT) AS n, least(n, quota) <= under_cap AS within_cap FROM b""")
def _(t):
    per = sample.quota_sample(units(t)).groupBy("bucket", "in_gazette", "institucio").agg(F.count(F.lit(1)).alias("k"))
    return per.groupBy("bucket", "in_gazette").agg(F.sum("k").alias("n"), (F.max("k") <= 2).alias("within_cap"))


@query("smp2_valid_pool", f"""WITH {SQL_UNITS}, b AS (SELECT CASE WHEN type = 'normatives-locals' THEN 'normative' ELSE 'non_normative' END AS bucket, gaz AS in_gazette, count(*) FILTER (WHERE reachable AND pages <= 2) AS n FROM u GROUP BY 1, 2)
SELECT bucket, in_gazette, least(n, 1000) AS n FROM b""")
def _(t):
    p = sample.valid_pool(units(t), per_bucket=1000, tested=1 << 30)
    return p.groupBy(F.col("_norm").alias("bucket"), F.col("_gaz").alias("in_gazette")).agg(F.count(F.lit(1)).alias("n"))
