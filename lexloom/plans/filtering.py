"""Filter queries."""

from pyspark.sql import functions as F

from lexloom.operators import filters
from lexloom.plans.registry import query


@query("fil1_years_and_limit", """SELECT document_id, year, title FROM legal_docs WHERE year IN (1996, 1997, 1998) ORDER BY ingest_ord DESC LIMIT 500""")
def _(t):
    return filters.select_docs(t.legal_docs, [1996, 1997, 1998], -500).select("document_id", "year", "title")


@query("fil2_min_year", "SELECT document_id, year FROM legal_docs WHERE year >= 1998 AND document_id % 10 <> 0")
def _(t):
    docs = t.legal_docs.withColumn("raw_year", F.when(F.col("document_id") % 10 == 0, "n/a").otherwise(F.col("year").cast("string")))
    return filters.since(docs, "raw_year", 1998).select("document_id", "year")


@query("fil3_section_codes", """SELECT document_id FROM legal_docs WHERE section IN ('DISPOSICIONS', '') AND document_id % 13 <> 0""")
def _(t):
    docs = t.legal_docs.withColumn("ident", F.concat(F.when(F.col("document_id") % 13 == 0, "BOE-S-").otherwise("BOE-A-"), F.col("document_id").cast("string")))
    return filters.filter_sections(docs, ["DISPOSICIONS", ""], "section").select("document_id")


@query("fil4_eligible_units", """SELECT ingest_ord FROM publications WHERE CAST(data_publicacio[1:4] AS INTEGER) BETWEEN 1996 AND 1999 AND url_pdf IS NOT NULL""")
def _(t):
    return filters.eligible_units(t.publications, 1996, 1999).select("ingest_ord")


@query("fil5_unresolved_targets", """SELECT CASE WHEN coalesce(butlleti, '') <> 'DOGC' OR url_pdf LIKE '%documentId=%' THEN 'not_wanted'
 WHEN CAST(data_publicacio[1:4] AS INTEGER) < 1997 THEN 'before_min_year' WHEN ingest_ord % 5 = 0 THEN 'attempted' ELSE 'target' END AS status, count(*) AS n
 FROM publications GROUP BY ALL""")
def _(t):
    p = t.publications.select(F.col("butlleti"), F.lit(False).alias("appears_in_dogc"), F.coalesce(F.col("url_pdf").contains("documentId="), F.lit(False)).alias("matched"),
                              F.substring("data_publicacio", 1, 4).cast("int").alias("year"), (F.col("ingest_ord") % 5 == 0).alias("attempted"))
    return filters.unresolved_status(p, 1997).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("fil6_unprocessed_sections", """SELECT section_id FROM legal_sections WHERE ord % 5 <> 0 AND ord % 3 <> 2""")
def _(t):
    n = t.legal_sections.select("section_id", F.col("section_id").alias("id"), F.array(F.lit("DocumentSection")).alias("labels"),
                                F.when(F.col("ord") % 3 == 0, F.col("text")).otherwise("").alias("text_es"),
                                F.when(F.col("ord") % 3 == 1, F.col("text")).alias("text_ca"), (F.col("ord") % 5 == 0).alias("done"))
    return filters.pending_sections(n, F.col("done")).select("section_id")


@query("fil7_legacy_pdf_docs", """SELECT document_id FROM legal_docs WHERE document_id % 3 <> 2 AND document_id % 4 <> 0""")
def _(t):
    k = F.col("document_id") % 3
    d = t.legal_docs.select("document_id", F.when(k == 0, "Disponible en PDF").when(k == 1, "Vegeu la Versió Catalana").alias("additional_text"),
                            F.when(F.col("document_id") % 4 != 0, F.col("pdf_url")).alias("pdf_url"))
    return filters.legacy_docs(d).select("document_id")


@query("fil8_valid_citation_ref", """WITH r AS (SELECT document_id, unnest([document_number, 'amb', 'GOV', split_part(document_number, '/', 1), section]) AS ref FROM legal_docs)
SELECT document_id, ref FROM r WHERE length(ref) > 2 AND regexp_matches(ref, '[0-9]')""")
def _(t):
    refs = F.array("document_number", F.lit("amb"), F.lit("GOV"), F.split_part("document_number", F.lit("/"), F.lit(1)), "section")
    return t.legal_docs.select("document_id", F.explode(refs).alias("ref")).filter(filters.valid_citation_ref(F.col("ref")))


@query("fil9_valid_article_num", """WITH r AS (SELECT section_id, unnest([CAST(ord AS VARCHAR), concat(CAST(ord AS VARCHAR), '-bis'), 'Primer', 'dotzè', title]) AS tok FROM legal_sections)
SELECT section_id, tok FROM r WHERE tok = 'Primer' OR regexp_matches(tok, '^[0-9]+[a-z0-9_-]*$')""")
def _(t):
    o = F.col("ord").cast("string")
    toks = F.array(o, F.concat(o, F.lit("-bis")), F.lit("Primer"), F.lit("dotzè"), F.col("title"))
    return t.legal_sections.select("section_id", F.explode(toks).alias("tok")).filter(filters.valid_article_token(F.col("tok")))


@query("fil10_drop_redundant_gazette_refs", """
WITH f AS (SELECT *, doc_type = 'DOGC' OR lower(coalesce(nullif(cited_title, ''), raw_text)) LIKE '%dogc%' AS g, regexp_matches(lower(raw_text), '\\bllei\\s+[0-9]+') AS nm,
  lower(doc_type) = 'llei' OR document_number <> '' AS sp FROM items),
s AS (SELECT *, max(sp) OVER (PARTITION BY source_id) AS anysp FROM f), k AS (SELECT *, NOT (g AND (anysp OR nm)) AS keep FROM s)
SELECT source_id, item_no FROM (SELECT *, max(keep) OVER (PARTITION BY source_id) AS anykeep FROM k) WHERE keep OR NOT anykeep""")
def _(t):
    return filters.drop_redundant_gazette_refs(t.items, ["source_id"]).select("source_id", "item_no")


@query("fil11_bulletins", "SELECT ingest_ord, butlleti FROM publications WHERE butlleti IN ('BOPG', 'BOPL')")
def _(t):
    return t.publications.filter(F.col("butlleti").isin("BOPG", "BOPL")).select("ingest_ord", "butlleti")


@query("fil12_text_search_hits", """SELECT doc_id, CAST((length(lower(text)) - length(replace(lower(text), 'the', ''))) / 3 AS BIGINT) AS hits FROM documents""")
def _(t):
    return filters.search_counts(t.documents, F.col("text"), "the", "doc_id").withColumn("hits", F.col("hits").cast("long"))
