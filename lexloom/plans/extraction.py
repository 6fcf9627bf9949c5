"""Segmentation and citation queries, and the flagship share of resolved citations."""

from pyspark.sql import functions as F

from lexloom.operators import cite, segment
from lexloom.plans.registry import query

# ---- pieces of the SQL checks ------------------------------------------------------------
SQL_PARAS = """p AS (SELECT *, CASE WHEN text LIKE 'Capítol %' THEN 'chapter' WHEN text LIKE 'Article %' THEN 'article' WHEN text LIKE 'Barcelona,%' THEN 'signature' END AS kind FROM legal_paras),
np AS (SELECT *, CAST(sum(CASE WHEN kind IS NULL THEN 0 ELSE 1 END) OVER w AS BIGINT) AS section_no, last_value(CASE WHEN kind = 'chapter' THEN text END IGNORE NULLS) OVER w AS chapter FROM p
  WINDOW w AS (PARTITION BY document_id ORDER BY ord ROWS UNBOUNDED PRECEDING))"""
SQL_CITES = SQL_PARAS + """,
c0 AS (SELECT document_id, section_no, text FROM np WHERE text LIKE 'D''acord%'),
c AS (SELECT document_id, section_no, 'Llei' AS kind, regexp_extract(text, 'la Llei (\\d+/\\d+)', 1) AS num, concat('Article ', regexp_extract(text, 'article (\\d+)', 1)) AS article FROM c0
  UNION ALL SELECT document_id, section_no, 'Decret', regexp_extract(text, 'el Decret (\\d+/\\d+)', 1), '' FROM c0),
r AS (SELECT c.document_id, c.section_no, c.kind, c.num, c.article, min(d.document_id) AS target_id FROM c LEFT JOIN legal_docs d
  ON d.document_number = c.num AND lower(split_part(d.title, ' ', 1)) = lower(c.kind) AND d.document_id <> c.document_id GROUP BY ALL)"""


def paragraphs(t):
    return segment.section_paragraphs(t.legal_paras)


def citations(t, with_section=False):
    p = paragraphs(t)
    return cite.extract_citations(p, t.legal_docs, segment.section_rows(p) if with_section else None)


@query("flagship_citation_share", f"""WITH {SQL_CITES} SELECT lower(kind) AS cited_type, count(*) AS citations, count(target_id) AS resolved,
 round(100.0 * count(target_id) / count(*), 4) AS resolved_pct FROM r GROUP BY ALL""")
def _(t):
    c = citations(t)
    return c.groupBy(F.lower("ref_type").alias("cited_type")).agg(
        F.count(F.lit(1)).alias("citations"), F.count_if("is_mapped").alias("resolved"),
        F.round(100.0 * F.count_if("is_mapped") / F.count(F.lit(1)), 4).alias("resolved_pct"))


@query("seg1_paragraphs_to_sections", f"""WITH {SQL_PARAS},
s AS (SELECT document_id, section_no, max(kind) AS kind, max(CASE WHEN kind IS NOT NULL THEN text END) AS head, max(chapter) AS chapter,
  count(*) FILTER (WHERE kind IS NULL OR kind = 'signature') AS n_paras FROM np GROUP BY ALL)
SELECT document_id, section_no, coalesce(kind, 'introduction') AS type,
 CASE kind WHEN 'chapter' THEN head WHEN 'article' THEN split_part(head, '.', 1) WHEN 'signature' THEN 'Signatures' ELSE 'Preàmbul' END AS title,
 CASE WHEN kind IS NULL THEN 'Introducció' WHEN kind = 'article' THEN split_part(head, '. ', 2) END AS heading, chapter, n_paras FROM s""")
def _(t):
    return segment.section_rows(paragraphs(t)).select("document_id", "section_no", "type", "title", "heading", "chapter", "n_paras")


@query("seg1_section_text", f"""WITH {SQL_PARAS} SELECT document_id, section_no, ord // 4096 AS piece, string_agg(text, chr(10) ORDER BY ord) AS text FROM np WHERE kind IS NULL OR kind = 'signature' GROUP BY ALL""")
def _(t):
    return segment.section_text(paragraphs(t)).select("document_id", "section_no", "piece", "text")


SQL_PAGE_TEXT = """b AS (SELECT page_id, regexp_split_to_array(regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '(?s)<h1>.*?</h1>', ''), '</?p>') AS parts FROM pages),
x AS (SELECT page_id, list_filter(list_transform(parts, lambda v: trim(regexp_replace(replace(replace(regexp_replace(v, '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g'))), lambda v: v <> '') AS paras FROM b)"""


@query("seg2_html_to_sections", f"""WITH {SQL_PAGE_TEXT}
SELECT page_id, 0 AS section_no, 'introduction' AS type, 'Preamble' AS title, NULL AS heading, NULL AS chapter, len(paras) AS n_paras, CAST(list_sum(list_transform(paras, lambda v: length(v))) AS BIGINT) AS n_chars FROM x WHERE len(paras) > 0
UNION ALL SELECT page_id, 1, 'article', 'Article 1', 'Objecte', NULL, 2, 35 FROM pages UNION ALL SELECT page_id, 2, 'article', 'Article 2', 'Segon', NULL, 2, 21 FROM pages""")
def _(t):
    return segment.page_sections(html_paragraphs(t)).select("page_id", "section_no", "type", "title", "heading", "chapter", "n_paras", "n_chars")


def html_pages(t):
    """The given pages, their article element playing the published-text container, with a table and an image in articles."""
    n = F.col("page_id").cast("string")
    more = F.concat(F.lit("<p>Article 1</p><p>Objecte</p><p>Text de la norma</p><table><tr><th>Clau</th><th>Valor</th></tr><tr><td>pagina</td><td>"), n,
                    F.lit('</td></tr></table><p>Article 2. Segon</p><p>Fi</p><img src="/img/'), n, F.lit('.png" alt="foto" title="peu"></article>'))
    return t.pages.withColumn("html", F.replace(F.replace("html", F.lit("<article>"), F.lit('<article id="fullText">')), F.lit("</article>"), more))


def html_paragraphs(t):
    return segment.page_paragraphs(segment.page_blocks(html_pages(t)))


@query("seg2_html_fields", """SELECT page_id, 'Unknown' AS document_id, CASE WHEN html LIKE '%<h1>%' THEN TRUE ELSE FALSE END AS has_title FROM pages""")
def _(t):
    return segment.page_fields(html_pages(t)).select("page_id", "document_id", (F.col("title") != "Unknown Title").alias("has_title"))


@query("seg2_html_attachments", """SELECT page_id, 'att_1' AS attachment_id, 'table' AS type, 'Article 1' AS section_title, concat('| Clau | Valor |', chr(10), '| --- | --- |', chr(10), '| pagina | ', CAST(page_id AS VARCHAR), ' |') AS content_text, NULL AS image_src FROM pages
UNION ALL SELECT page_id, 'att_2', 'image', 'Article 2', NULL, concat('/img/', CAST(page_id AS VARCHAR), '.png') FROM pages""")
def _(t):
    return segment.page_attachments(html_paragraphs(t)).select("page_id", "attachment_id", "type", "section_title", "content_text",
                                                               F.col("content_image.src").alias("image_src"))


@query("seg3_xml_blocks", """WITH p AS (SELECT *, text LIKE 'Article %' AS head FROM legal_paras),
np AS (SELECT *, CAST(sum(CASE WHEN head THEN 1 ELSE 0 END) OVER (PARTITION BY document_id ORDER BY ord) AS BIGINT) AS block_no FROM p)
SELECT document_id AS law_id, block_no, concat(CAST(document_id AS VARCHAR), '#', coalesce(max(CASE WHEN head THEN text END), 'Preámbulo')) AS id,
 count(*) FILTER (WHERE NOT head) AS n_paras, CAST(sum(length(text)) FILTER (WHERE NOT head) AS BIGINT) AS n_chars FROM np GROUP BY document_id, block_no HAVING count(*) FILTER (WHERE NOT head) > 0""")
def _(t):
    p = t.legal_paras.select(F.col("document_id").alias("law_id"), "ord", F.when(F.col("text").startswith("Article "), "articulo").otherwise("parrafo").alias("cls"), "text")
    return segment.block_rows(segment.xml_blocks(p)).select("law_id", "block_no", "id", "n_paras", "n_chars")


@query("seg4_offset_sections", """SELECT doc_id, 0 AS section_no, 'body' AS type, 'Body' AS title, 0 AS start_offset, CAST(CASE WHEN trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 0 ELSE length(text) END AS INT) AS end_offset FROM documents""")
def _(t):
    return segment.offset_sections(t.documents)


@query("seg4_offset_sections_laws", """SELECT document_id AS doc_id, 0 AS section_no, 'article' AS type, 'Article 1. Objecte' AS title, 0 AS start_offset, CAST(19 + length(title) + 1 AS INT) AS end_offset FROM legal_docs
UNION ALL SELECT document_id, 1, 'article', concat('Article 2 ', organisme), CAST(19 + length(title) + 1 AS INT), CAST(19 + length(title) + 1 + 10 + length(organisme) + 2 AS INT) FROM legal_docs
UNION ALL SELECT document_id, 2, 'signature', 'Signatures: Barcelona, 3 de maig de 1999', CAST(19 + length(title) + 1 + 10 + length(organisme) + 2 AS INT), CAST(19 + length(title) + 1 + 10 + length(organisme) + 2 + 28 AS INT) FROM legal_docs""")
def _(t):
    text = F.concat(F.lit("Article 1. Objecte\n"), "title", F.lit("\nArticle 2 "), "organisme", F.lit("\n\nBarcelona, 3 de maig de 1999"))
    return segment.offset_sections(t.legal_docs.select(F.col("document_id").alias("doc_id"), text.alias("text")))


@query("seg5_isolate_document", """WITH d AS (SELECT document_id AS doc_id, 20 * length(concat('Altres 5/1990 ', organisme, '. ')) + strpos(title, document_number) AS named, 20 * length(concat('Altres 5/1990 ', organisme, '. ')) + 1 + length(title) + 2 + 30 * length(concat(title, ' text. ')) AS head FROM legal_docs)
SELECT doc_id, CAST(greatest(named - 100, 0) AS INT) AS start_offset, CAST(head AS INT) AS end_offset FROM d""")
def _(t):
    issue = F.concat(F.repeat(F.concat(F.lit("Altres 5/1990 "), "organisme", F.lit(". ")), 20), F.lit("\n"), "title", F.lit(". "),
                     F.repeat(F.concat("title", F.lit(" text. ")), 30), F.lit("\n## DECRETO seguent "), "dogc_number")
    return segment.isolate(t.legal_docs.select(F.col("document_id").alias("doc_id"), issue.alias("text"), "title", F.col("document_number").alias("number")))


@query("seg6_align_bilingual", """SELECT document_id, ord, title, CASE WHEN ord % 3 = 0 THEN '' ELSE concat('Artículo ', CAST(ord AS VARCHAR)) END AS title_es, ord % 3 <> 0 AS is_bilingual FROM legal_sections""")
def _(t):
    es = t.legal_sections.filter("ord % 3 <> 0").withColumn("title", F.concat(F.lit("Artículo "), F.col("ord").cast("string")))
    return segment.align_sections(t.legal_sections, es).select("document_id", "ord", "title", "title_es", "is_bilingual")


@query("cit1_clause_citations", f"""WITH {SQL_CITES},
h AS (SELECT document_id AS doc, min(section_no) AS section, split_part(text, '.', 1) AS title FROM np WHERE kind = 'article' GROUP BY ALL)
SELECT r.document_id, r.section_no, r.target_id, concat(r.kind, ' ', r.num) AS cited, r.article, h.section AS target_section, r.target_id IS NOT NULL AS is_mapped
FROM r LEFT JOIN h ON h.doc = r.target_id AND h.title = r.article""")
def _(t):
    return citations(t, True).select("document_id", "section_no", "target_id", "cited", "article", "target_section", "is_mapped")


@query("cit2_simple_citations", """SELECT section_id, 0 AS cit_no, concat('ref_', replace(regexp_extract(text, 'la Llei (\\d+/\\d+)', 1), '/', '_')) AS target, concat('Llei ', regexp_extract(text, 'la Llei (\\d+/\\d+)', 1)) AS raw_text FROM legal_sections
UNION ALL SELECT section_id, 1, concat('ref_', replace(regexp_extract(text, 'el Decret (\\d+/\\d+)', 1), '/', '_')), concat('Decret ', regexp_extract(text, 'el Decret (\\d+/\\d+)', 1)) FROM legal_sections""")
def _(t):
    return cite.simple_citations(t.legal_sections, ["section_id"])


@query("cit3_affectation_action", """SELECT document_id, ord, CASE split_part(text, ' ', 1) WHEN 'Deroga' THEN 'Abrogate' WHEN 'Modifica' THEN 'Modify' ELSE 'Other' END AS action,
 concat('Article ', regexp_extract(text, 'article (\\d+)', 1)) AS affected FROM legal_affs""")
def _(t):
    return cite.classify_affectations(t.legal_affs).select("document_id", "ord", "action", F.array_join("affected", "|").alias("affected"))


@query("cit4_doc_ref", "SELECT document_id, ord, regexp_extract(text, '(Llei \\d+/\\d+)', 1) AS doc_ref FROM legal_affs")
def _(t):
    return t.legal_affs.select("document_id", "ord", cite.doc_ref("text").alias("doc_ref"))


@query("cit5_affected_from_source", """SELECT section_id, concat('Article ', CAST(ord AS VARCHAR)) AS affected FROM legal_sections WHERE ord % 2 = 0""")
def _(t):
    # even sections name their own target law; odd ones are asked about another one
    ref = F.when(F.col("ord") % 2 == 0, F.regexp_extract("text", r"(Llei \d+/\d+)", 1)).otherwise("Ordre 999/1901")
    s = t.legal_sections.select("section_id", "text", ref.alias("doc_ref"))
    return cite.affected_from_source(s, ["section_id"]).select("section_id", "affected")


def national(t):
    """Blocks and editorial references of a national law, from order lines."""
    li = t.lineitem_rn
    y, n = F.year("l_shipdate").cast("string"), (F.col("l_partkey") % 97 + 1).cast("string")
    m = (F.col("l_suppkey") % 97 + 1).cast("string")
    blocks = li.select(F.col("l_orderkey").alias("law_id"), F.col("rn").alias("block_no"), F.concat(F.lit("Artículo "), F.col("rn").cast("string")).alias("name"),
                       F.concat(F.lit("Según el artículo "), F.col("rn").cast("string"), F.lit(" de la Ley "), n, F.lit("/"), y, F.lit(" y el Real  Decreto "), m, F.lit("/"), y, F.lit(".")).alias("text"))
    refs = li.select(F.col("l_orderkey").alias("law_id"), F.col("rn").alias("ref_no"), F.concat(F.lit("BOE-A-"), F.col("l_partkey").cast("string")).alias("target_id"),
                                          F.lit("SE DEROGA").alias("relation"), F.concat(F.when(F.col("rn") % 4 == 0, "el art. 7 de la Ley ").otherwise("Ley "), n, F.lit("/"), y).alias("text"))
    kind = F.get(F.array(*[F.lit(x) for x in ("Ley", "Real Decreto", "Orden", "Resolución", "Anuncio")]), (F.col("document_id") % 5).cast("int"))
    docs = t.legal_docs.select(F.concat(F.lit("BOE-A-"), F.col("document_id").cast("string")).alias("identificador"), "ingest_ord",
                               F.concat(kind, F.lit("  "), "document_number", F.lit(", de 3 de mayo")).alias("titulo"))
    return blocks, refs, docs


SQL_NATIONAL = """li AS (SELECT l_orderkey AS law_id, rn, concat(CAST(l_partkey % 97 + 1 AS VARCHAR), '/', CAST(year(l_shipdate) AS VARCHAR)) AS ley,
  concat(CAST(l_suppkey % 97 + 1 AS VARCHAR), '/', CAST(year(l_shipdate) AS VARCHAR)) AS rd, concat('BOE-A-', CAST(l_partkey AS VARCHAR)) AS target_id FROM lineitem_rn),
b AS (SELECT law_id, rn AS block_no, ley, rd, concat('Según el artículo ', CAST(rn AS VARCHAR), ' de la Ley ', ley, ' y el Real  Decreto ', rd, '.') AS text FROM li),
tagged AS (SELECT DISTINCT b.law_id, b.block_no, li.rn AS ref_no, li.target_id, CASE WHEN li.rn % 4 = 0 THEN '7'
   ELSE CAST(b.block_no AS VARCHAR) END AS art FROM b JOIN li ON li.law_id = b.law_id AND contains(b.text, li.ley)),
sig AS (SELECT lower(concat(CASE document_id % 5 WHEN 0 THEN 'ley ' WHEN 1 THEN 'real decreto ' WHEN 2 THEN 'orden ' ELSE 'resolución ' END, document_number)) AS signature, concat('BOE-A-', CAST(max(document_id) AS VARCHAR)) AS target_id FROM legal_docs WHERE document_id % 5 < 4 GROUP BY ALL)"""


@query("cit6_tagged_references", f"""WITH {SQL_NATIONAL} SELECT law_id AS citing_law, block_no, target_id AS cited_law, art AS cited_article FROM tagged""")
def _(t):
    blocks, refs, _docs = national(t)
    return cite.tagged_citations(blocks, refs).select("citing_law", "block_no", "cited_law", "cited_article")


@query("cit7_signature_index", f"""WITH {SQL_NATIONAL} SELECT signature, target_id FROM sig""")
def _(t):
    return cite.signature_index(national(t)[2])


@query("cit8_untagged_references", f"""WITH {SQL_NATIONAL},
u AS (SELECT law_id, block_no, concat('ley ', ley) AS signature, CAST(block_no AS VARCHAR) AS art, concat('Ley ', ley) AS context FROM b UNION ALL SELECT law_id, block_no, concat('real decreto ', rd), 'Todo', concat('Real  Decreto ', rd) FROM b)
SELECT u.law_id AS citing_law, u.block_no, sig.target_id AS cited_law, u.art AS cited_article, u.context FROM u JOIN sig USING (signature)
WHERE NOT EXISTS (SELECT 1 FROM tagged g WHERE g.law_id = u.law_id AND g.block_no = u.block_no AND g.target_id = sig.target_id)""")
def _(t):
    blocks, refs, docs = national(t)
    tagged = cite.tagged_citations(blocks, refs)
    return cite.untagged_citations(blocks, cite.signature_index(docs), tagged).select("citing_law", "block_no", "cited_law", "cited_article", "context")


@query("cit9_split_compound_articles", """SELECT section_id, 0 AS part_no, CAST(ord AS VARCHAR) AS article FROM legal_sections UNION ALL SELECT section_id, 1, concat(CAST(ord AS VARCHAR), '.3') FROM legal_sections
UNION ALL SELECT section_id, 2, '12.1 bis' FROM legal_sections""")
def _(t):
    o = F.col("ord").cast("string")
    s = t.legal_sections.select("section_id", F.concat(F.lit("arts. "), o, F.lit(", "), o, F.lit(".3 y 12.1 bis")).alias("article_or_section"))
    return cite.split_articles(s, ["section_id"])
