"""Nested records to tables. Inputs are nested in the query from the given tables."""

from pyspark.sql import functions as F

from lexloom.operators import flatten
from lexloom.plans.registry import query

def _no():
    return F.lit(None).cast("string")


def nested_records(t):
    """Local records with a one-element list of publications each (see FLT3)."""
    p = t.publications
    pub = F.struct(p["fase"].alias("fase"), F.when(F.col("ingest_ord") % 4 == 0, "").otherwise(F.col("descripcio")).alias("descripcio"),
                   p["butlleti"].alias("butlleti"), _no().alias("numButlleti"), p["data_publicacio"].alias("dataPublicacio"),
                   p["url_pdf"].alias("urlPdf"), _no().alias("urlHtml"), F.lit(None).cast("boolean").alias("esVigent"),
                   F.lit(None).cast("boolean").alias("appearsInDogc"),
                   F.nullif(F.regexp_extract(F.coalesce("url_pdf", F.lit("")), r"documentId=(\d+)", 1), F.lit("")).alias("dogcDocumentId"))
    late = F.struct(F.lit("final").alias("fase"), F.lit("segona").alias("descripcio"), F.lit("BOPT").alias("butlleti"), _no().alias("numButlleti"),
                    F.lit("").alias("dataPublicacio"), _no().alias("urlPdf"), F.lit("https://h.example/x").alias("urlHtml"),
                    F.lit(True).alias("esVigent"), F.lit(False).alias("appearsInDogc"), _no().alias("dogcDocumentId"))
    return p.select(F.col("ingest_ord").alias("record_id"), "type", F.concat(F.lit("Expedient "), F.col("record_id").cast("string")).alias("title"),
                    F.lit("1996-01-01").alias("date"), F.lit("https://r.example").alias("url_record"), "institucio",
                    F.when(F.col("ingest_ord") % 2 == 0, F.array(pub)).otherwise(F.array(pub, late)).alias("documents"))


def structured_docs(t):
    """Documents with sections, descriptors and editorial links nested inside."""
    sec = lambda ty, ti, he, ps: F.struct(F.lit(ty).alias("type"), ti.alias("title"), he.alias("heading"), ps.alias("commas"))
    d = t.legal_docs
    none = F.array().cast("array<string>")
    secs = F.array(sec("introduction", F.lit("Preàmbul"), F.lit("Introducció"), none),
                   sec("article", F.concat(F.lit("Article "), F.col("document_id").cast("string")), F.col("organisme"), F.array(F.col("title"), F.col("dogc_number"))),
                   sec("quadre", F.lit(""), _no(), F.array(F.col("section"))))
    ent = lambda i, n: F.struct(i.alias("id"), n.alias("name"))
    desc = F.struct(F.array(ent(F.col("dogc_number"), F.concat("organisme", F.lit(" (77)")))).alias("organisms"),
                    F.array(ent(F.lit(""), F.lit("x"))).alias("geographic"),
                    F.array(ent(F.concat(F.lit(" t"), (F.col("document_id") % 9).cast("string")), F.coalesce("type", F.lit("")))).alias("thematic"))
    link = lambda tx_, ti: F.struct(tx_.alias("text"), ti.alias("targetDocumentId"))
    aff = F.struct(F.array(link(F.col("title"), F.lit("None")), link(F.col("title"), F.concat(F.lit(" "), (F.col("document_id") + 1).cast("string")))).alias("active"),
                   F.when(F.col("document_id") % 2 == 0, F.array(link(_no(), (F.col("document_id") * 2).cast("string")))).alias("passive"))
    return d.select("*", secs.alias("sections"), desc.alias("descriptors"), aff.alias("affectations"))


@query("flt1_flatten_issue_summary", """
WITH d AS (SELECT document_id, dogc_number, date_dogc, CAST(year AS VARCHAR) AS year, title, organisme, section, pdf_url FROM legal_docs)
SELECT CASE WHEN document_id % 11 = 0 THEN NULL ELSE CAST(document_id AS VARCHAR) END AS document_id, dogc_number, date_dogc, year,
  CASE WHEN section = '' THEN 'DISPOSICIONS' ELSE section END AS section, organisme, title, concat('direct ', title) AS tag FROM d WHERE FALSE
UNION ALL SELECT CAST(document_id AS VARCHAR), dogc_number, date_dogc, year, CASE WHEN section = '' THEN 'DISPOSICIONS' ELSE section END, 'Dept A', title, 'section' FROM d
UNION ALL SELECT NULL, dogc_number, date_dogc, year, CASE WHEN section = '' THEN 'DISPOSICIONS' ELSE section END, organisme, concat('H ', title), 'header' FROM d
UNION ALL SELECT CAST(document_id AS VARCHAR), dogc_number, date_dogc, year, CASE WHEN section = '' THEN 'DISPOSICIONS' ELSE section END, 'Sub', concat('S ', title), 'sub' FROM d""")
def _(t):
    d = t.legal_docs
    leaf = lambda title, pdf: F.struct(title.alias("title"), pdf.alias("linkDownloadDocumentPDF"), F.lit("None").alias("linkDownloadDocumentHTML"))
    url = F.concat(F.lit("https://x/pdf?documentId="), F.col("document_id").cast("string"))
    sub = F.struct(F.lit("Sub").alias("title"), F.array(leaf(F.concat(F.lit("S "), "title"), url)).alias("document"))
    head = F.struct(F.col("organisme").alias("title"), F.array(leaf(F.concat(F.lit("H "), "title"), _no())).alias("document"), F.array(sub).alias("subheader"))
    sec = F.struct(F.lit("Dept A").alias("title"), F.array(leaf(F.col("title"), url)).alias("document"), F.array(head).alias("header"))
    issue = F.to_json(F.struct(F.col("dogc_number").alias("numDOGC"), F.col("date_dogc").alias("dateDOGC"), F.col("section").alias("title"), F.array(sec).alias("section")))
    out = flatten.flatten_summary(d.select(issue.alias("j")), F.col("j"))
    return out.select("document_id", "dogc_number", "date_dogc", "year", "section", "organisme", "title",
                      F.when(F.col("title").startswith("S "), "sub").when(F.col("title").startswith("H "), "header").otherwise("section").alias("tag"))


@query("flt2_flatten_daily_bulletin", """
WITH d AS (SELECT *, concat('BOE-A-', CAST(document_id AS VARCHAR)) AS a, concat('BOE-B-', CAST(document_id AS VARCHAR)) AS b FROM legal_docs)
SELECT a AS identificador, title AS titulo, dogc_number AS fecha_publicacion, section AS seccion_nombre, 'Epi' AS epigrafe_nombre, pdf_url FROM d
UNION ALL SELECT b, title, dogc_number, section, NULL, html_url FROM d""")
def _(t):
    d = t.legal_docs
    item = lambda ident, pdf: F.struct(ident.alias("identificador"), F.col("title").alias("titulo"), pdf.alias("url_pdf"))
    i = F.col("document_id").cast("string")
    a, b, s = (item(F.concat(F.lit(p), i), u) for p, u in (("BOE-A-", F.struct(F.col("pdf_url").alias("texto"))), ("BOE-B-", F.col("html_url")), ("BOE-S-", F.col("html_url"))))
    epi = F.to_json(F.struct(F.lit("Epi").alias("nombre"), a.alias("item")))
    # odd documents use lists, even ones single objects, at each level
    listy = F.col("document_id") % 2 == 1
    wrap = lambda j: F.when(listy, F.concat(F.lit("["), j, F.lit("]"))).otherwise(j)
    j = F.concat(F.lit('{"codigo":"9","nombre":"Dep","epigrafe":'), wrap(epi), F.lit(',"item":['), F.to_json(b), F.lit(","), F.to_json(s), F.lit("]}"))
    j = F.concat(F.lit('{"codigo":"1","nombre":"'), F.col("section"), F.lit('","departamento":'), wrap(j), F.lit("}"))
    j = F.concat(F.lit('{"numero":"7","seccion":'), wrap(j), F.lit("}"))
    j = F.concat(F.lit('{"data":{"sumario":{"metadatos":{"fecha_publicacion":"'), F.col("dogc_number"), F.lit('"},"diario":'), wrap(j), F.lit("}}}"))
    return flatten.flatten_bulletin(d.select(j.alias("j")), F.col("j"), ["1"]).select(
        "identificador", "titulo", "fecha_publicacion", "seccion_nombre", "epigrafe_nombre", "pdf_url")


@query("flt3_explode_publications", """
SELECT ingest_ord AS record_id, 0 AS pos, type, data_publicacio AS date, coalesce(butlleti, 'OTHER') AS butlleti, coalesce(butlleti = 'DOGC', FALSE) AS appears_in_dogc,
 nullif(regexp_extract(coalesce(url_pdf, ''), 'documentId=(\\d+)', 1), '') AS dogc_document_id FROM publications
UNION ALL SELECT ingest_ord, 1, type, '1996-01-01', 'BOPT', FALSE, NULL FROM publications WHERE ingest_ord % 2 = 1""")
def _(t):
    return flatten.publications(nested_records(t)).select("record_id", "pos", "type", "date", "butlleti", "appears_in_dogc", "dogc_document_id")


@query("flt4_explode_sections", """
SELECT document_id, concat(CAST(document_id AS VARCHAR), '_sec_0') AS section_id, concat('sec_', CAST(document_id AS VARCHAR), '_1') AS alt_id, 'Introduction' AS type, 'Preàmbul' AS title, 'Introducció' AS text FROM legal_docs
UNION ALL SELECT document_id, concat(CAST(document_id AS VARCHAR), '_sec_1'), concat('sec_', CAST(document_id AS VARCHAR), '_2'), 'Article', concat('Article ', CAST(document_id AS VARCHAR)), concat(title, chr(10), dogc_number) FROM legal_docs
UNION ALL SELECT document_id, concat(CAST(document_id AS VARCHAR), '_sec_2'), concat('sec_', CAST(document_id AS VARCHAR), '_3'), 'Quadre', '', section FROM legal_docs""")
def _(t):
    return flatten.sections(structured_docs(t)).select("document_id", "section_id", "alt_id", "type", "title", "text")


@query("flt5_explode_descriptors", """
SELECT document_id, dogc_number AS descriptor_id, organisme AS name, 'Organism' AS type FROM legal_docs
UNION ALL SELECT document_id, concat('t', CAST(document_id % 9 AS VARCHAR)), type, 'Thematic' FROM legal_docs WHERE type IS NOT NULL""")
def _(t):
    return flatten.descriptors(structured_docs(t)).select("document_id", "descriptor_id", "name", "type")


@query("flt6_bulletin_documents", """
SELECT concat('cido_', CAST(ingest_ord AS VARCHAR), '_doc_0') AS id, ingest_ord AS cido_id, CASE WHEN ingest_ord % 4 = 0 THEN concat('Expedient ', CAST(record_id AS VARCHAR)) ELSE descripcio END AS title,
 butlleti AS bulletin, data_publicacio AS date, coalesce(url_pdf, 'https://r.example') AS link_to_text FROM publications WHERE butlleti = 'BOPG'
UNION ALL SELECT concat('cido_', CAST(ingest_ord AS VARCHAR), '_doc_1'), ingest_ord, 'segona', 'BOPT', '1996-01-01', 'https://h.example/x' FROM publications WHERE ingest_ord % 2 = 1""")
def _(t):
    return flatten.bulletin_documents(flatten.publications(nested_records(t)), ["BOPG", "BOPT"]).select(
        "id", "cido_id", "title", "bulletin", "date", "link_to_text")


@query("flt7_explode_affectations", """
SELECT document_id, 'active' AS direction, CAST(document_id + 1 AS VARCHAR) AS target_document_id, title AS text FROM legal_docs
UNION ALL SELECT document_id, 'passive', CAST(document_id * 2 AS VARCHAR), '' FROM legal_docs WHERE document_id % 2 = 0""")
def _(t):
    return flatten.affectations(structured_docs(t)).select("document_id", "direction", "target_document_id", "text")


@query("flt8_explode_references", """
SELECT document_id AS law_id, concat('L', CAST(target_document_id AS VARCHAR)) AS target_id, CASE WHEN ord = 1 THEN 'REFERENCIA' ELSE 'DEROGA' END AS relation, text FROM legal_affs
UNION ALL SELECT document_id, concat('P', CAST(ord AS VARCHAR)), direction, '' FROM legal_affs""")
def _(t):
    ref = lambda r, w, x: F.array(F.struct(r.alias("ref"), w.alias("word"), x.alias("text")))
    a = t.legal_affs.select(F.col("document_id").alias("law_id"),
                            ref(F.concat(F.lit("L"), F.col("target_document_id").cast("string")), F.when(F.col("ord") == 1, "").otherwise("DEROGA"), F.col("text")).alias("prior"),
                            F.concat(ref(F.concat(F.lit("P"), F.col("ord").cast("string")), F.col("direction"), _no()), ref(_no(), F.lit("x"), F.lit("y"))).alias("later"))
    return flatten.editorial_refs(a).select("law_id", "target_id", "relation", "text")


@query("flt9_package_bilingual", """
SELECT document_id, concat('ca ', title) AS ca_title, CASE WHEN document_id % 3 = 0 THEN concat('es ', title) END AS es_title,
 CASE WHEN document_id % 2 = 0 THEN 'eli/a' WHEN document_id % 3 = 0 THEN 'eli/b' ELSE '' END AS eli_uri, document_id % 3 = 0 AS has_es FROM legal_docs""")
def _(t):
    d = t.legal_docs
    ca = d.select("document_id", F.concat(F.lit("ca "), "title").alias("title"), F.when(F.col("document_id") % 2 == 0, "eli/a").otherwise("").alias("eli_uri"))
    es = d.filter(F.col("document_id") % 3 == 0).select("document_id", F.concat(F.lit("es "), "title").alias("title"), F.lit("eli/b").alias("eli_uri"))
    return flatten.package_bilingual(ca, es).select("document_id", F.col("ca.title").alias("ca_title"), F.col("es.title").alias("es_title"),
                                                    "eli_uri", F.col("es").isNotNull().alias("has_es"))


@query("flt10_shape_local_record", """
SELECT record_id, type, institucio, CASE WHEN record_id % 2 = 0 THEN 41.5 END AS lat, CASE type WHEN 'convenis' THEN 'c' WHEN 'oposicions' THEN 'p' WHEN 'contractacions' THEN 'k' WHEN 'subvencions' THEN 's' END AS first_detail,
 CASE type WHEN 'convenis' THEN 2 WHEN 'oposicions' THEN 4 WHEN 'contractacions' THEN 4 WHEN 'subvencions' THEN 3 ELSE 0 END AS n_details FROM records""")
def _(t):
    from lexloom import rules
    names = sorted({n for ns in rules.MODULE_DETAILS.values() for n in ns} - {"ambit"})
    firsts = {"codi": "c", "numPlaces": "p", "tipusContracte": "k", "tipusSubvencio": "s"}
    attrs = F.struct(F.lit("i").alias("identificador"), F.lit("").alias("titol"), F.lit("u").alias("urlCido"),
                     F.when(F.col("record_id") % 2 == 0, F.col("institucio")).alias("institucioDesenvolupat"), F.col("institucio").alias("ambit"),
                     F.col("es_vigent").alias("esVigent"), F.col("date").alias("maxDataPublicacioDocument"),
                     F.lit("41.5").alias("latitud"), F.when(F.col("record_id") % 2 == 0, "2.1").alias("longitud"),
                     *[F.lit(firsts.get(n, "v")).alias(n) for n in names])
    out = flatten.shape_records(t.records.select(F.col("record_id").alias("id"), F.col("type").alias("module"), attrs.alias("attributes")))
    first = F.get(F.map_values("detalls"), F.lit(0))
    return out.select("record_id", "type", "institucio", F.col("location.lat").alias("lat"),
                      first.alias("first_detail"), F.size("detalls").alias("n_details"))
