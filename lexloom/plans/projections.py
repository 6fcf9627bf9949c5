"""Match keys, dates, identifiers, types and markup as table jobs."""

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import doctype, ids, markup, text as tx
from lexloom.operators import project
from lexloom.plans.registry import query

# ---- pieces of the SQL checks ------------------------------------------------------------
W = "a-z0-9_à-öø-ÿ"


def sql_text_key(c):
    return f"trim(regexp_replace(regexp_replace(lower({c}), '[^{W}\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def sql_strip(c, prefixes):
    for p in prefixes:
        c = f"trim(regexp_replace({c}, '^{p}', ''))"
    return c


def sql_title_key(c):
    return sql_strip(sql_text_key(c), rules.TITLE_PREFIXES)


def sql_section_key(c):
    return (f"regexp_replace(strip_accents(replace(replace(replace(lower({c}),'artículo','article'),"
            "'articulo','article'),'art.','article')), '[^a-z0-9]', '', 'g')")


def sql_squeeze(c):
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


DATE = "concat(CAST(year(o_orderdate) AS VARCHAR), '-', CAST(month(o_orderdate) AS VARCHAR), '-', CAST(day(o_orderdate) AS VARCHAR))"


@query("prj1_match_key_title", f"SELECT id, {sql_title_key('title')} AS title_key FROM bulletin_feed")
def _(t):
    return t.bulletin_feed.select("id", tx.title_key("title").alias("title_key"))


@query("prj2_match_key_text", f"SELECT id, {sql_text_key('title')} AS text_key FROM bulletin_feed")
def _(t):
    return t.bulletin_feed.select("id", tx.text_key("title").alias("text_key"))


@query("prj3_match_key_alnum",
       "SELECT id, regexp_replace(lower(title), '[^a-z0-9à-üçï]', '', 'g') AS alnum_key FROM bulletin_feed")
def _(t):
    return t.bulletin_feed.select("id", tx.alnum_key("title").alias("alnum_key"))


@query("prj4_entity_key",
       f"SELECT document_id, {sql_squeeze(f'''regexp_replace(lower(title), '[^{W}\\s/]', '', 'g')''')} AS entity_key FROM legal_docs")
def _(t):
    return t.legal_docs.select("document_id", tx.entity_key("title").alias("entity_key"))


@query("prj5_eli_key", """
WITH u AS (SELECT document_id, concat(CASE document_id % 3 WHEN 0 THEN 'https://host.example/' WHEN 1 THEN '/' ELSE '' END,
  'ELI/es-cat/l/', CAST(year AS VARCHAR), '/', CAST(document_id AS VARCHAR), CASE WHEN document_id % 2 = 0 THEN '/dof/cat' ELSE '/' END) AS uri FROM legal_docs)
SELECT document_id, trim(regexp_replace(regexp_replace(regexp_replace(lower(uri), '^https?://[^/]+/', ''), '^/?(eli/)?', ''), '/dof(/.*)?$', ''), '/') AS eli_key FROM u""")
def _(t):
    uri = F.concat(F.when(F.col("document_id") % 3 == 0, "https://host.example/")
                   .when(F.col("document_id") % 3 == 1, "/").otherwise(""),
                   F.lit("ELI/es-cat/l/"), F.col("year").cast("string"), F.lit("/"),
                   F.col("document_id").cast("string"),
                   F.when(F.col("document_id") % 2 == 0, "/dof/cat").otherwise("/"))
    return t.legal_docs.select("document_id", tx.eli_key(uri).alias("eli_key"))


@query("prj6_section_key_compact",
       f"SELECT section_id, {sql_section_key('title')} AS section_key FROM legal_sections")
def _(t):
    return t.legal_sections.select("section_id", tx.section_key("title").alias("section_key"))


@query("prj7_section_key_words", """SELECT section_id,
  trim(regexp_replace(regexp_replace(regexp_replace(lower(title), '\\barticle\\b', 'art', 'g'), '\\banexo\\b', 'annex', 'g'), '[^a-z0-9\\s]', '', 'g')) AS section_words
FROM legal_sections""")
def _(t):
    return t.legal_sections.select("section_id", tx.section_words("title").alias("section_words"))


@query("prj8_label_name", """SELECT document_id, CASE WHEN type IS NULL THEN 'Other' ELSE concat(upper(type[1]), lower(type[2:])) END AS label FROM legal_docs""")
def _(t):
    return t.legal_docs.select("document_id", tx.label_name("type").alias("label"))


@query("prj9_slug", """SELECT document_id, trim(regexp_replace(lower(strip_accents(title)), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM legal_docs""")
def _(t):
    return t.legal_docs.select("document_id", tx.slug("title").alias("slug"))


@query("prj10_date_parts", """
WITH d AS (SELECT o_orderkey AS document_id, CASE o_orderkey % 4
  WHEN 0 THEN concat(CAST(day(o_orderdate) AS VARCHAR), '/', CAST(month(o_orderdate) AS VARCHAR), '/', CAST(year(o_orderdate) AS VARCHAR))
  WHEN 1 THEN concat(CAST(year(o_orderdate) AS VARCHAR), '-', CAST(month(o_orderdate) AS VARCHAR), '-', CAST(day(o_orderdate) AS VARCHAR))
  WHEN 2 THEN concat('any ', CAST(year(o_orderdate) AS VARCHAR)) ELSE '' END AS raw FROM orders)
SELECT document_id, CASE document_id % 4 WHEN 0 THEN split_part(raw,'/',3) WHEN 1 THEN split_part(raw,'-',1) WHEN 2 THEN raw[5:] ELSE '0000' END AS year,
 CASE document_id % 4 WHEN 0 THEN lpad(split_part(raw,'/',2),2,'0') WHEN 1 THEN lpad(split_part(raw,'-',2),2,'0') ELSE '00' END AS month,
 CASE document_id % 4 WHEN 0 THEN lpad(split_part(raw,'/',1),2,'0') WHEN 1 THEN lpad(split_part(raw,'-',3),2,'0') ELSE '00' END AS day,
 CASE document_id % 4 WHEN 0 THEN split_part(raw,'/',3) WHEN 1 THEN split_part(raw,'-',1) WHEN 2 THEN raw[5:] ELSE '0000' END AS year_anywhere FROM d""")
def _(t):
    y, m, d = F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")
    k = F.col("o_orderkey") % 4
    raw = (F.when(k == 0, F.concat_ws("/", d, m, y)).when(k == 1, F.concat_ws("-", y, m, d))
           .when(k == 2, F.concat(F.lit("any "), y)).otherwise(""))
    df = t.orders.select(F.col("o_orderkey").alias("document_id"), raw.alias("raw"))
    yy, mm, dd = ids.date_parts("raw")
    return df.select("document_id", yy.alias("year"), mm.alias("month"), dd.alias("day"),
                     ids.date_parts("raw", "anywhere")[0].alias("year_anywhere"))


@query("prj11_iso_date", """SELECT id, concat(split_part(date,'/',3), '-', split_part(date,'/',2), '-', split_part(date,'/',1)) AS iso_date FROM bulletin_feed""")
def _(t):
    return t.bulletin_feed.select("id", ids.iso_date("date").alias("iso_date"))


@query("prj12_sub_doc_year", """SELECT ingest_ord, CASE WHEN pos % 3 = 0 THEN 0 ELSE CAST(data_publicacio[1:4] AS INTEGER) END AS year FROM publications""")
def _(t):
    date = F.when(F.col("pos") % 3 == 2, F.col("data_publicacio"))
    url = F.when(F.col("pos") % 3 == 1, F.concat(F.lit("https://x.example/"), F.replace(
        "data_publicacio", F.lit("-"), F.lit("/")), F.lit("/a.pdf")))
    return t.publications.select("ingest_ord", ids.publication_year(date, url).alias("year"))


@query("prj13_doc_id_from_url", """SELECT ingest_ord, nullif(regexp_extract(url_pdf, 'documentId=(\\d+)', 1), '') AS doc_id FROM publications""")
def _(t):
    return t.publications.select("ingest_ord", ids.url_doc_id("url_pdf").alias("doc_id"))


@query("prj14_issue_from_url", """SELECT document_id, CASE WHEN document_id % 5 = 4 THEN NULL ELSE dogc_number END AS issue_number FROM legal_docs""")
def _(t):
    k, n = F.col("document_id") % 5, F.col("dogc_number")
    url = (F.when(k == 0, F.concat(F.lit("https://x/PDF/"), n, F.lit("/1.pdf")))
           .when(k == 1, F.concat(F.lit("https://x/?numDOGC="), n))
           .when(k == 2, F.concat(F.lit("https://x/DOGC_19990101_00"), n, F.lit("_1.pdf")))
           .when(k == 4, "https://x/other"))
    fallback = F.when(k == 3, n).when(k == 4, "n/a")
    return t.legal_docs.select("document_id", ids.issue_number(url, fallback).alias("issue_number"))


@query("prj15_org_key", f"SELECT document_id, {sql_strip(sql_title_key('organisme'), rules.ORG_PREFIXES)} AS org_key FROM legal_docs")
def _(t):
    return t.legal_docs.select("document_id", tx.org_key("organisme").alias("org_key"))


@query("prj16_doc_type_from_title", "SELECT document_id, split_part(title, ' ', 1) AS type FROM legal_docs")
def _(t):
    return project.fill_document_types(t.legal_docs).select("document_id", "type")


@query("prj17_doc_type_from_text", """SELECT document_id, CASE split_part(title, ' ', 1) WHEN 'LLEI' THEN 'Llei' WHEN 'DECRET' THEN 'Decret'
 WHEN 'ORDRE' THEN 'Ordre' WHEN 'ACORD' THEN 'Acord' ELSE 'Anunci' END AS type FROM legal_docs""")
def _(t):
    return t.legal_docs.select("document_id", doctype.type_from_text("title").alias("type"))


@query("prj18_doc_type_prefix", """SELECT document_id, CASE split_part(title, ' ', 1) WHEN 'LLEI' THEN 'Llei' WHEN 'DECRET' THEN 'Decret'
 WHEN 'ORDRE' THEN 'Ordre' WHEN 'ACORD' THEN 'Acord' ELSE 'Anunci' END AS type FROM legal_docs""")
def _(t):
    return t.legal_docs.select("document_id", doctype.type_from_prefix("title").alias("type"))


@query("prj19_document_type_of_node", """
WITH d AS (SELECT id, document_id, CASE WHEN document_id % 4 = 1 AND extra_label IS NOT NULL THEN extra_label WHEN extra_label IS NOT NULL THEN extra_label ELSE
  CASE split_part(title, ' ', 1) WHEN 'LLEI' THEN 'Llei' WHEN 'DECRET' THEN 'Decret' WHEN 'ORDRE' THEN 'Ordre' WHEN 'ACORD' THEN 'Acord' ELSE 'Anunci' END END AS t
  FROM graph_nodes WHERE label = 'Document')
SELECT n.id, coalesce(d.t, 'Unknown') AS document_type FROM graph_nodes n LEFT JOIN d ON d.document_id = n.document_id""")
def _(t):
    nodes = t.graph_nodes.select("id", F.array_compact(F.array("label", "extra_label")).alias("labels"),
                                 F.lit(None).cast("string").alias("type_of_law"), "title",
                                 F.lit(None).cast("string").alias("text"), F.lit("Unknown").alias("own_type"))
    edges = t.graph_edges.filter(F.col("type") == "HAS_SECTION")
    prefix = F.regexp_extract("id", r"^s(\d+)_", 1)
    return project.node_document_type(nodes.withColumn("doc_prefix", F.concat(F.lit("d"), F.nullif(prefix, F.lit("")))), edges)


@query("prj20_eli_ids", """SELECT document_id, CASE WHEN document_id % 10 = 0 THEN concat('eli/given/', CAST(document_id AS VARCHAR))
 ELSE concat('eli/es-cat/doc/', split_part(date_dogc,'/',3), '/', split_part(date_dogc,'/',2), '/', split_part(date_dogc,'/',1), '/', CAST(document_id AS VARCHAR)) END AS doc_eli,
 concat('eli/es-cat/dogc/', split_part(date_dogc,'/',3), '/', split_part(date_dogc,'/',2), '/', split_part(date_dogc,'/',1), '/', dogc_number) AS issue_eli,
 concat('eli/es-cat/materia/', trim(regexp_replace(lower(organisme), '[^a-z0-9]+', '_', 'g'), '_')) AS topic_eli FROM legal_docs""")
def _(t):
    given = F.when(F.col("document_id") % 10 == 0, F.concat(F.lit("eli/given/"), F.col("document_id").cast("string")))
    return project.with_elis(t.legal_docs.withColumn("eli_uri", given)).select(
        "document_id", "doc_eli", "issue_eli", F.concat(F.lit("eli/es-cat/materia/"), tx.slug("organisme")).alias("topic_eli"))


@query("prj21_module_prefix", """SELECT record_id, CASE type WHEN 'normatives-locals' THEN 'cido-norm' WHEN 'subvencions' THEN 'cido-subv'
 WHEN 'contractacions' THEN 'cido-cont' WHEN 'oposicions' THEN 'cido-opos' ELSE 'cido-conv' END AS prefix FROM records""")
def _(t):
    return t.records.select("record_id", ids.module_prefix("type").alias("prefix"))


@query("prj22_link_to_text", """SELECT id, CASE WHEN link_to_text IS NOT NULL THEN trim(link_to_text) ELSE concat('fallback/', id) END AS link FROM bulletin_feed""")
def _(t):
    return t.bulletin_feed.select("id", tx.link_to_text("link_to_text", F.lit("  "), F.concat(F.lit("fallback/"), "id")).alias("link"))


@query("prj23_article_number", """SELECT section_id, CASE ord % 7 WHEN 0 THEN 'Únic' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '5' WHEN 4 THEN '12-bis' WHEN 5 THEN '12BIS' ELSE CAST(ord AS VARCHAR) END AS number FROM legal_sections""")
def _(t):
    words = ["Únic", "Primer", "segundo", "Cinquè", "12-Bis", "12bis"]
    raw = F.coalesce(F.get(F.array(*[F.lit(w) for w in words]), F.col("ord") % 7), F.col("ord").cast("string"))
    return t.legal_sections.select("section_id", tx.article_number(raw).alias("number"))


@query("prj24_article_from_title", """SELECT section_id, CASE WHEN title LIKE 'Article%' THEN split_part(title, ' ', 2) END AS article FROM legal_sections""")
def _(t):
    return t.legal_sections.select("section_id", tx.article_from_title("title").alias("article"))


@query("prj25_descriptor_name", "SELECT document_id, organisme AS name FROM legal_docs")
def _(t):
    raw = F.concat("organisme", F.lit(" ("), F.col("document_id").cast("string"), F.lit(") "))
    return t.legal_docs.select("document_id", tx.descriptor_name(raw).alias("name"))


@query("prj26_language_twin_url", "SELECT document_id, replace(html_url, '/ca/', '/es/') AS twin FROM legal_docs")
def _(t):
    return t.legal_docs.select("document_id", ids.language_twin("html_url").alias("twin"))


@query("prj27_clean_cited_title", """SELECT source_id, item_no, concat('Llei ', document_number) AS clean_title FROM items WHERE document_number <> ''""")
def _(t):
    raw = F.concat("article_or_section", F.lit(" de la Llei "), "document_number")
    return t.items.filter(F.col("document_number") != "").select(
        "source_id", "item_no", tx.clean_cited_title(raw, "article_or_section").alias("clean_title"))


@query("prj28_affectation_text", """SELECT document_id, ord, concat(split_part(text, ' ', 1), ' articles ', CAST(ord AS VARCHAR), ' ', CAST(target_document_id AS VARCHAR), ' de ', text) AS sentence FROM legal_affs""")
def _(t):
    aff = F.struct(F.split_part("text", F.lit(" "), F.lit(1)).alias("type"), F.lit("de").alias("conj"),
                   F.col("text").alias("title"), F.lit(None).cast("string").alias("desc_text"),
                   F.array(F.struct(F.lit("articles").alias("description"),
                                    F.array(F.col("ord").cast("string"), F.lit(""), F.col("target_document_id").cast("string")).alias("titles")),
                           F.struct(F.lit("annexos").alias("description"), F.array(F.lit("")).alias("titles"))).alias("desc_list"))
    return t.legal_affs.select("document_id", "ord", markup.affectation_text(aff).alias("sentence"))


@query("prj29_html_to_text", """SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<script[^>]*>.*?</script>', '', 'gis'), '<style[^>]*>.*?</style>', '', 'gis'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages""")
def _(t):
    return t.pages.select("page_id", markup.html_to_text("html").alias("text"))


@query("prj30_html_table_to_markdown", """SELECT document_id, concat('| ', title, ' | ', coalesce(type, ''), ' |', chr(10), '| --- | --- |', chr(10), '| ', dogc_number, ' |  |') AS markdown FROM legal_docs""")
def _(t):
    html = F.concat(F.lit("<div><table class='x'><tr><th>"), "title", F.lit("</th><td><b>"), F.coalesce("type", F.lit("")),
                    F.lit("</b></td></tr><tr><td>"), "dogc_number", F.lit("</td></tr></table></div>"))
    return project.tables_to_markdown(t.legal_docs.select("document_id", html.alias("html")), "html").select("document_id", "markdown")


@query("prj31_markdown_to_blocks", """
SELECT document_id, 0 AS block, 'h2' AS kind, title AS text FROM legal_docs
UNION ALL SELECT document_id, 1, 'p', concat('primera linia ', organisme, ' segona') FROM legal_docs
UNION ALL SELECT document_id, 2, 'p', dogc_number FROM legal_docs""")
def _(t):
    md = F.concat(F.lit("## "), "title", F.lit("\n* primera linia "), "organisme", F.lit("\n- segona\n\n"), "dogc_number", F.lit("\n"))
    return project.markdown_blocks(t.legal_docs.select("document_id", md.alias("markdown")), "document_id", "markdown")


@query("prj32_parse_answer_json", """SELECT conv_id, turn, concat(CAST(conv_id % 97 + 1 AS VARCHAR), '/2020') AS document_number,
 CASE WHEN turn % 3 = 0 THEN 'DOGC' ELSE 'Llei' END AS doc_type, concat('article ', CAST(turn AS VARCHAR)) AS article_or_section FROM conversations""")
def _(t):
    return project.parse_answers(t.llm_answers, "answer", "struct<document_number:string,doc_type:string,article_or_section:string>",
                                 ["conv_id", "turn"])


@query("prj33_xml_body_choice", """SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'html' WHEN 1 THEN 'url' WHEN 2 THEN 'main' ELSE 'api' END AS chosen FROM pages""")
def _(t):
    k = F.col("page_id") % 4
    body = markup.body_html(F.when(k == 0, F.col("html")).otherwise("plain"), F.when(k == 1, F.col("url")).otherwise(" "),
                            F.when(k == 2, F.lit("main body")), F.lit("api body"))
    return t.pages.select("page_id", F.when(body == F.col("html"), "html").when(body == F.col("url"), "url")
                          .when(body == "main body", "main").otherwise("api").alias("chosen"))


@query("prj34_bilingual_title", """SELECT document_id, CASE document_id % 3 WHEN 0 THEN concat('es ', title) ELSE title END AS title FROM legal_docs""")
def _(t):
    es = F.when(F.col("document_id") % 3 == 0, F.concat(F.lit("es "), "title")).when(F.col("document_id") % 3 == 1, " ")
    return t.legal_docs.select("document_id", tx.bilingual(es, "title").alias("title"))
