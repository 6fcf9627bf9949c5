"""Nested records to tables."""

from pyspark.sql import Window, functions as F

from lexloom import rules
from lexloom.functions import text as tx
from lexloom.session import cut


# ---- FLT1: issue summary ------------------------------------------------------------------
_DOC = "struct<title:string,linkDownloadDocumentPDF:string,linkDownloadDocumentHTML:string>"
_CHILDREN = ("section", "header", "subheader")
_NODE = f"struct<title:string,numDOGC:string,document:string,{','.join(f'{c}:string' for c in _CHILDREN)}>"


def _children(json_text):
    """JSON texts of a list of objects, of a single object, or none."""
    t = F.ltrim(json_text)
    return F.coalesce(F.when(t.startswith("["), F.from_json(json_text, "array<string>")).when(t.startswith("{"), F.array(json_text)), F.array().cast("array<string>"))


def flatten_summary(df, json_col):
    """FLT1: every document of an issue with the organism and section it inherits.

    The tree is walked one level a round, however deep it is; children may be lists or single
    objects. An issue may be wrapped in a list of summaries, of which the first counts.
    """
    wrapped = F.get_json_object(json_col, "$.sumaris")
    root = F.when(wrapped.isNotNull(), F.get_json_object(json_col, "$.sumaris[0]")).otherwise(json_col)
    base = cut(df.select(F.monotonically_increasing_id().alias("_id"), root.alias("_json")))
    none = F.array().cast("array<int>")
    level, docs = base.select("_id", none.alias("path"), F.lit("").alias("org"), F.lit("").alias("sec"), F.from_json("_json", _NODE).alias("n")), None
    while True:
        title = F.coalesce("n.title", F.lit(""))
        takes = (F.size(_children(F.col("n.section"))) > 0) | (F.col("n.numDOGC").isNotNull() & (F.col("sec") == ""))
        here = level.filter("n IS NOT NULL").select("_id", "path", title.alias("t"), F.when(title != "", title).otherwise(F.col("org")).alias("org"), F.when(takes, title).otherwise(F.col("sec")).alias("sec"), "n")
        found = here.select("_id", "path", "org", "sec", F.posexplode(as_list(F.col("n.document"), _DOC)).alias("_i", "doc"))
        # documents of a node come before its children, and children in the order of their kinds
        found = found.select("_id", "org", "sec", "doc", F.concat("path", F.array(F.lit(0), F.col("_i"))).alias("path"))
        docs = found if docs is None else docs.unionByName(found)
        kids = [_numbered(_children(F.col(f"n.{c}")), k) for k, c in enumerate(_CHILDREN, 1)]
        level = cut(here.select("_id", "path", "t", "org", "sec", F.explode(F.concat(*kids)).alias("c")).select(
            "_id", F.concat("path", F.array(F.col("c.kind"), F.col("c.i"))).alias("path"), "org",
            F.when(F.col("c.kind") == 1, F.col("t")).otherwise(F.col("sec")).alias("sec"), F.from_json("c.x", _NODE).alias("n")))
        if level.isEmpty():
            break
    issue = base.select("_id", F.from_json("_json", "struct<numDOGC:string,dateDOGC:string>").alias("i")).select("_id", "i.*")
    pos = F.row_number().over(Window.partitionBy("_id").orderBy("path")) - 1
    df = docs.withColumn("pos", pos).join(issue, "_id")
    pdf, html = F.col("doc.linkDownloadDocumentPDF"), tx.nonblank("doc.linkDownloadDocumentHTML")
    doc_id = F.nullif(F.regexp_extract(pdf, r"documentId=(\d+)", 1), F.lit(""))
    page = F.concat(F.lit("https://dogc.gencat.cat/ca/document-del-dogc/index.html?documentId="), doc_id)
    return df.select(
        doc_id.alias("document_id"), F.col("numDOGC").alias("dogc_number"), F.col("dateDOGC").alias("date_dogc"),
        F.when(F.length("dateDOGC") >= 10, F.element_at(F.split("dateDOGC", "/"), -1)).otherwise("").alias("year"),
        F.coalesce(tx.nonblank("sec"), F.lit("DISPOSICIONS")).alias("section"),
        F.coalesce(tx.nonblank("org"), F.lit("Unknown")).alias("organisme"),
        tx.or_empty("doc.title").alias("title"), tx.nonblank(pdf).alias("pdf_url"),
        F.coalesce(F.when(html != "None", html), page).alias("html_url"), "pos")


def _numbered(items, kind):
    return F.transform(items, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x.alias("x")))


# ---- FLT2: daily bulletin, object-or-list at every level ------------------------------------
def as_list(json_text, item):
    """Array of items from JSON text that is a list, a single object or absent."""
    t = F.ltrim(json_text)
    return (F.when(t.startswith("["), F.from_json(json_text, f"array<{item}>"))
            .when(t.startswith("{"), F.array(F.from_json(json_text, item))))


_ITEM = ("struct<identificador:string,control:string,titulo:string,url_pdf:string,url_html:string,url_xml:string>")


def flatten_bulletin(df, json_col, codes=None):
    """FLT2: items of a daily bulletin with their section, department and heading."""
    root = F.from_json(json_col, "struct<data:struct<sumario:struct<metadatos:struct<fecha_publicacion:string>,diario:string>>>")
    df = df.select(root.alias("r")).select(F.col("r.data.sumario.metadatos.fecha_publicacion").alias("fecha_publicacion"),
                                           F.explode(as_list(F.col("r.data.sumario.diario"), "struct<numero:string,seccion:string>")).alias("d"))
    df = df.select("fecha_publicacion", F.col("d.numero").alias("diario_numero"),
                   F.explode(as_list(F.col("d.seccion"), "struct<codigo:string,nombre:string,departamento:string>")).alias("s"))
    if codes and "all" not in codes:
        df = df.filter(F.col("s.codigo").isin(list(codes)))
    df = df.select("fecha_publicacion", "diario_numero", F.col("s.codigo").alias("seccion_codigo"), F.col("s.nombre").alias("seccion_nombre"),
                   F.explode(as_list(F.col("s.departamento"), "struct<codigo:string,nombre:string,epigrafe:string,item:string>")).alias("p"))
    none = F.array().cast(f"array<struct<epigrafe_nombre:string,it:{_ITEM}>>")
    tag = lambda items, name: F.transform(items, lambda i: F.struct(name.alias("epigrafe_nombre"), i.alias("it")))
    headed = F.flatten(F.transform(as_list(F.col("p.epigrafe"), "struct<nombre:string,item:string>"),
                                   lambda e: F.coalesce(tag(as_list(e["item"], _ITEM), e["nombre"]), none)))
    direct = tag(as_list(F.col("p.item"), _ITEM), F.lit(None).cast("string"))
    df = df.select("*", F.explode(F.concat(F.coalesce(headed, none), F.coalesce(direct, none))).alias("x"))
    ident, pdf = F.col("x.it.identificador"), F.col("x.it.url_pdf")
    return df.filter(tx.nonblank(ident).isNotNull() & ~ident.startswith("BOE-S")).select(
        ident.alias("identificador"), F.col("x.it.control").alias("control"), F.col("x.it.titulo").alias("titulo"),
        "fecha_publicacion", "diario_numero", "seccion_codigo", "seccion_nombre",
        F.col("p.codigo").alias("departamento_codigo"), F.col("p.nombre").alias("departamento_nombre"),
        F.col("x.epigrafe_nombre").alias("epigrafe_nombre"),
        F.when(F.ltrim(pdf).startswith("{"), F.get_json_object(pdf, "$.texto")).otherwise(pdf).alias("pdf_url"),
        F.col("x.it.url_html").alias("html_url"), F.col("x.it.url_xml").alias("xml_url"))


# ---- FLT3 / FLT6: publications of local records ----------------------------------------------
PUBLICATION = ("struct<fase:string,descripcio:string,butlleti:string,numButlleti:string,dataPublicacio:string,"
               "urlPdf:string,urlHtml:string,esVigent:boolean,appearsInDogc:boolean,dogcDocumentId:string>")


def publications(records):
    """FLT3: one row per publication of a record, with its position and parent fields."""
    df = records.select("record_id", F.col("type"), F.col("title").alias("record_title"), "date", "url_record",
                        F.coalesce(tx.nonblank("institucio"), F.lit("Unknown")).alias("institucio"),
                        F.posexplode("documents").alias("pos", "d"))
    d = F.col("d")
    return df.select("record_id", "pos", "type", "record_title", "institucio", "url_record",
                     tx.first_nonblank(d["dataPublicacio"], "date").alias("date"),
                     F.coalesce(tx.nonblank(d["butlleti"]), F.lit("OTHER")).alias("butlleti"),
                     (F.coalesce(d["appearsInDogc"], F.lit(False)) | F.coalesce(d["butlleti"] == "DOGC", F.lit(False))).alias("appears_in_dogc"),
                     tx.nonblank(d["dogcDocumentId"]).alias("dogc_document_id"), d["fase"].alias("fase"),
                     d["descripcio"].alias("descripcio"), d["urlPdf"].alias("url_pdf"), d["urlHtml"].alias("url_html"),
                     d["numButlleti"].alias("bulletin_number"), d["esVigent"].alias("is_vigent"))


def synthetic_id(record, pos):
    return F.concat(F.lit("cido_"), tx.col(record).cast("string"), F.lit("_doc_"), tx.col(pos).cast("string"))


def bulletin_documents(pubs, codes):
    """FLT6: publications of chosen bulletins with record fallbacks and a stable id."""
    return pubs.filter(F.col("butlleti").isin(list(codes))).select(
        F.coalesce("dogc_document_id", synthetic_id("record_id", "pos")).alias("id"), F.col("record_id").alias("cido_id"),
        F.coalesce(tx.first_nonblank("descripcio", "record_title"), F.lit("Document")).alias("title"), "record_title",
        F.col("butlleti").alias("bulletin"), "bulletin_number", "date", F.col("institucio").alias("institution"),
        F.col("type").alias("category"), "fase", "url_html", "url_pdf", "url_record",
        tx.link_to_text("url_html", "url_pdf", "url_record").alias("link_to_text"), "is_vigent", "appears_in_dogc",
        "dogc_document_id")


# ---- FLT4 / FLT5 / FLT7 / FLT8: structured documents -------------------------------------------
def section_type(c):
    c = F.coalesce(tx.col(c), F.lit("unknown"))
    out = None
    for raw, mapped in rules.SECTION_TYPES.items():
        out = F.when(c == raw, mapped) if out is None else out.when(c == raw, mapped)
    return out.otherwise(tx.capitalise(c))


def sections(docs, sections_col="sections", key="document_id"):
    """FLT4: one row per section; paragraphs joined, the heading standing in for no text.

    ``section_id`` counts from 0, ``section_no`` / ``alt_id`` from 1.
    """
    df = docs.select(key, F.posexplode(sections_col).alias("pos", "s"))
    s = F.col("s")
    body = F.array_join(F.coalesce(s["commas"], F.array().cast("array<string>")), "\n")
    return df.select(
        key, F.concat(F.col(key).cast("string"), F.lit("_sec_"), F.col("pos").cast("string")).alias("section_id"),
        (F.col("pos") + 1).alias("section_no"),
        F.concat(F.lit("sec_"), F.col(key).cast("string"), F.lit("_"), (F.col("pos") + 1).cast("string")).alias("alt_id"),
        section_type(s["type"]).alias("type"), tx.or_empty(s["title"]).alias("title"), tx.or_empty(s["heading"]).alias("heading"),
        F.coalesce(F.nullif(body, F.lit("")), tx.or_empty(s["heading"])).alias("text"))


def descriptors(docs, struct_col="descriptors", key="document_id"):
    """FLT5: descriptor rows with their category; entries without id or name dropped."""
    none = F.array().cast("array<struct<id:string,name:string>>")

    def tag(name):
        return lambda d: F.struct(F.lit(name).alias("type"), d["id"].alias("id"), d["name"].alias("name"))

    tagged = [F.transform(F.coalesce(F.col(f"{struct_col}.{f}"), none), tag(name))
              for f, name in (("organisms", "Organism"), ("geographic", "Geographic"), ("thematic", "Thematic"))]
    df = docs.select(key, F.posexplode(F.concat(*tagged)).alias("pos", "x"))
    return df.filter(tx.nonblank("x.id").isNotNull() & tx.nonblank("x.name").isNotNull()).select(
        key, "pos", F.trim("x.id").alias("descriptor_id"), tx.descriptor_name("x.name").alias("name"),
        F.col("x.name").alias("raw_name"), F.col("x.type").alias("type"))


def affectations(docs, struct_col="affectations", key="document_id"):
    """FLT7: editorial links of both directions; links without a target dropped."""
    none = F.array().cast("array<struct<text:string,targetDocumentId:string>>")

    def tag(name):
        return lambda a: F.struct(F.lit(name).alias("direction"), a["text"].alias("text"), a["targetDocumentId"].alias("target"))

    tagged = [F.transform(F.coalesce(F.col(f"{struct_col}.{d}"), none), tag(d)) for d in ("active", "passive")]
    df = docs.select(key, F.posexplode(F.concat(*tagged)).alias("ord", "x"))
    target = F.trim("x.target")
    return df.filter((target != "") & (target != "None")).select(
        key, "ord", "x.direction", target.alias("target_document_id"), tx.or_empty("x.text").alias("text"))


def editorial_refs(df, key="law_id", prior="prior", later="later"):
    """FLT8: earlier and later editorial references in one table."""
    both = F.concat(*[F.coalesce(F.col(c), F.array().cast("array<struct<ref:string,word:string,text:string>>")) for c in (prior, later)])
    return df.select(key, F.posexplode(both).alias("ref_no", "x")).filter(tx.nonblank("x.ref").isNotNull()).select(
        key, "ref_no", F.col("x.ref").alias("target_id"), F.coalesce(tx.nonblank("x.word"), F.lit("REFERENCIA")).alias("relation"),
        F.coalesce("x.text", F.lit("")).alias("text"))


def package_bilingual(ca, es, key="document_id"):
    """FLT9: both language versions in one record; the second is NULL when absent."""
    pack = lambda df, n: df.select(F.col(key), F.struct(*[c for c in df.columns if c != key]).alias(n))
    out = pack(ca, "ca").join(pack(es, "es"), key, "left")
    return out.withColumn("eli_uri", tx.or_empty(tx.first_nonblank("ca.eli_uri", "es.eli_uri")))


def shape_records(df, attrs="attributes"):
    """FLT10: API attributes to a record; detail keys depend on the module."""
    a = F.col(attrs)
    detail = None
    for module, names in rules.MODULE_DETAILS.items():
        m = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[a[n] for n in names]))
        detail = F.when(F.col("module") == module, m) if detail is None else detail.when(F.col("module") == module, m)
    both = tx.nonblank(a["latitud"]).isNotNull() & tx.nonblank(a["longitud"]).isNotNull()
    return df.select(
        F.col("id").alias("record_id"), F.col("module").alias("type"), a["identificador"].alias("identificador"),
        F.coalesce(tx.nonblank(a["titol"]), F.lit("Untitled Record")).alias("title"), a["urlCido"].alias("url_record"),
        F.coalesce(tx.first_nonblank(a["institucioDesenvolupat"], a["ambit"]), F.lit("Unknown")).alias("institucio"),
        a["esVigent"].alias("es_vigent"), a["maxDataPublicacioDocument"].alias("date"),
        F.when(both, F.struct(a["latitud"].try_cast("double").alias("lat"), a["longitud"].try_cast("double").alias("lon"))).alias("location"),
        F.coalesce(detail, F.create_map().cast("map<string,string>")).alias("detalls"))
