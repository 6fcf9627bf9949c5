"""Node and edge tables."""

from pyspark.sql import functions as F

from lexloom.functions import doctype, ids, text as tx
from lexloom.operators import cite, dedupe
from lexloom.operators.ordered import first_row, global_scan, lookup_join

PAGE = "https://dogc.gencat.cat/ca/document-del-dogc/index.html"


def issue_nodes(docs):
    """NOD1: one node per gazette number, blank date or year filled from later documents."""
    d = docs.filter(tx.present("dogc_number").isNotNull()).select(F.trim("dogc_number").alias("dogc_number"), "date_dogc", F.col("year").cast("string").alias("year"), "ingest_ord")
    n = dedupe.first_by(d, ["dogc_number"], ["date_dogc", "year"])
    y, m, day = ids.issue_year("date_dogc", "year")
    return n.select("dogc_number", tx.or_empty("date_dogc").alias("date_dogc"), tx.or_empty("year").alias("year"),
                    ids.eli_path("dogc", (y, m, day), "dogc_number").alias("eli_id"), F.concat(F.lit(PAGE + "?numDOGC="), "dogc_number").alias("url"))


def _opt(df, name):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def document_nodes(docs):
    """NOD2: document properties with their fallbacks, and a label from the type.

    Documents without a gazette number get no node.
    """
    o = lambda n: _opt(docs, n)
    title = F.coalesce(tx.first_nonblank(o("title_ca"), "title"), F.lit("Untitled Document"))
    raw = F.coalesce(tx.first_nonblank(o("type"), o("type_of_law")), doctype.type_from_title(title))
    y, m, day = ids.issue_year("date_dogc", "year")
    return docs.filter(tx.nonblank("dogc_number").isNotNull()).select(
        F.col("document_id"), title.alias("title"), tx.or_empty(o("title_es")).alias("title_es"), tx.or_empty(o("eli_uri")).alias("eli_uri"),
        tx.or_empty(tx.first_nonblank(o("html_url_ca"), "html_url")).alias("url"), tx.or_empty(o("html_url_es")).alias("url_es"),
        tx.or_empty(tx.first_nonblank(o("pdf_url_ca"), "pdf_url")).alias("pdf_url"), tx.or_empty(o("pdf_url_es")).alias("pdf_url_es"),
        raw.alias("type_of_law"), tx.or_empty(o("document_date")).alias("document_date"), tx.or_empty("document_number").alias("document_number"),
        tx.or_empty(o("control_number")).alias("control_number"), F.coalesce(tx.first_nonblank("organisme"), F.lit("Unknown")).alias("emitting_organism"),
        tx.or_empty(o("cve")).alias("cve"), F.coalesce(tx.nonblank("section"), F.lit("Unknown")).alias("section"),
        (tx.nonblank(o("title_es")).isNotNull() | F.coalesce(o("has_spanish").cast("boolean"), F.lit(False))).alias("is_bilingual"),
        F.trim("dogc_number").alias("dogc_number"), tx.label_name(raw).alias("label"), ids.eli_path("doc", (y, m, day), "document_id", o("eli_uri")).alias("eli_id"))


def record_nodes(recs):
    """NOD3: local record nodes."""
    y, m, d = ids.date_parts("date")
    prefix = ids.module_prefix("type")
    return recs.select(
        "record_id", ids.eli_path(prefix, (y, m, d), "record_id").alias("eli_id"), tx.label_name(F.coalesce("type", F.lit("cidoDocument"))).alias("label"),
        tx.or_empty("title").alias("title"), F.coalesce(tx.nonblank("date"), F.concat_ws("-", y, m, d)).alias("date"),
        F.coalesce(tx.nonblank("url_record"), F.concat(F.lit("https://cido.diba.cat/"), prefix, F.lit("/"), F.col("record_id").cast("string"))).alias("url"),
        tx.or_empty("institucio").alias("institucio"), F.coalesce("es_vigent", F.lit(True)).alias("es_vigent"))


def descriptor_nodes(*sources):
    """NOD4: one node per descriptor; the first source and row that mentions it wins.

    Each source has descriptor_id, name, type and a row order ``ord``.
    """
    tagged = [s.select("descriptor_id", "name", "type", F.struct(F.lit(i).alias("s"), F.col("ord").alias("o")).alias("_o")) for i, s in enumerate(sources)]
    one = first_row(dedupe.union_documents(*tagged), ["descriptor_id"], ["_o"]).drop("_o")
    return one.select("descriptor_id", F.concat(F.lit("eli/es-cat/materia/"), tx.slug("descriptor_id")).alias("eli_id"), tx.descriptor_name("name").alias("name"),
                      "type", F.concat("type", F.lit("Descriptor")).alias("label"))


def section_nodes(aligned):
    """NOD5: bilingual section nodes from aligned sections; the heading stands in for no text."""
    text = lambda t, h: F.coalesce(tx.nonblank(t), tx.or_empty(h))
    from lexloom.operators.flatten import section_type
    return aligned.select(
        "section_id", "document_id", section_type("type").alias("type"), F.when(F.col("type") == "article", "Article").alias("label"),
        tx.or_empty("title").alias("title"), "title_es", tx.or_empty("heading").alias("heading"), "heading_es", text("text", "heading").alias("text"),
        text("text_es", "heading_es").alias("text_es"), "is_bilingual",
        F.coalesce(F.concat(tx.first_nonblank("title", "heading"), F.when(tx.nonblank("heading").isNotNull() & (F.col("title") != F.col("heading")), F.concat(F.lit(" - "), "heading")).otherwise("")), F.lit("Section")).alias("full_title"),
        tx.article_from_title("title").alias("article_number"))


def published_in(docs):
    """EDG1: document to issue, with the section it appeared under."""
    return docs.filter(tx.nonblank("dogc_number").isNotNull()).select(
        F.col("document_id").alias("src"), F.trim("dogc_number").alias("dst"), F.lit("PUBLISHED_IN").alias("type"), F.coalesce(tx.nonblank("section"), F.lit("Unknown")).alias("section"))


def _placed(docs, pubs):
    """Publications with the path of their gazette document (_eli, NULL if not in the corpus) and of a local one."""
    y, m, day = ids.issue_year("date_dogc", "year")
    known = first_row(docs.select(F.col("document_id").cast("string").alias("_d"), ids.eli_path("doc", (y, m, day), "document_id").alias("_eli"), "ingest_ord"), ["_d"], ["ingest_ord"], last=True).drop("ingest_ord")
    local = F.concat_ws("/", F.lit("eli/es-cat/doc/local"), F.col("record_id").cast("string"), F.col("pos").cast("string"))
    return lookup_join(pubs, known, "dogc_document_id", "_d").withColumn("_local", local)


def _publication_properties(p):
    """Properties that a publication gives to its edge and to its own node."""
    o = lambda n: _opt(p, n)
    own = F.when(tx.nonblank("butlleti").isNotNull(), F.array("butlleti")).otherwise(F.array().cast("array<string>"))
    return {"butlleti": tx.or_empty("butlleti"), "all_sources": F.coalesce(F.when(F.size(o("all_sources")) > 0, o("all_sources")), own) if "all_sources" in p.columns else own,
            "is_multi_source": F.coalesce(o("is_multi_source").cast("boolean"), F.lit(False)), "is_url_active": F.coalesce(o("is_url_active").cast("boolean"), F.lit(True)),
            "url_status": F.coalesce(o("url_status"), F.lit("active"))}


def local_document_nodes(docs, pubs):
    """NOD2: a node for every publication that is no gazette document of the corpus."""
    p = _placed(docs, pubs).filter("_eli IS NULL")
    o = lambda n: _opt(p, n)
    return p.select(
        F.concat_ws("_", F.lit("cido_doc"), F.col("record_id").cast("string"), F.col("pos").cast("string")).alias("document_id"), F.col("_local").alias("eli_id"),
        tx.or_empty(tx.first_nonblank("descripcio", o("record_title"))).alias("title"), tx.or_empty(tx.first_nonblank("data_publicacio", "record_date")).alias("date"),
        tx.or_empty(tx.first_nonblank("url_pdf", o("url_html"), o("url_record"))).alias("url"), tx.or_empty("url_pdf").alias("pdf_url"), F.lit("LocalBulletin").alias("label"),
        *[c.alias(n) for n, c in _publication_properties(p).items()])


def contains_edges(docs, pubs):
    """EDG1: issue to document, and record to publication (its local node when not in the corpus)."""
    y, m, d = ids.issue_year("date_dogc", "year")
    a = docs.filter(tx.present("dogc_number").isNotNull()).select(ids.eli_path("dogc", (y, m, d), "dogc_number").alias("src"), ids.eli_path("doc", (y, m, d), "document_id").alias("dst"),
                                                                  F.coalesce(tx.nonblank("section"), F.lit("Disposicions generals")).alias("macrosection"))
    p = _placed(docs, pubs)
    ry, rm, rd = ids.date_parts("record_date")
    b = p.select(ids.eli_path(ids.module_prefix("type"), (ry, rm, rd), "record_id").alias("src"), F.coalesce("_eli", "_local").alias("dst"), tx.or_empty("fase").alias("fase"),
                 F.coalesce(_opt(p, "num_butlleti").cast("long"), F.lit(0)).alias("num_butlleti"), tx.or_empty("data_publicacio").alias("data_publicacio"),
                 *[c.alias(n) for n, c in _publication_properties(p).items()])
    return dedupe.union_documents(a, b).withColumn("type", F.lit("CONTAINS"))


def has_section(sections, ord_col="ord"):
    """EDG2: document to section with its 0-based order."""
    return sections.select(F.col("document_id").alias("src"), F.col("section_id").alias("dst"), F.lit("HAS_SECTION").alias("type"), (F.col(ord_col) - 1).alias("order"))


def topic_edges(descriptors, owner, kind="HAS_TOPIC"):
    """EDG3: document or record to topic."""
    return descriptors.select(F.col(owner).alias("src"), F.concat(F.lit("eli/es-cat/materia/"), tx.slug("descriptor_id")).alias("dst"), F.lit(kind).alias("type"), F.lower("type").alias("category"))


def metadata_edges(affs, docs, list_name="direction", from_text=False):
    """EDG4: edges out of editorial lists; the type comes from the list's name, which is
    CITES for lists called active / passive, or from the link's text on request.

    Targets resolve over the whole corpus; unknown ones get a zero-date path.
    """
    y, m, d = ids.issue_year("date_dogc", "year")
    eli = first_row(docs.select(F.col("document_id").alias("_d"), ids.eli_path("doc", (y, m, d), "document_id").alias("_eli"), "ingest_ord"), ["_d"], ["ingest_ord"], last=True).drop("ingest_ord")
    name = F.lower(list_name)
    kind = F.when(name.contains("modific"), "MODIFY").when(name.contains("derog"), "ABROGATES").otherwise("CITES")
    if from_text:
        act = cite.affectation_action("text")
        kind = F.when(act == "Modify", "MODIFY").when(act == "Abrogate", "ABROGATES").otherwise("CITES")
    a = affs.join(eli.withColumnRenamed("_eli", "src"), F.col("document_id") == F.col("_d")).drop("_d")
    a = a.join(eli, F.col("target_document_id") == F.col("_d"), "left")
    missing = F.concat(F.lit("eli/es-cat/doc/0000/00/00/"), F.col("target_document_id").cast("string"))
    return a.select("src", F.coalesce("_eli", missing).alias("dst"), kind.alias("type"), F.lit("metadata").alias("flags"), F.col("text").alias("raw_text"))


def import_nodes(wanted, nodes, catalogue):
    """EDG5: catalogue entries copied into the graph with their parent documents and edges.

    wanted: id. nodes: id. catalogue: id, label, title, parent_id (NULL for documents).
    Returns (new nodes, new edges).
    """
    fresh = wanted.select("id").distinct().join(nodes.select("id"), "id", "left_anti")
    first = catalogue.join(fresh, "id", "left_semi")
    parents = first.filter("parent_id IS NOT NULL").select(F.col("parent_id").alias("id")).distinct().join(nodes.select("id"), "id", "left_anti")
    above = catalogue.join(parents, "id", "left_semi")
    stubs = parents.join(catalogue.select("id"), "id", "left_anti").select("id", F.lit("Document").alias("label"), F.concat(F.lit("Document "), "id").alias("title"), F.lit(None).cast("string").alias("parent_id"))
    new = first.unionByName(above).unionByName(stubs).groupBy("id").agg(F.min("label").alias("label"), F.min("title").alias("title"), F.min("parent_id").alias("parent_id"))
    edges = new.filter("parent_id IS NOT NULL").select(F.col("parent_id").alias("src"), F.col("id").alias("dst"), F.lit("HAS_SECTION").alias("type"))
    return new.drop("parent_id"), edges


def entity_key_of(number, title, eli=None, gazette=None):
    """Key under which unresolved citations mean the same new document."""
    tag = lambda p, c: F.when(c != "", F.concat(F.lit(p), c))
    keys = ([tag("eli:", tx.eli_key(eli))] if eli is not None else []) + [tag("num:", tx.entity_key(number)), tag("title:", tx.entity_key(title))]
    return F.coalesce(*keys, *([tag("gaz:", tx.entity_key(gazette))] if gazette is not None else []))


def create_targets(items, nodes, order, max_id):
    """EDG6: one new document node per distinct entity key, dense ids above the largest.

    items: entity_key, title, document_number, eli_uri, dogc_number, doc_type, year plus the
    order columns. ``max_id`` is a one-row DataFrame with column m.
    """
    one = first_row(items.filter("entity_key IS NOT NULL").select("entity_key", "title", "document_number", "eli_uri", "dogc_number", "doc_type", "year", *order), ["entity_key"], order)
    one = global_scan(one, [F.col(o) for o in order], {}, "_rank")
    eli = tx.nonblank("eli_uri")
    label = F.regexp_replace(F.initcap(F.regexp_replace(F.lower(F.trim("doc_type")), r"[\s_-]+", " ")), " ", "")
    new_id = F.col("_rank") + max_id.scalar()
    return one.select(
        new_id.alias("id"), "entity_key", F.coalesce(tx.nonblank("title"), F.concat(F.lit("Document "), tx.first_nonblank("document_number", new_id.cast("string")))).alias("title"),
        tx.or_empty("document_number").alias("document_number"), F.coalesce(tx.nonblank("doc_type"), F.lit("Unknown")).alias("type_of_law"),
        F.when((F.coalesce(label, F.lit("")) != "") & (label != "Document"), F.concat(F.lit("Document:"), label)).otherwise("Document").alias("labels"),
        F.when(eli.isNotNull(), F.concat(F.lit("https://portaljuridic.gencat.cat/"), F.regexp_replace(eli, "^/+", "")))
        .when(tx.nonblank("dogc_number").isNotNull(), F.concat(F.lit(PAGE + "?dogcNumber="), "dogc_number")).otherwise("").alias("url"))
