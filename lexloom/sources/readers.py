"""Landed files to tables. Schemas are explicit; nothing is inferred from data."""

from pyspark.sql import Window, functions as F

from lexloom import rules
from lexloom.functions import text as tx
from lexloom.operators.ordered import global_scan


def with_position(df, out="ingest_ord"):
    """Dense position of each row in file order.

    Rows are counted per file split; only those counts are scanned in one place. ``df``
    must come straight from a file source and carry ``_path`` and ``_start``.
    """
    d = df.withColumn("_m", F.monotonically_increasing_id())
    blocks = d.groupBy("_path", "_start").agg(F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return d.join(blocks, ["_path", "_start"]).withColumn(out, F.col("_off") + F.col("_m") - F.col("_m0")).drop("_path", "_start", "_m", "_m0", "_off")


def _with_split(df):
    return df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))


def read_index(spark, path, schema, layout="lines"):
    """SRC1: corpus of JSON records. Returns (records with their position, unreadable pieces).

    ``lines``: one record per line. ``array``: one top-level array. Both are split between
    tasks; an array printed with an indent of two is cut where a top-level record closes, a
    line that no nested value can produce. Any other print of an array is one piece of as many
    records. A piece that doesn't parse is kept as text with its place, none is lost.
    """
    sep = {} if layout == "lines" else {"lineSep": "\n  },"}
    raw = _with_split(spark.read.options(**sep).text(path)).filter(F.trim("value") != "")
    body = F.col("value")
    if layout == "array":
        whole = body.rlike(r"\n\]\s*$") | body.rlike(r"^\s*\[.*\]\s*$")
        body = F.when(whole, F.regexp_replace(body, r"\]\s*$", "")).otherwise(F.concat(body, F.lit("}")))
        body = F.regexp_replace(body, r"^\s*\[?", "")
    parsed = F.from_json(F.concat(F.lit("["), body, F.lit("]")), f"array<struct<{schema}>>", {"mode": "PERMISSIVE"})
    raw = raw.withColumn("_r", parsed)
    empty = F.array().cast(raw.schema["_r"].dataType)
    good = with_position(raw.select("_path", "_start", F.explode(F.coalesce("_r", empty)).alias("r")))
    return good.select("ingest_ord", "r.*"), raw.filter("_r IS NULL").select(F.col("_path").alias("file_path"), F.col("_start").alias("split_start"), "value")


def read_structured(spark, path, schema, glob="*_structured.json", one_per_file=True, key="documentId"):
    """SRC2: per-document JSON files. Returns (documents, unreadable files).

    Unreadable files and records without a usable id never stop the job.
    """
    df = (spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", one_per_file).option("pathGlobFilter", glob)
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    df = df.select("*", F.col("_metadata.file_path").alias("file_path"))
    # the source refuses queries on the corrupt column alone, so the key is read as well
    bad = df.filter(F.col("_corrupt_record").isNotNull() & F.coalesce(key, F.lit("")).rlike("")).select("file_path", "_corrupt_record")
    ok = df.filter(F.col("_corrupt_record").isNull() & tx.present(key).isNotNull())
    return ok.drop("_corrupt_record", "file_path"), bad


LAW_XML = ("_corrupt_record string, metadatos struct<identificador:string,titulo:string,fecha_publicacion:string,departamento:string,rango:string>, "
           "texto struct<p:array<struct<_class:string,_VALUE:string>>>, "
           "analisis struct<referencias:struct<anteriores:struct<anterior:array<struct<_referencia:string,palabra:string,texto:string>>>,"
           "posteriores:struct<posterior:array<struct<_referencia:string,palabra:string,texto:string>>>>>")


def read_gazette_xml(spark, path, layout="files", row_tag="documento"):
    """SRC3: national laws. Returns (laws, paragraphs, references, unreadable laws).

    ``files``: one law per file, as they are published. ``lines``: one law per line, which
    lets a large file be split between tasks.
    """
    df = spark.read.format("xml").option("rowTag", row_tag).option("multiLine", layout == "files").option("attributePrefix", "_").option("valueTag", "_VALUE").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").schema(LAW_XML).load(path)
    df = df.select("*", F.col("_metadata.file_path").alias("file_path"))
    bad = df.filter(F.col("_corrupt_record").isNotNull() | F.col("metadatos").isNull()).select("file_path", "_corrupt_record")
    df = df.filter(F.col("metadatos").isNotNull() & F.col("_corrupt_record").isNull())
    m, law = F.col("metadatos"), F.col("metadatos.identificador").alias("law_id")
    laws = df.select(law, m["titulo"].alias("title"), m["fecha_publicacion"].alias("publication_date"), m["departamento"].alias("department"), m["rango"].alias("rango"))
    paras = df.select(law, F.posexplode("texto.p").alias("ord", "p")).select("law_id", "ord", F.col("p._class").alias("cls"), F.trim("p._VALUE").alias("text")).filter(F.col("text") != "")
    ref = lambda c: F.transform(c, lambda r: F.struct(r["_referencia"].alias("ref"), r["palabra"].alias("word"), r["texto"].alias("text")))
    refs = df.select(law, ref(F.col("analisis.referencias.anteriores.anterior")).alias("prior"), ref(F.col("analisis.referencias.posteriores.posterior")).alias("later"))
    return laws, paras, refs, bad


def read_open_data_csv(spark, path, schema):
    """SRC4: header CSV (a byte-order mark is skipped) with the position of each row."""
    return spark.read.option("header", True).option("multiLine", False).option("escape", '"').schema(schema).csv(path)


def conform_csv_feed(df, ord_col="ingest_ord"):
    """SRC4: classify rows by owner and link, split the link by kind, drop the rest."""
    ens, link = F.lower(tx.or_empty("NOM_ENS")), tx.or_empty("ENLLAÇ")
    low = F.lower(link)
    bulletin = (F.when(ens.contains("girona") | low.contains("bopg") | low.contains("ddgi"), "BOPG")
                .when(ens.contains("tarragona") | low.contains("bopt") | low.contains("diputaciodetarragona"), "BOPT"))
    is_pdf = link.endswith(".pdf")
    html, pdf = F.when(link.startswith("http") & ~is_pdf, link), F.when(is_pdf, link)
    d = df.withColumn("bulletin", bulletin).filter("bulletin IS NOT NULL")
    d = global_scan(d, [F.col(ord_col)], {}, "_n")
    return d.select(F.concat(F.lower("bulletin"), F.lit("_ckan_"), F.col("_n").cast("string")).alias("id"), F.col("RESUM").alias("title"), "bulletin", F.col("DATA_PUB").alias("date"),
                    F.col("NOM_ENS").alias("institution"), html.alias("url_html"), pdf.alias("url_pdf"), tx.link_to_text(html, pdf, link).alias("link_to_text"),
                    F.when(tx.nonblank("VIGENT").isNotNull(), F.col("VIGENT") == "True").alias("is_vigent"))


# ---- fixed values: fallback keys of the open-data feeds, in order ------------------------------
FEED_KEYS = {
    "id": ["id_intern", "codi_expedient", "clau"],
    "title": ["denominacio", "descripcio_expedient", "t_tol_convocat_ria_catal", "t_tol_conveni", "t_tol_de_la_norma", "objecte_contracte"],
    "date": ["data_publicacio_contracte", "data_adjudicacio", "data_concessi", "data_signatura", "data_del_document", "any"],
    "html": ["enllac_publicacio"], "pdf": ["format_pdf", "bases_reguladores_url_catal"], "institution": ["nom_organ", "organisme_contractant"],
}


def conform_feed(df, dataset, category, default_institution, raw="raw", ord_col="ingest_ord"):
    """SRC5: one schema for differently shaped feeds, by ordered fallback keys.

    ``raw`` is the record as JSON text, so no feed needs a schema of its own. Links may be
    strings or objects with a url. Ids are generated from the row's place in its feed.
    """
    get = lambda k: F.get_json_object(raw, f"$.{k}")
    first = lambda field: tx.first_nonblank(*[get(k) for k in FEED_KEYS[field]])
    link = lambda field: tx.first_nonblank(*[F.coalesce(F.get_json_object(raw, f"$.{k}.url"), get(k)) for k in FEED_KEYS[field]])
    d = global_scan(df, [F.col(ord_col)], {}, "_n")
    made = F.concat_ws("_", F.lit("socrata"), F.lit(dataset), F.col("_n").cast("string"))
    return d.select(F.coalesce(first("id"), made).alias("id"), F.coalesce(first("title"), F.lit("Document")).alias("title"), F.split_part(first("date"), F.lit("T"), F.lit(1)).alias("date"),
                    F.coalesce(first("institution"), F.lit(default_institution)).alias("institution"), F.lit(category).alias("category"), link("html").alias("url_html"), link("pdf").alias("url_pdf"),
                    tx.link_to_text(link("html"), link("pdf")).alias("link_to_text"))


def as_document_view(df, ord_col="ingest_ord"):
    """SRC6: any table as (id, index, title, data) by fallback keys."""
    has = lambda names: [F.col(n).cast("string") for n in names if n in df.columns]
    d = global_scan(df, [F.col(ord_col)], {}, "_n").withColumn("index", F.col("_n") - 1)
    made_id, made_title = F.concat(F.lit("doc_"), F.col("index").cast("string")), F.concat(F.lit("Document #"), F.col("_n").cast("string"))
    return d.select(tx.first_nonblank(*has(["cido_id", "identificador", "document_id", "id"]), made_id).alias("id"), "index",
                    tx.first_nonblank(*has(["record_title", "title", "nombre"]), made_title).alias("title"), F.to_json(F.struct(*[c for c in df.columns])).alias("data"))


def read_annotations(spark, path):
    """SNK5: span CSV; offsets to integers where they are numbers, default section 'Body'."""
    schema = ", ".join(f"{c} string" for c in rules.ANNOTATION_COLUMNS)
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(schema).csv(path)
    return df.withColumns({"start_offset": F.col("start_offset").try_cast("int"), "end_offset": F.col("end_offset").try_cast("int"),
                           "section_title": F.coalesce(tx.nonblank("section_title"), F.lit("Body")), "section_type": F.coalesce(tx.nonblank("section_type"), F.lit("body"))})
