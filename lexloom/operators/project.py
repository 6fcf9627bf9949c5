"""Projections that need more than one column, a join or an explode."""

from pyspark.sql import functions as F

from lexloom.functions import doctype, ids, markup, text as tx


def fill_document_types(df, force=False):
    """Fill missing, 'Unknown' or 'Other' types from the title."""
    return df.withColumn("type", doctype.filled_type("type", "title", force))


def with_elis(docs):
    """Document and issue identifiers; a given ``eli_uri`` wins for the document."""
    y, m, d = ids.issue_year("date_dogc", "year")
    return docs.withColumns({"doc_eli": ids.eli_path("doc", (y, m, d), "document_id", "eli_uri"),
                             "issue_eli": ids.eli_path("dogc", (y, m, d), "dogc_number")})


def _extra_label(labels):
    return F.get(F.filter(labels, lambda x: ~x.isin("Document", "DocumentSection", "Article")), F.lit(0))


def node_document_type(nodes, section_edges, backup=None):
    """PRJ19: type of a node: own field, extra label, title; sections take their parent's,
    else that of the document named in their id, else a backup table's, else their text."""
    is_doc = F.array_contains("labels", "Document")
    own = F.coalesce(tx.nonblank("type_of_law"), _extra_label(F.col("labels")), doctype.type_from_text("title"), F.lit("Document"))
    doc_type = nodes.filter(is_doc).select(F.col("id").alias("doc"), own.alias("doc_type"))
    # the last parent edge wins, one row per child
    parent = section_edges.groupBy("dst").agg(F.max("src").alias("parent"))
    df = (nodes.join(parent, nodes["id"] == parent["dst"], "left")
          .join(doc_type, F.col("parent") == F.col("doc"), "left").drop("doc")
          .withColumnRenamed("doc_type", "parent_type")
          .join(doc_type, F.col("doc_prefix") == F.col("doc"), "left").drop("doc")
          .withColumnRenamed("doc_type", "prefix_type"))
    backed = F.lit(None).cast("string")
    if backup is not None:
        b = backup.select(F.col("doc_prefix").alias("_b"), F.coalesce(tx.nonblank("type_of_law"), doctype.type_from_text("title")).alias("_bt"))
        df, backed = df.join(b, F.col("doc_prefix") == F.col("_b"), "left"), F.col("_bt")
    loose = F.coalesce(_extra_label(F.col("labels")), doctype.type_from_text("title"),
                       doctype.type_from_text("text"), F.col("own_type"), F.lit("Unknown"))
    return df.select("id", F.when(is_doc, own).otherwise(F.coalesce("parent_type", "prefix_type", backed, loose)).alias("document_type"))


def tables_to_markdown(df, html):
    """One row per HTML table, ``n`` is its position in the page."""
    return (df.select("*", F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)(<table\b.*?</table>)"), F.lit(1))).alias("n", "_table"))
            .withColumn("markdown", markup.table_to_markdown("_table")).drop("_table"))


def markdown_blocks(df, key, markdown):
    """PRJ31: headings and paragraphs of markdown text, bullets dropped.

    A document is one row, so its lines are grouped inside the row: blank lines and
    headings end a paragraph. Splitting on them leaves one block per piece.
    """
    marked = F.regexp_replace(F.regexp_replace(markdown, r"(?m)^[ \t]+|[ \t\r]+$", ""), r"(?m)^(#.*)$", "\n\n$1\n\n")
    pieces = F.filter(F.split(marked, r"\n\s*\n"), lambda p: F.trim(p) != "")
    pieces = F.transform(pieces, lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    clean = lambda p: F.array_join(F.transform(F.split(p, "\n"), lambda x: F.regexp_replace(F.regexp_replace(x, r"^\*+\s*", ""), r"^-\s*", "")), " ")
    return (df.select(key, F.posexplode(pieces).alias("block", "_p"))
            .select(key, "block", F.when(F.col("_p").startswith("#"), "h2").otherwise("p").alias("kind"),
                    F.when(F.col("_p").startswith("#"), F.regexp_replace("_p", r"^#+\s*", "")).otherwise(F.trim(clean(F.col("_p")))).alias("text")))


def parse_answers(df, answer, item_schema, keys):
    """PRJ32: one row per item of a model answer."""
    return df.select(*keys, F.inline(markup.answer_items(answer, item_schema)))
