"""Incremental refresh and reviewed corrections."""

from pyspark.sql import functions as F

from lexloom.functions import text as tx
from lexloom.operators.match import match_section_prefix
from lexloom.operators.ordered import first_row


def append_new(feed, existing, key):
    """INC1: rows whose key is unknown, before the existing ones.

    Does not depend on the feed being newest-first, so it can be repeated safely.
    """
    new = feed.join(existing.select(key).distinct(), key, "left_anti").withColumn("is_new", F.lit(True))
    return new.unionByName(existing.withColumn("is_new", F.lit(False)), allowMissingColumns=True)


def since_last(feed, existing, key, date):
    """INC2: rows from the latest stored date on, inclusive, whose key is unknown."""
    last = existing.agg(F.max(date)).scalar()
    return feed.filter(last.isNull() | (F.col(date) >= last)).join(existing.select(key).distinct(), key, "left_anti")


def apply_resolution(pubs, matches, attempted, key):
    """INC3: write found ids, links and summaries back and mark attempts.

    matches: key, document_id, html_url, summary. attempted: key.
    """
    m = first_row(matches.select(key, F.col("document_id").cast("string").alias("_d"), F.col("html_url").alias("_u"), F.col("summary").alias("_s")), [key], ["_d"])
    a = attempted.select(key).distinct().withColumn("_a", F.lit(True))
    df = pubs.join(a, key, "left").join(m, key, "left")
    hit = F.col("_d").isNotNull()
    return df.withColumns({
        "attempted": F.coalesce("_a", "attempted"), "appears_in_dogc": F.col("appears_in_dogc") | hit, "dogc_document_id": F.coalesce("_d", "dogc_document_id"),
        "url_html": F.when(hit, F.coalesce(tx.nonblank("_u"), F.col("url_html"))).otherwise(F.col("url_html")), "matched_record": F.coalesce("_s", "matched_record")}).drop("_a", "_d", "_u", "_s")


KEEP, CHANGE, DROP, ADD, ALWAYS = ["KEEP", "VERIFY_EXISTING"], ["MODIFY", "FIX_EXISTING"], ["REMOVE"], ["ADD"], ["ADD_SECOND_EDGE", "CREATE_NEW_EDGE"]


def reconcile(edges, decisions):
    """INC4: apply reviewed decisions to edges. Returns (edges, counters per source).

    edges: edge_id, src, dst, type, details. decisions: ord, edge_id (NULL for additions),
    src, action, new_dst, new_type, details. The last decision about an edge counts. ADD
    appends unless an equal (source, target, type) exists; the other additions always append.
    """
    d = decisions.withColumn("action", F.upper(F.trim("action")))
    on_edge = d.filter(F.col("edge_id").isNotNull() & F.col("action").isin(KEEP + CHANGE + DROP))
    last = on_edge.groupBy("edge_id").agg(F.max_by(F.struct("action", "new_dst", "new_type", F.col("details").alias("new_details")), "ord").alias("x")).select("edge_id", "x.*")
    j = edges.join(last, "edge_id", "left")
    change = F.coalesce(F.col("action").isin(CHANGE), F.lit(False))
    done = j.select("edge_id", "src", F.when(change, F.coalesce("new_dst", "dst")).otherwise(F.col("dst")).alias("dst"), F.when(change, F.coalesce(tx.nonblank("new_type"), F.col("type"))).otherwise(F.col("type")).alias("type"),
                    F.when(change, F.coalesce(tx.nonblank("new_details"), F.col("details"))).otherwise(F.col("details")).alias("details"), F.coalesce(F.col("action").isin(KEEP), F.lit(False)).alias("verified"),
                    change.alias("modified"), F.lit(False).alias("extracted"), F.coalesce(F.col("action").isin(DROP), F.lit(False)).alias("_gone"))
    kept = done.filter("NOT _gone").drop("_gone")
    fresh = d.select("ord", "src", F.col("new_dst").alias("dst"), F.coalesce(tx.nonblank("new_type"), F.lit("CITES")).alias("type"), "details", "action").filter("dst IS NOT NULL")
    cols = ["src", "dst", "type"]
    once = first_row(fresh.filter(F.col("action").isin(ADD)), cols, ["ord"]).join(kept.select(*cols).distinct(), cols, "left_anti")
    new = once.unionByName(fresh.filter(F.col("action").isin(ALWAYS)))
    new = new.select(F.concat(F.lit("new:"), F.col("ord").cast("string")).alias("edge_id"), *cols, "details", F.lit(False).alias("verified"), F.lit(False).alias("modified"), F.lit(True).alias("extracted"))
    tally = done.filter("verified OR modified OR _gone").select("src", "verified", "modified", F.col("_gone").alias("removed"), F.lit(False).alias("added")).unionByName(
        new.select("src", F.lit(False).alias("verified"), F.lit(False).alias("modified"), F.lit(False).alias("removed"), F.lit(True).alias("added")))
    counters = tally.groupBy("src").agg(F.count_if("verified").alias("kept"), F.count_if("modified").alias("modified"), F.count_if("removed").alias("removed"), F.count_if("added").alias("added"))
    return kept.unionByName(new), counters


def final_target(items, sections, create=False, keys=("source_id", "item_no")):
    """INC5: where a resolved citation points: the document when it is general or names no
    article, the section when found, else the document, or a new section on request."""
    found = match_section_prefix(items.select(*keys, "document_id", "article_or_section"), sections, keys).select(*keys, "section_id")
    df = items.join(found, list(keys))
    named = (tx.nonblank("article_or_section").isNotNull()) & ~F.coalesce("is_general", F.lit(False))
    doc = F.col("document_id").cast("string")
    made = F.concat(F.lit("new:"), doc, F.lit(":"), tx.section_key("article_or_section")) if create else doc
    return df.select(*keys, F.when(F.col("document_id").isNull(), F.lit(None)).when(~named, doc).otherwise(F.coalesce("section_id", made)).alias("target"),
                     F.when(F.col("document_id").isNull(), "unresolved").when(named & F.col("section_id").isNotNull(), "section").when(named & F.lit(create), "new section").otherwise("document").alias("target_kind"))


def flag_nodes(nodes, processed, counters):
    """INC6: processed nodes marked, with their action counts in the property map."""
    p = processed.select("id").distinct().withColumn("_p", F.lit(True))
    names = ["kept", "modified", "removed", "added"]
    c = counters.select(F.col("src").alias("id"), *[F.col(n).alias(f"_{n}") for n in names])
    df = nodes.join(p, "id", "left").join(c, "id", "left")
    entries = [x for n in names for x in (F.lit(f"citations_{n}"), F.coalesce(F.col(f"_{n}"), F.lit(0)).cast("string"))]
    props = F.map_concat("props", F.create_map(F.lit("processed"), F.lit("true"), *entries))
    return df.select(*[x for x in nodes.columns if x != "props"], F.when(F.col("_p"), props).otherwise(F.col("props")).alias("props"))
