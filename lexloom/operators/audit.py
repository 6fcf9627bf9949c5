"""Counts, coverage and distributions."""

from functools import reduce

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import text as tx
from lexloom.operators.dedupe import share_of_total
from lexloom.operators.match import parent_document
from lexloom.operators.ordered import top_k
from lexloom.session import cut


def counts(df, col, default="Unknown", by_count=False):
    """AGG1: rows per value, by value or by descending count."""
    c = df.groupBy(F.coalesce(F.col(col).cast("string"), F.lit(default)).alias(col)).agg(F.count(F.lit(1)).alias("n"))
    return c.orderBy(F.col("n").desc(), col) if by_count else c.orderBy(col)


def docs_per_issue(df, ord_col="ingest_ord"):
    """AGG2: documents per issue with the first-seen date; other than numeric issues last."""
    g = df.groupBy(F.coalesce("dogc_number", F.lit("Unknown")).alias("dogc_number")).agg(
        F.min_by("date_dogc", ord_col).alias("date_dogc"), F.min_by("year", ord_col).alias("year"), F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.coalesce(F.when(F.col("dogc_number").rlike(r"^\d+$"), F.col("dogc_number").try_cast("bigint")), F.lit(999999)), "dogc_number")


def _missing(c):
    c = F.col(c).cast("string")
    return c.isNull() | (c == "") | (c == "None")


def completeness(df, fields=None):
    """AGG3: missing count and percent per field, one pass."""
    fields = fields or rules.AUDIT_FIELDS
    one = df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(_missing(f)).alias(f) for f in fields])
    long = one.select("total", F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("missing")) for f in fields])))
    return long.select("field", "missing", F.round(100.0 * F.col("missing") / F.greatest("total", F.lit(1)), 6).alias("pct"))


def incomplete_rows(df, fields=None, must=("document_id", "html_url"), limit=30, ord_col="ingest_ord"):
    """AGG3: the first rows that lack an essential field, with all they lack."""
    fields = fields or rules.AUDIT_FIELDS
    lacking = F.array_compact(F.array(*[F.when(_missing(f), f) for f in fields]))
    bad = reduce(lambda a, b: a | b, [_missing(f) for f in must])
    return df.filter(bad).withColumn("missing", lacking).orderBy(ord_col).limit(limit)


def match_report(df, by, matched="matched_id"):
    """AGG4: total, matched, unmatched and percent by each of several columns."""
    dims = F.array(*[F.struct(F.lit(b).alias("dimension"), F.coalesce(tx.nonblank(b), F.lit("UNKNOWN")).alias("value")) for b in by] +
                   [F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value"))])
    g = df.select(F.col(matched).isNotNull().alias("m"), F.explode(dims).alias("d")).groupBy("d.dimension", "d.value").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("m").alias("matched"))
    return g.withColumns({"unmatched": F.col("total") - F.col("matched"), "pct": F.round(100.0 * F.col("matched") / F.col("total"), 6)})


def match_samples(df, matched="matched_id", k=50, ord_col="ingest_ord"):
    """AGG4: first ``k`` matched and unmatched rows."""
    return top_k(df.withColumn("is_matched", F.col(matched).isNotNull()), ["is_matched"], [ord_col], k, "sample_no")


def module_summary(records, pubs):
    """AGG5: per module and in total: records by number of publications, and publications
    by resolution. pubs: record_id, butlleti, resolved."""
    per = pubs.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if((F.col("butlleti") == "DOGC") & F.col("resolved")).alias("res"),
        F.count_if((F.col("butlleti") == "DOGC") & ~F.col("resolved")).alias("unres"))
    r = records.select("record_id", F.coalesce("type", F.lit("unknown")).alias("module")).join(per, "record_id", "left").fillna(0, ["n", "res", "unres"])
    g = r.rollup("module").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("n") == 0).alias("with_0"), F.count_if(F.col("n") == 1).alias("with_1"), F.count_if(F.col("n") > 1).alias("with_more"),
        F.sum("res").alias("resolved"), F.sum("unres").alias("unresolved"), F.sum(F.col("n") - F.col("res") - F.col("unres")).alias("others"), F.sum("n").alias("publications"))
    return g.withColumn("module", F.coalesce("module", F.lit("Total / All Modules")))


def build_summary(frames):
    """AGG6: size of each table, mapped share of citations, bilingual share, edge types.

    Long form: (metric, value). ``frames`` maps a table name to a DataFrame.
    """
    count = lambda name, df: df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit(f"rows:{name}").alias("metric"), "value")
    kinds = {"citations": lambda: F.when(F.col("is_mapped"), "citations:mapped").otherwise("citations:unmapped"), "edges": lambda: F.concat(F.lit("edge:"), "type")}
    # a table that is told by kind is read once: a row for each kind is kept, and their sum is its size
    tally = {n: cut(frames[n].groupBy(kind().alias("metric")).agg(F.count(F.lit(1)).alias("n"))) for n, kind in kinds.items() if n in frames}
    total = lambda name: tally[name].agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("value")).select(F.lit(f"rows:{name}").alias("metric"), "value")
    parts = [total(n) if n in tally else count(n, d) for n, d in frames.items()]
    parts += [t.select("metric", F.col("n").cast("double").alias("value")) for t in tally.values()]
    if "sections" in frames and "is_bilingual" in frames["sections"].columns:
        parts.append(frames["sections"].agg(F.round(100 * F.avg(F.col("is_bilingual").cast("int")), 6).alias("value")).select(F.lit("sections:bilingual_pct").alias("metric"), "value"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def distributions(df, dims):
    """Counts of several columns in one pass: (dimension, value, n)."""
    d = F.array(*[F.struct(F.lit(n).alias("dimension"), c.cast("string").alias("value")) for n, c in dims.items()])
    return df.select(F.explode(d).alias("d")).groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("n"))


def subset_report(df, top=5):
    """AGG7: distributions of a sample, its 2x2 normative / gazette table, leading
    institutions and their number."""
    norm = F.when(F.col("type") == rules.NORMATIVE_MODULE, "normative").otherwise("non_normative")
    gaz = F.when(F.col("appears_in_dogc"), "gazette").otherwise("other")
    main = distributions(df, {"type": F.coalesce("type", F.lit("Unknown")), "butlleti": F.coalesce("butlleti", F.lit("OTHER")), "year": F.col("year"), "pages": F.col("pages"),
                              "normative x gazette": F.concat_ws(" x ", norm, gaz)})
    inst = df.groupBy(F.coalesce("institucio", F.lit("Unknown")).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    lead = inst.orderBy(F.col("n").desc(), "value").limit(top).select(F.lit("top institution").alias("dimension"), "value", "n")
    distinct = inst.agg(F.count(F.lit(1)).alias("n")).select(F.lit("institutions").alias("dimension"), F.lit("distinct").alias("value"), "n")
    return main.unionByName(lead).unionByName(distinct)


def module_volumes(records, pubs):
    """AGG8: records and publications per module with shares and averages."""
    p = pubs.groupBy("type").agg(F.count(F.lit(1)).alias("publications"))
    g = records.groupBy("type").agg(F.count(F.lit(1)).alias("records")).join(p, "type", "left").fillna(0, ["publications"])
    g = share_of_total(share_of_total(g, "records", "record_pct"), "publications", "publication_pct")
    return g.withColumn("per_record", F.round(F.col("publications") / F.col("records"), 6))


def corpus_distribution(records, pubs, docs, min_year=2015):
    """AGG8: bulletins, validity, ranked types and recent years with shares, in long form."""
    vig = F.when(F.col("es_vigent"), "Vigent").when(~F.col("es_vigent"), "No Vigent").otherwise("Unknown / Null")
    shares = lambda df, name, c: share_of_total(df.groupBy(c.cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))).select(F.lit(name).alias("dimension"), "value", "n", "pct")
    years = shares(docs, "year", F.col("year")).filter(F.col("value").try_cast("int") >= min_year)
    parts = [shares(pubs, "butlleti", F.coalesce("butlleti", F.lit("Other"))), shares(records, "validity", vig), shares(docs, "type", F.coalesce("type", F.lit("Unknown"))), years]
    return reduce(lambda a, b: a.unionByName(b), parts)


def link_coverage(pubs, docs):
    """AGG9: explicit, embedded and implicit links of gazette publications, and how many
    gazette documents they reach. pubs: butlleti, url_pdf, dogc_document_id, embedded."""
    gaz = pubs.filter((F.col("butlleti") == "DOGC") | F.col("dogc_document_id").isNotNull() | F.col("url_pdf").contains("dogc.gencat.cat"))
    a = gaz.agg(F.count(F.lit(1)).alias("gazette_publications"), F.count("dogc_document_id").alias("explicit_id"), F.count_if("embedded").alias("embedded_record"),
                F.count_if(F.col("dogc_document_id").isNull()).alias("implicit"))
    ids_ = docs.select(F.col("document_id").cast("string").alias("_d")).distinct()
    linked = ids_.join(gaz.select(F.col("dogc_document_id").alias("_d")).distinct(), "_d", "left_semi").agg(F.count(F.lit(1)).alias("linked"))
    total = ids_.agg(F.count(F.lit(1)))
    out = a.withColumns({"documents": total.scalar(), "linked_documents": linked.scalar()})
    return out.withColumns({"unlinked_documents": F.col("documents") - F.col("linked_documents"), "linked_pct": F.round(100.0 * F.col("linked_documents") / F.col("documents"), 6)})


def era_histogram(df, ranges, year="year"):
    """AGG10: documents and yearly mean per named year range."""
    era = None
    for name, lo, hi in ranges:
        hit = F.col(year).between(lo, hi)
        s = F.struct(F.lit(name).alias("era"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
        era = F.when(hit, s) if era is None else era.when(hit, s)
    g = df.withColumn("e", era).filter("e IS NOT NULL").groupBy("e.era", "e.lo", "e.hi").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("per_year", F.round(F.col("n") / (F.col("hi") - F.col("lo") + 1), 6))


def provenance():
    return (F.when(F.col("extracted"), "extracted (ADD)").when(F.col("modified"), "modified (MODIFY/FIX)")
            .when(F.col("verified"), "verified (KEEP)").otherwise("original_or_other"))


def graph_audit(nodes, edges):
    """AGG11: totals, action sums, label-set, edge-type and provenance distributions.

    nodes: labels (array), processed, created, kept, modified, added. edges: type,
    extracted, modified, verified.
    """
    label = F.array_join(F.array_sort("labels"), ":")
    n = nodes.agg(F.count(F.lit(1)).alias("total_nodes"), F.count_if("processed").alias("nodes_processed"), F.count_if("created").alias("nodes_created"),
                  *[F.coalesce(F.sum(F.when(F.col("processed"), F.col(c))), F.lit(0)).alias(f"citations_{c}") for c in ("kept", "modified", "added")])
    names = n.columns
    long = n.select(F.inline(F.array(*[F.struct(F.lit("summary").alias("dimension"), F.lit(c).alias("value"), F.col(c).cast("long").alias("n")) for c in names])))
    created = distributions(nodes.filter("created"), {"created labels": label})
    return (long.unionByName(distributions(nodes, {"labels": label})).unionByName(created)
            .unionByName(distributions(edges, {"edge type": F.coalesce("type", F.lit("UNKNOWN")), "provenance": provenance()}))
            .unionByName(edges.agg(F.count(F.lit(1)).alias("n")).select(F.lit("summary").alias("dimension"), F.lit("total_edges").alias("value"), "n")))


def node_audit(nodes, edges, before, snippet=300):
    """AGG12: one row per audited edge of a processed node: action, target, the target's
    parent document and, for modified edges, the state before.

    Rows replace per-node lists, so a node with very many citations is no problem.
    nodes: id, label, title, text, processed. edges: edge_id, src, dst, type, extracted,
    modified, verified. before: edge_id, dst, type.
    """
    par = parent_document(nodes, edges.select("src", "dst", "type"))
    name = nodes.select(F.col("id").alias("dst"), F.col("title").alias("target_title"))
    text = F.coalesce("text", F.lit(""))
    src = nodes.filter("processed").select(F.col("id").alias("src"), F.col("title"), F.when(F.length(text) > snippet, F.concat(F.substring(text, 1, snippet), F.lit("..."))).otherwise(text).alias("text_snippet"))
    action = F.when(F.col("extracted"), "added").when(F.col("modified"), "modified").when(F.col("verified"), "kept")
    e = edges.withColumn("action", action).filter("action IS NOT NULL").join(src, "src").join(name, "dst", "left")
    e = e.join(par.select(F.col("id").alias("dst"), F.col("parent_id").alias("target_parent")), "dst", "left")
    b = before.select("edge_id", F.col("dst").alias("before_dst"), F.col("type").alias("before_type"))
    e = e.join(b, "edge_id", "left")
    old = lambda c, d: F.when(F.col("action") == "modified", F.coalesce(c, F.lit(d)))
    return e.select("src", "title", "text_snippet", "action", "edge_id", "dst", "target_title", "target_parent", "type",
                    old("before_dst", "N/A").alias("before_dst"), old("before_type", "UNKNOWN").alias("before_type"))


def url_status(df, code="status_code"):
    """AGG13: active and eliminated addresses by landed status code."""
    s = F.when(F.col(code).isin(rules.ACTIVE_STATUS_CODES), "active").otherwise("eliminated")
    return df.groupBy(s.alias("url_status")).agg(F.count(F.lit(1)).alias("n"))


def annotation_stats(df):
    """AGG14: annotations and those with key-values, per document, category and overall."""
    filled = tx.nonblank("key_values_json").isNotNull() & ~F.col("key_values_json").isin("{}", "[]")
    d = F.array(F.struct(F.lit("document").alias("dimension"), F.col("doc_id").cast("string").alias("value")),
                F.struct(F.lit("category").alias("dimension"), F.col("category").alias("value")), F.struct(F.lit("all").alias("dimension"), F.lit("all").alias("value")))
    return df.select(F.explode(d).alias("d"), filled.alias("f")).groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("annotations"), F.count_if("f").alias("with_key_values"))


def subset_summary(df):
    """AGG15: one row about a sample."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("pages") == 1).alias("one_page"), F.count_if(F.col("pages") == 2).alias("two_pages"),
                  F.count_if("reachable").alias("reachable"), F.count_if(F.col("type") == rules.NORMATIVE_MODULE).alias("normative"),
                  F.count_if("appears_in_dogc").alias("in_gazette"), F.min("year").alias("min_year"), F.max("year").alias("max_year"))
