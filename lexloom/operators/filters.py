"""Row filters and limits."""

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import ids, text as tx


def select_docs(df, years=None, limit=None, ord_col="ingest_ord"):
    """FIL1: listed years; first ``limit`` rows, or the last ones when it is negative."""
    if years:
        df = df.filter(F.col("year").cast("string").isin([str(y) for y in years]))
    if limit:
        df = df.orderBy(F.col(ord_col) if limit > 0 else F.col(ord_col).desc()).limit(abs(limit))
    return df


def since(df, year, min_year):
    """FIL2: year at or after the bound; unparsable years count as 0 and drop out."""
    return df.filter(F.coalesce(F.col(year).try_cast("int"), F.lit(0)) >= min_year)


def filter_sections(df, codes, code="section_code", ident="ident"):
    """FIL3: wanted section codes unless 'all'; index summaries dropped."""
    if codes and "all" not in codes:
        df = df.filter(F.col(code).isin(list(codes)))
    return df.filter(~F.col(ident).startswith("BOE-S"))


def eligible_units(df, lo, hi, date="data_publicacio", pdf="url_pdf"):
    """FIL4: year within bounds and a PDF address present."""
    return df.filter(ids.leading_year(date).between(lo, hi) & tx.nonblank(pdf).isNotNull())


def unresolved_status(df, min_year, force=False):
    """FIL5: why a publication is or is not a resolution target.

    Needs butlleti, appears_in_dogc, matched, year, attempted.
    """
    wanted = ((F.col("butlleti") == "DOGC") | F.col("appears_in_dogc")) & ~F.col("matched")
    early = (F.col("year") > 0) & (F.col("year") < min_year)
    return df.withColumn("status", F.when(~F.coalesce(wanted, F.lit(False)), "not_wanted").when(early, "before_min_year")
                         .when(F.col("attempted") & F.lit(not force), "attempted").otherwise("target"))


def pending_sections(nodes, flag, n=None):
    """FIL6: unprocessed section nodes with text in either language."""
    text = tx.first_nonblank("text_es", "text_ca")
    df = nodes.filter(F.array_contains("labels", "DocumentSection") & text.isNotNull() & ~F.coalesce(flag, F.lit(False)))
    return df if n is None else df.orderBy("id").limit(n)


def legacy_docs(df, notice="additional_text", pdf="pdf_url"):
    """FIL7: second-language text exists only as a PDF that is linked."""
    note = F.coalesce(F.col(notice), F.lit(""))
    marked = F.lower(note).contains(rules.LEGACY_NOTICE_LOWER)
    for m in rules.LEGACY_NOTICE_MARKS:
        marked = marked | note.contains(m)
    return df.filter(marked & tx.nonblank(pdf).isNotNull())


def valid_citation_ref(ref):
    """FIL8: not a connector word, longer than two characters, holds a digit."""
    r = F.lower(F.trim(ref))
    return ~r.isin(rules.REF_STOPWORDS) & (F.length(r) > 2) & r.rlike(r"\p{Nd}")


def valid_article_token(tok):
    """FIL9: known ordinal word, or a number with an optional suffix."""
    t = F.lower(F.trim(tok))
    return t.isin(rules.ARTICLE_ORDINALS) | t.rlike(r"(?U)^\d+[\w\-]*$")


def drop_redundant_gazette_refs(items, by, doc_type="doc_type", number="document_number",
                                title="cited_title", raw="raw_text"):
    """FIL10: within a source drop gazette-issue citations when a specific law is cited there
    or the snippet itself names one; keep everything when that would leave nothing.

    Flags are aggregated per source before the join, so a hot source is never gathered.
    """
    kind = F.lower(tx.or_empty(doc_type))
    name = F.lower(F.trim(tx.or_empty(tx.first_nonblank(title, raw))))
    gazette = (F.trim(kind) == "dogc") | name.contains("dogc") | name.contains("diari oficial")
    named = F.lower(tx.or_empty(raw)).rlike(r"(?U)\b(llei|ley|decret|decreto|ordre|orden|resoluci[oó])\s+\d+")
    specific = kind.isin(rules.SPECIFIC_LAW_TYPES) | tx.nonblank(number).isNotNull()
    df = items.withColumns({"_gazette": gazette, "_named": named, "_specific": specific})
    flags = df.groupBy(*by).agg(F.max("_specific").alias("_any"), F.max(~F.col("_gazette")).alias("_plain"),
                                F.max(F.col("_gazette") & ~F.col("_named")).alias("_bare"))
    drop = F.col("_gazette") & (F.col("_any") | F.col("_named"))
    survivors = F.col("_plain") | (F.col("_bare") & ~F.col("_any"))
    return df.join(flags, by).filter(~drop | ~survivors).select(*items.columns)


def search_counts(df, text, query_text, key):
    """FIL12: case-insensitive literal hits per document."""
    return df.select(key, F.regexp_count(text, F.lit("(?iu)\\Q" + query_text.replace("\\E", "\\E\\\\E\\Q") + "\\E")).alias("hits"))
