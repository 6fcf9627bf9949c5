"""Legal references: extraction from text and from editorial links."""

from functools import reduce

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import text as tx
from lexloom.operators.filters import valid_article_token, valid_citation_ref


# ---- CIT3 / CIT4: one editorial link or clause ------------------------------------------------
def _any_word(c, words):
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: c.contains(w))


def affectation_action(c):
    """CIT3: what the link does, by keyword priority."""
    low, out = F.lower(F.coalesce(tx.col(c), F.lit(""))), None
    for name, words in rules.ACTION_WORDS:
        hit = _any_word(low, words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Other")


def _strip_marks(t):
    return F.regexp_replace(t, r"^[.\- ]+|[.\- ]+$", "")


def affected_sections(c, faithful=True):
    """CIT3: articles, annexes and dispositions named in a text, in order, no repeats.

    ``faithful`` splits article lists on the letters i/y even inside words, as the
    expected results do; otherwise only on whole conjunctions.
    """
    return tx.bind(F.lower(F.coalesce(tx.col(c), F.lit(""))), lambda low: _affected(low, faithful))


def _found(low, words, pattern, group):
    """Every hit of a pattern that needs one of ``words``; other texts, most by far, aren't searched."""
    there = reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    return F.when(there, F.regexp_extract_all(low, F.lit(pattern), F.lit(group))).otherwise(F.array().cast("array<string>"))


def _affected(low, faithful):
    """``affected_sections`` of a text in lower case."""
    breaker = rules.ARTICLE_TOKEN_BREAK if faithful else rules.ARTICLE_WORD_BREAK
    lists = _found(low, ["art"], rules.ARTICLE_LIST, 2)
    toks = F.transform(F.flatten(F.transform(lists, lambda s: F.split(s, breaker))), lambda t: _strip_marks(t))
    name = lambda prefix: lambda t: F.concat(F.lit(prefix), tx.capitalise(t))
    articles = F.transform(F.filter(toks, lambda t: valid_article_token(t)), name("Article "))
    single = F.transform(_found(low, ["art"], rules.ARTICLE_SINGLE, 1), name("Article "))
    annexes = F.transform(_found(low, ["annex", "anexo"], rules.ANNEX_MENTION, 1),
                          lambda t: F.when(_strip_marks(t) == "", "Annex").otherwise(F.concat(F.lit("Annex "), tx.capitalise(_strip_marks(t)))))
    disps = F.transform(_found(low, ["disposici"], rules.DISPOSITION_MENTION, 1), name("Disposicio "))
    listed = tx.bind(articles, lambda a: F.when(F.size(a) > 0, a).otherwise(single))
    return F.array_distinct(F.concat(listed, annexes, disps))


def doc_ref(c):
    """CIT4: first 'type reference' in a text."""
    return F.nullif(F.trim(F.regexp_extract(F.coalesce(tx.col(c), F.lit("")), rules.DOC_REF, 0)), F.lit(""))


def classify_affectations(affs, text="text"):
    """CIT3 + CIT4 over a table of editorial links."""
    action = affectation_action(text)
    edge = F.create_map(*[F.lit(x) for kv in rules.ACTION_EDGE.items() for x in kv])
    return affs.withColumns({"action": action, "affected": affected_sections(text), "doc_ref": doc_ref(text)}).withColumn(
        "edge_type", edge[F.col("action")])


# ---- clauses ------------------------------------------------------------------------------------
def clauses(df, text, keep):
    """Clauses of a text, split at ';', '.' and line ends."""
    return (df.select(*keep, F.posexplode(F.split(text, rules.CLAUSE_BREAK)).alias("clause_no", "clause"))
            .withColumn("clause", F.trim("clause")).filter(F.col("clause") != ""))


def _refs(clause):
    # a value holds no white space and a type doesn't end in it, so a hit falls apart at its last gap
    hits = F.regexp_extract_all(clause, F.lit(rules.CITED_REF), F.lit(0))
    part = lambda h, n: F.regexp_extract(h, r"(?Us)^(.*\S)\s+(\S+)$", n)
    return F.filter(F.transform(hits, lambda h: F.struct(part(h, 1).alias("t"), part(h, 2).alias("v"))), lambda r: valid_citation_ref(r["v"]))


def cited_refs(paras, keep, text="text"):
    """References of each clause crossed with the articles that clause names ('' if none)."""
    df = clauses(paras.filter(F.col(text).rlike(rules.CITED_REF)), text, keep)
    df = df.select(*keep, "clause_no", "clause", F.posexplode(_refs(F.col("clause"))).alias("ref_no", "_r"))
    arts = tx.bind(affected_sections("clause"), lambda a: F.when(F.size(a) > 0, a).otherwise(F.array(F.lit(""))))
    df = df.select(*keep, "clause_no", "ref_no", F.col("_r.t").alias("ref_type"), F.col("_r.v").alias("ref_value"),
                   F.posexplode(arts).alias("art_no", "article"))
    ref = F.concat_ws(" ", "ref_type", "ref_value")
    return df.withColumns({"cited": ref, "cited_key": tx.section_key(ref)})


# ---- JON2: resolve by number ----------------------------------------------------------------------
def number_index(docs, key="document_id", number="document_number", title="title", type_col="type", ord_col="ingest_ord"):
    """First two documents per (n/n number, cited type), so a self match has a runner-up.

    Types are tested against the fixed list while indexing. The lookup is then an equi join
    on a unique key: a number shared by a third of the corpus stays one row per type.
    """
    d = docs.select(F.col(key).alias("_id"), F.col(ord_col).alias("_ord"),
                    F.lower(F.concat_ws("\u0001", tx.or_empty(number), tx.or_empty(title))).alias("_numbers"),
                    F.lower(F.concat_ws("\u0001", tx.or_empty(type_col), tx.or_empty(title))).alias("_names"))
    nums = F.array_distinct(F.regexp_extract_all("_numbers", F.lit(f"({rules.REF_NUMBER})"), F.lit(1)))
    kinds = F.filter(F.array(*[F.lit(t) for t in rules.CITED_TYPES]), lambda t: F.contains(F.col("_names"), t))
    idx = (d.select("_id", "_ord", "_names", F.explode(nums).alias("ref_number"))
           .select("_id", "_ord", "ref_number", F.explode(kinds).alias("ref_kind")))
    pair = F.struct(F.col("_ord"), F.col("_id"))
    best = idx.groupBy("ref_number", "ref_kind").agg(F.min(pair).alias("a"))
    # second best: minimum over the rest, again a plain aggregate
    rest = (idx.join(best, ["ref_number", "ref_kind"]).filter(pair > F.col("a"))
            .groupBy("ref_number", "ref_kind").agg(F.min(pair).alias("b")))
    return best.join(rest, ["ref_number", "ref_kind"], "left").select(
        "ref_number", "ref_kind", F.col("a._id").alias("first_id"), F.col("b._id").alias("second_id"))


def resolve_refs(refs, docs, source="document_id", ref_type="ref_type", ref_value="ref_value"):
    """JON2: target document of each reference; misses stay with a NULL target."""
    idx = number_index(docs)
    df = refs.withColumns({"ref_number": F.nullif(F.regexp_extract(F.lower(ref_value), rules.REF_NUMBER, 0), F.lit("")), "ref_kind": F.lower(ref_type)})
    out = df.join(idx, ["ref_number", "ref_kind"], "left")
    target = F.when(F.col("first_id") == F.col(source), F.col("second_id")).otherwise(F.col("first_id"))
    return out.withColumn("target_id", target).select(*refs.columns, "target_id")


def match_section(df, sections, target="target_id", article="article", key="document_id", title="title", no="section_no"):
    """JON3: first section of the target whose normalised title equals the cited one."""
    idx = sections.groupBy(F.col(key).alias("_doc"), tx.section_key(title).alias("_key")).agg(F.min(no).alias("target_section"))
    cond = (F.col(target) == F.col("_doc")) & (tx.section_key(article) == F.col("_key"))
    return df.join(idx, cond, "left").drop("_doc", "_key")


# ---- CIT1 / CIT2 --------------------------------------------------------------------------------
def extract_citations(section_paras, docs, sections=None, key="document_id", other=None):
    """CIT1: one row per (section, target or cited key, article).

    ``other`` holds the sections' paragraphs in a second language (same columns); what both
    languages cite counts once, as the first language has it.

    Works on paragraphs: a section's paragraphs are joined by line ends, which also end
    clauses, so nothing is lost and no section text has to be assembled. Without
    ``sections`` the cited section is not looked up.
    """
    scanned = F.when(F.col("kind").isNotNull() & ~F.col("content"), F.col("heading")).otherwise(F.col("text"))
    texts = [(0, section_paras), *([(1, other)] if other is not None else [])]
    paras = reduce(lambda a, b: a.unionByName(b), [p.select(key, "section_no", F.lit(n).alias("lang_no"), "ord", scanned.alias("text")) for n, p in texts]).filter(F.col("text").isNotNull())
    refs = resolve_refs(cited_refs(paras, [key, "section_no", "lang_no", "ord"]), docs, key)
    dedupe = F.coalesce(F.col("target_id").cast("string"), F.col("cited_key"))
    refs = refs.withColumn("_to", dedupe)
    one = refs.groupBy(key, "section_no", "_to", "article").agg(
        F.min_by(F.struct("target_id", "cited", "ref_type"), F.struct("lang_no", "ord", "clause_no", "ref_no", "art_no")).alias("x"))
    out = one.select(key, "section_no", "article", "x.*", F.col("x.target_id").isNotNull().alias("is_mapped"))
    return out if sections is None else match_section(out, sections, key=key)


def simple_citations(sections, keep, text="text"):
    """CIT2: every 'type reference' pair, pointing to a slug of the reference."""
    n = F.regexp_extract_all(text, F.lit(rules.SIMPLE_CITATION), F.lit(2))
    t = F.regexp_extract_all(text, F.lit(rules.SIMPLE_CITATION), F.lit(1))
    df = sections.select(*keep, F.posexplode(F.arrays_zip(t.alias("t"), n.alias("v"))).alias("cit_no", "c"))
    return df.select(*keep, "cit_no", F.concat(F.lit("ref_"), tx.slug("c.v")).alias("target"), F.concat_ws(" ", F.trim("c.t"), F.trim("c.v")).alias("raw_text"))


# ---- CIT5 -----------------------------------------------------------------------------------------
def affected_from_source(df, keep, text="text", ref="doc_ref"):
    """CIT5: sections a source text says are affected, one row each.

    Clauses about another law are skipped unless they name the target too.
    """
    c = clauses(df.withColumn("_ref", F.lower(tx.or_empty(ref))), text, keep + ["_ref"])
    low, want = F.lower("clause"), F.col("_ref")
    num = F.regexp_extract(want, rules.REF_NUMBER, 0)
    names_target = (want != "") & (low.contains(want) | ((num != "") & low.contains(num)))
    others = F.exists(_refs(F.col("clause")), lambda r: ~(
        ((num != "") & F.lower(F.concat_ws(" ", r["t"], r["v"])).contains(num)) | ((want != "") & F.lower(F.concat_ws(" ", r["t"], r["v"])).contains(want))))
    skip = (_any_word(low, rules.OTHER_LAW_WORDS) | others) & ~names_target
    arts = affected_sections("clause")
    n = F.regexp_extract(low, rules.ANNEX_NUMBER, 1)
    extra = F.array_compact(F.array(
        F.when(_any_word(low, rules.PREAMBLE_WORDS), "Preamble"), F.when(_any_word(low, rules.SIGNATURE_WORDS), "Signature"),
        F.when(_any_word(low, rules.ANNEX_WORDS) & ~F.exists(arts, lambda a: a.startswith("Annex ")),
               F.when(n != "", F.concat(F.lit("Annex "), n)).otherwise("Annex"))))
    return c.filter(~skip).select(*keep, F.explode(F.concat(arts, extra)).alias("affected")).distinct()


# ---- CIT6 - CIT9: national references ----------------------------------------------------------------
def reference_keys(refs, text="text"):
    """Search keys of an editorial reference: law numbers and named codes."""
    nums = F.regexp_extract_all(text, F.lit(rules.REFERENCE_NUMBER), F.lit(1))
    codes = F.array_compact(F.array(*[F.when(_or_contains(F.col(text), marks), name) for name, marks in rules.NAMED_CODES]))
    return refs.withColumn("key", F.explode(F.array_distinct(F.concat(nums, codes))))


def _or_contains(c, marks):
    hit = F.lit(False)
    for m in marks:
        hit = hit | c.contains(m)
    return hit


def block_keys(blocks, keep, text="text"):
    """Every key a block could contain: named codes, and numbers with shorter readings.

    '5/1999' also occurs inside '15/19991', so each number yields its left suffixes with
    the first four digits of its right part.
    """
    nums = F.regexp_extract_all(text, F.lit(rules.BLOCK_NUMBER), F.lit(1))
    variants = F.flatten(F.transform(nums, lambda n: F.transform(F.sequence(F.lit(1), F.length(F.split_part(n, F.lit("/"), F.lit(1)))),
                                                                  lambda i: F.substring(n, i, F.length(n)))))
    codes = F.array_compact(F.array(*[F.when(F.col(text).contains(name), name) for name, _ in rules.NAMED_CODES]))
    return blocks.select(*keep, F.explode(F.array_distinct(F.concat(variants, codes))).alias("key"))


def tagged_citations(blocks, refs, law="law_id", block="block_no", name="name", text="text"):
    """CIT6: a citation for each (block, editorial reference) whose key the block contains.

    The join is on (law, key); its size is the size of the result.
    """
    rk = reference_keys(refs.withColumn("_own", F.nullif(F.trim(F.regexp_extract("text", rules.NATIONAL_ARTICLE, 1)), F.lit(""))))
    rk = rk.select(law, "ref_no", "target_id", "relation", F.col("text").alias("ref_text"), "_own", "key")
    b = blocks.select(law, block, name, text)
    hit = block_keys(b, [law, block, name, text]).join(rk, [law, "key"])
    at = F.instr(F.col(text), F.col("key"))
    start = F.greatest(at - 100, F.lit(1))
    around = F.substring(F.col(text), start, at + F.length("key") + 99 - start + 1)
    near = F.nullif(F.trim(F.regexp_extract(around, rules.NATIONAL_ARTICLE, 1)), F.lit(""))
    hit = hit.withColumn("_near", F.when(F.col("_own").isNull(), near))
    one = hit.groupBy(law, block, name, "ref_no", "target_id", "relation", "ref_text").agg(
        F.max("_own").alias("_own"), F.min_by("_near", F.when(F.col("_near").isNotNull(), F.col("key"))).alias("_near"))
    return one.select(F.col(law).alias("citing_law"), F.col(block), F.col(name).alias("citing_article"), F.col("target_id").alias("cited_law"),
                      F.coalesce("_own", "_near", F.lit("Todo")).alias("cited_article"), F.col("relation").alias("relation_type"), F.col("ref_text").alias("context"))


def _signature(c):
    return F.lower(tx.squeeze(c))


def signature_index(docs, ident="identificador", title="titulo", ord_col="ingest_ord"):
    """CIT7: 'type n/yyyy' signature of each title; the last document wins."""
    rx = "(?iU)" + rules.NATIONAL_SIGNATURE
    sig = _signature(F.concat_ws(" ", F.regexp_extract(title, rx, 1), F.regexp_extract(title, rx, 2)))
    return (docs.filter(F.col(title).rlike(rx)).select(sig.alias("signature"), F.col(ident), F.col(ord_col))
            .groupBy("signature").agg(F.max_by(ident, ord_col).alias("target_id")))


def untagged_citations(blocks, index, tagged, law="law_id", block="block_no", name="name", text="text"):
    """CIT8: signatures in a block that the index knows and CIT6 has not emitted."""
    rx = "(?iUs)" + rules.NATIONAL_SIGNATURE
    hits = F.regexp_extract_all(text, F.lit(rx), F.lit(0))
    # what lies between a signature and the one before it, at most its last 60 characters
    gaps = F.slice(F.split(F.col(text), rx), F.lit(1), F.size(hits))
    before = F.transform(gaps, lambda g: F.right(g, F.lit(60)))
    b = blocks.select(F.col(law).alias("citing_law"), F.col(block), F.col(name).alias("citing_article"),
                      F.posexplode(F.arrays_zip(before.alias("b"), hits.alias("w"))).alias("pos", "x"))
    b = b.withColumns({"context": F.col("x.w"), "signature": _signature("x.w"), "_before": F.col("x.b")})
    hit = b.join(index, "signature")
    first = hit.groupBy("citing_law", block, "citing_article", "target_id").agg(F.min_by(F.struct("context", "_before"), "pos").alias("x"))
    art = F.nullif(F.trim(F.regexp_extract("x._before", rules.NATIONAL_ARTICLE_BEFORE, 1)), F.lit(""))
    first = first.select("citing_law", block, "citing_article", F.col("target_id").alias("cited_law"), F.coalesce(art, F.lit("Todo")).alias("cited_article"),
                         F.lit("CITA").alias("relation_type"), F.col("x.context").alias("context"))
    return first.join(tagged.select("citing_law", block, "cited_law").distinct(), ["citing_law", block, "cited_law"], "left_anti")


def split_articles(df, keep, article="article_or_section"):
    """CIT9: 'arts 5, 8 y 12.3' to one row per article."""
    body = F.regexp_replace(article, r"(?iU)^\s*(?:articles?|artículos?|articulos?|arts?\.?)\s+", "")
    parts = F.filter(F.transform(F.split(body, r"(?iU)\s*,\s*|\s+(?:i|y|and)\s+"), lambda p: F.trim(p)), lambda p: p != "")
    return df.select(*keep, F.posexplode(parts).alias("part_no", "article"))
