"""Matching across corpora and between citations and the graph.

Lookups are reduced to one row per key before they are joined, so a key shared by a third
of either side stays an equi join on a unique key: no pairs are emitted, and AQE can split
the hot side.
"""

from functools import reduce

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import ids, text as tx
from lexloom.operators import cite, grams, nearest
from lexloom.operators.ordered import first_row, lookup_join, sorted_stream, split_row_number, top_k
from lexloom.session import cut, spread, stored


# ---- JON1: enrich ---------------------------------------------------------------------------
def enrich(base, extra, key="document_id"):
    """Full outer join; each field is the extra value when present, else the existing one."""
    shared = [c for c in base.columns if c in extra.columns and c != key]
    a, b = base.alias("a"), extra.alias("b")
    pick = lambda c: F.coalesce(tx.nonblank(f"b.{c}").cast(base.schema[c].dataType), F.col(f"a.{c}"))
    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(
        F.coalesce(f"a.{key}", f"b.{key}").alias(key), *[pick(c).alias(c) for c in shared],
        *[F.col(f"a.{c}") for c in base.columns if c not in shared and c != key],
        *[F.col(f"b.{c}") for c in extra.columns if c not in shared and c != key])


# ---- JON6 - JON8: cascades ---------------------------------------------------------------------
def lookup_table(df, ident, keys, ord_col="ingest_ord"):
    """(key_type, key) -> id, the last row in input order winning. Blank keys are dropped.

    ``keys`` is a list of (key type, expression, position); the position orders keys that
    one row contributes.
    """
    entries = F.array(*[F.struct(F.lit(t).alias("key_type"), e.cast("string").alias("key"), F.lit(n).alias("n")) for n, (t, e) in enumerate(keys)])
    rows = df.select(F.col(ident).alias("_id"), F.col(ord_col).alias("_o"), F.explode(entries).alias("k")).select("_id", "_o", "k.*")
    return (rows.filter(tx.nonblank("key").isNotNull()).groupBy("key_type", "key")
            .agg(F.max_by("_id", F.struct("_o", "n")).alias("matched_id")))


def cascade(df, row_id, lookup, attempts):
    """Try keys in order; the first that the lookup knows gives the match and its reason.

    ``attempts`` is a list of (reason, key type, expression). One join for all attempts.
    """
    tries = F.array(*[F.struct(F.lit(p).alias("priority"), F.lit(r).alias("match_reason"), F.lit(t).alias("key_type"), e.cast("string").alias("key"))
                      for p, (r, t, e) in enumerate(attempts)])
    rows = df.select(F.col(row_id), F.explode(tries).alias("k")).select(row_id, "k.*").filter(tx.nonblank("key").isNotNull())
    hit = rows.join(lookup, ["key_type", "key"]).groupBy(row_id).agg(F.min_by(F.struct("matched_id", "match_reason"), "priority").alias("m"))
    return df.join(hit, row_id, "left").select(*df.columns, F.col("m.matched_id").alias("matched_id"), F.col("m.match_reason").alias("match_reason"))


def title_date_key(title, date):
    key, date = tx.text_key(title), tx.nonblank(date)
    return F.when((key != "") & date.isNotNull(), F.concat_ws("\u0001", key, date))


def cascade_match(feed, records, publications):
    """JON7: record id, else any of the links, else title and date.

    Records are found by themselves and by their publications (record_id, pos, url_html,
    url_pdf, descripcio, data_publicacio; a blank date is the record's). The record whose key
    comes last in input order has it.
    """
    r = records.select("record_id", "ingest_ord", F.lit(-1).alias("n"), F.array(*[F.struct(F.lit(t).alias("key_type"), e.cast("string").alias("key")) for t, e in [
        ("id", F.col("record_id")), ("url", F.trim("url_record")), ("title_date", title_date_key("title", "date"))]]).alias("k"))
    p = publications.drop("ingest_ord").join(records.select("record_id", "ingest_ord", F.col("date").alias("_date")), "record_id")
    p = p.select("record_id", "ingest_ord", F.col("pos").alias("n"), F.array(*[F.struct(F.lit(t).alias("key_type"), e.alias("key")) for t, e in [
        ("url", F.trim("url_html")), ("url", F.trim("url_pdf")), ("title_date", title_date_key("descripcio", F.coalesce(tx.nonblank("data_publicacio"), "_date")))]]).alias("k"))
    rows = r.unionByName(p).select("record_id", "ingest_ord", "n", F.inline("k"))
    lookup = rows.filter(tx.nonblank("key").isNotNull()).groupBy("key_type", "key").agg(F.max_by("record_id", F.struct("ingest_ord", "n")).alias("matched_id"))
    title = F.coalesce(tx.nonblank("title"), F.col("record_title"))
    return cascade(feed, "id", lookup, [
        ("direct_id", "id", F.col("cido_id")), *[(f"url_match ({c})", "url", F.trim(c)) for c in ("link_to_text", "url_html", "url_pdf", "url_cido")],
        ("title_and_date_match", "title_date", title_date_key(title, "date"))])


def residual_match(feed, docs, already):
    """JON8: rows not matched before, by any link, then title and ISO date, then long title."""
    rest = feed.filter(~already)
    title = tx.text_key("title")
    lookup = lookup_table(docs, "document_id", [
        ("url", F.trim("html_url")), ("url", F.trim("pdf_url")), ("title_date", title_date_key("title", ids.iso_date("date_dogc"))),
        ("title", F.when(F.length(title) > 15, title))])
    return cascade(rest, "id", lookup, [
        *[(f"dogc_url_match ({c})", "url", F.trim(c)) for c in ("link_to_text", "url_html", "url_pdf")],
        ("dogc_title_and_date_match", "title_date", title_date_key("title", ids.iso_date("date"))),
        ("dogc_title_match", "title", F.when(F.length(title) > 20, title))])


def match_to_gazette(pubs, docs, title="record_title"):
    """JON6: the id in a gazette publication's link, else the document with the record's title (the last wins)."""
    by_title = docs.select(tx.title_key("title").alias("_key"), "document_id", "ingest_ord").filter("_key <> ''").groupBy("_key").agg(F.max_by("document_id", "ingest_ord").alias("_tid"))
    in_link = F.when(F.col("butlleti") == "DOGC", F.coalesce(ids.url_doc_id("url_pdf"), ids.url_doc_id("url_html")))
    df = pubs.withColumn("_uid", in_link).withColumn("_key", F.when(F.col("_uid").isNull(), tx.title_key(title)))
    df = lookup_join(df, by_title.withColumnRenamed("_key", "_tkey"), "_key", "_tkey").drop("_tkey").withColumn("dogc_document_id", F.coalesce("_uid", F.col("_tid").cast("string")))
    summary = docs.select(F.col("document_id").cast("string").alias("_did"), "ingest_ord", F.struct("document_id", "title", "date_dogc", "organisme").alias("matching_record"))
    summary = first_row(summary, ["_did"], ["ingest_ord"], last=True).drop("ingest_ord")
    df = lookup_join(df, summary, "dogc_document_id", "_did")
    kind = F.when(F.col("_uid").isNotNull(), "url_id").when(F.col("_tid").isNotNull(), "title")
    return df.withColumns({"appears_in_dogc": F.col("dogc_document_id").isNotNull(), "match_type": kind}).drop("_uid", "_key", "_tid", "_did")


# ---- containment of titles in texts ---------------------------------------------------------------
def first_strategy(parts, row_id):
    """Best match per row over (priority, frame) pairs."""
    u = reduce(lambda a, b: a.unionByName(b), [f.select(row_id, "matched_id", "matched_ord", F.lit(p).alias("strategy")) for p, f in parts])
    return u.groupBy(row_id).agg(F.min_by(F.struct("matched_id", "strategy"), F.struct("strategy", "matched_ord")).alias("m")).select(
        row_id, "m.matched_id", "m.strategy")


def holds(texts, titles, group, text, title, row_id, either=False):
    """For each text the first title (by order) of its group that it contains, character by character.

    Of equal titles in a group the first stands for all. With ``either``, a title that contains the text counts as well.
    """
    t = titles.select(*group, F.col(title).alias("_title"), F.col("document_id").alias("_id"), F.col("ord").alias("_o")).filter("_title <> ''")
    t = first_row(t, group + ["_title"], ["_o"]).withColumn("_nk", grams.key_of("_title"))
    pairs = grams.contained(texts, t, text, "_title", group, either)
    best = pairs.join(t.select(*group, "_nk", "_o", "_id"), group + ["_nk"]).groupBy(*group, "_tk").agg(F.min(F.struct("_o", "_id")).alias("m"))
    return texts.withColumn("_tk", grams.key_of(text)).join(best, group + ["_tk"]).select(row_id, F.col("m._id").alias("matched_id"), F.col("m._o").alias("matched_ord"))


def issue_match(targets, docs):
    """JON9: resolve publications inside their gazette issue by four strategies in turn.

    targets: target_id, issue, text, record_title, institucio. docs: issue, document_id,
    ord, title, organisme, cve, text (landed document text). Everything is by substring.
    """
    cve = lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(rules.CVE_CODE), F.lit(1))
    # the keys are made once, by all cores; everything below reads them
    t = stored(spread(targets, ["target_id"]).select("target_id", "issue", F.get(cve(F.col("text")), F.lit(0)).alias("_code"), tx.title_key("text").alias("_body"),
                                                     tx.title_key("record_title").alias("_rec"), tx.org_key("institucio").alias("_inst")), "targets")
    d = stored(spread(docs, ["document_id"]).select("issue", "document_id", "ord", F.array_distinct(F.concat(cve(F.col("title")), cve(F.col("cve")))).alias("_codes"), tx.title_key("title").alias("_name"),
                                                    tx.org_key("organisme").alias("_org"), tx.org_key("title").alias("_org_title"), tx.title_key("text").alias("_text")), "documents")
    g = ["issue"]
    s1 = holds(t, d.filter(F.length("_name") >= 15), g, "_body", "_name", "target_id")
    s2 = holds(t, d, g, "_rec", "_name", "target_id", either=True)
    codes = (d.select("issue", "document_id", "ord", F.explode("_codes").alias("_code"))
             .groupBy("issue", "_code").agg(F.min(F.struct("ord", "document_id")).alias("m")))
    s3 = (t.join(codes, ["issue", "_code"])
          .select("target_id", F.col("m.document_id").alias("matched_id"), F.col("m.ord").alias("matched_ord")))
    # organism either way, and a long word of the record's title in the document's text
    words = F.array_sort(F.array_distinct(F.filter(F.split("_rec", " "), lambda x: F.length(x) >= 5)))
    asked = t.filter("_inst <> ''").withColumn("_words", words).filter(F.size("_words") > 0)
    names = d.select("issue", "_org").distinct().withColumn("_tk", grams.key_of("_org"))
    wanted = asked.select("issue", "_inst").distinct().withColumn("_nk", grams.key_of("_inst"))
    org = grams.contained(names, wanted, "_org", "_inst", g, either=True).join(names, ["issue", "_tk"]).join(wanted, ["issue", "_nk"]).select("issue", "_inst", "_org")
    titled = grams.contained(d, wanted, "_org_title", "_inst", g).join(wanted, ["issue", "_nk"]).select("issue", "_inst", F.col("_tk").alias("_ok"))
    place = d.select("issue", "document_id", "ord", "_org", grams.key_of("_org_title").alias("_ok"), "_text").withColumn("_tk", grams.key_of("_text"))
    near = cut(org.join(place, ["issue", "_org"]).select("issue", "_inst", "document_id", "ord", "_tk").unionByName(
        titled.join(place, ["issue", "_ok"]).select("issue", "_inst", "document_id", "ord", "_tk")).distinct())
    # words that stand in a text, then those asked for by an institution that is near its document
    sought = asked.select("issue", "_inst", F.explode("_words").alias("_word")).distinct().withColumn("_nk", grams.key_of("_word"))
    inside = grams.contained(place.join(near.select("issue", "_tk").distinct(), ["issue", "_tk"], "left_semi"), sought, "_text", "_word", g)
    found = near.join(inside, ["issue", "_tk"]).join(sought, ["issue", "_inst", "_nk"])
    best = found.groupBy("issue", "_inst", "_word").agg(F.min(F.struct("ord", "document_id")).alias("m"))
    s4 = (asked.select("target_id", "issue", "_inst", F.explode("_words").alias("_word")).join(best, ["issue", "_inst", "_word"])
          .select("target_id", F.col("m.document_id").alias("matched_id"), F.col("m.ord").alias("matched_ord")))
    return first_strategy([(1, s1), (2, s2), (3, s3), (4, s4)], "target_id")


def title_in_issue(entries, docs):
    """JON10: equal (issue, title key), else containment either way inside the issue."""
    e = entries.select("entry_id", "issue", tx.squeeze(F.regexp_replace(F.lower("title"), r"[^a-z0-9à-üçï ]", "")).alias("_t"), tx.alnum_key("title").alias("_k"))
    d = docs.select("issue", "document_id", "ord", tx.squeeze(F.regexp_replace(F.lower("title"), r"[^a-z0-9à-üçï ]", "")).alias("_title"), tx.alnum_key("title").alias("_k"))
    last = d.groupBy("issue", "_k").agg(F.max_by(F.struct("document_id", "ord"), "ord").alias("m"))
    s1 = e.join(last, ["issue", "_k"]).select("entry_id", F.col("m.document_id").alias("matched_id"), F.col("m.ord").alias("matched_ord"))
    s2 = holds(e, d, ["issue"], "_t", "_title", "entry_id", either=True)
    return first_strategy([(1, s1), (2, s2)], "entry_id")


# ---- JON4 / JON5: editorial links to sections -------------------------------------------------------
def _number_variants(c):
    """All n/n strings that occur inside the n/n numbers of a text."""
    nums = F.array_distinct(F.regexp_extract_all(c, F.lit(f"({rules.REF_NUMBER})"), F.lit(1)))
    left, right = lambda n: F.split_part(n, F.lit("/"), F.lit(1)), lambda n: F.split_part(n, F.lit("/"), F.lit(2))
    return F.array_distinct(F.flatten(F.transform(nums, lambda n: F.flatten(F.transform(
        F.sequence(F.lit(1), F.length(left(n))), lambda i: F.transform(F.sequence(F.lit(1), F.length(right(n))), lambda k: F.concat(
            F.substring(left(n), i, F.length(n)), F.lit("/"), F.substring(right(n), F.lit(1), k))))))))


def _named_refs(c):
    """'type ref' strings of a text in every shorter reading of the reference."""
    rx = rf"(?iU)((?:{rules.longest_first(rules.DOC_REF_TYPES)})\s+[a-zA-Z0-9/\-.]+)"
    found = F.regexp_extract_all(c, F.lit(rx), F.lit(1))
    head = lambda r: F.length(F.regexp_extract(r, r"(?U)^(.*\s)", 1))
    return F.array_distinct(F.flatten(F.transform(found, lambda r: F.transform(F.sequence(head(r) + 1, F.length(r)), lambda k: F.substring(r, F.lit(1), k)))))


SECTION_WEIGHTS = {"title": 40, "heading": 30, "text": 15, "article": 15}  # fixed values


ASKED = 256  # distinct tokens of a document that its sections are handed, at most


def section_tokens(sections, want, key="document_id", no="section_no", weights=SECTION_WEIGHTS, most=ASKED):
    """(document, section, token, weight): what editorial links find in a section.

    want: doc, token. Number tokens weigh 40 in the title, 30 in the heading, 15 in the text;
    whole-number tokens, which cited articles look for, weigh 15 anywhere. Only sections of
    documents that some link acts from are read, once, and references without a number are
    looked up only where a link has one. A section is handed the tokens that are looked for in
    its document and keeps those it has; with more than ``most`` of them it keeps all it has.
    """
    bare = F.col("token").startswith("R:") & ~F.col("token").rlike(rules.REF_NUMBER)
    want = want.select("doc", "token").distinct()
    sizes = want.groupBy("doc").agg(F.count(F.lit(1)).alias("_n"), F.max(bare).alias("_bare"))
    asked = want.join(sizes.filter(F.col("_n") <= most).select("doc"), "doc", "left_semi").groupBy("doc").agg(
        F.collect_list("token").alias("_asked"), F.collect_list(F.when(F.col("token").startswith("R:"), F.expr("substring(token, 3)"))).alias("_refs"))
    asked = sizes.select("doc", "_bare").join(asked, "doc", "left")
    s = sections.select(F.col(key).alias("doc"), F.col(no).alias("section_no"), *[F.lower(tx.or_empty(c)).alias(c) for c in ("title", "heading", "text")]).join(asked, "doc")
    places = [(c, weights[c]) for c in ("title", "heading", "text")]
    found = F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", "heading", "text", "title"), F.lit(r"(?U)\b(\d+)\b"), F.lit(1)))
    named = F.concat(*[F.transform(_named_refs(F.col(c)), _weigh("R:", w)) for c, w in places])
    # the readings of a place's numbers are made only where a reference that is looked for may stand
    there = lambda c: F.col("_asked").isNull() | F.exists("_refs", lambda r: F.contains(F.col(c), r))
    variants = lambda c: F.when(there(c), _number_variants(F.col(c))).otherwise(F.array().cast("array<string>"))
    entries = F.concat(*[F.transform(variants(c), _weigh("R:", w)) for c, w in places], F.transform(found, _weigh("D:", weights["article"])),
                       F.when(F.col("_bare"), named).otherwise(F.array().cast("array<struct<token:string,w:int>>")))
    kept = F.filter(entries, lambda x: F.col("_asked").isNull() | F.array_contains("_asked", x["token"]))
    df = s.select("doc", "section_no", F.explode(kept).alias("x"))
    # title beats heading beats text: the best place counts once
    return df.groupBy("doc", "section_no", F.col("x.token").alias("token")).agg(F.max("x.w").alias("w"))


def _weigh(prefix, w):
    return lambda t: F.struct(F.concat(F.lit(prefix), t).alias("token"), F.lit(w).alias("w"))


def best_source_section(affs, sections, key="document_id", no="section_no", weights=SECTION_WEIGHTS, penalised=rules.PENALISED_TITLES, keep=True):
    """JON4: highest-scoring section of each acting document, where the score reaches 10.

    Sections without any hit score at most 0, so only token hits are joined. Links with the
    same acting document, reference and articles share one scoring. Ties go to the earlier
    section; a preamble-like title costs 10.

    affs: aff_id, acting_doc, doc_ref, affected (array). They are read several times, and written once for it where
    ``keep`` doesn't say that they are cheap to read.
    """
    ref = F.lower(tx.or_empty("doc_ref"))
    num = F.regexp_extract(ref, rules.REF_NUMBER, 0)
    a = affs.select("aff_id", "acting_doc", F.when(num != "", num).otherwise(ref).alias("_ref"), F.array_sort("affected").alias("_arts"))
    a = stored(a, "scored") if keep else a
    a = a.withColumn("sig", F.unhex(F.md5(F.concat_ws("\u0001", F.col("acting_doc").cast("string"), "_ref", F.array_join("_arts", "\u0002")))))
    sigs = a.groupBy("sig").agg(F.first("acting_doc").alias("doc"), F.first("_ref").alias("_ref"), F.first("_arts").alias("_arts"))
    wanted = F.concat(F.when(F.col("_ref") != "", F.array(F.concat(F.lit("R:"), "_ref"))).otherwise(F.array().cast("array<string>")),
                      F.transform(F.filter(F.transform("_arts", lambda x: F.regexp_replace(x, r"[^\p{Nd}]", "")), lambda x: x != ""), lambda x: F.concat(F.lit("D:"), x)))
    want = sigs.select("sig", "doc", F.explode(wanted).alias("token")).groupBy("sig", "doc", "token").agg(F.count(F.lit(1)).alias("times"))
    hits = want.join(section_tokens(sections, want, key, no, weights), ["doc", "token"])
    score = F.sum(F.col("w") * F.when(F.col("token").startswith("D:"), F.col("times")).otherwise(1))
    scored = hits.groupBy("sig", "doc", "section_no").agg(score.alias("score"))
    title = F.lower(tx.or_empty("title"))
    low = sections.select(F.col(key).alias("doc"), F.col(no).alias("section_no"), F.when(cite._any_word(title, list(penalised)), 10).otherwise(0).alias("cost"))
    scored = scored.join(low.filter("cost > 0"), ["doc", "section_no"], "left").withColumn("score", F.col("score") - F.coalesce("cost", F.lit(0)))
    best = scored.groupBy("sig").agg(F.max(F.struct(F.col("score"), (-F.col("section_no")).alias("n"))).alias("m")).filter("m.score >= 10")
    return a.select("aff_id", "sig").join(best, "sig").select("aff_id", (-F.col("m.n")).alias("section_no"), F.col("m.score").alias("score"))


def affectation_edges(affs, docs, sections, key="document_id", no="section_no"):
    """JON5: one edge per affected section (or one to the document when none is named).

    ``affs`` has document_id, ord, direction, target_document_id, text. An active link acts
    from its own document; a passive one from the target, under the own document's number.
    """
    a = cite.classify_affectations(affs).withColumn("aff_id", F.concat_ws(":", F.col(key).cast("string"), "direction", F.col("ord").cast("string")))
    own = docs.select(F.col(key).alias("_own"), tx.first_nonblank("document_number", "title").alias("_own_ref"))
    active = F.col("direction") == "active"
    a = a.join(own, F.col(key) == F.col("_own"), "left").select(
        "aff_id", F.when(active, F.col(key)).otherwise(F.col("target_document_id")).alias("acting_doc"),
        F.when(active, F.col("target_document_id")).otherwise(F.col(key)).alias("affected_doc"),
        F.when(active, F.col("doc_ref")).otherwise(F.col("_own_ref")).alias("doc_ref"), "affected", "edge_type", "action", "direction", "text")
    # each is read several times below
    a = stored(a, "links")
    best = best_source_section(a, sections, key, no, keep=False)
    a = stored(a.join(best.select("aff_id", "section_no"), "aff_id", "left"), "sources")
    src = sections.select(F.col(key).alias("acting_doc"), F.col(no).alias("section_no"), F.concat_ws("\n", tx.or_empty("heading"), tx.or_empty("text")).alias("_source"))
    scan_rows = a.filter(F.col("section_no").isNotNull()).select("aff_id", "acting_doc", "section_no", "doc_ref").join(src, ["acting_doc", "section_no"])
    named = cite.affected_from_source(scan_rows, ["aff_id"], "_source").unionByName(a.select("aff_id", F.explode("affected").alias("affected"))).distinct()
    e = a.drop("affected").join(named, "aff_id", "left").withColumn("affected", F.coalesce("affected", F.lit("")))
    e = cite.match_section(e, sections, "affected_doc", "affected", key, "title", no)
    hit = F.col("target_section").isNotNull() & (F.col("affected") != "")
    return e.select("aff_id", "direction", "action", F.col("edge_type").alias("type"), "acting_doc", F.col("section_no").alias("source_section"),
                    "affected_doc", F.when(hit, F.col("target_section")).alias("target_section"), F.col("affected").alias("mapped_section"), "text")


# ---- JON11 / JON12: hierarchy ---------------------------------------------------------------------
def hierarchy_documents(docs, pubs, section_edges):
    """JON11: gazette and local documents with section counts and parent records.

    Lists stay long: ``document_sections`` and ``document_parents`` hold one row per member,
    so a document with millions of members never becomes one value.
    """
    n_secs = section_edges.groupBy(F.col("document_id").cast("string").alias("_doc")).agg(F.count(F.lit(1)).alias("n_sections"))
    parents = document_parents(pubs).groupBy(F.col("document_id").alias("_doc2")).agg(F.count(F.lit(1)).alias("n_parents"), F.min("record_id").alias("_one"))
    g = (docs.withColumn("id", F.col("document_id").cast("string")).join(n_secs, F.col("id") == F.col("_doc"), "left")
         .join(parents, F.col("id") == F.col("_doc2"), "left"))
    g = g.select("id", "title", F.col("date_dogc").alias("date"), "dogc_number", tx.link_to_text("html_url", "pdf_url").alias("link_to_text"), F.lit("DOGC").alias("bulletin"),
                 F.coalesce("n_sections", F.lit(0)).alias("n_sections"), F.coalesce("n_parents", F.lit(0)).alias("n_parents"),
                 F.when(F.col("n_parents") == 1, F.col("_one")).alias("parent_record_id"))
    loc = pubs.filter(F.col("dogc_document_id").isNull()).select(
        F.concat(F.lit("cido_"), F.col("record_id").cast("string"), F.lit("_doc_"), F.col("pos").cast("string")).alias("id"),
        F.coalesce(tx.first_nonblank("descripcio", "record_title"), F.lit("Document")).alias("title"), "date", F.col("bulletin_number").alias("dogc_number"),
        tx.link_to_text("url_html", "url_pdf").alias("link_to_text"), F.coalesce(tx.nonblank("butlleti"), F.lit("CIDO")).alias("bulletin"),
        F.lit(0).cast("long").alias("n_sections"), F.lit(1).cast("long").alias("n_parents"), F.col("record_id").alias("parent_record_id"))
    return g.unionByName(loc)


def document_parents(pubs):
    """Distinct (gazette document, record) pairs."""
    return pubs.filter(F.col("dogc_document_id").isNotNull()).select(F.col("dogc_document_id").alias("document_id"), "record_id").distinct()


def record_documents(pubs):
    """Documents of each record in order, each document once at its first position."""
    ident = F.coalesce("dogc_document_id", F.concat(F.lit("cido_"), F.col("record_id").cast("string"), F.lit("_doc_"), F.col("pos").cast("string")))
    return pubs.select("record_id", ident.alias("document_id"), "pos").groupBy("record_id", "document_id").agg(F.min("pos").alias("pos"))


def enrich_subset(units, pubs, section_edges):
    """JON12: node id of each unit with the sizes of its sibling and section lists."""
    sib = record_documents(pubs).groupBy("record_id").agg(F.count(F.lit(1)).alias("n_documents"))
    secs = section_edges.groupBy(F.col("document_id").cast("string").alias("_doc")).agg(F.count(F.lit(1)).alias("n_sections"))
    node = F.coalesce("dogc_document_id", F.concat(F.lit("cido_"), F.col("record_id").cast("string"), F.lit("_doc_"), F.col("pos").cast("string")))
    df = units.withColumn("document_node_id", node).join(sib, "record_id", "left").join(secs, F.col("document_node_id") == F.col("_doc"), "left")
    return df.select(*units.columns, "document_node_id", F.coalesce("n_documents", F.lit(0)).alias("n_documents"), F.coalesce("n_sections", F.lit(0)).alias("n_sections"))


# ---- JON13 - JON15: graph lookups -------------------------------------------------------------------
def parent_document(nodes, edges, catalogue=None):
    """JON13: top-level document of every node, however many structural steps up.

    Steps are doubled each round until nobody's goal has a parent left. A path has at most as
    many steps as there are nodes with a parent, which also ends the rounds on a cycle; its
    nodes fall back like nodes without a parent.
    """
    is_doc = nodes.filter(F.col("label").isin(rules.DOCUMENT_LABELS)).select(F.col("id").alias("_doc")).distinct()
    up = edges.filter(F.col("type").isin(rules.PARENT_TYPES)).groupBy(F.col("dst").alias("_child")).agg(F.min("src").alias("_at"))
    up = stored(up.join(is_doc, F.col("_child") == F.col("_doc"), "left_anti"), "parents")
    rest, steps = up.count(), 1
    while steps < rest:
        ahead = up.select(F.col("_child").alias("_via"), F.col("_at").alias("_beyond"))
        moved = stored(up.join(ahead, F.col("_at") == F.col("_via"), "left").select("_child", "_at", "_beyond"), "parents")
        if moved.filter("_beyond IS NOT NULL").isEmpty():
            break
        up, steps = moved.select("_child", F.coalesce("_beyond", "_at").alias("_at")), steps * 2
    goal = up.join(is_doc, F.col("_at") == F.col("_doc"), "left_semi").select("_child", "_at").unionByName(is_doc.select(F.col("_doc").alias("_child"), F.col("_doc").alias("_at")))
    df = nodes.select("id").join(goal, F.col("id") == F.col("_child"), "left")
    fallback = F.col("id")
    if catalogue is not None:
        cat = catalogue.groupBy(F.col("id").alias("_cid")).agg(F.min("document_id").alias("_cdoc"))
        df, fallback = df.join(cat, F.col("id") == F.col("_cid"), "left"), F.coalesce("_cdoc", "id")
    return df.select("id", F.coalesce("_at", fallback).alias("parent_id"))


def list_citations(nodes, edges, ord_cols=("dst", "type"), total=None):
    """JON14: outgoing citations with target attributes, numbered per source.

    ``total`` names a column for the number of citations of the source, counted before the
    attributes are looked up; citations without a source have none and are left out then.
    """
    e = edges.filter(F.col("type").isin(rules.CITATION_TYPES)).select("src", "dst", "type")
    bucket = F.pmod(F.xxhash64("dst"), F.lit(1 << 20))
    e = split_row_number(e.withColumn("_b", bucket), ["src"], [F.col("_b")], ["_b", *ord_cols], "citation_no").drop("_b")
    more = [] if total is None else [total]
    if more:
        e = e.join(edges.filter(F.col("type").isin(rules.CITATION_TYPES)).groupBy("src").agg(F.count(F.lit(1)).alias(total)), "src")
    t = nodes.select(F.col("id").alias("dst"), "title", "document_number", "dogc_number")
    return e.join(t, "dst", "left").select("src", "citation_no", "type", "dst", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "document_number", "dogc_number")], *more)


def edges_between(pairs, edges):
    """JON15: citation edges of given (source, target) pairs."""
    return edges.filter(F.col("type").isin(rules.CITATION_TYPES)).join(pairs.select("src", "dst").distinct(), ["src", "dst"], "left_semi")


# ---- JON16 / JON17: candidates ------------------------------------------------------------------------
def _title_words(c):
    return F.array_except(F.array_distinct(F.filter(F.split(tx.entity_key(c), " "), lambda w: w.rlike(r"^[a-zà-ü]{4,}$"))), F.array(*[F.lit(w) for w in rules.CANDIDATE_STOPWORDS]))


def candidate_targets(texts, docs, k=15, text="text", row_id="text_id"):
    """JON16: best documents for a text by numbers, gazette numbers and title words.

    A candidate's document number, gazette number or title is in the text; shared title words
    and years only score. So a document is found or not whatever else the corpus holds.
    A number of another form than n/yyyy counts as a run of letters, digits and marks, a
    gazette number as a run of digits. Documents that agree on everything scored collapse to a
    profile and return as its first ``k`` members, and profiles that agree on a key and on
    what scores stand behind the first ``k`` of them; texts that agree on a key and on the
    tokens that can score behind it share one scoring.
    """
    d = docs.select("document_id", "ingest_ord", F.lower(tx.or_empty("document_number")).alias("num"), F.lower(tx.or_empty("dogc_number")).alias("gaz"),
                    tx.entity_key("title").alias("ttl"), F.substring(tx.or_empty("date_dogc"), -4, 4).alias("yr"))
    prof = d.select("num", "gaz", "ttl", "yr", "document_id", "ingest_ord").withColumn("pid", F.xxhash64("num", "gaz", "ttl", "yr"))
    members = top_k(prof.select("pid", "document_id", "ingest_ord"), ["pid"], ["ingest_ord"], k, "member")
    p = prof.groupBy("pid", "num", "gaz", "ttl", "yr").agg(F.min("ingest_ord").alias("first_ord")).withColumn("tw", _title_words(F.col("ttl")))
    plain = F.col("num").rlike(rules.PLAIN_NUMBER)
    tokens = F.array_compact(F.array(F.when((F.col("num") != "") & plain, F.concat(F.lit("n:"), "num")), F.when((F.col("num") != "") & ~plain, F.concat(F.lit("N:"), "num")),
                                     F.when(F.col("gaz") != "", F.concat(F.lit("g:"), "gaz")), F.when(F.col("ttl") != "", F.concat(F.lit("t:"), "ttl"))))
    index = p.select("pid", "num", "gaz", "ttl", "yr", "first_ord", "tw", F.explode(tokens).alias("tok"))
    # behind a token, profiles alike in all that can score are interchangeable but for their order
    index = top_k(index, ["tok", "num", "gaz", "yr", "tw", "ttl"], ["first_ord"], k, "_m").select("tok", "pid", "num", "gaz", "yr", "tw", "ttl", "first_ord")
    lower = F.lower(text)
    every = lambda pattern: F.regexp_extract_all(lower, F.lit(pattern), F.lit(1))
    tag = lambda a, pre: F.transform(a, lambda x: F.concat(F.lit(pre), x))
    marked = F.flatten(F.transform(every(rules.MARKED_NUMBER), lambda x: F.array(x, F.regexp_replace(x, r"(?U)^\W+|\W+$", ""))))
    # one token for each title that stands in the text
    names, norm = p.select("ttl").filter("ttl <> ''").distinct().withColumn("_nk", grams.key_of("ttl")), texts.select(row_id, tx.entity_key(text).alias("_norm"))
    held = grams.contained(norm, names, "_norm", "ttl").join(names, "_nk").join(norm.withColumn("_tk", grams.key_of("_norm")), "_tk").select(row_id, F.col("ttl").alias("_title"))
    held = held.groupBy(row_id).agg(F.collect_set(F.concat(F.lit("t:"), "_title")).alias("_held"))
    texts = texts.join(held, row_id, "left").withColumn("_held", F.coalesce("_held", F.array().cast("array<string>")))
    toks = F.array_sort(F.array_distinct(F.concat(
        F.col("_held"), tag(every(rules.TEXT_NUMBER), "n:"), tag(marked, "N:"), tag(every(rules.DIGITS), "g:"), tag(every(rules.NAMED_GAZETTE), "G:"), tag(every(rules.TEXT_YEAR), "y:"),
        tag(F.filter(F.split(tx.entity_key(text), " "), lambda w: w.rlike(r"^[a-zà-ü]{4,}$")), "w:"))))
    tt = stored(texts.select(row_id, toks.alias("toks")).withColumn("sig", F.xxhash64("toks")), "tokens")
    sigs = stored(tt.groupBy("sig").agg(F.first("toks").alias("toks")), "texts")
    index, asks = _asked(sigs, index)
    questions = stored(asks.groupBy("ask").agg(F.first("toks").alias("toks")).withColumnRenamed("ask", "sig"), "questions")
    full = candidate_pairs(questions, index, k).join(questions, "sig").join(p, "pid")
    has = lambda pre, c: F.array_contains("toks", F.concat(F.lit(pre), c))
    shared = F.size(F.array_intersect(F.transform("tw", lambda w: F.concat(F.lit("w:"), w)), F.col("toks")))
    number = F.when((F.col("num") != "") & plain & has("n:", F.col("num")), 100).when((F.col("num") != "") & ~plain & has("N:", F.col("num")), 80).otherwise(0)
    gazette = F.when(F.col("gaz") == "", 0).when(has("G:", F.col("gaz")), 90).when(has("g:", F.col("gaz")), 60).otherwise(0)
    score = number + gazette + shared * 5 + F.when(has("t:", F.col("ttl")), 50).otherwise(0) + F.when((F.col("yr") != "") & has("y:", F.col("yr")), 5).otherwise(0)
    full = full.select(F.col("sig").alias("ask"), "pid", "first_ord", score.alias("score"))
    best = top_k(full, ["ask"], [F.col("score").desc(), "first_ord"], k, "_r").drop("_r")
    best = top_k(best.join(members, "pid"), ["ask"], [F.col("score").desc(), "ingest_ord"], k, "_r")
    # in the order of a struct: higher scores first, then the earlier document
    found = best.groupBy("ask").agg(F.collect_list(F.struct((-F.col("score")).alias("less"), "ingest_ord", "document_id", "pid", "member")).alias("found"))
    mine = asks.select("sig", "ask").join(found, "ask").groupBy("sig").agg(F.flatten(F.collect_list("found")).alias("found"))
    mine = mine.select("sig", F.slice(F.array_sort(F.array_distinct("found")), 1, k).alias("found"))
    rows = tt.select(row_id, "sig").join(mine, "sig").select(row_id, F.posexplode("found").alias("_at", "x"))
    return rows.select(row_id, (F.col("_at") + 1).alias("rank"), F.col("x.document_id").alias("document_id"), (-F.col("x.less")).alias("score"))


def _features():
    """What can add to a profile's score: its words, year, gazette, title and number, as a text's tokens name them."""
    pre = lambda p, c: F.when(F.col(c) != "", F.concat(F.lit(p), c))
    return F.concat(F.transform("tw", lambda w: F.concat(F.lit("w:"), w)), F.array_compact(F.array(pre("y:", "yr"), pre("g:", "gaz"), pre("G:", "gaz"), pre("t:", "ttl"), pre("n:", "num"), pre("N:", "num"))))


def _asked(sigs, index):
    """The index of the tokens that texts have, and (sig, ask, toks): what each text asks of each.

    Behind a token a text's other tokens count only if some profile there has them as features. A question is the token
    with those, so texts that ask the same are scored once, whatever else they hold.
    """
    post = sigs.select("sig", F.explode("toks").alias("tok"))
    index = stored(index.join(post.select("tok").distinct(), "tok", "left_semi"), "index")
    features = index.select("tok", F.explode(_features()).alias("feature")).distinct()
    features = stored(features.join(post.select(F.col("tok").alias("feature")).distinct(), "feature", "left_semi"), "features")
    known = features.groupBy(F.col("feature").alias("tok")).agg(F.max(F.col("tok") == F.col("feature")).alias("_looked"))
    held = post.join(known, "tok").groupBy("sig").agg(F.collect_list("tok").alias("toks"), F.collect_list(F.when(F.col("_looked"), F.col("tok"))).alias("looked"))
    asks = held.select("sig", "toks", F.explode("looked").alias("tok")).select("sig", "tok", F.explode("toks").alias("feature"))
    asks = asks.join(features, ["tok", "feature"]).groupBy("sig", "tok").agg(F.sort_array(F.collect_list("feature")).alias("toks"))
    return index, stored(asks.select("sig", F.xxhash64("tok", "toks").alias("ask"), "toks"), "asks")


HOT_TOKEN = 1000  # profiles behind a token, and behind a token and a feature, that are read whole


def candidate_pairs(sigs, index, k, hot=HOT_TOKEN):
    """(sig, pid): every profile that can be among a text's k best, without reading a hot token's profiles.

    sigs: sig, toks. index: tok, pid, num, gaz, yr, tw, ttl, first_ord. A token with at most ``hot`` profiles is read
    whole. Behind another, what can add to a profile's score are its features. The profiles with a rare feature of
    the text (at most ``hot`` have it) are read; any other scores by its common features alone, and so does no better
    than the first k that have the same ones, which are read too.
    """
    post = sigs.select("sig", F.explode("toks").alias("tok")).filter(~F.substring("tok", 1, 2).isin("w:", "y:", "G:"))
    many = cut(index.groupBy("tok").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot).select("tok"))
    cold = post.join(index.join(many, "tok", "left_anti").select("tok", "pid"), "tok")
    held = index.join(many, "tok", "left_semi").select("tok", "pid", "first_ord", F.explode(F.filter(_features(), lambda x: x != F.col("tok"))).alias("feature"))
    often = held.groupBy("tok", "feature").agg(F.count(F.lit(1)).alias("_n"))
    held = cut(held.join(often, ["tok", "feature"]))
    rare = held.filter(F.col("_n") <= hot).select("tok", "feature", "pid")
    common = held.groupBy("tok", "pid", "first_ord").agg(F.sort_array(F.collect_list(F.when(F.col("_n") > hot, F.col("feature")))).alias("common"))
    # a profile behind a hot token without any feature stands with those that have no common one
    bare = index.join(many, "tok", "left_semi").select("tok", "pid", "first_ord").join(held.select("tok", "pid").distinct(), ["tok", "pid"], "left_anti")
    heads = top_k(common.unionByName(bare.withColumn("common", F.array().cast("array<string>"))), ["tok", "common"], ["first_ord"], k, "_m").select("tok", "pid")
    asked = post.join(many, "tok", "left_semi")
    by_feature = asked.join(sigs, "sig").select("sig", "tok", F.explode("toks").alias("feature")).join(rare, ["tok", "feature"])
    return cold.select("sig", "pid").unionByName(asked.join(heads, "tok").select("sig", "pid")).unionByName(by_feature.select("sig", "pid")).distinct()


def candidates_for_items(items, docs, k=10, keys=("source_id", "item_no")):
    """JON17: best documents for structured citations.

    A candidate carries the cited number (100 as its own number, 80 in its title) or gazette
    number (90); the cited type adds 30. The cited year filters when any document has it.
    Items with equal fields share one scoring; documents equal in everything scored are
    represented by their first ``k`` members, which are all that can be picked. In a cited
    gazette the number tells only the documents that carry it, which are looked up by both.
    """
    title = F.lower(tx.or_empty("title"))
    d = docs.select("document_id", "ingest_ord", F.lower(tx.or_empty("document_number")).alias("num"), F.lower(tx.or_empty("dogc_number")).alias("gaz"), F.lower(tx.or_empty("type")).alias("typ"),
                    F.array_sort(F.array_distinct(F.regexp_extract_all(F.concat_ws(" ", tx.or_empty("date_dogc"), title, tx.or_empty("document_number")), F.lit(r"(\d{4})"), F.lit(1)))).alias("yrs"),
                    F.regexp_extract_all(title, F.lit(f"({rules.REF_NUMBER})"), F.lit(1)).alias("_in_title"))
    known = d.select(F.explode("yrs").alias("q_year")).distinct()
    q = lambda c: F.trim(tx.or_empty(c))
    i = items.select(*keys, F.lower(q("document_number")).alias("q_num"), F.lower(q("dogc_number")).alias("q_gaz"), F.lower(q("doc_type")).alias("q_typ"), q("year").alias("q_year"))
    i = i.join(known.withColumn("_k", F.lit(True)), "q_year", "left").withColumn("q_year", F.when(F.col("_k"), F.col("q_year")).otherwise("")).drop("_k")
    sig_cols = ["q_num", "q_gaz", "q_typ", "q_year"]
    sigs = cut(i.select(*sig_cols).distinct())
    both = F.concat(F.transform(F.array("num"), lambda n: F.struct(n.alias("key"), F.lit(100).alias("pts"))), F.transform("_in_title", lambda n: F.struct(n.alias("key"), F.lit(80).alias("pts"))))
    nums = d.select("document_id", "ingest_ord", "num", "gaz", "typ", "yrs", F.explode(both).alias("x")).filter("x.key <> ''")
    nums = nums.groupBy("document_id", "ingest_ord", "gaz", "typ", "yrs", F.col("x.key").alias("key")).agg(F.max("x.pts").alias("pts"))
    by_num = top_k(nums, ["key", "pts", "typ", "yrs"], ["ingest_ord"], k, "_m")
    by_both = top_k(nums.filter("gaz <> ''"), ["gaz", "key", "pts", "typ", "yrs"], ["ingest_ord"], k, "_m")
    by_gaz = top_k(d.filter("gaz <> ''").distinct(), ["gaz", "typ", "yrs"], ["ingest_ord"], k, "_m")
    typed = lambda: F.when((F.col("q_typ") != "") & F.col("typ").contains(F.col("q_typ")), 30).otherwise(0)
    gaz_pts = lambda: F.when((F.col("q_gaz") != "") & (F.col("q_gaz") == F.col("gaz")), 90).otherwise(0)
    num_pts = F.when((F.col("q_num") != "") & (F.col("q_num") == F.col("num")), 100).when((F.col("q_num") != "") & F.array_contains("_in_title", F.col("q_num")), 80).otherwise(0)
    in_year = (F.col("q_year") == "") | F.array_contains("yrs", F.col("q_year"))
    # by number the gazette plays no part, so far fewer distinct questions are ranked
    short = ["q_num", "q_typ", "q_year"]
    a = sigs.filter("q_num <> ''").select(*short).distinct().join(by_num, F.col("q_num") == F.col("key")).filter(in_year)
    a = top_k(a.select(*short, "document_id", "ingest_ord", "gaz", (F.col("pts") + typed()).alias("base")), short, [F.col("base").desc(), "ingest_ord"], k, "_m")
    a = sigs.join(a, short).select(*sig_cols, "document_id", "ingest_ord", (F.col("base") + gaz_pts()).alias("score"))
    in_gaz = sigs.filter("q_gaz <> ''")
    # nor the number in a gazette: what stands first without it are the only ones that can be picked for lack of it
    issue = ["q_gaz", "q_typ", "q_year"]
    b = in_gaz.select(*issue).distinct().join(by_gaz, F.col("q_gaz") == F.col("gaz")).filter(in_year)
    b = top_k(b.select(*issue, "document_id", "ingest_ord", "gaz", "num", "_in_title", typed().alias("base")), issue, [F.col("base").desc(), "ingest_ord"], k, "_m")
    b = in_gaz.join(b, issue).select(*sig_cols, "document_id", "ingest_ord", (num_pts + gaz_pts() + F.col("base")).alias("score"))
    c = in_gaz.filter("q_num <> ''").join(by_both, (F.col("q_gaz") == F.col("gaz")) & (F.col("q_num") == F.col("key"))).filter(in_year)
    b = b.unionByName(c.select(*sig_cols, "document_id", "ingest_ord", (F.col("pts") + gaz_pts() + typed()).alias("score")))
    best = top_k(a.unionByName(b).repartition(*sig_cols).distinct(), sig_cols, [F.col("score").desc(), "ingest_ord"], k).select(*sig_cols, "rank", "document_id", "score")
    return i.join(best, sig_cols).select(*keys, "rank", "document_id", "score")


def candidate_sections(cands, items, sections, limit=25, keys=("source_id", "item_no")):
    """JON17, second part: sections of the candidates, the precisely cited article first."""
    s = sections.select("document_id", F.col("ord").alias("section_ord"), "section_id", tx.section_words("title").alias("_w"))
    want = items.select(*keys, tx.section_words("article_or_section").alias("_want"))
    c = cands.join(want, list(keys)).join(s, "document_id")
    precise = (F.col("_want") != "") & F.startswith("_w", F.col("_want"))
    c = c.withColumn("is_precise", precise)
    return top_k(c, list(keys), [F.col("is_precise").desc(), "rank", "section_ord"], limit, "section_rank").select(*keys, "section_rank", "document_id", "section_id", "is_precise")


def shared(items, cols, keys, found):
    """Rows of ``found`` for each item with the same text in ``cols`` (NULL reads as empty), for items with all ``keys``.

    ``found`` maps the distinct texts, one row each, to rows with ``cols``; equal citations are
    looked up once however many items make them.
    """
    named = items.select(*keys, *[tx.or_empty(c).alias(c) for c in cols]).dropna(subset=list(keys))
    out = found(named.select(*cols).distinct())
    return named.join(out, list(cols)).select(*keys, *[c for c in out.columns if c not in cols])


# ---- JON18 / JON19: entities -----------------------------------------------------------------------------
def resolve_entities(items, docs, keys=("source_id", "item_no")):
    """JON18: identifier path, number, title, gazette number, then a title that contains the cited one or lies in it.

    Containment is by characters and for cited titles of more than ten. The title that comes first wins; of documents
    with one title, the last.
    """
    it = items.withColumn("_row", F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))
    title = tx.entity_key(tx.clean_cited_title("cited_title"))
    lookup = lookup_table(docs, "document_id", [("eli", tx.eli_key("eli_uri")), ("number", tx.entity_key("document_number")), ("title", tx.entity_key("title")), ("gazette", tx.entity_key("dogc_number"))])
    out = cascade(it, "_row", lookup, [("eli", "eli", tx.eli_key("eli_uri")), ("number", "number", tx.entity_key("document_number")),
                                       ("title", "title", title), ("gazette", "gazette", tx.entity_key("dogc_number"))])
    rest = out.filter(F.col("matched_id").isNull()).select("_row", title.alias("_t")).filter(F.length("_t") > 10)
    d = docs.select(tx.entity_key("title").alias("_title"), "document_id", "ingest_ord").filter("_title <> ''")
    d = d.groupBy("_title").agg(F.min("ingest_ord").alias("ord"), F.max_by("document_id", "ingest_ord").alias("document_id"))
    s = holds(rest, d, [], "_t", "_title", "_row", either=True)
    out = out.join(s.select("_row", F.col("matched_id").alias("_sub")), "_row", "left")
    return out.select(*keys, F.coalesce("matched_id", "_sub").alias("document_id"),
                      F.when(F.col("matched_id").isNotNull(), F.col("match_reason")).when(F.col("_sub").isNotNull(), "substring").alias("match_reason"))


def match_section_prefix(items, sections, keys=("source_id", "item_no"), titles=("title", "heading")):
    """JON19: section whose title equals the cited words, else one that is a prefix of them.

    Prefixes of the cited words become join keys; the exact reading wins, then the earlier
    section.
    """
    # one row per name: the first section that has it, and the first that has it as an article's title
    named = F.array(*[F.struct(tx.section_words(c).alias("_w"), F.lit(n == 0).alias("_titled")) for n, c in enumerate(titles)])
    place = F.struct("ord", "section_id")
    names = (sections.select("document_id", "ord", "section_id", F.inline(named)).filter("_w <> ''")
             .groupBy("document_id", "_w").agg(F.min(place).alias("exact"), F.min(F.when(F.col("_titled") & F.col("_w").startswith("art "), place)).alias("head")))
    i = items.select(*keys, "document_id", F.split(tx.section_words("article_or_section"), " ").alias("_words"))
    n = F.size("_words")
    tries = F.transform(F.sequence(F.lit(1), n), lambda j: F.struct((j == n).alias("whole"), F.array_join(F.slice("_words", F.lit(1), j), " ").alias("w")))
    t = i.select(*keys, "document_id", F.explode(tries).alias("x")).select(*keys, "document_id", F.col("x.whole").alias("whole"), F.col("x.w").alias("_w")).filter("_w <> ''")
    hit = t.join(names, ["document_id", "_w"]).select(*keys, "whole", F.when(F.col("whole"), F.col("exact")).otherwise(F.col("head")).alias("m"))
    best = hit.filter("m IS NOT NULL").groupBy(*keys).agg(F.min_by("m", F.struct(~F.col("whole"), F.col("m.ord"))).alias("m"))
    return items.select(*keys, "document_id").join(best, list(keys), "left").select(*keys, "document_id", F.col("m.section_id").alias("section_id"))


# ---- JON20: nearest vectors ---------------------------------------------------------------------------------
def knn(queries, corpus, k, threshold=None, ident="vec_id", vector="embedding"):
    """JON20: the k nearest corpus vectors of each query by cosine, exact; ties go to the smaller id.

    Blocks of near vectors that can't hold a better one are skipped (``nearest``).
    """
    return nearest.Index(corpus, ident, vector).search(queries, k, threshold, ident, vector)


def resolve_titles(queries, targets, threshold=0.75):
    """JON20: cited titles to targets: the same title, else the gazette number it names, else
    the nearest vector if it is near enough. Only what the first two leave is searched.

    queries: query_id, title, embedding; targets: target_id, ingest_ord, title, dogc_number,
    embedding. The first target in input order has a title or number; vectors may be NULL.
    """
    clean = lambda c: F.lower(F.trim(c))
    first = lambda key: targets.select(key.alias("key"), "target_id", "ingest_ord").filter("key <> ''").groupBy("key").agg(F.min_by("target_id", "ingest_ord").alias("target_id"))
    q = queries.filter(tx.nonblank("title").isNotNull()).select("query_id", "embedding", clean("title").alias("_t"))
    q = q.withColumn("_g", F.regexp_extract("_t", rules.NAMED_GAZETTE, 1))
    by_title, by_number = first(clean("title")), first(F.col("dogc_number"))
    q = q.join(by_title.withColumnRenamed("target_id", "_a"), F.col("_t") == F.col("key"), "left").drop("key")
    q = cut(q.join(by_number.withColumnRenamed("target_id", "_b"), F.col("_g") == F.col("key"), "left").drop("key"))
    rest = q.filter("_a IS NULL AND _b IS NULL AND embedding IS NOT NULL").select(F.col("query_id").alias("vec_id"), "embedding")
    near = knn(rest, targets.filter("embedding IS NOT NULL").select(F.col("target_id").alias("vec_id"), "embedding"), 1, threshold)
    q = q.join(near.select("query_id", F.col("neighbour_id").alias("_c")), "query_id", "left")
    return q.select("query_id", F.coalesce("_a", "_b", "_c").alias("target_id"),
                    F.when(F.col("_a").isNotNull(), "title").when(F.col("_b").isNotNull(), "gazette_number").when(F.col("_c").isNotNull(), "vector").alias("found_by"))


# ---- JON21: spans in sections ---------------------------------------------------------------------------------
def locate_spans(spans, sections, doc="doc_id", offset="start_offset", width=1024):
    """JON21: first section containing an offset, else the document's first, else Body.

    Sections are spread over the offset buckets they cover; distinct (document, offset)
    pairs, not annotations, meet them there.
    """
    s = sections.select(doc, "section_no", "title", "type", "start_offset", "end_offset")
    buckets = s.withColumn("_b", F.explode(F.sequence(F.floor(F.col("start_offset") / width), F.floor(F.col("end_offset") / width))))
    at = spans.select(doc, F.col(offset).alias("_at")).distinct().withColumn("_b", F.floor(F.col("_at") / width))
    hit = (at.join(buckets, [doc, "_b"]).filter((F.col("_at") >= F.col("start_offset")) & (F.col("_at") <= F.col("end_offset")))
           .groupBy(doc, "_at").agg(F.min(F.struct("section_no", "title", "type")).alias("h")))
    first = s.groupBy(doc).agg(F.min(F.struct("section_no", "title", "type")).alias("f"))
    out = spans.withColumn("_at", F.col(offset)).join(hit, [doc, "_at"], "left").join(first, doc, "left")
    pick = lambda c, d: F.coalesce(F.col(f"h.{c}"), F.col(f"f.{c}"), F.lit(d))
    return out.select(*[f for f in spans.columns], pick("title", "Body").alias("section_title"), pick("type", "body").alias("section_type"))


# ---- JON22: aligning two citation lists ------------------------------------------------------------------------
def _word_windows(c):
    """Every run of whole words of a short name."""
    w = F.split(c, " ")
    n = F.size(w)
    return F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.array_join(F.slice(w, i, k), " "))))


def _align_keys(title, own, other):
    """Keys under which a title meets another: shared n/yyyy number, or whole-word containment."""
    t = tx.squeeze(F.lower(title))
    nums = F.regexp_extract_all(t, F.lit(r"(?U)\b(\d+/\d{4})\b"), F.lit(1))
    pre = lambda xs, p: F.transform(xs, lambda x: F.concat(F.lit(p), x))
    return F.array_distinct(F.concat(pre(nums, "n:"), F.array(F.concat(F.lit(own), t)), pre(_word_windows(t), other)))


TOGETHER = 1024  # titles of a node that one task aligns, at most


def align_citations(graph, found, block=64):
    """JON22: greedy one-to-one alignment per node: each graph title, in order, takes the
    first unused extracted title that shares an n/yyyy number or contains it or lies in it
    by whole words.

    graph / found: node_id, ord, title. A node of up to ``TOGETHER`` titles is aligned in one
    task, all its rows having come there in one shuffle; larger ones take rounds of ``block``
    graph titles. Titles without a node match nothing.
    """
    g = graph.select("node_id", F.col("ord").alias("g_ord"), F.col("title").alias("g_title"))
    f = found.select("node_id", F.col("ord").alias("f_ord"), F.col("title").alias("f_title"))
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    cols = ["node_id", "status", "g_title", "f_title", "g_ord", "f_ord"]
    one = g.select("node_id", F.lit("missing").alias("status"), "g_title", none(f, "f_title"), "g_ord", none(f, "f_ord"))
    two = f.select("node_id", F.lit("extra").alias("status"), none(g, "g_title"), "f_title", none(g, "g_ord"), "f_ord")
    rows = one.unionByName(two)
    near = cut(rows.filter("node_id IS NOT NULL").repartition("node_id").sortWithinPartitions("node_id", F.col("status").desc(), "g_ord", "f_ord"))
    large = cut(near.groupBy("node_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > TOGETHER).select("node_id"))
    lone = rows.filter("node_id IS NULL")
    if large.isEmpty():
        return _align_in_tasks(near).unionByName(lone).select(cols)
    # fewer than all rows / TOGETHER
    hot = near.join(F.broadcast(large), "node_id", "left_semi")
    small = _align_in_tasks(near.join(F.broadcast(large), "node_id", "left_anti"))
    rounds = _align_in_rounds(hot.filter("status = 'missing'").select(g.columns), hot.filter("status = 'extra'").select(f.columns), block)
    return small.unionByName(rounds).unionByName(lone).select(cols)


def _align_in_tasks(rows):
    """``align_citations`` of rows sorted by node, graph titles first, each side in order."""
    title = tx.squeeze(F.lower(F.coalesce("g_title", "f_title")))
    return rows.withColumns({"_t": title, "_nums": F.regexp_extract_all(title, F.lit(r"(?U)\b(\d+/\d{4})\b"), F.lit(1))}).mapInArrow(_aligned, rows.schema)


def _aligned(batches):
    """Matched, missing and extra rows, node by node."""
    import pyarrow as pa
    names = ["node_id", "status", "g_title", "f_title", "g_ord", "f_ord"]
    node, held, out, schema = None, [], [], None
    batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*rows))], names=names)
    for b in batches:
        schema = b.schema
        for row in zip(*(b.column(c).to_pylist() for c in [*names, "_t", "_nums"])):
            if held and row[0] != node:
                out += _align_node(held)
                held = []
            node = row[0]
            held.append(row)
        if out:
            yield batch(out)
            out = []
    if held:
        yield batch(_align_node(held))


def _align_node(rows):
    """Rows of one node, aligned. Rows of a side that share an order count as one title with several readings."""
    def entries(status, at):
        by_ord = {}
        for n, r in enumerate(rows):
            if r[1] == status:
                by_ord.setdefault(("no order", n) if r[at] is None else r[at], []).append(r)
        # (rows, readings: title between blanks and its numbers)
        return [(rs, [(f" {r[6]} ", set(r[7])) for r in rs if r[6] is not None and r[at] is not None]) for rs in by_ord.values()]

    def alike(a, b):
        return any(s in t or t in s or not n.isdisjoint(m) for s, n in a for t, m in b)

    free, out = entries("extra", 5), []
    for mine, read in entries("missing", 4):
        k = next((k for k, (_, other) in enumerate(free) if alike(read, other)), None)
        if k is None:
            out += [r[:6] for r in mine]
        else:
            taken = free.pop(k)[0]
            out += [(m[0], "match", m[2], o[3], m[4], o[5]) for m in mine for o in taken]
    return out + [r[:6] for rs, _ in free for r in rs]


def _align_in_rounds(g, f, block):
    """``align_citations`` in rounds of ``block`` graph titles per node.

    Within a round the others can use up fewer than ``block`` candidates, so the first
    ``block`` free ones per key are enough. Titles meet on equal keys, a node never has
    more than block * block rows per key in a task, and the result is that of the
    sequential greedy however hot the node is.
    """
    def greedy(batches):
        import pandas as pd
        node = taken = object()
        used = set()
        for pdf in batches:
            out = []
            for n, g, f in zip(pdf["node_id"], pdf["g_ord"], pdf["f_ord"]):
                if n != node:
                    node, taken, used = n, object(), set()
                if g != taken and f not in used:
                    used.add(f)
                    taken = g
                    out.append((n, g, f))
            yield pd.DataFrame(out, columns=["node_id", "g_ord", "f_ord"])

    numbered = split_row_number(g, ["node_id"], [F.floor(F.col("g_ord") / 4096)], ["g_ord"], "_n")
    gk = cut(numbered.select("node_id", "g_ord", F.floor((F.col("_n") - 1) / block).alias("_round"), F.explode(_align_keys("g_title", "w:", "t:")).alias("_key")))
    free = f.select("node_id", "f_ord", F.explode(_align_keys("f_title", "t:", "w:")).alias("_key"))
    free = cut(free.join(gk.select("node_id", "_key").distinct(), ["node_id", "_key"], "left_semi"))
    rounds, done = (gk.agg(F.max("_round")).first()[0] or 0) + 1, None
    for r in range(rounds):
        now = gk.filter(F.col("_round") == r).select("node_id", "g_ord", "_key")
        if done is not None:
            free = free.join(done.select("node_id", "f_ord"), ["node_id", "f_ord"], "left_anti")
        near = top_k(free, ["node_id", "_key"], ["f_ord"], block, "_k")
        pairs = now.join(near, ["node_id", "_key"]).select("node_id", "g_ord", "f_ord").distinct()
        got = cut(sorted_stream(pairs, ["node_id"], ["g_ord", "f_ord"], greedy, pairs.schema))
        done = got if done is None else done.unionByName(got)
    match = done.join(g, ["node_id", "g_ord"]).join(f, ["node_id", "f_ord"]).select("node_id", F.lit("match").alias("status"), "g_title", "f_title", "g_ord", "f_ord")
    none = F.lit(None).cast("string")
    missing = g.join(done, ["node_id", "g_ord"], "left_anti").select("node_id", F.lit("missing").alias("status"), "g_title", none.alias("f_title"), "g_ord", F.lit(None).cast(f.schema["f_ord"].dataType).alias("f_ord"))
    extra = f.join(done, ["node_id", "f_ord"], "left_anti").select("node_id", F.lit("extra").alias("status"), none.alias("g_title"), "f_title", F.lit(None).cast(g.schema["g_ord"].dataType).alias("g_ord"), "f_ord")
    return match.unionByName(missing).unionByName(extra)


# ---- JON23 - JON26 -----------------------------------------------------------------------------------------------
def edge_diff(old, new):
    """JON23: edges of the new graph whose (source, target, type) the old one lacks."""
    return new.join(old.select("src", "dst", "type").distinct(), ["src", "dst", "type"], "left_anti")


def before_and_after(old, new, edge_id="edge_id"):
    """JON23: changed edges with their former target and type."""
    o = old.select(edge_id, F.col("dst").alias("old_dst"), F.col("type").alias("old_type"))
    return new.join(o, edge_id).filter((F.col("dst") != F.col("old_dst")) | (F.col("type") != F.col("old_type")))


def merge_catalogue(feed, manual, issue_docs):
    """JON24: open-data rows, hand-kept addresses and issue documents in one catalogue.

    The first feed row of an address creates the entry and later rows only fill blanks;
    entries adopt the issue document with their issue and title; issue documents nobody
    adopted are appended. Keyed by id, else by address, the later source winning.
    """
    rows = feed.filter(tx.nonblank("url").isNotNull()).select("url", "type", "year", "dogc_number", "title", F.col("ingest_ord").alias("o"), F.lit(0).alias("src"))
    hand = manual.select("url", F.lit("Unknown").alias("type"), F.lit("").alias("year"), F.lit("").alias("dogc_number"), F.lit("Unknown Title").alias("title"), F.lit(0).cast("long").alias("o"), F.lit(1).alias("src"))
    order = F.struct("src", "o")
    first = lambda c: F.min_by(c, F.when(tx.nonblank(c).isNotNull(), order)).alias(c)
    cat = rows.unionByName(hand).groupBy("url").agg(F.min_by("type", order).alias("type"), F.min_by("year", order).alias("year"), first("dogc_number"), first("title"))
    idx = issue_docs.withColumn("_k", tx.alnum_key("title")).groupBy("dogc_number", "_k").agg(F.max_by(F.struct("document_id", "section", "organisme", F.col("year").cast("string").alias("year")), "ingest_ord").alias("m"))
    cat = cat.withColumn("_k", tx.alnum_key("title")).join(idx, ["dogc_number", "_k"], "left").select(
        F.col("m.document_id").alias("document_id"), "url", "type", F.coalesce(F.col("m.year"), "year").alias("year"), "dogc_number", F.col("m.section").alias("section"),
        F.coalesce(F.col("m.organisme"), F.lit("Unknown Organisme")).alias("organisme"), "title")
    rest = issue_docs.join(cat.filter(F.col("document_id").isNotNull()).select("document_id").distinct(), "document_id", "left_anti").select(
        "document_id", F.lit(None).cast("string").alias("url"), "type", F.col("year").cast("string").alias("year"), "dogc_number", "section", "organisme", "title")
    key = F.coalesce(F.col("document_id").cast("string"), F.concat(F.lit("url_"), "url"))
    return first_row(cat.unionByName(rest).withColumn("catalogue_key", key), ["catalogue_key"], ["url"], last=True)


def not_yet_done(df, done, key):
    """JON25: input rows whose key was not processed before."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def induced_edges(edges, nodes, ident="id"):
    """JON26: edges with both ends among the nodes."""
    n = nodes.select(F.col(ident).alias("_n")).distinct()
    return edges.join(n, F.col("src") == F.col("_n"), "left_semi").join(n, F.col("dst") == F.col("_n"), "left_semi")
