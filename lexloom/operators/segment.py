"""Paragraphs, pages and whole texts into articles and sections."""

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import markup, text as tx
from lexloom.operators.ordered import CHUNK, scan
from lexloom.session import cut, spread


def _ex(c, pattern, group):
    return F.regexp_extract(c, pattern, group)


def _chapter_label(title, heading):
    full = F.regexp_replace(F.concat(title, F.lit(". "), heading), r"^[. ]+|[. ]+$", "")
    return F.when(heading != "", full).otherwise(title)


def header_patterns(html=False):
    """The header patterns of each kind, with the groups that `classify` reads, in order of priority."""
    found = {"chapter": rules.CHAPTER_HEADER, "article": rules.ARTICLE_HEADER_HTML if html else rules.ARTICLE_HEADER}
    if html:
        found["resolution"] = rules.RESOLUTION_HEADER
    return {**found, "disposition": rules.DISPOSITION_HEADER, "annex": rules.ANNEX_HEADER, "signature": rules.SIGNATURE_HEADER_HTML if html else rules.SIGNATURE_HEADER}


def classify(df, text="text", html=False, patterns=None):
    """Header kind, title, heading and chapter label of each paragraph, in the priority of ``patterns``.

    patterns: kind to pattern, as ``header_patterns`` gives them; some or all can be replaced by own ones.
    """
    c, patterns = F.col(text), patterns or header_patterns(html)
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(patterns.items()):
        kind = F.when(c.rlike(pattern), name).otherwise(kind)
    df = df.withColumn("kind", kind)
    k = F.col("kind")

    def group(wanted):
        out = F.when(k.isNull(), F.lit(None).cast("string"))
        for name, n in wanted.items():
            out = out.when(k == name, _ex(c, patterns[name], n)) if name in patterns else out
        return out

    # captured pieces become columns first, so each regex runs once per header
    df = df.withColumns({"_name": group({"chapter": 1, "resolution": 1, "disposition": 2}),
                         "_num": group({"chapter": 2, "article": 2, "disposition": 3, "annex": 2}),
                         "_rest": group({"chapter": 3, "article": 3, "resolution": 2, "disposition": 4, "annex": 3})})
    name, num = tx.capitalise("_name"), F.col("_num")
    title = (F.when(k == "chapter", F.concat_ws(" ", name, num))
             .when(k == "article", F.concat(F.lit("Article "), num if html else tx.article_number(num)))
             .when(k == "resolution", name)
             .when(k == "disposition", F.trim(F.concat_ws(" ", F.lit("Disposició"), name, num)))
             .when(k == "annex", F.trim(F.concat(F.lit("Annex "), num)))
             .when(k == "signature", "Signatures"))
    df = df.withColumns({"title": title, "heading": F.nullif("_rest", F.lit(""))}).drop("_name", "_num", "_rest")
    return df.withColumn("chapter_label", F.when(k == "chapter", _chapter_label(F.col("title"), F.coalesce("heading", F.lit("")))))


def section_paragraphs(paras, key="document_id", ord_col="ord", text="text", patterns=None):
    """SEG1: every paragraph with its section number, kind and running chapter.

    Section 0 is the implicit preamble. Long documents are scanned in chunks.
    """
    p = paras.filter(F.col(text).rlike(r"(?U)\S")).select(key, F.col(ord_col).alias("ord"), tx.squeeze(text).alias("text"))
    p = classify(p, patterns=patterns).withColumns({"_head": F.col("kind").isNotNull().cast("long"), "_one": F.lit(1)})
    p = scan(p, [key], "ord", sums={"section_no": "_head", "para_no": "_one"}, carries={"chapter": "chapter_label"}, sizes=paras.select(key))
    content = F.col("kind").isNull() | (F.col("kind") == "signature")
    return p.withColumn("content", content).drop("_head", "_one", "chapter_label")


def section_rows(p, key="document_id", intro=("introduction", "Preàmbul", "Introducció"), drop_empty_intro=False):
    """One row per section from paragraph rows; an intro row for every document."""
    own = F.struct("section_no", F.lit(True).alias("real"))
    none = F.struct(F.lit(0).cast("long").alias("section_no"), F.lit(False).alias("real"))
    # a document that opens with a header still has a preamble, an empty one
    opens = (F.col("para_no") == 1) & (F.col("section_no") == 1) & F.lit(not drop_empty_intro)
    p = p.select("*", F.explode(F.when(opens, F.array(own, none)).otherwise(F.array(own))).alias("_x"))
    real, content = F.col("_x.real"), F.col("_x.real") & F.col("content")
    s = p.groupBy(key, F.col("_x.section_no").alias("section_no")).agg(
        F.min_by(F.struct("kind", "title", "heading", "chapter"), F.when(real & F.col("kind").isNotNull(), F.col("ord"))).alias("h"),
        F.count_if(content).alias("n_paras"), F.coalesce(F.sum(F.when(content, F.length("text"))), F.lit(0)).alias("n_chars"))
    return s.select(key, "section_no", F.coalesce("h.kind", F.lit(intro[0])).alias("type"),
                    F.coalesce("h.title", F.lit(intro[1])).alias("title"),
                    F.when(F.col("h.kind").isNull(), F.lit(intro[2])).otherwise(F.col("h.heading")).alias("heading"),
                    F.col("h.chapter").alias("chapter"), "n_paras", "n_chars")


def section_text(p, key="document_id", sep="\n"):
    """Text of each section in pieces of bounded size; the pieces in order are the whole.

    An ordinary section is one piece. A section spanning many paragraph chunks becomes
    several rows, so no row or task ever holds an unbounded list.
    """
    pieces = (p.filter("content").withColumn("piece", F.floor(F.col("ord") / CHUNK))
              .groupBy(key, "section_no", "piece").agg(F.sort_array(F.collect_list(F.struct("ord", "text"))).alias("x")))
    return pieces.select(key, "section_no", "piece", F.array_join(F.transform("x", lambda e: e["text"]), sep).alias("text"))


def xml_blocks(paras, key="law_id", ord_col="ord", cls="cls", text="text"):
    """SEG3: paragraphs numbered by the article block they belong to; headers removed.

    Blocks without text vanish because only content paragraphs are kept.
    """
    p = paras.select(key, F.col(ord_col).alias("ord"), F.col(cls).alias("cls"), F.trim(text).alias("text")).filter(F.col("text") != "")
    p = p.withColumns({"_head": (F.col("cls") == "articulo").cast("long"), "_name": F.when(F.col("cls") == "articulo", F.col("text"))})
    p = scan(p, [key], "ord", sums={"block_no": "_head"}, carries={"raw_name": "_name"}, sizes=paras.select(key))
    name = F.trim(F.replace(F.coalesce("raw_name", F.lit("Preámbulo")), F.lit("[precepto]"), F.lit("")))
    return p.filter("_head = 0").select(key, "block_no", name.alias("name"), "ord", "text")


def block_rows(p, key="law_id"):
    """One row per block with its identifier and size."""
    return (p.groupBy(key, "block_no").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n_paras"), F.sum(F.length("text")).alias("n_chars"))
            .withColumn("id", F.concat(F.col(key).cast("string"), F.lit("#"), "name")))


def align_sections(a, b, key="document_id", ord_col="ord"):
    """SEG6: section i of one language beside section i of the other."""
    cols = ["title", "heading", "text"]
    other = b.select(key, ord_col, *[F.col(c).alias(f"{c}_es") for c in cols], F.lit(True).alias("_has"))
    out = a.join(other, [key, ord_col], "left")
    return out.select(*a.columns, *[F.coalesce(f"{c}_es", F.lit("")).alias(f"{c}_es") for c in cols],
                      F.coalesce("_has", F.lit(False)).alias("is_bilingual"))


# ---- SEG2: published pages ------------------------------------------------------------------
_BREAK = "\u0001"
_BLOCK_TAGS = r"(?is)</?(?:p|h[1-6]|div|li|blockquote|section|article|ul|ol|nav|footer|header|body)\b[^>]*>"


def page_fields(df, html="html"):
    """Title, identifiers, notices and editorial links of a published page."""
    c = F.col(html)
    items = lambda ul: F.regexp_extract_all(F.regexp_extract(c, rf"(?is)<ul[^>]*id=[\"']{ul}[\"'][^>]*>(.*?)</ul>", 1), F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), F.lit(1))
    links = lambda ul: F.transform(items(ul), lambda li: F.struct(tx.squeeze(markup.inner_text(li)).alias("text"), F.nullif(F.regexp_extract(li, r"documentId=(\d+)", 1), F.lit("")).alias("targetDocumentId")))
    topics = lambda ul: F.transform(F.regexp_extract_all(F.regexp_extract(c, rf"(?is)<ul[^>]*id=[\"']related_body_block-{ul}[\"'][^>]*>(.*?)</ul>", 1), F.lit(r"(?is)(<a\b[^>]*>.*?</a>)"), F.lit(1)), lambda a: F.struct(
        F.nullif(F.regexp_extract(a, r"(?i)\bid=[\"']([^\"']*)", 1), F.lit("")).alias("id"),
        F.coalesce(F.nullif(F.regexp_extract(a, r"(?i)\btitle=[\"']([^\"']*)", 1), F.lit("")), F.trim(markup.inner_text(a))).alias("name")))
    pairs = F.transform(items("disposicions_cos_bloc"), lambda li: F.filter(F.transform(F.split(F.regexp_replace(li, r"(?s)<[^>]*>", "\n"), "\n"), lambda x: F.trim(x)), lambda x: x != ""))
    pairs = F.filter(pairs, lambda p: F.size(p) >= 2)
    names = F.create_map(*[F.lit(x) for kv in rules.METADATA_KEYS.items() for x in kv])
    camel = lambda k: F.concat(F.lower(F.substring(F.regexp_replace(F.initcap(F.regexp_replace(k, r"[^a-zA-Z0-9\s]", "")), r"\s+", ""), 1, 1)),
                               F.substring(F.regexp_replace(F.initcap(F.regexp_replace(k, r"[^a-zA-Z0-9\s]", "")), r"\s+", ""), 2, 1 << 20))
    metadata = F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.coalesce(F.try_element_at(names, p[0]), camel(p[0])), F.array_join(F.slice(p, F.lit(2), F.size(p)), " "))))
    hrefs = F.regexp_extract_all(c, F.lit(r"(?is)<a\b[^>]*href=[\"']([^\"']*)"), F.lit(1))
    return df.withColumns({
        "document_id": F.coalesce(F.nullif(F.regexp_extract(c, r"(?is)<input[^>]*id=[\"']documentIdRequest[\"'][^>]*value=[\"']([^\"']*)", 1), F.lit("")), F.lit("Unknown")),
        "eli_uri": F.trim(F.replace(markup.inner_text(F.regexp_extract(c, r"(?is)<[^>]*(?:class|id)=[\"']uriEli[\"'][^>]*>(.*?)</", 1)), F.lit("URI ELI:"), F.lit(""))),
        "title": F.coalesce(F.nullif(tx.squeeze(markup.inner_text(F.regexp_extract(c, r"(?is)<h1\b[^>]*>(.*?)</h1>", 1))), F.lit("")), F.lit("Unknown Title")),
        "metadata": metadata, "affectations": F.struct(links("affectations_active_ul").alias("active"), links("affectations_passive_ul").alias("passive")),
        "descriptors": F.struct(topics("organizationDescriptor").alias("organisms"), topics("geographicDescriptor").alias("geographic"), topics("thematicDescriptor").alias("thematic")),
        "pdf_url": F.get(F.filter(hrefs, lambda h: h.contains("PdfProviderServlet")), F.lit(0))})


def page_blocks(df, key="page_id", html="html"):
    """Text, table and image blocks of the page body in order. Pages without one vanish."""
    c = F.col(html)
    body = F.regexp_replace(F.regexp_extract(c, r"(?is)<(\w+)\b[^>]*\bid=[\"']fullText[\"'][^>]*>(.*)</\1>", 2), r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1>", "")
    body = F.regexp_replace(F.regexp_replace(body, r"(?is)^(.*?)<h1\b[^>]*>.*?</h1>", "$1"), r"(?is)<(\w+)[^>]*(?:class|id)=[\"']uriEli[\"'][^>]*>.*?</\1>", "")
    body = F.regexp_replace(body, r"(?is)(<table\b.*?</table>|<img\b[^>]*>)", _BREAK + "$1" + _BREAK)
    # blank lines inside <pre> end a paragraph
    body = F.regexp_replace(body, r"(?is)<pre\b[^>]*>|</pre>", _BREAK + "\u0002")
    pieces = F.split(F.regexp_replace(body, _BLOCK_TAGS, _BREAK), _BREAK)
    pieces = F.flatten(F.transform(pieces, lambda p: F.when(p.startswith("\u0002"), F.split(F.translate(p, "\u0002", ""), r"\n\s*\n")).otherwise(F.array(p))))
    typed = F.transform(pieces, lambda p: F.struct(
        F.when(p.rlike(r"(?i)^<table\b"), "table").when(p.rlike(r"(?i)^<img\b"), "image").otherwise("text").alias("block"), p.alias("html"),
        F.when(p.rlike(r"(?i)^<(table|img)\b"), "").otherwise(tx.squeeze(markup.inner_text(p))).alias("text")))
    typed = F.filter(typed, lambda b: (b["block"] != "text") | (b["text"] != ""))
    return df.select(key, F.posexplode(typed).alias("ord", "b")).select(key, "ord", "b.*")


def page_paragraphs(blocks, key="page_id"):
    """SEG2: blocks with section number, kind, borrowed headings and numbered attachments."""
    b = classify(blocks, "text", html=True)
    is_text = F.col("block") == "text"
    b = b.withColumn("kind", F.when(is_text, F.col("kind")))
    # a chapter line inside a signature block is swallowed; every other header ends it
    b = b.withColumn("_breaker", F.when(F.col("kind") != "chapter", F.col("kind")))
    b = b.withColumn("_bare", F.coalesce((F.col("kind") == "article") & F.col("heading").isNull(), F.lit(False)))
    b = b.withColumn("_plain", is_text & F.col("kind").isNull())
    b = scan(b, [key], "ord", carries={"_last": "_breaker"}, leads={"_next_plain": "_plain", "_next_text": "text"})
    b = b.withColumn("kind", F.when((F.col("kind") == "chapter") & (F.col("_last") == "signature"), F.lit(None)).otherwise(F.col("kind")))
    borrow = F.col("_bare") & F.coalesce("_next_plain", F.lit(False))
    b = b.withColumns({"heading": F.when(borrow, F.col("_next_text")).otherwise(F.col("heading")), "_borrow": borrow,
                       "_head": F.col("kind").isNotNull().cast("long"), "_att": (~is_text).cast("long"), "_one": F.lit(1),
                       "_section_title": F.when(F.col("kind").isNotNull(), F.col("title")),
                       "chapter_label": F.when(F.col("kind").isNotNull(), F.col("chapter_label")),
                       "_borrow_at": F.when(borrow, F.col("ord") + 1)})
    b = scan(b, [key], "ord", sums={"section_no": "_head", "para_no": "_one", "_att_no": "_att"},
             carries={"chapter": "chapter_label", "section_title": "_section_title", "_taken": "_borrow_at"})
    taken = F.coalesce(F.col("_taken") == F.col("ord"), F.lit(False)) & ~F.col("_borrow")
    att = F.concat(F.lit("att_"), F.col("_att_no").cast("string"))
    kind = F.when(F.col("kind") == "resolution", "article").otherwise(F.col("kind"))
    return b.select(
        key, "ord", "section_no", "para_no", kind.alias("kind"), "title", "heading", "chapter", "block", "html",
        F.coalesce("section_title", F.lit("Preamble")).alias("section_title"), F.when(~is_text, att).alias("attachment_id"),
        F.when(is_text, F.col("text")).otherwise(F.concat(F.lit("[ATTACHMENT: "), att, F.lit("]"))).alias("text"),
        ((F.col("kind").isNull() | (F.col("kind") == "signature")) & ~taken).alias("content"))


def page_sections(p, key="page_id"):
    """Section rows of pages; an introduction without content is dropped."""
    rows = section_rows(p, key, ("introduction", "Preamble", None), drop_empty_intro=True)
    return rows.filter((F.col("section_no") > 0) | (F.col("n_paras") > 0))


def page_attachments(p, key="page_id"):
    """Tables as markdown and images as source/alt/title."""
    attr = lambda n: F.regexp_extract("html", rf"(?i)\b{n}=[\"']([^\"']*)", 1)
    return p.filter(F.col("attachment_id").isNotNull()).select(
        key, "attachment_id", F.col("block").alias("type"), "section_title",
        F.when(F.col("block") == "table", markup.table_to_markdown("html")).alias("content_text"),
        F.when(F.col("block") == "image", F.struct(attr("src").alias("src"), attr("alt").alias("alt"), attr("title").alias("title"))).alias("content_image"))


# ---- SEG4 / SEG5: offsets in whole texts -----------------------------------------------------
def _regex(pattern):
    return f"(?iU){pattern}"


def offset_sections(df, key="doc_id", text="text"):
    """SEG4: (type, title, start, end) spans that tile each text; text before the first header is a body.

    A pattern's hits and the text between them have the same order, so running sums of their lengths are the offsets.
    Only lengths and titles leave the row that holds the text.
    """
    docs = spread(df.select(key, F.col(text).alias("_text")), [key, "_text"])
    docs = docs.withColumn("_n", F.when(F.col("_text").rlike(r"(?U)\S"), F.length("_text")).otherwise(0))
    # one search for each pattern; texts that it hits are cut up and read for titles
    docs = docs.withColumns({f"_at_{kind}": F.when(F.col("_n") > 0, F.regexp_extract_all("_text", F.lit(_regex(pattern)), F.lit(0))) for kind, pattern in rules.SPAN_HEADERS})
    found = []
    for kind, pattern in rules.SPAN_HEADERS:
        rx, hits = _regex(pattern), F.col(f"_at_{kind}")
        there = _hits(kind, F.split("_text", rx), hits, F.regexp_extract_all("_text", F.lit(rx), F.lit(1)))
        found.append(F.when(F.size(hits) > 0, there).otherwise(F.array().cast("array<struct<type:string,no:int,reach:int,title:string>>")))
    docs = cut(docs.select(key, "_n", F.concat(*found).alias("_hits")))
    hits = docs.select(key, F.explode("_hits").alias("_h")).select(key, "_h.*")
    hits = scan(hits, [key, "type"], "no", sums={"_upto": "reach"})
    title = F.regexp_replace("title", r"(?U)^\s+|\s+$", "")
    title = F.when(F.col("type") == "signature", F.concat(F.lit("Signatures: "), F.substring(title, 1, rules.SPAN_SIGNATURE_CUT))).otherwise(title)
    most = rules.SPAN_TITLE_CUT
    heads = hits.select(key, "type", F.when(F.length(title) <= most, title).otherwise(F.concat(F.substring(title, 1, most), F.lit("..."))).alias("title"),
                        (F.col("_upto") - F.length("title")).alias("start_offset"))
    first = heads.groupBy(key).agg(F.min("start_offset").alias("_first"))
    sizes = docs.select(key, "_n").join(first, key, "left")
    lead = sizes.filter("_first IS NULL OR _first > 0").select(key, F.lit("body").alias("type"), F.lit("Body").alias("title"), F.lit(0).cast("long").alias("start_offset"))
    spans = scan(lead.unionByName(heads).withColumn("_one", F.lit(1)), [key], "start_offset", sums={"_no": "_one"}, leads={"_next": "start_offset"})
    return spans.join(sizes.select(key, "_n"), key).select(
        key, (F.col("_no") - 1).cast("int").alias("section_no"), "type", "title", F.col("start_offset").cast("int"), F.coalesce("_next", "_n").cast("int").alias("end_offset"))


def _hits(kind, gaps, hits, titles):
    """Array of (type, no, reach, title): reach is the length of a hit and of what lies between it and the one before."""
    both = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
    return F.transform(F.zip_with(both, titles, lambda n, t: F.struct(n.alias("reach"), t.alias("title"))),
                       lambda x, i: F.struct(F.lit(kind).alias("type"), i.alias("no"), x["reach"].alias("reach"), x["title"].alias("title")))


def _starts(gaps, sizes):
    """Where each hit starts, by running sums inside the row. gaps: what lies between hits; sizes: the hits' lengths."""
    reach = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, n: F.length(g) + n)
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    ends = F.aggregate(reach, none, lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["all"], a["at"] + n).alias("all")), lambda a: a["all"])
    return F.zip_with(ends, sizes, lambda e, n: e - n)


def isolate(df, key="doc_id", text="text", title="title", number="number"):
    """SEG5: span of one document inside a whole-issue text.

    Of the places that name the document's number, the one with most title words around it opens the span (the first of
    equals); the next header far enough behind closes it. Without a number, or a place that names it, the span is the text.
    """
    before, around, lead, least = rules.ISSUE_WINDOW
    names = [F.col(c).alias(n) for c, n in ((key, key), (text, "_text"), (title, "_title"), (number, "_number"))]
    d = spread(df.select(*names), [key, "_text"])
    txt, num, title = tx.or_empty("_text"), F.trim(tx.or_empty("_number")), "_title"
    num = F.when(num.contains("/"), F.regexp_replace(num, "^0+", "")).otherwise(num)
    # the number itself is looked for first, word borders only around it
    named = F.concat(F.lit("(?iU)(?=\\Q"), num, F.lit("\\E)\\b\\Q"), num, F.lit("\\E\\b"))
    d = d.select(key, txt.alias("_t"), F.length(txt).alias("_n"), num.alias("_num"), F.when(num != "", named).alias("_rx"),
                  F.filter(F.regexp_extract_all(F.lower(tx.or_empty(title)), F.lit(r"(?U)\w{4,}"), F.lit(0)), lambda w: ~w.isin(rules.ISSUE_TITLE_STOPWORDS)).alias("_words"))
    # one search: a hit is as long as the number
    d = d.withColumn("_gaps", F.split(F.col("_t"), F.col("_rx")))
    d = d.withColumn("_sizes", F.array_repeat(F.length("_num"), F.size("_gaps") - 1))
    starts = _starts(F.col("_gaps"), F.col("_sizes"))
    window = lambda at: F.lower(F.substring(F.col("_t"), F.greatest(at - before, F.lit(0)) + 1, F.least(at, F.lit(before)) + around))
    score = lambda x: F.size(F.filter("_words", lambda w: F.contains(x["window"], w)))
    places = F.transform(starts, lambda at: F.struct(at.alias("at"), window(at).alias("window")))
    best = F.array_max(F.transform(places, lambda x: F.struct(score(x).alias("score"), (-x["at"]).alias("at"))))
    d = d.withColumn("_start", F.greatest(-best["at"] - lead, F.lit(0)))
    rx = _regex(rules.ISSUE_NEXT_HEADER)
    d = d.withColumn("_rest", F.substring(F.col("_t"), F.col("_start") + 1, F.col("_n")))
    d = d.withColumn("_heads", F.regexp_extract_all("_rest", F.lit(rx), F.lit(0)))
    heads = _starts(F.split("_rest", rx), F.transform("_heads", lambda h: F.length(h)))
    later = F.filter(F.when(F.size("_heads") > 0, heads), lambda at: at > least)
    end = F.coalesce(F.col("_start") + F.get(later, F.lit(0)), F.col("_n"))
    return d.select(key, F.coalesce("_start", F.lit(0)).cast("int").alias("start_offset"), F.when(F.col("_start").isNull(), F.col("_n")).otherwise(end).cast("int").alias("end_offset"))
