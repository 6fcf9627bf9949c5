"""Segmentation and citation rules on hand-written text, accents and quirks included."""

import re

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.functions import doctype, text as tx
from lexloom.operators import cite, segment

LAW = ["Vist l'expedient", "Capítol II. Règim", "Article únic. Objecte", "Text  de\tl'article.", "Artículo segundo", "Més text", "Disposició addicional primera. Altres",
       "Annex III. Taules", "Barcelona, 3 de maig de 2020", "El conseller"]


def _paras(spark, docs):
    return spark.createDataFrame([(d, i, p) for d, ps in docs.items() for i, p in enumerate(ps)], "document_id string, ord int, text string")


def test_sections_follow_headers(spark):
    docs = {"a": LAW, "b": ["Article 1", "x"], "c": ["només text"]}
    p = segment.section_paragraphs(_paras(spark, docs))
    rows = [tuple(r) for r in segment.section_rows(p).select("document_id", "section_no", "type", "title", "heading", "chapter", "n_paras").orderBy("document_id", "section_no").collect()]
    chap = "Capítol II. Règim"
    assert rows[:7] == [
        ("a", 0, "introduction", "Preàmbul", "Introducció", None, 1), ("a", 1, "chapter", "Capítol II", "Règim", chap, 0),
        ("a", 2, "article", "Article Únic", "Objecte", chap, 1), ("a", 3, "article", "Article 2", None, chap, 1),
        ("a", 4, "disposition", "Disposició Addicional primera", "Altres", chap, 0), ("a", 5, "annex", "Annex", "III. Taules", chap, 0),
        ("a", 6, "signature", "Signatures", None, chap, 2)]
    assert rows[7:] == [("b", 0, "introduction", "Preàmbul", "Introducció", None, 0), ("b", 1, "article", "Article 1", None, None, 1), ("c", 0, "introduction", "Preàmbul", "Introducció", None, 1)]
    assert segment.section_rows(p, drop_empty_intro=True).filter("document_id = 'b'").count() == 1
    text = {(r["document_id"], r["section_no"]): r["text"] for r in segment.section_text(p).collect()}
    assert text[("a", 6)] == "Barcelona, 3 de maig de 2020\nEl conseller" and text[("a", 2)] == "Text de l'article."


def test_page_blocks_and_attachments(spark):
    html = ('<html><body><input id="documentIdRequest" value="77"><div id="fullText"><h1>LLEI  1/2020</h1>intro <b>text</b><p>Article 1</p><p>Objecte de la llei</p><p>Cos</p>'
            '<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table><pre>un\n\ndos</pre><p>Primer. Punt</p><p>Barcelona, 3 de maig de 2020</p><p>Capítol I</p><img src="s.png" alt="x"><p>Annex 1</p><p>fi &amp; prou</p></div></body></html>')
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    p = segment.page_paragraphs(segment.page_blocks(df))
    rows = [tuple(r) for r in segment.page_sections(p).select("section_no", "type", "title", "heading", "n_paras").orderBy("section_no").collect()]
    assert rows == [(0, "introduction", "Preamble", None, 1), (1, "article", "Article 1", "Objecte de la llei", 4), (2, "article", "Primer", "Punt", 0),
                    (3, "signature", "Signatures", None, 3), (4, "annex", "Annex 1", None, 1)]
    att = segment.page_attachments(p).orderBy("attachment_id").collect()
    assert att[0]["content_text"] == "| a | b |\n| --- | --- |\n| c |  |" and att[0]["section_title"] == "Article 1"
    assert att[1]["content_image"]["src"] == "s.png" and att[1]["section_title"] == "Signatures"
    f = segment.page_fields(df).first()
    assert f["document_id"] == "77" and f["title"] == "LLEI 1/2020"


def test_offset_sections_tile_the_text(spark):
    text = "lead\nArticle 1. Un\ncos\n\n  Annex 2\nBarcelona,\n 3 de 2020 fi"
    got = segment.offset_sections(spark.createDataFrame([(1, text), (2, " "), (3, "cap")], "doc_id bigint, text string")).orderBy("doc_id", "section_no").collect()
    assert [(r["type"], r["start_offset"], r["end_offset"]) for r in got if r["doc_id"] == 1] == [
        ("body", 0, 5), ("article", 5, text.index("Annex")), ("annex", text.index("Annex"), text.index("Barcelona")), ("signature", text.index("Barcelona"), len(text))]
    assert [(r["type"], r["end_offset"]) for r in got if r["doc_id"] != 1] == [("body", 0), ("body", 3)]


def test_texts_are_searched_once_and_spread(spark):
    """No text or pattern is left in the plan behind the one search, which runs on all cores however few splits the input has."""
    text = F.concat(F.lit("Article 1. Objecte\n"), F.col("id").cast("string"), F.lit("\nAnnex 2"))
    docs = spark.range(40).coalesce(1).select(F.col("id").alias("doc_id"), text.alias("text"))
    out = segment.offset_sections(docs)
    assert out.count() == 80 and "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()
    one = docs.withColumns({"title": F.lit("LLEI de mesures"), "number": F.lit("1/2000")})
    assert "repartition_by_num" in segment.isolate(one)._jdf.queryExecution().executedPlan().toString().lower()


def test_isolate_picks_the_best_window(spark):
    text = "altres 5/2020 res " + "x" * 900 + " LLEI de mesures fiscals 5/2020 " + "y" * 900 + "\nDECRETO 9/2020"
    r = segment.isolate(spark.createDataFrame([(1, text, "LLEI de mesures fiscals", "05/2020")], "doc_id bigint, text string, title string, number string")).first()
    assert text[r["start_offset"] + 100:].startswith("5/2020 y") and text[r["end_offset"]:] == "\nDECRETO 9/2020"


def test_article_lists_split_inside_words(spark):
    one = lambda s, faithful=True: spark.createDataFrame([(s,)], "t string").select(cite.affected_sections("t", faithful).alias("a")).first()["a"]
    assert one("Modifica els articles 631-22, 631-23 i 631-24 de la Llei") == ["Article 631-22", "Article 631-23", "Article 631-24"]
    assert one("article primer de la llei") == ["Article Primer"]  # the fallback pattern finds what the list split breaks
    assert one("l'article 5 de la Llei i l'annex 2, disposició final") == ["Article 5", "Annex 2", "Disposicio Final"]
    assert one("annex taules") == ["Annex"]  # an empty number is tried before a word
    assert one("articles 3 i 4 de la llei", False) == ["Article 3", "Article 4"]


def test_titles_and_types(spark):
    df = spark.createDataFrame([("decreto x",), ("RESOLUCIó de 3",), ("CONFLICTE DE JURISDICCIÓ, entre",), ("cap majúscula",), (" ",)], "t string")
    assert [r[0] for r in df.select(doctype.type_from_title("t")).collect()] == ["DECRETO", "RESOLUCIÓ", "CONFLICTE DE JURISDICCIÓ", "Other", "Unknown"]
    assert df.select(tx.title_key("t")).first()[0] == "o x"  # 'decret' goes without a word boundary
    assert [r[0] for r in df.select(doctype.type_from_text("t")).collect()][:2] == ["Decret", "Resolució"]


def test_untagged_reference_context(spark):
    b = spark.createDataFrame([("L", 1, "Art", "según el art. 5 de la Ley 3/1999 y la Ley Orgánica 4/2000")], "law_id string, block_no int, name string, text string")
    idx = spark.createDataFrame([("ley 3/1999", "A"), ("ley orgánica 4/2000", "B")], "signature string, target_id string")
    none = spark.createDataFrame([], "citing_law string, block_no int, cited_law string")
    got = {r["cited_law"]: (r["cited_article"], r["context"]) for r in cite.untagged_citations(b, idx, none).collect()}
    assert got == {"A": ("5", "Ley 3/1999"), "B": ("Todo", "Ley Orgánica 4/2000")}


def test_span_patterns_compile():
    for _, p in rules.SPAN_HEADERS:
        re.compile(p, re.IGNORECASE)


def test_own_rule_sets(spark):

    df = spark.createDataFrame([(1, 0, "Teil I Vorwort"), (1, 1, "§ 5. Zweck"), (1, 2, "Text"), (1, 3, "Article 7. Altra")], "document_id int, ord int, text string")
    own = {**segment.header_patterns(), "article": r"^(§)\s*(\d+)\.?\s*(.*)$"}
    rows = segment.section_paragraphs(df, patterns=own).orderBy("ord").collect()
    assert [(r["section_no"], r["kind"], r["heading"]) for r in rows] == [(0, None, None), (1, "article", "Zweck"), (1, None, None), (1, None, None)]
    t = spark.createDataFrame([("Verordnung über Wasser",), ("LLEI 3/2000",)], "t string")
    assert [r[0] for r in t.select(doctype.type_from_title("t", ["verordnung"])).collect()] == ["VERORDNUNG", "LLEI"]
    assert [r[0] for r in t.select(doctype.type_from_text("t", [("Wasser", "W")])).collect()] == ["W", None]


def test_isolate_searches_a_text_once_for_its_number(spark):
    one = spark.createDataFrame([(1, "x", "LLEI de taxes", "5/2020")], "doc_id bigint, text string, title string, number string")
    # the words of the title and the headers are extracted; the places of the number come from one split
    assert segment.isolate(one)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 2
    text = "LLEI 15/2020 i 5/20201\n" + "a" * 900 + "LLEI 5/2020 de taxes" + "b" * 900 + "\n\n # decreto x"
    at = spark.createDataFrame([(1, text, "LLEI de taxes", "05/2020"), (3, "", "", "5/2020"), (4, None, None, None)], "doc_id bigint, text string, title string, number string")
    place = text.index(" 5/2020 de") + 1
    assert sorted(map(tuple, segment.isolate(at).collect())) == [(1, place - 100, text.index("\n\n #")), (3, 0, 0), (4, 0, 0)]
