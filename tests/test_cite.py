"""Citations in two languages."""

import re

from pyspark.sql import functions as F

from lexloom import rules
from lexloom.operators import cite, match, segment

PARAS = "document_id bigint, section_no bigint, ord bigint, kind string, content boolean, heading string, text string"


def test_both_languages_cite_once(spark):
    docs = spark.createDataFrame([(9, 0, "LLEI 5/1999 (LEY 5/1999), de mesures", "5/1999", "LLEI"), (8, 1, "LLEI 6/1999", "6/1999", "LLEI")], "document_id bigint, ingest_ord bigint, title string, document_number string, type string")
    first = spark.createDataFrame([(1, 1, 0, None, True, None, "D'acord amb la Llei 5/1999, de mesures")], PARAS)
    second = spark.createDataFrame([(1, 1, 0, None, True, None, "De acuerdo con la Ley 5/1999 y la Ley 77/2001")], PARAS)
    rows = lambda **more: sorted((r["target_id"] or 0, r["cited"], r["is_mapped"]) for r in cite.extract_citations(first, docs, **more).collect())
    assert rows() == [(9, "llei 5/1999", True)] or rows() == [(9, "Llei 5/1999", True)]
    both = rows(other=second)
    assert [t for t, _, _ in both].count(9) == 1 and any("77/2001" in c for _, c, _ in both) and len(both) == 2


def test_patterns_leave_places_without_a_first_letter(spark):
    """Each search starts with a look at what a hit must begin with, and finds what it found without it."""
    texts = ["D'acord amb l'article 5 de la Llei 3/1999", "vist el Reial decret 17/1977, artículos 3, 4 i 5 bis", "ANNEX 2; disposició final", "xllei 5/1999", "DECRET\n\t4/2001 i ordre\u00a0ENS/5/2010", "Llei", "", "\u017fart 5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name in ("CITED_REF", "DOC_REF", "ARTICLE_LIST", "ARTICLE_SINGLE", "ANNEX_MENTION", "DISPOSITION_MENTION"):
        pattern = getattr(rules, name)
        ahead = re.match(r"\(\?i?U\)(\(\?=[^)]*\))\\b", pattern)
        assert ahead, name
        old = pattern.replace(ahead[1], "", 1)
        assert all(r[0] == r[1] for r in df.select(F.regexp_extract_all("t", F.lit(pattern), F.lit(0)), F.regexp_extract_all("t", F.lit(old), F.lit(0))).collect())


def test_references_fall_apart_at_the_last_gap(spark):
    texts = ["Reial  decret 3/1999 i REIAL DECRET\n17/1977; decret  llei 5/2001", "ordre\u00a0ENS/5/2010", "sense res"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pair = lambda n: F.regexp_extract_all("t", F.lit(rules.CITED_REF), F.lit(n))
    for r in df.select(cite._refs(F.col("t")).alias("x"), pair(1).alias("a"), pair(2).alias("b")).collect():
        assert set((x["t"], x["v"]) for x in r["x"]) <= set(zip(r["a"], r["b"])) and len(r["x"]) >= sum(bool(re.match(r"\d+/\d", v)) for v in r["b"])


def test_signatures_keep_sixty_characters_before_them(spark):
    far = "el art. 3 de la " + "x" * 70 + "el artículo 8 de la "
    blocks = spark.createDataFrame([(1, 0, "b", far + "Ley 5/1999 y art. 2 del Real  Decreto 6/2000.\nxLey 7/2001")], "law_id long, block_no int, name string, text string")
    index = spark.createDataFrame([("ley 5/1999", "A"), ("real decreto 6/2000", "B"), ("ley 7/2001", "C")], "signature string, target_id string")
    none = spark.createDataFrame([], "citing_law long, block_no int, cited_law string")
    found = cite.untagged_citations(blocks, index, none)
    assert sorted((r["cited_law"], r["cited_article"], r["context"]) for r in found.collect()) == [("A", "8", "Ley 5/1999"), ("B", "2", "Real  Decreto 6/2000")]
    assert ".{0,60}" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_long_documents_are_counted_before_texts_are_read(spark):
    paras = spark.createDataFrame([(1, 0, " "), (1, 1, "Article 1. Objecte"), (1, 2, "text\u00a0 llarg"), (2, 1, None)], "document_id long, ord int, text string")
    rows = segment.section_paragraphs(paras)
    assert sorted((r["document_id"], r["ord"], r["section_no"], r["text"]) for r in rows.collect()) == [(1, 1, 1, "Article 1. Objecte"), (1, 2, 1, "text llarg")]
    counted = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().split("Aggregate [document_id")[1:]]
    assert counted and "regexp_replace" not in counted[0].split("Join")[0]


def test_citations_carry_the_number_of_their_source(spark):
    nodes = spark.createDataFrame([("d1", "t", "1/1999", "9")], "id string, title string, document_number string, dogc_number string")
    edges = spark.createDataFrame([("a", "d1", "CITES"), ("a", "d2", "MODIFIES"), ("b", "d1", "CITES"), ("b", "d1", "HAS_SECTION"), (None, "d1", "CITES")], "src string, dst string, type string")
    got = match.list_citations(nodes, edges, total="n").collect()
    assert sorted((r["src"], r["dst"], r["title"], r["n"]) for r in got) == [("a", "d1", "t", 2), ("a", "d2", "", 2), ("b", "d1", "t", 1)]


def test_section_names_are_read_once(spark):
    sections = spark.createDataFrame([(1, 1, "s1", "Article 1", "Objecte"), (1, 2, "s2", "Annex", "Article 1"), (1, 3, "s3", "Capítol 2", "art 2 bis")], "document_id long, ord int, section_id string, title string, heading string")
    items = spark.createDataFrame([(1, 1, 1, "article 1"), (1, 2, 1, "article 1 apartat 2"), (1, 3, 1, "Objecte"), (1, 4, 1, "art 2 bis"), (1, 5, 1, "art 2 bis final"), (1, 6, 1, "")], "source_id long, item_no int, document_id long, article_or_section string")
    found = match.match_section_prefix(items, sections)
    assert {r["item_no"]: r["section_id"] for r in found.collect()} == {1: "s1", 2: "s1", 3: "s1", 4: "s3", 5: None, 6: None}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2
