"""Matching operators against plain-Python brute force on small fixtures."""

import random
import re

from pyspark.sql import functions as F

from lexloom.operators import dedupe, match


def _has(words, part):
    return f" {part} " in f" {words} "


def test_align_citations_is_the_sequential_greedy(spark):
    rnd = random.Random(1)
    title = lambda: rnd.choice(["Llei", "Decret"]) + f" {rnd.randint(1, 4)}/200{rnd.randint(0, 1)}" + rnd.choice(["", " de pressupostos", " i altres"])
    # node 0 holds most rows
    g = [(0 if i % 3 else i, i, title()) for i in range(60)]
    f = [(0 if i % 3 else i, i, title() if i % 5 else "sense número") for i in range(80)]
    nums = lambda s: set(re.findall(r"\b\d+/\d{4}\b", s))
    want = set()
    for node in {n for n, _, _ in g}:
        used = set()
        for _, go, gt in sorted(x for x in g if x[0] == node):
            for _, fo, ft in sorted(x for x in f if x[0] == node):
                if fo not in used and (nums(gt) & nums(ft) or _has(gt.lower(), ft.lower()) or _has(ft.lower(), gt.lower())):
                    used.add(fo)
                    want.add((node, go, fo))
                    break
    sch = "node_id bigint, ord bigint, title string"
    out = match.align_citations(spark.createDataFrame(g, sch), spark.createDataFrame(f, sch), block=4).collect()
    assert {(r["node_id"], r["g_ord"], r["f_ord"]) for r in out if r["status"] == "match"} == want
    assert sum(r["status"] == "missing" for r in out) == len(g) - len(want) and sum(r["status"] == "extra" for r in out) == len(f) - len(want)


def test_align_citations_in_tasks_and_in_rounds(spark, monkeypatch):
    """Nodes over and under the limit of a task, repeated and unordered rows, titles without a node or a text."""
    rnd = random.Random(3)
    title = lambda: rnd.choice([None, "", "Llei 1/2001", "la llei  1/2001 de taxes", "Decret 2/2001", "Decret 2/2001 bis", "Decret", "llei 11/2001"])
    side = lambda n: [(rnd.choice([0, 0, 0, 1, 2, 3, None]), i, title()) for i in range(n)]
    g, f = side(90), side(110)
    sch = "node_id bigint, ord bigint, title string"
    run = lambda: sorted(map(str, match.align_citations(spark.createDataFrame(g + g[:5], sch), spark.createDataFrame(f + f[:5], sch)).collect()))
    got = []
    for most in (1 << 20, 60, 0):
        monkeypatch.setattr(match, "TOGETHER", most)
        got.append(run())
    assert got[0] == got[1] == got[2] and len({x.split("status=")[1].split(",")[0] for x in got[0]}) == 3


def test_align_citations_makes_no_keys_of_small_nodes(spark):
    """A long title used to travel once for each run of its words; now every title does once."""
    sch = "node_id bigint, ord bigint, title string"
    long = " ".join(f"paraula{i}" for i in range(60))
    out = match.align_citations(spark.createDataFrame([(1, 1, long)], sch), spark.createDataFrame([(1, 1, "paraula7 paraula8")], sch))
    assert [(r["status"], r["g_ord"], r["f_ord"]) for r in out.collect()] == [("match", 1, 1)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def _alike(a, b):
    """The similarity rule over word sets, written apart from the operator."""
    left, right = set(a.split()), set(b.split())
    tests = [min(len(a), len(b)) >= 15 and (a in b or b in a)]
    if left and right:
        tests += [100 * len(left & right) >= 82 * max(len(left), len(right)), len([w for w in left & right if len(w) > 4]) > 1]
    return any(tests)


def test_clusters_end_without_a_phase(spark):
    rows = [(1, None, i, f"aprovacio definitiva numero{i % 3}") for i in range(6)] + [(1, "", 6, "aprovacio definitiva"), (None, "a", 7, "aprovacio definitiva"), (1, None, 8, None)]
    df = spark.createDataFrame(rows, "record_id int, fase string, ingest_ord bigint, descripcio string")
    got = {r["ingest_ord"]: r["cluster"] for r in dedupe.cluster_publications(df, ["record_id", "fase"], "descripcio").collect()}
    assert got == {**{i: 0 for i in range(7)}, 7: 7, 8: 8}


def test_cluster_publications_is_the_sequential_greedy(spark):
    rnd = random.Random(2)
    words = ["aprovacio", "definitiva", "ordenanca", "fiscal", "anunci", "lot", "nota", "bis", "taxa"]
    rows = [(0 if i % 3 else i % 4, "f", i, " ".join(rnd.sample(words, rnd.randint(0, 4)))) for i in range(150)]
    want = {}
    for rec in {r[0] for r in rows}:
        reps = []
        for _, _, o, d in sorted((r for r in rows if r[0] == rec), key=lambda r: r[2]):
            key = re.sub(r"^\s+|\s+$", "", d)
            for p in ("ordre", "orden", "anunci", "anuncio"):
                key = key[len(p):].strip() if key.startswith(p) else key
            rep = next((ro for rt, ro in reps if _alike(key, rt)), None)
            if rep is None:
                reps.append((key, o))
                rep = o
            want[o] = rep
    df = spark.createDataFrame(rows, "record_id int, fase string, ingest_ord bigint, descripcio string")
    got = {r["ingest_ord"]: r["cluster"] for r in dedupe.cluster_publications(df, ["record_id", "fase"], "descripcio").collect()}
    assert got == want


def test_ten_thousand_clusters_in_one_group(spark, monkeypatch):
    """Every description shares words with all, and its two long ones with one other: rounds and pairs don't follow the clusters."""
    n = 10_000
    name = lambda i: f"expedient{i:05d}"
    rows = [(1, "f", i, f"acte {i % n} de la taxa {name(i % n)} anunciada") for i in range(2 * n)]
    df = spark.createDataFrame(rows, "record_id int, fase string, ingest_ord bigint, descripcio string")
    d = df.select(F.struct("record_id").alias("_g"), F.col("ingest_ord").alias("_o"), F.regexp_replace("descripcio", "acte", "acta").alias("_t")).filter(F.col("_o") < n)
    assert dedupe.alike_by_words(d).count() < 10 * n
    rounds, cut = [], dedupe.cut
    monkeypatch.setattr(dedupe, "cut", lambda x: rounds.append(1) or cut(x))
    got = {r["ingest_ord"]: r["cluster"] for r in dedupe.cluster_publications(df.withColumn("descripcio", F.when(F.col("ingest_ord") >= n, F.concat("descripcio", F.lit(" bis"))).otherwise(F.col("descripcio"))), ["record_id", "fase"], "descripcio").collect()}
    assert got == {i: i % n for i in range(2 * n)} and len(rounds) < 20


def test_similarity_column_agrees_with_python(spark):
    rnd = random.Random(3)
    words = ["alfa", "beta", "gamma", "deltas", "epsilon", "zeta"]
    pairs = [(" ".join(rnd.sample(words, rnd.randint(0, 5))), " ".join(rnd.sample(words, rnd.randint(0, 5)))) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("s", dedupe.similar(F.col("a"), F.col("b")))
    assert all(r["s"] == _alike(r["a"], r["b"]) for r in df.collect())


def test_issue_match_strategies(spark):
    docs = spark.createDataFrame([
        ("9", 1, 0, "ANUNCI de licitacio d'obres municipals", "Ajuntament de Vic", "", "obres municipals de clavegueram"),
        ("9", 2, 1, "EDICTE sobre taxes", "Ajuntament de Reus", "CVE-DOGC-A-123-2020", "taxes de residus"),
        ("8", 3, 2, "ANUNCI de licitacio d'obres municipals", "Ajuntament de Vic", "", "")], "issue string, document_id int, ord int, title string, organisme string, cve string, text string")
    t = spark.createDataFrame([
        (1, "9", "Butlletí. Anunci de licitació: de licitacio d'obres municipals, fi", "", ""), (2, "9", "", "Edicte sobre taxes del municipi", ""),
        (3, "9", "codi CVE-DOGC-A-123-2020", "zzz", ""), (6, "9", "", "res", ""), (7, "9", "", "Reforma del clavegueram", "Ajuntament de Vic i comarca"), (4, "9", "zzz", "Reforma del clavegueram", "Ajuntament de Vic"), (5, "7", "sobre taxes", "sobre taxes", "")],
        "target_id int, issue string, text string, record_title string, institucio string")
    got = {r["target_id"]: (r["matched_id"], r["strategy"]) for r in match.issue_match(t, docs).collect()}
    # containment is by substring: 'res' is in 'obres'
    assert got == {1: (1, 1), 2: (2, 2), 3: (2, 3), 4: (1, 4), 6: (1, 2), 7: (1, 4)}


def test_entities_by_any_part_of_a_title(spark):
    docs = spark.createDataFrame([(1, 0, "Ordre de pesca fluvial"), (2, 1, "Llei de pressupostos generals"), (3, 2, "Llei de pressupostos generals"), (4, 3, "pesca"), (5, 4, "")], "document_id int, ingest_ord int, title string")
    docs = docs.withColumns({c: F.lit("") for c in ("document_number", "dogc_number", "eli_uri")})
    cited = ["pesca fluvia", "re de pesca flu", "la Llei de pressupostos generals de 2020", "lei de pressupostos gener", "pesca", "reglament de pescadors", "un altre text"]
    items = spark.createDataFrame([(i, 0, t) for i, t in enumerate(cited)], "source_id int, item_no int, cited_title string").withColumns({c: F.lit("") for c in ("document_number", "dogc_number", "eli_uri")})
    got = {r["source_id"]: (r["document_id"], r["match_reason"]) for r in match.resolve_entities(items, docs).collect()}
    # titles that start or end inside a word count, as do those that the cited text holds; of equal titles the last document
    assert got == {0: (1, "substring"), 1: (1, "substring"), 2: (3, "substring"), 3: (3, "substring"), 4: (4, "title"), 5: (4, "substring"), 6: (None, None)}


def _edges(spark, affs, docs, secs):
    a = spark.createDataFrame(affs, "document_id int, ord int, direction string, target_document_id int, text string")
    d = spark.createDataFrame(docs, "document_id int, document_number string, title string")
    s = spark.createDataFrame(secs, "document_id int, section_no int, title string, heading string, text string")
    return {(r["aff_id"], r["type"], r["source_section"], r["target_section"], r["mapped_section"]) for r in match.affectation_edges(a, d, s).collect()}


def test_affectation_edges(spark):
    docs = [(1, "3/1985", "LLEI 3/1985"), (2, "7/2000", "DECRET 7/2000")]
    secs = [(1, 0, "Preàmbul", "", "exposa"), (1, 1, "Article 5", "", "Es modifica l'article 2 del Decret 7/2000; i altres. Annex 3 del Decret 7/2000"), (1, 2, "Article 6", "", "Decret 17/2000"),
            (2, 0, "Article 2", "", "res"), (2, 1, "Annex 3", "", "taula")]
    active = _edges(spark, [(1, 0, "active", 2, "Modifica l'article 2 del Decret 7/2000")], docs, secs)
    assert active == {("1:active:0", "MODIFIES", 1, 0, "Article 2"), ("1:active:0", "MODIFIES", 1, 1, "Annex 3")}
    # passive: sections of the other document are scored under the own number; none reaches 10
    assert _edges(spark, [(2, 0, "passive", 1, "Afectat per la Llei 3/1985")], docs, secs) == {("2:passive:0", "AFFECTS", 1, 0, "Article 2"), ("2:passive:0", "AFFECTS", 1, 1, "Annex 3")}
    assert _edges(spark, [(2, 0, "active", 9, "Deroga l'acord")], docs, secs) == {("2:active:0", "ABROGATES", None, None, "")}


def test_best_section_prefers_title_then_order(spark):
    secs = spark.createDataFrame([(1, 0, "Signatures 7/2000", "", ""), (1, 1, "A 7/2000", "", "12"), (1, 2, "B", "7/2000", "12 i 13"), (1, 3, "C", "", "17/20001")], "document_id int, section_no int, title string, heading string, text string")
    affs = spark.createDataFrame([("x", 1, "Decret 7/2000", []), ("y", 1, "Decret 7/2000", ["Article 12", "Article 13"]), ("z", 1, "Decret 9/2000", []), ("w", 1, None, ["Article 13"])], "aff_id string, acting_doc int, doc_ref string, affected array<string>")
    assert {r["aff_id"]: (r["section_no"], r["score"]) for r in match.best_source_section(affs, secs).collect()} == {"x": (1, 40), "y": (2, 60), "w": (2, 15)}


def test_sections_keep_the_tokens_that_links_look_for(spark):
    text = "vist el Decret 17/20001 i la Llei 123/1999, articles 4 i 5"
    secs = spark.createDataFrame([(d, n, "", "", text) for d in (1, 2) for n in range(3)], "document_id int, section_no int, title string, heading string, text string")
    want = spark.createDataFrame([(1, "R:7/2000"), (1, "D:5"), (1, "D:77"), (2, "R:llei 123/1999"), (2, "R:la llei")], "doc int, token string")
    found = {(1, "R:7/2000", 15), (1, "D:5", 15)}
    for most, more in ((256, False), (1, True)):
        out = {tuple(r) for r in match.section_tokens(secs, want, most=most).filter("doc = 1").drop("section_no").distinct().collect()}
        assert found <= out and (len(out) > len(found)) == more


def test_candidate_targets_scores(spark):
    docs = spark.createDataFrame([(1, 0, "5/2020", "9001", "Llei 5/2020 de pressupostos generals", "01/02/2020"), (2, 1, "5/2020", "9002", "Decret 5/2020 de residus", "01/02/2019"), (3, 2, "8/1999", "9003", "Ordre de pesca fluvial", "")],
                                 "document_id int, ingest_ord int, document_number string, dogc_number string, title string, date_dogc string")
    texts = spark.createDataFrame([(1, "segons la llei 5/2020 de pressupostos generals"), (2, "publicat al DOGC nº 9003 sobre pesca"), (3, "vist el número 9002 de 2019"), (4, "cap")], "text_id int, text string")
    got = {}
    for r in match.candidate_targets(texts, docs, k=2).collect():
        got.setdefault(r["text_id"], []).append((r["rank"], r["document_id"], r["score"]))
    # number 100, two shared words 10, whole title 50, year 5
    assert sorted(got[1]) == [(1, 1, 165), (2, 2, 100)]
    assert sorted(got[2]) == [(1, 3, 95)] and sorted(got[3]) == [(1, 2, 65)] and 4 not in got


def test_a_number_on_very_many_titles(spark):
    """100,000 titles under one number: few pairs are read, and the best are those of reading all."""
    rnd = random.Random(11)
    topics = [f"tema{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(676)]
    rows = [(i, i, "5/2020", str(9000 + i % 7), f"Llei de {rnd.choice(topics)} general {rnd.choice(topics)} publica{'' if i % 2 else ' reformada'} lot {i}", f"01/02/{2000 + i % 3}") for i in range(100_000)]
    docs = spark.createDataFrame(rows, "document_id int, ingest_ord int, document_number string, dogc_number string, title string, date_dogc string")
    texts = spark.createDataFrame([(0, f"segons la llei 5/2020 de {topics[3]} i {topics[9]} general"), (1, "la llei 5/2020 reformada, DOGC nº 9003, de 2001"), (2, "vist el 5/2020"), (3, f"{rows[4321][4]} (5/2020)")], "text_id int, text string")
    seen = {}
    read, match_pairs = [], match.candidate_pairs
    for hot in (1 << 40, 1000):
        def pairs(sigs, index, k, hot=hot):
            out = match_pairs(sigs, index, k, hot)
            read.append(out.count())
            return out
        match.candidate_pairs = pairs
        try:
            seen[hot] = sorted(map(tuple, match.candidate_targets(texts, docs, k=15).collect()))
        finally:
            match.candidate_pairs = match_pairs
    assert seen[1000] == seen[1 << 40] and len(seen[1000]) == 60
    assert read[0] >= 400_000 and read[1] < read[0] / 20


def test_texts_that_ask_the_same_share_a_scoring(spark, monkeypatch):
    """Words that no candidate has tell texts apart, but not what is asked of a number."""
    docs = spark.createDataFrame([(i, i, f"{i % 3}/2020", str(9000 + i), f"Llei de pesca {'fluvial' if i % 2 else 'marina'}", "01/02/2020") for i in range(12)],
                                 "document_id int, ingest_ord int, document_number string, dogc_number string, title string, date_dogc string")
    texts = spark.createDataFrame([(i, f"paraula{chr(97 + i)} {'fluvial' if i % 2 else 'cap'} 1/2020 i 2/2020") for i in range(20)], "text_id int, text string")
    asked, match_pairs = [], match.candidate_pairs
    monkeypatch.setattr(match, "candidate_pairs", lambda sigs, *rest: asked.append(sigs.count()) or match_pairs(sigs, *rest))
    got = {}
    for r in match.candidate_targets(texts, docs, k=3).collect():
        got.setdefault(r["text_id"], []).append((r["rank"], r["document_id"], r["score"]))
    assert asked == [4] and len(got) == 20
    # number 100, year 5, and 5 for the word
    assert sorted(got[0]) == [(1, 1, 105), (2, 2, 105), (3, 4, 105)] and sorted(got[1]) == [(1, 1, 110), (2, 5, 110), (3, 7, 110)]


def test_links_are_read_once_for_their_sections(spark):
    """What a link's text says is found once, not again by each join that needs it."""
    affs = spark.createDataFrame([(1, 0, "active", 2, "Deroga l'article 3 de la Llei 5/2020"), (1, 1, "passive", 2, "Modifica l'article 1")], "document_id int, ord int, direction string, target_document_id int, text string")
    secs = spark.createDataFrame([(1, 0, "Article 3", "", "de la Llei 15/20201 i 5/202"), (1, 1, "Article 1", "", "vist 25/2020"), (2, 0, "Article 1", "", "segons 7/1999")], "document_id int, section_no int, title string, heading string, text string")
    docs = spark.createDataFrame([(1, "7/1999", "Llei 7/1999"), (2, "5/2020", "Llei 5/2020")], "document_id int, document_number string, title string")
    a = match.cite.classify_affectations(affs).select("ord", "document_id", "doc_ref", "affected").toDF("aff_id", "acting_doc", "doc_ref", "affected")
    best = match.best_source_section(a, secs)
    assert "de la Llei" not in best._jdf.queryExecution().optimizedPlan().toString() and "regexp_extract" not in best._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    # the number stands in '15/20201'; the article's own number is in the title
    assert sorted(map(tuple, best.collect())) == [(0, 0, 30), (1, 1, 15)]
    edges = {(r["aff_id"], r["acting_doc"], r["source_section"], r["affected_doc"], r["target_section"], r["mapped_section"]) for r in match.affectation_edges(affs, docs, secs).collect()}
    assert {e[:4] for e in edges} == {("1:active:0", 1, 0, 2), ("1:passive:1", 2, 0, 1)}


def test_issue_keys_are_made_once(spark):
    docs = spark.createDataFrame([("9", 1, 0, "ANUNCI de licitacio d'obres", "Ajuntament de Vic", "", "obres")], "issue string, document_id int, ord int, title string, organisme string, cve string, text string")
    t = spark.createDataFrame([(1, "9", "Anunci de licitacio d'obres", "", "")], "target_id int, issue string, text string, record_title string, institucio string")
    assert "regexp_replace" not in match.issue_match(t, docs)._jdf.queryExecution().optimizedPlan().toString()


def test_catalogue_merge(spark):
    feed = spark.createDataFrame([("u1", "Llei", "2000", "10", "LLEI 1", 0), ("u1", "Decret", "2001", "", "", 1), (None, "x", "", "", "", 2)], "url string, type string, year string, dogc_number string, title string, ingest_ord int")
    manual = spark.createDataFrame([("u1",), ("u2",)], "url string")
    docs = spark.createDataFrame([(7, 0, "10", "LLEI 1.", "LLEI", 2000, "S", "O"), (8, 1, "10", "ALTRA", "ACORD", 2000, "S", "O")], "document_id int, ingest_ord int, dogc_number string, title string, type string, year int, section string, organisme string")
    got = {r["catalogue_key"]: (r["url"], r["type"], r["organisme"]) for r in match.merge_catalogue(feed, manual, docs).collect()}
    assert got == {"7": ("u1", "Llei", "O"), "8": (None, "ACORD", "O"), "url_u2": ("u2", "Unknown", "Unknown Organisme")}


def test_item_candidates_in_a_busy_gazette(spark):
    """A gazette with many documents: as a plain ranking of all of them, and few rows travel for a citation."""
    docs = [(i, i, ["LLEI", "DECRET", None][i % 3], f"{i % 50 + 1}/{2000 + i % 2}", "g1" if i % 4 else "g2", f"x {i % 7 + 1}/2001, de coses", f"01/01/{2000 + i % 2}") for i in range(400)]
    docs += [docs[5], docs[9]]  # repeated rows stand once
    items = [(n, 1, num, gaz, typ, year) for n, (num, gaz, typ, year) in enumerate(
        (num, gaz, typ, year) for num in ("3/2001", "8/2000", "9/9", "", None) for gaz in ("g1", "g2", "", "none") for typ in ("llei", "", "Decret") for year in ("2001", "1900", None))]
    d = spark.createDataFrame(docs, "document_id long, ingest_ord long, type string, document_number string, dogc_number string, title string, date_dogc string")
    i = spark.createDataFrame(items, "source_id long, item_no int, document_number string, dogc_number string, doc_type string, year string")
    want = set()
    for n, no, num, gaz, typ, year in items:
        num, gaz, typ, year = num or "", gaz or "", (typ or "").lower(), year if year in ("2000", "2001") else ""
        scored = set()
        for doc, o, t, own, issue, title, date in docs:
            pts = 100 if num and num == own else 80 if num and num in re.findall(r"\d+/\d{4}", title) else 0
            at = 90 if gaz and gaz == issue else 0
            if (pts or at) and (not year or year in re.findall(r"\d{4}", f"{date} {title} {own}")):
                scored.add((-(pts + at + (30 if typ and typ in (t or "").lower() else 0)), o, doc))
        want |= {(n, no, r, doc, -s) for r, (s, o, doc) in enumerate(sorted(scored)[:10], 1)}
    got = match.candidates_for_items(i, d)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_sections_of_equal_citations_are_looked_up_once(spark):
    docs = spark.createDataFrame([(i, i, "LLEI", "7/2001", "", f"Llei {i}", "01/01/2001") for i in range(4)], "document_id long, ingest_ord long, type string, document_number string, dogc_number string, title string, date_dogc string")
    secs = spark.createDataFrame([(i, o, f"{i}_{o}", f"Article {o}") for i in range(4) for o in (1, 2, 3)], "document_id long, ord int, section_id string, title string")
    rows = [(s, n, "7/2001", "", "llei", "2001", "Article 2" if n % 2 else None) for s in range(5) for n in range(4)] + [(None, 0, "7/2001", "", "llei", "2001", "Article 2")]
    items = spark.createDataFrame(rows, "source_id long, item_no int, document_number string, dogc_number string, doc_type string, year string, article_or_section string")
    cited, asked = ["document_number", "dogc_number", "doc_type", "year", "article_or_section"], []

    def found(q):
        asked.append(q.count())
        return match.candidate_sections(match.candidates_for_items(q, docs, keys=cited), q, secs, limit=5, keys=cited)
    plain = match.candidate_sections(match.candidates_for_items(items, docs), items, secs, limit=5)
    got = match.shared(items, cited, ["source_id", "item_no"], found)
    assert got.columns == plain.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()))
    assert asked == [2] and got.count() == 100
