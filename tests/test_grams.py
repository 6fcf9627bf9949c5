"""The substring join against brute force, and how many places it looks at."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexloom.operators import grams, match


def pairs(spark, texts, titles, group=("g",)):
    t = spark.createDataFrame(texts, "g int, text string")
    n = spark.createDataFrame(titles, "g int, title string")
    named = grams.contained(t, n, "text", "title", group)
    named = named.join(t.withColumn("_tk", grams.key_of("text")).distinct(), [*group, "_tk"]).join(n.withColumn("_nk", grams.key_of("title")).distinct(), [*group, "_nk"])
    rows = [(r["g"] if group else 0, r["text"], r["title"]) for r in named.select(*group, "text", "title").collect()]
    return sorted(rows if group else set(rows))


def brute(texts, titles, grouped=True):
    return sorted({(g if grouped else 0, t, n) for g, t in texts for h, n in titles if t and n and (g == h and g is not None or not grouped) and n in t})


def sampled(texts, q, w):
    return sorted((int(i), int(h), int(p)) for part in grams.samples(texts, q, w) for i, h, p in zip(*part))


@settings(max_examples=200, deadline=None)
@given(st.text("abé😀", max_size=40), st.integers(1, 4), st.integers(1, 5), st.integers(0, 30), st.integers(0, 30))
def test_a_part_has_the_same_samples(text, q, w, a, n):
    part = text[a:a + n]
    found = sampled(["other", text, "", part, "x" * 20], q, w)
    assert {(h, p) for i, h, p in found if i == 1} == {(h, p) for _, h, p in sampled([text], q, w)}
    assert {(h, p + a) for i, h, p in found if i == 3} <= {(h, p) for i, h, p in found if i == 1}
    assert any(i == 3 for i, _, _ in found) == (len(part) >= q + w - 1)


def test_samples_in_steps(monkeypatch):
    texts = ["".join(random.Random(i).choices("abc", k=n)) for i, n in enumerate((1000, 3, 40, 17, 300))]
    whole = sampled(texts, 4, 5)
    monkeypatch.setattr(grams, "_STEP", 17)
    assert set(sampled(texts, 4, 5)) == set(whole)


@pytest.mark.parametrize("group", [("g",), ()])
def test_equals_brute_force(spark, group, monkeypatch):
    rnd = random.Random(7)
    monkeypatch.setattr(grams, "PIECE", 16)
    word = lambda n: "".join(rnd.choices("ab è", k=n))
    texts = [(i % 3, word(rnd.randint(0, 80))) for i in range(60)] + [(None, "abab"), (1, None), (2, ""), (0, "x" * 500 + "abcdefghijklmnop")]
    titles = [(i % 3, word(rnd.randint(0, 6))) for i in range(40)] + [(g, t[a:a + n]) for g, t in texts[:60] for a, n in [(rnd.randint(0, 60), rnd.randint(1, 40))]]
    titles += [(None, "ab"), (1, None), (0, "abcdefghijkl"), (0, "x" * 90), (1, texts[4][1] + "b"), (0, "x" * 500 + "ab")]
    assert pairs(spark, texts, titles, group) == brute(texts, titles, bool(group))
    assert pairs(spark, texts, [], group) == pairs(spark, [], titles, group) == []


@pytest.mark.parametrize("cold", [-1, 400, 1 << 22])
def test_groups_in_tasks_and_by_samples(spark, cold, monkeypatch):
    """Groups over and under the limit of a task, repeated rows, titles of every kind of length."""
    rnd = random.Random(11)
    monkeypatch.setattr(grams, "COLD", cold)
    word = lambda n: "".join(rnd.choices("abç 😀", k=n))
    texts = [(min(i % 9, 4), word(rnd.randint(1, 60))) for i in range(80)]
    titles = [(g, t[a:a + n]) for g, t in texts for a, n in [(rnd.randint(0, 30), rnd.randint(1, 30))]] + [(i % 6, word(rnd.randint(1, 12))) for i in range(40)]
    assert pairs(spark, texts + texts[:9], titles + titles[:9]) == sorted(set(brute(texts, titles)))
    t, n = spark.createDataFrame(texts, "g int, text string"), spark.createDataFrame(titles, "g int, title string")
    found = grams.contained(t, n, "text", "title", ["g"], either=True)
    key = lambda df, c, k: df.select("g", c, grams.key_of(c).alias(k)).distinct()
    got = sorted(tuple(r) for r in found.join(key(t, "text", "_tk"), ["g", "_tk"]).join(key(n, "title", "_nk"), ["g", "_nk"]).select("g", "text", "title").collect())
    assert got == sorted(set(brute(texts, titles)) | {(g, b, a) for g, a, b in brute(titles, texts)})


def test_small_groups_take_one_shuffle(spark):
    """Only pairs leave the task that a group's rows come to: neither samples nor places are shuffled."""
    t = spark.createDataFrame([(i % 3, f"es publica la llei {i}/2001 de residus") for i in range(30)], "g int, text string")
    n = spark.createDataFrame([(i % 3, f"llei {i}/2001 de residus") for i in range(30)], "g int, title string")
    found = grams.contained(t, n, "text", "title", ["g"])
    assert found.count() == 30
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0  # the rows lie where they were shuffled to


def test_hot_group_makes_no_pairs(spark):
    """One issue with 20,000 titles that begin and end alike: places looked at follow the texts, not texts x titles."""
    title = lambda i: f"resolucio de concessio de llicencia a l'expedient {i * 7919 % 100003:06d} del municipi de referencia"
    titles = spark.createDataFrame([(1, title(i)) for i in range(20_000)], "g int, _title string").withColumn("_nk", grams.key_of("_title"))
    texts = spark.createDataFrame([(1, f"es publica la {title(i * 40)} amb data {i}") for i in range(500)] + [(1, f"text {i} sense cap") for i in range(500)], "g int, _text string").withColumn("_tk", grams.key_of("_text"))
    places = grams.candidates(texts, titles, ["g"], *grams.TIERS[0][1:])
    assert 500 <= places.count() < 40_000
    found = grams.contained(texts, titles, "_text", "_title", ["g"]).join(texts, "_tk").join(titles, "_nk").select("_text", "_title").collect()
    assert len(found) == 500 and all(r["_title"] in r["_text"] for r in found)


def test_no_join_on_the_issue_alone(spark):
    entries = spark.createDataFrame([(1, "9", "anunci de licitacio d'obres")], "entry_id int, issue string, title string")
    docs = spark.createDataFrame([("9", 1, 0, "anunci de licitacio d'obres municipals")], "issue string, document_id int, ord int, title string")
    found = match.title_in_issue(entries, docs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert [r["matched_id"] for r in found.collect()] == [1] and not any("CartesianProduct" in j or "NestedLoop" in j or "Contains" in j for j in joins)
