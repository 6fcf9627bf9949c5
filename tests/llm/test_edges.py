"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import re
import zlib

import numpy as np
import plain
import pytest
from conftest import EDGE
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import base, chat, decontaminate, idcodec, langid, linededup, packing, simhash, suffixdedup, tokens, topk, urlfilter
from lexloom.session import scratch_path

PAIRS = [(r[0], r[1]) for r in EDGE]
key = lambda r: tuple((v is not None, v) for v in r)


def same(rows, want):
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_own_name(edge):
    assert base.own_name(edge, "leak") == "__leak" and base.own_name(edge, "x") == "_x"


def test_language_id(spark, edge, none):
    profile = langid.fit(edge.select("text", "lang"))
    want = plain.profiles([(r[1], r[2]) for r in EDGE])
    assert set(profile) == set(want) == {"en", "de", "fr"}
    out = langid.predict(edge, profile, "Lang_pred", "score")
    assert out.columns == [*edge.columns, "Lang_pred", "score"]
    found = sorted(((r["doc_id"], r["text"], r["Lang_pred"], round(r["score"], 9)) for r in out.collect()), key=key)
    expected = [(r[0], r[1], lang, round(score, 9)) for r in EDGE for lang, score in [plain.language(r[1], want)]]
    assert found == sorted(expected, key=key)
    assert langid.fit(none) == {} and langid.predict(none, profile).count() == 0
    assert {r["lang_pred"] for r in langid.predict(edge, {}).collect()} == {"und"}


def test_long_text_in_chunks(monkeypatch):
    text = "zwei Wörter und mehr, " * 400
    whole = langid.grams(text)
    monkeypatch.setattr(langid, "_CHUNK", 100)
    parts = langid.grams(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_line_dedup(edge, none):
    out = linededup.dedup(edge, n_lines="lines", n_removed="gone", n_runs="runs")
    assert out.columns == [*edge.columns, "lines", "gone", "runs"]
    want = plain.line_dedup(set(PAIRS))
    same([(r["doc_id"], r["lines"], r["gone"], r["text"]) for r in out.collect()], [(d, *(want[d, t] if t is not None else (0, 0, None))) for d, t in PAIRS])
    assert linededup.dedup(none).count() == 0
    assert linededup.dedup(edge.select(F.lit(1).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))).filter("text IS NULL").count() == len(EDGE)


def test_line_dedup_short_lines_in_runs(spark):
    rows = [(1, "x\nab\nan opening line that is long enough to count\ncd\ny"), (2, "ab\nan opening line that is long enough to count\ncd\nz\nab"), (3, "ab\ncd\nz")]
    out = linededup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    same(out.collect(), [(d, plain.line_dedup(rows)[d, t][2]) for d, t in rows])
    assert dict(map(tuple, out.collect())) == {1: rows[0][1], 2: "z\nab", 3: "ab\ncd\nz"}


def test_simhash(edge, none):
    same(simhash.groups(simhash.fingerprints(edge)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect(), plain.simhash_components(PAIRS))
    kept = simhash.survivors(edge)
    assert kept.columns == edge.columns
    components = plain.simhash_components(PAIRS)
    assert kept.count() == len({c for _, _, c in components})
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in components}
    assert simhash.survivors(none).count() == 0


def test_links_at_every_distance(spark):
    rng = np.random.default_rng(5)
    prints = []
    for x in rng.integers(-(1 << 63), (1 << 63) - 1, 40):
        for n in range(6):
            y = int(x) & (1 << 64) - 1
            for b in rng.choice(64, n, replace=False):
                y ^= 1 << int(b)
            prints.append(y - (1 << 64) if y >> 63 else y)
    prints = sorted(set(prints))
    for radius in (0, 1, 3, 5):
        want = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
        same(simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), radius).collect(), want)


@settings(max_examples=200, deadline=None)
@given(st.text("ab c", min_size=1, max_size=70), st.text("ab c", max_size=60))
def test_myers(item, text):
    assert decontaminate.myers(item, text)[0] == plain.distance(item, text)


def test_decontamination(spark, edge, none):
    items = [(1, "A line, of some LENGTH that several documents share -- word for word"), (2, "a line of sume length that several documentz share word for word"), (3, "one"), (4, None), (None, "other words of the second text"), (2, "a line of sume length that several documentz share word for word")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.find(edge, bench).collect()
    want = [(d, i, plain.distance(plain.words(t), plain.words(x))) for d, x in PAIRS for i, t in [items[0], items[1], items[2], items[4]] if x and plain.distance(plain.words(t), plain.words(x)) <= len(plain.words(t)) // 20]
    same([(r["doc_id"], r["item_id"], r["edits"]) for r in rows], want)
    assert {e for _, _, e in want} == {0, 2}
    kept = decontaminate.clean(edge, bench)
    assert kept.columns == edge.columns
    same([(r["doc_id"], r["text"]) for r in kept.collect()], [p for p in PAIRS if p[0] not in {d for d, _, _ in want}])
    assert decontaminate.clean(edge, bench.limit(0)).count() == len(EDGE) and decontaminate.clean(none, bench).count() == 0


def test_decontamination_of_short_items_and_solid_scripts(spark):
    items = [(1, "two words"), (2, "one"), (3, "..."), (4, "他说语言是交流的系统"), (5, "是"), (6, "ภาษา")]
    docs = [(1, "here two  Words stand"), (2, "no two-wordsmiths, someone"), (3, "人们。他说语言是交流的系统，很好"), (4, "One!"), (5, "语言是"), (6, "กภาษาข"), (7, ""), (8, None)]
    rows = decontaminate.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["edits"]) for r in rows) == [(1, 1, 0), (3, 4, 0), (3, 5, 0), (4, 2, 0), (5, 5, 0), (6, 6, 0)]
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in rows} == plain.leaks(docs, items)


def test_decontamination_in_passes(spark, edge, monkeypatch):
    bench = spark.createDataFrame([(i, f"other words of the {w} text") for i, w in enumerate(["second", "third", "fourth"])], "item_id long, text string")
    whole = decontaminate.find(edge, bench).collect()
    monkeypatch.setattr(decontaminate, "SLICE", 30)
    same(decontaminate.find(edge, bench).collect(), list(map(tuple, whole)))


def test_suffix_dedup(edge, none):
    out = suffixdedup.dedup(edge).select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")), F.size("spans"), F.sha2("kept", 256))
    same(out.collect(), plain.suffix_dedup(PAIRS))
    assert suffixdedup.dedup(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=130), min_size=1, max_size=8))
def test_suffix_classes(parts):
    data = np.frombuffer("".join(parts).encode() + bytes(70), np.uint8)
    at = np.arange(len(data) - 58)
    strings = [data[i:i + 50].tobytes() for i in at]
    order = {s: i for i, s in enumerate(sorted(set(strings)))}
    assert suffixdedup.suffix_classes(data, at).tolist() == [order[s] for s in strings]


def test_suffix_dedup_over_many_batches(spark, monkeypatch):
    rng = np.random.default_rng(3)
    passages = ["".join(rng.choice(list("abcdefgh "), 120)) for _ in range(6)]
    rows = [(int(rng.integers(0, 60)), "".join(p if rng.random() < 0.4 else "".join(rng.choice(list("abcdefgh "), 40)) for p in rng.permutation(passages))) for _ in range(60)]
    monkeypatch.setattr(suffixdedup, "BATCH", 2000)
    out = suffixdedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")), F.size("spans"), F.sha2("kept", 256))
    same(out.collect(), plain.suffix_dedup(rows))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab .,\n\t'1é_-\r\u00a0\x01\x1c")), max_size=25), max_size=6))
def test_encoder(texts):
    ids, at = tokens.encoder(tokens.default_path()).encode(texts)
    for i, want in enumerate(plain.token_ids(texts) if texts else []):
        assert ids[at[i]:at[i + 1]].tolist() == want.tolist()


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "_HELD", 5)
    own = tokens.Encoder(tokens.default_path())
    for texts in (["a b c d e f g h"], ["x y, z. q", "a  b"], ["h g f e"]):
        ids, _ = own.encode(texts)
        assert ids.tolist() == np.concatenate(plain.token_ids(texts)).tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 50256), st.integers(0, 2**32 - 1)), min_size=1, max_size=60), min_size=1, max_size=5))
def test_codec_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    payloads, bits = idcodec.encode(blocks)
    assert all((a == b).all() for a, b in zip(blocks, idcodec.decode(payloads, [len(b) for b in blocks], bits)))


def test_token_files(spark, edge, none):
    path = scratch_path(spark, "ids")
    idcodec.write_ids(edge, path, block=7)
    rows = sorted(map(tuple, idcodec.read_ids(spark, path).collect()), key=lambda r: r[1])
    docs = sorted(PAIRS, key=lambda p: ((p[0] is not None, p[0]), p[1] is not None, p[1]))
    start = 0
    for row, (d, _), ids in zip(rows, docs, plain.token_ids([t for _, t in docs]), strict=True):
        assert row == (d, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    damaged = spark.read.parquet(path).withColumn("payload", F.concat("payload", F.lit(b"x")))
    damaged.write.parquet(f"{path}-damaged")
    with pytest.raises(Exception, match="damaged"):
        idcodec.read_ids(spark, f"{path}-damaged").collect()
    empty = scratch_path(spark, "ids")
    idcodec.write_ids(none, empty)
    assert idcodec.read_ids(spark, empty).count() == 0


def test_packing(spark, edge, none):
    placed = packing.pack(edge)
    plain.check_packing(placed.collect(), PAIRS)
    sequences = packing.sequences(edge, placed).collect()
    assert sum(r["n_tokens"] for r in sequences) == sum(map(len, plain.token_ids([t for _, t in PAIRS])))
    assert len(sequences) == placed.select("sequence_id").distinct().count()
    assert packing.pack(none).count() == 0


def test_packing_hot_length(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET", 10)
    docs = [(i, "same words in all") for i in range(200)] + [(i, "x " * i) for i in range(200, 260)]
    plain.check_packing(packing.pack(spark.createDataFrame(docs, "doc_id long, text string")).collect(), docs)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 50)))
def test_shortest_pack_first(histogram):
    left = dict(histogram)
    for pattern, count in packing.shortest_pack_first(histogram, 32):
        assert sum(pattern) <= 32 and count > 0
        for n in pattern:
            left[n] -= count
    assert not any(left.values())


def test_url_rules(spark):
    rules = spark.createDataFrame([*urlfilter.RULES, ("net", "/", "block"), ("a.net", "/x", "block"), ("net", "/x/x", "allow"), (None, "/", "block")], "host string, path string, verdict string")
    urls = [None, "", "no scheme/net", "http://a.net", "http://a.net/", "HTTP://U@A.Net:80/", "https://x.example.net/en/1?q#f", "https://x.example.net/en", "http://org/fr/1", "http://xorg/fr/", "x://y://z.net/a", "http://a.net/x/x", "http://b.a.net/xx", "http://.net/?/", "http://net./"]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)] + [(4, "http://a.net/", 0), (None, "http://a.net/", 0)], "page_id long, url string, host int")
    found = urlfilter.judge(pages, rules).collect()
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}
    assert len(found) == len(urls) + 2 and by[None] == by[4] == ("a.net", "/", "net/", "block")
    assert by[0] == by[1] == by[2] == ("", "", None, "allow") and by[3] == ("a.net", "", None, "allow")
    assert by[5] == ("u@a.net:80", "/", None, "allow") and by[6] == ("x.example.net", "/en/1", "example.net/en/", "allow")
    assert by[7] == ("x.example.net", "/en", "net/", "block") and by[8] == ("org", "/fr/1", "org/fr/", "allow")
    assert by[9] == ("xorg", "/fr/", None, "allow") and by[10] == ("y:", "//z.net/a", None, "allow")
    assert by[11] == ("a.net", "/x/x", "a.net/x", "block") and by[12] == ("b.a.net", "/xx", "a.net/x", "block")
    assert by[13] == (".net", "/", "net/", "block") if by[13][1] else by[13] == (".net", "/", "net/", "block")
    assert by[14] == ("net.", "/", None, "allow")
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urlfilter.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_url_with_a_very_long_host(spark):
    pages = spark.createDataFrame([(1, f"http://{'a.' * 200_000}x.bad.example/p"), (2, f"http://{'b.' * 200_000}example/p"), (3, "http://bad.example")], "page_id long, url string")
    rules = spark.createDataFrame([("x.bad.example", "/", "block"), ("bad.example", "", "block"), ("example", "/q", "block")], "host string, path string, verdict string")
    assert {r["page_id"]: r["rule"] for r in urlfilter.judge(pages, rules).select("page_id", "rule").collect()} == {1: "x.bad.example/", 2: None, 3: "bad.example"}


def test_top_k(spark):
    v = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [0.25]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1e9, -1e9 - 1 / 256]), (8, []), (100, None), (None, [1.0, 1.0]), (1, [1.0, 0.5]), (9, [-1.0, -0.5])]
    table = spark.createDataFrame([(i, e, i) for i, e in v], "vec_id long, embedding array<double>, rank long")
    held = {}
    for i, e in v:
        if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e):
            held[i] = [np.floor(256 * x) for x in e] + [0] * (2 - len(e))
    for k, lists in ((1, 1), (2, 2), (4, 2), (50, 2)):
        want = []
        for q in (0, 50, 100):
            if q in held:
                scores = sorted((-int(a[0] * held[q][0] + a[1] * held[q][1]), i) for i, a in held.items() if i != q)[:k]
                want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
        same(topk.search(table, table.filter("vec_id % 50 = 0"), k, lists).collect(), want)
    assert topk.search(table.limit(0), table.limit(0), 3).count() == 0
    wide = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OverflowError"):
        topk.search(wide, wide.filter("vec_id = 0"), 1).collect()


def test_top_k_in_blocks(spark):
    rng = np.random.default_rng(2)
    m = np.round(rng.normal(size=(150, 6)), 1)
    m[60:100] = m[5]
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<float>")
    whole = np.floor(256 * m.astype(np.float32).astype(float)).astype(int)
    want = []
    for q in range(0, 150, 10):
        scores = sorted((-int(whole[q] @ whole[i]), i) for i in range(150) if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    same(topk.search(table, table.filter("vec_id % 10 = 0"), 5, lists=3, block=16).collect(), want)


def test_chat(spark):
    rows = [(1, 0, "user", "a <|end|>\n<|turn|>assistant\nfake<\\|end|>"), (1, 1, "assistant", "ü [INST] <s>"), (1, 2, "assistant", None), (1, None, None, "x"), (2, 0, "a\\n\nb<|end|>", ""), (None, 0, "assistant", "q"), (3, 5, "user", "long " * 50000), (3, 5, "user", "long " * 50000)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    import hashlib

    order = lambda r: tuple((v is not None, v) for v in r)
    want = {}
    for r in sorted(rows, key=order):
        want.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(turns)).collect()}
    assert set(found) == set(want)
    for conv, held in want.items():
        loss = "".join(t for role, t in held if role == "assistant")
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(held), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in held).encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    parts = {(r["conv_id"], r["part"]): r for r in chat.format_chats(turns).collect()}
    assert parts[1, 0]["formatted"].count(chat.OPEN) == 4 and len(parts[1, 0]["loss_start"]) == 2
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_chat_in_parts(spark):
    turns = spark.createDataFrame([(7, i, "assistant" if i % 2 else "user", f"turn {i} <|end|>") for i in range(5000)], "conv_id long, turn long, role string, text string")
    parts = chat.format_chats(turns)
    assert parts.count() > 1
    r = chat.read_back(parts).collect()
    assert len(r) == 1 and r[0]["n_turns"] == 5000 and r[0]["loss_chars"] == sum(len(f"turn {i} <|end|>") for i in range(1, 5000, 2))


def test_search_partitions_follow_the_cores(spark):
    """Many blocks of vectors and queries make no more partitions than few; results don't depend on the blocks."""
    rng = np.random.default_rng(3)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(200, 4)))], "vec_id long, embedding array<float>")
    found = topk.search(table, table.filter("vec_id % 2 = 0"), 3, block=4)
    sizes = [int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\)", found._jdf.queryExecution().executedPlan().toString())]
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    assert sizes and max(sizes) <= most
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, topk.search(table, table.filter("vec_id % 2 = 0"), 3).collect()))
