"""Duplicates, picks, numbering, order and set operations."""

from pyspark.sql import functions as F

from lexloom.functions import text as tx
from lexloom.operators import grams
from lexloom.operators.ordered import first_row, global_scan, split_row_number
from lexloom.session import cut


def dedupe_first(df, keys, ord_col="ingest_ord"):
    """DED1: first row per first non-blank key; rows without any key dropped."""
    key = tx.first_nonblank(*keys)
    return first_row(df.withColumn("_key", key).filter(F.col("_key").isNotNull()), ["_key"], [ord_col]).drop("_key")


# ---- DED2: publications that say the same ---------------------------------------------------
SIMILAR_RATIO, MIN_CONTAINED, LONG_WORD, SHARED_LONG = 0.82, 15, 5, 2  # fixed values


def similar(a, b):
    """Two normalised descriptions: containment, token overlap, or shared long words."""
    wa, wb = _word_set(a), _word_set(b)
    both = F.array_intersect(wa, wb)
    contained = (F.length(a) >= MIN_CONTAINED) & (F.length(b) >= MIN_CONTAINED) & (F.contains(a, b) | F.contains(b, a))
    overlap = (a != "") & (b != "") & (F.size(both) / F.greatest(F.size(wa), F.size(wb)) >= SIMILAR_RATIO)
    return contained | overlap | (F.size(F.filter(both, lambda w: F.length(w) >= LONG_WORD)) >= SHARED_LONG)


def _word_set(c):
    return F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))


def alike_by_words(d):
    """(_g, a, b), a before b: candidates for the share of common words, by exact prefix filtering.

    d: _g, _o, _t. Two word sets of that share have one of the rarest words of either in common: of n words, the rarest
    n - 0.82 n + 1, in the group's order of how many descriptions hold them. Sizes and places bound the share further.
    """
    n = F.size("_w")
    held = d.select("_g", "_o", _word_set(F.col("_t")).alias("_w"))
    words = held.select("_g", "_o", n.alias("_n"), F.explode("_w").alias("_x"))
    often = words.groupBy("_g", "_x").agg(F.count(F.lit(1)).alias("_often"))
    order = words.join(often, ["_g", "_x"]).groupBy("_g", "_o", "_n").agg(F.sort_array(F.collect_list(F.struct("_often", "_x"))).alias("_w"))
    least = lambda n: F.ceil(F.lit(round(SIMILAR_RATIO * 100)) * n / 100).cast("int")
    keys = cut(order.select("_g", "_o", "_n", F.posexplode(F.slice("_w", F.lit(1), F.col("_n") - least(F.col("_n")) + 1)).alias("_at", "_k")).filter("_k._often > 1").select("_g", "_k._x", "_o", "_n", "_at"))
    side = lambda p: keys.select("_g", "_x", *[F.col(c).alias(f"{p}{c}") for c in ("_o", "_n", "_at")])
    both = side("a").join(side("b"), ["_g", "_x"]).filter("a_o < b_o")
    need, rest = least(F.greatest("a_n", "b_n")), F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    return both.filter((F.least("a_n", "b_n") >= need) & (rest >= need)).select("_g", F.col("a_o").alias("a"), F.col("b_o").alias("b")).distinct()


def _contained(d):
    """(_g, a, b), a before b: one holds the other, and both have the length for that."""
    long = d.filter(F.length("_t") >= MIN_CONTAINED)
    name = lambda c, o: long.select("_g", grams.key_of("_t").alias(c), F.col("_o").alias(o))
    pairs = grams.contained(long, long, "_t", "_t", ["_g"]).join(name("_tk", "x"), ["_g", "_tk"]).join(name("_nk", "y"), ["_g", "_nk"]).filter("x <> y")
    return pairs.select("_g", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def cluster_publications(pubs, keys, text, ord_col="ingest_ord"):
    """DED2: greedy clusters per group; a row joins the first cluster whose representative
    (its first member) is similar. ``cluster`` is the representative's position.

    NULL and blank text keys are one group, as a missing phase is a phase of its own. Equal
    descriptions always share a fate, so distinct ones are clustered. Blank ones stay alone.

    Two shared long words are one key, a pair of words, and whoever has a key is similar to
    all that have it; no pair of descriptions is made for that. The other two rules give
    verified pairs, from indexes. A round makes every description a representative that is
    the first open one behind each of its keys and pairs, and settles what is similar to it.
    That is the sequential greedy: nothing before a representative could have taken it. Rounds
    follow the longest chain of descriptions each similar to the one before, not the clusters.
    """
    group = F.struct(*[(F.when(F.trim(k) != "", F.col(k)) if pubs.schema[k].dataType.typeName() == "string" else F.col(k)).alias(k) for k in keys])
    df = pubs.withColumns({"_t": tx.title_key(text), "_g": group})
    d = cut(df.filter("_t <> ''").groupBy("_g", "_t").agg(F.min(ord_col).alias("_o")))
    long = F.array_sort(F.filter(_word_set(F.col("_t")), lambda w: F.length(w) >= LONG_WORD))
    two = F.flatten(F.transform(long, lambda w, i: F.transform(F.slice(long, i + 2, F.size(long)), lambda v: F.concat(w, F.lit(" "), v))))
    shared = d.select("_g", "_o", F.explode(two).alias("_k"))
    shared = cut(shared.join(shared.groupBy("_g", "_k").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_g", "_k"), ["_g", "_k"], "left_semi"))
    named = lambda p: d.select("_g", F.col("_o").alias(p), F.col("_t").alias(f"{p}_t"))
    pairs = alike_by_words(d).join(named("a"), ["_g", "a"]).join(named("b"), ["_g", "b"]).filter(similar(F.col("a_t"), F.col("b_t"))).select("_g", "a", "b")
    pairs = cut(pairs.unionByName(_contained(d)).distinct())

    node, open_, reps = ["_g", "_o"], d.select("_g", "_o"), None
    linked = cut(shared.select(*node).union(pairs.select("_g", "a")).union(pairs.select("_g", "b")).distinct())
    reps, open_ = open_.join(linked, node, "left_anti"), linked  # what is similar to nothing stands alone
    left, edges = shared, pairs
    while not open_.isEmpty():
        first = left.groupBy("_g", "_k").agg(F.min("_o").alias("_first"))
        held = left.join(first, ["_g", "_k"])
        later = held.filter("_o > _first").select(*node).union(edges.select("_g", "b")).distinct()
        new = cut(open_.join(later, node, "left_anti"))
        of = lambda c: new.select("_g", F.col("_o").alias(c))
        gone = held.join(of("_first"), ["_g", "_first"], "left_semi").select(*node).union(edges.join(of("a"), ["_g", "a"], "left_semi").select("_g", "b")).union(new.select(*node)).distinct()
        reps, open_ = reps.unionByName(new), cut(open_.join(gone, node, "left_anti"))
        left = cut(left.join(open_, node, "left_semi"))
        still = lambda c: open_.select("_g", F.col("_o").alias(c))
        edges = cut(edges.join(still("a"), ["_g", "a"], "left_semi").join(still("b"), ["_g", "b"], "left_semi"))
    reps = cut(reps)
    # the first representative that is similar and comes before; no two of them share a key
    of = lambda c: reps.select("_g", F.col("_o").alias(c))
    by_key = shared.join(shared.join(reps, node, "left_semi").select("_g", "_k", F.col("_o").alias("_rep")), ["_g", "_k"]).select(*node, "_rep").filter("_rep <= _o")
    by_pair = pairs.join(of("a"), ["_g", "a"], "left_semi").select("_g", F.col("b").alias("_o"), F.col("a").alias("_rep"))
    rep = by_key.unionByName(by_pair).unionByName(reps.select(*node, F.col("_o").alias("_rep"))).groupBy(*node).agg(F.min("_rep").alias("_rep"))
    own = reps.select(*node, F.lit(True).alias("_own"))
    done = d.join(rep, node).join(own, node, "left").select("_g", "_t", F.when(F.col("_own"), F.col("_o")).otherwise(F.col("_rep")).alias("_rep"))
    return df.join(done, ["_g", "_t"], "left").select(*pubs.columns, F.coalesce("_rep", ord_col).alias("cluster"))


def source_priority(known="known"):
    """Matched gazette 4, gazette 3, provincial 2, other 1."""
    b = F.upper(F.coalesce("butlleti", F.lit("")))
    return F.when((b == "DOGC") & F.col(known), 4).when(b == "DOGC", 3).when(b.startswith("BOP"), 2).otherwise(1)


def pick_source(df, keys, ord_col="ingest_ord"):
    """DED3: best publication per cluster with its sorted source list.

    The list holds distinct bulletin codes, of which there are a handful.
    """
    rank = F.struct((-source_priority()).alias("p"), F.col(ord_col))
    rest = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("r"), F.array_sort(F.collect_set(tx.nonblank("butlleti"))).alias("all_sources"))
    return g.select(*keys, "r.*", "all_sources", (F.size("all_sources") > 1).alias("is_multi_source"))


def last_by(df, keys, ord_col="ingest_ord"):
    """DED4: the last row per key, as overwriting a dictionary entry does."""
    return first_row(df, keys, [ord_col], last=True)


def first_by(df, keys, fill, ord_col="ingest_ord"):
    """DED5: first row per key, blanks filled from the next row that has a value."""
    filled = [F.min_by(c, F.when(tx.nonblank(c).isNotNull(), F.col(ord_col))).alias(c) for c in fill]
    rest = [F.min_by(c, ord_col).alias(c) for c in df.columns if c not in keys and c not in fill]
    return df.groupBy(*keys).agg(*filled, *rest)


def unique_edges(df, ord_col=None):
    """DED6: one edge per (source, target, type)."""
    keys = ["src", "dst", "type"]
    return df.select(*keys).distinct() if ord_col is None else first_row(df, keys, [ord_col])


def distinct_ordered(df, keys, value, ord_col):
    """DED7: distinct values per key at their first position, as rows."""
    return df.groupBy(*keys, value).agg(F.min(ord_col).alias(ord_col))


def number_sections(df, key="document_id", ord_col="ord"):
    """WIN1: dense 1-based number and 0-based order of sections in a document."""
    n = split_row_number(df, [key], [F.floor(F.col(ord_col) / 4096)], [ord_col], "section_no")
    return n.withColumn("order", F.col("section_no") - 1)


def assign_ids(new, existing, order, ident="id"):
    """WIN2: ids above the largest existing one, dense and in a given order."""
    base = existing.agg(F.coalesce(F.max(ident), F.lit(0)).alias("m"))
    ranked = global_scan(new, order, {}, "_rank")
    return ranked.withColumn(ident, F.col("_rank") + base.scalar()).drop("_rank")


def share_of_total(counts, n="n", out="pct", digits=6):
    """WIN4: percent of the column total."""
    return counts.withColumn(out, F.round(100.0 * F.col(n) / counts.agg(F.sum(n)).scalar(), digits))


def issue_order(c):
    """SRT1: sort key; missing first, then numeric by the digits in it, then by text."""
    digits = F.regexp_replace(tx.col(c), r"\D", "")
    missing = tx.nonblank(c).isNull()
    return F.struct(F.when(missing, 0).otherwise(1).alias("a"), F.coalesce(digits.try_cast("bigint"), F.lit(0)).alias("b"), F.coalesce(tx.col(c), F.lit("")).alias("c"))


def union_documents(*dfs):
    """SET1: tables stacked by column name; a missing column is NULL."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def placeholders(edges, nodes, ident="document_id"):
    """SET2: stub nodes for edge ends that no node has."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias(ident)).distinct()
    p = ends.join(nodes.select(ident).distinct(), ident, "left_anti")
    title = F.concat(F.lit("Referenced Law (Placeholder - Document ID "), F.col(ident).cast("string"), F.lit(")"))
    return p.select(ident, title.alias("title"), F.lit("Unknown").alias("type_of_law"), F.lit("Unknown").alias("organisme"),
                    F.lit("Unknown").alias("section"), F.lit("Document").alias("label"), F.lit(False).alias("is_bilingual"))


def key_space(df, props="props"):
    """SET3: every property key in use."""
    return df.select(F.explode(F.map_keys(props)).alias("key")).distinct()


def upsert(base, changes, key):
    """SET4: replace rows by key, append new ones."""
    return base.join(changes.select(key).distinct(), key, "left_anti").unionByName(changes)


def delete_by(base, gone, key):
    """SET4: rows whose key is not in ``gone``."""
    return base.join(gone.select(key).distinct(), key, "left_anti")
