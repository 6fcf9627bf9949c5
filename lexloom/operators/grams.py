"""Substring joins: which titles stand in which texts, at character level, by an index of sampled q-grams.

Of every window of ``w`` neighbouring q-grams the one with the smallest hash is sampled, from titles and texts alike.
A title that stands in a text makes the same windows there, so each of its samples is one of the text's. The title is
looked up by the sample that the texts hold least often; both positions give the only place where it can start, and the
characters there are compared. So neither a group that holds most rows nor words that all titles share make pairs.

Groups of up to ``COLD`` characters are searched so inside one task, all their rows having come there in one shuffle, and
only pairs leave it. Larger groups, and searches without groups, shuffle the samples.
"""

from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from lexloom.session import cut

# (least length, characters of a gram, grams of a window); shorter titles are looked up by the texts' substrings
TIERS = [(11, 6, 6), (4, 4, 1)]
PIECE = 4096  # characters of a text that are fetched for a comparison, at least
COLD = 1 << 22  # characters of a group's texts and titles that one task searches, at most
_STEP = 1 << 18  # characters hashed at once
_PLACES = 1 << 20  # places compared at once
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def samples(texts, q, w):
    """(number of the text, gram hash, position) of the sampled q-grams of texts, in parts of about _STEP characters.

    A text of fewer than w q-grams has none.
    """
    held, size = [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(0, len(t) - q - w + 2), _STEP):
            part = t[a:a + _STEP + q + w - 2]
            held.append((i, a, part))
            size += len(part)
            if size >= _STEP:
                yield _sampled(held, q, w)
                held, size = [], 0
    if held:
        yield _sampled(held, q, w)


def _sampled(held, q, w):
    """Samples of (number, start, part of a text), all parts in one array; windows across a border don't count."""
    codes = np.frombuffer("".join(p for _, _, p in held).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(p) for _, _, p in held])
    n = len(codes) - q + 1
    h = np.zeros(n, np.uint64)
    for i in range(q):
        h = (h ^ codes[i:i + n]) * _MIX[0]
        h ^= h >> np.uint64(29)
    h = (h ^ h >> np.uint64(30)) * _MIX[1]
    h = (h ^ h >> np.uint64(27)) * _MIX[2]
    start = np.arange(n - w + 1)
    part = np.searchsorted(ends, start, side="right")
    start = start[start + q + w - 1 <= ends[part]]
    at = np.unique(np.lib.stride_tricks.sliding_window_view(h, w)[start].argmin(axis=1) + start)
    part = np.searchsorted(ends, at, side="right")
    begins = ends - [len(p) for _, _, p in held]
    return np.array([i for i, _, _ in held])[part], h[at].view(np.int64), at - begins[part] + np.array([a for _, a, _ in held])[part]


def _exploded(df, keep, text, kind, parts):
    """Rows of ``parts(texts)`` (number of the text, two values) beside the columns kept. kind: their names and types."""

    def task(batches):
        for b in batches:
            for at, x, y in parts(b.column(text).to_pylist()):
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(at, pa.int64())) for c in keep), pa.array(x), pa.array(y)], names=[*keep, *kind.names])

    return df.select(*keep, text).mapInArrow(task, T.StructType([*df.select(*keep).schema.fields, *kind.fields]))


_GRAM = T.StructType([T.StructField("_gram", T.LongType()), T.StructField("_pos", T.LongType())])
_PIECE = T.StructType([T.StructField("_piece", T.LongType()), T.StructField("_part", T.StringType())])
_SHORT = T.StructType([T.StructField("_title", T.StringType()), T.StructField("_len", T.LongType())])


def candidates(texts, titles, group, q, w):
    """Places where a title may start: group, _tk, _nk, _start. One row for each hit of a title's rarest sample.

    texts: group, _tk, _text. titles: group, _nk, _title.
    """
    key = [*group, "_gram"]
    wanted = cut(_exploded(titles, [*group, "_nk"], "_title", _GRAM, lambda held: samples(held, q, w)))
    index = cut(_exploded(texts, [*group, "_tk"], "_text", _GRAM, lambda held: samples(held, q, w)).join(wanted.select(*key).distinct(), key, "left_semi"))
    often = wanted.join(index.groupBy(*key).agg(F.count(F.lit(1)).alias("_often")), key, "left")
    # a sample that no text holds proves that no text holds the title
    rarest = often.groupBy(*group, "_nk").agg(F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("n"), "_gram", "_pos")).alias("x")).filter("x.n > 0")
    rarest = rarest.select(*group, "_nk", F.col("x._gram").alias("_gram"), F.col("x._pos").alias("_at"))
    return rarest.join(index, key).select(*group, "_tk", "_nk", (F.col("_pos") - F.col("_at")).alias("_start")).filter("_start >= 0").distinct()


def _equal_at(found, texts, titles, group, longest):
    """The candidates whose characters are those of the title."""
    size = max(PIECE, longest)
    pieces = _exploded(texts.select("_tk", "_text").dropDuplicates(["_tk"]), ["_tk"], "_text", _PIECE, lambda held: _pieces(held, size, longest))
    rows = found.withColumn("_piece", F.floor(F.col("_start") / size)).join(titles.select(*group, "_nk", "_title"), [*group, "_nk"]).join(pieces, ["_tk", "_piece"])
    place = (F.col("_start") - F.col("_piece") * size + 1).cast("int")
    return rows.filter(F.substring("_part", place, F.length("_title")) == F.col("_title")).select(*group, "_tk", "_nk").distinct()


def _pieces(texts, size, longest):
    for i, t in enumerate(texts):
        for a in range(0, len(t), size * 64):
            at = range(a, min(len(t), a + size * 64), size)
            yield [i] * len(at), [x // size for x in at], [t[x:x + size + longest] for x in at]


def _substrings(texts, sizes):
    for i, t in enumerate(texts):
        for n in sizes:
            if found := sorted({t[a:a + n] for a in range(len(t) - n + 1)}):
                yield [i] * len(found), found, [n] * len(found)


def key_of(text):
    """How `contained` names a text or a title."""
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def contained(texts, titles, text, title, group=(), either=False):
    """Distinct (group, _tk, _nk): titles that stand anywhere in texts of their group, character by character.

    ``_tk`` and ``_nk`` are ``key_of`` text and title. Empty and NULL texts, titles and groups have no pairs. With
    ``either``, titles in which a text stands are found as well.
    """
    group = list(group)
    side = lambda df, c, mark: df.select(*group, F.lit(mark).alias("_mark"), key_of(c).alias("_key"), F.col(c).alias("_string")).filter("_string <> ''")
    t, n = side(texts, text, False), side(titles, title, True)
    if not group:
        return _by_samples(t, n, group, either)
    rows = cut(t.unionByName(n).dropna(subset=group).repartition(*group).sortWithinPartitions(*group))
    # fewer than all characters / COLD
    hot = cut(rows.groupBy(*group).agg(F.sum(F.length("_string")).alias("_size")).filter(F.col("_size") > COLD).select(*group))
    if hot.isEmpty():
        return _in_tasks(rows, group, either)
    large = rows.join(F.broadcast(hot), group, "left_semi")
    return _in_tasks(rows.join(F.broadcast(hot), group, "left_anti"), group, either).unionByName(_by_samples(large.filter("NOT _mark"), large.filter("_mark"), group, either))


def _in_tasks(rows, group, either):
    """``contained`` for rows that are sorted by group, each group in one task."""
    keys = [T.StructField(c, T.BinaryType()) for c in ("_tk", "_nk")]
    return rows.mapInArrow(lambda batches: _searched(batches, group, either), T.StructType([*rows.select(*group).schema.fields, *keys]))


class _Rows:
    """Distinct strings of some groups: number of the group, key and string of each."""

    def __init__(self):
        self.seen, self.of, self.keys, self.strings = set(), [], [], []

    def add(self, no, key, string):
        if (no, key) not in self.seen:
            self.seen.add((no, key))
            self.of.append(no)
            self.keys.append(key)
            self.strings.append(string)

    def arrays(self):
        """Group, length and start in the joined strings of each, and (sum of code times power of its place) up to each place."""
        size = np.array([len(x) for x in self.strings], np.int64)
        codes = np.frombuffer("".join(self.strings).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers(len(codes)), dtype=np.uint64)])
        return np.array(self.of, np.int64), size, np.cumsum(size) - size, sums


def _powers(n):
    out = np.full(n, _MIX[0])
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _searched(batches, group, either):
    """Pairs of rows sorted by group. Small groups are searched together."""
    groups, texts, titles, size, schema = [], _Rows(), _Rows(), 0, None
    for b in batches:
        schema = b.schema
        for at, mark, key, string in zip(zip(*(b.column(c).to_pylist() for c in group)), *(b.column(c).to_pylist() for c in ("_mark", "_key", "_string"))):
            if not groups or groups[-1] != at:
                if size >= _STEP:
                    yield from _pairs(groups, texts, titles, group, schema, either)
                    groups, texts, titles, size = [], _Rows(), _Rows(), 0
                groups.append(at)
            (titles if mark else texts).add(len(groups) - 1, key, string)
            size += len(string)
    if groups:
        yield from _pairs(groups, texts, titles, group, schema, either)


def _pairs(groups, texts, titles, group, schema, either):
    if not texts.of or not titles.of:
        return
    found = _places(texts, titles)
    if either:
        # equal strings are found already
        back = ([(i, j) for j, i in zip(*pairs) if texts.keys[i] != titles.keys[j]] for pairs in _places(titles, texts))
        found = chain(found, (list(zip(*pairs)) for pairs in back if pairs))
    known = [pa.array(c, schema.field(g).type) for g, c in zip(group, zip(*groups))]
    for i, j in found:
        of = pa.array([texts.of[x] for x in i], pa.int64())
        yield pa.RecordBatch.from_arrays([*(c.take(of) for c in known), pa.array([texts.keys[x] for x in i], pa.binary()), pa.array([titles.keys[x] for x in j], pa.binary())],
                                         names=[*group, "_tk", "_nk"])


def _places(texts, titles):
    """(numbers of texts, numbers of the titles in them), each pair once."""
    here, there = texts.arrays(), titles.arrays()
    powers = _powers(max(len(here[3]), len(there[3])))
    for (a, b), (_, q, w) in zip(_ranges(), TIERS):
        some = np.flatnonzero((there[1] >= a) & (there[1] < b))
        if len(some):
            yield from _looked_up(texts, titles, here, there, powers, some, q, w)
    short = {}
    for j in np.flatnonzero(there[1] < TIERS[-1][0]).tolist():
        short.setdefault(titles.of[j], {})[titles.strings[j]] = j
    sizes = {no: sorted({len(x) for x in of}) for no, of in short.items()}
    for i, (no, t) in enumerate(zip(texts.of, texts.strings)):
        if no in short:
            found = {short[no].get(t[x:x + n]) for n in sizes[no] for x in range(len(t) - n + 1)} - {None}
            if found:
                yield [i] * len(found), sorted(found)


def _gathered(strings, of, q, w):
    """String, gram hash (of a gram and its group) and position of all samples."""
    parts = list(samples(strings, q, w))
    at, h, pos = (np.concatenate([p[x] for p in parts]) if parts else np.zeros(0, np.int64) for x in range(3))
    return at, h.view(np.uint64) ^ (of[at].astype(np.uint64) * _MIX[1]), pos


def _looked_up(texts, titles, here, there, powers, some, q, w):
    """The titles ``some``, each compared where the texts of its group hold its rarest sample."""
    (t_of, t_size, t_start, t_sums), (n_of, n_size, n_start, n_sums) = here, there
    n_at, n_gram, n_pos = _gathered([titles.strings[j] for j in some], n_of[some], q, w)
    t_at, t_gram, t_pos = _gathered(texts.strings, t_of, q, w)
    order = np.argsort(t_gram, kind="stable")
    grams = t_gram[order]
    low = np.searchsorted(grams, n_gram)
    often = np.searchsorted(grams, n_gram, side="right") - low
    by = np.lexsort((often, n_at))
    first = by[np.flatnonzero(np.diff(n_at[by], prepend=-1))]
    first = first[often[first] > 0]
    ends = np.cumsum(often[first])
    begin = 0
    while begin < len(first):
        # whole titles, about _PLACES places
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + _PLACES, side="right")))
        one, n = first[begin:end], often[first[begin:end]]
        rows = np.repeat(one, n)
        hit = order[np.repeat(low[one] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        i, j, at = t_at[hit], some[n_at[rows]], t_pos[hit] - n_pos[rows]
        fits = (at >= 0) & (at + n_size[j] <= t_size[i]) & (t_of[i] == n_of[j])
        i, j, at = i[fits], j[fits], at[fits]
        x, y = t_start[i] + at, n_start[j]
        same = (t_sums[x + n_size[j]] - t_sums[x]) * powers[y] == (n_sums[y + n_size[j]] - n_sums[y]) * powers[x]
        found = sorted({(a, b) for a, b, c in zip(i[same].tolist(), j[same].tolist(), at[same].tolist()) if texts.strings[a].startswith(titles.strings[b], c)})
        if found:
            yield [a for a, _ in found], [b for _, b in found]
        begin = end


def _by_samples(texts, titles, group, either=False):
    """``contained`` by shuffles of the samples. texts, titles: group, _key, _string."""
    found = _held(texts, titles, group)
    if not either:
        return found
    back = _held(titles, texts, group).select(*group, F.col("_nk").alias("_tk"), F.col("_tk").alias("_nk"))
    return found.unionByName(back.filter("_tk <> _nk"))


def _held(texts, titles, group):
    """Titles in texts. They come in three kinds by length, each searched only if there are any; the shortest are compared
    with the texts' distinct substrings of their few lengths."""
    t = texts.select(*group, F.col("_string").alias("_text"), F.col("_key").alias("_tk")).dropDuplicates([*group, "_tk"])
    n = titles.select(*group, F.col("_string").alias("_title"), F.col("_key").alias("_nk")).dropDuplicates([*group, "_nk"])
    if group:
        t = t.join(n.select(*group).distinct(), group, "left_semi")
    n = cut(n.withColumn("_len", F.length("_title").cast("long")))
    t = cut(t)
    # a handful of numbers: the longest title, and lengths under the shortest of the indexed ones
    least = TIERS[-1][0]
    longest, short, *some = n.agg(F.max("_len"), F.collect_set(F.when(F.col("_len") < least, F.col("_len"))), *[F.count(F.when((F.col("_len") >= a) & (F.col("_len") < b), 1)) for a, b in _ranges()]).first()
    out = []
    for (a, b), (_, q, w), there in zip(_ranges(), TIERS, some):
        if there:
            part = n.filter((F.col("_len") >= a) & (F.col("_len") < b))
            out.append(_equal_at(candidates(t, part, group, q, w), t, part, group, longest))
    if short:
        found = _exploded(t, [*group, "_tk"], "_text", _SHORT, lambda held: _substrings(held, short))
        out.append(found.join(n.filter(F.col("_len") < least).select(*group, "_title", "_nk"), [*group, "_title"]).select(*group, "_tk", "_nk").distinct())
    if not out:
        return texts.sparkSession.createDataFrame([], t.select(*group, "_tk", F.col("_tk").alias("_nk")).schema)
    return reduce(lambda x, y: x.unionByName(y), out)


def _ranges():
    least = [a for a, _, _ in TIERS]
    return list(zip(least, [1 << 40, *least]))
