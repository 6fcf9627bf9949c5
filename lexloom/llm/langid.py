"""Language identification by rank-order profiles.

Letters are lower-cased, everything else is one word boundary. The n-grams of one to three characters (none spans a
boundary) are ranked by frequency, ties by code point. A language's profile is the ranking over its training texts; a
text goes to the language with the smallest out-of-place distance: the sum over the text's own most frequent n-grams of
the difference between both ranks, or the profile length where the profile lacks the n-gram.
"""

import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.base import small_batches, texts, with_columns

PROFILE = 300
MAX_LANGUAGES = 8192  # bound of the collected profiles: PROFILE rows for each language
FLOOR_ROWS = 100  # texts that a floor of scores is taken from, at least
UNKNOWN = "und"
_EDGE = 1  # stands for a word boundary; a control character, so never a letter
_CHUNK = 1 << 20
_FLUSH = 1 << 21


@functools.cache
def _letters():
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _counted(codes):
    codes.sort()
    at = np.flatnonzero(np.concatenate((np.ones(min(1, len(codes)), bool), codes[1:] != codes[:-1])))
    return codes[at], np.diff(np.append(at, len(codes)))


def _merged(codes, counts):
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[at], np.add.reduceat(counts, at)


def grams(text):
    """Sorted n-gram codes of a text and their counts; None if it has no letter. Long texts are counted in chunks."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[cp]
    if not letter.any():
        return None
    cp[~letter] = _EDGE
    cp = np.concatenate(([_EDGE], cp, [_EDGE]))
    edge = cp == _EDGE
    cp = cp[~(edge & np.concatenate(([False], edge[:-1])))]
    parts = []
    for i in range(0, len(cp), _CHUNK):
        one, two, three = cp[i:i + _CHUNK], cp[i:i + _CHUNK + 1], cp[i:i + _CHUNK + 2]
        pairs = two[:-1] << 21 | two[1:]
        triples = (pairs[:len(three) - 2] << 21 | three[2:])[three[1:-1] != _EDGE]
        parts.append(_counted(np.concatenate((one[one != _EDGE], pairs, triples))))
    return parts[0] if len(parts) == 1 else _merged(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))


def _top(codes, counts, k):
    return codes[np.argsort(-counts, kind="stable")[:k]]


def _count_task(batches):
    """Counts by language of a whole partition, sent on when they fill their bound."""
    held = {}

    def out():
        for lang, parts in held.items():
            codes, counts = _merged(np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts.astype(np.int64))], names=["lang", "code", "n"])
        held.clear()

    size = 0
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), texts(b)):
            if g := grams(text):
                held.setdefault(lang, []).append(g)
                size += len(g[0])
                if size > _FLUSH:
                    held = {k: [_merged(np.concatenate([c for c, _ in v]), np.concatenate([n for _, n in v]))] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > _FLUSH // 2:
                        yield from out()
                        size = 0
    yield from out()


def fit(labelled, profile=PROFILE):
    """Profiles from all rows of labelled (text, lang): {lang: n-gram codes by rank}.

    Rows with a NULL lang or without a letter teach nothing. Counting is distributed; `profile` rows for each language
    come to the driver, and more than MAX_LANGUAGES languages are refused.
    """
    small_batches(labelled.sparkSession)
    counts = labelled.filter(F.col("lang").isNotNull()).select("lang", "text").mapInArrow(_count_task, "lang string, code long, n long")
    counts = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    rows = counts.withColumn("rank", rank).filter(F.col("rank") <= profile).select("lang", "code", "rank").limit(profile * MAX_LANGUAGES + 1).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(r["code"])
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return found


def classifier(profiles, profile=PROFILE):
    """Function from text to (language, score). Equal distances go to the smaller language name."""
    langs = sorted(profiles)
    codes = np.array(sorted({c for v in profiles.values() for c in v}), np.int64)
    ranks = np.full((len(langs), len(codes) + 1), -1, np.int64)
    for i, lang in enumerate(langs):
        ranks[i, np.searchsorted(codes, np.array(profiles[lang], np.int64))] = np.arange(len(profiles[lang]))

    def classify(text):
        found = grams(text) if langs else None
        if found is None:
            return UNKNOWN, 0.0
        top = _top(*found, profile)
        at = np.searchsorted(codes, top)
        at[(at == len(codes)) | (codes[np.minimum(at, len(codes) - 1)] != top)] = len(codes)
        there = ranks[:, at]
        away = np.where(there < 0, profile, np.abs(there - np.arange(len(top)))).sum(axis=1)
        best = int(away.argmin())
        return langs[best], float(1 - away[best] / (profile * len(top)))

    return classify


def predict(docs, profiles, lang="lang_pred", score="score", profile=PROFILE):
    """docs with the predicted language and a score from 0 (nothing in common) to 1 (same ranking).

    Only `text` is read. NULL texts, texts without a letter, and all texts if no profile was learned give `und` and 0.
    Repeated rows each get their prediction.
    """
    small_batches(docs.sparkSession)

    def task(batches):
        classify = classifier(profiles, profile)
        for b in batches:
            found = [classify(t) for t in texts(b)]
            yield with_columns(b, **{lang: pa.array([x for x, _ in found], pa.string()), score: pa.array([x for _, x in found], pa.float64())})

    return docs.mapInArrow(task, T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())]))


def floor_of(scored, score="score"):
    """Lowest score of a text in a learned language, by the scores of all labelled texts; 0 from fewer than FLOOR_ROWS.

    It lies as far under their lowest hundredth as that lies under the median, so that a few wrong labels change nothing.
    Floors by length would be tighter, but lose clean texts that the labelled ones of their length don't resemble.
    """
    (low, middle), n = scored.agg(F.coalesce(F.percentile_approx(score, [0.01, 0.5], 10000), F.array(F.lit(0.0), F.lit(0.0))), F.count(F.lit(1))).first()
    return max(0.0, 2 * low - middle) if n >= FLOOR_ROWS else 0.0


def held_out(doc_id="doc_id"):
    """Documents kept from training: crc32 of the id as text divisible by 5. A NULL id counts as empty text, held out."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def op9_language_id(spark, sf_dir):
    from lexloom.llm.base import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    profiles = fit(docs.filter(~F.col("held_out")))
    return predict(docs.select("doc_id", "held_out", "text"), profiles).select("doc_id", "held_out", "lang_pred", "score")
