"""A training corpus from `documents`, in five stages. Each stage's rows are written as Parquet and read by the next.

1. language_id: documents without a recognisable language go: no letter at all, or a score under the floor that all
   labelled documents give. With too few labelled documents for that, only documents without a letter go.
2. line_dedup: later copies of repeated line runs are cut out; documents of which nothing but blanks is left go.
3. simhash: one document of each group of near copies stays: five-word shingle sets with a similarity of 0.8 or more.
   Texts whose SimHash fingerprints are linked are checked on whole sets, as are those that share a segment of minima.
4. decontaminate: documents that hold a benchmark item go.
5. pack: the token pieces of what is left, packed into sequences.

The first four return the columns of documents, `text` and `n_chars` as changed. Empty tables give empty results, NULL
ids and repeated rows follow the operators' docstrings.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lexloom.llm import decontaminate, langid, linededup, neardup, packing, simhash  # noqa: E402
from lexloom.llm.base import own_name, table  # noqa: E402
from lexloom.session import scratch_path  # noqa: E402


def language_id(spark, docs, sf_dir):
    profiles = langid.fit(docs.filter(~langid.held_out()))
    lang, score = own_name(docs, "lang_pred"), own_name(docs, "lang_score")
    if not profiles:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    scored = langid.predict(docs, profiles, lang, score).filter(F.col(lang) != langid.UNKNOWN)
    learned = docs.filter(~langid.held_out() & F.col("lang").isNotNull()).select("text")
    floor = langid.floor_of(langid.predict(learned, profiles).filter(F.col("lang_pred") != langid.UNKNOWN))
    return scored.filter(F.col(score) >= floor).select(*docs.columns)


def line_dedup(spark, docs, sf_dir):
    gone = own_name(docs, "lines_removed")
    out = linededup.dedup(docs, n_removed=gone).filter((F.col(gone) == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    cut = F.col(gone) > 0
    return out.select(*[F.when(cut, F.length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


def near_dedup(spark, docs, sf_dir):
    return neardup.survivors(docs, simhash.near_texts(docs.select("doc_id", "text")))


def decontaminated(spark, docs, sf_dir):
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark, docs, sf_dir):
    return packing.pack(docs.select("doc_id", "text")).drop("text_key")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("simhash", near_dedup), ("decontaminate", decontaminated), ("pack", packed)]

# Edit distances over whole texts and a public tokenizer's ids are beyond SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Packed token pieces of the cleaned corpus: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
