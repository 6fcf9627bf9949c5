"""The language stage keeps clean documents and drops texts in no learned language."""

import random

import corpus_pipeline
from pyspark.sql import functions as F


def test_unlearned_scripts_and_noise_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(1)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (60, 150, 400, 3000)]
    greek = "η γλώσσα είναι ένα σύστημα επικοινωνίας που χρησιμοποιούν οι άνθρωποι "
    chinese = ["".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n)) for n in (5, 200)]
    planted = [*noise, "γλώσσα", greek, greek * 50, *chinese]
    rows = [(10 ** 9 + i, t, None) for i, t in enumerate(planted)]
    kept = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), None)
    found = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not found & {d for d, _, _ in rows}
    clean = {r["doc_id"] for r in docs.filter(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert found == clean
