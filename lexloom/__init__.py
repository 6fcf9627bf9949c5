"""Citation-graph analytics over official-gazette corpora, written as Spark DataFrame jobs."""
