"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR: input folder (default /root/testdata/sf0.1); BENCH_CPUS: cores (default 8);
BENCH_QUERIES: comma-separated names to run instead of the headline list.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexloom import plans  # noqa: E402
from lexloom.session import local_session  # noqa: E402

HEADLINE = ["flagship_citation_share", "seg1_paragraphs_to_sections", "cit2_simple_citations", "cit3_affectation_action", "jon2_resolve_by_number",
            "jon6_local_to_gazette", "jon7_cascade_match", "jon13_parent_document", "jon17_candidate_targets_item", "jon20_semantic_match",
            "ded3_pick_source", "ded5_first_by_key", "agg2_docs_per_issue", "agg5_module_summary", "agg8_corpus_distribution", "smp1_quota_sample",
            "nod2_document_nodes", "edg4_metadata_affectations", "grf5_connected_components", "inc4_reconcile_edges"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "lexloom-bench", **{"spark.ui.showConsoleProgress": "false"})
    failed = {}

    def run(n, d):
        """Seconds of a query; one that fails is listed and the others go on."""
        t = time.perf_counter()
        try:
            plans.QUERIES[n](spark, d).write.format("noop").mode("overwrite").save()
        except Exception as e:
            failed[n] = f"{type(e).__name__}: {str(e)[:300]}"
        return round(time.perf_counter() - t, 3)

    # one untimed pass over the smallest folder warms the JVM's code paths
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for n in names if os.path.isdir(small) else []:
        run(n, small)
    times = {n: run(n, sf_dir) for n in names}
    times = {n: s for n, s in times.items() if n not in failed}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), **({"failed": failed} if failed else {})}))
    spark.stop()


if __name__ == "__main__":
    main()
