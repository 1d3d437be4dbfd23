"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR: folder of the tables (default sf0.1). BENCH_CPUS: local cores (default 8).
Results go to a sink that computes every column and keeps nothing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spanloom.plans.queries import QUERIES  # noqa: E402
from spanloom.session import local_session  # noqa: E402

HEADLINE = [
    "extract_to_table",
    "flat_entity_table",
    "clean_text",
    "regularize_spans",
    "case_rules",
    "strategy_max",
    "annotation_export",
    "prompt_examples",
    "chunk_examples",
    "position_vectors",
    "shrink_documents",
    "entity_negatives",
    "relation_train_negatives",
    "extraction_examples",
    "split_ie",
    "running_ids",
    "label_examples",
    "merge_results",
    "money_normalize",
    "span_prf_by_class",
    "multilabel_metrics",
    "two_stage_classify",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8, "16g")
    # Start-up of the engine and of the file system is not part of any query.
    QUERIES["clean_text"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(
        json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
