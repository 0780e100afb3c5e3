"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` with
``local[$BENCH_CPUS]`` and print one JSON line with per-query seconds.

Each query is forced to completion with Spark's ``noop`` sink (full evaluation,
nothing collected).  ``train_full_batch`` (T1: every stride-1 window, twice) can
be named on the command line; it is not in the default list, because at sf0.1 it
alone takes several times as long as all the others.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["vocab", "encoded_lines", "corpus_sliding", "paragraph_chunks", "window_loss", "doc_scores",
            "train_mini_batch", "train_param_avg", "train_per_document", "carried_state_loss", "generate_sampled",
            "free_running_loss"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from charloom.session import get_spark
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    from charloom.queries import QUERIES
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    times = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
