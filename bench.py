"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables. BENCH_CPUS: local threads. Results go to the no-op sink, so
every row is computed and nothing is gathered.
"""

from __future__ import annotations

import json
import os
import time

from massloom import build_session
from massloom.catalog.registry import queries

HEADLINE = [
    "best_match_summary", "w01_best_psm", "a06_search_summary", "p17_dia_to_psm", "p10_delta_mass",
    "a03_site_fractions", "j02_match_mods", "a10_spectrum_stats", "a12_composite", "a13_label_calls",
    "x01_digest", "j01_remove_contaminants", "a01_peptide_scores_max", "j13_candidates",
    "a02_taxon_weights", "g02_factors", "g05_taxon_posteriors", "j14_class_overlap",
    "j03_reconcile_taxids", "a14_event_summary", "a29_w07_sdrf", "p22_protocol_facts",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(2 * int(cpus) if cpus.isdigit() else 16),
        spark__driver__memory="16g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    registered["a07_per_file_stats"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
