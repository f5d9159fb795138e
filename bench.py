"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's ``noop`` sink (the whole plan executes, nothing
is collected to the driver).  Queries run in order in one session, so a stored intermediate
(coded events, clean measurements, cross-section) is written by the first query that needs it
and read by later ones, as in a real run.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortsmith import build_session  # noqa: E402
from cohortsmith.plans import registry  # noqa: E402

HEADLINE = [
    "coded_events", "clean_measurements", "baseline_nearest", "biomarker_features",
    "comorbidity_features", "medication_features", "efi", "stage_at_index",
    "cross_section_efi", "eligibility", "table_one_continuous", "table_one_categorical",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="cohortsmith-bench", conf={
        "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus),
        "spark.driver.memory": "16g",
    })
    qs = registry.queries()
    # Warm-up (not timed): JVM start-up and the fixture lookup tables (codelists, drug-class
    # lookup), which a real warehouse already holds as stored tables.
    b = registry.build_for(spark, sf_dir)
    b.wh.codelists.count()
    b.wh.drug_class_lookup.count()
    times: dict[str, float] = {}
    verbose = bool(os.environ.get("BENCH_VERBOSE"))
    for key in HEADLINE:
        t0 = time.perf_counter()
        df = qs[key](spark, sf_dir)
        t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
        if verbose:
            print(f"{key}: build {t1 - t0:.2f}s run {time.perf_counter() - t1:.2f}s", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
