"""Times the headline queries and prints one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. Every query runs to the end over its
whole input; the result goes to Spark's ``noop`` sink, so nothing is left out by pruning and
nothing is collected. The best of two runs counts, after three queries that warm up the session.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from suite import CASES

HEADLINE = (
    "m1_upsert_classification",
    "m3_first_pass",
    "m4_deferred_lookup_pass",
    "m13_apply_plan",
    "j1_external_id_match",
    "j4_lookup_remap",
    "j4_lineitem_to_orders",
    "j5_children_by_several_lookups",
    "j7_self_reference_expansion",
    "j16_lookup_conflict_repair",
    "j21_pair_by_key_with_duplicates",
    "j26_lookup_by_comparison",
    "w3_first_match_per_group",
    "w4_duplicate_ordinal",
    "w5_sequence_number",
    "q4_repair_chain",
    "q7_id_uniqueness_repair",
    "t1_value_mapping",
    "t4_mock_columns",
    "t8_mask_secrets",
    "t12_mask_bypass",
    "f9_bad_words_filter",
    "m16_document_version_plan",
    "m18_size_bound_batches",
    "s2_typed_csv_scan",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("a3_write_summary", "m6_dry_run", "w8_fixed_size_chunks"):
        CASES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            CASES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
