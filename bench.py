"""Time the headline queries: one JSON line with seconds per query and their sum."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "A1_class_metrics",
    "A3_average_precision",
    "A5_confusion_matrix",
    "J8_multiclass_nms",
    "J6_near_duplicate_pairs",
    "A10_dataset_totals",
    "A12_class_balance",
    "W5_random_split",
    "X30_tiled_boxes",
    "X21_mask_overlaps",
    "A8_semantic_overall",
    "ST4_window_stats",
    "F11_filtered_log",
    "W7_throttled_records",
    "J1_label_files_to_images",
]


def main() -> None:
    from annoframe.plans.registry import runnable
    from annoframe.session import build
    import annoframe.plans  # noqa: F401

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    # One small run first, so that no query pays for starting the session.
    runnable("A11_stage_counts")(spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        runnable(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
