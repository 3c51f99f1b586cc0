"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("pit_actor_history", "form_last_n", "trailing_days", "win_streak", "jt_combo_synergy", "market_overround", "field_zscore", "dedup_most_complete", "last_non_null_wins", "full_outer_provenance", "horse_career", "track_profile", "labels", "calibration_bins", "logloss_auc", "psi", "schema_violations", "monthly_stats", "harville_trifecta", "band_distance_rate", "asof_rating", "events_session")


def main() -> None:
    from paceline.plans.registry import QUERIES
    from paceline.session import session

    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_driver_memory="12g", spark_ui_showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    run("labels")  # warms the JVM up
    took = {}
    for name in HEADLINE:
        began = time.time()
        run(name)
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
