"""Times the headline queries; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from fleetwatch.plans.queries import queries

HEADLINE = [
    "alert_replay",
    "alert_lifecycle",
    "last_seen_writes",
    "device_last_seen",
    "latest_telemetry_per_device",
    "device_telemetry",
    "parse_accepted",
    "list_alerts_by_site",
    "command_outcomes",
    "rule_change_outcomes",
    "check_domains",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetwatch-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    named, times = queries(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the first run compiles the generated code
            start = time.time()
            named[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        times[name] = round(min(runs), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
