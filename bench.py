"""Time every catalogue query on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from noticelens.plans.catalogue import QUERIES
from noticelens.session import local_session

# Untimed, so that the first timed query does not pay for starting the JVM and workers.
WARM_UP = ("class_distribution", "title_clean", "weak_label_ensemble")


def seconds(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    # The noop sink computes every row and column without collecting them.
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = local_session(cpus, "bench", **{"spark.ui.showConsoleProgress": "false"})
    for name in WARM_UP:
        seconds(spark, name, sf_dir)
    times = {name: round(seconds(spark, name, sf_dir), 3) for name in only or QUERIES}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "catalogue_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
