"""Times every query at BENCH_SF_DIR on local[BENCH_CPUS] and prints one JSON line.

A query is timed from the call to its last row, written to nowhere. Before, all of them run once untimed on the
smallest tables at hand, as the first run of a process mostly measures class loading and compilation. BENCH_QUERIES
(comma-separated) picks some.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from railwatch.plans.queries import QUERIES  # noqa: E402
from railwatch.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else list(QUERIES)
    spark = build_session(
        "railwatch-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            # One machine: its temporary folder is shared by all there is.
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="railwatch-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    smallest = Path(sf_dir).parent / "sf0.001"
    for folder in (str(smallest if smallest.exists() else sf_dir), sf_dir):
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
