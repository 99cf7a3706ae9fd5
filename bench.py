"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the local threads. Results are
computed in full and discarded, so nothing is saved by pruning columns or rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from marginalia import storage  # noqa: E402
from marginalia.plans.catalog import QUERIES  # noqa: E402
from marginalia.session import build_session  # noqa: E402
from marginalia.sources.retail import retail_lines  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def clock(name: str, work) -> None:
        start = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - start, 3)
        # Standard output is for the one result line; a run that is stopped still shows its times.
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    # Cleaning the lines is paid once, as every later query reads the staged table.
    clock("stage_lines", lambda: retail_lines(spark, sf_dir))
    for name in names:
        clock(name, lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("/sf", 1)[-1],
            }
        )
    )
    storage.release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
