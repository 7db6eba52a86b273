"""Compare one joint profile with profiling the same columns one by one.

Stands in for the per-column style of work (several jobs for every column), which the engine
avoids. Usage: ``python benchmarks/column_at_a_time.py [folder] [table]``.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import session  # noqa: E402
from siftwell import OutlierDetector, profile  # noqa: E402


def timed(spark, label, work):
    group = f"{label}-{time.time()}"
    spark.sparkContext.setJobGroup(group, label)
    started = time.perf_counter()
    work()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    print(f"{label:28s} {time.perf_counter() - started:7.2f} s {jobs:5d} jobs", flush=True)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    table = sys.argv[2] if len(sys.argv) > 2 else "lineitem"
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "integer")]
    for attempt in ("cold", "warm"):
        timed(spark, f"profile, joint ({attempt})", lambda: profile(df).columns.collect())
        timed(
            spark,
            f"profile, by column ({attempt})",
            lambda: [profile(df.select(c)).columns.collect() for c in df.columns],
        )
        timed(spark, f"fences, joint ({attempt})", lambda: OutlierDetector(numeric).fit(df))
        timed(
            spark,
            f"fences, by column ({attempt})",
            lambda: [OutlierDetector([c]).fit(df) for c in numeric],
        )


if __name__ == "__main__":
    main()
