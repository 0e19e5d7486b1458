"""Time every query over ``$BENCH_SF_DIR`` and print one JSON line.

Each query runs whole, into a sink that discards its rows. ``store_comments`` is the time to
derive the day-partitioned comment table that the statistics start from.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    from palaver.plans import catalog
    from palaver.session import build_session, release

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
        },
    )
    seconds: dict[str, float] = {}

    def timed(name: str, job) -> None:
        start = time.time()
        job()
        seconds[name] = round(time.time() - start, 3)

    spark.range(1000).selectExpr("sum(id)").collect()
    timed("store_comments", lambda: catalog.raw(spark, sf_dir).count())
    for name, query in catalog.queries().items():
        if not only or name in only:
            timed(name, lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total time of all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]),
                "cpus": int(cpus),
            }
        )
    )
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
