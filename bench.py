"""Wall times of the registered queries; prints one JSON line.

`queries` derives the postings from the supplied tables and answers, each query from
scratch. `stored` asks the same questions of a posting table that has been written once,
as a service would. The first query also pays for the start of the session.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.compare import local_session
from checks.inputs import jobs
from checks.queries import QUERIES, STORED
from rolecall.sources import read_postings, shared_dir

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def seconds(query: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    query().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS)
    jobs(spark, SF_DIR).limit(1).collect()
    times = {key: seconds(lambda: query(spark, SF_DIR)) for key, query in QUERIES.items()}

    path = shared_dir(spark)
    jobs(spark, SF_DIR).write.parquet(path)
    postings = read_postings(spark, path)
    stored = {
        key: sorted(seconds(lambda: question(postings)) for _ in range(3))[1]
        for key, question in STORED.items()
    }
    print(
        json.dumps(
            {
                "metric": "total wall time of all registered queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stored": stored,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
