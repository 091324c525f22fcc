"""Time the headline queries on one node.

Tables from ``$BENCH_SF_DIR``, ``local[$BENCH_CPUS]``; prints one JSON line. A query that
takes less than ten seconds is run again and the faster run counts; results go to a sink that takes all
rows and keeps none.
``python bench.py NAME ...`` times other registered queries instead.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from marquee.session import get_session
from marquee.workload import QUERIES

HEADLINE = [
    "decade_trends",
    "tag_ratings",
    "cleaning_report",
    "dedup_by_key",
    "dedup_rows",
    "enrich_left",
    "enrich_left_measured",
    "daily_average",
    "low_rated_absolute",
    "low_rated_relative",
    "agg_distinct",
    "publish_json",
    "parse_json_messages",
    "tokenize",
    "term_counts",
    "term_vectors",
    "topic_mixture",
    "index_category",
    "one_hot",
    "assemble_features",
    "predict",
    "feature_importance",
    "revenue_rows",
    "low_rated_stream_absolute",
    "low_rated_stream_relative",
    "revenue_model",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "marquee-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="marquee-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start-up of the JVM and the first scan belong to no query.
    QUERIES["scan_table"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        runs: list[float] = []
        while not runs or (len(runs) < 2 and runs[0] < 10):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
