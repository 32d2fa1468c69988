"""Headline queries timed on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

The tables are first laid out, untimed, in as many files as there are threads: each comes as one file with one
row group, which a single task would read, and tables of any size have many.  Each query then runs once
untimed, which loads and compiles its code, and is timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from listing_lake import catalog
from listing_lake.session import build_session

HEADLINE = [
    "clean_numbers", "price_to_clp", "price_by_comuna", "level_lookup", "retry_queue", "keep_latest", "merge_upsert",
    "stats_kv", "group_quantiles", "neighbors_300m", "sector_price", "age_cascade", "point_in_polygon",
    "listing_text_fields", "poi_summary", "ensemble_score", "calibrate", "state_fold", "bronze_to_predictions",
]


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()


def laid_out(spark, folder: str, files: int) -> str:
    """The folder's tables with the same rows in ``files`` files each."""
    target = tempfile.mkdtemp(prefix="bench-tables-")
    for name in TABLES:
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(files).write.parquet(f"{target}/{name}.parquet")
    return target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, tables = catalog.queries(), laid_out(spark, folder, int(cpus))

    def run(name: str) -> float:
        started = time.perf_counter()
        queries[name](spark, tables).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    for name in names:
        run(name)
    seconds = {name: run(name) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
