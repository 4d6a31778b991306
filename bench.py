"""Time the headline queries: one JSON line.

BENCH_SF_DIR   folder of Parquet files (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query after one warm-up (default 3); the median counts

Every run builds the query anew and consumes every column of every row; nothing is cached between runs.  Models are
trained once, timed as ``train_models`` and ``permutation_importance``, since the scoring job reads finished models; both
cold runs count in the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from larkspur import build_session  # noqa: E402
from larkspur.catalog import QUERIES, lab, tables  # noqa: E402
from larkspur.operators.scale import work_folder  # noqa: E402
from larkspur.plans import exports  # noqa: E402
from larkspur.sources.star import AS_OF  # noqa: E402

HEADLINES = [
    "channel_performance",
    "channel_performance_by_year",
    "retention_monthly",
    "retention_orders_monthly",
    "running_channel_cost",
    "spend_rank_in_country",
    "ltv_features",
    "churn_features",
    "target_summary",
    "spend_trend_monthly",
    "completed_orders_with_country",
    "dq_foreign_key",
    "export_bundle",
    "batch_score_customers",
]


def consume(rows) -> None:
    rows.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "larkspur-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def train_models() -> None:
        models = lab(spark, folder)
        models.churn_forest(), models.propensity_balanced(), models.ltv_forest()

    seconds = {"train_models": timed(train_models)}
    seconds["permutation_importance"] = timed(lambda: consume(QUERIES["permutation_importance"](spark, folder)))
    for name in HEADLINES:
        run = lambda name=name: consume(QUERIES[name](spark, folder))
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(repeats))
    # ``export_bundle`` reads back and parses what it wrote; this is the writing alone, and not part of the sum.
    document = f"{work_folder(spark)}/bench.json"
    write = lambda: exports.export_bundle(tables(spark, folder), AS_OF, document)
    alone = statistics.median(timed(write) for _ in range(repeats))
    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "training, importance (cold) and headline queries (warm medians), summed",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "export_bundle_write": round(alone, 3),
                "sf": folder.rsplit("/sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
