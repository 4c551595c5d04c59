"""Time the headline queries: one JSON line with the warm median of up to three runs per query."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelwright.plans import QUERIES  # noqa: E402
from panelwright.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_momentum_quintiles",
    "s02_tick_bars",
    "r01_densify",
    "w08_rank_per_date",
    "x02_standardize",
    "x04_qcut_global",
    "x05_neutralize_two_factors",
    "x08_population_split",
    "t03_williams_r_14",
    "t05_adx",
    "t13_past_returns",
    "t14_future_returns",
    "t15_beta",
    "t17_liquidity",
    "j01_merge_feature_tables",
    "j08_asof_backward",
    "j09_filings_asof_daily",
    "j15_paths_after_strikes",
    "m05_ensemble",
    "g02_return_summary",
    "i02_contribution_shares",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))  # warm runs, of every query alike
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    first, warm = {}, {}
    for name in names:
        first[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(statistics.median([run(spark, name, sf_dir) for _ in range(runs)]), 3)
        print(f"{name}: first {first[name]}, warm {warm[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "first_run": first,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "shuffle_partitions": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
