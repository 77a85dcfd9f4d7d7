"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the median counts.
Results go to the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from marketlake.registry import QUERIES
from marketlake.session import build_session

HEADLINE = [
    "agg_11_keep_last",
    "gld_02_dim_date",
    "gld_03_fact_daily_prices",
    "gld_04_fact_with_snapshot",
    "win_02_daily_return",
    "win_05_bollinger",
    "win_08_macd",
    "win_09_rsi",
    "win_16_snapshot",
    "win_17_indicator_series",
    "jn_02_fact_coins",
    "jn_08_top_coin_facts",
    "dsh_06_compare_price_usd_5",
    "dsh_07_avg_volume_sorted",
    "dsh_11_latest_candles",
    "dsh_15_symbols_close",
    "agg_16_candles_1m",
    "src_02_chart_objects",
    "snk_03_gold_partitioned",
    "pat_03_similar",
    "jn_07_similarity_join",
    "rec_03_fallback",
    "sum_01_market_summary",
    "str_04_stream_candles",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for turn in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            if turn:
                times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
