"""Time the headline queries; prints one JSON line.

Each figure is the median of three runs after a warm-up, writing to Spark's `noop` sink.
The archive that `scan_ticks` and `regime_job` read is written before their timed runs.
`rolling_week_frame`, which is left out of the total, and `rolling_week_running` give the same sums, by Spark's sliding
frame and by running totals.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from datetime import timedelta

from tidebar.operators.bars import day_bars
from tidebar.operators.rolling import Roll, rolling
from tidebar.operators.tail import FAN_KEYS, fan_out, spread_blocks
from tidebar.plans import queries as q
from tidebar.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
COMPARATOR = "rolling_week_frame"


def _rolling_week(method: str):
    def query(spark, sf):
        events = q._events(spark, sf)
        _, last = q._day_range(events)
        fanned = fan_out(spread_blocks(day_bars(q._ticks(events)), last - timedelta(1), last))
        return rolling(
            fanned, [Roll("week", "ret2_1m", "sum", 10080, 4320)], FAN_KEYS, method=method
        )

    return query


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions="16",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("OFF")
    named = q.queries()
    chosen = {
        name: named[name]
        for name in (
            "minute_bars",
            "log_returns_by_day",
            "day_clip",
            "rolling_sum_min",
            "rolling_mean_min",
            "rolling_std_min",
            "rolling_zscore",
            "tail_fanout",
            "trend24",
            "rv24_z168",
            "regime_features_default_windows",
            "regime_features_all",
            "epoch_unit_detect",
            "numeric_coerce",
            "status_by_symbol",
            "scan_ticks",
            "regime_job",
        )
    }
    chosen |= {f"rolling_week_{m}": _rolling_week(m) for m in ("frame", "running")}
    seconds = {}
    for name, query in chosen.items():
        times = []
        for _ in range(RUNS + 1):
            began = time.perf_counter()
            query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of all queries but the comparator (median of 3 warm runs each)",
                "value": round(sum(v for k, v in seconds.items() if k != COMPARATOR), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
