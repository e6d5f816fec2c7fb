"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the number of cores.
Each batch query runs three times, each stream query twice; the best time
counts. Results go through Spark's no-op sink, so every row and column is
computed. ``--compare`` adds how long the nine metrics take as nine separate
queries over the same input.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from orderflow.catalog import QUERIES, faulty_messages, message_stream  # noqa: E402
from orderflow.functions.parse import process  # noqa: E402
from orderflow.operators import metrics  # noqa: E402
from orderflow.operators.windows import orders_in_last_minute, windowed_orders  # noqa: E402
from orderflow.plans.rollup import metrics_snapshot  # noqa: E402
from orderflow.session import build_session, new_folder, staged  # noqa: E402
from orderflow.sources.views import event_transactions, line_transactions  # noqa: E402
from orderflow.streaming.jobs import start_stream  # noqa: E402

BATCH = [
    "kpis",
    "revenue_by_category",
    "orders_by_city",
    "payment_method_distribution",
    "order_status_distribution",
    "total_amounts",
    "filter_transactions",
    "city_facet",
    "line_metrics",
    "event_kpis",
    "event_metrics",
    "windowed_orders",
    "sliding_windowed_orders",
    "orders_in_last_minute",
    "recent_transactions",
    "message_round_trip",
    "refused_by_reason",
]
STREAMS = ["stream_kpis", "stream_windowed_orders", "stream_snapshot"]
REPEATS = 3
STREAM_REPEATS = 2


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action, repeats: int = 1) -> float:
    times = []
    for _ in range(repeats):
        started = time.perf_counter()
        action()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def ingest_rate(spark, folder: str) -> tuple[int, float]:
    """Messages through the stored stream in one micro-batch, and the seconds it took."""
    messages = faulty_messages(event_transactions(spark, folder))
    count = messages.count()
    stream = process(message_stream(spark, messages, batches=1))
    root = new_folder(spark, "bench-store")
    taken = seconds(
        lambda: start_stream(stream, root, trigger={"availableNow": True}).awaitTermination()
    )
    return count, taken


def compare(spark, folder: str) -> dict[str, float]:
    """All metrics in one plan, and as one query each, over the same stored rows."""
    found = {}
    for name, view in (("lines", line_transactions), ("events", event_transactions)):
        rows = staged(view(spark, folder), f"bench-{name}")

        def separate():
            for metric in metrics.METRICS.values():
                if metric is not metrics.kpis:
                    run(metric(rows))
            run(orders_in_last_minute(rows))
            run(windowed_orders(rows))

        run(metrics_snapshot(rows))
        found[f"{name}_one_plan"] = seconds(lambda: run(metrics_snapshot(rows)), REPEATS)
        found[f"{name}_separate"] = seconds(separate, REPEATS)
    return found


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "orderflow-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["kpis"](spark, folder))
    run(QUERIES["event_kpis"](spark, folder))

    times = {name: seconds(lambda: run(QUERIES[name](spark, folder)), REPEATS) for name in BATCH}
    times.update(
        {name: seconds(lambda: run(QUERIES[name](spark, folder)), STREAM_REPEATS) for name in STREAMS}
    )
    count, taken = ingest_rate(spark, folder)
    result = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
        "cpus": int(cpus),
        "ingest_rows_per_sec": round(count / taken),
    }
    if "--compare" in sys.argv:
        result["compare"] = compare(spark, folder)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
