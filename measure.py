
from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from showcase.batch import _addressed  # noqa: E402
from showcase.inputs import ip_ranges, raw_orders  # noqa: E402
from showcase.registry import load  # noqa: E402
from showcase.streams import _keys, _timed_lines, topic_of  # noqa: E402
from tallyflow.functions.net import ipv4_to_long  # noqa: E402
from tallyflow.operators.lookups import locate_ips  # noqa: E402
from tallyflow.operators.parsing import timed_words  # noqa: E402
from tallyflow.plans.orders import enrich_orders  # noqa: E402
from tallyflow.session import build_session  # noqa: E402
from tallyflow.sinks.keyed import STREAM, keyed_table  # noqa: E402
from tallyflow.sinks.streams import keyed_sink, topic_sink  # noqa: E402
from tallyflow.streaming.lifecycle import drain  # noqa: E402
from tallyflow.streaming.stateful import first_per_key, flat_windows, windowed_counts  # noqa: E402
from tallyflow.workspace import file_system, new_folder  # noqa: E402


def best(action, runs: int = 3) -> float:
    took = []
    for _ in range(runs):
        began = time.perf_counter()
        action()
        took.append(time.perf_counter() - began)
    return min(took)


def noop(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def size_of(spark, path: str) -> int:
    fs, hadoop_path = file_system(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("measure", "local[8]", 8, overrides={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")

    ranges, events = ip_ranges(spark, folder), _addressed(spark, folder)
    numbered = events.withColumn("n", ipv4_to_long("ip"))
    plain = numbered.join(F.broadcast(ranges), F.col("n").between(F.col("ip_from"), F.col("ip_to")), "left")
    blocks, between = best(lambda: noop(locate_ips(events, ranges))), best(lambda: noop(plain))
    print(f"lookup: blocks {blocks:.2f} s, BETWEEN {between:.2f} s, ratio {between / blocks:.1f}")

    orders = load(spark, folder, "orders")
    for percent in (1, 50):
        table = keyed_table(spark, new_folder(spark, "measured"), "o_orderkey")
        table.upsert(orders, 0, unique=True)
        changed = orders.where(F.col("o_orderkey") % 100 < percent).withColumn("o_totalprice", F.col("o_totalprice") + 1)
        write = best(lambda: table.upsert(changed, unique=True), 1)
        read = best(lambda: noop(table.read()))
        base, whole = size_of(spark, f"{table.path}/{STREAM}=main"), size_of(spark, table.path)
        print(f"upsert {percent}%: {write:.2f} s, {whole - base:,} B beside {base:,} B written, read {read:.2f} s")

    def stream(label, count, rows, keys=None):
        path = new_folder(spark, label)
        table = keyed_table(spark, f"{path}/table", *(keys or ()))
        writer = keyed_sink(rows, table, f"{path}/ck") if keys else topic_sink(rows, f"{path}/ck", f"{path}/out", file_format="parquet")
        began = time.perf_counter()
        query = drain(writer)[0]
        took = time.perf_counter() - began
        state = sum(s["numRowsTotal"] for s in query.recentProgress[0]["stateOperators"])
        print(f"{label}: {took:.2f} s, {count / took:,.0f} rows/s, {state:,} state rows")

    for _ in range(2):  # the first round warms up
        number = load(spark, folder, "events").count()
        timed = timed_words(_timed_lines(spark, folder, True))
        windows = flat_windows(windowed_counts(timed, length="2 hours", slide="1 hour"))
        stream("sliding window", number, windows, ("window_start", "word"))
        stream("dedup", number, first_per_key(_keys(spark, folder), ["user_id", "event_type"]))
        stream("order etl", orders.count(), enrich_orders(topic_of(spark, "raw-orders", raw_orders(orders)), ranges))
    spark.stop()


if __name__ == "__main__":
    main()
