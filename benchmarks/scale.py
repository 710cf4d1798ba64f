"""Larger trials on generated orders: ``python benchmarks/scale.py FOLDER [ROWS [PART OF A LABEL]]``.

The folder receives the generated tables once and keeps them for later runs.
Each line is the wall time of one complete result, after one warm-up.
"""

from __future__ import annotations

import os
import sys
import time
from datetime import timedelta

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from plumbline.operators.cooldown import alerts_with_cooldown  # noqa: E402
from plumbline.operators.dedup import first_per_key_by_rank  # noqa: E402
from plumbline.plans import enrich, semantic, validate  # noqa: E402
from plumbline.plans.shop_monitors import orders_monitor  # noqa: E402
from plumbline.session import build_session  # noqa: E402
from plumbline.sources import schemas  # noqa: E402
from plumbline.sources.generator import generate_orders  # noqa: E402
from plumbline.sources.shop import AS_OF, customers_from  # noqa: E402
from plumbline.streaming.validated_stream import ValidatedTable  # noqa: E402


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(label: str, run) -> None:
    if len(sys.argv) > 3 and sys.argv[3] not in label:
        return
    times = []
    for _ in range(2):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    print(f"{label:<58}{times[-1]:8.2f} s", flush=True)


def main() -> None:
    folder, n = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 10_000_000
    spark = build_session("plumbline-scale", f"local[{os.environ.get('BENCH_CPUS', '8')}]", **{
        "spark.sql.shuffle.partitions": "64", "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{folder}/orders-{n}"
    if not os.path.exists(path):
        generate_orders(spark, n, n // 10).repartition(32).write.parquet(f"{path}/even")
        even = schemas.read_table(spark, f"{path}/even", schemas.ORDERS)
        # A third of all rows under one order, and a third under one customer.
        third = F.pmod(F.xxhash64("order_id", "order_date"), F.lit(3)) == 0
        (even.withColumn("order_id", F.when(third, F.lit("HOT")).otherwise(F.col("order_id")))
         .withColumn("customer_id", F.when(third, F.lit("CUST-00000001")).otherwise(F.col("customer_id")))
         .write.parquet(f"{path}/hot"))
        validate.validated_orders(even).write.parquet(f"{path}/validated")
        customers = spark.range(1, n // 10 + 1).select(F.col("id").alias("c_custkey"))
        customers_from(customers).write.parquet(f"{path}/customers")
        spark.range(n).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("key"),
            F.timestamp_add("SECOND", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(365 * 86400)),
                            F.lit(AS_OF.isoformat(" ")).cast("timestamp_ntz")).alias("ts")
        ).write.parquet(f"{path}/violations")
    even = schemas.read_table(spark, f"{path}/even", schemas.ORDERS)
    hot = schemas.read_table(spark, f"{path}/hot", schemas.ORDERS)
    monitor = orders_monitor()

    print(f"{n} generated orders and their copies")
    timed("five metrics, one job each", lambda: [
        discard(a.metric.on(even, *a.columns, as_of=AS_OF)) for a in monitor.associations])
    timed("five metrics, fused", lambda: discard(monitor.measure(even, AS_OF)))
    timed("five metrics, fused, hot order", lambda: discard(monitor.measure(hot, AS_OF)))
    timed("validated table", lambda: discard(validate.validated_orders(even)))
    timed("validated table by row_number",
          lambda: discard(validate.score(first_per_key_by_rank(even, "order_id", "order_date"))))
    timed("validated table, hot order", lambda: discard(validate.validated_orders(hot)))
    timed("history over months", lambda: discard(monitor.history(
        hot, F.trunc("order_date", "month"), lambda b: F.add_months(b, 1).cast("timestamp_ntz"))))
    timed("enriched orders", lambda: discard(enrich.flat(enrich.enriched_orders(even))))

    stored = spark.read.parquet(f"{path}/validated")
    customers = schemas.read_table(spark, f"{path}/customers", schemas.CUSTOMERS)
    model = semantic.ORDER_QUALITY.bind(orders=stored, customers=customers)
    skewed = semantic.ORDER_QUALITY.bind(orders=validate.score(hot), customers=customers)
    timed("all metrics by tier, stored table", lambda: discard(model.query(semantic.ALL_METRICS, ["tier"])))
    timed("all metrics by tier, hot customer", lambda: discard(skewed.query(semantic.ALL_METRICS, ["tier"])))
    timed("facts with tier, hot customer", lambda: discard(
        skewed.query_rows(["order_total", "quality_score"], ["tier"], ["order_id"])))

    run = f"{path}/table-{int(time.time())}"
    table = ValidatedTable(spark, run)
    table.base.publish(stored)
    changed = even.sample(0.01, seed=1)
    timed("refresh with 1 % changed rows", lambda: table.refresh(changed, 0))
    timed("read of base and changes", lambda: discard(table.read()))

    violations = spark.read.parquet(f"{path}/violations")
    timed("alerts with cooldown, hot key", lambda: discard(
        alerts_with_cooldown(violations, ["key"], "ts", timedelta(hours=1))))
    spark.stop()


if __name__ == "__main__":
    main()
