"""Benchmark the medallion layers at $BENCH_SF_DIR on local[$BENCH_CPUS].

Steps (each timed, each writing its output as parquet the way the layers are
tables in production):
  derive_topics          driver tables -> change envelopes (test input, like a topic)
  bronze_<entity>        decode envelopes -> Bronze
  silver_<entity>        Bronze -> latest state per key, deletes applied
  gold_<mart>            Silver -> marts
  dq_*                   quality checks over Silver / Bronze
  silver_payments_stream Bronze files -> Spark's keyed state (~8 micro-batches), and a read of it
  e2e_gold_daily_revenue the registered flagship query from the raw tables
Prints one JSON line; ``value`` is the sum over the layer steps (topic
derivation and the end-to-end query are reported on their own, outside the sum).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.entities import ENTITIES  # noqa: E402
from tidemark.functions.envelope import decode_envelope  # noqa: E402
from tidemark.operators import marts, quality  # noqa: E402
from tidemark.operators.state import silver  # noqa: E402
from tidemark.plans.queries import QUERIES  # noqa: E402
from tidemark.session import build_session, scratch_path  # noqa: E402
from tidemark.sources import testdata as td  # noqa: E402
from tidemark.streaming.jobs import start_silver  # noqa: E402
from tidemark.streaming.keyed_state import read_silver  # noqa: E402

TOPIC_FILES = 16
NAMES = ("customers", "orders", "payments", "transactions")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, app="tidemark-bench")
    root = scratch_path(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    def write(df, path):
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    # warm-up (JIT, file listing); not timed
    QUERIES["bronze_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    topics = {}
    t0 = time.time()
    for e in NAMES:
        # a topic has many partitions: the derived one is written in a stated number of files
        topics[e] = write(td.topic_records(spark, sf_dir, e).repartition(TOPIC_FILES), f"{root}/topic/{e}")
    derive = round(time.time() - t0, 3)

    bronze, silv = {}, {}
    for e in NAMES:
        bronze[e] = timed(f"bronze_{e}", lambda e=e: write(decode_envelope(topics[e], ENTITIES[e]), f"{root}/bronze/{e}"))
    for e in NAMES:
        silv[e] = timed(f"silver_{e}", lambda e=e: write(silver(bronze[e], ENTITIES[e]), f"{root}/silver/{e}"))
    timed("gold_customer_order_summary", lambda: write(
        marts.customer_order_summary(silv["customers"], silv["orders"], silv["payments"]), f"{root}/gold/cos"))
    timed("gold_order_payment_status", lambda: write(
        marts.order_payment_status(silv["orders"], silv["payments"], silv["transactions"]), f"{root}/gold/ops"))
    timed("gold_daily_revenue", lambda: write(
        marts.daily_revenue(silv["orders"], silv["payments"], silv["transactions"]), f"{root}/gold/dr"))
    timed("dq_silver_pk", lambda: quality.pk_violations(
        {f"{e}_silver": (silv[e], ENTITIES[e].key) for e in NAMES}).collect())
    timed("dq_change_log", lambda: [quality.validate_change_log(bronze[e], ENTITIES[e].key).collect() for e in NAMES])

    def stream():
        q = start_silver(spark, f"{root}/bronze/payments", ENTITIES["payments"], f"{root}/_ckpt/payments", available_now=True,
                         max_files_per_trigger=max(1, TOPIC_FILES // 8), if_running="replace")
        q.awaitTermination()
        return read_silver(spark, f"{root}/_ckpt/payments", ENTITIES["payments"]).count()
    # about 8 micro-batches into Spark's keyed state, then one full read of it
    timed("silver_payments_stream", stream)
    layers = round(sum(times.values()), 3)
    timed("e2e_gold_daily_revenue", lambda: QUERIES["gold_daily_revenue"](spark, sf_dir)
          .write.format("noop").mode("overwrite").save())
    times["derive_topics"] = derive
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "medallion_layers_seconds",
        "value": layers,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
