import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import order_bronze, rows_of, ts
from tidemark.entities import ORDERS, PAYMENTS
from tidemark.operators.state import silver
from tidemark.sources import testdata as td
from tidemark.streaming import (
    BatchTotals, drain, guard_running, read_silver, read_state, read_topic, run_folder, start_all, start_bronze,
    start_minimal_events_jsonl, start_silver,
)

SF = "/root/testdata/sf0.001"


def fresh():
    return tempfile.mkdtemp(prefix="tidemark-stream-")


def write_topic(spark, root, entity, files=4, name="d0"):
    td.topic_records(spark, SF, entity).repartition(files, F.xxhash64("value")).write.parquet(f"{root}/topic/{name}")


def test_stream_equals_batch(spark):
    root = fresh()
    write_topic(spark, root, "payments")
    qb = start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic/*", max_files_per_trigger=1),
                      PAYMENTS, f"{root}/bronze", f"{root}/ck/b", available_now=True)
    qb.awaitTermination()
    assert len(qb.recentProgress) >= 4  # one file per micro-batch
    bronze = spark.read.schema(PAYMENTS.bronze_schema).parquet(f"{root}/bronze")
    batch_bronze = td.bronze(spark, SF, "payments")
    assert bronze.count() == batch_bronze.count()
    qs = start_silver(spark, f"{root}/bronze", PAYMENTS, f"{root}/ck/s", available_now=True, max_files_per_trigger=1)
    qs.awaitTermination()
    assert len(qs.recentProgress) >= 4
    cols = PAYMENTS.silver_columns
    assert sorted(map(tuple, read_silver(spark, f"{root}/ck/s", PAYMENTS).select(*cols).collect())) == \
        sorted(map(tuple, silver(batch_bronze, PAYMENTS).select(*cols).collect()))


def run_silver(spark, root, *batches, **options):
    """Each batch of Bronze rows is appended and taken by a run of its own on the same checkpoint."""
    for rows in batches:
        order_bronze(spark, rows).coalesce(1).write.mode("append").parquet(f"{root}/bronze")
        q = start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/ck", available_now=True, **options)
        q.awaitTermination()
    return q


def status(spark, root, **options):
    return rows_of(read_silver(spark, f"{root}/ck", ORDERS, **options), "order_id", "status")


def test_state_through_restarts_repeats_deletes_and_late_events(spark):
    root = fresh()
    change = [("u", 1, "B", 1, 2, 2), ("d", 2, "A", 1, 2, 2)]
    run_silver(spark, root, [("c", 1, "A", 1, 1, 1), ("c", 2, "A", 1, 1, 1)], change, change)
    assert status(spark, root) == [(1, "B")]
    # a late event for the deleted key arriving in a later run does not bring it back, a newer one does
    run_silver(spark, root, [("u", 2, "LATE", 1, 1, 9)])
    assert status(spark, root) == [(1, "B")]
    run_silver(spark, root, [("c", 2, "AGAIN", 1, 3, 3), ("u", None, "no key", 1, 9, 9)])
    assert status(spark, root) == [(1, "B"), (2, "AGAIN")]
    assert status(spark, root, batch_id=0) == [(1, "A"), (2, "A")]  # as of an earlier batch
    assert read_state(spark, f"{root}/ck", ORDERS, batch_id=1).where("op = 'd'").count() == 1


def test_state_rows_follow_the_batch(spark):
    root = fresh()
    run_silver(spark, root, [("c", k, "A", 1, 1, 1) for k in range(500)])
    q = run_silver(spark, root, [("u", 3, "B", 1, 2, 2), ("u", 3, "C", 1, 3, 3), ("d", 4, "A", 1, 2, 2)], changes_path=f"{root}/changes")
    op = q.lastProgress.stateOperators[0]
    assert (q.lastProgress.numInputRows, op.numRowsUpdated, op.numRowsTotal) == (3, 2, 500)
    changed = spark.read.parquet(f"{root}/changes/batch_id={q.lastProgress.batchId}")
    assert rows_of(changed, "order_id", "op", "status") == [(3, "u", "C"), (4, "d", "A")]
    assert len(status(spark, root)) == 499


def test_state_of_nothing_and_of_another_key(spark):
    root = fresh()
    spark.createDataFrame([], ORDERS.bronze_schema).write.parquet(f"{root}/bronze")
    start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/ck", available_now=True).awaitTermination()
    assert status(spark, root) == []
    run_silver(spark, root, [("c", 1, "A", 1, 1, 1)])
    with pytest.raises(ValueError, match="holds state by"):
        read_silver(spark, f"{root}/ck", PAYMENTS)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")  # put back


def test_batches_are_limited_by_bytes(spark):
    root = fresh()
    write_topic(spark, root, "orders", files=6)
    size = max(os.path.getsize(f"{root}/topic/d0/{f}") for f in os.listdir(f"{root}/topic/d0") if f.endswith(".parquet"))
    q = start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic/*", max_bytes_per_trigger=int(2.5 * size)), ORDERS, f"{root}/bronze",
                     f"{root}/ck", available_now=True)
    q.awaitTermination()
    batches = [p.numInputRows for p in q.recentProgress if p.numInputRows]
    total = td.topic_records(spark, SF, "orders").count()
    assert sum(batches) == total and 3 <= len(batches) < 6 and max(batches) < total / 1.5
    with pytest.raises(ValueError, match="not both"):
        read_topic(spark, fmt="parquet", path=root, max_files_per_trigger=1, max_bytes_per_trigger=1)


def test_totals_of_observed_batches(spark):
    root = fresh()
    td.malformed_order_records(spark, SF).repartition(3).write.parquet(f"{root}/topic")
    totals = BatchTotals()
    spark.streams.addListener(totals)
    try:
        q = start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic", max_files_per_trigger=1), ORDERS, f"{root}/bronze", f"{root}/ck",
                         available_now=True, metrics="orders_counts")
        q.awaitTermination()
        totals.wait(q)
    finally:
        spark.streams.removeListener(totals)
    bronze = spark.read.schema(ORDERS.bronze_schema).parquet(f"{root}/bronze")
    got = totals.totals["orders_counts"]
    assert len(q.recentProgress) >= 3 and got["cnt"] == bronze.count() > 0
    assert got["null_ops"] == bronze.where("op IS NULL").count() > 0
    assert got["rows_with_errors"] > 0 and totals.totals["orders_counts_topic"]["null_messages"] > 0
    assert "cast_errors" not in spark.read.parquet(f"{root}/bronze").columns


def test_replay_vs_resume(spark):
    root = fresh()
    write_topic(spark, root, "orders", files=2)
    ck = run_folder(f"{root}/ck", "orders_bronze", "resume")
    assert ck == run_folder(f"{root}/ck", "orders_bronze", "resume")
    assert run_folder(f"{root}/ck", "x", "replay") != run_folder(f"{root}/ck", "x", "replay")
    with pytest.raises(ValueError):
        run_folder(root, "x", "rewind")
    src = lambda: read_topic(spark, fmt="parquet", path=f"{root}/topic/*")
    start_bronze(src(), ORDERS, f"{root}/bronze", ck, available_now=True).awaitTermination()
    n1 = spark.read.parquet(f"{root}/bronze").count()
    # resume: nothing new -> no new rows
    start_bronze(src(), ORDERS, f"{root}/bronze", ck, available_now=True).awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == n1
    # new data arrives -> resume picks up only it
    write_topic(spark, root, "orders", files=1, name="d1")
    start_bronze(src(), ORDERS, f"{root}/bronze", ck, available_now=True).awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 2 * n1
    # replay: fresh checkpoint *and* output version (a file sink skips batch ids
    # its folder already committed) re-reads everything -> Bronze holds copies,
    # Silver is unchanged
    replay = run_folder(f"{root}/bronze_runs", "orders_bronze", "replay")
    start_bronze(src(), ORDERS, f"{replay}/data", f"{replay}/_ckpt", available_now=True).awaitTermination()
    b = spark.read.schema(ORDERS.bronze_schema).parquet(f"{root}/bronze", f"{replay}/data")
    assert b.count() == 4 * n1
    assert silver(b, ORDERS).count() == silver(td.bronze(spark, SF, "orders"), ORDERS).count()


def test_guard_running_and_start_all(spark):
    root = fresh()
    write_topic(spark, root, "orders", files=1)
    src = read_topic(spark, fmt="parquet", path=f"{root}/topic/*")
    q = start_bronze(src, ORDERS, f"{root}/b", f"{root}/ck", trigger="1 second")
    try:
        with pytest.raises(RuntimeError):
            guard_running(spark, "orders_bronze", "error")
        q2 = start_bronze(src, ORDERS, f"{root}/b", f"{root}/ck", trigger="1 second", if_running="replace")
        assert not q.isActive and q2.isActive
        q2.stop()
    finally:
        for s in spark.streams.active:
            s.stop()
    qs = start_all([lambda: start_bronze(src, ORDERS, f"{root}/b2", f"{root}/ck2", available_now=True)])
    for s in qs:
        s.awaitTermination()


def test_minimal_events_jsonl(spark):
    root = fresh()
    write_topic(spark, root, "orders", files=1)
    src = read_topic(spark, fmt="parquet", path=f"{root}/topic/*")
    q = start_minimal_events_jsonl(src, f"{root}/out", f"{root}/ck", "resume", "orders-jsonl-consumer",
                                   available_now=True)
    q.awaitTermination()
    files = [f for f in os.listdir(f"{root}/out") if f.endswith(".json")]
    line = json.loads(open(os.path.join(root, "out", files[0])).readline())
    assert line["consumer_mode"] == "resume" and "ingested_at" in line and "order_id" in line
    assert spark.read.json(f"{root}/out").count() == td.topic_records(spark, SF, "orders").count()


def test_drain_barrier_over_live_bronze_and_silver(spark):
    root = fresh()
    write_topic(spark, root, "orders", files=3)
    # Silver polls the Bronze folder while Bronze is still being written
    spark.createDataFrame([], ORDERS.bronze_schema).write.parquet(f"{root}/bronze")

    def bronze():
        return start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic/*", max_files_per_trigger=1),
                            ORDERS, f"{root}/bronze", f"{root}/ck/b", trigger="1 second", if_running="replace")
    qs = start_all([bronze, lambda: start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/ck/s", trigger="1 second")])
    try:
        drain(qs)
        want = silver(td.bronze(spark, SF, "orders"), ORDERS).count()
        assert read_silver(spark, f"{root}/ck/s", ORDERS).count() == want
        first = qs[0]
        qs[0] = bronze()  # the running one is replaced and the checkpoint goes on
        assert not first.isActive and qs[0].isActive
        write_topic(spark, root, "orders", files=1, name="d1")
        drain(qs)
        assert read_silver(spark, f"{root}/ck/s", ORDERS).count() == want
        assert spark.read.parquet(f"{root}/bronze").count() == 2 * td.topic_records(spark, SF, "orders").count()
    finally:
        for q in qs:
            q.stop()


def test_hot_key_third_of_rows(spark):
    # one key holds a third of the events: result exact, reduce combines map-side
    from tidemark.operators.state import latest_per_key
    ev = [("u", 1, f"S{i}", 1, i, i) for i in range(300)] + [("c", k, "X", 1, 1, 1) for k in range(2, 602)]
    b = order_bronze(spark, ev).repartition(8)
    out = {r.order_id: r.status for r in silver(b, ORDERS).collect()}
    assert out[1] == "S299" and len(out) == 601
    plan = latest_per_key(b.drop("raw_json"), "order_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")  # partial below (after) the exchange in the tree text


def test_bronze_partitioned_by_ingest_date(spark):
    from tidemark.streaming.jobs import bronze_read_schema
    root = fresh()
    write_topic(spark, root, "customers", files=2)
    start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic/*"), td.SPECS["customers"],
                 f"{root}/bronze", f"{root}/ck/b", available_now=True, partition_by_date=True).awaitTermination()
    assert any(n.startswith("ingest_date=") for n in os.listdir(f"{root}/bronze"))
    b = spark.read.schema(bronze_read_schema(td.SPECS["customers"], True)).parquet(f"{root}/bronze")
    day = b.where("ingest_date = DATE'2024-01-02'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan
    assert day.count() == b.where(F.to_date("kafka_event_ts") == "2024-01-02").count() > 0
    start_silver(spark, f"{root}/bronze", td.SPECS["customers"], f"{root}/ck/s", available_now=True,
                 bronze_partitioned_by_date=True).awaitTermination()
    assert read_silver(spark, f"{root}/ck/s", td.SPECS["customers"]).count() == silver(td.bronze(spark, SF, "customers"), td.SPECS["customers"]).count()


def test_tie_breaker_end_to_end(spark):
    """Two changes of one commit: the later log position wins, also through the streams."""
    root = fresh()
    value = '{"op":"u","after":{"order_id":1,"status":"%s"},"source":{"ts_ms":5,"lsn":%d}}'
    rows = [("1", value % ("SECOND", 20), ts(0)), ("1", value % ("FIRST", 10), ts(0))]
    spark.createDataFrame(rows, "key string, value string, timestamp timestamp").write.parquet(f"{root}/topic")
    start_bronze(read_topic(spark, fmt="parquet", path=f"{root}/topic"), ORDERS, f"{root}/bronze", f"{root}/ck/b",
                 available_now=True, keep_lsn=True).awaitTermination()
    start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/ck/s", tie_breaker=("source_lsn",), available_now=True).awaitTermination()
    assert rows_of(read_silver(spark, f"{root}/ck/s", ORDERS, tie_breaker=("source_lsn",)), "order_id", "status") == [(1, "SECOND")]


def test_console_view_resumes(spark, tmp_path):
    from tidemark.functions import envelope_view
    from tidemark.streaming import start_console
    topic = str(tmp_path / "topic")

    def shown(mode):
        td.topic_records(spark, SF, "orders").limit(20).write.mode("append").parquet(topic)
        q = start_console(envelope_view(read_topic(spark, fmt="parquet", path=topic)), str(tmp_path / "ck"), mode,
                          name="tail_test", available_now=True)
        q.awaitTermination()
        return sum(p.numInputRows for p in q.recentProgress)

    assert [shown("resume"), shown("resume"), shown("replay")] == [20, 20, 60]


def test_console_view_shows_the_first_rows_of_all_it_reads(spark, tmp_path, capsys):
    """Every message is read and decoded once; the first rows of the batch are shown."""
    from tidemark.functions import envelope_view
    from tidemark.streaming import start_console
    value = '{"payload":{"op":"c","after":{"status":"%s"}}}'
    text = "x" * 500
    rows = spark.range(0, 20_000, numPartitions=3).selectExpr(
        "cast(id as string) AS key", f"replace('{value}', '%s', concat('{text}', id)) AS value", "timestamp_millis(id) AS timestamp")
    rows.write.parquet(str(tmp_path / "topic"))
    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda v: seen.add(1) or v, "string").asNondeterministic()
    view = envelope_view(read_topic(spark, fmt="parquet", path=str(tmp_path / "topic")).withColumn("value", count("value")))
    q = start_console(view, str(tmp_path / "ck"), name="tail_few", available_now=True)
    q.awaitTermination()
    assert sum(p.numInputRows for p in q.recentProgress) == 20_000 and seen.value == 20_000
    out = capsys.readouterr().out
    assert "Batch: 0" in out and "only showing top 20 rows" in out and out.count(text) == 20


def test_failure_of_one_query_stops_the_unit(spark, tmp_path):
    from tidemark.streaming import await_all

    def fail(df, batch):
        raise ValueError("broken sink")

    def start(name, sink):
        rate = spark.readStream.format("rate").load()
        return (rate.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / name))
                .trigger(processingTime="1 second").start())
    good, bad = start("good", lambda df, batch: None), start("bad", fail)
    with pytest.raises(Exception, match="broken sink"):
        await_all([good, bad])
    assert not good.isActive and not bad.isActive
