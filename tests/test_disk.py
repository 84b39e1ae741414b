"""What a query keeps on disk: shuffles freed with each write, files compressed for texts, no second copy of a layer."""

import os
import tempfile
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.plans import layer_queries, queries
from tidemark.session import checkpoint_root, drop_staged, stage
from tidemark.sources import testdata as td

SF = "/root/testdata/sf0.001"


def shuffle_blocks(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def left_over(spark, before, seconds=10):
    """Shuffle blocks that stay (they are removed beside the query, so it may take a moment)."""
    until = time.time() + seconds
    while (left := shuffle_blocks(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def data_files(root):
    return {os.path.join(at, f) for at, _, files in os.walk(root.removeprefix("file:")) for f in files if f.endswith(".parquet")}


def codecs(files):
    found = set()
    for f in files:
        m = pq.ParquetFile(f).metadata
        found |= {m.row_group(g).column(0).compression for g in range(m.num_row_groups)}
    return found


def built(spark, name):
    """(rows, parquet files the query left, shuffle blocks its own writes left)"""
    root, before = checkpoint_root(spark), shuffle_blocks(spark)
    files = data_files(root)
    df = {**queries.QUERIES, **layer_queries.QUERIES}[name](spark, SF)
    left = left_over(spark, before)
    return df, data_files(root) - files, left


def test_staged_rows_are_kept_and_their_shuffle_is_not(spark):
    root, before = tempfile.mkdtemp(prefix="tidemark-stage-"), shuffle_blocks(spark)
    df = stage(spark.range(1000).repartition(3).withColumn("t", F.lit("x")), f"{root}/a")
    assert not left_over(spark, before) and codecs(data_files(root)) == {"ZSTD"}
    assert sorted(r.id for r in df.collect()) == list(range(1000)) and df.columns == ["id", "t"]
    drop_staged(spark, f"{root}/a")
    assert os.listdir(root) == []


# query -> what its returned plan may not hold: max_by reduces a whole log, which is to be done once and written; an Exchange in a
# report means that the logs' shuffles lie on disk side by side
FIXED = {
    "silver_transactions_replay": (),  # F1
    "dq_table_files": (),  # F2
    "catalog_layer_counts": ("Exchange",),  # F3
    "dq_pk_exists": ("max_by",),  # F4
    "gold_daily_revenue_table": ("max_by",),  # F5
    "gold_order_payment_status": ("max_by",),  # F6
    "gold_order_payment_status_latest": ("max_by",),  # F7
    "gold_daily_revenue": ("max_by",),  # F8
    "gold_order_payment_status_bucketed": ("max_by",),  # F9
    "silver_payments_stream": (),  # F10
    "dq_change_log": ("Exchange",),  # F11
    "dq_order_kept": ("Exchange",),  # F12
    "dq_silver_pk": ("max_by",),  # F13
    "dq_gold_keys": ("max_by",),  # F14
    "dq_table_counts": ("max_by",),  # F15
    "dq_duplicate_counts": ("max_by",),  # F16
    "adhoc_report_by_date": ("max_by",),  # F17
}


@pytest.mark.parametrize("name", FIXED)
def test_query_leaves_no_shuffles_of_its_steps_and_small_files(spark, name):
    df, files, left = built(spark, name)
    assert not left and codecs(files) == {"ZSTD"}
    plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FIXED[name] if word in plan]
    assert not any("/topic/" in f for f in files)  # a topic goes when Bronze holds it
    # Bronze is kept once, with its texts
    texts = [pq.ParquetFile(f).metadata.num_rows for f in files if {"raw_json", "payment_id"} < (names := set(pq.read_schema(f).names)) and "txn_type" not in names]
    payments = td.payments_changes(spark, SF).count()
    assert sum(texts) == (0 if name == "silver_transactions_replay" else payments)
    df.collect()
