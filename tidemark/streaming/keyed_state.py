"""Silver as Spark's own keyed state.

The Silver stream is a streaming ``groupBy(key).agg(max_by(row, order))`` in update
mode.  Spark keeps one row per key in its RocksDB state store under the query's
checkpoint, tombstones included, so

* a batch reads and writes the keys it touches only: the changelog files uploaded with a
  commit follow the batch, not the table;
* late, repeated and out-of-order events are harmless (the maximum is associative);
* restart, exactly-once and clean-up of old versions are Spark's: old snapshots and
  changelogs go when ``spark.sql.streaming.minBatchesToRetain`` batches have passed.

The state is read back with the ``statestore`` source, as of the newest batch or of an
earlier one that is still kept.  Key, tie-breaker and number of state partitions are
part of the checkpoint; Spark refuses another key or order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.entities import EntitySpec
from tidemark.operators.state import latest_per_key, silver_from_state
from tidemark.session import CODEC, FREE_SHUFFLES

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # keys and changes on disk; files written with another codec stay readable
    "spark.sql.streaming.stateStore.rocksdb.compression": CODEC,
    "spark.sql.streaming.stateStore.compression.codec": CODEC,
    FREE_SHUFFLES: "true",  # of each batch, when it ends
}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """The state settings for a query started inside; a query keeps the settings it started with."""
    wanted = dict(STATE_SETTINGS)
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def state_schema(spec: EntitySpec, tie_breaker: Sequence[str] = ()) -> T.StructType:
    """Bronze columns that the state keeps (all but the message text), and the tie-breakers."""
    fields = [f for f in spec.bronze_schema.fields if f.name != "raw_json"]
    return T.StructType(fields + [T.StructField(c, T.LongType(), True) for c in tie_breaker if c not in spec.bronze_columns])


def keyed_updates(bronze: DataFrame, spec: EntitySpec, tie_breaker: Sequence[str] = ()) -> DataFrame:
    """Streaming Bronze -> the newest row of every key that a batch touches (update mode)."""
    rows = bronze.select(*state_schema(spec, tie_breaker).names).where(bronze[spec.key].isNotNull())
    return latest_per_key(rows, spec.key, tie_breaker=tie_breaker)


def read_state(spark: SparkSession, checkpoint: str, spec: EntitySpec, tie_breaker: Sequence[str] = (),
               batch_id: int | None = None) -> DataFrame:
    """One row per key, newest event, tombstones kept, as of a batch (default: the newest).

    A stream that has not committed a batch yet has an empty state."""
    schema = state_schema(spec, tie_breaker)
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    try:
        state = reader.load(checkpoint)
    except AnalysisException as e:
        if batch_id is None and (e.getCondition() or "").startswith(("STDS_NO_COMMITTED_BATCH", "STDS_OFFSET_LOG_UNAVAILABLE")):
            return spark.createDataFrame([], schema)
        raise
    kept = state.schema["key"].dataType.names
    if kept != [spec.key]:
        raise ValueError(f"{checkpoint} holds state by {kept}, not by {spec.key!r}")
    return state.select("value.valueWithExtremumOrdering.*").select(*schema.names)


def read_silver(spark: SparkSession, checkpoint: str, spec: EntitySpec, tie_breaker: Sequence[str] = (),
                batch_id: int | None = None) -> DataFrame:
    """The Silver rows: the state without deleted keys."""
    return silver_from_state(read_state(spark, checkpoint, spec, tie_breaker, batch_id), spec)
