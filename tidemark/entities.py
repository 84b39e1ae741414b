"""Entity specifications: one ``EntitySpec`` per source table generates every layer schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Ordering of change events: newest event wins.  Both columns come from the
# event itself (commit time, then broker time), never from arrival order.
ORDER_COLUMNS = ("source_ts_ms", "kafka_event_ts")

# Lineage columns Silver keeps, renamed from Bronze.
LINEAGE_RENAMES = {
    "op": "bronze_op",
    "source_ts_ms": "bronze_source_ts_ms",
    "kafka_event_ts": "bronze_kafka_event_ts",
}

AMOUNT_TYPE = T.DecimalType(12, 2)
# sum() over decimal(12,2) widens by 10 digits
SUM_AMOUNT_TYPE = T.DecimalType(22, 2)


@dataclass(frozen=True)
class EntitySpec:
    """A source table: name, primary key and typed payload columns."""

    name: str
    key: str
    columns: tuple[tuple[str, T.DataType], ...]
    foreign_keys: tuple[str, ...] = field(default=())

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def payload_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, True) for c, t in self.columns])

    @property
    def text_payload_schema(self) -> T.StructType:
        """Payload as it travels in JSON: every field read as text, cast later."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c, _ in self.columns])

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField("kafka_event_ts", T.TimestampType(), True),
             T.StructField("op", T.StringType(), True)]
            + list(self.payload_schema.fields)
            + [T.StructField("source_ts_ms", T.LongType(), True),
               T.StructField("raw_json", T.StringType(), True)]
        )

    @property
    def bronze_columns(self) -> list[str]:
        return [f.name for f in self.bronze_schema.fields]

    @property
    def silver_columns(self) -> list[str]:
        return self.column_names + list(LINEAGE_RENAMES.values())

    @property
    def bronze_table(self) -> str:
        return f"{self.name}_bronze"

    @property
    def silver_table(self) -> str:
        return f"{self.name}_silver"


_TS = T.TimestampType()
_L = T.LongType()
_S = T.StringType()

CUSTOMERS = EntitySpec(
    "customers", "customer_id",
    (("customer_id", _L), ("full_name", _S), ("email", _S), ("country", _S),
     ("created_at", _TS), ("updated_at", _TS)),
)
ORDERS = EntitySpec(
    "orders", "order_id",
    (("order_id", _L), ("customer_id", _L), ("status", _S), ("amount", AMOUNT_TYPE),
     ("created_at", _TS), ("updated_at", _TS)),
    foreign_keys=("customer_id",),
)
PAYMENTS = EntitySpec(
    "payments", "payment_id",
    (("payment_id", _L), ("order_id", _L), ("customer_id", _L), ("payment_method", _S),
     ("payment_status", _S), ("amount", AMOUNT_TYPE), ("created_at", _TS), ("updated_at", _TS)),
    foreign_keys=("order_id", "customer_id"),
)
TRANSACTIONS = EntitySpec(
    "transactions", "transaction_id",
    (("transaction_id", _L), ("payment_id", _L), ("order_id", _L), ("customer_id", _L),
     ("txn_type", _S), ("txn_status", _S), ("amount", AMOUNT_TYPE), ("created_at", _TS),
     ("updated_at", _TS)),
    foreign_keys=("payment_id", "order_id", "customer_id"),
)

ENTITIES: dict[str, EntitySpec] = {e.name: e for e in (CUSTOMERS, ORDERS, PAYMENTS, TRANSACTIONS)}


def entity(name: str) -> EntitySpec:
    try:
        return ENTITIES[name]
    except KeyError:
        raise KeyError(f"unknown entity {name!r}; known: {sorted(ENTITIES)}") from None
