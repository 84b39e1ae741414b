import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.entities import ORDERS  # noqa: E402
from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = build_session(master="local[4]", shuffle_partitions=4, app="tidemark-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-wh-")})
    yield s
    s.stop()


def ts(ms: int | None):
    if ms is None:
        return None
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=ms)


def order_bronze(spark, events):
    """events: (op, order_id, status, amount, source_ts_ms, kafka_ms[, customer_id]) -> Bronze orders rows."""
    rows = []
    for e in events:
        op, oid, status, amount, src, kms = e[:6]
        cust = e[6] if len(e) > 6 else 1001
        rows.append((ts(kms), op, oid, cust, status, None if amount is None else Decimal(str(amount)),
                     ts(0), ts(kms), src, "{}"))
    return spark.createDataFrame(rows, ORDERS.bronze_schema)


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
