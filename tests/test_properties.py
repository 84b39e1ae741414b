"""Silver is a function of the set of events: invariant under arrival order,
duplication and any split into micro-batches, and equal to a Python fold."""

import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import order_bronze, rows_of
from tidemark.entities import ORDERS
from tidemark.operators.state import silver
from tidemark.streaming import read_silver, start_silver

OPS = ["c", "u", "d", "r", None]


@st.composite
def logs(draw):
    n = draw(st.integers(min_value=1, max_value=25))
    events = []
    for i in range(n):
        key = draw(st.integers(min_value=1, max_value=5))
        op = draw(st.sampled_from(OPS))
        src = draw(st.one_of(st.none(), st.integers(min_value=0, max_value=20)))
        # tie-free: broker time unique per event
        events.append((op, key, f"S{i}", i, src, 1000 + i))
    perm = draw(st.permutations(range(n)))
    dup = draw(st.lists(st.integers(min_value=0, max_value=n - 1), max_size=5))
    cuts = sorted(draw(st.lists(st.integers(min_value=0, max_value=n), max_size=3)))
    return events, perm, dup, cuts


def fold(events):
    best = {}
    for e in events:
        op, key, status, _, src, kafka = e
        rank = (src is not None, src if src is not None else 0, kafka)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, e)
    return sorted((k, e[2]) for k, (_, e) in best.items() if e[0] is not None and e[0] != "d")


def _stream(spark, arrived, cuts):
    """Each cut of the arrivals is a micro-batch of its own into the keyed state, with a restart behind the first."""
    root = tempfile.mkdtemp(prefix="tidemark-prop-")
    bounds = [0, *cuts, len(arrived)]
    parts = [arrived[a:b] for a, b in zip(bounds, bounds[1:]) if b > a]
    for run in (parts[:1], parts[1:]):
        for part in run:
            order_bronze(spark, part).coalesce(1).write.mode("append").parquet(f"{root}/bronze")
        start_silver(spark, f"{root}/bronze", ORDERS, f"{root}/ck", available_now=True, max_files_per_trigger=1).awaitTermination()
    return rows_of(read_silver(spark, f"{root}/ck", ORDERS), "order_id", "status")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs())
def test_silver_is_order_invariant(spark, case):
    events, perm, dup, _ = case
    arrived = [events[i] for i in perm] + [events[i] for i in dup]
    assert rows_of(silver(order_bronze(spark, arrived), ORDERS), "order_id", "status") == fold(events)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(logs())
def test_keyed_state_is_batch_invariant(spark, case):
    events, perm, dup, cuts = case
    arrived = [events[i] for i in perm] + [events[i] for i in dup]
    assert _stream(spark, arrived, cuts) == fold(events)
