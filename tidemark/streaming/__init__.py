from tidemark.streaming.jobs import (
    TOPIC_SCHEMA,
    BatchTotals,
    await_all,
    drain,
    guard_running,
    observed,
    read_topic,
    run_folder,
    start_all,
    start_bronze,
    start_console,
    start_minimal_events_jsonl,
    start_silver,
)
from tidemark.streaming.keyed_state import read_silver, read_state

__all__ = [
    "BatchTotals", "TOPIC_SCHEMA", "await_all", "drain", "guard_running", "observed", "read_silver", "read_state", "read_topic",
    "run_folder", "start_all", "start_bronze", "start_console", "start_minimal_events_jsonl", "start_silver",
]
