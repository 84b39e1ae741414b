from tidemark.operators.feed import change_feed, flatten_feed, snapshot_feed
from tidemark.operators.joins import fanout_left_join
from tidemark.operators.marts import customer_order_summary, daily_revenue, order_payment_status
from tidemark.operators.quality import (
    bronze_counts, cast_error_counts, check_not_null, check_unique, delete_ops_present, duplicate_key_counts,
    key_tests, pk_violations, table_counts, table_health, validate_change_log,
)
from tidemark.operators.state import (
    apply_changes, keyed_state, latest_per_key, live_rows, merge_upsert, rank_latest, silver, silver_from_state,
)

__all__ = [
    "apply_changes", "bronze_counts", "cast_error_counts", "change_feed", "check_not_null", "check_unique",
    "customer_order_summary", "daily_revenue", "delete_ops_present", "duplicate_key_counts", "fanout_left_join",
    "flatten_feed", "keyed_state", "key_tests", "latest_per_key", "live_rows", "merge_upsert",
    "order_payment_status", "pk_violations", "rank_latest", "silver", "silver_from_state", "snapshot_feed",
    "table_counts", "table_health", "validate_change_log",
]
