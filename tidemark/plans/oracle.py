"""Independent DuckDB SQL for every registered query that SQL can express.

The change logs are computed straight from the base tables (no JSON), Silver
with ``row_number()`` and the marts in their original join-chain form, so each
oracle checks the Spark path end to end: encode, decode, reduce, pre-aggregated
marts.
"""

from __future__ import annotations

from tidemark.entities import ENTITIES

_MS = "date_trunc('millisecond', {c})"


def _ms(c: str) -> str:
    return _MS.format(c=c)


LOGS = {
    "customers": f"""
SELECT e.user_id AS customer_id, c.c_name AS full_name,
       'u' || CAST(e.user_id AS VARCHAR) || '.' || CAST(e.event_id AS VARCHAR) || '@example.com' AS email,
       n.n_name AS country, {_ms('e.ts')} AS created_at, {_ms('e.ts')} AS updated_at,
       CASE e.event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
       epoch_ms({_ms('e.ts')}) AS source_ts_ms, {_ms('e.ts')} AS kafka_event_ts
FROM events e JOIN customer c ON e.user_id = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "orders": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'SHIPPED' END AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS amount, {_ms('o_orderdate')} AS created_at,
       {_ms('o_orderdate')} AS updated_at,
       CASE o_orderstatus WHEN 'F' THEN 'r' WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' END AS op,
       epoch_ms({_ms('o_orderdate')}) AS source_ts_ms, {_ms('o_orderdate')} AS kafka_event_ts
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey,
       CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'SHIPPED' END,
       CAST(o_totalprice AS DECIMAL(12,2)), {_ms('o_orderdate')}, {_ms('o_orderdate')}, 'd',
       epoch_ms({_ms('o_orderdate')}) + 86400000, {_ms('o_orderdate')} + INTERVAL 1 DAY
FROM orders WHERE o_orderpriority = '5-LOW'""",
    "payments": f"""
SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS order_id, o_custkey AS customer_id,
       CASE l_linestatus WHEN 'O' THEN 'CARD' WHEN 'F' THEN 'WALLET' END AS payment_method,
       CASE WHEN l_returnflag = 'A' THEN 'PAID' ELSE 'PENDING' END AS payment_status,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, {_ms('l_shipdate')} AS created_at,
       {_ms('l_shipdate')} AS updated_at,
       CASE l_returnflag WHEN 'R' THEN 'd' WHEN 'A' THEN 'u' WHEN 'N' THEN 'c' END AS op,
       epoch_ms({_ms('l_shipdate')}) AS source_ts_ms,
       epoch_ms(epoch_ms({_ms('l_shipdate')}) + l_partkey) AS kafka_event_ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "transactions": f"""
SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_orderkey * 10 + l_linenumber AS payment_id,
       l_orderkey AS order_id, o_custkey AS customer_id,
       CASE l_linestatus WHEN 'O' THEN 'CAPTURE' WHEN 'F' THEN 'AUTH' END AS txn_type,
       CASE l_linestatus WHEN 'O' THEN 'SUCCESS' WHEN 'F' THEN 'PENDING' END AS txn_status,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS amount, {_ms('l_shipdate')} AS created_at,
       {_ms('l_shipdate')} AS updated_at,
       CASE WHEN l_quantity >= 45 THEN 'd' ELSE 'u' END AS op,
       epoch_ms({_ms('l_shipdate')}) AS source_ts_ms,
       epoch_ms(epoch_ms({_ms('l_shipdate')}) + l_partkey) AS kafka_event_ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}

ENTITY_NAMES = ("customers", "orders", "payments", "transactions")


def _bronze(e: str) -> str:
    cols = ", ".join(ENTITIES[e].column_names)
    return f"SELECT kafka_event_ts, op, {cols}, source_ts_ms FROM {e}_log"


def _silver(e: str) -> str:
    spec = ENTITIES[e]
    cols = ", ".join(spec.column_names)
    return f"""
SELECT {cols}, op AS bronze_op, source_ts_ms AS bronze_source_ts_ms, kafka_event_ts AS bronze_kafka_event_ts
FROM (SELECT *, row_number() OVER (PARTITION BY {spec.key}
                                   ORDER BY source_ts_ms DESC NULLS LAST, kafka_event_ts DESC NULLS LAST) AS rn
      FROM {e}_log WHERE {spec.key} IS NOT NULL) ranked
WHERE rn = 1 AND op <> 'd'"""


GOLD = {
    "customer_order_summary_gold": """
SELECT c.customer_id, c.full_name, c.email, c.country,
       count(DISTINCT o.order_id) AS total_orders,
       CAST(coalesce(sum(CASE WHEN p.payment_status = 'PAID' THEN p.amount ELSE 0 END), 0) AS DECIMAL(22,2))
         AS total_paid_amount,
       max(o.created_at) AS latest_order_ts
FROM customers_silver c
LEFT JOIN orders_silver o ON c.customer_id = o.customer_id
LEFT JOIN payments_silver p ON o.order_id = p.order_id
GROUP BY 1, 2, 3, 4""",
    "order_payment_status_gold": """
SELECT o.order_id, o.customer_id, o.status AS order_status, o.amount AS order_amount,
       p.payment_status AS latest_payment_status, t.txn_status AS latest_transaction_status,
       o.created_at AS order_created_at
FROM orders_silver o
LEFT JOIN payments_silver p ON o.order_id = p.order_id
LEFT JOIN (SELECT order_id, txn_status,
                  row_number() OVER (PARTITION BY order_id ORDER BY bronze_source_ts_ms DESC NULLS LAST,
                                     bronze_kafka_event_ts DESC NULLS LAST, transaction_id DESC) AS rn
           FROM transactions_silver) t ON o.order_id = t.order_id AND t.rn = 1""",
    "order_payment_status_latest_gold": """
SELECT o.order_id, o.customer_id, o.status AS order_status, o.amount AS order_amount,
       p.payment_status AS latest_payment_status, t.txn_status AS latest_transaction_status,
       o.created_at AS order_created_at
FROM orders_silver o
LEFT JOIN (SELECT order_id, payment_status,
                  row_number() OVER (PARTITION BY order_id ORDER BY bronze_source_ts_ms DESC NULLS LAST,
                                     bronze_kafka_event_ts DESC NULLS LAST, payment_id DESC) AS rn
           FROM payments_silver) p ON o.order_id = p.order_id AND p.rn = 1
LEFT JOIN (SELECT order_id, txn_status,
                  row_number() OVER (PARTITION BY order_id ORDER BY bronze_source_ts_ms DESC NULLS LAST,
                                     bronze_kafka_event_ts DESC NULLS LAST, transaction_id DESC) AS rn
           FROM transactions_silver) t ON o.order_id = t.order_id AND t.rn = 1""",
    "daily_revenue_gold": """
SELECT coalesce(o.revenue_date, p.revenue_date, t.revenue_date) AS revenue_date,
       coalesce(o.total_orders, 0) AS total_orders,
       coalesce(p.total_payments, 0) AS total_payments,
       coalesce(t.total_successful_transactions, 0) AS total_successful_transactions,
       CAST(coalesce(t.gross_revenue, 0) AS DECIMAL(22,2)) AS gross_revenue
FROM (SELECT CAST(created_at AS DATE) AS revenue_date, count(*) AS total_orders
      FROM orders_silver GROUP BY 1) o
FULL OUTER JOIN (SELECT CAST(created_at AS DATE) AS revenue_date, count(*) AS total_payments
                 FROM payments_silver GROUP BY 1) p ON o.revenue_date = p.revenue_date
FULL OUTER JOIN (SELECT CAST(created_at AS DATE) AS revenue_date,
                        count(CASE WHEN txn_status = 'SUCCESS' THEN 1 END) AS total_successful_transactions,
                        coalesce(sum(CASE WHEN txn_status = 'SUCCESS' THEN amount ELSE 0 END), 0) AS gross_revenue
                 FROM transactions_silver GROUP BY 1) t
  ON coalesce(o.revenue_date, p.revenue_date) = t.revenue_date""",
}


def with_layers(body: str, gold: bool = False) -> str:
    ctes = [f"{e}_log AS ({LOGS[e]})" for e in ENTITY_NAMES]
    ctes += [f"{e}_bronze AS ({_bronze(e)})" for e in ENTITY_NAMES]
    ctes += [f"{e}_silver AS ({_silver(e)})" for e in ENTITY_NAMES]
    if gold:
        ctes += [f"{name} AS ({sql})" for name, sql in GOLD.items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _pk_checks(suffix: str) -> str:
    parts = []
    for e in ENTITY_NAMES:
        k, t = ENTITIES[e].key, f"{e}{suffix}"
        parts.append(f"SELECT '{t}_null_pk' AS test_name WHERE EXISTS (SELECT 1 FROM {t} WHERE {k} IS NULL)")
        parts.append(f"SELECT '{t}_duplicate_pk' AS test_name WHERE EXISTS "
                     f"(SELECT {k} FROM {t} GROUP BY 1 HAVING count(*) > 1)")
    return _union(parts)


def _dup_counts() -> str:
    parts = []
    for suffix in ("_silver", "_bronze"):
        for e in ENTITY_NAMES:
            k, t = ENTITIES[e].key, f"{e}{suffix}"
            parts.append(f"SELECT '{t}_pk_duplicates' AS check_name, count(*) AS cnt FROM "
                         f"(SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1) x")
    return _union(parts)


def _delete_ops() -> str:
    parts = [f"SELECT '{e}_silver_delete_ops_present' AS check_name, count(*) AS cnt FROM {e}_silver "
             f"WHERE bronze_op = 'd'" for e in ENTITY_NAMES]
    parts += [f"SELECT '{e}_bronze_delete_ops_present' AS check_name, count(*) AS cnt FROM {e}_bronze "
              f"WHERE op = 'd'" for e in ENTITY_NAMES]
    return _union(parts)


def _bronze_counts() -> str:
    return _union([
        f"SELECT '{e}_bronze' AS table_name, count(*) AS cnt, CAST(0 AS BIGINT) AS raw_json_nulls, "
        f"count(*) FILTER (WHERE op IS NULL) AS null_ops FROM {e}_bronze" for e in ENTITY_NAMES])


def _table_counts() -> str:
    parts = [f"SELECT '{e}_silver' AS table_name, count(*) AS cnt FROM {e}_silver" for e in ENTITY_NAMES]
    parts += [f"SELECT '{g}' AS table_name, count(*) AS cnt FROM {g}"
              for g in ("customer_order_summary_gold", "order_payment_status_gold", "daily_revenue_gold")]
    return _union(parts)


def _gold_keys() -> str:
    parts = []
    for model, col in (("customer_order_summary_gold", "customer_id"), ("order_payment_status_gold", "order_id"),
                       ("daily_revenue_gold", "revenue_date")):
        parts.append(f"SELECT '{model}' AS model_name, '{col}' AS column_name, 'not_null' AS test_name, "
                     f"count(*) AS failures FROM {model} WHERE {col} IS NULL")
        parts.append(f"SELECT '{model}' AS model_name, '{col}' AS column_name, 'unique' AS test_name, "
                     f"count(*) AS failures FROM (SELECT {col} FROM {model} WHERE {col} IS NOT NULL "
                     f"GROUP BY {col} HAVING count(*) > 1) x")
    return _union(parts)


def _change_log(entities: tuple[str, ...] = ENTITY_NAMES) -> str:
    parts = []
    for e in entities:
        k, t = ENTITIES[e].key, f"{e}_bronze"
        parts.append(f"""
SELECT '{t}' AS table_name, 'unexpected_op' AS check_name,
       count(*) FILTER (WHERE op IS NULL OR op NOT IN ('c', 'u', 'd', 'r')) AS violations FROM {t}
UNION ALL
SELECT '{t}', 'duplicate_event', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM {t} GROUP BY {k}, op, source_ts_ms, kafka_event_ts) g
UNION ALL
SELECT '{t}', 'out_of_order', count(*) FILTER (WHERE arr_newest < last_arrival) FROM
  (SELECT {k}, max(kafka_event_ts) AS last_arrival,
          max(CASE WHEN rn = 1 THEN kafka_event_ts END) AS arr_newest
   FROM (SELECT {k}, kafka_event_ts, row_number() OVER (PARTITION BY {k}
                ORDER BY source_ts_ms DESC NULLS LAST, kafka_event_ts DESC NULLS LAST) AS rn
         FROM {t} WHERE {k} IS NOT NULL) r GROUP BY {k}) g
UNION ALL
SELECT '{t}', 'delete_without_before', count(*) FILTER (WHERE op = 'd' AND {k} IS NULL) FROM {t}""")
    return _union(parts)


DIRTY_LOG = f"""
WITH o AS (SELECT o_orderkey AS order_id, {_ms('o_orderdate')} AS ts, o_orderpriority AS pr,
                  CASE o_orderstatus WHEN 'F' THEN 'r' WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' END AS op FROM orders),
orders_bronze AS (
  SELECT order_id, 'x' AS op, epoch_ms(ts) AS source_ts_ms, ts AS kafka_event_ts FROM o WHERE pr = '1-URGENT'
  UNION ALL SELECT order_id, op, epoch_ms(ts), ts FROM o WHERE pr IN ('2-HIGH', '3-MEDIUM')
  UNION ALL SELECT order_id, op, epoch_ms(ts), ts FROM o WHERE pr = '2-HIGH'
  UNION ALL SELECT order_id, 'u', epoch_ms(ts) - 86400000, ts + INTERVAL 1 DAY FROM o WHERE pr = '3-MEDIUM'
  UNION ALL SELECT NULL, 'd', epoch_ms(ts), ts FROM o WHERE pr = '4-NOT SPECIFIED'
  UNION ALL SELECT order_id, NULL, epoch_ms(ts), ts FROM o WHERE pr = '5-LOW')"""

INVERTED_LOG = f"""
SELECT CASE o_orderpriority WHEN '2-HIGH' THEN -1 ELSE o_orderkey END AS key,
       epoch_ms({_ms('o_orderdate')}) + 86400000 * CASE o_orderpriority WHEN '1-URGENT' THEN [1, 3, 2, 4][step] WHEN '3-MEDIUM' THEN [4, 1, 2, 3][step] ELSE step END
         + o_orderkey AS source_ts_ms,
       epoch_ms(CAST(epoch_ms({_ms('o_orderdate')}) + 86400000 * step + o_orderkey AS BIGINT)) AS kafka_event_ts
FROM orders, range(1, 5) t(step)"""

SAME_COMMIT = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'DELIVERED' AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
       {_ms('o_orderdate')} AS created_at, {_ms('o_orderdate')} AS updated_at, 'u' AS bronze_op,
       epoch_ms({_ms('o_orderdate')}) AS bronze_source_ts_ms, {_ms('o_orderdate')} AS bronze_kafka_event_ts
FROM orders"""

MALFORMED = f"""
SELECT {_ms('o_orderdate')} AS kafka_event_ts,
       CASE WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN NULL
            ELSE CASE o_orderstatus WHEN 'F' THEN 'r' WHEN 'O' THEN 'c' WHEN 'P' THEN 'u' END END AS op,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderkey END AS order_id,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_custkey END AS customer_id,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL
            ELSE CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'SHIPPED' END
       END AS status,
       CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM', '5-LOW') THEN NULL
            ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS amount,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE {_ms('o_orderdate')} END AS created_at,
       CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE epoch_ms({_ms('o_orderdate')}) END AS source_ts_ms,
       TRUE AS has_raw_json
FROM orders WHERE o_orderpriority <> '1-URGENT'"""

CAST_ERRORS = """
SELECT 'orders_bronze' AS table_name, count(*) AS cnt,
       count(*) FILTER (WHERE o_orderpriority IN ('3-MEDIUM', '5-LOW')) AS rows_with_errors,
       count(*) FILTER (WHERE o_orderpriority IN ('3-MEDIUM', '5-LOW')) AS cast_errors
FROM orders WHERE o_orderpriority <> '1-URGENT'"""

MINIMAL_EVENTS = """
SELECT 'replay' AS consumer_mode, 'orders-jsonl-replay' AS consumer_group,
       CASE WHEN order_id % 2 = 0 THEN op END AS op,
       order_id,
       CASE WHEN order_id % 2 = 0 THEN customer_id END AS customer_id,
       CASE WHEN order_id % 2 = 0 THEN status END AS status,
       CASE WHEN order_id % 2 = 0 THEN CAST(amount AS VARCHAR) END AS amount,
       CASE WHEN order_id % 2 = 0 THEN source_ts_ms END AS source_ts_ms,
       CASE WHEN order_id % 2 = 0 THEN source_ts_ms END AS lsn
FROM orders_log"""

ENVELOPE_VIEW = """
SELECT 'resume' AS consumer_mode, 'orders-view' AS consumer_group,
       '{"payload":{"order_id":' || CAST(order_id AS VARCHAR) || '}}' AS key,
       CASE WHEN order_id % 2 = 0 THEN op END AS op,
       CASE WHEN order_id % 2 = 0 AND op = 'd' THEN status END AS before_status,
       CASE WHEN order_id % 2 = 0 AND op <> 'd' THEN status END AS after_status
FROM orders_log"""

_ORDER_ROWS = f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'SHIPPED' END AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS amount, {_ms('o_orderdate')} AS created_at,
       {_ms('o_orderdate')} AS updated_at, o_orderpriority AS priority
FROM orders"""

CHANGE_FEED = f"""
WITH r AS ({_ORDER_ROWS}),
b AS (SELECT * FROM r WHERE priority <> '1-URGENT'),
a AS (SELECT order_id, customer_id,
             CASE WHEN priority = '3-MEDIUM' THEN 'PAID' ELSE status END AS status,
             CASE WHEN priority = '2-HIGH' THEN CAST(amount * 1.1 AS DECIMAL(12,2)) ELSE amount END AS amount,
             created_at, updated_at
      FROM r WHERE priority <> '5-LOW')
SELECT CASE WHEN b.order_id IS NULL THEN 'c' WHEN a.order_id IS NULL THEN 'd' ELSE 'u' END AS op,
       coalesce(a.order_id, b.order_id) AS order_id,
       b.status AS before_status, a.status AS after_status, b.amount AS before_amount, a.amount AS after_amount
FROM b FULL OUTER JOIN a ON b.order_id = a.order_id
WHERE b.order_id IS NULL OR a.order_id IS NULL
   OR b.customer_id IS DISTINCT FROM a.customer_id OR b.status IS DISTINCT FROM a.status
   OR b.amount IS DISTINCT FROM a.amount OR b.created_at IS DISTINCT FROM a.created_at
   OR b.updated_at IS DISTINCT FROM a.updated_at"""

SNAPSHOT_FEED = """
SELECT c_custkey AS customer_id, c_name AS full_name, 'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       n_name AS country, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at,
       'r' AS bronze_op, CAST(0 AS BIGINT) AS bronze_source_ts_ms,
       TIMESTAMP '1970-01-01 00:00:00' AS bronze_kafka_event_ts
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

APPLY_CHANGES = """
SELECT customer_id, full_name, email, country, created_at, updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
            ORDER BY source_ts_ms DESC NULLS LAST, kafka_event_ts DESC NULLS LAST, gen DESC) AS rn
  FROM (SELECT c_custkey AS customer_id, c_name AS full_name, CAST(NULL AS VARCHAR) AS email, n_name AS country,
               CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at, 'r' AS op,
               CAST(NULL AS BIGINT) AS source_ts_ms, CAST(NULL AS TIMESTAMP) AS kafka_event_ts, 0 AS gen
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        UNION ALL
        SELECT customer_id, full_name, email, country, created_at, updated_at, op, source_ts_ms,
               kafka_event_ts, 1 AS gen
        FROM customers_log) u
  WHERE customer_id IS NOT NULL) ranked
WHERE rn = 1 AND op <> 'd'"""

UPSERT = f"""
WITH r AS ({_ORDER_ROWS})
SELECT order_id, customer_id,
       CASE WHEN priority = '1-URGENT' THEN 'PAID' ELSE status END AS status,
       CASE WHEN priority = '1-URGENT' THEN CAST(amount * 1.1 AS DECIMAL(12,2)) ELSE amount END AS amount,
       created_at,
       CASE WHEN priority = '1-URGENT' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE updated_at END AS updated_at
FROM r
UNION ALL
SELECT order_id + 1000000000000, customer_id, status, amount, created_at, updated_at
FROM r WHERE priority = '2-HIGH'"""


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for e in ENTITY_NAMES:
        out[f"bronze_{e}"] = with_layers(f"SELECT * FROM {e}_bronze")
        out[f"silver_{e}"] = with_layers(f"SELECT * FROM {e}_silver")
    out["bronze_malformed_and_null"] = MALFORMED
    out["bronze_orders_stream"] = out["bronze_orders"]
    out["dq_cast_errors"] = CAST_ERRORS
    out["silver_payments_window"] = out["silver_payments"]
    out["silver_payments_stream"] = out["silver_payments"]
    out["silver_transactions_replay"] = out["silver_transactions"]
    out["silver_orders_resume"] = out["silver_orders"]
    out["gold_customer_order_summary"] = with_layers("SELECT * FROM customer_order_summary_gold", gold=True)
    out["gold_order_payment_status"] = with_layers("SELECT * FROM order_payment_status_gold", gold=True)
    out["gold_order_payment_status_latest"] = with_layers("SELECT * FROM order_payment_status_latest_gold", gold=True)
    out["gold_daily_revenue"] = with_layers("SELECT * FROM daily_revenue_gold", gold=True)
    out["gold_daily_revenue_table"] = out["gold_daily_revenue"]
    out["bronze_orders_run_modes"] = with_layers(_union([
        f"SELECT '{mode}' AS run_mode, op, count(*) AS cnt FROM orders_bronze GROUP BY op" for mode in ("resume", "replay")]))
    out["bronze_non_scalar_text"] = with_layers("""
SELECT * REPLACE (CASE order_id % 4 WHEN 2 THEN '[VIP] ' || status WHEN 3 THEN status END AS status) FROM orders_bronze""")
    out["dq_silver_pk"] = with_layers(_pk_checks("_silver"))
    out["dq_bronze_pk"] = with_layers(_pk_checks("_bronze"))
    out["dq_duplicate_counts"] = with_layers(_dup_counts())
    out["dq_delete_ops"] = with_layers(_delete_ops())
    out["dq_bronze_counts"] = with_layers(_bronze_counts())
    out["dq_table_counts"] = with_layers(_table_counts(), gold=True)
    out["dq_gold_keys"] = with_layers(_gold_keys(), gold=True)
    out["dq_change_log"] = with_layers(_change_log())
    out["dq_table_health"] = with_layers(_union([
        f"SELECT '{e}_bronze' AS table_name, count(*) AS row_count, count(*) > 0 AS healthy FROM {e}_bronze"
        for e in ENTITY_NAMES]))
    out["dq_change_log_dirty"] = DIRTY_LOG + "SELECT check_name, violations FROM (" + _change_log(("orders",)) + ") v"
    out["dq_bronze_counts_dirty"] = DIRTY_LOG + """
SELECT 'orders_bronze' AS table_name, count(*) AS cnt, count(*) FILTER (WHERE op = 'x') AS raw_json_nulls,
       count(*) FILTER (WHERE op IS NULL) AS null_ops FROM orders_bronze"""
    out["bronze_orders_raw"] = with_layers(
        "SELECT kafka_event_ts, op AS raw_op, order_id AS raw_order_id, status AS raw_status, source_ts_ms AS raw_ts_ms FROM orders_bronze")
    out["silver_orders_same_commit"] = SAME_COMMIT
    out["silver_orders_late"] = out["silver_orders_live"] = out["silver_orders"]
    out["silver_orders_state_rows"] = with_layers("""
SELECT CAST(0 AS BIGINT) AS batch, count(*) AS rows_in, count(DISTINCT order_id) AS rows_sent, count(DISTINCT order_id) AS state_rows_written,
       count(DISTINCT order_id) AS state_rows, count(DISTINCT order_id) AS live_keys FROM orders_log WHERE op <> 'd'
UNION ALL
SELECT 1, (SELECT count(*) FROM orders_log WHERE op = 'd'), (SELECT count(DISTINCT order_id) FROM orders_log WHERE op = 'd'),
       (SELECT count(DISTINCT order_id) FROM orders_log WHERE op = 'd'), (SELECT count(DISTINCT order_id) FROM orders_log),
       (SELECT count(*) FROM orders_silver)""")
    out["console_view_runs"] = with_layers(_union([
        f"SELECT CAST({run} AS BIGINT) AS run, '{mode}' AS consumer_mode, {times} * count(*) AS messages FROM orders_log"
        for run, (mode, times) in enumerate((("resume", 1), ("resume", 1), ("replay", 2)))]))
    out["gold_order_payment_status_bucketed"] = out["gold_order_payment_status"]
    out["gold_customer_order_summary_bucketed"] = out["gold_customer_order_summary"]
    out["catalog_layer_counts"] = with_layers(_union(
        [f"SELECT '{layer}.{e}_{layer}' AS table_name, count(*) AS cnt FROM {e}_{layer}" for layer in ("bronze", "silver") for e in ENTITY_NAMES]
        + [f"SELECT 'gold.{g}' AS table_name, count(*) AS cnt FROM {g}"
           for g in ("customer_order_summary_gold", "order_payment_status_gold", "daily_revenue_gold")]), gold=True)
    out["bronze_customers_by_date"] = with_layers("""
SELECT CAST(kafka_event_ts AS DATE) AS ingest_date, count(*) AS cnt, count(DISTINCT customer_id) AS customers FROM customers_bronze GROUP BY 1""")
    out["bronze_orders_variant"] = with_layers("""
SELECT * REPLACE (CASE order_id % 4 WHEN 0 THEN '9' || lpad(CAST(order_id AS VARCHAR), 19, '0') WHEN 1 THEN CAST(order_id AS VARCHAR) || '.5'
                                    WHEN 3 THEN status END AS status) FROM orders_bronze""")
    out["dq_stream_metrics"] = DIRTY_LOG + """
SELECT 'edge_messages' AS table_name, count(*) AS messages, count(*) FILTER (WHERE pr = '1-URGENT') AS null_messages,
       count(*) FILTER (WHERE pr <> '1-URGENT') AS cnt, CAST(0 AS BIGINT) AS raw_json_nulls,
       count(*) FILTER (WHERE pr IN ('2-HIGH', '4-NOT SPECIFIED')) AS null_ops,
       count(*) FILTER (WHERE pr IN ('3-MEDIUM', '5-LOW')) AS rows_with_errors, count(*) FILTER (WHERE pr IN ('3-MEDIUM', '5-LOW')) AS cast_errors FROM o
UNION ALL
SELECT 'dirty_log', count(*), 0, count(*), 0, count(*) FILTER (WHERE op IS NULL), 0, 0 FROM orders_bronze"""
    out["dq_order_kept"] = with_layers(f"""
SELECT table_name, count(*) FILTER (WHERE descents > 0) AS keys_out_of_order, CAST(coalesce(sum(descents), 0) AS BIGINT) AS descents FROM (
    SELECT table_name, key, count(*) FILTER (WHERE source_ts_ms < before) AS descents FROM (
        SELECT table_name, key, source_ts_ms,
               lag(source_ts_ms) OVER (PARTITION BY table_name, key ORDER BY kafka_event_ts, source_ts_ms) AS before
        FROM ({_union([f"SELECT '{e}_bronze' AS table_name, {ENTITIES[e].key} AS key, source_ts_ms, kafka_event_ts FROM {e}_bronze" for e in ENTITY_NAMES]
                      + [f"SELECT 'inverted_orders', key, source_ts_ms, kafka_event_ts FROM ({INVERTED_LOG}) i"])}) logs
        WHERE key IS NOT NULL AND source_ts_ms IS NOT NULL AND kafka_event_ts IS NOT NULL) l
    GROUP BY table_name, key) k
GROUP BY table_name""")
    out["dq_pk_exists"] = with_layers(_pk_checks("_bronze") + "\nUNION ALL\n" + _pk_checks("_silver") + """
UNION ALL SELECT 'dirty_orders_null_pk' WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED')
UNION ALL SELECT 'dirty_orders_duplicate_pk' WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM'))""")
    out["dq_table_files"] = with_layers(_union([
        f"SELECT '{e}_bronze' AS table_name, CAST(4 AS BIGINT) AS data_files, count(*) AS row_count, count(*) > 0 AS healthy FROM {e}_bronze"
        for e in ENTITY_NAMES]))
    out["change_feed_orders_digest"] = CHANGE_FEED
    out["minimal_order_events"] = with_layers(MINIMAL_EVENTS)
    out["minimal_order_events_dirty"] = with_layers(MINIMAL_EVENTS + " WHERE order_id % 5 >= 3")
    out["orders_jsonl"] = with_layers(f"SELECT *, 10 AS n_fields FROM ({MINIMAL_EVENTS}) m")
    out["envelope_view_orders"] = with_layers(ENVELOPE_VIEW)
    out["change_feed_orders"] = CHANGE_FEED
    out["snapshot_feed_customers"] = SNAPSHOT_FEED
    out["apply_changes_customers"] = with_layers(APPLY_CHANGES)
    out["upsert_orders"] = UPSERT
    out["adhoc_report_by_customer"] = with_layers(
        "SELECT customer_id, total_orders, total_paid_amount FROM customer_order_summary_gold ORDER BY customer_id",
        gold=True)
    out["adhoc_report_by_date"] = with_layers(
        "SELECT revenue_date, gross_revenue FROM daily_revenue_gold ORDER BY revenue_date", gold=True)
    return out
