"""DuckDB SQL stating the same results as the registered queries.

Tables are DuckDB views over the same parquet files. The amount fold is a
recursive CTE over each user's rows numbered in arrival order, on whole
micro-units, so that its totals are exact.
"""

from __future__ import annotations

EVENTS_TXN = """SELECT event_id AS seq,
       'txn-' || CAST(event_id AS VARCHAR) AS transaction_id,
       'user-' || CAST(user_id AS VARCHAR) AS user_id,
       CAST(floor(epoch(ts)) AS BIGINT) AS txn_time,
       CAST(value AS DOUBLE) AS amount,
       event_type AS location,
       CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95 THEN 'Fraud' ELSE 'Normal' END
         AS transaction_type
  FROM events"""

ORDERS_TXN = """SELECT o_orderkey AS seq,
       'txn-' || CAST(o_orderkey AS VARCHAR) AS transaction_id,
       'user-' || CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(floor(epoch(o_orderdate)) AS BIGINT) AS txn_time,
       CAST(o_totalprice AS DOUBLE) AS amount,
       o_orderpriority AS location,
       'Normal' AS transaction_type
  FROM orders"""

TXN = {"events": EVENTS_TXN, "orders": ORDERS_TXN}
UNITS = "CAST(CAST(amount AS DECIMAL(38,6)) * 1000000 AS HUGEINT)"
CANON = "seq, transaction_id, user_id, txn_time, amount, location, transaction_type"


def scores_ctes(table: str = "events", factor: float = 3.0, max_gap: int = 20, source: str | None = None,
                p: str = "") -> str:
    """RECURSIVE CTEs t (transactions), w (window helpers), r (amount fold), s (all three scores).

    `source` replaces the table's adapter SQL; `p` prefixes the CTE names.
    """
    src = source or TXN[table]
    num, den = factor.as_integer_ratio()
    return f"""RECURSIVE {p}t AS ({src}),
{p}w AS (
  SELECT *, {UNITS} AS units,
         row_number() OVER (PARTITION BY user_id ORDER BY seq) AS rn,
         lag(txn_time) OVER (PARTITION BY user_id ORDER BY seq) AS prev_time,
         lag(location) OVER (PARTITION BY user_id ORDER BY seq) AS prev_loc,
         first_value(location) OVER (PARTITION BY user_id ORDER BY seq
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_loc
    FROM {p}t),
{p}r AS (
  SELECT user_id, rn, seq, 0 AS amount_score, units AS total, CAST(1 AS HUGEINT) AS cnt FROM {p}w WHERE rn = 1
  UNION ALL
  SELECT w.user_id, w.rn, w.seq,
         CASE WHEN w.units * r.cnt * {den} >= r.total * {num} THEN 1 ELSE 0 END,
         CASE WHEN w.units * r.cnt * {den} >= r.total * {num} THEN r.total ELSE r.total + w.units END,
         CASE WHEN w.units * r.cnt * {den} >= r.total * {num} THEN r.cnt ELSE r.cnt + 1 END
    FROM {p}r r JOIN {p}w w ON w.user_id IS NOT DISTINCT FROM r.user_id AND w.rn = r.rn + 1),
{p}s AS (
  SELECT w.seq, w.transaction_id, w.user_id, w.txn_time, w.amount, w.location, w.transaction_type,
         CAST(r.amount_score AS INTEGER) AS amount_score,
         CAST(CASE WHEN w.rn = 1 THEN 0 WHEN w.txn_time - w.prev_time <= {max_gap} THEN 1 ELSE 0 END AS INTEGER)
           AS velocity_score,
         CAST(CASE WHEN w.rn = 1 THEN 0 WHEN w.location IS NOT DISTINCT FROM w.first_loc THEN 0 ELSE 1 END AS INTEGER)
           AS location_score
    FROM {p}w w JOIN {p}r r ON r.seq = w.seq)"""


def detect_sql(detector: str, table: str = "events", factor: float = 3.0, max_gap: int = 20) -> str:
    col = {"amount": "amount_score", "velocity": "velocity_score", "location": "location_score"}[detector]
    return f"WITH {scores_ctes(table, factor, max_gap)}\nSELECT {CANON}, {col} AS fraud_score FROM s"


def score_all_sql(table: str = "events", source: str | None = None) -> str:
    return f"WITH {scores_ctes(table, source=source)}\nSELECT * FROM s"


def detect_location_prev_sql(table: str = "events") -> str:
    return f"""WITH {scores_ctes(table)}
SELECT {CANON},
       CAST(CASE WHEN rn = 1 THEN 0 WHEN location IS NOT DISTINCT FROM prev_loc THEN 0 ELSE 1 END AS INTEGER)
         AS fraud_score
  FROM w"""


def detect_amount_all_sql(table: str = "events", factor: float = 3.0) -> str:
    num, den = factor.as_integer_ratio()
    return f"""WITH t AS ({TXN[table]}),
a AS (
  SELECT *,
         row_number() OVER (PARTITION BY user_id ORDER BY seq) AS rn,
         sum({UNITS}) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tot,
         count(amount) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS cnt
    FROM t)
SELECT {CANON},
       CAST(CASE WHEN rn = 1 OR cnt = 0 THEN 0 WHEN {UNITS} * cnt * {den} >= tot * {num} THEN 1 ELSE 0 END AS INTEGER)
         AS fraud_score
  FROM a"""


def scored_long_body() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {CANON}, '{d}' AS detector, {d}_score AS fraud_score FROM s" for d in ("amount", "velocity", "location"))


def scored_long_sql(table: str = "events") -> str:
    return f"WITH {scores_ctes(table)}\n{scored_long_body()}"


def _rollup_select(src: str, keys: str = "transaction_id", extra_select: str = "") -> str:
    return f"""SELECT {extra_select}{keys}, arg_max(user_id, seq) AS user_id, arg_max(txn_time, seq) AS txn_time,
       arg_max(amount, seq) AS amount, arg_max(location, seq) AS location,
       CASE WHEN sum(fraud_score) >= 2 THEN 'Fraud' ELSE arg_max(transaction_type, seq) END AS transaction_type,
       CAST(sum(fraud_score) AS INTEGER) AS fraud_score,
       sum(fraud_score) >= 2 AS detected
  FROM {src}
 GROUP BY {keys}"""


def final_scores_sql(table: str = "events") -> str:
    return f"WITH {scores_ctes(table)}, l AS (\n{scored_long_body()})\n{_rollup_select('l')}"


# Redeliveries derived from the data: the scored rows of error events are sent twice.
REDELIVER_WHERE = "location = 'error'"


def final_scores_redelivered_sql(dedup: bool) -> str:
    src = "(SELECT DISTINCT * FROM l2)" if dedup else "l2"
    return f"""WITH {scores_ctes('events')}, l AS (
{scored_long_body()}),
l2 AS (SELECT * FROM l UNION ALL SELECT * FROM l WHERE {REDELIVER_WHERE})
{_rollup_select(src)}"""


def final_scores_tumbling_sql() -> str:
    """One-second windows; error events come a second time one second later, which is another window."""
    return f"""WITH {scores_ctes('events')}, l AS (
{scored_long_body()}),
l2 AS (SELECT * FROM l UNION ALL SELECT * REPLACE (txn_time + 1 AS txn_time) FROM l WHERE {REDELIVER_WHERE})
{_rollup_select('(SELECT *, txn_time AS window_start FROM l2)', keys='transaction_id, window_start')}"""


def final_scores_session_sql(gap: int, key: str = "user_id") -> str:
    """Sessions per key on txn_time: a row more than `gap` seconds after the previous one opens another."""
    payload = [c for c in ("transaction_id", "user_id", "amount", "location") if c != key]
    return f"""WITH {scores_ctes('events')}, l AS (
{scored_long_body()}),
g AS (SELECT *, CASE WHEN txn_time - lag(txn_time) OVER (PARTITION BY {key} ORDER BY txn_time, seq, detector) <= {gap}
                     THEN 0 ELSE 1 END AS brk FROM l),
n AS (SELECT *, sum(brk) OVER (PARTITION BY {key} ORDER BY txn_time, seq, detector
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g),
m AS (SELECT *, min(txn_time) OVER (PARTITION BY {key}, sid) AS session_start,
                max(txn_time) OVER (PARTITION BY {key}, sid) + {gap} AS session_end FROM n)
SELECT {key}, session_start, session_end, {', '.join(f'arg_max({c}, seq) AS {c}' for c in payload)}, arg_max(txn_time, seq) AS txn_time,
       CASE WHEN sum(fraud_score) >= 2 THEN 'Fraud' ELSE arg_max(transaction_type, seq) END AS transaction_type,
       CAST(sum(fraud_score) AS INTEGER) AS fraud_score, sum(fraud_score) >= 2 AS detected
  FROM m GROUP BY {key}, session_start, session_end"""


def end_to_end_sql(table: str = "events") -> str:
    return f"""WITH {scores_ctes(table)}
SELECT transaction_id, user_id, txn_time, CAST(amount AS DECIMAL(10,3)) AS amount, location,
       CASE WHEN amount_score + velocity_score + location_score >= 2 THEN 'Fraud' ELSE transaction_type END
         AS transaction_type,
       CAST(amount_score + velocity_score + location_score AS INTEGER) AS fraud_score
  FROM s"""
