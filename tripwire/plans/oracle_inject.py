"""DuckDB SQL for the injection queries (same md5 draws as the Spark columns)."""

from __future__ import annotations

TWO_32 = "4294967296.0"

# The producer's ranges and picking constants, stated here once more so that
# the SQL does not depend on the code it checks.
AMOUNT_FACTOR_RANGE = (0.8, 1.2)
FRAUD_FACTOR_RANGE = (3.0, 10.0)
LOCATION_TIME_WINDOW = (1, 600)
CLOSE_TIME_WINDOW = (1, 20000)
NORMAL_TXN_MIN_GAP = 30
NORMAL_TXN_MOVE = (30, 1000)
FRAUD_INTERVAL = 1000
FRAUD_COUNT_RANGE = (0, 20)
PERM_PRIME = 1009
HIGH_VALUE, PROXIMITY, TIME = "High Value Fraud", "Proximity Fraud", "Time Fraud"


def frac_sql(key: str, salt: str) -> str:
    return f"(CAST(('0x' || substr(md5(CAST({key} AS VARCHAR) || '{salt}'), 1, 8)) AS BIGINT) / {TWO_32})"


def uniform_sql(a: float, b: float, key: str, salt: str) -> str:
    return f"round({float(a)!r} + {float(b - a)!r} * {frac_sql(key, salt)}, 3)"


def uniform_int_sql(a: int, b: int, key: str, salt: str) -> str:
    return f"CAST({int(a)} + floor({frac_sql(key, salt)} * {int(b - a + 1)}) AS BIGINT)"


def history_sql(txn_sql: str) -> str:
    """CTEs t (transactions), h (profile before each row), loc (numbered locations), m (their count)."""
    return f"""t AS ({txn_sql}),
h AS (
  SELECT seq, transaction_id, user_id, txn_time, amount, location, transaction_type,
         CASE WHEN n > 1 THEN CAST(sign(CAST((tot - CAST(amount AS DECIMAL(38,6))) * 1000000 AS HUGEINT))
              * ((2 * abs(CAST((tot - CAST(amount AS DECIMAL(38,6))) * 1000000 AS HUGEINT)) + (n - 1) * 1000)
                 // (2 * (n - 1) * 1000)) AS DOUBLE) / 1000 END AS avg_before,
         last_time, main_location, n = 1 AS is_first
    FROM (SELECT *, count(*) OVER u AS n,
                 sum(CAST(amount AS DECIMAL(38,6))) OVER u AS tot,
                 first_value(location) OVER u AS main_location,
                 lag(txn_time) OVER (PARTITION BY user_id ORDER BY seq) AS last_time
            FROM t
          WINDOW u AS (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))),
loc AS (SELECT lk, loc, row_number() OVER (ORDER BY md5(lk), lk) - 1 AS idx
          FROM (SELECT lower(location) AS lk, min(location) AS loc FROM t WHERE location IS NOT NULL GROUP BY 1)),
m AS (SELECT count(*) AS m FROM loc)"""


def other_location_sql() -> str:
    """CTE ho: h plus other_location."""
    shift = f"(1 + floor({frac_sql('h.seq', 'loc_pick')} * (m.m - 1)))"
    return f"""ho AS (
  SELECT h.*, CASE WHEN m.m < 2 OR ml.idx IS NULL THEN NULL ELSE
           (SELECT loc FROM loc o WHERE o.idx = ((ml.idx + {shift}) % m.m)) END AS other_location
    FROM h CROSS JOIN m LEFT JOIN loc ml ON ml.lk = lower(h.main_location))"""


def pick_position_sql(block: str, pos: str, interval: int = FRAUD_INTERVAL) -> str:
    p = PERM_PRIME
    a = f"(1 + floor({frac_sql(block, 'perm_a')} * {p - 1}))"
    b = f"floor({frac_sql(block, 'perm_b')} * {p})"

    def f(x: str) -> str:
        return f"((({a} * {x} + {b}) % {p} + {p}) % {p})"

    steps = [f(pos)]
    for _ in range(p - interval - 1):
        steps.append(f(steps[-1]))
    out = steps[-1]
    for x in reversed(steps[:-1]):
        out = f"CASE WHEN {x} <= {interval} THEN {x} ELSE {out} END"
    return out


def picked_sql(interval: int = FRAUD_INTERVAL, src: str = "t") -> str:
    """CTE picked: seq, block, pos, n of the chosen rows."""
    lo, hi = FRAUD_COUNT_RANGE
    return f"""bp AS (SELECT seq, seq // {interval} AS block, seq % {interval} AS pos FROM {src}),
picked AS (SELECT seq, block, pos, n FROM (
  SELECT *, {uniform_int_sql(lo, hi, 'block', 'count')} AS n,
         {pick_position_sql('block', 'pos', interval)} AS rk FROM bp) WHERE rk < n)"""


def types_sql(src: str = "picked") -> str:
    names = ", ".join(f"('{t}')" for t in (HIGH_VALUE, PROXIMITY, TIME))
    return f"""ty AS (SELECT p.seq, x.t, {uniform_int_sql(1, 3, 'p.seq', 'k')} AS k,
                  row_number() OVER (PARTITION BY p.seq ORDER BY md5(CAST(p.seq AS VARCHAR) || x.t)) AS r
             FROM {src} p CROSS JOIN (VALUES {names}) x(t)),
types AS (SELECT seq, string_agg(t, ',' ORDER BY r) AS fraud_types FROM ty WHERE r <= k GROUP BY seq)"""


def _gap() -> str:
    return "(((txn_time - last_time) % 86400) + 86400) % 86400"


def _ts(kind: str) -> str:
    if kind == "spacing":
        lo, hi = NORMAL_TXN_MOVE
        return f"(last_time * 1000 + {uniform_int_sql(lo, hi, 'seq', 'spacing')} * 1000)"
    if kind == PROXIMITY:
        lo, hi = LOCATION_TIME_WINDOW
        return f"(last_time * 1000 + {uniform_int_sql(lo, hi, 'seq', 'loc_time')} * 1000)"
    lo, hi = CLOSE_TIME_WINDOW
    return f"(last_time * 1000 + {uniform_int_sql(lo, hi, 'seq', 'close')})"


def _amount(kind: str) -> str:
    lo, hi = AMOUNT_FACTOR_RANGE if kind == "normal" else FRAUD_FACTOR_RANGE
    return f"(avg_before * {uniform_sql(lo, hi, 'seq', 'normal' if kind == 'normal' else 'high')})"


def behaviour_sql(txn_sql: str, name: str) -> str:
    ctes = history_sql(txn_sql)
    src = "h"
    if name == PROXIMITY:
        ctes += ",\n" + other_location_sql()
        src = "ho"
    amount, ts, loc = "amount", "NULL", "location"
    if name == "normal":
        amount = _amount("normal")
    elif name == "spacing":
        ts = f"CASE WHEN {_gap()} <= {NORMAL_TXN_MIN_GAP} THEN {_ts('spacing')} END"
    elif name == HIGH_VALUE:
        amount = _amount("high")
    elif name == PROXIMITY:
        loc = "coalesce(other_location, location)"
        ts = _ts(PROXIMITY)
    else:
        ts = _ts(TIME)
    return f"""WITH {ctes}
SELECT seq,
       CASE WHEN is_first THEN amount ELSE {amount} END AS amount,
       CASE WHEN is_first OR ({ts}) IS NULL THEN txn_time ELSE ({ts}) // 1000 END AS txn_time,
       CASE WHEN is_first THEN location ELSE {loc} END AS location
  FROM {src}"""


def inject_all_ctes(txn_sql: str) -> str:
    """CTEs ending in `inj`: canonical columns plus fraud_types."""
    P, T = PROXIMITY, TIME

    def pos_ts(i: int) -> str:
        t = f"string_split(fraud_types, ',')[{i}]"
        return (f"WHEN len(string_split(fraud_types, ',')) >= {i} AND {t} = '{P}' THEN {_ts(P)} "
                f"WHEN len(string_split(fraud_types, ',')) >= {i} AND {t} = '{T}' THEN {_ts(T)}")

    return f"""{history_sql(txn_sql)},
{other_location_sql()},
{picked_sql()},
{types_sql()},
a AS (SELECT ho.*, types.fraud_types, (types.fraud_types IS NOT NULL AND NOT ho.is_first) AS alter
        FROM ho LEFT JOIN types USING (seq)),
b AS (SELECT *, CASE WHEN NOT alter THEN NULL {pos_ts(3)} {pos_ts(2)} {pos_ts(1)}
                     WHEN {_gap()} <= {NORMAL_TXN_MIN_GAP} THEN {_ts('spacing')} END AS ts_ms
        FROM a),
inj AS (
  SELECT seq, transaction_id, user_id,
         CASE WHEN ts_ms IS NULL THEN txn_time ELSE ts_ms // 1000 END AS txn_time,
         CASE WHEN NOT alter THEN amount
              WHEN contains(fraud_types, '{HIGH_VALUE}') THEN {_amount('high')}
              ELSE {_amount('normal')} END AS amount,
         CASE WHEN alter AND contains(fraud_types, '{P}') AND other_location IS NOT NULL THEN other_location
              ELSE location END AS location,
         CASE WHEN alter THEN 'Fraud' ELSE transaction_type END AS transaction_type,
         CASE WHEN alter THEN fraud_types END AS fraud_types
    FROM b)"""
