"""DuckDB SQL oracles, one per registered query.

Each string runs on the pre-registered views (``orders``, ``lineitem``,
``customer``, ``nation``, ``events`` ...). Column names and types are aliased to
equal the Spark result exactly (``SUM`` over integers is cast to BIGINT: DuckDB
would return HUGEINT).
"""

from __future__ import annotations

# Order-independent sums and means: values count with six decimals as whole numbers, sums
# are exact, quotients are rounded half up on whole numbers.


def _micros(x: str) -> str:
    return f"SUM(CAST(ROUND({x} * 1000000) AS HUGEINT))"


def _half_up(s: str, n: str, decimals: int) -> str:
    """s / n for s in millionths, rounded half up."""
    down = 10 ** (6 - decimals)
    return (f"CAST(CASE WHEN {s} < 0 THEN -1 ELSE 1 END * ((ABS({s}) * 2 + {n} * {down}) // ({n} * {2 * down}))"
            f" AS DOUBLE) / {10 ** decimals}")


def _total(x: str, decimals: int = 2) -> str:
    return _half_up(_micros(x), "1", decimals)


def _mean(x: str, decimals: int = 2) -> str:
    return f"CASE WHEN COUNT({x}) > 0 THEN {_half_up(_micros(x), f'COUNT({x})', decimals)} END"


ACTIVITY_CTE = f"""
WITH li AS (
  SELECT l_orderkey, CAST(SUM(l_quantity) AS INTEGER) AS items, MAX(l_discount) AS max_disc
  FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
         LAG(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
  FROM orders),
base AS (
  SELECT printf('evt-%06d', o_orderkey) AS event_id,
         o_orderdate AS event_time,
         CAST(c_custkey AS BIGINT) AS customer_id,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              ELSE CAST(18 + (c_custkey * 7) % 53 AS INTEGER) END AS age,
         n_name AS city,
         CASE WHEN c_acctbal >= 6000 THEN 'Gold' WHEN c_acctbal >= 2500 THEN 'Silver'
              ELSE 'Bronze' END AS membership_type,
         o_totalprice / 300 AS total_spend,
         items AS items_purchased,
         CAST(28 + (o_orderkey * 37) % 23 AS DOUBLE) / 10 AS average_rating,
         max_disc > 0.09 AS discount_applied,
         CAST(1 + date_diff('day', prev, o_orderdate) % 60 AS INTEGER) AS days_since_last_purchase,
         o_orderkey,
         CAST(FLOOR(o_orderkey / 500) AS BIGINT) AS batch_id
  FROM o JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey
         LEFT JOIN li ON l_orderkey = o_orderkey),
activity AS (
  SELECT event_id, event_time, customer_id, gender, age, city, membership_type, total_spend,
         items_purchased, average_rating, discount_applied, days_since_last_purchase,
         CASE WHEN average_rating >= 4.3 AND days_since_last_purchase <= 28 THEN 'Satisfied'
              WHEN average_rating < 3.7 OR days_since_last_purchase > 38 THEN 'Unsatisfied'
              ELSE 'Neutral' END AS satisfaction_level,
         o_orderkey, batch_id
  FROM base),
enriched AS (
  SELECT *,
         CASE WHEN days_since_last_purchase > 30
                   AND (satisfaction_level = 'Unsatisfied' OR average_rating < 3.8)
              THEN TRUE ELSE FALSE END AS is_at_risk,
         CASE WHEN total_spend >= 1000.0 THEN 1 ELSE 0 END AS high_value_order
  FROM activity),
aged AS (
  SELECT *,
         CASE WHEN age < 35 THEN 'Under 35'
              WHEN age >= 35 AND age <= 50 THEN 'Between 35-50'
              ELSE 'Over 50' END AS age_group
  FROM enriched),
kpi AS (
  SELECT CAST(batch_id AS BIGINT) AS batch_id,
         COUNT(*) AS event_count,
         {_total("total_spend")} AS total_revenue,
         {_mean("total_spend")} AS avg_spend,
         {_mean("average_rating")} AS avg_rating,
         CAST(SUM(CASE WHEN discount_applied THEN 1 ELSE 0 END) AS BIGINT) AS discounted_orders,
         CAST(SUM(high_value_order) AS BIGINT) AS high_value_orders,
         CAST(SUM(CASE WHEN is_at_risk THEN 1 ELSE 0 END) AS BIGINT) AS at_risk_count
  FROM enriched GROUP BY batch_id),
kpi_history AS (
  SELECT batch_id,
         CAST(ROW_NUMBER() OVER (ORDER BY batch_id) AS BIGINT) AS processed_batches,
         event_count,
         CAST(SUM(event_count) OVER (ORDER BY batch_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_event_count,
         total_revenue, avg_spend, avg_rating, discounted_orders, high_value_orders, at_risk_count
  FROM kpi)
"""


def _q(body: str) -> str:
    return ACTIVITY_CTE + body


EVENT_COLS = ("event_id, event_time, customer_id, gender, age, city, membership_type, "
              "total_spend, items_purchased, average_rating, discount_applied, "
              "days_since_last_purchase, satisfaction_level")
# Decoded events: the message contract has a 32-bit customer id.
DECODED_COLS = EVENT_COLS.replace("customer_id", "CAST(customer_id AS INTEGER) AS customer_id")
AT_RISK_COLS = ("event_time, customer_id, city, membership_type, total_spend, average_rating, "
                "days_since_last_purchase, satisfaction_level")
RISK_ORDER = ("days_since_last_purchase DESC NULLS LAST, average_rating ASC NULLS FIRST, "
              "customer_id ASC NULLS FIRST, event_time ASC NULLS FIRST, event_id ASC NULLS FIRST")
SEGMENT_MEASURES = (f"{_mean('total_spend')} AS avg_total_spend, "
                    "CAST(SUM(items_purchased) AS BIGINT) AS total_items_purchased")
JSON_EVENT = """to_json(struct_pack(
    event_id := event_id, event_time := strftime(event_time, '%Y-%m-%dT%H:%M:%SZ'),
    customer_id := customer_id, gender := gender, age := age, city := city,
    membership_type := membership_type, total_spend := total_spend,
    items_purchased := items_purchased, average_rating := average_rating,
    discount_applied := discount_applied, days_since_last_purchase := days_since_last_purchase,
    satisfaction_level := satisfaction_level))"""


def _csv(cols: list[str]) -> str:
    return "concat_ws(',', " + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


CSV_COLS = ["customer_id", "gender", "age", "city", "membership_type", "total_spend",
            "items_purchased", "average_rating", "discount_applied", "days_since_last_purchase",
            "satisfaction_level"]

ORACLES: dict[str, str] = {
    "activity": _q("SELECT * FROM activity"),
    "enrich": _q("SELECT * FROM enriched"),
    "age_groups": _q("SELECT age_group, COUNT(*) AS event_count FROM aged GROUP BY age_group"),
    "satisfaction_a": _q("""
SELECT event_id, average_rating, days_since_last_purchase,
       CASE WHEN average_rating >= 4.3 AND days_since_last_purchase <= 28 THEN 'Satisfied'
            WHEN average_rating < 3.7 OR days_since_last_purchase > 38 THEN 'Unsatisfied'
            ELSE 'Neutral' END AS satisfaction_level
FROM activity"""),
    "satisfaction_b": _q("""
SELECT event_id, average_rating,
       CASE WHEN average_rating > 4.0 THEN 'Satisfied' WHEN average_rating = 4.0 THEN 'Neutral'
            ELSE 'Unsatisfied' END AS satisfaction_level
FROM activity"""),
    "city_summary": _q(f"""
SELECT city, COUNT(*) AS event_count, {_mean("total_spend")} AS avg_total_spend,
       CAST(SUM(items_purchased) AS BIGINT) AS total_items_purchased
FROM enriched GROUP BY city"""),
    "membership_summary": _q(f"""
SELECT membership_type, COUNT(*) AS event_count, {_mean("total_spend")} AS avg_total_spend,
       {_mean("average_rating")} AS avg_rating,
       CAST(SUM(high_value_order) AS BIGINT) AS high_value_orders
FROM enriched GROUP BY membership_type"""),
    "customer_segments": _q(f"""
SELECT membership_type, age_group, city, {SEGMENT_MEASURES}
FROM aged GROUP BY membership_type, age_group, city"""),
    "city_segments": _q(f"SELECT city, {SEGMENT_MEASURES} FROM activity GROUP BY city"),
    "batch_kpi": _q("SELECT * FROM kpi"),
    "at_risk_ranked": _q(f"SELECT {AT_RISK_COLS} FROM enriched WHERE is_at_risk"),
    "at_risk_classic": _q("""
SELECT customer_id, city, total_spend, days_since_last_purchase, satisfaction_level
FROM activity WHERE days_since_last_purchase > 30 AND satisfaction_level = 'Unsatisfied'"""),
    "top_at_risk": _q(f"""
SELECT {AT_RISK_COLS} FROM enriched
WHERE is_at_risk AND batch_id = (SELECT MAX(batch_id) FROM enriched) ORDER BY {RISK_ORDER} LIMIT 10"""),
    "ordered_events": _q("SELECT * FROM enriched"),
    "latest_events": _q("""
SELECT * FROM enriched WHERE batch_id = (SELECT MAX(batch_id) FROM enriched)
ORDER BY event_time ASC NULLS FIRST, event_id ASC NULLS FIRST LIMIT 10"""),
    "kpi_history": _q("SELECT * FROM kpi_history"),
    "recent_kpis": _q("SELECT * FROM kpi_history ORDER BY batch_id DESC LIMIT 8"),
    "latest_kpi": _q("SELECT * FROM kpi_history ORDER BY batch_id DESC LIMIT 1"),
    "parse_bool": _q("""
, t AS (
  SELECT event_id,
         CASE WHEN discount_applied IS NULL THEN NULL
              WHEN discount_applied THEN (['TRUE', ' yes ', '1', 'Y'])[1 + CAST(o_orderkey % 4 AS INTEGER)]
              ELSE (['FALSE', 'no', '0', 'n'])[1 + CAST(o_orderkey % 4 AS INTEGER)] END AS discount_text
  FROM activity)
SELECT event_id, discount_text,
       COALESCE(lower(trim(discount_text)) IN ('1', 'true', 'yes', 'y'), FALSE) AS discount_applied
FROM t"""),
    "encode_json": _q(f"SELECT event_id, CAST({JSON_EVENT} AS VARCHAR) AS value FROM activity"),
    "decode_json": _q(f"SELECT {DECODED_COLS} FROM activity"),
    "encode_csv": _q(f"SELECT event_id, {_csv(CSV_COLS)} AS value FROM activity"),
    "decode_csv": _q("""
SELECT CAST(customer_id AS INTEGER) AS customer_id, gender, age, city, membership_type, CAST(total_spend AS FLOAT) AS total_spend,
       items_purchased, CAST(average_rating AS FLOAT) AS average_rating, discount_applied,
       days_since_last_purchase, satisfaction_level
FROM activity"""),
    "valid_rejects": _q("""
SELECT o_orderkey AS "offset",
       CASE WHEN o_orderkey % 50 IN (7, 37) THEN NULL ELSE event_id END AS event_id,
       o_orderkey % 50 NOT IN (7, 17, 27, 37) AS is_valid,
       CASE WHEN o_orderkey % 50 IN (7, 37) THEN 'missing event_id'
            WHEN o_orderkey % 50 = 27 THEN 'missing event_time'
            WHEN o_orderkey % 50 = 17 THEN 'missing customer_id' END AS reject_reason
FROM activity"""),
}


# --- streaming twins, additions, synthesis, reports -----------------------------
def _u(tag: str, idx: str = "i", seed: int = 42) -> str:
    """SQL twin of ``functions.hashing.uniform``."""
    return (f"(CAST(('0x' || substr(md5('{seed}:' || CAST({idx} AS VARCHAR) || ':{tag}'), 1, 8))"
            f" AS BIGINT) / 4294967296.0)")


def _between(tag: str, lo: float, hi: float) -> str:
    return f"(CAST({lo!r} AS DOUBLE) + {_u(tag)} * CAST({hi - lo!r} AS DOUBLE))"


def _randint(tag: str, lo: int, hi: int) -> str:
    return f"CAST({lo} + FLOOR({_u(tag)} * {hi - lo + 1}) AS INTEGER)"


def _pick(tag: str, options: list[str]) -> str:
    arr = "[" + ", ".join(f"'{o}'" for o in options) + "]"
    return f"({arr})[CAST(FLOOR({_u(tag)} * {len(options)}) AS INTEGER) + 1]"


def _keep_null(x: str, expr: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE {expr} END"


_SYNTH_EVENTS = f"""
, seed AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1 AS row_no FROM activity),
n AS (SELECT COUNT(*) AS n FROM seed),
picks AS (SELECT row_no + 1 AS i FROM seed),
picked AS (SELECT p.i, CAST(FLOOR({_u('pick', 'p.i')} * n.n) AS BIGINT) AS row_no
           FROM picks p, n),
m AS (
  SELECT k.i, s.customer_id, s.gender, s.city, s.membership_type,
         ROUND(s.total_spend + {_between('spend', -90.0, 140.0)}, 2) AS spend_r,
         ROUND(s.average_rating + {_between('rating', -0.4, 0.5)}, 1) AS rating_r,
         s.items_purchased + {_randint('items', -2, 3)} AS items_r,
         s.days_since_last_purchase + {_randint('days', -6, 8)} AS days_r,
         s.age + {_randint('age', -1, 1)} AS age_r,
         s.discount_applied <> ({_u('flip')} < 0.25) AS discount_applied,
         CAST(FLOOR((k.i - 1) / 20) + 1 AS BIGINT) AS batch_no
  FROM picked k JOIN seed s ON k.row_no = s.row_no),
f AS (
  SELECT printf('evt-%06d', i) AS event_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds((batch_no - 1) * 5) AS event_time,
         customer_id, gender,
         {_keep_null('age_r', 'GREATEST(18, LEAST(70, age_r))')} AS age,
         city, membership_type,
         {_keep_null('spend_r', 'GREATEST(CAST(120.0 AS DOUBLE), spend_r)')} AS total_spend,
         {_keep_null('items_r', 'GREATEST(1, items_r)')} AS items_purchased,
         {_keep_null('rating_r', 'GREATEST(CAST(2.8 AS DOUBLE), LEAST(CAST(5.0 AS DOUBLE), rating_r))')}
           AS average_rating,
         discount_applied,
         {_keep_null('days_r', 'GREATEST(1, days_r)')} AS days_since_last_purchase,
         batch_no
  FROM m)
SELECT event_id, event_time, customer_id, gender, age, city, membership_type, total_spend,
       items_purchased, average_rating, discount_applied, days_since_last_purchase,
       CASE WHEN average_rating >= 4.3 AND days_since_last_purchase <= 28 THEN 'Satisfied'
            WHEN average_rating < 3.7 OR days_since_last_purchase > 38 THEN 'Unsatisfied'
            ELSE 'Neutral' END AS satisfaction_level,
       batch_no
FROM f"""

_SYNTH_MESSAGES = f"""
WITH idx AS (SELECT event_id + 1 AS i FROM events),
r AS (SELECT i, ROUND({_between('rating', 3.0, 4.7)}, 1) AS average_rating FROM idx)
SELECT i,
       {_randint('customer', 101, 999)} AS customer_id,
       {_pick('gender', ['Male', 'Female'])} AS gender,
       {_randint('age', 18, 65)} AS age,
       {_pick('city', ['New York', 'Los Angeles', 'Chicago', 'San Francisco', 'Miami', 'Houston'])}
         AS city,
       {_pick('tier', ['Gold', 'Silver', 'Bronze'])} AS membership_type,
       ROUND({_between('spend', 400.0, 1500.0)}, 2) AS total_spend,
       {_randint('items', 8, 19)} AS items_purchased,
       average_rating,
       {_u('discount')} < 0.5 AS discount_applied,
       {_randint('days', 12, 55)} AS days_since_last_purchase,
       CASE WHEN average_rating > 4.0 THEN 'Satisfied' WHEN average_rating = 4.0 THEN 'Neutral'
            ELSE 'Unsatisfied' END AS satisfaction_level
FROM r"""

_LAST_KPI = ", last AS (SELECT * FROM kpi_history ORDER BY batch_id DESC LIMIT 1)\n"

_NEWEST = ", newest AS (SELECT * FROM enriched WHERE batch_id = (SELECT MAX(batch_id) FROM enriched))\n"

_BARS = _NEWEST + f"""
, cs AS (SELECT city AS label, {_mean("total_spend")} AS value FROM newest
         GROUP BY city ORDER BY city ASC NULLS FIRST LIMIT 8),
ms AS (SELECT membership_type AS label, CAST(COUNT(*) AS DOUBLE) AS value FROM newest
       GROUP BY membership_type ORDER BY membership_type ASC NULLS FIRST LIMIT 8)
SELECT 'avg_spend_by_city' AS chart, label, value, printf('%.2f', value) AS value_text,
       ROUND(GREATEST(CAST(6.0 AS DOUBLE),
             value / GREATEST((SELECT MAX(value) FROM cs), CAST(1.0 AS DOUBLE)) * 100.0), 1) AS width
FROM cs
UNION ALL
SELECT 'events_by_membership', label, value, CAST(CAST(value AS BIGINT) AS VARCHAR),
       ROUND(GREATEST(CAST(6.0 AS DOUBLE),
             value / GREATEST((SELECT MAX(value) FROM ms), CAST(1.0 AS DOUBLE)) * 100.0), 1)
FROM ms"""

_LATE = """
, arrivals AS (
  SELECT *, LEAST(3, (YEAR(event_time) - 1995) // 2
                  + CASE o_orderkey % 50 WHEN 3 THEN 1 WHEN 4 THEN 2 ELSE 0 END) AS epoch
  FROM enriched),
marks AS (
  SELECT epoch, newest_event_time, MAX(newest_event_time) OVER (ORDER BY epoch
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 30 DAY AS watermark
  FROM (SELECT epoch, MAX(event_time) AS newest_event_time FROM arrivals GROUP BY epoch))
"""

ORACLES.update({
    "stream_events": _q(f"SELECT {DECODED_COLS}, batch_id, is_at_risk, high_value_order FROM enriched"),
    "stream_kpis": ORACLES["kpi_history"],
    "stream_segments": ORACLES["customer_segments"],
    "stream_city_segments": ORACLES["city_segments"],
    "segment_upsert": ORACLES["customer_segments"],
    "late_events": _q(_LATE + f"""
SELECT {DECODED_COLS}, batch_id, CAST(epoch AS BIGINT) AS epoch, watermark
FROM arrivals JOIN marks USING (epoch) WHERE event_time < watermark"""),
    "trigger_counts": _q(_LATE + """
SELECT CAST(epoch AS BIGINT) AS epoch, COUNT(*) AS rows_read,
       COUNT(*) FILTER (watermark IS NULL OR event_time >= watermark) AS kept,
       COUNT(*) FILTER (event_time < watermark) AS late, CAST(0 AS BIGINT) AS rejected, watermark,
       MAX(MAX(arrivals.event_time)) OVER (ORDER BY epoch ROWS UNBOUNDED PRECEDING) AS newest_event_time
FROM arrivals JOIN marks USING (epoch) GROUP BY epoch, watermark"""),
    "session_kpis": f"""
WITH o AS (
  SELECT user_id, ts, value, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before
  FROM events WHERE ts IS NOT NULL),
s AS (
  SELECT *, SUM(CASE WHEN before IS NULL OR epoch_us(ts) - epoch_us(before) > 1800000000 THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session
  FROM o)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 30 MINUTE AS session_end,
       COUNT(*) AS event_count, {_total("value")} AS total_value
FROM s GROUP BY user_id, session""",
    "dedup_events": _q(f"SELECT {EVENT_COLS} FROM activity"),
    "window_kpis": f"""
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type, COUNT(*) AS event_count, {_total("value")} AS total_value
FROM events GROUP BY ALL""",
    "synth_events": _q(_SYNTH_EVENTS),
    "synth_messages": _SYNTH_MESSAGES,
    "report_cards": _q(_LAST_KPI + """
SELECT 1 AS position, 'Processed Batches' AS card, CAST(processed_batches AS VARCHAR) AS value FROM last
UNION ALL SELECT 2, 'Total Events', CAST(cumulative_event_count AS VARCHAR) FROM last
UNION ALL SELECT 3, 'Latest Revenue', printf('%.2f', total_revenue) FROM last
UNION ALL SELECT 4, 'At-Risk Customers', CAST(at_risk_count AS VARCHAR) FROM last"""),
    "report_bars": _q(_BARS),
    "report_summary": _q(_LAST_KPI + _NEWEST + """
SELECT 'processed_batches' AS metric, CAST(processed_batches AS DOUBLE) AS value FROM last
UNION ALL SELECT 'total_events', CAST(cumulative_event_count AS DOUBLE) FROM last
UNION ALL SELECT 'latest_revenue', total_revenue FROM last
UNION ALL SELECT 'latest_avg_spend', avg_spend FROM last
UNION ALL SELECT 'latest_at_risk', CAST(at_risk_count AS DOUBLE) FROM last
UNION ALL SELECT 'cities', CAST(COUNT(*) AS DOUBLE) FROM (SELECT city FROM newest GROUP BY city)
UNION ALL SELECT 'membership_groups', CAST(COUNT(*) AS DOUBLE)
          FROM (SELECT membership_type FROM newest GROUP BY membership_type)
UNION ALL SELECT 'at_risk_records', CAST(COUNT(*) AS DOUBLE) FROM newest WHERE is_at_risk"""),
})
