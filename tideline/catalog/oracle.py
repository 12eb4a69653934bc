"""The registered queries as plain SQL, for an independent engine.

Written from the definition of each result, not from the Spark plans: history
is ``lag``/``lead`` over whole groups, joins are plain, streams are batch
recomputes. Each query reads the whole of the given tables.
"""

from __future__ import annotations

INPUTS = {
    "fx_events": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
               CASE WHEN delivery = 1 THEN 'click' ELSE event_type END AS event_type,
               ts AS event_time, ts + (event_id % 73 + 5 * delivery) * INTERVAL '1' HOUR AS ingestion_time,
               concat(user_id, '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS session_id,
               CASE event_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'ios' ELSE 'android' END AS device,
               value AS amount
        FROM (SELECT *, 0 AS delivery FROM events
              UNION ALL SELECT *, 1 AS delivery FROM events WHERE event_id % 10 = 0)""",
    "fx_newest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC) AS rn FROM fx_events
        ) WHERE rn = 1""",
    "fx_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price,
               p_size <= 40 AS is_active
        FROM part""",
    "fx_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderkey % 200 AS product_id,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 10 * delivery AS DECIMAL(18,2)) AS amount,
               concat('C', o_custkey % 5) AS currency, o_orderdate AS order_time,
               o_orderdate + (CASE WHEN delivery = 1 THEN 5 ELSE o_orderkey % 4 END) * INTERVAL '1' DAY AS ingestion_time
        FROM (SELECT *, 0 AS delivery FROM orders
              UNION ALL SELECT *, 1 AS delivery FROM orders WHERE o_orderkey % 20 = 0)""",
    "fx_payments": """
        SELECT o_orderkey * 10 + delivery AS payment_id, o_orderkey AS order_id,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o_orderkey % 20 = 0 THEN 10 ELSE 0 END
                    - CASE WHEN o_orderkey % 50 = 7 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS paid_amount,
               CASE WHEN delivery = 1 OR o_orderstatus = 'O' THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
               o_orderdate AS payment_time, o_orderdate + (1 + delivery) * INTERVAL '1' DAY AS ingestion_time
        FROM (SELECT *, 0 AS delivery FROM orders
              UNION ALL SELECT *, 1 AS delivery FROM orders WHERE o_orderkey % 30 = 1)""",
    "fx_refunds": """
        SELECT l_orderkey * 10 + l_linenumber AS refund_id, l_orderkey AS order_id,
               CAST(l_quantity * 10 AS DECIMAL(18,2)) AS refund_amount, l_shipdate AS refund_time,
               l_shipdate + (l_partkey % 4) * INTERVAL '1' DAY AS ingestion_time, l_partkey AS seq
        FROM lineitem WHERE l_returnflag = 'R'""",
    "fx_rates": """
        SELECT * FROM (VALUES ('C0', CAST(1.00 AS DECIMAL(10,4))), ('C1', 1.10), ('C2', 0.90), ('C3', 1.25))
            AS r(currency, fx_rate)""",
    "fx_transactions": """
        SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
               CAST(CAST(value AS DECIMAL(18,2)) - 50 AS DOUBLE) AS amount,
               CASE WHEN event_id % 2 = 0 THEN 'credit' ELSE 'debit' END AS transaction_type,
               CASE WHEN event_id % 97 = 0 THEN 'bad'
                    ELSE concat(CAST(CAST(ts AS DATE) AS VARCHAR), ' 12:00:00') END AS transaction_timestamp
        FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 15 = 0)""",
    "fx_trips": """
        SELECT l_orderkey * 10 + l_linenumber AS trip_id, l_suppkey AS driver_id, r_name AS city,
               l_extendedprice AS fare_amount, l_shipdate AS trip_timestamp, l_partkey AS seq
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "fx_users": """
        SELECT c_custkey AS user_id, c_acctbal AS risk_score, c_mktsegment AS user_segment FROM customer""",
    "fx_updates": """
        SELECT o_custkey AS customer_id, c_name AS name, concat('e', o_custkey, '@x.org') AS email,
               c_mktsegment AS address,
               CASE o_orderstatus WHEN 'F' THEN 'LOW' WHEN 'O' THEN 'MEDIUM' WHEN 'P' THEN 'HIGH' END AS risk_level,
               o_orderdate AS updated_at, o_orderdate + (o_orderkey % 5) * INTERVAL '1' DAY AS ingestion_time,
               o_orderkey AS seq
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "fx_first": "SELECT * FROM fx_updates WHERE updated_at < TIMESTAMP '1999-01-01 00:00:00' AND seq % 7 <> 0",
    "fx_ontime": "SELECT * FROM fx_updates WHERE seq % 7 <> 0",
    "fx_behind": "SELECT * FROM fx_updates WHERE seq % 7 = 0",
    "fx_next": "SELECT * FROM fx_updates WHERE updated_at >= TIMESTAMP '1999-01-01 00:00:00' OR seq % 7 = 0",
    "fx_cdc": """
        SELECT o_custkey AS customer_id, concat('CITY', o_orderkey % 25) AS city,
               CASE WHEN o_orderkey % 40 = 0 THEN 'NOOP' WHEN o_orderstatus = 'O' THEN 'INSERT'
                    WHEN o_orderstatus = 'P' THEN 'UPDATE' WHEN o_orderstatus = 'F' THEN 'DELETE' END AS operation,
               o_orderdate AS event_time, o_orderkey AS seq
        FROM orders""",
    "fx_sales": """
        SELECT l_partkey AS product_id, CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS price,
               CAST(l_quantity AS INTEGER) AS units_sold, l_orderkey * 10 + l_linenumber AS seq
        FROM lineitem""",
    "fx_silver": """
        SELECT *, CAST(CAST(CAST(price AS DECIMAL(18,2)) * units_sold AS DECIMAL(18,2)) AS DOUBLE) AS revenue
        FROM fx_sales WHERE price IS NOT NULL""",
    "fx_skewed": """
        SELECT event_id, CASE WHEN event_id % 100 < 90 THEN 0 ELSE user_id END AS user_id, ts AS event_time,
               event_type, value AS amount
        FROM events""",
    "skew_counts": "SELECT user_id, CAST(count(*) AS BIGINT) AS row_count FROM fx_skewed GROUP BY user_id",
    "skew_top": "SELECT row_count FROM skew_counts ORDER BY row_count DESC LIMIT 10",
}

CUSTOMER_HASH = (
    r"sha256(concat_ws('|', " + ", ".join(
        rf"coalesce(replace(replace({c}, '\', '\\'), '|', '\|'), '\N')"
        for c in ("name", "email", "address", "risk_level")
    ) + "))"
)


def _sql(names: str, body: str) -> str:
    """``body`` behind the named inputs, in the order given."""
    parts = []
    for name in names.split():
        parts.append(f"{name} AS ({INPUTS[name]})")
    return ("WITH " + ", ".join(parts) + " " if parts else "") + body


def _money(expression: str) -> str:
    return f"CAST(CAST({expression} AS DECIMAL(18,2)) AS DOUBLE)"


def _history(source: str) -> str:
    """All versions of the customers in ``source``."""
    return f"""
        SELECT customer_id, name, email, address, risk_level, updated_at AS effective_from,
               lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS effective_to,
               lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) IS NULL AS is_current, record_hash
        FROM (
            SELECT *, lag(record_hash) OVER (PARTITION BY customer_id ORDER BY updated_at) AS before
            FROM (
                SELECT *, {CUSTOMER_HASH} AS record_hash,
                       row_number() OVER (PARTITION BY customer_id, updated_at
                                          ORDER BY ingestion_time DESC, seq DESC) AS rn
                FROM {source}
            ) WHERE rn = 1
        ) WHERE before IS NULL OR before <> record_hash"""


INPUTS["dim"] = _history("fx_first")
INPUTS["newest"] = f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, {CUSTOMER_HASH} AS record_hash,
                   row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, ingestion_time DESC, seq DESC) AS rn
            FROM fx_next
        ) WHERE rn = 1"""
INPUTS["current"] = "SELECT * FROM dim WHERE is_current"
INPUTS["all_dim"] = _history("fx_updates")
INPUTS["ontime_dim"] = _history("fx_ontime")
INPUTS["faulty"] = """
        SELECT * REPLACE (customer_id % 11 = 0 OR is_current AS is_current,
                          CASE WHEN customer_id % 11 <> 0 THEN effective_to END AS effective_to)
        FROM all_dim"""

_OPEN = "customer_id, name, email, address, risk_level"


def _apply(insert_new: bool) -> str:
    added = f"""
        UNION ALL
        SELECT {_OPEN}, updated_at, NULL, true, record_hash FROM newest
        WHERE customer_id NOT IN (SELECT customer_id FROM current)""" if insert_new else ""
    return f"""
        SELECT * FROM dim WHERE NOT is_current
        UNION ALL
        SELECT {", ".join("c." + c for c in _OPEN.split(", "))}, c.effective_from,
               CASE WHEN n.updated_at > c.effective_from AND n.record_hash <> c.record_hash THEN n.updated_at END,
               NOT coalesce(n.updated_at > c.effective_from AND n.record_hash <> c.record_hash, false), c.record_hash
        FROM current c LEFT JOIN newest n ON n.customer_id = c.customer_id
        WHERE n.customer_id IS NULL OR n.updated_at <> c.effective_from OR n.record_hash = c.record_hash
        UNION ALL
        SELECT {", ".join("n." + c for c in _OPEN.split(", "))}, n.updated_at, NULL, true, n.record_hash
        FROM newest n JOIN current c ON n.customer_id = c.customer_id
        WHERE n.updated_at >= c.effective_from AND n.record_hash <> c.record_hash{added}"""


def _sessions(where: str, deliveries: str = "fx_events") -> str:
    return f"""
        , newest AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC) AS rn
                FROM {deliveries}
            ) WHERE rn = 1 AND {where}
        )
        SELECT session_id, user_id, min(event_time) AS session_start, max(event_time) AS session_end,
               CAST(count(*) AS BIGINT) AS total_events,
               CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS total_clicks,
               {_money("sum(CAST(price AS DECIMAL(18,2)))")} AS total_value,
               CAST(count(DISTINCT category) AS BIGINT) AS category_diversity,
               CAST(min(event_time) AS DATE) AS event_date
        FROM newest LEFT JOIN (SELECT * FROM fx_products WHERE is_active) p ON newest.product_id = p.product_id
        GROUP BY session_id, user_id"""


def _revenue(paid: str, dates: str = "") -> str:
    return f"""
        , o AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingestion_time DESC, amount DESC) AS rn
                           FROM fx_orders) WHERE rn = 1
        ), paid AS ({paid}),
        r AS (
            SELECT order_id, sum(refund_amount) AS total_refund FROM (
                SELECT *, row_number() OVER (PARTITION BY refund_id
                                             ORDER BY ingestion_time DESC, seq DESC, refund_amount DESC) AS rn
                FROM fx_refunds) WHERE rn = 1 GROUP BY order_id
        ), f AS (
            SELECT CAST(order_time AS DATE) AS order_date, o.order_id, amount, paid_amount,
                   amount * fx_rate AS amount_base,
                   CAST(coalesce(total_refund, 0) AS DECIMAL(18,2)) * fx_rate AS refund_base
            FROM o JOIN paid USING (order_id) LEFT JOIN r USING (order_id) LEFT JOIN fx_rates USING (currency)
        )
        SELECT order_date, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
               {_money("sum(amount_base)")} AS gross_revenue, {_money("sum(refund_base)")} AS refund_amount,
               CAST(CAST(sum(amount_base) AS DECIMAL(18,2)) - CAST(sum(refund_base) AS DECIMAL(18,2)) AS DOUBLE) AS net_revenue,
               CAST(count(*) FILTER (WHERE abs(paid_amount - amount) > 0.01) AS BIGINT) AS mismatch_count
        FROM f {dates} GROUP BY order_date"""


_ALL_PAYMENTS = """
            SELECT order_id, sum(paid_amount) AS paid_amount FROM (
                SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY ingestion_time DESC) AS rn FROM fx_payments)
            WHERE rn = 1 AND payment_status = 'SUCCESS' GROUP BY order_id"""
_LAST_PAYMENT = """
            SELECT order_id, paid_amount FROM (
                SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingestion_time DESC, payment_id DESC) AS rn
                FROM fx_payments) WHERE rn = 1 AND payment_status = 'SUCCESS'"""
_AFFECTED = """WHERE order_date IN (
            SELECT CAST(order_time AS DATE) FROM fx_orders WHERE order_id IN (
                SELECT order_id FROM fx_orders WHERE ingestion_time > TIMESTAMP '2001-06-01 00:00:00'
                UNION ALL SELECT order_id FROM fx_payments WHERE ingestion_time > TIMESTAMP '2001-06-01 00:00:00'
                UNION ALL SELECT order_id FROM fx_refunds WHERE ingestion_time > TIMESTAMP '2001-06-01 00:00:00'))"""


def _rolling(frame: str) -> str:
    return f"""
        , daily AS (
            SELECT user_id, CAST(order_time AS DATE) AS event_date, sum(amount) AS daily_amount, count(*) AS daily_count
            FROM fx_orders JOIN fx_users USING (user_id) GROUP BY ALL
        )
        SELECT user_id, event_date, CAST(daily_amount AS DOUBLE) AS daily_amount, CAST(daily_count AS BIGINT) AS daily_count,
               CAST(sum(daily_amount) OVER w AS DOUBLE) AS total_amount_30d,
               CAST(sum(daily_count) OVER w AS BIGINT) AS transaction_count_30d
        FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY event_date {frame})"""


_JOINED = """
        SELECT s.user_id, event_id, event_time, event_type, amount, risk_score, user_segment
        FROM fx_skewed s JOIN fx_users u ON s.user_id = u.user_id"""

_JOINED_DATED = _JOINED.replace("SELECT s.user_id,", "SELECT s.user_id, CAST(event_time AS DATE) AS event_date,")

_CDC_LATEST = """
            SELECT customer_id, city, sha256(concat_ws('|', customer_id, city)) AS hash_value, event_time AS updated_at
            FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY event_time DESC, seq DESC) AS rn
                  FROM fx_cdc WHERE operation IN ('INSERT', 'UPDATE', 'DELETE'))
            WHERE rn = 1 AND operation <> 'DELETE'"""

_CDC_HISTORY = r"""
        SELECT customer_id, city, event_time AS effective_from, effective_to, effective_to IS NULL AS is_current,
               sha256(city) AS record_hash
        FROM (
            SELECT *, lead(event_time) OVER (PARTITION BY customer_id ORDER BY event_time) AS effective_to
            FROM (
                SELECT *, lag(state) OVER (PARTITION BY customer_id ORDER BY event_time) AS before
                FROM (
                    SELECT *, CASE WHEN operation = 'DELETE' THEN '' ELSE city END AS state,
                           row_number() OVER (PARTITION BY customer_id, event_time ORDER BY seq DESC) AS rn
                    FROM fx_cdc WHERE operation IN ('INSERT', 'UPDATE', 'DELETE')
                ) WHERE rn = 1
            ) WHERE state <> coalesce(before, '')
        ) WHERE operation <> 'DELETE'"""

_LATE_SPLIT = f"""
        , l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at
                                                            ORDER BY ingestion_time DESC, seq DESC) AS rn FROM fx_behind)
                WHERE rn = 1),
        points AS (
            SELECT {_OPEN}, effective_from AS updated_at, 0 AS seq, effective_from AS ingestion_time FROM ontime_dim
            WHERE customer_id IN (SELECT customer_id FROM l)
            UNION ALL
            SELECT {_OPEN}, updated_at, 1, updated_at FROM l
        ), rebuilt AS ({_history("points")})
        SELECT * FROM ontime_dim WHERE customer_id NOT IN (SELECT customer_id FROM l)
        UNION ALL SELECT * FROM rebuilt"""

def _product_hash(price: str) -> str:
    columns = ("p_name", "p_type", f"CAST(CAST({price} AS DECIMAL(38,6)) AS VARCHAR)", "'active'")
    return "sha256(concat_ws('|', " + ", ".join(columns) + "))"


def _product_row(price: str, start: str, end: str, current: str) -> str:
    return f"""
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, CAST({price} AS DOUBLE) AS price,
               'active' AS status, TIMESTAMP '{start}' AS effective_from, CAST({end} AS TIMESTAMP) AS effective_to,
               {current} AS is_current, {_product_hash(price)} AS record_hash
        FROM part"""


_OLD_PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"
_NEW_PRICE = "(CAST(p_retailprice AS DECIMAL(18,2)) + p_partkey % 3)"
_PRODUCT_SCD2 = (
    _product_row(_OLD_PRICE, "2024-01-01 00:00:00", "CASE WHEN p_partkey % 3 <> 0 THEN '2024-02-01 00:00:00' END",
                 "p_partkey % 3 = 0")
    + " UNION ALL "
    + _product_row(_NEW_PRICE, "2024-02-01 00:00:00", "NULL", "true") + " WHERE p_partkey % 3 <> 0"
)


def _windows(days: int, having: str = "") -> str:
    """Windows of ``days`` days, one starting each day."""
    return f"""
        SELECT start AS window_start, start + INTERVAL '{days}' DAY AS window_end, user_id,
               CAST(count(*) AS BIGINT) AS event_count
        FROM (SELECT user_id, unnest(generate_series(date_trunc('day', ts) - INTERVAL '{days - 1}' DAY,
                                                     date_trunc('day', ts), INTERVAL '1' DAY)) AS start FROM events)
        GROUP BY start, user_id {having}"""


_HOURLY = f"""
        SELECT date_trunc('hour', event_time) AS window_start,
               date_trunc('hour', event_time) + INTERVAL '1' HOUR AS window_end, user_id AS merchant_id,
               CAST(count(*) AS BIGINT) AS txn_count, {_money("sum(CAST(amount AS DECIMAL(18,2)))")} AS total_amount,
               {_money("sum(CAST(amount AS DECIMAL(18,2)))")} / count(*) AS avg_amount
        FROM fx_newest GROUP BY ALL"""

# What a stream has closed at its end: windows up to the last event less the delay.
_CLOSED_HOURS = """
        SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL '1' HOUR AS window_end, user_id,
               CAST(count(*) AS BIGINT) AS event_count
        FROM events GROUP BY date_trunc('hour', ts), user_id
        HAVING date_trunc('hour', ts) + INTERVAL '1' HOUR
               <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '2' HOUR FROM events)"""
_CLOSED_SESSIONS = """
        WITH marked AS (
            SELECT user_id, ts,
                   CASE WHEN ts < lag(ts) OVER w + INTERVAL '6' HOUR THEN 0 ELSE 1 END AS starts
            FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
        ), numbered AS (
            SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM marked
        )
        SELECT min(ts) AS window_start, max(ts) + INTERVAL '6' HOUR AS window_end, user_id,
               CAST(count(*) AS BIGINT) AS event_count
        FROM numbered GROUP BY user_id, n
        HAVING max(ts) + INTERVAL '6' HOUR
               <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '1' DAY FROM events)"""


_MERGED_CLAUSES = f"""
            SELECT p_partkey AS product_id, p_type AS category,
                   CASE WHEN p_size <= 40 AND {_NEW_PRICE} <= {_OLD_PRICE} THEN p_retailprice
                        ELSE CAST({_NEW_PRICE} AS DOUBLE) END AS price
            FROM part WHERE p_partkey % 17 <> 0"""


_AS_OF = _sql("fx_updates all_dim", """
    SELECT * FROM all_dim WHERE effective_from <= TIMESTAMP '1997-03-01 00:00:00'
        AND (effective_to IS NULL OR effective_to > TIMESTAMP '1997-03-01 00:00:00')""")


def statements() -> dict[str, str]:
    revenue_inputs = "fx_orders fx_payments fx_refunds fx_rates"
    next_dim = "fx_updates fx_first fx_next dim newest current"
    return {
        "regional_sales": _sql("", f"""
            SELECT r_name AS region, {_money("sum(CAST(l_extendedprice AS DECIMAL(18,2)))")} AS total_sales
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                 JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey
                 JOIN region ON n_regionkey = r_regionkey
            GROUP BY r_name"""),
        "daily_txn_totals": _sql("fx_transactions", f"""
            SELECT CAST(try_cast(transaction_timestamp AS TIMESTAMP) AS DATE) AS transaction_date, transaction_type,
                   {_money("sum(CAST(amount AS DECIMAL(18,2)))")} AS total_amount
            FROM (SELECT DISTINCT * FROM fx_transactions) WHERE amount > 0 GROUP BY ALL"""),
        "unreadable_times": _sql("fx_transactions", """
            SELECT * FROM fx_transactions
            WHERE transaction_timestamp IS NOT NULL AND try_cast(transaction_timestamp AS TIMESTAMP) IS NULL"""),
        "top3_drivers": _sql("fx_trips", f"""
            SELECT city, trip_date, driver_id, CAST(total_fare AS DOUBLE) AS total_fare, CAST(rank AS INTEGER) AS rank
            FROM (SELECT *, row_number() OVER (PARTITION BY city, trip_date ORDER BY total_fare DESC, driver_id) AS rank
                  FROM (SELECT city, CAST(trip_timestamp AS DATE) AS trip_date, driver_id,
                               sum(CAST(fare_amount AS DECIMAL(18,2))) AS total_fare
                        FROM (SELECT *, row_number() OVER (PARTITION BY trip_id
                                  ORDER BY trip_timestamp DESC, seq DESC, fare_amount DESC) AS rn FROM fx_trips)
                        WHERE rn = 1 GROUP BY ALL)) WHERE rank <= 3"""),
        "session_metrics": _sql("fx_events fx_products", _sessions("true")),
        "session_metrics_incremental": _sql(
            "fx_events fx_products", _sessions(
                "session_id IN (SELECT session_id FROM fx_events WHERE ingestion_time > TIMESTAMP '2024-01-15 00:00:00')")),
        "daily_revenue": _sql(revenue_inputs, _revenue(_ALL_PAYMENTS)),
        "daily_revenue_last_payment": _sql(revenue_inputs, _revenue(_LAST_PAYMENT)),
        "daily_revenue_run": _sql(revenue_inputs, _revenue(_ALL_PAYMENTS)),
        "daily_revenue_since": _sql(revenue_inputs, _revenue(_ALL_PAYMENTS, _AFFECTED)),
        "unrated_orders": _sql("fx_orders fx_rates", """
            SELECT currency, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count
            FROM fx_orders WHERE currency NOT IN (SELECT currency FROM fx_rates) GROUP BY currency"""),
        "rolling_30d": _sql("fx_orders fx_users", _rolling(
            "RANGE BETWEEN INTERVAL '29' DAY PRECEDING AND CURRENT ROW")),
        "rolling_30_rows": _sql("fx_orders fx_users", _rolling("ROWS BETWEEN 29 PRECEDING AND CURRENT ROW")),
        "incremental_events": _sql("fx_events", """
            SELECT * FROM fx_events WHERE ingestion_time > TIMESTAMP '2024-01-15 00:00:00'"""),
        "next_watermark": _sql("fx_events", "SELECT max(ingestion_time) AS boundary FROM fx_events"),
        "latest_by_ingestion": _sql("fx_events fx_newest", "SELECT * FROM fx_newest"),
        "latest_by_two_times": _sql("fx_updates", """
            SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                ORDER BY updated_at DESC, ingestion_time DESC, seq DESC) AS rn FROM fx_updates) WHERE rn = 1"""),
        "dedup_single_key": _sql("fx_transactions", "SELECT DISTINCT * FROM fx_transactions"),
        "dedup_composite": _sql("fx_updates", """
            SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at
                ORDER BY ingestion_time DESC, seq DESC) AS rn FROM fx_updates) WHERE rn = 1"""),
        "row_hash_customers": r"""
            SELECT c_custkey, sha256(concat_ws('|', c_custkey, coalesce(c_name, '\N'), coalesce(CAST(c_nationkey AS VARCHAR), '\N'),
                coalesce(CAST(CAST(c_acctbal AS DECIMAL(38,2)) AS VARCHAR), '\N'), coalesce(c_mktsegment, '\N'))) AS record_hash
            FROM customer""",
        "silver_revenue": _sql("fx_sales fx_silver", "SELECT * FROM fx_silver"),
        "product_upsert": _sql("fx_products fx_sales fx_silver", """
            , latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                ORDER BY seq DESC, price DESC, units_sold DESC) AS rn FROM fx_silver) WHERE rn = 1)
            SELECT product_id, price, units_sold, seq, revenue FROM latest
            UNION ALL SELECT product_id, price, 0, 0, 0.0 FROM fx_products
            WHERE is_active AND product_id NOT IN (SELECT product_id FROM latest)"""),
        "merge_clauses": _MERGED_CLAUSES,
        "merge_clauses_shuffled": _MERGED_CLAUSES,
        "merge_expressions": f"""
            SELECT p_partkey AS product_id, CASE WHEN p_size <= 40 THEN p_type ELSE 'NEW' END AS category,
                   CASE WHEN p_size <= 40 THEN (p_retailprice + CAST({_NEW_PRICE} AS DOUBLE)) / 2
                        ELSE CAST({_NEW_PRICE} AS DOUBLE) END AS price
            FROM part""",
        "merge_source_conflicts": _sql("fx_updates", """
            SELECT customer_id, CAST(count(*) AS BIGINT) AS row_count FROM fx_updates GROUP BY customer_id
            HAVING count(*) > 1"""),
        "cdc_latest_state": _sql("fx_cdc", _CDC_LATEST),
        "cdc_late_events": _sql("fx_cdc", """
            SELECT * FROM fx_cdc WHERE operation IN ('INSERT', 'UPDATE', 'DELETE')
                AND event_time < TIMESTAMP '2000-01-01 00:00:00' - INTERVAL '1' DAY"""),
        "scd2_initial": _sql("fx_updates", f"""
            SELECT {_OPEN}, updated_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current,
                   {CUSTOMER_HASH} AS record_hash
            FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
                ORDER BY updated_at DESC, ingestion_time DESC, seq DESC) AS rn FROM fx_updates) WHERE rn = 1"""),
        "scd2_changes": _sql(next_dim, """
            SELECT n.* FROM newest n LEFT JOIN current c ON n.customer_id = c.customer_id
            WHERE c.record_hash IS NULL OR c.record_hash <> n.record_hash"""),
        "scd2_apply": _sql(next_dim, _apply(insert_new=True)),
        "scd2_apply_changed_only": _sql(next_dim, _apply(insert_new=False)),
        "product_scd2": _PRODUCT_SCD2,
        "scd2_history": _sql("fx_updates", _history("fx_updates")),
        "scd2_history_sliced": _sql("fx_updates", _history("fx_updates")),
        "cdc_scd2_history": _sql("fx_cdc", _CDC_HISTORY),
        "scd2_late_detect": _sql("fx_updates fx_ontime fx_behind ontime_dim", """
            SELECT l.* FROM fx_behind l JOIN ontime_dim c ON l.customer_id = c.customer_id
            WHERE c.is_current AND l.updated_at < c.effective_from"""),
        "scd2_late_fix": _sql("fx_updates", _history("fx_updates")),
        "scd2_late_split": _sql("fx_updates fx_ontime fx_behind ontime_dim", _LATE_SPLIT),
        "scd2_as_of": _AS_OF,
        "customer_dimension_as_of": _AS_OF,
        "scd2_multi_active": _sql("fx_updates all_dim faulty", """
            SELECT customer_id, CAST(sum(CAST(is_current AS INTEGER)) AS BIGINT) AS active_count FROM faulty
            GROUP BY customer_id HAVING sum(CAST(is_current AS INTEGER)) > 1"""),
        "scd2_overlaps": _sql("fx_updates all_dim faulty", """
            SELECT * FROM (SELECT *, lead(effective_from) OVER (PARTITION BY customer_id ORDER BY effective_from) AS next_start
                           FROM faulty)
            WHERE next_start IS NOT NULL AND (effective_to IS NULL OR effective_to > next_start)"""),
        "key_profile": _sql("fx_skewed skew_counts", "SELECT * FROM skew_counts"),
        "top_key_share": _sql("fx_skewed skew_counts skew_top", """
            SELECT *, round(top_rows / all_rows, 6) AS top_share FROM (
                SELECT CAST((SELECT sum(row_count) FROM skew_top) AS BIGINT) AS top_rows,
                       CAST(sum(row_count) AS BIGINT) AS all_rows FROM skew_counts)"""),
        "skew_metrics": _sql("fx_skewed skew_counts skew_top", """
            SELECT *, round(top_rows / all_rows, 6) AS top_share FROM (
                SELECT 'run-1' AS run_id, CAST(count(*) AS BIGINT) AS key_count, max(row_count) AS largest_key_rows,
                       CAST((SELECT sum(row_count) FROM skew_top) AS BIGINT) AS top_rows,
                       CAST(sum(row_count) AS BIGINT) AS all_rows FROM skew_counts)"""),
        "salted_join": _sql("fx_skewed fx_users", _JOINED),
        "heavy_key_join": _sql("fx_skewed fx_users", _JOINED),
        "salted_agg": _sql("fx_skewed", f"""
            SELECT user_id, CAST(count(*) AS BIGINT) AS row_count,
                   {_money("sum(CAST(amount AS DECIMAL(18,2)))")} AS total_amount,
                   min(amount) AS min_amount, max(amount) AS max_amount
            FROM fx_skewed GROUP BY user_id"""),
        "broadcast_join": _sql("fx_users", """
            SELECT e.user_id, event_id, event_type, value, risk_score, user_segment
            FROM events e JOIN fx_users u ON e.user_id = u.user_id"""),
        "partition_report": _sql("fx_skewed", """
            SELECT 'round robin' AS layout, CAST(16 AS BIGINT) AS partitions, CAST(count(*) AS BIGINT) AS total_rows, true AS even
            FROM fx_skewed UNION ALL SELECT 'merged down', 4, count(*), true FROM fx_skewed"""),
        "composite_repartition": _sql("fx_skewed skew_counts", """
            SELECT 'user' AS layout, CAST(sum(row_count) AS BIGINT) AS total_rows, 2 * max(row_count) > sum(row_count) AS crowded
            FROM skew_counts UNION ALL SELECT 'user and event', CAST(sum(row_count) AS BIGINT), false FROM skew_counts"""),
        "dynamic_overwrite_roundtrip": _sql("fx_events", """
            SELECT * EXCLUDE (oldest, latest) FROM (
                SELECT *, CAST(event_time AS DATE) AS event_date,
                       row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time) AS oldest,
                       row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC) AS latest
                FROM fx_events)
            WHERE CASE WHEN event_date >= DATE '2024-01-15' THEN latest ELSE oldest END = 1"""),
        "schema_evolution_roundtrip": _sql("fx_products", """
            SELECT product_id, category, price, is_active, CASE WHEN is_active THEN product_name END AS product_name
            FROM fx_products"""),
        "compact_and_cluster": _sql("fx_orders", f"SELECT * REPLACE ({_money('amount')} AS amount) FROM fx_orders"),
        "curve_pruning": _sql("fx_orders", """
            SELECT CAST(count(*) FILTER (user_id = 7) AS BIGINT) AS one_user,
                   CAST(count(*) FILTER (order_time = TIMESTAMP '1997-03-03 00:00:00') AS BIGINT) AS one_day,
                   true AS few_files_user, true AS few_files_day FROM fx_orders"""),
        "compact_small_files": _sql("fx_orders", f"""
            SELECT currency, CAST(count(*) AS BIGINT) AS order_rows, {_money('sum(amount)')} AS amount, true AS large_kept,
                   true AS fewer_files FROM fx_orders GROUP BY currency"""),
        "named_format_roundtrip": _sql("fx_updates", "SELECT * FROM fx_updates"),
        "csv_roundtrip": _sql("fx_transactions", "SELECT * FROM fx_transactions"),
        "stream_hourly_metrics": _sql("fx_events fx_newest", _HOURLY),
        "stream_sliding_14d": _windows(14),
        "stream_sliding_7d": _windows(7),
        "stream_sessions": _CLOSED_SESSIONS,
        "stream_preagg_rollup": """
            WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS event_count
                           FROM events GROUP BY ALL)
            SELECT *, CAST(sum(event_count) OVER (PARTITION BY user_id ORDER BY event_date
                           RANGE BETWEEN INTERVAL '13' DAY PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_count
            FROM daily""",
        "stream_append": _CLOSED_HOURS,
        "stream_late_drops": _sql("fx_events", """
            , placed AS (
                SELECT event_time, CAST(greatest(0, floor(date_diff('hour', TIMESTAMP '2024-01-01', ingestion_time) / 72)) AS INTEGER) AS b
                FROM fx_events
            ), capped AS (SELECT event_time, least(b, 10) AS b FROM placed),
            seen AS (SELECT b, max(event_time) AS latest FROM capped GROUP BY b),
            marks AS (
                SELECT s.b, (SELECT max(latest) FROM seen o WHERE o.b < s.b - 1) - INTERVAL '1' DAY AS watermark FROM seen s
            )
            SELECT CAST(count(*) AS BIGINT) AS input_rows,
                   CAST(count(*) FILTER (event_time <= date_trunc('millisecond', watermark)) AS BIGINT) AS late_rows_dropped
            FROM capped JOIN marks USING (b)"""),
        "stream_activity_append": _windows(14, """
            HAVING start + INTERVAL '14' DAY <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL '2' DAY FROM events)"""),
        "incremental_boundary_run": _sql("fx_events", """
            SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 50 <> 0
                              THEN CAST(CAST(ingestion_time AS DATE) AS TIMESTAMP) END AS ingestion_time) FROM fx_events"""),
        "incremental_run": _sql("fx_events", "SELECT * FROM fx_events"),
        "product_table_run": _sql("fx_sales fx_silver", """
            SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id
                ORDER BY seq DESC, price DESC, units_sold DESC) AS rn FROM fx_silver) WHERE rn = 1"""),
        "session_metrics_run": _sql("fx_events fx_products", _sessions("TRUE", """(
            SELECT * REPLACE (event_time - CASE WHEN CAST(event_id AS BIGINT) % 30 = 0
                                                 AND ingestion_time = event_time + (CAST(event_id AS BIGINT) % 73 + 5) * INTERVAL '1' HOUR
                                           THEN INTERVAL '1' DAY ELSE INTERVAL '0' DAY END AS event_time) FROM fx_events)""")),
        "customer_dimension_run": _sql("fx_updates", _history("fx_updates")),
        "change_feed_silver_run": _sql("fx_cdc", _CDC_LATEST),
        "change_feed_retention_run": _sql("fx_cdc", _CDC_LATEST),
        "change_feed_run": _sql("fx_cdc", _CDC_HISTORY),
        "skew_safe_output": _sql("fx_skewed fx_users", _JOINED_DATED),
        "tuned_join_output": _sql("fx_skewed fx_users", _JOINED_DATED),
        "tuned_join_salted": _sql("fx_skewed fx_users", _JOINED_DATED),
        "skew_metrics_run": _sql("fx_skewed fx_users", """
            , runs AS (
                SELECT 'run-2' AS run_id, f.user_id FROM fx_skewed f JOIN fx_users u ON f.user_id = u.user_id
                UNION ALL SELECT 'run-1', f.user_id FROM fx_skewed f JOIN fx_users u ON f.user_id = u.user_id
                WHERE event_time < TIMESTAMP '2024-01-15 00:00:00'
            ), counts AS (
                SELECT run_id, count(*) AS n, row_number() OVER (PARTITION BY run_id ORDER BY count(*) DESC) AS place
                FROM runs GROUP BY run_id, user_id
            )
            SELECT run_id, CAST(sum(n) AS BIGINT) AS all_rows, max(n) AS largest_key_rows,
                   CAST(sum(n) FILTER (place <= 10) AS BIGINT) AS top_rows,
                   round(sum(n) FILTER (place <= 10) / sum(n), 6) AS top_share
            FROM counts GROUP BY run_id"""),
        "flat_join_output": _sql("fx_skewed fx_users", _JOINED_DATED),
        "stream_audit": _sql("fx_events fx_newest", """
            SELECT user_id AS merchant_id, CAST(count(*) AS BIGINT) AS published, CAST(count(*) AS BIGINT) AS recomputed,
                   CAST(0 AS BIGINT) AS difference
            FROM fx_newest GROUP BY user_id"""),
    }
