"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Each statement is put together from named building blocks (common table expressions) and a final
select. Money is summed in whole cents and rounded half up with integers, because the engine divides
decimals as doubles.
"""

from __future__ import annotations

import re

# The values below are written out here and not taken from the library, so that a wrong one there is seen.
TEXT_PATTERNS = {
    "email": r"(^|[\x00-\x24\x26-\x2A\x2C\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F])[^\x00-\x24\x26-\x2A\x2C\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "card": r"[0-9]{4,}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4,}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{4,5}|[0-9]{13,}",
    "phone": r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}",
}
TEXT_MASKS = {"email": "[EMAIL]", "card": "[CARD]", "phone": "[PHONE]"}

RUN_ID = "run-2024-01-30"
RUN_DATE = "DATE '2024-01-30'"
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """round(numerator / denominator, digits) for whole non-negative numbers, scale = 10 ** digits."""
    return f"((2 * {scale} * ({numerator}) + ({denominator})) // (2 * ({denominator}))) / {float(scale)}"


def address(key: str) -> str:
    street = f"cast({key} % 9000 + 100 as varchar) || ' Main St, Springfield, IL ' || lpad(cast({key} % 100000 as varchar), 5, '0')"
    return f"CASE WHEN {key} % 5 = 0 THEN 'c/o Dr. Lee, ' || {street} ELSE {street} END"


def card(key: str) -> str:
    return (
        f"lpad(cast({key} % 10000 as varchar), 4, '0') AS card_last4, "
        f"CASE {key} % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Amex' END AS card_type"
    )


def hashed(key: str) -> str:
    return f"sha256('user.' || cast({key} as varchar) || '@example.com')"


ACTION = (
    "CASE WHEN shipping_address LIKE 'c/o %' THEN 'suppress (entities: LOCATION, PERSON)' "
    "ELSE 'suppress (entities: LOCATION)' END"
)

BLOCKS = {
    "r_lines": """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS copy_no
            FROM lineitem) WHERE copy_no = 1""",
    "r_orders": f"""
        SELECT 'ORD-' || l_orderkey || '-' || l_linenumber AS order_id,
               'CUST-' || o_custkey AS customer_id,
               'PROD-' || l_partkey AS product_id,
               cast(l_quantity AS bigint) AS quantity,
               cast(round(p_retailprice * 100) AS bigint) AS price_cents,
               cast(round(l_extendedprice * 100) AS bigint) AS amount_cents,
               cast(o_orderdate AS date) AS order_date,
               CASE WHEN l_returnflag = 'R' THEN 'returned'
                    WHEN o_orderstatus = 'O' THEN 'placed'
                    WHEN o_orderstatus = 'P' AND l_linestatus = 'O' THEN 'paid'
                    WHEN o_orderstatus = 'P' THEN 'shipped'
                    ELSE 'delivered' END AS status,
               {address('o_custkey')} AS shipping_address,
               {card('l_orderkey')}
        FROM r_lines JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "r_customers": f"""
        SELECT 'CUST-' || c_custkey AS customer_id, c_name,
               {hashed('c_custkey')} AS hashed_email,
               {address('c_custkey')} AS shipping_address,
               length(cast(c_custkey AS varchar)) AS key_length,
               first_order AS registration_date,
               CASE WHEN c_acctbal >= 7500 THEN 'gold' WHEN c_acctbal >= 4000 THEN 'silver'
                    WHEN c_acctbal < 0 THEN NULL ELSE 'bronze' END AS tier
        FROM customer LEFT JOIN (
            SELECT o_custkey, min(cast(o_orderdate AS date)) AS first_order FROM orders GROUP BY o_custkey) f
        ON c_custkey = o_custkey""",
    "r_products": """
        SELECT 'PROD-' || p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
               cast(round(p_retailprice * 100) AS bigint) AS price_cents,
               (cast(round(p_retailprice * 100) AS bigint) * (35 + p_size % 31) + 50) // 100 AS cost_cents,
               'SUPP-' || (p_partkey % 100) AS supplier_id,
               cast(p_size AS bigint) AS reorder_threshold,
               cast(p_size AS bigint) * 10 AS current_stock
        FROM part""",
    "r_inventory": """
        SELECT 'INV-' || l_partkey || '-' || strftime(m, '%Y%m') AS inventory_id,
               'PROD-' || l_partkey AS product_id, m AS date, stock_level,
               cast(p_size AS bigint) AS reorder_threshold, units_sold, units_received
        FROM (
            SELECT l_partkey, cast(date_trunc('month', l_shipdate) AS date) AS m,
                   cast(coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0) AS bigint) AS stock_level,
                   cast(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0) AS bigint) AS units_sold,
                   cast(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS bigint) AS units_received
            FROM lineitem GROUP BY 1, 2) JOIN part ON l_partkey = p_partkey""",
    "r_roles": """
        SELECT *, CASE event_type WHEN 'signup' THEN 'customer_registered' WHEN 'view' THEN 'item_added_to_cart'
                  WHEN 'purchase' THEN 'order_placed' WHEN 'click' THEN 'payment_processed'
                  ELSE 'order_returned' END AS role,
               cast(regexp_extract(props, '[0-9]+') AS bigint) AS item
        FROM events""",
    "r_bronze": f"""
        SELECT 'EVT-' || event_id AS event_id, role AS event_type,
               date_trunc('milliseconds', ts + to_seconds(delay)) AS event_timestamp,
               CASE WHEN role <> 'customer_registered' THEN 'ORD-' || event_id END AS order_id,
               'CUST-' || user_id AS customer_id, user_id,
               CASE WHEN role <> 'customer_registered' THEN 'PROD-' || item END AS product_id,
               CASE WHEN role <> 'customer_registered' THEN item END AS quantity,
               CASE WHEN role <> 'customer_registered' THEN value END AS order_amount,
               CASE WHEN role = 'order_placed' THEN {address('user_id')} END AS shipping_address,
               {card('event_id')},
               CASE role WHEN 'customer_registered' THEN 'joined' WHEN 'item_added_to_cart' THEN 'basket'
                    WHEN 'order_placed' THEN 'placed' WHEN 'payment_processed' THEN 'paid' ELSE 'returned' END AS status
        FROM r_roles, (VALUES (0), (5)) AS d(delay)
        WHERE delay = 0 OR event_id % 7 = 0""",
    "r_first": """
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id, event_type ORDER BY event_timestamp) AS copy_no FROM r_bronze)
        WHERE copy_no = 1""",
    "r_events": """
        SELECT * FROM r_first WHERE order_id IS NOT NULL AND customer_id IS NOT NULL""",
    "r_parsed": """
        SELECT *, CAST(NULL AS VARCHAR) AS reject_reason FROM r_bronze""",
    "r_dates": """
        SELECT cast(d AS date) AS full_date, cast(strftime(d, '%Y%m%d') AS bigint) AS date_key
        FROM (SELECT unnest(generate_series(
            least((SELECT min(o_orderdate::date) FROM orders), (SELECT min(date_trunc('month', l_shipdate)::date) FROM lineitem)),
            greatest((SELECT max(o_orderdate::date) FROM orders), (SELECT max(date_trunc('month', l_shipdate)::date) FROM lineitem)),
            INTERVAL 1 DAY)) AS d)""",
    "r_customer_keys": "SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key FROM r_customers",
    "r_product_keys": "SELECT product_id, row_number() OVER (ORDER BY product_id) AS product_key FROM r_products",
    "r_totals": """
        SELECT customer_id, count(*) AS n, cast(sum(amount_cents) AS bigint) AS cents
        FROM r_orders WHERE status <> 'placed' GROUP BY 1""",
    "r_customer_dim": """
        SELECT customer_id, hashed_email, tier, registration_date, coalesce(n, 0) AS total_orders,
               coalesce(cents, 0) AS spent_cents
        FROM r_customers LEFT JOIN r_totals USING (customer_id)""",
    "r_velocity": """
        SELECT product_id, cast(sum(quantity) AS bigint) AS units_sold,
               (SELECT max(order_date) - min(order_date) + 1 FROM r_orders) AS total_days
        FROM r_orders WHERE status <> 'placed' GROUP BY 1""",
    "r_stock": f"""
        SELECT i.*, i.stock_level < i.reorder_threshold AS is_below_reorder,
               CASE WHEN v.units_sold > 0 THEN {half_up('i.stock_level * v.total_days', 'v.units_sold', 10)} END AS days_left
        FROM r_inventory i LEFT JOIN r_velocity v USING (product_id)""",
    "r_sales": f"""
        SELECT order_date AS period_date, category, subcategory, count(*) AS total_orders,
               cast(sum(amount_cents) AS bigint) AS cents, count(DISTINCT customer_id) AS unique_customers,
               cast(sum(quantity) AS bigint) AS total_items_sold,
               count(*) FILTER (status = 'returned') AS returned_orders
        FROM r_orders LEFT JOIN r_products USING (product_id) WHERE status <> 'placed' GROUP BY 1, 2, 3""",
    "r_returns": f"""
        SELECT *, (20000 * returned_orders + total_orders) // (2 * total_orders) AS rate FROM (
            SELECT cast(date_trunc('month', order_date) AS date) AS period_date, product_id, product_name, category,
                   count(*) AS total_orders, count(*) FILTER (status = 'returned') AS returned_orders
            FROM r_orders JOIN r_products USING (product_id) GROUP BY 1, 2, 3, 4)""",
    "r_return_mart": """
        SELECT *, lag(rate) OVER (PARTITION BY product_id ORDER BY period_date) AS prev FROM r_returns""",
    "r_cohorts": f"""
        SELECT cohort_week, weeks AS weeks_since_acquisition, size AS customers_in_cohort, active AS active_customers,
               {half_up('active', 'size', 10000)} AS retention_rate
        FROM (
            SELECT cohort_week, (order_week - cohort_week) // 7 AS weeks, count(DISTINCT customer_id) AS active
            FROM (SELECT customer_id, cast(date_trunc('week', registration_date) AS date) AS cohort_week
                  FROM r_customers WHERE registration_date IS NOT NULL)
            JOIN (SELECT customer_id, cast(date_trunc('week', order_date) AS date) AS order_week FROM r_orders) USING (customer_id)
            WHERE order_week >= cohort_week GROUP BY 1, 2)
        JOIN (SELECT cast(date_trunc('week', registration_date) AS date) AS cohort_week, count(DISTINCT customer_id) AS size
              FROM r_customers WHERE registration_date IS NOT NULL GROUP BY 1) USING (cohort_week)""",
    "r_alerts": """
        SELECT product_id, product_name, category, subcategory, supplier_id, stock_level AS current_stock_level,
               s.reorder_threshold, days_left AS days_of_stock_remaining,
               CASE WHEN stock_level < s.reorder_threshold THEN 'red'
                    WHEN stock_level * 10 < s.reorder_threshold * 12 THEN 'yellow' ELSE 'green' END AS alert_level,
               date AS snapshot_date
        FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS rn FROM r_stock) s
        JOIN r_products USING (product_id) WHERE rn = 1""",
    "r_audit": f"""
        SELECT event_id AS record_id, event_id, field_name, masking_action, original_length, event_timestamp AS masked_at
        FROM (
            SELECT event_id, event_timestamp, 'customer_name' AS field_name, 'replace' AS masking_action,
                   length('Customer ' || user_id) AS original_length FROM r_events
            UNION ALL
            SELECT event_id, event_timestamp, 'customer_email', 'sha256_hash', length(' User.' || user_id || '@Example.com ') FROM r_events
            UNION ALL
            SELECT event_id, event_timestamp, 'customer_phone', 'replace', length('+1202') + greatest(7, length(user_id::varchar)) FROM r_events
            UNION ALL
            SELECT event_id, event_timestamp, 'shipping_address', {ACTION}, length(shipping_address)
            FROM r_events WHERE shipping_address IS NOT NULL)
        UNION ALL SELECT customer_id, NULL, 'customer_name', 'replace', length(c_name), registration_date::timestamp FROM r_customers
        UNION ALL SELECT customer_id, NULL, 'customer_email', 'sha256_hash', length(' User.@Example.com ') + key_length, registration_date::timestamp FROM r_customers
        UNION ALL SELECT customer_id, NULL, 'customer_phone', 'replace', length('+1202') + greatest(7, key_length), registration_date::timestamp FROM r_customers
        UNION ALL SELECT customer_id, NULL, 'shipping_address', {ACTION}, length(shipping_address), registration_date::timestamp FROM r_customers
        UNION ALL SELECT customer_id, NULL, 'shipping_address', {ACTION}, length(shipping_address), order_date::timestamp FROM r_orders""",
    "r_runs": """
        SELECT 'run-' || strftime(order_date, '%Y%m%d') AS run_id, 'silver' AS stage, order_date,
               order_date::timestamp + INTERVAL 2 HOUR AS start_time,
               order_date::timestamp + INTERVAL 2 HOUR + to_seconds(60 + n) AS end_time,
               n AS records_processed, bad AS records_failed, n AS pii_events_masked,
               CASE WHEN bad * 4 > n * 3 THEN 'failed' ELSE 'success' END AS status
        FROM (SELECT order_date, count(*) AS n, count(*) FILTER (amount_cents > 5000000) AS bad FROM r_orders GROUP BY 1)""",
    "r_month_checks": """
        SELECT month, 'checkpoint_silver_events' AS checkpoint_name, 'silver_events' AS suite_name, 20 AS rules,
               cast(bool_or(event_id IS NULL) AS bigint) + cast(bool_or(event_type IS NULL) AS bigint) + cast(bool_or(event_timestamp IS NULL) AS bigint)
               + cast(bool_or(order_id IS NULL) AS bigint) + cast(bool_or(customer_id IS NULL) AS bigint)
               + cast(coalesce(bool_or(order_amount NOT BETWEEN 0.01 AND 50000), false) AS bigint)
               + cast(coalesce(bool_or(quantity NOT BETWEEN 1 AND 1000), false) AS bigint)
               + cast(count(event_id) <> count(DISTINCT event_id) AS bigint) AS failed
        FROM (SELECT *, cast(date_trunc('month', event_timestamp) AS date) AS month FROM r_events) GROUP BY month
        UNION ALL
        SELECT month, 'checkpoint_silver_customers', 'silver_customers', 8,
               cast(bool_or(customer_id IS NULL) AS bigint) + cast(bool_or(tier IS NULL) AS bigint) + cast(bool_or(registration_date IS NULL) AS bigint)
               + cast(count(customer_id) <> count(DISTINCT customer_id) AS bigint)
        FROM (SELECT *, coalesce(cast(date_trunc('month', registration_date) AS date), DATE '1970-01-01') AS month FROM r_customers) GROUP BY month
        UNION ALL
        SELECT month, 'checkpoint_silver_orders' AS checkpoint_name, 'silver_orders' AS suite_name, 8 AS rules,
               cast(bool_or(order_id IS NULL) AS bigint) + cast(bool_or(customer_id IS NULL) AS bigint)
               + cast(bool_or(product_id IS NULL) AS bigint) + cast(bool_or(amount_cents IS NULL) AS bigint)
               + cast(count(order_id) <> count(DISTINCT order_id) AS bigint)
               + cast(coalesce(bool_or(amount_cents NOT BETWEEN 1 AND 5000000), false) AS bigint)
               + cast(coalesce(bool_or(quantity NOT BETWEEN 1 AND 1000), false) AS bigint) AS failed
        FROM (SELECT *, cast(date_trunc('month', order_date) AS date) AS month FROM r_orders) GROUP BY month
        UNION ALL
        SELECT date, 'checkpoint_silver_inventory', 'silver_inventory', 5,
               cast(bool_or(product_id IS NULL) AS bigint) + cast(bool_or(stock_level IS NULL) AS bigint)
               + cast(coalesce(bool_or(stock_level NOT BETWEEN 0 AND 1000000), false) AS bigint)
               + cast(coalesce(bool_or(units_sold NOT BETWEEN 0 AND 100000), false) AS bigint)
        FROM r_inventory GROUP BY date""",
    "r_validation": f"""
        SELECT 'run-' || strftime(month, '%Y%m') AS run_id, checkpoint_name, suite_name, failed = 0 AS success,
               rules AS evaluated_expectations, rules - failed AS successful_expectations, failed AS failed_expectations,
               month::timestamp AS run_ts
        FROM r_month_checks""",
    "r_panes": """
        SELECT time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS pane, event_type, count(*) AS events
        FROM r_bronze GROUP BY 1, 2""",
    "r_sliding": """
        SELECT pane - to_minutes(5 * k) AS window_start, event_type, cast(sum(events) AS bigint) AS events
        FROM r_panes, generate_series(0, 11) AS t(k) GROUP BY 1, 2""",
}


def build(final: str) -> str:
    """The final select with the blocks it needs, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(BLOCKS[name])

    visit(final)
    parts = [f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + final


def stamp(c: str) -> str:
    return f"strftime({c}, {STAMP})"


def day(c: str) -> str:
    return f"cast({c} AS varchar)"


ORDER_COLUMNS = """order_id, customer_id, product_id, quantity, price_cents / 100.0 AS unit_price,
    amount_cents / 100.0 AS order_amount, cast(order_date AS varchar) AS order_date, status"""
DATE_COLUMNS = """cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, cast(cast(d AS date) AS varchar) AS full_date,
    year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, week(d) AS week_of_year,
    day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend"""
RUN_COLUMNS = f"""run_id, stage, {stamp('start_time')} AS start_time, {stamp('end_time')} AS end_time,
    records_processed, records_failed, pii_events_masked, status"""
RATE = f"""{stamp('window_start')} AS window_start, {stamp('window_end')} AS window_end, event_type, events"""
DROP_COLUMNS = "table_name, rows_in, missing_event_id, repeated_copies, missing_key, rows_out"

FINALS: dict[str, str] = {}

# --- Bronze and ingest ----------------------------------------------------------------------------

FINALS["parse_events"] = """
    SELECT event_id, event_type, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_timestamp, order_id, customer_id,
           ' User.' || user_id || '@Example.com ' AS customer_email, quantity, order_amount, status
    FROM r_parsed WHERE reject_reason IS NULL"""
FINALS["quarantine_events"] = """
    SELECT reject_reason, count(*) AS messages FROM (
        SELECT reject_reason FROM r_parsed
        UNION ALL SELECT CASE WHEN props IS NULL THEN 'malformed' ELSE 'missing:event_id' END FROM events
        UNION ALL SELECT 'malformed' FROM documents)
    WHERE reject_reason IS NOT NULL GROUP BY 1"""
FINALS["ingest_metrics"] = """
    SELECT CASE WHEN reject_reason IS NULL THEN event_type ELSE 'unknown' END AS event_type,
           count(*) FILTER (reject_reason IS NULL) AS processed, count(*) FILTER (reject_reason IS NOT NULL) AS failed
    FROM r_parsed GROUP BY 1"""
FINALS["stream_bronze"] = f"""
    SELECT event_type, {day('event_timestamp::date')} AS date, count(*) AS rows, count(DISTINCT event_id) AS event_ids
    FROM r_parsed WHERE reject_reason IS NULL GROUP BY 1, 2"""
FINALS["event_date"] = f"""
    SELECT event_type, {day('event_timestamp::date')} AS date, count(*) AS rows FROM r_bronze GROUP BY 1, 2"""
FINALS["pin_event_date"] = f"""
    SELECT event_id, event_type, {stamp(f"{RUN_DATE} + event_timestamp::time")} AS event_timestamp FROM r_bronze"""
FINALS["stream_dedup_events"] = "SELECT event_id, event_type, customer_id FROM r_first"
FINALS["stream_event_rate_5m"] = f"""
    SELECT {RATE}, events / 300.0 AS per_second
    FROM (SELECT pane AS window_start, pane + INTERVAL 5 MINUTE AS window_end, event_type, events FROM r_panes)"""
FINALS["ingest_once"] = """
    SELECT DISTINCT strftime(date, '%Y%m') AS drop_id FROM r_inventory
    WHERE strftime(date, '%Y%m') NOT IN (SELECT strftime(order_date, '%Y%m') FROM r_orders)"""
FINALS["bronze_day_events"] = """
    SELECT event_id, event_type, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_timestamp, order_id, customer_id, quantity, order_amount
    FROM r_bronze WHERE r_bronze.event_timestamp::date = DATE '2024-01-15'"""
FINALS["bronze_csv_drop"] = f"SELECT {ORDER_COLUMNS} FROM r_orders"
FINALS["load_drops"] = """
    SELECT 'orders' AS entity, strftime(order_date, '%Y') AS drop_id, 'first' AS run_id, count(*) AS rows FROM r_orders GROUP BY 2"""
FINALS["retention_log"] = f"""
    SELECT event_type, {day('event_timestamp::date')} AS date, CASE WHEN event_timestamp::date < {RUN_DATE} - 7 THEN 'removed' ELSE 'kept' END AS state,
           CASE WHEN event_timestamp::date < {RUN_DATE} - 7 THEN 0 ELSE count(*) END AS rows
    FROM r_bronze GROUP BY event_type, event_timestamp::date"""
FINALS["expire_partitions"] = f"""
    SELECT {day('event_timestamp::date')} AS date, count(*) AS rows FROM r_bronze
    WHERE event_timestamp::date < {RUN_DATE} - 7 GROUP BY 1"""
FINALS["drop_expired"] = f"""
    SELECT {day('event_timestamp::date')} AS date, event_type, count(*) AS rows FROM r_bronze
    WHERE event_timestamp::date >= {RUN_DATE} - 7 GROUP BY 1, 2"""

# --- Silver ---------------------------------------------------------------------------------------

FINALS["silver_events"] = f"""
    SELECT event_id, event_type, {stamp('event_timestamp')} AS event_timestamp, order_id, customer_id,
           'MASKED_NAME' AS customer_name, {hashed('user_id')} AS hashed_email, 'MASKED_PHONE' AS customer_phone,
           product_id, cast(NULL AS varchar) AS product_name, cast(NULL AS varchar) AS category, quantity,
           cast(NULL AS double) AS unit_price, order_amount, cast(NULL AS varchar) AS shipping_address,
           card_last4, card_type, status, cast(NULL AS bigint) AS stock_level, cast(NULL AS bigint) AS reorder_threshold,
           '2024-01-30' AS ingestion_date
    FROM r_events"""
FINALS["silver_customers"] = f"""
    SELECT customer_id, 'MASKED_NAME' AS customer_name, hashed_email, 'MASKED_PHONE' AS customer_phone,
           cast(NULL AS varchar) AS shipping_address, {day('registration_date')} AS registration_date, tier,
           cast(0 AS bigint) AS total_orders, cast(0 AS double) AS total_spent
    FROM r_customers"""
FINALS["silver_products"] = """
    SELECT product_id, product_name, category, subcategory, price_cents / 100.0 AS unit_price, cost_cents / 100.0 AS cost_price,
           supplier_id, reorder_threshold, current_stock FROM r_products"""
FINALS["silver_orders"] = f"""
    SELECT {ORDER_COLUMNS}, cast(NULL AS varchar) AS shipping_address, card_last4, card_type FROM r_orders"""
FINALS["silver_inventory"] = f"""
    SELECT inventory_id, product_id, {day('date')} AS date, stock_level, reorder_threshold, units_sold, units_received
    FROM r_inventory"""
FINALS["silver_drop_counts"] = f"""
    SELECT {DROP_COLUMNS} FROM (
        SELECT 'events' AS table_name, (SELECT count(*) FROM r_bronze) AS rows_in,
               (SELECT count(*) FROM r_bronze WHERE event_id IS NULL) AS missing_event_id,
               (SELECT count(*) FROM r_bronze) - (SELECT count(*) FROM r_first) AS repeated_copies,
               (SELECT count(*) FROM r_first) - (SELECT count(*) FROM r_events) AS missing_key,
               (SELECT count(*) FROM r_events) AS rows_out
        UNION ALL SELECT 'products', count(*), 0, 0, count(*) - count(product_id), count(product_id) FROM r_products
        UNION ALL SELECT 'inventory', count(*), 0, 0, count(*) - count(product_id), count(product_id) FROM r_inventory)"""
FINALS["silver_run_summary"] = """
    SELECT table_name, rows_in, rows_out, rows_in - rows_out AS rows_dropped, pii_masked FROM (
        SELECT 'events' AS table_name, (SELECT count(*) FROM r_bronze) AS rows_in, (SELECT count(*) FROM r_events) AS rows_out,
               (SELECT count(*) FROM r_audit WHERE event_id IS NOT NULL) AS pii_masked
        UNION ALL SELECT 'customers', count(*), count(*), 3 * count(*) + count(shipping_address) FROM r_customers
        UNION ALL SELECT 'orders', count(*), count(*), count(shipping_address) FROM r_orders
        UNION ALL SELECT 'products', count(*), count(product_id), 0 FROM r_products
        UNION ALL SELECT 'inventory', count(*), count(product_id), 0 FROM r_inventory)"""
_CASTS = {
    "events": ("event_timestamp", "quantity", "unit_price", "order_amount"),
    "customers": ("registration_date", "total_spent", "total_orders", "tier"),
    "products": ("unit_price", "cost_price", "reorder_threshold", "current_stock"),
    "orders": ("order_date", "order_amount", "unit_price", "quantity"),
    "inventory": ("date", "stock_level", "reorder_threshold", "units_sold", "units_received"),
}
FINALS["cast_failures"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, " + ("count(*) FILTER (tier IS NULL) AS failures FROM r_customers" if c == "tier" else "0 AS failures")
    for t, columns in _CASTS.items() for c in columns)
FINALS["dedup_order_lines"] = """
    SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM r_lines"""
FINALS["dedup_event_copies"] = f"""
    SELECT event_id, event_type, {stamp('event_timestamp')} AS event_timestamp, customer_id FROM r_first"""
FINALS["dedup_latest_snapshot"] = f"""
    SELECT product_id, {day('date')} AS date, stock_level, units_sold
    FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS rn FROM r_inventory) WHERE rn = 1"""

# --- privacy --------------------------------------------------------------------------------------

FINALS["pii_mask_customers"] = """
    SELECT customer_id, 'MASKED_NAME' AS customer_name, hashed_email, 'MASKED_PHONE' AS customer_phone,
           cast(NULL AS varchar) AS shipping_address FROM r_customers"""
FINALS["pii_mask_orders"] = """
    SELECT order_id, cast(NULL AS varchar) AS shipping_address, card_last4, card_type FROM r_orders"""
FINALS["pii_audit_rows"] = f"""
    SELECT record_id, event_id, field_name, masking_action, original_length, '{RUN_ID}' AS pipeline_run_id FROM r_audit"""
FINALS["pii_masked_count"] = "SELECT field_name, count(*) AS masked_values FROM r_audit GROUP BY 1"
FINALS["pii_log_written"] = f"SELECT '{RUN_ID}' AS pipeline_run_id, field_name, count(*) AS rows FROM r_audit GROUP BY 2"
FINALS["pii_entities"] = f"SELECT {ACTION} AS masking_action, count(*) AS addresses FROM r_customers GROUP BY 1"
_SCAN = ", ".join(f"cast(len(regexp_extract_all(text, '{p}')) AS bigint) AS {kind}_count" for kind, p in TEXT_PATTERNS.items())
FINALS["pii_scan_documents"] = f"SELECT doc_id, {_SCAN} FROM documents"
_REDACTED = "text"
BACK = "\\1"
for _kind, _pattern in TEXT_PATTERNS.items():
    _REDACTED = f"regexp_replace({_REDACTED}, '{_pattern}', '{BACK if _kind == 'email' else ''}{TEXT_MASKS[_kind]}', 'g')"
FINALS["pii_redact_documents"] = f"SELECT doc_id, {_REDACTED} AS text FROM documents"

# --- staging --------------------------------------------------------------------------------------

FINALS["stg_events"] = f"""
    SELECT event_id, event_type, {stamp('event_timestamp')} AS event_timestamp, order_id, customer_id, product_id, quantity,
           order_amount, status FROM r_events"""
FINALS["stg_customers"] = f"""
    SELECT customer_id, hashed_email, tier, {day('registration_date')} AS registration_date,
           'MASKED_NAME' AS masked_customer_name, 'MASKED_PHONE' AS masked_customer_phone FROM r_customers"""
FINALS["stg_products"] = FINALS["silver_products"]
FINALS["stg_orders"] = f"SELECT {ORDER_COLUMNS}, card_last4, card_type FROM r_orders"
FINALS["stg_inventory"] = f"""
    SELECT product_id, {day('date')} AS inventory_date, stock_level, reorder_threshold, units_sold, units_received FROM r_inventory"""

FINALS["staging_loaded"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) AS stamped FROM r_{t}" for t in ("events", "customers", "products", "orders", "inventory"))

# --- gold -----------------------------------------------------------------------------------------

FINALS["surrogate_keys"] = "SELECT customer_key, customer_id FROM r_customer_keys"
FINALS["dim_customers"] = f"""
    SELECT customer_key, customer_id, hashed_email, tier, {day('registration_date')} AS registration_date, total_orders,
           spent_cents / 100.0 AS total_spent
    FROM r_customer_dim JOIN r_customer_keys USING (customer_id)"""
FINALS["dim_products"] = f"""
    SELECT product_key, product_id, product_name, category, subcategory, price_cents / 100.0 AS unit_price,
           cost_cents / 100.0 AS cost_price,
           CASE WHEN price_cents <> 0 THEN {half_up('(price_cents - cost_cents) * 100', 'price_cents', 100)} END AS margin_pct,
           supplier_id, reorder_threshold, current_stock
    FROM r_products JOIN r_product_keys USING (product_id)"""
FINALS["dim_date"] = f"""
    SELECT {DATE_COLUMNS}
    FROM (SELECT unnest(generate_series(min(order_date)::timestamp, max(order_date)::timestamp, INTERVAL 1 DAY)) AS d FROM r_orders)"""
FINALS["date_spine"] = f"""
    SELECT {DATE_COLUMNS}
    FROM (SELECT unnest(generate_series(date_trunc('day', min(event_timestamp))::timestamp, date_trunc('day', max(event_timestamp))::timestamp, INTERVAL 1 DAY)) AS d
          FROM r_events)"""
FINALS["dim_geography"] = """
    SELECT cast(1 AS bigint) AS geography_key, 'Unknown — address masked for privacy' AS geography_name, count(*) AS orders FROM r_orders"""
FINALS["fact_orders"] = """
    SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id, customer_key, product_key, date_key,
           cast(1 AS bigint) AS geography_key, quantity, o.price_cents / 100.0 AS unit_price, amount_cents / 100.0 AS order_amount,
           status, card_type, status = 'returned' AS is_returned
    FROM r_orders o LEFT JOIN r_customer_keys USING (customer_id) LEFT JOIN r_product_keys USING (product_id)
         LEFT JOIN r_dates ON order_date = full_date"""
FINALS["fact_events"] = f"""
    SELECT row_number() OVER (ORDER BY event_timestamp, event_id) AS event_key, event_id, event_type,
           {stamp('event_timestamp')} AS event_timestamp, customer_key, product_key,
           cast(strftime(event_timestamp, '%Y%m%d') AS bigint) AS date_key, order_id, order_amount, quantity, status
    FROM r_events LEFT JOIN r_customer_keys USING (customer_id) LEFT JOIN r_product_keys USING (product_id)"""
FINALS["fact_inventory_snapshots"] = """
    SELECT row_number() OVER (ORDER BY product_id, date_key) AS snapshot_key, product_key, date_key, stock_level, reorder_threshold,
           units_sold, units_received, is_below_reorder, days_left AS days_of_stock_remaining
    FROM r_stock LEFT JOIN r_product_keys USING (product_id) LEFT JOIN r_dates ON date = full_date"""
FINALS["inventory_velocity"] = """
    SELECT product_id, units_sold, total_days, units_sold / total_days AS avg_daily_units_sold FROM r_velocity"""


def _snapshot(at: str) -> str:
    """All customers with their totals up to ``at``."""
    return f"""
        SELECT customer_id, hashed_email, tier, registration_date, coalesce(n, 0) AS total_orders, coalesce(cents, 0) AS spent
        FROM r_customers LEFT JOIN (
            SELECT customer_id, count(*) AS n, cast(sum(amount_cents) AS bigint) AS cents FROM r_orders
            WHERE status <> 'placed' AND order_date < DATE '{at}' GROUP BY 1) USING (customer_id)"""


_FIRST, _SECOND = "1998-01-01", "2000-01-01"
FINALS["scd2_customers"] = f"""
    , a AS ({_snapshot(_FIRST)}), b AS ({_snapshot(_SECOND)}),
    pairs AS (
        SELECT a.customer_id AS a_id, b.customer_id AS b_id,
               b.customer_id IS NULL OR a.tier IS DISTINCT FROM b.tier OR a.total_orders IS DISTINCT FROM b.total_orders
               OR a.spent IS DISTINCT FROM b.spent AS ends
        FROM a FULL JOIN b USING (customer_id)),
    versions AS (
        SELECT a.*, '{_FIRST}' AS valid_from, CASE WHEN ends THEN '{_SECOND}' END AS valid_to
        FROM a JOIN pairs ON a_id = customer_id
        UNION ALL
        SELECT b.*, '{_SECOND}', NULL FROM b JOIN pairs ON b_id = customer_id WHERE a_id IS NULL OR ends)
    SELECT customer_id, hashed_email, tier, cast(registration_date AS varchar) AS registration_date, total_orders, spent / 100.0 AS total_spent,
           md5(customer_id || '|' || valid_from || ' 00:00:00') AS scd_id,
           coalesce(valid_to, valid_from) || ' 00:00:00.000000' AS updated_at,
           valid_from || ' 00:00:00.000000' AS valid_from, valid_to || ' 00:00:00.000000' AS valid_to, valid_to IS NULL AS is_current
    FROM versions"""
FINALS["upsert_by_key"] = f"""
    SELECT {RUN_COLUMNS}, CASE WHEN records_failed < records_processed THEN records_failed * 2 <= records_processed END AS quality_passed
    FROM r_runs"""
FINALS["backfill_customer_stats"] = """
    SELECT customer_id, tier, coalesce(n, 0) AS total_orders, coalesce(cents, 0) / 100.0 AS total_spent
    FROM r_customers LEFT JOIN (
        SELECT customer_id, count(*) AS n, cast(sum(amount_cents) AS bigint) AS cents FROM r_orders GROUP BY 1) USING (customer_id)"""
FINALS["backfill_current_stock"] = """
    SELECT product_id, coalesce(stock_level, current_stock) AS current_stock
    FROM r_products LEFT JOIN (
        SELECT product_id, stock_level, row_number() OVER (PARTITION BY product_id ORDER BY date DESC) AS rn FROM r_inventory) s
    USING (product_id) WHERE coalesce(rn, 1) = 1"""

# --- marts ----------------------------------------------------------------------------------------

FINALS["mart_sales_summary"] = f"""
    SELECT {day('period_date')} AS period_date, year(period_date) AS year, month(period_date) AS month,
           week(period_date) AS week_of_year, category, subcategory, total_orders, cents / 100.0 AS total_gmv,
           ((2 * cents + total_orders) // (2 * total_orders)) / 100.0 AS avg_order_value, unique_customers, total_items_sold,
           returned_orders, {half_up('returned_orders', 'total_orders', 10000)} AS return_rate
    FROM r_sales"""
FINALS["mart_return_rates"] = f"""
    SELECT year(period_date) AS year, month(period_date) AS month, {day('period_date')} AS period_date, product_id, product_name,
           category, total_orders, returned_orders, rate / 10000.0 AS return_rate, prev / 10000.0 AS prev_month_return_rate,
           (rate - prev) / 10000.0 AS return_rate_change
    FROM r_return_mart"""
FINALS["mart_customer_cohorts"] = f"""
    SELECT {day('cohort_week')} AS cohort_week, weeks_since_acquisition, customers_in_cohort, active_customers, retention_rate
    FROM r_cohorts"""
FINALS["mart_event_cohorts"] = f"""
    , m AS (SELECT customer_id, date_trunc('week', max(event_timestamp))::date AS cohort_week
            FROM r_bronze WHERE event_type = 'customer_registered' GROUP BY 1),
    w AS (SELECT DISTINCT customer_id, date_trunc('week', event_timestamp)::date AS order_week
          FROM r_events WHERE event_type = 'order_placed'),
    act AS (SELECT cohort_week, (order_week - cohort_week) // 7 AS weeks, count(*) AS active
            FROM w JOIN m USING (customer_id) WHERE order_week >= cohort_week GROUP BY 1, 2),
    sz AS (SELECT cohort_week, count(*) AS size FROM m GROUP BY 1)
    SELECT {day('cohort_week')} AS cohort_week, weeks AS weeks_since_acquisition, size AS customers_in_cohort,
           active AS active_customers, {half_up('active', 'size', 10000)} AS retention_rate
    FROM act JOIN sz USING (cohort_week)"""
ALERT_COLUMNS = f"""product_id, product_name, category, subcategory, supplier_id, current_stock_level, reorder_threshold,
    days_of_stock_remaining, alert_level, {day('snapshot_date')} AS snapshot_date"""
FINALS["mart_inventory_alerts"] = f"SELECT {ALERT_COLUMNS} FROM r_alerts"

# --- serving --------------------------------------------------------------------------------------

FINALS["daily_sales_trend"] = f"""
    SELECT {day('period_date')} AS period_date, sum(cents)::bigint / 100.0 AS total_gmv, sum(total_orders)::bigint AS total_orders,
           (sum(cents)::bigint / 100.0) / sum(total_orders)::bigint AS avg_order_value
    FROM r_sales WHERE period_date >= (SELECT max(period_date) FROM r_sales) - 30 GROUP BY r_sales.period_date"""
FINALS["range_presets"] = """
    SELECT preset, sum(total_orders)::bigint AS orders, sum(cents)::bigint / 100.0 AS gmv
    FROM r_sales, (VALUES ('7d', 7), ('30d', 30), ('90d', 90), ('6mo', 180)) AS p(preset, days)
    WHERE period_date >= (SELECT max(period_date) FROM r_sales) - days GROUP BY 1"""
FINALS["sales_by_category"] = """
    SELECT coalesce(category, 'Unknown') AS category, sum(cents)::bigint / 100.0 AS total_gmv, sum(total_orders)::bigint AS total_orders,
           sum(returned_orders)::double / sum(total_orders)::double AS return_rate
    FROM r_sales WHERE period_date >= (SELECT max(period_date) FROM r_sales) - 90
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
FINALS["home_kpis"] = """
    SELECT sum(cents)::bigint / 100.0 AS today_gmv, sum(total_orders)::bigint AS today_orders,
           (sum(cents)::bigint / 100.0) / sum(total_orders)::bigint AS today_aov,
           (SELECT count(*) FROM r_alerts WHERE alert_level IN ('red', 'yellow')
            AND snapshot_date = (SELECT max(snapshot_date) FROM r_alerts)) AS active_sku_alerts
    FROM r_sales WHERE period_date = (SELECT max(period_date) FROM r_sales)"""
FINALS["cohort_table"] = f"""
    SELECT {day('cohort_week')} AS cohort_week, weeks_since_acquisition, customers_in_cohort, active_customers, retention_rate
    FROM r_cohorts WHERE weeks_since_acquisition <= 12
    ORDER BY r_cohorts.cohort_week DESC, weeks_since_acquisition LIMIT 500"""
_WEEKS = ", ".join(f"max(retention_rate) FILTER (weeks_since_acquisition = {w}) AS week_{w}" for w in range(13))
FINALS["cohort_heatmap"] = f"""
    SELECT {day('cohort_week')} AS cohort_week, {_WEEKS}
    FROM r_cohorts WHERE weeks_since_acquisition <= 12 GROUP BY r_cohorts.cohort_week
    ORDER BY r_cohorts.cohort_week DESC LIMIT 12"""
FINALS["cohort_bands"] = """
    SELECT CASE WHEN retention_rate >= 0.4 THEN 'strong' WHEN retention_rate >= 0.2 THEN 'fair'
                WHEN retention_rate >= 0.1 THEN 'weak' ELSE 'poor' END AS band, count(*) AS cells
    FROM r_cohorts WHERE weeks_since_acquisition <= 12 GROUP BY 1"""
FINALS["customer_tier_summary"] = """
    SELECT count(*) AS total_customers, (sum(spent_cents)::bigint / 100.0) / count(*) AS avg_total_spent,
           count(*) FILTER (tier = 'bronze') AS bronze_count, count(*) FILTER (tier = 'silver') AS silver_count,
           count(*) FILTER (tier = 'gold') AS gold_count
    FROM r_customer_dim"""
FINALS["inventory_alerts_filtered"] = f"""
    SELECT {ALERT_COLUMNS} FROM r_alerts
    WHERE alert_level = 'red' AND category = 'PROMO' AND product_name ILIKE '%RING%'"""
FINALS["inventory_alerts_sorted"] = f"SELECT {ALERT_COLUMNS} FROM r_alerts WHERE product_name ILIKE '%bolt%'"
FINALS["inventory_stats"] = """
    SELECT count(*) AS total_skus, count(*) FILTER (alert_level = 'red') AS red_alerts,
           count(*) FILTER (alert_level = 'yellow') AS yellow_alerts, count(*) FILTER (alert_level = 'green') AS green_skus
    FROM r_alerts"""
FINALS["return_trends"] = f"""
    SELECT {day('period_date')} AS period_date, year(r_returns.period_date) AS year, month(r_returns.period_date) AS month,
           sum(total_orders)::bigint AS total_orders, sum(returned_orders)::bigint AS returned_orders,
           sum(returned_orders)::double / sum(total_orders)::double AS return_rate
    FROM r_returns WHERE period_date >= (SELECT max(period_date) FROM r_returns) - INTERVAL 6 MONTH
    GROUP BY r_returns.period_date"""
FINALS["returns_by_category"] = """
    SELECT coalesce(category, 'Unknown') AS category, sum(total_orders)::bigint AS total_orders,
           sum(returned_orders)::bigint AS returned_orders, sum(returned_orders)::double / sum(total_orders)::double AS return_rate
    FROM r_returns WHERE period_date >= (SELECT max(period_date) FROM r_returns) - 90 GROUP BY 1"""
FINALS["top_returned_products"] = """
    SELECT product_id, product_name, category, rate / 10000.0 AS return_rate, returned_orders, (rate - prev) / 10000.0 AS return_rate_change
    FROM r_return_mart WHERE period_date = (SELECT max(period_date) FROM r_returns)
    ORDER BY rate DESC, product_id LIMIT 10"""
FINALS["latest_return_kpi"] = f"""
    SELECT {day('period_date')} AS period_date, sum(returned_orders)::bigint AS returned_orders,
           sum(returned_orders)::double / sum(total_orders)::double AS return_rate
    FROM r_returns WHERE period_date = (SELECT max(period_date) FROM r_returns) GROUP BY r_returns.period_date"""
FINALS["paged"] = "SELECT product_id, product_name FROM r_products ORDER BY product_id LIMIT 1000 OFFSET 1000"
FINALS["paged_seek"] = FINALS["paged"]

# --- data quality ---------------------------------------------------------------------------------

# Which expression of the building blocks stands for a Silver column in a rule.
_SOURCE = {"events": "r_events", "customers": "r_customers", "orders": "r_orders", "inventory": "r_inventory", "products": "r_products"}
_COLUMN = {
    ("orders", "order_amount"): "amount_cents / 100.0",
    ("customers", "total_spent"): "0",
    ("events", "hashed_email"): hashed("user_id"),
    ("events", "ingestion_date"): RUN_DATE,
}


# Kind, column, and for some kinds the values, bounds or pattern of every rule, as (kind, column, ...).
_EVENT_TYPES = ("customer_registered", "item_added_to_cart", "order_placed", "payment_processed", "order_shipped", "order_delivered", "order_returned", "inventory_updated")
_TIERS = ("bronze", "silver", "gold")
_RULES = {
    "events": [
        *[("column_to_exist", c) for c in ("event_id", "event_type", "event_timestamp", "order_id", "customer_id", "product_id", "order_amount", "quantity", "ingestion_date")],
        *[("values_to_not_be_null", c) for c in ("event_id", "event_type", "event_timestamp", "order_id", "customer_id")],
        ("values_to_be_in_set", "event_type", _EVENT_TYPES),
        ("values_to_be_between", "order_amount", 0.01, 50000),
        ("values_to_be_between", "quantity", 1, 1000),
        ("values_to_be_unique", "event_id"),
        ("values_to_match_regex", "hashed_email", "^[a-f0-9]{64}$"),
        ("table_row_count_to_be_between", "", 1),
    ],
    "customers": [
        *[("values_to_not_be_null", c) for c in ("customer_id", "tier", "registration_date")],
        ("values_to_be_unique", "customer_id"),
        ("values_to_be_in_set", "tier", _TIERS),
        ("values_to_be_between", "total_spent", 0, 1000000),
        ("values_to_not_be_null", "hashed_email"),
        ("values_to_match_regex", "hashed_email", "^[a-f0-9]{64}$"),
    ],
    "orders": [
        *[("values_to_not_be_null", c) for c in ("order_id", "customer_id", "product_id", "order_date", "order_amount")],
        ("values_to_be_unique", "order_id"),
        ("values_to_be_between", "order_amount", 0.01, 50000),
        ("values_to_be_between", "quantity", 1, 1000),
    ],
    "inventory": [
        *[("values_to_not_be_null", c) for c in ("product_id", "date", "stock_level")],
        ("values_to_be_between", "stock_level", 0, 1000000),
        ("values_to_be_between", "units_sold", 0, 100000),
    ],
    "products": [
        ("values_to_not_be_null", "product_id"), ("values_to_be_unique", "product_id"), ("values_to_not_be_null", "product_name"), ("values_to_not_be_null", "category"),
    ],
}


def _rule_sql(table: str, no: int, kind: str, column: str, *values) -> str:
    c = _COLUMN.get((table, column), column)
    bad, parameters = "0", ""
    if kind == "values_to_not_be_null":
        bad = f"count(*) FILTER ({c} IS NULL)"
    elif kind == "values_to_be_in_set":
        bad = f"count(*) FILTER ({c} NOT IN ({', '.join(repr(v) for v in values[0])}))"
        parameters = "in " + ", ".join(values[0])
    elif kind == "values_to_be_between":
        bad, parameters = f"count(*) FILTER ({c} NOT BETWEEN {values[0]} AND {values[1]})", f"{values[0]}..{values[1]}"
    elif kind == "values_to_match_regex":
        bad, parameters = f"count(*) FILTER (NOT regexp_matches({c}, '{values[0]}'))", values[0]
    elif kind == "values_to_be_unique":
        bad = f"count(*) FILTER ({c} IN (SELECT {c} FROM {_SOURCE[table]} GROUP BY 1 HAVING count(*) > 1))"
    elif kind == "table_row_count_to_be_between":
        parameters = f"{values[0]}.."
    ok = f"count(*) >= {values[0]}" if kind == "table_row_count_to_be_between" else f"{bad} = 0"
    return (
        f"SELECT 'silver_{table}' AS suite_name, 'checkpoint_silver_{table}' AS checkpoint_name, {no} AS rule_no, '{kind}' AS expectation, "
        f"'{column}' AS column_name, '{parameters}' AS parameters, count(*) AS table_rows, "
        f"{bad} AS unexpected_count, {ok} AS success FROM {_SOURCE[table]}"
    )


def suite_sql(table: str) -> str:
    return " UNION ALL ".join(_rule_sql(table, no, *rule) for no, rule in enumerate(_RULES[table], start=1))


for _table in _RULES:
    FINALS[f"expect_{_table}"] = suite_sql(_table)
_FRESH_AGE = f"epoch_us(TIMESTAMP '2024-01-30 23:59:59') - epoch_us(max(event_timestamp))"
FINALS["checkpoint_summary"] = f"""
    SELECT checkpoint_name, suite_name, count(*) AS evaluated_expectations, count(*) FILTER (success) AS successful_expectations,
           count(*) FILTER (NOT success) AS unsuccessful_expectations, bool_and(success) AS success
    FROM ({' UNION ALL '.join(suite_sql(t) for t in ('events', 'customers', 'orders', 'inventory'))}) GROUP BY 1, 2
    UNION ALL
    SELECT 'checkpoint_silver_freshness', 'silver_freshness', 1, cast({_FRESH_AGE} <= 7200000000 AS bigint),
           1 - cast({_FRESH_AGE} <= 7200000000 AS bigint), {_FRESH_AGE} <= 7200000000 FROM r_events"""
FINALS["validation_written"] = f"""
    SELECT '{RUN_ID}' AS pipeline_run_id, checkpoint_name, suite_name, evaluated_expectations, successful_expectations, unsuccessful_expectations,
           NOT success AS closes_gate, true AS detailed
    FROM ({FINALS["checkpoint_summary"]})"""
FINALS["freshness_check"] = f"""
    SELECT 'checkpoint_silver_freshness' AS checkpoint_name, 'silver_freshness' AS suite_name,
           {_FRESH_AGE} <= 7200000000 AS success, {stamp('max(event_timestamp)')} AS most_recent,
           ({_FRESH_AGE}) // 1000000 AS age_seconds,
           CASE WHEN {_FRESH_AGE} <= 7200000000 THEN 'fresh' ELSE 'older than 2 h' END AS reason
    FROM r_events"""
FINALS["source_freshness"] = f"""
    SELECT table_name, {stamp('newest')} AS max_loaded_at, age AS age_seconds,
           CASE WHEN age > 21600 THEN 'error' WHEN age > 10800 THEN 'warn' ELSE 'pass' END AS state
    FROM (SELECT *, epoch_us(TIMESTAMP '2024-01-30 23:59:59') // 1000000 - epoch_us(newest) // 1000000 AS age FROM (
        SELECT 'events' AS table_name, max(event_timestamp) AS newest FROM r_events
        UNION ALL SELECT 'orders', max(order_date)::timestamp FROM r_orders
        UNION ALL SELECT 'customers', max(registration_date)::timestamp FROM r_customers
        UNION ALL SELECT 'inventory', max(date)::timestamp FROM r_inventory
        UNION ALL SELECT 'products', max(date)::timestamp FROM r_inventory WHERE product_id IN (SELECT product_id FROM r_products)))"""
FINALS["test_not_null"] = "SELECT customer_id, hashed_email FROM r_customers WHERE tier IS NULL"
FINALS["test_unique"] = """
    SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
FINALS["test_accepted_values"] = """
    SELECT 'unrated' AS value_field, count(*) AS n_records FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0"""
FINALS["test_relationships"] = """
    SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


# Of every table: where its rows come from, columns that must be set, keys, and allowed values.
_TESTED = {
    "stg_events": ("r_events", ("event_id", "event_type", "customer_id"), ("event_id",), {"event_type": _EVENT_TYPES}),
    "stg_customers": ("r_customers", ("customer_id", "tier"), ("customer_id",), {"tier": _TIERS}),
    "stg_products": ("r_products", ("product_id", "product_name", "category"), ("product_id",), {}),
    "stg_orders": ("(SELECT *, amount_cents AS order_amount FROM r_orders)", ("order_id", "customer_id", "product_id", "order_amount"), ("order_id",),
                   {"status": ("placed", "paid", "shipped", "delivered", "returned")}),
    "stg_inventory": ("(SELECT *, date AS inventory_date FROM r_inventory)", ("product_id", "inventory_date", "stock_level"), (), {}),
    "dim_date": ("(SELECT *, isodow(full_date) AS day_of_week, quarter(full_date) AS quarter FROM r_dates)", ("date_key", "full_date"), ("date_key",),
                 {"day_of_week": (1, 2, 3, 4, 5, 6, 7), "quarter": (1, 2, 3, 4)}),
    "dim_customers": ("(FINAL dim_customers)", ("customer_key", "customer_id"), ("customer_key", "customer_id"), {"tier": _TIERS}),
    "dim_products": ("(FINAL dim_products)", ("product_key", "product_id"), ("product_key", "product_id"), {}),
    "fact_orders": ("(FINAL fact_orders)", ("order_key", "order_id", "customer_key", "product_key", "date_key"), ("order_key",), {}),
    "fact_events": ("(FINAL fact_events)", ("event_key", "event_id"), ("event_key", "event_id"), {}),
    "fact_inventory_snapshots": ("(FINAL fact_inventory_snapshots)", ("snapshot_key", "product_key", "date_key"), ("snapshot_key",), {}),
    "mart_sales_summary": ("(FINAL mart_sales_summary)", ("period_date", "category"), (), {}),
    "mart_return_rates": ("(FINAL mart_return_rates)", ("product_id", "period_date"), (), {}),
    "mart_customer_cohorts": ("(FINAL mart_customer_cohorts)", ("cohort_week", "weeks_since_acquisition"), (), {}),
    "mart_inventory_alerts": ("r_alerts", ("product_id",), ("product_id",), {"alert_level": ("red", "yellow", "green")}),
}
_REFERENCES = (
    ("fact_orders", "customer_key", "dim_customers", "customer_key"),
    ("fact_orders", "product_key", "dim_products", "product_key"),
    ("fact_orders", "date_key", "dim_date", "date_key"),
    ("fact_inventory_snapshots", "product_key", "dim_products", "product_key"),
)


def _table_tests() -> str:
    rows = {t: re.sub(r"FINAL (\w+)", lambda m: FINALS[m[1]], v[0]) for t, v in _TESTED.items()}
    parts = []

    def add(table: str, test: str, column: str, failures: str) -> None:
        parts.append(f"SELECT '{table}' AS table_name, '{test}' AS test_name, '{column}' AS column_name, ({failures}) AS failures")

    for table, (_, required, keys, domains) in _TESTED.items():
        for c in required:
            add(table, "not_null", c, f"SELECT count(*) FROM {rows[table]} WHERE {c} IS NULL")
        for c, allowed in domains.items():
            add(table, "accepted_values", c, f"SELECT count(*) FROM {rows[table]} WHERE {c} NOT IN ({', '.join(repr(v) for v in allowed)})")
        for c in keys:
            add(table, "unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {rows[table]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    for child, c, parent, key in _REFERENCES:
        add(child, "relationships", c, f"SELECT count(*) FROM {rows[child]} AS child WHERE child.{c} IS NOT NULL AND child.{c} NOT IN (SELECT {key} FROM {rows[parent]})")
    return " UNION ALL ".join(parts)


FINALS["table_tests"] = _table_tests()


def _constraints() -> str:
    # of every table: its rows, required columns, keys, checks
    tables = {
        "events": ("r_events", ("event_id", "event_type", "event_timestamp"), (("event_id",),), {}),
        "customers": ("r_customers", ("customer_id",), (("customer_id",),), {}),
        "products": ("(SELECT *, product_id AS sku FROM r_products)", ("product_id", "sku"), (("product_id",), ("sku",)), {}),
        "orders": (
            "(SELECT *, order_id AS order_line_id, amount_cents / 100.0 AS order_amount, status AS order_status FROM r_orders)",
            ("order_line_id", "order_id", "customer_id", "product_id", "quantity", "order_amount", "order_date", "order_status"), (("order_line_id",),),
            {"quantity_positive": "quantity > 0", "order_amount_in_range": "order_amount BETWEEN 0.01 AND 50000"},
        ),
        "inventory": (
            "(SELECT *, date AS snapshot_date, stock_level AS quantity_on_hand, 'UNKNOWN' AS warehouse_region FROM r_inventory)",
            ("snapshot_date", "product_id", "quantity_on_hand", "warehouse_region"), (("snapshot_date", "product_id", "warehouse_region"),), {},
        ),
        "run_log": ("r_runs", (), (), {"status_known": "status IN ('running', 'success', 'failed')"}),
    }
    parts = []
    for table, (rows, required, keys, checks) in tables.items():
        for c in required:
            parts.append((table, f"not_null:{c}", f"SELECT count(*) FROM {rows} WHERE {c} IS NULL"))
        for name, test in checks.items():
            parts.append((table, f"check:{name}", f"SELECT count(*) FROM {rows} WHERE NOT ({test})"))
        for key in keys:
            cols = ", ".join(key)
            repeated = f"SELECT count(*) FROM (SELECT {cols} FROM {rows} GROUP BY {cols} HAVING count(*) > 1)"
            parts.append((table, f"unique:{','.join(key)}", repeated))
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS constraint_name, ({sql}) AS violations" for t, n, sql in parts
    )


FINALS["staging_constraints"] = _constraints()
FINALS["constraint_loads"] = """
    , t AS (
        SELECT 'events' AS table_name, 'unique:event_id' AS key_rule, false AS bad_quantity, false AS bad_amount,
               cast(regexp_extract(event_id, '[0-9]+$') AS bigint) % 2 = 0 AS taken FROM r_events
        UNION ALL SELECT 'customers', 'unique:customer_id', false, false, cast(regexp_extract(customer_id, '[0-9]+$') AS bigint) % 2 = 0 FROM r_customers
        UNION ALL SELECT 'products', 'unique:product_id', false, false, cast(regexp_extract(product_id, '[0-9]+$') AS bigint) % 2 = 0 FROM r_products
        UNION ALL SELECT 'orders', 'unique:order_line_id', quantity <= 0, amount_cents < 1 OR amount_cents > 5000000,
               cast(regexp_extract(order_id, '[0-9]+$') AS bigint) % 2 = 0 FROM r_orders
        UNION ALL SELECT 'inventory', 'unique:snapshot_date,product_id,warehouse_region', false, false,
               cast(regexp_extract(product_id, '[0-9]+$') AS bigint) % 2 = 0 FROM r_inventory)
    SELECT table_name, 'loaded' AS rule, count(*) FILTER (NOT bad_quantity AND NOT bad_amount AND NOT taken) AS rows FROM t GROUP BY 1
    UNION ALL SELECT table_name, key_rule, count(*) FROM t WHERE NOT bad_quantity AND NOT bad_amount AND taken GROUP BY 1, 2
    UNION ALL SELECT table_name, 'check:quantity_positive', count(*) FROM t WHERE bad_quantity GROUP BY 1
    UNION ALL SELECT table_name, 'check:order_amount_in_range', count(*) FROM t WHERE bad_amount GROUP BY 1"""
FINALS["assert_gmv_positive"] = """
    SELECT order_id, amount_cents / 100.0 AS order_amount FROM r_orders WHERE amount_cents <= 0 AND status <> 'returned'"""
FINALS["assert_reorder_matches"] = """
    SELECT product_id FROM r_inventory i JOIN r_products p USING (product_id) WHERE i.reorder_threshold <> p.reorder_threshold"""
FINALS["assert_no_future_orders"] = f"""
    SELECT order_id, {day('order_date')} AS order_date FROM r_orders WHERE r_orders.order_date > DATE '2001-07-01'"""
FINALS["assert_amount_matches"] = """
    SELECT order_id, amount_cents / 100.0 AS order_amount, quantity, price_cents / 100.0 AS unit_price
    FROM r_orders WHERE abs(amount_cents - quantity * price_cents) > 1"""

# --- operations -----------------------------------------------------------------------------------

FINALS["run_view"] = f"""
    SELECT run_id, {stamp('start_time')} AS start_time, {stamp('end_time + INTERVAL 30 SECOND')} AS end_time,
           2 * records_processed - records_failed AS records_processed, records_failed, records_failed = 0 AS quality_passed,
           pii_events_masked, status
    FROM r_runs"""
FINALS["recent_runs"] = f"SELECT {RUN_COLUMNS} FROM r_runs ORDER BY r_runs.start_time DESC, run_id LIMIT 50"
FINALS["last_success"] = f"""
    SELECT {RUN_COLUMNS} FROM r_runs WHERE status = 'success' ORDER BY r_runs.end_time DESC, run_id LIMIT 1"""
FINALS["today_totals"] = """
    SELECT sum(records_processed)::bigint AS records_processed_today, sum(pii_events_masked)::bigint AS pii_events_masked_today
    FROM r_runs WHERE order_date = (SELECT max(order_date) FROM r_runs)"""
FINALS["run_stats"] = """
    SELECT count(*) FILTER (status = 'success') AS success_runs, count(*) FILTER (status = 'failed') AS failed_runs,
           avg(60 + records_processed) AS avg_duration_seconds
    FROM (SELECT * FROM r_runs ORDER BY start_time DESC, run_id LIMIT 100)"""
FINALS["runs_by_day_status"] = f"SELECT {day('order_date')} AS run_date, status, count(*) AS runs FROM r_runs GROUP BY order_date, status"
VALIDATION_COLUMNS = f"""run_id, checkpoint_name, suite_name, success, evaluated_expectations, successful_expectations,
    failed_expectations, {stamp('run_ts')} AS run_time"""
FINALS["validation_results"] = f"SELECT {VALIDATION_COLUMNS} FROM r_validation ORDER BY run_ts DESC, run_id, checkpoint_name LIMIT 20"
FINALS["failed_validations"] = f"""
    SELECT {VALIDATION_COLUMNS} FROM r_validation WHERE NOT success ORDER BY run_ts DESC, run_id, checkpoint_name LIMIT 50"""
FINALS["checkpoint_status"] = f"""
    SELECT checkpoint_name, count(*) FILTER (success) AS passed, count(*) AS total,
           {stamp('max(run_ts) FILTER (success)')} AS last_success
    FROM r_validation GROUP BY 1"""
FINALS["pass_rate_trend"] = f"""
    SELECT {stamp('run_ts')} AS run_time, checkpoint_name, successful_expectations / evaluated_expectations AS pass_rate FROM r_validation"""
FINALS["panel_totals"] = """
    , c AS (SELECT checkpoint_name AS label, count(*) FILTER (success) AS a, sum(successful_expectations) AS b, sum(failed_expectations) AS d
            FROM r_validation GROUP BY 1),
    s AS (SELECT stage AS label, sum(records_processed) AS a, sum(records_failed) AS b, max(60 + records_processed) AS d FROM r_runs GROUP BY 1)
    SELECT 'checkpoints_passing' AS panel, label, a::double AS value FROM c
    UNION ALL SELECT 'expectations_passed', label, b::double FROM c
    UNION ALL SELECT 'expectations_failed', label, d::double FROM c
    UNION ALL SELECT 'rows_processed', label, a::double FROM s
    UNION ALL SELECT 'rows_failed', label, b::double FROM s
    UNION ALL SELECT 'max_duration_seconds', label, d::double FROM s"""
FINALS["pii_summary"] = f"""
    SELECT field_name, count(*) AS events, {stamp('max(masked_at)')} AS last_seen, avg(original_length) AS avg_original_length
    FROM r_audit GROUP BY 1"""
FINALS["pii_totals"] = "SELECT count(DISTINCT field_name) AS fields_masked, count(*) AS events_masked FROM r_audit"
FINALS["pii_hourly_volume"] = f"""
    SELECT {stamp("date_trunc('hour', masked_at)")} AS hour, count(*) AS events FROM r_audit
    WHERE masked_at > TIMESTAMP '2024-01-23 12:00:00' GROUP BY 1"""
FINALS["recent_pii_events"] = f"""
    SELECT record_id, event_id, field_name, masking_action, original_length, '{RUN_ID}' AS pipeline_run_id, {stamp('r_audit.masked_at')} AS masked_at
    FROM r_audit ORDER BY r_audit.masked_at DESC NULLS LAST, record_id, field_name LIMIT 200"""
FINALS["event_rate_5m"] = f"""
    SELECT {RATE}, events / 300.0 AS per_second
    FROM (SELECT pane AS window_start, pane + INTERVAL 5 MINUTE AS window_end, event_type, events FROM r_panes)"""
FINALS["event_rate_1h"] = f"""
    SELECT {RATE}, events / 3600.0 AS per_second
    FROM (SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM r_sliding)"""
FINALS["stream_event_rate_1h"] = f"""
    SELECT {RATE}, events / 3600.0 AS per_second
    FROM (SELECT *, window_start + INTERVAL 1 HOUR AS window_end FROM r_sliding)"""
FINALS["pii_rate_1h"] = f"""
    , panes AS (SELECT time_bucket(INTERVAL 5 MINUTE, masked_at) AS pane, count(*) AS events FROM r_audit WHERE masked_at IS NOT NULL GROUP BY 1)
    SELECT {stamp('pane - to_minutes(5 * k)')} AS window_start, {stamp('pane - to_minutes(5 * k) + INTERVAL 1 HOUR')} AS window_end,
           sum(events)::bigint AS events, sum(events)::bigint / 3600.0 AS per_second
    FROM panes, generate_series(0, 11) AS t(k) GROUP BY 1, 2"""
FINALS["throughput_in_out"] = f"""
    , a AS (SELECT date_trunc('hour', event_timestamp) AS h, count(*) AS n FROM r_bronze GROUP BY 1),
    b AS (SELECT date_trunc('hour', event_timestamp) AS h, count(*) AS n FROM r_events GROUP BY 1)
    SELECT {stamp('h')} AS window_start, coalesce(a.n, 0) AS events_in, coalesce(b.n, 0) AS records_out,
           coalesce(a.n, 0) / 3600.0 AS in_per_second, coalesce(b.n, 0) / 3600.0 AS out_per_second
    FROM a FULL JOIN b USING (h)"""


def _assemble(final: str) -> str:
    """Statements that bring blocks of their own start with a comma."""
    sql = build(final.strip())
    return re.sub(r"\)\s+,\s", "), ", sql, count=1) if final.strip().startswith(",") else sql


ORACLES = {name: _assemble(final) for name, final in FINALS.items()}
