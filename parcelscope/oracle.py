"""The registered queries in DuckDB SQL, written from the definitions and not from the plans.

``r_`` are the stand-in bronze tables, ``s_`` silver, ``g_`` gold. A statement lists the tables it
needs; their definitions go in front as common table expressions.
"""

from __future__ import annotations

import re

TABLES: dict[str, str] = {
    "r_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderkey AS VARCHAR) AS customer_id,
               o_orderstatus AS order_status, o_orderdate AS order_purchase_timestamp,
               o_orderdate AS order_approved_at, first_ship AS order_delivered_carrier_date,
               CASE WHEN o_orderstatus <> 'P' THEN last_ship + INTERVAL 6 HOUR END
                   AS order_delivered_customer_date,
               o_orderdate + INTERVAL 30 DAY + INTERVAL 12 HOUR AS order_estimated_delivery_date
        FROM orders LEFT JOIN (
            SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
            FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    "r_order_items": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               l_shipdate AS shipping_limit_date, CAST(l_extendedprice AS DECIMAL(10, 2)) AS price,
               CAST(l_quantity AS DECIMAL(10, 2)) AS freight_value
        FROM lineitem""",
    "r_order_payments": """
        SELECT order_id, payment_sequential, payment_type, 1::BIGINT AS payment_installments,
               payment_value
        FROM (
            SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderpriority,
                   CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto'
                        WHEN '3-MEDIUM' THEN 'voucher' WHEN '5-LOW' THEN 'debit_card'
                        ELSE 'not_defined' END AS payment_type,
                   1::BIGINT AS payment_sequential,
                   CAST(o_totalprice AS DECIMAL(10, 2)) AS payment_value
            FROM orders
            UNION ALL
            SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, 'credit_card', 2,
                   CAST(10 AS DECIMAL(10, 2))
            FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "r_order_reviews": """
        SELECT CAST(event_id AS VARCHAR) AS review_id, CAST(event_id * 3 // 4 AS VARCHAR) AS order_id,
               CASE WHEN event_type = 'error' THEN 'txt'
                    ELSE CAST(CAST(floor(value / 40) + 1 AS BIGINT) AS VARCHAR) END AS review_score,
               event_type AS review_comment_title, props AS review_comment_message,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS review_creation_date,
               ts AS review_answer_timestamp
        FROM events""",
    "r_customers": """
        SELECT CAST(o_orderkey AS VARCHAR) AS customer_id,
               CAST(o_custkey AS VARCHAR) AS customer_unique_id,
               CAST(nullif(c_nationkey, 0) AS BIGINT) AS customer_zip_code_prefix,
               CASE WHEN o_orderstatus = 'F' THEN lower(c_mktsegment) ELSE c_mktsegment END
                   AS customer_city,
               lower(n_name) AS customer_state
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "r_sellers": """
        SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
               CAST(s_nationkey AS BIGINT) AS seller_zip_code_prefix, s_name AS seller_city,
               lower(n_name) AS seller_state
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "r_products": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS product_category_name,
               length(p_name)::BIGINT AS product_name_lenght,
               p_size::BIGINT AS product_description_lenght,
               CAST(nullif(p_size % 7, 0) AS BIGINT) AS product_photos_qty,
               CAST(round_even(p_retailprice / 2, 0) AS BIGINT) AS product_weight_g,
               p_size::BIGINT AS product_length_cm,
               CAST(round_even(p_size * 2.5::DOUBLE, 0) AS BIGINT) AS product_height_cm,
               p_size::BIGINT AS product_width_cm
        FROM part""",
    "r_product_category_translation": """
        SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
        FROM part WHERE p_type NOT IN ('PROMO', 'STANDARD')""",
    "r_geolocation": """
        SELECT CAST(c_nationkey AS BIGINT) AS geolocation_zip_code_prefix, c_acctbal AS geolocation_lat,
               -c_acctbal AS geolocation_lng, lower(c_mktsegment) AS geolocation_city,
               n_name AS geolocation_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "s_orders": """
        SELECT *,
               date_sub('day', order_purchase_timestamp, order_delivered_customer_date) AS delivery_days,
               CASE WHEN order_delivered_customer_date IS NOT NULL
                         AND order_delivered_customer_date > order_estimated_delivery_date
                    THEN 1 ELSE 0 END::BIGINT AS is_late,
               date_sub('day', order_estimated_delivery_date, order_delivered_customer_date) AS days_late,
               CASE WHEN order_delivered_customer_date IS NULL THEN 0 ELSE 1 END::BIGINT AS is_delivered
        FROM r_orders""",
    "s_order_items": "SELECT * FROM r_order_items",
    "s_order_payments": """
        SELECT *, CASE WHEN payment_type IN ('credit_card', 'boleto', 'voucher', 'debit_card')
                       THEN 1 ELSE 0 END::BIGINT AS payment_type_valid
        FROM r_order_payments""",
    "s_order_reviews": """
        SELECT *, CASE WHEN review_score IS NULL THEN 0 WHEN review_score BETWEEN 1 AND 5 THEN 1
                       ELSE 0 END::BIGINT AS review_score_valid
        FROM (SELECT * REPLACE (CAST(round_even(TRY_CAST(trim(review_score) AS DOUBLE), 0) AS BIGINT)
                                AS review_score) FROM r_order_reviews)""",
    "s_customers": """
        SELECT * REPLACE (upper(customer_state) AS customer_state),
               customer_zip_code_prefix IS NOT NULL AS has_zip
        FROM r_customers""",
    "s_sellers": "SELECT * REPLACE (upper(seller_state) AS seller_state) FROM r_sellers",
    "s_products": """
        SELECT p.*, t.product_category_name_english AS product_category_english
        FROM r_products p LEFT JOIN r_product_category_translation t USING (product_category_name)""",
    "s_geolocation": """
        SELECT geolocation_zip_code_prefix, geolocation_state, geolocation_city,
               avg(geolocation_lat) AS geolocation_lat, avg(geolocation_lng) AS geolocation_lng
        FROM r_geolocation GROUP BY ALL""",
    "g_geo_by_zip": """
        SELECT geolocation_zip_code_prefix, avg(geolocation_lat) AS geolocation_lat,
               avg(geolocation_lng) AS geolocation_lng
        FROM s_geolocation GROUP BY geolocation_zip_code_prefix""",
    "g_dim_customers": """
        SELECT md5(customer_unique_id) AS customer_key, customer_unique_id, customer_city,
               customer_state, geolocation_lat, geolocation_lng
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id DESC) AS rn
              FROM s_customers)
        LEFT JOIN g_geo_by_zip ON customer_zip_code_prefix = geolocation_zip_code_prefix
        WHERE rn = 1""",
    "g_seller_stats": """
        SELECT seller_id, count(*) AS total_orders, avg(CAST(1 - is_late AS DOUBLE)) AS on_time_rate,
               avg(CAST(review_score AS DOUBLE)) AS avg_review_score
        FROM s_order_items JOIN s_orders USING (order_id) LEFT JOIN s_order_reviews USING (order_id)
        GROUP BY seller_id""",
    "g_dim_sellers": """
        SELECT md5(seller_id) AS seller_key, seller_id, seller_city, seller_state, geolocation_lat,
               geolocation_lng, total_orders, on_time_rate, avg_review_score
        FROM s_sellers
        LEFT JOIN g_geo_by_zip ON seller_zip_code_prefix = geolocation_zip_code_prefix
        LEFT JOIN g_seller_stats USING (seller_id)""",
    "g_dim_products": """
        SELECT md5(product_id) AS product_key, product_id, product_category_english,
               product_weight_g::INTEGER AS product_weight_g,
               product_length_cm::INTEGER AS product_length_cm,
               product_height_cm::INTEGER AS product_height_cm,
               product_width_cm::INTEGER AS product_width_cm
        FROM s_products""",
    "g_dim_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               year(d)::SMALLINT AS year, month(d)::SMALLINT AS month
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2003-12-31', INTERVAL 1 DAY))
                          AS DATE) AS d)""",
    "g_latest_review": """
        SELECT order_id, review_score
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_id
                  ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC) AS rn
              FROM s_order_reviews WHERE review_score_valid = 1)
        WHERE rn = 1""",
    "g_payments_agg": """
        SELECT order_id, sum(payment_value) AS payment_value FROM s_order_payments GROUP BY order_id""",
    "g_customer_lookup": "SELECT DISTINCT customer_id, customer_unique_id FROM s_customers",
    "g_fact_orders": """
        SELECT md5(i.order_id || CAST(order_item_id AS VARCHAR)) AS order_item_key, i.order_id,
               order_item_id::INTEGER AS order_item_id, md5(l.customer_unique_id) AS customer_key,
               md5(i.seller_id) AS seller_key, md5(i.product_id) AS product_key,
               strftime(order_purchase_timestamp, '%Y%m%d')::INTEGER AS order_date_key,
               strftime(order_delivered_customer_date, '%Y%m%d')::INTEGER AS delivery_date_key,
               strftime(order_estimated_delivery_date, '%Y%m%d')::INTEGER
                   AS estimated_delivery_date_key,
               price, freight_value, payment_value::DECIMAL(10, 2) AS payment_value,
               review_score::SMALLINT AS review_score, delivery_days::INTEGER AS delivery_days,
               days_late::INTEGER AS days_late, is_late::SMALLINT AS is_late,
               is_delivered::SMALLINT AS is_delivered, order_status
        FROM s_order_items i
        JOIN s_orders o ON i.order_id = o.order_id
        JOIN g_customer_lookup l ON o.customer_id = l.customer_id
        JOIN g_dim_customers c ON md5(l.customer_unique_id) = c.customer_key
        JOIN s_sellers s ON i.seller_id = s.seller_id
        JOIN g_dim_products p ON md5(i.product_id) = p.product_key
        LEFT JOIN g_latest_review r ON i.order_id = r.order_id
        LEFT JOIN g_payments_agg pa ON i.order_id = pa.order_id""",
    # the fact with the attributes measures are sliced by
    "m_fact": """
        SELECT f.*, c.customer_state, s.seller_id, s.seller_state, p.product_category_english,
               d.full_date, d.year, d.month
        FROM g_fact_orders f
        LEFT JOIN g_dim_customers c ON f.customer_key = c.customer_key
        LEFT JOIN (SELECT md5(seller_id) AS seller_key, seller_id, seller_state FROM s_sellers) s
            ON f.seller_key = s.seller_key
        LEFT JOIN g_dim_products p ON f.product_key = p.product_key
        LEFT JOIN g_dim_date d ON f.order_date_key = d.date_key""",
}

_ON_TIME = (
    "round(nullif(count(*) FILTER (WHERE coalesce(is_late, 0) = 0), 0)::DOUBLE / count(*), 6)"
    " AS on_time_rate"
)


def _needed(sql: str) -> list[str]:
    """Tables a statement reads, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[rsgm]_[a-z_]+\b", text):
            if name in TABLES and name not in order:
                visit(TABLES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def _with(sql: str, **local: str) -> str:
    """The statement behind its table definitions and local ones."""
    body = " ".join([*local.values(), sql])
    parts = [f"{n} AS ({TABLES[n]})" for n in _needed(body)]
    parts += [f"{n} AS ({q})" for n, q in local.items()]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def _revenue(axes: str, source: str = "m_fact", where: str = "TRUE") -> str:
    """Revenue, orders and on-time rate; revenue takes each order's payment once per group."""
    by = f"{axes}, " if axes else ""
    group = f"GROUP BY {axes}" if axes else ""
    on = " AND ".join(f"a.{x.strip()} IS NOT DISTINCT FROM b.{x.strip()}" for x in axes.split(","))
    picked = ", ".join(f"a.{x.strip()}" for x in axes.split(","))
    return f"""
        SELECT {picked}, total_revenue::DOUBLE AS total_revenue, total_orders, on_time_rate
        FROM (SELECT {axes}, sum(pv) AS total_revenue
              FROM (SELECT {by}order_id, max(payment_value) AS pv FROM {source} WHERE {where}
                    GROUP BY {by}order_id) {group}) a
        JOIN (SELECT {by}count(DISTINCT order_id) AS total_orders, {_ON_TIME}
              FROM {source} WHERE {where} {group}) b ON {on}"""


def _checks(table: str, source: str, checks: list[tuple[str, str, str]]) -> str:
    """One aggregate per check over the same source."""
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{kind}' AS check_type, {result} AS result,"
        f" coalesce({passed}, FALSE) AS passed FROM ({source}) x"
        for kind, result, passed in checks
    )


def _clock(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _bronze_checks() -> str:
    keys = {
        "orders": ("order_id", "orders", True, "order_purchase_timestamp"),
        "order_items": ("order_id, order_item_id", "lineitem", True, None),
        "order_payments": ("order_id, payment_sequential", "orders", True, None),
        "order_reviews": ("review_id", "events", False, "review_creation_date"),
        "customers": ("customer_id", "orders", True, None),
        "sellers": ("seller_id", "supplier", True, None),
        "products": ("product_id", "part", True, None),
        "product_category_translation": ("product_category_name", "nation", True, None),
        "geolocation": ("geolocation_zip_code_prefix", "customer", False, None),
    }
    parts = []
    for table, (key, source, unique, clock) in keys.items():
        null = " OR ".join(f"{k.strip()} IS NULL" for k in key.split(","))
        blocks = "TRUE" if table == "order_reviews" else f"count(*) FILTER (WHERE {null}) = 0"
        expected = f"(SELECT count(*) FROM {source})"
        off = f"(abs(count(*) - {expected})::DOUBLE / {expected})"
        repeats = f"(count(*) - count(DISTINCT row({key})))"
        checks = [
            (
                "row_count",
                f"count(*) || ' rows for about ' || {expected} || ' (off by ' ||"
                f" printf('%.1f', {off} * 100) || '%)'",
                f"{off} <= 0.05",
            ),
            ("pk_null_rate", f"count(*) FILTER (WHERE {null}) || ' nulls in {key}'", blocks),
            ("pk_duplicates", f"{repeats} || ' duplicates on {key}'", f"{repeats} = 0")
            if unique
            else ("pk_duplicates", "'skipped, key not unique by design'", "count(*) >= 0"),
        ]
        if clock:
            low, high = _clock(f"min({clock})"), _clock(f"max({clock})")
            checks.append(("date_range", f"{low} || ' to ' || {high}", "count(*) >= 0"))
        parts.append(_checks(table, f"SELECT * FROM r_{table}", checks))
    return _with(" UNION ALL ".join(parts))


def _silver_checks() -> str:
    parts = []
    required = {
        "orders": ["order_id", "customer_id"],
        "order_items": ["order_id", "seller_id", "product_id"],
        "order_payments": ["order_id"],
        "order_reviews": ["order_id"],
    }
    ranges = {
        "order_reviews": ("review_score", "min(review_score) >= 1 AND max(review_score) <= 5"),
        "order_payments": ("payment_value", "min(payment_value) >= 0"),
        "orders": ("delivery_days", "min(delivery_days) >= -30 AND max(delivery_days) <= 365"),
    }
    for table in (
        "orders", "order_items", "order_payments", "order_reviews", "customers", "sellers",
        "geolocation", "products",
    ):
        bronze = f"(SELECT count(*) FROM r_{table})"
        checks = [
            (
                "row_count_reconciliation",
                "'deduplicated, silver ' || count(*)"
                if table == "geolocation"
                else f"'bronze ' || {bronze} || ', silver ' || count(*)",
                "TRUE" if table == "geolocation" else f"count(*) <= {bronze}",
            )
        ]
        for column in required.get(table, []):
            nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
            rate = f"printf('%.2f', coalesce({nulls}::DOUBLE / nullif(count(*), 0), 0) * 100)"
            checks.append(
                (f"null_rate_{column}", f"{nulls} || ' nulls (' || {rate} || '%)'", f"{nulls} = 0")
            )
        if table in ranges:
            column, rule = ranges[table]
            text = f"'min=' || min({column}) || ', max=' || max({column})"
            checks.append((f"range_{column}", f"coalesce({text}, 'no rows')", f"coalesce({rule}, TRUE)"))
        if table == "order_reviews":
            bad = "count(*) FILTER (WHERE review_score_valid = 0)"
            checks.append(
                (
                    "review_score_valid_flag",
                    f"{bad} || ' reviews with an invalid score, of ' || count(*)",
                    f"{bad} <= 50",
                )
            )
        if table == "order_payments":
            bad = "count(*) FILTER (WHERE payment_type_valid = 0)"
            checks.append(
                (
                    "payment_type_valid_flag",
                    f"{bad} || ' payments of an unlisted type, of ' || count(*)",
                    "count(*) >= 0",
                )
            )
        parts.append(_checks(table, f"SELECT * FROM s_{table}", checks))
    for child, column, parent in (
        ("order_items", "order_id", "orders"),
        ("order_items", "seller_id", "sellers"),
        ("order_items", "product_id", "products"),
        ("order_payments", "order_id", "orders"),
        ("order_reviews", "order_id", "orders"),
        ("orders", "customer_id", "customers"),
    ):
        orphans = f"""
            SELECT DISTINCT c.{column} FROM s_{child} c
            WHERE NOT EXISTS (SELECT 1 FROM s_{parent} p WHERE p.{column} = c.{column})"""
        parts.append(
            _checks(
                child,
                orphans,
                [(f"ref_integrity_{column}", "count(*) || ' keys without a parent'", "count(*) <= 25")],
            )
        )
    off = "(abs(paid - sold)::DOUBLE / sold::DOUBLE)"
    parts.append(
        f"""SELECT 'order_payments' AS table_name, 'revenue_reconciliation' AS check_type,
               'payments=' || paid || ', items=' || sold || ', variance=' ||
               printf('%.2f', {off} * 100) || '%' AS result, {off} <= 0.30 AS passed
            FROM (SELECT sum(payment_value) AS paid FROM s_order_payments)
            CROSS JOIN (SELECT sum(price + freight_value) AS sold FROM s_order_items)"""
    )
    return " UNION ALL ".join(parts)


def _gold_checks() -> str:
    parts = []
    items = "(SELECT count(*) FROM s_order_items)"
    checks = [
        (
            "fact_vs_silver_order_items",
            f"'fact ' || count(*) || ', silver ' || {items}",
            f"count(*) = {items}",
        )
    ]
    for column in ("customer_key", "seller_key", "product_key", "order_date_key"):
        nulls = f"count(*) FILTER (WHERE {column} IS NULL)"
        checks.append((f"null_{column}", f"{nulls} || ' nulls'", f"{nulls} = 0"))
    out = "count(*) FILTER (WHERE review_score NOT BETWEEN 1 AND 5)"
    null = "count(*) FILTER (WHERE review_score IS NULL)"
    checks += [
        ("review_score_out_of_range", f"{out} || ' rows'", f"{out} = 0"),
        (
            "review_score_null_count",
            f"{null} || ' rows (up to 6000 tolerated)'",
            f"{null} <= 6000",
        ),
    ]
    parts.append(_checks("fact_orders", "SELECT * FROM g_fact_orders", checks))
    for column, dim, key in (
        ("customer_key", "g_dim_customers", "customer_key"),
        ("seller_key", "g_dim_sellers", "seller_key"),
        ("product_key", "g_dim_products", "product_key"),
        ("order_date_key", "g_dim_date", "date_key"),
        ("delivery_date_key", "g_dim_date", "date_key"),
        ("estimated_delivery_date_key", "g_dim_date", "date_key"),
    ):
        exempt = f"AND f.{column} IS NOT NULL" if key == "date_key" else ""
        orphans = f"""
            SELECT f.{column} FROM g_fact_orders f LEFT JOIN {dim} d ON f.{column} = d.{key}
            WHERE d.{key} IS NULL {exempt}"""
        parts.append(
            _checks(
                "fact_orders",
                orphans,
                [(f"{column}_orphans", "count(*) || ' orphans'", "count(*) = 0")],
            )
        )
    off = "(abs(f - s)::DOUBLE / s::DOUBLE)"
    parts.append(
        f"""SELECT 'fact_orders' AS table_name, 'revenue_reconciliation' AS check_type,
               'fact=' || f || ', silver=' || s || ', variance=' || printf('%.4f', {off} * 100) || '%'
                   AS result, {off} <= 0.01 AS passed
            FROM (SELECT sum(payment_value) AS f FROM (
                      SELECT DISTINCT order_id, payment_value FROM g_fact_orders
                      WHERE payment_value IS NOT NULL))
            CROSS JOIN (SELECT sum(payment_value) AS s FROM s_order_payments p WHERE EXISTS (
                      SELECT 1 FROM s_order_items i WHERE i.order_id = p.order_id))"""
    )
    return _with(" UNION ALL ".join(parts))


def _lengths() -> str:
    limits = {
        "dim_customers": {"customer_unique_id": 50, "customer_city": 100, "customer_state": 2},
        "dim_sellers": {"seller_id": 50, "seller_city": 100, "seller_state": 2},
        "dim_products": {"product_id": 50, "product_category_english": 100},
    }
    parts = []
    for table, columns in limits.items():
        for column, size in columns.items():
            over = f"count(*) FILTER (WHERE length({column}) > {size})"
            check = (f"length_{column}", f"{over} || ' values over {size}'", f"{over} = 0")
            parts.append(_checks(table, f"SELECT * FROM g_{table}", [check]))
    return _with(" UNION ALL ".join(parts))


def _silver(table: str, **text_columns: str) -> str:
    replace = ", ".join(f"{expr} AS {c}" for c, expr in text_columns.items())
    return _with(f"SELECT * {f'REPLACE ({replace})' if replace else ''} FROM s_{table}")


_ORDER_CLOCKS = {
    c: _clock(c)
    for c in (
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
}

_COORDINATES = (
    "round(geolocation_lat, 6) AS geolocation_lat, round(geolocation_lng, 6) AS geolocation_lng"
)

_MARGINS = (
    ("year",), ("customer_state",), ("product_category_english",), ("year", "customer_state"),
    ("customer_state", "product_category_english"), (),
)


def _margin(axes: tuple[str, ...]) -> str:
    """One set of axes of the margins, on its own."""
    every = ("year", "customer_state", "product_category_english")
    by = "".join(f"{a}, " for a in axes)
    shown = ", ".join(a if a in axes else f"NULL AS {a}" for a in every)
    group = f"GROUP BY {', '.join(axes)}" if axes else ""
    return f"""
        SELECT {shown}, '{", ".join(axes)}' AS margin, sum(ltv)::DOUBLE AS total_revenue,
               nullif(sum(orders), 0)::DOUBLE AS total_orders, nullif(count(customer_key), 0) AS total_customers,
               round(nullif(sum(on_time), 0)::DOUBLE / sum(n), 6) AS on_time_rate,
               round(sum(scores)::DOUBLE / sum(n_scores), 6) AS avg_review_score,
               round(nullif(count(*) FILTER (WHERE n >= 2), 0)::DOUBLE / count(customer_key), 6) AS repeat_customer_rate,
               round(sum(ltv)::DOUBLE / count(ltv), 6) AS clv
        FROM (SELECT {by}customer_key, sum(pv) AS ltv, sum(n) AS n, count(order_id) AS orders, sum(on_time) AS on_time,
                     sum(scores) AS scores, sum(n_scores) AS n_scores
              FROM (SELECT {by}customer_key, order_id, max(payment_value) AS pv, count(*) AS n,
                           count(*) FILTER (WHERE coalesce(is_late, 0) = 0) AS on_time,
                           sum(review_score) AS scores, count(review_score) AS n_scores
                    FROM m_fact GROUP BY {by}customer_key, order_id)
              GROUP BY {by}customer_key) {group}"""


# The damage done to the items' lines, see the query.
_DAMAGED = """
        SELECT order_id, order_item_id, seller_id, shipping_limit_date, price, freight_value, kind,
               CASE kind WHEN 0 THEN concat_ws(',', a, b, 'n/a', freight_value) WHEN 1 THEN concat_ws(',', a, b)
                         WHEN 2 THEN concat_ws(',', a, b, price, freight_value, 'extra')
                         WHEN 3 THEN concat(a, ',"', concat_ws(',', b, price, freight_value)) END AS line
        FROM (SELECT *, (order_id::BIGINT + order_item_id) % 11 AS kind, concat_ws(',', order_id, order_item_id) AS a,
                     concat_ws(',', product_id, seller_id, strftime(shipping_limit_date, '%Y-%m-%d %H:%M:%S')) AS b
              FROM r_order_items)"""

# Customers as known on the snapshot days, and their versions: islands of equal attributes.
_HISTORY = {
    "days": """
        SELECT day, coalesce(lead(day) OVER (ORDER BY day), DATE '9999-12-31') AS until
        FROM (VALUES (DATE '1994-12-31'), (DATE '1995-12-31'), (DATE '1996-12-31'), (DATE '1998-12-31')) v(day)""",
    "known": """
        SELECT day, until, customer_unique_id, customer_city, customer_state
        FROM days JOIN (SELECT c.*, CAST(order_purchase_timestamp AS DATE) AS bought
                        FROM s_customers c JOIN s_orders o USING (customer_id)) ON bought <= day
        QUALIFY row_number() OVER (PARTITION BY day, customer_unique_id ORDER BY customer_id DESC) = 1""",
    "marked": """
        SELECT *, lag(until) OVER w IS NOT DISTINCT FROM day AND lag(customer_city) OVER w IS NOT DISTINCT FROM customer_city
                  AND lag(customer_state) OVER w IS NOT DISTINCT FROM customer_state AS goes_on
        FROM known WINDOW w AS (PARTITION BY customer_unique_id ORDER BY day)""",
    "islands": """
        SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END) OVER (PARTITION BY customer_unique_id ORDER BY day) AS island
        FROM marked""",
    "versions": """
        SELECT customer_unique_id, any_value(customer_city) AS customer_city, any_value(customer_state) AS customer_state,
               min(day) AS effective_start_date, nullif(max(until), DATE '9999-12-31') AS effective_end_date
        FROM islands GROUP BY customer_unique_id, island""",
}

_SQL: dict[str, str] = {
    "in_incremental_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS purchase_date
        FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '1998-06-30'""",
    "in_full_load_roundtrip": _with("SELECT * FROM r_geolocation"),
    "in_incremental_load": _with(
        f"""SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in _ORDER_CLOCKS.items())})
            FROM r_orders WHERE order_purchase_timestamp IS NOT NULL"""
    ),
    "in_same_day_load": _with(
        """
        SELECT mode, run_id, CASE run_id WHEN 'run-1' THEN n ELSE 0 END AS rows_loaded, 'success' AS status,
               CASE mode WHEN 'run_date' THEN DATE '1998-06-30' ELSE latest END AS last_loaded_date
        FROM (SELECT count(*) AS n, max(CAST(order_purchase_timestamp AS DATE)) AS latest FROM r_orders
              WHERE CAST(order_purchase_timestamp AS DATE) <= DATE '1998-06-30'),
             (VALUES ('lookback'), ('event_date'), ('run_date')) modes(mode),
             (VALUES ('run-1'), ('run-2')) runs(run_id)"""
    ),
    "in_rescued": _with(
        """
        SELECT 'run-1' AS run_id, order_id, order_item_id, line, CASE kind WHEN 0 THEN 'price' END AS "column",
               CASE kind WHEN 0 THEN 'n/a' END AS raw_value
        FROM lines WHERE kind < 4""",
        lines=_DAMAGED,
    ),
    "in_damaged_load": _with(
        """
        SELECT order_id, order_item_id, CASE WHEN kind <> 3 THEN seller_id END AS seller_id,
               CASE WHEN kind <> 3 THEN strftime(shipping_limit_date, '%Y-%m-%d %H:%M:%S') END AS shipping_limit_date,
               CASE WHEN kind NOT IN (0, 1, 3) THEN price::DOUBLE END AS price,
               CASE WHEN kind NOT IN (1, 3) THEN freight_value::DOUBLE END AS freight_value
        FROM lines""",
        lines=_DAMAGED,
    ),
    "in_rejects": _with(
        f"""SELECT order_id, {_clock('order_purchase_timestamp')} AS order_purchase_timestamp,
                   CASE WHEN order_purchase_timestamp IS NULL THEN 'undated' ELSE 'future' END AS reason
            FROM r_orders
            WHERE order_purchase_timestamp IS NULL
               OR CAST(order_purchase_timestamp AS DATE) > DATE '1998-06-30'"""
    ),
    "in_run_report": _with(
        """
        SELECT 1 AS sequence, 'sellers' AS table_name, count(*) AS rows_loaded, 'success' AS status FROM r_sellers
        UNION ALL SELECT 2, 'products', count(*), 'success' FROM r_products
        UNION ALL SELECT 3, 'product_category_translation', count(*), 'success'
                  FROM r_product_category_translation"""
    ),
    "in_run_log": _with(
        """
        SELECT 'sellers' AS table_name, count(*) AS rows_loaded, 'success' AS status,
               DATE '2026-01-01' AS last_loaded_date, 'run-1' AS last_run_id FROM r_sellers
        UNION ALL SELECT 'products', count(*), 'success', DATE '2026-01-01', 'run-1' FROM r_products
        UNION ALL SELECT 'product_category_translation', count(*), 'success', DATE '2026-01-01', 'run-1'
                  FROM r_product_category_translation
        UNION ALL SELECT 'order_reviews', count(*), 'success', max(CAST(review_creation_date AS DATE)),
                  'run-1' FROM r_order_reviews"""
    ),
    "in_schema_drift": _with(
        """
        SELECT seller_id, seller_state,
               'header differs: undeclared columns ["city''s name"], absent columns [''seller_city'']' AS refused
        FROM r_sellers"""
    ),
    "st_incremental_events": f"""
        SELECT event_id, {_clock('ts')} AS ts, user_id, event_type, value FROM events""",
    "st_keyed_orders": _with(
        f"""
        SELECT order_id, {_clock('order_purchase_timestamp')} AS order_purchase_timestamp,
               CASE WHEN order_purchase_timestamp IS NULL THEN 'undated'
                    WHEN order_purchase_timestamp < TIMESTAMP '1993-01-01' AND order_id::BIGINT % 10 = 3 THEN 'late'
                    ELSE 'stored' END AS reason
        FROM r_orders"""
    ),
    "sv_orders": _silver("orders", **_ORDER_CLOCKS),
    "sv_order_items": _silver(
        "order_items",
        shipping_limit_date=_clock("shipping_limit_date"),
        price="price::DOUBLE",
        freight_value="freight_value::DOUBLE",
    ),
    "sv_order_payments": _silver("order_payments", payment_value="payment_value::DOUBLE"),
    "sv_order_reviews": _silver(
        "order_reviews",
        review_creation_date=_clock("review_creation_date"),
        review_answer_timestamp=_clock("review_answer_timestamp"),
    ),
    "sv_customers": _silver("customers"),
    "sv_sellers": _silver("sellers"),
    "sv_products": _silver("products"),
    "sv_stored_tables": _silver("customers"),
    "sv_geolocation": _silver(
        "geolocation",
        geolocation_lat="round(geolocation_lat, 6)",
        geolocation_lng="round(geolocation_lng, 6)",
    ),
    "gd_dim_date": _with(
        """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
               year(d)::SMALLINT AS year, quarter(d)::SMALLINT AS quarter,
               'Q' || quarter(d) AS quarter_name, month(d)::SMALLINT AS month,
               monthname(d) AS month_name, strftime(d, '%b-%Y') AS month_year,
               (CAST(strftime(d, '%U') AS INTEGER)
                + CASE WHEN dayofweek(date_trunc('year', d)) = 0 THEN 0 ELSE 1 END)::SMALLINT
                   AS week_of_year,
               day(d)::SMALLINT AS day_of_month, (dayofweek(d) + 1)::SMALLINT AS day_of_week,
               dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
               d = last_day(d) AS is_month_end, (year(d) - 2018)::SMALLINT AS year_offset
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo)::TIMESTAMP,
                  make_timestamp(year(hi), 12, 31, 0, 0, 0), INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(least(order_purchase_timestamp, order_delivered_customer_date,
                                     order_estimated_delivery_date)) AS lo,
                           max(greatest(order_purchase_timestamp, order_delivered_customer_date,
                                        order_estimated_delivery_date)) AS hi
                    FROM r_orders))"""
    ),
    "gd_dim_customers": _with(
        f"SELECT * REPLACE ({_COORDINATES}) FROM g_dim_customers"
    ),
    "gd_seller_stats": _with(
        """SELECT seller_id, total_orders, round(on_time_rate, 6) AS on_time_rate,
                  round(avg_review_score, 6) AS avg_review_score FROM g_seller_stats"""
    ),
    "gd_dim_sellers": _with(
        f"""SELECT * REPLACE ({_COORDINATES}, round(on_time_rate, 6) AS on_time_rate,
                              round(avg_review_score, 6) AS avg_review_score) FROM g_dim_sellers"""
    ),
    "gd_dim_products": _with("SELECT * FROM g_dim_products"),
    "gd_latest_review": _with("SELECT * FROM g_latest_review"),
    "gd_payments_agg": _with(
        "SELECT order_id, payment_value::DOUBLE AS payment_value FROM g_payments_agg"
    ),
    "gd_customer_lookup": _with("SELECT * FROM g_customer_lookup"),
    "gd_geo_by_zip": _with(f"SELECT * REPLACE ({_COORDINATES}) FROM g_geo_by_zip"),
    "gd_fact_orders": _with(
        """SELECT * REPLACE (price::DOUBLE AS price, freight_value::DOUBLE AS freight_value,
                             payment_value::DOUBLE AS payment_value) FROM g_fact_orders"""
    ),
    "gd_dim_customers_history": _with(
        """
        SELECT md5(customer_unique_id) AS customer_key, *, effective_end_date IS NULL AS is_current FROM versions""",
        **_HISTORY,
    ),
    "gd_fact_asof": _with(
        """
        SELECT order_id, order_item_key, customer_key AS member_key, order_date, price, customer_city, customer_state,
               effective_start_date
        FROM (SELECT *, strptime(order_date_key::VARCHAR, '%Y%m%d')::DATE AS order_date FROM g_fact_orders)
        LEFT JOIN versions ON customer_key = md5(customer_unique_id) AND effective_start_date <= order_date
                          AND order_date < coalesce(effective_end_date, DATE '9999-12-31')""",
        **_HISTORY,
    ),
    "qc_bronze": _bronze_checks(),
    "qc_silver": _with(_silver_checks()),
    "qc_gold": _gold_checks(),
    "qc_summary": _with(
        "SELECT passed, count(*) AS n_checks FROM checked GROUP BY passed", checked=_silver_checks()
    ),
    "qc_lengths": _lengths(),
    "qc_unique_item_key": _with(
        """
        SELECT 'order_items' AS table_name, 'unique_item_key' AS check_type,
               (count(*) - count(DISTINCT row(order_id, order_item_id))) || ' repeats' AS result,
               count(*) = count(DISTINCT row(order_id, order_item_id)) AS passed
        FROM s_order_items"""
    ),
    "me_revenue_by_year_state": _with(_revenue("year, customer_state")),
    "me_totals": _with(
        """
        SELECT sum(pv)::DOUBLE AS total_revenue, count(*) AS total_orders,
               nullif(sum(late), 0)::BIGINT AS late_orders,
               (SELECT count(DISTINCT customer_key) FROM g_fact_orders) AS total_customers,
               round(sum(pv)::DOUBLE / count(*), 6) AS avg_order_value
        FROM (SELECT order_id, max(payment_value) AS pv, sum(is_late) AS late
              FROM g_fact_orders GROUP BY order_id)"""
    ),
    "me_delivery_by_state": _with(
        f"""
        SELECT customer_state, {_ON_TIME},
               round(nullif(count(*) FILTER (WHERE is_delivered = 1 AND is_late = 0), 0)::DOUBLE
                     / count(*) FILTER (WHERE is_delivered = 1), 6) AS on_time_rate_delivered,
               nullif(count(*) FILTER (WHERE is_late = 1), 0) AS late_orders,
               round(avg(delivery_days), 6) AS avg_delivery_days,
               round(avg(days_late) FILTER (WHERE is_late = 1), 6) AS avg_days_late
        FROM m_fact GROUP BY customer_state"""
    ),
    "me_reviews_by_category": _with(
        """SELECT product_category_english, round(avg(review_score), 6) AS avg_review_score
           FROM m_fact GROUP BY product_category_english"""
    ),
    "me_review_rolling_3m": _with(
        """
        SELECT m.year, m.month, round(avg(f.review_score), 6) AS review_score_rolling_3m
        FROM (SELECT year, month, max(full_date) AS last FROM g_dim_date GROUP BY year, month) m
        JOIN m_fact f
          ON f.full_date <= m.last
         AND f.full_date >= date_trunc('month', m.last) - INTERVAL 2 MONTH
        GROUP BY m.year, m.month"""
    ),
    "me_review_rolling_daily": _with(
        """
        SELECT d.full_date, f.customer_state, round(avg(f.review_score), 6) AS review_score_rolling_3m
        FROM g_dim_date d JOIN m_fact f
          ON f.full_date <= d.full_date AND f.full_date >= d.full_date + INTERVAL 1 DAY - INTERVAL 3 MONTH
        GROUP BY d.full_date, f.customer_state"""
    ),
    "me_margins": _with(" UNION ALL ".join(map(_margin, _MARGINS))),
    "me_distinct_from_sketches": _with(
        """
        SELECT year, customer_state, count(DISTINCT order_id) AS total_orders_approx,
               count(DISTINCT customer_key) AS total_customers_approx
        FROM m_fact GROUP BY year, customer_state"""
    ),
    "me_revenue_yoy": _with(
        """
        SELECT coalesce(c.year, p.year + 1)::SMALLINT AS year,
               coalesce(c.month, p.month)::SMALLINT AS month, c.rev::DOUBLE AS total_revenue,
               (coalesce(c.rev, 0) - coalesce(p.rev, 0))::DOUBLE AS yoy_revenue,
               round((coalesce(c.rev, 0) - p.rev)::DOUBLE / nullif(p.rev, 0)::DOUBLE, 6)
                   AS yoy_revenue_pct
        FROM monthly c FULL JOIN monthly p ON c.year = p.year + 1 AND c.month = p.month
        WHERE coalesce(c.year, p.year + 1) <= 2003""",
        monthly="""
        SELECT year, month, sum(pv) AS rev
        FROM (SELECT year, month, order_id, max(payment_value) AS pv FROM m_fact
              GROUP BY year, month, order_id) GROUP BY year, month""",
    ),
    "me_customers": _with(
        """
        SELECT customer_state, count(*) AS total_customers,
               round(nullif(count(*) FILTER (WHERE items >= 2), 0)::DOUBLE / count(*), 6)
                   AS repeat_customer_rate,
               round(nullif(count(*) FILTER (WHERE orders >= 2), 0)::DOUBLE / count(*), 6)
                   AS repeat_customer_rate_orders,
               round(sum(ltv)::DOUBLE / count(ltv), 6) AS clv,
               round(sum(ltv)::DOUBLE / sum(orders), 6) AS avg_order_value
        FROM (SELECT customer_state, customer_key, sum(pv) AS ltv, sum(n) AS items, count(*) AS orders
              FROM (SELECT customer_state, customer_key, order_id, max(payment_value) AS pv,
                           count(*) AS n
                    FROM m_fact GROUP BY customer_state, customer_key, order_id)
              GROUP BY customer_state, customer_key)
        GROUP BY customer_state"""
    ),
    "me_seller_sla": _with(
        f"SELECT seller_id, {_ON_TIME.replace('on_time_rate', 'seller_sla')} FROM m_fact GROUP BY seller_id"
    ),
    "me_orders_delivered": _with(
        """
        SELECT coalesce(a.year, b.year) AS year, orders_delivered, total_orders
        FROM (SELECT d.year, count(DISTINCT order_id) AS orders_delivered
              FROM g_fact_orders f LEFT JOIN g_dim_date d ON f.delivery_date_key = d.date_key
              WHERE delivery_date_key IS NOT NULL GROUP BY d.year) a
        FULL JOIN (SELECT year, count(DISTINCT order_id) AS total_orders FROM m_fact GROUP BY year) b
          ON a.year IS NOT DISTINCT FROM b.year"""
    ),
    "me_implicit_sums": _with(
        """
        SELECT seller_state, sum(price)::DOUBLE AS sum_price,
               sum(freight_value)::DOUBLE AS sum_freight_value, sum(is_late)::BIGINT AS sum_is_late,
               sum(is_delivered)::BIGINT AS sum_is_delivered,
               sum(review_score)::DOUBLE AS sum_review_score,
               sum(delivery_days)::DOUBLE AS sum_delivery_days, sum(days_late)::DOUBLE AS sum_days_late
        FROM m_fact GROUP BY seller_state"""
    ),
    "me_revenue_by_category_filtered": _with(
        """
        SELECT product_category_english, sum(pv)::DOUBLE AS total_revenue, count(*) AS total_orders
        FROM (SELECT product_category_english, order_id, max(payment_value) AS pv FROM m_fact
              WHERE year IN (1996, 1997) AND is_delivered = 1 AND customer_state <> 'NATION_1'
              GROUP BY product_category_english, order_id)
        GROUP BY product_category_english"""
    ),
    "rl_seller": _with(_revenue("year", where="seller_state = 'NATION_1'")),
    "rl_pruned": _with(_revenue("year", where="seller_state = 'NATION_1' AND year = 1996")),
    "rl_region": _with(_revenue("year, customer_state", where="customer_state = 'NATION_1'")),
    "an_lag_vs_score": _with(
        """
        SELECT coalesce(band, 'all') AS band, count(*) AS n_items,
               round(avg(review_score), 6) AS avg_review_score,
               CASE WHEN band IS NULL THEN round(corr(days_late, review_score), 6) END
                   AS lag_score_corr
        FROM (SELECT *, CASE WHEN days_late < -7 THEN 'early by more than 7'
                             WHEN days_late < 0 THEN 'early by 1 to 7'
                             WHEN days_late = 0 THEN 'on the day'
                             WHEN days_late <= 7 THEN 'late by 1 to 7'
                             ELSE 'late by more than 7' END AS band
              FROM g_fact_orders WHERE days_late IS NOT NULL AND review_score IS NOT NULL)
        GROUP BY ROLLUP (band)"""
    ),
    "an_delay_by_state": _with(
        """
        SELECT customer_state, count(*) FILTER (WHERE is_late = 1) AS late_items,
               count(*) FILTER (WHERE is_delivered = 1) AS delivered_items,
               round(count(*) FILTER (WHERE is_late = 1)::DOUBLE
                     / nullif(count(*) FILTER (WHERE is_delivered = 1), 0), 6) AS delay_rate,
               round(avg(days_late) FILTER (WHERE is_late = 1), 6) AS avg_days_late
        FROM m_fact GROUP BY customer_state"""
    ),
    "an_seller_concentration": _with(
        """
        SELECT late_items, n_sellers,
               round(sum(n_sellers) OVER (ORDER BY late_items DESC)::DOUBLE
                     / sum(n_sellers) OVER (), 6) AS cum_seller_share,
               round(sum(n_sellers * late_items) OVER (ORDER BY late_items DESC)::DOUBLE
                     / sum(n_sellers * late_items) OVER (), 6) AS cum_late_share
        FROM (SELECT late_items, count(*) AS n_sellers
              FROM (SELECT seller_key, count(*) FILTER (WHERE is_late = 1) AS late_items
                    FROM g_fact_orders GROUP BY seller_key) GROUP BY late_items)"""
    ),
}


def _output(names: dict[str, str]) -> str:
    return ", ".join(f"CAST({c} AS {kind}) AS {c}" for c, kind in names.items())


# Output types of the compared results: dates as text, whole numbers that may be null as doubles.
_OUTPUT: dict[str, dict[str, str]] = {
    "in_incremental_orders": {"purchase_date": "VARCHAR"},
    "in_run_log": {"last_loaded_date": "VARCHAR"},
    "in_same_day_load": {"last_loaded_date": "VARCHAR"},
    "sv_orders": {"delivery_days": "DOUBLE", "days_late": "DOUBLE"},
    "sv_order_reviews": {"review_score": "DOUBLE"},
    "sv_customers": {"customer_zip_code_prefix": "DOUBLE"},
    "sv_stored_tables": {"customer_zip_code_prefix": "DOUBLE"},
    "sv_products": {"product_photos_qty": "DOUBLE"},
    "gd_dim_date": {"full_date": "VARCHAR", "year": "DOUBLE"},
    "gd_seller_stats": {"total_orders": "DOUBLE"},
    "gd_dim_customers_history": {"effective_start_date": "VARCHAR", "effective_end_date": "VARCHAR"},
    "gd_fact_asof": {"order_date": "VARCHAR", "effective_start_date": "VARCHAR", "price": "DOUBLE"},
    "gd_dim_sellers": {"total_orders": "DOUBLE"},
    "gd_latest_review": {"review_score": "DOUBLE"},
    "gd_fact_orders": {
        "delivery_date_key": "DOUBLE",
        "estimated_delivery_date_key": "DOUBLE",
        "review_score": "DOUBLE",
        "delivery_days": "DOUBLE",
        "days_late": "DOUBLE",
    },
    "me_revenue_by_year_state": {"year": "DOUBLE", "total_orders": "DOUBLE"},
    "me_totals": {"total_orders": "DOUBLE", "late_orders": "DOUBLE"},
    "me_delivery_by_state": {"late_orders": "DOUBLE"},
    "me_review_rolling_3m": {"year": "DOUBLE"},
    "me_review_rolling_daily": {"full_date": "VARCHAR"},
    "me_margins": {"year": "DOUBLE"},
    "me_distinct_from_sketches": {"year": "DOUBLE"},
    "me_revenue_yoy": {"year": "DOUBLE"},
    "me_orders_delivered": {
        "year": "DOUBLE", "orders_delivered": "DOUBLE", "total_orders": "DOUBLE"
    },
    "me_revenue_by_category_filtered": {"total_orders": "DOUBLE"},
    "rl_seller": {"year": "DOUBLE", "total_orders": "DOUBLE"},
    "rl_pruned": {"year": "DOUBLE", "total_orders": "DOUBLE"},
    "rl_region": {"year": "DOUBLE", "total_orders": "DOUBLE"},
}

_SQL["sv_managed_geolocation"] = _SQL["sv_geolocation"]
_SQL["gd_refreshed_rows"] = _with(
    """
    SELECT 'dim_date' AS table_name, strftime(d, '%Y%m%d') AS row_key, strftime(d, '%Y-%m-%d') AS first_value,
           year(d)::VARCHAR AS second_value
    FROM range(DATE '1995-01-01', DATE '2004-01-01', INTERVAL 1 DAY) r(d)
    UNION ALL SELECT 'dim_customers', customer_key, customer_city, customer_state FROM g_dim_customers
    UNION ALL SELECT 'dim_sellers', seller_key, seller_city, total_orders::VARCHAR FROM g_dim_sellers
    UNION ALL SELECT 'dim_products', product_key, product_category_english, product_weight_g::VARCHAR FROM g_dim_products
    UNION ALL SELECT 'fact_orders', order_item_key, order_id, payment_value::VARCHAR FROM g_fact_orders"""
)
_SQL["gd_fact_incremental"] = _SQL["gd_fact_orders"]
_OUTPUT["gd_fact_incremental"] = _OUTPUT["gd_fact_orders"]
_SQL["qc_from_footers"] = _SQL["qc_bronze"]
_SQL["qc_logged"] = _SQL["qc_silver"]
_SQL["qc_failures"] = (
    f"SELECT * FROM ({_SQL['qc_silver']}) WHERE NOT passed "
    f"UNION ALL BY NAME SELECT * FROM ({_SQL['qc_unique_item_key']}) WHERE NOT passed"
)
_SQL["gd_full_refresh"] = " UNION ALL ".join(
    [
        "SELECT 'dim_date' AS table_name, count(*) AS n_rows "
        "FROM range(DATE '1995-01-01', DATE '2004-01-01', INTERVAL 1 DAY)",
        *[
            f"SELECT '{t}', count(*) FROM ({_SQL[f'gd_{t}']})"
            for t in ("dim_customers", "dim_sellers", "dim_products", "fact_orders")
        ],
    ]
)

ORACLES: dict[str, str] = {
    name: f"SELECT * REPLACE ({_output(_OUTPUT[name])}) FROM ({sql})" if name in _OUTPUT else sql
    for name, sql in _SQL.items()
}
