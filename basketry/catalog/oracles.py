"""Independent ANSI SQL for every registered query, run over the whole raw tables.

Column names and types match ``queries``: amounts as DOUBLE, dates and times as
ISO text. Amounts are summed as DECIMAL and rounded half up, as in the library.
"""

from __future__ import annotations

# --- text helpers --------------------------------------------------------------


def _round(x: str, digits: int) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


def _ratio(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def _mean(a: str, b: str, digits: int) -> str:
    return _round(_ratio(a, b), digits)


def _pct(a: str, b: str, digits: int = 1) -> str:
    return _round(f"{_ratio(a, b)} * 100", digits)


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _sec(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _pick(values: tuple[str, ...], k: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {k} % {len(values)} {arms} END"


# --- the star-schema mapping in SQL ---------------------------------------------

TABLES: dict[str, str] = {
    "ord": """
        SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_orderdate AS ts, CAST(o_orderdate AS DATE) AS date,
               strftime(o_orderdate, '%Y-%m') AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS total,
               o_orderpriority AS payment_method,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' ELSE 'refunded' END AS status
        FROM orders""",
    "lin": f"""
        SELECT l_orderkey AS transaction_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS subtotal,
               CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS line_discount,
               CAST({_round('l_extendedprice / l_quantity', 2)} AS DECIMAL(18,2)) AS unit_price
        FROM lineitem""",
    "sales": """
        SELECT lin.*, ord.user_id, ord.date, ord.month, ord.total, ord.payment_method, ord.status
        FROM lin JOIN ord ON ord.transaction_id = lin.transaction_id""",
    "amt": """
        SELECT transaction_id, SUM(subtotal) AS subtotal, SUM(line_discount) AS discount FROM lin GROUP BY 1""",
    "txn": """
        SELECT ord.*, COALESCE(amt.subtotal, 0) AS subtotal, COALESCE(amt.discount, 0) AS discount
        FROM ord LEFT JOIN amt ON amt.transaction_id = ord.transaction_id""",
    "prod": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category_id, p_type || '/' || p_brand AS subcategory_id,
               CAST(p_retailprice AS DECIMAL(18,2)) AS base_price, p_size * 10 AS current_stock, p_size % 10 <> 0 AS is_active,
               p_type AS category, p_brand AS subcategory,
               CAST(0.05 * (1 + CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) % 8) AS DECIMAL(4,2)) AS profit_margin
        FROM part""",
    "usr": """
        SELECT c_custkey AS user_id, c_name AS name, n_name AS city, r_name AS province
        FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey = n_nationkey""",
    "reg": "SELECT user_id, MIN(ts) AS registration_date, strftime(MIN(ts), '%Y-%m') AS cohort FROM ord GROUP BY 1",
    "tot": f"""
        SELECT user_id, COUNT(*) AS total_orders, SUM(total) AS total_spent, {_mean('SUM(total)', 'COUNT(*)', 2)} AS avg_order_value
        FROM ord GROUP BY 1""",
    "usert": """
        SELECT usr.*, COALESCE(total_orders, 0) AS total_orders, COALESCE(total_spent, 0) AS total_spent,
               COALESCE(avg_order_value, 0.0) AS avg_order_value
        FROM usr LEFT JOIN tot ON tot.user_id = usr.user_id""",
    "tier": """
        SELECT *, CASE WHEN total_orders = 0 THEN 'Inactive' WHEN total_spent >= 2500000 THEN 'VIP'
                       WHEN total_spent >= 1500000 THEN 'Regular' ELSE 'Low' END AS tier
        FROM usert""",
    "ev": """
        SELECT event_id, user_id, ts, event_type, CAST(value AS DECIMAL(18,2)) AS value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
               user_id || '-' || strftime(ts, '%Y%m%d') AS session_id
        FROM events""",
    "agg": """
        SELECT session_id, MIN(user_id) AS user_id, MIN(ts) AS start_time, MAX(ts) AS end_time, COUNT(*) AS page_views,
               COUNT(*) FILTER (WHERE event_type = 'view') AS viewed_products,
               COUNT(*) FILTER (WHERE event_type = 'click') AS cart_items,
               COUNT(*) FILTER (WHERE event_type = 'purchase') AS bought, FIRST(k ORDER BY event_id) AS k
        FROM ev GROUP BY session_id""",
    "sess": f"""
        SELECT session_id, user_id, start_time, end_time,
               (epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS duration_seconds,
               page_views, viewed_products, cart_items,
               CASE WHEN cart_items > 0 AND bought > 0 THEN 'converted' WHEN cart_items > 0 THEN 'abandoned'
                    ELSE 'browsing' END AS conversion_status,
               {_pick(('direct', 'search_engine', 'social_media', 'email', 'affiliate'), 'k')} AS referrer,
               {_pick(('desktop', 'mobile', 'tablet'), 'k')} AS device_type,
               {_pick(('Windows', 'macOS', 'Android', 'iOS'), 'k')} AS device_os,
               {_pick(('Chrome', 'Firefox', 'Safari', 'Edge', 'Opera', 'Brave'), 'k')} AS browser,
               'NATION_' || (k % 25) AS city,
               {_pick(('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'), 'k')} AS province, 'Earth' AS country,
               hour(start_time) AS hour
        FROM agg""",
    "pv": """
        SELECT session_id, event_id AS view_id, event_type AS page_type, value AS view_duration, ts,
               CASE WHEN event_type IN ('view', 'click') THEN k END AS product_id, CAST(ts AS DATE) AS date
        FROM ev""",
    "cart": """
        SELECT session_id, k AS product_id, COUNT(*) AS quantity, MIN(value) AS price
        FROM ev WHERE event_type = 'click' GROUP BY 1, 2""",
    "ctot": """
        SELECT session_id, SUM(quantity * price) AS cart_total, SUM(quantity) AS cart_quantity FROM cart GROUP BY 1""",
    "bought": """
        SELECT session_id, SUM(value) AS purchase_amount, COUNT(*) AS items_purchased
        FROM ev WHERE event_type = 'purchase' GROUP BY 1""",
    "price": "SELECT product_id, date, MAX(unit_price) AS price FROM sales GROUP BY 1, 2",
    "daily": f"""
        SELECT product_id, date, SUM(quantity) AS total_quantity, SUM(subtotal) AS total_revenue,
               COUNT(*) AS num_transactions, {_mean('SUM(unit_price)', 'COUNT(*)', 2)} AS avg_unit_price
        FROM sales GROUP BY 1, 2""",
    "metric": """
        SELECT daily.*, COALESCE(current_stock, 0) AS current_stock, COALESCE(base_price, 0) AS base_price,
               COALESCE(is_active, FALSE) AS is_active
        FROM daily LEFT JOIN prod ON prod.product_id = daily.product_id""",
    "ps": """
        SELECT product_id, SUM(subtotal) AS revenue, SUM(quantity) AS quantity, COUNT(*) AS orders, SUM(unit_price) AS prices
        FROM lin GROUP BY 1""",
    "pstat": """
        SELECT ps.*, COALESCE(name, CAST(ps.product_id AS VARCHAR)) AS product_name, COALESCE(category, 'Unknown') AS category,
               COALESCE(subcategory, 'Unknown') AS subcategory, COALESCE(profit_margin, 0) AS profit_margin
        FROM ps LEFT JOIN prod ON prod.product_id = ps.product_id""",
    "done": """
        SELECT category, subcategory, SUM(subtotal) AS revenue, SUM(quantity) AS qty_sold, COUNT(*) AS order_count
        FROM sales JOIN prod ON prod.product_id = sales.product_id WHERE status = 'completed' GROUP BY 1, 2""",
    "subrev": """
        SELECT category, subcategory, MAX(profit_margin) AS profit_margin, SUM(revenue) AS revenue FROM pstat GROUP BY 1, 2""",
    "basket": "SELECT DISTINCT transaction_id, product_id FROM lin",
    "pair": """
        SELECT a.product_id AS product_a, b.product_id AS product_b, COUNT(*) AS co_purchase_count
        FROM basket a JOIN basket b ON a.transaction_id = b.transaction_id AND a.product_id < b.product_id GROUP BY 1, 2""",
    "mirror": """
        SELECT product_a AS source_product, product_b AS recommended_product, co_purchase_count FROM pair
        UNION ALL SELECT product_b, product_a, co_purchase_count FROM pair""",
    "rec": """
        SELECT source_product, s.name AS source_name, recommended_product, t.name AS rec_name, co_purchase_count
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY source_product
                     ORDER BY co_purchase_count DESC, recommended_product) AS rn FROM mirror) m
        JOIN prod s ON s.product_id = source_product JOIN prod t ON t.product_id = recommended_product WHERE rn <= 3""",
    "coh": """
        SELECT ord.transaction_id, ord.user_id, cohort, month AS txn_month,
               CAST(date_diff('month', date_trunc('month', registration_date), date_trunc('month', date)) AS INTEGER) AS months_since_reg,
               total
        FROM ord JOIN reg ON reg.user_id = ord.user_id""",
    "cell": """
        SELECT cohort, months_since_reg, SUM(total) AS revenue, COUNT(DISTINCT user_id) AS active_users FROM coh GROUP BY 1, 2""",
    "cal": """
        SELECT COALESCE(cohort, 'Unknown') AS cohort_month, month AS activity_month, SUM(subtotal) AS revenue
        FROM sales LEFT JOIN reg ON reg.user_id = sales.user_id GROUP BY 1, 2""",
    "txm": f"""
        SELECT user_id, COUNT(*) AS txn_count, SUM(total) AS txn_total_spent, {_ratio('SUM(total)', 'COUNT(*)')} AS txn_avg_value,
               MIN(ts) AS first_txn_date, MAX(ts) AS last_txn_date,
               CAST(date_diff('day', CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE)) AS INTEGER) AS lifespan_days
        FROM ord GROUP BY 1""",
    "txf": """
        SELECT *, CASE WHEN lifespan_days > 0 THEN CAST(txn_count AS DOUBLE) / lifespan_days * 365.0
                       ELSE CAST(txn_count AS DOUBLE) END AS purchase_frequency
        FROM txm""",
    "sem": f"""
        SELECT user_id, COUNT(*) AS session_count, SUM(duration_seconds) AS total_session_time,
               COUNT(*) FILTER (WHERE conversion_status = 'converted') AS converted_sessions,
               {_ratio('SUM(duration_seconds)', 'COUNT(*)')} AS avg_session_duration,
               {_ratio("COUNT(*) FILTER (WHERE conversion_status = 'converted')", 'COUNT(*)')} AS session_conversion_rate
        FROM sess GROUP BY 1""",
    "val": f"""
        SELECT usr.*, COALESCE(txn_count, 0) AS txn_count, COALESCE(txn_total_spent, 0) AS txn_total_spent,
               COALESCE(txn_avg_value, 0) AS txn_avg_value, first_txn_date, last_txn_date,
               COALESCE(lifespan_days, 0) AS lifespan_days, COALESCE(purchase_frequency, 0) AS purchase_frequency,
               COALESCE(session_count, 0) AS session_count, COALESCE(total_session_time, 0) AS total_session_time,
               COALESCE(converted_sessions, 0) AS converted_sessions, COALESCE(avg_session_duration, 0) AS avg_session_duration,
               COALESCE(session_conversion_rate, 0) AS session_conversion_rate,
               COALESCE(txn_count, 0) AS total_orders, COALESCE(txn_total_spent, 0) AS total_spent,
               COALESCE({_round('txn_avg_value', 2)}, 0) AS avg_order_value
        FROM usr LEFT JOIN txf ON txf.user_id = usr.user_id LEFT JOIN sem ON sem.user_id = usr.user_id""",
    "clv": """
        SELECT *, CASE WHEN estimated_clv >= 1200000 THEN 'Platinum' WHEN estimated_clv >= 900000 THEN 'Gold'
                       WHEN estimated_clv >= 600000 THEN 'Silver' ELSE 'Bronze' END AS clv_tier
        FROM (SELECT *, avg_order_value * purchase_frequency * 2.0 AS estimated_clv FROM val)""",
    "flag": """
        SELECT session_id, user_id, start_time, duration_seconds, conversion_status, referrer, device_type, device_os,
               TRUE AS stage_browse, viewed_products > 0 AS stage_view_product, cart_items > 0 AS stage_add_to_cart,
               conversion_status = 'converted' AS stage_purchase, hour AS hour_of_day,
               CASE WHEN hour BETWEEN 6 AND 11 THEN 'morning' WHEN hour BETWEEN 12 AND 17 THEN 'afternoon'
                    WHEN hour BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day
        FROM sess""",
    "owi": "SELECT * FROM ord WHERE transaction_id IN (SELECT transaction_id FROM lin)",
    "day": "SELECT date, SUM(subtotal) AS revenue FROM sales GROUP BY 1",
    "catrev": "SELECT category, SUM(revenue) AS revenue FROM pstat GROUP BY 1",
    "mon": "SELECT month, SUM(subtotal) AS revenue, COUNT(*) AS order_lines FROM sales GROUP BY 1",
}

# Tables each table reads; stated so that only the needed ones enter a statement.
NEEDS: dict[str, tuple[str, ...]] = {
    "sales": ("lin", "ord"), "amt": ("lin",), "txn": ("ord", "amt"), "reg": ("ord",), "tot": ("ord",), "usert": ("usr", "tot"),
    "tier": ("usert",), "agg": ("ev",), "sess": ("agg",), "pv": ("ev",), "cart": ("ev",), "ctot": ("cart",), "bought": ("ev",),
    "price": ("sales",), "daily": ("sales",), "metric": ("daily", "prod"), "ps": ("lin",), "pstat": ("ps", "prod"),
    "done": ("sales", "prod"), "subrev": ("pstat",), "basket": ("lin",), "pair": ("basket",), "mirror": ("pair",),
    "rec": ("mirror", "prod"), "coh": ("ord", "reg"), "cell": ("coh",), "cal": ("sales", "reg"), "txm": ("ord",), "txf": ("txm",),
    "sem": ("sess",), "val": ("usr", "txf", "sem"), "clv": ("val",), "flag": ("sess",), "owi": ("ord", "lin"), "day": ("sales",),
    "catrev": ("pstat",), "mon": ("sales",),
}


def _with(tables: str, select: str) -> str:
    """Statement with the named tables and whatever they read, in order."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in NEEDS.get(name, ()):
            visit(other)
        if name not in needed:
            needed.append(name)

    for name in tables.split():
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed) + "\n" + select


CONV = "COUNT(*) FILTER (WHERE conversion_status = 'converted')"
VIEWED = "COUNT(*) FILTER (WHERE viewed_products > 0)"
CARTED = "COUNT(*) FILTER (WHERE cart_items > 0)"
ABAND = "COUNT(*) FILTER (WHERE conversion_status = 'abandoned')"


def _load_and_profile() -> dict[str, str]:
    dup = "total_rows - distinct_keys"
    check = f"""SELECT total_rows, distinct_keys, {dup} AS duplicates,
        CASE WHEN {dup} = 0 THEN 'OK' ELSE 'DUPLICATES' END AS verdict
        FROM (SELECT COUNT(*) AS total_rows, COUNT(DISTINCT transaction_id) AS distinct_keys FROM """
    return {
        "users_from_json": _with("usr reg", f"""SELECT CAST(usr.user_id AS VARCHAR) AS user_id, name, city, province,
            {_sec('registration_date')} AS registration_date FROM usr LEFT JOIN reg ON reg.user_id = usr.user_id"""),
        "subcategories_from_json": _with("prod", f"""SELECT DISTINCT category_id, category AS category_name, subcategory_id,
            subcategory AS subcategory_name, {_dbl('profit_margin')} AS profit_margin FROM prod"""),
        "clean_products": _with("prod", "SELECT product_id, name, current_stock, is_active FROM prod"),
        "subcategories": _with("prod", f"""SELECT DISTINCT category_id, category AS category_name, subcategory_id,
            subcategory AS subcategory_name, {_dbl('profit_margin')} AS profit_margin FROM prod"""),
        "null_profile": _with("pv", """SELECT 'product_id' AS column_name, COUNT(*) AS null_count
            FROM pv WHERE product_id IS NULL"""),
        "duplicate_key_check_lines": _with("lin", check + "lin)"),
        "duplicate_key_check_orders": _with("ord", check + "ord)"),
        "row_counts": """SELECT 'users' AS table_name, COUNT(*) AS row_count FROM customer
            UNION ALL SELECT 'products', COUNT(*) FROM part UNION ALL SELECT 'orders', COUNT(*) FROM orders
            UNION ALL SELECT 'items', COUNT(*) FROM lineitem UNION ALL SELECT 'page_views', COUNT(*) FROM events""",
        "table_stats": _with("sess", """SELECT COUNT(*) AS row_count,
            MIN(user_id || '_' || (9999999999999 - epoch_us(start_time) // 1000)) AS sample_key,
            'row_key,session_id,user_id,start_time,end_time,duration_seconds,conversion_status,referrer,device_type,device_os,device_browser,geo_city,geo_state,geo_country,activity' AS column_names
            FROM sess"""),
    }


def _denormalise() -> dict[str, str]:
    return {
        "products_enriched": _with("prod", f"""SELECT product_id, name, {_dbl('base_price')} AS base_price, current_stock, is_active,
            category_id, category AS category_name, subcategory_id, subcategory AS subcategory_name,
            {_dbl('profit_margin')} AS profit_margin FROM prod"""),
        "purchase_summary": _with("ord", f"""SELECT t.user_id, total_orders, {_dbl('total_spent')} AS total_spent, avg_order_value,
            {_sec('first_ts')} AS first_purchase, {_sec('last_ts')} AS last_purchase, payment_method AS favorite_payment_method
            FROM (SELECT user_id, COUNT(*) AS total_orders, SUM(total) AS total_spent,
                         {_mean('SUM(total)', 'COUNT(*)', 2)} AS avg_order_value, MIN(ts) AS first_ts, MAX(ts) AS last_ts
                  FROM ord GROUP BY 1) t
            JOIN (SELECT user_id, payment_method, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, payment_method) AS rn
                  FROM ord GROUP BY 1, 2) m ON m.user_id = t.user_id AND rn = 1"""),
        "users_enriched": _with("ord usr", f"""SELECT usr.user_id, name, city, province, COALESCE(total_orders, 0) AS total_orders,
            COALESCE({_dbl('total_spent')}, 0) AS total_spent, COALESCE(avg_order_value, 0) AS avg_order_value,
            {_sec('first_ts')} AS first_purchase, {_sec('last_ts')} AS last_purchase, payment_method AS favorite_payment_method
            FROM usr LEFT JOIN (SELECT user_id, COUNT(*) AS total_orders, SUM(total) AS total_spent,
                         {_mean('SUM(total)', 'COUNT(*)', 2)} AS avg_order_value, MIN(ts) AS first_ts, MAX(ts) AS last_ts
                  FROM ord GROUP BY 1) t ON t.user_id = usr.user_id
            LEFT JOIN (SELECT user_id, payment_method, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, payment_method) AS rn
                  FROM ord GROUP BY 1, 2) m ON m.user_id = usr.user_id AND rn = 1"""),
        "product_daily_metrics": _with("metric", f"""SELECT product_id, {_day('date')} AS date, {_big('total_quantity')} AS total_quantity,
            {_dbl('total_revenue')} AS total_revenue, num_transactions, avg_unit_price, current_stock,
            {_dbl('base_price')} AS base_price, is_active FROM metric"""),
        "sessions_flat": _with("sess", f"""SELECT user_id || '_' || (9999999999999 - epoch_us(start_time) // 1000) AS row_key, session_id, user_id,
            {_sec('start_time')} AS start_time, {_sec('end_time')} AS end_time, duration_seconds, conversion_status, referrer,
            device_type, device_os, browser AS device_browser, city AS geo_city, province AS geo_state, country AS geo_country,
            '{{"page_views":' || page_views || ',"viewed_products":' || viewed_products || ',"cart_items":' || cart_items || '}}' AS activity
            FROM sess"""),
        "txn_lines": _with("lin txn prod", f"""SELECT {_day('txn.date')} AS date, user_id, lin.transaction_id, lin.product_id,
            COALESCE(name, CAST(lin.product_id AS VARCHAR)) AS product_name, COALESCE(category, 'Unknown') AS category,
            COALESCE(subcategory, 'Unknown') AS subcategory, {_dbl('COALESCE(profit_margin, 0)')} AS profit_margin, quantity,
            {_dbl('unit_price')} AS unit_price, {_dbl('lin.subtotal')} AS subtotal, {_dbl('total')} AS total,
            {_dbl('txn.discount')} AS discount, payment_method, status
            FROM lin JOIN txn ON txn.transaction_id = lin.transaction_id LEFT JOIN prod ON prod.product_id = lin.product_id"""),
        "users_flat": _with("usert reg", f"""SELECT usert.user_id, name, COALESCE(province, 'Unknown') AS province,
            COALESCE(city, 'Unknown') AS city, {_sec('registration_date')} AS registration_date, total_orders,
            {_dbl('total_spent')} AS total_spent, avg_order_value FROM usert LEFT JOIN reg ON reg.user_id = usert.user_id"""),
        "sessions_summary": _with("sess", f"""SELECT session_id, user_id, {_sec('start_time')} AS start_time, duration_seconds,
            conversion_status, referrer, device_type, device_os, browser, city, province, viewed_products, cart_items,
            {_day('start_time')} AS date, CAST(hour AS INTEGER) AS hour FROM sess"""),
        "page_views": _with("pv", f"""SELECT session_id, view_id, page_type, {_dbl('view_duration')} AS view_duration,
            {_sec('ts')} AS timestamp, CAST(product_id AS VARCHAR) AS product_id, {_day('date')} AS date FROM pv"""),
        "cart_lines": _with("cart sess prod", f"""SELECT cart.session_id, cart.product_id,
            COALESCE(name, CAST(cart.product_id AS VARCHAR)) AS product_name, COALESCE(category, 'Unknown') AS category, quantity,
            {_dbl('price')} AS price, {_dbl('quantity * price')} AS line_total, conversion_status
            FROM cart JOIN sess ON sess.session_id = cart.session_id LEFT JOIN prod ON prod.product_id = cart.product_id"""),
        "price_history": _with("price prod", f"""SELECT price.product_id, COALESCE(name, CAST(price.product_id AS VARCHAR)) AS product_name,
            {_dbl('price')} AS price, {_day('date')} AS date FROM price LEFT JOIN prod ON prod.product_id = price.product_id"""),
    }


def _commerce() -> dict[str, str]:
    daily = _with("ord", f"""SELECT {_day('sale_date')} AS sale_date, num_transactions, {_dbl('rev')} AS daily_revenue,
        {_round('CAST(SUM(rev) OVER w7 AS DOUBLE) / COUNT(*) OVER w7', 2)} AS moving_avg_7d,
        {_dbl('SUM(rev) OVER (ORDER BY sale_date ROWS UNBOUNDED PRECEDING)')} AS cumulative_revenue
        FROM (SELECT date AS sale_date, COUNT(*) AS num_transactions, SUM(total) AS rev FROM ord GROUP BY 1)
        WINDOW w7 AS (ORDER BY sale_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
    report = f"""{_dbl('SUM(total)')} AS total_revenue, COUNT(*) AS txn_count, {_mean('SUM(total)', 'COUNT(*)', 2)} AS avg_order_value,
        {_dbl('ROUND(SUM(discount), 2)')} AS total_discount, {_pct('SUM(discount)', 'SUM(subtotal)', 2)} AS discount_rate"""

    def spread(total: str, squares: str, kind: str = "DECIMAL(18,2)") -> str:
        return _round(f"sqrt(CAST(n * {squares} - CAST({total} AS {kind}) * {total} AS DOUBLE) / NULLIF(CAST(n * (n - 1) AS DOUBLE), 0))", 2)

    return {
        "materialised_daily_revenue": daily,
        "daily_revenue": daily,
        "product_popularity": _with("sales prod", f"""SELECT t.product_id, name, category, total_qty, total_revenue, num_orders FROM (
            SELECT product_id, {_big('SUM(quantity)')} AS total_qty, {_dbl('SUM(subtotal)')} AS total_revenue, COUNT(*) AS num_orders
            FROM sales WHERE status = 'completed' GROUP BY 1 ORDER BY total_qty DESC, product_id LIMIT 10) t
            JOIN prod ON prod.product_id = t.product_id"""),
        "revenue_by_category": _with("done", f"""SELECT category, {_dbl('SUM(revenue)')} AS total_revenue,
            {_big('SUM(qty_sold)')} AS total_qty, {_big('SUM(order_count)')} AS total_orders,
            {_mean('SUM(revenue)', 'SUM(order_count)', 2)} AS avg_order_value,
            string_agg(subcategory || '=' || CAST(CAST(revenue AS DECIMAL(18,2)) AS VARCHAR) || '=' || CAST(qty_sold AS VARCHAR), ';'
                       ORDER BY revenue DESC, subcategory) AS subcategories FROM done GROUP BY 1"""),
        "revenue_by_subcategory": _with("done", f"""SELECT category, subcategory, {_dbl('revenue')} AS revenue,
            {_big('qty_sold')} AS qty_sold, order_count FROM done"""),
        "spending_tiers": _with("usert", f"""SELECT tier, COUNT(*) AS count, {_mean('SUM(total_spent)', 'COUNT(*)', 2)} AS avg_spent,
            {_dbl('SUM(total_spent)')} AS total_spent, {_mean('SUM(total_orders)', 'COUNT(*)', 1)} AS avg_orders
            FROM (SELECT *, CASE WHEN total_spent >= 0 AND total_spent < 1 THEN 'Inactive'
                WHEN total_spent >= 1 AND total_spent < 1000000 THEN 'Low' WHEN total_spent >= 1000000 AND total_spent < 2000000 THEN 'Regular'
                WHEN total_spent >= 2000000 AND total_spent < 3000000 THEN 'High'
                WHEN total_spent >= 3000000 AND total_spent < 4000000 THEN 'VIP' ELSE 'Other' END AS tier FROM usert) GROUP BY 1"""),
        "spending_by_province": _with("usert", f"""SELECT province, COUNT(*) AS user_count,
            {_mean('SUM(total_spent)', 'COUNT(*)', 2)} AS avg_spent, {_dbl('SUM(total_spent)')} AS total_spent,
            {_mean('SUM(total_orders)', 'COUNT(*)', 1)} AS avg_orders FROM usert WHERE total_orders > 0 GROUP BY 1"""),
        "monthly_revenue": _with("txn", f"SELECT month, {report} FROM txn WHERE status = 'completed' GROUP BY 1"),
        "payment_methods": _with("txn", f"""SELECT payment_method, {report}, COUNT(DISTINCT user_id) AS unique_users
            FROM txn WHERE status = 'completed' GROUP BY 1"""),
        "top_products": _with("pstat", f"""SELECT product_id, product_name, category AS category_name, subcategory AS subcategory_name,
            {_dbl('profit_margin')} AS profit_margin, orders AS times_sold, {_big('quantity')} AS units_sold,
            {_dbl('revenue')} AS total_revenue, {_dbl('ROUND(CAST(revenue AS DECIMAL(18,2)) * profit_margin, 2)')} AS est_profit
            FROM pstat ORDER BY revenue DESC, product_id LIMIT 15"""),
        "price_variability": _with("daily prod", f"""SELECT *, CASE WHEN price_stddev > 0 AND mean_daily_units > 0 THEN
            {_round('(units_stddev / mean_daily_units) / (price_stddev / NULLIF(mean_price, 0))', 3)} END AS price_variability_ratio
            FROM (SELECT s.product_id, name AS product_name, {_dbl('base_price')} AS base_price,
                {_mean('p', 'n', 2)} AS mean_price, {spread('p', 'pp')} AS price_stddev, {_mean('u', 'n', 2)} AS mean_daily_units,
                {spread('u', 'uu', 'HUGEINT')} AS units_stddev, {_big('u')} AS total_units, n AS active_days
                FROM (SELECT product_id, COUNT(*) AS n, SUM(u) AS u, SUM(CAST(u AS HUGEINT) * u) AS uu, SUM(p) AS p, SUM(p * p) AS pp
                      FROM (SELECT product_id, CAST(total_quantity AS BIGINT) AS u, CAST(avg_unit_price AS DECIMAL(18,2)) AS p FROM daily)
                      GROUP BY 1 HAVING COUNT(*) >= 3) s
                JOIN prod ON prod.product_id = s.product_id) ORDER BY total_units DESC, product_id LIMIT 20"""),
    }


def _lookup_and_recommend() -> dict[str, str]:
    return {
        "user_sessions": _with("sess", f"""SELECT session_id, user_id, {_sec('start_time')} AS start_time, {_sec('end_time')} AS end_time,
            duration_seconds, conversion_status, referrer, device_type, device_os, browser, city, province, country, viewed_products, cart_items
            FROM (SELECT * FROM sess WHERE user_id = 7 ORDER BY sess.start_time DESC, session_id LIMIT 10)"""),
        "stored_user_sessions": _with("sess", f"""SELECT session_id, user_id, {_sec('start_time')} AS start_time, {_sec('end_time')} AS end_time,
            duration_seconds, conversion_status, referrer, device_type, device_os, browser, city, province, country, viewed_products, cart_items
            FROM (SELECT * FROM sess WHERE user_id = 7 ORDER BY sess.start_time DESC, session_id LIMIT 10)"""),
        "sessions_by_key": _with("sess", """SELECT user_id || '_' || (9999999999999 - epoch_us(start_time) // 1000) AS row_key, session_id,
            conversion_status, duration_seconds, CAST(user_id AS VARCHAR) AS user_id FROM sess ORDER BY 1, 2 LIMIT 25"""),
        "stored_sessions_by_key": _with("sess", """SELECT user_id || '_' || (9999999999999 - epoch_us(start_time) // 1000) AS row_key, session_id,
            conversion_status, duration_seconds, CAST(user_id AS VARCHAR) AS user_id FROM sess ORDER BY 1, 2 LIMIT 25"""),
        "recent_sessions": _with("sess", f"""SELECT session_id, user_id, {_sec('s.start_time')} AS start_time, conversion_status, duration_seconds
            FROM sess s ORDER BY s.start_time DESC, session_id LIMIT 25"""),
        "product_metrics_for": _with("metric", f"""SELECT product_id, {_day('date')} AS date, {_big('total_quantity')} AS total_quantity,
            {_dbl('total_revenue')} AS total_revenue, num_transactions, avg_unit_price, current_stock, {_dbl('base_price')} AS base_price,
            is_active FROM metric WHERE product_id = 42"""),
        "product_metrics_summary": _with("metric", f"""SELECT COUNT(*) AS days, {_big('SUM(total_quantity)')} AS total_units,
            {_dbl('SUM(total_revenue)')} AS total_revenue FROM metric WHERE product_id = 42"""),
        "co_purchase_pairs": _with("pair", "SELECT * FROM pair"),
        "top_pairs": _with("pair prod", """SELECT product_a, a.name AS product_a_name, product_b, b.name AS product_b_name, co_purchase_count
            FROM (SELECT * FROM pair ORDER BY co_purchase_count DESC, product_a, product_b LIMIT 20) t
            JOIN prod a ON a.product_id = product_a JOIN prod b ON b.product_id = product_b"""),
        "also_bought": _with("rec", "SELECT * FROM rec"),
        "search_recommendations": _with("rec", """SELECT * FROM rec
            WHERE contains(lower(source_name), 'ring') OR contains(lower(rec_name), 'ring')"""),
        "product_search": """SELECT needle, p_partkey AS product_id
            FROM (VALUES (''), ('g'), ('RI'), ('ing'), ('d Bolt'), ('small widget'), ('ringring')) v(needle) JOIN part ON contains(lower(p_name), lower(needle))""",
    }


def _cohort() -> dict[str, str]:
    def matrix(table: str, key: str, period: str, value: str) -> str:
        return _with(table, f"""SELECT {key}, CAST(COUNT(*) AS INTEGER) AS cells, string_agg(CAST({period} AS VARCHAR) || '='
            || CAST(CAST({value} AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY {period}) AS {value} FROM {table} GROUP BY 1""")

    return {
        "cohort_activity": _with("coh", f"SELECT * REPLACE ({_dbl('total')} AS total) FROM coh"),
        "cohort_spending": _with("cell", f"SELECT cohort, months_since_reg, {_dbl('revenue')} AS revenue FROM cell"),
        "cohort_spending_matrix": matrix("cell", "cohort", "months_since_reg", "revenue"),
        "cohort_summary": _with("coh", f"""SELECT cohort, COUNT(DISTINCT user_id) AS active_users, COUNT(*) AS total_transactions,
            {_dbl('SUM(total)')} AS total_revenue, {_mean('SUM(total)', 'COUNT(*)', 2)} AS avg_order_value FROM coh GROUP BY 1"""),
        "cohort_retention": _with("cell", "SELECT cohort, months_since_reg, active_users FROM cell"),
        "cohort_retention_matrix": matrix("cell", "cohort", "months_since_reg", "active_users"),
        "cohort_retention_pct": _with("cell reg", f"""SELECT cell.cohort, months_since_reg, cohort_size,
            {_pct('active_users', 'cohort_size')} AS retention_pct
            FROM cell JOIN (SELECT cohort, COUNT(*) AS cohort_size FROM reg GROUP BY 1) s ON s.cohort = cell.cohort"""),
        "cohort_spending_calendar": _with("cal", f"SELECT cohort_month, activity_month, {_dbl('revenue')} AS revenue FROM cal"),
        "cohort_spending_calendar_matrix": matrix("cal", "cohort_month", "activity_month", "revenue"),
    }


def _lifetime() -> dict[str, str]:
    def avg(figure: str, digits: int, factor: str = "1.0") -> str:
        """Mean of values rounded to four decimals, summed as whole numbers."""
        units = f"SUM(CAST(floor(CAST({figure} AS DOUBLE) * 10000.0 + 0.5) AS HUGEINT))"
        return _round(f"CAST({units} AS DOUBLE) / (COUNT(*) * 10000.0) * {factor}", digits)

    return {
        "txn_metrics": _with("txf", f"""SELECT user_id, txn_count, {_dbl('txn_total_spent')} AS txn_total_spent, txn_avg_value,
            {_sec('first_txn_date')} AS first_txn_date, {_sec('last_txn_date')} AS last_txn_date, lifespan_days, purchase_frequency FROM txf"""),
        "session_metrics": _with("sem", f"""SELECT user_id, session_count, {_big('total_session_time')} AS total_session_time,
            converted_sessions, avg_session_duration, session_conversion_rate FROM sem"""),
        "clv": _with("clv", f"""SELECT * REPLACE ({_dbl('txn_total_spent')} AS txn_total_spent, {_dbl('total_spent')} AS total_spent,
            {_big('total_session_time')} AS total_session_time,
            {_sec('first_txn_date')} AS first_txn_date, {_sec('last_txn_date')} AS last_txn_date) FROM clv"""),
        "clv_tier_summary": _with("clv", f"""SELECT clv_tier, COUNT(*) AS num_customers, {avg('estimated_clv', 2)} AS avg_clv,
            {_mean('SUM(total_spent)', 'COUNT(*)', 2)} AS avg_total_spent, {avg('session_count', 1)} AS avg_sessions,
            {avg('avg_session_duration', 1)} AS avg_session_sec,
            {avg('session_conversion_rate', 1, '100.0')} AS avg_conv_rate_pct FROM clv GROUP BY 1"""),
        "top_customers_by_clv": _with("clv", f"""SELECT user_id, name, province, {_round('c.estimated_clv', 2)} AS estimated_clv,
            {_dbl('total_spent')} AS total_spent, total_orders, session_count, {_round('avg_session_duration', 0)} AS avg_session_sec,
            {_round('session_conversion_rate', 3)} AS conv_rate FROM clv c ORDER BY c.estimated_clv DESC, user_id LIMIT 10"""),
        "engagement_by_tier": _with("clv", f"""SELECT clv_tier, {avg('session_count', 1)} AS avg_sessions,
            {avg('total_session_time', 0)} AS avg_total_time_sec, {avg('avg_session_duration', 0)} AS avg_duration_sec,
            {avg('session_conversion_rate', 1, '100.0')} AS conv_rate_pct,
            {avg('purchase_frequency', 1)} AS annualized_freq FROM clv GROUP BY 1"""),
        "clv_by_province": _with("clv", f"""SELECT province, COUNT(*) AS num_customers, {avg('estimated_clv', 2)} AS avg_clv,
            {_dbl('SUM(total_spent)')} AS total_revenue FROM clv GROUP BY 1"""),
    }


def _funnel() -> dict[str, str]:
    v, c, p = (f"COUNT(*) FILTER (WHERE {s})" for s in ("stage_view_product", "stage_add_to_cart", "stage_purchase"))

    def by(dim: str) -> str:
        return f"""SELECT {dim}, COUNT(*) AS total_sessions, {v} AS viewed, {c} AS added_to_cart, {p} AS purchased,
            {_pct(v, 'COUNT(*)')} AS view_rate_pct, {_pct(c, 'COUNT(*)')} AS cart_rate_pct,
            {_pct(p, 'COUNT(*)')} AS purchase_rate_pct FROM flag GROUP BY 1"""

    stages = [("Browse", "n", "n"), ("View Product", "v", "n"), ("Add to Cart", "c", "v"), ("Purchase", "p", "c")]
    stage_rows = " UNION ALL ".join(
        f"""SELECT '{name}' AS stage, {x} AS count, COALESCE({_pct(x, 'n')}, 0) AS pct_of_total,
        COALESCE({_pct(x, before)}, 0) AS pct_of_prev FROM t""" for name, x, before in stages)
    device = f"""total_sessions, viewed_products, added_to_cart, converted, {_pct('viewed_products', 'total_sessions')} AS viewed_pct,
        {_pct('added_to_cart', 'total_sessions')} AS cart_pct, {_pct('converted', 'total_sessions')} AS converted_pct
        FROM (SELECT {{key}} COUNT(*) AS total_sessions, {VIEWED} AS viewed_products, {CARTED} AS added_to_cart, {CONV} AS converted
              FROM sess {{group}})"""
    title = "upper(substr(device_type, 1, 1)) || substr(device_type, 2)"
    return {
        "funnel_flags": _with("flag", f"""SELECT * REPLACE ({_sec('start_time')} AS start_time, CAST(hour_of_day AS INTEGER) AS hour_of_day)
            FROM flag"""),
        "session_purchases": _with("flag bought", f"""SELECT flag.session_id, conversion_status,
            COALESCE({_dbl('purchase_amount')}, 0) AS purchase_amount, COALESCE(items_purchased, 0) AS items_purchased
            FROM flag LEFT JOIN bought ON bought.session_id = flag.session_id"""),
        "funnel_stages": _with("flag", f"SELECT * FROM (WITH t AS (SELECT COUNT(*) AS n, {v} AS v, {c} AS c, {p} AS p FROM flag) {stage_rows})"),
        "funnel_by_device_type": _with("flag", by("device_type")),
        "funnel_by_referrer": _with("flag", by("referrer")),
        "funnel_by_time_of_day": _with("flag", by("time_of_day")),
        "funnel_rates_long": _with("flag", " UNION ALL ".join(
            f"SELECT device_type, '{name}' AS stage, {_pct(x, 'COUNT(*)')} AS rate FROM flag GROUP BY 1"
            for name, x in (("view_rate_pct", v), ("cart_rate_pct", c), ("purchase_rate_pct", p)))),
        "avg_purchase": _with("flag bought", f"""SELECT device_type, referrer, COUNT(*) AS purchases,
            {_mean('SUM(COALESCE(purchase_amount, 0))', 'COUNT(*)', 2)} AS avg_amount,
            {_mean('SUM(COALESCE(items_purchased, 0))', 'COUNT(*)', 1)} AS avg_items
            FROM flag LEFT JOIN bought ON bought.session_id = flag.session_id WHERE stage_purchase GROUP BY 1, 2"""),
        "cart_abandonment": _with("flag", f"""SELECT COUNT(*) AS cart_sessions, {ABAND} AS abandoned, {p} AS converted,
            COALESCE({_pct(ABAND, 'COUNT(*)')}, 0) AS abandonment_rate_pct FROM flag WHERE stage_add_to_cart"""),
        "cart_abandonment_by_device": _with("flag", f"""SELECT device_type, COUNT(*) AS cart_sessions, {ABAND} AS abandoned,
            {_pct(ABAND, 'COUNT(*)')} AS abandonment_rate_pct FROM flag WHERE stage_add_to_cart GROUP BY 1"""),
        "device_funnel": _with("sess", f"SELECT {title} AS device, " + device.format(key="device_type,", group="GROUP BY device_type")
                               + " UNION ALL SELECT 'overall', " + device.format(key="", group="")),
        "device_funnel_insight": _with("sess", f"""SELECT {_pct(CONV, 'COUNT(*)')} AS conversion_rate_pct,
            COALESCE({_pct(CONV, CARTED)}, 0) AS cart_to_conversion_pct,
            COALESCE({_round(f'(1.0 - {_ratio(CONV, CARTED)}) * 100', 1)}, 0) AS cart_abandonment_pct,
            (SELECT {title} FROM sess GROUP BY device_type ORDER BY {_ratio(CONV, 'COUNT(*)')} DESC, device_type LIMIT 1) AS best_device,
            (SELECT {_round('MAX(x) * 100', 1)} FROM (SELECT {_ratio(CONV, 'COUNT(*)')} AS x FROM sess GROUP BY device_type)) AS best_device_rate_pct
            FROM sess"""),
    }


def _sessions() -> dict[str, str]:
    carted = "COUNT(*) FILTER (WHERE conversion_status IN ('converted', 'abandoned'))"
    brows = "COUNT(*) FILTER (WHERE conversion_status = 'browsing')"

    def conversion(dim: str, extra: str = "", key: str = "") -> str:
        return _with("sess", f"""SELECT {key or dim} AS {dim}, COUNT(*) AS sessions, {CONV} AS conversions,
            {_round(f'{_ratio(CONV, "COUNT(*)")} * 100', 4)} AS conv_rate{extra} FROM sess GROUP BY {dim}""")

    def rate(system: str) -> str:
        hit = f"COUNT(*) FILTER (WHERE conversion_status = 'converted' AND device_os = '{system}')"
        return f"COALESCE({_pct(hit, f'''COUNT(*) FILTER (WHERE device_os = '{system}')''')}, 0) AS \"{system}\""

    return {
        "device_behaviour": _with("sess", f"""SELECT device_type, device_os AS os, COUNT(*) AS session_count,
            {_mean('SUM(duration_seconds)', 'COUNT(*)', 0)} AS avg_duration_sec, {_mean('SUM(page_views)', 'COUNT(*)', 1)} AS avg_pages_per_session,
            {_mean('SUM(viewed_products)', 'COUNT(*)', 1)} AS avg_products_viewed, {_pct(CONV, 'COUNT(*)')} AS conversion_rate_pct
            FROM sess GROUP BY 1, 2"""),
        "funnel_overview": _with("sess", f"""SELECT COUNT(*) AS total_sessions, {VIEWED} AS browsed_products,
            {_pct(VIEWED, 'COUNT(*)')} AS browse_rate_pct, {carted} AS added_to_cart, {_pct(carted, 'COUNT(*)')} AS cart_rate_pct,
            {CONV} AS converted, {_pct(CONV, 'COUNT(*)')} AS conversion_rate_pct, {_pct(CONV, carted)} AS cart_to_purchase_pct FROM sess"""),
        "status_counts": _with("sess", f"""SELECT COUNT(*) AS total, {CONV} AS converted, {_pct(CONV, 'COUNT(*)')} AS converted_pct,
            {ABAND} AS abandoned, {_pct(ABAND, 'COUNT(*)')} AS abandoned_pct, {brows} AS browsing, {_pct(brows, 'COUNT(*)')} AS browsing_pct
            FROM sess"""),
        "filtered_status_counts": _with("sess", f"""SELECT COUNT(*) AS total, {CONV} AS converted, {_pct(CONV, 'COUNT(*)')} AS converted_pct,
            {ABAND} AS abandoned, {_pct(ABAND, 'COUNT(*)')} AS abandoned_pct, {brows} AS browsing, {_pct(brows, 'COUNT(*)')} AS browsing_pct
            FROM sess WHERE device_type IN ('mobile', 'desktop') AND referrer IN ('direct', 'email')"""),
        "stage_counts": _with("sess", f"""SELECT 'Total Sessions' AS stage, COUNT(*) AS count FROM sess
            UNION ALL SELECT 'Viewed Products', {VIEWED} FROM sess UNION ALL SELECT 'Added to Cart', {CARTED} FROM sess
            UNION ALL SELECT 'Purchased', {CONV} FROM sess"""),
        "conversion_by_device_type": conversion("device_type"),
        "conversion_by_referrer": conversion("referrer", f", {_mean('SUM(duration_seconds)', 'COUNT(*)', 2)} AS avg_duration"),
        "conversion_by_browser": conversion("browser"),
        "conversion_by_hour": conversion("hour", key="CAST(hour AS INTEGER)"),
        "session_flow": _with("sess", "SELECT referrer, device_type, conversion_status, COUNT(*) AS count FROM sess GROUP BY 1, 2, 3"),
        "session_flow_edges": _with("sess", """SELECT 'referrer_device' AS hop, referrer AS source, device_type AS target, COUNT(*) AS count
            FROM sess GROUP BY 2, 3 UNION ALL SELECT 'device_status', device_type, conversion_status, COUNT(*) FROM sess GROUP BY 2, 3"""),
        "device_os_matrix": _with("sess", "SELECT device_type, " + ", ".join(rate(s) for s in ("Windows", "macOS", "Android", "iOS"))
                                  + " FROM sess GROUP BY 1"),
        "device_os_map": _with("sess", f"""SELECT device_type, CAST(COUNT(*) AS INTEGER) AS systems,
            string_agg(os || '=' || CAST(CAST(rate AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY os) AS rates FROM (
            SELECT device_type, COALESCE(device_os, 'Unknown') AS os, {_pct("COUNT(*) FILTER (WHERE conversion_status = 'converted')", 'COUNT(*)')} AS rate
            FROM sess GROUP BY 1, 2) GROUP BY 1"""),
        "page_view_kpis": _with("pv", f"""SELECT COUNT(*) AS total_views, {_mean('COUNT(*)', 'COUNT(DISTINCT session_id)', 2)} AS avg_views_per_session,
            {_mean('SUM(view_duration)', 'COUNT(view_duration)', 2)} AS avg_duration,
            (SELECT page_type FROM pv GROUP BY 1 ORDER BY COUNT(*) DESC, page_type LIMIT 1) AS top_page_type
            FROM pv"""),
        "filtered_page_view_kpis": _with("pv", f"""SELECT COUNT(*) AS total_views, {_mean('COUNT(*)', 'COUNT(DISTINCT session_id)', 2)} AS avg_views_per_session,
            {_mean('SUM(view_duration)', 'COUNT(view_duration)', 2)} AS avg_duration,
            (SELECT page_type FROM pv WHERE page_type IN ('view', 'click', 'purchase') GROUP BY 1 ORDER BY COUNT(*) DESC, page_type LIMIT 1) AS top_page_type
            FROM pv WHERE page_type IN ('view', 'click', 'purchase')"""),
        "page_type_stats": _with("pv", f"""SELECT page_type, COUNT(*) AS views, {_mean('SUM(view_duration)', 'COUNT(view_duration)', 2)} AS avg_duration,
            {_dbl('MIN(view_duration)')} AS min, {_dbl('MAX(view_duration)')} AS max, {_quartiles('view_duration')} FROM pv GROUP BY 1"""),
        "daily_page_views": _with("pv", f"SELECT {_day('p.date')} AS date, page_type, COUNT(*) AS views FROM pv p GROUP BY p.date, page_type"),
        "page_transitions": _with("pv", """SELECT page_type AS source, nxt AS target, COUNT(*) AS count
            FROM (SELECT page_type, LEAD(page_type) OVER (PARTITION BY session_id ORDER BY ts, view_id) AS nxt FROM pv)
            WHERE nxt IS NOT NULL GROUP BY 1, 2"""),
    }


def _quartiles(col: str) -> str:
    return ", ".join(f"{_round(f'quantile_cont({_dbl(col)}, {p})', 2)} AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))


def _insights() -> dict[str, str]:
    inactive, vip = "COUNT(*) FILTER (WHERE tier = 'Inactive')", "COUNT(*) FILTER (WHERE tier = 'VIP')"
    vip_rev = "COALESCE(SUM(total_spent) FILTER (WHERE tier = 'VIP'), 0)"
    label = """CASE WHEN length(product_name) > 25 THEN substr(product_name, 1, 25) || '...' ELSE product_name END || ' [' || category || ']'"""
    best = f"""SELECT product_id, product_name, category, {_dbl('p.revenue')} AS revenue, {_big('p.quantity')} AS quantity, orders FROM pstat p"""
    return {
        "weekly_category_revenue": _with("sales prod", f"""SELECT {_day('wk')} AS week, category, {_dbl('SUM(subtotal)')} AS revenue
            FROM (SELECT date_trunc('week', date) AS wk, COALESCE(category, 'Unknown') AS category, subtotal
                  FROM sales LEFT JOIN prod ON prod.product_id = sales.product_id)
            WHERE category IN (SELECT COALESCE(category, 'Unknown') FROM sales LEFT JOIN prod ON prod.product_id = sales.product_id
                               GROUP BY 1 ORDER BY SUM(subtotal) DESC, 1 LIMIT 5) GROUP BY wk, category"""),
        "weekly_revenue": _with("sales", f"""SELECT {_day("date_trunc('week', date)")} AS week, {_dbl('SUM(subtotal)')} AS revenue FROM sales GROUP BY 1"""),
        "category_concentration": _with("catrev", f"""SELECT (SELECT category FROM catrev ORDER BY revenue DESC, category LIMIT 1) AS top_category,
            {_dbl('MAX(revenue)')} AS top_revenue, {_pct('MAX(revenue)', 'SUM(revenue)')} AS top_share_pct,
            {_pct('(SELECT SUM(revenue) FROM (SELECT revenue FROM catrev ORDER BY revenue DESC, category LIMIT 5))', 'SUM(revenue)')} AS top5_share_pct,
            {_dbl('SUM(revenue)')} AS total_revenue FROM catrev"""),
        "customer_tiers": _with("tier", f"SELECT user_id, province, {_dbl('total_spent')} AS total_spent, total_orders, tier FROM tier"),
        "tiers_by_province": _with("tier", "SELECT province, tier, COUNT(*) AS count FROM tier GROUP BY 1, 2"),
        "tiers_by_province_wide": _with("tier", "SELECT province, " + ", ".join(
            f"COUNT(*) FILTER (WHERE tier = '{t}') AS \"{t}\"" for t in ("VIP", "Regular", "Low", "Inactive")) + " FROM tier GROUP BY 1"),
        "segment_insight": _with("tier", f"""SELECT {vip} AS vip_count, {_pct(vip, 'COUNT(*)')} AS vip_user_pct, {_dbl(vip_rev)} AS vip_revenue,
            {_pct(vip_rev, 'SUM(total_spent)')} AS vip_revenue_pct, {inactive} AS inactive_count,
            {_pct(inactive, 'COUNT(*)')} AS inactive_pct FROM tier"""),
        "product_performance": _with("pstat", f"""SELECT product_id, {label} AS label, category, {_dbl('revenue')} AS revenue,
            {_big('quantity')} AS quantity FROM pstat"""),
        "product_insight": _with("pstat", f"""SELECT {_dbl('MAX(revenue)')} AS top_revenue, {_big('MAX(quantity)')} AS top_quantity,
            {_pct('(SELECT SUM(revenue) FROM (SELECT revenue FROM pstat ORDER BY revenue DESC, product_id LIMIT 15))', 'SUM(revenue)')} AS top_share_pct,
            COUNT(*) AS products_sold,
            (SELECT product_name FROM pstat ORDER BY revenue DESC, product_id LIMIT 1) AS top_revenue_product,
            (SELECT product_name FROM pstat ORDER BY quantity DESC, product_id LIMIT 1) AS top_quantity_product FROM pstat"""),
        "product_stats": _with("pstat", best),
        "best_products_by_revenue": _with("pstat", best + " ORDER BY p.revenue DESC, product_id LIMIT 15"),
        "best_products_by_quantity": _with("pstat", best + " ORDER BY p.quantity DESC, product_id LIMIT 15"),
        "subcategory_revenue": _with("subrev", f"""SELECT category, subcategory, {_dbl('profit_margin')} AS profit_margin,
            {_dbl('revenue')} AS revenue FROM subrev"""),
        "subcategory_totals": _with("subrev", f"SELECT category, subcategory, {_dbl('SUM(revenue)')} AS revenue FROM subrev GROUP BY ROLLUP (category, subcategory)"),
        "top_subcategories": _with("subrev", f"""SELECT category, subcategory, {_dbl('t.profit_margin')} AS profit_margin, {_dbl('t.revenue')} AS revenue,
            {_round('CAST(t.profit_margin AS DOUBLE) * CAST(MAX(t.revenue) OVER () AS DOUBLE) / CAST(MAX(t.profit_margin) OVER () AS DOUBLE)', 2)} AS scaled_margin
            FROM (SELECT * FROM subrev ORDER BY revenue DESC, category, subcategory LIMIT 20) t"""),
        "price_timeline": _with("price pstat", f"""SELECT price.product_id, product_name, {_dbl('price')} AS price, {_day('date')} AS date
            FROM price JOIN (SELECT product_id, product_name FROM pstat ORDER BY revenue DESC, product_id LIMIT 10) t
            ON t.product_id = price.product_id"""),
        "category_stats": _with("pstat", f"""SELECT category, {_dbl('SUM(revenue)')} AS revenue, {_big('SUM(quantity)')} AS quantity,
            {_big('SUM(orders)')} AS orders, COUNT(*) AS products, {_round(_ratio('SUM(prices)', 'SUM(orders)'), 4)} AS avg_price FROM pstat GROUP BY 1"""),
        "category_revenue": _with("catrev", f"SELECT category, {_dbl('revenue')} AS revenue FROM catrev"),
        "payment_revenue": _with("sales", f"SELECT payment_method, {_dbl('SUM(subtotal)')} AS revenue FROM sales GROUP BY 1"),
        "status_payment_revenue": _with("sales", f"SELECT status, payment_method, {_dbl('SUM(subtotal)')} AS revenue FROM sales GROUP BY ROLLUP (status, payment_method)"),
        "monthly_changes": _with("mon", f"""SELECT month, {_dbl('revenue')} AS revenue,
            {_dbl('revenue - COALESCE(LAG(revenue) OVER (ORDER BY month), 0)')} AS delta,
            CASE WHEN LAG(revenue) OVER (ORDER BY month) IS NULL THEN 'absolute' ELSE 'relative' END AS measure FROM mon
            UNION ALL SELECT 'Total', {_dbl('(SELECT revenue FROM mon ORDER BY month DESC LIMIT 1)')}, 0, 'total'"""),
        "monthly_volume": _with("mon", f"SELECT month, {_dbl('revenue')} AS revenue, order_lines FROM mon"),
        "daily_revenue_lines": _with("day", f"""SELECT {_day('d.date')} AS date, {_dbl('revenue')} AS revenue,
            {_round('CAST(SUM(revenue) OVER w AS DOUBLE) / COUNT(*) OVER w', 4)} AS avg_7d FROM day d
            WINDOW w AS (ORDER BY d.date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
        "overview_kpis": _with("day lin usr sess", f"""SELECT {_dbl('total')} AS total_revenue, {_dbl('last30')} AS last_30d, {_dbl('prior30')} AS prior_30d,
            {_dbl('last30 - prior30')} AS revenue_delta, (SELECT COUNT(DISTINCT user_id) FROM usr) AS unique_customers,
            (SELECT COUNT(DISTINCT product_id) FROM lin) AS products_sold, (SELECT COUNT(*) FROM sess) AS sessions,
            (SELECT {_round(f'{_ratio(CONV, "COUNT(*)")} * 100', 4)} FROM sess) AS conversion_rate,
            {_round('CAST(total AS DOUBLE) * 1.2', 2)} AS revenue_target
            FROM (SELECT SUM(revenue) AS total, COALESCE(SUM(revenue) FILTER (WHERE date >= last - 30), 0) AS last30,
                         COALESCE(SUM(revenue) FILTER (WHERE date >= last - 60 AND date < last - 30), 0) AS prior30
                  FROM day, (SELECT MAX(date) AS last FROM day))"""),
        "tier_summary": _with("tier", f"""SELECT tier, count, avg_spent, total_revenue, pct, count || ' (' || pct || '%)' AS label FROM (
            SELECT tier, COUNT(*) AS count, {_round(_ratio('SUM(total_spent)', 'COUNT(*)'), 4)} AS avg_spent,
            {_dbl('SUM(total_spent)')} AS total_revenue, {_pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct
            FROM tier GROUP BY 1)"""),
        "filtered_tier_summary": _with("tier", f"""SELECT tier, count, avg_spent, total_revenue, pct, count || ' (' || pct || '%)' AS label FROM (
            SELECT tier, COUNT(*) AS count, {_round(_ratio('SUM(total_spent)', 'COUNT(*)'), 4)} AS avg_spent,
            {_dbl('SUM(total_spent)')} AS total_revenue, {_pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct
            FROM tier WHERE tier IN ('VIP', 'Regular', 'Low') GROUP BY 1)"""),
        "registrations": _with("usr reg", """SELECT cohort AS reg_month, province, COUNT(*) AS count FROM usr JOIN reg ON reg.user_id = usr.user_id GROUP BY 1, 2"""),
        "top_provinces": _with("usert", f"SELECT province, {_dbl('SUM(total_spent)')} AS revenue FROM usert GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
        "top_customers": _with("tier", f"""SELECT user_id, name, province, total_orders, {_dbl('t.total_spent')} AS total_spent, avg_order_value, tier,
            format('{{:,}}', CAST(round(t.total_spent, 0) AS BIGINT)) AS spent_label FROM tier t ORDER BY t.total_spent DESC, user_id LIMIT 15"""),
        "active_users": _with("tier", f"SELECT user_id, name, province, tier, total_orders, {_dbl('total_spent')} AS total_spent FROM tier WHERE total_orders > 0"),
        "spend_distribution": _with("tier", f"""SELECT tier, COUNT(*) AS n, {_dbl('MIN(total_spent)')} AS min, {_dbl('MAX(total_spent)')} AS max,
            {_quartiles('total_spent')} FROM tier WHERE total_orders > 0 GROUP BY 1"""),
    }


def _filters_and_carts() -> dict[str, str]:
    kept = "CAST(start_time AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND province IN ('ASIA', 'EUROPE')"
    statuses = " UNION ALL ".join(
        f"SELECT '{s}' AS status, COUNT(*) FILTER (WHERE status = '{s}') AS count, "
        f"COALESCE({_pct(f'''COUNT(*) FILTER (WHERE status = '{s}')''', 'COUNT(*)')}, 0) AS pct FROM owi"
        for s in ("completed", "shipped", "processing", "refunded"))
    return {
        "filtered_lines": _with("sales prod", f"""SELECT {_day('s.date')} AS date, s.product_id, {_dbl('SUM(subtotal)')} AS revenue, COUNT(*) AS lines
            FROM sales s JOIN prod ON prod.product_id = s.product_id
            WHERE s.date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND category IN ('ECONOMY', 'LARGE') GROUP BY s.date, s.product_id"""),
        "filtered_users": _with("usr", "SELECT * FROM usr WHERE province IN ('ASIA', 'EUROPE')"),
        "filtered_sessions": _with("sess", f"SELECT session_id, province, {_sec('start_time')} AS start_time FROM (SELECT * FROM sess WHERE {kept})"),
        "filtered_page_views": _with("pv sess", f"""SELECT page_type, COUNT(*) AS views FROM pv
            WHERE session_id IN (SELECT session_id FROM sess WHERE {kept}) GROUP BY 1"""),
        "cart_kpis": _with("ctot sess owi", f"""SELECT {_mean('SUM(cart_total)', 'COUNT(*)', 2)} AS avg_cart_value,
            {_mean('SUM(cart_quantity)', 'COUNT(*)', 1)} AS avg_cart_items,
            (SELECT {_round(f'(1.0 - {_ratio(CONV, "COUNT(*)")}) * 100', 1)} FROM sess WHERE cart_items > 0) AS abandonment_rate_pct,
            (SELECT {_pct("COUNT(*) FILTER (WHERE status = 'refunded')", 'COUNT(*)')} FROM owi) AS refund_rate_pct FROM ctot"""),
        "status_share": _with("owi", statuses),
        "cart_value_histogram": _with("ctot", f"""SELECT bin, {_round('lo + bin * width', 4)} AS bin_from, {_round('lo + (bin + 1) * width', 4)} AS bin_to,
            COUNT(*) AS sessions FROM (SELECT lo, width, CASE WHEN hi > lo THEN CAST(least(floor((v - lo) / width), 39) AS INTEGER) ELSE 0 END AS bin
                FROM (SELECT {_dbl('cart_total')} AS v FROM ctot),
                     (SELECT MIN({_dbl('cart_total')}) AS lo, MAX({_dbl('cart_total')}) AS hi, (MAX({_dbl('cart_total')}) - MIN({_dbl('cart_total')})) / 40e0 AS width FROM ctot))
            GROUP BY bin, lo, width"""),
        "cart_value_quartiles": _with("ctot", f"""SELECT 'all' AS scope, COUNT(*) AS n, {_dbl('MIN(cart_total)')} AS min, {_dbl('MAX(cart_total)')} AS max,
            {_quartiles('cart_total')} FROM ctot"""),
        "discount_bridge": _with("amt ord", f"""SELECT {_dbl('SUM(subtotal)')} AS gross, {_dbl('ROUND(SUM(discount), 2)')} AS discount,
            {_dbl('SUM(total)')} AS net, {_pct('SUM(discount)', 'SUM(subtotal)')} AS discount_pct FROM amt JOIN ord ON ord.transaction_id = amt.transaction_id"""),
        "refund_rate_by_category": _with("sales prod", f"""SELECT category, count, total, {_round(f'{_ratio("count", "total")} * 100', 4)} AS refund_rate
            FROM (SELECT COALESCE(category, 'Unknown') AS category, COUNT(DISTINCT transaction_id) AS total,
                         COUNT(DISTINCT CASE WHEN status = 'refunded' THEN transaction_id END) AS count
                  FROM sales LEFT JOIN prod ON prod.product_id = sales.product_id GROUP BY 1) WHERE count > 0"""),
        "abandonment_by_referrer_device": _with("sess", """SELECT referrer, device_type,
            COUNT(*) FILTER (WHERE conversion_status <> 'converted') AS abandoned FROM sess WHERE cart_items > 0 GROUP BY 1, 2"""),
    }


def _documents(found: dict[str, str]) -> dict[str, str]:
    """The document adapter must agree with the star adapter."""
    same = ("daily_revenue", "category_revenue", "funnel_stages", "page_transitions")
    # Other ways to the same rows have the same SQL.
    ways = {"indexed_search_recommendations": "search_recommendations", "arrays_users": "users_from_json", "arrays_subcategories": "subcategories_from_json", "arrays_products": "clean_products",
            "arrays_daily_revenue": "daily_revenue", "arrays_funnel_stages": "funnel_stages", "document_cart_lines": "cart_lines",
            "rollup_product_daily_metrics": "product_daily_metrics", "rollup_purchase_summary": "purchase_summary",
            "store_user_sessions": "user_sessions", "store_product_metrics_for": "product_metrics_for", "store_txn_lines": "txn_lines",
            "store_monthly_revenue": "monthly_revenue", "store_products": "products_enriched", "store_users": "users_enriched"}
    activity = _activity()
    return {f"documents_{name}": found[name] for name in same} | {name: found[of] for name, of in ways.items()} | {
        "document_activity": activity, "document_activity_filled": activity, "rollup_buyers": _buyers(),
        "rollup_view_durations": _with("pv", f"""SELECT page_type, COUNT(*) AS n, {_dbl('MIN(view_duration)')} AS min, {_dbl('MAX(view_duration)')} AS max,
            {_quartiles('view_duration')} FROM pv p WHERE view_duration IS NOT NULL AND CAST(p.date AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1""")}


def _buyers() -> str:
    """Distinct users with orders, by period and by payment method, each counted from the orders."""
    labels = {"month": "strftime(date, '%Y-%m')", "quarter": "year(date) || '-Q' || quarter(date)", "all": "'all'", "method": "payment_method"}
    return _with("ord", " UNION ALL ".join(f"SELECT '{p}' AS period, {label} AS label, COUNT(DISTINCT user_id) AS buyers FROM ord GROUP BY 2" for p, label in labels.items()))


def _activity() -> str:
    """What the activity of a session holds."""
    return _with("sess cart", f"""SELECT session_id, CAST(user_id AS VARCHAR) AS user_id, page_views, viewed_products,
        COALESCE(n, 0) AS cart_contents, COALESCE({_big('q')}, 0) AS units FROM sess
        LEFT JOIN (SELECT session_id AS s, COUNT(*) AS n, SUM(quantity) AS q FROM cart GROUP BY 1) ON s = session_id""")


def statements() -> dict[str, str]:
    """Query name to SQL text."""
    out: dict[str, str] = {}
    for part in (_load_and_profile, _denormalise, _commerce, _lookup_and_recommend, _cohort, _lifetime, _funnel, _sessions,
                 _insights, _filters_and_carts):
        out.update(part())
    return out | _documents(out)
