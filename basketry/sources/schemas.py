"""Schemas of the five document entities.

Declared, never inferred: inference would turn ``cart_contents`` into a struct
with one field per product and would cost an extra pass over the files.
Enriched documents may also carry ``purchase_summary`` (users) and ``category``
(products, instead of the two ids); plain ones read as NULL there.
Timestamps arrive as ISO text and are parsed by the loader.
"""

USERS = """
    user_id STRING, name STRING, email STRING, phone STRING,
    geo_data STRUCT<city: STRING, province: STRING, country: STRING>,
    registration_date STRING, last_active STRING,
    purchase_summary STRUCT<total_orders: BIGINT, total_spent: DOUBLE, avg_order_value: DOUBLE>
"""

CATEGORIES = """
    category_id STRING, name STRING,
    subcategories ARRAY<STRUCT<subcategory_id: STRING, name: STRING, profit_margin: DOUBLE>>
"""

PRODUCTS = """
    product_id STRING, name STRING, category_id STRING, subcategory_id STRING,
    base_price DOUBLE, current_stock INT, is_active BOOLEAN,
    price_history ARRAY<STRUCT<price: DOUBLE, date: STRING>>, creation_date STRING,
    category STRUCT<category_id: STRING, name: STRING, subcategory_id: STRING, subcategory_name: STRING, profit_margin: DOUBLE>
"""

SESSIONS = """
    session_id STRING, user_id STRING, start_time STRING, end_time STRING, duration_seconds INT,
    geo_data STRUCT<city: STRING, state: STRING, country: STRING, ip_address: STRING>,
    device_profile STRUCT<type: STRING, os: STRING, browser: STRING>,
    viewed_products ARRAY<STRING>,
    page_views ARRAY<STRUCT<timestamp: STRING, page_type: STRING, product_id: STRING,
                            category_id: STRING, view_duration: INT>>,
    cart_contents MAP<STRING, STRUCT<quantity: INT, price: DOUBLE>>,
    conversion_status STRING, referrer STRING
"""

TRANSACTIONS = """
    transaction_id STRING, session_id STRING, user_id STRING, timestamp STRING,
    items ARRAY<STRUCT<product_id: STRING, quantity: INT, unit_price: DOUBLE, subtotal: DOUBLE>>,
    subtotal DOUBLE, discount DOUBLE, total DOUBLE, payment_method STRING, status STRING
"""

ENTITIES = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "sessions": SESSIONS,
    "transactions": TRANSACTIONS,
}
