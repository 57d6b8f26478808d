"""The flat tables every analysis works on.

Both adapters (documents and star schema) fill the same columns:

- ``orders``: transaction_id, user_id, session_id, timestamp, date, total, payment_method, status
- ``items``: transaction_id, product_id, quantity, unit_price, subtotal, line_discount
- ``products``: product_id, name, category_id, subcategory_id, base_price, current_stock, is_active, has_price_history
- ``categories``: category_id, category_name
- ``subcategories``: category_id, category_name, subcategory_id, subcategory_name, profit_margin
- ``users``: user_id, name, city, province, registration_date
- ``sessions``: session_id, user_id, start_time, end_time, duration_seconds, page_views, viewed_products,
  cart_items, conversion_status, referrer, device_type, device_os, browser, city, province, country
- ``page_views``: session_id, view_id, page_type, view_duration, timestamp, product_id, date
- ``carts``: session_id, product_id, quantity, price
- ``session_purchases``: session_id, purchase_amount, items_purchased
- ``price_points``: product_id, price, date

``total``, ``subtotal``, ``unit_price`` and ``price`` are whole cents (BIGINT), ``line_discount``
hundredths of a cent: they are summed over billions of rows, see ``functions.numeric``. Everything
derived from these tables, ``transactions()`` and ``order_revenue()`` included, is in DECIMAL
amounts. Timestamps carry no zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.numeric import sum_money, units
from basketry.operators.joins import HotKeys, attach, measure_hot_keys

# The keys by which rows of a large table are joined one by one.
JOINED_BY = {"items": ("transaction_id", "product_id"), "cart_events": ("session_id", "product_id"), "page_views": ("session_id",), "orders": ("user_id",)}
# What tells the items of one transaction apart, and of one product.
ITEM_SPREAD = {"transaction_id": ("product_id", "subtotal"), "product_id": ("transaction_id",)}
ORDER_COLUMNS = ("user_id", "timestamp", "date", "total", "payment_method", "status")


class Retail:
    """Lazily built tables; adapters implement the abstract properties."""

    orders: DataFrame
    items: DataFrame
    products: DataFrame
    categories: DataFrame
    subcategories: DataFrame
    users: DataFrame
    sessions: DataFrame
    page_views: DataFrame
    carts: DataFrame
    session_purchases: DataFrame
    price_points: DataFrame

    def __init__(self) -> None:
        self._hot: dict[tuple[str, str], HotKeys] = {}

    def hot_keys(self, table: str, key: str) -> HotKeys:
        """Hot keys of a table; all its join keys are measured in one pass, once per loaded data set."""
        if (table, key) not in self._hot:
            found = measure_hot_keys(getattr(self, table), JOINED_BY[table])
            self._hot |= {(table, k): hot for k, hot in found.items()}
        return self._hot[table, key]

    def sales(self, *order_columns: str, only: str | None = None) -> DataFrame:
        """Items with the named columns of their order; ``only`` keeps one status.

        The status filter sits on the order side, so it reaches that scan.
        """
        return self._with_orders(self.items, *order_columns, only=only)

    def _with_orders(self, items: DataFrame, *order_columns: str, only: str | None = None) -> DataFrame:
        orders = self.orders if only is None else self.orders_with(only)
        header = orders.select("transaction_id", *(order_columns or ORDER_COLUMNS))
        return attach(items, header, "transaction_id", hot=self.hot_keys("items", "transaction_id"), by=ITEM_SPREAD["transaction_id"])

    def sales_of(self, product_id, *order_columns: str) -> DataFrame:
        """``sales`` of one product: its items are read by key, so nothing is measured and no key can be hot."""
        one = self.items.filter(F.col("product_id") == product_id)
        return one.join(self.orders.select("transaction_id", *order_columns), "transaction_id")

    def orders_with(self, status: str) -> DataFrame:
        return self.orders.filter(F.col("status") == status)

    def order_amounts(self) -> DataFrame:
        """``subtotal``, ``discount`` and number of ``lines`` per transaction that has items."""
        return self.items.groupBy("transaction_id").agg(
            sum_money("subtotal").alias("subtotal"), sum_money("line_discount", 4).alias("discount"), F.count("*").alias("lines")
        )

    def order_revenue(self, *order_columns: str) -> DataFrame:
        """Amounts of the transactions that have items, with the named columns of their order.

        For reports that do not look at products: items are reduced to one row
        per transaction before the join, so both sides are unique on the key and
        a transaction with very many lines needs no special care.
        """
        header = [units("total").alias("total") if c == "total" else F.col(c) for c in order_columns]
        return self.order_amounts().join(self.orders.select("transaction_id", *header), "transaction_id")

    def price_points_of(self, products: DataFrame) -> DataFrame:
        """Price points of the few products in ``products``."""
        return self.price_points.join(products.select("product_id"), "product_id", "left_semi")

    @property
    def cart_events(self) -> DataFrame:
        """What the carts are made of; frequent products and sessions are measured here, before any shuffle."""
        return self.carts

    @property
    def registrations(self) -> DataFrame:
        """``user_id, registration_date``"""
        return self.users.select("user_id", "registration_date")

    def transactions(self, only: str | None = None) -> DataFrame:
        """Orders, or those with one status, with their amounts; orders without items have zero amounts."""
        zero = F.lit(0).cast("decimal(18,2)")
        orders = self.orders if only is None else self.orders_with(only)
        return orders.join(self.order_amounts().drop("lines"), "transaction_id", "left").withColumns(
            {"total": units("total"), "subtotal": F.coalesce("subtotal", zero), "discount": F.coalesce("discount", zero)}
        )

    def product_dim(self) -> DataFrame:
        """Products with category, subcategory and margin; unknown ones get defaults."""
        sub = self.subcategories.select("subcategory_id", F.col("subcategory_name").alias("subcategory"), "profit_margin")
        cat = self.categories.select("category_id", F.col("category_name").alias("category"))
        return self.products.join(cat, "category_id", "left").join(sub, "subcategory_id", "left").withColumns(
            {
                "category": F.coalesce("category", F.lit("Unknown")),
                "subcategory": F.coalesce("subcategory", F.lit("Unknown")),
                "profit_margin": F.coalesce("profit_margin", F.lit(0).cast("decimal(4,2)")),
            }
        )
