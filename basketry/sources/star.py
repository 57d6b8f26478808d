"""Adapter: order/line/part/customer star schema plus an event stream.

The mapping is fixed and stated here once; nothing is invented per query.

- order status F/O/P -> completed / processing / refunded; payment method = order priority
- category = part type, subcategory = type/brand, margin = 5 % steps by brand number
- user geography = region (province) and nation (city); registration = first order
- a session is one user's events of one calendar day; views, clicks (cart) and
  purchases are event types; device, system, referrer and browser follow from
  the ``k`` of the session's first event (smallest id); a cart line is one clicked product
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.calendar import by_date, seconds_between
from basketry.functions.numeric import cents, money, sum_money, units
from basketry.sources.retail import Retail

# Fixed values of the mapping.
CODE_OF = {"completed": "F", "processing": "O", "refunded": "P"}
DEVICES = ("desktop", "mobile", "tablet")
SYSTEMS = ("Windows", "macOS", "Android", "iOS")
REFERRERS = ("direct", "search_engine", "social_media", "email", "affiliate")
BROWSERS = ("Chrome", "Firefox", "Safari", "Edge", "Opera", "Brave")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
STOCK_STEP, INACTIVE_EVERY, CITIES = 10, 10, 25


def _pick(values: tuple[str, ...], k: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(k, F.lit(len(values))))


class StarRetail(Retail):
    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__()
        self.spark, self.path = spark, path

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders_from(self._read("orders"))

    def orders_with(self, status: str) -> DataFrame:
        """Filters the stored code: a comparison Parquet can check, unlike the derived name."""
        return self._orders_from(self._read("orders").filter(F.col("o_orderstatus") == CODE_OF[status]))

    def _orders_from(self, raw: DataFrame) -> DataFrame:
        status = F.lit(None).cast("string")
        for name, code in CODE_OF.items():
            status = F.when(F.col("o_orderstatus") == code, name).otherwise(status)
        return raw.select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_custkey").alias("user_id"),
            F.lit(None).cast("string").alias("session_id"),
            F.col("o_orderdate").alias("timestamp"),
            F.to_date("o_orderdate").alias("date"),
            cents("o_totalprice").alias("total"),
            F.col("o_orderpriority").alias("payment_method"),
            status.alias("status"),
        )

    @cached_property
    def items(self) -> DataFrame:
        price = cents("l_extendedprice")
        return self._read("lineitem").select(
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            cents(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_price"),
            price.alias("subtotal"),
            (price * cents("l_discount")).alias("line_discount"),
        )

    @cached_property
    def _parts(self) -> DataFrame:
        brand_no = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
        return self._read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category_id"),
            F.concat_ws("/", "p_type", "p_brand").alias("subcategory_id"),
            money("p_retailprice").alias("base_price"),
            (F.col("p_size") * STOCK_STEP).alias("current_stock"),
            (F.col("p_size") % INACTIVE_EVERY != 0).alias("is_active"),
            F.lit(True).alias("has_price_history"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            (F.lit(0.05) * (1 + brand_no % 8)).cast("decimal(4,2)").alias("profit_margin"),
        )

    @cached_property
    def products(self) -> DataFrame:
        return self._parts.drop("category", "subcategory", "profit_margin")

    @cached_property
    def categories(self) -> DataFrame:
        return self._parts.select("category_id", F.col("category").alias("category_name")).distinct()

    @cached_property
    def subcategories(self) -> DataFrame:
        return self._parts.select(
            "category_id", F.col("category").alias("category_name"), "subcategory_id",
            F.col("subcategory").alias("subcategory_name"), "profit_margin",
        ).distinct()

    def product_dim(self) -> DataFrame:
        """The part table already carries category, subcategory and margin: no join."""
        return self._parts

    @cached_property
    def customers(self) -> DataFrame:
        """Users without the registration date, which needs the orders."""
        nation = self._read("nation").join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        places = nation.select(F.col("n_nationkey"), F.col("n_name").alias("city"), F.col("r_name").alias("province"))
        return (
            self._read("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), "city", "province")
        )

    @cached_property
    def registrations(self) -> DataFrame:
        """First order per user; needs the orders only."""
        return self.orders.groupBy("user_id").agg(F.min("timestamp").alias("registration_date"))

    @cached_property
    def users(self) -> DataFrame:
        return self.customers.join(self.registrations, "user_id", "left")

    @cached_property
    def events(self) -> DataFrame:
        return self._read("events").select(
            "event_id", "user_id", "ts", "event_type",
            cents("value").alias("value"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        return self._sessions_from(self.events)

    def sessions_of(self, user_id: int) -> DataFrame:
        """Sessions of one user; the user filter reaches the event scan."""
        return self._sessions_from(self.events.filter(F.col("user_id") == user_id))

    def sessions_between(self, start: date, end: date) -> DataFrame:
        """Sessions that start in the given days; a session never leaves its day, so the scan is cut to them."""
        return self._sessions_from(by_date(self.events, start, end, "ts"))

    def _sessions_from(self, events: DataFrame) -> DataFrame:
        """One aggregation, combined before the shuffle; no event list is collected."""
        def having(kind: str) -> Column:
            return F.count_if(F.col("event_type") == kind)

        per_session = events.groupBy("session_id").agg(
            F.min("user_id").alias("user_id"),
            F.min("ts").alias("start_time"),
            F.max("ts").alias("end_time"),
            F.count("*").alias("page_views"),
            having("view").alias("viewed_products"),
            having("click").alias("cart_items"),
            having("purchase").alias("_bought"),
            F.min_by("k", "event_id").alias("_k"),
        )
        k = F.col("_k")
        status = F.when((F.col("cart_items") > 0) & (F.col("_bought") > 0), "converted").when(
            F.col("cart_items") > 0, "abandoned"
        )
        return per_session.select(
            "session_id", "user_id", "start_time", "end_time",
            seconds_between("start_time", "end_time").alias("duration_seconds"),
            "page_views", "viewed_products", "cart_items",
            status.otherwise("browsing").alias("conversion_status"),
            _pick(REFERRERS, k).alias("referrer"),
            _pick(DEVICES, k).alias("device_type"),
            _pick(SYSTEMS, k).alias("device_os"),
            _pick(BROWSERS, k).alias("browser"),
            F.concat(F.lit("NATION_"), F.pmod(k, F.lit(CITIES)).cast("string")).alias("city"),
            _pick(REGIONS, k).alias("province"),
            F.lit("Earth").alias("country"),
        )

    @cached_property
    def page_views(self) -> DataFrame:
        shows_product = F.col("event_type").isin("view", "click")
        return self.events.select(
            "session_id", F.col("event_id").alias("view_id"), F.col("event_type").alias("page_type"),
            units("value").alias("view_duration"), F.col("ts").alias("timestamp"),
            F.when(shows_product, F.col("k")).alias("product_id"), F.to_date("ts").alias("date"),
        )

    @cached_property
    def cart_events(self) -> DataFrame:
        return self.events.filter(F.col("event_type") == "click").select("session_id", F.col("k").alias("product_id"), "value")

    @cached_property
    def carts(self) -> DataFrame:
        return self.cart_events.groupBy("session_id", "product_id").agg(
            F.count("*").alias("quantity"), F.min("value").alias("price")
        )

    @cached_property
    def session_purchases(self) -> DataFrame:
        bought = self.events.filter(F.col("event_type") == "purchase")
        return bought.groupBy("session_id").agg(
            sum_money("value").alias("purchase_amount"), F.count("*").alias("items_purchased")
        )

    @cached_property
    def price_points(self) -> DataFrame:
        return self._prices(self.items)

    def price_points_of(self, products: DataFrame) -> DataFrame:
        """Lines are cut to the products before they meet the orders."""
        return self._prices(self.items.join(products.select("product_id"), "product_id", "left_semi"))

    def _prices(self, items: DataFrame) -> DataFrame:
        """Highest unit price per product and day of sale."""
        return self._with_orders(items, "date").groupBy("product_id", "date").agg(F.max("unit_price").alias("price"))
