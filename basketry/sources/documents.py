"""Adapter: nested JSON documents (arrays or JSON lines, one or many files)."""

from __future__ import annotations

import posixpath
import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.functions.calendar import iso_text, parse_iso, plain_text
from basketry.functions.numeric import cents, money
from basketry.sources.retail import ORDER_COLUMNS, Retail
from basketry.sources.schemas import ENTITIES

ISO_COLUMNS = {
    "users": ("registration_date", "last_active"),
    "products": ("creation_date",),
    "sessions": ("start_time", "end_time"),
    "transactions": ("timestamp",),
    "categories": (),
}
DEFAULT_STOCK, DEFAULT_ACTIVE = 0, True
# Records a written array file holds on average at most; its task keeps them in memory, some KB each.
FILE_RECORDS = 1 << 16


def read_entity(spark: SparkSession, path: str, entity: str, multi_line: bool = True) -> DataFrame:
    """One entity from ``entity*.json`` files with its declared schema.

    ``multi_line`` files hold one JSON array each. Pretty-printed ones are cut at their records
    (``read_array``); an array on one line cannot be split and is read whole by one task.
    ``False`` reads JSON lines.
    """
    files = posixpath.join(path, f"{entity}*.json")
    found = read_array(spark, files, ENTITIES[entity]) if multi_line else spark.read.schema(ENTITIES[entity]).json(files)
    return clean(found, entity)


def read_array(spark: SparkSession, files: str, schema: str) -> DataFrame:
    """Records of files that each hold one JSON array; a large pretty-printed file feeds many tasks.

    Inside a pretty-printed array a line that starts with the indentation of the records and a brace can
    only begin or end a record: nested lines stand deeper, and a string never holds a raw line break. So
    "end of a record, comma, begin of the next" is the separator of a plain text scan, which Spark splits
    at any size. Line breaks and indentation are taken from the head of the first file. A record with a
    line that is not indented deeper is an error, never lost: its file is printed in another way.
    """
    head = spark.read.option("lineSep", "{").text(files).filter(F.col("value").rlike(r"^\s*\[")).first()
    layout = re.fullmatch(r"\s*\[[ \t]*(\r?\n)([ \t]+)", head["value"]) if head else None
    if layout is None:  # an empty array, or one on a single line
        return spark.read.schema(schema).option("multiLine", True).json(files)
    line, pad = layout.groups()
    parts = spark.read.option("lineSep", f"{line}{pad}}},{line}{pad}{{").text(files).filter(~F.col("value").rlike(r"^\s*(\[\s*\]\s*)?$"))
    inner = F.regexp_replace(F.regexp_replace("value", r"^\s*\[\s*\{", ""), rf"\n{pad}\}}\s*\n\]\s*$", "\n")
    whole = inner.rlike(r"^[ \t]*\r?\n") & ~inner.rlike(rf"\n[ \t]{{0,{len(pad)}}}[^ \t\r\n]")
    text = F.when(whole, F.concat(F.lit("{"), inner, F.lit("}"))).otherwise(F.raise_error(F.lit("a JSON array is not printed like the first file")))
    return parts.select(F.from_json(text, schema).alias("r")).select("r.*")


def write_array(df: DataFrame, path: str, key: str, files: int = 1, most: int = FILE_RECORDS) -> None:
    """Pretty-printed JSON arrays, records in the order of ``key``: as many files as asked for, or more if
    these would hold over ``most`` records on average. A file is written by one task, which sorts its records."""
    files = max(files, -(-df.select(key).count() // most))
    record = F.concat(F.lit("  "), F.regexp_replace(F.to_json(F.struct(*df.columns), {"pretty": "true"}), "\n", "\n  "))
    rows = df.select(F.pmod(F.xxhash64(key), F.lit(files)).cast("int").alias("file"), F.col(key).alias("key"), record.alias("value"))
    rows = rows.repartitionById(files, "file")
    order = Window.partitionBy("file").orderBy("key")
    first, last = F.row_number().over(order) == 1, F.lead("key").over(order).isNull()
    text = F.concat(F.when(first, "[\n").otherwise(""), F.col("value"), F.when(last, "\n]").otherwise(","))
    rows.select("file", "key", text.alias("value")).sortWithinPartitions("file", "key").select("file", "value").write.mode(
        "overwrite").partitionBy("file").text(path)


def clean(df: DataFrame, entity: str) -> DataFrame:
    """Parse timestamps; give products their default stock and active flag."""
    out = df.withColumns({c: parse_iso(c) for c in ISO_COLUMNS[entity]})
    if entity == "products":
        out = clean_products(out).withColumn(
            "price_history",
            F.transform("price_history", lambda p: F.struct(p["price"].alias("price"), F.substring(p["date"], 1, 10).cast("date").alias("date"))),
        )
    return out


def clean_products(products: DataFrame) -> DataFrame:
    return products.withColumns(
        {
            "current_stock": F.coalesce("current_stock", F.lit(DEFAULT_STOCK)),
            "is_active": F.coalesce("is_active", F.lit(DEFAULT_ACTIVE)),
        }
    )


def load(spark: SparkSession, path: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """The five typed entities."""
    return {entity: read_entity(spark, path, entity, multi_line) for entity in ENTITIES}


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines, one file per partition of ``df`` unless a number of files is asked for."""
    (df if files is None else df.repartition(files)).write.mode("overwrite").json(path)


def explode_subcategories(categories: DataFrame) -> DataFrame:
    return categories.select(
        "category_id", F.col("name").alias("category_name"), F.explode("subcategories").alias("s")
    ).select(
        "category_id", "category_name", "s.subcategory_id", F.col("s.name").alias("subcategory_name"),
        F.col("s.profit_margin").cast("decimal(4,2)").alias("profit_margin"),
    )


def documents_of(r: Retail) -> dict[str, DataFrame]:
    """The flat tables as nested documents: the way back. A document holds its lists, so each is one row."""
    text = lambda c: F.col(c).cast("string").alias(c)
    amount = lambda c, digits=2: (F.col(c) / 10**digits).cast("double").alias(c)
    lines = r.items.groupBy("transaction_id").agg(
        F.sort_array(F.collect_list(F.struct(text("product_id"), F.col("quantity").cast("int").alias("quantity"), amount("unit_price"), amount("subtotal")))).alias("items"),
        amount_sum("subtotal"), amount_sum("line_discount", 4).alias("discount"))
    views = r.page_views.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("timestamp").alias("ts"), "view_id", "page_type", text("product_id"), F.col("view_duration").cast("int").alias("view_duration")))).alias("v"))
    seen = F.transform(F.filter("v", lambda x: x["page_type"] == "view"), lambda x: x["product_id"])
    listed = F.transform("v", lambda x: F.struct(
        F.concat(F.translate(plain_text(x["ts"]), " ", "T"), F.lit("Z")).alias("timestamp"), x["page_type"].alias("page_type"), x["product_id"].alias("product_id"),
        F.lit(None).cast("string").alias("category_id"), x["view_duration"].alias("view_duration")))
    carts = r.carts.groupBy("session_id").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("product_id").cast("string"), F.struct(F.col("quantity").cast("int").alias("quantity"), amount("price"))))).alias("cart_contents"))
    sessions = r.sessions.drop("page_views", "viewed_products", "cart_items").join(views, "session_id", "left").join(carts, "session_id", "left")
    subs = r.subcategories.groupBy("category_id", F.col("category_name").alias("name")).agg(F.collect_list(F.struct(
        "subcategory_id", F.col("subcategory_name").alias("name"), F.col("profit_margin").cast("double").alias("profit_margin"))).alias("subcategories"))
    return {
        "users": r.users.select(text("user_id"), "name", F.struct("city", "province").alias("geo_data"), iso_text("registration_date").alias("registration_date")),
        "categories": subs,
        "products": r.products.select(text("product_id"), "name", "category_id", "subcategory_id", F.col("base_price").cast("double").alias("base_price"),
                                      F.col("current_stock").cast("int").alias("current_stock"), "is_active"),
        "sessions": sessions.select(
            "session_id", text("user_id"), iso_text("start_time").alias("start_time"), iso_text("end_time").alias("end_time"),
            F.col("duration_seconds").cast("int").alias("duration_seconds"), F.struct("city", F.col("province").alias("state"), "country").alias("geo_data"),
            F.struct(F.col("device_type").alias("type"), F.col("device_os").alias("os"), "browser").alias("device_profile"),
            seen.alias("viewed_products"), listed.alias("page_views"), "cart_contents", "conversion_status", "referrer"),
        "transactions": r.orders.join(lines, "transaction_id", "left").select(
            text("transaction_id"), text("session_id"), text("user_id"), iso_text("timestamp").alias("timestamp"), "items", "subtotal", "discount",
            amount("total"), "payment_method", "status"),
    }


def amount_sum(column: str, digits: int = 2) -> Column:
    return (F.sum(column) / 10**digits).cast("double").alias(column)


class DocumentRetail(Retail):
    """Flat tables from the nested entities; nesting is undone by explode, never by a join."""

    def __init__(self, entities: dict[str, DataFrame]) -> None:
        super().__init__()
        self.entities = entities

    @cached_property
    def orders(self) -> DataFrame:
        return self.entities["transactions"].select(
            "transaction_id", "user_id", "session_id", "timestamp", F.to_date("timestamp").alias("date"),
            cents("total").alias("total"), "payment_method", "status",
        )

    @cached_property
    def _lines(self) -> DataFrame:
        """Items with everything their document says about the order."""
        return self.entities["transactions"].select(
            "transaction_id", "user_id", "timestamp", F.to_date("timestamp").alias("date"),
            cents("total").alias("total"), "payment_method", "status",
            F.floor(F.try_divide(F.col("discount") * 10000, F.size("items")) + 0.5).alias("line_discount"),
            F.explode("items").alias("item"),
        ).select(
            "transaction_id", F.col("item.product_id").alias("product_id"),
            F.col("item.quantity").cast("bigint").alias("quantity"),
            cents("item.unit_price").alias("unit_price"), cents("item.subtotal").alias("subtotal"),
            "line_discount", *ORDER_COLUMNS,
        )

    @cached_property
    def items(self) -> DataFrame:
        return self._lines.drop(*ORDER_COLUMNS)

    def sales(self, *order_columns: str, only: str | None = None) -> DataFrame:
        lines = self._lines if only is None else self._lines.filter(F.col("status") == only)
        kept = order_columns or ORDER_COLUMNS
        return lines.drop(*[c for c in ORDER_COLUMNS if c not in kept])

    def transactions(self, only: str | None = None) -> DataFrame:
        """The documents state their own amounts."""
        documents = self.entities["transactions"]
        return (documents if only is None else documents.filter(F.col("status") == only)).select(
            "transaction_id", "user_id", "session_id", "timestamp", F.to_date("timestamp").alias("date"),
            money("total").alias("total"), "payment_method", "status",
            money("subtotal").alias("subtotal"), money("discount").alias("discount"),
        )

    def order_amounts(self) -> DataFrame:
        with_items = self.entities["transactions"].filter(F.size("items") > 0)
        return with_items.select("transaction_id", money("subtotal").alias("subtotal"), money("discount").alias("discount"),
                                 F.size("items").cast("bigint").alias("lines"))

    @cached_property
    def products(self) -> DataFrame:
        return self.entities["products"].select(
            "product_id", "name", F.coalesce("category_id", "category.category_id").alias("category_id"),
            F.coalesce("subcategory_id", "category.subcategory_id").alias("subcategory_id"), money("base_price").alias("base_price"),
            "current_stock", "is_active",
            F.coalesce(F.size("price_history") > 0, F.lit(False)).alias("has_price_history"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self.entities["categories"].select("category_id", F.col("name").alias("category_name"))

    @cached_property
    def subcategories(self) -> DataFrame:
        return explode_subcategories(self.entities["categories"])

    @cached_property
    def users(self) -> DataFrame:
        return self.entities["users"].select(*self._user_columns())

    @staticmethod
    def _user_columns() -> list:
        return ["user_id", "name", F.coalesce("geo_data.city", F.lit("Unknown")).alias("city"),
                F.coalesce("geo_data.province", F.lit("Unknown")).alias("province"), "registration_date"]

    @property
    def profiles(self) -> DataFrame:
        """Users with the totals their documents carry, 0 where they carry none."""
        return self.entities["users"].select(
            *self._user_columns(), F.coalesce("purchase_summary.total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
            F.coalesce(money("purchase_summary.total_spent"), F.lit(0).cast("decimal(18,2)")).alias("total_spent"),
            F.coalesce("purchase_summary.avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        def length(col: str):
            return F.coalesce(F.size(col), F.lit(0)).cast("bigint").alias(col)

        return self.entities["sessions"].select(
            "session_id", "user_id", "start_time", "end_time",
            F.col("duration_seconds").cast("bigint").alias("duration_seconds"),
            length("page_views"), length("viewed_products"),
            F.coalesce(F.size("cart_contents"), F.lit(0)).cast("bigint").alias("cart_items"),
            "conversion_status", "referrer",
            F.col("device_profile.type").alias("device_type"), F.col("device_profile.os").alias("device_os"),
            F.col("device_profile.browser").alias("browser"), F.col("geo_data.city").alias("city"),
            F.col("geo_data.state").alias("province"), F.col("geo_data.country").alias("country"),
        )

    @cached_property
    def page_views(self) -> DataFrame:
        return self.entities["sessions"].select("session_id", F.posexplode("page_views").alias("view_id", "v")).select(
            "session_id", F.col("view_id").cast("bigint").alias("view_id"),
            F.coalesce("v.page_type", F.lit("unknown")).alias("page_type"),
            money("v.view_duration").alias("view_duration"),
            parse_iso("v.timestamp").alias("timestamp"),
            F.col("v.product_id").alias("product_id"),
            F.substring("v.timestamp", 1, 10).cast("date").alias("date"),
        )

    @cached_property
    def carts(self) -> DataFrame:
        return self.entities["sessions"].select(
            "session_id", F.explode("cart_contents").alias("product_id", "line")
        ).select("session_id", "product_id", F.col("line.quantity").cast("bigint").alias("quantity"),
                 cents("line.price").alias("price"))

    @cached_property
    def session_purchases(self) -> DataFrame:
        return self.entities["transactions"].groupBy("session_id").agg(
            F.sum(money("total")).alias("purchase_amount"),
            F.sum(F.size("items")).cast("bigint").alias("items_purchased"),
        )

    @cached_property
    def price_points(self) -> DataFrame:
        return self.entities["products"].select("product_id", F.explode("price_history").alias("p")).select(
            "product_id", "p.date", cents("p.price").alias("price")
        )
