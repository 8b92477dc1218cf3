"""The star: four dimensions around the order fact, as lazy plans."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.dates import date_key, date_parts
from orderloom.functions.numbers import line_amount
from orderloom.functions.text import full_name, strip
from orderloom.model import Staged, Star
from orderloom.operators.dedupe import distinct_values, first_appearance, keep_first
from orderloom.operators.lookup import MATCHED, left_lookup
from orderloom.operators.surrogate import dense_keys
from orderloom.schemas import ORDER_DAY, POSITION, STAR_SCHEMAS


def conform(rows: DataFrame, table: str) -> DataFrame:
    """Exactly the table's columns, in its order and types; null where a value does not fit."""
    return rows.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in STAR_SCHEMAS[table]]
    )


def build_customer(customers: DataFrame) -> DataFrame:
    return keep_first(customers, "customer_id").select(
        F.col("customer_id").alias("CustomerKey"),
        full_name(F.col("first_name"), F.col("last_name")).alias("FullName"),
        F.col("email").alias("Email"),
        F.col("city").alias("City"),
        F.col("signup_date").alias("SignupDate"),
    )


def build_category(products: DataFrame) -> DataFrame:
    """Distinct trimmed names over all products, copies too, numbered as they appear."""
    named = products.select(strip(F.col("category_name")).alias("CategoryName"), POSITION)
    numbered = dense_keys(first_appearance(named, "CategoryName"), "CategoryKey")
    return conform(numbered, "DimCategory")


def build_product(products: DataFrame, category: DataFrame) -> DataFrame:
    """First row per product with its category's key, null for an unknown category.

    The lookup comes first, as the shuffle of the de-duplication then leaves Spark
    free to split a category that owns much of the products.
    """
    keyed = left_lookup(products, strip(F.col("category_name")), category, "CategoryName")
    return keep_first(keyed, "product_id").select(
        F.col("product_id").alias("ProductKey"),
        F.col("product_name").alias("ProductName"),
        F.col("price").alias("Price"),
        F.col("stock").alias("Stock"),
        "CategoryKey",
    )


def build_date(orders: DataFrame) -> DataFrame:
    """One row per valid order date that occurs, dates of copied orders included."""
    days = distinct_values(orders, ORDER_DAY)
    return conform(days.select(*date_parts(F.col(ORDER_DAY))), "DimDate")


def valid_orders(orders: DataFrame) -> DataFrame:
    """Orders with a valid date; the only rule that drops rows."""
    return orders.where(F.col(ORDER_DAY).isNotNull())


def build_prices(products: DataFrame) -> DataFrame:
    """Key and price as the product dimension has them, without its category lookup."""
    return keep_first(products, "product_id").select(
        F.col("product_id").alias("ProductKey"), F.col("price").alias("Price")
    )


def with_amount(
    orders: DataFrame, prices: DataFrame, counted_prices: int | None = None
) -> DataFrame:
    """Add price times quantity by a lookup of the product's price."""
    priced = left_lookup(
        orders,
        F.col("product_id"),
        prices.select("ProductKey", "Price"),
        "ProductKey",
        counted_prices,
    )
    amount = line_amount(F.col(MATCHED), F.col("Price"), F.col("quantity"))
    return priced.withColumn("TotalAmount", amount).drop(MATCHED, "Price")


def first_orders(orders: DataFrame) -> DataFrame:
    """The first valid row of each order, without what only reading and ranking want."""
    return keep_first(valid_orders(orders), "order_id").select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        ORDER_DAY,
        "payment_type",
        "status",
        "updated_at",
    )


def fact_of(priced: DataFrame) -> DataFrame:
    """The fact out of one row per order with its amount."""
    return conform(
        priced.select(
            F.col("order_id").alias("OrderKey"),
            F.col("customer_id").alias("CustomerKey"),
            F.col("product_id").alias("ProductKey"),
            date_key(F.col(ORDER_DAY)).alias("DateKey"),
            F.col("quantity").alias("Quantity"),
            F.col(ORDER_DAY).alias("OrderDate"),
            F.col("payment_type").alias("PaymentType"),
            F.col("status").alias("Status"),
            F.col("updated_at").alias("UpdatedAt"),
            "TotalAmount",
        ),
        "FactOrder",
    )


def build_fact(
    orders: DataFrame, prices: DataFrame, counted_prices: int | None = None
) -> DataFrame:
    """The first valid row of each order, priced by the product dimension or its prices.

    Prices are looked up before the de-duplication: its shuffle by order lets Spark
    split a hot product in the join, which a report grouping by product would not. A run, which
    writes the fact at once, looks them up afterwards (`first_orders`, `with_amount`, `fact_of`).
    `counted_prices` is the number of prices, if the caller has counted them.
    """
    priced = with_amount(valid_orders(orders), prices, counted_prices)
    return fact_of(keep_first(priced, "order_id"))


def build_star(staged: Staged) -> Star:
    star = Star(
        DimCategory=lambda: build_category(staged.products),
        DimCustomer=lambda: build_customer(staged.customers),
        DimProduct=lambda: build_product(staged.products, star.DimCategory),
        DimDate=lambda: build_date(staged.orders),
        FactOrder=lambda: build_fact(staged.orders, build_prices(staged.products)),
    )
    return star


@contextmanager
def visible(spark: SparkSession, star: Star) -> Iterator[None]:
    """Make the tables visible to SQL text under their names, and leave the session as it was."""
    names = [name for name, _ in star.items()]
    temporary = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    hidden = {name: spark.table(name) for name in names if name.lower() in temporary}
    for name, table in star.items():
        table.createOrReplaceTempView(name)
    try:
        yield
    finally:
        for name in names:
            if name in hidden:
                hidden[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def run_sql(spark: SparkSession, star: Star, text: str, **args: object) -> DataFrame:
    """Run SQL text over the star; `args` fill its :named parameters.

    The text is resolved at once, so the frame outlives the names.
    """
    with visible(spark, star):
        return spark.sql(text, args=args)
