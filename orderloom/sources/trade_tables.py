"""Staging projection of the trade tables (customer, part, orders, lineitem).

They are clean, so some cells are dirtied by key to give the quality rules work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.dates import iso_text, parse_date
from orderloom.model import Staged
from orderloom.schemas import MONEY, ORDER_DAY, POSITION, UNREAD_DATE, Rules

# A range of the position's coarse half spans 2^16 keys.
RANGE_BITS = 16

TRADE_RULES = Rules(
    payments=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"),
    statuses=("F", "O"),
    date_formats=("yyyy-M-d",),
)


TABLES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table by its known columns, which saves a job that would infer them."""
    return spark.read.schema(TABLES[table]).parquet(f"{folder}/{table}.parquet")


def key_position(key: str, *rest: str) -> Column:
    """A position from a business order: the key's range, then the key or the whole order."""
    part = F.shiftright(key, RANGE_BITS)
    row = F.struct(key, *rest) if rest else F.col(key)
    return F.struct(part.alias("part"), row.alias("row"))


def stage_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = _read(spark, folder, "customer")
    nation = _read(spark, folder, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    email = (
        F.when(key % 17 == 0, F.lit(None))
        .when(key % 17 == 1, F.lit("   "))
        .otherwise(F.concat("c_name", F.lit("@example.com")))
    )
    signup = F.date_add(F.lit("1992-01-01").cast("date"), (key % 2000).cast("int"))
    return customer.join(
        nation, customer.c_nationkey == nation.n_nationkey, "left"
    ).select(
        key.alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        email.alias("email"),
        F.col("n_name").alias("city"),
        iso_text(signup).alias("signup_date"),
        key_position("c_custkey").alias(POSITION),
    )


def stage_products(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    price = (
        F.when(key % 61 == 0, F.lit(None))
        .when(key % 61 == 1, F.lit(0))
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)"))
    )
    return _read(spark, folder, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_name"),
        price.cast(MONEY).alias("price"),
        (F.col("p_size") - 3).cast("bigint").alias("stock"),
        key_position("p_partkey").alias(POSITION),
    )


def stage_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One staged order per line item, in the order of all line item columns."""
    lines = _read(spark, folder, "lineitem")
    key = F.col("o_orderkey")
    date_text = F.when(key % 97 == 0, F.lit("not-a-date")).otherwise(
        iso_text(F.col("o_orderdate").cast("date"))
    )
    day = parse_date(date_text, TRADE_RULES.date_formats)
    heads = _read(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer_id"),
        day.alias(ORDER_DAY),
        F.when(day.isNull(), date_text).alias(UNREAD_DATE),
        F.when(key % 89 != 0, F.col("o_orderpriority")).alias("payment_type"),
        F.col("o_orderstatus").alias("status"),
    )
    return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        "customer_id",
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        ORDER_DAY,
        UNREAD_DATE,
        "payment_type",
        "status",
        iso_text(F.col("l_shipdate").cast("date")).alias("updated_at"),
        key_position(*lines.columns).alias(POSITION),
    )


def stage_trade(spark: SparkSession, folder: str) -> Staged:
    return Staged(
        stage_customers(spark, folder),
        stage_products(spark, folder),
        stage_orders(spark, folder),
    )
