"""Row rules over the staged sources: every violation becomes one issue row.

The rules look at all source rows, copies too, and only report; a row may break
several rules. Each source is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.predicates import (
    is_blank,
    negative_or_null,
    not_listed_or_null,
    not_positive,
)
from orderloom.functions.text import full_name, shown, shown_decimal, strip
from orderloom.model import Staged
from orderloom.schemas import (
    CORRUPT,
    CUSTOMERS,
    DEFAULT_RULES,
    ORDER_DAY,
    ORDERS,
    PRODUCTS,
    REJECTED,
    UNREAD_DATE,
    Rules,
    SourceSchema,
)

# The category of an issue, by its source.
CATEGORIES = {
    "customers": "CUSTOMER ERROR",
    "products": "PRODUCT ERROR",
    "orders": "ORDER ERROR",
}

RowRule = tuple[str, Column, Column]


def customer_rules() -> list[RowRule]:
    """(rule, violated when, message) triples over staged customers."""
    name = full_name(F.col("first_name"), F.col("last_name"))
    return [
        (
            "DQ-1",
            is_blank(F.col("email")),
            F.concat(F.lit("No email address for customer "), shown(name)),
        )
    ]


def product_rules() -> list[RowRule]:
    key = shown(F.col("product_id"))
    return [
        (
            "DQ-2",
            not_positive(F.col("price")),
            F.concat(
                F.lit("Price of product "),
                key,
                F.lit(" is not positive: "),
                shown_decimal(F.col("price")),
            ),
        ),
        (
            "DQ-3",
            negative_or_null(F.col("stock")),
            F.concat(F.lit("No stock, or less than none, of product "), key),
        ),
    ]


def order_rules(rules: Rules) -> list[RowRule]:
    key = shown(F.col("order_id"))
    payment = F.col("payment_type")
    return [
        (
            "DQ-4",
            F.col(ORDER_DAY).isNull(),
            F.concat(
                F.lit("Date of order "), key, F.lit(" is not readable: "), shown(F.col(UNREAD_DATE))
            ),
        ),
        (
            "DQ-5",
            not_listed_or_null(strip(payment), rules.payments),
            F.concat(
                F.lit("Payment type of order "),
                key,
                F.lit(" is not allowed: "),
                shown(payment),
            ),
        ),
    ]


def reading_rules(rows: DataFrame) -> list[RowRule]:
    """Rules on how a row was read, for sources that keep track of it."""
    found: list[RowRule] = []
    if REJECTED in rows.columns:
        cell = F.transform(
            REJECTED, lambda x: F.concat(x["column"], F.lit(" '"), x["text"], F.lit("'"))
        )
        listed = F.concat(F.lit("Cells that do not fit their type: "), F.array_join(cell, ", "))
        found.append(("DQ-6", F.size(REJECTED) > 0, listed))
    if CORRUPT in rows.columns:
        line = F.concat(F.lit("Wrong number of fields: "), CORRUPT)
        found.append(("DQ-7", F.col(CORRUPT).isNotNull(), line))
    return found


def source_issues(rows: DataFrame, source: SourceSchema, row_rules: list[RowRule]) -> DataFrame:
    """All violations in one source, by a single pass over its rows."""
    row_rules = [*row_rules, *reading_rules(rows)]
    # Rules that a row keeps are dropped after the array: in it that would be interpreted, and a
    # filter before it would be pushed to the scan and compute all cells once more.
    hits = F.array(
        *[
            F.when(broken, F.struct(F.lit(rule).alias("rule"), message.alias("message")))
            for rule, broken, message in row_rules
        ]
    )
    return (
        rows.select(F.col(source.key).alias("key"), F.explode(hits).alias("hit"))
        .where(F.col("hit").isNotNull())
        .select(
            F.lit(source.name).alias("entity"),
            "key",
            "hit.rule",
            F.lit(CATEGORIES[source.name]).alias("category"),
            "hit.message",
        )
    )


def find_issues(staged: Staged, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return (
        source_issues(staged.customers, CUSTOMERS, customer_rules())
        .unionByName(source_issues(staged.products, PRODUCTS, product_rules()))
        .unionByName(source_issues(staged.orders, ORDERS, order_rules(rules)))
    )


def issue_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """How the issues of two runs differ: rows (entity, rule, key, before, after, change).

    `before` and `after` count the issues of a rule on rows with that key; `change` is new, gone or
    kept. Null keys are one key. Both tables meet in one shuffle of counts.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = before.select("entity", "rule", "key", one.alias("before"), none.alias("after")).unionByName(
        after.select("entity", "rule", "key", none.alias("before"), one.alias("after"))
    )
    counts = both.groupBy("entity", "rule", "key").agg(
        F.sum("before").alias("before"), F.sum("after").alias("after")
    )
    change = (
        F.when(F.col("before") == 0, F.lit("new"))
        .when(F.col("after") == 0, F.lit("gone"))
        .otherwise(F.lit("kept"))
    )
    return counts.withColumn("change", change)
