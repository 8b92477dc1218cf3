"""One callable per query, each reading the trade tables in a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.dates import iso_text
from orderloom.functions.predicates import not_listed_or_null
from orderloom.functions.text import full_name, null_if_token, strip
from orderloom.model import Star
from orderloom.operators.dedupe import distinct_values, first_appearance, keep_first
from orderloom.operators.integrity import duplicate_keys, orphan_keys
from orderloom.plans import reports
from orderloom.plans.checks import gates_of, null_links_of, summarize
from orderloom.plans.issues import find_issues, issue_changes, order_rules, source_issues
from orderloom.plans.job import RunResult, run_pipeline
from orderloom.plans.star import (
    build_category,
    build_fact,
    build_prices,
    build_product,
    build_star,
    run_sql,
    valid_orders,
)
from orderloom.schemas import CUSTOMERS, ORDER_DAY, ORDERS, POSITION, PRODUCTS, UNREAD_DATE
from orderloom.session import scratch_folder
from orderloom.sources.csv_files import read_csv, read_orders
from orderloom.sources.mart import read_run_log, read_star
from orderloom.sources.trade_tables import (
    TRADE_RULES,
    stage_customers,
    stage_orders,
    stage_products,
    stage_trade,
)

Query = Callable[[SparkSession, str], DataFrame]

WEEKDAY_SALES = """
    SELECT d.DayOfWeek                                   AS weekday,
           COUNT(o.OrderKey)                             AS orders,
           CAST(ROUND(SUM(o.TotalAmount), 2) AS DOUBLE)  AS revenue
    FROM FactOrder o
    JOIN DimDate d ON d.DateKey = o.DateKey
    WHERE o.Quantity >= :least_units
    GROUP BY d.DayOfWeek
"""


def trade_star(spark: SparkSession, folder: str) -> Star:
    return build_star(stage_trade(spark, folder))


def trade_run(spark: SparkSession, folder: str, root: str | None = None) -> RunResult:
    """Publish a mart of the trade tables into the cluster's shared folder."""
    return run_pipeline(
        spark, stage_trade(spark, folder), root or scratch_folder(spark), TRADE_RULES
    )


def with_double(rows: DataFrame, *columns: str) -> DataFrame:
    """Decimals as doubles, for comparing results across engines."""
    return rows.withColumns({c: F.col(c).cast("double") for c in columns})


# Sources, sinks, SQL text


def csv_roundtrip_customers(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark)
    (
        stage_customers(spark, folder)
        .drop(POSITION)
        .write.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return read_csv(spark, path, CUSTOMERS).select(*CUSTOMERS.column_names)


def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of orders that went through CSV with quantities that are no whole numbers."""
    path = scratch_folder(spark)
    key = F.col("order_id")
    quantity = (
        F.when(key % 7 == 0, F.lit("many"))
        .when(key % 11 == 0, F.lit("2.5"))
        .otherwise(F.col("quantity").cast("string"))
    )
    dated = F.coalesce(iso_text(F.col(ORDER_DAY)), F.col(UNREAD_DATE))
    (
        stage_orders(spark, folder)
        .withColumns({"quantity": quantity, "order_date": dated})
        .select(*ORDERS.column_names)
        .write.option("header", True)
        .csv(path)
    )
    return source_issues(read_orders(spark, path, TRADE_RULES), ORDERS, order_rules(TRADE_RULES))


def csv_padded_header(spark: SparkSession, folder: str) -> DataFrame:
    """Products that went through CSV under column names with blanks around them."""
    path = scratch_folder(spark)
    rows = stage_products(spark, folder).drop(POSITION)
    (
        rows.toDF(*[f" {name}  " if i % 2 else f"{name}\t" for i, name in enumerate(rows.columns)])
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return with_double(read_csv(spark, path, PRODUCTS).select(*PRODUCTS.column_names), "price")


# Rows that a task sorts for one CSV file.
ROWS_PER_FILE = 1_000_000


def csv_files_of(rows: int) -> int:
    """Files for so many rows, so that no task sorts more of them as a table grows."""
    return max(8, -(-rows // ROWS_PER_FILE))


def csv_elected_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Days of orders whose file writes them month first, with some written otherwise."""
    path = scratch_folder(spark)
    day, key = F.col(ORDER_DAY), F.col("order_id")
    text = F.when(key % 13 == 0, iso_text(day)).otherwise(F.date_format(day, "MM/dd/yyyy"))
    written = stage_orders(spark, folder).where(day.isNotNull()).withColumn("order_date", text)
    (
        written.select(*ORDERS.column_names)
        .repartitionByRange(
            csv_files_of(spark.read.parquet(f"{folder}/lineitem.parquet").count()),
            key % 13 == 0,
            "order_id",
        )
        .sortWithinPartitions(key % 13 == 0, "order_id")
        .write.option("header", True)
        .csv(path)
    )
    return read_orders(spark, path).select(
        "order_id", iso_text(day).alias("day"), F.col(UNREAD_DATE).alias("unread")
    )


def source_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counted rows of each source beside the number that a run observed as it staged them."""
    root = scratch_folder(spark)
    run = trade_run(spark, folder, root)
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"), "row_count"
        )
        for name, rows in stage_trade(spark, folder).items()
    ]
    logged = read_run_log(spark, root).where(
        (F.col("run_id") == run.run_id) & (F.col("kind") == "source")
    )
    observed = logged.select(
        F.col("table_name").alias("source"), F.col("row_count").alias("observed_rows")
    )
    return counts[0].union(counts[1]).union(counts[2]).join(observed, "source")


def star_publish_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counted and logged rows per table after two runs into one mart."""
    root = scratch_folder(spark)
    trade_run(spark, folder, root)
    last = trade_run(spark, folder, root)
    logged = read_run_log(spark, root).where(
        (F.col("run_id") == last.run_id) & (F.col("kind") == "table")
    )
    counts = [
        rows.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, rows in read_star(spark, root).items()
    ]
    counted = counts[0]
    for count in counts[1:]:
        counted = counted.union(count)
    return counted.join(
        logged.select("table_name", F.col("row_count").alias("logged_rows")), "table_name"
    )


def sql_text_report(spark: SparkSession, folder: str) -> DataFrame:
    return run_sql(spark, trade_star(spark, folder), WEEKDAY_SALES, least_units=10)


# Star


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return trade_star(spark, folder).DimCustomer


def dim_category(spark: SparkSession, folder: str) -> DataFrame:
    return trade_star(spark, folder).DimCategory


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return with_double(trade_star(spark, folder).DimProduct, "Price")


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return trade_star(spark, folder).DimDate.withColumn("FullDate", F.col("FullDate").cast("string"))


def _shown_fact(fact: DataFrame) -> DataFrame:
    return with_double(fact, "TotalAmount").withColumn(
        "OrderDate", F.col("OrderDate").cast("string")
    )


def fact_order(spark: SparkSession, folder: str) -> DataFrame:
    return _shown_fact(trade_star(spark, folder).FactOrder)


# Cleaning, de-duplication, lookups


def normalize_strings(spark: SparkSession, folder: str) -> DataFrame:
    """Trimming, null tokens and list tests on customers with padded cells."""
    key = F.col("customer_id")
    padded = F.concat(F.lit("\t "), F.col("first_name"), F.lit(" \n"))
    cell = (
        F.when(key % 13 == 0, F.lit("N/A"))
        .when(key % 13 == 1, F.lit("null"))
        .when(key % 13 == 2, F.lit(" NA "))
        .otherwise(F.col("last_name"))
    )
    listed = F.when(key % 11 != 0, F.col("first_name"))
    return stage_customers(spark, folder).select(
        "customer_id",
        strip(padded).alias("first_name"),
        full_name(padded, F.when(key % 7 != 0, F.col("last_name"))).alias("full_name"),
        null_if_token(cell).alias("cell"),
        not_listed_or_null(strip(listed), ["BUILDING", "MACHINERY"]).alias("unlisted"),
    )


def _with_copies(rows: DataFrame, key: str, dirtied: str) -> DataFrame:
    """A table, less each fifth key, followed by a dirtied copy of all of it."""
    first = rows.where(F.col(key) % 5 != 0).withColumn("_copy", F.lit(0))
    copy = rows.withColumn(dirtied, F.concat(F.lit("copy "), dirtied)).withColumn(
        "_copy", F.lit(1)
    )
    place = F.struct(F.col("_copy").alias("part"), F.col(key).alias("row"))
    return first.unionByName(copy).withColumn(POSITION, place).drop("_copy")


def dedupe_customers(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_copies(stage_customers(spark, folder), "customer_id", "city")
    return keep_first(rows, "customer_id").select("customer_id", "last_name", "city")


def dedupe_products(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_copies(stage_products(spark, folder), "product_id", "product_name")
    return keep_first(rows, "product_id").select("product_id", "product_name", "stock")


def dedupe_orders(spark: SparkSession, folder: str) -> DataFrame:
    rows = keep_first(valid_orders(stage_orders(spark, folder)), "order_id")
    return rows.select(
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        iso_text(F.col(ORDER_DAY)).alias("order_date"),
        "updated_at",
    )


def distinct_categories(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage_products(spark, folder).withColumn("category_name", strip(F.col("category_name")))
    return first_appearance(rows, "category_name").select(
        "category_name", F.col(f"{POSITION}.row").alias("first_product")
    )


def distinct_dates(spark: SparkSession, folder: str) -> DataFrame:
    days = distinct_values(stage_orders(spark, folder), ORDER_DAY)
    return days.select(iso_text(F.col(ORDER_DAY)).alias("day"))


def amount_lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    """Amounts for known, unpriced and, as some products are left out, unknown products."""
    staged = stage_trade(spark, folder)
    prices = build_prices(staged.products.where(F.col("product_id") % 50 != 0))
    fact = build_fact(staged.orders, prices)
    return with_double(
        fact.select("OrderKey", "ProductKey", "Quantity", "TotalAmount"), "TotalAmount"
    )


# Reports


def _report(report: Callable[[Star], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return report(trade_star(spark, folder))

    return query


def stored_reports(spark: SparkSession, folder: str) -> DataFrame:
    """All six stored reports with their ranks, from one pass over the fact of a published mart."""
    star = reports.summed_star(trade_run(spark, folder).star(spark))
    return reports.stored_reports(star)


def dashboard_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """The four feeds over a published mart, stacked under their names."""
    feeds = [
        rows.select(F.lit(name).alias("feed"), "label", "value")
        for name, rows in reports.dashboard_feeds(
            trade_run(spark, folder).star(spark)
        ).items()
    ]
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.unionByName(feed)
    return merged


def headline_insights(spark: SparkSession, folder: str) -> DataFrame:
    return reports.headline_insights(trade_run(spark, folder).star(spark))


# Quality


def dq_issues(spark: SparkSession, folder: str) -> DataFrame:
    return find_issues(stage_trade(spark, folder), TRADE_RULES)


def dq_issue_changes(spark: SparkSession, folder: str) -> DataFrame:
    """What changed in the issues of two runs into one mart: the first had fewer payment types
    allowed and knew more e-mail addresses."""
    root = scratch_folder(spark)
    later = stage_trade(spark, folder)
    known = F.when(F.col("customer_id") % 3 == 0, F.lit("known@example.com"))
    earlier = replace(
        later, customers=later.customers.withColumn("email", F.coalesce(known, "email"))
    )
    strict = replace(TRADE_RULES, payments=TRADE_RULES.payments[1:])
    runs = [
        run_pipeline(spark, source, root, rules)
        for source, rules in ((earlier, strict), (later, TRADE_RULES))
    ]
    return issue_changes(*(run.issues(spark) for run in runs))


def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    return trade_run(spark, folder).report(spark)


def dq_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarize(dq_report(spark, folder))


def dq_gates(spark: SparkSession, folder: str) -> DataFrame:
    """The gates, all zero, and the rows with a null foreign key."""
    metrics = trade_run(spark, folder).metrics(spark)
    return gates_of(metrics).unionByName(null_links_of(metrics))


def _orphans(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(F.col(key).alias("orphan_key"), F.col("_rows").alias("row_count"))


def orphan_customers(spark: SparkSession, folder: str) -> DataFrame:
    star = trade_star(spark, folder)
    known = star.DimCustomer.where(F.col("CustomerKey") % 40 != 0)
    return _orphans(
        orphan_keys(star.FactOrder, "CustomerKey", known, "CustomerKey"), "CustomerKey"
    )


def orphan_products(spark: SparkSession, folder: str) -> DataFrame:
    star = trade_star(spark, folder)
    known = star.DimProduct.where(F.col("ProductKey") % 50 != 0)
    return _orphans(orphan_keys(star.FactOrder, "ProductKey", known, "ProductKey"), "ProductKey")


def orphan_categories(spark: SparkSession, folder: str) -> DataFrame:
    products = stage_products(spark, folder)
    category = build_category(products)
    known = category.where(F.col("CategoryKey") != 1)
    return _orphans(
        orphan_keys(build_product(products, category), "CategoryKey", known, "CategoryKey"),
        "CategoryKey",
    )


def orphan_dates(spark: SparkSession, folder: str) -> DataFrame:
    star = trade_star(spark, folder)
    known = star.DimDate.where(F.col("Day") != 1)
    return _orphans(orphan_keys(star.FactOrder, "DateKey", known, "DateKey"), "DateKey")


def duplicate_order_keys(spark: SparkSession, folder: str) -> DataFrame:
    copies = duplicate_keys(stage_orders(spark, folder), "order_id")
    return copies.select("order_id", F.col("_rows").alias("copies"))


QUERIES: dict[str, Query] = {
    "csv_roundtrip_customers": csv_roundtrip_customers,
    "csv_rejects": csv_rejects,
    "csv_padded_header": csv_padded_header,
    "csv_elected_dates": csv_elected_dates,
    "source_row_counts": source_row_counts,
    "star_publish_counts": star_publish_counts,
    "sql_text_report": sql_text_report,
    "dim_customer": dim_customer,
    "dim_category": dim_category,
    "dim_product": dim_product,
    "dim_date": dim_date,
    "fact_order": fact_order,
    "normalize_strings": normalize_strings,
    "dedupe_customers": dedupe_customers,
    "dedupe_products": dedupe_products,
    "dedupe_orders": dedupe_orders,
    "distinct_categories": distinct_categories,
    "distinct_dates": distinct_dates,
    "amount_lookup_default": amount_lookup_default,
    "top_customers_by_orders": _report(reports.top_customers_by_orders),
    "top_customers_with_city": _report(reports.top_customers_with_city),
    "orders_by_city": _report(reports.order_distribution_by_city),
    "city_revenue": _report(reports.city_revenue),
    "monthly_trend": _report(reports.monthly_order_trend),
    "monthly_revenue": _report(reports.monthly_revenue),
    "category_sales": _report(reports.sales_by_category),
    "category_revenue": _report(reports.sales_by_category),
    "payment_breakdown": _report(reports.payment_method_breakdown),
    "payment_revenue": _report(reports.payment_method_breakdown),
    "top_products_by_units": _report(reports.top_products_by_quantity),
    "product_sales": _report(reports.product_sales),
    "status_share": _report(reports.status_distribution),
    "quarterly_revenue": _report(reports.quarterly_revenue),
    "headline_insights": headline_insights,
    "stored_reports": stored_reports,
    "dashboard_feeds": dashboard_feeds,
    "dq_issues": dq_issues,
    "dq_issue_changes": dq_issue_changes,
    "dq_report": dq_report,
    "dq_summary": dq_summary,
    "dq_gates": dq_gates,
    "orphan_customers": orphan_customers,
    "orphan_products": orphan_products,
    "orphan_categories": orphan_categories,
    "orphan_dates": orphan_dates,
    "duplicate_order_keys": duplicate_order_keys,
}
