"""The reports over a star, each a lazy frame with its rows in report order.

Facts are summed by foreign key first, then joined to the dimension and summed
again, so joins see one row per key. Ties are broken by the group columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.numbers import percent_of, rounded
from orderloom.operators.rollup import measure_by, roll_up, sums_by_each
from orderloom.model import Star
from orderloom.session import scratch_folder

ORDERS, ROWS, UNITS, REVENUE = "orders", "rows", "units", "revenue"
# Fact columns that some report groups by, itself or through a dimension.
FACT_KEYS = ("CustomerKey", "ProductKey", "DateKey", "PaymentType", "Status")

# Names of result columns, each with what it measures.
Measures = Mapping[str, str]


def _aggregates() -> dict[str, Column]:
    return {
        ORDERS: F.count("OrderKey"),
        ROWS: F.count(F.lit(1)),
        UNITS: F.sum("Quantity"),
        REVENUE: F.sum("TotalAmount"),
    }


class SummedStar(Star):
    """A star whose fact has been summed by each of its keys; every report runs on it alike."""

    def __init__(self, star: Star, sums: DataFrame):
        super().__init__(**{name: lambda name=name: star.table(name) for name, _ in star.pairs()})
        self._sums = sums

    def partial(self, key: str, measures: Measures) -> DataFrame:
        own = self._sums.where(F.col("grain") == key)
        return own.select(key, *[F.col(kind).alias(name) for name, kind in measures.items()])


def summed_star(star: Star, folder: str | None = None) -> SummedStar:
    """Read the fact once, sum it by every key, and keep the sums below the folder.

    The folder is a new one in the cluster's shared scratch folder unless another is named. One
    part per key is written, so a report reads only the sums it needs.
    """
    spark = star.FactOrder.sparkSession
    path = folder or scratch_folder(spark)
    sums = sums_by_each(star.FactOrder, FACT_KEYS, _aggregates())
    sums.write.partitionBy("grain").parquet(path)
    stored = spark.read.schema(sums.schema).parquet(path)
    return SummedStar(star, stored)


def _partial(star: Star, key: str, measures: Measures) -> DataFrame:
    """One row per key of the fact with its measures."""
    if isinstance(star, SummedStar):
        return star.partial(key, measures)
    kinds = _aggregates()
    return measure_by(star.FactOrder, [key], {name: kinds[k] for name, k in measures.items()})


def _limit(n: int) -> int:
    if isinstance(n, bool) or not isinstance(n, int) or n < 0:
        raise ValueError(f"n must be a whole number of rows, not {n!r}")
    return n


def _ranked(rows: DataFrame, measure: str, keys: Sequence[str]) -> DataFrame:
    """Largest first, ties by the group columns."""
    return rows.orderBy(F.col(measure).desc(), *keys)


def _with_rounded(rows: DataFrame, revenue: str) -> DataFrame:
    return rows.withColumn(revenue, rounded(F.col(revenue)))


def by_customer(star: Star, by: Sequence[str], measures: Measures) -> DataFrame:
    partial = _partial(star, "CustomerKey", measures)
    return roll_up(partial, star.DimCustomer, "CustomerKey", by, measures)


def by_date(star: Star, by: Sequence[str], measures: Measures) -> DataFrame:
    partial = _partial(star, "DateKey", measures)
    return roll_up(partial, star.DimDate, "DateKey", by, measures)


def by_product(star: Star, by: Sequence[str], measures: Measures) -> DataFrame:
    """Over the chain fact, product, category; `by` may name columns of both."""
    partial = _partial(star, "ProductKey", measures)
    own = [name for name in by if name in star.DimProduct.columns]
    per_category = roll_up(
        partial, star.DimProduct, "ProductKey", [*own, "CategoryKey"], measures
    )
    return roll_up(per_category, star.DimCategory, "CategoryKey", by, measures)


def top_customers_by_orders(star: Star, n: int = 5) -> DataFrame:
    """The n customers with most orders; customers of one name count as one."""
    counts = by_customer(star, ["FullName"], {"TotalOrders": ORDERS})
    named = counts.withColumnRenamed("FullName", "Customer")
    return _ranked(named, "TotalOrders", ["Customer"]).limit(_limit(n))


def top_customers_with_city(star: Star, n: int = 5) -> DataFrame:
    """As above, but customers of one name are told apart by their city."""
    counts = by_customer(star, ["FullName", "City"], {"TotalOrders": ORDERS})
    named = counts.withColumnRenamed("FullName", "Customer")
    return _ranked(named, "TotalOrders", ["Customer", "City"]).limit(_limit(n))


def order_distribution_by_city(star: Star) -> DataFrame:
    return _ranked(by_customer(star, ["City"], {"OrderCount": ORDERS}), "OrderCount", ["City"])


def city_revenue(star: Star) -> DataFrame:
    measures = {"OrderCount": ORDERS, "CityRevenue": REVENUE}
    totals = by_customer(star, ["City"], measures)
    return _ranked(_with_rounded(totals, "CityRevenue"), "OrderCount", ["City"])


def _monthly(star: Star, revenue: str) -> DataFrame:
    measures = {"TotalOrders": ORDERS, "TotalUnits": UNITS, revenue: REVENUE}
    totals = by_date(star, ["Year", "Month", "MonthName"], measures)
    return _with_rounded(totals, revenue).orderBy("Year", "Month")


def monthly_order_trend(star: Star) -> DataFrame:
    return _monthly(star, "Revenue")


def monthly_revenue(star: Star) -> DataFrame:
    return _monthly(star, "MonthlyRevenue")


def quarterly_revenue(star: Star) -> DataFrame:
    measures = {"TotalOrders": ORDERS, "QuarterlyRevenue": REVENUE}
    totals = by_date(star, ["Year", "Quarter"], measures)
    return _with_rounded(totals, "QuarterlyRevenue").orderBy("Year", "Quarter")


def sales_by_category(star: Star) -> DataFrame:
    measures = {"TotalUnitsSold": UNITS, "TotalRevenue": REVENUE}
    totals = by_product(star, ["CategoryName"], measures)
    return _ranked(_with_rounded(totals, "TotalRevenue"), "TotalRevenue", ["CategoryName"])


def _product_totals(star: Star, revenue: str) -> DataFrame:
    names = ["ProductName", "CategoryName"]
    measures = {"TotalQuantity": UNITS, revenue: REVENUE}
    totals = by_product(star, names, measures)
    return _ranked(_with_rounded(totals, revenue), "TotalQuantity", names)


def top_products_by_quantity(star: Star, n: int = 5) -> DataFrame:
    """The n products sold most; equal names in one category count as one."""
    return _product_totals(star, "Revenue").limit(_limit(n))


def product_sales(star: Star) -> DataFrame:
    return _product_totals(star, "TotalRevenue")


def payment_method_breakdown(star: Star) -> DataFrame:
    measures = {"OrderCount": ROWS, "Revenue": REVENUE}
    totals = _partial(star, "PaymentType", measures)
    return _ranked(_with_rounded(totals, "Revenue"), "OrderCount", ["PaymentType"])


def _with_share(counts: DataFrame, name: str) -> DataFrame:
    """Add each row's share of all OrderCount; the total is a scalar subquery."""
    total = counts.select(F.sum("OrderCount")).scalar()
    return counts.withColumn(name, percent_of(F.col("OrderCount"), total))


def status_distribution(star: Star) -> DataFrame:
    counts = _partial(star, "Status", {"OrderCount": ROWS})
    return _ranked(_with_share(counts, "Percentage"), "OrderCount", ["Status"])


def _leaders(rows: DataFrame, measure: str) -> DataFrame:
    """Every row that shares the largest measure."""
    return rows.where(F.col(measure) == rows.select(F.max(measure)).scalar())


def _insight(rows: DataFrame, name: str, label: Column, value: Column, share: Column) -> DataFrame:
    return rows.select(
        F.lit(name).alias("insight"),
        label.cast("string").alias("label"),
        value.cast("string").alias("value"),
        share.cast("string").alias("share"),
    )


def total_rows(star: Star) -> DataFrame:
    """One row: how many tables there are and how many rows they hold together."""
    counts = [table.agg(F.count(F.lit(1)).alias("rows")) for _, table in star.items()]
    all_counts = counts[0]
    for count in counts[1:]:
        all_counts = all_counts.union(count)
    return all_counts.agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"))


def headline_insights(star: Star) -> DataFrame:
    """Leaders by city, payment, category and customer, and the rows loaded.

    Leaders that tie are all listed.
    """
    none = F.lit(None)
    cities = by_customer(star, ["City"], {"OrderCount": ORDERS})
    payments = _with_share(_partial(star, "PaymentType", {"OrderCount": ROWS}), "Share")
    categories = by_product(star, ["CategoryName"], {"Revenue": REVENUE}).withColumn(
        "Revenue", F.round("Revenue", 2).cast("decimal(38,2)")
    )
    customers = by_customer(star, ["FullName"], {"TotalOrders": ORDERS})
    col = F.col
    parts = [
        _insight(
            _leaders(cities, "OrderCount"), "top city", col("City"), col("OrderCount"), none
        ),
        _insight(
            _leaders(payments, "OrderCount"),
            "top payment",
            col("PaymentType"),
            col("OrderCount"),
            col("Share"),
        ),
        _insight(
            _leaders(categories, "Revenue"),
            "top category",
            col("CategoryName"),
            col("Revenue"),
            none,
        ),
        _insight(
            _leaders(customers, "TotalOrders"),
            "top customer",
            col("FullName"),
            col("TotalOrders"),
            none,
        ),
        _insight(total_rows(star), "rows loaded", col("tables"), col("rows"), none),
    ]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


def dashboard_feeds(star: Star, n: int = 5) -> dict[str, DataFrame]:
    """(label, value) frames for the four dashboard visuals."""
    col = F.col

    def feed(rows: DataFrame, label: Column, value: str) -> DataFrame:
        return rows.select(label.alias("label"), col(value).alias("value"))

    month = F.format_string("%04d-%02d", col("Year"), col("Month"))
    units = by_product(star, ["CategoryName"], {"Units": UNITS})
    months = by_date(star, ["Year", "Month"], {"TotalOrders": ORDERS})
    return {
        "customers by orders": feed(
            top_customers_by_orders(star, n), col("Customer"), "TotalOrders"
        ),
        "orders by city": feed(order_distribution_by_city(star), col("City"), "OrderCount"),
        "orders by month": feed(months.orderBy("Year", "Month"), month, "TotalOrders"),
        "units by category": feed(
            _ranked(units, "Units", ["CategoryName"]), col("CategoryName"), "Units"
        ),
    }


def all_reports(star: Star, n: int = 5) -> dict[str, DataFrame]:
    """The six stored reports by name, none of them run yet; over a `SummedStar`, all from one
    pass over the fact."""
    return {
        "top_customers_by_orders": top_customers_by_orders(star, n),
        "order_distribution_by_city": order_distribution_by_city(star),
        "monthly_order_trend": monthly_order_trend(star),
        "sales_by_category": sales_by_category(star),
        "payment_method_breakdown": payment_method_breakdown(star),
        "top_products_by_quantity": top_products_by_quantity(star, n),
    }


# Of each stored report, the order of its rows, largest first where marked, and its columns as
# label, detail, orders, units and revenue.
_STORED = {
    "top_customers_by_orders": (("-TotalOrders", "Customer"), "Customer", None, "TotalOrders", None, None),
    "order_distribution_by_city": (("-OrderCount", "City"), "City", None, "OrderCount", None, None),
    "monthly_order_trend": (("Year", "Month"), "MonthName", "Year", "TotalOrders", "TotalUnits", "Revenue"),
    "sales_by_category": (("-TotalRevenue", "CategoryName"), "CategoryName", None, None, "TotalUnitsSold", "TotalRevenue"),
    "payment_method_breakdown": (("-OrderCount", "PaymentType"), "PaymentType", None, "OrderCount", None, "Revenue"),
    "top_products_by_quantity": (("-TotalQuantity", "ProductName", "CategoryName"), "ProductName", "CategoryName", None, "TotalQuantity", "Revenue"),
}


def stored_reports(star: Star, n: int = 5) -> DataFrame:
    """The six stored reports in one table, each row with its `rank` in its report.

    The rank makes the order part of the result. It is counted over a report's finished rows, one
    per city, month, category or payment type.
    """
    parts = []
    for name, rows in all_reports(star, n).items():
        order, *shown = _STORED[name]
        keys = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in order]
        types = ("string", "string", "bigint", "bigint", "double")
        label, detail, orders, units, revenue = (
            (F.lit(None) if c is None else F.col(c)).cast(t) for c, t in zip(shown, types, strict=True)
        )
        parts.append(
            rows.select(
                F.lit(name).alias("report"),
                F.row_number().over(Window.orderBy(*keys)).alias("rank"),
                label.alias("label"),
                detail.alias("detail"),
                orders.alias("orders"),
                units.alias("units"),
                revenue.alias("revenue"),
            )
        )
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged
