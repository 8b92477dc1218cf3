"""Schemas of the sources and the star, and the values the business rules allow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
AMOUNT = T.DecimalType(28, 4)

# Column that remembers where a staged row stood in its source: `part` orders
# whole file splits (or key ranges), `row` orders the rows inside one of them.
POSITION = "_pos"

# Parsed date of a staged order, null where its text is no valid date.
ORDER_DAY = "order_day"

# What a source may add to its staged rows: the text of a date that could not be read, the
# cells whose text did not fit their type, and a line with a wrong number of fields.
UNREAD_DATE = "_unread_date"
REJECTED = "_rejected"
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class SourceSchema:
    """Typed columns a source must deliver, and which of them is its key."""

    name: str
    key: str
    columns: tuple[tuple[str, T.DataType], ...]

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]


CUSTOMERS = SourceSchema(
    "customers",
    "customer_id",
    (
        ("customer_id", T.LongType()),
        ("first_name", T.StringType()),
        ("last_name", T.StringType()),
        ("email", T.StringType()),
        ("city", T.StringType()),
        ("signup_date", T.StringType()),
    ),
)
PRODUCTS = SourceSchema(
    "products",
    "product_id",
    (
        ("product_id", T.LongType()),
        ("product_name", T.StringType()),
        ("category_name", T.StringType()),
        ("price", MONEY),
        ("stock", T.LongType()),
    ),
)
ORDERS = SourceSchema(
    "orders",
    "order_id",
    (
        ("order_id", T.LongType()),
        ("customer_id", T.LongType()),
        ("product_id", T.LongType()),
        ("quantity", T.LongType()),
        ("order_date", T.StringType()),
        ("payment_type", T.StringType()),
        ("status", T.StringType()),
        ("updated_at", T.StringType()),
    ),
)
SOURCES = {s.name: s for s in (CUSTOMERS, PRODUCTS, ORDERS)}


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


# The five star tables, dimensions first: a fact row is only written once every
# dimension it points at is in place.
STAR_SCHEMAS: dict[str, T.StructType] = {
    "DimCategory": _struct(
        ("CategoryKey", T.LongType()),
        ("CategoryName", T.StringType()),
    ),
    "DimCustomer": _struct(
        ("CustomerKey", T.LongType()),
        ("FullName", T.StringType()),
        ("Email", T.StringType()),
        ("City", T.StringType()),
        ("SignupDate", T.StringType()),
    ),
    "DimProduct": _struct(
        ("ProductKey", T.LongType()),
        ("ProductName", T.StringType()),
        ("Price", MONEY),
        ("Stock", T.LongType()),
        ("CategoryKey", T.LongType()),
    ),
    "DimDate": _struct(
        ("DateKey", T.IntegerType()),
        ("FullDate", T.DateType()),
        ("Year", T.IntegerType()),
        ("Month", T.IntegerType()),
        ("Day", T.IntegerType()),
        ("Quarter", T.IntegerType()),
        ("MonthName", T.StringType()),
        ("DayOfWeek", T.StringType()),
    ),
    "FactOrder": _struct(
        ("OrderKey", T.LongType()),
        ("CustomerKey", T.LongType()),
        ("ProductKey", T.LongType()),
        ("DateKey", T.IntegerType()),
        ("Quantity", T.LongType()),
        ("OrderDate", T.DateType()),
        ("PaymentType", T.StringType()),
        ("Status", T.StringType()),
        ("UpdatedAt", T.StringType()),
        ("TotalAmount", AMOUNT),
    ),
}
DIMENSIONS = [name for name in STAR_SCHEMAS if name != "FactOrder"]

PRIMARY_KEYS = {
    "DimCategory": "CategoryKey",
    "DimCustomer": "CustomerKey",
    "DimProduct": "ProductKey",
    "DimDate": "DateKey",
    "FactOrder": "OrderKey",
}
REQUIRED_NAMES = {
    "DimCategory": "CategoryName",
    "DimProduct": "ProductName",
    "DimCustomer": "FullName",
}
# (child table, column, parent table); the parent column is the parent's key.
FOREIGN_KEYS = (
    ("FactOrder", "CustomerKey", "DimCustomer"),
    ("FactOrder", "ProductKey", "DimProduct"),
    ("DimProduct", "CategoryKey", "DimCategory"),
    ("FactOrder", "DateKey", "DimDate"),
)


# Formats that a source's dates are tried by, where the rules name none: month before day where
# both are possible.
DATE_FORMATS = (
    "yyyy-M-d",
    "M/d/yyyy",
    "d/M/yyyy",
    "yyyy/M/d",
    "M-d-yyyy",
    "d-M-yyyy",
    "M.d.yyyy",
    "d.M.yyyy",
    "yyyyMMdd",
    "d MMM yyyy",
    "MMM d, yyyy",
)


@dataclass(frozen=True)
class Rules:
    """What counts as valid; a deployment may bring its own lists and formats.

    Without date formats, the first readable date of a source decides its format.
    """

    # Fixed values.
    payments: tuple[str, ...] = (
        "Credit Card",
        "Debit Card",
        "Cash on Delivery",
        "Bank Transfer",
        "UPI",
    )
    statuses: tuple[str, ...] = ("Delivered", "Shipped", "Processing", "Cancelled")
    date_formats: tuple[str, ...] = ()


DEFAULT_RULES = Rules()
