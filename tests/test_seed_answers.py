"""Answers for a seed of 20 customers, products and orders, kept outside this repository.

SEED_CSV_DIR names the folder with customers.csv, products.csv and orders.csv.
"""

import os

import pytest

from edge_rows import row_set, rows
from orderloom.plans import reports
from orderloom.plans.job import run_pipeline
from orderloom.sources.csv_files import read_csv_sources

SEED = os.environ.get("SEED_CSV_DIR")

pytestmark = pytest.mark.skipif(not SEED, reason="SEED_CSV_DIR is not set")

# Fixed values.
TOP_CUSTOMERS = [
    ("Emily Davis", 2),
    ("Julia Adams", 2),
    ("Paul Sullivan", 2),
    ("Ayşe Martinez", 1),
    ("David Smith", 1),
]
CITIES = [
    ("Tokyo", 4, 630.0),
    ("Istanbul", 3, 5850.0),
    ("Paris", 3, 1650.0),
    ("San Francisco", 3, 460.0),
    ("Sydney", 3, 1080.0),
    ("New York", 2, 1650.0),
    ("Berlin", 1, 150.0),
    ("London", 1, 3600.0),
]
CATEGORIES = [("Furniture", 24, 13050.0), ("Stationery", 11, 1650.0), ("Electronics", 9, 370.0)]
PRODUCTS = [
    ("Notebook", "Furniture", 15, 2250.0),
    ("Monitor", "Stationery", 11, 1650.0),
    ("Monitor", "Furniture", 9, 10800.0),
    ("Desk Chair", "Electronics", 7, 70.0),
    ("Laptop", "Electronics", 2, 300.0),
]
PAYMENTS = [("Debit Card", 9, 8260.0), ("Cash on Delivery", 7, 5130.0), ("Credit Card", 4, 1680.0)]
STATUSES = [("Delivered", 8, 40.0), ("Shipped", 6, 30.0), ("Cancelled", 4, 20.0), ("Processing", 2, 10.0)]
QUARTERS = [
    (2020, 2, 1, 750.0),
    (2021, 1, 2, 780.0),
    (2021, 2, 2, 600.0),
    (2021, 3, 2, 450.0),
    (2021, 4, 2, 600.0),
    (2022, 1, 3, 2550.0),
    (2022, 2, 2, 4950.0),
    (2022, 3, 3, 190.0),
    (2022, 4, 1, 300.0),
    (2023, 1, 2, 3900.0),
]
MONTHS = [
    (2020, 6, "June", 1, 5, 750.0),
    (2021, 1, "January", 2, 8, 780.0),
    (2021, 4, "April", 1, 2, 300.0),
    (2021, 5, "May", 1, 2, 300.0),
    (2021, 7, "July", 1, 1, 150.0),
    (2021, 8, "August", 1, 2, 300.0),
    (2021, 10, "October", 1, 1, 150.0),
    (2021, 12, "December", 1, 3, 450.0),
    (2022, 2, "February", 1, 1, 1200.0),
    (2022, 3, "March", 2, 2, 1350.0),
    (2022, 5, "May", 1, 1, 150.0),
    (2022, 6, "June", 1, 4, 4800.0),
    (2022, 7, "July", 1, 1, 10.0),
    (2022, 9, "September", 2, 4, 180.0),
    (2022, 11, "November", 1, 2, 300.0),
    (2023, 1, "January", 2, 5, 3900.0),
]


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    paths = [os.path.join(SEED, f"{name}.csv") for name in ("customers", "products", "orders")]
    root = str(tmp_path_factory.mktemp("seed"))
    return run_pipeline(spark, read_csv_sources(spark, *paths), root)


@pytest.fixture(scope="module")
def star(spark, result):
    return result.star(spark)


def test_clean_load(spark, result, star):
    assert result.table_rows == {
        "DimCategory": 3,
        "DimCustomer": 20,
        "DimProduct": 20,
        "DimDate": 20,
        "FactOrder": 20,
    }
    assert result.issues(spark).count() == 0
    assert rows(result.report(spark).where("NOT passed")) == []
    assert row_set(star.DimCategory) == [(1, "Stationery"), (2, "Electronics"), (3, "Furniture")]


def test_reports(star):
    assert rows(reports.top_customers_by_orders(star)) == TOP_CUSTOMERS
    assert rows(reports.city_revenue(star)) == CITIES
    assert rows(reports.order_distribution_by_city(star)) == [city[:2] for city in CITIES]
    assert rows(reports.sales_by_category(star)) == CATEGORIES
    assert rows(reports.product_sales(star)) == PRODUCTS
    assert rows(reports.payment_method_breakdown(star)) == PAYMENTS
    assert rows(reports.status_distribution(star)) == STATUSES
    assert rows(reports.quarterly_revenue(star)) == QUARTERS
    assert rows(reports.monthly_order_trend(star)) == MONTHS


def test_headlines(star):
    assert row_set(reports.headline_insights(star)) == [
        ("rows loaded", "5", "83", None),
        ("top category", "Furniture", "13050.00", None),
        ("top city", "Tokyo", "4", None),
        ("top customer", "Emily Davis", "2", None),
        ("top customer", "Julia Adams", "2", None),
        ("top customer", "Paul Sullivan", "2", None),
        ("top payment", "Debit Card", "9", "45.0"),
    ]
