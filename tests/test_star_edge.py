"""The dirty rows of edge_rows.py through the star, the issues, checks and reports."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from edge_rows import row_set, rows, write_sources
from orderloom.model import Staged
from orderloom.plans import reports
from orderloom.plans.checks import (
    CHECKS,
    all_metrics,
    check_report,
    gates_of,
    null_links_of,
    summarize,
)
from orderloom.plans.issues import find_issues, issue_changes
from orderloom.plans.job import run_pipeline
from orderloom.plans.star import build_star, run_sql
from orderloom.schemas import STAR_SCHEMAS
from orderloom.sources.csv_files import read_csv_sources


@pytest.fixture(scope="module", params=[None, 1, 16])
def staged(spark, request, tmp_path_factory):
    """The sources as scanned, and moved to one or to many partitions."""
    read = read_csv_sources(spark, *write_sources(tmp_path_factory.mktemp("edge")))
    if request.param is None:
        return read
    return Staged(**{name: table.repartition(request.param) for name, table in read.items()})


@pytest.fixture(scope="module")
def star(staged):
    return build_star(staged)


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    """The star as published, for the reports."""
    source = read_csv_sources(spark, *write_sources(tmp_path_factory.mktemp("edge")))
    return run_pipeline(spark, source, str(tmp_path_factory.mktemp("mart"))).star(spark)


def test_schemas(star):
    for name, table in star.items():
        found = [(f.name, f.dataType) for f in table.schema]
        assert found == [(f.name, f.dataType) for f in STAR_SCHEMAS[name]]


def test_customers(star):
    assert row_set(star.DimCustomer) == [
        (1, "Ann Lee", "ann@x.test", "Oslo", "2020-01-01"),
        (2, "Bo Ray", None, "Rome", "2020-01-02"),
        (3, "Cy Fox", "   ", "Oslo", "2020-01-03"),
    ]


def test_categories_count_copies_of_products(star):
    assert row_set(star.DimCategory) == [(1, "Home"), (2, "Office"), (3, "Garden")]


def test_products(star):
    assert row_set(star.DimProduct) == [
        (1, "Lamp", Decimal("10.5000"), 5, 1),
        (2, "Rug", None, 3, 1),
        (3, "Pen", Decimal("0.0000"), -1, 2),
        (4, "Cup", Decimal("4.2500"), None, 2),
    ]


def test_dates_count_copies_of_orders(star):
    days = [(2021, 3, 1), (2021, 4, 1), (2021, 5, 5), (2021, 6, 1), (2021, 12, 31), (2022, 1, 1)]
    assert sorted(rows(star.DimDate.select("FullDate"))) == [(datetime.date(*day),) for day in days]


def test_first_valid_order_wins_and_is_priced(star):
    found = row_set(star.FactOrder.select("OrderKey", "CustomerKey", "UpdatedAt", F.col("TotalAmount").cast("double")))
    assert found == [
        (10, 1, "2021-03-02", 21.0),
        (11, 2, "2021-03-02", None),
        (12, 3, "2021-04-02", 0.0),
        (14, 7, "2022-01-01", 10.5),
        (15, 1, "2021-05-07", 12.75),
        (16, 3, "2021-06-02", None),
    ]


def test_payment_is_stored_untrimmed(star):
    assert rows(star.FactOrder.where("OrderKey = 14").select("PaymentType")) == [(" Debit Card ",)]


def test_issues(staged):
    found = row_set(find_issues(staged).select("rule", "key", "category", "message"))
    assert found == sorted(
        [
            ("DQ-1", 2, "CUSTOMER ERROR", "No email address for customer Bo Ray"),
            ("DQ-1", 3, "CUSTOMER ERROR", "No email address for customer Cy Fox"),
            ("DQ-2", 2, "PRODUCT ERROR", "Price of product 2 is not positive: nan"),
            ("DQ-2", 3, "PRODUCT ERROR", "Price of product 3 is not positive: 0"),
            ("DQ-3", 3, "PRODUCT ERROR", "No stock, or less than none, of product 3"),
            ("DQ-3", 4, "PRODUCT ERROR", "No stock, or less than none, of product 4"),
            ("DQ-4", 13, "ORDER ERROR", "Date of order 13 is not readable: bad-date"),
            ("DQ-4", 15, "ORDER ERROR", "Date of order 15 is not readable: 2021-13-01"),
            ("DQ-5", 11, "ORDER ERROR", "Payment type of order 11 is not allowed: Cheque"),
            ("DQ-5", 13, "ORDER ERROR", "Payment type of order 13 is not allowed: nan"),
        ],
        key=repr,
    )


def test_checks(spark, staged, star):
    report = check_report(spark, star, find_issues(staged))
    found = {row["check"]: row["violations"] for row in report.collect()}
    failing = {"CK-7": 1, "CK-8": 1, "CK-11": 2, "CK-12": 1, "CK-16": 2, "CK-17": 1, "CK-19": 10}
    assert found == {check: failing.get(check, 0) for check in CHECKS}
    assert len(found) == 19
    assert rows(summarize(report)) == [(12, 7, 19)]


def test_gates_and_null_links(spark, staged, mart):
    metrics = all_metrics(spark, mart, find_issues(staged))
    gates = dict(rows(gates_of(metrics)))
    assert len(gates) == 14 and set(gates.values()) == {0}
    assert dict(rows(null_links_of(metrics))) == {
        "null FactOrder.CustomerKey": 0,
        "null FactOrder.ProductKey": 0,
        "null FactOrder.DateKey": 0,
        "null DimProduct.CategoryKey": 0,
    }


def test_payment_report(mart):
    assert rows(reports.payment_method_breakdown(mart)) == [
        ("UPI", 2, 33.75),
        (" Debit Card ", 1, 10.5),
        ("Bank Transfer", 1, None),
        ("Cheque", 1, None),
        ("Credit Card", 1, 0.0),
    ]


def test_city_report_drops_orphans(mart):
    assert rows(reports.city_revenue(mart)) == [("Oslo", 4, 33.75), ("Rome", 1, None)]
    assert rows(reports.order_distribution_by_city(mart)) == [("Oslo", 4), ("Rome", 1)]


def test_category_and_product_reports(mart):
    assert rows(reports.sales_by_category(mart)) == [("Home", 4, 31.5), ("Office", 3, 12.75)]
    products = [("Cup", "Office", 3, 12.75), ("Lamp", "Home", 3, 31.5), ("Rug", "Home", 1, None)]
    assert rows(reports.product_sales(mart)) == products
    assert rows(reports.top_products_by_quantity(mart, 2)) == products[:2]


def test_month_and_quarter_reports(mart):
    assert rows(reports.monthly_order_trend(mart)) == [
        (2021, 3, "March", 2, 3, 21.0),
        (2021, 4, "April", 1, 4, 0.0),
        (2021, 5, "May", 1, 3, 12.75),
        (2021, 6, "June", 1, None, None),
        (2021, 12, "December", 1, 1, 10.5),
    ]
    assert rows(reports.quarterly_revenue(mart)) == [
        (2021, 1, 2, 21.0),
        (2021, 2, 3, 12.75),
        (2021, 4, 1, 10.5),
    ]


def test_status_report(mart):
    assert rows(reports.status_distribution(mart)) == [
        ("Delivered", 2, 33.3),
        (None, 1, 16.7),
        ("Lost", 1, 16.7),
        ("Processing", 1, 16.7),
        ("Shipped", 1, 16.7),
    ]


def test_customer_reports(mart):
    expected = [("Ann Lee", 2), ("Cy Fox", 2), ("Bo Ray", 1)]
    assert rows(reports.top_customers_by_orders(mart)) == expected
    assert rows(reports.top_customers_by_orders(mart, 1)) == expected[:1]
    assert rows(reports.top_customers_by_orders(mart, 0)) == []
    assert rows(reports.top_customers_with_city(mart, 2)) == [("Ann Lee", "Oslo", 2), ("Cy Fox", "Oslo", 2)]


@pytest.mark.parametrize("n", [-1, "5", 2.5, True])
def test_report_size_is_checked(mart, n):
    with pytest.raises(ValueError):
        reports.top_customers_by_orders(mart, n)


def test_headlines_list_all_tied_leaders(mart):
    assert row_set(reports.headline_insights(mart)) == [
        ("rows loaded", "5", "22", None),
        ("top category", "Home", "31.50", None),
        ("top city", "Oslo", "4", None),
        ("top customer", "Ann Lee", "2", None),
        ("top customer", "Cy Fox", "2", None),
        ("top payment", "UPI", "2", "33.3"),
    ]


def test_feeds(mart):
    found = {name: rows(feed) for name, feed in reports.dashboard_feeds(mart).items()}
    assert found == {
        "customers by orders": [("Ann Lee", 2), ("Cy Fox", 2), ("Bo Ray", 1)],
        "orders by city": [("Oslo", 4), ("Rome", 1)],
        "orders by month": [("2021-03", 2), ("2021-04", 1), ("2021-05", 1), ("2021-06", 1), ("2021-12", 1)],
        "units by category": [("Home", 4), ("Office", 3)],
    }


def test_all_reports_in_one_call(mart):
    named = reports.all_reports(mart, 3)
    assert list(named) == [
        "top_customers_by_orders",
        "order_distribution_by_city",
        "monthly_order_trend",
        "sales_by_category",
        "payment_method_breakdown",
        "top_products_by_quantity",
    ]
    assert all(report.limit(1).count() == 1 for report in named.values())


def test_sql_text_with_parameters(spark, mart):
    text = """
        SELECT c.City, COUNT(*) AS orders FROM FactOrder o
        JOIN DimCustomer c ON o.CustomerKey = c.CustomerKey
        WHERE o.OrderDate >= :since GROUP BY c.City ORDER BY c.City"""
    assert rows(run_sql(spark, mart, text, since="2021-04-01")) == [("Oslo", 3)]


def test_namesakes_merge_only_without_city(spark, tmp_path):
    head = "customer_id,first_name,last_name,email,city,signup_date\n"
    people = head + "1,Ann,Lee,a@x,Oslo,\n2,Ann,Lee,b@x,Rome,\n3,Bo,Ray,c@x,Rome,\n"
    star = build_star(read_csv_sources(spark, *write_sources(tmp_path, customers=people)))
    assert rows(reports.top_customers_by_orders(star)) == [("Ann Lee", 3), ("Bo Ray", 2)]
    assert rows(reports.top_customers_with_city(star)) == [
        ("Ann Lee", "Oslo", 2),
        ("Bo Ray", "Rome", 2),
        ("Ann Lee", "Rome", 1),
    ]


def test_empty_sources(spark, tmp_path):
    import edge_rows

    heads = [text.splitlines()[0] + "\n" for text in (edge_rows.CUSTOMERS, edge_rows.PRODUCTS, edge_rows.ORDERS)]
    staged = read_csv_sources(spark, *write_sources(tmp_path, *heads))
    star = build_star(staged)
    assert all(table.count() == 0 for _, table in star.items())
    assert rows(reports.monthly_order_trend(star)) == []
    assert rows(reports.status_distribution(star)) == []
    failing = check_report(spark, star, find_issues(staged)).where("NOT passed").select("check")
    assert row_set(failing) == [("CK-2",), ("CK-3",), ("CK-4",), ("CK-5",), ("CK-6",)]


def test_null_category_stays_out_of_the_dimension(spark, tmp_path):
    products = "product_id,product_name,category_name,price,stock\n1,Lamp,,1,1\n2,Rug,Home,1,1\n"
    staged = read_csv_sources(spark, *write_sources(tmp_path, products=products))
    star = build_star(staged)
    assert rows(star.DimCategory) == [(1, "Home")]
    assert row_set(star.DimProduct.select("ProductKey", "CategoryKey")) == [(1, None), (2, 1)]
    links = null_links_of(all_metrics(spark, star, find_issues(staged)))
    assert dict(rows(links))["null DimProduct.CategoryKey"] == 1


REPORTS = [
    reports.top_customers_by_orders,
    reports.top_customers_with_city,
    reports.order_distribution_by_city,
    reports.city_revenue,
    reports.monthly_order_trend,
    reports.quarterly_revenue,
    reports.sales_by_category,
    reports.product_sales,
    reports.top_products_by_quantity,
    reports.payment_method_breakdown,
    reports.status_distribution,
    reports.headline_insights,
    reports.stored_reports,
]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_report_runs_on_the_sums_of_one_pass(mart, tmp_path):
    summed = reports.summed_star(mart, str(tmp_path / "sums"))
    for report in REPORTS:
        assert rows(report(summed)) == rows(report(mart)), report.__name__
    for name, frame in reports.all_reports(summed).items():
        text = plan(frame)
        assert "OrderKey" not in text and "grain" in text, name
        assert "PartitionFilters: [isnotnull(grain" in text


def test_stored_reports_carry_their_order(mart):
    found = [r for r in reports.stored_reports(mart).collect()]
    for name, frame in reports.all_reports(mart).items():
        own = sorted((r for r in found if r["report"] == name), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, frame.count() + 1))
        first = {"monthly_order_trend": "MonthName", "sales_by_category": "CategoryName"}.get(name, frame.columns[0])
        assert [r["label"] for r in own] == [r[first] for r in frame.collect()]


def test_sql_text_leaves_the_session_as_it_was(spark, mart):
    spark.range(3).createOrReplaceTempView("dimcustomer")
    spark.catalog.dropTempView("FactOrder")
    found = run_sql(spark, mart, "SELECT count(*) AS n FROM FactOrder JOIN DimCustomer USING (CustomerKey)")
    assert spark.table("DimCustomer").columns == ["id"]
    assert not spark.catalog.tableExists("FactOrder")
    assert found.first()["n"] > 0
    with pytest.raises(Exception, match="nothing"):
        run_sql(spark, mart, "SELECT nothing FROM FactOrder")
    assert spark.table("DimCustomer").columns == ["id"]
    spark.catalog.dropTempView("dimcustomer")


def test_issue_changes_count_null_keys_and_copies(spark):
    schema = "entity string, rule string, key long, message string"
    before = spark.createDataFrame([("orders", "DQ-4", 1, "a"), ("orders", "DQ-4", 1, "b"), ("orders", "DQ-5", None, "c"), ("products", "DQ-2", 3, "d")], schema)
    after = spark.createDataFrame([("orders", "DQ-4", 1, "z"), ("orders", "DQ-5", None, "c"), ("orders", "DQ-4", 3, "e")], schema)
    assert row_set(issue_changes(before, after)) == sorted(
        [
            ("orders", "DQ-4", 1, 2, 1, "kept"),
            ("orders", "DQ-5", None, 1, 1, "kept"),
            ("products", "DQ-2", 3, 1, 0, "gone"),
            ("orders", "DQ-4", 3, 0, 1, "new"),
        ],
        key=repr,
    )
