"""The SQL each query must equal, for DuckDB over the same trade tables.

Every statement starts with the common table expressions it needs: the staging
projection, the star on top of it, and the issues.
"""

from __future__ import annotations

LINE_ORDER = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)

CTES = {
    "st_customers": """
        SELECT c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
               CASE WHEN c_custkey % 17 = 0 THEN NULL
                    WHEN c_custkey % 17 = 1 THEN '   '
                    ELSE c_name || '@example.com' END AS email,
               n_name AS city,
               strftime(DATE '1992-01-01' + CAST(c_custkey % 2000 AS INTEGER), '%Y-%m-%d')
                   AS signup_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "st_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category_name,
               CASE WHEN p_partkey % 61 = 0 THEN NULL
                    WHEN p_partkey % 61 = 1 THEN 0
                    ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS price,
               CAST(p_size - 3 AS BIGINT) AS stock
        FROM part""",
    "st_orders": """
        SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS customer_id,
               l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
               CASE WHEN l_orderkey % 97 = 0 THEN 'not-a-date'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
               CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE o_orderpriority END AS payment_type,
               o_orderstatus AS status, strftime(l_shipdate, '%Y-%m-%d') AS updated_at,
               lineitem.*
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "DimCustomer": """
        SELECT customer_id AS CustomerKey, trim(first_name) || ' ' || trim(last_name) AS FullName,
               email AS Email, city AS City, signup_date AS SignupDate
        FROM st_customers""",
    "DimCategory": """
        SELECT row_number() OVER (ORDER BY first_key) AS CategoryKey, CategoryName
        FROM (SELECT trim(category_name) AS CategoryName, min(product_id) AS first_key
              FROM st_products GROUP BY 1) firsts""",
    "DimProduct": """
        SELECT product_id AS ProductKey, product_name AS ProductName, price AS Price,
               stock AS Stock, CategoryKey
        FROM st_products LEFT JOIN DimCategory ON trim(category_name) = CategoryName""",
    "order_days": """
        SELECT DISTINCT CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS d
        FROM st_orders WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL""",
    "DimDate": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, strftime(d, '%Y-%m-%d') AS FullDate,
               CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
               CAST(day(d) AS INTEGER) AS Day, CAST(quarter(d) AS INTEGER) AS Quarter,
               monthname(d) AS MonthName, dayname(d) AS DayOfWeek
        FROM order_days""",
    "valid_orders": f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {LINE_ORDER}) AS nth
            FROM st_orders WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL) numbered
        WHERE nth = 1""",
    "FactOrder": """
        SELECT order_id AS OrderKey, customer_id AS CustomerKey, v.product_id AS ProductKey,
               CAST(replace(order_date, '-', '') AS INTEGER) AS DateKey, quantity AS Quantity,
               order_date AS OrderDate, payment_type AS PaymentType, status AS Status,
               updated_at AS UpdatedAt,
               CASE WHEN ProductKey IS NULL THEN 0 ELSE Price END * quantity AS TotalAmount
        FROM valid_orders v LEFT JOIN DimProduct p ON v.product_id = p.ProductKey""",
    "issues": """
        SELECT 'customers' AS entity, customer_id AS key, 'DQ-1' AS rule,
               'CUSTOMER ERROR' AS category,
               'No email address for customer ' || first_name || ' ' || last_name AS message
        FROM st_customers WHERE email IS NULL OR trim(email) = ''
        UNION ALL
        SELECT 'products', product_id, 'DQ-2', 'PRODUCT ERROR',
               'Price of product ' || product_id || ' is not positive: ' ||
               CASE WHEN price IS NULL THEN 'nan' ELSE '0' END
        FROM st_products WHERE price IS NULL OR price <= 0
        UNION ALL
        SELECT 'products', product_id, 'DQ-3', 'PRODUCT ERROR',
               'No stock, or less than none, of product ' || product_id
        FROM st_products WHERE stock IS NULL OR stock < 0
        UNION ALL
        SELECT 'orders', order_id, 'DQ-4', 'ORDER ERROR',
               'Date of order ' || order_id || ' is not readable: ' || order_date
        FROM st_orders WHERE try_strptime(order_date, '%Y-%m-%d') IS NULL
        UNION ALL
        SELECT 'orders', order_id, 'DQ-5', 'ORDER ERROR',
               'Payment type of order ' || order_id || ' is not allowed: ' ||
               coalesce(payment_type, 'nan')
        FROM st_orders
        WHERE payment_type IS NULL
           OR payment_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""",
    "checks": """
        SELECT 'CK-1' AS "check", 'tables readable with the expected schema' AS name, 0 AS violations
        UNION ALL SELECT 'CK-2', 'customers present',
            (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM DimCustomer)
        UNION ALL SELECT 'CK-3', 'categories present',
            (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM DimCategory)
        UNION ALL SELECT 'CK-4', 'products present',
            (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM DimProduct)
        UNION ALL SELECT 'CK-5', 'dates present',
            (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM DimDate)
        UNION ALL SELECT 'CK-6', 'orders present',
            (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM FactOrder)
        UNION ALL SELECT 'CK-7', 'order customers known', (SELECT count(*) FROM FactOrder
            WHERE CustomerKey NOT IN (SELECT CustomerKey FROM DimCustomer))
        UNION ALL SELECT 'CK-8', 'order products known', (SELECT count(*) FROM FactOrder
            WHERE ProductKey NOT IN (SELECT ProductKey FROM DimProduct))
        UNION ALL SELECT 'CK-9', 'product categories known', (SELECT count(*) FROM DimProduct
            WHERE CategoryKey NOT IN (SELECT CategoryKey FROM DimCategory))
        UNION ALL SELECT 'CK-10', 'customer names filled',
            (SELECT count(*) FROM DimCustomer WHERE FullName IS NULL OR FullName = '')
        UNION ALL SELECT 'CK-11', 'prices positive',
            (SELECT count(*) FROM DimProduct WHERE Price IS NULL OR Price <= 0)
        UNION ALL SELECT 'CK-12', 'quantities positive',
            (SELECT count(*) FROM FactOrder WHERE Quantity IS NULL OR Quantity <= 0)
        UNION ALL SELECT 'CK-13', 'order dates filled',
            (SELECT count(*) FROM FactOrder WHERE OrderDate IS NULL)
        UNION ALL SELECT 'CK-14', 'order keys unique', (SELECT count(*) FROM
            (SELECT OrderKey FROM FactOrder GROUP BY OrderKey HAVING count(*) > 1) d)
        UNION ALL SELECT 'CK-15', 'customer keys unique', (SELECT count(*) FROM
            (SELECT CustomerKey FROM DimCustomer GROUP BY CustomerKey HAVING count(*) > 1) d)
        UNION ALL SELECT 'CK-16', 'amounts not negative',
            (SELECT count(*) FROM FactOrder WHERE TotalAmount IS NULL OR TotalAmount < 0)
        UNION ALL SELECT 'CK-17', 'statuses allowed',
            (SELECT count(*) FROM FactOrder WHERE Status NOT IN ('F', 'O'))
        UNION ALL SELECT 'CK-18', 'order dates known', (SELECT count(*) FROM FactOrder
            WHERE DateKey NOT IN (SELECT DateKey FROM DimDate))
        UNION ALL SELECT 'CK-19', 'no issues logged', (SELECT count(*) FROM issues)""",
    "by_city": """
        SELECT City, count(OrderKey) AS orders, sum(TotalAmount) AS revenue
        FROM FactOrder JOIN DimCustomer USING (CustomerKey) GROUP BY City""",
    "by_customer": """
        SELECT FullName, count(OrderKey) AS orders
        FROM FactOrder JOIN DimCustomer USING (CustomerKey) GROUP BY FullName""",
    "by_month": """
        SELECT Year, Month, MonthName, count(OrderKey) AS orders, sum(Quantity) AS units,
               sum(TotalAmount) AS revenue
        FROM FactOrder JOIN DimDate USING (DateKey) GROUP BY Year, Month, MonthName""",
    "by_category": """
        SELECT CategoryName, sum(Quantity) AS units, sum(TotalAmount) AS revenue
        FROM FactOrder JOIN DimProduct USING (ProductKey) JOIN DimCategory USING (CategoryKey)
        GROUP BY CategoryName""",
    "by_product": """
        SELECT ProductName, CategoryName, sum(Quantity) AS units, sum(TotalAmount) AS revenue
        FROM FactOrder JOIN DimProduct USING (ProductKey) JOIN DimCategory USING (CategoryKey)
        GROUP BY ProductName, CategoryName""",
    "by_payment": """
        SELECT PaymentType, count(*) AS orders, sum(TotalAmount) AS revenue
        FROM FactOrder GROUP BY PaymentType""",
}


def _with(body: str) -> str:
    """The statement behind every common table expression; unused ones cost nothing."""
    parts = ", ".join(f"{name} AS ({text})" for name, text in CTES.items())
    return f"WITH {parts} {body}"


STAR = ("DimCategory", "DimCustomer", "DimProduct", "DimDate", "FactOrder")
CITY_ORDERS = "SELECT City, CAST(orders AS BIGINT) AS OrderCount"
MONTH = (
    "SELECT Year, Month, MonthName, CAST(orders AS BIGINT) AS TotalOrders, "
    "CAST(units AS BIGINT) AS TotalUnits, CAST(round(revenue, 2) AS DOUBLE) AS"
)
CATEGORY = """
    SELECT CategoryName, CAST(units AS BIGINT) AS TotalUnitsSold,
           CAST(round(revenue, 2) AS DOUBLE) AS TotalRevenue FROM by_category"""
PAYMENT = """
    SELECT PaymentType, CAST(orders AS BIGINT) AS OrderCount,
           CAST(round(revenue, 2) AS DOUBLE) AS Revenue FROM by_payment"""
PRODUCT = (
    "SELECT ProductName, CategoryName, CAST(units AS BIGINT) AS TotalQuantity, "
    "CAST(round(revenue, 2) AS DOUBLE) AS"
)


def _copied(staged: str, key: str, dirtied: str, columns: str) -> str:
    return f"""
        SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY copy) AS nth FROM (
                SELECT *, 0 AS copy FROM {staged} WHERE {key} % 5 <> 0
                UNION ALL
                SELECT * REPLACE ('copy ' || {dirtied} AS {dirtied}), 1 AS copy FROM {staged}
            ) copies) numbered
        WHERE nth = 1"""


def _orphans(child: str, key: str, parent: str, keep: str) -> str:
    return f"""
        SELECT {key} AS orphan_key, count(*) AS row_count FROM {child}
        WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent} WHERE {keep})
        GROUP BY {key}"""


def _gates() -> str:
    nulls = [
        ("DimCategory", "CategoryKey"),
        ("DimCategory", "CategoryName"),
        ("DimCustomer", "CustomerKey"),
        ("DimCustomer", "FullName"),
        ("DimProduct", "ProductKey"),
        ("DimProduct", "ProductName"),
        ("DimDate", "DateKey"),
        ("FactOrder", "OrderKey"),
    ]
    copies = [pair for pair in nulls if pair[1] not in ("FullName", "ProductName")]
    links = [
        ("FactOrder", "CustomerKey"),
        ("FactOrder", "ProductKey"),
        ("FactOrder", "DateKey"),
        ("DimProduct", "CategoryKey"),
    ]
    null_count = "SELECT 'null {t}.{c}' AS metric, count(*) AS violations FROM {t} WHERE {c} IS NULL"
    copy_count = (
        "SELECT 'copies {t}.{c}', count(*) FROM "
        "(SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1) d"
    )
    return " UNION ALL ".join(
        [null_count.format(t=t, c=c) for t, c in nulls]
        + [copy_count.format(t=t, c=c) for t, c in copies]
        + [null_count.format(t=t, c=c) for t, c in links]
    )


_BODIES = {
    "csv_roundtrip_customers": "SELECT * FROM st_customers",
    "csv_rejects": """
        SELECT * FROM issues WHERE entity = 'orders'
        UNION ALL
        SELECT 'orders', order_id, 'DQ-6', 'ORDER ERROR',
               'Cells that do not fit their type: quantity ''' ||
               CASE WHEN order_id % 7 = 0 THEN 'many' ELSE '2.5' END || ''''
        FROM st_orders WHERE order_id % 7 = 0 OR order_id % 11 = 0""",
    "csv_padded_header": "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM st_products",
    "csv_elected_dates": """
        SELECT order_id, CASE WHEN order_id % 13 <> 0 THEN order_date END AS day,
               CASE WHEN order_id % 13 = 0 THEN order_date END AS unread
        FROM st_orders WHERE try_strptime(order_date, '%Y-%m-%d') IS NOT NULL""",
    "source_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS source, count(*) AS row_count, count(*) AS observed_rows FROM st_{name}"
        for name in ("customers", "products", "orders")
    ),
    "star_publish_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) AS logged_rows FROM {name}"
        for name in STAR
    ),
    "sql_text_report": """
        SELECT DayOfWeek AS weekday, count(OrderKey) AS orders,
               CAST(round(sum(TotalAmount), 2) AS DOUBLE) AS revenue
        FROM FactOrder JOIN DimDate USING (DateKey) WHERE Quantity >= 10 GROUP BY DayOfWeek""",
    "dim_customer": "SELECT * FROM DimCustomer",
    "dim_category": "SELECT * FROM DimCategory",
    "dim_product": "SELECT * REPLACE (CAST(Price AS DOUBLE) AS Price) FROM DimProduct",
    "dim_date": "SELECT * FROM DimDate",
    "fact_order": "SELECT * REPLACE (CAST(TotalAmount AS DOUBLE) AS TotalAmount) FROM FactOrder",
    "normalize_strings": """
        SELECT customer_id, first_name,
               CASE WHEN customer_id % 7 <> 0 THEN first_name || ' ' || last_name END AS full_name,
               CASE WHEN customer_id % 13 < 2 THEN NULL
                    WHEN customer_id % 13 = 2 THEN ' NA '
                    ELSE last_name END AS cell,
               customer_id % 11 = 0 OR first_name NOT IN ('BUILDING', 'MACHINERY') AS unlisted
        FROM st_customers""",
    "dedupe_customers": _copied(
        "st_customers", "customer_id", "city", "customer_id, last_name, city"
    ),
    "dedupe_products": _copied(
        "st_products", "product_id", "product_name", "product_id, product_name, stock"
    ),
    "dedupe_orders": """
        SELECT order_id, customer_id, product_id, quantity, order_date, updated_at
        FROM valid_orders""",
    "distinct_categories": """
        SELECT trim(category_name) AS category_name, min(product_id) AS first_product
        FROM st_products GROUP BY 1""",
    "distinct_dates": "SELECT CAST(d AS VARCHAR) AS day FROM order_days",
    "amount_lookup_default": """
        SELECT order_id AS OrderKey, v.product_id AS ProductKey, quantity AS Quantity,
               CAST(CASE WHEN p.product_id IS NULL THEN 0 ELSE price END * quantity AS DOUBLE)
                   AS TotalAmount
        FROM valid_orders v
        LEFT JOIN (SELECT * FROM st_products WHERE product_id % 50 <> 0) p
               ON v.product_id = p.product_id""",
    "top_customers_by_orders": """
        SELECT FullName AS Customer, CAST(orders AS BIGINT) AS TotalOrders
        FROM by_customer ORDER BY orders DESC, FullName LIMIT 5""",
    "top_customers_with_city": """
        SELECT FullName AS Customer, City, count(OrderKey) AS TotalOrders
        FROM FactOrder JOIN DimCustomer USING (CustomerKey)
        GROUP BY FullName, City ORDER BY TotalOrders DESC, Customer, City LIMIT 5""",
    "orders_by_city": f"{CITY_ORDERS} FROM by_city",
    "city_revenue": f"{CITY_ORDERS}, CAST(round(revenue, 2) AS DOUBLE) AS CityRevenue FROM by_city",
    "monthly_trend": f"{MONTH} Revenue FROM by_month",
    "monthly_revenue": f"{MONTH} MonthlyRevenue FROM by_month",
    "category_sales": CATEGORY,
    "category_revenue": CATEGORY,
    "payment_breakdown": PAYMENT,
    "payment_revenue": PAYMENT,
    "top_products_by_units": f"""
        {PRODUCT} Revenue FROM by_product
        ORDER BY units DESC, ProductName, CategoryName LIMIT 5""",
    "product_sales": f"{PRODUCT} TotalRevenue FROM by_product",
    "status_share": """
        SELECT Status, count(*) AS OrderCount,
               CAST(round(100.0 * count(*) / (SELECT count(*) FROM FactOrder), 1) AS DOUBLE)
                   AS Percentage
        FROM FactOrder GROUP BY Status""",
    "quarterly_revenue": """
        SELECT Year, Quarter, count(OrderKey) AS TotalOrders,
               CAST(round(sum(TotalAmount), 2) AS DOUBLE) AS QuarterlyRevenue
        FROM FactOrder JOIN DimDate USING (DateKey) GROUP BY Year, Quarter""",
    "headline_insights": """
        SELECT 'top city' AS insight, City AS label, CAST(orders AS VARCHAR) AS value,
               CAST(NULL AS VARCHAR) AS share
        FROM by_city WHERE orders = (SELECT max(orders) FROM by_city)
        UNION ALL
        SELECT 'top payment', PaymentType, CAST(orders AS VARCHAR),
               CAST(CAST(round(100.0 * orders / (SELECT sum(orders) FROM by_payment), 1)
                   AS DOUBLE) AS VARCHAR)
        FROM by_payment WHERE orders = (SELECT max(orders) FROM by_payment)
        UNION ALL
        SELECT 'top category', CategoryName, CAST(CAST(round(revenue, 2) AS DECIMAL(38,2)) AS VARCHAR),
               NULL
        FROM by_category WHERE revenue = (SELECT max(revenue) FROM by_category)
        UNION ALL
        SELECT 'top customer', FullName, CAST(orders AS VARCHAR), NULL
        FROM by_customer WHERE orders = (SELECT max(orders) FROM by_customer)
        UNION ALL
        SELECT 'rows loaded', '5', CAST((SELECT count(*) FROM DimCategory)
            + (SELECT count(*) FROM DimCustomer) + (SELECT count(*) FROM DimProduct)
            + (SELECT count(*) FROM DimDate) + (SELECT count(*) FROM FactOrder) AS VARCHAR), NULL""",
    "dashboard_feeds": """
        SELECT 'customers by orders' AS feed, label, CAST(value AS BIGINT) AS value FROM
            (SELECT FullName AS label, orders AS value FROM by_customer
             ORDER BY orders DESC, FullName LIMIT 5) top
        UNION ALL SELECT 'orders by city', City, CAST(orders AS BIGINT) FROM by_city
        UNION ALL SELECT 'orders by month', printf('%04d-%02d', Year, Month), CAST(orders AS BIGINT)
            FROM by_month
        UNION ALL SELECT 'units by category', CategoryName, CAST(units AS BIGINT) FROM by_category""",
    "stored_reports": """
        SELECT 'top_customers_by_orders' AS report,
               CAST(row_number() OVER (ORDER BY orders DESC, FullName) AS INTEGER) AS rank,
               FullName AS label, CAST(NULL AS VARCHAR) AS detail, CAST(orders AS BIGINT) AS orders,
               CAST(NULL AS BIGINT) AS units, CAST(NULL AS DOUBLE) AS revenue
        FROM by_customer QUALIFY rank <= 5
        UNION ALL
        SELECT 'order_distribution_by_city', row_number() OVER (ORDER BY orders DESC, City),
               City, NULL, orders, NULL, NULL FROM by_city
        UNION ALL
        SELECT 'monthly_order_trend', row_number() OVER (ORDER BY Year, Month), MonthName,
               CAST(Year AS VARCHAR), orders, units, round(revenue, 2) FROM by_month
        UNION ALL
        SELECT 'sales_by_category', row_number() OVER (ORDER BY round(revenue, 2) DESC, CategoryName),
               CategoryName, NULL, NULL, units, round(revenue, 2) FROM by_category
        UNION ALL
        SELECT 'payment_method_breakdown',
               row_number() OVER (ORDER BY orders DESC, PaymentType NULLS FIRST),
               PaymentType, NULL, orders, NULL, round(revenue, 2) FROM by_payment
        UNION ALL
        SELECT * FROM (
            SELECT 'top_products_by_quantity',
                   row_number() OVER (ORDER BY units DESC, ProductName, CategoryName) AS nth,
                   ProductName, CategoryName, NULL, units, round(revenue, 2) FROM by_product)
        WHERE nth <= 5""",
    "dq_issues": "SELECT * FROM issues",
    "dq_issue_changes": """
        SELECT *, CASE WHEN before = 0 THEN 'new' WHEN after = 0 THEN 'gone' ELSE 'kept' END AS change
        FROM (
            SELECT entity, rule, key, count(*) FILTER (run = 1) AS before,
                   count(*) FILTER (run = 2) AS after
            FROM (
                SELECT entity, rule, key, 1 AS run FROM issues
                WHERE NOT (rule = 'DQ-1' AND key % 3 = 0) AND rule <> 'DQ-5'
                UNION ALL
                SELECT 'orders', 'DQ-5', order_id, 1 FROM st_orders
                WHERE payment_type IS NULL OR payment_type NOT IN ('2-HIGH', '3-MEDIUM', '5-LOW')
                UNION ALL
                SELECT entity, rule, key, 2 FROM issues
            ) both_runs
            GROUP BY ALL) counted""",
    "dq_report": """
        SELECT "check", name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
        FROM checks""",
    "dq_summary": """
        SELECT count(*) FILTER (violations = 0) AS passed,
               count(*) FILTER (violations <> 0) AS failed, count(*) AS total
        FROM checks""",
    "dq_gates": _gates(),
    "orphan_customers": _orphans("FactOrder", "CustomerKey", "DimCustomer", "CustomerKey % 40 <> 0"),
    "orphan_products": _orphans("FactOrder", "ProductKey", "DimProduct", "ProductKey % 50 <> 0"),
    "orphan_categories": _orphans("DimProduct", "CategoryKey", "DimCategory", "CategoryKey <> 1"),
    "orphan_dates": _orphans("FactOrder", "DateKey", "DimDate", "Day <> 1"),
    "duplicate_order_keys": """
        SELECT order_id, count(*) AS copies FROM st_orders GROUP BY order_id HAVING count(*) > 1""",
}

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
