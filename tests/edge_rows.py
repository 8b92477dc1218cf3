"""A small dirty source: every rule fires at least once. Row order matters."""

from __future__ import annotations

CUSTOMERS = (
    "customer_id,first_name,last_name,email,city ,signup_date\n"
    "1,  Ann ,Lee\t,ann@x.test,Oslo,2020-01-01\n"
    "2,Bo,Ray,,Rome,2020-01-02\n"
    "3,Cy,Fox,   ,Oslo,2020-01-03\n"
    "2,Dup,Ray,dup@x.test,Lima,2020-01-04\n"
)
PRODUCTS = (
    "product_id,product_name,category_name,price,stock\n"
    "1,Lamp,Home,10.50,5\n"
    "2,Rug, Home ,,3\n"
    "3,Pen,Office,0,-1\n"
    "1,Lamp2,Garden,99,1\n"
    "4,Cup,Office,4.25,\n"
)
ORDERS = (
    "order_id,customer_id,product_id,quantity,order_date,payment_type,status,updated_at\n"
    "10,1,1,2,2021-03-01,UPI,Delivered,2021-03-02\n"
    "11,2,2,1,2021-03-01,Cheque,Shipped,2021-03-02\n"
    "12,3,9,4,2021-04-01,Credit Card,Lost,2021-04-02\n"
    "13,1,3,1,bad-date,,Delivered,2021-04-02\n"
    "14,7,1,1,2021-12-31, Debit Card ,Processing,2022-01-01\n"
    "15,1,4,3,2021-13-01,UPI,Delivered,2021-05-06\n"
    "15,1,4,3,2021-05-05,UPI,Delivered,2021-05-07\n"
    "10,2,4,9,2022-01-01,UPI,Shipped,2022-01-02\n"
    "16,3,1,,2021-06-01,Bank Transfer,,2021-06-02\n"
)


def write_sources(folder, customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS):
    """Write the three files, two with a byte order mark; return their paths."""
    paths = []
    for name, text, encoding in (
        ("customers", customers, "utf-8-sig"),
        ("products", products, "utf-8-sig"),
        ("orders", orders, "utf-8"),
    ):
        path = folder / f"{name}.csv"
        path.write_text(text, encoding=encoding)
        paths.append(str(path))
    return paths


def rows(frame):
    """The rows as tuples, in the frame's order."""
    return [tuple(row) for row in frame.collect()]


def row_set(frame):
    return sorted(rows(frame), key=repr)
