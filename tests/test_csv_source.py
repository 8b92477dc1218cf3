import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from edge_rows import rows
from orderloom.operators.dedupe import keep_first
from orderloom.schemas import CUSTOMERS, ORDER_DAY, PRODUCTS, Rules
from orderloom.plans.issues import product_rules, source_issues
from orderloom.sources.csv_files import (
    bad_lines,
    read_csv,
    read_csv_sources,
    read_orders,
    read_text_table,
)

HEAD = "product_id,product_name,category_name,price,stock\n"


def products(spark, folder, body, **options):
    (folder / "p.csv").write_text(HEAD + body, encoding="utf-8")
    return read_csv(spark, str(folder / "p.csv"), PRODUCTS, **options)


def test_byte_order_mark_padded_header_and_column_order(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text(" stock ,price,product_id,category_name,product_name,more\n5,1.5,1,Home,Lamp,x\n", "utf-8-sig")
    found = read_csv(spark, str(path), PRODUCTS).select(*PRODUCTS.column_names)
    assert rows(found) == [(1, "Lamp", "Home", Decimal("1.5000"), 5)]


def test_quotes_backslashes_and_accents(spark, tmp_path):
    body = '1,"a ""b"", c",\\x,2,3\n2,Ayşe O\'Neil,Ü,1,1\n'
    found = products(spark, tmp_path, body).select("product_name", "category_name")
    assert rows(found) == [('a "b", c', "\\x"), ("Ayşe O'Neil", "Ü")]


def test_null_tokens_and_blank_cells(spark, tmp_path):
    found = products(spark, tmp_path, '1,NA,,nan,NULL\n2,"", ,n/a,4.0\n').select(*PRODUCTS.column_names)
    assert rows(found) == [(1, None, None, None, None), (2, None, " ", None, 4)]


def test_bad_cells_become_null_and_are_named(spark, tmp_path):
    table = products(spark, tmp_path, "1,a,b,cheap,x\n2,a,b,NA,1\n3,a,b\n4,a,b,1,1,more\n5,a,b,1,1\n")
    found = rows(bad_lines(table).select("product_id", "_rejected", "_corrupt_record").orderBy("product_id"))
    cells = [("price", "cheap"), ("stock", "x")]
    assert found == [(1, cells, None), (3, [], "3,a,b"), (4, [], "4,a,b,1,1,more")]


def test_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,price\n1,2\n")
    with pytest.raises(ValueError, match="product_name"):
        read_csv(spark, str(tmp_path / "p.csv"), PRODUCTS)


def test_files_with_another_header_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "1,a,b,1,1\n")
    (tmp_path / "b.csv").write_text("product_id,product_name,category_name,stock,price\n2,a,b,1,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, str(tmp_path), PRODUCTS).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    table = products(spark, tmp_path, '1,"two\nlines",b,1,1\n', multiline=True)
    assert rows(table.select("product_name")) == [("two\nlines",)]


def test_position_follows_files_and_lines(spark, tmp_path):
    """Many files and many splits per file: the first row in source order wins."""
    for number in range(6):
        lines = [f"{key},file{number} row{row},c,1,1" for row, key in enumerate([7, 8, 7, number])]
        (tmp_path / f"f{number}.csv").write_text(HEAD + "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        table = read_csv(spark, str(tmp_path), PRODUCTS)
        assert table.rdd.getNumPartitions() > 6
        found = keep_first(table.repartition(5, "stock"), "product_id")
        names = dict(rows(found.select("product_id", "product_name")))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert names == {7: "file0 row0", 8: "file0 row1", **{n: f"file{n} row3" for n in range(6)}}


def test_text_table_keeps_all_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a , b\n1,NA\n")
    assert rows(read_text_table(spark, str(tmp_path / "t.csv")).select("a", "b")) == [("1", "NA")]


def test_sources_carry_the_parsed_day(spark, tmp_path):
    from edge_rows import write_sources

    staged = read_csv_sources(spark, *write_sources(tmp_path))
    assert staged.customers.columns[:6] == CUSTOMERS.column_names
    assert staged.orders.where(F.col(ORDER_DAY).isNull()).count() == 2


def test_a_position_is_two_numbers_whatever_the_path(spark, tmp_path):
    folder = tmp_path / "a folder, é=1 %20"
    folder.mkdir()
    for i, name in enumerate(("b 2.csv", "a%1.csv", "c+é.csv")):
        (folder / name).write_text(HEAD + "".join(f"{10 * i + j},x,Home,1,1\n" for j in range(3)))
    table = read_csv(spark, str(folder), PRODUCTS)
    assert table.schema["_pos"].dataType.simpleString() == "struct<part:bigint,row:bigint>"
    found = [r["product_id"] for r in table.orderBy("_pos").select("product_id").collect()]
    assert found == [10, 11, 12, 0, 1, 2, 20, 21, 22]
    assert table.where("_pos.part IS NULL").isEmpty()
    text = keep_first(table, "product_id")._jdf.queryExecution().executedPlan().toString()
    shuffled = text[: text.index("Exchange hashpartitioning(product_id")]
    assert "_path" not in shuffled and "file_path" not in shuffled


def order_file(path, dates):
    head = "order_id,customer_id,product_id,quantity,order_date,payment_type,status,updated_at\n"
    path.write_text(head + "".join(f"{i},1,1,1,{d},UPI,Shipped,x\n" for i, d in enumerate(dates)))


@pytest.mark.parametrize(
    "dates, days",
    [
        (["03/14/2021", "12/31/2020", "2021-01-01"], ["2021-03-14", "2020-12-31", None]),
        (["", "NA", "soon", "05/04/2021", "14/04/2021"], [None, None, None, "2021-05-04", None]),
        (["14/03/2021", "05/04/2021"], ["2021-03-14", "2021-04-05"]),
        (["2021-3-4", "03/14/2021"], ["2021-03-04", None]),
        (["2021-03-04 10:30:00", "2021-3-5"], ["2021-03-04", "2021-03-05"]),
        (["20210304", "20211301"], ["2021-03-04", None]),
        (["4 Mar 2021", "soon"], ["2021-03-04", None]),
        (["never", ""], [None, None]),
    ],
)
def test_the_first_readable_date_elects_the_format(spark, tmp_path, dates, days):
    order_file(tmp_path / "o.csv", dates)
    found = read_orders(spark, str(tmp_path / "o.csv")).orderBy("order_id")
    assert [str(r[0]) if r[0] else None for r in found.select(ORDER_DAY).collect()] == days


def test_files_elect_in_their_order_and_rules_overrule_them(spark, tmp_path):
    order_file(tmp_path / "a 1.csv", ["soon", ""])
    order_file(tmp_path / "b.csv", ["25/12/2021", "01/02/2021"])
    order_file(tmp_path / "c.csv", ["2021-05-06"])
    found = read_orders(spark, str(tmp_path)).where(F.col(ORDER_DAY).isNotNull())
    assert sorted(str(r[0]) for r in found.select(ORDER_DAY).collect()) == ["2021-02-01", "2021-12-25"]
    given = read_orders(spark, str(tmp_path), Rules(date_formats=("yyyy-M-d", "M/d/yyyy")))
    assert sorted(str(r[0]) for r in given.where(F.col(ORDER_DAY).isNotNull()).select(ORDER_DAY).collect()) == [
        "2021-01-02",
        "2021-05-06",
    ]


def test_cells_are_read_once_for_issues(spark, tmp_path):
    """No filter is pushed to the scan, which would compute every cell again."""
    table = products(spark, tmp_path, "1,a,b,cheap,x\n2,a,b,NA,1\n5,a,b,1,1\n")
    issues = source_issues(table, PRODUCTS, product_rules())
    filters = re.findall("Filter (.*)", issues._jdf.queryExecution().optimizedPlan().toString())
    assert sorted(re.sub("#[0-9]+", "", f) for f in filters) == ["isnotnull(_path)", "isnotnull(hit)"]
    assert [r.rule for r in issues.orderBy("key", "rule").collect()] == ["DQ-2", "DQ-3", "DQ-6", "DQ-2"]


def test_files_of_elected_dates_grow_in_number_only():
    from contract.bindings import csv_files_of

    assert csv_files_of(600_000) == 8 and csv_files_of(216_000_000) >= 200
