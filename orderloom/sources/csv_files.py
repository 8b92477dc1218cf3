"""CSV source: header names decide the columns, bad cells become nulls.

Every cell is read as text and cast by try_cast, so one bad value never stops a
scan. Fields may be quoted, with a doubled quote for a quote inside.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.dates import parse_date
from orderloom.functions.numbers import to_typed
from orderloom.functions.text import null_if_token
from orderloom.model import Staged
from orderloom.schemas import (
    CORRUPT,
    CUSTOMERS,
    DATE_FORMATS,
    DEFAULT_RULES,
    ORDER_DAY,
    ORDERS,
    POSITION,
    PRODUCTS,
    REJECTED,
    UNREAD_DATE,
    Rules,
    SourceSchema,
)


# A split's number is its file's number and, in the low bits, where in the file it begins.
OFFSET_BITS = 40
# Files whose paths and numbers are broadcast: about 20 MB.
BROADCAST_FILES = 100_000


def with_position(rows: DataFrame) -> DataFrame:
    """Add the place of each row in its source: two longs, the split's number and the row in it.

    Taken at the scan: row ids rise inside a split, while the order between splits follows from
    their path and offset whatever task reads them. Paths are looked up right there in the list
    of files, so that no later step carries them.
    """
    spark = rows.sparkSession
    # Local files are listed with two more slashes than rows say they are from.
    paths = sorted(re.sub("^file:/+", "file:/", path) for path in rows.inputFiles())
    files = spark.createDataFrame(list(enumerate(paths)), "_file long, _path string")
    unlisted = F.raise_error(F.concat(F.lit("file is not listed: "), F.col("_of"))).cast("bigint")
    part = F.shiftleft(F.coalesce(F.col("_file"), unlisted), OFFSET_BITS) + F.col("_start")
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_of"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    listed = F.broadcast(files) if len(paths) <= BROADCAST_FILES else files
    return placed.join(listed, F.col("_of") == F.col("_path"), "left").select(
        *rows.columns, F.struct(part.alias("part"), F.col("_row").alias("row")).alias(POSITION)
    )


def read_text_table(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All cells as text under stripped header names, plus position and bad lines.

    Files whose header differs from the first one's raise an error. `multiline`
    allows line breaks inside quotes; it stops Spark from splitting a file.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    header = reader.csv(path).columns
    text_schema = T.StructType(
        [T.StructField(name, T.StringType()) for name in [*header, CORRUPT]]
    )
    raw = (
        reader.schema(text_schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .csv(path)
    )
    raw = with_position(raw)
    return raw.toDF(*[name.strip() for name in header], CORRUPT, POSITION)


def read_csv(
    spark: SparkSession, path: str, schema: SourceSchema, multiline: bool = False
) -> DataFrame:
    """A typed source table; `_rejected` has column and text of the cells that did not fit."""
    raw = read_text_table(spark, path, multiline)
    missing = [name for name in schema.column_names if name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the {schema.name} columns {missing}")
    # One step after the other, so that what a later one uses twice is computed once.
    cells = raw.select(
        *[null_if_token(F.col(name)).alias(f"_cell_{name}") for name in schema.column_names],
        CORRUPT,
        POSITION,
    )
    typed = cells.select(
        "*", *[to_typed(F.col(f"_cell_{name}"), dtype).alias(name) for name, dtype in schema.columns]
    )
    # Arrays are joined, as a filter of them would be interpreted. Text columns take any cell, but
    # lines are only told apart from broken ones where every column is read.
    none = F.array().cast("array<struct<column:string,text:string>>")
    misfits = [
        F.when(
            F.col(f"_cell_{name}").isNotNull() & F.col(name).isNull(),
            F.array(F.struct(F.lit(name).alias("column"), F.col(f"_cell_{name}").alias("text"))),
        ).otherwise(none)
        for name in schema.column_names
    ]
    return typed.select(
        *schema.column_names, F.concat(*misfits).alias(REJECTED), CORRUPT, POSITION
    )


def bad_lines(table: DataFrame) -> DataFrame:
    """Rows with a rejected cell or a wrong number of fields."""
    return table.where((F.size(REJECTED) > 0) | F.col(CORRUPT).isNotNull())


def elect_date_format(
    spark: SparkSession, path: str, column: str, candidates: Sequence[str], multiline: bool = False
) -> str:
    """The candidate format that reads the first value, in source order, that any of them reads.

    Usually the first file answers; only if none of its values can be read, all files are. If
    nothing can, the first candidate stands. Two candidates may read one value (a day up to 12
    beside its month); the earlier one is then meant.
    """
    paths = sorted(read_text_table(spark, path, multiline).inputFiles())
    # Spark names files as encoded URIs and reads plain paths.
    for scope in [unquote(paths[0]), path] if paths else []:
        text = null_if_token(F.col(column))
        fits = F.coalesce(
            *[F.when(parse_date(text, [f]).isNotNull(), F.lit(i)) for i, f in enumerate(candidates)]
        )
        read = read_text_table(spark, scope, multiline).select(fits.alias("fits"), POSITION)
        first = read.where("fits IS NOT NULL").agg(F.min_by("fits", POSITION).alias("fits")).first()
        if first["fits"] is not None:
            return candidates[first["fits"]]
    return candidates[0]


def read_orders(
    spark: SparkSession, path: str, rules: Rules = DEFAULT_RULES, multiline: bool = False
) -> DataFrame:
    """Staged orders: the day in place of the date's text, which stays where no format fits.

    Without formats in the rules, the data elect one of DATE_FORMATS.
    """
    orders = read_csv(spark, path, ORDERS, multiline)
    formats = rules.date_formats or [
        elect_date_format(spark, path, "order_date", DATE_FORMATS, multiline)
    ]
    day = parse_date(F.col("order_date"), formats)
    unread = F.when(day.isNull(), F.col("order_date"))
    return orders.withColumns({ORDER_DAY: day, UNREAD_DATE: unread}).drop("order_date")


def read_csv_sources(
    spark: SparkSession,
    customers: str,
    products: str,
    orders: str,
    rules: Rules = DEFAULT_RULES,
    multiline: bool = False,
) -> Staged:
    """The three source files, or folders of files, as staged tables.

    Rejected cells and broken lines stay with their rows, for the issues to report.
    """
    return Staged(
        customers=read_csv(spark, customers, CUSTOMERS, multiline),
        products=read_csv(spark, products, PRODUCTS, multiline),
        orders=read_orders(spark, orders, rules, multiline),
    )
