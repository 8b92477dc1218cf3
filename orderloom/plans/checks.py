"""Metrics over a built star, and the checks, gates and tallies read from them.

A metric counts violations. All row conditions on one table share one pass: a run counts
them while it writes the table, a report on a finished star reads the columns they need. Key
metrics shuffle a count per key, once for each key.
Checks and gates that ask the same question share its metric.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions.predicates import (
    is_empty,
    negative_or_null,
    not_listed,
    not_positive,
)
from orderloom.model import Star
from orderloom.operators.integrity import duplicate_key_count, orphan_rows
from orderloom.schemas import (
    DEFAULT_RULES,
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    REQUIRED_NAMES,
    STAR_SCHEMAS,
    Rules,
)

# check: (what passes, metric that must be zero)
CHECKS = {
    "CK-1": ("tables readable with the expected schema", "schema differences"),
    "CK-2": ("customers present", "empty DimCustomer"),
    "CK-3": ("categories present", "empty DimCategory"),
    "CK-4": ("products present", "empty DimProduct"),
    "CK-5": ("dates present", "empty DimDate"),
    "CK-6": ("orders present", "empty FactOrder"),
    "CK-7": ("order customers known", "orphans FactOrder.CustomerKey"),
    "CK-8": ("order products known", "orphans FactOrder.ProductKey"),
    "CK-9": ("product categories known", "orphans DimProduct.CategoryKey"),
    "CK-10": ("customer names filled", "invalid DimCustomer.FullName"),
    "CK-11": ("prices positive", "invalid DimProduct.Price"),
    "CK-12": ("quantities positive", "invalid FactOrder.Quantity"),
    "CK-13": ("order dates filled", "invalid FactOrder.OrderDate"),
    "CK-14": ("order keys unique", "copies FactOrder.OrderKey"),
    "CK-15": ("customer keys unique", "copies DimCustomer.CustomerKey"),
    "CK-16": ("amounts not negative", "invalid FactOrder.TotalAmount"),
    "CK-17": ("statuses allowed", "invalid FactOrder.Status"),
    "CK-18": ("order dates known", "orphans FactOrder.DateKey"),
    "CK-19": ("no issues logged", "issues logged"),
}
# Checks that a table has rows at all.
FILLED_CHECKS = [check for check, (_, metric) in CHECKS.items() if metric.startswith("empty ")]


def _gates(name: str) -> list[str]:
    """Metrics a table must answer with zero: keys and names filled, keys unique."""
    key = PRIMARY_KEYS[name]
    required = [key, *([REQUIRED_NAMES[name]] if name in REQUIRED_NAMES else [])]
    nulls = [f"null {name}.{column}" for column in required]
    return nulls + [f"copies {name}.{column}" for column in _unique_columns(name)]


def _unique_columns(name: str) -> list[str]:
    also = ["CategoryName"] if name == "DimCategory" else []
    return [PRIMARY_KEYS[name], *also]


GATES = {name: _gates(name) for name in STAR_SCHEMAS}
NULL_LINKS = [f"null {child}.{column}" for child, column, _ in FOREIGN_KEYS]


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _labelled(one_row: DataFrame, metric: str) -> DataFrame:
    return one_row.select(F.lit(metric).alias("metric"), "violations")


def _row_conditions(name: str, rules: Rules) -> dict[str, Column]:
    """Metrics of a table that count violating rows."""
    linked = [column for child, column, _ in FOREIGN_KEYS if child == name]
    filled = [PRIMARY_KEYS[name], *linked]
    if name in REQUIRED_NAMES:
        filled.append(REQUIRED_NAMES[name])
    col = F.col
    invalid = {
        "DimCustomer": {"FullName": is_empty(col("FullName"))},
        "DimProduct": {"Price": not_positive(col("Price"))},
        "FactOrder": {
            "Quantity": not_positive(col("Quantity")),
            "OrderDate": col("OrderDate").isNull(),
            "TotalAmount": negative_or_null(col("TotalAmount")),
            "Status": not_listed(col("Status"), rules.statuses),
        },
    }.get(name, {})
    return {
        **{f"null {name}.{column}": col(column).isNull() for column in filled},
        **{f"invalid {name}.{column}": broken for column, broken in invalid.items()},
    }


def row_counts(name: str, rules: Rules = DEFAULT_RULES) -> list[Column]:
    """Aggregates that count a table's violating rows, one per metric, for any pass over it."""
    conditions = _row_conditions(name, rules)
    return [F.count_if(condition).alias(metric) for metric, condition in conditions.items()]


def counted_metrics(name: str, counts: Mapping[str, int]) -> dict[str, int]:
    """The metrics of a table out of what a pass over it counted, its `rows` among it."""
    broken = {metric: count for metric, count in counts.items() if metric != "rows"}
    return {f"empty {name}": int(counts["rows"] == 0), **broken}


def listed_metrics(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """(metric, violations) of counts that are known already."""
    rows = [F.struct(F.lit(m), F.lit(n).cast("bigint")) for m, n in counts.items()]
    return spark.range(1).select(F.inline(F.array(*rows)).alias("metric", "violations"))


def copies_metrics(star: Star, name: str) -> DataFrame:
    """(metric, violations) of the columns that must be unique; reads those columns only."""
    table = star.table(name)
    return _union(
        _labelled(duplicate_key_count(table, column), f"copies {name}.{column}")
        for column in _unique_columns(name)
    )


def table_metrics(star: Star, name: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """(metric, violations) of one table by itself."""
    empty = (F.count(F.lit(1)) == 0).cast("bigint").alias(f"empty {name}")
    one_pass = star.table(name).agg(empty, *row_counts(name, rules))
    quoted = [f"`{metric}`" for metric in one_pass.columns]
    return one_pass.unpivot([], quoted, "metric", "violations").unionByName(
        copies_metrics(star, name)
    )


def link_metrics(star: Star) -> DataFrame:
    """(metric, violations) of the foreign keys: rows that point at no parent."""
    return _union(
        _labelled(
            orphan_rows(star.table(child), column, star.table(parent), PRIMARY_KEYS[parent]),
            f"orphans {child}.{column}",
        )
        for child, column, parent in FOREIGN_KEYS
    )


def schema_differences(star: Star) -> list[str]:
    """Tables whose columns or types differ from the star's definition."""
    return [
        name
        for name, table in star.items()
        if [(f.name, f.dataType) for f in table.schema]
        != [(f.name, f.dataType) for f in STAR_SCHEMAS[name]]
    ]


def other_metrics(spark: SparkSession, star: Star, issues: DataFrame) -> DataFrame:
    """(metric, violations) of the schemas and of the issue table."""
    wrong = F.lit(len(schema_differences(star))).cast("bigint").alias("violations")
    logged = issues.agg(F.count(F.lit(1)).alias("violations"))
    return _labelled(spark.range(1).select(wrong), "schema differences").unionByName(
        _labelled(logged, "issues logged")
    )


def all_metrics(
    spark: SparkSession, star: Star, issues: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Every metric of a star, one row each."""
    tables = [table_metrics(star, name, rules) for name in STAR_SCHEMAS]
    return _union([*tables, link_metrics(star), other_metrics(spark, star, issues)])


def report_of(metrics: DataFrame) -> DataFrame:
    """The 19 checks: name, violations, and whether the check passed."""
    texts = F.create_map(
        *[
            cell
            for check, (name, metric) in CHECKS.items()
            for cell in (
                F.lit(metric),
                F.struct(F.lit(check).alias("check"), F.lit(name).alias("name")),
            )
        ]
    )
    return (
        metrics.where(F.col("metric").isin([metric for _, metric in CHECKS.values()]))
        .withColumn("_check", texts[F.col("metric")])
        .select(
            "_check.check", "_check.name", "violations", (F.col("violations") == 0).alias("passed")
        )
    )


def check_report(
    spark: SparkSession, star: Star, issues: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """One row per check, computed from the star and its issues."""
    return report_of(all_metrics(spark, star, issues, rules))


def summarize(report: DataFrame) -> DataFrame:
    """Tally of a report: how many checks passed, failed and ran."""
    return report.agg(
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    )


def gates_of(metrics: DataFrame, names: Iterable[str] = tuple(STAR_SCHEMAS)) -> DataFrame:
    """The metrics that must be zero before the named tables are published."""
    wanted = [gate for name in names for gate in GATES[name]]
    return metrics.where(F.col("metric").isin(wanted))


def null_links_of(metrics: DataFrame) -> DataFrame:
    """Rows whose foreign key is null, which no orphan check counts."""
    return metrics.where(F.col("metric").isin(NULL_LINKS))
