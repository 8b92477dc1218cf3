"""The two bundles of tables the pipeline passes around; both hold lazy frames."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderloom.schemas import STAR_SCHEMAS


@dataclass(frozen=True)
class Staged:
    """Typed source tables, each with its position column, orders with their day."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [
            ("customers", self.customers),
            ("products", self.products),
            ("orders", self.orders),
        ]


class Star:
    """The five tables by name; one given as a function is planned on first use."""

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame]):
        self._tables = {name: tables[name] for name in STAR_SCHEMAS if name in tables}

    def table(self, name: str) -> DataFrame:
        found = self._tables[name]
        if callable(found):
            found = self._tables[name] = found()
        return found

    def pairs(self) -> list[tuple[str, DataFrame | Callable[[], DataFrame]]]:
        """The tables as they were given, planned or not."""
        return list(self._tables.items())

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, self.table(name)) for name in self._tables]

    @property
    def DimCategory(self) -> DataFrame:
        return self.table("DimCategory")

    @property
    def DimCustomer(self) -> DataFrame:
        return self.table("DimCustomer")

    @property
    def DimProduct(self) -> DataFrame:
        return self.table("DimProduct")

    @property
    def DimDate(self) -> DataFrame:
        return self.table("DimDate")

    @property
    def FactOrder(self) -> DataFrame:
        return self.table("FactOrder")
