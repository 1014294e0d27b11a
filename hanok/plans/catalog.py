"""Datasets that refer to each other: dependency order, publishing, lineage."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from hanok.functions.text import table_references


class DatasetCatalog:
    """Named datasets, each a function of the datasets it names.

    A dataset is built once; everything that refers to it shares the same plan.
    """

    def __init__(self, sources: Mapping[str, DataFrame]):
        self._built: dict[str, DataFrame] = dict(sources)
        self._makers: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {}

    def define(self, name: str, inputs: tuple[str, ...], make: Callable[..., DataFrame]) -> None:
        self._makers[name] = (inputs, make)

    def names(self) -> list[str]:
        return list(self._makers)

    def inputs(self, name: str) -> tuple[str, ...]:
        return self._makers[name][0]

    def get(self, name: str, _visiting: tuple[str, ...] = ()) -> DataFrame:
        if name in self._built:
            return self._built[name]
        if name in _visiting:
            raise ValueError(f"datasets refer to each other in a circle: {' -> '.join((*_visiting, name))}")
        if name not in self._makers:
            by = f" in {_visiting[-1]}" if _visiting else ""
            raise ValueError(f"unknown dataset {name}{by}")
        inputs, make = self._makers[name]
        self._built[name] = make(*[self.get(i, (*_visiting, name)) for i in inputs])
        return self._built[name]

    def publish_views(self) -> list[str]:
        """Create or replace a temporary view per dataset."""
        for name in self._makers:
            self.get(name).createOrReplaceTempView(name)
        return self.names()

    def edges(self, spark: SparkSession) -> DataFrame:
        """(input, dataset) pairs of all definitions."""
        pairs = [(i, n) for n, (inputs, _) in self._makers.items() for i in inputs]
        return spark.createDataFrame(pairs, "input STRING, dataset STRING")


def publish_sql_view(spark: SparkSession, name: str, sql: str) -> None:
    """Create or replace a catalog view from SQL text."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")


def lineage_edges(statements: DataFrame) -> DataFrame:
    """Distinct (input catalog, input table, dataset) edges from (dataset, sql) rows."""
    found = statements.select("dataset", F.explode(table_references(F.col("sql"))).alias("_ref"))
    return found.select(
        F.split_part("_ref", F.lit("."), F.lit(1)).alias("input_catalog"),
        F.concat_ws(".", F.split_part("_ref", F.lit("."), F.lit(2)), F.split_part("_ref", F.lit("."), F.lit(3))).alias("input_table"),
        "dataset",
    ).distinct()
