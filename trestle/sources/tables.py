"""Named table loading (S-1)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy reader of the landed parquet tables under one folder.

    Each table is read once per ``Tables`` object; DataFrames are lazy, so Catalyst still prunes columns and
    pushes filters into every scan that uses them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self(name)
        raise AttributeError(name)

    @cached_property
    def scope(self) -> str:
        """What landed tables belong to: the folder and the state of its files."""
        from trestle.sources.landing import source_state

        return f"{self.root}@{source_state(self.spark, self.root)}"

    @cached_property
    def fx(self):
        from trestle.sources.analogs import Analogs

        return Analogs(self)


def source(tables: Tables, name: str) -> DataFrame:
    """S-1: read a declared source table by name."""
    return tables(name)
