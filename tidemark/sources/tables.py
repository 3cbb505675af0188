"""Batch table scans (S6, S16) and named logical sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """Parquet table ``<base_dir>/<name>.parquet``; projection and filters reach the scan."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


class SourceRegistry:
    """Logical ``schema.table`` names resolved to DataFrame loaders.

    The models ask for ``registry.get("raw.customers_raw")`` instead of a path,
    so the same model code runs over a landing table, a fixture or a stand-in.
    """

    def __init__(self) -> None:
        self._loaders: dict[str, Callable[[], DataFrame]] = {}

    def register(self, name: str, loader: Callable[[], DataFrame]) -> None:
        self._loaders[name.lower()] = loader

    def get(self, name: str) -> DataFrame:
        try:
            return self._loaders[name.lower()]()
        except KeyError:
            raise KeyError(f"unknown source {name!r}; known: {sorted(self._loaders)}") from None

    def names(self) -> list[str]:
        return sorted(self._loaders)

    def register_views(self) -> None:
        """Expose every source as a temp view named after its table part."""
        for name in self._loaders:
            self.get(name).createOrReplaceTempView(name.split(".")[-1])
