"""What every source offers."""

from __future__ import annotations

from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession


@runtime_checkable
class DataSource(Protocol):
    """Anything with a ``name`` that loads a DataFrame, e.g. from Parquet or a table."""

    name: str

    def load(self, spark: SparkSession) -> DataFrame:
        """The data; lazy."""
        ...
