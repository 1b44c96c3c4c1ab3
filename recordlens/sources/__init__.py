"""Sources: given Parquet tables, and labelled data planted into rows of any table."""

from recordlens.sources.base import DataSource
from recordlens.sources.columnar import ColumnarTable, register
from recordlens.sources.planted import (
    SyntheticCustomers,
    SyntheticTransactions,
    plant_anomalies,
    plant_duplicates,
)

__all__ = [
    "ColumnarTable",
    "DataSource",
    "SyntheticCustomers",
    "SyntheticTransactions",
    "plant_anomalies",
    "plant_duplicates",
    "register",
]
