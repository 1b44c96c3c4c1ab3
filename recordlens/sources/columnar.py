"""Parquet tables as rows for detection, through Spark's Python data source interface.

``spark.read.format("recordlens")`` reads the files below ``path``, one partition per row
group. The filters that Spark hands over choose the row groups by their statistics and the
rows within them, and stay visible in the plan. Bad numbers can be dropped where they are
read: with ``numeric`` set to a column, rows where it is null, NaN or infinite stay behind.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "recordlens"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

COMPARISONS = {
    EqualTo: lambda x, v: x == v,
    GreaterThan: lambda x, v: x > v,
    GreaterThanOrEqual: lambda x, v: x >= v,
    LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v,
    In: lambda x, v: x.isin(list(v)),
    StringStartsWith: pc.starts_with,
    StringEndsWith: pc.ends_with,
    StringContains: pc.match_substring,
}


def expression(condition: Filter, kinds: dict[str, pa.DataType]) -> pc.Expression | None:
    """A filter of Spark's in Arrow's terms, or None if it is left to Spark.

    But for null tests, floating point is left to Spark, where NaN is the largest number,
    and so are points in time, which depend on the session's zone, and nested columns.
    """
    if isinstance(condition, Not):
        inner = expression(condition.child, kinds)
        if inner is None or isinstance(condition.child, (IsNull, IsNotNull)):
            return None if inner is None else ~inner
        # Unknown is unknown on both sides, but for a null's membership, false in Arrow.
        return ~inner & ds.field(condition.child.attribute[0]).is_valid()
    path = condition.attribute
    if len(path) != 1 or path[0] not in kinds:
        return None
    x, kind = ds.field(path[0]), kinds[path[0]]
    if isinstance(condition, IsNull):
        return x.is_null()
    if isinstance(condition, IsNotNull):
        return x.is_valid()
    if pa.types.is_floating(kind) or pa.types.is_timestamp(kind) or pa.types.is_nested(kind):
        return None
    value = getattr(condition, "value", None)
    if isinstance(condition, EqualNullSafe) or value is None:
        return None
    if isinstance(condition, In) and any(v is None for v in value):
        return None
    found = COMPARISONS.get(type(condition))
    if found is None:
        return None
    try:
        if isinstance(condition, (StringStartsWith, StringEndsWith, StringContains)):
            return found(x, value)
        values = [pa.scalar(v, kind) for v in value] if isinstance(condition, In) else None
        return x.isin([v.as_py() for v in values]) if values is not None else found(x, pa.scalar(value, kind))
    except (pa.ArrowInvalid, pa.ArrowTypeError, OverflowError):
        return None


@dataclass
class RowGroup(InputPartition):
    """One row group of one file."""

    path: str
    number: int


class ColumnarReader(DataSourceReader):
    """Reads row groups, with the filters that it could take over."""

    def __init__(self, path: str, columns: list[str], numeric: str | None) -> None:
        self.path, self.columns, self.numeric = path, columns, numeric
        self.filters: list[Filter] = []

    def _kinds(self, schema: pa.Schema) -> dict[str, pa.DataType]:
        return {f.name: f.type for f in schema}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = self._kinds(ds.dataset(self.path, format="parquet").schema)
        for condition in filters:
            if expression(condition, kinds) is None:
                yield condition
            else:
                self.filters.append(condition)

    def _condition(self, schema: pa.Schema) -> pc.Expression | None:
        kinds, every = self._kinds(schema), None
        for condition in self.filters:
            own = expression(condition, kinds)
            every = own if every is None else every & own
        if self.numeric is not None:
            x = ds.field(self.numeric)
            own = x.is_valid()
            if pa.types.is_floating(kinds[self.numeric]):
                own = own & pc.is_finite(x)
            every = own if every is None else every & own
        return every

    def partitions(self) -> list[RowGroup]:
        dataset = ds.dataset(self.path, format="parquet")
        condition = self._condition(dataset.schema)
        return [
            RowGroup(fragment.path, group.id)
            for fragment in dataset.get_fragments(filter=condition)
            # Row groups whose statistics rule the filters out are no partitions.
            for part in fragment.split_by_row_group(filter=condition)
            for group in part.row_groups
        ]

    def read(self, partition: RowGroup | None) -> Iterator[pa.RecordBatch]:
        # Without row groups Spark asks once for a partition that is none.
        if not hasattr(partition, "number"):
            return
        files = ds.dataset(self.path, format="parquet")
        fragment = files.format.make_fragment(
            partition.path, filesystem=files.filesystem, row_groups=[partition.number]
        )
        scanner = fragment.scanner(
            schema=files.schema, columns=self.columns, filter=self._condition(files.schema)
        )
        yield from scanner.to_batches()


class ColumnarSource(DataSource):
    """Options: ``path``, a Parquet file or folder that pyarrow can open on all machines;
    ``columns``, those to read, comma-separated (default all); ``numeric``, a column whose
    null, NaN and infinite values leave their rows out."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def _columns(self) -> list[str]:
        every = ds.dataset(self.options["path"], format="parquet").schema.names
        wanted = self.options.get("columns")
        chosen = [c.strip() for c in wanted.split(",")] if wanted else every
        numeric = self.options.get("numeric")
        missing = [c for c in (*chosen, *([numeric] if numeric else [])) if c not in every]
        if missing:
            raise ValueError(f"no such columns: {missing}")
        return chosen

    def schema(self) -> StructType:
        schema = ds.dataset(self.options["path"], format="parquet").schema
        return from_arrow_schema(pa.schema([schema.field(c) for c in self._columns()]))

    def reader(self, schema: StructType) -> ColumnarReader:
        return ColumnarReader(self.options["path"], self._columns(), self.options.get("numeric"))


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let Spark hand filters over.

    The classes travel as they are: the process in which Spark plans a scan does not look
    for packages where the session's own does.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ColumnarSource)
    spark.conf.set(PUSHDOWN, "true")


@dataclass(frozen=True)
class ColumnarTable:
    """A source over a given table, for the detectors.

    Attributes:
        path: A Parquet file or folder.
        columns: Columns to read; empty for all.
        numeric: Column whose null, NaN and infinite values leave their rows out.
    """

    path: str
    columns: tuple[str, ...] = ()
    numeric: str | None = None
    name: str = FORMAT

    def load(self, spark: SparkSession) -> DataFrame:
        """The rows; lazy."""
        register(spark)
        options = {"path": self.path}
        if self.columns:
            options["columns"] = ",".join(self.columns)
        if self.numeric is not None:
            options["numeric"] = self.numeric
        return spark.read.format(FORMAT).options(**options).load()
