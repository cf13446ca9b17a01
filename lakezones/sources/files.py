"""File and frame sources (S5, S6) and the ``TableSource`` used by extraction."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from ..functions import CORRUPT
from .jdbc import JdbcConnection, count_rows, read_table


def read_csv(spark: SparkSession, path: str, *, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV with header; infers types unless a schema is given.

    Inference costs an extra pass over the files, so production jobs should
    pass ``schema``.
    """
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, *, header: bool = True) -> DataFrame:
    """S5 with every line kept: a line that does not fit ``schema`` (too few or too many fields, a value of another
    type) has its text in ``_corrupt_record``.

    Lines are parsed whole whatever columns a query needs, so all queries agree on which are malformed.
    ``operators/contracts.py`` parts them from the others.
    """
    kinds = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if CORRUPT not in kinds.names:
        kinds = StructType(list(kinds.fields)).add(CORRUPT, StringType())
    return (spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False).option("enforceSchema", True).schema(kinds).csv(path))


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A local collection as a distributed frame (small driver-side data only)."""
    return spark.createDataFrame(list(rows), schema)


class TableSource:
    """What extraction needs from a source: a lazy frame and its row count."""

    name: str

    def read(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError

    def count(self, spark: SparkSession, df: DataFrame) -> int:
        return df.count()

    # A source whose content can change between two reads (a live database)
    # must be snapshotted once per run so that count, diff and write agree.
    stable: bool = True


@dataclass
class FrameSource(TableSource):
    """A source given as a frame or a frame factory (parquet, tests, other jobs)."""

    name: str
    frame: DataFrame | Callable[[SparkSession], DataFrame]
    stable: bool = True

    def read(self, spark: SparkSession) -> DataFrame:
        return self.frame(spark) if callable(self.frame) else self.frame


@dataclass
class ParquetSource(TableSource):
    name: str
    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


@dataclass
class CsvSource(TableSource):
    """S5 as a source; a contract that quarantines takes malformed lines out."""

    name: str
    path: str
    schema: StructType | str
    header: bool = True

    def read(self, spark: SparkSession) -> DataFrame:
        return read_csv_checked(spark, self.path, self.schema, header=self.header)


@dataclass
class JdbcSource(TableSource):
    """S1 + A1 for one table; the count is pushed to the database."""

    name: str
    connection: JdbcConnection
    dbtable: str
    partition_column: str | None = None
    num_partitions: int | None = None
    stable: bool = False
    even: bool = False  # ranges of as many rows, also of a text key

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.connection, self.dbtable, partition_column=self.partition_column,
                          num_partitions=self.num_partitions, even=self.even)

    def count(self, spark: SparkSession, df: DataFrame) -> int:
        return count_rows(spark, self.connection, self.dbtable)
