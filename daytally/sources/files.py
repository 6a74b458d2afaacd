"""CSV with explicit types, parquet tables, and one error for missing input."""

from __future__ import annotations

import csv
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from daytally.schemas import (
    CALENDAR_TYPES,
    DAY_PREFIX,
    PREDICTION_SCHEMA,
    PRICE_TYPES,
    SERIES,
    WIDE_IDS,
    require_columns,
)


# What a bucketed table needs to be registered again from its files.
LAYOUT = "columns string, buckets int, keys array<string>, order array<string>"
SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _found(path: str, read: Callable[[], DataFrame]) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"missing input: {path}") from error
        raise


def read_table(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None
) -> DataFrame:
    """Parquet table; a given schema spares the job that infers it."""
    reader = spark.read.schema(schema) if schema else spark.read
    return _found(path, lambda: reader.parquet(path))


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line; no other line is read."""
    first = _found(path, lambda: spark.read.text(path)).head()
    if first is None:
        raise ValueError(f"no header in {path}")
    return next(csv.reader([first.value]))


def csv_schema(names: list[str], types: dict[str, str], prefix: str | None = None) -> T.StructType:
    """Types by name; day columns are INT; anything else is read as text."""

    def kind(name: str) -> str:
        if name in types:
            return types[name]
        return "int" if prefix and name.startswith(prefix) else "string"

    return T.StructType([T.StructField(name, SPARK_TYPES[kind(name)]) for name in names])


def _read_csv(
    spark: SparkSession, path: str, types: dict[str, str], prefix: str | None = None
) -> DataFrame:
    """Columns by the names in the header. Every file of a folder must have the first one's header."""
    schema = csv_schema(header_names(spark, path), types, prefix)
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
    df = reader.option("enforceSchema", False).csv(path)
    require_columns(df, types, path)
    return df


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, {name: "string" for name in WIDE_IDS}, DAY_PREFIX)


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, CALENDAR_TYPES)


def read_prices_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, PRICE_TYPES)


def read_predictions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Predictions with typed dates, so later windows order by day and not by text."""
    types = dict(column.split() for column in PREDICTION_SCHEMA.split(", "))
    return _read_csv(spark, path, types).select(*types)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, keys: list[str] = SERIES, by: str = "date"
) -> str:
    """Catalog table over ``path``, bucketed by series and sorted by series and day.

    Later windows and joins on the series skip the shuffle. Hand in rows that are hashed by
    ``keys`` into ``buckets`` partitions already: each task then writes one bucket, one file. The
    layout is kept beside the folder, so that a catalog that does not last can be told again.
    """
    order = [*keys, by]
    (
        df.write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*order)
        .saveAsTable(table)
    )
    layout = df.sparkSession.createDataFrame([(_ddl(df), buckets, keys, order)], LAYOUT)
    layout.coalesce(1).write.mode("overwrite").parquet(_layout_path(path))
    return table


def read_bucketed(spark: SparkSession, table: str, path: str) -> DataFrame:
    """The bucketed table; one that this catalog has not seen is registered from its kept layout."""
    if not spark.catalog.tableExists(table):
        layout = read_table(spark, _layout_path(path), LAYOUT).first()
        keys, order = (", ".join(f"`{name}`" for name in layout[part]) for part in ("keys", "order"))
        spark.sql(
            f"CREATE TABLE {table} ({layout['columns']}) USING parquet CLUSTERED BY ({keys}) "
            f"SORTED BY ({order}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}_layout"
