"""What is known of a table: its columns, and those of its key in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_COLUMNS = "position int, name string, type string, nullable boolean"


def described(spark: SparkSession, table: str | T.StructType) -> DataFrame:
    """(position, name, type, nullable) of the columns of a catalog's table or of a schema."""
    schema = spark.table(table).schema if isinstance(table, str) else table
    return spark.createDataFrame([(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)], _COLUMNS)


def key_columns(schema: T.StructType, names: set[str]) -> list[T.StructField]:
    """The columns of a key by their place in the table; a name that the table hasn't is an error."""
    missing = set(names) - set(schema.fieldNames())
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return [f for f in schema.fields if f.name in names]
