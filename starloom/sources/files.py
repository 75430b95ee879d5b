"""CSV extracts read back under their contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.sources.dialect import dialect_options, unescaped


def read_csv_extract(
    spark: SparkSession, path: str, schema: T.StructType, lossless: bool = False
) -> DataFrame:
    """Read an extract written with the same ``lossless`` flag; no schema is inferred.

    In a lossless extract a line is a record, and large files are split. In a plain one text can
    hold line ends, which needs ``multiLine``: where a column is text each file is read by
    one task, and the writer's ``bytes_per_file`` bounds its size.
    """
    text = any(isinstance(f.dataType, T.StringType) for f in schema.fields)
    options = dialect_options(lossless)
    df = spark.read.schema(schema).options(multiLine=text and not lossless, **options).csv(path)
    return unescaped(df) if lossless else df
