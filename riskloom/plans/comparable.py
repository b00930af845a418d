"""Results in types that compare alike between engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, days as text, instants without a zone."""
    return df.select(*[_plain(f).alias(f.name) for f in df.schema.fields])


def _plain(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.DecimalType):
        return column.cast("double")
    if isinstance(field.dataType, T.DateType):
        return column.cast("string")
    if isinstance(field.dataType, T.TimestampType):
        return column.cast("timestamp_ntz")
    return column
