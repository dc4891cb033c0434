"""Result columns in types both engines hand over alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def portable(df: DataFrame) -> DataFrame:
    """Whole numbers as long, decimals and floats as double, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(kind, (T.BooleanType, T.IntegralType)):
            column = column.cast("long")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.substring(column.cast("string"), 1, 19)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def micro(column: str) -> F.Column:
    """A coordinate in whole millionths of a degree."""
    return F.round(F.col(column).cast("double") * 1_000_000).cast("long")
