"""Presentation projection used by the registered queries: doubles rounded
to 4 decimals and timestamps as ``yyyy-MM-dd HH:mm:ss`` text, so a result
compares value-for-value with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 4)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.ShortType, T.ByteType)):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)
