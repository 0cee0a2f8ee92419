"""Small helpers for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabspark.functions import columns as C


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, as the check SQL does, so sums in another order compare equal."""
    return df.select(*[
        (C.rounded(F.col(f"`{f.name}`"), digits).alias(f.name)
         if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`"))
        for f in df.schema.fields])


def cols(*names: str, digits: int = 6) -> str:
    """The named columns, rounded."""
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in names)


def r(*names: str, digits: int = 6) -> str:
    """All columns, the named ones rounded."""
    return f"* REPLACE ({cols(*names, digits=digits)})"
