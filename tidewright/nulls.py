"""NaN and three-valued logic: missing values are NULL, and a comparison with a missing value is false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known(c: Column) -> Column:
    """NULL for NaN. Spark orders NaN above all numbers, so it must not reach a comparison or an aggregate."""
    return F.when(~F.isnan(c), c)


def holds(condition: Column) -> Column:
    """The condition, false where it is unknown."""
    return F.coalesce(condition, F.lit(False))


def clean(df: DataFrame) -> DataFrame:
    """All floating-point columns with NULL for NaN."""
    return df.withColumns({name: known(df[name]) for name, kind in df.dtypes if kind in ("double", "float")})
