"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sparkrec.functions.columns import OUT_DECIMALS


def round_doubles(df: DataFrame, places: int = OUT_DECIMALS) -> DataFrame:
    """Round every floating column so results do not depend on summation order."""
    cols = [F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)
