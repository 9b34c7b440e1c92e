"""Output shaping for comparisons and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType


def instants_as_ntz(df: DataFrame) -> DataFrame:
    """Render TIMESTAMP (instant) columns as UTC wall clocks (TIMESTAMP_NTZ), session zone UTC."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
                       else F.col(f.name) for f in df.schema.fields])
