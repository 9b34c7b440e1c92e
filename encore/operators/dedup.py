"""Deterministic keep-one deduplication (W03, U03-U06; trap T19).

``dropDuplicates`` keeps an arbitrary row. We keep the first row of each key
group under a full, explicit ordering. ``row_number() == 1`` is planned as a
partial ``WindowGroupLimit`` before the shuffle, so a hot key group (e.g. a
third of all rows being copies of one play) is cut to one row per map task
before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys, order: list[Column] | None = None) -> DataFrame:
    """First row per ``keys`` under ``order`` (default: remaining columns ascending, nulls last)."""
    keys = list(keys)
    if order is None:
        order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
