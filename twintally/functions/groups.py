"""Grouping in which rows without a key stay apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: grouping column: NULL for rows with a key, another number for every other row
OWN_GROUP = "_own_group"


def with_own_group(df: DataFrame, has_key: Column) -> DataFrame:
    """``df`` with ``OWN_GROUP``: grouped by the key and this column, rows without a key are groups of one,
    spread over all tasks. So both kinds of rows come from one pass over the input."""
    return df.withColumn(OWN_GROUP, F.when(~has_key, F.monotonically_increasing_id()))
