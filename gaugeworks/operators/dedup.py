"""Row de-duplication (R-24, R-34 to R-36, R-42)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order_by``, which should settle every tie.

    NULL keys form one group.  The ``= 1`` filter lets Spark keep one row per key in every task before
    the shuffle, so copies of a key do not meet in one task.
    """
    ranked = df.withColumn("__rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def distinct_rows(df: DataFrame, columns: Sequence[Column | str] | None = None) -> DataFrame:
    """DISTINCT over the whole projected row; pre-aggregated in every task before the shuffle."""
    return (df.select(*columns) if columns else df).distinct()
