"""Keep-first, top-k and ordered-union operators that the rest is built from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row a key: the first by ``order``. A partial group limit runs before the shuffle, so that a hot key doesn't travel whole."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_per(df: DataFrame, keys: list[str], order: list[Column | str], k: int, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def running_last(df: DataFrame, value: Column, keys: list[str], order: list[str], name: str) -> DataFrame:
    """The last non-null ``value`` up to and with each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def merge_upgraded(df: DataFrame, keys: list[str], best: str, first: str, order: str) -> DataFrame:
    """Union by key with upgrades: the greatest ``best`` and the first non-empty ``first``."""
    filled = F.when(F.col(first).isNotNull() & (F.col(first) != ""), F.col(order))
    return df.groupBy(*keys).agg(F.max(best).alias(best), F.min_by(F.when(filled.isNotNull(), F.col(first)), filled).alias(first))
