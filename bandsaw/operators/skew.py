"""Joins that stay even when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _computed(table: DataFrame, name: str) -> Column:
    """The key as an expression. A column that is merely passed on keeps the partitioning of an
    aggregate below it, the join then takes that over, and Spark cannot split what it did not
    shuffle for the join."""
    kind = table.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.concat(F.col(name), F.lit("")).alias(name)
    if isinstance(kind, T.IntegralType):
        return F.col(name).bitwiseXOR(F.lit(0).cast(kind)).alias(name)
    return F.col(name)


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to the one-row-per-key ``table``; keys are numbers or strings.

    A merge join spills and can be split: Spark reads a partition with a hot key
    as several slices of ``rows``, each beside the table's few rows
    (``spark.sql.adaptive.skewJoin``).
    """
    own = table.select(*[_computed(table, c) if c in keys else F.col(c) for c in table.columns])
    return rows.join(own.hint("merge"), keys, how)


def semi_join(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``wanted`` (distinct keys), split in the same way."""
    return lookup(rows, wanted, [key], "left_semi")
