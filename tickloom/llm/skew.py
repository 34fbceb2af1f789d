"""Joins with a table that has one row for each key, where a few keys may hold much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds more than one in so many of all rows. So there are fewer hot keys than this.
HOT = 10_000


def look_up(rows: DataFrame, table: DataFrame, key: str, weight: str, hot: int = HOT) -> DataFrame:
    """`rows` with the columns of `table`, whose column `weight` says how many of the rows have the key.

    Rows with hot keys meet a broadcast of these keys alone, fewer than `hot` by arithmetic; the others are joined by key, and none
    of their keys has more than one in `hot` of all rows. Both inputs are read twice, so they should be written tables.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    many = F.col(weight) > total / hot
    few = F.broadcast(table.where(many))
    apart = rows.join(few, key)
    rest = rows.join(few.select(key), key, "left_anti").join(table.where(~many), key)
    return apart.unionByName(rest).drop(weight)
