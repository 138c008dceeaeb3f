"""Top-k, argmax and safe sorting; ties always go to the explicit position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import safe_int
from ..session import kept


def top_n(df: DataFrame, key: str | list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each key, numbered from 1.  Spark keeps n rows a key before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)


def top_n_with_fallback(df: DataFrame, key: str, score: str, position: str, n: int, least: int = 30, rank: str = "rank") -> DataFrame:
    """The n best rows of each key among those that reach ``least``, or among all if none does.

    A key's best row tells whether any reaches it: ranking first and filtering then gives the same
    rows, so one pruned window does and no second pass over the key is needed."""
    top = top_n(df, key, [F.desc(score), F.asc(position)], n, rank)
    best = F.max(score).over(Window.partitionBy(key))
    return top.withColumn("__best", best).filter((F.col(score) >= least) | (F.col("__best") < least)).drop("__best")


def probe_targets(df: DataFrame, key: str, score: str, position: str, n: int) -> DataFrame:
    """``df`` with ``probe``: whether a row is among its key's n best."""
    w = Window.partitionBy(key).orderBy(F.desc(score), F.asc(position))
    return df.withColumn("probe", F.row_number().over(w) <= n)


def argmax(df: DataFrame, key: str | list[str], value: Column, score: Column, position: Column, name: str) -> DataFrame:
    """The value of each key's highest score, the first on ties: a plain aggregate, combined on the map side."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(score, -position)).alias(name))


def sort_by_ints(df: DataFrame, columns: list[str], position: str) -> DataFrame:
    """Global order by columns read as integers (0 where they are none), stable by position."""
    return df.orderBy(*[safe_int(c) for c in columns], position)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: each row's number, from 1, in the order.

    Rows are sorted by range partitions and written, each with its number in its partition; how many
    rows come before a partition is told by one small row a partition.  No task holds all rows."""
    inner = (1 << 33) - 1
    rows = kept(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumns({"__part": F.shiftright("__id", 33), "__inner": F.col("__id").bitwiseAND(F.lit(inner))})
    sizes = sorted((r["__part"], r["count"]) for r in rows.groupBy("__part").count().collect())
    before, total = [], 0
    for part, n in sizes:
        before.append((part, total))
        total += n
    starts = df.sparkSession.createDataFrame(before, "__part long, __before long")
    return rows.join(F.broadcast(starts), "__part").withColumn(name, F.col("__before") + F.col("__inner") + 1).drop("__id", "__part", "__inner", "__before")
