"""Reading inputs, cutting lineage and choosing between broadcast and shuffle joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keepwell.session import scratch_folder

#: A side is broadcast only if its counted rows times its row width stay below this.
BROADCAST_BYTES = 48 << 20


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Rows of a narrow table that one task writes, where the number is known before.
ROWS_A_TASK = 250_000


def written(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """The frame as a table in the shared folder: cuts lineage, outlives any executor.

    ``most`` is a bound on its rows; few rows are written by few tasks.
    """
    path = scratch_folder(df.sparkSession, name)
    kind = df.schema
    (df if most is None else df.coalesce(max(4, -(-most // ROWS_A_TASK)))).write.parquet(path)
    return df.sparkSession.read.schema(kind).parquet(path)


def measured(df: DataFrame, name: str, most: int | None = None, **values: Column) -> tuple[DataFrame, dict]:
    """A written table with its row count and other aggregates, read from the table."""
    table = written(df, name, most)
    return table, table.agg(F.count(F.lit(1)).alias("rows"), *(v.alias(k) for k, v in values.items())).first().asDict()


def small(side: DataFrame, size: int) -> DataFrame:
    """A side of a known size in bytes, marked for broadcast within the bound."""
    return F.broadcast(side) if size <= BROADCAST_BYTES else side


def sized(side: DataFrame, row_bytes: int | Column) -> DataFrame:
    """A written side, marked for broadcast if its measured size is within the bound.

    ``row_bytes`` is the width of a row, or an expression of it where rows hold
    arrays. Beyond the bound the join is left to a shuffle, whose skewed
    partitions adaptive execution splits.
    """
    width = row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes)
    total = side.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(side) if total <= BROADCAST_BYTES else side


def text_key(text) -> F.Column:
    """Identity of a text; null and empty texts are the same."""
    return F.md5(F.coalesce(text, F.lit("")))
