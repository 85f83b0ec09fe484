"""A synopsis of stored rows: counts and newest keys per date, from which common questions are answered.

One row for each UTC date and local day that meet: at most three for a date. It is made from two columns of what a load
wrote and kept beside it, so that reads about "now" need not search the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions import clock

SCHEMA = T.StructType(
    [
        T.StructField("local_day", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("observed", T.LongType()),
        T.StructField("newest_micros", T.LongType()),
    ]
)


def synopsis(rows: DataFrame, key: str, utc_date: str, seen: str, *more: str, zone: str = clock.PARIS) -> DataFrame:
    """utc_date, local_day, rows, observed rows, the newest observed key in microseconds; ``more`` aggregates."""
    dtype = clock.type_of(rows, key)
    return rows.groupBy(utc_date, F.expr(f"{clock.local_day(key, dtype, zone)} AS local_day")).agg(
        F.expr("count(1) AS rows"),
        F.expr(f"count_if({seen}) AS observed"),
        F.expr(f"max({clock.micros(key, dtype)}) FILTER (WHERE {seen}) AS newest_micros"),
        *[F.expr(text) for text in more],
    )


def newest(held: DataFrame) -> DataFrame:
    """One row: ``last`` (UTC wall clock) and ``last_micros`` of the newest observed key."""
    return held.agg(F.max("newest_micros").alias("last_micros")).selectExpr(
        f"{clock.wall_from_micros('last_micros')} AS last", "last_micros"
    )


def counted(held: DataFrame) -> DataFrame:
    """One row: ``raw_rows``."""
    return held.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_rows"))


def observed_days(held: DataFrame) -> DataFrame:
    """Observed rows per local day, days without any left out: day, quarters."""
    days = held.groupBy(F.col("local_day").alias("day")).agg(F.sum("observed").alias("quarters"))
    return days.where("quarters > 0")


def newest_days(held: DataFrame, utc_date: str, count: int = 2) -> DataFrame:
    """The newest local days with observed rows: day, the first UTC date they reach into, their newest observed key.

    One aggregate and a top-``count``. The first row's ``newest_micros`` is that of the whole table.
    """
    days = held.groupBy(F.col("local_day").alias("day")).agg(
        F.min(utc_date).alias("first"), F.max("newest_micros").alias("newest_micros"), F.sum("observed").alias("quarters")
    )
    return days.where("quarters > 0").orderBy(F.desc("day")).limit(count)
