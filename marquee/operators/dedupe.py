"""First-wins duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import blank, strip_wide
from marquee.operators.ranking import first_per_key


def _low(c: str) -> Column:
    return F.lower(strip_wide(blank(F.col(c))))


def first_listing(df: DataFrame, order: str = "_ord") -> DataFrame:
    """First row per (name, start text, venue)."""
    return first_per_key(df, [_low("name"), strip_wide(blank(F.col("start_time"))), _low("location_name")], [order])


def first_of_day(df: DataFrame, order: str = "_ord", day: str = "local_day") -> DataFrame:
    """First row per (name, venue, local day); an unknown day is a key of its own."""
    return first_per_key(df, [_low("name"), _low("location_name"), F.coalesce(F.col(day).cast("string"), F.lit(""))],
                         [order])


def first_by_key(df: DataFrame, key_columns: list[str], order: str = "_ord", keep_keyless: bool = False) -> DataFrame:
    """First row per the first filled key column (url, else id, else name, ...).

    With ``keep_keyless`` a row without any key is never a duplicate.
    """
    key = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in key_columns])
    own = F.when(key.isNull(), F.col(order)) if keep_keyless else F.lit(0)
    return first_per_key(df, [key, own], [order])


def backfill_city(df: DataFrame, city: str) -> DataFrame:
    """A blank city takes the requested city."""
    wanted = city.strip().lower()
    if not wanted:
        return df
    return df.withColumn("city", F.when(strip_wide(blank(F.col("city"))) == "", F.lit(wanted)).otherwise(F.col("city")))
