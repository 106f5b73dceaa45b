"""Sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import config


def natural_key(c: str) -> Column:
    """Key under which all-digit identifiers come first, by number, and the rest by text.

    A number is compared by its length without leading zeros and then by its digits, so no
    identifier is too long for it and nothing is cast.
    """
    value = F.col(c)
    digits = F.when(value.rlike("^[0-9]+$"), F.ltrim(value, F.lit("0")))
    return F.struct(
        digits.isNull().cast("int").alias("text"),
        F.coalesce(F.length(digits), F.lit(0)).alias("width"),
        F.coalesce(digits, value).alias("value"),
    )


def natural_order(c: str) -> list[Column]:
    """Sort columns: natural key, then the text itself, nulls last."""
    return [F.col(c).isNull(), natural_key(c), F.col(c)]


def class_rank(c: str) -> Column:
    """Place of an activity class in the order of precedence, from 1."""
    ranks = F.array(*[F.lit(name) for name in config.ACTIVITY_CLASSES])
    return F.nullif(F.array_position(ranks, F.col(c)), F.lit(0))
