"""Ranks inside groups that may be far too large for one task.

A window over a whole group sorts that group in one task. Here the group is cut into value bands with a fixed
width: the rows of lower bands are counted once per band, and only the rows of one band are
sorted together. Equal values are counted before any window, so a value that most rows share costs one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def even_bands(value: str, width: float) -> Column:
    """Bands of a fixed width."""
    return F.floor(F.col(value) / F.lit(float(width)))


def bounded_bands(value: str, width: float, most: int = 1000) -> Column:
    """Bands of a fixed width near zero that grow wider beyond ``most`` bands on either side: a few thousand in all."""
    steps = F.col(value) / F.lit(float(width))
    size = F.abs(steps)
    far = F.lit(float(most)) * (1 + F.log(F.greatest(size, F.lit(float(most))) / F.lit(float(most))))
    return F.floor(F.signum(steps) * F.when(size <= most, size).otherwise(far))


def values_below(
    df: DataFrame, group: list[str], value: str, band: Column, out: str = "below", tie: list[str] | None = None
) -> DataFrame:
    """One row per (group, value[, tie bucket]) with the number of group rows that sort before it.

    ``band`` never falls as the value rises; the bands of a group are counted in one task, the rows of a band sorted
    in one. Neither ``value`` nor the group columns may be NULL. ``tie`` names bucket columns that order equal values.
    """
    tie = tie or []
    counted = df.groupBy(*group, value, *tie).agg(F.count(F.lit(1)).alias("__n")).withColumn("__band", band)
    bands = counted.groupBy(*group, "__band").agg(F.sum("__n").alias("__band_n"))
    lower_bands = (
        Window.partitionBy(*group).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    )
    bands = bands.select(
        *group, "__band", F.coalesce(F.sum("__band_n").over(lower_bands), F.lit(0)).alias("__before")
    )
    inside = (
        Window.partitionBy(*group, "__band").orderBy(value, *tie).rowsBetween(Window.unboundedPreceding, -1)
    )
    counted = counted.withColumn("__inside", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    return counted.join(bands, [*group, "__band"]).select(
        *group, value, *tie, (F.col("__before") + F.col("__inside")).alias(out)
    )


def positions(df: DataFrame, group: list[str], value: str, name: str, width: float) -> DataFrame:
    """``df`` with its ``position`` in the group: by value, equal values by the md5 of ``name``, then by name.

    The hash gives equal values an order that can be cut into 256 even buckets, which names cannot promise.
    """
    # never NULL, so that the join puts no condition of its own on the rows below
    marked = df.withColumn("__md5", F.md5(name)).withColumn("__slice", F.coalesce(F.substring("__md5", 1, 2), F.lit("")))
    before = values_below(marked, group, value, even_bands(value, width), "__rows_before", ["__slice"])
    joined = marked.join(before, [*group, value, "__slice"])
    among = Window.partitionBy(*group, value, "__slice").orderBy("__md5", name)
    return joined.withColumn(
        "position", (F.col("__rows_before") + F.row_number().over(among)).cast("bigint")
    ).drop("__md5", "__slice", "__rows_before")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, out: str = "place") -> DataFrame:
    """First ``k`` rows of each group; Spark cuts to ``k`` per group before the shuffle as well."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(out, place.cast("bigint")).filter(F.col(out) <= k)


def one_shuffle(aggregated: DataFrame) -> DataFrame:
    """The same rows, read by several branches of a query from one shuffle.

    Branches that read different columns would prune different ones, and Spark would then compute the aggregate anew for
    each. A condition that is always true, but that the optimizer cannot know to be, keeps all columns in all branches.
    """
    return aggregated.filter(F.hash(*aggregated.columns) >= F.lit(-(2**31)))
