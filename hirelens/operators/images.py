"""Rows of pixels of images (W6): where an image may be cut.  The pixels' reader and the cutting lie outside the engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The span of brightness within which a row counts as flat, and the thickness of a band that may be cut.
TOLERANCE, LEAST_BAND = 8, 12


def is_flat(darkest: Column, brightest: Column, tolerance: float = TOLERANCE) -> Column:
    return brightest - darkest <= tolerance


def flat_bands(rows: DataFrame, key: str, y: str, flat: Column, low: int | None = None, high: int | None = None, least: int = 0) -> DataFrame:
    """Key, first and last row of each run of flat rows next to each other, of rows from low up to but not high; a
    run whose ends lie less than `least` rows apart is left out.  rows: one for each key and y; a null is not flat.

    One shuffle: the runs of a key are numbered and aggregated where its rows lie.  A key holds the rows of one image.
    """
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col(y) >= low)
    if high is not None:
        inside = inside & (F.col(y) < high)
    n = F.row_number().over(Window.partitionBy(key).orderBy(y))
    runs = rows.where(flat & inside).select(key, y).withColumn("run", F.col(y) - n)
    return runs.groupBy(key, "run").agg(F.min(y).alias("first"), F.max(y).alias("last")).where(F.col("last") - F.col("first") >= least).drop("run")
