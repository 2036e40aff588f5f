"""Code tables: roles and places to site codes, with unknown and ambiguous names reported."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank

# Kinds of places that a name may leave out, the name for everywhere, and career bands with their codes.
PLACE_KIND = "(특별시|광역시|특별자치시|특별자치도|시|군|구|도)$"
NATIONWIDE = "전국"
CAREER_NEW, CAREER_BANDS = "1", [(1, 3, "2"), (4, 6, "3"), (7, 9, "4"), (10, 15, "5"), (16, 20, "6"), (21, 99, "7")]


def resolve(names: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(name, code) of names a table (name, code) knows, ignoring case; and the names it doesn't know."""
    n = names.withColumn("key", F.lower(F.trim("name")))
    t = table.select(F.lower(F.trim("name")).alias("key"), "code").distinct()
    return n.join(t, "key").select("name", "code"), n.join(t, "key", "left_anti").select("name")


def ambiguous(table: DataFrame) -> DataFrame:
    """A10: names with several codes."""
    return table.groupBy("name").agg(F.countDistinct("code").alias("n_codes")).where("n_codes > 1")


def unambiguous(table: DataFrame) -> DataFrame:
    return table.join(ambiguous(table).select("name"), "name", "left_anti")


def flatten_places(tree: DataFrame) -> DataFrame:
    """Provinces with arrays of districts (name, code) as rows name, code, province."""
    top = tree.select("name", "code", F.col("name").alias("province"))
    below = tree.select(F.col("name").alias("province"), F.explode("districts").alias("d")).select("d.name", "d.code", "province")
    return top.unionByName(below)


def group_of(mapping: DataFrame) -> DataFrame:
    """Code to the names that map to it.  mapping: name, codes."""
    return mapping.select("name", F.explode("codes").alias("code")).groupBy("code").agg(F.sort_array(F.collect_set("name")).alias("names"))


def place_matches(place: Column, wanted: list[str]) -> Column:
    """without a condition or a place all match; else a wanted name, or it without its kind of place, in the place."""
    if not wanted:
        return F.lit(True)
    p = F.coalesce(place, F.lit(""))
    out = is_blank(p)
    for name in (" ".join(w.split()) for w in wanted):
        stem = re.sub(PLACE_KIND, "", name)
        out = out | (F.lit(True) if name in ("", NATIONWIDE) else p.contains(name) | (p.contains(stem) if stem else F.lit(False)))
    return out


def career_band(years: Column, bands: list[tuple[int, int, str]] = CAREER_BANDS) -> Column:
    """Nothing for below zero years, the newcomers' code for none, else the code of the band (low, high, code) that
    holds them, the last one beyond all."""
    out = F.lit(bands[-1][2])
    for low, high, code in reversed(bands):
        out = F.when((years >= low) & (years <= high), code).otherwise(out)
    return F.when(years < 0, "").when(years == 0, CAREER_NEW).otherwise(out)
