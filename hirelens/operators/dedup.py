"""Deduplication and survivor selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import company_key, is_blank, title_key
from ..schema import COLUMNS, COMPANY, FIRST, LAST, ORD, PREF, REQ, SITE, TECH, TITLE, URL


def weight() -> Column:
    """A1."""
    return F.length(REQ) + F.length(PREF) + F.length(TECH)


def keyed(postings: DataFrame, title: Column | None = None, alive: Column | None = None) -> DataFrame:
    """D3: postings with k1, k2 (company and title keys) and grouped: whether the row takes part in grouping at all."""
    t = title if title is not None else title_key(F.col(TITLE))
    k = postings.withColumns({"k1": F.coalesce(company_key(F.col(COMPANY)), F.lit("")), "k2": F.coalesce(t, F.lit(""))})
    return k.withColumn("grouped", (alive if alive is not None else F.lit(True)) & ((F.col("k1") != "") | (F.col("k2") != "")))


def marked(postings: DataFrame, title: Column | None = None, fill: bool = True, alive: Column | None = None) -> DataFrame:
    """Every posting with survivor_url (null: it stays) and, where it survives a merge, what the group gives it.

    A group merges unless a site repeats in it.  Which groups merge is found on the keys and the site alone, with partial
    aggregates, so a company and title that a third of all rows share costs one row a task.  Merging groups have at most
    one row a site; all other rows are spread by their order, so no window holds a hot key.  Rows that are not alive
    stay as they are.  ORD must be unique.
    """
    k = keyed(postings, title, alive)
    sizes = k.where("grouped").groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("members"), F.count_distinct(SITE).alias("sites"))
    merging = sizes.where((F.col("members") > 1) & (F.col("members") == F.col("sites"))).select("k1", "k2", F.lit(True).alias("merges"))
    m = k.join(merging, ["k1", "k2"], "left").withColumn("merges", F.coalesce("merges", F.lit(False)) & F.col("grouped"))
    m = m.withColumn("k3", F.when(F.col("merges"), F.lit(-1).cast("long")).otherwise(F.col(ORD)))
    w = Window.partitionBy("k1", "k2", "k3")
    heaviest = F.struct(weight(), -F.col(ORD))
    facts = {"best": F.max_by(F.struct(F.col(ORD).alias("ord"), F.col(URL).alias("url")), heaviest).over(w), "place": F.min(ORD).over(w)}
    first = lambda c: F.min_by(F.col(c), F.when(~is_blank(F.col(c)), F.col(ORD))).over(w)
    if fill:
        facts |= {f"any_{i}": first(c) for i, c in enumerate(COLUMNS) if c not in (FIRST, LAST)}
        facts |= {f"any_{i}": (F.min if c == FIRST else F.max)(F.when(~is_blank(F.col(c)), F.col(c))).over(w) for i, c in enumerate(COLUMNS) if c in (FIRST, LAST)}
    m = m.select("*", *[v.alias(n) for n, v in facts.items()])
    content = {}
    if fill:
        for i, c in enumerate(COLUMNS):
            needed = F.col("merges") if c in (FIRST, LAST) else F.col("merges") & is_blank(F.col(c))
            content[c] = F.when(needed, F.coalesce(F.col(f"any_{i}"), F.col(c))).otherwise(F.col(c))
    survives = F.col("best.ord") == F.col(ORD)
    content["survivor_url"] = F.when(F.col("merges") & ~survives, F.col("best.url"))
    content[ORD] = F.when(F.col("merges") & survives, F.col("place")).otherwise(F.col(ORD))
    return m.select(*[c for c in postings.columns if c not in content], *[v.alias(c) for c, v in content.items()])


def dedup(postings: DataFrame, title: Column | None = None, fill: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped).  kept stands at its group's first place; dropped names the survivor."""
    g = marked(postings, title, fill)
    return g.where(F.col("survivor_url").isNull()).select(*COLUMNS, ORD), g.where(F.col("survivor_url").isNotNull()).select(*COLUMNS, ORD, "survivor_url")


def keep_last(df: DataFrame, *key: str) -> DataFrame:
    """The last row of each key, at the place of the first."""
    rest = [c for c in df.columns if c not in (*key, ORD)]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), ORD).alias("r"), F.min(ORD).alias(ORD)).select(*key, "r.*", ORD)


def keep_first(df: DataFrame, key: str) -> DataFrame:
    """The first row of each key that isn't null."""
    rest = [c for c in df.columns if c not in (key, ORD)]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*rest), ORD).alias("r"), F.min(ORD).alias(ORD)).select(key, "r.*", ORD)


def representative(df: DataFrame, name: str = COMPANY) -> DataFrame:
    """The longest spelling of each company key, the first of ties."""
    return df.where(~is_blank(F.col(name))).groupBy(company_key(F.col(name)).alias("company_key")).agg(F.max_by(F.col(name), F.struct(F.length(name), -F.col(ORD))).alias("name"))
