"""Union, keyed upsert with retention, and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COLUMNS, FIRST, LAST, ORD, SITES, URL, as_postings
from .dedup import keep_last

KEEP_DAYS = 30


def union_all(frames: list[DataFrame]) -> DataFrame:
    """G1: rows of all frames in their order; no row is dropped, columns align by name."""
    out = None
    for k, f in enumerate(frames):
        part = as_postings(f).withColumn(ORD, F.col(ORD) + F.lit(k) * F.lit(1 << 48))
        out = part if out is None else out.unionByName(part)
    return out


def site_order(site: Column) -> Column:
    """O2."""
    return F.array_position(F.array(*[F.lit(s) for s in SITES]), site)


def parsed(c: Column) -> Column:
    return F.try_to_timestamp(F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), F.trim(c)), F.lit("yyyy-M-d")).cast("date")


def upsert(existing: DataFrame, fresh: DataFrame, today: str, days: int = KEEP_DAYS) -> DataFrame:
    """One row a URL, with state (added, updated, unseen) and expired / undated marks; expired rows are still in.

    Fresh content wins, the last of a batch; first seen stays, or is today; last seen of fresh rows is today.
    A row unseen for over `days` days expires unless its date, or today, cannot be read.
    """
    rest = [c for c in COLUMNS if c != URL]
    old = keep_last(as_postings(existing).where(F.col(URL) != ""), URL).select(URL, F.struct(*rest).alias("o"), F.col(ORD).alias("o_ord"))
    given = as_postings(fresh).where(F.col(URL) != "")
    new = given.groupBy(URL).agg(F.max_by(F.struct(*rest), ORD).alias("n"), F.min(ORD).alias("n_ord"), F.count(F.lit(1)).alias("given"))
    both = old.join(new, URL, "full_outer")
    content = {c: F.coalesce(F.col("n")[c], F.col("o")[c]) for c in rest}
    content[FIRST] = F.when(F.col("n").isNull(), F.col("o")[FIRST]).otherwise(F.coalesce(F.nullif(F.col("o")[FIRST], F.lit("")), F.lit(today)))
    content[LAST] = F.when(F.col("n").isNull(), F.col("o")[LAST]).otherwise(F.lit(today))
    rows = both.select(URL, *[content[c].alias(c) for c in rest], F.coalesce("o_ord", F.col("n_ord") + F.lit(1 << 52)).alias(ORD), F.when(F.col("n").isNull(), "unseen").when(F.col("o").isNull(), "added").otherwise("updated").alias("state"), F.coalesce("given", F.lit(0)).alias("given"))
    last = parsed(F.col(LAST))
    return rows.withColumns({"expired": F.coalesce(last < F.date_sub(parsed(F.lit(today)), days), F.lit(False)), "undated": last.isNull()})


def merge(existing: DataFrame, fresh: DataFrame, today: str, days: int = KEEP_DAYS) -> DataFrame:
    """The rows upsert() keeps, latest first."""
    return upsert(existing, fresh, today, days).where(~F.col("expired")).select(*COLUMNS, ORD).orderBy(F.col(LAST).desc(), F.col(FIRST).desc(), F.col(URL).desc())


def merged(existing: DataFrame, fresh: DataFrame, today: str, days: int = KEEP_DAYS) -> DataFrame:
    """The rows upsert() keeps, in no order: what is stored in buckets needs none."""
    return upsert(existing, fresh, today, days).where(~F.col("expired")).select(*COLUMNS, ORD)


def counters(marked: DataFrame) -> DataFrame:
    """A4 over upsert()'s rows: every fresh row counts, the first of a new URL as added and all others as updated; unseen
    is what else is kept, and undated rows are among the kept ones."""
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))
    kept, added = n(~F.col("expired")), n(F.col("state") == "added")
    updated = n(F.col("given")) - added
    return marked.agg(added.alias("added"), updated.alias("updated"), (kept - added - updated).alias("unseen"), n(F.col("expired")).alias("expired"), n(F.col("undated")).alias("undated"))


def revive_first_seen(rows: DataFrame, history: DataFrame) -> DataFrame:
    """First seen as the history has it, where it has one."""
    h = keep_last(history.select(URL, F.col(FIRST).alias("h_first"), ORD).where(F.col(URL) != ""), URL).select(URL, "h_first")
    return rows.join(h, URL, "left").withColumn(FIRST, F.coalesce(F.nullif("h_first", F.lit("")), F.col(FIRST))).drop("h_first")


def keep_earliest(rows: DataFrame, earlier: DataFrame) -> DataFrame:
    """The earlier of two first-seen dates, where both are there."""
    h = earlier.groupBy(URL).agg(F.min(F.nullif(F.col(FIRST), F.lit(""))).alias("h_first"))
    return rows.join(h, URL, "left").withColumn(FIRST, F.coalesce(F.least(F.nullif(F.col(FIRST), F.lit("")), F.col("h_first")), F.lit(""))).drop("h_first")


def dropped_union(reports: dict[str, DataFrame], common: list[str]) -> DataFrame:
    """Reports of any columns as one: the common columns, the stage, and the rest as k=v, blanks skipped."""
    out = None
    for stage, r in reports.items():
        rest = [c for c in r.columns if c not in common and c != ORD]
        detail = F.concat_ws(" · ", *[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in rest]) if rest else F.lit("")
        part = r.select(*[(F.col(c) if c in r.columns else F.lit("")).cast("string").alias(c) for c in common], F.lit(stage).alias("stage"), detail.alias("detail"))
        out = part if out is None else out.unionByName(part)
    return out


def unknown_names(given: Column, known: Column) -> Column:
    """G3."""
    return F.array_except(given, known)
