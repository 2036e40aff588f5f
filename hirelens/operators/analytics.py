"""Analytics over kept postings: tiers, companions, lift, families, depth, facets (AN1-AN7, A1-A13, F21, O4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import Rule, hits
from ..functions.text import items


def exploded(df: DataFrame, key: str, names: Column) -> DataFrame:
    """key and name, each name once a row."""
    return df.select(key, F.explode(F.array_distinct(names)).alias("name"))


def tech_frequency(df: DataFrame, names: Column, top: int | None = None) -> DataFrame:
    """A6."""
    out = df.select(F.explode(F.array_distinct(names)).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return out if top is None else out.orderBy(F.col("n").desc(), "name").limit(top)


def tiers(df: DataFrame, req: Column, pref: Column, least: int = 5) -> DataFrame:
    """AN1, AN6: rows that ask for a name against rows that prefer it; one shuffle."""
    both = df.select(F.explode(F.array_distinct(req)).alias("name"), F.lit(1).alias("r"), F.lit(0).alias("p")).unionByName(df.select(F.explode(F.array_distinct(pref)).alias("name"), F.lit(0).alias("r"), F.lit(1).alias("p")))
    n = both.groupBy("name").agg(F.sum("r").alias("n_req"), F.sum("p").alias("n_pref")).where(F.col("n_req") + F.col("n_pref") >= least)
    return n.withColumn("tier", F.when(F.col("n_req") >= 2 * F.col("n_pref"), "기본기").when(F.col("n_pref") >= 2 * F.col("n_req"), "경쟁력").otherwise("갈림"))


def companions(df: DataFrame, names: Column, axes: list[str]) -> DataFrame:
    """AN2."""
    return tech_frequency(df, F.array_except(names, F.array(*[F.lit(a) for a in axes])))


def lift(df: DataFrame, key: str, names: Column, top: int = 22, least: int = 5) -> DataFrame:
    """AN3.  Pairs come from each row's own few top names, so no key is joined with itself."""
    frequent = tech_frequency(df, names, top)
    table = frequent.agg(F.map_from_entries(F.collect_list(F.struct("name", "n"))).alias("counts"))  # at most `top` entries
    total = df.agg(F.count(F.lit(1)).alias("total"))
    own = df.select(F.array_sort(F.array_distinct(names)).alias("own")).crossJoin(F.broadcast(table)).select(F.filter("own", lambda x: F.array_contains(F.map_keys("counts"), x)).alias("own"))
    pairs = own.select(F.explode(F.flatten(F.transform("own", lambda x, i: F.transform(F.slice("own", i + 2, F.size("own")), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n_ab")).where(F.col("n_ab") >= least)
    facts = F.broadcast(table.crossJoin(total))  # one row
    return pairs.crossJoin(facts).select("a", "b", "n_ab", F.round(F.col("n_ab") * F.col("total") / (F.col("counts")[F.col("a")] * F.col("counts")[F.col("b")]), 6).alias("lift"))


def families(df: DataFrame, names: Column, left: list[str], right: list[str], top: int = 5) -> DataFrame:
    """AN4: the most frequent names among rows of one family, the other, or both."""
    has = lambda xs: F.arrays_overlap(names, F.array(*[F.lit(x) for x in xs]))
    family = F.when(has(left) & has(right), "both").when(has(left), "left").when(has(right), "right")
    n = df.select(family.alias("family"), F.explode(F.array_distinct(names)).alias("name")).where("family IS NOT NULL").groupBy("family", "name").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("family").orderBy(F.col("n").desc(), "name")
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def depth(df: DataFrame, columns: dict[str, str], rules: list[Rule]) -> DataFrame:
    """AN5, AN6: rows each rule hits, by column: one pass, one row out per rule and column."""
    aggs = [F.sum(F.col(c).rlike(r.pattern).cast("long")).alias(f"{label}|{r.name}") for label, c in columns.items() for r in rules]
    flat = df.agg(*aggs)
    return flat.select(F.inline(F.array(*[F.struct(F.lit(label).alias("part"), F.lit(r.name).alias("rule"), F.coalesce(F.col(f"`{label}|{r.name}`"), F.lit(0).cast("long")).alias("n")) for label in columns for r in rules])))


def denominators(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """AN7."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.when(F.trim(F.col(c)) != "", 1)).alias(f"n_{k}") for k, c in columns.items()])


def distinct_sites(df: DataFrame, site: str = "site") -> DataFrame:
    """A7."""
    return df.select(site).distinct().orderBy(site)


def coverage(df: DataFrame, flag: Column) -> DataFrame:
    """A5."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(flag.cast("long")), F.lit(0).cast("long")).alias("candidates")).withColumn("skipped", F.col("total") - F.col("candidates")).withColumn("pct", F.round(100 * F.col("candidates") / F.col("total"), 6))


def reason_counts(df: DataFrame, reasons: Column) -> DataFrame:
    """A2."""
    return df.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def search(df: DataFrame, site: str | None = None, chips: list[str] = (), text: str | None = None, columns: list[str] = (), tech: str = "tech") -> DataFrame:
    """site equality, all chips among the technologies, and a substring of any column, ignoring case."""
    out = df
    if site:
        out = out.where(F.col("site") == site)
    if chips:
        own = items(F.col(tech))
        out = out.where(F.forall(F.array(*[F.lit(c) for c in chips]), lambda c: F.array_contains(own, c)))
    if text:
        out = out.where(F.lower(F.concat_ws(" ", *columns)).contains(text.lower()))
    return out


def sort_keys(by: str) -> list[Column]:
    """Rating, deadline (dates first, others last) or company."""
    iso = F.when(F.col("deadline").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("deadline")).otherwise(F.lit("9999-99-99"))
    return {"rating": [F.coalesce(F.expr("try_cast(rating AS double)"), F.lit(-1.0)).desc(), F.col("company")], "deadline": [iso, F.col("company")], "company": [F.col("company")]}[by]


def run_summary(log: DataFrame) -> DataFrame:
    """Totals, the slowest site, and flags by site list.  log: site, rows, seconds, failures, code."""
    flagged = log.withColumns({"ok": F.col("code") == 0, "silent": (F.col("code") == 0) & (F.col("rows") == 0), "incomplete": (F.col("rows") == 0) & (F.col("failures") > 0)})
    names = lambda c: F.array_join(F.sort_array(F.collect_list(F.when(F.col(c), F.col("site")))), ", ").alias(f"{c}_sites")
    return flagged.agg(F.sum("rows").alias("rows"), F.max("seconds").alias("seconds"), F.max_by("site", F.struct("seconds", "site")).alias("slowest"), names("ok"), names("silent"), names("incomplete"))
