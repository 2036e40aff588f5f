"""The stages in order (Q9): union, image fill, role, screen, wording, rating, core technologies, career, history.

One frame goes through all of them: a row that a gate drops keeps its fate (stage, verdict, grounds) and takes no part in
what follows.  So the final rows, the reports and the funnel all come from that one frame.  Two gates look at other rows
first (the merge across sites at keys, wording at marked companies); before them the frame is written to the folder
that spark.checkpoint.dir names and read again, so what stands before is worked out once.  Without such a folder
it is worked out again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import gates
from ..operators.skills import Matcher
from ..schema import COLUMNS, ORD


@dataclass
class Context:
    """Settings and side tables.  Judgement tables left out keep all rows of their gate."""

    excluded: list[str] = field(default_factory=list)
    core: list[str] = field(default_factory=list)
    ratings: DataFrame | None = None
    reads: DataFrame | None = None
    matcher: Matcher | None = None
    bodies: DataFrame | None = None
    role_verdicts: DataFrame | None = None
    role_fills: DataFrame | None = None
    nuance_verdicts: DataFrame | None = None
    career_verdicts: DataFrame | None = None
    title: Column | None = None


#: Gates that read their input more than once.
READ_TWICE = ("filter", "nuance")
STAGES = ["merged", "image", "role", "filter", "nuance", "rating", "core", "career"]


@dataclass
class Result:
    """rows: every posting, with fate (null: it is in the final list)."""

    rows: DataFrame
    ran: list[str]

    @property
    def final(self) -> DataFrame:
        return self.rows.where(F.col("fate").isNull()).select(*COLUMNS, ORD)

    @property
    def report(self) -> DataFrame:
        """Every dropped row with its stage, verdict and grounds."""
        return self.rows.where(F.col("fate").isNotNull()).select(*gates.COMMON, "fate.stage", "fate.verdict", "fate.detail", ORD)

    @property
    def funnel(self) -> DataFrame:
        """A3: rows after each stage, null for a stage that has not run; one aggregate."""
        pos = F.col("fate.pos")
        counts = self.rows.agg(*[F.count(F.when(pos.isNull() | (pos > k), 1)).alias(f"n{k}") for k in range(len(STAGES))])
        each = [F.struct(F.lit(k).alias("pos"), F.lit(s).alias("stage"), (F.col(f"n{k}") if s in self.ran else F.lit(None).cast("long")).alias("n")) for k, s in enumerate(STAGES)]
        return counts.select(F.inline(F.array(*each)))


def written(df: DataFrame, name: str) -> DataFrame:
    """df from a table in the shared folder, if the session names one: lineage ends there."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        return df
    path = f"{base.rstrip('/')}/hirelens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run(postings: DataFrame, ctx: Context) -> Result:
    """Every dropped row is in the report with its stage; a gate without its side table is passed over."""
    steps = {
        "image": (ctx.reads is not None, lambda p, a: gates.image_fill(p, ctx.reads, ctx.matcher, alive=a)),
        "role": (ctx.role_verdicts is not None and ctx.bodies is not None, lambda p, a: gates.role(p, ctx.role_verdicts, ctx.bodies, ctx.role_fills, matcher=ctx.matcher, alive=a)),
        "filter": (True, lambda p, a: gates.screen(p, ctx.excluded, ctx.title, alive=a)),
        "nuance": (ctx.nuance_verdicts is not None, lambda p, a: gates.nuance(p, ctx.nuance_verdicts, ctx.bodies, alive=a)),
        "rating": (ctx.ratings is not None, lambda p, a: gates.rating(p, ctx.ratings, alive=a)),
        "core": (bool(ctx.core), lambda p, a: gates.core_tech(p, ctx.core, alive=a)),
        "career": (ctx.career_verdicts is not None, lambda p, a: gates.career(p, ctx.career_verdicts, alive=a)),
    }
    rows = postings.withColumn("fate", F.lit(None).cast("struct<pos:int,stage:string,verdict:string,detail:string>"))
    ran = [STAGES[0]]
    for name, (runs, step) in steps.items():
        if not runs:
            continue
        if name in READ_TWICE and len(ran) > 1:
            rows = written(rows, name)
        g = step(rows, F.col("fate").isNull())
        said = [F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in g.detail]
        fate = F.struct(F.lit(STAGES.index(name)).alias("pos"), F.lit(name).alias("stage"), F.col("verdict"), F.concat_ws(" · ", *said).alias("detail"))
        rows = g.rows.withColumn("fate", F.when(F.col("fate").isNull() & F.col("cut"), fate).otherwise(F.col("fate"))).drop("cut", "verdict", *g.detail)
        ran.append(name)
    return Result(rows, ran)
