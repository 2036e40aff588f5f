"""Reading and writing the pipeline's files (S1-S6, K1-K8).  Paths go through Spark, so any store Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import BODY_CAP, is_blank, strip_u
from ..operators import merge
from ..operators.dedup import keep_last
from ..operators.skills import Dictionary
from ..schema import COLUMNS, FIRST, LAST, ORD, POSTING_SCHEMA, URL, as_postings

CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}
# The file of dropped rows.
DROPPED, DROPPED_COMMON = "history_dropped.csv", ["기업명", "공고명", "사이트명", "URL", "판정"]
DROPPED_COLUMNS = ["기록일", "단계", *DROPPED_COMMON, "근거"]


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_any(spark: SparkSession, path: str) -> DataFrame | None:
    """Whatever columns a CSV file has, as strings; None if it is absent."""
    return spark.read.options(**CSV).csv(path) if exists(spark, path) else None


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    """The 14 columns by name; absent ones are empty, further ones ignored, an absent file has no rows."""
    df = read_any(spark, path)
    return as_postings(df) if df is not None else spark.createDataFrame([], POSTING_SCHEMA)


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Url and body; lines that are no JSON are passed over, the last of equal URLs holds (by file, split and line)."""
    if not exists(spark, path):
        return spark.createDataFrame([], "url string, body string")
    raw = spark.read.schema("URL string, `본문` string").option("mode", "DROPMALFORMED").json(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    rows = raw.select(F.col("URL").alias("url"), F.coalesce(F.col("본문"), F.lit("")).alias("body"), place.alias("place")).where(F.coalesce("url", F.lit("")) != "")
    return rows.groupBy("url").agg(F.max_by("body", "place").alias("body"))


def gather_bodies(frames: list[DataFrame]) -> DataFrame:
    """K3: bodies of several sources; blank ones go, long ones are cut, the last of equal URLs holds."""
    out = None
    for k, f in enumerate(frames):
        part = f.select("url", F.substring(strip_u(F.col("body")), 1, BODY_CAP).alias("body"), F.lit(k).cast("long").alias(ORD)).where(~is_blank(F.col("body")))
        out = part if out is None else out.unionByName(part)
    return keep_last(out, "url").drop(ORD)


def read_verdicts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A verdict table with one answer for each URL and rules version, the last one; absent means empty."""
    try:
        rows = spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    keys = [c for c in ("url", "rules_version") if c in rows.columns]
    rest = [c for c in rows.columns if c not in keys]
    order = sorted(rest, key=lambda c: (c != "judged_on", rest.index(c)))
    return rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("row")).select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest]).select(rows.columns)


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """`term` or `term = standard` lines without comments; an absent file has no terms."""
    if not exists(spark, path):
        return spark.createDataFrame([], "term string, standard string")
    line = strip_u(F.regexp_replace("value", r"(?:^|\s)#.*$", ""))
    parts = F.split(line, r"\s*=\s*", 2)
    return spark.read.text(path).where(line != "").select(parts[0].alias("term"), F.coalesce(F.try_element_at(parts, F.lit(2)), parts[0]).alias("standard"))


def read_mapping(spark: SparkSession, path: str, field: str) -> DataFrame:
    """A JSON object of strings as rows name, standard."""
    raw = spark.read.schema(f"`{field}` map<string,string>").option("multiLine", "true").json(path)
    return raw.select(F.explode(F.col(f"`{field}`")).alias("name", "standard"))


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Puts a file in another's place in one step: a reader sees the old one or the new one."""
    jvm = spark._jvm
    to, frm = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(source)
    conf = spark._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.getFileSystem(conf).makeQualified(to).toUri(), conf)
    rename = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = next(x for x in rename.getEnumConstants() if str(x) == "OVERWRITE")
    context.rename(context.makeQualified(frm), context.makeQualified(to), options)


def write_csv(df: DataFrame, path: str, columns: list[str] = COLUMNS) -> None:
    """K1, K2: one ordered CSV file, with a byte order mark, that replaces the file under its name when it is whole."""
    spark = df.sparkSession
    tmp = f"{path}.{uuid.uuid4().hex}"
    rows = df.orderBy(ORD) if ORD in df.columns else df
    rows.select(*[F.col(c).alias(f"﻿{c}" if k == 0 else c) for k, c in enumerate(columns)]).coalesce(1).write.options(header="true", quote='"', escape='"', emptyValue="", quoteAll="false").csv(tmp)
    frm = spark._jvm.org.apache.hadoop.fs.Path(tmp)
    fs = frm.getFileSystem(spark._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(frm) if s.getPath().getName().startswith("part-"))
    replace_file(spark, part.toString(), path)
    fs.delete(frm, True)


def save(spark: SparkSession, rows: DataFrame, path: str, today: str, bodies: DataFrame | None = None) -> DataFrame:
    """Merge what was collected into the CSV file of a site, and its bodies into the file beside it; one row of counts."""
    if bodies is not None:
        beside = path.removesuffix(".csv") + "_bodies.jsonl"
        whole = gather_bodies([read_bodies(spark, beside), bodies])
        tmp = f"{beside}.{uuid.uuid4().hex}"
        write_bodies(whole, tmp)
        put_folder(spark, tmp, beside)
    marked = merge.upsert(read_postings(spark, path), rows, today)
    counts = spark.createDataFrame(merge.counters(marked).collect(), "added long, updated long, unseen long, expired long, undated long")  # one row
    ordered = marked.where(~F.col("expired")).withColumn(ORD, F.row_number().over(Window.orderBy(F.col(LAST).desc(), F.col(FIRST).desc(), F.col(URL).desc())).cast("long"))
    write_csv(ordered, path)  # one file is one task in any case
    return counts


def put_folder(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in another's place; the old one goes only when the new one stands under its name."""
    jvm = spark._jvm
    to, frm, old = (jvm.org.apache.hadoop.fs.Path(x) for x in (target, source, f"{target}.{uuid.uuid4().hex}.old"))
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(to)
    if had and not fs.rename(to, old):
        raise OSError(f"could not put {target} aside")
    if not fs.rename(frm, to):
        if had:
            fs.rename(old, to)
        raise OSError(f"could not rename to {target}")
    if had:
        fs.delete(old, True)


def history_stage(spark: SparkSession, csv: str, history: str, today: str, pairs: list[tuple[str, str]], reports: dict[str, DataFrame]) -> None:
    """Q8: the collected and the final postings into the history files of their names (first seen: the earlier date), and why
    rows were dropped into one file, the last word for each URL and stage."""
    for source, target in pairs:
        fresh, path = read_postings(spark, f"{csv}/{source}"), f"{history}/{target}"
        rows = merge.keep_earliest(merge.merge(read_postings(spark, path), fresh, today), fresh)
        write_csv(rows.withColumn(ORD, F.row_number().over(Window.orderBy(F.col(LAST).desc(), F.col(FIRST).desc(), F.col(URL).desc())).cast("long")), path)
    path = f"{history}/{DROPPED}"
    fresh = merge.dropped_union(reports, DROPPED_COMMON).withColumn("기록일", F.lit(today)).withColumnsRenamed({"stage": "단계", "detail": "근거"})
    before = read_any(spark, path)
    none = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in DROPPED_COLUMNS))
    old = (before if before is not None else none).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in DROPPED_COLUMNS], F.lit(0).alias("age"))
    both = old.unionByName(fresh.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in DROPPED_COLUMNS], F.lit(1).alias("age")))
    kept = both.groupBy("URL", "단계").agg(F.max(F.struct("age", *[c for c in DROPPED_COLUMNS if c not in ("URL", "단계")])).alias("r")).select("URL", "단계", "r.*")
    write_csv(kept.orderBy("단계", "URL"), path, DROPPED_COLUMNS)


def write_bodies(bodies: DataFrame, path: str) -> None:
    """K3."""
    bodies.select(F.col("url").alias("URL"), F.col("body").alias("본문")).orderBy("URL").write.mode("overwrite").json(path)


def read_dictionary(spark: SparkSession, folder: str) -> Dictionary:
    """The dictionary files of a folder; absent ones are empty.  A dictionary is read whole: it is a setting."""

    def lines(name: str) -> list[str]:
        return [r["term"] + (" = " + r["standard"] if r["standard"] != r["term"] else "") for r in read_terms(spark, f"{folder}/{name}").collect()]

    corpus, aliases = {}, {}
    if exists(spark, f"{folder}/tech_corpus.json"):
        raw = spark.read.schema("tech array<struct<name:string,kind:string>>").option("multiLine", "true").json(f"{folder}/tech_corpus.json")
        corpus = {r["name"]: r["kind"] for r in raw.select(F.inline("tech")).collect()}
    if exists(spark, f"{folder}/tech_aliases.json"):
        aliases = {r["name"]: r["standard"] for r in read_mapping(spark, f"{folder}/tech_aliases.json", "aliases").collect()}
    korean = dict(x.split(" = ", 1) if " = " in x else (x, x) for x in lines("tech_ko_allowlist.txt"))
    return Dictionary(corpus, aliases, frozenset(lines("tech_blocklist.txt")), frozenset(lines("tech_rejected.txt")), korean)


def write_candidates(candidates: DataFrame, path: str) -> None:
    """K8: names to look at, as JSON lines, in the place of those before."""
    spark, tmp = candidates.sparkSession, f"{path}.{uuid.uuid4().hex}"
    candidates.write.json(tmp)
    put_folder(spark, tmp, path)


def append_verdicts(verdicts: DataFrame, path: str) -> None:
    """K4: verdicts are only added; readers take those of their rules version."""
    verdicts.write.mode("append").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    """K5."""
    rows.write.mode("append").json(path)


def sweep(spark: SparkSession, folder: str) -> int:
    """K7: delete the sites' collected files once history holds them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().endswith(("_post.csv", "_bodies.jsonl"))]
    return sum(bool(fs.delete(x, True)) for x in gone)


def report_page(template: str, postings: DataFrame, funnel: DataFrame, most: int = 100_000) -> str:
    """K6, Q10: a page with its data as JSON; a page holds at most `most` postings and says so otherwise."""
    rows = postings.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"over {most} postings do not fit in a page; filter first")
    body = f"[{','.join(rows)}]".replace("</", "<\\/")
    stages = f"[{','.join(r for r in funnel.orderBy('pos').toJSON().collect())}]".replace("</", "<\\/")
    return template.replace("__POSTINGS__", body).replace("__FUNNEL__", stages)
