"""A postings-shaped view over the driver's tables, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import VALUES_HEADING, strip_u
from ..schema import CAREER, COLUMNS, COMPANY, DEADLINE, FIRST, LAST, ORD, PLACE, PREF, RATING, REQ, SALARY, SITE, SITES, TECH, TITLE, URL

CAREERS = ["신입", "경력 3년 이상", "신입 또는 경력 3년", "정보전략팀: 6년 이상 / 플랫폼팀: 3년 이상", "", "경력 무관", "8~9년차 우대", "경력(5년~8년)", "정규직, 5년차", "[Web] 경력 2년 이상 / [SW] 신입 또는 3년 이상", "경력 미기재 · 3년 이상", "2024년 설립", "신입·경력"]
TECHS = ["Java, Spring Boot", "JavaScript, React", "PHP, Java", "Python(FastAPI, Django), Kotlin", "Kotlin, Java, Python", "https://img/a.png, Go"]
TITLES = ["[IT] 백엔드 개발자 ", "IT 백엔드 개발자 - ", "IT 백엔드・개발자〜", "(IT) 백엔드 개발자 / ", "[안랩] 2026 각  부문 수시채용 ", "데이터 파이프라인 ETL·SRE ", "정보보안 관제, QA ", "_모션 엔지니어_ ", "iOS 앱 개발 DBA ", "백엔드 모집분야 공개 채용 ", "【웹】 서버 개발 "]
REQS = ["• 웹서비스 개발 경력 4년 이상  ", "- 4년제 대학 졸업자 이상", "신입 또는 백엔드 개발 경력 5년 내외", "ㆍ제품개발 경력이 5~10년 정도", "경력직 레퍼런스 체크", "관련 직무 3년 이상 경험자", "우대: 경력 3년 이상"]
PREFS = ["고객사 상주 파견", "SI프로젝트, 병역 특례", "VLSI와 ISMS", "신논현역 초인접", "현역 또는 보충역", "서치펌 Search Firm", "자사 서비스", "전문 연구 요원", "산업기능요원 SM"]
BODIES = ["모집부문 A 모집 분야 B", "채용부문 안내, 모집 직무, 채용부문", "본문", "모집분야", ""]
PLACES = ["서울 강남구", "경기 성남시", "전국", "", "부산"]
NAMES = {COMPANY: "company", TITLE: "title", DEADLINE: "deadline", REQ: "req", PREF: "pref", CAREER: "career", URL: "url", SALARY: "salary", TECH: "tech", PLACE: "place", SITE: "site", RATING: "rating", FIRST: "first_seen", LAST: "last_seen", ORD: "ord"}


def _pick(values: list[str], n):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values)).cast("int") + 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer splits than there are cores (one small file) is dealt out over them; larger ones are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lang = F.col("doc_id"), F.coalesce("lang", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    day = F.date_format(F.date_add(F.lit("2026-09-01").cast("date"), (d % 45).cast("int")), "yyyy-MM-dd")
    df = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        F.when(d % 4 == 0, F.concat(F.lit("(주)"), lang)).when(d % 4 == 1, F.concat(lang, F.lit(" 주식회사"))).when(d % 4 == 2, F.upper(lang)).otherwise(lang).alias(COMPANY),
        F.concat(_pick(TITLES, d), F.split_part(text, F.lit("\n"), F.lit(1))).alias(TITLE),
        F.when(d % 3 == 0, "상시채용").otherwise(day).alias(DEADLINE),
        F.when(d % 22 == 0, f"{VALUES_HEADING}\n• 성실").when(d % 11 == 0, "").otherwise(F.concat_ws("\n", _pick(REQS, d), F.substring(text, F.lit(1), half))).alias(REQ),
        F.when(d % 13 == 0, "").otherwise(F.concat_ws("\n", _pick(PREFS, d), F.substring(text, half + 1, F.length(text)))).alias(PREF),
        _pick(CAREERS, d).alias(CAREER),
        F.concat(F.lit("https://x/"), d.cast("string")).alias(URL),
        F.when(d % 5 == 0, F.concat((d % 9000 + 1000).cast("string"), F.lit("만원"))).otherwise("").alias(SALARY),
        _pick(TECHS, d).alias(TECH), _pick(PLACES, d).alias(PLACE), _pick(SITES, d).alias(SITE),
        F.lit("").alias(RATING), day.alias(FIRST), day.alias(LAST), d.alias(ORD),
    )
    return df.select(*COLUMNS, ORD)


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url and body: the wording of some postings for several roles, and the text of the document; some have none."""
    d, text = F.col("doc_id"), F.coalesce("text", F.lit(""))
    body = F.when(d % 9 == 0, "").otherwise(strip_u(F.concat_ws("\n", _pick(BODIES, d), text)))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(F.concat(F.lit("https://x/"), d.cast("string")).alias("url"), body.alias("body"))


def renamed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, under the view's English names."""
    back = {v: k for k, v in NAMES.items()}
    return df.select(*[F.col(back[c]).alias(c) if back.get(c) in df.columns else F.col(c) for c in columns])


def _sql_pick(values: list[str], n: str = "doc_id") -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][CAST({n} % {len(values)} AS INTEGER) + 1]"


SQL = f"""p AS (
 SELECT CASE doc_id % 4 WHEN 0 THEN '(주)' || coalesce(lang, '') WHEN 1 THEN coalesce(lang, '') || ' 주식회사' WHEN 2 THEN upper(coalesce(lang, '')) ELSE coalesce(lang, '') END AS company,
  {_sql_pick(TITLES)} || split_part(text, chr(10), 1) AS title,
  CASE WHEN doc_id % 3 = 0 THEN '상시채용' ELSE strftime(DATE '2026-09-01' + CAST(doc_id % 45 AS INTEGER), '%Y-%m-%d') END AS deadline,
  CASE WHEN doc_id % 22 = 0 THEN '[인재상 (별도표기)]' || chr(10) || '• 성실' WHEN doc_id % 11 = 0 THEN '' ELSE {_sql_pick(REQS)} || chr(10) || substring(text, 1, length(text) // 2) END AS req,
  CASE WHEN doc_id % 13 = 0 THEN '' ELSE {_sql_pick(PREFS)} || chr(10) || substring(text, length(text) // 2 + 1, length(text)) END AS pref,
  CASE WHEN doc_id % 9 = 0 THEN '' ELSE trim({_sql_pick(BODIES)} || chr(10) || text, E' \\n\\t\\r') END AS body,
  {_sql_pick(CAREERS)} AS career, 'https://x/' || doc_id AS url,
  CASE WHEN doc_id % 5 = 0 THEN (doc_id % 9000 + 1000) || '만원' ELSE '' END AS salary,
  {_sql_pick(TECHS)} AS tech, {_sql_pick(PLACES)} AS place, {_sql_pick(SITES)} AS site, '' AS rating,
  strftime(DATE '2026-09-01' + CAST(doc_id % 45 AS INTEGER), '%Y-%m-%d') AS first_seen,
  strftime(DATE '2026-09-01' + CAST(doc_id % 45 AS INTEGER), '%Y-%m-%d') AS last_seen, doc_id AS ord
 FROM (SELECT * REPLACE (coalesce(text, '') AS text) FROM documents))"""

KEY = r"lower(regexp_replace(regexp_replace(company, '주식회사|㈜|\(주\)|\(유\)|\(재\)|\(사\)|유한책임회사|유한회사', '', 'g'), '\s+', '', 'g'))"
# The compatibility forms that the postings here have (DuckDB composes, but does not fold them).
TITLE_KEY = r"lower(regexp_replace(regexp_replace(replace(title, chr(160), ' '), '[\[\]()（）{}<>〈〉《》「」『』~〜\-‐‑‒–—―/／·・,，:：|｜]', '', 'g'), '\s+', '', 'g'))"

BASE = "company, title, deadline, req, pref, body, career, url, salary, tech, place, site, rating, first_seen, last_seen, ord"


def groups(source: str) -> str:
    """Tables g0, g and m over `source`: every row with its group's facts."""
    return f"""g0 AS (SELECT *, {KEY} AS k1, {TITLE_KEY} AS k2, length(req) + length(pref) + length(tech) AS weight FROM {source}),
g AS (SELECT *, count(*) OVER w AS members, count(DISTINCT site) OVER w AS sites, min(ord) OVER w AS place_at,
  row_number() OVER (PARTITION BY k1, k2 ORDER BY weight DESC, ord) AS rk, first_value(url) OVER (PARTITION BY k1, k2 ORDER BY weight DESC, ord) AS survivor_url
  FROM g0 WINDOW w AS (PARTITION BY k1, k2)),
m AS (SELECT *, (members > 1 AND members = sites AND (k1 <> '' OR k2 <> '')) AS merges FROM g)"""


GROUPS = groups("p")


def word_sql(column: str, name: str) -> str:
    return f"regexp_matches({column}, '(^|[^A-Za-z0-9]){name}([^A-Za-z0-9]|$)', 'i')"


def hits_sql(column: str, names: list[str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {word_sql(column, n)} THEN '{n}' END" for n in names) + "], lambda x: x IS NOT NULL)"
