"""The query catalogue over the postings view: name -> (query, SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import markup, rules, text, wording
from ..operators import analytics as an
from ..operators import dedup, gates, images, lookups, merge, sections, sites, skills
from ..schema import CAREER, COMPANY, DEADLINE, FIRST, LAST, ORD, PLACE, PREF, REQ, SALARY, SITE, SITES, TECH, TITLE, URL
from ..sources.files import gather_bodies
from ..streaming import history
from . import pipeline
from .view import BASE, GROUPS, KEY, SQL, bodies, groups, hits_sql, postings, renamed, table, word_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = ["the", "and", "with", "der", "que", "les", "License", "Apache"]
TODAY = "2026-10-20"


def query(sql: str | None = None, view: bool = True):
    def add(f):
        name = f.__name__.removesuffix("_q")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = f"WITH {SQL}{sql if sql.lstrip().startswith(',') else ' ' + sql}" if view else sql
        return f

    return add


def names_in(column: str):
    return skills.plain_names(F.col(column), VOCABULARY)


@query("SELECT url, site, title FROM p")
def scan_union_all_sites(spark, d):
    p = postings(spark, d)
    return renamed(merge.union_all([p.where(F.col(SITE) == s) for s in SITES]), "url", "site", "title")


@query(f", {GROUPS} SELECT url, CASE WHEN merges THEN place_at ELSE ord END AS ord FROM m WHERE NOT merges OR rk = 1")
def dedup_cross_site(spark, d):
    return renamed(dedup.dedup(postings(spark, d), fill=False)[0], "url", "ord")


@query(f""", {GROUPS},
f AS (SELECT *, first_value(CASE WHEN trim(req) <> '' THEN req END IGNORE NULLS) OVER w AS any_req, first_value(CASE WHEN trim(pref) <> '' THEN pref END IGNORE NULLS) OVER w AS any_pref,
 min(first_seen) OVER w AS lo, max(last_seen) OVER w AS hi FROM m WINDOW w AS (PARTITION BY k1, k2 ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT url, md5(CASE WHEN merges AND trim(req) = '' THEN coalesce(any_req, req) ELSE req END) AS req, md5(CASE WHEN merges AND trim(pref) = '' THEN coalesce(any_pref, pref) ELSE pref END) AS pref,
 CASE WHEN merges THEN lo ELSE first_seen END AS first_seen, CASE WHEN merges THEN hi ELSE last_seen END AS last_seen FROM f WHERE NOT merges OR rk = 1""")
def dedup_fill_blanks(spark, d):
    kept = renamed(dedup.dedup(postings(spark, d))[0], "url", "req", "pref", "first_seen", "last_seen")
    return kept.withColumns({"req": F.md5("req"), "pref": F.md5("pref")})


@query(f", {GROUPS} SELECT url, survivor_url FROM m WHERE merges AND rk > 1")
def dedup_dropped_report(spark, d):
    return renamed(dedup.dedup(postings(spark, d), fill=False)[1], "url", "survivor_url")


@query(f", k AS (SELECT {KEY} AS company_key, company, ord FROM p WHERE trim(company) <> ''), r AS (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY length(company) DESC, ord) AS n FROM k) SELECT company_key, company AS name FROM r WHERE n = 1")
def company_representative(spark, d):
    return dedup.representative(postings(spark, d))


def _upsert(spark, d):
    """Both sides together hold every posting; some fresh rows stand there twice."""
    p = postings(spark, d)
    fresh = p.where((F.col(ORD) % 2 == 0) | (F.col(ORD) % 3 == 0))
    return merge.upsert(p.where(F.col(ORD) % 3 != 0), fresh.unionByName(fresh.where(F.col(ORD) % 10 == 0)), TODAY)


UPSERT = f""", o AS (SELECT * FROM p WHERE ord % 3 <> 0), n AS (SELECT *, CASE WHEN ord % 10 = 0 THEN 2 ELSE 1 END AS given FROM p WHERE ord % 2 = 0 OR ord % 3 = 0),
u AS (SELECT coalesce(o.url, n.url) AS url, coalesce(n.given, 0) AS given, CASE WHEN n.url IS NULL THEN o.first_seen ELSE coalesce(nullif(o.first_seen, ''), '{TODAY}') END AS first_seen,
 CASE WHEN n.url IS NULL THEN o.last_seen ELSE '{TODAY}' END AS last_seen, CASE WHEN n.url IS NULL THEN 'unseen' WHEN o.url IS NULL THEN 'added' ELSE 'updated' END AS state
 FROM o FULL JOIN n ON o.url = n.url), e AS (SELECT *, CAST(last_seen AS DATE) < DATE '{TODAY}' - 30 AS expired FROM u)"""


@query(UPSERT + " SELECT url, first_seen, last_seen, state FROM e WHERE NOT expired")
def upsert_retention(spark, d):
    return _upsert(spark, d).where("NOT expired").select(F.col(URL).alias("url"), F.col(FIRST).alias("first_seen"), F.col(LAST).alias("last_seen"), "state")


@query(UPSERT + ", c AS (SELECT count(*) FILTER (state = 'added') AS added, CAST(sum(given) AS BIGINT) AS seen, count(*) FILTER (NOT expired) AS kept, count(*) FILTER (expired) AS expired FROM e) SELECT added, seen - added AS updated, kept - seen AS unseen, expired, CAST(0 AS BIGINT) AS undated FROM c")
def upsert_counters(spark, d):
    return merge.counters(_upsert(spark, d))


@query("SELECT url, CASE WHEN ord % 2 = 0 THEN '2026-01-01' ELSE first_seen END AS first_seen FROM p")
def revive_first_seen(spark, d):
    p = postings(spark, d)
    old = p.where(F.col(ORD) % 2 == 0).withColumn(FIRST, F.lit("2026-01-01"))
    return renamed(merge.revive_first_seen(p, old), "url", "first_seen")


@query("SELECT url, CASE WHEN ord % 2 = 0 THEN least(first_seen, '2026-09-10') ELSE first_seen END AS first_seen FROM p")
def keep_earliest(spark, d):
    p = postings(spark, d)
    return renamed(merge.keep_earliest(p, p.where(F.col(ORD) % 2 == 0).withColumn(FIRST, F.lit("2026-09-10"))), "url", "first_seen")


@query(f"SELECT {KEY} AS company_key, arg_max(title, ord) AS title, min(ord) AS ord FROM p GROUP BY 1")
def keep_last_by_key(spark, d):
    p = postings(spark, d).select(text.company_key(F.col(COMPANY)).alias("company_key"), F.col(TITLE).alias("title"), ORD)
    return dedup.keep_last(p, "company_key").withColumnRenamed(ORD, "ord")


@query("SELECT url, 'tech' AS stage, 'tech=' || tech AS detail FROM p WHERE ord % 2 = 0 UNION ALL SELECT url, 'career', CASE WHEN career = '' THEN '' ELSE 'career=' || career END FROM p WHERE ord % 2 = 1")
def history_dropped_union(spark, d):
    p = renamed(postings(spark, d), "url", "tech", "career", "ord")
    return merge.dropped_union({"tech": p.where("ord % 2 = 0").select("url", "tech"), "career": p.where("ord % 2 = 1").select("url", "career")}, ["url"])


EXCLUDED = ["PHP", "React"]


@query(f"SELECT url, {hits_sql('tech', EXCLUDED)} AS names FROM p WHERE len({hits_sql('tech', EXCLUDED)}) > 0")
def filter_excluded_tech(spark, d):
    p = postings(spark, d).withColumn("names", rules.hits(F.col(TECH), rules.words(EXCLUDED)))
    return renamed(p.where(F.size("names") > 0), "url", "names")


# The rules below are written from the wording of the sites, in the dialect of the SQL engine (no lookaround there).
BANNED_SQL = {
    "SI": "(^|[^A-Za-z0-9])SI([^A-Za-z0-9]|$)", "SM": "(^|[^A-Za-z0-9])SM([^A-Za-z0-9]|$)", "병역특례": r"병역\s*특례", "현역": "(^|[^가-힣])현역", "보충역": "보충역",
    "산업기능요원": r"산업\s*기능\s*요원", "전문연구요원": r"전문\s*연구\s*요원", "고객사": "고객사", "파견": "파견",
}
HEAD_SQL = {"헤드헌팅": r"(?i)헤드\s*헌|서치\s*펌|search\s*firm|채용\s*대행|인재\s*서치|리크루팅\s*(펌|회사)"}
TEXT3 = "title || chr(10) || req || chr(10) || pref"


def list_sql(column: str, rules_: dict[str, str]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({column}, '{p}') THEN '{n}' END" for n, p in rules_.items()) + "], lambda x: x IS NOT NULL)"


@query(f"SELECT url, unnest({list_sql(TEXT3, BANNED_SQL)}) AS name FROM p")
def banned_word_hits(spark, d):
    return renamed(gates.banned_hits(postings(spark, d)), "url", "name")


CORE_SQL = " OR ".join(word_sql("tech || chr(10) || req || chr(10) || pref", n) for n in ("Spring Boot", "Spring", "License"))


@query(f"SELECT url FROM p WHERE {CORE_SQL}")
def core_tech_gate(spark, d):
    return renamed(gates.core_tech(postings(spark, d), ["Spring Boot", "License"]).kept, "url")


@query(f"SELECT url, '제외 · 핵심 기술 없음' AS verdict, tech FROM p WHERE NOT ({CORE_SQL})")
def core_tech_report(spark, d):
    return renamed(gates.core_tech(postings(spark, d), ["Spring Boot", "License"]).report, "url", "verdict", "tech")


OPEN_SQL = r"신입|무관|미기재|명시\s*없|졸업\s*예정|우대"
YEARS_SQL = r"[0-9]{1,2}\s*년\s*(이상|차|이후|부터)|[0-9]{1,2}\s*년\s*[~\-–]\s*[0-9]{1,2}\s*년|[0-9]{1,2}\s*[~\-–]\s*[0-9]{1,2}\s*년|경력\s*[(\s]*[0-9]{1,2}"
PARTS_SQL = r"list_filter(list_transform(regexp_split_to_array(trim(career), '\s/\s|\s·\s|,\s'), lambda x: trim(x)), lambda x: x <> '')"
CLOSED = f"CASE WHEN len(list_filter({PARTS_SQL}, lambda x: regexp_matches(x, '{OPEN_SQL}'))) = 0 THEN list_filter({PARTS_SQL}, lambda x: regexp_matches(x, '{YEARS_SQL}'))[1] END"


@query(f"SELECT url, {CLOSED} AS closed FROM p")
def career_closed(spark, d):
    return postings(spark, d).select(F.col(URL).alias("url"), wording.closed_to_newbie(F.col(CAREER)).alias("closed"))


NEWBIE_SQL = "regexp_matches(replace(career, ' ', ''), '^(신입|경력무관)')"
DEMAND_SQL = r"(경력|경험|근무|실무)[^\n]{0,12}?[0-9]{1,2}\s*(년|개월)\s*(이상|이후|차|정도|내외|~)|[0-9]{1,2}\s*(년|개월)\s*(이상|차)[^\n]{0,10}?(경력|경험|근무|실무)|경력\s*직|[0-9]{1,2}\s*[~-]\s*[0-9]{1,2}\s*년"
LINE_SQL = f"trim(list_filter(string_split(req, chr(10)), lambda x: regexp_matches(x, '{DEMAND_SQL}') AND NOT regexp_matches(x, '신입|무관|우대|졸업\\s*예정'))[1])"


@query(f"SELECT url, {LINE_SQL} AS line FROM p WHERE {NEWBIE_SQL} AND {LINE_SQL} IS NOT NULL")
def career_contradiction_candidates(spark, d):
    p = postings(spark, d).withColumn("line", wording.contradiction_line(F.col(CAREER), F.col(REQ)))
    return renamed(p.where("line IS NOT NULL"), "url", "line")


def uniq_sql(items: str) -> str:
    """The distinct items of a list in order."""
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


SPOKEN = "list_transform({found}, lambda x: regexp_replace(x, '\\s+', ' ', 'g'))"
MIXED_SQL = r"각\s*부문|부문\s*별|분야\s*별|직군\s*별|각\s*분야|모집\s*분야|공개\s*채용|집중\s*채용|수시\s*채용|통합\s*채용|채용\s*통합|전\s*부문|부문\s*채용"
TITLE_SQL = uniq_sql(SPOKEN.format(found=f"regexp_extract_all(title, '{MIXED_SQL}')"))
COMMON_SQL, RARE_SQL = r"len(regexp_extract_all(body, '모집\s*부문|모집\s*분야'))", uniq_sql(SPOKEN.format(found=r"regexp_extract_all(body, '채용\s*부문|채용\s*분야|모집\s*직무|부문\s*안내|직군\s*안내')"))
BODY_SQL = f"list_filter([CASE WHEN {COMMON_SQL} >= 2 THEN '본문에 부문 낱말 ' || {COMMON_SQL} || '회' END, CASE WHEN len({RARE_SQL}) > 0 THEN '본문에 ' || array_to_string({RARE_SQL}, ' ') END], lambda x: x IS NOT NULL)"
#: Borders of words: Hangul counts as part of one.
AT, END = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"
FOREIGN_SQL = {
    "데이터엔지니어": rf"(?i)데이터[\s가-힣]{{0,4}}엔지니어|Data\s*Engineer|{AT}ETL{END}|데이터\s*파이프라인", "데브옵스": rf"(?i)DevOps|데브옵스|{AT}SRE{END}|인프라\s*엔지니어|클라우드\s*(시스템\s*)?엔지니어",
    "머신러닝": rf"(?i)Machine\s*Learning|{AT}ML\s*Engineer|머신\s*러닝|딥\s*러닝|Researcher", "보안": r"보안\s*(엔지니어|솔루션|개발|관제|컨설)|정보\s*보안|침해\s*대응|취약점\s*진단",
    "QA": r"(?i)(^|[^A-Za-z])QA([^A-Za-z]|$)|테스트\s*엔지니어|품질\s*보증", "임베디드": rf"(?i)임베디드|펌웨어|Firmware|{AT}MCU{END}|{AT}RTOS{END}",
    "앱": r"(?i)안드로이드|Android|(^|[^A-Za-z])iOS([^A-Za-z]|$)|앱\s*개발|Flutter|모바일\s*개발", "퍼블리셔": r"퍼블리셔|마크업\s*개발", "DBA": "(?i)(^|[^A-Za-z])DBA([^A-Za-z]|$)",
    "블록체인": "(?i)블록체인|Blockchain", "기술지원": r"(?i)Forward\s*Deployed|기술\s*지원\s*엔지니어|솔루션\s*엔지니어|필드\s*엔지니어",
}
MINE_SQL = rf"(?i)백엔드|Back[\s-]?end|서버\s*개발|웹\s*개발|웹\s*서비스\s*개발|풀스택|Full[\s-]?stack|프론트|Front[\s-]?end|웹\s*프로그래머|Java|Spring|Node|Django|FastAPI|{AT}PHP{END}|Nest"
UNCLEAR_SQL = f"CASE WHEN NOT regexp_matches(title, '{MINE_SQL}') THEN CASE WHEN len({list_sql('title', FOREIGN_SQL)}) > 0 THEN '제목이 다른 직군: ' || array_to_string({list_sql('title', FOREIGN_SQL)}, ' · ') ELSE '제목에 내 직군 낱말이 없다' END END"
SECTIONS_SQL = "CASE WHEN trim(split_part(req, '[인재상 (별도표기)]', 1)) = '' AND length(body) >= 400 THEN '지원자격이 빔 · 본문 ' || length(body) || '자' END"


@query(f"SELECT url, {TITLE_SQL} AS found FROM p")
def role_title_hits(spark, d):
    return postings(spark, d).select(F.col(URL).alias("url"), wording.title_hits(F.col(TITLE)).alias("found"))


@query(f"SELECT url, {BODY_SQL} AS found FROM p")
def role_body_hits(spark, d):
    return bodies(spark, d).select("url", wording.body_hits(F.col("body")).alias("found"))


@query(f"SELECT url, {UNCLEAR_SQL} AS reason FROM p")
def role_title_unclear(spark, d):
    return postings(spark, d).select(F.col(URL).alias("url"), wording.title_unclear(F.col(TITLE)).alias("reason"))


@query(f"SELECT url, {SECTIONS_SQL} AS why FROM p WHERE {SECTIONS_SQL} IS NOT NULL")
def role_needs_sections(spark, d):
    p = gates.with_bodies(postings(spark, d), bodies(spark, d)).withColumn("why", wording.needs_sections(F.col(REQ), F.col("body")))
    return renamed(p.where("why IS NOT NULL"), "url", "why")


def _verdicts(spark, d, *columns):
    return table(spark, d, "labels").select(F.concat(F.lit("https://x/"), F.col("doc_id").cast("string")).alias("url"), *columns)


def _role_verdicts(spark, d):
    """Half of the judged rows are sure; what they say overwrites."""
    texts = {"tech": "Python(FastAPI), 없는 것", "req": "- 골라 낸 요건", "pref": "", "career": "3년 이상"}
    return _verdicts(spark, d, F.lit(4).alias("rules_version"), (F.col("quality") > 0).alias("fits"), (F.col("doc_id") % 2 == 0).alias("sure"), *[F.lit(v).alias(c) for c, v in texts.items()])


def _role_fills(spark, d):
    return _verdicts(spark, d, F.lit(4).alias("rules_version"), F.lit("").alias("tech"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("- 다시 읽은 요건").alias("req"), F.lit("").alias("pref"), F.lit("").alias("career"))


KNOWN = ["Java", "Spring Boot", "JavaScript", "React", "PHP", "Python", "FastAPI", "Django", "Kotlin", "Go", "Docker"]


def _matcher():
    return skills.Matcher(KNOWN)


VALUES_SQL = "CASE WHEN contains(req, '[인재상 (별도표기)]') THEN chr(10) || '[인재상 (별도표기)]' || rtrim(split_part(req, '[인재상 (별도표기)]', 2)) ELSE '' END"


def role_sql(source: str) -> str:
    """Every row of `source` with says, and the four columns as the gate leaves them."""
    return f"""SELECT * REPLACE (
  CASE WHEN says = '남김 · 부문 골라 덮어씀' THEN 'Python, FastAPI' ELSE tech END AS tech, CASE WHEN says = '남김 · 부문 골라 덮어씀' THEN '3년 이상' ELSE career END AS career,
  CASE WHEN says = '남김 · 부문 골라 덮어씀' THEN '- 골라 낸 요건' || {VALUES_SQL} WHEN says = '남김 · 절 복구' THEN '- 다시 읽은 요건' || {VALUES_SQL} ELSE req END AS req) FROM (
 SELECT *, CASE WHEN asked AND body = '' THEN '남김 · 본문 없음' WHEN asked AND doc_id IS NULL THEN '남김 · 판정 실패' WHEN asked AND NOT coalesce(quality > 0, false) THEN '제외 · 내 직군 없음'
   WHEN asked AND ord % 2 = 1 THEN '남김 · 부문 내용 없음' WHEN asked THEN '남김 · 부문 골라 덮어씀' WHEN why IS NULL THEN NULL WHEN doc_id IS NULL THEN '남김 · 절 복구 실패' WHEN ord % 3 = 0 THEN '남김 · 절 복구 · 못 찾음' ELSE '남김 · 절 복구' END AS says
 FROM (SELECT s.*, l.doc_id, l.quality, l.toxic, {SECTIONS_SQL} AS why, (len({TITLE_SQL}) + len({BODY_SQL}) > 0 OR ({UNCLEAR_SQL}) IS NOT NULL) AS asked FROM {source} s LEFT JOIN labels l ON s.ord = l.doc_id))"""


@query(f"SELECT url, says AS verdict, md5(req) AS req, tech, career FROM ({role_sql('p')})")
def role_gate_apply(spark, d):
    g = gates.role(postings(spark, d), _role_verdicts(spark, d), bodies(spark, d), _role_fills(spark, d), matcher=_matcher())
    return renamed(g.rows, "url", "verdict", "req", "tech", "career").withColumn("req", F.md5("req"))


def _career_verdicts(spark, d):
    return _verdicts(spark, d, F.lit(2).alias("rules_version"), (F.col("toxic") == 1).alias("contradiction"), F.lit("").alias("basis"))


def career_sql(source: str) -> str:
    return f"SELECT s.*, coalesce({NEWBIE_SQL} AND {LINE_SQL} IS NOT NULL AND l.toxic = 1, false) AS goes FROM {source} s LEFT JOIN labels l ON s.ord = l.doc_id"


@query(f"SELECT url FROM ({career_sql('p')}) WHERE NOT goes")
def career_gate_apply(spark, d):
    return renamed(gates.career(postings(spark, d), _career_verdicts(spark, d)).kept, "url")


def _nuance_verdicts(spark, d):
    marks = {"firm": (F.col("toxic") == 1) & (F.col("doc_id") % 7 == 0), "onsite": F.col("quality") == 0, "military": F.lit(False), "headhunt": (F.col("toxic") == 1) & (F.col("doc_id") % 7 == 1)}
    return _verdicts(spark, d, F.lit(4).alias("rules_version"), *[v.alias(c) for c, v in marks.items()], F.lit("").alias("basis"))


HITS_SQL = f"list_sort(list_distinct({list_sql(TEXT3, BANNED_SQL | HEAD_SQL)} || {list_sql('body', BANNED_SQL | HEAD_SQL)}))"


def nuance_sql(source: str) -> str:
    """Every row of `source` with says and reason (null: no unwanted word)."""
    return f"""SELECT *, CASE WHEN NOT cand THEN NULL WHEN NOT judged THEN '남김 · 판정 실패' WHEN reasons <> '' THEN '제외 · 피할 자리' ELSE '남김 · 결격 아님' END AS says,
  reasons || CASE WHEN reasons <> '' AND ((firm_all AND NOT firm) OR (head_all AND NOT head)) THEN ' (같은 회사의 다른 공고에서 판정)' ELSE '' END AS reason FROM (
 SELECT *, array_to_string(list_filter([CASE WHEN firm_all THEN 'SI/SM 업체' END, CASE WHEN onsite THEN '상주·파견' END, CASE WHEN head_all THEN '헤드헌팅' END], lambda x: x IS NOT NULL), ' · ') AS reasons FROM (
  SELECT *, judged AND bool_or(firm) OVER (PARTITION BY key) AS firm_all, judged AND bool_or(head) OVER (PARTITION BY key) AS head_all FROM (
   SELECT *, coalesce(judged AND toxic = 1 AND ord % 7 = 0, false) AS firm, coalesce(judged AND toxic = 1 AND ord % 7 = 1, false) AS head, coalesce(judged AND quality = 0, false) AS onsite FROM (
    SELECT *, cand AND doc_id IS NOT NULL AS judged FROM (SELECT s.*, l.doc_id, l.quality, l.toxic, {KEY} AS key, {HITS_SQL} AS words, len({HITS_SQL}) > 0 AS cand
     FROM {source} s LEFT JOIN labels l ON s.ord = l.doc_id)))))"""


@query(f"SELECT url, says AS verdict, reason, array_to_string(words, ', ') AS words FROM ({nuance_sql('p')}) WHERE says IS NOT NULL")
def nuance_propagation(spark, d):
    return renamed(gates.nuance(postings(spark, d), _nuance_verdicts(spark, d), bodies(spark, d)).report, "url", "verdict", "reason", "words")


RATED = "r AS (SELECT DISTINCT {k} AS k, CAST(ascii({k}) * 7 % 10 AS DOUBLE) / 2 AS rating FROM p WHERE {k} <> 'fr')".format(k=KEY)
RATING_SQL = "CASE WHEN r.rating IS NULL THEN '제외 · 잡플래닛에서 못 찾음' WHEN r.rating = 0 THEN '제외 · 평점 없음' WHEN r.rating < 2.9 THEN '제외 · 평점 ' || printf('%.1f', r.rating) ELSE '남김 · 평점 ' || printf('%.1f', r.rating) END"


def _ratings(p):
    key = text.company_key(F.col(COMPANY))
    return p.select(key.alias("company_key")).distinct().where("company_key <> 'fr'").withColumn("rating", F.ascii("company_key") * 7 % 10 / 2)


@query(f", {RATED} SELECT url, {RATING_SQL} AS verdict FROM p LEFT JOIN r ON {KEY} = r.k")
def rating_gate(spark, d):
    p = postings(spark, d)
    return renamed(gates.rating(p, _ratings(p)).report, "url", "verdict")


def _candidates(spark, d):
    return table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("company_key"), F.col("s_name").alias("name"), F.round(F.col("s_acctbal") % 5, 1).alias("rating"), (F.col("s_suppkey") % 7).cast("int").alias("headcount"), F.col("s_suppkey").alias(ORD))


CANDIDATES = "WITH c AS (SELECT CAST(s_nationkey AS VARCHAR) AS company_key, s_name AS name, round(s_acctbal % 5, 1) AS rating, CAST(s_suppkey % 7 AS INTEGER) AS headcount, s_suppkey AS o FROM supplier)"


@query(CANDIDATES + ", r AS (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY coalesce(rating, 0) DESC, coalesce(headcount, 0) DESC, o) AS n FROM c) SELECT company_key, name, headcount FROM r WHERE n = 1", view=False)
def rating_pick_candidate(spark, d):
    return gates.pick_candidate(_candidates(spark, d)).select("company_key", "name", "headcount")


@query(CANDIDATES + " SELECT company_key, name FROM (SELECT *, count(*) OVER (PARTITION BY company_key) AS n FROM c) WHERE n > 1", view=False)
def rating_same_names(spark, d):
    c = _candidates(spark, d)
    many = c.groupBy("company_key").agg(F.collect_list(F.struct("name")).alias("found")).where(F.size("found") > 1)
    return many.select("company_key", F.inline("found"))


#: Company names with what the forms are about: a legal form, parentheses and blanks.
NAMES_SQL = "CASE c_custkey % 4 WHEN 0 THEN '(주)' || c_name WHEN 1 THEN c_name || ' (' || c_mktsegment || ') Lab' WHEN 2 THEN '주식회사  ' || c_name ELSE c_name || ' Korea' END"
FORMS_SQL = r"""f AS (SELECT company_key, raw, bare, trim(regexp_replace(regexp_replace(bare, '\s*[\(（][^)）]*[\)）]', '', 'g'), '\s+', ' ', 'g')) AS outside, trim(regexp_extract(bare, '\s*[\(（][^)）]*[\)）]'), ' ()（）') AS inside
 FROM (SELECT company_key, raw, trim(regexp_replace(regexp_replace(raw, '주식회사|㈜|\(주\)', '', 'g'), '\s+', ' ', 'g'), ' -·,') AS bare FROM n)),
l AS (SELECT company_key, [raw, bare, regexp_replace(bare, '\s+', '', 'g'), outside, regexp_replace(outside, '\s+', '', 'g'), inside, CASE WHEN contains(outside, ' ') THEN split_part(outside, ' ', 1) ELSE '' END, '(주)' || regexp_replace(outside, '\s+', '', 'g')] AS vs,
  ['원문', '법인표기 제거', '공백 제거', '괄호 제거', '괄호+공백 제거', '괄호 안쪽', '첫 어절', '법인표기 추가'] AS hows FROM f),
v AS (SELECT company_key, variant, how, row_number() OVER (PARTITION BY company_key ORDER BY k) - 1 AS pos FROM (
  SELECT *, row_number() OVER (PARTITION BY company_key, lower(variant) ORDER BY k) AS rep FROM (SELECT company_key, unnest(vs) AS variant, unnest(hows) AS how, unnest(range(8)) AS k FROM l) WHERE length(variant) >= 2) WHERE rep = 1)"""


def _names(c):
    k = F.col("c_custkey") % 4
    named = F.when(k == 0, F.concat(F.lit("(주)"), "c_name")).when(k == 1, F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(") Lab"))).when(k == 2, F.concat(F.lit("주식회사  "), "c_name")).otherwise(F.concat("c_name", F.lit(" Korea")))
    return c.select(F.col("c_custkey").cast("string").alias("company_key"), text.variants(named).alias("forms")).select("company_key", F.posexplode("forms").alias("pos", "form")).select("company_key", "pos", "form.variant", "form.how")


@query(f"WITH n AS (SELECT CAST(c_custkey AS VARCHAR) AS company_key, {NAMES_SQL} AS raw FROM customer), {FORMS_SQL} SELECT company_key, CAST(pos AS INTEGER) AS pos, variant, how FROM v", view=False)
def name_variants(spark, d):
    return _names(table(spark, d, "customer"))


@query(f"WITH n AS (SELECT CAST(c_custkey AS VARCHAR) AS company_key, {NAMES_SQL} AS raw FROM customer), {FORMS_SQL}, i AS (SELECT DISTINCT c_name AS name FROM customer WHERE c_custkey % 3 = 0 UNION SELECT DISTINCT c_mktsegment FROM customer) SELECT company_key, CAST(min(pos) AS INTEGER) AS pos, arg_min(variant, pos) AS variant FROM v JOIN i ON v.variant = i.name GROUP BY company_key", view=False)
def rating_ladder(spark, d):
    c = table(spark, d, "customer")
    index = c.where("c_custkey % 3 = 0").select(F.col("c_name").alias("name")).unionByName(c.select(F.col("c_mktsegment").alias("name")))
    return gates.ladder(_names(c), index)


@query("SELECT url, 'https://img/a.png' AS key FROM p WHERE tech LIKE '%https://%'")
def image_rows(spark, d):
    return postings(spark, d).withColumn("key", F.array_join(gates.image_parts(F.col(TECH)), " ")).where("key <> ''").select(F.col(URL).alias("url"), "key")


def _reads(spark):
    return spark.createDataFrame([("https://img/a.png", ["go(Docker)", "no such name"], ["Licensed"], [], ["성실"])], "key string, tech array<string>, req array<string>, pref array<string>, `values` array<string>")


LACKS_SQL = "len(list_filter(string_split(req, chr(10)), lambda x: contains(regexp_replace(lower(x), '[^\\p{L}\\p{N}]+', '', 'g'), 'licensed'))) = 0"
BARE_SQL = "regexp_replace(req, '^\\s+|\\s+$', '', 'g')"


def image_sql(source: str) -> str:
    """Rows of `source` with what the images gave: a requirement that no line has yet, and values under their heading."""
    added = f"CASE WHEN {LACKS_SQL} THEN {BARE_SQL} || CASE WHEN {BARE_SQL} = '' THEN '' ELSE chr(10) END || '• Licensed' ELSE {BARE_SQL} END"
    full = f"{added} || CASE WHEN contains(req, '[인재상 (별도표기)]') THEN '' ELSE chr(10) || '[인재상 (별도표기)]' || chr(10) || '• 성실' END"
    return f"SELECT * REPLACE (CASE WHEN tech LIKE '%https://%' THEN 'Go, Docker' ELSE tech END AS tech, CASE WHEN tech LIKE '%https://%' THEN {full} ELSE req END AS req) FROM {source}"


@query(f"SELECT url, tech, md5(req) AS req FROM ({image_sql('p')})")
def image_fill_apply(spark, d):
    g = gates.image_fill(postings(spark, d), _reads(spark), _matcher())
    return renamed(g.kept, "url", "tech", "req").withColumn("req", F.md5("req"))


@query("SELECT url, md5(CASE WHEN ord % 2 = 0 AND trim(pref) <> '' THEN substring(trim(pref, E' \\n'), 1, 50000) ELSE substring(trim(req, E' \\n'), 1, 50000) END) AS body FROM p WHERE trim(req) <> '' OR (ord % 2 = 0 AND trim(pref) <> '')")
def bodies_gather(spark, d):
    p = renamed(postings(spark, d), "url", "req", "pref", "ord")
    out = gather_bodies([p.select("url", F.col("req").alias("body")), p.where("ord % 2 = 0").select("url", F.col("pref").alias("body"))])
    return out.withColumn("body", F.md5("body"))


@query(f"SELECT url, {hits_sql('req', VOCABULARY)} AS skills FROM p")
def skill_extract_doc(spark, d):
    return postings(spark, d).select(F.col(URL).alias("url"), names_in(REQ).alias("skills"))


@query(f"SELECT name, count(*) AS n FROM (SELECT unnest({hits_sql('req', VOCABULARY)}) AS name FROM p) GROUP BY name ORDER BY n DESC, name LIMIT 14")
def skill_frequency_top14(spark, d):
    return an.tech_frequency(postings(spark, d), names_in(REQ), 14)


def _tier_sql(names: list[str]) -> str:
    return f""", x AS (SELECT unnest({hits_sql('req', names)}) AS name, 1 AS r, 0 AS q FROM p UNION ALL SELECT unnest({hits_sql('pref', names)}), 0, 1 FROM p),
t AS (SELECT name, CAST(sum(r) AS BIGINT) AS n_req, CAST(sum(q) AS BIGINT) AS n_pref FROM x GROUP BY name HAVING sum(r + q) >= 5)
SELECT name, n_req, n_pref, CASE WHEN n_req >= 2 * n_pref THEN '기본기' WHEN n_pref >= 2 * n_req THEN '경쟁력' ELSE '갈림' END AS tier FROM t"""


@query(_tier_sql(VOCABULARY))
def tech_tier(spark, d):
    return an.tiers(postings(spark, d), names_in(REQ), names_in(PREF))


@query(_tier_sql(["for", "von", "de", "la"]))
def soft_skill_tiers(spark, d):
    bundle = ["for", "von", "de", "la"]
    return an.tiers(postings(spark, d), skills.plain_names(F.col(REQ), bundle), skills.plain_names(F.col(PREF), bundle))


LIST = "list_transform(string_split(tech, ','), lambda x: trim(x))"


@query(f"SELECT name, count(*) AS n FROM (SELECT unnest({LIST}) AS name FROM p) WHERE name NOT IN ('Java', 'Python') GROUP BY name")
def companion_frequency(spark, d):
    return an.companions(postings(spark, d), text.items(F.col(TECH)), ["Java", "Python"])


@query(f""", x AS (SELECT ord, unnest({LIST}) AS name FROM p), f AS (SELECT name, count(*) AS n FROM x GROUP BY name ORDER BY n DESC, name LIMIT 22),
ab AS (SELECT a.name AS a, b.name AS b, count(*) AS n_ab FROM x a JOIN x b ON a.ord = b.ord AND a.name < b.name WHERE a.name IN (SELECT name FROM f) AND b.name IN (SELECT name FROM f) GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT a, b, n_ab, round(n_ab * (SELECT count(*) FROM p) / (fa.n * fb.n), 6) AS lift FROM ab JOIN f fa ON fa.name = a JOIN f fb ON fb.name = b""")
def lift_pairs(spark, d):
    return an.lift(postings(spark, d), ORD, text.items(F.col(TECH)))


@query(f""", x AS (SELECT CASE WHEN (list_contains(l, 'Java') OR list_contains(l, 'Kotlin')) AND list_contains(l, 'Python') THEN 'both' WHEN list_contains(l, 'Java') OR list_contains(l, 'Kotlin') THEN 'left' WHEN list_contains(l, 'Python') THEN 'right' END AS family, unnest(l) AS name FROM (SELECT {LIST} AS l FROM p)),
n AS (SELECT family, name, count(*) AS n FROM x WHERE family IS NOT NULL GROUP BY 1, 2) SELECT family, name, n, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n DESC, name) AS rank FROM n) WHERE rank <= 5""")
def family_split(spark, d):
    return an.families(postings(spark, d), text.items(F.col(TECH)), ["Java", "Kotlin"], ["Python"])


DEPTH = [rules.Rule("licensed", "Licensed under"), rules.Rule("work", "This work is"), rules.Rule("see", r"LICENSE|license")]


@query(" UNION ALL ".join(f"SELECT '{part}' AS part, '{r.name}' AS rule, count(*) FILTER (regexp_matches({part}, '{r.pattern}')) AS n FROM p" for part in ("req", "pref") for r in DEPTH))
def requirement_depth(spark, d):
    return an.depth(postings(spark, d), {"req": REQ, "pref": PREF}, DEPTH)


@query("SELECT 'career' AS part, r AS rule, n FROM (SELECT count(*) FILTER (regexp_matches(career, '이상$')) AS a, count(*) FILTER (regexp_matches(career, '^신입')) AS b FROM p), LATERAL (SELECT unnest(['at_least', 'newbie']) AS r, unnest([a, b]) AS n)")
def phrase_style(spark, d):
    return an.depth(postings(spark, d), {"career": CAREER}, [rules.Rule("at_least", "이상$"), rules.Rule("newbie", "^신입")])


@query("SELECT count(*) AS n_rows, count(*) FILTER (trim(req) <> '') AS n_req, count(*) FILTER (trim(pref) <> '') AS n_pref, count(*) FILTER (trim(career) <> '') AS n_career FROM p")
def denominators(spark, d):
    return an.denominators(postings(spark, d), {"req": REQ, "pref": PREF, "career": CAREER})


@query("SELECT count(*) AS total, count(*) FILTER (regexp_matches(career, '신입')) AS candidates, count(*) FILTER (NOT regexp_matches(career, '신입')) AS skipped, round(100 * count(*) FILTER (regexp_matches(career, '신입')) / count(*), 6) AS pct FROM p")
def gate_coverage(spark, d):
    return an.coverage(postings(spark, d), F.col(CAREER).rlike("신입"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest({hits_sql('tech', ['PHP', 'React', 'Go'])}) AS reason FROM p) GROUP BY reason")
def reason_counts(spark, d):
    return an.reason_counts(postings(spark, d), rules.hits(F.col(TECH), rules.words(["PHP", "React", "Go"])))


def _flat(spark, d):
    return renamed(postings(spark, d), "company", "title", "career", "place", "tech", "site", "url", "deadline", "rating", "ord")


@query("SELECT url FROM p WHERE site = 'jumpit' AND list_contains(" + LIST + ", 'Java') AND contains(lower(company || ' ' || title || ' ' || career || ' ' || place), 'th')")
def search_facets(spark, d):
    return an.search(_flat(spark, d), "jumpit", ["Java"], "TH", ["company", "title", "career", "place"]).select("url")


@query("SELECT url, CAST(row_number() OVER (ORDER BY CASE WHEN regexp_matches(deadline, '^\\d{4}-\\d{2}-\\d{2}$') THEN deadline ELSE '9999-99-99' END, company, ord) AS INTEGER) AS pos FROM p ORDER BY pos LIMIT 100")
def search_sorted(spark, d):
    top = _flat(spark, d).orderBy(*an.sort_keys("deadline"), "ord").limit(100)  # a page of the report
    w = Window.orderBy(*an.sort_keys("deadline"), "ord")
    return top.select("url", F.row_number().over(w).alias("pos"))


@query("WITH l AS (SELECT source AS site, doc_id // 2 AS id FROM documents), r AS (SELECT source AS site, count(*) // 2 AS total FROM documents GROUP BY 1), g AS (SELECT site, count(*) AS received, count(DISTINCT id) AS unique_ids FROM l GROUP BY 1) SELECT site, total, received, unique_ids, total = unique_ids AS matches FROM r JOIN g USING (site)", view=False)
def listing_reconcile(spark, d):
    docs = table(spark, d, "documents")
    reported = docs.groupBy(F.col("source").alias("site")).agg(F.floor(F.count(F.lit(1)) / 2).alias("total"))
    return sites.reconcile(docs.select(F.col("source").alias("site"), F.floor(F.col("doc_id") / 2).alias("id")), reported)


@query("SELECT url, page_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM pages WHERE url IS NOT NULL) WHERE n = 1", view=False)
def listing_dedup_pages(spark, d):
    p = table(spark, d, "pages").select("url", "page_id", F.col("page_id").alias(ORD))
    return dedup.keep_first(p, "url").select("url", "page_id")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '연봉 ' WHEN 1 THEN '월급 ' ELSE '' END || CASE WHEN lo = hi THEN format('{:,}만원', lo) ELSE format('{:,}~{:,}만원', lo, hi) END AS salary
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) * 100 AS BIGINT) // 10000 AS lo, CASE WHEN o_orderkey % 2 = 0 THEN CAST(floor(o_totalprice) * 200 AS BIGINT) // 10000 ELSE CAST(floor(o_totalprice) * 100 AS BIGINT) // 10000 END AS hi FROM orders)""", view=False)
def salary_range(spark, d):
    period = F.when(F.col("o_orderkey") % 3 == 0, "year").when(F.col("o_orderkey") % 3 == 1, "MONTH")
    price = F.floor("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", sites.salary_range(period, F.lit(None).cast("double"), price * 100, F.when(F.col("o_orderkey") % 2 == 0, price * 200).otherwise(0)).alias("salary"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m-%d') ELSE '채용시 마감' END AS deadline FROM orders", view=False)
def deadline_normalise(spark, d):
    k, t = F.col("o_orderkey") % 3, F.col("o_orderdate")
    valid, listed = F.when(k == 0, F.date_format(t, "yyyy-MM-dd'T'00:00")), F.when(k == 1, F.concat(F.lit(" ~ "), F.date_format(t, "M / d"), F.lit("(금)"))).otherwise(" 채용시   마감 ")
    return table(spark, d, "orders").select("o_orderkey", sites.jobkorea_deadline(valid, listed).alias("deadline"))


@query("""WITH b AS (SELECT p_partkey, nullif(p_size % 12 - 1, -1) AS a, CASE p_size * 7 % 15 WHEN 0 THEN NULL WHEN 14 THEN 100 ELSE p_size * 7 % 15 END AS c FROM part),
o AS (SELECT p_partkey, a IS NULL AND c IS NULL AS none, coalesce(CASE WHEN a > c THEN c ELSE a END, 0) AS lo, CASE WHEN a > c THEN a ELSE c END AS hi FROM b)
SELECT p_partkey, CASE WHEN none THEN '경력무관' WHEN hi IS NULL OR hi >= 100 THEN CASE WHEN lo = 0 THEN '신입' ELSE lo || '년 이상' END WHEN lo = 0 AND hi = 0 THEN '신입' WHEN lo = 0 THEN '신입~' || hi || '년' WHEN lo = hi THEN lo || '년' ELSE lo || '~' || hi || '년' END AS career FROM o""", view=False)
def career_format(spark, d):
    low, c = F.col("p_size") % 12 - 1, F.col("p_size") * 7 % 15
    return table(spark, d, "part").select("p_partkey", sites.career_range(low, F.when(c == 14, 100).when(c != 0, c)).alias("career"))


# Rows of the sites, from payloads that every document makes; expected values are written down field by field.


def _payload(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") % 2).alias("k"), (F.col("doc_id") % 3).alias("j"), F.coalesce("source", F.lit("")).alias("company"))


def _columns(df, *extra):
    return renamed(df, "url", "site", "company", "title", "deadline", "req", "pref", "career", "salary", "tech", "place")


PAYLOAD = "WITH d AS (SELECT doc_id AS id, doc_id % 2 AS k, doc_id % 3 AS j, coalesce(source, '') AS company FROM documents)"


@query(PAYLOAD + """ SELECT 'https://www.wanted.co.kr/wd/' || id AS url, 'wanted' AS site, company, '백엔드' AS title, CASE k WHEN 0 THEN '2026-09-30' ELSE '상시채용' END AS deadline, 'Java17 경험' AS req, '' AS pref,
 CASE j WHEN 0 THEN '신입~5년' WHEN 1 THEN '경력무관' ELSE '3년 이상' END AS career, '' AS salary, 'Python, Zig, Java, Docker' AS tech, CASE k WHEN 0 THEN '서울 강남구 · 테헤란로 1' ELSE '서울 강남구 역삼동' END AS place FROM d""", view=False)
def wanted_rows(spark, d):
    p = _payload(spark, d)
    k, j = F.col("k") == 0, F.col("j")
    df = p.select(
        "id", F.struct(F.col("company").alias("name")).alias("company"), F.struct(F.lit(" 백엔드 ").alias("position"), F.lit("Java17 경험\n").alias("requirements"), F.lit(None).cast("string").alias("preferred_points"), F.lit("docker 운영").alias("main_tasks")).alias("detail"),
        F.when(k, "2026-09-30T00:00:00").alias("due_time"), F.when(j == 0, 0).when(j == 2, 3).alias("annual_from"), F.when(j == 0, 5).when(j == 2, 100).alias("annual_to"),
        F.struct(F.lit("서울").alias("location"), F.lit("강남구").alias("district"), F.when(k, "테헤란로 1").otherwise("서울 강남구 역삼동").alias("full_location")).alias("address"),
        F.array(*[F.struct(F.lit(x).alias("text")) for x in ("python", "Zig", "풀스택")]).alias("skill_tags"),
    )
    return _columns(sites.wanted_row(df, skills.Matcher(KNOWN, rejected={"풀스택"})))


@query(PAYLOAD + """ SELECT 'https://www.saramin.co.kr/zf_user/jobs/view?rec_idx=' || id AS url, 'saramin' AS site, company, '공고' AS title, CASE k WHEN 0 THEN '2026-09-03' ELSE '09-05' END AS deadline, 'Java 3년' || chr(10) || '학사' AS req, 'Docker & Go' AS pref,
 '신입 · 경력' AS career, CASE k WHEN 0 THEN '연봉 3,000만원' ELSE '' END AS salary, 'Python, Java, Docker, Go, https://i/x.png' AS tech, CASE k WHEN 0 THEN '서울 강남구' ELSE '부산' END AS place FROM d""", view=False)
def saramin_rows(spark, d):
    k = F.col("k") == 0
    top = F.when(k, "<dl><dt> 급여 </dt><dd>연봉 <b>3,000</b> 만원 이상</dd><dt>근무지역</dt><dd>서울 강남구 지도보기</dd></dl><b>마감일</b> 2026.09.03").otherwise("<dl><dt>급여</dt><dd>면접 후 결정</dd></dl>")
    tag = F.lit('<a href="/zf_user/jobs/list/job-category?cat_kewd=235" class="t">#파이썬</a><a href="/zf_user/jobs/list/job-category?cat_kewd=9">#x</a>')
    body = F.lit('<div class="user_content jobsViewDetail_1"><div><p>자격요건</p><p>Java 3년</p><!-- x --><p style="display:none">PHP</p><p>학사</p></div><p>우대사항</p><p>Docker &amp; Go</p><p>복리후생</p>밥</div><p>React</p>')
    df = _payload(spark, d).select(F.col("id").alias("rec_idx"), "company", F.lit("공고").alias("title"), F.lit("~ 9/5(토)").alias("deadline"), F.lit("신입 · 경력 ·  정규직 외").alias("career"), F.lit("부산").alias("place"), F.concat(top, tag, body).alias("page"), F.array(F.lit("https://i/x.png")).alias("image_urls"))
    return _columns(sites.saramin_row(df, _matcher(), {"235": "python"}))


@query(PAYLOAD + """ SELECT 'https://www.jobkorea.co.kr/Recruit/GI_Read/' || id AS url, 'jobkorea' AS site, CASE k WHEN 0 THEN '주식회사 가' ELSE company END AS company, CASE k WHEN 0 THEN '백엔드 개발' ELSE '목록 제목' END AS title, CASE k WHEN 0 THEN '2026-09-30' ELSE '상시채용' END AS deadline,
 'Kotlin' AS req, '' AS pref, CASE k WHEN 0 THEN '경력무관' ELSE '신입' END AS career, CASE k WHEN 0 THEN '연봉 3,000~5,001만원' ELSE '2,800만원' END AS salary, 'Kotlin, https://i/y.png' AS tech, CASE k WHEN 0 THEN '서울 강남구 1' ELSE '부산' END AS place FROM d""", view=False)
def jobkorea_rows(spark, d):
    ld = '{"@type": "JobPosting", "title": " 백엔드\\n 개발", "validThrough": "2026-09-30T23:59", "hiringOrganization": {"name": "주식회사 가"}, "experienceRequirements": "경력무관", "jobLocation": {"address": {"streetAddress": "서울  강남구 1"}}, "baseSalary": {"value": {"unitText": "YEAR", "minValue": 30000000, "maxValue": 50010000}}}'
    page = F.when(F.col("k") == 0, f'<script id="x" type="application/ld+json">{ld}</script>').otherwise("<p>none</p>")
    df = _payload(spark, d).select(
        F.col("id").alias("gno"), "company", F.lit("목록 제목").alias("title"), F.lit(" 상시채용 ").alias("deadline"), F.array(F.lit("신입"), F.lit("학력무관"), F.lit("부산"), F.lit("2,800 만원")).alias("cells"),
        page.alias("detail"), F.lit("<p>지원자격</p><p>Kotlin</p><script>Java</script><p>포지션 소개</p><p>글</p>").alias("body"), F.array(F.lit("https://i/y.png")).alias("image_urls"),
    )
    return _columns(sites.jobkorea_row(df, _matcher()))


@query(PAYLOAD + """ SELECT 'https://www.jobplanet.co.kr/job/search?posting_ids%5B%5D=' || id AS url, 'jobplanet' AS site, CASE k WHEN 0 THEN 'detail co' ELSE company END AS company, '제목' AS title, CASE j WHEN 0 THEN '2026-09-03' WHEN 1 THEN '채용시까지' ELSE '' END AS deadline, 'React 경험' || chr(10) || '학사' AS req, '' AS pref,
 CASE k WHEN 0 THEN '5 ~ 10년, 신입' ELSE '3년 이상' END AS career, CASE k WHEN 0 THEN '3,600만원' ELSE '' END AS salary, 'Java, Python, React, Go' AS tech, CASE j WHEN 0 THEN '경기 수원시' ELSE '서울, 부산' END AS place FROM d""", view=False)
def jobplanet_rows(spark, d):
    k, j = F.col("k") == 0, F.col("j")
    none, lists = F.lit(None).cast("string"), lambda *x: F.array(*[F.lit(v) for v in x])
    posting = F.struct(F.col("id"), F.lit("제목").alias("title"), F.when(j == 0, "2026.9.3 18:00").alias("end_at"), F.struct(F.col("company").alias("name")).alias("company"), F.lit(None).cast("array<string>").alias("recruitment_text"), F.struct(F.lit("3년 이상").alias("text")).alias("annual"), F.lit(None).cast("array<string>").alias("working_area"), lists("서울", " ", "부산").alias("cities"))
    detail = F.struct(
        F.when(k, "detail  co").alias("name"), F.lit(" ").alias("title"), F.when(j == 1, "채용시까지").alias("end_at"), F.lit("React\t 경험\n학사 ").alias("required_qualification"), none.alias("preferred_skill"), F.lit("go 서비스").alias("primary_responsibility"),
        F.when(k, lists("5 ~ 10년", "신입")).alias("recruitment_text"), F.struct(none.alias("text")).alias("annual"), F.when(k, "연봉 3,600 만원").otherwise("면접 후").alias("salary"), F.when(j == 0, "경기  수원시").alias("location"),
        F.lit(None).cast("array<string>").alias("working_area"), F.lit(None).cast("array<string>").alias("cities"), lists("java/python", "zzz", "풀스택").alias("skills"),
    )
    return _columns(sites.jobplanet_row(_payload(spark, d).select(posting.alias("posting"), detail.alias("detail")), _matcher()))


@query(PAYLOAD + """ SELECT 'https://jumpit.saramin.co.kr/position/' || id AS url, 'jumpit' AS site, company, '서버 개발' AS title, CASE WHEN k = 0 THEN '상시채용' WHEN j = 0 THEN '2026-10-01' ELSE '상시채용' END AS deadline, 'Spring Boot' || chr(10) || '학사' AS req, 'Docker' AS pref,
 CASE WHEN k = 0 THEN '신입' WHEN j = 0 THEN '3~7년' WHEN j = 1 THEN '5년' ELSE '2년 이상' END AS career, '' AS salary, 'Java, Go, Spring Boot, Docker' AS tech, CASE j WHEN 0 THEN '서울 강남구' WHEN 1 THEN '서울 1, 서울 2' ELSE '판교' END AS place FROM d""", view=False)
def jumpit_rows(spark, d):
    k, j = F.col("k") == 0, F.col("j")
    none = F.lit(None).cast("string")
    common = lambda c, t: [c.alias("companyName"), t.alias("title"), F.lit(None).cast("boolean").alias("alwaysOpen")]
    position = F.struct(F.col("id"), *common(F.col("company"), F.lit("서버 개발")), F.when(j == 0, "2026-10-01 23:59").alias("closedAt"), k.alias("newcomer"), F.when(j == 0, 3).when(j == 1, 5).otherwise(2).alias("minCareer"), F.when(j == 0, 7).when(j == 1, 5).alias("maxCareer"), F.array(F.lit("go"), F.lit("nope")).alias("techStacks"), F.array(F.lit("판교")).alias("locations"))
    detail = F.struct(
        none.alias("companyName"), none.alias("title"), k.alias("alwaysOpen"), none.alias("closedAt"), F.lit(False).alias("newcomer"), F.lit(None).cast("int").alias("minCareer"), F.lit(None).cast("int").alias("maxCareer"), F.array(F.struct(F.lit("JAVA").alias("stack"))).alias("techStacks"), F.lit(None).cast("array<string>").alias("locations"),
        F.lit("Spring Boot\r\n학사").alias("qualifications"), F.lit("Docker").alias("preferredRequirements"), none.alias("responsibility"), F.when(j == 0, "서울 강남구").alias("location"), F.when(j == 1, F.array(F.struct(F.lit("서울 1").alias("address")), F.struct(F.lit("서울 2").alias("address")))).alias("workingPlaces"),
    )
    return _columns(sites.jumpit_row(_payload(spark, d).select(position.alias("position"), detail.alias("detail")), _matcher()))


@query("SELECT site, count(*) AS rows, count(*) FILTER (trim(req) = '') AS no_requirements, count(*) FILTER (contains(tech, 'http')) AS with_images, CAST(0 AS BIGINT) AS no_technology FROM p GROUP BY site")
def site_collection_stats(spark, d):
    return sites.collection_stats(postings(spark, d))


@query("SELECT DISTINCT site FROM p")
def distinct_sites(spark, d):
    return an.distinct_sites(_flat(spark, d))


@query("SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS code, r_name AS province FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, CAST(r_regionkey AS VARCHAR), r_name FROM region", view=False)
def location_resolve(spark, d):
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    below = n.groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_name").alias("name"), F.col("n_nationkey").cast("string").alias("code"))).alias("districts"))
    return lookups.flatten_places(r.join(below, r["r_regionkey"] == below["n_regionkey"]).select(F.col("r_name").alias("name"), F.col("r_regionkey").cast("string").alias("code"), "districts"))


@query("SELECT p_brand AS name, count(DISTINCT p_size) AS n_codes FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1", view=False)
def ambiguous_names(spark, d):
    return lookups.ambiguous(table(spark, d, "part").select(F.col("p_brand").alias("name"), F.col("p_size").alias("code")))


@query("SELECT DISTINCT lower(c_mktsegment) AS name, c_nationkey AS code FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')", view=False)
def role_codes(spark, d):
    t = table(spark, d, "customer").select(F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("code"))
    return lookups.resolve(spark.createDataFrame([("building",), ("machinery",), ("none",)], "name string"), t)[0]


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script\b.*?</script>', ' ', 'gis'), '<style\b.*?</style>', ' ', 'gis'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""", view=False)
def html_visible_text(spark, d):
    return table(spark, d, "pages").select("page_id", markup.plain_text(F.col("html")).alias("text"))


@query()
def html_lines_sections(spark, d):
    p = table(spark, d, "pages").select("page_id", markup.visible()(F.col("html")).alias("seen"))
    return p.select("page_id", "seen.text", F.inline(F.array(sections.split_body(F.col("seen.lines")))))


INNER_SQL = r"regexp_replace(tech, '\(([^(),]*), *([^(),]*)\)', '(\1·\2)', 'g')"


@query(f"SELECT url, flatten(list_transform(list_transform(string_split({INNER_SQL}, ','), lambda x: trim(x)), lambda x: CASE WHEN contains(x, '(') THEN [split_part(x, '(', 1)] || string_split(rtrim(split_part(x, '(', 2), ')'), '·') ELSE [x] END)) AS names FROM p")
def split_names(spark, d):
    return postings(spark, d).select(F.col(URL).alias("url"), text.split_names(F.col(TECH)).alias("names"))


TRAILERS_SQL = "|".join(sorted(set(skills.TRAILERS)))
PROSE_SQL = "req || chr(10) || pref"
NAMED_SQL = "[" + ", ".join(f"CASE WHEN regexp_matches({PROSE_SQL}, '(?i)(^|[^A-Za-z0-9]){n}{'[0-9]*' if len(n) > 2 else ''}([^A-Za-z0-9]|$)') THEN '{n}' END" for n in [*KNOWN, "License", "Apache"]) + f", CASE WHEN regexp_matches({PROSE_SQL}, '경력([^가-힣]|$|{TRAILERS_SQL})') THEN '경력' END]"
TAGS_SQL = f"list_filter({LIST}, lambda x: list_contains(['{"', '".join(KNOWN)}'], x))"


@query(f"SELECT url, list_sort(list_distinct(list_filter({TAGS_SQL} || {NAMED_SQL}, lambda x: x IS NOT NULL))) AS skills FROM p")
def skill_matcher_prose(spark, d):
    m = skills.Matcher([*KNOWN, "License", "Apache", "경력"], korean={"경력": "경력"})
    p = postings(spark, d).withColumn("tags", m.keep_known(text.items(F.col(TECH))))
    return skills.extract(p, m, "tags", REQ, PREF).select(F.col(URL).alias("url"), F.array_sort("skills").alias("skills"))


@query(f"""SELECT name, count(*) AS n, list_sort(list_distinct(list(site))) AS sites, list_sort(list_distinct(list(url)))[1:3] AS examples, min(first_seen) AS first_seen, max(last_seen) AS last_seen
FROM (SELECT unnest({LIST}) AS name, site, url, first_seen, last_seen FROM p) WHERE name NOT IN ('Java', 'Kotlin', 'React') GROUP BY name""")
def corpus_candidates(spark, d):
    p = postings(spark, d).select(F.explode(text.items(F.col(TECH))).alias("name"), F.col(SITE).alias("site"), F.col(URL).alias("example"), F.col(FIRST).alias("seen"))
    return skills.candidate_names(p, skills.Matcher(["Java", "Kotlin", "React"]))


@query("SELECT CAST(sum(rows) AS BIGINT) AS rows, max(seconds) AS seconds, arg_max(site, seconds) AS slowest, string_agg(site, ', ' ORDER BY site) AS ok_sites, '' AS silent_sites, '' AS incomplete_sites FROM (SELECT source AS site, count(*) AS rows, max(n_chars * 1000 + CAST(substring(source, 4) AS INTEGER)) AS seconds FROM documents GROUP BY 1)", view=False)
def site_run_summary(spark, d):
    log = table(spark, d, "documents").groupBy(F.col("source").alias("site")).agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("n_chars") * 1000 + F.substring("source", 4, 9).cast("int")).alias("seconds")).withColumns({"failures": F.lit(0), "code": F.lit(0)})
    return an.run_summary(log)


def _escaped(c):
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(sign), F.lit(entity))
    return c


def _html(*parts):
    return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])


ONE_LINE = r"trim(regexp_replace(replace({}, chr(160), ' '), '\s+', ' ', 'g'))"


def _listing(spark, d, head, block):
    """A page for each posting: what stands before the listing, the posting's block, and a further block of its id."""
    p = postings(spark, d)
    page = F.concat(head, block(_escaped(F.col(COMPANY))), block(F.lit("again")))
    return p.select(F.col(ORD).alias("page"), page.alias("html"))


@query(f"""SELECT CAST(ord AS VARCHAR) AS rec_idx, {ONE_LINE.format('company')} AS company, {ONE_LINE.format('title')} AS title, '백엔드 , 서버' AS sector, place, {ONE_LINE.format('career')} AS career, '' AS education,
 CASE WHEN ord % 2 = 0 THEN deadline ELSE '' END AS deadline, CASE WHEN ord % 7 > 0 THEN ord * 1000 + 7 END AS total FROM p""")
def listing_saramin(spark, d):
    ad = '<div id="rec-7" class="list_item"><p class="career">광고</p></div>'
    head = F.when(F.col(ORD) % 7 > 0, _html(ad, "<h2>전체 채용정보 <b>", F.format_number(F.col(ORD) * 1000 + 7, 0), "</b>\n건</h2>")).otherwise("")

    def block(company):
        name = F.when(F.col(ORD) % 3 == 0, _html('<span class="str_tit">', company, "</span>")).otherwise(_html('<a href="x" class="str_tit">', company, "</a>"))
        return _html(
            '<div id="rec-', F.col(ORD).cast("string"), F.when(F.col(ORD) % 5 == 0, '" class="list_item effect">').otherwise('" class="list_item">'), '<div class="col company_nm">\n', name, '</div><div class="job_tit"><a><span>',
            _escaped(F.col(TITLE)), '</span></a></div><span class="job_sector"><span>백엔드</span>, <span>서버</span> 외</span><p class="work_place">', F.col(PLACE), '</p><p class="career">', _escaped(F.col(CAREER)),
            "</p>", F.when(F.col(ORD) % 2 == 0, _html('<span class="date">', F.col(DEADLINE), "</span>")).otherwise(""), "</div>",
        )

    pages = _listing(spark, d, head, block)
    totals = pages.select(F.col("page").cast("string").alias("rec_idx"), sites.saramin_total(F.col("html")).alias("total"))
    return sites.saramin_listing(pages).join(totals, "rec_idx")


@query(f"""SELECT CAST(ord AS VARCHAR) AS gno, {ONE_LINE.format('company')} AS company, {ONE_LINE.format('title')} AS title, '서버 & 웹' AS summary, deadline,
 CASE WHEN ord % 4 = 0 THEN [] WHEN salary = '' THEN [{ONE_LINE.format('career')}, '학력 무관', place] ELSE [{ONE_LINE.format('career')}, '학력 무관', place, salary] END AS cells FROM p""")
def listing_jobkorea(spark, d):
    def block(company):
        cell = lambda c: _html('<span class="cell">', c, "</span>")
        cells = _html(cell(_escaped(F.col(CAREER))), cell("학력<b>무관</b>"), cell(F.col(PLACE)), F.when(F.col(SALARY) != "", cell(F.col(SALARY))).otherwise(""))
        return _html(
            '<tr class="devloopArea" data-x="1" data-gno="', F.col(ORD).cast("string"), '"><td class="tplCo"><a href="x">', company, '</a></td><div class="titBx"><div class="badge"></div><strong><a>', _escaped(F.col(TITLE)),
            '</a></strong></div><p class="dsc">서버 &amp;\n웹</p>', F.when(F.col(ORD) % 4 > 0, _html('<p class="etc">', cells, "</p>")).otherwise(""), '<span class="date dotum">', F.col(DEADLINE), "</span></tr>",
        )

    return sites.jobkorea_listing(_listing(spark, d, F.lit("<table>"), block))


BANDS = """WITH f AS (SELECT l_orderkey AS image, l_linenumber AS y FROM lineitem GROUP BY 1, 2 HAVING max(l_quantity) - min(l_discount) <= 30),
s AS (SELECT image, y, CASE WHEN y - lag(y) OVER w = 1 THEN 0 ELSE 1 END AS begins FROM f WINDOW w AS (PARTITION BY image ORDER BY y)),
r AS (SELECT *, sum(begins) OVER (PARTITION BY image ORDER BY y) AS run FROM s) SELECT image, min(y) AS first, max(y) AS last FROM r GROUP BY image, run"""


@query(BANDS, view=False)
def flat_row_bands(spark, d):
    """Order lines stand for rows of an image: quantity is the brightest pixel of a row, discount the darkest."""
    rows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("y")).agg(F.min("l_discount").alias("darkest"), F.max("l_quantity").alias("brightest"))
    return images.flat_bands(rows, "image", "y", images.is_flat(F.col("darkest"), F.col("brightest"), 30))


@query("""SELECT doc_id, CASE WHEN s < 60 THEN '방금' WHEN s < 3600 THEN s // 60 || '분 전' WHEN s < 86400 AND s % 3600 < 60 THEN s // 3600 || '시간 전' WHEN s < 86400 THEN s // 3600 || '시간 ' || s % 3600 // 60 || '분 전'
 WHEN s % 86400 < 3600 THEN s // 86400 || '일 전' ELSE s // 86400 || '일 ' || s % 86400 // 3600 || '시간 전' END AS age FROM (SELECT doc_id, doc_id * doc_id AS s FROM documents)""", view=False)
def age_in_words(spark, d):
    return table(spark, d, "documents").select("doc_id", text.spoken(F.col("doc_id") * F.col("doc_id")).alias("age"))


CORE = ["Java", "Kotlin", "Python"]


def _run(spark, d):
    """All eight stages with their side tables."""
    p = postings(spark, d)
    return pipeline.run(p, pipeline.Context(
        excluded=EXCLUDED, core=CORE, ratings=_ratings(p), reads=_reads(spark), matcher=_matcher(), bodies=bodies(spark, d), role_verdicts=_role_verdicts(spark, d),
        role_fills=_role_fills(spark, d), nuance_verdicts=_nuance_verdicts(spark, d), career_verdicts=_career_verdicts(spark, d),
    ))


FILL = ", ".join(f"CASE WHEN merges AND trim({c}) = '' THEN coalesce(first_value(CASE WHEN trim({c}) <> '' THEN {c} END IGNORE NULLS) OVER w, {c}) ELSE {c} END AS {c}" for c in ("career", "req", "pref", "tech", "company", "title"))
PIPE = f""", {RATED}, s1 AS (SELECT {BASE} FROM ({image_sql('p')})), s2 AS (SELECT {BASE} FROM ({role_sql('s1')}) WHERE says IS NULL OR says <> '제외 · 내 직군 없음'), {groups('s2')},
filled AS (SELECT * REPLACE ({FILL}) FROM m WINDOW w AS (PARTITION BY k1, k2 ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
s3 AS (SELECT {BASE} FROM filled WHERE (NOT merges OR rk = 1) AND len({hits_sql('tech', EXCLUDED)}) = 0 AND ({CLOSED}) IS NULL),
s4 AS (SELECT {BASE} FROM ({nuance_sql('s3')}) WHERE says IS NULL OR says <> '제외 · 피할 자리'), s5 AS (SELECT s4.* FROM s4 JOIN r ON {KEY} = r.k WHERE r.rating >= 2.9),
s6 AS (SELECT * FROM s5 WHERE {' OR '.join(word_sql("tech || chr(10) || req || chr(10) || pref", n) for n in CORE)}), s7 AS (SELECT * FROM ({career_sql('s6')}) WHERE NOT goes)"""


@query(PIPE + " SELECT url, career, tech, md5(req) AS req FROM s7")
def pipeline_final(spark, d):
    return renamed(_run(spark, d).final, "url", "career", "tech", "req").withColumn("req", F.md5("req"))


@query(PIPE + " SELECT * FROM (VALUES " + ", ".join(f"({k}, '{stage}', (SELECT count(*) FROM {t}))" for k, (stage, t) in enumerate(zip(pipeline.STAGES, ["p", *(f"s{i}" for i in range(1, 8))], strict=True))) + ") t(pos, stage, n)")
def funnel(spark, d):
    return _run(spark, d).funnel


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2", view=False)
def events_tumbling(spark, d):
    return history.tumbling(table(spark, d, "events"))


@query("""WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events),
g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM o) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, s""", view=False)
def events_session(spark, d):
    return history.sessions(table(spark, d, "events"))
