"""Wording of careers, roles and unwanted posts: fixed patterns, and expressions that apply them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import BANNED, HEADHUNT, Rule, any_hit, near
from .text import VALUES_HEADING, is_blank, let, squeeze, strip_u

# Years asked for in requirements, words on the same line that take them back, the career cells that take
# newcomers, how a cell parts its openings, openings for anyone, and years asked for in a career cell.
YEARS = r"(경력|경험|근무|실무)[^\n]{0,12}?(\d{1,2})\s*(년|개월)\s*(이상|이후|차|정도|내외|~)|(\d{1,2})\s*(년|개월)\s*(이상|차)[^\n]{0,10}?(경력|경험|근무|실무)|경력\s*직|(\d{1,2})\s*[~-]\s*(\d{1,2})\s*년"
SAME_LINE_OK = r"신입|무관|우대|졸업\s*예정"
NEWCOMER = r"^(신입|경력무관)"
OPENINGS = r"\s/\s|\s·\s|,\s"
OPEN = r"신입|무관|미기재|명시\s*없|졸업\s*예정|우대"
CELL_YEARS = r"(\d{1,2})\s*년\s*(이상|차|이후|부터)|(\d{1,2})\s*년\s*[~\-–]\s*(\d{1,2})\s*년|(\d{1,2})\s*[~\-–]\s*(\d{1,2})\s*년|경력\s*[(\s]*(\d{1,2})"
# Titles and bodies of postings for several roles; a common word counts from COMMON_LEAST on.
MIXED_TITLE = r"각\s*부문|부문\s*별|분야\s*별|직군\s*별|각\s*분야|모집\s*분야|공개\s*채용|집중\s*채용|수시\s*채용|통합\s*채용|채용\s*통합|전\s*부문|부문\s*채용"
COMMON_BODY, COMMON_LEAST = r"모집\s*부문|모집\s*분야", 2
RARE_BODY = r"채용\s*부문|채용\s*분야|모집\s*직무|부문\s*안내|직군\s*안내"
LEAST_BODY = 400
# Titles of other roles, by name, and of the wanted ones.
FOREIGN_ROLES = [
    Rule("데이터엔지니어", r"데이터[\s가-힣]{0,4}엔지니어|Data\s*Engineer|\bETL\b|데이터\s*파이프라인"),
    Rule("데브옵스", r"DevOps|데브옵스|\bSRE\b|인프라\s*엔지니어|클라우드\s*(시스템\s*)?엔지니어"),
    Rule("머신러닝", r"Machine\s*Learning|\bML\s*Engineer|머신\s*러닝|딥\s*러닝|Researcher"),
    Rule("보안", r"보안\s*(엔지니어|솔루션|개발|관제|컨설)|정보\s*보안|침해\s*대응|취약점\s*진단"),
    Rule("QA", r"(?<![A-Za-z])QA(?![A-Za-z])|테스트\s*엔지니어|품질\s*보증"),
    Rule("임베디드", r"임베디드|펌웨어|Firmware|\bMCU\b|\bRTOS\b"),
    Rule("앱", r"안드로이드|Android|(?<![A-Za-z])iOS(?![A-Za-z])|앱\s*개발|Flutter|모바일\s*개발"),
    Rule("퍼블리셔", r"퍼블리셔|마크업\s*개발"),
    Rule("DBA", r"(?<![A-Za-z])DBA(?![A-Za-z])"),
    Rule("블록체인", r"블록체인|Blockchain"),
    Rule("기술지원", r"Forward\s*Deployed|기술\s*지원\s*엔지니어|솔루션\s*엔지니어|필드\s*엔지니어"),
]
WANTED_ROLE = r"백엔드|Back[\s-]?end|서버\s*개발|서버개발|웹\s*개발|웹개발|웹\s*서비스\s*개발|풀스택|Full[\s-]?stack|프론트|Front[\s-]?end|웹\s*프로그래머|Java|Spring|Node|Django|FastAPI|\bPHP\b|Nest"
IN_COLUMNS, IN_BODY = "공고 칸", "본문"

UNICODE, ANY_CASE = "(?U)", "(?iuU)"


def closed_to_newbie(c: Column) -> Column:
    """the first opening of a career cell that asks for years, unless an opening takes anyone; else null."""
    parts = F.filter(F.transform(F.split(strip_u(F.coalesce(c, F.lit(""))), UNICODE + OPENINGS), strip_u), lambda x: x != "")
    first = F.try_element_at(F.filter(parts, lambda x: x.rlike(UNICODE + CELL_YEARS)), F.lit(1))
    return F.when(~F.exists(parts, lambda x: x.rlike(UNICODE + OPEN)), first)


def accepts_newbie(c: Column) -> Column:
    """F10."""
    return F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit("")).rlike(NEWCOMER)


def demands_years(c: Column) -> Column:
    """the first line of requirements that asks for years without taking it back, stripped; else null."""
    found = F.filter(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: x.rlike(UNICODE + YEARS) & ~x.rlike(UNICODE + SAME_LINE_OK))
    return strip_u(F.try_element_at(found, F.lit(1)))


def contradiction_line(career: Column, requirements: Column) -> Column:
    """the line that asks for years of a posting whose career cell takes newcomers; else null."""
    return F.when(accepts_newbie(career), demands_years(requirements))


def _found(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"{UNICODE}({pattern})"), F.lit(0))


def title_hits(c: Column) -> Column:
    """the words of a title that speak of several roles, each once."""
    return F.array_distinct(F.filter(F.transform(_found(c, MIXED_TITLE), squeeze), lambda x: x != ""))


def body_hits(c: Column) -> Column:
    """what of a body speaks of several roles: how often the common words stand there, and the rare ones."""
    # Either pattern begins with one of these words; a text without them needs no search for the patterns.
    common = F.when(F.coalesce(c, F.lit("")).contains("모집"), _found(c, COMMON_BODY)).otherwise(F.array().cast("array<string>"))
    scarce = F.when(c.contains("채용") | c.contains("모집") | c.contains("부문") | c.contains("직군"), _found(c, RARE_BODY)).otherwise(F.array().cast("array<string>"))
    n, rare = F.size(common), F.array_distinct(F.transform(scarce, squeeze))
    often = F.when(n >= COMMON_LEAST, F.concat(F.lit("본문에 부문 낱말 "), n.cast("string"), F.lit("회")))
    return F.array_compact(F.array(often, F.when(F.size(rare) > 0, F.concat(F.lit("본문에 "), F.array_join(rare, " ")))))


def looks_mixed(title: Column, body: Column) -> Column:
    """F15."""
    return F.concat(F.transform(title_hits(title), lambda x: F.concat(F.lit("제목: "), x)), body_hits(body))


def needs_sections(requirements: Column, body: Column) -> Column:
    """F16: why the sections must be read anew (no requirements but for values, and a body long enough); else null."""
    text, n = F.substring_index(F.coalesce(requirements, F.lit("")), VALUES_HEADING, 1), F.length(strip_u(F.coalesce(body, F.lit(""))))
    return F.when(is_blank(text) & (n >= LEAST_BODY), F.concat(F.lit("지원자격이 빔 · 본문 "), n.cast("string"), F.lit("자")))


def title_unclear(c: Column) -> Column:
    """null where the title names the wanted role; else the other roles it names, or that it names none."""
    t = F.coalesce(c, F.lit(""))
    names = F.array_compact(F.array(*[F.when(t.rlike(ANY_CASE + r.pattern), F.lit(r.name)) for r in FOREIGN_ROLES]))
    other = F.when(F.size(names) > 0, F.concat(F.lit("제목이 다른 직군: "), F.array_join(names, " · "))).otherwise(F.lit("제목에 내 직군 낱말이 없다"))
    return F.when(~t.rlike(ANY_CASE + WANTED_ROLE), other)


def wording_hits(columns: Column, body: Column, width: int = 40) -> Column:
    """Words to judge a posting for, as structs (name, place, near): those of the columns, then those only the body has."""

    def one(text: Column, r: Rule, place: str) -> Column:
        return let(near(text, r, width), lambda x: F.when(x.isNotNull(), F.struct(F.lit(r.name).alias("name"), F.lit(place).alias("place"), x.alias("near"))))

    found = lambda text, place: F.array_compact(F.array(*[one(text, r, place) for r in [*BANNED, *HEADHUNT]]))
    return let(F.struct(found(columns, IN_COLUMNS).alias("own"), found(body, IN_BODY).alias("rest")), lambda x: F.concat(x["own"], F.filter(x["rest"], lambda y: ~F.exists(x["own"], lambda z: z["name"] == y["name"]))))


def wording_found(columns: Column, body: Column) -> Column:
    """Whether there is any such word, without working out what stands near it."""
    return any_hit(columns, [*BANNED, *HEADHUNT]) | any_hit(body, [*BANNED, *HEADHUNT])
