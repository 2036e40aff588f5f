"""Rows of the posting relation from the payloads of five sites, and their field rules.

A payload table has one row for each posting; JSON payloads are read with a schema (columns and structs), pages as text.
Row builders want a Matcher for technologies.  A posting without its id gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import markup
from ..functions.text import distinct_ci, items, squeeze, strip_u, trim_field, unescape
from ..schema import CAREER, COLUMNS, COMPANY, DEADLINE, ORD, PLACE, PREF, REQ, SALARY, SITE, TECH, TITLE, URL
from .sections import EXTRA_JOBKOREA, split_body
from .skills import Matcher

# Wording of deadlines and careers, addresses, and amounts of pay.
ALWAYS, NEWBIE, ANY_CAREER, UNBOUNDED = "상시채용", "신입", "경력무관", 100
EMPLOYMENT = "정규직 계약직 아르바이트 인턴직 프리랜서 파트 위촉직 파견직 전임 병역특례 교육생 해외취업".split()
ADDRESS = {
    "wanted": "https://www.wanted.co.kr/wd/",
    "saramin": "https://www.saramin.co.kr/zf_user/jobs/view?rec_idx=",
    "jobkorea": "https://www.jobkorea.co.kr/Recruit/GI_Read/",
    "jobplanet": "https://www.jobplanet.co.kr/job/search?posting_ids%5B%5D=",
    "jumpit": "https://jumpit.saramin.co.kr/position/",
}
PERIODS = {"YEAR": "연봉", "MONTH": "월급", "WEEK": "주급", "DAY": "일급", "HOUR": "시급"}
PAY = r"(연봉|월급|주급|일급|시급)\s*([\d,]+)\s*(만원|원)"
AMOUNT = r"([\d,]{3,})\s*(만원|원)"
DATE = r"(\d{4})[.\-/](\d{1,2})[.\-/](\d{1,2})"
DAY = r"(\d{1,2})\s*[./-]\s*(\d{1,2})"
DETAIL_DATE = r"마감일\s*(\d{4})\.(\d{2})\.(\d{2})"
MAP_WORDS = r"\s*(지도보기|주변정보|약도)\s*$"
#: Listing pages: where advertisements end, the start of a block with its id, and the place of each field in it.
ADS_END, HEAD = "전체 채용정보", 600
TOTAL = r"전체 채용정보\s+([\d,]+)\s*건"
SARAMIN_ITEM = r'<div id="rec-(\d+)" class="list_item[^"]*">'
SARAMIN_FIELDS = {
    "company": (r'class="col company_nm">.*?<(a|span)[^>]*class="str_tit"[^>]*>(.*?)</\1>', 2),
    "title": (r'<div class="job_tit">.*?<span>(.*?)</span>', 1),
    "sector": (r'<span class="job_sector">(.*?)</span>\s*(?:외)?\s*</span>', 1),
    "place": (r'<p class="work_place">(.*?)</p>', 1),
    "career": (r'<p class="career">(.*?)</p>', 1),
    "education": (r'<p class="education">(.*?)</p>', 1),
    "deadline": (r'<span class="date">(.*?)</span>', 1),
}
JOBKOREA_ITEM = r'<tr class="devloopArea"[^>]*data-gno="(\d+)"'
JOBKOREA_FIELDS = {
    "company": (r'<td class="tplCo"[^>]*>.*?<a[^>]*>(.*?)</a>', 1),
    "title": (r'<div class="titBx">.*?<strong>\s*<a[^>]*>(.*?)</a>', 1),
    "summary": (r'<p class="dsc">(.*?)</p>', 1),
    "deadline": (r'<span class="date[^"]*">(.*?)</span>', 1),
}
JOBKOREA_CELLS, JOBKOREA_CELL = r'<p class="etc">(.*?)</p>', r'<span class="cell">(.*?)</span>'
TAG = r'/zf_user/jobs/list/job-category\?cat_kewd=(\d+)"[^>]*?>#([^<]{1,40})</a>'
BODY_WANTED = ["intro", "main_tasks", "requirements", "preferred_points", "benefits", "hire_rounds"]
PROSE_JOBPLANET = ["required_qualification", "preferred_skill", "primary_responsibility"]
PROSE_JUMPIT = ["qualifications", "preferredRequirements", "responsibility"]


def _or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _text(c: Column) -> Column:
    """One kind of line end, one blank for blanks and tabs, nothing around."""
    return strip_u(F.regexp_replace(F.regexp_replace(_or_empty(c), "\r\n?", "\n"), r"[ \t]+", " "))


def first_of(*columns: Column) -> Column:
    """The first that is not empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def dated(c: Column) -> Column:
    """M4: the first date as YYYY-MM-DD, null if there is none."""
    pad = lambda g: F.lpad(F.regexp_extract(c, DATE, g), 2, "0")
    return F.when(c.rlike(DATE), F.concat_ws("-", F.regexp_extract(c, DATE, 1), pad(2), pad(3)))


def listed_deadline(c: Column) -> Column:
    """M2, M3: of a listing's phrase the day as MM-DD (a year is never invented), else the phrase itself."""
    raw = squeeze(_or_empty(c))
    pad = lambda g: F.lpad(F.regexp_extract(raw, DAY, g), 2, "0")
    return F.when(raw.rlike(DAY), F.concat_ws("-", pad(1), pad(2))).otherwise(raw)


def wanted_deadline(c: Column) -> Column:
    """M1."""
    return F.when(_or_empty(c) == "", ALWAYS).otherwise(F.substring(c, 1, 10))


def saramin_deadline(page: Column, listed: Column) -> Column:
    """M2: the detail page's date comes first."""
    plain = F.regexp_replace(_or_empty(page), "<[^>]+>", " ")
    return F.when(plain.rlike(DETAIL_DATE), F.concat_ws("-", *[F.regexp_extract(plain, DETAIL_DATE, g) for g in (1, 2, 3)])).otherwise(listed_deadline(listed))


def jobkorea_deadline(valid_through: Column, listed: Column) -> Column:
    """M3."""
    given = F.regexp_extract(_or_empty(valid_through), r"^(\d{4}-\d{2}-\d{2})", 1)
    return first_of(given, listed_deadline(listed))


def career_range(low: Column, high: Column) -> Column:
    """M1: a phrase from bounds in years: negative ones count as none, turned round ones are turned, absurd highs are open."""
    a, b = F.when(low >= 0, low), F.when(high >= 0, high)
    lo, hi = F.when(a > b, b).otherwise(a), F.when(a > b, a).otherwise(b)
    n = lambda x: x.cast("int").cast("string")
    at_least, open_ = F.coalesce(lo, F.lit(0)), hi.isNull() | (hi >= UNBOUNDED)
    return (
        F.when(lo.isNull() & hi.isNull(), ANY_CAREER)
        .when(open_ & (at_least == 0), NEWBIE)
        .when(open_, F.concat(n(at_least), F.lit("년 이상")))
        .when((at_least == 0) & (hi == 0), NEWBIE)
        .when(at_least == 0, F.concat(F.lit("신입~"), n(hi), F.lit("년")))
        .when(at_least == hi, F.concat(n(hi), F.lit("년")))
        .otherwise(F.concat(n(at_least), F.lit("~"), n(hi), F.lit("년")))
    )


def saramin_career(c: Column) -> Column:
    """M2: the parts of a listing's career cell that are no form of employment."""
    parts = F.transform(F.split(squeeze(_or_empty(c)), "·"), strip_u)
    return F.array_join(F.filter(parts, lambda x: (x != "") & ~strip_u(F.replace(x, F.lit(" 외"), F.lit(""))).isin(EMPLOYMENT)), " · ")


def jumpit_career(newcomer: list[Column], bounds: list[tuple[Column, Column]]) -> Column:
    """M5: newcomers first, then the first pair of bounds that has one; a lone bound is a least."""
    out = F.lit("")
    n = lambda x: x.cast("int").cast("string")
    for low, high in reversed(bounds):
        lone = F.concat(n(F.coalesce(low, high)), F.lit("년 이상"))
        both = F.when(low == high, F.concat(n(low), F.lit("년"))).otherwise(F.concat(n(low), F.lit("~"), n(high), F.lit("년")))
        out = F.when(low.isNull() & high.isNull(), out).when(low.isNull() | high.isNull(), lone).otherwise(both)
    any_new = F.lit(False)
    for c in newcomer:
        any_new = any_new | F.coalesce(c, F.lit(False))
    return F.when(any_new, NEWBIE).otherwise(out)


def salary_range(period: Column, *amounts: Column) -> Column:
    """M3: the positive ones of some amounts in won, as ten thousands, a range if they differ, behind the period they are for."""
    real = F.array_compact(F.array(*[F.when(a > 0, F.floor(a.cast("double")).cast("long")) for a in amounts]))
    man = lambda x: F.format_number(F.floor(x / 10000), 0)
    low, high = F.array_min(real), F.array_max(real)
    span = F.when(low == high, F.concat(man(low), F.lit("만원"))).otherwise(F.concat(man(low), F.lit("~"), man(high), F.lit("만원")))
    name = F.lit("")
    for code, word in PERIODS.items():
        name = F.when(F.upper(_or_empty(period)) == code, word).otherwise(name)
    return F.when(F.size(real) == 0, "").otherwise(F.trim(F.concat_ws(" ", name, span)))


def text_salary(c: Column) -> Column:
    """M4: an amount in a text, as it stands."""
    return F.concat(F.regexp_extract(_or_empty(c), AMOUNT, 1), F.regexp_extract(_or_empty(c), AMOUNT, 2))


def saramin_salary(page: Column) -> Column:
    """M6: period and amount of the summary, only if there is a real amount."""
    c = summary_field(page, "급여")
    part = lambda g: F.regexp_extract(c, f"(?U){PAY}", g)
    return F.when(part(1) != "", F.concat(part(1), F.lit(" "), part(2), part(3))).otherwise("")


def saramin_workplace(page: Column, listed: Column) -> Column:
    """M6."""
    return first_of(F.btrim(F.regexp_replace(summary_field(page, "근무지역"), MAP_WORDS, ""), F.lit(" ,")), _or_empty(listed))


def workplace(location: Column, district: Column, full: Column) -> Column:
    """M7: province and district before the full address, unless it has the district or there is none."""
    place, d = strip_u(_or_empty(full)), strip_u(_or_empty(district))
    known = strip_u(F.array_join(F.filter(F.array(_or_empty(location), d), lambda x: x != ""), " "))
    return F.when(place == "", known).when((known == "") | ((d != "") & place.contains(d)), place).otherwise(F.concat_ws(" · ", known, place))


def joined_names(a: Column) -> Column:
    return F.array_join(F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: strip_u(F.regexp_replace(F.coalesce(x, F.lit("")), r"[ \t]+", " "))), lambda x: x != ""), ", ")


def body_of(*columns: Column) -> Column:
    """Fields as lines; blanks stay as empty lines between them."""
    return strip_u(F.concat_ws("\n", *[strip_u(_or_empty(c)) for c in columns]))


def prose(source: str, fields: list[str]) -> Column:
    """Fields of a payload as one text."""
    return strip_u(F.concat_ws("\n", *[_or_empty(F.col(f"{source}.{f}")) for f in fields]))


def _row(df: DataFrame, site: str, key: str, **content: Column) -> DataFrame:
    names = {"company": COMPANY, "title": TITLE, "deadline": DEADLINE, "req": REQ, "pref": PREF, "career": CAREER, "salary": SALARY, "tech": TECH, "place": PLACE}
    id_ = strip_u(_or_empty(F.col(key)))
    given = {names[k]: v for k, v in content.items()} | {URL: F.concat(F.lit(ADDRESS[site]), id_), SITE: F.lit(site)}
    return df.where(id_ != "").select(*[given.get(c, F.lit("")).alias(c) for c in COLUMNS])


def _techs(*arrays: Column) -> Column:
    return F.array_join(F.array_distinct(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])), ", ")


def wanted_row(df: DataFrame, matcher: Matcher) -> DataFrame:
    """P1.  Columns: id, company{name}, detail{position, requirements, preferred_points, main_tasks, ..}, due_time,
    annual_from, annual_to, address{location, district, full_location}, skill_tags [{tag_type_id, text}]."""
    found = matcher.udf()(F.array_join(F.filter(F.array(*[_or_empty(F.col(f"detail.{f}")) for f in ("requirements", "preferred_points", "main_tasks")]), lambda x: x != ""), "\n"))
    tags = matcher.tags(F.coalesce(F.transform("skill_tags", lambda t: t["text"]), F.array().cast("array<string>")))
    return _row(
        df, "wanted", "id", company=_or_empty(F.col("company.name")), title=strip_u(_or_empty(F.col("detail.position"))), deadline=wanted_deadline(F.col("due_time")),
        req=strip_u(_or_empty(F.col("detail.requirements"))), pref=strip_u(_or_empty(F.col("detail.preferred_points"))), career=career_range(F.col("annual_from"), F.col("annual_to")),
        tech=F.array_join(distinct_ci(F.concat(tags, found)), ", "), place=workplace(F.col("address.location"), F.col("address.district"), F.col("address.full_location")),
    )


def saramin_tags(page: Column, codes: dict[str, str]) -> Column:
    """Names of the technology codes among a page's tags."""
    found = F.regexp_extract_all(_or_empty(page), F.lit(TAG), F.lit(1))
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]) if codes else F.create_map().cast("map<string,string>")  # one site's code table
    return F.array_compact(F.transform(found, lambda c: F.try_element_at(table, c)))


def saramin_row(df: DataFrame, matcher: Matcher, codes: dict[str, str] | None = None) -> DataFrame:
    """P2.  Columns: rec_idx, company, title, deadline, career, place (of the listing), page, image_urls (unread images)."""
    seen = markup.visible(markup.CONTAINER)(F.col("page"))
    s = df.withColumn("seen", seen).withColumn("parts", split_body(F.col("seen.lines")))
    tags = matcher.tags(saramin_tags(F.col("page"), codes or {}))
    return _row(
        s, "saramin", "rec_idx", company=_or_empty(F.col("company")), title=_or_empty(F.col("title")), deadline=saramin_deadline(F.col("page"), F.col("deadline")),
        req=F.col("parts.req"), pref=F.col("parts.pref"), career=saramin_career(F.col("career")), salary=saramin_salary(F.col("page")),
        tech=_techs(F.array_distinct(F.concat(tags, matcher.udf()(F.col("seen.text")))), F.col("image_urls")), place=saramin_workplace(F.col("page"), F.col("place")),
    )


def jobkorea_row(df: DataFrame, matcher: Matcher) -> DataFrame:
    """P3.  Columns: gno, company, title, deadline, cells (of the listing), detail, body (pages), image_urls."""
    s = df.withColumn("seen", markup.visible(code_first=True)(F.col("body"))).withColumn("parts", split_body(F.col("seen.lines"), EXTRA_JOBKOREA)).withColumn("ld", json_ld(F.col("detail")))
    get = lambda path, kind="string": F.try_variant_get("ld", path, kind)
    cell = lambda k: _or_empty(F.get("cells", F.lit(k)))
    pay = salary_range(get("$.baseSalary.value.unitText"), *[get(f"$.baseSalary.value.{k}", "double") for k in ("value", "minValue", "maxValue")])
    listed = F.coalesce(F.get(F.filter(F.transform(F.coalesce("cells", F.array().cast("array<string>")), text_salary), lambda x: x != ""), F.lit(0)), F.lit(""))
    return _row(
        s, "jobkorea", "gno", company=first_of(strip_u(_or_empty(get("$.hiringOrganization.name"))), _or_empty(F.col("company"))), title=first_of(squeeze(_or_empty(get("$.title"))), _or_empty(F.col("title"))),
        deadline=jobkorea_deadline(get("$.validThrough"), F.col("deadline")), req=F.col("parts.req"), pref=F.col("parts.pref"), career=first_of(_or_empty(get("$.experienceRequirements")), cell(0)),
        salary=first_of(pay, listed), tech=_techs(matcher.udf()(F.col("seen.text")), F.col("image_urls")), place=first_of(squeeze(_or_empty(get("$.jobLocation.address.streetAddress"))), cell(2)),
    )


def jobplanet_row(df: DataFrame, matcher: Matcher) -> DataFrame:
    """P4.  Columns: posting{id, title, end_at, company{name}, recruitment_text [], annual{text}, working_area [], cities []}
    and detail{name, title, end_at, required_qualification, preferred_skill, primary_responsibility, recruitment_text [],
    annual{text}, salary, location, working_area [], cities [], skills []}."""
    both = lambda f: [f("detail"), f("posting")]
    at = lambda s, c: F.col(f"{s}.{c}")
    end = _text(F.coalesce(at("detail", "end_at"), at("posting", "end_at")))
    tags = matcher.resolved(F.filter(F.transform(F.coalesce(at("detail", "skills"), F.array().cast("array<string>")), strip_u), lambda x: x != ""))
    places = [joined_names(at(s, c)) for s in ("detail", "posting") for c in ("working_area", "cities")]
    return _row(
        df, "jobplanet", "posting.id", company=first_of(_text(at("detail", "name")), _text(F.col("posting.company.name"))), title=first_of(*both(lambda s: _text(at(s, "title")))),
        deadline=F.coalesce(dated(end), end), req=trim_field(_text(at("detail", "required_qualification"))), pref=trim_field(_text(at("detail", "preferred_skill"))),
        career=first_of(*both(lambda s: joined_names(at(s, "recruitment_text"))), *both(lambda s: _text(F.col(f"{s}.annual.text")))), salary=text_salary(at("detail", "salary")),
        tech=_techs(tags, matcher.udf()(prose("detail", PROSE_JOBPLANET))), place=first_of(_text(at("detail", "location")), *places),
    )


def jumpit_row(df: DataFrame, matcher: Matcher) -> DataFrame:
    """P5.  Columns: position{id, companyName, title, alwaysOpen, closedAt, newcomer, minCareer, maxCareer, techStacks [],
    locations []} and detail{the same, techStacks [{stack}], qualifications, preferredRequirements, responsibility,
    location, workingPlaces [{address}]}."""
    at = lambda s, c: F.col(f"{s}.{c}")
    both = lambda c: [at("detail", c), at("position", c)]
    always = F.coalesce(at("detail", "alwaysOpen"), F.lit(False)) | F.coalesce(at("position", "alwaysOpen"), F.lit(False))
    none = F.array().cast("array<string>")
    raw = F.concat(F.coalesce(F.transform(at("detail", "techStacks"), lambda x: x["stack"]), none), F.coalesce(at("position", "techStacks"), none))
    tags = matcher.resolved(F.array_distinct(F.filter(F.transform(F.array_compact(raw), strip_u), lambda x: x != "")))
    places = joined_names(F.transform(at("detail", "workingPlaces"), lambda x: x["address"]))
    return _row(
        df, "jumpit", "position.id", company=first_of(*[_text(c) for c in both("companyName")]), title=first_of(*[_text(c) for c in both("title")]),
        deadline=F.when(always, ALWAYS).otherwise(F.coalesce(*[dated(_text(c)) for c in both("closedAt")], F.lit(ALWAYS))),
        req=trim_field(_text(at("detail", "qualifications"))), pref=trim_field(_text(at("detail", "preferredRequirements"))),
        career=jumpit_career(both("newcomer"), list(zip(both("minCareer"), both("maxCareer"), strict=True))), tech=_techs(tags, matcher.udf()(prose("detail", PROSE_JUMPIT))),
        place=first_of(_text(at("detail", "location")), places, *[joined_names(c) for c in both("locations")]),
    )


def listing_blocks(page: Column, marker: str) -> Column:
    """A listing page cut into blocks, each from one marker to the next."""
    return F.filter(F.split(page, f"(?={marker})"), lambda x: x.rlike(f"^(?:{marker})"))


def _untagged(c: Column) -> Column:
    return unescape(F.regexp_replace(c, "<[^>]+>", " "))


def _field(block: Column, pattern: str, group: int) -> Column:
    return squeeze(_untagged(F.regexp_extract(block, f"(?s){pattern}", group)))


def behind_ads(page: Column) -> Column:
    """A listing page from the words that end its advertisements on; all of a page without them."""
    p = _or_empty(page)
    return F.substr(p, F.greatest(F.instr(p, ADS_END), F.lit(1)))


def saramin_total(page: Column) -> Column:
    """The total a page reports at the head of its listing; null if it has none."""
    head = squeeze(F.regexp_replace(F.substring(behind_ads(page), 1, HEAD), "<[^>]+>", " "))
    return F.when(head.rlike(TOTAL), F.translate(F.regexp_extract(head, TOTAL, 1), ",", "").try_cast("long"))


def jobkorea_total(answer: Column) -> Column:
    """The total, if the answer is a number and nothing else."""
    plain = F.regexp_replace(_or_empty(answer), "<[^>]+>", "")
    return F.when(plain.rlike(r"(?U)^\s*[\d,]+\s*$"), F.regexp_replace(plain, r"[^\d]", "").try_cast("long"))


def saramin_listing(pages: DataFrame) -> DataFrame:
    """The blocks behind the advertisements of pages (page, html), the first of each id.  A field that a block lacks is empty."""
    blocks = pages.select("page", F.posexplode(listing_blocks(behind_ads(F.col("html")), SARAMIN_ITEM)).alias("pos", "block"))
    fields = [_field(F.col("block"), *at).alias(name) for name, at in SARAMIN_FIELDS.items()]
    return _first_listed(blocks.select("page", "pos", F.struct(F.regexp_extract("block", SARAMIN_ITEM, 1).alias("rec_idx"), *fields).alias("item")), "rec_idx").select("item.*")


def jobkorea_listing(pages: DataFrame) -> DataFrame:
    """As S7, of fragments (page, html).  cells: the conditions, five or six of them, in order."""
    blocks = pages.select("page", F.posexplode(listing_blocks(_or_empty(F.col("html")), JOBKOREA_ITEM)).alias("pos", "block"))
    found = F.regexp_extract_all(F.regexp_extract("block", f"(?s){JOBKOREA_CELLS}", 1), F.lit(f"(?s){JOBKOREA_CELL}"), F.lit(1))
    plain = F.transform(F.split(_untagged(F.array_join(found, "\x01")), "\x01"), squeeze)
    cells = F.when(F.size(found) == 0, F.array().cast("array<string>")).otherwise(plain)
    fields = [_field(F.col("block"), *at).alias(name) for name, at in JOBKOREA_FIELDS.items()]
    return _first_listed(blocks.select("page", "pos", F.struct(F.regexp_extract("block", JOBKOREA_ITEM, 1).alias("gno"), *fields, cells.alias("cells")).alias("item")), "gno").select("item.*")


def summary_field(page: Column, label: str) -> Column:
    """The value of a labelled entry of a definition list."""
    return squeeze(F.regexp_replace(F.regexp_extract(_or_empty(page), rf"(?s)<dt>\s*{label}\s*</dt>\s*<dd>(.*?)</dd>", 1), r"<[^>]+>", " "))


def json_ld(page: Column) -> Column:
    """The first linked-data script, if it is a JobPosting, as a variant."""
    v = F.try_parse_json(unescape(F.regexp_extract(_or_empty(page), r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)))
    return F.when(F.try_variant_get(v, "$.@type", "string") == "JobPosting", v)


def own_postings(listing: DataFrame) -> DataFrame:
    """S13."""
    return listing.where(F.col("posting_apply_type").isin("jobplanet", "outlink"))


def _first_listed(each: DataFrame, key: str) -> DataFrame:
    return each.groupBy(F.col(f"item.{key}").alias(key)).agg(F.min_by("item", F.struct("page", "pos")).alias("item"), F.min(F.struct("page", "pos")).alias("place"))


def listed(pages: DataFrame, items_: str, key: str) -> DataFrame:
    """The items of JSON listing pages (page, and an array of structs), the first of each id that is not null, with
    its place.  An aggregate keeps one item an id before the shuffle."""
    each = pages.select("page", F.posexplode(items_).alias("pos", "item")).where(F.col(f"item.{key}").isNotNull())
    return _first_listed(each, key)


def reconcile(listing: DataFrame, reported: DataFrame) -> DataFrame:
    """Per site the reported total against rows received and distinct ids."""
    got = listing.groupBy("site").agg(F.count(F.lit(1)).alias("received"), F.countDistinct("id").alias("unique_ids"))
    return reported.join(got, "site", "left").select("site", "total", F.coalesce("received", F.lit(0)).alias("received"), F.coalesce("unique_ids", F.lit(0)).alias("unique_ids")).withColumn("matches", F.col("total") == F.col("unique_ids"))


def within_budget(reported: DataFrame, page: int, budget: int) -> DataFrame:
    """Sources whose pages fit the request budget; others are skipped whole."""
    return reported.where(F.ceil(F.col("total") / page) <= budget)


def drop_empty(rows: DataFrame) -> DataFrame:
    """Rows need a URL and technologies."""
    return rows.where((F.col(URL) != "") & (F.size(items(F.col(TECH))) > 0))


def collection_stats(rows: DataFrame) -> DataFrame:
    """Per site the rows collected, and how many lack requirements, hold images to read, or have no technology."""
    n = lambda c: F.sum(c.cast("long"))
    has = F.col(TECH).contains("http")
    return rows.groupBy(F.col(SITE).alias("site")).agg(F.count(F.lit(1)).alias("rows"), n(strip_u(F.col(REQ)) == "").alias("no_requirements"), n(has).alias("with_images"), n(F.size(items(F.col(TECH))) == 0).alias("no_technology"))


def with_order(df: DataFrame, first: int = 0) -> DataFrame:
    return df.withColumn(ORD, F.monotonically_increasing_id() + first)
