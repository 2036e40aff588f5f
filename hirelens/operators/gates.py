"""Stage-level gates (Q1-Q7).  A gate marks every row: whether it goes, with what verdict, and on what grounds.

Judgements are never made here: they come as tables (url, rules_version, answer columns), in which the last answer of a
URL holds (the greatest judged_on, if there is such a column, then the greatest answer).  A missing judgement keeps a row,
but for ratings (not found drops) and images (not read drops).

Every gate takes `alive`: rows for which it is false pass unmarked and have no influence on others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import BANNED, Rule, any_hit, contexts, core_words, hits, words
from ..functions.text import add_missing, add_values, cleaned, company_key, distinct_ci, is_blank, items, joined, keep_values, split_names, strip_u, trim_field
from ..functions.wording import closed_to_newbie, contradiction_line, looks_mixed, needs_sections, title_unclear, wording_found, wording_hits
from ..schema import CAREER, COLUMNS, COMPANY, ORD, PREF, RATING, REQ, SITE, TECH, TITLE, URL
from .dedup import marked
from .skills import Matcher

COMMON = [COMPANY, TITLE, SITE, URL]
# Verdicts, reasons, and the least rating that stays.
CUT_DUPLICATE, CUT_CAREER, CUT_WORD = "제외 · 중복", "제외 · 경력직", "제외 · 낱말"
CUT_AVOID, KEPT_FAIR, KEPT_UNJUDGED = "제외 · 피할 자리", "남김 · 결격 아님", "남김 · 판정 실패"
FIRM, ONSITE, MILITARY, HEADHUNTED, INHERITED = "SI/SM 업체", "상주·파견", "병역특례 전용", "헤드헌팅", " (같은 회사의 다른 공고에서 판정)"
NOT_FOUND, UNRATED, CUT_RATING, KEPT_RATING = "제외 · 잡플래닛에서 못 찾음", "제외 · 평점 없음", "제외 · 평점 ", "남김 · 평점 "
CUT_CORE, CUT_CONTRADICTION = "제외 · 핵심 기술 없음", "제외 · 사실상 경력 요구"
CUT_ROLE, KEPT_NO_BODY, KEPT_UNSURE, KEPT_ROLE = "제외 · 내 직군 없음", "남김 · 본문 없음", "남김 · 부문 내용 없음", "남김 · 부문 골라 덮어씀"
SECTIONS_FAILED, SECTIONS_NONE, SECTIONS_READ = "남김 · 절 복구 실패", "남김 · 절 복구 · 못 찾음", "남김 · 절 복구"
CAREER_WORD, SURVIVOR = "경력직", "남긴 행: "
LEAST_RATING = 2.9


@dataclass
class Gate:
    """rows: all input rows, with `cut`, `verdict` (null: nothing to report) and the detail columns."""

    rows: DataFrame
    detail: tuple[str, ...]

    @property
    def kept(self) -> DataFrame:
        return self.rows.where(~F.col("cut")).select(*COLUMNS, ORD)

    @property
    def report(self) -> DataFrame:
        return self.rows.where(F.col("verdict").isNotNull()).select(*COMMON, "verdict", *self.detail, ORD)


def _gate(df: DataFrame, given: list[str], cut: Column, verdict: Column, **detail: Column) -> Gate:
    """df with the marks; of its other columns only the given ones stay."""
    marks = {"cut": F.coalesce(cut, F.lit(False)), "verdict": verdict, **detail}
    return Gate(df.select(*given, *[c.alias(n) for n, c in marks.items()]), tuple(detail))


def _alive(alive: Column | None) -> Column:
    return alive if alive is not None else F.lit(True)


def latest(table: DataFrame, key: str) -> DataFrame:
    """One row for each key: the last answer (greatest judged_on, if there is such a column, then the greatest row)."""
    rest = [c for c in table.columns if c != key]
    order = sorted(rest, key=lambda c: (c != "judged_on", rest.index(c)))
    return table.groupBy(key).agg(F.max(F.struct(*order)).alias("row")).select(key, *[F.col(f"row.{c}").alias(c) for c in rest])


# Gates


def screen(postings: DataFrame, excluded: list[str], title: Column | None = None, alive: Column | None = None) -> Gate:
    """Q1: merge across sites, then drop excluded technologies and career-only postings."""
    live, rules = _alive(alive), words(excluded)
    m = marked(postings, title, alive=alive)
    copy = F.col("survivor_url").isNotNull()
    m = m.withColumns({"names": hits(F.col(TECH), rules), "closed": closed_to_newbie(F.col(CAREER))})
    closed = F.col("closed").isNotNull()
    out = (F.size("names") > 0) | closed
    none = F.array().cast("array<string>")
    found = F.concat(F.col("names"), F.when(closed, F.array(F.lit(CAREER_WORD))).otherwise(none))
    where = F.concat(F.transform("names", lambda n: F.concat(n, F.lit(f" «{TECH}»"))), F.when(closed, F.array(F.concat(F.lit(f"{CAREER_WORD} «"), F.col("closed"), F.lit("»")))).otherwise(none))
    verdict = F.when(~live, F.lit(None)).when(copy, CUT_DUPLICATE).when(closed, CUT_CAREER).when(out, CUT_WORD)
    basis = F.when(copy, F.concat(F.lit(SURVIVOR), F.col("survivor_url"))).otherwise(F.array_join(where, " / "))
    return _gate(m, postings.columns, live & (copy | out), verdict, words=F.when(copy, "").otherwise(F.array_join(found, ", ")), basis=basis)


def banned_hits(postings: DataFrame, rules: list[Rule] = BANNED, width: int = 24) -> DataFrame:
    """URL, and name and context of each rule that a posting's title, requirements or preferences hit."""
    return postings.select(URL, F.inline(contexts(joined(TITLE, REQ, PREF), rules, width)))


def core_tech(postings: DataFrame, names: list[str], alive: Column | None = None) -> Gate:
    """Q4: keeps rows that name a core technology; without names it refuses to run."""
    if not names:
        raise ValueError("no core technologies are set; the gate would drop or pass everything")
    rules = core_words(names)
    # One column after the other: most rows are decided by the short one.
    found = any_hit(F.col(TECH), rules) | any_hit(F.col(REQ), rules) | any_hit(F.col(PREF), rules)
    m = postings.withColumn("found", found)
    out = _alive(alive) & ~F.col("found")
    return _gate(m, postings.columns, out, F.when(out, CUT_CORE), tech=F.col(TECH))


def core_hits(postings: DataFrame, names: list[str]) -> DataFrame:
    """F8: URL, and name and context of each core technology a posting names."""
    return postings.select(URL, F.inline(contexts(joined(TECH, REQ, PREF), core_words(names))))


def with_verdicts(postings: DataFrame, verdicts: DataFrame, version: int, name: str = "v") -> DataFrame:
    """The last verdict of the URL under these rules as a struct, null if there is none."""
    v = latest(verdicts.where(F.col("rules_version") == version).drop("rules_version"), "url")
    v = v.select(F.col("url").alias("v_url"), F.struct(*[c for c in v.columns if c != "url"]).alias(name))
    return postings.join(v, postings[URL] == F.col("v_url"), "left").drop("v_url")


def pending(postings: DataFrame, verdicts: DataFrame, version: int, candidate: Column) -> DataFrame:
    """Candidates without a verdict, for judgement outside."""
    return postings.where(candidate).join(verdicts.where(F.col("rules_version") == version).select(F.col("url").alias(URL)), URL, "left_anti")


def with_bodies(postings: DataFrame, bodies: DataFrame | None) -> DataFrame:
    """The body of the URL, empty if there is none."""
    if bodies is None:
        return postings.withColumn("body", F.lit(""))
    b = latest(bodies.select(F.col("url").alias("b_url"), F.col("body").alias("b_body")), "b_url")
    return postings.join(b, postings[URL] == F.col("b_url"), "left").drop("b_url").withColumn("body", F.coalesce("b_body", F.lit(""))).drop("b_body")


def career(postings: DataFrame, verdicts: DataFrame, version: int = 2, alive: Column | None = None) -> Gate:
    """Q5: drops candidates judged contradictory.  verdicts: url, rules_version, contradiction, basis."""
    m = with_verdicts(postings, verdicts, version).withColumn("line", contradiction_line(F.col(CAREER), F.col(REQ)))
    out = _alive(alive) & F.col("line").isNotNull() & F.coalesce(F.col("v.contradiction"), F.lit(False))
    return _gate(m, postings.columns, out, F.when(out, CUT_CONTRADICTION), career=F.col(CAREER), line=F.col("line"), basis=F.coalesce(F.col("v.basis"), F.lit("")))


def nuance(postings: DataFrame, verdicts: DataFrame, bodies: DataFrame | None = None, version: int = 4, alive: Column | None = None) -> Gate:
    """Q2: postings with an unwanted word, in their columns or body, are judged; marks of the firm and of head hunting spread
    to the other judged candidates of the company (a blank company key is a company too).

    verdicts: url, rules_version, firm, onsite, military, headhunt, basis.
    """
    m = with_bodies(with_verdicts(postings, verdicts, version), bodies).withColumn("columns_text", joined(TITLE, REQ, PREF))
    m = m.withColumns({"candidate": _alive(alive) & wording_found(F.col("columns_text"), F.col("body")), "key": company_key(F.col(COMPANY))})
    # The answer comes first: texts of rows without one need not be searched for it.
    judged = F.col("v").isNotNull() & F.col("candidate")
    flag = lambda c: F.coalesce(F.col("v").isNotNull() & F.col(f"v.{c}") & F.col("candidate"), F.lit(False))
    # Companies with a mark are few rows after this; a hot company needs no window over all its postings.
    marks = m.where(flag("firm") | flag("headhunt")).groupBy("key").agg(F.max(flag("firm")).alias("c_firm"), F.max(flag("headhunt")).alias("c_head"))
    m = m.join(marks, "key", "left")
    spread = lambda c: judged & F.coalesce(F.col(c), F.lit(False))
    firm, head = spread("c_firm"), spread("c_head")
    inherited = (firm & ~flag("firm")) | (head & ~flag("headhunt"))
    reasons = F.array_compact(F.array(F.when(firm, FIRM), F.when(flag("onsite"), ONSITE), F.when(flag("military"), MILITARY), F.when(head, HEADHUNTED)))
    m = m.withColumns({"reasons": reasons, "inherited": inherited, "hits": F.when(F.col("candidate"), wording_hits(F.col("columns_text"), F.col("body")))})
    out = F.size("reasons") > 0
    verdict = F.when(~F.col("candidate"), F.lit(None)).when(~judged, KEPT_UNJUDGED).when(out, CUT_AVOID).otherwise(KEPT_FAIR)
    near = F.substring(F.array_join(F.transform("hits", lambda h: F.concat(h["name"], F.lit(" «"), h["near"], F.lit("»"))), " / "), 1, 300)
    reason = F.concat(F.array_join("reasons", " · "), F.when(out & F.col("inherited"), INHERITED).otherwise(""))
    return _gate(
        m, postings.columns, out, verdict, reason=reason,
        words=F.array_join(F.array_sort(F.array_distinct(F.col("hits.name"))), ", "), place=F.array_join(F.array_sort(F.array_distinct(F.col("hits.place"))), " / "),
        basis=F.coalesce(F.nullif(F.col("v.basis"), F.lit("")), near),
    )


def rating_verdict(rating: Column, least: float = LEAST_RATING) -> Column:
    """a rating that is null is one not found."""
    shown = F.format_string("%.1f", rating)
    return F.when(rating.isNull(), NOT_FOUND).when(rating == 0, UNRATED).when(rating < least, F.concat(F.lit(CUT_RATING), shown)).otherwise(F.concat(F.lit(KEPT_RATING), shown))


def rating(postings: DataFrame, ratings: DataFrame, least: float = LEAST_RATING, alive: Column | None = None) -> Gate:
    """Q3: company ratings (company_key, rating) are joined; companies not found, unrated or rated low go."""
    r = latest(ratings, "company_key").select(F.col("company_key").alias("key"), F.col("rating").cast("double").alias("r"))
    m = postings.withColumn("key", company_key(F.col(COMPANY))).join(r, "key", "left").withColumn("says", rating_verdict(F.col("r"), least))
    live, out = _alive(alive), ~F.col("says").startswith(KEPT_RATING)
    m = m.withColumn(RATING, F.when(live & ~out, F.format_string("%.1f", "r")).otherwise(F.col(RATING)))
    return _gate(m, postings.columns, live & out, F.when(live, F.col("says")), rating=F.col("r"))


def pick_candidate(candidates: DataFrame) -> DataFrame:
    """Per company_key the best rated, then the largest, then the first candidate."""
    w = Window.partitionBy("company_key").orderBy(F.coalesce("rating", F.lit(0.0)).desc(), F.coalesce("headcount", F.lit(0)).desc(), F.col(ORD))
    return candidates.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def ladder(variants: DataFrame, index: DataFrame) -> DataFrame:
    """Per company_key the first variant (pos) that the index knows.  variants: company_key, pos, variant."""
    return variants.join(index.select(F.col("name").alias("variant")).distinct(), "variant", "left_semi").groupBy("company_key").agg(F.min("pos").alias("pos"), F.min_by("variant", "pos").alias("variant"))


def overwritten(answer: str, matcher: Matcher | None) -> dict[str, Column]:
    """What a judgement (tech, req, pref, career) makes of the four columns: blanks change nothing, of the technologies
    those known stay, and values under their heading are put back."""
    text = lambda c: strip_u(F.coalesce(F.col(f"{answer}.{c}").cast("string"), F.lit("")))
    names = split_names(text("tech"))
    tech = F.array_join(matcher.keep_known(names) if matcher else distinct_ci(names), ", ")
    given = {TECH: tech, REQ: text("req"), PREF: text("pref"), CAREER: text("career")}
    out = {c: F.when(v != "", trim_field(v)).otherwise(F.col(c)) for c, v in given.items()}
    out[REQ] = keep_values(F.col(REQ), out[REQ])
    return out


def role(postings: DataFrame, verdicts: DataFrame, bodies: DataFrame, fills: DataFrame | None = None, version: int = 4, matcher: Matcher | None = None, alive: Column | None = None) -> Gate:
    """Q6: postings that may hold several roles or another one, and have a body, are judged: not the role drops, surely known
    content overwrites.  Others whose sections could not be read take what was read for them anew (fills).

    verdicts: url, rules_version, fits, sure, tech, req, pref, career; fills the same without fits and sure.
    """
    live = _alive(alive)
    m = with_bodies(with_verdicts(postings, verdicts, version), bodies)
    if fills is not None:
        m = with_verdicts(m, fills.select("url", "rules_version", "tech", "req", "pref", "career"), version, "f")
    else:
        m = m.withColumn("f", F.lit(None).cast("struct<tech:string,req:string,pref:string,career:string>"))
    signals = F.concat(looks_mixed(F.col(TITLE), F.col("body")), F.array_compact(F.array(title_unclear(F.col(TITLE)))))
    m = m.withColumns({"signals": signals, "why": needs_sections(F.col(REQ), F.col("body"))})
    asked, judged = F.size("signals") > 0, F.col("v").isNotNull()
    fits, sure = F.coalesce(F.col("v.fits"), F.lit(False)), F.coalesce(F.col("v.sure"), F.lit(True))
    states = [(~live, None), (asked & (F.col("body") == ""), KEPT_NO_BODY), (asked & ~judged, KEPT_UNJUDGED), (asked & ~fits, CUT_ROLE), (asked & ~sure, KEPT_UNSURE), (asked, KEPT_ROLE)]
    reread = [(F.col("why").isNull(), None), (F.col("f").isNull(), SECTIONS_FAILED), (is_blank(F.col("f.req")), SECTIONS_NONE)]
    verdict = F.lit(SECTIONS_READ)
    for test, says in reversed(states + reread):
        verdict = F.when(test, F.lit(says)).otherwise(verdict)
    m = m.withColumn("says", verdict)
    picked, reread_ = overwritten("v", matcher), overwritten("f", matcher)
    new = {c: F.when(F.col("says") == KEPT_ROLE, picked[c]).when(F.col("says") == SECTIONS_READ, reread_[c]).otherwise(F.col(c)) for c in picked}
    return _gate(m.withColumns(new), postings.columns, F.col("says") == CUT_ROLE, F.col("says"), signals=F.when(asked, F.array_join("signals", " / ")).otherwise(F.coalesce("why", F.lit(""))))


def image_parts(c: Column) -> Column:
    """F18."""
    return F.filter(items(c), lambda x: x.startswith("http"))


READ = ("tech", "req", "pref", "values")


def image_fill(postings: DataFrame, reads: DataFrame, matcher: Matcher | None = None, alive: Column | None = None) -> Gate:
    """Q7: rows whose technologies hold image addresses take what was read from the images.

    reads: key (the addresses joined by blanks), tech, req, pref, values (arrays; an absent column was not read).  A row goes
    only if technologies, requirements and preferences are all empty; unread rows are left for another run.  Of the read
    names those the matcher knows are taken, and all of them without a matcher.
    """
    none = F.array().cast("array<string>")
    live = _alive(alive)
    m = postings.withColumn("key", F.when(live, F.array_join(image_parts(F.col(TECH)), " ")).otherwise(""))
    read = {c: cleaned(F.flatten(F.transform(F.array_compact(F.col(c)), split_names)) if c == "tech" else F.col(c)) if c in reads.columns else none for c in READ}
    r = latest(reads, "key")
    m = m.join(r.select("key", F.struct(*[v.alias(c) for c, v in read.items()]).alias("read")), "key", "left")
    has = F.col("key") != ""
    empty = (F.size("read.tech") == 0) & (F.size("read.req") == 0) & (F.size("read.pref") == 0)
    out = has & (F.col("read").isNull() | empty)
    own = F.filter(cleaned(F.split(F.col(TECH), ",")), lambda x: ~x.startswith("http"))
    names = matcher.keep_known(F.col("read.tech")) if matcher else distinct_ci(F.col("read.tech"))
    new = F.filter(names, lambda x: ~F.exists(own, lambda y: F.lower(y) == F.lower(x)))
    filled = {
        TECH: F.when(has, F.array_join(F.concat(own, new), ", ")).otherwise(F.col(TECH)),
        REQ: F.when(has, add_values(add_missing(F.col(REQ), F.col("read.req")), F.col("read.values"))).otherwise(F.col(REQ)),
        PREF: F.when(has, add_missing(F.col(PREF), F.col("read.pref"))).otherwise(F.col(PREF)),
    }
    given = {c: F.when(out, F.col(c)).otherwise(v) for c, v in filled.items()}
    verdict = F.when(out, F.when(F.col("read").isNull(), "이미지 못 읽음").otherwise("이미지에 없음"))
    return _gate(m.withColumns(given), postings.columns, out, verdict, images=F.col("key"))
