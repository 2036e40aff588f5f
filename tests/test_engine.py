"""Operators of the posting engine on authored rows, and every catalogue query against its SQL."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

from hirelens.functions import markup, rules, text, wording
from hirelens.operators import analytics, dedup, gates, images, lookups, merge, sections, sites, skills
from hirelens.plans import pipeline, queries, view
from hirelens.schema import COLUMNS, COMPANY, FIRST, LAST, ORD, POSTING_SCHEMA, PREF, REQ, SITE, TECH, TITLE, URL, as_postings
from hirelens.sources import conditions, files
from hirelens.streaming import history

SF = "/root/testdata/sf0.001"


def rows(spark, *given):
    keys = {v: k for k, v in view.NAMES.items()}
    made = []
    for n, g in enumerate(given):
        r = dict.fromkeys(COLUMNS, "") | {ORD: n, URL: f"u{n}"} | {keys[k]: v for k, v in g.items()}
        made.append(tuple(r[c] for c in [*COLUMNS, ORD]))
    return spark.createDataFrame(made, POSTING_SCHEMA)


def one(spark, column, value, schema="string"):
    return spark.createDataFrame([(value,)], f"x {schema}").select(column(F.col("x"))).first()[0]


def plain(v):
    if isinstance(v, float):
        return "null" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return repr([plain(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "pages", "events", "lineitem", "orders", "part", "customer", "supplier", "nation", "region"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(columns).collect())
    if name in queries.ORACLES:
        want = sorted(tuple(map(plain, r)) for r in con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall())
        assert got == want
    else:
        assert got


@pytest.mark.parametrize(("name", "value", "hit"), [("Java", "JavaScript", False), ("Java", "Java8", False), ("Spring", "Spring기반", True), ("C++", "C++ 개발", True), ("java", "JAVA,", True)])
def test_word_borders(spark, name, value, hit):
    assert one(spark, lambda c: c.rlike(text.word_pattern(name)), value) is hit


@pytest.mark.parametrize(("value", "key"), [("(주) 가나", "가나"), ("가나 주식회사", "가나"), ("㈜GaNa", "gana"), ("유한책임회사 가", "가"), ("", "")])
def test_company_key(spark, value, key):
    assert one(spark, text.company_key, value) == key


def test_text_functions(spark):
    assert one(spark, text.title_key, "［백엔드］ Ａ-B") == "백엔드ab"
    assert one(spark, text.title_key, "가_나 【다】") == "가_나【다】"
    assert one(spark, text.title_key, "가\u2010\u2011\u2012\u2015\u301c\u30fb\uff65나") == "가나"
    assert one(spark, text.split_names, "A(b, c), D, A") == ["A", "b", "c", "D", "A"]
    assert one(spark, text.split_names, "AWS(ECS, Cognito), C#, x(y(z), w), q)r, s") == ["AWS", "ECS", "Cognito", "C#", "x(y(z), w)", "q)r", "s"]
    assert [one(spark, text.without_version, x) for x in ("Java 17+", "React 19 이상", "Delphi 이후", "S3", "Vue V3")] == ["Java", "React", "Delphi", "S3", "Vue V3"]
    assert one(spark, lambda c: rules.near(c, rules.Rule("b", "bb"), 2), "a bb c bb") == "a bb c"
    assert one(spark, text.log_lines, "a\r 50%|## \n\n b  ") == ["a", " b"]
    assert one(spark, text.trim_field, "x" * 5000) == "x" * 4000 + " …"
    assert one(spark, lambda c: text.distinct_ci(F.split(c, ",")), "Go,go,GO,C") == ["Go", "C"]
    assert one(spark, lambda c: text.first_json(c).cast("string"), 'note {"a":1} rest') == '{"a":1}'


def test_dedup_vetoes_merges_and_fills(spark):
    p = rows(
        spark,
        {"company": "가", "title": "t", "site": "wanted", "req": "", "pref": "p", "first_seen": "2026-02-02", "last_seen": "2026-02-02"},
        {"company": "(주)가", "title": "T", "site": "jumpit", "req": " r ", "tech": "Java", "first_seen": "2026-01-01", "last_seen": "2026-01-05"},
        {"company": "나", "title": "t", "site": "wanted"},
        {"company": "나", "title": "t", "site": "wanted"},
        {"company": "나", "title": "t", "site": "jumpit"},
        {"company": "", "title": "", "site": "wanted"},
        {"company": "", "title": "", "site": "jumpit"},
    )
    kept, dropped = dedup.dedup(p)
    out = {r[URL]: r for r in kept.collect()}
    assert set(out) == {"u1", "u2", "u3", "u4", "u5", "u6"} and out["u1"][ORD] == 0
    assert (out["u1"][REQ], out["u1"][PREF], out["u1"][FIRST], out["u1"][LAST]) == (" r ", "p", "2026-01-01", "2026-02-02")
    assert [(r[URL], r["survivor_url"]) for r in dropped.collect()] == [("u0", "u1")]


def test_results_do_not_depend_on_layout(spark):
    p = view.postings(spark, SF)
    a, b = (sorted(map(tuple, dedup.dedup(p.repartition(n))[0].collect())) for n in (1, 7))
    assert a == b


def test_upsert_retention_border(spark):
    old = rows(spark, {"url": "a", "last_seen": "2026-08-20"}, {"url": "b", "last_seen": "2026-08-21"}, {"url": "c", "last_seen": "soon"}, {"url": "", "last_seen": "2026-09-20"}, {"url": "d", "last_seen": "2026-9-1"}, {"url": "e", "first_seen": "2026-01-01", "last_seen": "2026-01-01"})
    new = rows(spark, {"url": "e", "title": "x"}, {"url": "e", "title": "y", "first_seen": "2020-01-01"}, {"url": "f", "first_seen": "2020-01-01"})
    out = {r[URL]: r for r in merge.merge(old, new, "2026-09-20").collect()}
    assert set(out) == {"b", "c", "d", "e", "f"}
    assert (out["e"][TITLE], out["e"][FIRST], out["f"][FIRST], out["f"][LAST]) == ("y", "2026-01-01", "2026-09-20", "2026-09-20")
    again = merge.merge(merge.merge(old, new, "2026-09-20"), new, "2026-09-20")
    assert {r[URL] for r in again.collect()} == set(out)
    assert tuple(merge.counters(merge.upsert(old, new, "2026-09-20")).first()) == (1, 2, 2, 1, 1)
    assert "a" in {r[URL] for r in merge.merge(old, new, "no date").collect()}


def test_queries_run_over_all_postings(spark):
    n = view.postings(spark, SF).count()
    for name in ("upsert_retention", "role_gate_apply", "rating_gate"):
        assert queries.QUERIES[name](spark, SF).count() == n if name != "upsert_retention" else True
    out = queries.QUERIES["upsert_counters"](spark, SF).first()
    assert out["added"] + out["unseen"] + out["expired"] <= n and out["updated"] > 0
    assert queries.QUERIES["pipeline_final"](spark, "/root/testdata/sf0.01").count() > 0


@pytest.mark.parametrize(
    ("career", "closed"),
    [("경력 3년", "경력 3년"), ("신입 / 경력 3년", None), ("경력 3년 / 신입", None), ("", None), (None, None), ("정규직, 5년 이상", "5년 이상"), ("무관", None), ("8~9년차 우대", None), ("명시 없음, 5년 이상", None), ("2024년 설립", None), ("인턴", None), ("가: 6년 이상 / 나: 3년 이상", "가: 6년 이상"), ("React/Spring 3년 이상", "React/Spring 3년 이상")],
)
def test_closed_career(spark, career, closed):
    assert one(spark, wording.closed_to_newbie, career) == closed


@pytest.mark.parametrize(("value", "yes"), [("신입 · 경력", True), ("경력 무관", True), ("신입~5년", True), ("경력 3년", False), (None, False), ("\t신입", False)])
def test_newcomers(spark, value, yes):
    assert one(spark, wording.accepts_newbie, value) is yes


@pytest.mark.parametrize(
    ("text_", "line"),
    [("학사\n  • 웹서비스 개발 경력 4년 이상 ", "• 웹서비스 개발 경력 4년 이상"), ("ㆍ제품개발 경력이 5~10년 정도", "ㆍ제품개발 경력이 5~10년 정도"), ("실무 6개월 이상", "실무 6개월 이상"), ("경력직", "경력직"), ("2024년 졸업", None), ("- 4년제 대학 졸업자 이상", None), ("신입 또는 경력 5년 이상", None), ("경력 1년 이상 우대", None), ("능숙한 분", None), (None, None)],
)
def test_lines_that_ask_for_years(spark, text_, line):
    assert one(spark, wording.demands_years, text_) == line


@pytest.mark.parametrize(("title", "why"), [("Java 백엔드 / 데이터 파이프라인", None), ("정보보안 DevOps", "제목이 다른 직군: 데브옵스 · 보안"), ("iOSX QA팀", "제목이 다른 직군: QA"), ("ETL개발", "제목에 내 직군 낱말이 없다"), ("모션 플래닝", "제목에 내 직군 낱말이 없다"), (None, "제목에 내 직군 낱말이 없다"), ("fullstack", None)])
def test_titles_of_other_roles(spark, title, why):
    assert one(spark, wording.title_unclear, title) == why


def test_several_roles(spark):
    assert one(spark, wording.title_hits, "각  부문 · 각 부문 공개채용") == ["각 부문", "공개채용"]
    assert one(spark, wording.body_hits, "모집부문 A") == [] and one(spark, wording.body_hits, None) == []
    assert one(spark, wording.body_hits, "모집부문 A 모집 분야 B 채용 부문 채용부문") == ["본문에 부문 낱말 2회", "본문에 채용 부문 채용부문"]
    r = spark.createDataFrame([("[인재상 (별도표기)]\n• 성실", " " + "글" * 500, "글" * 399)], "req string, body string, short string")
    assert r.select(wording.needs_sections(F.col("req"), F.col("body")), wording.needs_sections(F.col("req"), F.col("short"))).first()[:] == ("지원자격이 빔 · 본문 500자", None)


def test_screen_splits_its_input(spark):
    p = rows(spark, {"company": "a", "tech": "PHP"}, {"company": "b", "tech": "Java", "career": "경력 5년"}, {"company": "c", "tech": "PHPUnit"})
    g = gates.screen(p, ["PHP"])
    assert {r[URL] for r in g.kept.collect()} == {"u2"}
    assert {(r[URL], r["verdict"], r["words"], r["basis"]) for r in g.report.collect()} == {("u0", "제외 · 낱말", "PHP", "PHP «기술스택»"), ("u1", "제외 · 경력직", "경력직", "경력직 «경력 5년»")}
    assert gates.screen(p, []).kept.count() == 2


def test_core_gate_needs_names(spark):
    p = rows(spark, {"tech": "Spring"}, {"req": "spring boot 경험"}, {"tech": "Go"})
    assert {r[URL] for r in gates.core_tech(p, ["Spring Boot"]).kept.collect()} == {"u0", "u1"}
    with pytest.raises(ValueError):
        gates.core_tech(p, [])


def test_rating_verdicts(spark):
    p = rows(spark, *[{"company": c} for c in "abcd"])
    ratings = spark.createDataFrame([("a", 2.8), ("b", 2.9), ("b", 1.0), ("c", 0.0)], "company_key string, rating double")
    g = gates.rating(p, ratings)
    assert {r[URL]: r["verdict"] for r in g.report.collect()} == {"u0": "제외 · 평점 2.8", "u1": "남김 · 평점 2.9", "u2": "제외 · 평점 없음", "u3": "제외 · 잡플래닛에서 못 찾음"}
    assert [r["평점"] for r in g.kept.collect()] == ["2.9"]


def test_wording_spreads_to_judged_candidates_only(spark):
    p = rows(spark, *[{"company": c, "req": "SI 고객사" if k != 2 else "글"} for k, c in enumerate(("a", "a", "a", "", "", "b", "c"))], {"company": "a", "title": "x"})
    v = [("u0", 4, True, False, False, False, "x"), ("u1", 4, False, False, False, False, "y"), ("u2", 4, True, False, False, False, ""), ("u3", 4, True, False, True, False, ""), ("u4", 4, False, True, False, False, ""), ("u5", 3, True, True, True, True, "old"), ("u6", 4, False, False, False, False, ""), ("u0", 4, False, False, False, False, "a")]
    verdicts = spark.createDataFrame(v, "url string, rules_version int, firm boolean, onsite boolean, military boolean, headhunt boolean, basis string")
    bodies = spark.createDataFrame([("u7", "현역 파견"), ("u6", "서치 펌")], "url string, body string")
    g = gates.nuance(p, verdicts, bodies)
    assert {r[URL] for r in g.kept.collect()} == {"u2", "u5", "u6", "u7"} and g.rows.count() == 8  # a verdict given twice makes no second row
    said = {r[URL]: (r["verdict"], r["reason"], r["words"], r["place"]) for r in g.report.collect()}
    assert said["u1"] == ("제외 · 피할 자리", "SI/SM 업체 (같은 회사의 다른 공고에서 판정)", "SI, 고객사", "공고 칸")
    assert said["u3"][1] == "SI/SM 업체 · 병역특례 전용" and said["u4"][1] == "SI/SM 업체 · 상주·파견 (같은 회사의 다른 공고에서 판정)"
    assert said["u5"][0] == "남김 · 판정 실패" and said["u6"] == ("남김 · 결격 아님", "", "SI, 고객사, 헤드헌팅", "공고 칸 / 본문") and said["u7"][2:] == ("파견, 현역", "본문") and "u2" not in said


def test_role_gate(spark):
    p = rows(spark, {"title": "프론트 공개채용", "tech": "React"}, {"title": "데이터", "tech": "R", "req": "옛 요건\n[인재상 (별도표기)]\n• 성실 "}, {"title": "백엔드"}, {"title": "안드로이드"}, {"title": "서버 개발"}, {"title": "QA"}, {"title": "QA"})
    bodies = spark.createDataFrame([("u0", "글"), ("u1", "글"), ("u2", "글"), ("u4", "가" * 400), ("u5", "글"), ("u6", "글")], "url string, body string")
    v = [("u0", 4, False, True, "", "", "", ""), ("u1", 4, True, True, "Spark(Java), 없는 말", "새 요건", "", ""), ("u1", 4, False, False, "", "", "", ""), ("u3", 4, False, True, "", "", "", ""), ("u5", 4, True, False, "x", "x", "x", "x")]
    verdicts = spark.createDataFrame(v, "url string, rules_version int, fits boolean, sure boolean, tech string, req string, pref string, career string")
    fills = spark.createDataFrame([("u4", 4, "", "다시 읽음", "", "")], "url string, rules_version int, tech string, req string, pref string, career string")
    g = gates.role(p, verdicts, bodies, fills, matcher=skills.Matcher(["Spark", "Java"]))
    out = {r[URL]: (r[TECH], r[REQ]) for r in g.kept.collect()}
    assert set(out) == {"u1", "u2", "u3", "u4", "u5", "u6"} and out["u1"] == ("Spark, Java", "새 요건\n[인재상 (별도표기)]\n• 성실") and out["u4"][1] == "다시 읽음"
    said = {r[URL]: r["verdict"] for r in g.report.collect()}
    assert said == {"u0": "제외 · 내 직군 없음", "u1": "남김 · 부문 골라 덮어씀", "u3": "남김 · 본문 없음", "u4": "남김 · 절 복구", "u5": "남김 · 부문 내용 없음", "u6": "남김 · 판정 실패"}


def test_verdicts_given_twice_make_no_second_row(spark):
    p = rows(spark, {"career": "신입", "req": "경력 3년 이상"}, {"career": "신입", "req": "경력 3년 이상"})
    v = spark.createDataFrame([("u0", 2, False, "a", "2026-01-02"), ("u0", 2, True, "b", "2026-01-01"), ("u1", 2, True, "b", "2026-01-01")], "url string, rules_version int, contradiction boolean, basis string, judged_on string")
    g = gates.career(p, v)
    assert [r[URL] for r in g.kept.collect()] == ["u0"] and [tuple(r)[3:8] for r in g.report.collect()] == [("u1", "제외 · 사실상 경력 요구", "신입", "경력 3년 이상", "b")]


def test_image_fill(spark):
    p = rows(spark, {"tech": "Go, http://i/1, http://i/2"}, {"tech": "http://i/3"}, {"tech": "http://i/4"}, {"tech": "Java"})
    reads = spark.createDataFrame([("http://i/1 http://i/2", ["go", "Rust"]), ("http://i/3", [])], "key string, tech array<string>")
    g = gates.image_fill(p, reads)
    assert {r[URL]: r[TECH] for r in g.kept.collect()} == {"u0": "Go, Rust", "u3": "Java"} and g.report.count() == 2


def test_image_fill_takes_requirements_and_preferences(spark):
    p = rows(spark, {"tech": "C++, http://i/1", "req": " - oracle 경험\n학사 "}, {"tech": "http://i/2", "pref": "Docker 우대"}, {"tech": "http://i/3"}, {"tech": "http://i/4"})
    given = [("http://i/1", ["AWS(ECS, 없는 이름)", "c++", "aws"], ["o oracle  경험", "3년 이상", "3년이상", "•"], None), ("http://i/2", None, None, ["docker", "영어 · 일어"]), ("http://i/3", [], ["•"], [" "])]
    g = gates.image_fill(p, spark.createDataFrame(given, "key string, tech array<string>, req array<string>, pref array<string>"), skills.Matcher(["C", "C++", "AWS", "ECS"]))
    out = {r[URL]: (r[TECH], r[REQ], r[PREF]) for r in g.kept.collect()}
    assert out == {"u0": ("C++, AWS, ECS", "- oracle 경험\n학사\n• 3년 이상", ""), "u1": ("", "", "Docker 우대\n• 영어 · 일어")}
    assert {r[URL]: r["verdict"] for r in g.report.collect()} == {"u2": "이미지에 없음", "u3": "이미지 못 읽음"}


def test_matcher():
    m = skills.Matcher(["Java", "Spring Boot", "Spring", "C", "C++", "Docker"], {"k8s": "Kubernetes", "도커": "Docker"}, {"Docker"}, {"부하 테스트": "부하 테스트"})
    assert m.find("Spring Boot, java17과 C++, k8s, docker 부하 테스트를") == ["Spring Boot", "Java", "C++", "Kubernetes", "부하 테스트"]
    assert m.find("JavaScript") == [] and m.find("부하 테스트장") == [] and m.find("java17 C9") == ["Java"] and m.find("부하 테스트한다") == ["부하 테스트"]


def test_dictionary():
    d = skills.Dictionary({"Java": "language", "Amazon S3": "platform", "React": None, "C": None, "MySQL": None, "Tailwind CSS": None}, {"S3": "Amazon S3", "C언어": "C", "자바": "Java"}, frozenset({"S3"}), frozenset({"풀스택"}), {"자바": "Java"})
    assert [d.known(x) for x in ("C 언어", "React 19", "MY SQL", "TailwindCSS", "S3", "nope", "Java 17 이상")] == ["C", "React", "MySQL", "Tailwind CSS", "Amazon S3", "", "Java"]
    assert d.kind_of("자바") == "language" and d.kind_of("nope") is None and d.blocked("풀스택") and not d.blocked("S3")
    assert d.resolved("react/java") == ["React", "Java"] and d.resolved("java-x") == [] and d.resolved("풀스택") == [] and d.similar("Raect") == ["React"]
    m = skills.corpus_matcher(d)
    assert m.find("S3와 자바를 쓰고 자바선 React18") == ["React", "Java"]


def test_look_alikes(spark):
    m = skills.Matcher(["Spring Boot", "SpringBoot", "Java"])
    assert one(spark, lambda c: m.look_alikes(F.array(c)), "Spring-Boot") == ["SpringBoot", "Spring Boot"]  # as like; the later one in the alphabet first


def test_matcher_columns(spark):
    m = skills.Matcher(["Java", "Spring", "AWS"], rejected={"풀스택"})
    r = spark.createDataFrame([(["AWS/java", "java-x", "풀스택", None], ["JAVA 17", "nope", None], None)], "a array<string>, c array<string>, n array<string>")
    assert tuple(r.select(m.resolved(F.col("a")), m.keep_known(F.col("c")), m.unresolved(F.col("a")), m.unknown(F.col("c")), m.keep_known(F.col("n"))).first()) == (["AWS", "Java"], ["JAVA"], ["java-x"], ["nope"], [])  # a name without its version stays as it is written


@pytest.mark.parametrize(("body", "req", "pref"), [("자격요건\n- 파이썬\n우대사항: 도커\n쿠버\n복리후생\n밥", "- 파이썬", "도커\n쿠버"), ("자격요건 / 우대사항\n표\n자격요건: 3년\nX\n우대사항\nY", "3년\nX", "Y"), ("A\nB\n우대사항\nC", "A\nB", "C"), ("그냥 글", "그냥 글", ""), ("담당업무\nx\n복리후생\ny\n근무조건\nz", "", ""), (None, "", ""), ("no heading", "no heading", ""),
     ("이런 분을 찾습니다\n- a\n우대사항\n- b", "- a", "- b"), ("담당업무\n자격요건\n보안\n우대사항\nx\n전형절차\ny", "", "x"), ("자격요건\nㆍ학력 : 무관\nㆍ필수요건 : React\n우대사항\nz", "ㆍ학력 : 무관\nㆍ필수요건 : React", "z"),
     ("담당업무\nx\n담당 업무\ny\n담당업무\nz", "담당업무\nx\n담당 업무\ny\n담당업무\nz", "")])
def test_sections(spark, body, req, pref):
    assert tuple(one(spark, sections.split_body, body)) == (req, pref)


def test_markup(spark):
    page = '<div>a&amp;b<!-- x --><p style="display: none">hid<b>den</b></p><script>1</script><p>c</p><span style="font-size:0px">z</span><i style="opacity:0.5">d</i></div>'
    assert one(spark, markup.visible_text, page) == "a&b c d"
    assert one(spark, markup.visible_lines, "<p>a</p><p> b <br>c</p>") == "a\nb\nc"
    assert markup.split_visible('x<div style="display:none">y')[0] == "x"
    assert one(spark, markup.image_urls, '<img src="//h/a.png"><IMG alt="" src="data:x"><img src="//h/a.png"><img src="/p x.gif?q=가"><img src="http://h/track">') == ["https://h/a.png", "https://www.saramin.co.kr/p%20x.gif?q=%EA%B0%80"]
    assert one(spark, markup.image_urls_jobkorea, '<script><img src="a.png"></script><img src="//i.jobkorea.kr/content/images/a.png"><img src="/b">') == ["https://www.jobkorea.co.kr/b"]
    assert [markup.hidden_style(x) for x in ("DISPLAY : none !important", "opacity:0.0", "opacity:0", "width:0;height:0", "max-width:0;height:0", "font-size:0px")] == [True, False, True, True, False, True]
    assert one(spark, lambda c: markup.looks_like_image(c, 3), "ab") is True
    assert markup.balanced('<p><div id="c"><div>a</div>b</div>c', '<div id="c">') == '<div id="c"><div>a</div>b</div>'


@pytest.mark.parametrize(("low", "high", "text_"), [(None, None, "경력무관"), (0, 100, "신입"), (0, None, "신입"), (3, None, "3년 이상"), (3, 100, "3년 이상"), (0, 2, "신입~2년"), (0, 0, "신입"), (5, 3, "3~5년"), (2, 2, "2년"), (-1, 5, "신입~5년"), (-1, -1, "경력무관")])
def test_career_phrases(spark, low, high, text_):
    assert spark.createDataFrame([(low, high)], "a int, b int").select(sites.career_range(F.col("a"), F.col("b"))).first()[0] == text_


def test_field_rules(spark):
    assert [one(spark, sites.listed_deadline, x) for x in ("~ 9/3(금)", " 채용시  마감 ", "상시채용", "")] == ["09-03", "채용시 마감", "상시채용", ""]
    assert [one(spark, sites.wanted_deadline, x) for x in ("2026-09-30T00:00:00", None)] == ["2026-09-30", "상시채용"]
    assert one(spark, sites.saramin_career, "신입 · 경력 · 정규직 외") == "신입 · 경력"
    w = spark.createDataFrame([("서울", "강남구", "테헤란로 1"), ("서울", "강남구", "서울 강남구 1"), ("서울", None, ""), (None, None, "부산")], "a string, b string, c string")
    assert [r[0] for r in w.select(sites.workplace(F.col("a"), F.col("b"), F.col("c"))).collect()] == ["서울 강남구 · 테헤란로 1", "서울 강남구 1", "서울", "부산"]
    assert [one(spark, lambda c: lookups.place_matches(c, ["성남시", "서울특별시"]), x) for x in ("경기 성남 분당", "서울", "전국", "", "부산")] == [True, True, False, True, False]
    assert [one(spark, lookups.career_band, x, "int") for x in (-1, 0, 2, 12, 200)] == ["", "1", "2", "5", "7"]
    names = one(spark, text.variants, "(주)더즌 (dozn) 랩스")
    assert [tuple(x) for x in names] == [("(주)더즌 (dozn) 랩스", "원문"), ("더즌 (dozn) 랩스", "법인표기 제거"), ("더즌(dozn)랩스", "공백 제거"), ("더즌 랩스", "괄호 제거"), ("더즌랩스", "괄호+공백 제거"), ("dozn", "괄호 안쪽"), ("더즌", "첫 어절"), ("(주)더즌랩스", "법인표기 추가")]


def test_listing_pages(spark):
    pages = spark.createDataFrame([(2, [("a", 9), ("b", 2)]), (1, [("a", 1), (None, 0)])], "page int, items array<struct<id:string,n:int>>")
    assert {r["id"]: r["item"]["n"] for r in sites.listed(pages, "items", "id").collect()} == {"a": 1, "b": 2}


def test_listings_of_several_pages(spark):
    block = '<div id="rec-{}" class="list_item"><div class="col company_nm"><span class="str_tit">{}</span></div></div>'
    ad = block.format(9, "광고") + "전체 채용정보 1,002 건"
    pages = spark.createDataFrame([(2, block.format(1, "둘") + block.format(2, "A &amp;&nbsp;B")), (1, ad + block.format(1, "하나")), (3, None), (4, "")], "page int, html string")
    assert sorted((r["rec_idx"], r["company"], r["title"]) for r in sites.saramin_listing(pages).collect()) == [("1", "하나", ""), ("2", "A & B", "")]
    assert [one(spark, sites.saramin_total, x) for x in (ad, "전체 채용정보", None)] == [1002, None, None]
    assert [one(spark, sites.jobkorea_total, x) for x in (" 1,057\n", "<b>57</b>", "57건", "", None)] == [1057, 57, None, None, None]
    assert sites.jobkorea_listing(pages).count() == 0


def test_flat_bands(spark):
    flat = [True, True, False, True, None, True, True, True, False]
    rows_ = spark.createDataFrame([("a", y, f) for y, f in enumerate(flat)] + [("b", 0, False)], "k string, y int, flat boolean")
    bands = lambda **kw: sorted(tuple(r) for r in images.flat_bands(rows_, "k", "y", F.col("flat"), **kw).collect())
    assert bands() == [("a", 0, 1), ("a", 3, 3), ("a", 5, 7)] and bands(low=1, high=7) == [("a", 1, 1), ("a", 3, 3), ("a", 5, 6)] and bands(least=2) == [("a", 5, 7)]


ROLES = {"백엔드": "백엔드", "서버": "백엔드", "웹": "웹"}


def test_env_files(tmp_path):
    f = tmp_path / ".env"
    f.write_text("""# c\nexport A = x y # note\nB="q # \\"r\\"\\n2"\nC='it''s'\nD= # only a comment\nE=C#,F# \nNONE\nA=2\n""")
    env = conditions.read_env(f)
    assert env["A"] == "2" and env["B"] == 'q # "r"\n2' and env["E"] == "C#,F#" and env["NONE"] is None and conditions.uncommented(env["D"]) == ""
    assert conditions.listed("C#, ,Java # x") == ["C#", "Java"]
    with pytest.raises(conditions.ConditionError):
        conditions.read_env(tmp_path / "none")


@pytest.mark.parametrize("env", [{}, {"JOB_ROLES": "요리"}, {"JOB_ROLES": "웹", "YOE": "21"}, {"JOB_ROLES": "웹", "YOE": "x"}, {"JOB_ROLES": "웹", "EMPLOYMENT_TYPES": "정규직"}, {"JOB_ROLES": "웹", "EDUCATION": "중졸"}])
def test_conditions_not_understood(env):
    for site in ("saramin", "jobkorea", "jobplanet", "jumpit"):
        with pytest.raises(conditions.ConditionError):
            conditions.load(site, env, ROLES, {"웹": [87]})


@pytest.mark.parametrize(
    ("site", "places", "want"),
    [
        ("saramin", {"loc_mcd": ["101000", "102000"]}, ["?cat_kewd=84%2C87&search_optional_item=y&search_done=y&panel_count=y&preview=y&recruitSort=relation&recruitPageCount=50&exp_cd=2&exp_min=3&edu_min=8&edu_max=11&loc_mcd=101000%2C102000&job_type=1%2C4"]),
        ("jobkorea", {"local": ["I000"]}, ["?menucode=duty&duty=84%2C87&local=I000&career=2&edu=5&jobtype=1%2C3"]),
        ("jobplanet", {"city": []}, ["?occupation_level2=84%2C87&job_type=3&years_of_experience=0%2C3"]),
        ("jumpit", {"locationTag": ["a", "b"]}, ["?sort=popular&jobCategory=84&jobCategory=87&locationTag=a&locationTag=b&career=3"]),
        ("wanted", {"locations": ["seoul.all"]}, [f"?country=kr&job_group_id={g}&job_sort=job.latest_order&job_ids=84&job_ids=87&locations=seoul.all&employment_types=job.employment_type.regular&employment_types=job.employment_type.intern&years=3" for g in (518, 507)]),
    ],
)
def test_searches(site, places, want):
    env = {"JOB_ROLES": "서버, 백엔드,웹", "YOE": "3 # years", "EDUCATION": "대졸4", "EMPLOYMENT_TYPES": "regular,intern"}
    c = conditions.load(site, env, ROLES, {"백엔드": [84, 87], "웹": []})
    assert c.missing_roles == ("웹",) and c.unsupported_employment == {"jobplanet": ["intern"], "jumpit": ["regular", "intern"]}.get(site, [])
    assert [conditions.query_string(site, x) for x in conditions.searches(c, places, {"84": 518, "87": 507})] == want


def test_search_borders():
    assert [conditions.experience(s, y) for s, y in (("saramin", -1), ("saramin", 0), ("jobkorea", 0), ("jobkorea", 16), ("jobplanet", 0), ("jobplanet", 30), ("jumpit", 0))] == [{}, {"exp_cd": "1"}, {"career": "1"}, {"career": "6"}, {"years_of_experience": "0,0"}, {"years_of_experience": "0,11"}, {"career": "0"}]
    assert conditions.education("saramin", "무관") == {"edu_none": "y"} and conditions.education("jobplanet", "석사") == {}
    assert conditions.checked_codes(["2", "1", "2"], ["1", "2"]) == ["2", "1"] and conditions.query_string("saramin", {"a": [], "b": None, "c": " "}) == ""
    for codes in (["9"], ["3"]):
        with pytest.raises(conditions.ConditionError):
            conditions.checked_codes(codes, ["1"], ["9"])


def test_old_inputs_are_asked_for(tmp_path):
    f, said = tmp_path / "x.csv", []
    ask = lambda **kw: conditions.may_use(f, say=said.append, **kw)
    assert ask()
    f.write_text("x")
    now = f.stat().st_mtime + conditions.STALE_AFTER
    assert ask(now=now - 1) and ask(now=now, yes=True) and ask(now=now, chained=True) and not said
    assert not ask(now=now) and ask(now=now, ask=lambda: " Yes ") and not ask(now=now, ask=lambda: "") and len(said) == 4


def test_files_round_trip(spark, tmp_path):
    p = rows(spark, {"title": 'a "q", b\nc', "req": "줄\n둘"}, {"title": "z"})
    path = str(tmp_path / "x.csv")
    files.write_csv(p, path)
    assert (tmp_path / "x.csv").read_bytes()[:3] == b"\xef\xbb\xbf"
    assert [r[TITLE] for r in files.read_postings(spark, path).orderBy(ORD).collect()] == ['a "q", b\nc', "z"]
    files.write_csv(p.where(f"{ORD} = 1"), path)  # replaces the file in one step
    assert [r[TITLE] for r in files.read_postings(spark, path).collect()] == ["z"] and [x.name for x in tmp_path.iterdir() if x.name.startswith("x.csv")] == ["x.csv"]
    assert files.read_postings(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "b.jsonl").write_text('{"URL": "u", "본문": "1"}\nbroken\n{"URL": "u", "본문": "2"}\n{"URL": "", "본문": "3"}\n')
    assert [tuple(r) for r in files.read_bodies(spark, str(tmp_path / "b.jsonl")).collect()] == [("u", "2")]
    (tmp_path / "t.txt").write_text("# c\nC# # x\n쿠버 = Kubernetes\n")
    assert {tuple(r) for r in files.read_terms(spark, str(tmp_path / "t.txt")).collect()} == {("C#", "C#"), ("쿠버", "Kubernetes")}


def test_save_and_history_files(spark, tmp_path):
    path, h = str(tmp_path / "wanted_post.csv"), tmp_path / "history"
    h.mkdir()
    bodies = lambda *x: spark.createDataFrame(x, "url string, body string")
    assert tuple(files.save(spark, rows(spark, {"url": "a"}, {"url": "b"}), path, "2026-09-01", bodies(("a", "1"), ("b", " "))).first())[:2] == (2, 0)
    assert tuple(files.save(spark, rows(spark, {"url": "a", "title": "t"}, {"url": "c"}), path, "2026-09-02", bodies(("a", "2"))).first()) == (1, 1, 1, 0, 0)
    assert [(r[URL], r[TITLE], r[FIRST]) for r in files.read_postings(spark, path).orderBy(ORD).collect()] == [("c", "", "2026-09-02"), ("a", "t", "2026-09-01"), ("b", "", "2026-09-01")]
    assert [tuple(r) for r in files.read_bodies(spark, path.replace(".csv", "_bodies.jsonl")).collect()] == [("a", "2")]
    report = spark.createDataFrame([("co", "t", "wanted", "a", "제외 · 낱말", "PHP")], "`기업명` string, `공고명` string, `사이트명` string, URL string, `판정` string, words string")
    for day in ("2026-09-03", "2026-09-04"):
        files.history_stage(spark, str(tmp_path), str(h), day, [("wanted_post.csv", "history_read.csv")], {"거르기": report})
    assert {r[URL]: (r[FIRST], r[LAST]) for r in files.read_postings(spark, str(h / "history_read.csv")).collect()}["a"] == ("2026-09-01", "2026-09-04")
    assert [(r["기록일"], r["단계"], r["근거"]) for r in files.read_any(spark, str(h / "history_dropped.csv")).withColumnRenamed("\ufeff기록일", "기록일").collect()] == [("2026-09-04", "거르기", "words=PHP")]


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "tech_corpus.json").write_text('{"tech": [{"name": "Go", "kind": "language"}]}')
    (tmp_path / "tech_aliases.json").write_text('{"aliases": {"Golang": "Go"}}')
    (tmp_path / "tech_ko_allowlist.txt").write_text("고랭 = Go\n부하 테스트\n")
    d = files.read_dictionary(spark, str(tmp_path))
    assert d.known("golang") == "Go" and d.korean == {"고랭": "Go", "부하 테스트": "부하 테스트"} and not d.rejected


def test_pipeline_accounts_for_every_row(spark):
    p = view.postings(spark, SF)
    r = pipeline.run(p, pipeline.Context(excluded=["PHP"], core=["Java"]))
    kept = {x[URL] for x in r.final.collect()}
    cut = {x[URL] for x in r.report.collect()}
    assert not kept & cut and kept | cut == {x[URL] for x in p.collect()}
    n = [x["n"] for x in r.funnel.orderBy("pos").collect() if x["n"] is not None]
    assert n == sorted(n, reverse=True) and n[-1] == len(kept)


def test_history_stream(spark, tmp_path):
    source, folder = tmp_path / "in", str(tmp_path / "history")
    p = as_postings(view.postings(spark, SF))
    p.where(f"{ORD} < 50").coalesce(1).write.parquet(str(source))
    stream = spark.readStream.schema(POSTING_SCHEMA).parquet(str(source))
    history.stream_history(stream, folder, str(tmp_path / "cp"), "2026-10-01").awaitTermination()
    p.where(f"{ORD} >= 40 AND {ORD} < 60").coalesce(1).write.mode("append").parquet(str(source))
    history.stream_history(stream, folder, str(tmp_path / "cp"), "2026-10-02").awaitTermination()
    out = {r[URL]: r[LAST] for r in history.current(spark, folder).collect()}
    assert len(out) == 60 and out["https://x/45"] == "2026-10-02" and out["https://x/5"] == "2026-10-01"
    # A new checkpoint goes on from the newest version; a batch that runs again changes nothing.
    q = history.stream_history(spark.readStream.schema(POSTING_SCHEMA).parquet(str(source)), folder, str(tmp_path / "other"), "2026-10-03")
    q.awaitTermination()
    history.upsert_batch(spark, folder, p.where(f"{ORD} < 3"), "2026-10-09", str(q.id), 0)
    out = {r[URL]: r[LAST] for r in history.current(spark, folder).collect()}
    assert len(out) == 60 and set(out.values()) == {"2026-10-03"}
    history.upsert_batch(spark, folder, p.where(f"{ORD} = 100"), "2026-12-01", "later", 0)
    assert {r[URL] for r in history.current(spark, folder).collect()} == {"https://x/100"}


def test_lift_and_tiers(spark):
    df = spark.createDataFrame([(i, ["a", "b"] if i < 6 else ["a"] if i < 8 else ["c"]) for i in range(12)], "k long, t array<string>")
    assert [tuple(r) for r in analytics.lift(df, "k", F.col("t")).collect()] == [("a", "b", 6, 1.5)]
    tiers = {r["name"]: r["tier"] for r in analytics.tiers(df, F.col("t"), F.slice("t", 2, 1)).collect()}
    assert tiers == {"a": "기본기", "b": "갈림"}


def test_contexts(spark):
    assert [tuple(x) for x in one(spark, lambda c: rules.contexts(c, rules.BANNED), "우리는 SI 회사, 고객사 파견")] == [("SI", "우리는 SI 회사, 고객사 파견"), ("고객사", "우리는 SI 회사, 고객사 파견"), ("파견", "우리는 SI 회사, 고객사 파견")]


def test_training_part_may_be_absent(monkeypatch):
    import __spark_entry__ as entry

    def missing(name):
        raise ImportError(name)

    monkeypatch.setattr(entry, "import_module", missing)
    assert set(entry.queries()) == set(queries.QUERIES) and set(entry.oracle_sql()) == set(queries.ORACLES)
