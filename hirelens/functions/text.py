"""Text expressions.  All are JVM-side but title_key, unescape and the HTML ones: Spark has no NFKC and no unescape."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal forms dropped from company names (and from names looked up for a rating), the symbols titles are
# compared without, a version behind a name, a name with a list in brackets, and the heading of values within requirements.
LEGAL_FORMS = r"주식회사|㈜|\(주\)|\(유\)|\(재\)|\(사\)|유한책임회사|유한회사"
RATED_LEGAL_FORMS = r"주식회사|㈜|\(주\)|\(유\)|\(재\)|\(사\)|유한책임회사|유한회사|\(株\)"
TITLE_SYMBOLS = r"[\[\]()（）{}<>〈〉《》「」『』~〜\-‐‑‒–—―/／·・,，:：|｜]"
VERSION = r"\s+v?\d+(?:\.\d+)*\s*(?:이상|이후|\+)?$|\s+(?:이상|이후)$"
WRAPPED = r"^([^()\[\]]+?)\s*[(\[]([^()\[\]]*)[)\]]$"
PARENTHESES = r"\s*[\(（][^)）]*[\)）]"
VALUES_HEADING = "[인재상 (별도표기)]"

FIELD_CAP, BODY_CAP = 4000, 50_000


def quoted(s: str) -> str:
    """s as a literal within a Java and Python pattern."""
    return re.sub(r"([^\w\s]|_)", r"\\\1", s)


def strip_u(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    return strip_u(F.regexp_replace(c, r"(?U)\s+", " "))


def is_blank(c: Column) -> Column:
    return strip_u(F.coalesce(c, F.lit(""))) == ""


def company_key(c: Column) -> Column:
    """Legal forms and white space dropped, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, LEGAL_FORMS, ""), r"(?U)\s+", ""))


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x) if x is not None else None)


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: html.unescape(x) if x is not None else None)


def plain_title_key(c: Column) -> Column:
    """D2 for text that is NFKC already."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, TITLE_SYMBOLS, ""), r"(?U)\s+", ""))


def title_key(c: Column) -> Column:
    """NFKC only where a character outside ASCII and Hangul makes it matter."""
    return plain_title_key(F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F가-힣]"), c)), c))


def word_pattern(name: str) -> str:
    """name not next to ASCII letters or digits, ignoring case; Hangul may touch it."""
    return rf"(?iu)(?<![A-Za-z0-9]){quoted(name)}(?![A-Za-z0-9])"


def let(value: Column, body) -> Column:
    """body(value) with value worked out once, however often body names it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def trim_field(c: Column, cap: int = FIELD_CAP) -> Column:
    """At most `cap` characters, marked when cut."""
    return F.when(F.length(c) > cap, F.concat(F.regexp_replace(F.substring(c, 1, cap), r"(?U)\s+$", ""), F.lit(" …"))).otherwise(c)


def joined(*columns: str) -> Column:
    """F5."""
    return F.concat_ws("\n", *columns)


def items(c: Column, separator: str = ",") -> Column:
    """Non-empty trimmed parts."""
    return F.filter(F.transform(F.split(c, re.escape(separator)), strip_u), lambda x: x != "")


def distinct_ci(a: Column) -> Column:
    """The first spelling of each name, whatever its case."""
    return F.aggregate(a, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)))


def distinct_names(a: Column) -> Column:
    """D8."""
    return F.array_distinct(F.filter(a, lambda x: x != ""))


def split_names(c: Column) -> Column:
    """Parts at commas outside brackets of any depth, in order, repeats included; A(b, c) gives A, b and c.

    A closing bracket too many closes nothing.  Only cells with brackets pay for the scan of their characters.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("seen"))

    def step(acc: Column, x: Column) -> Column:
        depth = F.when(x.isin("(", "["), acc["depth"] + 1).when(x.isin(")", "]"), F.greatest(acc["depth"] - 1, F.lit(0))).otherwise(acc["depth"])
        return F.struct(depth.alias("depth"), F.concat(acc["seen"], F.when((x == ",") & (acc["depth"] == 0), F.lit("\x01")).otherwise(x)).alias("seen"))

    marked = F.when(c.rlike(r"[(\[]"), F.aggregate(F.split(c, ""), start, step, lambda acc: acc["seen"])).otherwise(F.translate(c, ",", "\x01"))
    outer = F.filter(F.transform(F.split(marked, "\x01"), strip_u), lambda x: x != "")
    inner = F.transform(outer, lambda x: F.when(x.rlike(WRAPPED), F.concat(F.array(strip_u(F.regexp_extract(x, WRAPPED, 1))), F.transform(F.split(F.regexp_extract(x, WRAPPED, 2), r"[,/·]"), strip_u))).otherwise(F.array(x)))
    return F.filter(F.flatten(inner), lambda x: x != "")


def without_version(c: Column) -> Column:
    """T15."""
    return strip_u(F.regexp_replace(c, f"(?U){VERSION}", ""))


def tight(c: Column) -> Column:
    """NFKC, legal forms and white space dropped, parentheses kept."""
    return F.lower(F.regexp_replace(F.regexp_replace(nfkc(c), RATED_LEGAL_FORMS, ""), r"(?U)\s+", ""))


def loose(c: Column) -> Column:
    """Also without what stands in parentheses."""
    plain = F.regexp_replace(F.replace(nfkc(c), F.lit("㈜"), F.lit("")), f"(?U){PARENTHESES}", "")
    return F.lower(F.replace(F.regexp_replace(plain, r"(?U)\s+", ""), F.lit("(주)"), F.lit("")))


def matches(items_: Column, tight_name: Column, loose_name: Column) -> Column:
    """Of an array of structs with fields tight and loose (the names' own forms) those whose tight form is the
    one looked for, and only without such ones those whose loose form is."""
    strict = F.filter(items_, lambda x: x["tight"] == tight_name)
    return F.when(F.size(strict) > 0, strict).otherwise(F.filter(items_, lambda x: x["loose"] == loose_name))


def variants(c: Column) -> Column:
    """The forms a company is looked up by, in order, as structs (variant, how): each form of two characters or
    more once, whatever its case."""
    raw = nfkc(strip_u(F.coalesce(c, F.lit(""))))
    one_space = lambda x: F.regexp_replace(x, r"(?U)\s+", " ")
    no_space = lambda x: F.regexp_replace(x, r"(?U)\s+", "")
    bare = F.btrim(one_space(F.regexp_replace(raw, RATED_LEGAL_FORMS, "")), F.lit(" -·,"))
    outside = strip_u(one_space(F.regexp_replace(bare, f"(?U){PARENTHESES}", "")))
    inside = F.btrim(F.regexp_extract(bare, f"(?U){PARENTHESES}", 0), F.lit(" ()（）"))
    first = F.when(outside.contains(" "), F.split_part(outside, F.lit(" "), F.lit(1))).otherwise(F.lit(""))
    # The names of the forms, in order.
    forms = [(raw, "원문"), (bare, "법인표기 제거"), (no_space(bare), "공백 제거"), (outside, "괄호 제거"), (no_space(outside), "괄호+공백 제거"), (inside, "괄호 안쪽"), (first, "첫 어절"), (F.concat(F.lit("(주)"), no_space(outside)), "법인표기 추가")]
    given = F.array(*[F.struct(strip_u(x).alias("variant"), F.lit(how).alias("how")) for x, how in forms])
    none = F.array().cast("array<struct<variant:string,how:string>>")
    known = lambda acc, x: (F.length(x["variant"]) < 2) | F.exists(acc, lambda y: F.lower(y["variant"]) == F.lower(x["variant"]))
    return F.aggregate(given, none, lambda acc, x: F.when(known(acc, x), acc).otherwise(F.array_append(acc, x)))


def bullet_key(c: Column) -> Column:
    """Without the bullet in front (an o only before white space), white space and punctuation; lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"(?U)^\s*(?:[•·※*▪◦∙・\-]+|o(?=\s))\s*", ""), r"[^\p{L}\p{N}]+", ""))


def cleaned(a: Column) -> Column:
    """Squeezed items that say something, each once."""
    return F.array_distinct(F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), squeeze), lambda x: x.isNotNull() & (bullet_key(x) != "")))


def add_missing(c: Column, items_: Column) -> Column:
    """A text and, as bullets, the items that no line of it and no item added before holds."""
    found, base = cleaned(items_), strip_u(F.coalesce(c, F.lit("")))
    lines = F.transform(F.split(base, "\n"), bullet_key)
    added = F.aggregate(found, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(lines, lambda y: y.contains(bullet_key(x))) | F.exists(acc, lambda y: bullet_key(y).contains(bullet_key(x))), acc).otherwise(F.array_append(acc, x)))
    tail = F.array_join(F.transform(added, lambda x: F.concat(F.lit("• "), x)), "\n")
    return F.when(F.size(found) == 0, c).when(F.size(added) == 0, base).when(base == "", tail).otherwise(F.concat(base, F.lit("\n"), tail))


def add_values(c: Column, items_: Column) -> Column:
    """A text and, under the heading of values, the items as bullets; a text that has the heading stays."""
    found, base = cleaned(items_), strip_u(F.coalesce(c, F.lit("")))
    tail = F.concat(F.lit(VALUES_HEADING + "\n"), F.array_join(F.transform(found, lambda x: F.concat(F.lit("• "), x)), "\n"))
    return F.when((F.size(found) == 0) | F.coalesce(c, F.lit("")).contains(VALUES_HEADING), c).when(base == "", tail).otherwise(F.concat(base, F.lit("\n"), tail))


def keep_values(before: Column, after: Column) -> Column:
    """The values a text had under their heading, put back behind what overwrote it."""
    at = F.locate(VALUES_HEADING, before)
    block = F.regexp_replace(F.substring(before, at, F.length(before)), r"(?U)\s+$", "")
    cut = F.regexp_replace(after, r"(?U)\s+$", "")
    return F.when((at == 0) | after.contains(VALUES_HEADING), after).when(cut == "", block).otherwise(F.concat(cut, F.lit("\n"), block))


def log_lines(c: Column) -> Column:
    """The lines of a log without blank ones and progress bars (a bar among the first 20 characters)."""
    each = F.transform(F.split(F.coalesce(c, F.lit("")), r"[\r\n]"), lambda x: F.regexp_replace(x, r"(?U)\s+$", ""))
    return F.filter(each, lambda x: (strip_u(x) != "") & ~F.substring(x, 1, 20).contains("|"))


def spoken(seconds: Column) -> Column:
    """An age in words: its largest unit and the next smaller one, if that is not zero."""
    m, h, d = F.floor(seconds / 60), F.floor(seconds / 3600), F.floor(seconds / 86400)
    part = lambda n, unit: F.when(n > 0, F.concat(n.cast("string"), F.lit(unit)))
    hours, days = F.concat_ws(" ", part(h, "시간"), part(m % 60, "분")), F.concat_ws(" ", part(d, "일"), part(h % 24, "시간"))
    return F.when(seconds < 60, "방금").otherwise(F.concat(F.when(seconds < 3600, part(m, "분")).when(seconds < 86400, hours).otherwise(days), F.lit(" 전")))


def first_json(c: Column) -> Column:
    """The first JSON value in a text, as a variant."""
    return F.try_parse_json(F.when(c.contains("{"), F.concat(F.lit("{"), F.regexp_extract(c, r"(?s)\{(.*)", 1))))
