"""Document sections: requirements and preferences out of one text (T10-T13), as array expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let, strip_u, trim_field

# Headings of requirements, preferences and other sections, headings that are sentences (what follows them
# on their line is no content), a further heading of one site, and from how many names on a text counts as sectioned.
REQUIRED = r"자격\s*요건|지원\s*자격|자격\s*조건|자격\s*사항|필수\s*요건|필수\s*사항|이런\s*분을\s*찾|이런\s*분과"
PREFERRED = r"우대\s*사항|우대\s*조건|우대\s*요건|우대\s*능력|이런\s*분이면\s*더|이런\s*경험"
OTHER = r"담당\s*업무|주요\s*업무|모집\s*부문|모집\s*분야|근무\s*조건|근무\s*환경|전형\s*절차|채용\s*절차|제출\s*서류|접수\s*방법|접수\s*기간|복리\s*후생|기타\s*사항|유의\s*사항|문의\s*(?:사항|처)|채용\s*문의|문의\s*:|^\s*문의\s*$"
SENTENCE = r"이런\s*분을\s*찾|이런\s*분과|이런\s*분이면\s*더|이런\s*경험"
EXTRA_JOBKOREA = "포지션"
TAIL_MARKS = " :·-|]）)"
SECTIONED = 3
HANGUL = "[가-힣]"


def lines(text: Column, extra_other: str | None = None) -> Column:
    """Each line with its marks: names (what it matches of each heading class, blanks taken out), kinds, column (a table
    header), q_tail and p_tail (null: no such heading, else the content behind it), bare and stacked."""
    classes = [REQUIRED, PREFERRED, OTHER] + ([extra_other] if extra_other else [])

    def mark(x: Column) -> Column:
        hit = [F.regexp_extract(x, f"(?U)({p})", 1) for p in classes]
        rest = x
        for p in classes:
            rest = F.regexp_replace(rest, f"(?sU)^(.*?)(?:{p})", "$1")
        names = F.filter(F.transform(F.array(*hit), lambda h: F.replace(h, F.lit(" "), F.lit(""))), lambda h: h != "")
        tail = lambda p: F.when(x.rlike(f"(?U){SENTENCE}"), F.lit("")).otherwise(strip_u(F.ltrim(F.regexp_replace(x, f"(?sU)^.*?(?:{p})", ""), F.lit(TAIL_MARKS))))
        return F.struct(
            x.alias("line"), names.alias("names"), F.size(names).alias("kinds"), (F.size(names) > 1).alias("column"),
            F.when(hit[0] != "", tail(REQUIRED)).alias("q_tail"), F.when(hit[1] != "", tail(PREFERRED)).alias("p_tail"),
            ((F.size(names) > 0) & ~rest.rlike("[0-9A-Za-z가-힣]")).alias("bare"),
        )

    # A line that holds no heading needs no further pattern, and one without Hangul none at all.
    any_of = "(?U)" + "|".join(classes)
    may = lambda x: x.rlike(HANGUL) & x.rlike(any_of) if all(re.search(HANGUL, c) for c in classes) else x.rlike(any_of)
    plain = lambda x: F.struct(x.alias("line"), F.array().cast("array<string>").alias("names"), F.lit(0).alias("kinds"), F.lit(False).alias("column"), F.lit(None).cast("string").alias("q_tail"), F.lit(None).cast("string").alias("p_tail"), F.lit(False).alias("bare"))
    marked = F.transform(F.split(text, "\n"), lambda x: F.when(may(x), mark(x)).otherwise(plain(x)))
    near = lambda a, i: F.coalesce(F.try_element_at(a, i)["bare"], F.lit(False))
    return let(marked, lambda a: F.transform(a, lambda x, i: x.withField("stacked", x["bare"] & ((F.when(i > 0, near(a, F.greatest(i, F.lit(1)))).otherwise(F.lit(False))) | near(a, i + F.lit(2))))))


def section(marked: Column, tail: str) -> Column:
    """From the first heading of a class (named by its tail) to the next heading, empty without one.

    A table header neither ends a section nor belongs to it; the section's own heading with content behind it goes on.
    """
    starts = F.transform(marked, lambda x: x[tail].isNotNull() & ~x["stacked"] & ~x["column"])
    return let(F.array_position(starts, F.lit(True)).cast("int"), lambda start: F.when(start > 0, _from(marked, start, tail)).otherwise(F.lit("")))


def _from(marked: Column, start: Column, tail: str) -> Column:
    first = F.coalesce(F.try_element_at(marked, F.greatest(start, F.lit(1)))[tail], F.lit(""))
    rest = F.slice(marked, F.greatest(start, F.lit(0)) + 1, F.greatest(F.size(marked) - start, F.lit(0)))
    ends = lambda x: (x["kinds"] > 0) & ~x["column"] & (F.coalesce(x[tail], F.lit("")) == "")
    own = let(rest, lambda r: let(F.array_position(F.transform(r, ends), F.lit(True)).cast("int"), lambda stop: F.when(stop > 0, F.slice(r, 1, F.greatest(stop - 1, F.lit(0)))).otherwise(r)))
    return F.array_join(F.filter(F.concat(F.array(first), _content(own)), lambda x: x != ""), "\n")


def _content(rows: Column) -> Column:
    return F.filter(F.transform(F.filter(rows, lambda x: ~x["column"]), lambda x: strip_u(x["line"])), lambda x: x != "")


def headings(marked: Column) -> Column:
    """The distinct names of headings."""
    return F.array_distinct(F.flatten(F.transform(marked, lambda x: x["names"])))


def split_body(text: Column, extra_other: str | None = None) -> Column:
    """struct(req, pref).  Without a requirements section: nothing in a text of three heading names or more, what
    stands before the preferences, or the whole text."""
    whole = F.coalesce(text, F.lit(""))
    parts = lambda m: F.struct(m.alias("m"), section(m, "q_tail").alias("req"), section(m, "p_tail").alias("pref"))
    done = lambda x: let(F.when(x["req"] != "", x["req"]).otherwise(_fallback(whole, x)), lambda v: trim_field(v))
    split = let(let(lines(whole, extra_other), parts), lambda x: F.struct(done(x).alias("req"), trim_field(x["pref"]).alias("pref")))
    unsplit = F.struct(trim_field(whole).alias("req"), F.lit("").alias("pref"))  # every heading has Hangul
    return F.when(whole.rlike(HANGUL), split).otherwise(unsplit) if extra_other is None or re.search(HANGUL, extra_other) else split


def _fallback(whole: Column, x: Column) -> Column:
    m = x["m"]
    first = F.array_position(F.transform(m, lambda y: y["p_tail"].isNotNull() & ~y["column"]), F.lit(True)).cast("int")
    before = F.array_join(F.filter(F.transform(F.when(first > 0, F.slice(m, 1, F.greatest(first - 1, F.lit(0)))).otherwise(m), lambda y: strip_u(y["line"])), lambda y: y != ""), "\n")
    return F.when(F.size(headings(m)) >= SECTIONED, F.lit("")).when(x["pref"] != "", before).otherwise(whole)
