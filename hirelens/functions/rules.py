"""Rule tables as array literals, and what they find in a text: no join of texts with rules is needed."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, quoted, squeeze, word_pattern


@dataclass(frozen=True)
class Rule:
    """A pattern by name.  needs: literals of which a text (in lower case, if the pattern ignores case) has one wherever
    the pattern matches; a search for a literal costs a fraction of one for a pattern.  first: what a match begins with, for the same reason."""

    name: str
    pattern: str
    needs: tuple[str, ...] = ()
    first: str = ""

    def may(self, c: Column) -> Column:
        low = F.lower(c) if "(?i" in self.pattern else c
        out = F.lit(not self.needs)
        for x in self.needs:
            out = out | low.contains(x)
        return out

    def hits(self, c: Column) -> Column:
        return self.may(c) & c.rlike(self.pattern)


# Words that postings are reported for.
BANNED = [
    Rule("SI", r"(?<![A-Za-z0-9])SI(?![A-Za-z0-9])", ("SI",)),
    Rule("SM", r"(?<![A-Za-z0-9])SM(?![A-Za-z0-9])", ("SM",)),
    Rule("병역특례", r"병역\s*특례", ("병역",)),
    Rule("현역", r"(?<![가-힣])현역", ("현역",)),
    Rule("보충역", "보충역"),
    Rule("산업기능요원", r"산업\s*기능\s*요원", ("산업",)),
    Rule("전문연구요원", r"전문\s*연구\s*요원", ("전문",)),
    Rule("고객사", "고객사"),
    Rule("파견", "파견"),
]
# Words of head hunters.
HEADHUNT = [Rule("헤드헌팅", r"(?iu)헤드\s*헌|서치\s*펌|search\s*firm|채용\s*대행|인재\s*서치|리크루팅\s*(펌|회사)", ("헤드", "서치", "search", "ſearch", "채용", "리크루팅"))]


def words(names: list[str]) -> list[Rule]:
    return [Rule(n, word_pattern(n), first=n[:1]) for n in names if n.strip()]


def core_words(names: list[str]) -> list[Rule]:
    """a name also counts by its first word, if that has two characters or more."""
    out = []
    for n in (x.strip() for x in names):
        if n:
            head = n.split()[0]
            both = [word_pattern(n)] + ([word_pattern(head).removeprefix("(?iu)")] if len(head) >= 2 and head.lower() != n.lower() else [])
            out.append(Rule(n, "|".join(both), first=n[:1]))
    return out


def hits(c: Column, rules: list[Rule]) -> Column:
    """Names of the rules that match, in the rules' order."""
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(r.hits(c), F.lit(r.name)) for r in rules]))


def any_hit(c: Column, rules: list[Rule]) -> Column:
    """Whether any rule matches.  Rules that say what they begin with become one pattern, so a text is read once however
    many names there are."""
    out, parted = F.lit(False), []
    for r in rules:
        if r.first:
            parted.append((r.first, re.match(r"(?:\(\?([a-zA-Z]+)\))?(.*)", r.pattern, re.S).groups()))
        else:
            out = out | r.hits(c)
    if parted:
        group = lambda flags, body: f"(?{flags}:{body})" if flags else f"(?:{body})"
        flags = {f for _, (f, _) in parted}
        looks = group(flags.pop(), f"[{quoted(''.join(sorted({x for x, _ in parted})))}]") if len(flags) == 1 else ""
        out = out | c.rlike((f"(?={looks})" if looks else "") + "(?:" + "|".join(group(f, body) for _, (f, body) in parted) + ")")
    return out


def near(c: Column, rule: Rule, width: int) -> Column:
    """the first match of a rule with its surroundings, null without one.  The text is parted at the match, so it is
    searched once and not again for what stands there."""

    def around(parts: Column) -> Column:
        before, after = parts[0], parts[1]
        match = F.substring(c, F.length(before) + 1, F.length(c) - F.length(before) - F.length(after))
        return F.when(F.size(parts) == 2, squeeze(F.concat(F.right(before, F.lit(width)), match, F.left(after, F.lit(width)))))

    whole = let(F.split(c, rule.pattern, 2), lambda parts: around(F.when(F.size(parts) == 2, parts).otherwise(F.array(F.lit(""), F.lit(""), F.lit("")))))
    return F.when(rule.may(c), whole)


def contexts(c: Column, rules: list[Rule], width: int = 24) -> Column:
    """name and surroundings of each rule's first match."""
    each = [let(near(c, r, width), lambda x, r=r: F.when(x.isNotNull(), F.struct(F.lit(r.name).alias("name"), x.alias("context")))) for r in rules]
    return F.array_compact(F.array(*each))
