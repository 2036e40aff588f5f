"""Technology names: dictionaries, finding names in prose, and resolving tags.

Dictionaries are parameters (sources.files reads them): a corpus of standard names with their kinds, aliases, words that
are no technology in prose (blocked) or at all (rejected), and Korean terms.  A dictionary is read on the driver and goes
to each Python worker once.  Lookups run on the distinct names of an Arrow batch, so their cost does not depend on how
often a name stands in it.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.text import VERSION, distinct_ci, split_names

# Names of two characters or fewer that count, and what may follow a Korean name that ends there:
# particles, endings and suffixes.
SHORT = {"c", "r", "go", "c#", "c++", "js", "ai", "ml"}
PARTICLES = "을 를 이 가 은 는 에 의 와 과 로 으로 도 만 및 부터 까지 처럼 보다 대로 만큼 이나 나 든 라도 조차 마저 뿐 께 한테 에서 에게 랑 이며 며 이고 고".split()
ENDINGS = "하 한 할 함 해 했 하는 하여 하고 하며 하지 되 된 될 됨 돼 됐 되는 되어 되고 되며 인 이 였 이었 라 란 랑".split()
SUFFIXES = "화 적 성 형 기 자 등 들 시 상 중 용 별 내 외 간 어 측 부 군 값 수".split()
TRAILERS = tuple(PARTICLES + ENDINGS + SUFFIXES)
#: A name of at least so many characters may be followed by a version's digits.
VERSIONED = 3
ASCII_NAME = re.compile(r"[A-Za-z0-9.][A-Za-z0-9 .+#/_-]*")


@dataclass(frozen=True)
class Dictionary:
    """corpus: standard name to kind; aliases and korean: spelling to standard name."""

    corpus: dict[str, str | None]
    aliases: dict[str, str] = field(default_factory=dict)
    blocklist: frozenset[str] = frozenset()
    rejected: frozenset[str] = frozenset()
    korean: dict[str, str] = field(default_factory=dict)

    @cached_property
    def standard(self) -> dict[str, str]:
        return {n.lower(): n for n in self.corpus}

    @cached_property
    def by_alias(self) -> dict[str, str]:
        return {a.lower(): s for a, s in self.aliases.items()}

    @cached_property
    def no_technology(self) -> frozenset[str]:
        return frozenset(x.lower() for x in self.rejected)

    @cached_property
    def packed(self) -> dict[str, str]:
        """Names and aliases without white space, for names written with other blanks; the first one holds."""
        out: dict[str, str] = {}
        for spelling, name in [*self.standard.items(), *((a, self.canonical(s)) for a, s in self.by_alias.items())]:
            out.setdefault("".join(spelling.split()), name)
        return out

    def canonical(self, name: str | None) -> str:
        """The standard spelling; of an unknown name, itself without blanks around it."""
        n = (name or "").strip()
        n = self.by_alias.get(n.lower(), n)
        return self.standard.get(n.lower(), n)

    def kind_of(self, name: str) -> str | None:
        """T21."""
        return self.corpus.get(self.canonical(name))

    def blocked(self, name: str) -> bool:
        """Whether a name is no technology at all."""
        return self.canonical(name).lower() in self.no_technology

    def _exact(self, name: str) -> str:
        low = name.lower()
        if low in self.standard:
            return name
        return self.canonical(self.by_alias[low]) if low in self.by_alias else self.packed.get("".join(low.split()), "")

    def known(self, name: str) -> str:
        """The standard spelling of a name, or of it without its version; empty if it is not known."""
        n = self.canonical(name)
        bare = re.sub(VERSION, "", n).strip()
        return self._exact(n) or (self._exact(bare) if bare and bare != n else "")

    def resolved(self, name: str) -> list[str]:
        """The whole name, else its parts at / or at -, if all of them stand in the corpus."""
        if (name or "").strip().lower() in self.no_technology:
            return []
        if (n := self.canonical(name)).lower() in self.standard:
            return [n]
        for sign in ("/", "-"):
            parts = [self.canonical(p) for p in (name or "").split(sign)]
            if len(parts) > 1 and all(p.lower() in self.standard for p in parts):
                return list(dict.fromkeys(parts))
        return []

    def similar(self, name: str, most: int = 3, least: float = 0.75) -> list[str]:
        """Standard names that look like a name: a warning, never an identity."""
        return difflib.get_close_matches(name, list(self.corpus), n=most, cutoff=least)


def _on_arrays(f: Callable[[str], list[str]]):
    """An Arrow UDF over arrays of names that calls f once for each distinct name of a batch."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            rows = [() if x is None else x for x in s]
            flat = pd.Series([n for x in rows for n in x], dtype=object)
            codes, names = pd.factorize(flat)
            answers = [f(n) for n in names]
            ends = np.cumsum([len(x) for x in rows])
            yield pd.Series([[a for c in codes[e - len(x) : e] if c >= 0 for a in answers[c]] for x, e in zip(rows, ends, strict=True)], dtype=object)

    return run


class Matcher:
    """Names found in prose: ASCII names first, then Korean ones, each as its standard spelling, once.

    site_terms: further names of a site.  A plain list of names is a dictionary of these alone.
    """

    def __init__(self, dictionary: Dictionary | list[str], aliases: dict[str, str] | None = None, rejected: set[str] = frozenset(), korean: dict[str, str] | None = None, site_terms: list[str] = ()):
        d = dictionary if isinstance(dictionary, Dictionary) else Dictionary(dict.fromkeys(dictionary), aliases or {}, frozenset(), frozenset(rejected), korean or {})
        self.dictionary = d
        never = {x.lower() for x in d.blocklist} | d.no_technology
        names = [n for n in [*site_terms, *d.corpus, *d.aliases] if n.lower() not in never and ASCII_NAME.fullmatch(n) and re.search("[A-Za-z]", n) and (len(n) > 2 or n.lower() in SHORT)]
        self.standard = {n.lower(): d.canonical(n) for n in names}
        longest = sorted(self.standard, key=lambda k: (-len(k), k))
        any_of = "|".join(re.escape(k) + ("[0-9]*" if len(k) >= VERSIONED else "") for k in longest)
        self.pattern = re.compile(rf"(?<![A-Za-z0-9])(?:{any_of})(?![A-Za-z0-9])", re.I) if longest else None
        self.korean = {k: d.canonical(s or k) for k, s in d.korean.items() if not d.blocked(s or k)}
        self.korean_pattern = re.compile("|".join(re.escape(k) for k in sorted(self.korean, key=lambda k: (-len(k), k)))) if self.korean else None

    def find(self, text: str) -> list[str]:
        """A Korean name counts where its word ends: before anything but Hangul, or before a trailer."""
        found: dict[str, str] = {}
        for m in self.pattern.finditer(text) if self.pattern else ():
            hit = m[0].lower()
            if name := self.standard.get(hit) or self.standard.get(hit.rstrip("0123456789")):
                found.setdefault(name.lower(), name)
        for m in self.korean_pattern.finditer(text) if self.korean_pattern else ():
            rest = text[m.end() : m.end() + 3]
            if not ("가" <= rest[:1] <= "힣") or rest.startswith(TRAILERS):
                name = self.korean[m[0]]
                found.setdefault(name.lower(), name)
        return list(found.values())

    def udf(self):
        """X2 as an Arrow UDF: the compiled pattern goes along once per worker, whatever the vocabulary's size."""
        me = self

        @F.pandas_udf(ArrayType(StringType()))
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield s.map(lambda t: me.find(t) if t else [])

        return find

    def keep_known(self, names: Column) -> Column:
        """The standard spellings of the names known, each once."""
        d = self.dictionary
        return distinct_ci(_on_arrays(lambda n: [k] if (k := d.known(n)) else [])(names))

    def unknown(self, names: Column) -> Column:
        """The names no dictionary knows, as they stand."""
        d = self.dictionary
        return _on_arrays(lambda n: [n] if n and n.strip() and not d.known(n) else [])(names)

    def look_alikes(self, names: Column) -> Column:
        """Standard names that look like some names, each once: what a report warns of."""
        return F.array_distinct(_on_arrays(self.dictionary.similar)(names))

    def resolved(self, names: Column) -> Column:
        """X7 over an array of tags."""
        d = self.dictionary
        return F.array_distinct(_on_arrays(d.resolved)(names))

    def unresolved(self, names: Column) -> Column:
        """The tags to look at: neither resolved nor rejected."""
        d = self.dictionary
        return F.array_distinct(_on_arrays(lambda n: [n] if d.canonical(n) and not d.resolved(n) and n.strip().lower() not in d.no_technology else [])(names))

    def tags(self, names: Column) -> Column:
        """X5 for sites with a code table: standard spellings of all tags but rejected ones, whether known or not."""
        d = self.dictionary
        return distinct_ci(_on_arrays(lambda n: [c] if (c := d.canonical(n)) and not d.blocked(n) else [])(names))

    def clean(self, techs: Column) -> Column:
        """X8."""
        return F.array_join(self.keep_known(split_names(techs)), ", ")


def corpus_matcher(dictionary: Dictionary) -> Matcher:
    """The matcher of sites without names of their own."""
    return Matcher(dictionary)


def extract(df: DataFrame, matcher: Matcher, tags: Column | str | None, *texts: str) -> DataFrame:
    """Skills from tags that are already standard names, then from prose, each once."""
    prose = matcher.udf()(F.concat_ws("\n", *texts))
    given = F.coalesce(F.col(tags) if isinstance(tags, str) else tags, F.array().cast("array<string>")) if tags is not None else F.array().cast("array<string>")
    return df.withColumn("skills", distinct_ci(F.filter(F.concat(given, prose), lambda x: x != "")))


def plain_names(c: Column, names: list[str]) -> Column:
    """Names that stand in a text as whole words, in the order given: JVM-side, for small vocabularies."""
    from ..functions.rules import hits, words

    return hits(c, words(names))


def candidate_names(observed: DataFrame, matcher: Matcher, examples: int = 3) -> DataFrame:
    """Names that cannot be resolved, with how often and where they were seen and `examples` addresses: the first by
    their order in the alphabet.  observed: name, site, example, seen.  No group is collected whole: an aggregate over
    (name, site) and (name, example) pairs keeps a count and the least addresses.
    """
    new = observed.withColumn("n_", matcher.unresolved(F.array("name"))).where(F.size("n_") > 0).drop("n_")
    facts = new.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"))
    sites = new.select("name", "site").distinct().groupBy("name").agg(F.array_sort(F.collect_list("site")).alias("sites"))  # a row a site
    least = None  # the least address, then the least after it, and so on
    given = new.select("name", "example").where(F.coalesce("example", F.lit("")) != "").distinct()
    rest = given
    for k in range(examples):
        one = rest.groupBy("name").agg(F.min("example").alias("example"))
        least = one.withColumn("k", F.lit(k)) if least is None else least.unionByName(one.withColumn("k", F.lit(k)))
        rest = rest.join(one.withColumnRenamed("example", "taken"), "name").where(F.col("example") > F.col("taken")).drop("taken")
    seen = least.groupBy("name").agg(F.array_sort(F.collect_list("example")).alias("examples"))  # at most `examples` rows
    return facts.join(sites, "name").join(seen, "name", "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>"))).select("name", "n", "sites", "examples", "first_seen", "last_seen").orderBy(F.col("n").desc(), F.lower("name"))
