"""HTML to text (T1-T9, F20, F25).  Balanced tags need a scan, so visible text comes from an Arrow UDF that parses a page once."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import quote, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Elements without an end tag, elements that break lines, styles that hide, the container of a posting's body,
# images' addresses of two sites and a site's own pictures, what stays as it is in an address, and least lengths of bodies.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = "p div br hr li tr h1 h2 h3 h4 h5 h6 ul ol table thead tbody section article header footer blockquote pre dt dd".split()
HIDDEN = [r"display:none", r"visibility:hidden", r"font-size:0(?![.\d])", r"opacity:0(?![.\d])"]
ZERO_BOX = [r"(?<!max-)(?<!min-)width:0(?![.\d])", r"(?<!max-)(?<!min-)height:0(?![.\d])"]
CONTAINER = r'<div class="user_content jobsViewDetail_(\d+)">'
IMAGE = r"<img[^>]*?src\s*=\s*[\"']([^\"']+)[\"']"
IMAGE_JOBKOREA = r"<img[^>]*?src\s*=\s*[\"']([^\"'“”‘’]+)"
OWN_PICTURE = r"//i\.jobkorea\.kr/content/images/"
ORIGIN, ORIGIN_JOBKOREA = "https://www.saramin.co.kr", "https://www.jobkorea.co.kr"
PATH_SAFE = "/%!$&'()*+,;=:@"
LEAST_BODY, LEAST_BODY_JOBKOREA = 100, 200

_TAG = re.compile(r"<(/?)([a-zA-Z][\w-]*)\b([^>]*)>")
_STYLE = re.compile(r"(?:^|\s)style\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_CODE = re.compile(r"<(script|style)\b.*?</\1>", re.S | re.I)
_COMMENT, _ANY, _UNCLOSED = re.compile(r"<!--.*?-->", re.S), re.compile(r"<[^>]+>"), re.compile(r"<[a-zA-Z/!][^>]*$")
_BREAK = re.compile(rf"</?(?:{'|'.join(BLOCKS)})\b[^>]*>", re.I)


def hidden_style(style: str) -> bool:
    """T2."""
    s = style.lower().replace(" ", "")
    return any(re.search(p, s) for p in HIDDEN) or all(re.search(p, s) for p in ZERO_BOX)


def split_visible(source: str) -> tuple[str, str]:
    """(visible, hidden) markup without comments; a hidden element that never ends hides the rest."""
    source = without_comments(source)
    seen, unseen, at, owner, depth, since = [], [], 0, None, 0, 0
    for m in _TAG.finditer(source):
        name, single = m[2].lower(), m[2].lower() in VOID or m[3].rstrip().endswith("/")
        if owner is None:
            style = None if m[1] or single else _STYLE.search(m[3])
            if style and hidden_style(style[1] or style[2] or ""):
                seen.append(source[at : m.start()])
                since, depth, owner = m.start(), 1, name
        elif name == owner and not m[3].rstrip().endswith("/"):
            depth += -1 if m[1] else 1
            if not depth:
                unseen.append(source[since : m.end()])
                at, owner = m.end(), None
    (seen if owner is None else unseen).append(source[at if owner is None else since :])
    return "".join(seen), "".join(unseen)


def without_comments(source: str) -> str:
    return _COMMENT.sub("", source) if "<!--" in source else source


def without_code(source: str) -> str:
    return _CODE.sub(" ", source)


def to_text(source: str) -> str:
    """T4."""
    s = _ANY.sub(" ", _UNCLOSED.sub(" ", without_code(without_comments(source))))
    return " ".join(html.unescape(s).split())


def to_lines(visible: str) -> str:
    """T6, from markup of which hidden parts are gone."""
    s = html.unescape(_ANY.sub(" ", _BREAK.sub("\n", without_code(visible))))
    return re.sub(r"\n{2,}", "\n", "\n".join(x.strip() for x in re.sub(r"[^\S\n]+", " ", s).split("\n"))).strip()


def balanced(source: str, container: str = CONTAINER) -> str:
    """From the tag that matches `container` to its end tag, or the end of the text; empty without one."""
    m = re.search(container, source)
    if not m:
        return ""
    depth = 0
    for t in re.finditer(r"<(/?)div\b[^>]*?(/?)>", source[m.start() :]):
        if not t[2]:
            depth += -1 if t[1] else 1
            if not depth:
                return source[m.start() : m.start() + t.end()]
    return source[m.start() :]


def _parse(source: str | None, container: str | None, code_first: bool) -> tuple[str, str, str]:
    s = source or ""
    s = balanced(s, container) if container else without_code(s) if code_first else s
    visible, hidden = split_visible(s)
    return to_text(visible), to_lines(visible), to_text(hidden)


def visible(container: str | None = None, code_first: bool = False):
    """T5-T8 as one Arrow UDF: struct(text, lines, hidden) of a page, of the container in it, or of it without code."""

    @F.pandas_udf("text string, lines string, hidden string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield pd.DataFrame([_parse(x, container, code_first) for x in s], columns=["text", "lines", "hidden"], dtype=object)

    return run


def visible_text(c: Column) -> Column:
    """T5."""
    return visible()(c)["text"]


def visible_lines(c: Column) -> Column:
    """T6."""
    return visible()(c)["lines"]


def looks_like_image(text: Column, least: int = LEAST_BODY) -> Column:
    """whether a body has too little text to be read (`least` differs by site)."""
    return F.length(F.coalesce(text, F.lit(""))) < least


def plain_text(c: Column) -> Column:
    """T1 and T4 without entities and hidden elements: JVM-side."""
    s = F.regexp_replace(c, r"(?s)<!--.*?-->", "")
    s = F.regexp_replace(s, r"(?is)<(script|style)\b.*?</\1>", " ")
    s = F.regexp_replace(s, r"<[a-zA-Z/!][^>]*$", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(s, r"<[^>]+>", " "), r"(?U)\s+", " "), r"^ | $", "")


def _address(url: str, origin: str) -> str:
    url = "https:" + url if url.startswith("//") else origin + url if url.startswith("/") else url
    p = urlsplit(url)
    return urlunsplit((p.scheme, p.netloc, quote(p.path, safe=PATH_SAFE), quote(p.query, safe=PATH_SAFE + "?"), p.fragment))


def image_urls(c: Column, origin: str = ORIGIN) -> Column:
    """Image sources, absolute and safe, in order, once each: no inline data, and of one site no name without a dot."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"(?i){IMAGE}"), F.lit(1))
    real = F.filter(found, lambda u: ~u.startswith("data:") & F.regexp_replace(u, "^.*/", "").contains("."))
    return F.array_distinct(safe_urls(origin)(real))


def image_urls_jobkorea(c: Column) -> Column:
    """T9 of the other site, which puts its own pictures into bodies."""
    found = F.regexp_extract_all(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " "), F.lit(f"(?i){IMAGE_JOBKOREA}"), F.lit(1))
    urls = safe_urls(ORIGIN_JOBKOREA)(F.filter(found, lambda u: ~u.startswith("data:")))
    return F.array_distinct(F.filter(urls, lambda u: ~u.rlike(f"(?i){OWN_PICTURE}")))


def safe_urls(origin: str):
    """Absolute addresses in which what may not stand in an address is percent-encoded; escapes stay."""

    @F.pandas_udf(ArrayType(StringType()))
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda a: [_address(u, origin) for u in a] if a is not None else None)

    return run
