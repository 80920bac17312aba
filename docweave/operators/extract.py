"""Page extraction: HTML string -> document columns (H1-H18), all native expressions.

Elements are found by patterns over the page with scripts, styles and comments removed;
an element's inside ends where the opening and closing tags of its name balance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import dictionaries as D
from ..functions import text as T
from ..functions import urls as U
from .common import fence
from .discover import INERT_MARKUP

bound = T.bound
ATTR = r"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def attr_value(tag: Column, name: str) -> Column:
    pat = "(?is)" + ATTR.format(name=name)
    return F.concat(F.regexp_extract(tag, pat, 1), F.regexp_extract(tag, pat, 2), F.regexp_extract(tag, pat, 3))


def _meta_tag(html: Column, attr: str, value: str) -> Column:
    """First ``<meta ... attr="value" ...>`` tag ('' when none)."""
    pat = rf"""(?is)<meta\b[^>]*\s{attr}\s*=\s*(?:"{value}"[^>]*|'{value}'[^>]*|{value}(?:[\s/][^>]*)?)>"""
    return F.regexp_extract(html, pat, 0)


def meta_content(html: Column, attr: str, value: str) -> Column:
    """content of the first matching meta tag: null when absent or empty,
    else entity-decoded and stripped (may become '')."""
    content = bound(_meta_tag(html, attr, value), lambda tag: attr_value(tag, "content"))
    return bound(content, lambda c: F.when(c != "", T.strip_ws(T.html_unescape(c))))


def element_text(html: Column, tag: str) -> Column:
    """``get_text(" ", strip=True)`` of the first ``<tag>`` element: text
    pieces between markup, stripped, blanks dropped, joined by a space."""
    inner = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    pieces = F.filter(F.transform(F.split(inner, "<[^>]*>"), lambda x: T.strip_ws(T.html_unescape(x))),
                      lambda x: x != "")
    return F.array_join(pieces, " ")


def title(html: Column) -> Column:
    """H1: og:title, twitter:title, <title>, <h1>: first present (null if none)."""
    return F.coalesce(meta_content(html, "property", "og:title"), meta_content(html, "name", "twitter:title"),
                      bound(element_text(html, "title"), T.nullif_empty), bound(element_text(html, "h1"), T.nullif_empty))


def description(html: Column) -> Column:
    """H2: meta description, else og:description."""
    return F.coalesce(meta_content(html, "name", "description"), meta_content(html, "property", "og:description"))


def keyword_tags(html: Column) -> Column:
    """H4: meta keywords split on commas, trimmed, lower-cased, blanks dropped."""
    kw = meta_content(html, "name", "keywords")
    parts = F.transform(F.split(F.coalesce(kw, F.lit("")), ","), lambda x: F.lower(T.strip_ws(x)))
    return F.filter(parts, lambda x: x != "")


_TIME_SOURCES = (
    (r"(?is)<meta\b[^>]*\sproperty\s*=\s*[\"']?article:published_time[\"']?[^>]*>", "content"),
    (r"(?is)<meta\b[^>]*\sname\s*=\s*[\"']?article:published_time[\"']?[^>]*>", "content"),
    (r"(?is)<meta\b[^>]*\sname\s*=\s*[\"']?publish_date[\"']?[^>]*>", "content"),
    (r"(?is)<time\b[^>]*\sdatetime\s*=[^>]*>", "datetime"),
)


def published_raw(html: Column) -> Column:
    """H5: first parseable raw time among all matches, selector order first."""
    cands = []
    for pat, _ in _TIME_SOURCES:
        tags = F.regexp_extract_all(html, F.lit(pat), F.lit(0))
        cands.append(F.transform(tags, lambda t: F.coalesce(
            F.nullif(attr_value(t, "content"), F.lit("")), F.nullif(attr_value(t, "datetime"), F.lit("")))))
    allc = F.concat(*cands)
    return F.try_element_at(F.filter(allc, lambda v: DT.parse_datetime(v).isNotNull()), F.lit(1))


def markup_text(html: Column, joiner: str = "\n", markup: str = "<[^>]*>") -> Column:
    """Text pieces between tags, entity-decoded and stripped, blank ones dropped, joined."""
    pieces = F.transform(F.split(html, markup), lambda x: T.strip_ws(T.html_unescape(x)))
    return F.array_join(F.filter(pieces, lambda x: x != ""), joiner)


def native_text(html: Column) -> Column:
    """Text of the whole page, one line per text piece (scripts, styles and comments dropped)."""
    no_inert = F.regexp_replace(html, INERT_MARKUP, "\n")
    return T.normalize_content(T.html_unescape(F.regexp_replace(no_inert, "<[^>]*>", "\n")))


def element_pattern(tag: str, condition: str = "") -> str:
    """Pattern of an element's opening tag; ``condition`` is an attribute pattern that it must contain."""
    return rf"(?is)<{tag}(?=[\s/>])[^>]*\s{condition}[^>]*>" if condition else rf"(?is)<{tag}(?=[\s/>])[^>]*>"


#: Tag part of a pattern of any element, and the elements that have no inside.
ANY = r"[a-z][\w:.-]*"
VOID = "(?i)^<(?:area|base|br|col|embed|hr|img|input|link|meta|param|source|track|wbr)(?=[\\s/>])"


def equals(name: str, value: str) -> str:
    """Attribute pattern: the attribute has this value."""
    return rf"""{name}\s*=\s*(?:"{value}"|'{value}'|{value}(?=[\s/>]))"""


def _inside(page: Column, closed: bool = False) -> Column:
    """Inside of the element whose opening tag starts ``page``: up to where the tags of its name balance.

    An element that is never closed reaches to the end (null if ``closed``); ``<tag/>`` is empty."""
    def step(acc, mark):
        depth = acc["depth"] + F.when(mark.startswith("</"), -1).when(mark.rlike("^<[^>]*/>"), 0).otherwise(1)
        return F.when(acc["depth"] == 0, acc).otherwise(
            F.struct(depth.alias("depth"), (acc["marks"] + F.when(depth == 0, 0).otherwise(1)).alias("marks")))

    def upto(marks):
        start = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("marks"))
        end = F.when(F.coalesce(F.get(marks, F.lit(1)).startswith("</"), F.lit(False)), F.struct(F.lit(0).alias("depth"), F.lit(1).alias("marks")))
        return bound(end.otherwise(F.aggregate(F.slice(marks, 2, F.size(marks)), start, step)), lambda e: F.when(
            (e["depth"] == 0) | F.lit(not closed), F.regexp_replace(F.array_join(F.slice(marks, 1, e["marks"]), ""), "^<[^>]*>", "")))

    name = F.regexp_extract(page, r"^<([\w:.-]+)", 1)
    marks = F.split(page, F.concat(F.lit(r"(?i)(?=</?\Q"), name, F.lit(r"\E[\s/>])")))
    return F.when(page.rlike("^<[^>]*/>") | page.rlike(VOID), F.lit("")).otherwise(bound(marks, upto))


def element(html: Column, pattern: str) -> Column:
    """Inside of the first element whose opening tag matches; null when there is none."""
    return bound(F.regexp_extract(html, pattern + ".*", 0), lambda page: F.when(page != "", _inside(page)))


def elements(html: Column, pattern: str) -> Column:
    """Insides of all elements whose opening tags match, in page order, nested ones too."""
    def inner(parts):
        return F.array_compact(F.transform(parts, lambda part, i: F.when(part.rlike("^" + pattern), F.coalesce(
            _inside(part, closed=True), bound(F.array_join(F.slice(parts, i + 1, F.size(parts)), ""), lambda page: _inside(page))))))

    return bound(F.split(html, f"(?={pattern})"), inner)


def with_class(*names: str) -> str:
    """Attribute pattern: the class list holds all the names, in any order."""
    return "".join(rf"""(?=class\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'])""" for name in names) + "class"


#: H3: where the main text is looked for, in this order; else in the body.
MAIN_REGIONS = (element_pattern("article"), element_pattern("main"), element_pattern(ANY, equals("role", "main")))
BODY = r"(?is)<body\b[^>]*>(.*)"


def main_text(html: Column) -> Column:
    """H3: text lines of the first article, main, role=main element or body; else of the whole page."""
    plain = F.regexp_replace(html, INERT_MARKUP, "\n")
    region = F.coalesce(*[element(plain, p) for p in MAIN_REGIONS], F.when(plain.rlike(BODY), F.regexp_extract(plain, BODY, 1)), plain)
    return T.normalize_content(T.html_unescape(F.regexp_replace(region, "<[^>]*>", "\n")))


def first_text(html: Column, patterns: tuple[str | tuple[str, str], ...]) -> Column:
    """H6: text (pieces joined by a space) of the first pattern whose first match has any.

    A pair of patterns stands for the first element of the second kind inside one of the first kind."""
    def first(p):
        if isinstance(p, str):
            return element(html, p)
        return F.get(F.array_compact(F.transform(elements(html, p[0]), lambda outer: element(outer, p[1]))), F.lit(0))

    return F.coalesce(*[bound(markup_text(first(p), " "), T.nullif_empty) for p in patterns])


def joined_text(html: Column, patterns: tuple[str, ...]) -> Column:
    """H7: texts of all matches of the patterns, each once, one per line."""
    found = F.concat(*[elements(html, p) for p in patterns])
    texts = F.transform(found, lambda x: markup_text(x, " "))
    return F.array_join(F.filter(F.array_distinct(texts), lambda x: x != ""), "\n")


PAGE_FIELDS = {"html_title": title, "description": description, "tags": keyword_tags, "published_raw": published_raw}


def page_fields(pages: DataFrame, html: str = "html", plain: str | None = None, fields: tuple[str, ...] = tuple(PAGE_FIELDS)) -> DataFrame:
    """H1, H2, H4, H5 and the publish times, all native; one fenced stage.

    ``plain``: a column with the page without inert markup, made here if not given.  ``fields``: those that the
    caller reads, as a fenced field is computed whether it is read or not."""
    out = pages if plain else pages.withColumn("_h", F.regexp_replace(F.col(html), INERT_MARKUP, " "))
    out = out.withColumns({f: PAGE_FIELDS[f](F.col(plain or "_h")) for f in fields})
    out = out if plain else out.drop("_h")
    made = list(fields)
    if "published_raw" in fields:
        out = out.withColumns({"published_at": DT.parse_datetime("published_raw"), "published_date": DT.local_date("published_raw")})
        made += ["published_at", "published_date"]
    return fence(out, made)


def without_inert(pages: DataFrame, html: str = "html") -> DataFrame:
    """``_plain``: the page without inert markup, fenced, so every pattern reads one string."""
    return fence(pages.withColumn("_plain", F.regexp_replace(F.col(html), INERT_MARKUP, " ")), ["_plain"])


def challenge_reason(text: Column) -> Column:
    """P3 as the error reason of a document."""
    return bound(F.lower(text), lambda lower: F.when(
        T.contains_any(lower, D.CHALLENGE_PHRASES) | (lower.contains(D.CHALLENGE_PAIR[0]) & lower.contains(D.CHALLENGE_PAIR[1])),
        F.lit("bot_protection_challenge")))


def article_records(pages: DataFrame, link: str = "link", html: str = "html") -> DataFrame:
    """H9 (+P3): article document parts from a stored page.

    title (fallback: the link), content = description + blank line + main
    text (H3), platform = source = host.  ``challenge_reason``: the error of a
    bot-challenge page, by the text of the whole page, as its marks may lie outside the main text."""
    f = page_fields(pages, html).withColumns({
        "_text": main_text(F.col(html)),
        "challenge_reason": challenge_reason(markup_text(F.col(html), " ", f"{INERT_MARKUP}|<[^>]*>"))})
    f = fence(f, ["_text", "challenge_reason"])
    parts = F.array_compact(F.array(F.nullif(F.col("description"), F.lit("")), F.nullif(F.col("_text"), F.lit(""))))
    return f.select(
        *[c for c in pages.columns if c != html],
        F.coalesce(F.nullif(F.col("html_title"), F.lit("")), F.col(link)).alias("title"),
        F.array_join(parts, "\n\n").alias("content"),
        "tags", "published_at", "published_date",
        U.host(link).alias("platform"), U.host(link).alias("source"),
        F.create_map(F.lit("description"), F.col("description")).alias("raw_metadata"),
        "challenge_reason",
    )


# The elements of job pages, by field, in order of preference.
JOB_TITLE = (element_pattern("h1", with_class("top-card-layout__title")), element_pattern("h1", with_class("topcard__title")),
             element_pattern("h1"))
JOB_COMPANY = (element_pattern("a", with_class("topcard__org-name-link")), element_pattern("span", with_class("topcard__flavor")),
               (element_pattern("div", with_class("topcard__flavor-row")), element_pattern("span")))
JOB_LOCATION = (element_pattern("span", with_class("topcard__flavor--bullet")),)
JOB_DESCRIPTION = (element_pattern("div", with_class("show-more-less-html__markup")),
                   element_pattern("section", with_class("show-more-less-html")), element_pattern("div", with_class("description__text")))
JOB_CRITERIA = (element_pattern("li", with_class("description__job-criteria-item")),
                element_pattern("span", with_class("description__job-criteria-text")))
README_BLOCKS = (element_pattern("article", with_class("markdown-body")), element_pattern("div", with_class("markdown-body")),
                 element_pattern(ANY, equals("id", "readme")))
# One pattern of both kinds of topic links, so they come in page order.
TOPIC_TAGS = (r"(?is)<a(?=[\s/>])(?:(?=[^>]*\s" + with_class("topic-tag") + r")|(?=[^>]*\s" + equals("data-view-component", "true")
              + r""")(?=[^>]*\shref\s*=\s*(?:"[^">]*/topics/|'[^'>]*/topics/|[^\s"'>]*/topics/)))[^>]*>""",)


def job_records(pages: DataFrame, link: str = "link", html: str = "html") -> DataFrame:
    """H8 (+H6, H7): job document parts: labelled lines, criteria and description."""
    f = page_fields(without_inert(pages, html), html, "_plain", ("html_title", "published_raw")).withColumns({
        "_first": first_text(F.col("_plain"), JOB_TITLE), "_company": first_text(F.col("_plain"), JOB_COMPANY),
        "_location": first_text(F.col("_plain"), JOB_LOCATION), "_about": first_text(F.col("_plain"), JOB_DESCRIPTION),
        "_criteria": joined_text(F.col("_plain"), JOB_CRITERIA)})
    f = fence(f, ["_first", "_company", "_location", "_about", "_criteria"])
    title = F.coalesce("_first", T.nullif_empty("html_title"), F.col(link))
    parts = F.array_compact(F.array(
        F.concat(F.lit("Job title: "), title), F.concat(F.lit("Company: "), F.col("_company")),
        F.concat(F.lit("Location: "), F.col("_location")), F.nullif(F.col("_criteria"), F.lit("")), F.col("_about")))
    return f.select(
        *[c for c in pages.columns if c != html], title.alias("title"), F.array_join(parts, "\n\n").alias("content"),
        F.array_compact(F.array("_company", "_location")).alias("tags"), "published_at", "published_date",
        F.lit("linkedin").alias("platform"), F.lit("linkedin").alias("source"),
        F.create_map(F.lit("company"), F.col("_company"), F.lit("location"), F.col("_location")).alias("raw_metadata"))


def rendered_article_records(pages: DataFrame, link: str = "link", html: str = "html") -> DataFrame:
    """H12 (+P3): rendered feed-host page: title = first h1, else the page title, else the link;
    content = first h2 + blank line + whole page text; challenge pages become errors."""
    f = page_fields(without_inert(pages, html), html, "_plain", ("html_title", "tags", "published_raw")).withColumns({
        "_h1": first_text(F.col("_plain"), (element_pattern("h1"),)), "_h2": first_text(F.col("_plain"), (element_pattern("h2"),)),
        "_text": native_text(F.col(html))})
    f = fence(f, ["_h1", "_h2", "_text"])
    parts = F.array_compact(F.array(F.col("_h2"), F.nullif(F.col("_text"), F.lit(""))))
    content = F.array_join(parts, "\n\n")
    return f.select(
        *[c for c in pages.columns if c != html],
        F.coalesce("_h1", T.nullif_empty("html_title"), F.col(link)).alias("title"), content.alias("content"),
        "tags", "published_at", "published_date", F.lit("medium").alias("platform"), F.lit("medium").alias("source"),
        F.create_map(F.lit("subtitle"), F.col("_h2")).alias("raw_metadata"), challenge_reason(content).alias("challenge_reason"))


def repository_page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """README block text and topic tags of a repository page."""
    plain = F.regexp_replace(F.col(html), INERT_MARKUP, " ")
    block = F.coalesce(*[element(plain, p) for p in README_BLOCKS])
    topics = F.concat(*[elements(plain, p) for p in TOPIC_TAGS])
    out = pages.withColumns({
        "readme": F.coalesce(markup_text(block), F.lit("")),
        "topics": F.filter(F.array_distinct(F.transform(topics, lambda x: F.lower(markup_text(x, " ")))), lambda x: x != "")})
    return fence(out, ["readme", "topics"])
