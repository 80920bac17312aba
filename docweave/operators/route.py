"""One routed extraction (H16, X1): links split by extractor kind, one document schema.

Links meet their stored pages once; the result is written partitioned by extractor kind, so
every extractor reads its own links' pages and nothing else.  An extractor is a function
``(links, inputs) -> parts``: ``links`` are (seq, link, html) of its kind (html null where no page is
stored), ``parts`` one row per link with the columns of :data:`PARTS` (missing ones are null).
Callers add kinds with :meth:`Extractors.adding`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions import urls as U
from ..session import saved
from ..sources import feeds as FD
from ..sources import repos as R
from . import extract as X
from .documents import route_extractor

PARTS = {
    "seq": "bigint", "link": "string", "title": "string", "content": "string", "tags": "array<string>", "published_at": "timestamp",
    "published_date": "date", "platform": "string", "source": "string", "raw_metadata": "map<string,string>", "failure": "string",
}
NO_PAGE = "page not stored"


@dataclass(frozen=True)
class Inputs:
    """What a run reads: stored pages (url, html), feed documents (feed_url, feed_pos, xml), and repository
    files (repo: the repository's link, file_id, path, size_bytes, text)."""

    pages: DataFrame
    feeds: DataFrame | None = None
    repo_files: DataFrame | None = None


def as_parts(df: DataFrame) -> DataFrame:
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in PARTS.items()])


def without_page(links: DataFrame) -> DataFrame:
    return as_parts(links.filter("html IS NULL").select("seq", "link", F.lit(NO_PAGE).alias("failure")))


def article(links: DataFrame, inputs: Inputs) -> DataFrame:
    made = X.article_records(links.filter("html IS NOT NULL")).withColumnRenamed("challenge_reason", "failure")
    return as_parts(made).unionByName(without_page(links))


def job(links: DataFrame, inputs: Inputs) -> DataFrame:
    return as_parts(X.job_records(links.filter("html IS NOT NULL"))).unionByName(without_page(links))


def feed_article(links: DataFrame, inputs: Inputs) -> DataFrame:
    """The article's entry in its feed (L13, H11), else its rendered page.

    Feeds that no link asks for are dropped by their key before any XML is read."""
    if inputs.feeds is None:
        matched, rest = None, links
    else:
        asked = links.select(U.feed_url_for_article("link").alias("feed_url")).filter("feed_url IS NOT NULL").distinct()
        items = FD.feed_items(inputs.feeds.join(asked, "feed_url", "left_semi"), feed_url=F.col("feed_url"))
        looked = FD.lookup_entries(links, items)
        matched, rest = looked.filter("feed_url IS NOT NULL"), looked.filter("feed_url IS NULL").select("seq", "link", "html")
    rendered = X.rendered_article_records(rest.filter("html IS NOT NULL")).withColumnRenamed("challenge_reason", "failure")
    out = as_parts(rendered).unionByName(without_page(rest))
    return out if matched is None else out.unionByName(as_parts(FD.feed_documents(matched.drop("html"))))


def repository(links: DataFrame, inputs: Inputs) -> DataFrame:
    """The README of the link's repository (S7, H13); files of other repositories are dropped by key first."""
    if inputs.repo_files is None:
        readmes = links.select("seq", "link", F.lit(None).cast("string").alias("readme"), F.lit(None).cast("string").alias("readme_path"))
    else:
        asked = links.select(F.col("link").alias("repo")).distinct()
        found = R.readme_pick(inputs.repo_files.join(asked, "repo", "left_semi"))
        readmes = links.select("seq", "link").join(found.withColumnRenamed("repo", "_repo"), F.col("link") == F.col("_repo"), "left").drop("_repo")
    made = R.repository_records(readmes)
    return as_parts(made.withColumnsRenamed({"seed_tags": "tags", "error_reason": "failure"}))


Extractor = Callable[[DataFrame, Inputs], DataFrame]


@dataclass(frozen=True)
class Extractors:
    """Extractors by kind, and which host has which kind; other hosts are articles."""

    functions: dict[str, Extractor] = field(default_factory=lambda: {
        "article": article, "job": job, "feed_article": feed_article, "repository": repository})
    hosts: tuple[tuple[str, str], ...] = D.EXTRACTOR_HOSTS

    def adding(self, kind: str, function: Extractor, hosts: tuple[str, ...]) -> Extractors:
        return replace(self, functions={**self.functions, kind: function}, hosts=(*((h, kind) for h in hosts), *self.hosts))


def extract_links(links: DataFrame, inputs: Inputs, extractors: Extractors = Extractors()) -> DataFrame:
    """Document parts (see PARTS) of every link (seq, link), each by its kind's extractor.

    Of several pages stored under one URL the smallest text counts, so a link is one row."""
    pages = inputs.pages.groupBy(F.col("url").alias("link")).agg(F.min("html").alias("html"))
    routed = links.select("seq", "link", route_extractor("link", extractors.hosts).alias("kind")).join(pages, "link", "left")
    stored = saved(routed.select("seq", "link", "html", "kind"), partition_by="kind")
    made = [function(stored.filter(F.col("kind") == kind).drop("kind"), inputs) for kind, function in extractors.functions.items()]
    return reduce(DataFrame.unionByName, made)
