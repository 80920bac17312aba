"""Link discovery over stored listing pages.

Every step is a column expression or a window over (category, source,
position): order is carried explicitly in columns, never taken from
partition order.  Quotas and caps are literals (five categories); a top-k window is
first cut at the largest of them, so it plans as WindowGroupLimit and each map task keeps
at most that many rows per group before the shuffle, whatever the size of a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dictionaries as D
from ..functions import text as T
from ..functions import urls as U
from ..session import saved
from ..sources import feeds as FD
from .common import fence

# Markup whose text is not part of the document tree (comments, scripts, styles).
INERT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR_TAG = r"(?is)<a\b[^>]*>"


def _attr(tag: Column, name: str) -> tuple[Column, Column]:
    """(present, value) of an attribute of one start tag (any quoting)."""
    pat = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = F.concat(F.regexp_extract(tag, pat, 1), F.regexp_extract(tag, pat, 2), F.regexp_extract(tag, pat, 3))
    return tag.rlike(rf"(?is)\s{name}\s*="), T.html_unescape(value)


def anchors(df: DataFrame, html: str = "html") -> DataFrame:
    """L1: every ``a[href]`` in document order as (pos, href, anchor_class).

    Comments, scripts and styles are removed first (their text is not
    markup); hrefs are entity-decoded and trimmed.  Native: a regex and a
    posexplode, no UDF.
    """
    tags = F.regexp_extract_all(F.regexp_replace(F.col(html), INERT_MARKUP, " "), F.lit(ANCHOR_TAG), F.lit(0))
    out = df.select(*[c for c in df.columns if c != html], F.posexplode(tags).alias("pos", "_tag"))
    has_href, href = _attr(F.col("_tag"), "href")
    _, cls = _attr(F.col("_tag"), "class")
    return (out.filter(has_href)
            .withColumns({"href": T.strip_ws(href), "anchor_class": cls})
            .drop("_tag"))


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per key in ``order`` (not dropDuplicates,
    which keeps an arbitrary one)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_k(df: DataFrame, group: list[str], order: list[str], k, name: str = "rank", most: int | None = None) -> DataFrame:
    """First k rows per group in ``order``.  ``k`` is a number, or a column with its largest value ``most``:
    the literal cut is what reaches the map tasks, the column's cut follows it."""
    df = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    if isinstance(k, int):
        return df.filter(F.col(name) <= k)
    return df.filter((F.col(name) <= most) & (F.col(name) <= k))


def by_category(values: dict[str, int], category="category") -> Column:
    """A category's number as a CASE over literals (null for other categories)."""
    out = F.lit(None).cast("int")
    for name, value in values.items():
        out = F.when(F.col(category) == name, F.lit(value)).otherwise(out)
    return out


def quotas(max_links: int | None = D.MAX_LINKS, min_per_category: int = D.MIN_PER_CATEGORY) -> dict[str, int]:
    """Per-category quota; extras go round-robin in the fixed order
    (closed form: min + extra // 5 + (rank < extra % 5))."""
    cats = D.DISCOVERY_CATEGORY_ORDER
    extra = discovery_target(max_links, min_per_category) - min_per_category * len(cats)
    return {c: min_per_category + extra // len(cats) + (1 if i < extra % len(cats) else 0) for i, c in enumerate(cats)}


def discovery_target(max_links: int | None = D.MAX_LINKS, min_per_category: int = D.MIN_PER_CATEGORY) -> int:
    return max(max_links or D.MAX_LINKS, min_per_category * len(D.DISCOVERY_CATEGORY_ORDER))


def source_registry(spark: SparkSession, links: dict[str, tuple[str, ...]] = D.CURATED_SOURCE_LINKS) -> DataFrame:
    """The registry as a table (category, source_pos, source_url), in order."""
    return spark.createDataFrame([(c, i, url) for c, urls in links.items() for i, url in enumerate(urls)],
                                 "category string, source_pos long, source_url string")


def resolve_hrefs(a: DataFrame, base: str) -> DataFrame:
    """L2 -> U2: ``link`` = normalised absolute URL of ``href``.

    ``base``: a URL literal or a column name.  ``link`` is fenced, so the predicates that follow
    read it as a plain column.
    """
    joined = a.withColumn("_abs", U.urljoin_sql(U.base_sql(base), "href"))
    return fence(joined.withColumn("link", U.normalize_link("_abs")).drop("_abs"), ["link"])


def same_host_links(sources: DataFrame, limit, min_depth: int = 2) -> DataFrame:
    """L3: per source page, same-host content links, first-wins distinct, first ``limit``.

    ``sources``: (category, source_pos, source_url, html).  ``limit`` is an
    int or a column (per-source limits).  All in the page's row: the anchors are an array, links that pass
    are taken one by one until there are enough, so nothing is shuffled.
    """
    tags = F.regexp_extract_all(F.regexp_replace("html", INERT_MARKUP, " "), F.lit(ANCHOR_TAG), F.lit(0))

    def href(tag: Column) -> Column:
        present, value = _attr(tag, "href")
        return F.when(present, T.strip_ws(value))

    pages = sources.withColumn("_hrefs", F.transform(tags, href)).drop("html")
    link = U.let("j0_", U.urljoin_text("`source_url`", "h0_"), U.normalize_text("j0_"))
    pages = pages.withColumn("_links", F.expr(f"transform(_hrefs, h0_ -> CASE WHEN h0_ IS NOT NULL THEN {link} END)")).drop("_hrefs")
    placed = F.transform("_links", lambda x, i: F.struct(i.alias("pos"), x.alias("link")))
    base = F.col("source_url")
    passing = F.filter(placed, lambda x: x["link"].isNotNull() & U.is_http_url(x["link"]) & U.same_host(base, x["link"])
                       & U.is_likely_content_link(base, x["link"], min_depth))
    k = F.lit(limit) if isinstance(limit, int) else limit
    taken = F.aggregate(passing, F.array().cast("array<struct<pos: int, link: string>>"), lambda acc, x: F.when(
        (F.size(acc) >= k) | F.exists(acc, lambda t: t["link"] == x["link"]), acc).otherwise(F.concat(acc, F.array(x))))
    kept = [c for c in sources.columns if c != "html"]
    return (pages.select(*kept, F.posexplode(taken).alias("_at", "_l"))
            .select(*kept, F.col("_l.pos").alias("pos"), F.col("_l.link").alias("link"), (F.col("_at") + 1).alias("source_rank")))


def feed_source_links(sources: DataFrame, feeds: DataFrame, limit, most: int) -> DataFrame:
    """L7 per feed-host source: http links of its feed, distinct, first ``limit``, ``pos`` their order.

    ``feeds``: (feed_url, feed_pos, xml), the documents of each feed in order.  The asked feeds are a list of
    the registry's size; others are dropped by their key before any XML is read.  A feed is read once, however
    many sources lie on it: its first ``most`` links meet the sources, not its documents."""
    asked = sources.drop("html").withColumn("feed_url", U.feed_url_for_source("source_url"))
    urls = [r.feed_url for r in asked.select("feed_url").distinct().collect()]
    wanted = feeds.select("feed_url", "feed_pos", "xml").filter(F.col("feed_url").isin(urls))
    items = FD.feed_items(wanted, feed_url=F.col("feed_url"))
    distinct = items.groupBy("feed_url", "link").agg(F.min(F.struct("feed_pos", "item_pos")).alias("_spot"))
    first = top_k(distinct, ["feed_url"], ["_spot"], most, "source_rank").drop("_spot")
    out = asked.join(first, "feed_url").filter(F.col("source_rank") <= limit)
    return out.withColumn("pos", F.col("source_rank") - 1)


def sources_per_category(sources: DataFrame) -> dict[str, int]:
    return {r.category: r.n for r in sources.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}


def expand_sources(sources: DataFrame, limits: dict[str, int], min_depth: int = 2, feeds: DataFrame | None = None,
                   n_sources: dict[str, int] | None = None) -> DataFrame:
    """L8 (+L9): blogs/news expansion over the categories' listing pages.

    Per source at most ``max(2, ceil(limit / n_sources))`` links (distinct
    only within a source); sources in order until the category has its
    limit: the loop's early stop equals the final cut, a W3 on
    (source_pos, pos).  Feed hosts (``medium.com`` in the host) give the links of
    their feed in ``feeds`` at their place among the sources (none without a feed, as
    when a feed cannot be read).  ``n_sources``: sources of each category, counted if not given.
    """
    n = n_sources or sources_per_category(sources)
    shares = {c: max(2, math.ceil(limit / max(1, n.get(c, 1)))) for c, limit in limits.items()}
    s = sources.filter(F.col("category").isin(list(limits)))
    on_feed_host = U.host("source_url").contains("medium.com")
    kept = ["category", "source_pos", "source_url", "pos", "link", "source_rank"]
    links = same_host_links(s.filter(~on_feed_host), by_category(shares), min_depth).select(*kept)
    if feeds is not None:
        links = links.unionByName(feed_source_links(s.filter(on_feed_host), feeds, by_category(shares), max(shares.values())).select(*kept))
    return top_k(links, ["category"], ["source_pos", "pos"], by_category(limits), "category_rank_pos", max(limits.values()))


def capped_links(candidates: DataFrame, limits: dict[str, tuple[int, int]]) -> DataFrame:
    """L4/L5 (and L6): links distinct across sources, per-source cap, total limit; ``limits``: category -> (limit, cap).

    Only *taken* links are seen, so whether a link is free depends on earlier sources: a fold over
    (source_pos, pos).  Its input is bounded without loss.  (1) Of a source's distinct links the first
    limit + cap can matter: at most limit are taken before, at most cap are taken.  (2) Of a link's
    sources the first ``limit`` can matter: a source that holds a free link and does not take it has
    taken ``cap`` others.  (3) A source that holds a link of no earlier source takes at least one, so
    after ``limit`` such sources the category is full.  Up to there lie at most limit * (limit + cap)
    links, each in at most ``limit`` sources.  ``candidates``: (category, source_pos, pos, link), filtered by
    the category's predicate; a cap of the limit gives the uncapped list of L6.
    """
    limit, cap = by_category({c: q for c, (q, _) in limits.items()}), by_category({c: k for c, (_, k) in limits.items()})
    most, both = max(q for q, _ in limits.values()), max(q + k for q, k in limits.values())
    c = candidates.select("category", F.col("source_pos").cast("long").alias("source_pos"), F.col("pos").cast("int").alias("pos"), "link")
    c = c.filter(F.col("category").isin(list(limits))).groupBy("category", "source_pos", "link").agg(F.min("pos").alias("pos"))
    c = top_k(c, ["category", "source_pos"], ["pos"], limit + cap, "_r", both)
    c = saved(top_k(c, ["category", "link"], ["source_pos"], limit, "_s", most))
    fresh = c.filter("_s = 1").select("category", "source_pos").distinct()
    full = (top_k(fresh, ["category"], ["source_pos"], limit, "_f", most).filter(F.col("_f") == limit)
            .select("category", F.col("source_pos").alias("_last")))  # at most one row per category
    c = c.join(F.broadcast(full), "category", "left").filter(F.col("_last").isNull() | (F.col("source_pos") <= F.col("_last")))
    arr = c.groupBy("category").agg(F.sort_array(F.collect_list(F.struct("source_pos", "pos", "link"))).alias("_c"))
    init = F.struct(F.array().cast("array<struct<source_pos: bigint, pos: int, link: string>>").alias("taken"),
                    F.lit(None).cast("bigint").alias("src"), F.lit(0).alias("n_src"))

    def step(acc, x):
        n_src = F.when(acc["src"] == x["source_pos"], acc["n_src"]).otherwise(F.lit(0))
        free = ~F.exists(acc["taken"], lambda t: t["link"] == x["link"])
        take = free & (n_src < cap) & (F.size(acc["taken"]) < limit)
        return F.struct(
            F.when(take, F.concat(acc["taken"], F.array(x))).otherwise(acc["taken"]).alias("taken"),
            x["source_pos"].alias("src"),
            (n_src + F.when(take, 1).otherwise(0)).alias("n_src"))

    return arr.select("category", F.inline(F.aggregate("_c", init, step)["taken"]))


def strategy(category="category") -> Column:
    """How a category's links are found."""
    c = F.col(category)
    return (F.when(c == "job_postings", "jobs").when(c == "github", "repositories")
            .when(c == "research_papers", "papers").otherwise("expand"))


CODE_BASE, JOB_BASE = "https://github.com", "https://www.linkedin.com"


def is_job_anchor() -> Column:
    """P11 on an exploded anchor."""
    return (F.col("anchor_class").rlike(rf"(^|\s){D.JOB_ANCHOR_CLASS}(\s|$)") | F.col("href").contains(D.JOB_ANCHOR_HREF_PART))


def listing_candidates(pages: DataFrame) -> DataFrame:
    """L4-L6's candidates (category, source_pos, pos, link) of listing pages (strategy, category, source_pos, source_url, html).

    The pages are parsed once; each anchor is resolved against its strategy's base and kept if the
    strategy's predicate holds."""
    how = F.col("strategy")
    a = anchors(pages)
    # Exact pre-filters on the raw href before any URL work: a reference without scheme or authority
    # resolves onto the strategy's own host; one with an authority keeps its own host.
    own_host = ~F.col("href").rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:|//)")
    href_host = U.host(F.col("href"))
    maybe = (((how == "repositories") & (own_host | href_host.isin(*D.CODE_HOSTS)))
             | ((how == "papers") & (own_host | href_host.isin(*D.PAPER_HOSTS))) | ((how == "jobs") & is_job_anchor()))
    base = F.when(how == "repositories", CODE_BASE).when(how == "jobs", JOB_BASE).otherwise(F.col("source_url"))
    a = resolve_hrefs(a.filter(maybe).withColumn("_base", base), "_base")
    keep = (((how == "repositories") & U.is_repository_link("link")) | ((how == "papers") & U.is_paper_link("link"))
            | ((how == "jobs") & U.is_http_url("link")))
    return a.filter(keep).select("category", "source_pos", "pos", "link")


def category_links(sources: DataFrame, max_links: int | None = D.MAX_LINKS, min_depth: int = 2, feeds: DataFrame | None = None,
                   n_sources: dict[str, int] | None = None, listings: DataFrame | None = None) -> DataFrame:
    """Every category's links (category, source_pos, pos, link), cut to its quota.

    ``sources``: (category, source_pos, source_url, html).  ``listings``: pages of the listing strategies
    with their ``strategy``, if they are not among the sources."""
    n, quota = n_sources or sources_per_category(sources), quotas(max_links)
    expanded = {c: q for c, q in quota.items() if c not in ("github", "research_papers", "job_postings")}
    capped = {c: (q, q if c == "job_postings" else max(1, math.ceil(q / max(1, n.get(c, 1))))) for c, q in quota.items() if c not in expanded}
    pages = sources.withColumn("strategy", strategy()) if listings is None else listings
    found = expand_sources(sources, expanded, min_depth, feeds, n).select("category", "source_pos", "pos", "link")
    return found.unionByName(capped_links(listing_candidates(pages.filter("strategy <> 'expand'")), capped))


def job_links(pages: DataFrame, limit: int, base: str = "https://www.linkedin.com") -> DataFrame:
    """L6 (+P11): job anchors over result pages, distinct across pages, first ``limit``.

    ``pages``: (page_index, html).  Order = (page_index, pos).
    """
    a = anchors(pages).filter(is_job_anchor())
    a = resolve_hrefs(a, base).filter(U.is_http_url("link"))
    a = first_wins(a, ["link"], ["page_index", "pos"])
    return a.orderBy("page_index", "pos").limit(limit)


def discover(parts: dict[str, DataFrame] | DataFrame, max_links: int | None = D.MAX_LINKS) -> DataFrame:
    """Concat per-category candidates (each already cut to its quota,
    with ``source_pos``/``pos``), first-wins distinct after normalisation,
    http only, cut to the target in (category, source, position) order.
    ``parts``: one DataFrame with a ``category`` column, or one per category.
    """
    target = discovery_target(max_links)
    rank = F.lit(len(D.DISCOVERY_CATEGORY_ORDER))
    for i, c in reversed(list(enumerate(D.DISCOVERY_CATEGORY_ORDER))):
        rank = F.when(F.col("category") == c, F.lit(i)).otherwise(rank)
    if isinstance(parts, dict):
        frames = [df if "category" in df.columns else df.withColumn("category", F.lit(cat))
                  for cat, df in parts.items()]
        allc = frames[0].select("category", "source_pos", "pos", "link")
        for f in frames[1:]:
            allc = allc.unionByName(f.select("category", "source_pos", "pos", "link"))
    else:
        allc = parts.select("category", "source_pos", "pos", "link")
    allc = allc.select("category", rank.alias("category_rank"), F.col("source_pos").cast("bigint").alias("source_pos"),
                       F.col("pos").cast("bigint").alias("pos"), F.col("link").alias("_raw"))
    allc = fence(allc.withColumn("link", U.normalize_link("_raw")).drop("_raw"), ["link"])
    allc = allc.filter(U.is_http_url("link"))
    allc = first_wins(allc, ["link"], ["category_rank", "source_pos", "pos"])
    return allc.orderBy("category_rank", "source_pos", "pos").limit(target)


def resolve_links(manual: DataFrame, auto: DataFrame) -> DataFrame:
    """Manual links win; auto links only when no manual link is left.

    The constant anti-join (``auto`` against one manual row on TRUE) keeps
    every auto row iff the manual side is empty, without a count on the
    driver.  Then W1 on the raw link (no utm removal on this path).
    """
    m = manual.select(F.lit(0).alias("src_rank"), F.col("pos").cast("long"), "link")
    one = F.broadcast(m.limit(1).select(F.lit(1).alias("_any")))  # at most one row
    a = auto.select(F.lit(1).alias("src_rank"), F.col("pos").cast("long"), "link").join(one, F.lit(True), "left_anti")
    both = m.unionByName(a)
    return first_wins(both, ["link"], ["src_rank", "pos"])


def manual_links(lines: DataFrame, cli_links: list[str] | None = None) -> DataFrame:
    """Argument links first, then file lines; stripped, blanks dropped.

    ``lines``: (pos, value) as read by ``spark.read.text`` plus a position.
    """
    spark = lines.sparkSession
    cli = spark.createDataFrame([(i, v) for i, v in enumerate(cli_links or [])], "pos long, value string")
    both = (cli.select(F.lit(0).alias("src_rank"), "pos", "value")
            .unionByName(lines.select(F.lit(1).alias("src_rank"), F.col("pos").cast("long"), "value")))
    out = both.select("src_rank", "pos", T.strip_ws("value").alias("link")).filter(F.col("link") != "")
    return out


def fallback_links(lines: DataFrame, limit: int) -> DataFrame:
    """S3: fallback file: stripped, no '#' comments, http(s) only, cut to ``limit``."""
    out = lines.select("pos", T.strip_ws("value").alias("link"))
    out = out.filter((F.col("link") != "") & ~F.col("link").startswith("#") & U.is_http_url("link"))
    return out.orderBy("pos").limit(limit)


def auto_links(sources: DataFrame, max_links: int | None = D.MAX_LINKS, feeds: DataFrame | None = None,
               fallback: DataFrame | None = None, n_sources: dict[str, int] | None = None, min_depth: int = 2) -> DataFrame:
    """L12 + S3: discovered links, or the fallback lines' if nothing was discovered; (pos, link) in order.

    Both lists hold at most the target's number of rows, so the choice (the smaller rank present) is a
    window over so few rows."""
    target = discovery_target(max_links)
    found = discover(category_links(sources, max_links, min_depth, feeds, n_sources), max_links)
    order = Window.orderBy("category_rank", "source_pos", "pos")
    lists = found.select(F.lit(0).alias("_src"), F.row_number().over(order).cast("long").alias("pos"), "link")
    if fallback is not None:
        lists = lists.unionByName(fallback_links(fallback, target).select(F.lit(1).alias("_src"), F.col("pos").cast("long").alias("pos"), "link"))
    first = F.min("_src").over(Window.partitionBy(F.lit(0)))
    return lists.withColumn("_first", first).filter("_src = _first").select("pos", "link")


def run_links(spark: SparkSession, manual: DataFrame | None, registry: DataFrame | None, pages: DataFrame, feeds: DataFrame | None = None,
              fallback: DataFrame | None = None, max_links: int | None = D.MAX_LINKS, min_depth: int = 2) -> DataFrame:
    """X2's link list (seq, link) as one plan: manual links, else discovered ones, else the fallback's.

    ``manual``: (pos, link), blanks dropped here.  ``registry`` (S11): (category, source_pos, source_url); its
    listing pages are looked up among ``pages`` (url, html)."""
    none = spark.createDataFrame([], "pos long, link string")
    own = none if manual is None else manual.select(F.col("pos").cast("long").alias("pos"), T.strip_ws("link").alias("link")).filter("link <> ''")
    auto = none
    if registry is not None:
        asked = registry.select("category", F.col("source_pos").cast("long").alias("source_pos"), "source_url")
        stored = pages.join(asked.select(F.col("source_url").alias("url")).distinct(), "url", "left_semi")
        html = stored.groupBy(F.col("url").alias("source_url")).agg(F.min("html").alias("html"))
        sources = asked.join(html, "source_url", "left").withColumn("html", F.coalesce("html", F.lit("")))
        auto = auto_links(sources, max_links, feeds, fallback, sources_per_category(asked), min_depth)
    elif fallback is not None:
        auto = fallback_links(fallback, discovery_target(max_links)).select(F.col("pos").cast("long").alias("pos"), "link")
    chosen = resolve_links(own, auto)
    return chosen.select((F.col("src_rank") * F.lit(1 << 40) + F.col("pos")).cast("long").alias("seq"), "link")
