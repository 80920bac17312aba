"""RSS feeds (S5, S6, L7, L13, H11, H17, H18) with Spark's built-in XML support.

A feed table holds one feed document per row (``feed_url``/key + ``xml``);
``from_xml`` parses it, ``inline`` turns items into rows.  A malformed feed
parses to a null channel and contributes no rows; an item without a link
or with a non-http link is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions import dates as DT
from ..operators.common import fence

ITEMS = "item array<struct<title string, link string, description string, pubDate string, `content:encoded` string>>"
#: Items inside the channel (RSS 2.0) and beside it (RSS 1.0).
FEED_SCHEMA = f"channel struct<{ITEMS}>, {ITEMS}"


def clean_html_fragment(c) -> Column:
    """H17 (native form): fragment -> text lines, stripped, blanks dropped; '' -> null."""
    c = T.col(c)
    text = T.html_unescape(F.regexp_replace(c, "<[^>]*>", "\n"))
    return T.nullif_empty(T.normalize_content(text))


def feed_items(feeds: DataFrame, xml: str = "xml", feed_url: Column | None = None) -> DataFrame:
    """S5 + S6: one row per linked item of every feed.

    Columns: the feed's other columns, link (normalised), title,
    description, content (full content, else description), published_at
    (raw, whitespace-cleaned), feed_url.
    """
    keep = [c for c in feeds.columns if c != xml]
    parsed = feeds.select(*keep, F.from_xml(F.col(xml), FEED_SCHEMA).alias("_f"))
    found = F.concat(F.coalesce("_f.channel.item", F.array()), F.coalesce("_f.item", F.array()))
    items = parsed.select(*keep, F.posexplode(found).alias("item_pos", "_i"))
    items = items.filter(F.col("_i.link").isNotNull())
    items = items.withColumn("link", F.col("_i.link")).withColumn("link", U.normalize_link("link"))
    items = fence(items, ["link"]).filter(U.is_http_url("link"))
    desc = clean_html_fragment(F.col("_i.description"))
    out = items.select(
        *keep, "item_pos", "link",
        T.clean_xml_text(F.col("_i.title")).alias("title"),
        desc.alias("description"),
        F.coalesce(clean_html_fragment(F.col("_i.`content:encoded`")), desc).alias("content"),
        T.clean_xml_text(F.col("_i.pubDate")).alias("published_at"),
    )
    return out.withColumn("feed_url", feed_url if feed_url is not None else U.feed_url_for_article("link"))


def feed_links(items: DataFrame, limit: int, source: str = "feed_url") -> DataFrame:
    """Http links of each feed, distinct, first ``limit`` in item order."""
    from ..operators.discover import first_wins, top_k

    d = first_wins(items, [source, "link"], ["item_pos"])
    return top_k(d, [source], ["item_pos"], limit, "feed_rank")


def lookup_entries(links: DataFrame, items: DataFrame, link: str = "link") -> DataFrame:
    """Each link's feed entry by normalised link (left join).

    Of several entries of one link the first counts (feed, then item position), so the join
    multiplies no row.  Both sides are keyed by link; the planner picks broadcast or
    sort-merge by measured size (AQE), no side is broadcast unconditionally.
    """
    fields = ["feed_url", "item_pos", "title", "description", "content", "published_at"]
    entries = (items.groupBy(F.col("link").alias("_entry_link")).agg(F.min(F.struct(*fields)).alias("_e"))
               .select("_entry_link", *[f"_e.{c}" for c in fields if c != "item_pos"]))
    keyed = fence(links.withColumn("_norm", U.normalize_link(link)), ["_norm"])
    return keyed.join(entries, keyed["_norm"] == entries["_entry_link"], "left").drop("_norm", "_entry_link")


def feed_documents(matched: DataFrame, link: str = "link") -> DataFrame:
    """Feed-backed article parts (platform/source ``medium``)."""
    parts = F.array_compact(F.array(
        F.when(T.strip_ws("description") != "", F.col("description")),
        F.when(T.strip_ws("content") != "", F.col("content"))))
    return matched.select(
        *[c for c in matched.columns if c not in ("title", "description", "content", "published_at", "feed_url")],
        F.coalesce(F.col("title"), F.col(link)).alias("title"),
        F.when(F.size(parts) > 0, F.array_join(parts, "\n\n"))
        .otherwise(F.coalesce(F.col("description"), F.lit(""))).alias("content"),
        DT.parse_datetime("published_at").alias("published_at"),
        DT.local_date("published_at").alias("published_date"),
        F.lit("medium").alias("platform"), F.lit("medium").alias("source"),
        F.create_map(F.lit("feed_url"), F.col("feed_url"), F.lit("ingestion_mode"), F.lit("rss")).alias("raw_metadata"),
    )
