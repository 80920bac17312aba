"""Raw page sources (S4): stored pages as (url, html).

Pages come either from a table (parquet with url/html columns) or from
HTML files on storage read with the built-in ``binaryFile`` source; bytes
are decoded as UTF-8 with replacement characters (an unreadable file is a
null page, which the crawl step reports as an error row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def page_text(content) -> Column:
    """Bytes of a page as text; what is not UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(F.col(content).cast("string"))


def pages_from_files(spark: SparkSession, path: str, glob: str = "*.html",
                     url_prefix: str | None = None) -> DataFrame:
    """HTML files -> (url, html).  ``url`` is the file path, or the path
    relative to ``path`` under ``url_prefix`` when one is given."""
    raw = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
           .option("recursiveFileLookup", "true").load(path))
    html = page_text("content")
    url = F.col("path")
    if url_prefix is not None:
        root = path.rstrip("/")
        url = F.concat(F.lit(url_prefix.rstrip("/")), F.regexp_replace("path", rf"^(file:)?{root}", ""))
    return raw.select(url.alias("url"), html.alias("html"))


def pages_from_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet page table with url and html columns; blank pages skipped."""
    return spark.read.parquet(path).select("url", "html").filter(F.col("html").isNotNull())
