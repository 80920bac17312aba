"""Whole run with sinks, routing and JSON."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from docweave.operators import documents as P
from docweave.operators import merge as M
from docweave.operators import route as RT
from docweave.operators import store as ST
from docweave.plans.run import run_batch, summary_json
from docweave.sources import views as V
from docweave.sources.pages import pages_from_files
from docweave.sources.tables import read_table

from conftest import SMALL


def empty_store(spark):
    root = tempfile.mkdtemp(prefix="dw-run-") + "/store"
    ST.create_store(spark.createDataFrame([], P.DOCUMENT_SCHEMA), root, buckets=4)
    return root


def test_run_batch_writes_store_and_summary(spark):
    out_dir = tempfile.mkdtemp(prefix="dw-run-")
    pages = read_table(spark, SMALL, "pages", ["page_id", "url", "html"])
    links = pages.select(F.col("page_id").alias("pos"), F.col("url").alias("link")).unionByName(
        spark.createDataFrame([(10_000, "https://nowhere.example.com/x"), (10_001, "  ")], "pos long, link string"))
    store = empty_store(spark)
    given = dict(links=links, inputs=RT.Inputs(pages.select("url", "html").unionAll(pages.select("url", "html"))), store=store,
                 users=V.existing_users(spark, SMALL), start_date=dt.date(2024, 1, 1), end_date=dt.date(2024, 12, 31), runs_out=f"{out_dir}/runs")
    res = run_batch(spark, **given)
    row = spark.read.parquet(f"{out_dir}/runs/runs").first()
    n_pages = pages.count()
    assert row.saved_count + row.moved_count + row.duplicate_count + row.error_count + row.skipped_count == n_pages + 1
    assert row.error_count >= 1 and row.discovered_count == n_pages + 1
    assert len(row.analytics_preview) <= 10 and row.per_collection
    links_out = spark.read.parquet(f"{out_dir}/runs/links")
    assert links_out.count() == n_pages + 1 and {r.run_id for r in links_out.select("run_id").distinct().collect()} == {row.run_id}
    assert spark.read.parquet(f"{out_dir}/runs/domains").agg(F.sum("total")).first()[0] == n_pages + 1
    stored = ST.read_store(spark, store, P.DOCUMENT_SCHEMA)
    assert stored.count() == row.saved_count and M.key_violations(stored, ["link"]).count() == 0
    assert stored.filter("id IS NULL OR created_at IS NULL OR created_by_user_name IS NULL").count() == 0
    again = run_batch(spark, **given)["summary"].first()
    assert (again.saved_count, again.moved_count, again.duplicate_count) == (0, 0, row.saved_count)
    assert ST.current_version(spark, store) == 2
    text = summary_json(res["summary"], pretty=True).first()["json"]
    assert '"saved_count"' in text and '"start_date" : "2024-01-01"' in text


def test_own_extractor(spark):
    def notes(links, inputs):
        return RT.as_parts(links.select("seq", "link", F.concat(F.lit("note "), "link").alias("title"), F.lit("words " * 60).alias("content"),
                                        F.lit("notes").alias("platform")))

    pages = spark.createDataFrame([("https://a.com/x", "<title>A</title><article>" + "text " * 60 + "</article>")], "url string, html string")
    links = spark.createDataFrame([(0, "https://notes.example.com/1"), (1, "https://a.com/x"), (2, "https://github.com/a/b"),
                                   (3, "https://medium.com/p/1"), (4, "https://linkedin.com/jobs/view/1")], "seq long, link string")
    extractors = RT.Extractors().adding("note", notes, ("notes.example.com",))
    got = {r.seq: r for r in RT.extract_links(links, RT.Inputs(pages), extractors).collect()}
    assert got[0].platform == "notes" and got[0].failure is None and got[1].title == "A"
    assert got[2].failure.startswith("Repository") and got[3].failure == got[4].failure == RT.NO_PAGE
    assert len(got) == 5


def test_bad_window(spark):
    with pytest.raises(ValueError):
        run_batch(spark, inputs=RT.Inputs(spark.createDataFrame([], "url string, html string")), store="",
                  users=spark.createDataFrame([], "full_name string"), start_date=dt.date(2024, 2, 1), end_date=dt.date(2024, 1, 1))


def test_pages_from_files(spark):
    d = tempfile.mkdtemp(prefix="dw-pages-")
    os.makedirs(f"{d}/a")
    with open(f"{d}/a/p.html", "wb") as fh:
        fh.write("<html><title>T\u00ef</title></html>".encode() + b"\xff")
    rows = pages_from_files(spark, d, url_prefix="https://h.example.com").collect()
    assert rows[0].url == "https://h.example.com/a/p.html"
    assert rows[0].html.startswith("<html><title>T\u00ef</title>") and rows[0].html.endswith("\ufffd")
