"""Merge and discovery folds against sequential Python folds (random cases)."""

import math
import random

from pyspark.sql import functions as F

from docweave.operators import discover as L
from docweave.operators import merge as M
from docweave.operators import metrics as A

COLLS = ["blogs", "news", "github", "research_papers", "job_postings"]


def seq_merge(state, batch):
    cur = dict(state)
    out = {}
    for seq, link, coll in sorted(batch):
        ex = cur.get(link)
        if ex == coll:
            out[seq] = "duplicate"
        elif ex is not None:
            out[seq] = "moved"
            cur[link] = coll
        else:
            out[seq] = "inserted"
            cur[link] = coll
    return out, cur


def test_merge_matches_sequential_fold(spark):
    rnd = random.Random(7)
    for case in range(6):
        links = [f"l{i}" for i in range(rnd.randint(3, 12))]
        state = {lk: rnd.choice(COLLS) for lk in links if rnd.random() < 0.5}
        batch = [(s, rnd.choice(links), rnd.choice(COLLS)) for s in rnd.sample(range(200), rnd.randint(1, 40))]
        exp, final = seq_merge(state, batch)
        st = spark.createDataFrame(list(state.items()) or [("zz", "blogs")], "link string, collection_name string")
        if not state:
            st = st.filter("false")
        b = spark.createDataFrame(batch, "seq long, link string, collection_name string")
        for chunk in (3, 1 << 20):  # tiny chunks cross chunk borders
            acts = M.merge_actions(b, st, chunk=chunk)
            got = {r.seq: r.action for r in acts.collect()}
            assert got == exp, (case, chunk)
            ns = {r.link: r.collection_name for r in M.new_state(st, acts).collect()}
            assert ns == final, (case, chunk)


def test_merge_with_outcomes(spark):
    rows = [(1, "a", "blogs", "candidate"), (2, "a", None, "error"), (3, "a", "news", "candidate"),
            (4, "b", None, "skipped"), (5, "b", "news", "candidate")]
    b = spark.createDataFrame(rows, "seq long, link string, collection_name string, outcome string")
    st = spark.createDataFrame([("a", "blogs")], "link string, collection_name string")
    got = {r.seq: r.action for r in M.merge_actions(b, st, outcome="outcome").collect()}
    assert got == {1: "duplicate", 2: "error", 3: "moved", 4: "skipped", 5: "inserted"}
    c = A.load_counters(M.merge_actions(b, st, outcome="outcome")).first()
    assert (c.saved_count, c.moved_count, c.duplicate_count, c.skipped_count, c.error_count) == (1, 1, 1, 1, 1)


def test_domain_metrics_edge(spark):
    rows = [("error", None, None), ("ready", "h", 0.5), ("filtered_date_range", "h", 0.3)]
    df = spark.createDataFrame(rows, "status string, source_domain string, ai_relevance_score double")
    got = {r.source_domain: r for r in A.domain_metrics(df).collect()}
    assert (got["unknown"].total, got["unknown"].errors, got["unknown"].avg_ai_relevance_score) == (1, 1, 0.0)
    assert (got["h"].total, got["h"].saved, got["h"].avg_ai_relevance_score) == (2, 1, 0.4)


def test_category_targets(spark):
    for max_links, exp in ((0, [5] * 5), (25, [5] * 5), (28, [6, 6, 6, 5, 5]), (3, [5] * 5)):
        assert list(L.quotas(max_links).values()) == exp


def capped(spark, sources, limit, n_sources):
    rows = [("c", i, pos, link) for i, links in enumerate(sources) for pos, link in enumerate(links)]
    df = spark.createDataFrame(rows, "category string, source_pos long, pos int, link string")
    return [(r.source_pos, r.link) for r in L.capped_links(df, {"c": (limit, max(1, math.ceil(limit / n_sources)))}).orderBy("source_pos", "pos").collect()]


def test_capped_links_worked_cases(spark):
    # limit 2 over 2 sources: one link of each; the second source's first link is taken already
    assert capped(spark, [["a", "b"], ["b", "c"]], 2, 2) == [(0, "a"), (1, "b")]
    # limit 4 over 2 sources: two of each, repeats do not count
    assert capped(spark, [["a", "a", "b", "c"], ["a", "b", "d", "e", "f"]], 4, 2) == [(0, "a"), (0, "b"), (1, "d"), (1, "e")]
    # a source's links past its cap stay open for later sources
    assert capped(spark, [["a", "b", "c"], ["c", "b", "a"], ["b"]], 3, 3) == [(0, "a"), (1, "c"), (2, "b")]
    # a source without new links leaves its share unused; the total stops the walk
    assert capped(spark, [["a"], ["a"], ["x", "y"]], 9, 9) == [(0, "a"), (2, "x")]
    assert capped(spark, [["a", "b"], ["c", "d"], ["e"]], 3, 1) == [(0, "a"), (0, "b"), (1, "c")]


def test_capped_links_properties(spark):
    rnd = random.Random(3)
    for _ in range(6):
        sources = [[f"x{rnd.randint(0, 9)}" for _ in range(rnd.randint(1, 6))] for _ in range(rnd.randint(1, 5))]
        limit, n = rnd.randint(1, 7), rnd.randint(1, 4)
        got = capped(spark, sources, limit, n)
        links = [link for _, link in got]
        assert len(got) <= limit and len(set(links)) == len(links)
        per_source = [sum(s == i for s, _ in got) for i in range(len(sources))]
        assert max(per_source) <= max(1, math.ceil(limit / n))
        assert all(link in sources[s] for s, link in got) and got[0] == (0, sources[0][0])


def test_resolve_links_manual_wins(spark):
    manual = spark.createDataFrame([(0, "m1"), (1, "m1"), (2, "m2")], "pos long, link string")
    auto = spark.createDataFrame([(0, "a1")], "pos long, link string")
    assert sorted(r.link for r in L.resolve_links(manual, auto).collect()) == ["m1", "m2"]
    none = manual.filter("false")
    assert [r.link for r in L.resolve_links(none, auto).collect()] == ["a1"]


def test_anchors(spark):
    html = ('<html><!-- <a href="/hidden">x</a> --><script>var s="<a href=\'/js\'>";</script>'
            '<a class="base-card__full-link x" href=" /jobs/view/1?a=1&amp;utm_x=2 ">J</a>'
            "<A HREF='/b'>B</A><a name=n>no href</a><a href=/c>C</a></html>")
    df = spark.createDataFrame([(1, html)], "page_index long, html string")
    got = [(r.pos, r.href) for r in L.anchors(df).collect()]
    assert [h for _, h in got] == ["/jobs/view/1?a=1&utm_x=2", "/b", "/c"]
    jobs = L.job_links(df, 5).collect()
    assert [r.link for r in jobs] == ["https://www.linkedin.com/jobs/view/1?a=1"]


def test_expand_sources_routes_feed_hosts(spark):
    page = "".join(f'<a href="/blog/post-{i}">x</a>' for i in range(4))
    item = "<item><title>t</title><link>{}</link></item>".format
    sources = spark.createDataFrame([("blogs", 0, "https://a.com/", page), ("blogs", 1, "https://medium.com/tag/ai", page),
                                     ("blogs", 2, "https://pub.medium.com/x", page), ("blogs", 3, "https://b.com/", page),
                                     ("news", 4, "https://medium.com/none", page)], "category string, source_pos long, source_url string, html string")
    feeds = spark.createDataFrame([
        ("https://medium.com/feed/tag/ai", 1, "<rss><channel>" + item("https://medium.com/p/1?utm_source=rss") + item("ftp://no/x")
         + item("https://medium.com/p/1") + item("https://medium.com/p/2") + "</channel></rss>"),
        ("https://medium.com/feed/tag/ai", 2, "<rss><channel>" + item("https://medium.com/p/3") + "</channel></rss>"),
        ("https://pub.medium.com/feed", 1, "<rss><channel>" + "".join(item(f"https://pub.medium.com/{i}") for i in range(5)) + "</channel></rss>"),
        ("https://medium.com/feed/other", 1, "<rss><channel>" + item("https://medium.com/p/9") + "</channel></rss>")],
        "feed_url string, feed_pos long, xml string")

    def links(limit):
        got = L.expand_sources(sources, {"blogs": limit, "news": limit}, feeds=feeds).orderBy("category", "category_rank_pos").collect()
        return [(r.source_pos, r.link.split("//")[1]) for r in got]

    a, m = [(0, f"a.com/blog/post-{i}") for i in range(4)], [(1, f"medium.com/p/{i}") for i in (1, 2, 3)]
    p, b = [(2, f"pub.medium.com/{i}") for i in range(5)], [(3, f"b.com/blog/post-{i}") for i in range(4)]
    assert links(7) == a[:2] + m[:2] + p[:2] + b[:1]
    assert links(12) == a[:3] + m + p[:3] + b[:3]


def test_feed_is_read_once_for_all_its_sources(spark):
    item = "<item><link>https://medium.com/p/{}</link></item>".format
    sources = spark.createDataFrame([("blogs", 0, "https://medium.com/t", ""), ("news", 1, "https://medium.com/t/", ""), ("blogs", 2, "https://medium.com/t?x=1", ""),
                                     ("blogs", 3, "https://medium.com/none", "")], "category string, source_pos long, source_url string, html string")
    feeds = spark.createDataFrame([("https://medium.com/feed/t", 2, f"<rss><channel>{item(1)}{item(3)}{item(4)}</channel></rss>"),
                                   ("https://medium.com/feed/t", 1, f"<rss><channel>{item(1)}{item(2)}{item(1)}</channel></rss>")],
                                  "feed_url string, feed_pos long, xml string")
    out = L.feed_source_links(sources, feeds, L.by_category({"blogs": 2, "news": 3}), 3)
    got = sorted((r.source_pos, r.pos, r.source_rank, r.link[-1]) for r in out.collect())
    assert got == [(0, 0, 1, "1"), (0, 1, 2, "2"), (1, 0, 1, "1"), (1, 1, 2, "2"), (1, 2, 3, "3"), (2, 0, 1, "1"), (2, 1, 2, "2")]
    # The documents are parsed below the join with the sources, not once per source above it.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "Join" not in plan[plan.index("from_xml"):]
