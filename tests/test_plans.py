"""Plan properties: no Python in the column operators,
top-k windows cut before the shuffle, the store filtered where it is read."""

import __spark_entry__ as se

from conftest import SMALL

PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(spark, name):
    df = se.queries()[name](spark, SMALL)
    df.write.mode("overwrite").format("noop").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_column_operators(spark):
    for name in ("w6_topic_top10", "e11_enrich_documents", "u2_normalize_link", "u3_u5_text_functions",
                 "m1_merge_actions", "a2_domain_metrics", "l12_discover_links", "h1_h5_page_fields", "h8_job_documents", "h12_rendered_article_documents", "h3_main_text"):
        plan = _plan(spark, name)
        assert not any(p in plan for p in PYTHON_NODES), name


def test_flagship_plan(spark):
    plan = _plan(spark, "w6_topic_top10")
    assert "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan
    assert plan.count("FileScan") == 1  # the documents are read and enriched once


def test_merge_filters_store_by_batch(spark):
    plan = _plan(spark, "m1_merge_actions")
    assert "LeftSemi" in plan


def _initial(spark, name):
    return se.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_same_host_links_stay_in_their_row(spark):
    plan = _initial(spark, "l3_same_host_links")
    assert "Exchange" not in plan and "Window" not in plan and plan.count("FileScan") == 1


def test_quotas_cut_before_the_shuffle(spark):
    for name in ("l8_expand_sources", "l12_discover_links"):
        plan = _initial(spark, name)
        limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "[category" in line]
        assert len(limits) >= 2, name  # partial and final
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_folds_are_bounded_and_read_once(spark):
    for name in ("l4_repo_links", "l5_paper_links"):
        plan = _initial(spark, name)
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_date_filter_runs_no_keyword_test(spark):
    plan = _initial(spark, "p4_date_filter")
    assert "Contains" not in plan and "contains(" not in plan.lower()


def test_merge_carries_keys_only(spark):
    for name in ("m1_merge_actions", "m2_new_state"):
        for line in _initial(spark, name).splitlines():
            if "Window" in line or "Aggregate" in line:
                assert "content" not in line and "title" not in line, name
