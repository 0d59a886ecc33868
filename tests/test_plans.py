"""What the physical plans of all registered queries must and must not contain."""

import os

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
FITTED = {"detector_scores", "detector_report", "category_scores", "category_metrics", "seeded_topics"}
CLASSIFIED = {"batch_scores", "refined_scores"}
# a model of hashed words is looked up by Arrow batches
SCORED = {n for n in entry.queries() if n.startswith(("detector_", "category_", "seeded_"))} - {"category_counts"}
# an automaton walks over the words
MATCHED = {"topic_tags", "lexicon_topics"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def plans(spark):
    queries = {name: q for name, q in entry.queries().items() if name not in FITTED}
    frames = {name: query(spark, SF_DIR) for name, query in queries.items()}
    return {name: df._jdf.queryExecution().executedPlan().toString() for name, df in frames.items()}


def test_no_cross_joins(plans):
    assert [n for n, p in plans.items() if "NestedLoop" in p or "CartesianProduct" in p] == []


def test_python_only_for_classifiers_models_and_the_lexicon(plans):
    assert {n for n, p in plans.items() if "Python" in p} <= CLASSIFIED | SCORED | MATCHED


def test_answers_are_parsed_once(plans):
    for name in ("answer_classes", "repr_answers", "batch_scores"):
        assert plans[name].count("from_json(") == 1, name


def test_texts_are_read_only_where_needed(plans):
    for name in ("explorer_filtered", "category_counts", "multilabel_metrics", "head_share", "split_sizes", "run_manifest"):
        assert "text" not in plans[name], name


@pytest.mark.parametrize("name", ["chunk_text", "prompt_table", "task_prompts", "training_table", "normalised_labels", "outlet_colours", "parse_mixed_dates"])
def test_row_work_does_not_shuffle(plans, name):
    assert "Exchange" not in plans[name]


@pytest.mark.parametrize("name", ["coverage_by_day", "outlet_daily_share", "themes_by_month", "label_counts", "filter_values"])
def test_one_shuffle_of_partial_sums(plans, name):
    assert plans[name].count("Exchange hashpartitioning") == 1
    assert "partial_" in plans[name] or name == "filter_values"
