"""Sub-category classification of on-topic articles and evaluation of saved runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.functions import answers as A
from newscov.operators import evaluate, prompts
from newscov.operators.batches import Classifier, refined_scores, score_batches
from newscov.operators.coverage import only_positive
from newscov.operators.parse import with_classes
from newscov.operators.splits import head_rows, tail_share
from newscov.sources.readers import read_articles
from newscov.sources.sinks import append_metrics
from newscov.taxonomy import MACRO_CODES


def classify_articles(
    articles: DataFrame, classify: Classifier, order: list[str], full: bool = True, macro: bool = False,
    text: str = "description",
) -> DataFrame:
    """Prompt the classifier for every on-topic article and keep rows with three usable classes.

    ``full=False`` takes the last fifth in ``order``: of the on-topic rows for micro
    categories, of all rows for macro categories, which then all count as on topic.
    """
    rows = articles if macro else only_positive(articles)
    if not full:
        rows = tail_share(rows, order)
    if macro:
        rows = only_positive(rows, overwrite=True)
    prompt = prompts.macro_prompt(F.col(text)) if macro else prompts.micro_prompt(F.col(text))
    missing = A.MISSING_KEY_MACRO if macro else A.MISSING_KEY_MICRO
    answered = score_batches(rows, classify, prompt, "_text")
    block = answered.withColumn("prediction_label", A.marked_block(F.col("_text"))).drop("_text")
    return with_classes(block, A.parse_json(F.col("prediction_label")), missing, keep="complete")


def classify_with_method(
    articles: DataFrame, classify: Classifier, order: list[str], method: str = "raw", n_shots: int = 0,
    passes: int = 0, examples: dict[str, list[str]] | None = None, first_rows: int | None = None, text: str = "description",
) -> DataFrame:
    """Classify on-topic rows, those of the ``first_rows`` only if given, with one prompt method, refined ``passes`` times."""
    rows = only_positive(articles if first_rows is None else head_rows(articles, order, first_rows))
    message = F.lit(prompts.method_message(method, n_shots, examples))
    user = prompts.around_text(prompts.USER_PROMPT, F.col(text))
    answered = refined_scores(rows, classify, message, user, passes)
    classes = with_classes(answered, F.col("prediction_label"), keep="parsed")
    return classes.withColumn("prediction_label", F.to_json("prediction_label"))


def evaluate_files(
    spark: SparkSession, path: str, macro: bool = False, name_parts: int = 1, sep: str = ",", out: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """Metrics of saved prediction files, one row per file name; ``out`` also appends them to a table, as ``run``."""
    rows = read_articles(spark, path, sep=sep, path_column="_path")
    metrics = evaluate_runs(rows.withColumn("source", A.run_name(F.col("_path"), name_parts)), macro)
    if out is not None:
        append_metrics(metrics, out, run)
    return metrics


def evaluate_runs(predictions: DataFrame, macro: bool = False, source: str = "source") -> DataFrame:
    """Metrics per run of evaluation rows tagged with their run name."""
    lists = evaluate.label_lists(evaluate.evaluation_columns(predictions, source), macro)
    if macro:
        return evaluate.multilabel_metrics(lists, MACRO_CODES, by=[source]).drop("unsure")
    return evaluate.multilabel_metrics(lists, by=[source])
