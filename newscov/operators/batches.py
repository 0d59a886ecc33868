"""Applying a caller's text classifier, once or in refining passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import newscov
from newscov.functions.answers import first_block, parse_json
from newscov.operators.prompts import with_previous_answer
from newscov.scale import checkpointed

# Executors receive the code itself and need no installed copy of the package.
cloudpickle.register_pickle_by_value(newscov)

Classifier = Callable[[list[str]], list[str | None]]


def _answers(classify: Classifier, prompts: list[str]) -> list[str | None]:
    """Answers for a batch; after a failure one by one, null for each text that fails again."""
    try:
        return list(classify(prompts))
    except Exception:
        if len(prompts) <= 1:
            return [None] * len(prompts)
        return [answer for prompt in prompts for answer in _answers(classify, [prompt])]


def score_batches(df: DataFrame, classify: Classifier, prompt: Column, answer: str = "answer") -> DataFrame:
    """Add the classifier's answer to every row.

    Only the prompt crosses into Python, in Arrow batches of
    ``spark.sql.execution.arrow.maxRecordsPerBatch``. The function counts as
    nondeterministic, which keeps Spark from calling it twice for one row.
    """

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_answers(classify, batch.tolist()), dtype="object")

    return df.withColumn(answer, run.asNondeterministic()(prompt))


def refined_scores(
    df: DataFrame, classify: Classifier, message: Column, text: Column, passes: int = 1, legacy: bool = False
) -> DataFrame:
    """Add ``prediction_label``, the parsed answer after ``passes`` refinements of a first one.

    Each pass is shown the answer before it; ``legacy`` shows the first answer every
    time. A pass without an answer makes the result null, whatever later passes say.

    Only rows whose answer is still open are asked again. A pass that would be shown what the pass before it was
    shown asks the same question once more, so the row keeps its answer; one without an answer is done as well.
    Passes are checkpointed, so a lost executor repeats no calls of earlier passes.
    """
    columns = df.columns
    first = score_batches(df, classify, F.concat_ws("\n", message, text), "_answer")
    answered = F.col("_answer").isNotNull()
    opened = checkpointed(first.withColumn("_shown", first_block(F.col("_answer"))))
    done = [opened.where(~answered)]
    opened = opened.where(answered)
    for number in range(passes):
        prompt = F.concat_ws("\n", with_previous_answer(message, F.col("_shown")), text)
        scored = score_batches(opened.drop("_answer"), classify, prompt, "_answer")
        following = F.col("_shown") if legacy else first_block(F.col("_answer"))
        scored = checkpointed(scored.withColumn("_next", following))
        settled = ~answered | F.col("_shown").eqNullSafe(F.col("_next")) | F.lit(number == passes - 1)
        done.append(scored.where(settled).drop("_next"))
        opened = scored.where(~settled).withColumn("_shown", F.col("_next")).drop("_next")
        if number < passes - 1 and opened.isEmpty():
            break
    if passes == 0:
        done.append(opened)
    parsed = F.when(answered, parse_json(first_block(F.col("_answer")))).alias("prediction_label")
    return reduce(lambda a, b: a.unionByName(b), done).select(*columns, parsed)
