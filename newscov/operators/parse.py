"""Class columns from parsed answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscov.functions.answers import class_names

KEEP = ("all", "parsed", "complete")


def with_classes(
    answered: DataFrame, answer: Column, placeholder: str | None = None, keep: str = "all"
) -> DataFrame:
    """Add the three class columns of ``answer``, a map of strings.

    ``keep`` says which rows stay: all, those whose answer could be parsed, or those
    with three non-null classes (a ``placeholder`` for a missing key counts as one).
    The rows are dropped inside the generator: a filter behind it would be pushed
    below the parsing and parse every answer several times.
    """
    if keep not in KEEP:
        raise ValueError(f"keep is one of {KEEP}")
    classes = class_names(F.col("_answer"), placeholder)
    names = [f"c{i}" for i in range(len(classes))]
    rows = F.array(F.struct(*[c.alias(n) for c, n in zip(classes, names)]))
    if keep == "parsed":
        rows = F.filter(rows, lambda row: F.col("_answer").isNotNull())
    if keep == "complete":
        rows = F.filter(rows, lambda row: row["c0"].isNotNull() & row["c1"].isNotNull() & row["c2"].isNotNull())
    found = answered.select("*", answer.alias("_answer")).select(*answered.columns, F.inline(rows))
    return found.withColumnsRenamed({n: f"prediction_label_{i}" for i, n in enumerate(names, start=1)})
